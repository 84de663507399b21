"""Main text of web pages by a linear-chain conditional random field over the DOM's leaf blocks.

A page becomes the sequence of its leaf blocks (runs of text between block-level tags, white space made single, character
references decoded). Each block has features of its ancestors' tags and of the words in their class, id and role, and
of its text: length, share of linked text, punctuation, symbols. A two-state chain (boilerplate, content) over these
features, trained by gradient descent on the conditional likelihood of labelled pages, is decoded by Viterbi; the
content blocks, joined by line feeds, are the main text.

The labelled pages are made here, by a generator of page layouts (``labelled_pages``): menus, headers, footers,
sidebars, notices, adverts, forms and comments around and inside articles in several kinds of container, with telling,
misleading or no names; some pages have neither names nor telling tags, so that text alone must decide. Training
takes a fixed number of pages and a few seconds on the driver; only the weights (some thousand floats) travel.

Defined results: null or blank html gives empty text; broken markup is read as browsers do, as far as blocks are
concerned (unclosed tags, stray angle brackets, missing ends): a tag ends at the next ``>`` outside quoted values, whatever
their length, and one without an end hides the rest of the page. Open elements are found by tag, however deep, and only names that
the model knows are kept for them, so time follows the page's length without bounds on depth or sizes. Pages of any
length are read whole; repeated rows each get their text; an empty table gives an empty result; other columns do not matter.
"""

from __future__ import annotations

import random
import re
from collections.abc import Container, Iterable, Iterator
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 head header hr html label legend li main menu nav noframes ol optgroup option p pre section select summary table tbody td textarea tfoot th thead title tr ul".split()
)
#: What a page does not show as text, up to its end tag; without one, the first kind hides the rest of the page, the second nothing.
RAW_TAGS = frozenset("script style noscript template iframe noembed xmp title".split())
EMBEDDED_TAGS = frozenset("svg object canvas audio video head".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Opening the first closes an open one of the second, up to one of the third.
IMPLIED = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}
CLOSES_P = BLOCK_TAGS - {"button", "label", "option", "optgroup", "body", "html", "head"}
#: A comment, a declaration, or a tag up to its end; values in quotes may hold anything, an unclosed quote is a character.
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?|[\"'])*+)(?:>|\Z)", re.S)
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
NAME_WORD = re.compile(r"[a-z]+")


class _Open:
    """An open element: its tag, the nearest block element, whether it is in a link, and the features of it and its ancestors."""

    __slots__ = ("block", "features", "link", "tag")

    def __init__(self, tag: str, attributes: str, above: _Open | None, known: Container[str] | None = None):
        own = {f"in:{tag}"} if tag in BLOCK_TAGS else set()
        if attributes and above:
            for found in NAMES.finditer(attributes):
                words = (f"name:{w}" for w in NAME_WORD.findall((found[1] or found[2] or found[3] or "").lower()))
                own.update(words if known is None else (w for w in words if w in known))
        before = above.features if above else frozenset()
        self.tag, self.link, self.features = tag, tag == "a" or bool(above and above.link), before if own <= before else before | own
        self.block = self if above is None or tag in BLOCK_TAGS else above.block


class _Stack:
    """The open elements, with the places of each tag's and of the block elements."""

    def __init__(self) -> None:
        self.all, self.by, self.blocks = [_Open("", "", None)], {}, []

    def push(self, element: _Open) -> None:
        self.by.setdefault(element.tag, []).append(len(self.all))
        if element.tag in BLOCK_TAGS:
            self.blocks.append(len(self.all))
        self.all.append(element)

    def last(self, tags: Iterable[str]) -> int:
        """The place of the innermost open one of these; 0 if there is none."""
        return max((self.by[t][-1] for t in tags if self.by.get(t)), default=0)

    def cut(self, at: int) -> None:
        """Closes the element at a place and all within it."""
        while len(self.all) > at:
            tag = self.all.pop().tag
            self.by[tag].pop()
            if tag in BLOCK_TAGS:
                self.blocks.pop()

    def end(self, tag: str) -> None:
        """An end tag: an inline one does not close block elements."""
        at = self.last((tag,))
        if at and (tag in BLOCK_TAGS or not self.blocks or self.blocks[-1] < at):
            self.cut(at)

    def close(self, tags: Iterable[str], within: Iterable[str]) -> None:
        """Closes the innermost of ``tags`` unless one of ``within`` is further in."""
        at = self.last(tags)
        if at > self.last(within):
            self.cut(at)


def blocks(html: str, known: Container[str] | None = None) -> Iterator[tuple[str, str, frozenset[str], int]]:
    """(text, tag, ancestor features, characters in links) of each leaf block in page order; ``known``: the features that matter."""
    stack = _Stack()
    parts: list[str] = []
    endless: set[str] = set()
    linked = at = 0
    end = len(html)

    def flush():
        nonlocal linked
        text = " ".join("".join(parts).split())
        top = stack.all[-1]
        made = (text, top.block.tag, top.features, linked) if text else None
        parts.clear()
        linked = 0
        return made

    while at < end:
        found = TAG.search(html, at)
        upto = found.start() if found else end
        if upto > at:
            # Character references end with their piece of text.
            piece = html[at:upto]
            parts.append(unescape(piece) if "&" in piece else piece)
            if stack.all[-1].link:
                linked += upto - at
        if not found:
            break
        at = found.end()
        if found[2] is None:
            continue
        if at == end and html[-1] != ">":
            break
        closing, tag = found[1], found[2].lower()
        if tag == "br":
            parts.append(" ")
            continue
        if tag in BLOCK_TAGS and parts and (made := flush()):
            yield made
        if tag in RAW_TAGS or tag in EMBEDDED_TAGS:
            if closing or found[3].endswith("/"):
                continue
            stop = None if tag in endless else re.compile(rf"</{tag}\b[^<>]*>", re.I).search(html, at)
            if stop:
                at = stop.end()
                continue
            endless.add(tag)
            if tag in RAW_TAGS:
                break
            continue
        if closing:
            stack.end(tag)
        elif tag not in VOID_TAGS:
            if tag in CLOSES_P:
                stack.close(("p",), ("button", "td", "th", "table"))
            if tag in IMPLIED:
                stack.close(*IMPLIED[tag])
            stack.push(_Open(tag, found[3], stack.all[-1], known))
    if parts and (made := flush()):
        yield made


def _text_features(text: str, tag: str, linked: int) -> list[str]:
    n, words = len(text), text.count(" ") + 1
    size, links, stop = min(words.bit_length(), 7), min(4, 5 * linked // max(n, 1)), text[-1] in ".!?…。"
    sentences = min(3, text.count(". ") + text.count("! ") + text.count("? ") + stop)
    return [
        f"tag:{tag}",
        f"words:{size}",
        f"links:{links}",
        f"stop:{stop}",
        f"commas:{min(3, text.count(','))}",
        f"mark:{'©' in text or '®' in text or '·' in text}",
        f"upper:{text[:1].isupper()}",
        f"size:{size},{links},{sentences}",
        f"kind:{tag},{links > 2},{size > 3}",
    ]


# Labelled pages


def _words(rng: random.Random, n: int, junk: str = "") -> str:
    letters = rng.choice(("etaoinshrdlu", "enisratdhul", "esaitnrulod", "eaosrnidlc"))
    out = ["".join(rng.choices(letters, k=rng.randint(1, 11))) + junk for _ in range(n)]
    out = [w + "." if rng.random() < 0.1 else w + "," if rng.random() < 0.05 else w for w in out]
    text = " ".join(out)
    return text.upper() if junk and rng.random() < 0.4 else text.capitalize()


CHROME = {
    "nav": "nav menu navigation navbar breadcrumb breadcrumbs toc pagination topnav mainmenu",
    "header": "header masthead topbar banner site branding logo",
    "footer": "footer bottom copyright legal colophon imprint",
    "aside": "sidebar side rail widget related recommended aside secondary complementary",
    "ad": "ad ads advert advertisement sponsor sponsored promo adslot dfp banner",
    "notice": "notice cookie consent alert gdpr message popup modal warning newsletter paywall disclaimer",
    "form": "form search login signup subscribe contact newsletter",
    "comments": "comments comment disqus respond replies reply discussion reader",
    "share": "share social sharing tools meta tags byline follow buttons",
}
MISLEADING = "wrap box widget block top meta tools panel header7 side"
CONTENT = "content article post entry story main body text page maincontent hentry prose read single"


def _attr(rng: random.Random, words: str) -> str:
    name = rng.choice(words.split())
    if rng.random() < 0.4:
        name += rng.choice("-_") + rng.choice(("box", "wrap", "inner", "block", "area", "list", "container", "x7", "top"))
    return f' {rng.choice(("class", "id", "class"))}="{name}"'


def _chrome(rng: random.Random, kind: str) -> list:
    """Tokens of a piece that is not content: markup strings and (text, label) pairs."""
    tag = {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form"}.get(kind, "div")
    named = _attr(rng, CHROME[kind])
    if tag != "div" and rng.random() < 0.5:
        named = "" if rng.random() < 0.7 else named
    elif tag != "div":
        tag = rng.choice(("div", "section")) if kind != "form" else "form"
    out: list = [f"<{tag}{named}>"]
    style = rng.choice({"nav": ["list"], "header": ["heading", "list", "plain"], "footer": ["plain", "mark", "list", "mark"], "form": ["form"], "comments": ["paras", "plain"], "aside": ["list", "paras", "heading"], "ad": ["plain", "paras"], "notice": ["plain", "paras"], "share": ["list", "plain"]}[kind])
    if style == "list":
        out.append("<ul>")
        for _ in range(rng.randint(2, 8)):
            out += ["<li><a href='/x'>", (_words(rng, rng.randint(1, 4)), 0), rng.choice(("</a></li>", "</a>"))]
        out.append("</ul>")
    elif style == "heading":
        out += [f"<h{(h := rng.randint(1, 4))}>", (_words(rng, rng.randint(1, 5)), 0), f"</h{h}><p>", (_words(rng, rng.randint(2, 15)), 0), "</p>"]
    elif style == "form":
        out += ["<label>", (_words(rng, 2), 0), "</label><input name=q><button>", (_words(rng, 1), 0), "</button>"]
        if rng.random() < 0.4:
            out += ["<select><option>", (_words(rng, 1), 0), "<option>", (_words(rng, 1), 0), "</select>"]
    elif style == "paras":
        for _ in range(rng.randint(1, 6)):
            box = rng.choice(("p", "div", "p"))
            out += [f"<{box}>", (_words(rng, rng.randint(3, 60)), 0), f"</{box}>"]
    else:
        mark = rng.choice(("&copy; ", "© ")) if style == "mark" else ""
        out.append((mark + _words(rng, rng.randint(3, 25)) + (" &middot; " + _words(rng, 6) if style == "mark" else ""), 0))
    return [*out, f"</{tag}>"]


def _container(rng: random.Random) -> tuple[str, str]:
    """Tag and attributes of an article's container: telling ones, plain ones, misleading ones."""
    kind = rng.random()
    if kind < 0.4:
        return "article", "" if rng.random() < 0.7 else _attr(rng, CONTENT)
    if kind < 0.5:
        return "main", ""
    return rng.choice(("div", "div", "section")), _attr(rng, CONTENT) if kind < 0.7 else "" if kind < 0.92 else _attr(rng, MISLEADING)


def _article(rng: random.Random, container: tuple[str, str] | None = None) -> list:
    tag, named = container or _container(rng)
    junk = rng.choice(("", "", "", "***", "$$$", "%%%", "!!", "&amp;&amp;", " |"))
    out: list = [f"<{tag}{named}>"]
    if rng.random() < 0.85:
        out += [rng.choice(("<h1>", "<h1>", "<h2>", "<header><h1>")), (_words(rng, rng.randint(1, 9), junk), 1), ""]
        out[-1] = {"<h1>": "</h1>", "<h2>": "</h2>", "<header><h1>": "</h1></header>"}[out[-3]]
    for _ in range(rng.choice((1, 1, 2, 3, 5, 8, 12))):
        part, n = rng.random(), rng.choice((1, 2, 4, 8, 15, 30, 60, 120))
        if part < 0.7:
            out += [rng.choice(("<p>", "<p>", "<p><b>", "<div>")), (_words(rng, n, junk), 1), ""]
            out[-1] = "</div>" if out[-3] == "<div>" else rng.choice(("</p>", "<br>", ""))
        elif part < 0.78:
            out += ["<h2>", (_words(rng, rng.randint(1, 6), junk), 1), "</h2>"]
        elif part < 0.86:
            out += [x for _ in range(rng.randint(1, 5)) for x in ("<li>", (_words(rng, rng.randint(1, 20), junk), 1), "</li>")]
            out.insert(-3, "")
        elif part < 0.9:
            out += [(o := rng.choice(("<blockquote>", "<pre>", "<figure><figcaption>"))), (_words(rng, n, junk), 1), {"<blockquote>": "</blockquote>", "<pre>": "</pre>", "<figure><figcaption>": "</figcaption></figure>"}[o]]
        elif part < 0.94:
            out += ["<table><tr><td>", (_words(rng, 2, junk), 1), "<td>", (_words(rng, 3, junk), 1), "</table>"]
        else:
            out += _chrome(rng, rng.choice(("ad", "aside", "share", "form", "notice")))
    if rng.random() < 0.15:
        out += _chrome(rng, rng.choice(("comments", "share", "ad")))
    return [*out, f"</{tag}>"]


def _nameless(rng: random.Random) -> str:
    return f"<div class={rng.choice('abcdefgxyz')}{rng.randint(1, 99)}>"


def _prose(rng: random.Random, n: int) -> str:
    """A paragraph: mostly with full stops and commas as sentences have them."""
    words = _words(rng, n).rstrip(".,").split(" ")
    if rng.random() < 0.85:
        words = [w.rstrip(".") + ("." if i % 14 == 13 else "") for i, w in enumerate(words)]
        words[-1] = words[-1].rstrip(".,") + rng.choice("...!?")
    return " ".join(words)


def _plain_chrome(rng: random.Random, kind: str) -> list:
    """A piece that is not content in a container without a name: links, a short line, a mark, a form."""
    out: list = [rng.choice(("<div>", "<div>", "<section>", _nameless(rng)))]
    if kind == "links":
        listed = rng.random() < 0.7
        out.append("<ul>" if listed else "")
        for _ in range(rng.randint(2, 9)):
            out += ["<li><a href=/x>" if listed else "<a href=/x>", (_words(rng, rng.randint(1, 4)), 0), "</a></li>" if listed else "</a></div><div>"]
        out.append("</ul>" if listed else "")
    elif kind == "mark":
        out.append((rng.choice(("&copy; ", "© ")) + _words(rng, rng.randint(2, 12)) + rng.choice(("", " &middot; " + _words(rng, 3))), 0))
    elif kind == "form":
        out += ["<form><label>", (_words(rng, 2), 0), "</label><input name=q><button>", (_words(rng, 1), 0), "</button></form>"]
    else:
        out += ["<a href=/>", (_words(rng, rng.randint(1, 3)), 0), "</a>"]
    return [*out, {"<section>": "</section>"}.get(out[0], "</div>")]


def _plain_body(rng: random.Random) -> list:
    """The body of a page without telling names and tags: text alone says what the article is."""
    before, after = ["logo", "links", "form"], ["links", "mark", "form"]
    out, often = [], rng.choice((0.0, 0.3, 0.6, 0.8))
    for kind in before:
        out += _plain_chrome(rng, kind) if rng.random() < often else []
    tag = rng.choice(("div", "div", "section", "td"))
    inner: list = ["<table><tr><td>"] if tag == "td" else [_nameless(rng) if tag == "div" and rng.random() < 0.3 else f"<{tag}>"]
    if rng.random() < 0.7:
        inner += ["<h1>", (_words(rng, rng.randint(2, 9)), 1), "</h1>"]
    for _ in range(rng.choice((1, 2, 2, 3, 5, 9))):
        box = rng.choice(("p", "p", "p", "div", "h2", "blockquote"))
        inner += [f"<{box}>", (_words(rng, rng.randint(2, 6)) if box == "h2" else _prose(rng, rng.choice((8, 15, 30, 60, 120))), 1), f"</{box}>"]
    out += [*inner, "</td></tr></table>" if tag == "td" else f"</{tag}>"]
    for kind in after:
        out += _plain_chrome(rng, kind) if rng.random() < often else []
    return out


def _short_page(rng: random.Random) -> list:
    """An article of one or two paragraphs with a line or two that are not of it: a footer, comments, an aside, a logo."""
    box = rng.choice(("article", "article", "main", "div", "section", ""))
    wraps = rng.choice((0, 0, 0, 1, 2, 5))
    out: list = ["<body>", "<div>" * wraps]
    if rng.random() < 0.15:
        out += [*rng.choice((("<header>", "</header>"), ("<div class=logo>", "</div>"), ("<nav><a href=/>", "</a></nav>")))]
        out.insert(-1, (_words(rng, rng.randint(1, 4)), 0))
    out += [f"<{box}>" if box else ""]
    for _ in range(rng.choice((1, 1, 1, 2))):
        out += ["<p>", (_prose(rng, rng.choice((10, 16, 25, 45))), 1), "</p>"]
    out += [f"</{box}>" if box else "", "</div>" * wraps]
    ends = (("<footer>", "</footer>"), ("<footer><p>", "</p></footer>"), ("<div class=comments><p>", "</p></div>"), ("<section class=comments><p>", "</p></section>"), ("<aside>", "</aside>"), ("<aside><p>", "</p></aside>"), ("<div class=footer>", "</div>"))
    for first, last in rng.sample(ends, rng.choice((0, 1, 1, 1, 2))):
        line = _words(rng, rng.randint(1, 6)).rstrip(".,") + rng.choice(("", "", ".", " 2020"))
        out += [first, (rng.choice(("", "", "Copyright ", "&copy; ")) + line if "footer" in first else line, 0), last]
    return [*out, "</body>"]


def labelled_page(rng: random.Random) -> tuple[str, list[int]]:
    """A page and the labels of its leaf blocks (1: content)."""
    if rng.random() < 0.15:
        return _labelled(_short_page(rng))
    if rng.random() < 0.04:
        box = rng.choice(("article", "div", "main", "p", "section"))
        return _labelled([f"<body><{box}><p>", (rng.choice((_words, _prose))(rng, rng.choice((8, 20, 50))), 1), f"</p></{box}></body>"])
    if rng.random() < 0.35:
        return _labelled(["<html><head><title>t</title></head><body>", *_plain_body(rng), "</body></html>"])
    tokens: list = [f"<!DOCTYPE html><html><head><title>{_words(rng, 5)}</title><style>p{{margin:0}}</style><script>var t='</p>';</script></head><body>"]
    for kind in ("header", "nav", "notice", "ad"):
        if rng.random() < 0.55:
            tokens += _chrome(rng, kind)
    wrap = rng.random() < 0.3
    tokens += ["<div id='wrapper' class='container'>"] * wrap
    if rng.random() < 0.2:
        tokens += _chrome(rng, "aside")
    tokens += _article(rng)
    for kind in ("comments", "aside", "share", "form", "ad"):
        if rng.random() < 0.25:
            tokens += _chrome(rng, kind)
    tokens += ["</div>"] * wrap
    if rng.random() < 0.8:
        tokens += _chrome(rng, "footer")
    tokens.append(rng.choice(("</body></html>", "")))
    return _labelled(tokens)


def _labelled(tokens: list) -> tuple[str, list[int]]:
    html = "".join(t if isinstance(t, str) else t[0] for t in tokens)
    # A control character and the label at each text's end come back in its leaf block.
    marked = "".join(t if isinstance(t, str) else f"{t[0]} \x02{t[1]}" for t in tokens)
    labels = [int(text[text.index("\x02") + 1]) for text, *_ in blocks(marked)]
    return html, labels


def labelled_pages(n: int, seed: int = 7) -> list[tuple[str, list[int]]]:
    rng = random.Random(seed)
    return [labelled_page(rng) for _ in range(n)]


# The chain


def block_features(html: str | None, known: Container[str] | None = None) -> list[tuple[str, list[str], frozenset[str]]]:
    """(text, text features, ancestor features) of each block; the first and last block know that they are."""
    found = [(text, _text_features(text, tag, linked), above) for text, tag, above, linked in blocks(html or "", known)]
    if len(found) == 1:
        found[0][1].append("only")
    elif found:
        found[0][1].append("first")
        found[-1][1].append("last")
    return found


class Crf:
    """Binary linear chain: a weight for each feature of content against boilerplate, transitions, and ends."""

    def __init__(self, weights: dict[str, float], steps: list[list[float]], start: float, bias: float):
        self.weights, self.steps, self.start, self.bias = weights, steps, start, bias
        self.above: dict[frozenset[str], float] = {}

    def emissions(self, found: list) -> list[float]:
        get, above = self.weights.get, self.above
        if len(above) > 50_000:
            above.clear()
        out = []
        for _, own, inherited in found:
            if (s := above.get(inherited)) is None:
                s = above[inherited] = sum(get(f, 0.0) for f in inherited)
            out.append(self.bias + s + sum(get(f, 0.0) for f in own))
        return out

    def viterbi(self, e: list[float]) -> list[int]:
        (a00, a01), (a10, a11) = self.steps
        s0, s1, back = 0.0, self.start + e[0], []
        for x in e[1:]:
            b0, b1 = s1 + a10 > s0 + a00, s1 + a11 > s0 + a01
            s0, s1 = (s1 + a10 if b0 else s0 + a00), (s1 + a11 if b1 else s0 + a01) + x
            back.append((b0, b1))
        y = int(s1 > s0)
        out = [y]
        for b in reversed(back):
            y = int(b[y])
            out.append(y)
        return out[::-1]

    def main_text(self, html: str | None) -> str:
        found = block_features(html, self.weights)
        if not found:
            return ""
        return "\n".join(f[0] for f, y in zip(found, self.viterbi(self.emissions(found)), strict=True) if y)


def train(pages: list[tuple[str, list[int]]], rounds: int = 200, rate: float = 0.1, decay: float = 2e-4) -> Crf:
    """Maximises the conditional likelihood of the labels by Adam, over all pages at once."""
    ids: dict[str, int] = {}
    rows, cols, data = [], [], []
    for html, labels in pages:
        found = block_features(html)
        if len(found) != len(labels):
            raise ValueError("labels do not match blocks")
        data.append((len(rows), labels))
        for _, own, above in found:
            rows.append(len(rows))
            cols.append([ids.setdefault(f, len(ids)) for f in (*own, *sorted(above))])
    r = np.repeat(np.arange(len(cols)), [len(c) for c in cols])
    c = np.concatenate([np.asarray(x, np.int64) for x in cols])
    longest = max(len(y) for _, y in data)
    at = np.full((len(data), longest), -1)
    y = np.zeros((len(data), longest), np.int64)
    for i, (first, labels) in enumerate(data):
        at[i, : len(labels)] = np.arange(first, first + len(labels))
        y[i, : len(labels)] = labels
    on = at >= 0
    theta, d = np.zeros(len(ids) + 6), len(ids)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, rounds + 1):
        e = np.bincount(r, theta[c], len(cols)) + theta[d + 5]
        x = np.where(on, e[at], 0.0)
        step, start = theta[d : d + 4].reshape(2, 2), theta[d + 4]
        score = np.stack([np.zeros_like(x), x], -1)
        forward, backward = np.zeros_like(score), np.zeros_like(score)
        forward[:, 0] = score[:, 0] + [0.0, start]
        for k in range(1, longest):
            f = np.logaddexp.reduce(forward[:, k - 1, :, None] + step, axis=1) + score[:, k]
            forward[:, k] = np.where(on[:, k, None], f, forward[:, k - 1])
        for k in range(longest - 2, -1, -1):
            b = np.logaddexp.reduce(step + (score[:, k + 1] + backward[:, k + 1])[:, None, :], axis=2)
            backward[:, k] = np.where(on[:, k + 1, None], b, backward[:, k + 1])
        total = np.logaddexp.reduce(forward[:, -1], axis=1)
        p = np.exp(forward + backward - total[:, None, None])[..., 1]
        g = np.zeros_like(theta)
        miss = np.where(on, y - p, 0.0)
        flat = np.zeros(len(cols))
        flat[at[on]] = miss[on]
        g[:d] = np.bincount(c, flat[r], d)
        g[d + 4], g[d + 5] = miss[:, 0].sum(), miss.sum()
        both = np.exp(forward[:, :-1, :, None] + step + (score[:, 1:] + backward[:, 1:])[:, :, None, :] - total[:, None, None, None]) * on[:, 1:, None, None]
        seen = np.zeros((2, 2))
        np.add.at(seen, (y[:, :-1][on[:, 1:]], y[:, 1:][on[:, 1:]]), 1)
        g[d : d + 4] = (seen - both.sum((0, 1))).ravel()
        g = g / len(data) - decay * theta
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta += rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return Crf({f: float(theta[i]) for f, i in ids.items()}, theta[d : d + 4].reshape(2, 2).tolist(), float(theta[d + 4]), float(theta[d + 5]))


@lru_cache(maxsize=1)
def default_model() -> Crf:
    """Trained on 700 generated pages; the same each time."""
    return train(labelled_pages(700), rounds=150)


def extract(df: DataFrame, model: Crf | None = None, html_col: str = "html", carry: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``carry``, the main ``text`` of each page and its code points."""
    model = model or default_model()
    state = (model.weights, model.steps, model.start, model.bias)
    own = df.select(F.col(f"`{html_col}`").alias("_html"), *(F.col(f"`{c}`") for c in carry))

    def work(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crf = Crf(*state)
        for batch in rows:
            for at in range(0, batch.num_rows, 256):
                b = batch.slice(at, 256)
                texts = [crf.main_text(x.as_py()) for x in b.column(0)]
                yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=[*carry, "text", "n_chars"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields[1:])
    return own.mapInArrow(work, f"{kinds}, text string, n_chars long")
