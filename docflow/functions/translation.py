"""Dictionary translation, clean-up of model output, prompts and cache keys, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docflow.functions import lexicon
from docflow.functions.rx import CJK, map_lines, replace_in_order, strip

DICTIONARIES = {"ru": lexicon.TO_RUSSIAN, "en": lexicon.TO_ENGLISH}


def substitute_terms(text: Column) -> Column:
    return replace_in_order(text, lexicon.TECHNICAL_TERMS)


def translate_headings(text: Column, language: str) -> Column:
    """Heading words, in heading lines only."""
    words = [p for p in lexicon.HEADING_WORDS.get(language, ()) if p[1]]
    return map_lines(text, lambda x: F.when(strip(x).startswith("#"), replace_in_order(x, words)).otherwise(x)) if words else text


def translate_tables(text: Column, language: str) -> Column:
    """Cells of lines with three parts or more, stripped and put together again without padding."""
    words = [p for p in DICTIONARIES.get(language, ()) if p[1]]

    def cells(line: Column) -> Column:
        parts = F.split(line, r"\|")
        done = F.array_join(F.transform(parts, lambda c: replace_in_order(strip(c), words)), "|")
        return F.when(F.size(parts) >= 3, done).otherwise(line)

    return map_lines(text, cells) if words else text


def post_process(text: Column, language: str) -> Column:
    """Blank runs, punctuation and quotes of Russian, spacing of terms in parentheses."""
    t = F.regexp_replace(text, r"(?U)\n\s*\n\s*\n+", "\n\n")
    if language == "ru":
        t = F.regexp_replace(t, r"\.([А-Я])", ". $1")
        t = F.replace(t, F.lit('"'), F.lit("«"))
    return strip(F.regexp_replace(t, r"(?U)\(\s*([A-Za-z0-9]+)\s*\)", " ($1)"))


def translate(text: Column, language: str, preserve_terms: bool = True) -> Column:
    """Terms, dictionary, headings, tables, clean-up, in this order; other languages than the dictionaries' only keep terms."""
    t = substitute_terms(text) if preserve_terms else text
    t = replace_in_order(t, [p for p in DICTIONARIES.get(language, ()) if p[1]])
    return post_process(translate_tables(translate_headings(t, language), language), language)


def scrub(text: Column) -> Column:
    """Model output without its asides."""
    t = strip(text)
    for p in lexicon.SCRUB_PATTERNS:
        t = F.regexp_replace(t, f"(?isuU){p}", "")
    return t


def fix_terms(text: Column, language: str) -> Column:
    """Struct of the text with brand names and terms set right, and how many rules applied."""
    t, n = text, F.lit(0)
    for p in lexicon.BRAND_FIXES:
        n = n + t.rlike(f"(?U){p}").cast("int")
        t = F.regexp_replace(t, f"(?U){p}", "WenTian")
    table = lexicon.TERMINOLOGY_RU if language == "ru" else lexicon.TERMINOLOGY
    pairs = F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in table))
    step = lambda s, p: F.struct(F.replace(s["text"], p["a"], p["b"]).alias("text"), (s["fixes"] + F.contains(s["text"], p["a"]).cast("int")).alias("fixes"))
    return F.aggregate(pairs, F.struct(t.alias("text"), n.alias("fixes")), step)


def post_process_model(text: Column, language: str) -> Column:
    return strip(F.regexp_replace(fix_terms(scrub(text), language)["text"], r"(?U)\n\s*\n\s*\n+", "\n\n"))


def residual_fragments(text: Column, most: int = 10) -> Column:
    """The first runs of two or more source characters."""
    return F.slice(F.regexp_extract_all(text, F.lit(f"{CJK}{{2,}}"), 0), 1, most)


def repair_residuals(text: Column, lookup) -> Column:
    """The first fragments replaced, one occurrence each, where ``lookup`` of a fragment differs and has no source characters."""

    def step(t: Column, f: Column) -> Column:
        new = lookup(f)
        at = F.position(f, t)
        ok = new.isNotNull() & (new != f) & ~new.rlike(CJK) & (at > 0)
        return F.when(ok, F.concat(F.substring(t, F.lit(1), at - 1), new, F.substring(t, at + F.length(f), F.length(t)))).otherwise(t)

    return F.aggregate(residual_fragments(text), text, step)


def cache_key(text: Column, source: Column, target: Column) -> Column:
    return F.substring(F.md5(F.concat_ws("-", source, target, text).cast("binary")), 1, 16)


def prompt_key(prompt: Column) -> Column:
    return F.sha2(prompt, 256)


def language_name(code: Column) -> Column:
    names = F.create_map(*(F.lit(x) for p in lexicon.LANGUAGE_NAMES for x in p))
    return F.coalesce(F.try_element_at(names, code), code)


def chat_template(messages: Column) -> Column:
    """Messages (role, content) in the block format of chat models, open for the assistant."""
    block = lambda m: F.concat(F.lit("<|im_start|>"), m["role"], F.lit("\n"), m["content"], F.lit("<|im_end|>"))
    return F.concat(F.array_join(F.transform(messages, block), "\n"), F.lit("\n<|im_start|>assistant\n"))


def translation_messages(text: Column, source: Column, target: Column) -> Column:
    """System and user message of a translation request."""
    system = F.concat(F.lit("You translate technical documents from "), language_name(source), F.lit(" to "), language_name(target), F.lit(". Keep Markdown, numbers, units and commands. Answer with the translation only."))
    message = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    return F.array(message("system", system), message("user", text))


def parse_response(body: Column) -> Column:
    """Content and token usage of a chat completion's JSON; a missing total is the sum."""
    usage = "usage struct<prompt_tokens:int,completion_tokens:int,total_tokens:int>"
    r = F.from_json(body, f"choices array<struct<message:struct<content:string>>>, {usage}")
    p, c = F.coalesce(r["usage"]["prompt_tokens"], F.lit(0)), F.coalesce(r["usage"]["completion_tokens"], F.lit(0))
    text = strip(F.get(r["choices"], F.lit(0))["message"]["content"])
    return F.struct(text.alias("content"), p.alias("prompt_tokens"), c.alias("completion_tokens"), F.coalesce(r["usage"]["total_tokens"], p + c).alias("total_tokens"))


def route_task(text: Column) -> Column:
    """translation only if strictly more of its words occur than of content work."""
    hits = lambda words: F.size(F.filter(F.array(*map(F.lit, words)), lambda w: F.contains(F.lower(text), w)))
    return F.when(hits(lexicon.TRANSLATION_KEYWORDS) > hits(lexicon.CONTENT_KEYWORDS), "translation").otherwise("content_transformation")


def classify_error(message: Column) -> Column:
    """Struct (category, action) of an error message."""
    pair = lambda c, a: F.struct(F.lit(c).alias("category"), F.lit(a).alias("action"))
    out = None
    for words, category, action in lexicon.ERROR_RULES:
        hit = F.contains(message, F.lit(words))
        out = F.when(hit, pair(category, action)) if out is None else out.when(hit, pair(category, action))
    net = F.contains(message, F.lit("Connection")) | F.contains(F.lower(message), F.lit("timeout"))
    return out.when(net, pair("network_error", "retry_with_backoff")).otherwise(pair("general_error", "investigate_logs"))
