"""Quality scores, as columns over texts or over ``markdown.features`` structs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docflow.functions import lexicon, markdown
from docflow.functions.rx import CJK, ML, clamp, count, occurrences, present

LEVEL4 = ("structure", "content", "terms", "markdown", "translation", "formatting", "consistency", "completeness")


def _minus(condition: Column, points) -> Column:
    return F.when(condition, F.lit(points) if not isinstance(points, Column) else points).otherwise(0)


def _ratio(new: Column, old: Column) -> Column:
    return new / F.greatest(old, F.lit(1))


def basic_quality(old: Column, new: Column) -> Column:
    """100 less for a changed length, lost headings, table lines and source characters; the arguments are feature structs."""
    r = _ratio(new["chars"], old["chars"])
    lost = lambda k: (old[k] > 0) & (_ratio(new[k], old[k]) < 0.9)
    score = 100.0 - _minus((r < 0.8) | (r > 1.3), 10) - _minus(new["headings"] < old["headings"], 15) - _minus(lost("table_lines"), 10) - _minus(lost("cjk"), 20)
    return F.greatest(score, F.lit(0.0))


def enhancement_quality(old_text: Column, new_text: Column, old: Column, new: Column) -> Column:
    r = _ratio(new["chars"], old["chars"])
    length = F.when(r.between(0.9, 1.3), 0.3).when(r.between(0.8, 1.5), 0.1).otherwise(0.0)

    def kept(a: Column, b: Column, high: float, low: float) -> Column:
        share = _ratio(b, a)
        return F.when(a <= 0, 0.0).when(share >= high, 0.2).when(share >= low, 0.1).otherwise(0.0)

    terms = kept(markdown.term_occurrences(old_text), markdown.term_occurrences(new_text), 0.9, 0.7)
    heads = F.when(new["headings"] >= old["headings"], 0.15).otherwise(0.0)
    tables = F.when(new["table_lines"] >= old["table_lines"], 0.15).otherwise(0.0)
    total = length + kept(old["cjk"], new["cjk"], 0.95, 0.8) + terms + heads + tables
    return F.when((new_text == "") | (new_text == old_text), 0.0).otherwise(F.least(F.lit(1.0), total))


def final_quality(base: Column, enhanced: Column, enhancement: Column, old_chars: Column, new_chars: Column) -> Column:
    r = _ratio(new_chars, old_chars)
    return clamp(base + F.when(enhanced, enhancement * 20).otherwise(0.0) - F.when(r < 0.8, (0.8 - r) * 50).otherwise(0.0), 0.0, 100.0)


def dictionary_quality(old_text: Column, new_text: Column, old: Column, new: Column, language: str) -> Column:
    if language in ("original", "zh"):
        return F.lit(100.0)
    r = _ratio(new["chars"], old["chars"])
    kept, source = occurrences(new_text, [b for _, b in lexicon.TECHNICAL_TERMS]), occurrences(old_text, [a for a, _ in lexicon.TECHNICAL_TERMS])
    terms = F.when(source > 0, F.least(F.lit(1.0), kept / F.greatest(source, F.lit(1))) * 10).otherwise(0.0)
    heads = _minus((old["headings"] > 0) & (_ratio(new["headings"], old["headings"]) < 0.9), 10)
    cjk = F.when(old["cjk"] > 0, (1 - new["cjk"] / F.greatest(old["cjk"], F.lit(1))) * 20).otherwise(0.0)
    return clamp(100.0 - _minus((r < 0.5) | (r > 2.0), 15) + terms - heads + cjk, 0.0, 100.0)


UNITS = r"\d+(?:\.\d+)?(?:W|MHz|GB|TB|GHz|mm)"


def technical_validation(old_text: Column, new_text: Column) -> Column:
    """Struct (score, status) of a technical translation."""
    cjk = count(new_text, CJK, "")
    asides = sum((count(new_text, p, "(?U)") for p in lexicon.THINKING_PATTERNS[1:]), count(new_text, lexicon.THINKING_PATTERNS[0], "(?U)"))
    rows_old, rows_new = markdown.table_row_count(old_text), markdown.table_row_count(new_text)
    r = F.length(new_text) / F.greatest(F.length(old_text), F.lit(1))
    brand = F.contains(old_text, F.lit("问天")) & ~F.contains(new_text, F.lit("WenTian"))
    score = (
        100
        - F.least(F.lit(50), cjk * 3)
        - F.least(F.lit(30), asides * 10)
        - _minus(brand, 20)
        - _minus((rows_old > 0) & (_ratio(rows_new, rows_old) < 0.9), 15)
        - _minus((r > 2.5) | (r < 0.4), 10)
        - _minus(count(old_text, UNITS) != count(new_text, UNITS), 10)
    )
    score = F.greatest(score, F.lit(0)).cast("long")
    status = F.when(score >= 95, "excellent").when(score >= 85, "good").when(score >= 70, "fair").otherwise("poor")
    return F.struct(score.alias("score"), status.alias("status"))


def ocr_proxy(text: Column) -> Column:
    bonus = F.least(F.lit(0.05), present(text, lexicon.QA_TERMS) * 0.01)
    return F.least(F.lit(1.0), 0.92 + bonus - F.greatest(F.lit(0.0), (1000 - F.length(text)) / 10000))


def ocr_proxy_consensus(text: Column, second: float = 0.87) -> Column:
    return F.least(F.lit(1.0), ocr_proxy(text) * 0.7 + second * 0.3 + F.least(F.lit(0.05), F.length(text) / 10000))


def structure_score(text: Column, f: Column) -> Column:
    part = lambda k, points: F.when(f[k] > 0, points).otherwise(0.0)
    heads = F.when(text.rlike(rf"{ML}^#+\s+(.+)"), 0.3).otherwise(0.0)
    terms = F.least(F.lit(0.1), present(text, lexicon.QA_TERMS) * 0.02)
    return clamp(heads + part("table_lines", 0.2) + part("lists", 0.2) + part("code_blocks", 0.2) + terms, 0.6, 1.0)


def semantic_fallback(text: Column) -> Column:
    terms = F.least(F.lit(0.1), present(text, lexicon.QA_TERMS[:10]) * 0.02)
    return clamp(0.8 - F.when(F.length(text) < 500, 0.2).otherwise(0.0) + terms, 0.7, 1.0)


def level4(text: Column, f: Column) -> list[Column]:
    """The eight checks of level 4, each between 0 and 1, in the order of LEVEL4."""
    floor = lambda x: F.greatest(F.lit(100) - x, F.lit(0)) / 100
    terms = present(text, lexicon.QA_TERMS)
    clashes = sum((F.when(F.contains(text, F.lit(a)) & ~F.contains(text, F.lit(b)), 1).otherwise(0) for a, b in lexicon.CONSISTENT_PAIRS), F.lit(0))
    found = present(text, lexicon.REQUIRED_SECTIONS)
    scores = (
        floor(_minus(f["chars"] < 100, 30) + _minus(count(text, r"^#+\s+") < 1, 20) + _minus(f["titles"] < 1, 15)),
        floor(f["empty_sections"] * 10 + _minus(f["repetition"] > 0.3, 20)),
        floor(F.when(terms == 0, 30).when(terms < 3, 15).otherwise(0)),
        floor(f["bad_headings"] * 5 + f["empty_links"] * 3 + _minus((f["table_rows"] > 0) & (f["separators"] == 0), 15)),
        floor(_minus((f["chars"] > 0) & (f["cjk"] / F.greatest(f["chars"], F.lit(1)) > 0.3), 20)),
        floor(f["empty_items"] * 5 + _minus(f["fences"] % 2 != 0, 20)),
        floor(clashes * 10),
        floor(F.when(found < 2, (4 - found) * 15).otherwise(0)),
    )
    return [s.alias(n) for s, n in zip(scores, LEVEL4, strict=True)]


def content_validation(text: Column, f: Column) -> Column:
    """Struct (score, issues, terms) of the service's content check."""
    terms = present(text, lexicon.REQUIRED_TERMS)
    few = F.when(terms < 5, "few terms")
    code = F.when((f["code_blocks"] < 1) & F.contains(F.lower(text), F.lit("command")), "few code blocks")
    heads = F.when(~text.rlike(rf"{ML}^#{{1,6}}\s+.+$"), "no headings")
    issues = F.array_compact(F.array(few, code, heads))
    return F.struct(F.greatest(F.lit(0.0), 1.0 - 0.2 * F.size(issues)).alias("score"), issues.alias("issues"), terms.alias("terms"))


def correction_quality(old: Column, new: Column) -> Column:
    r = F.length(new) / F.greatest(F.length(old), F.lit(1))
    cased = lambda t: F.size(F.filter(F.array(*map(F.lit, lexicon.QA_TERMS)), lambda x: F.contains(t, x)))
    score = 0.8 + F.when(r.between(0.8, 1.3), 0.1).otherwise(-0.2) + F.when(cased(new) >= cased(old) * 0.9, 0.1).otherwise(0.0)
    return F.when((new == "") | (new == old), 0.0).otherwise(clamp(score, 0.0, 1.0))


def guarded_review(old: Column, new: Column) -> Column:
    """The corrected text unless it lost three tenths of its words."""
    words = lambda t: F.size(F.filter(F.split(t, r"(?U)\s+"), lambda w: w != ""))
    return F.when(words(new) < 0.7 * words(old), old).otherwise(new)


def diff_severity(area: Column, width: Column, height: Column) -> Column:
    share = area / (width * height)
    return F.when(share > 0.1, "critical").when(share > 0.05, "high").when(share > 0.01, "medium").otherwise("low")


def diff_type(before: Column, after: Column) -> Column:
    return F.when((before < 30) & (after > 200), "added").when((before > 200) & (after < 30), "removed").otherwise("changed")
