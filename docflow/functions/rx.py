"""Regular expressions that read text as Unicode with line feeds as the only line ends, and small text helpers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Multiline, Unix line ends, Unicode classes.
ML = "(?mdU)"
CJK = r"[\x{4e00}-\x{9fff}]"
FENCE = "```"


def count(text: Column, pattern: str, flags: str = ML) -> Column:
    """Non-overlapping matches, as a long."""
    return F.regexp_count(text, F.lit(flags + pattern)).cast("long")


def strip(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+\z", "")


def rstrip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)\s+\z", "")


def lines(text: Column) -> Column:
    return F.split(text, "\n")


def map_lines(text: Column, f) -> Column:
    return F.array_join(F.transform(lines(text), f), "\n")


def replace_in_order(text: Column, pairs: Iterable[tuple[str, str]]) -> Column:
    """Each pair's replacement applied to the result of the ones before; the plan holds one literal array."""
    table = F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in pairs))
    return F.aggregate(table, text, lambda t, p: F.replace(t, p["a"], p["b"]))


def _total(parts: list[Column]) -> Column:
    out = parts[0]
    for p in parts[1:]:
        out = out + p
    return out.cast("long")


def occurrences(text: Column, terms: Iterable[str]) -> Column:
    """Non-overlapping occurrences summed over terms; terms that contain one another each count."""
    lost = lambda t: F.when(F.contains(text, F.lit(t)), F.floor((F.length(text) - F.length(F.replace(text, F.lit(t), F.lit("")))) / len(t))).otherwise(0)
    return F.when(text.isNotNull(), _total([lost(t) for t in terms]))


def present(text: Column, terms: Iterable[str]) -> Column:
    """How many of the terms occur, whatever the case. One flat sum, so generated code lowers the text once."""
    low = F.lower(text)
    return _total([F.contains(low, F.lit(t.lower())).cast("int") for t in terms])


def let(value: Column, body) -> Column:
    """``body(value)`` with value evaluated once for each row, wherever the optimizer moves the expression."""
    return F.element_at(F.transform(F.array(value), body), 1)


#: Items that an inner fold takes.
PART = 256


def emitted(items: Column, state: dict[str, Column], kind: str, step) -> Column:
    """The elements that a fold over ``items`` emits, as ``array<kind>``.

    ``step(state, item)`` gives the new state, as a dict with the same keys, and an array of what it emits. Every step copies
    the state, so what is emitted must not stay in it: an inner fold takes ``PART`` items and an outer one the inner ones'
    results. Keep the state small; what all steps read comes in by ``let``.
    """
    none = F.array().cast(f"array<{kind}>")

    def advance(a: Column, x: Column) -> Column:
        new, out = step(a, x)
        return F.struct(*(new[k].alias(k) for k in state), F.concat(a["_out"], out.cast(f"array<{kind}>")).alias("_out"))

    def part(a: Column, block: Column) -> Column:
        inner = F.aggregate(block, F.struct(*(a[k].alias(k) for k in state), none.alias("_out")), advance)
        return let(inner, lambda v: F.struct(*(v[k].alias(k) for k in state), F.concat(a["_all"], F.array(v["_out"])).alias("_all")))

    def blocks(every: Column) -> Column:
        starts = F.when(F.size(every) > 0, F.sequence(F.lit(1), F.size(every), F.lit(PART))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.slice(every, i, F.lit(PART)))

    zero = F.struct(*(v.alias(k) for k, v in state.items()), F.array().cast(f"array<array<{kind}>>").alias("_all"))
    return F.aggregate(let(items, blocks), zero, part, lambda a: F.flatten(a["_all"]))


def clamp(value: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(value, F.lit(low)), F.lit(high))
