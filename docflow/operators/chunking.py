"""Chunks of long documents with overlap, their merging, and the batch plan of line translation. Folds within a row; no shuffle."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docflow.functions import markdown
from docflow.functions.rx import emitted, let, lines, strip

LONGEST, OVERLAP, SHORTEST = 6000, 500, 1000
MARK = "\x01"


def fixed_chunks(text: Column, longest: int = LONGEST, overlap: int = OVERLAP) -> Column:
    """Pieces of ``longest`` characters that start ``longest - overlap`` apart; whole, if short; blank ones fall out."""
    starts = F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1)), F.lit(longest - overlap))
    return F.when(F.length(text) <= longest, F.array(text)).otherwise(F.filter(F.transform(starts, lambda i: F.substring(text, i, F.lit(longest))), lambda c: strip(c) != ""))


def header_chunks(text: Column, longest: int = LONGEST, overlap: int = OVERLAP, shortest: int = SHORTEST) -> Column:
    """Pieces that end before a heading once they are ``shortest`` long, or at ``longest``; each starts with the tail of the last.

    Pieces under ``shortest`` fall out at the end, as the rule has it; a short text is one piece.
    """
    marked = F.regexp_replace(text, r"(?dU)\n(#+\s+.*?)\n", MARK + "$1" + MARK)
    tail = lambda c: F.substring(c, -overlap, overlap)

    def step(a: Column, part: Column) -> Column:
        head = part.rlike(r"(?U)^#+\s+")
        full = head & (F.length(a["cur"]) >= shortest)
        out = F.when(full, F.concat(a["out"], F.array(strip(a["cur"])))).otherwise(a["out"])
        cur = F.when(full, F.concat(tail(a["cur"]), F.lit("\n"), part)).when(head, F.concat(a["cur"], F.lit("\n"), part)).otherwise(F.concat(a["cur"], part))
        return _flush(F.struct(cur.alias("cur"), out.alias("out")))

    def _flush(s: Column) -> Column:
        whole = F.length(s["cur"]) >= longest
        return F.struct(F.when(whole, tail(s["cur"])).otherwise(s["cur"]).alias("cur"), F.when(whole, F.concat(s["out"], F.array(strip(s["cur"])))).otherwise(s["out"]).alias("out"))

    zero = F.struct(F.lit("").alias("cur"), F.array().cast("array<string>").alias("out"))
    done = F.aggregate(F.split(marked, MARK), zero, step, lambda a: F.concat(a["out"], F.when(strip(a["cur"]) != "", F.array(strip(a["cur"]))).otherwise(F.array().cast("array<string>"))))
    return F.when(F.length(text) <= longest, F.array(text)).otherwise(F.filter(done, lambda c: F.length(c) >= shortest))


def without_overlap(before: Column, after: Column, overlap: int = OVERLAP) -> Column:
    """``after`` without the longest start, in steps of 10, that shares three tenths of its words with the end of ``before``."""
    most = F.least(F.lit(overlap), F.length(before), F.length(after))
    words = lambda t: F.filter(F.split(t, r"(?U)\s+"), lambda w: w != "")

    def alike(n: Column) -> Column:
        suffix, prefix = words(F.right(before, n)), words(F.left(after, n))
        return F.size(F.array_intersect(suffix, prefix)) / F.greatest(F.size(suffix), F.lit(1)) > 0.3

    lengths = F.when(most > 50, F.sequence(most, F.lit(51), F.lit(-10))).otherwise(F.array().cast("array<int>"))
    cut = F.coalesce(F.get(F.filter(lengths, alike), F.lit(0)), F.lit(0))
    return F.substring(after, cut + 1, F.length(after))


def merge_chunks(chunks: Column, overlap: int = OVERLAP) -> Column:
    """Pieces joined, overlaps cut, with a blank line where neither side has one.

    What is cut from a piece depends on the last ``overlap`` characters so far, so only these are carried along.
    """

    def step(a: Column, chunk: Column) -> tuple[dict[str, Column], Column]:
        rest = without_overlap(a["tail"], chunk, overlap)
        gap = F.when(a["tail"].endswith("\n\n") | rest.startswith("\n"), "").otherwise("\n\n")
        piece = F.concat(F.when(a["first"], F.lit("")).otherwise(gap), F.when(a["first"], chunk).otherwise(rest))
        return {"tail": F.right(F.concat(a["tail"], piece), F.lit(max(overlap, 2))), "first": F.lit(False)}, F.array(piece)

    many = strip(F.array_join(emitted(chunks, {"tail": F.lit(""), "first": F.lit(True)}, "string", step), ""))
    return F.when(F.size(chunks) == 0, "").when(F.size(chunks) == 1, F.get(chunks, F.lit(0))).otherwise(many)


def batch_plan(text: Column, compat: bool = True, blanks: bool = False) -> Column:
    """Batches of a document's lines: array of (first, lines).

    A batch is sized by its first line's kind and leaves blank lines out; ``compat`` moves on by the number of lines taken, so
    after an interior blank line the last ones come again; otherwise by the lines covered. With ``blanks``, a blank line that is
    reached comes as a batch of its own.
    """
    kind = "struct<first:int,lines:array<string>>"
    normal = F.regexp_replace(text, "\r\n?", "\n")
    rows = F.transform(lines(normal), lambda x: F.struct(x.alias("line"), markdown.batch_size(markdown.complexity(x)).alias("n")))

    def planned(every: Column) -> Column:
        def step(a: Column, i: Column) -> tuple[dict[str, Column], Column]:
            here = F.get(every, i)
            go, blank = i >= a["next"], strip(here["line"]) == ""
            taken = F.transform(F.filter(F.slice(every, i + 1, here["n"]), lambda r: strip(r["line"]) != ""), lambda r: r["line"])
            moved = F.when(blank, 1).otherwise(F.size(taken) if compat else here["n"])
            own = F.when(blank, F.array(here["line"])).otherwise(taken) if blanks else taken
            batch = F.array(F.struct(i.cast("int").alias("first"), own.alias("lines")))
            state = {"next": F.when(go, i + moved).otherwise(a["next"]).cast("int")}
            return state, F.when(go if blanks else go & ~blank, batch).otherwise(F.array().cast(f"array<{kind}>"))

        return emitted(F.sequence(F.lit(0), F.size(every) - 1), {"next": F.lit(0)}, kind, step)

    return let(rows, planned)
