"""Words of texts without spaces: the best path through a lattice of lexicon words, with frequencies counted from the corpus.

A run of source-script characters is cut where the product of its words' shares is largest; any single character is a word,
at least as rare as the rarest. Among equal paths the one with the longer first word wins, and so on. Words start at a node of a trie of
the lexicon and follow the text, so a place costs at most the longest word's length. Stretches of other letters and digits are words
as they stand.

The lexicon comes from the corpus: sequences of up to ``LONGEST`` characters that occur ``LEAST`` times or more, and hold
together (each of their two-part cuts would be expected less often than they are seen), counted by one aggregation, of which the
``MOST`` frequent ones travel to the tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from math import inf, log

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.functions.rx import CJK
from docflow.operators.adapters import pieces

#: Characters of a lexicon word, times it must occur, words that travel (some 20 bytes each).
LONGEST, LEAST, MOST = 4, 5, 200_000
_PIECES = re.compile("[一-鿿]+|[^\\W_一-鿿]+")


class Lexicon:
    """A trie of words, their costs (minus the log of their shares) at its nodes."""

    def __init__(self, counts: Iterable[tuple[str, float]]):
        found = [(w, float(n)) for w, n in counts if w and n > 0]
        total = sum(n for _, n in found) or 1.0
        self.unknown = log(total) - log(min((n for _, n in found), default=1.0))
        self.root: dict = {}
        for word, n in found:
            node = self.root
            for c in word:
                node = node.setdefault(c, {})
            node[""] = log(total) - log(n)

    def words(self, run: str) -> list[str]:
        """The cheapest path through the words of a run, found from its end on."""
        n = len(run)
        cost, step = [inf] * n + [0.0], [1] * n
        for i in range(n - 1, -1, -1):
            node, j = self.root, i
            best, size = cost[i + 1] + self.unknown, 1
            while j < n and (node := node.get(run[j])) is not None:
                j += 1
                if "" in node and cost[j] + node[""] <= best:
                    best, size = cost[j] + node[""], j - i
            cost[i], step[i] = best, size
        out, i = [], 0
        while i < n:
            out.append(run[i : i + step[i]])
            i += step[i]
        return out

    def cut(self, text: str | None) -> list[str]:
        """All words of a text."""
        out: list[str] = []
        for piece in _PIECES.findall(text or ""):
            out += self.words(piece) if "一" <= piece[0] <= "鿿" else [piece]
        return out


def sequences(text: Column) -> Column:
    """All sequences of up to LONGEST characters within the runs of source script."""
    runs = F.regexp_extract_all(text, F.lit(f"{CJK}+"), 0)
    of = lambda r, k: F.when(F.length(r) >= k, F.transform(F.sequence(F.lit(1), F.length(r) - (k - 1)), lambda i: F.substring(r, i, F.lit(k)))).otherwise(F.array().cast("array<string>"))
    return F.flatten(F.transform(runs, lambda r: F.concat(*(of(r, k) for k in range(1, LONGEST + 1)))))


def lexicon_counts(docs: DataFrame, text_col: str = "text", least: int = LEAST, most: int = MOST) -> DataFrame:
    """(word, n): sequences of the corpus that occur often enough and hold together, and all single characters; the most frequent ones."""
    counts = docs.select(F.explode(sequences(F.col(text_col))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where((F.col("n") >= least) | (F.length("word") == 1))
    total = counts.where(F.length("word") == 1).agg(F.sum("n").alias("total"))
    cuts = counts.where(F.length("word") > 1).withColumn("at", F.explode(F.sequence(F.lit(1), F.length("word") - 1)))
    ends = cuts.select("word", "n", F.expr("substring(word, 1, at)").alias("head"), F.expr("substring(word, at + 1)").alias("tail"))
    # Parts of a frequent sequence are frequent too, so both are there.
    side = lambda name: counts.select(F.col("word").alias(name), F.col("n").alias(f"{name}_n"))
    both = ends.join(side("head"), "head").join(side("tail"), "tail").crossJoin(F.broadcast(total))  # one row
    firm = both.groupBy("word", "n").agg(F.bool_and(F.col("n") * F.col("total") > F.col("head_n") * F.col("tail_n")).alias("firm")).where("firm").select("word", "n")
    return counts.where(F.length("word") == 1).unionByName(firm).orderBy(F.desc("n"), "word").limit(most)


def read_lexicon(counts: DataFrame) -> Lexicon:
    """The lexicon on the driver; ``counts`` are as bounded as ``lexicon_counts`` leaves them."""
    return Lexicon((r["word"], r["n"]) for r in counts.limit(MOST).collect())


def segmented(rows: DataFrame, lexicon: Lexicon, columns: dict[str, str]) -> DataFrame:
    """``rows`` with an array of words for each text column: ``columns`` maps the text's name to the words'."""
    names = list(columns)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            words = [pa.array([lexicon.cut(t) for t in part.column(name).to_pylist()], pa.list_(pa.string())) for name in names]
            yield pa.RecordBatch.from_arrays([*part.columns, *words], [*part.schema.names, *(columns[n] for n in names)])

    kinds = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields), *(f"`{columns[n]}` array<string>" for n in names)])
    return rows.mapInArrow(work, kinds)


def token_overlap(a: Column, b: Column) -> Column:
    """The share of two word lists' distinct words that both have; 0 where there are none."""
    return F.coalesce(F.try_divide(F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))), F.lit(0.0))
