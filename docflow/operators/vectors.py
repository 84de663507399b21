"""Vectors of words, titles and sections that know meaning: random indexing over the corpus.

Every word has an index vector with a few ones, plus or minus, at places that its hash names. A unit (a title, a section) sums the index
vectors of its distinct words, weighted by rarity; a word's vector sums the units that it is in, each without the word itself. So
words of like company become alike though they never meet, and two aggregations train it all, whatever the corpus. A text's vector
is the weighted sum of its words' unit vectors, of length one; texts without a known word have none.

Texts meet words in bins of some ``BIN`` bytes: the words of a text go to one bin, a word's weight or vector once to each bin that says
it, and sums within a bin are matrix sums over its pairs of text and word. So what is shuffled follows the distinct words of the bins,
no pair carries a vector, and no group follows the input, however common a word is. Equal texts are one with a count. All texts train,
but only words that are asked for have vectors under way, as whole numbers of 40 bits to the largest component. Nothing is collected.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docflow.functions.rx import let
from docflow.operators.similarity import dot, mean_pair_cosine

#: Dimensions of a vector, and ones in an index vector.
SIZE, ONES = 64, 6
#: Cosine of documents with fewer than two sections, a fixed value.
ALONE = 0.8
#: Bits of a place and its sign.
BITS = SIZE.bit_length()
#: Bytes of a bin's texts and their vectors; a larger bin tells a word's vector fewer times. A bin is worked through by pieces of its
#: texts and by parts of its words, and these by pairs that are summed at a time.
BIN, PIECE, PART, PAIRS = 128 << 20, 8 << 20, 1 << 16, 1 << 11
#: Vectors travel as whole numbers of 40 bits, of which ``high`` holds the upper 32, times ``scale``.
MOST = (1 << 39) - 1


def _places(word: Column) -> Column:
    """The places of the word's ones; a minus one at k is -1 - k."""

    def one(k: Column) -> Column:
        at = F.pmod(F.xxhash64(word, k), F.lit(SIZE)).cast("int")
        return F.when(F.xxhash64(k, word) < 0, -1 - at).otherwise(at)

    return F.transform(F.sequence(F.lit(0), F.lit(ONES - 1)), one)


def _packed(word: Column) -> Column:
    """The places in one number, ``BITS`` for each: the place, and above it a one for minus."""
    out = F.lit(0).cast("long")
    for k in map(F.lit, range(ONES)):
        out = out * (1 << BITS) + F.pmod(F.xxhash64(word, k), F.lit(SIZE)) + F.when(F.xxhash64(k, word) < 0, SIZE).otherwise(0)
    return out


def index_vector(word: Column) -> Column:
    """The word's own places as an array: plus or minus one for each, added up where two fall together."""
    each = lambda places: F.transform(F.sequence(F.lit(0), F.lit(SIZE - 1)), lambda d: F.aggregate(places, F.lit(0.0), lambda a, p: a + F.when(p == d, 1.0).when(p == -1 - d, -1.0).otherwise(0.0)))
    return let(_places(word), each)


def words_of(text: Column) -> Column:
    """Distinct lower-case words of letters and digits."""
    return F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), 0))


def _sum(vector: str) -> list[Column]:
    return [F.sum(F.get(F.col(vector), F.lit(d))).alias(f"d{d}") for d in range(SIZE)]


def _gathered() -> Column:
    return F.array(*(F.col(f"d{d}") for d in range(SIZE)))


def _unit(vector: Column) -> Column:
    """The vector at length one; null if it is zero."""
    return let(vector, lambda v: let(F.sqrt(dot(v, v)), lambda n: F.transform(v, lambda x: F.try_divide(x, n))))


def _known(vector: str) -> Column:
    return F.exists(vector, lambda x: F.abs(x) > 1e-9)


# Bins


def _said(text: Column) -> Column:
    """The text's distinct words joined by spaces."""
    return F.array_join(words_of(text), " ")


def _at(texts: DataFrame, text_col: str) -> DataFrame:
    """(_bins): one row, as many bins as the bytes of the texts ask for."""
    return texts.select((F.floor(F.coalesce(F.sum(F.coalesce(F.octet_length(text_col), F.lit(0)) + 8 * SIZE), F.lit(0)) / BIN) + 1).alias("_bins"))


def _binned(rows: DataFrame, text_col: str) -> DataFrame:
    """``rows`` with the words ``_w`` of their texts instead of these, each in its bin; rows that have them stay where they are."""
    if "_bin" in rows.columns:
        return rows
    said = rows.withColumn("_w", _said(F.col(text_col))).where("_w <> ''").drop(text_col)
    placed = said.crossJoin(F.broadcast(_at(rows, text_col)))  # one row
    return placed.withColumn("_bin", F.pmod(F.xxhash64(*said.columns), F.col("_bins"))).drop("_bins").repartition("_bin")


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal texts of a batch as one with their number, so that no bin meets all copies of a text."""
    for batch in batches:
        yield from pa.table([batch.column("_w")], ["_w"]).group_by("_w").aggregate([([], "count_all")]).rename_columns(["_w", "times"]).to_batches()


def _distinct(units: DataFrame, text_col: str) -> DataFrame:
    """(_bin, _w, times): units of equal words as one, in their bins."""
    said = units.select(_said(F.col(text_col)).alias("_w")).where("_w <> ''").mapInArrow(_together, "_w string, times long")
    placed = said.crossJoin(F.broadcast(_at(units, text_col)))  # one row
    dealt = placed.select(F.pmod(F.xxhash64("_w"), F.col("_bins")).alias("_bin"), "_w", "times").repartition("_bin")
    return dealt.groupBy("_bin", "_w").agg(F.sum("times").alias("times"))


def _pieces(rows: pa.Table) -> Iterator[tuple[slice, np.ndarray, pa.Array]]:
    """The rows by pieces of some ``PIECE`` bytes: which they are, all their words, and the number of each one's row in the piece, ascending."""
    start = 0
    for texts in rows["_w"].chunks:
        step = -(-len(texts) // (texts.nbytes // PIECE + 1)) or 1
        for at in range(0, len(texts), step):
            piece = texts[at : at + step]
            lists = pc.split_pattern(piece, " ")
            yield slice(start + at, start + at + len(piece)), pc.list_parent_indices(lists).to_numpy(zero_copy_only=False), pc.list_flatten(lists)
        start += len(texts)


def _counted(rows: pa.Table) -> pa.Table:
    """The words of a bin, each with the number of units that say it there."""
    times = rows["times"].to_numpy().astype(float) if "times" in rows.column_names else np.ones(len(rows))
    found = []
    for which, row, flat in _pieces(rows):
        coded = flat.dictionary_encode()
        n = np.bincount(coded.indices.to_numpy(zero_copy_only=False), times[which][row], len(coded.dictionary))
        found.append(pa.table({"word": coded.dictionary, "k": n}))
    words = pa.concat_tables(found).group_by("word").aggregate([("k", "sum")]).rename_columns(["word", "k"])
    return _small(words.add_column(0, "_of", pa.array(np.full(len(words), rows["_bin"][0].as_py()))))


def _spoken(rows: DataFrame) -> DataFrame:
    """(_of, word, k): each word once for each bin that says it."""
    return rows.groupBy("_bin").applyInArrow(_counted, "_of long, word string, k double")


def _in_bins(rows: DataFrame, words: DataFrame, work: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``work`` for each bin, on its rows and on the ``words`` (_of, word, …) that its texts say."""
    return rows.groupBy("_bin").cogroup(words.groupBy("_of")).applyInArrow(work, schema)


def _small(table: pa.Table) -> pa.Table:
    """The table in batches that are passed on one by one."""
    return pa.Table.from_batches(table.to_batches(max_chunksize=PAIRS), table.schema)


def _pairs(rows: pa.Table, words: pa.Table) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """The pairs of a bin's texts and words by pieces of the rows: number of the row in the piece, ascending, and of the word."""
    known = words["word"].combine_chunks()
    for which, row, flat in _pieces(rows):
        word = pc.fill_null(pc.index_in(flat, value_set=known), -1).to_numpy(zero_copy_only=False)
        yield which, row[word >= 0], word[word >= 0]


def _add(out: np.ndarray, group: np.ndarray, vectors: Callable[[slice], np.ndarray]) -> None:
    """Adds to the rows of ``out`` the sums of the vectors of each group; ``group`` ascends."""
    for at in range(0, len(group), PAIRS):
        part = slice(at, at + PAIRS)
        heads = np.flatnonzero(np.diff(group[part], prepend=-1))
        out[group[part][heads]] += np.add.reduceat(vectors(part), heads)


def _lists(matrix: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(matrix) + 1, dtype=np.int32) * SIZE), pa.array(matrix.ravel()))


def _whole(matrix: np.ndarray) -> dict[str, pa.Array]:
    """The columns of vectors as they travel."""
    scale = np.abs(matrix).max(axis=1, initial=0) / MOST
    whole = np.rint(matrix / np.where(scale > 0, scale, 1)[:, None]).astype(np.int64)
    return {"scale": pa.array(scale), "high": _lists((whole >> 8).astype(np.int32)), "low": _lists(((whole & 255) - 128).astype(np.int8))}


def _component(d: int) -> Column:
    high, low = (F.get(F.col(c), F.lit(d)).cast("double") for c in ("high", "low"))
    return (high * 256.0 + low + 128.0) * F.col("scale")


def _unit_whole(vector: str) -> list[Column]:
    """The same columns for a vector of length one."""
    whole = F.transform(vector, lambda x: F.rint(x * MOST).cast("long"))
    high, low = F.transform(whole, lambda x: F.shiftright(x, 8).cast("int")), F.transform(whole, lambda x: (x.bitwiseAND(F.lit(255)) - 128).cast("tinyint"))
    return [F.lit(1 / MOST).alias("scale"), high.alias("high"), low.alias("low")]


def _index_vectors(packed: np.ndarray) -> np.ndarray:
    out, every = np.zeros((len(packed), SIZE)), np.arange(len(packed))
    for k in range(ONES):
        place = packed >> (k * BITS)
        out[every, place & (SIZE - 1)] += np.where(place & SIZE, -1.0, 1.0)
    return out


def _company(rows: pa.Table, words: pa.Table) -> pa.Table:
    """What a bin adds to the vectors of its words that are asked for: over their texts, the sum of the other words' index vectors, weighted."""
    packed, weight, times = words["places"].to_numpy(), words["weight"].to_numpy(), rows["times"].to_numpy().astype(float)
    own = lambda of: _index_vectors(packed[of]) * weight[of, None]
    asked = np.flatnonzero(words["asked"].to_numpy(zero_copy_only=False))
    number = np.full(len(words), -1, np.int32)
    number[asked] = np.arange(len(asked), dtype=np.int32)
    held, done = [], []
    for which, row, word in _pairs(rows, words):
        every = np.zeros((which.stop - which.start, SIZE))
        _add(every, row, lambda p: own(word[p]))
        to = number[word]
        row, to = row[to >= 0], to[to >= 0]
        order = np.argsort(to, kind="stable")
        to = to[order]
        heads = np.flatnonzero(np.diff(to, prepend=-1))
        held.append((every, times[which], to[heads], np.append(heads, len(to)), row[order].astype(np.min_scalar_type(len(every)))))
    for first in range(0, len(asked), PART):
        of = asked[first : first + PART]
        rest = np.zeros((len(of), SIZE))
        for every, often, said, heads, row in held:
            a, b = np.searchsorted(said, (first, first + len(of)))
            unit, to = row[heads[a] : heads[b]], np.repeat(said[a:b] - first, np.diff(heads[a : b + 1]))
            _add(rest, to, lambda p: (every[unit[p]] - own(of[to[p]])) * often[unit[p], None])
        done.append(pa.table({"word": words["word"].take(pa.array(of)).combine_chunks(), "weight": weight[of]} | _whole(rest)))
    return _small(pa.concat_tables(done) if done else pa.table({"word": pa.array([], pa.string()), "weight": np.zeros(0)} | _whole(np.zeros((0, SIZE)))))


def _weighted(rows: pa.Table, words: pa.Table) -> pa.Table:
    """A bin's rows with the weighted sums of their words' vectors."""
    high, low = (pc.list_flatten(words[c].combine_chunks()).to_numpy(zero_copy_only=False).reshape(-1, SIZE) for c in ("high", "low"))
    weight, scale = words["weight"].to_numpy(), words["scale"].to_numpy()
    own = lambda of: (high[of] * 256.0 + low[of] + 128.0) * scale[of, None] * weight[of, None]
    x = np.zeros((len(rows), SIZE))
    for which, row, word in _pairs(rows, words):
        _add(x[which], row, lambda p: own(word[p]))
    return _small(rows.drop_columns(["_w", "_bin"]).append_column("x", _lists(x)))


def word_vectors(units: DataFrame, text_col: str = "text", least: int = 1, asked: DataFrame | None = None) -> DataFrame:
    """(word, weight, vector) from units of text, one a row: the word's rarity, and its vector of length one, null without company.

    Words of fewer than ``least`` units are left out. All units train; ``asked`` are texts whose words alone are told, by default all are.
    """
    own = _binned(_distinct(units, text_col), "_w")
    counts = _spoken(own).withColumn("n", F.sum("k").over(Window.partitionBy("word"))).where(F.col("n") >= least)  # a row a bin
    if asked is None:
        counts = counts.withColumn("asked", F.lit(True))
    else:
        told = asked.select(F.explode(words_of(F.col(text_col))).alias("word")).distinct().withColumn("asked", F.lit(True))
        counts = counts.join(told, "word", "left").withColumn("asked", F.coalesce("asked", F.lit(False)))
    total = units.select(F.count(F.lit(1)).alias("total"))
    weights = counts.crossJoin(F.broadcast(total)).select("_of", "word", F.log(1 + F.col("total") / F.col("n")).alias("weight"), _packed(F.col("word")).alias("places"), "asked")  # one row
    met = _in_bins(own, weights, _company, "word string, weight double, scale double, high array<int>, low array<tinyint>").repartition("word")  # a bin tells a word once: nothing to combine before
    summed = met.groupBy("word").agg(F.max("weight").alias("weight"), *(F.sum(_component(d)).alias(f"d{d}") for d in range(SIZE))).select("word", "weight", _gathered().alias("v"))
    return summed.select("word", "weight", F.when(_known("v"), _unit(F.col("v"))).alias("vector"))


def text_vectors(rows: DataFrame, words: DataFrame, keys: tuple[str, ...], text_col: str = "text") -> DataFrame:
    """(keys…, vector) of texts with a known word."""
    own = _binned(rows.select(*keys, F.col(text_col).alias("_text")), "_text")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keys).schema.fields)
    said = _spoken(own).select("_of", "word").join(words.where("vector is not null").select("word", "weight", *_unit_whole("vector")), "word")
    met = _in_bins(own, said, _weighted, f"{kinds}, x array<double>")
    summed = met.groupBy(*keys).agg(*_sum("x")).select(*keys, _gathered().alias("v"))
    return summed.where(_known("v")).select(*keys, _unit(F.col("v")).alias("vector"))


def title_likeness(original: DataFrame, result: DataFrame, words: DataFrame) -> DataFrame:
    """(doc_id, semantic): cosine of the sums of both sides' title vectors (doc_id, pos, title), at least 0; 0 where a side has none."""
    # Equal titles of a document are one with a count.
    each = lambda d: text_vectors(d.groupBy("doc_id", "title").agg(F.count(F.lit(1)).alias("n")), words, ("doc_id", "title", "n"), "title")
    side = lambda d, to: each(d).withColumn("x", let(F.col("n"), lambda n: F.transform("vector", lambda v: v * n))).groupBy("doc_id").agg(*_sum("x")).select("doc_id", _gathered().alias(to))
    both = side(original, "x").join(side(result, "y"), "doc_id")
    cosine = F.try_divide(dot(F.col("x"), F.col("y")), F.sqrt(dot(F.col("x"), F.col("x"))) * F.sqrt(dot(F.col("y"), F.col("y"))))
    docs = original.select("doc_id").union(result.select("doc_id")).distinct()
    return docs.join(both, "doc_id", "left").select("doc_id", F.greatest(F.lit(0.0), F.coalesce(cosine, F.lit(0.0))).alias("semantic"))


#: What begins a section, with the line end before it.
HEAD = r"\n#{1,6}\s+"


def sections(docs: DataFrame, text_col: str = "md") -> DataFrame:
    """(doc_id, pos, text): the texts between heading lines."""
    return docs.select("doc_id", F.posexplode(F.split(F.coalesce(F.col(text_col), F.lit("")), HEAD)).alias("pos", "text"))


def compared_sections(docs: DataFrame, text_col: str = "md") -> DataFrame:
    """The sections of documents with more than one; the others' coherence is fixed, whatever their words."""
    return sections(docs.where(F.col(text_col).rlike(HEAD)), text_col)


def section_words(docs: DataFrame, text_col: str = "md") -> DataFrame:
    """Word vectors that all sections train, of the words that ``section_coherence`` of the same documents asks for."""
    return word_vectors(sections(docs, text_col), asked=compared_sections(docs, text_col))


def section_coherence(docs: DataFrame, words: DataFrame, text_col: str = "md") -> DataFrame:
    """(doc_id, semantic): the mean cosine over all pairs of a document's sections; a fixed value for fewer than two."""
    found = mean_pair_cosine(text_vectors(compared_sections(docs, text_col), words, ("doc_id", "pos")), "doc_id", "vector")
    return docs.select("doc_id").distinct().join(found, "doc_id", "left").select("doc_id", F.coalesce("cosine", F.lit(ALONE)).alias("semantic"))
