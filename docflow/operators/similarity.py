"""Text and vector likeness. Word overlap is native; edit distance and matching blocks of long texts run in Arrow batches."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType

from docflow.functions import alike
from docflow.functions.rx import CJK, let, strip


@F.pandas_udf(DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """The share of matching blocks of two texts."""
    return pd.Series([alike.block_ratio(x or "", y or "") for x, y in zip(a, b, strict=True)], dtype="float64")


@F.pandas_udf(LongType())
def edit_distance(a: pd.Series, b: pd.Series) -> pd.Series:
    """The edit distance of two texts of any length; null if one is."""
    return pd.Series([None if x is None or y is None else alike.edit_distance(x, y) for x, y in zip(a, b, strict=True)], dtype="Int64")


def word_jaccard(a: Column, b: Column) -> Column:
    words = lambda t: F.array_distinct(F.filter(F.split(t, r"(?U)\s+"), lambda w: w != ""))
    return F.try_divide(F.size(F.array_intersect(words(a), words(b))), F.size(F.array_union(words(a), words(b))))


def edit_similarity(a: Column, b: Column) -> Column:
    return 1 - F.try_divide(edit_distance(a, b), F.greatest(F.length(a), F.length(b)))


def cjk_bigrams(text: Column) -> Column:
    runs = F.regexp_extract_all(text, F.lit(f"{CJK}+"), 0)
    pairs = lambda r: F.when(F.length(r) < 2, F.array(r)).otherwise(F.transform(F.sequence(F.lit(1), F.length(r) - 1), lambda i: F.substring(r, i, F.lit(2))))
    return F.array_distinct(F.flatten(F.transform(runs, pairs)))


def text_similarity(a: Column, b: Column, words: tuple[Column, Column] | None = None) -> Column:
    """Weighted edit, word, block and, with source characters, token likeness; 0 for blank texts.

    Tokens are ``words``, arrays as ``segmentation.segmented`` gives them, or else pairs of characters.
    """
    x, y = words or (cjk_bigrams(a), cjk_bigrams(b))
    tokens = F.coalesce(F.try_divide(F.size(F.array_intersect(x, y)), F.size(F.array_union(x, y))), F.lit(0.0))
    e, j, s = edit_similarity(a, b), F.coalesce(word_jaccard(a, b), F.lit(1.0)), sequence_ratio(a, b)
    cjk = F.concat(a, b).rlike(CJK)
    return F.when((strip(a) == "") | (strip(b) == ""), 0.0).when(cjk, e * 0.3 + j * 0.2 + s * 0.3 + tokens * 0.2).otherwise(e * 0.4 + j * 0.3 + s * 0.3)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def mean_pair_cosine(vectors: DataFrame, by: str, vector: str) -> DataFrame:
    """(by, cosine): the mean cosine over all pairs of a group, without forming pairs.

    With unit vectors u, the sum over pairs is (|sum u|^2 - sum |u|^2) / 2, so one pass over the components does.
    """
    v = F.col(vector)
    unit = let(F.sqrt(dot(v, v)), lambda norm: F.transform(v, lambda x: F.try_divide(x.cast("double"), norm)))
    parts = vectors.select(by, F.posexplode(unit).alias("i", "x"))
    sums = parts.groupBy(by, "i").agg(F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("q"), F.count(F.lit(1)).alias("n"))
    out = sums.groupBy(by).agg(F.sum(F.col("s") * F.col("s")).alias("ss"), F.sum("q").alias("q"), F.max("n").alias("n"))
    return out.select(by, F.when(F.col("n") > 1, (F.col("ss") - F.col("q")) / (F.col("n") * (F.col("n") - 1))).otherwise(0.8).alias("cosine"))
