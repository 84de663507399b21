"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import stored


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))"), F.sum((F.xxhash64("b", "a") % 1_000_003).cast("long"))).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node hands its larger neighbours to the smallest node next to it."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return both.join(least.hint("merge"), "a").where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node hands its smaller neighbours, and itself, to the smallest of them. Edges have a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least.hint("merge"), "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(links: DataFrame, a: str, b: str, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of a link that is not its own root; root is the smallest node reachable.

    Each round shuffles the links once by node, combining before the shuffle; a node with very many links is
    split by adaptive execution, since both sides of the joins are plain exchanges. Rounds are written to the
    shared folder, so lineage stays short. Links with a null end do not count.
    """
    ends = (F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
    edges = stored(links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).select(*ends).distinct(), "links")
    before = _state(edges)
    for _ in range(rounds):
        if not before[0]:
            break
        edges = stored(_small_star(_large_star(edges)), "links")
        now = _state(edges)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
