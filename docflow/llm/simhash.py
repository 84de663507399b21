"""SimHash near-duplicates: a segment-popcount embedding, a grid join under Manhattan distance, exact verification.

A 64-bit fingerprint maps to the number of set bits in each of its 32 two-bit segments. The Manhattan distance of
two such vectors is at most the number of differing bits, so fingerprints that link at ``radius`` bits are at
most ``radius`` apart on the grid. The grid's dimensions are cut into groups; ``radius`` units of distance leave
all but ``radius`` groups equal, so linked fingerprints share the cell of at least one choice of equal groups.
Counts are written in unary (00, 01, 11), which makes Manhattan distance a population count of an exclusive or
and a cell a masked 64-bit number.

Only distinct fingerprints enter the grid, so exact copies, however many, cost one row. Cells with many
fingerprints are dealt out as pairs of blocks; a task emits a spanning forest of its cell's links, never all
pairs. Components come from alternating star steps over those links.

Defined results: null and blank texts have fingerprint zero, linked like any other; repeated rows share
fingerprint and component; a null id takes part, but a component's id is its smallest id that is not null (null
if there is none); texts of any length are read whole; an empty table gives an empty result; other columns,
whatever their names, do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import stored
from docflow.llm.components import connected_components

SHINGLE, SEED, RADIUS = 3, 42, 3
SEGMENTS, LOW = 32, 0x5555555555555555
#: Fingerprints of a cell that one task compares at once; larger cells are dealt out as pairs of blocks.
BLOCK = 4096
#: Groups are added until a cell would hold this many unrelated fingerprints at most.
CROWD = 8


def fingerprint(text: str | None) -> int:
    """The unsigned fingerprint of one text."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    line, width = b" ".join(words), min(SHINGLE, len(words))
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts, ends = (ends - sizes)[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()
    digest, counts, n = xxhash.xxh64_intdigest, np.zeros(64, np.int64), len(starts)
    for at in range(0, n, 1 << 15):
        h = np.array([digest(line[s:e], SEED) for s, e in zip(starts[at : at + (1 << 15)], ends[at : at + (1 << 15)], strict=True)], "<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, h, fp): each row's id, a hash of its text, and the fingerprint of its whole text as a signed long."""
    own = df.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(f"`{text_col}`").alias("h"), F.col(f"`{text_col}`").alias("t"))

    def work(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows:
            fp = np.array([fingerprint(x.as_py()) for x in b.column(2)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp, pa.int64())], names=["id", "h", "fp"])

    return own.mapInArrow(work, f"id {own.schema['id'].dataType.simpleString()}, h long, fp long")


def unary(fp: Column) -> Column:
    """The segments' counts in unary, in place: the grid point as a long."""
    up = F.shiftrightunsigned(fp, 1)
    low = fp.bitwiseOR(up).bitwiseAND(F.lit(LOW))
    high = fp.bitwiseAND(up).bitwiseAND(F.lit(LOW))
    return low.bitwiseOR(F.shiftleft(high, 1))


def cell_masks(groups: int, radius: int = RADIUS) -> list[int]:
    """Signed masks of the segments in each choice of ``groups - radius`` groups."""
    edges = [round(i * SEGMENTS / groups) for i in range(groups + 1)]
    bits = [sum(3 << 2 * s for s in range(a, b)) for a, b in zip(edges, edges[1:], strict=False)]
    masks = [sum(c) for c in combinations(bits, groups - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def groups_for(n: int, radius: int = RADIUS) -> int:
    """The fewest groups with few unrelated fingerprints in a cell; any number finds every link."""
    for groups in range(radius + 1, SEGMENTS // 2):
        if n * 0.375 ** (SEGMENTS * (groups - radius) / groups) <= CROWD:
            break
    return groups


def forest(fp: np.ndarray, grid: np.ndarray, radius: int = RADIUS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(root, member) links that connect what links within one group of distinct fingerprints."""
    left = np.arange(len(fp))
    while len(left) > 1:
        root, queue, left = left[0], [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = np.bitwise_count(grid[left] ^ grid[at]) <= radius  # the lower bound
            near[near] = np.bitwise_count(fp[left[near]] ^ fp[at]) <= radius
            if near.any():
                found = left[near]
                yield np.full(len(found), fp[root]), fp[found]
                queue.extend(found.tolist())
                left = left[~near]


def _links(rows: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Rows (key, fp, grid) come sorted by key; a key may go on in the next batch."""
    rest = (np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64))

    def out(key, fp, grid):
        cuts = np.flatnonzero(np.diff(key)) + 1
        bounds = np.concatenate([[0], cuts, [len(key)]])
        pairs = [p for a, b in zip(bounds[:-1], bounds[1:], strict=True) if b - a > 1 for p in forest(fp[a:b], grid[a:b], radius)]
        if pairs:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([p[i] for p in pairs]).view(np.int64)) for i in (0, 1)], names=["a", "b"])

    for b in rows:
        got = [b.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
        key, fp, grid = (np.concatenate([r, g.view(r.dtype)]) for r, g in zip(rest, got, strict=True))
        if not len(key):
            continue
        last = np.searchsorted(key, key[-1]) if key[0] <= key[-1] else 0
        yield from out(key[:last], fp[:last], grid[:last])
        rest = (key[last:], fp[last:], grid[last:])
    yield from out(*rest)


def links(prints: DataFrame, radius: int = RADIUS, groups: int | None = None) -> DataFrame:
    """(a, b): links between distinct fingerprints ``prints.fp`` that connect everything within ``radius`` bits."""
    groups = groups or groups_for(prints.count(), radius)
    cells = prints.select("fp", unary(F.col("fp")).alias("grid")).select(
        "fp", "grid", F.explode(F.array(*(F.xxhash64(F.lit(i), F.col("grid").bitwiseAND(F.lit(m))) for i, m in enumerate(cell_masks(groups, radius))))).alias("cell")
    )
    crowds = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = cells.join(crowds, "cell").withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    block = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("blocks")).cast("int")
    other = F.when(F.col("blocks") > 1, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(F.lit(0)))
    dealt = met.withColumn("block", block).withColumn("other", F.explode(other))
    key = F.xxhash64("cell", F.least("block", "other"), F.greatest("block", "other"))
    keyed = dealt.select(key.alias("key"), "fp", "grid").repartition("key").sortWithinPartitions("key")
    return keyed.mapInArrow(lambda rows: _links(rows, radius), "a long, b long")


def _classified(df: DataFrame, text_col: str, id_col: str, radius: int) -> tuple[DataFrame, DataFrame]:
    """The rows' fingerprints, and for each distinct one its component's root fingerprint and smallest id."""
    prints = stored(fingerprints(df, text_col, id_col), "prints")
    classes = stored(prints.groupBy("fp").agg(F.min("id").alias("rep")), "classes")
    roots = connected_components(links(classes, radius), "a", "b")
    rooted = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "rep", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("rep").alias("component"))
    return prints, rooted.join(smallest, "root").select("fp", "root", "component")


def near_duplicates(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", radius: int = RADIUS) -> DataFrame:
    """(id, fp, component) for every row: its fingerprint and the smallest id reachable over links, itself included."""
    prints, classes = _classified(df, text_col, id_col, radius)
    return prints.join(classes.hint("merge"), "fp").select("id", "fp", "component")


def drop_near_duplicates(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", radius: int = RADIUS) -> DataFrame:
    """The rows of ``df``, one of each component: that with the smallest id; of rows that share it, one with the least text hash."""
    prints, classes = _classified(df, text_col, id_col, radius)
    return keep_one(df, prints, classes, text_col, id_col)


def drop_similar(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", width: int = 5, similarity: float = 0.8) -> DataFrame:
    """As ``drop_near_duplicates``, with components of texts whose shingle sets have at least this similarity.

    The fingerprints are wide ones, in which no such text is missed; see ``shingle_sets``.
    """
    from docflow.llm import shingle_sets

    return shingle_sets.drop_near_copies(df, text_col, id_col, width, similarity)


def keep_one(df: DataFrame, prints: DataFrame, classes: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """The rows of ``df``, one of each root: ``prints`` has (id, h, fp) of every row, ``classes`` the root of each fp."""
    least = F.min(F.struct(F.col("id").isNull().alias("no"), "id", "h"))
    winners = prints.join(classes.hint("merge"), "fp").groupBy("root").agg(least.alias("w")).select(F.col("w.id").alias("id"), F.col("w.h").alias("h")).distinct()
    row = F.struct(*(F.col(f"`{c}`") for c in df.columns))
    packed = df.select(F.col(f"`{id_col}`").alias("_id"), F.xxhash64(f"`{text_col}`").alias("_h"), row.alias("_row"))
    kept = packed.join(winners, packed["_id"].eqNullSafe(winners["id"]) & (packed["_h"] == winners["h"]), "left_semi")
    return kept.withColumn("_n", F.expr("row_number() over (partition by _id, _h order by _h)")).where("_n = 1").select("_row.*")


def query(df: DataFrame) -> DataFrame:
    """The contract's columns."""
    return near_duplicates(df).select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


__all__ = ["BLOCK", "cell_masks", "drop_near_duplicates", "drop_similar", "fingerprint", "fingerprints", "forest", "groups_for", "keep_one", "links", "near_duplicates", "query", "unary"]
