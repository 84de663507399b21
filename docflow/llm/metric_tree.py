"""Exact top-k by inner product of whole-number vectors, over a paged M-tree.

Inner products become distances: with one more component, sqrt(M^2 - |v|^2) for candidates (M is the largest norm) and
0 for queries, the largest product is the smallest Euclidean distance, and the triangle inequality holds.

The tree has three levels. The root's routing objects are a bounded sample of the vectors (``PIVOTS``); every vector goes
to its nearest one. Such a cell is cut by hash into nodes of about ``NODE`` vectors, so a dense cell is many nodes and no
task holds more than one. A node's routing objects are some of its own vectors; the others go to the nearest, and the pages
under them hold at most ``PAGE`` entries, cut by distance from the routing object. Cells and pages store their covering
radius, pages and entries the distance to the routing object above them.

A search opens a query's cells in order of their lower bound (distance less radius): the nearest one, then the next ones,
then all whose bound the k-th best score so far admits (``ROUNDS``). Queries travel to nodes in rows, and many queries at a
node are dealt out in parts of ``CROWD``, each with its own copy of the node's pages. In a node, pages open in order of
their lower bound, each for the queries whose bound admits it. Stored distances to the object above exclude pages and
entries, by the triangle inequality, before any distance to them is computed. Bounds are widened by a margin beyond
rounding errors, so no result is lost; scores are exact.

Identical vectors are one entry with the smallest k + 1 of their ids. In data of high dimension without clusters the bounds
exclude little, and a search then compares the query set with all rows, in blocks.

Defined results: vectors that are null, hold null or non-finite components, have another length than the valid vector
of the smallest id, or a null id take no part; zero vectors do. Of rows that share an id the one with the least vector
counts. Components and scores beyond 64 bits become the nearest 64-bit number, in order too. A query has as many results as
there are other rows, if these are fewer than k; empty tables and a single vector have none. Other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docflow.llm.common import stored

SCALE, TOP, EVERY = 1024, 10, 100
#: The root's routing objects, at most, and their components in all, so that what every task gets is bounded.
PIVOTS, PIVOT_COMPONENTS = 4096, 1 << 20
#: Vectors for each routing object of the root, for each node and for each page.
CELL, NODE, PAGE = 4096, 4096, 64
#: Queries compared at once, and query rows for each copy of a node.
BLOCK, CROWD = 512, 4096
#: Cells of a query opened by the end of each round; all that its bound admits in the last.
ROUNDS = (1, 6, None)
#: Share of the norms by which bounds are widened.
MARGIN = 1e-6
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1
#: Below this, sums of products are exact in double precision.
_EXACT = float(1 << 53)

PAGES = "cell int, block int, route array<long>, parent double, radius double, vs array<long>, parents array<double>, ids array<array<long>>"
FOUND = "query_id long, found array<struct<score: long, id: long>>"


def scaled(df: DataFrame, id_col: str, vec_col: str, scale: int = SCALE) -> DataFrame:
    """(id, v): one row an id, v the components floor(scale * x) as longs; only vectors that take part."""
    x = F.transform(F.col(f"`{vec_col}`"), lambda c: c.cast("double"))
    own = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), x.alias("x")).where(F.col("id").isNotNull() & F.col("x").isNotNull())
    own = own.where(F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))))
    return own.select("id", F.transform("x", lambda c: F.floor(scale * c)).alias("v")).groupBy("id").agg(F.min("v").alias("v"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, dim)


def _norm2(v: np.ndarray) -> np.ndarray:
    x = v.astype(np.float64)
    return np.einsum("ij,ij->i", x, x)


@dataclass(frozen=True)
class Space:
    """What distances need: the length of vectors and the largest squared norm."""

    dim: int
    most2: float

    def distances(self, v: np.ndarray, w: np.ndarray, queries: bool = False) -> np.ndarray:
        """Between all of v and all of w, vectors of the tree; ``queries``: v are queries."""
        a, b = v.astype(np.float64), w.astype(np.float64)
        a2, b2 = _norm2(v), _norm2(w)
        lift = lambda n2: np.sqrt(np.maximum(self.most2 - n2, 0))
        a_lift = np.zeros(len(a)) if queries else lift(a2)
        b_lift = lift(b2)
        d2 = (a2 + a_lift**2)[:, None] + (b2 + b_lift**2) - 2 * (a @ b.T + a_lift[:, None] * b_lift)
        return np.sqrt(np.maximum(d2, 0))

    def reach(self, v: np.ndarray, kth: np.ndarray) -> np.ndarray:
        """The distance within which queries have anything that scores ``kth`` or more, and the margin."""
        n2 = _norm2(v)
        r = np.sqrt(np.maximum(n2 + self.most2 - 2 * kth.astype(np.float64), 0)) + MARGIN * (np.sqrt(n2) + np.sqrt(self.most2))
        return np.where(kth == _LEAST, np.inf, r)

    def scores(self, v: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Exact inner products as 64-bit numbers."""
        largest = float(np.abs(v.astype(np.float64)).max(initial=0)) * float(np.abs(w.astype(np.float64)).max(initial=0)) * self.dim
        if largest < _EXACT:
            return (v.astype(np.float64) @ w.astype(np.float64).T).astype(np.int64)
        exact = v.astype(object) @ w.astype(object).T
        return np.clip(exact, _LEAST, _MOST).astype(np.int64).reshape(len(v), len(w))


@dataclass(frozen=True)
class Tree:
    """The pages as a table; the root's routing objects, their radii and how many nodes each cell has."""

    space: Space
    pages: DataFrame
    pivots: np.ndarray
    radii: np.ndarray
    blocks: np.ndarray


def _paged(v: np.ndarray, parents: np.ndarray, space: Space) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Routing object, members and their distances to it, page by page; parents are distances to the object above."""
    # Routing objects at even steps of the distance from the object above.
    routes = np.argsort(parents, kind="stable")[:: max(PAGE // 2, 1)]
    d = space.distances(v, v[routes])
    nearest = d.argmin(1)
    for r in range(len(routes)):
        own = np.flatnonzero(nearest == r)
        own = own[np.argsort(d[own, r], kind="stable")]
        for k in range(0, len(own), PAGE):
            yield routes[r], own[k : k + PAGE], d[own[k : k + PAGE], r]


def build(vectors: DataFrame, keep_ids: int = TOP + 1) -> Tree | None:
    """The tree over (id, v) rows of ``scaled``; None without vectors."""
    first = vectors.agg(F.min(F.struct("id", F.size("v").alias("dim"))).alias("m")).first()["m"]
    if first is None:
        return None
    dim = first["dim"]
    # Spark limits such a rank in each task before rows move, so copies of one vector bring few rows each.
    same = Window.partitionBy("h", "v").orderBy("id")
    ranked = vectors.where(F.size("v") == dim).withColumn("h", F.xxhash64("v")).withColumn("n", F.row_number().over(same)).where(F.col("n") <= keep_ids)
    entries = stored(ranked.groupBy("h", "v").agg(F.sort_array(F.collect_list("id")).alias("ids")), "entries")
    norm2 = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    count, most2 = entries.agg(F.count(F.lit(1)), F.max(norm2)).first()
    space = Space(dim, float(most2))
    chosen = min(PIVOTS, -(-count // CELL), max(1, PIVOT_COMPONENTS // max(dim, 1)))
    drawn = entries.select("v", F.xxhash64("v", F.lit(17)).alias("o")).orderBy("o", "v").limit(chosen).toArrow()
    pivots = np.array(drawn.column("v").to_pylist(), np.int64).reshape(-1, dim)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 1024):
                b = whole.slice(k, 1024)
                d = space.distances(_matrix(b.column(0), dim), pivots)
                cell = d.argmin(1)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell, pa.int32()), pa.array(d[np.arange(len(cell)), cell])], names=["v", "ids", "cell", "parent"])

    assigned = stored(entries.select("v", "ids").mapInArrow(assign, "v array<long>, ids array<long>, cell int, parent double"), "assigned")
    radii, blocks = np.zeros(len(pivots)), np.zeros(len(pivots), np.int64)
    for r in assigned.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("parent").alias("r")).collect():  # a row a pivot at most
        radii[r["cell"]], blocks[r["cell"]] = r["r"], -(-r["n"] // NODE)
    many = F.get(F.lit(blocks.tolist()), F.col("cell"))

    def load(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        v, parents, ids = _matrix(group.column("v").combine_chunks(), dim), group.column("parent").to_numpy(), group.column("ids").combine_chunks()
        out: dict[str, list] = {f.split(" ")[0]: [] for f in PAGES.split(", ")}
        for route, own, d in _paged(v, parents, space):
            row = (group.column("cell")[0].as_py(), group.column("block")[0].as_py(), v[route], float(parents[route]), float(d.max()), v[own].ravel(), d, ids.take(pa.array(own)))
            for name, value in zip(out, row, strict=True):
                out[name].append(value.tolist() if hasattr(value, "tolist") else value)
        kinds = [pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.float64(), pa.float64(), pa.list_(pa.int64()), pa.list_(pa.float64()), pa.list_(pa.list_(pa.int64()))]
        return pa.Table.from_arrays([pa.array(x, kind) for x, kind in zip(out.values(), kinds, strict=True)], names=list(out))

    nodes = assigned.withColumn("block", F.pmod(F.xxhash64("v", F.lit(29)), many).cast("int"))
    return Tree(space, stored(nodes.groupBy("cell", "block").applyInArrow(load, PAGES), "pages"), pivots, radii, blocks)


@dataclass
class Node:
    """One node's pages, as they arrive."""

    space: Space
    pivot: np.ndarray
    rows: list[dict] = field(default_factory=list)

    def add(self, batch: pa.RecordBatch) -> None:
        dim = self.space.dim
        col = {n: batch.column(n) for n in ("route", "parent", "radius", "vs", "parents", "ids")}
        for i in range(batch.num_rows):
            ids = col["ids"].slice(i, 1).flatten()
            own = {"ids": ids, "first": np.array([x[0].as_py() for x in ids], np.int64), "v": _matrix(col["vs"].slice(i, 1), dim), "parents": col["parents"].slice(i, 1).flatten().to_numpy()}
            self.rows.append(own | {"route": _matrix(col["route"].slice(i, 1), dim)[0], "parent": col["parent"][i].as_py(), "radius": col["radius"][i].as_py()})

    def best(self, ids: np.ndarray, q: np.ndarray, kth: np.ndarray, k: int) -> tuple[list[list[tuple[int, int]]], int]:
        """For each query its k best (score, id) pairs here that may count beside ``kth``, and the distances computed."""
        space, many = self.space, len(q)
        kth = kth.copy()
        reach = space.reach(q, kth)
        up = space.distances(q, self.pivot[None], True)[:, 0]
        parent, radius = (np.array([r[n] for r in self.rows]) for n in ("parent", "radius"))
        # Stored distances to the cell's routing object exclude pages before their own is compared.
        may = np.abs(up[:, None] - parent) - radius <= reach[:, None]
        asked = np.flatnonzero(may.any(0))
        to_route, least = np.zeros((many, len(self.rows))), np.full((many, len(self.rows)), np.inf)
        computed = may.sum()
        if len(asked):
            to_route[:, asked] = space.distances(q, np.stack([self.rows[p]["route"] for p in asked]), True)
            least[:, asked] = np.where(may[:, asked], np.maximum(to_route[:, asked] - radius[asked], 0), np.inf)
        # One entry more than results, as a query may find itself; the k + 1-th best bounds the k-th of the others.
        keep = k + 1
        score, first = np.full((many, keep), _LEAST), np.full((many, keep), _MOST)
        page, entry = np.full((many, keep), -1), np.zeros((many, keep), np.int64)
        for p in np.argsort(least.min(0, initial=np.inf), kind="stable"):
            rows = np.flatnonzero(least[:, p] <= reach)
            if not len(rows):
                continue
            own = self.rows[p]
            near = np.abs(to_route[rows, p][:, None] - own["parents"]) <= reach[rows][:, None]
            rows, near = rows[near.any(1)], near[near.any(1)]
            at = np.flatnonzero(near.any(0))
            if not len(at):
                continue
            computed += near.sum()
            s = space.scores(q[rows], own["v"][at])
            # A full list takes in only what beats or ties its last score.
            better = (s >= score[rows, -1][:, None]).any(1)
            rows, s = rows[better], s[better]
            if not len(rows):
                continue
            wide = np.broadcast_to
            all_score = np.hstack([score[rows], s])
            all_first = np.hstack([first[rows], wide(own["first"][at], s.shape)])
            all_page = np.hstack([page[rows], np.full(s.shape, p)])
            all_entry = np.hstack([entry[rows], wide(at, s.shape)])
            order = np.lexsort((all_first, ~all_score), axis=-1)[:, :keep]
            score[rows], first[rows], page[rows], entry[rows] = (np.take_along_axis(x, order, 1) for x in (all_score, all_first, all_page, all_entry))
            kth[rows] = np.maximum(kth[rows], score[rows, -1])
            reach[rows] = np.minimum(reach[rows], space.reach(q[rows], kth[rows]))
        out = []
        for i in range(many):
            pairs = [(int(score[i, j]), x) for j in range(keep) if page[i, j] >= 0 for x in self.rows[page[i, j]]["ids"][int(entry[i, j])].as_py() if x != ids[i]]
            out.append(sorted(pairs, key=lambda p: (-p[0], p[1]))[:k])
        return out, int(computed)


def _opened(tree_space: Space, pivots: np.ndarray, radii: np.ndarray, blocks: np.ndarray, after: int, to: int | None):
    """Of a batch (query_id, v, kth): query and cell, for cells that open in this round."""

    def cells(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        q, kth = _matrix(b.column("v"), tree_space.dim), b.column("kth").to_numpy()
        least = np.where(blocks > 0, np.maximum(tree_space.distances(q, pivots, True) - radii, 0), np.inf)
        order = np.argsort(least, axis=1, kind="stable")[:, after:to]
        row, at = np.nonzero(np.isfinite(np.take_along_axis(least, order, 1)) & (np.take_along_axis(least, order, 1) <= tree_space.reach(q, kth)[:, None]))
        return row, order[row, at]

    return cells


def search(tree: Tree, queries: DataFrame, k: int = TOP) -> DataFrame:
    """(query_id, found): the k best (score, id) pairs of every query row (id, v), best first, smaller ids first on ties.

    Results are right where the tree was built with ``keep_ids`` of k + 1 or more.
    """
    space, pivots, radii, blocks = tree.space, tree.pivots, tree.radii, tree.blocks
    asked = stored(queries.where(F.size("v") == space.dim).select(F.col("id").alias("query_id"), "v"), "queries")
    best = asked.select("query_id", F.array().cast("array<struct<score: long, id: long>>").alias("found"))
    opened = 0
    for to in ROUNDS:
        if opened >= len(pivots):
            break
        kth = F.when(F.size("found") == k, F.element_at("found", -1)["score"]).otherwise(F.lit(_LEAST)).alias("kth")
        now = asked.join(best, "query_id", "left").select("query_id", "v", F.coalesce(kth, F.lit(_LEAST)).alias("kth"))
        best = stored(_merged(_visited(tree, now, _opened(space, pivots, radii, blocks, opened, to), k).unionByName(best), k), "found")
        opened = to or len(pivots)
    return best


def _visited(tree: Tree, now: DataFrame, cells: Callable, k: int) -> DataFrame:
    """What the queries find in the nodes of the cells that they open."""
    space, pivots, blocks = tree.space, tree.pivots, tree.blocks

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(pivots), np.int64)
        for whole in batches:
            for i in range(0, whole.num_rows, BLOCK):
                n += np.bincount(cells(whole.slice(i, BLOCK))[1], minlength=len(pivots))
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(n), pa.int32()), pa.array(n[n > 0])], names=["cell", "n"])

    now = stored(now, "asked")
    parts = np.zeros(len(pivots), np.int64)
    for r in now.mapInArrow(counted, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():  # a row a pivot at most
        parts[r["cell"]] = -(-r["n"] // CROWD)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, BLOCK):
                b = whole.slice(i, BLOCK)
                row, cell = cells(b)
                row, cell, many = np.repeat(row, blocks[cell]), np.repeat(cell, blocks[cell]), blocks[cell]
                block = np.arange(len(cell)) - np.repeat(np.cumsum(many) - many, many)
                part = b.column("query_id").to_numpy()[row] // EVERY % np.maximum(parts[cell], 1)
                for j in range(0, len(row), 4096):
                    s = slice(j, j + 4096)
                    yield pa.RecordBatch.from_arrays([*(pa.array(x[s], pa.int32()) for x in (cell, block, part)), *b.take(pa.array(row[s])).columns], names=["cell", "block", "part", "query_id", "v", "kth"])

    copies = F.get(F.lit(parts.tolist()), F.col("cell"))
    pages = tree.pages.where(copies > 0).withColumn("part", F.explode(F.sequence(F.lit(0), (copies - 1).cast("int"))))
    visits = now.mapInArrow(dealt, "cell int, block int, part int, query_id long, v array<long>, kth long")
    rows = pages.withColumn("kind", F.lit(0)).unionByName(visits.withColumn("kind", F.lit(1)), allowMissingColumns=True)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, node = None, None
        for b in batches:
            keys = np.stack([b.column(n).to_numpy() for n in ("cell", "block", "part", "kind")], 1)
            cuts = np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1, [len(keys)]])
            for i, j in zip(cuts[:-1], cuts[1:], strict=True):
                own = b.slice(i, j - i)
                if j > i and at != tuple(keys[i, :3]):
                    at, node = tuple(keys[i, :3]), Node(space, pivots[keys[i, 0]])
                if j > i and keys[i, 3] == 0:
                    node.add(own)
                    continue
                for s in range(0, j - i, BLOCK):
                    q = own.slice(s, BLOCK)
                    ids = q.column("query_id").to_numpy()
                    found, _ = node.best(ids, _matrix(q.column("v"), space.dim), q.column("kth").to_numpy(), k)
                    told = pa.array([[{"score": x, "id": y} for x, y in f] for f in found], pa.list_(pa.struct([("score", pa.int64()), ("id", pa.int64())])))
                    yield pa.RecordBatch.from_arrays([pa.array(ids), told], names=["query_id", "found"])

    met = rows.repartition("cell", "block", "part").sortWithinPartitions("cell", "block", "part", "kind")
    return met.mapInArrow(work, FOUND)


def _merged(found: DataFrame, k: int) -> DataFrame:
    """Each query's k best of several lists; queries without any are left out."""
    order = Window.partitionBy("query_id").orderBy(F.desc("p.score"), "p.id")
    pairs = found.select("query_id", F.explode("found").alias("p")).withColumn("n", F.row_number().over(order)).where(F.col("n") <= k)
    lists = pairs.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("n", "p"))).alias("l"))
    return lists.select("query_id", F.transform("l", lambda x: x["p"]).alias("found"))


def nearest(df: DataFrame, is_query: Callable[[Column], Column], k: int = TOP, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products of the queries' vectors with all others."""
    vectors = stored(scaled(df, id_col, vec_col, scale), "vectors")
    tree = build(vectors, k + 1)
    if tree is None:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    best = search(tree, vectors.where(is_query(F.col("id"))), k)
    return best.select("query_id", F.posexplode("found").alias("rank", "p")).select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("p.id").alias("vec_id"), F.col("p.score").alias("score"))


def query(vectors: DataFrame) -> DataFrame:
    """The ten best of every row whose id is divisible by 100, among all rows."""
    return nearest(vectors, lambda i: F.pmod(i, F.lit(EVERY)) == 0)


#: DuckDB SQL for the query over ``embeddings``.
ORACLE = f"""
with x as (select vec_id, embedding::double[] as e from embeddings where vec_id is not null and embedding is not null),
v as (select vec_id, min(list_transform(e, lambda c: floor({SCALE} * c)::bigint)) as v from x
      where len(list_filter(e, lambda c: c is null or not isfinite(c))) = 0 group by vec_id),
d as (select vec_id, v from v where len(v) = (select len(v) from v order by vec_id limit 1)),
s as (select q.vec_id as query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::bigint as score
      from d q join d c on q.vec_id <> c.vec_id where q.vec_id % {EVERY} = 0),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from s)
select query_id, rank, vec_id, score from r where rank <= {TOP}
"""
