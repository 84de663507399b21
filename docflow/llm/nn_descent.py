"""Approximate nearest neighbours by inner product: an NN-descent graph built by Spark joins, greedy graph search.

Identical vectors are one node (their ids are attached at the end, the smallest that can matter), so copies cost nothing.
Neighbours are by inner product throughout, whatever the norms. Lists start in small groups of a few random projection
trees. A round of NN-descent joins each node with a sample of its neighbours, new ones first, and of the nodes that
list it; members of such a group are neighbours of neighbours, and pairs with a new edge compare. A node
hears only of nodes that it does not list (it carries a small bitmap of its list), so a tight cluster cannot fill what
a group may say. Rounds go on until fewer than ``SETTLED`` of all list places change.

A search starts with the query's own list and with entry points that all queries share, as many as there can be results
and more, so that no closed cluster leaves a query short; it expands the best unexpanded candidates of its beam until none
is left. The best candidates are scored again in double precision on the original vectors.

The path is the same at every size. Groups are bounded: lists by ``DEGREE``, listing nodes by ``SLOTS`` (one for each
hash slot, combined before the shuffle), leaves by dealing them out in groups of about ``GROUP``. Queries that meet at
a node are dealt out in parts of ``CROWD``, each with its own copy of the node's adjacency. Vectors travel as half floats
with a power of two each, taken from the largest vector's (below 2^-100 of it as 2^-100), so any finite doubles
can be compared. Split planes come from a bounded sample (``SAMPLE``); every vector is indexed.

Defined results: vectors that are null, zero, of another length than the first valid one (by id), or hold null or
non-finite components take no part; rows without id neither; repeated rows count once; queries have all candidates
if there are fewer than ``k``; a score beyond the range of doubles is infinite with the sign of the true one, or zero;
an empty table gives an empty result; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import forget, stored

#: Neighbours of a node; how many of them, and of those that list it, meet in a round; nodes of a first group.
DEGREE, MEETING, SLOTS, GROUP, TREES, DEPTH = 40, 16, 12, 64, 4, 10
#: Share of list places that may still change when the graph is done.
SETTLED = 0.1
#: Candidates of a search, how many of them expand at once, entry points of either kind, candidates scored in double precision.
BEAM, WIDTH, ENTRIES, EXACT = 224, 64, 40, 80
#: Queries that one copy of a node's adjacency serves; hot nodes up to this number (some 12 bytes each) are broadcast.
CROWD, BROADCAST_HOT = 4096, 500_000
SAMPLE, SEED, BITS, LOWEST = 20_000, 11, 256, -100

FOUND = "node long, ids array<long>, sims array<float>"
GRAPH = "node long, ids array<long>, sims array<float>, fresh array<boolean>, vec binary, power int"
MEMBER = "at long, node long, fresh boolean, vec binary, power int, least float, listed binary"


# Columns and lists


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole groups of the first column, by which the rows are sorted."""
    rest: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        key = b.column(0).to_numpy()
        cut = int(np.searchsorted(key, key[-1], side="left"))
        if cut:
            yield pa.Table.from_batches([*rest, b.slice(0, cut)]).combine_chunks()
            rest = []
        elif rest and rest[-1].column(0)[-1].as_py() != key[-1]:
            yield pa.Table.from_batches(rest).combine_chunks()
            rest = []
        rest.append(b.slice(cut))
    if rest:
        yield pa.Table.from_batches(rest).combine_chunks()


def _whole(c: pa.Array | pa.ChunkedArray) -> pa.Array:
    c = c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c
    return c.chunk(0) if isinstance(c, pa.ChunkedArray) else c


def _np(t: pa.Table | pa.RecordBatch, name: str) -> np.ndarray:
    return _whole(t.column(name)).to_numpy(zero_copy_only=False)


def _lists(t: pa.Table | pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """(values, counts) of a list column; null lists are empty."""
    c = _whole(t.column(name))
    counts = np.nan_to_num(c.value_lengths().to_numpy(zero_copy_only=False).astype(float)).astype(np.int64)
    return c.flatten().to_numpy(zero_copy_only=False), counts


def _bytes(t: pa.Table | pa.RecordBatch, name: str) -> memoryview | bytes:
    """All bytes of a binary column, end to end."""
    c = _whole(t.column(name))
    _, cuts, data = c.buffers()
    if data is None:
        return b""
    ends = np.frombuffer(cuts, np.int32, len(c) + 1, 4 * c.offset)
    return memoryview(data)[ends[0] : ends[-1]]


def _vectors(t: pa.Table | pa.RecordBatch, size: int) -> np.ndarray:
    """The vectors of a table as floats of the common scale."""
    raw = np.frombuffer(_bytes(t, "vec"), np.float16).reshape(-1, size)
    return np.ldexp(raw.astype(np.float32), _np(t, "power").astype(np.int32)[:, None])


def _bounds(key: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1, [len(key)]]) if len(key) else np.zeros(1, np.int64)


def _places(key: np.ndarray) -> np.ndarray:
    """The place of each row within its group of the sorted key."""
    cuts = _bounds(key)
    return np.arange(len(key)) - np.repeat(cuts[:-1], np.diff(cuts))


def _found(node: np.ndarray, other: np.ndarray, sim: np.ndarray) -> pa.RecordBatch:
    """FOUND rows from candidates, the ``BEAM`` best different ones for each node."""
    node, other, sim, _ = _best(node, other, sim, np.zeros(len(node), bool), BEAM)
    cuts = _bounds(node)
    lists = [pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(v, k)) for v, k in ((other, pa.int64()), (sim, pa.float32()))]
    return pa.RecordBatch.from_arrays([pa.array(node[cuts[:-1]], pa.int64()), *lists], names=["node", "ids", "sims"])


def _best(owner: np.ndarray, ids: np.ndarray, sims: np.ndarray, mark: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` best different ids of each owner, best first; of equal ids one that is marked, if any."""
    order = np.lexsort((~mark, ids, owner))
    owner, ids, sims, mark = owner[order], ids[order], sims[order], mark[order]
    new = np.ones(len(ids), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (ids[1:] != ids[:-1])
    owner, ids, sims, mark = owner[new], ids[new], sims[new], mark[new]
    order = np.lexsort((ids, -sims, owner))
    top = order[_places(owner[order]) < k]
    return owner[top], ids[top], sims[top], mark[top]


def _list_columns(owner: np.ndarray, n: int, *values: tuple[np.ndarray, pa.DataType]) -> list[pa.Array]:
    """List columns of ``n`` rows from values sorted by owner row."""
    cuts = pa.array(np.searchsorted(owner, np.arange(n + 1)), pa.int32())
    return [pa.ListArray.from_arrays(cuts, pa.array(v, k)) for v, k in values]


def _by(df: DataFrame, *keys: str) -> DataFrame:
    return df.repartition(keys[0]).sortWithinPartitions(*keys)


# The graph


def _slot(ids: np.ndarray, seed: int) -> np.ndarray:
    """A number of 16 bits from each id."""
    x = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(2 * seed + 1)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(48)).astype(np.int64)


def _bitmaps(ids: np.ndarray, counts: np.ndarray, seed: int) -> list[bytes]:
    """A bitmap of ``BITS`` for each list."""
    on = np.zeros((len(counts), BITS), bool)
    on[np.repeat(np.arange(len(counts)), counts), _slot(ids, seed) % BITS] = True
    return [r.tobytes() for r in np.packbits(on, axis=1, bitorder="little")]


def _meeting(fresh: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Which entries of the lists meet in a round: the first ``MEETING``, new ones before old; none if all are old."""
    owner = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((np.arange(len(owner)), ~fresh, owner))
    chosen = np.zeros(len(owner), bool)
    chosen[order[_places(owner[order]) < MEETING]] = True
    any_new = np.zeros(len(counts), bool)
    any_new[owner[fresh]] = True
    return chosen & any_new[owner]


def _compare(rows: Iterator[pa.RecordBatch], size: int, seed: int) -> Iterator[pa.RecordBatch]:
    """MEMBER rows by ``at``: pairs of a group with a new member compare; each learns of better nodes that it does not list."""
    for t in runs(rows):
        at, node, fresh, least = _np(t, "at"), _np(t, "node"), _np(t, "fresh").astype(bool), _np(t, "least")
        listed = np.unpackbits(np.frombuffer(_bytes(t, "listed"), np.uint8).reshape(-1, BITS // 8), axis=1, bitorder="little").astype(bool)
        x, slot, cuts = _vectors(t, size), _slot(node, seed) % BITS, _bounds(at)
        widths, first, out = np.diff(cuts), 0, []
        while first < len(widths):
            # Groups of like size are worked together, padded to the widest.
            wide = np.maximum.accumulate(widths[first:])
            many = max(1, int(np.searchsorted(wide * wide * np.arange(1, len(wide) + 1), 2_000_000, side="right")))
            a, b, m = cuts[first], cuts[first + many], int(wide[many - 1])
            group, place = np.repeat(np.arange(many), widths[first : first + many]), _places(at[a:b])
            row = np.full((many, m), -1)
            row[group, place] = np.arange(a, b)
            y = np.zeros((many, m, size), np.float32)
            y[group, place] = x[a:b]
            g = y @ y.transpose(0, 2, 1)
            on, new = row >= 0, np.where(row >= 0, fresh[row], False)
            low = np.where(on, least[row], np.inf)
            k, i, j = np.nonzero((g > low[:, :, None]) & on[:, None, :] & (new[:, :, None] | new[:, None, :]))
            p, q = row[k, i], row[k, j]
            ok = (node[p] != node[q]) & ~listed[p, slot[q]]
            out.append((node[p[ok]], node[q[ok]], g[k[ok], i[ok], j[ok]]))
            first += many
        if sum(len(o[0]) for o in out):
            yield _found(*(np.concatenate(v) for v in zip(*out, strict=True)))


def _merge(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole groups of (node, ids, sims, old, vec, power), one row of each node with its vector, to GRAPH rows."""
    for t in runs(rows):
        nodes, at = np.unique(_np(t, "node"), return_inverse=True)
        ids, counts = _lists(t, "ids")
        sims, _ = _lists(t, "sims")
        own = _whole(t.column("vec").is_valid()).to_numpy(zero_copy_only=False)
        old = np.zeros(len(ids), bool)
        flags, _ = _lists(t, "old")
        old[np.repeat(own, counts)] = flags.astype(bool)
        owner, ids, sims, old = _best(np.repeat(at, counts), ids, sims, old, DEGREE)
        kept = t.filter(pa.array(own))
        kept = kept.take(np.argsort(_np(kept, "node"), kind="stable"))
        lists = _list_columns(owner, len(nodes), (ids, pa.int64()), (sims, pa.float32()), (~old, pa.bool_()))
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), *lists, *(_whole(kept.column(c)) for c in ("vec", "power"))], names=["node", "ids", "sims", "fresh", "vec", "power"])


def _merged(state: DataFrame, found: DataFrame) -> DataFrame:
    rows = state.unionByName(found, allowMissingColumns=True).select("node", "ids", "sims", "old", "vec", "power")
    return stored(_by(rows, "node").mapInArrow(_merge, GRAPH), "graph")


def _met(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(at, node, fresh) of the neighbours that meet at each node."""
    for b in rows:
        ids, counts = _lists(b, "ids")
        fresh = _lists(b, "fresh")[0].astype(bool)
        pick = _meeting(fresh, counts)
        at = np.repeat(_np(b, "node"), counts)[pick]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(ids[pick], pa.int64()), pa.array(fresh[pick])], names=["at", "node", "fresh"])


def _carried(rows: Iterator[pa.RecordBatch], seed: int) -> Iterator[pa.RecordBatch]:
    """What travels of each node: vector, least similarity that would help it, bitmap of its list."""
    for b in rows:
        ids, counts = _lists(b, "ids")
        sims, _ = _lists(b, "sims")
        ends = np.cumsum(counts)
        least = np.where(counts >= DEGREE, sims[np.maximum(ends - 1, 0)] if len(sims) else -np.inf, -np.inf).astype(np.float32)
        yield pa.RecordBatch.from_arrays([b.column("node"), b.column("vec"), b.column("power"), pa.array(least), pa.array(_bitmaps(ids, counts, seed), pa.binary())], names=["node", "vec", "power", "least", "listed"])


def _after(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The graph's rows with what has met marked as old."""
    for b in rows:
        _, counts = _lists(b, "ids")
        fresh = _lists(b, "fresh")[0].astype(bool)
        old = ~fresh | _meeting(fresh, counts)
        marked = _list_columns(np.repeat(np.arange(b.num_rows), counts), b.num_rows, (old, pa.bool_()))
        yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("node", "ids", "sims")), *marked, b.column("vec"), b.column("power")], names=["node", "ids", "sims", "old", "vec", "power"])


def split_planes(sample: np.ndarray, leaves: int, rng: np.random.Generator) -> list[tuple[np.ndarray, np.ndarray]]:
    """A projection tree as levels of (direction of each node, median of each node), over a sample."""
    levels, at = [], np.zeros(len(sample), np.int64)
    for depth in range(max(0, int(np.ceil(np.log2(max(leaves, 1)))))):
        planes = rng.standard_normal((1 << depth, sample.shape[1])).astype(np.float32)
        side = np.einsum("ij,ij->i", sample, planes[at])
        cut = np.array([np.median(side[at == i]) if (at == i).any() else 0.0 for i in range(1 << depth)], np.float32)
        levels.append((planes, cut))
        at = 2 * at + (side >= cut[at])
    return levels


def _leaves(rows: Iterator[pa.RecordBatch], trees: list, size: int) -> Iterator[pa.RecordBatch]:
    for b in rows:
        x = _vectors(b, size)
        for number, levels in enumerate(trees):
            at = np.zeros(len(x), np.int64)
            for planes, cut in levels:
                at = 2 * at + (np.einsum("ij,ij->i", x, planes[at]) >= cut[at])
            yield pa.RecordBatch.from_arrays([pa.array(at + (number << 40), pa.int64()), b.column("node")], names=["leaf", "node"])


def _first_groups(nodes: DataFrame, n: int, size: int) -> DataFrame:
    """(at, node): groups of about ``GROUP`` nodes of one leaf, for each tree."""
    share = min(1.0, SAMPLE / max(n, 1))
    drawn = nodes.where(F.pmod(F.xxhash64("node", F.lit(SEED)), F.lit(1_000_000)) < int(1_000_000 * share) + 1).select("vec", "power").toArrow()
    rng = np.random.default_rng(SEED)
    sample = _vectors(drawn, size) if drawn.num_rows else np.zeros((1, size), np.float32)
    depth = min(DEPTH, max(0, int(np.ceil(np.log2(max(n / GROUP, 1))))))
    trees = [split_planes(sample, 1 << depth, rng) for _ in range(TREES)]
    leaves = stored(nodes.select("node", "vec", "power").mapInArrow(lambda b: _leaves(b, trees, size), "leaf long, node long"), "leaves")
    loads = leaves.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / GROUP).alias("parts"))  # TREES << DEPTH rows at most
    part = F.pmod(F.xxhash64("node", "leaf"), F.col("parts"))
    return leaves.join(F.broadcast(loads), "leaf").select(F.xxhash64("leaf", part).alias("at"), "node")


def build_graph(nodes: DataFrame, size: int) -> DataFrame:
    """The neighbour graph of (node, vec, power) rows as GRAPH rows, stored."""
    n = nodes.count()
    empty = nodes.select("node", F.array().cast("array<long>").alias("ids"), F.array().cast("array<float>").alias("sims"), F.array().cast("array<boolean>").alias("old"), "vec", "power")
    met, seed = _first_groups(nodes, n, size).withColumn("fresh", F.lit(True)), 0
    graph, state, carried = None, empty, nodes.withColumns({"least": F.lit(float("-inf")).cast("float"), "listed": F.lit(bytes(BITS // 8))})
    while True:
        sent = met.join(carried, "node").select("at", "node", "fresh", "vec", "power", "least", "listed")
        found = _by(sent, "at").mapInArrow(lambda b, s=seed: _compare(b, size, s), FOUND)
        before, graph = graph, _merged(state, found)
        forget(before)
        fresh = graph.agg(F.sum(F.size(F.filter("fresh", lambda x: x)))).first()[0] or 0
        if fresh <= SETTLED * n * DEGREE:
            return graph
        seed += 1
        # Those that list a node meet there too: of the new ones, one for each hash slot.
        forward = stored(graph.select("node", "ids", "fresh").mapInArrow(_met, "at long, node long, fresh boolean"), "met")
        slot = F.pmod(F.xxhash64("at", F.lit(seed)), F.lit(SLOTS))
        back = forward.where("fresh").groupBy(F.col("node").alias("to"), slot.alias("slot")).agg(F.min("at").alias("node")).select(F.col("to").alias("at"), "node", F.lit(True).alias("fresh"))
        own = graph.select(F.col("node").alias("at"), "node", F.lit(False).alias("fresh"))
        met = forward.union(back).union(own)
        carried = graph.select("node", "ids", "sims", "vec", "power").mapInArrow(lambda b, s=seed: _carried(b, s), "node long, vec binary, power int, least float, listed binary")
        state = graph.mapInArrow(_after, "node long, ids array<long>, sims array<float>, old array<boolean>, vec binary, power int")


# The search


def _gather(rows: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Rows (node, other, vec, power), by node, to one row of each node with its neighbours' vectors."""
    for t in runs(rows):
        node = _np(t, "node")
        cuts = _bounds(node)
        raw, width = bytes(_bytes(t, "vec")), 2 * size
        lists = [pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(_np(t, c), k)) for c, k in (("other", pa.int64()), ("power", pa.int32()))]
        vecs = pa.array([raw[a * width : b * width] for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(node[cuts[:-1]], pa.int64()), lists[0], vecs, lists[1]], names=["node", "ids", "vec", "powers"])


def _visit(rows: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Rows (key, query, vec, power, least, ids, powers), by key, the node's own row (query null) first; queries score its neighbours."""
    held: tuple | None = None
    for b in rows:
        key, asked = _np(b, "key"), b.column("query").is_valid().to_numpy(zero_copy_only=False)
        query, cuts, out = b.column("query").to_pylist(), _bounds(key), []
        for a, e in zip(cuts[:-1], cuts[1:], strict=True):
            if not asked[a]:
                ids = np.array(b.column("ids")[a].as_py(), np.int64)
                x = np.frombuffer(b.column("vec")[a].as_py(), np.float16).reshape(-1, size).astype(np.float32)
                held, a = (key[a], ids, np.ldexp(x, np.array(b.column("powers")[a].as_py(), np.int32)[:, None])), a + 1
            if a == e or held is None or held[0] != key[a]:
                continue
            part = b.slice(a, e - a)
            g = _vectors(part, size) @ held[2].T
            i, j = np.nonzero(g > _np(part, "least")[:, None])
            out.append((np.array(query[a:e], np.int64)[i], held[1][j], g[i, j]))
        if sum(len(o[0]) for o in out):
            yield _found(*(np.concatenate(v) for v in zip(*out, strict=True)))


BEAMS = "node long, ids array<long>, sims array<float>, done array<boolean>, next array<boolean>, vec binary, power int"


def _beams(nodes: pa.Array, n: int, owner: np.ndarray, ids: np.ndarray, sims: np.ndarray, done: np.ndarray, *more: pa.Array) -> pa.RecordBatch:
    """BEAMS rows from lists that are sorted, best first; the first ``WIDTH`` unexpanded candidates of each are next, and count as done from now on."""
    cuts = np.searchsorted(owner, np.arange(n))
    running = np.cumsum(~done)
    before = np.concatenate([[0], running])[cuts]
    ahead = ~done & (running - before[owner] <= WIDTH)
    lists = _list_columns(owner, n, (ids, pa.int64()), (sims, pa.float32()), (done | ahead, pa.bool_()), (ahead, pa.bool_()))
    return pa.RecordBatch.from_arrays([nodes, *lists, *more], names=["node", "ids", "sims", "done", "next", "vec", "power"])


def _settle(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole groups of beam rows and FOUND rows to one beam each."""
    for t in runs(rows):
        nodes, at = np.unique(_np(t, "node"), return_inverse=True)
        ids, counts = _lists(t, "ids")
        sims, _ = _lists(t, "sims")
        own = _whole(t.column("vec").is_valid()).to_numpy(zero_copy_only=False)
        done = np.zeros(len(ids), bool)
        done[np.repeat(own, counts)] = _lists(t, "done")[0].astype(bool)
        owner, ids, sims, done = _best(np.repeat(at, counts), ids, sims, done, BEAM)
        kept = t.filter(pa.array(own))
        kept = kept.take(np.argsort(_np(kept, "node"), kind="stable"))
        yield _beams(pa.array(nodes, pa.int64()), len(nodes), owner, ids, sims, done, *(_whole(kept.column(c)) for c in ("vec", "power")))


def _asked(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each beam's next candidates as messages to them."""
    for b in rows:
        ids, counts = _lists(b, "ids")
        sims, _ = _lists(b, "sims")
        pick = _lists(b, "next")[0].astype(bool)
        ends = np.cumsum(counts)
        least = np.where(counts >= BEAM, sims[np.maximum(ends - 1, 0)] if len(sims) else -np.inf, -np.inf).astype(np.float32)
        row = pa.array(np.repeat(np.arange(b.num_rows), counts)[pick])
        sent = [c.take(row) for c in (b.column("node"), b.column("vec"), b.column("power"), pa.array(least))]
        yield pa.RecordBatch.from_arrays([pa.array(ids[pick], pa.int64()), *sent], names=["node", "query", "vec", "power", "least"])


def _entries(rows: Iterator[pa.RecordBatch], size: int, ids: np.ndarray, x: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The first beams: a node's own list, itself, and the entry points, with their similarities."""
    for b in rows:
        found, counts = _lists(b, "ids")
        sims, _ = _lists(b, "sims")
        v, node, n = _vectors(b, size), _np(b, "node"), b.num_rows
        owner = np.concatenate([np.repeat(np.arange(n), counts), np.arange(n), np.repeat(np.arange(n), len(ids))])
        every = np.concatenate([found, node, np.tile(ids, n)])
        value = np.concatenate([sims, (v * v).sum(1), (v @ x.T).ravel()]).astype(np.float32)
        owner, every, value, done = _best(owner, every, value, np.zeros(len(owner), bool), BEAM)
        yield _beams(b.column("node"), n, owner, every, value, done, b.column("vec"), b.column("power"))


def _parts(asked: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``asked`` with the part of each message at its node, and the nodes that more than ``CROWD`` queries visit."""
    loads = asked.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CROWD)
    hot = stored(loads.select("node", F.ceil(F.col("n") / CROWD).cast("int").alias("parts")), "hot")
    few = hot.count()
    if not few:
        return asked.withColumn("part", F.lit(0)), None
    hot = F.broadcast(hot) if few <= BROADCAST_HOT else hot.hint("merge")
    return asked.join(hot, "node", "left").withColumn("part", F.pmod(F.xxhash64("query"), F.coalesce("parts", F.lit(1))).cast("int")).drop("parts"), hot


def search(graph: DataFrame, queries: DataFrame, size: int) -> DataFrame:
    """(node, ids, sims): the beam of each query (one column, node) when none of its candidates is unexpanded."""
    links = graph.select("node", F.explode("ids").alias("other"))
    slot = F.pmod(F.xxhash64("node", F.lit(SEED)), F.lit(SLOTS))
    back = links.groupBy(F.col("other").alias("to"), slot.alias("slot")).agg(F.min("node").alias("by")).select(F.col("to").alias("node"), F.col("by").alias("other"))
    vectors = graph.select(F.col("node").alias("other"), "vec", "power")
    near = links.union(back).distinct().join(vectors, "other").select("node", "other", "vec", "power")
    near = stored(_by(near, "node").mapInArrow(lambda b: _gather(b, size), "node long, ids array<long>, vec binary, powers array<int>"), "adjacent")
    points = graph.select("node", "vec", "power")
    start = points.orderBy("node").limit(ENTRIES).union(points.orderBy(F.xxhash64("node", F.lit(SEED)), "node").limit(ENTRIES)).toArrow()
    ids, x = (_np(start, "node"), _vectors(start, size)) if start.num_rows else (np.empty(0, np.int64), np.empty((0, size), np.float32))
    own = graph.join(queries, "node", "left_semi").select("node", "ids", "sims", "vec", "power")
    beams = stored(own.mapInArrow(lambda b: _entries(b, size, ids, x), BEAMS), "beams")
    while True:
        asked = stored(beams.mapInArrow(_asked, "node long, query long, vec binary, power int, least float"), "asked")
        if asked.isEmpty():
            return beams.select("node", "ids", "sims")
        asked, hot = _parts(asked)
        posts = near.join(asked.select("node").distinct(), "node", "left_semi")
        copies = posts.withColumn("part", F.lit(0)) if hot is None else posts.join(hot, "node", "left").withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))).drop("parts")
        rows = asked.unionByName(copies, allowMissingColumns=True)
        key = F.when(F.col("part") == 0, F.col("node")).otherwise(F.xxhash64("node", "part"))
        rows = rows.select(key.alias("key"), "query", "vec", "power", "least", "ids", "powers")
        found = rows.repartition("key").sortWithinPartitions("key", F.col("query").asc_nulls_first()).mapInArrow(lambda b: _visit(b, size), FOUND)
        both = beams.drop("next").unionByName(found, allowMissingColumns=True)
        before, beams = beams, stored(_by(both, "node").mapInArrow(_settle, BEAMS), "beams")
        forget(before)


# The operator


def _packed(rows: Iterator[pa.RecordBatch], size: int, top: int) -> Iterator[pa.RecordBatch]:
    """Half floats between -1 and 1 of each vector, and its power of two below the largest one's."""
    for t in rows:
        x = t.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
        power = np.frexp(np.abs(x).max(1))[1]
        vec = _scaled(x, -power).astype(np.float16)
        yield pa.RecordBatch.from_arrays([t.column("node"), pa.array([r.tobytes() for r in vec], pa.binary()), pa.array(np.maximum(power - top, LOWEST), pa.int32())], names=["node", "vec", "power"])


def _scaled(x: np.ndarray, power: np.ndarray) -> np.ndarray:
    """x times two to the power, in two steps so that no power is out of range."""
    half = power // 2
    return np.ldexp(np.ldexp(x, half[:, None]), (power - half)[:, None])


def _exact(rows: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Inner products in double precision; scaling by powers of two keeps them from overflowing halfway."""
    for t in rows:
        a, b = (t.column(c).flatten().to_numpy(zero_copy_only=False).reshape(-1, size) for c in ("a", "b"))
        p, q = (np.frexp(np.abs(x).max(1))[1] for x in (a, b))
        dots = (_scaled(a, -p) * _scaled(b, -q)).sum(1)
        with np.errstate(over="ignore"):
            score = _scaled(dots[:, None], p + q)[:, 0]
        yield pa.RecordBatch.from_arrays([t.column("node"), t.column("other"), pa.array(score + 0.0, pa.float64())], names=["node", "other", "score"])


def nearest(df: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for every id that ``is_query`` (of a column) holds for, its ``k`` nearest others."""
    if k >= ENTRIES:
        raise ValueError(f"k must be below {ENTRIES}")
    spark = df.sparkSession
    kind = "query_id long, rank int, vec_id long, score double"
    v = F.col("v")
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    valid = rows.where("id is not null and v is not null").where(~bad & F.exists(v, lambda x: x != 0))
    first = valid.agg(F.min_by(F.size("v"), "id")).first()
    if first[0] is None:
        return spark.createDataFrame([], kind)
    size = int(first[0])
    valid = stored(valid.where(F.size("v") == size).distinct(), "vectors")
    top = int(np.frexp(valid.agg(F.max(F.array_max(F.transform(v, F.abs)))).first()[0])[1])
    classes = stored(valid.groupBy("v").agg(F.min("id").alias("node")), "classes")
    members = stored(valid.join(classes.hint("merge"), "v").select("id", "node"), "members")
    nodes = stored(classes.select("node", "v").mapInArrow(lambda b: _packed(b, size, top), "node long, vec binary, power int"), "nodes")
    graph = build_graph(nodes, size)
    asking = members.where(is_query(F.col("id")))
    found = search(graph, asking.select("node").distinct(), size)
    pairs = found.select("node", F.explode(F.array_union(F.slice("ids", 1, EXACT), F.array("node"))).alias("other")).distinct()
    # Exact scores: each pair meets both original vectors.
    left = pairs.join(classes.select(F.col("node").alias("other"), F.col("v").alias("b")), "other")
    both = left.join(classes.select("node", F.col("v").alias("a")), "node").select("node", "other", "a", "b")
    scored = both.mapInArrow(lambda b: _exact(b, size), "node long, other long, score double")
    few = members.withColumn("n", F.expr("row_number() over (partition by node order by id)")).where(F.col("n") <= k + 1).groupBy("node").agg(F.collect_list("id").alias("ids"))
    wide = scored.join(few.withColumnRenamed("node", "other"), "other").select("node", "score", F.explode("ids").alias("id"))
    best = wide.withColumn("n", F.expr("row_number() over (partition by node order by score desc, id)")).where(F.col("n") <= k + 1)
    lists = stored(best.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("n", "id", "score"))).alias("best")), "best")
    mine = asking.join(lists.hint("merge"), "node")
    others = F.slice(F.filter("best", lambda x: x["id"] != F.col("id")), 1, k)
    return mine.select(F.col("id").alias("query_id"), F.posexplode(others).alias("p", "x")).select("query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"), F.col("x.score").alias("score"))


def query(df: DataFrame) -> DataFrame:
    """The contract's columns: queries are the ids divisible by 20."""
    return nearest(df, lambda i: i % 20 == 0)
