"""Archives and near-duplicates against brute force."""

import base64
import hashlib
import io
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from docflow.llm import components, queries, simhash, warc
from tests.compare import connect, same


def expected_records(rows):
    first = {}
    for p, h in sorted(rows, key=lambda x: (x[0] is None, x[0])):
        first.setdefault(h, p)
    seen, out = set(), []
    for p, h in sorted(rows, key=lambda x: (x[0] is None, x[0] or 0)):
        new = h not in seen
        seen.add(h)
        out.append((p, len(h), base64.b32encode(hashlib.sha1(h).digest()).decode(), "response" if new else "revisit", None if new else first[h]))
    return sorted(map(str, out))


def test_archives(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    odd = [(10001, "u", "<p>x"), (10002, "u2\n", "<p>x"), (10003, None, None), (10004, None, ""), (None, "v", "<p>x"), (10001, "u", "<p>x"), (9, "z", "é\r\n\r\nWARC/1.1\r\n"), (20000, "big", "y" * 300_000)]
    df = pages.unionByName(spark.createDataFrame(odd, "page_id long, url string, html string")).withColumn("ord", F.lit(1)).withColumn("payload_digest", F.lit("x"))
    rows = [(r.page_id, (r.html or "").encode()) for r in df.collect()]
    assert sorted(str(tuple(r)) for r in warc.query(df).collect()) == expected_records(rows)
    assert warc.query(df.limit(0)).count() == 0


def test_query_equals_sql(spark, sf):
    same(queries.op3_warc(spark, sf), connect(sf), warc.ORACLE)


def test_small_payloads_are_not_revisited_above_a_bound(spark):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")], "page_id long, url string, html string")
    first, second = warc.own_dir(spark, "t"), warc.own_dir(spark, "t2")
    found = warc.resolve(warc.read_archives(warc.deduplicate(spark, warc.write_archives(df, first), second, least=3), second))
    assert {r.page_id: r.record_type for r in found.collect()} == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_records_read_piece_by_piece():
    blobs = [random.Random(i).randbytes(n) for i, n in enumerate((0, 1, 70_000, 200_000, 65_536))]
    data = b"".join(warc.record("response", [("WARC-Record-ID", str(i))], b) for i, b in enumerate(blobs))
    got = list(warc.records(io.BytesIO(data)))
    assert [b for *_, b in got] == blobs and sum(n for _, n, *_ in got) == len(data)
    with pytest.raises(ValueError, match="cut short"):
        list(warc.records(io.BytesIO(data[:-3])))


def brute_print(text):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(pairs):
    """(id, fp) rows to the smallest id of each row's component."""
    fps = sorted({fp for _, fp in pairs})
    a = np.array(fps, np.uint64)
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a[i + 1 :] ^ a[i]) <= 3) + i + 1:
            parent[find(int(j))] = find(i)
    best = {}
    for d, fp in pairs:
        r = find(fps.index(fp))
        if d is not None:
            best[r] = min(best.get(r, d), d)
    return [best.get(find(fps.index(fp))) for _, fp in pairs]


def test_near_duplicates(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    odd = [(90001, None), (90002, ""), (90003, " \n"), (None, ""), (90004, "A b"), (90005, "a B"), (90006, "Ä b"), (90006, "Ä b"), (None, "lone text here"), (None, "lone text here"), (90007, "w " * 40_000)]
    df = docs.union(spark.createDataFrame(odd, "doc_id long, text string")).withColumn("fp", F.lit(7)).withColumn("id", F.lit("x"))
    rows = [(r.doc_id, brute_print(r.text)) for r in df.collect()]
    want = sorted(map(str, [(d, f"{fp:016x}", c) for (d, fp), c in zip(rows, brute_components(rows), strict=True)]))
    assert sorted(str(tuple(r)) for r in simhash.query(df).collect()) == want
    kept = simhash.drop_near_duplicates(df)
    assert kept.columns == df.columns
    comps = brute_components(rows)
    named = {c for c in comps if c is not None}
    lone = {fp for (d, fp), c in zip(rows, comps, strict=True) if c is None}
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(named) and sum(i is None for i in ids) == len(lone) == 1
    assert simhash.query(df.limit(0)).count() == 0 and simhash.drop_near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("groups", [4, 5, 6, 9])
def test_links_find_every_component_of_planted_groups(spark, groups, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 64)  # cells are dealt out as pairs of blocks
    rng = random.Random(groups)
    fps = {rng.getrandbits(64) for _ in range(300)}
    for base in list(fps)[:6]:
        at = base
        for _ in range(60):  # chains that drift away, and a dense ball
            at ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
            fps.add(at)
            fps.add(base ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64))
    rows = [(i, fp) for i, fp in enumerate(sorted(fps))]
    df = spark.createDataFrame([(i, fp - (1 << 64) if fp >> 63 else fp) for i, fp in rows], "rep long, fp long")
    links = simhash.links(df, groups=groups).collect()
    parent = {fp: fp for fp in fps}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in ((r.a & (1 << 64) - 1, r.b & (1 << 64) - 1) for r in links):
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    want = brute_components(rows)
    mine = {}
    for i, fp in rows:
        mine.setdefault(find(fp), []).append(i)
    assert sorted(map(tuple, mine.values())) == sorted(tuple(i for i, c in enumerate(want) if c == k) for k in set(want))
    assert len(links) < 20 * len(fps)


def test_grid_distance_is_a_lower_bound(spark):
    rng = random.Random(1)
    pairs = [(rng.getrandbits(63), rng.getrandbits(63)) for _ in range(500)]
    df = spark.createDataFrame(pairs, "a long, b long").select("a", "b", simhash.unary(F.col("a")).alias("u"), simhash.unary(F.col("b")).alias("v"))
    for r in df.collect():
        counts = lambda x: [(x >> 2 * i & 3).bit_count() for i in range(32)]
        grid = sum(abs(p - q) for p, q in zip(counts(r.a), counts(r.b), strict=True))
        assert ((r.u ^ r.v) & (1 << 64) - 1).bit_count() == grid <= (r.a ^ r.b).bit_count()


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(1, 200)] + [(1000, i) for i in range(1001, 1300)] + [(5000, 5000), (None, 3)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.root for r in components.connected_components(df, "a", "b").collect()}
    assert got == {**{i: 1 for i in range(2, 201)}, **{i: 1000 for i in range(1001, 1300)}}


def test_query_runs(spark, sf):
    assert queries.op4_simhash(spark, sf).columns == ["doc_id", "fingerprint", "component_id"]
