"""Likeness and regions of page images against direct computations."""

import numpy as np
import pytest

from docflow.operators import images
from docflow.plans import image_queries, registry


def direct_ssim(a, b, w=7):
    win = lambda m: np.lib.stride_tricks.sliding_window_view(m.astype(float), (w, w)).reshape(-1, w * w)
    x, y = win(a), win(b)
    mx, my = x.mean(1), y.mean(1)
    vx, vy = x.var(1, ddof=1), y.var(1, ddof=1)
    cov = ((x - mx[:, None]) * (y - my[:, None])).sum(1) / (w * w - 1)
    c1, c2 = 2.55**2, 7.65**2
    return (((2 * mx * my + c1) * (2 * cov + c2)) / ((mx**2 + my**2 + c1) * (vx + vy + c2))).mean()


def direct_resize(a, h, w):
    big = np.kron(a, np.ones((h, w)))  # every pixel h by w times
    return big.reshape(h, a.shape[0], w, a.shape[1]).mean((1, 3))


def flood(mask, corners):
    """Components as sets of pixels."""
    left, out = {tuple(p) for p in np.argwhere(mask)}, []
    near = [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1) if (a, b) != (0, 0) and (corners or not (a and b))]
    while left:
        seen = [left.pop()]
        for y, x in seen:
            for a, b in near:
                if (y + a, x + b) in left:
                    left.remove((y + a, x + b))
                    seen.append((y + a, x + b))
        out.append(set(seen))
    return out


def direct_regions(before, after, least):
    diff = np.abs(before.astype(int) - after.astype(int))
    mask = diff > 25
    out = []
    around = next(c for c in flood(~np.pad(mask, 1), False) if (0, 0) in c)
    full = np.array([[(y + 1, x + 1) not in around for x in range(mask.shape[1])] for y in range(mask.shape[0])])
    for part in flood(full, True):
        area = 0.0
        for y in range(-1, mask.shape[0]):
            for x in range(-1, mask.shape[1]):
                n = sum(p in part for p in ((y, x), (y, x + 1), (y + 1, x), (y + 1, x + 1)))
                area += (n == 4) + 0.5 * (n == 3)
        ys, xs = [p[0] for p in part], [p[1] for p in part]
        box = (slice(min(ys), max(ys) + 1), slice(min(xs), max(xs) + 1))
        if area >= least:
            out.append((min(xs), min(ys), max(xs) - min(xs) + 1, max(ys) - min(ys) + 1, area, round(diff[box].mean() / 255, 9), round(before[box].mean(), 6), round(after[box].mean(), 6)))
    return sorted(out)


@pytest.mark.parametrize("share", [0.02, 0.1, 0.3, 0.5, 0.7])
def test_regions_equal_a_flood(share):
    rng = np.random.default_rng(int(share * 100))
    for _ in range(15):
        h, w = rng.integers(1, 25, 2)
        before = rng.integers(0, 255, (h, w)).astype(np.uint8)
        after = np.where(rng.random((h, w)) < share, (before.astype(int) + 128) % 256, before).astype(np.uint8)
        got = sorted((*r[:5], round(r[5], 9), round(r[6], 6), round(r[7], 6)) for r in images.regions(before.astype(float), after.astype(float), least=0.5))
        assert got == direct_regions(before, after, 0.5)


def test_shapes_of_known_area():
    page = np.zeros((40, 40))
    ring = page.copy()
    ring[5:30, 5:30] = 255
    ring[10:20, 10:20] = 0
    ring[14:16, 14:16] = 255  # inside a hole: no region of its own
    assert images.regions(page, ring) == [(5, 5, 25, 25, 576.0, pytest.approx(ring[5:30, 5:30].mean() / 255), 0.0, pytest.approx(ring[5:30, 5:30].mean()))]
    line = page.copy()
    line[3, :] = 255
    assert images.regions(page, line) == [] and images.regions(page, line, least=0) != [] and images.regions(page, page) == []
    spiral = np.array([[(x + y) % 2 for x in range(40)] for y in range(40)]) * 255.0
    assert len(images.regions(page, spiral, least=0)) == 1  # corners join


def test_similarity_and_sizes():
    rng = np.random.default_rng(0)
    for h, w in ((7, 7), (20, 33), (64, 50)):
        a, b = rng.integers(0, 256, (2, h, w))
        b = (a + rng.integers(-40, 40, (h, w))).clip(0, 255)
        assert images.similarity(a.astype(float), b.astype(float)) == pytest.approx(direct_ssim(a, b), abs=1e-10)
    flat = np.full((30, 30), 255.0)
    assert images.similarity(flat, flat) == pytest.approx(1, abs=1e-12) and images.similarity(flat[:6], flat[:6]) == 0
    for shape in ((10, 14), (3, 9), (20, 15)):
        a = rng.integers(0, 256, shape)
        assert np.allclose(images.resized(a, 3, 7), direct_resize(a, 3, 7))


def test_pages_of_unlike_sizes_and_bad_bytes(spark):
    rng = np.random.default_rng(1)
    a = rng.integers(0, 256, (30, 40)).astype(np.uint8)
    b = np.kron(a, np.ones((2, 2), np.uint8))
    c = a.copy()
    c[5:20, 5:20] = 255 - c[5:20, 5:20]
    rows = [(1, 0, a, 40, b, 80), (1, 1, a, 40, c, 40), (2, 0, None, 40, a, 40), (2, 1, a, 41, a, 40), (2, 2, a, 0, a, 40), (2, 3, a[:0], 40, a, 40), (2, 4, a, None, a, 40)]
    df = spark.createDataFrame([(d, p, None if x is None else bytearray(x.tobytes()), v, bytearray(y.tobytes()), w) for d, p, x, v, y, w in rows], "doc_id int, page int, before binary, before_width int, after binary, after_width int")
    got = {(r.doc_id, r.page): r.s for r in df.select("doc_id", "page", images.ssim("before", "after", "before_width", "after_width").alias("s")).collect()}
    assert got[1, 0] == pytest.approx(1, abs=1e-9) and 0 < got[1, 1] < 0.95 and all(got[2, p] == 0 for p in range(5))
    found = images.page_differences(df).collect()
    assert {(r.doc_id, r.page) for r in found} == {(1, 1)} and max(r.area for r in found) > 100 and {r.severity for r in found} <= {"medium", "high", "critical"}


def test_query_equals_the_flood(spark, sf):
    pages = image_queries.page_pairs(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").where("length(text) < 2000").limit(8)).collect()
    want = {}
    for p in pages:
        x, y = images.paired(p.before, p.after, p.before_width, p.after_width)
        want[p.doc_id, p.page] = [r[:5] for r in direct_regions(np.round(x), np.round(y), 100)]
    got = {k: [] for k in want}
    for r in registry.queries()["page_regions"](spark, sf).collect():
        if (r.doc_id, r.page) in got:
            got[r.doc_id, r.page].append((r.x, r.y, r.w, r.h, r.area))
    assert {k: sorted(v) for k, v in got.items()} == want and any(want.values())
    levels = registry.queries()["visual_from_images"](spark, sf)
    assert levels.count() == spark.read.parquet(f"{sf}/documents.parquet").count() and levels.where("similarity is null or n_changed > 0").count() > 0
