"""Page images side by side: structural similarity and regions of difference, in Arrow batches of pages.

Images are grey bytes, row by row, each side with its own width. Sides of unlike size are brought to the smaller width and height
by area: a pixel is the mean of what it covers. All means, variances and covariances of windows come from summed-area tables,
so time follows pixels, whatever the window.

A region is an outer contour of pixels that differ by more than the tolerance: holes are filled, and what lies in them belongs
to the region. Rows of a page are runs of marked pixels; runs of neighbouring rows that touch, corners included, are joined by
least labels with pointer jumping (for holes: runs of the background, sides only). A contour's area is that of the polygon
through the centres of its outer pixels: one for each square of four marked pixels, half for each of three.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from docflow.functions import scoring

#: Window of the similarity, tolerance of a pixel as a share of the range, least area of a region.
WINDOW, TOLERANCE, LEAST_AREA = 7, 0.1, 100


def table_of(image: np.ndarray) -> np.ndarray:
    """Summed-area table with a first row and column of zeros."""
    out = np.zeros((image.shape[0] + 1, image.shape[1] + 1))
    np.cumsum(np.cumsum(image, axis=0, dtype=float), axis=1, out=out[1:, 1:])
    return out


def resized(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """The image by area: differences of its summed-area table at even, fractional steps."""
    if image.shape == (height, width):
        return image.astype(float)

    def at(table: np.ndarray, steps: int) -> np.ndarray:
        x = np.linspace(0, len(table) - 1, steps + 1)
        low = np.minimum(x.astype(int), max(len(table) - 2, 0))
        return table[low] + (table[low + 1] - table[low]) * (x - low)[:, None]

    sums = at(at(table_of(image), height).T, width).T
    return np.diff(np.diff(sums, axis=0), axis=1) * (height * width / (image.shape[0] * image.shape[1]))


def paired(a: bytes, b: bytes, a_width: int, b_width: int) -> tuple[np.ndarray, np.ndarray]:
    """Two images of one size."""
    x, y = (np.frombuffer(v, np.uint8).reshape(-1, int(w)) for v, w in ((a, a_width), (b, b_width)))
    height, width = min(len(x), len(y)), min(x.shape[1], y.shape[1])
    return resized(x, height, width), resized(y, height, width)


def similarity(a: np.ndarray, b: np.ndarray, window: int = WINDOW) -> float:
    """The mean structural similarity over all whole windows; 0 for images smaller than a window."""
    if min(a.shape) < window:
        return 0.0
    n = window * window

    def mean(x: np.ndarray) -> np.ndarray:
        t = table_of(x)
        return (t[window:, window:] - t[:-window, window:] - t[window:, :-window] + t[:-window, :-window]) / n

    # Around the middle of the range, sums of squares keep their digits.
    x, y = a - 127.5, b - 127.5
    mx, my, more = mean(x), mean(y), n / (n - 1)
    vx, vy, cov = (more * (mean(p) - q) for p, q in ((x * x, mx * mx), (y * y, my * my), (x * y, mx * my)))
    mx, my = mx + 127.5, my + 127.5
    c1, c2 = (0.01 * 255) ** 2, (0.03 * 255) ** 2
    return float((((2 * mx * my + c1) * (2 * cov + c2)) / ((mx * mx + my * my + c1) * (vx + vy + c2))).mean())


def labelled(mask: np.ndarray, corners: bool) -> np.ndarray:
    """The component of each marked pixel, from 1 in reading order of first pixels; 0 elsewhere. ``corners`` join too."""
    height, width = mask.shape
    edge = np.zeros((height, width + 2), np.int8)
    edge[:, 1:-1] = mask
    step = np.diff(edge, axis=1)
    row, start = np.nonzero(step == 1)
    end = np.nonzero(step == -1)[1]  # past the last pixel; runs come in the same order
    if not len(row):
        return np.zeros(mask.shape, np.int64)
    # A run meets those of the row above that begin before its end and end after its start; these are neighbours in order.
    wide, more = width + 3, int(corners)
    above = (row - 1) * wide
    first = np.searchsorted(row * wide + end, above + start - more, side="right")
    last = np.searchsorted(row * wide + start, above + end + more, side="left")
    many = np.maximum(last - first, 0)
    many[row == 0] = 0
    lower = np.repeat(np.arange(len(row)), many)
    upper = first[lower] + np.arange(len(lower)) - np.repeat(np.cumsum(many) - many, many)
    label = np.arange(len(row))
    while len(lower):
        a, b = label[lower], label[upper]
        if (a == b).all():
            break
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label != label[label]).any():
            label = label[label]
    number = np.unique(label, return_inverse=True)[1] + 1
    out = np.zeros(mask.shape, np.int64)
    out[mask] = np.repeat(number, end - start)
    return out


def filled(mask: np.ndarray) -> np.ndarray:
    """The mask with its holes: background that no way of sides leads out of."""
    outside = np.pad(~mask, 1, constant_values=True)
    label = labelled(outside, False)
    return ~(label == label[0, 0])[1:-1, 1:-1]


def regions(before: np.ndarray, after: np.ndarray, tolerance: float = TOLERANCE, least: float = LEAST_AREA) -> list[tuple]:
    """(x, y, width, height, area, confidence, mean before, mean after) of the regions of ``least`` area or more."""
    diff = np.abs(np.round(before) - np.round(after))
    label = labelled(filled(diff > int(255 * tolerance)), True)
    many = int(label.max(initial=0))
    if not many:
        return []
    y, x = np.nonzero(label)
    own = label[y, x]
    box = np.array([[before.shape[1]] * (many + 1), [before.shape[0]] * (many + 1), [-1] * (many + 1), [-1] * (many + 1)])
    for k, v in enumerate((x, y)):
        np.minimum.at(box[k], own, v)
        np.maximum.at(box[k + 2], own, v)
    padded = np.pad(label, 1)
    quad = np.stack([padded[:-1, :-1], padded[:-1, 1:], padded[1:, :-1], padded[1:, 1:]])
    marked = (quad > 0).sum(0)
    area = np.bincount(quad.max(0)[marked >= 3], np.where(marked == 4, 1.0, 0.5)[marked >= 3], many + 1)
    tables = [table_of(v) for v in (diff, before, after)]
    out = []
    for k in range(1, many + 1):
        if area[k] < least:
            continue
        x0, y0, x1, y1 = (int(v) for v in (box[0, k], box[1, k], box[2, k] + 1, box[3, k] + 1))
        means = [(t[y1, x1] - t[y0, x1] - t[y1, x0] + t[y0, x0]) / ((x1 - x0) * (y1 - y0)) for t in tables]
        out.append((x0, y0, x1 - x0, y1 - y0, float(area[k]), means[0] / 255, means[1], means[2]))
    return out


@F.pandas_udf(DoubleType())
def ssim(a: pd.Series, b: pd.Series, a_width: pd.Series, b_width: pd.Series) -> pd.Series:
    """Structural similarity of two grey images; 0 for missing images and for bytes that are no whole rows."""

    def one(x: bytes, y: bytes, v: float, w: float) -> float:
        try:
            return similarity(*paired(x, y, v, w))
        except (TypeError, ValueError, ZeroDivisionError):
            return 0.0

    return pd.Series([one(*v) for v in zip(a, b, a_width, b_width, strict=True)], dtype="float64")


def page_differences(pages: DataFrame, by: tuple[str, ...] = ("doc_id", "page"), tolerance: float = TOLERANCE, least: float = LEAST_AREA) -> DataFrame:
    """(by…, x, y, w, h, area, confidence, type, severity) of pages (by…, before, before_width, after, after_width), a row a region.

    Pages without a region, without an image on a side, or whose bytes are no whole rows have no row.
    """
    found = "x int, y int, w int, h int, area double, confidence double, _b double, _a double, _width int, _height int"
    names = [c.split(" ")[0] for c in found.split(", ")]
    own = pages.select(*(F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(by)), "before", "after", "before_width", "after_width")

    def work(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for *key, a, b, v, w in part.itertuples(index=False):
                try:
                    before, after = paired(a, b, v, w)
                except (TypeError, ValueError, ZeroDivisionError):
                    continue
                rows += [(*key, *r, before.shape[1], before.shape[0]) for r in regions(before, after, tolerance, least)]
            yield pd.DataFrame(rows, columns=[*part.columns[: len(by)], *names])

    keys = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in own.schema.fields[: len(by)])
    out = own.mapInPandas(work, keys + found)
    kind, severity = scoring.diff_type(F.col("_b"), F.col("_a")), scoring.diff_severity(F.col("area"), F.col("_width"), F.col("_height"))
    return out.select(*(F.col(f"_k{i}").alias(c) for i, c in enumerate(by)), "x", "y", "w", "h", "area", "confidence", kind.alias("type"), severity.alias("severity"))
