"""A quality classifier by positive-unlabelled learning with the non-negative unbiased risk estimator.

Trusted positives are labelled good documents; the unlabelled set is all the web text there is; the class prior is
estimated from both by the best bin of a first classifier (the least ratio of tail shares, unlabelled to positive,
with a confidence margin). That classifier sums the log ratios of bin counts, so every text, positive or unlabelled, is
scored by exactly the counts of all the others: one text less in each of its bins. No text decides about itself. A linear model over binned text statistics then minimises
``prior * risk(P, +) + max(0, risk(U, -) - prior * risk(P, -))`` under the sigmoid loss; where the bracket is
negative, a step goes the other way. Its margin becomes a probability without negatives too: slope and offset minimise
the logistic risk of positives and unlabelled texts, which is convex and has the posterior as its minimum.

Statistics of every whole text are computed once and stored. A bounded, hash-drawn sample of the labelled positives
(``learning.SAMPLE_ROWS``) travels. Every unlabelled text takes part: rows are dealt out by a hash of id and text, so copies
spread, in blocks of about ``BLOCK``; a task minimises the risk over a block and the positives, and the weights are averaged over blocks, ``MIXES`` times from where
the last average stands. Tail shares and the last map use counts of margins over all texts, in ``CUTS`` cuts.

Defined results: null and blank texts have all statistics zero and get a score like others; a null id is not held out
and is never learned from; repeated rows are each scored; texts of any length are read whole; an empty table gives
an empty result; without a labelled positive the score is 0.5; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import stored
from docflow.llm.learning import SAMPLE_ROWS, drawn, fold, sigmoid

FOLDS, HELD_OUT, THRESHOLD = 5, 0, 0.3
#: Shares of the positives below the edges of a statistic's bins.
LEVELS = (0.002, 0.02, 0.1, 0.2, 0.35, 0.5, 0.65, 0.8, 0.9, 0.98, 0.998)
BINS = len(LEVELS) + 1
#: Unlabelled texts of a block, averages, and cuts of the margin's range that are counted.
BLOCK, MIXES, CUTS = 20_000, 2, 2000
NAMES = ("words", "word_length", "distinct", "pairs", "triples", "same_next", "upper", "lower", "digits", "marks", "stops", "bars", "other", "symbols", "lines", "same_lines")


def statistics(text: str | None) -> list[float]:
    """The statistics of one text, in the order of NAMES: counts in logs, the rest as shares."""
    raw = (text or "").encode()
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * len(NAMES)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    seen = len(raw)
    of = lambda chars: float(counts[list(chars)].sum()) / n
    lines = [x for x in raw.split(b"\n") if x]
    following = words[1:]
    return [
        float(np.log1p(n)),
        (seen - float(counts[[9, 10, 11, 12, 13, 32]].sum())) / n,
        len(set(words)) / n,
        len(set(zip(words, following, strict=False))) / max(n - 1, 1),
        len(set(zip(words, following, words[2:], strict=False))) / max(n - 2, 1),
        sum(map(bytes.__eq__, words, following)) / n,
        float(counts[65:91].sum()) / seen,
        float(counts[97:123].sum()) / seen,
        float(counts[48:58].sum()) / seen,
        of(b"!?;:"),
        of(b".,"),
        of(b"|<>{}[]"),
        float(counts[128:].sum()) / seen,
        of(b"#*$%&@^~=+_\\/"),
        float(np.log1p(len(lines))),
        1 - len(set(lines)) / max(len(lines), 1),
    ]


def measured(df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, h, stats): each row's id, a hash of its text and the statistics of its whole text."""
    own = df.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(f"`{text_col}`").alias("h"), F.col(f"`{text_col}`").alias("t"))

    def work(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows:
            stats = pa.array([statistics(x.as_py()) for x in b.column(2)], pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), stats], names=["id", "h", "stats"])

    return own.mapInArrow(work, f"id {own.schema['id'].dataType.simpleString()}, h long, stats array<float>")


@dataclass(frozen=True)
class Model:
    """Bin edges of each statistic, a weight for each bin, and the logistic map to a probability."""

    edges: np.ndarray
    weights: np.ndarray
    slope: float
    offset: float
    prior: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.weights[_cells(x, self.edges)].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * self.margin(x) + self.offset)


def _cells(x: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """For each row and statistic the index of its bin's weight."""
    width = edges.shape[1] + 1
    return np.stack([np.searchsorted(edges[j], x[:, j], side="right") + j * width for j in range(len(edges))], axis=1)


def _gradient(cells: np.ndarray, pull: np.ndarray, size: int) -> np.ndarray:
    return np.bincount(cells.ravel(), np.repeat(pull, cells.shape[1]), size)


def _minimise(positive: np.ndarray, unlabelled: np.ndarray, start: np.ndarray, prior: float, rounds: int = 300, rate: float = 0.05, decay: float = 1e-3, smooth: float = 1e-2) -> np.ndarray:
    """Weights under the non-negative risk, drawn to zero by ``decay`` and to those of the bins beside them by ``smooth``."""
    w, size = start.copy(), len(start)
    m, v = np.zeros(size), np.zeros(size)
    for t in range(1, rounds + 1):
        gp, gu = w[positive].sum(1), w[unlabelled].sum(1)
        sp, su = sigmoid(gp), sigmoid(gu)  # the loss of x as negative; 1 - sigmoid as positive
        up = _gradient(positive, -sp * (1 - sp) / len(gp), size) * prior
        rest = _gradient(unlabelled, su * (1 - su) / len(gu), size) - prior * _gradient(positive, sp * (1 - sp) / len(gp), size)
        g = up + rest if su.mean() - prior * sp.mean() >= 0 else -rest
        steps = smooth * np.diff(w.reshape(-1, BINS), axis=1, prepend=0, append=0)
        steps[:, [0, -1]] = 0
        g += decay * w - np.diff(steps, axis=1).ravel()
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return w


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, confidence: float = 0.1) -> float:
    """The least ratio of tail shares, unlabelled to positive; a margin keeps thin tails from deciding.

    Both are counts by rising cut of the margin.
    """
    tail = lambda n: np.cumsum(n[::-1])[::-1] / max(n.sum(), 1)
    p, u = tail(positive), tail(unlabelled)
    ok = p >= 0.05
    margin = np.sqrt(np.log(4 / confidence) / 2 / max(unlabelled.sum(), 1)) + np.sqrt(np.log(4 / confidence) / 2 / max(positive.sum(), 1))
    best = np.argmin(np.where(ok, (u + margin) / np.maximum(p, 1e-9), np.inf))
    return float(np.clip(u[best] / p[best], 0.05, 0.98))


def left_out_weights(positive: np.ndarray, unlabelled: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log ratios of bin counts (statistic x bin) for positives and for unlabelled texts, each without the text itself.

    A text counts half for its own bin and a quarter for each bin beside it; at the ends three quarters and one.
    """
    own = np.full(positive.shape[1], 0.5)
    own[[0, -1]] = 0.75

    def share(n: np.ndarray, without: bool) -> np.ndarray:
        wide = np.pad(n, ((0, 0), (1, 1)), mode="edge")
        spread = (wide[:, :-2] + 2 * wide[:, 1:-1] + wide[:, 2:]) / 4 - own * without
        return np.log((np.maximum(spread, 0) + 1) / (n.sum(1, keepdims=True) - without + n.shape[1]))

    return (share(positive, True) - share(unlabelled, False)).ravel(), (share(positive, False) - share(unlabelled, True)).ravel()


def posterior_map(at: np.ndarray, positive: np.ndarray, unlabelled: np.ndarray, prior: float, rounds: int = 100) -> tuple[float, float]:
    """Slope and offset that minimise the (slightly ridged) logistic risk, from counts of margins ``at`` among positives and unlabelled."""
    p, u = positive / positive.sum(), unlabelled / unlabelled.sum()
    z, w = np.stack([at, np.ones_like(at)], 1), np.array([1.0, 0.0])
    for _ in range(rounds):
        s = sigmoid(z @ w)
        g = z.T @ (u * s - prior * p) + 3e-3 * w
        h = (z * (u * s * (1 - s))[:, None]).T @ z + 3e-3 * np.eye(2)
        step = np.clip(np.linalg.solve(h, g), -1, 1)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def fit(positive: np.ndarray, blocks, counted) -> Model:
    """The model from the positives' statistics.

    ``blocks(edges, start, prior)`` averages the weights minimised over blocks of unlabelled texts; ``counted(edges, weights,
    cuts)`` counts unlabelled margins between cuts.
    """
    # The outer bins hold what hardly any positive reaches.
    edges = np.sort(np.quantile(positive, LEVELS, axis=0).T, axis=1)
    p = _cells(positive, edges)

    def both(wp: np.ndarray, wu: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Counts of the positives' margins under wp and of the unlabelled ones under wu."""
        by = np.stack([wp, wu]).reshape(2, len(edges), BINS)
        cuts = np.linspace(by.min(2).sum(1).min(), by.max(2).sum(1).max() + 1e-9, CUTS + 1)
        own = np.bincount(np.clip(np.searchsorted(cuts, wp[p].sum(1), side="right") - 1, 0, CUTS - 1), minlength=CUTS)
        return (cuts[1:] + cuts[:-1]) / 2, own, counted(edges, wu, cuts)

    size = len(edges) * BINS
    bins = lambda j: np.where(np.arange(size) // BINS == j, np.arange(size) % BINS, 0).astype(float)
    there = np.stack([counted(edges, bins(j), np.arange(BINS + 1) - 0.5)[:BINS] for j in range(len(edges))])
    wp, wu = left_out_weights(np.bincount(p.ravel(), minlength=size).reshape(len(edges), BINS), there)
    _, own, others = both(wp, wu)
    prior = estimate_prior(own, others)
    weights = np.zeros(size)
    for _ in range(MIXES):
        weights = blocks(edges, weights, prior)
    at, own, others = both(weights, weights)
    slope, offset = posterior_map(at, own, others, prior)
    return Model(edges, weights, slope, offset, prior)


def _stats(b: pa.RecordBatch, column: str = "stats") -> np.ndarray:
    return b.column(column).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, len(NAMES))


def _mixed(rows: Iterator[pa.RecordBatch], positive: np.ndarray, edges: np.ndarray, start: np.ndarray, prior: float) -> Iterator[pa.RecordBatch]:
    """Rows (block, h, stats) by block and h to (at, sum, n): weights minimised over each block, times its texts."""
    p, held = _cells(positive, edges), []

    def told() -> pa.RecordBatch:
        x = np.vstack([h[1] for h in held])
        w = _minimise(p, _cells(x, edges), start, prior) * len(x)
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(np.arange(len(w)), pa.int32()), pa.array(w), pa.array(np.full(len(w), len(x)), pa.int64())], names=["at", "w", "n"])

    for b in rows:
        block, x = b.column("block").to_numpy(), _stats(b)
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(block)) + 1, [len(block)]])
        for i, e in zip(cuts[:-1], cuts[1:], strict=True):
            if held and (held[0][0] != block[i] or sum(len(h[1]) for h in held) >= 2 * BLOCK):
                yield told()
            if e > i:
                held.append((block[i], x[i:e]))
    if held:
        yield told()


def train(stats: DataFrame, labels: DataFrame, label_col: str = "quality") -> Model | None:
    """The model from stored statistics and (doc_id, label) rows outside the held-out fold; None without a positive."""
    own = labels.where((fold(F.col("doc_id"), FOLDS) != HELD_OUT) & (F.col(label_col) == 1)).select(F.col("doc_id").alias("id")).distinct()
    known = stored(stats.join(own, "id", "left_semi").select("h", "stats"), "positives")
    sample = drawn(known, F.col("h")).toArrow()
    positive = np.array(sample.column("stats").to_pylist(), np.float64).reshape(-1, len(NAMES))
    if not len(positive):
        return None
    positive = positive[np.lexsort(positive.T)]  # one order of sums, however rows arrive
    total = stats.count()
    block = F.pmod(F.xxhash64("h", "id", F.lit(23)), F.lit(-(-total // BLOCK)))
    dealt = stored(stats.select(block.alias("block"), "h", "stats").repartition("block").sortWithinPartitions("block", "h"), "blocks")

    def blocks(edges: np.ndarray, start: np.ndarray, prior: float) -> np.ndarray:
        rows = dealt.select("block", "stats").mapInArrow(lambda b: _mixed(b, positive, edges, start, prior), "at int, w double, n long")
        found = rows.groupBy("at").agg((F.sum("w") / F.sum("n")).alias("w")).orderBy("at").toArrow()
        return found.column("w").to_numpy().copy()

    def counted(edges: np.ndarray, w: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        def work(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n = np.zeros(CUTS, np.int64)
            for b in rows:
                n += np.bincount(np.clip(np.searchsorted(cuts, w[_cells(_stats(b), edges)].sum(1), side="right") - 1, 0, CUTS - 1), minlength=CUTS)
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(n[at])], names=["at", "n"])

        out = np.zeros(CUTS)
        for r in dealt.select("stats").mapInArrow(work, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
            out[r["at"]] = r["n"]
        return out

    return fit(positive, blocks, counted)


def classify(df: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row."""
    stats = stored(measured(df), "stats")
    model = train(stats, labels)

    def work(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows:
            x = _stats(b)
            score = model.score(x) if model else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score, pa.float64())], names=["doc_id", "score"])

    scored = stats.select("id", "stats").mapInArrow(work, f"doc_id {stats.schema['id'].dataType.simpleString()}, score double")
    held = F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
