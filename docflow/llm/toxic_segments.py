"""Toxic passages by maximum-scoring segments over token log-odds.

Tokens are words and, marked by a star, their first ``STEM`` letters. Every token of the labelled documents has the
log-odds of its occurrences between toxic and clean ones under an informative Dirichlet prior: the token's frequency in
the whole corpus, worth ``PRIOR`` of all labelled tokens. Toxic log-odds shrink by the share ``BOUND / z``, where z is
the root of the likelihood-ratio statistic over documents (so repetition in one of them does not count). From the result goes
``GAP``, the log-odds against a word being in a toxic passage, so that chance scores are negative; none is below ``FLOOR``. A word scores
the larger of its own and its stem's, and one that no labelled document has minus ``GAP``. The Ruzzo-Tompa scan
finds all maximal scoring segments of a text in linear time.

Karlin-Altschul statistics calibrate them: lambda solves the moment equation of the scores under clean
frequencies, K is the maximum-likelihood value for the best segments of clean training documents, and a segment's normalised
score is by how much it exceeds what chance gives in a text of this length. A document's statistic is the extreme-value
one: the least chance, over r, of r segments with so large a sum. Logistic regression on training rows turns it
into a probability.

Training takes a bounded, hash-drawn sample of labelled rows (twice ``learning.SAMPLE_ROWS``), broadcast to the documents, so
no text is shuffled; token counts, of the sample as of the corpus, are combined before their shuffle. The model that
travels has the tokens of the sample, at most ``TOKENS`` of them, the most frequent in it.

Defined results: null and blank texts have no segments and get the least score; a null id is not held out and is
never learned from; repeated rows are each scored; texts of any length are scanned whole; an empty table gives an
empty result; without labels of both kinds the score is 0; other columns do not matter.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import stored
from docflow.llm.learning import SAMPLE_ROWS, drawn, fit_logistic, fold, sigmoid

FOLDS, HELD_OUT, THRESHOLD = 4, 2, 0.3
#: Prior counts as a share of all labelled counts, root of the likelihood ratio that leaves nothing, what a word costs, least score, letters of a stem.
PRIOR, BOUND, GAP, FLOOR, STEM = 0.01, 3.5, 0.25, -1.0, 5
#: Tokens that the model holds at most (some 50 bytes each).
TOKENS = 500_000
TOKEN = re.compile(r"[^\W\d_]+")
#: Words that a worker remembers the score of; it starts anew when full.
SEEN = 300_000


def segments(scores: Iterable[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first token, end, score) of a sequence of scores.

    Candidates are kept in a stack with cumulative scores before and after, as Ruzzo and Tompa do; a candidate merges with
    those it dominates.
    """
    stack: list[list[float]] = []  # first, end, sum before, sum after, place of the last one with a smaller sum before
    total = 0.0
    for position, score in enumerate(scores):
        before, total = total, total + score
        if score <= 0:
            continue
        new = [position, position + 1, before, total, -1]
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= new[2]:
                j = stack[j][4]  # everything between starts no lower
            new[4] = j
            if j < 0 or stack[j][3] >= new[3]:
                break
            new = [stack[j][0], new[1], stack[j][2], new[3], -1]
            del stack[j:]
        stack.append(new)
    return [(int(a), int(b), right - left) for a, b, left, right, _ in stack]


class _Seen(dict):
    """Scores of words as they stand in texts; that of a new one is the largest of its parts'."""

    def __init__(self, scores: dict[str, float], stems: dict[str, float]):
        super().__init__()
        self.scores, self.stems = scores, stems

    def __missing__(self, word: str) -> float:
        parts = TOKEN.findall(word.lower())
        s = self[word] = max((max(self.scores.get(p, -GAP), self.stems.get(p[:STEM], FLOOR) if len(p) >= STEM else FLOOR) for p in parts), default=0.0)
        return s

    def __reduce__(self):
        return _Seen, (self.scores, self.stems)


@dataclass(frozen=True)
class Model:
    """Scores of words and stems, lambda, log K, and the logistic map from the statistic to a probability."""

    scores: dict[str, float]
    stems: dict[str, float]
    rate: float
    log_k: float = 0.0
    weights: tuple[float, ...] = (0.0,)
    offset: float = 0.0

    @cached_property
    def seen(self) -> _Seen:
        return _Seen(self.scores, self.stems)

    def best(self, text: str | None) -> tuple[int, float]:
        """The tokens of a text and the score of its best segment."""
        n, found = self.passages(text, calibrated=False)
        return n, max((s for *_, s in found), default=0.0)

    def passages(self, text: str | None, calibrated: bool = True) -> tuple[int, list[tuple[int, int, float]]]:
        """The tokens of a text and its segments with normalised scores, significant or not."""
        words = (text or "").split()
        if len(self.seen) > SEEN:
            self.seen.clear()
        found = segments(map(self.seen.__getitem__, words))
        if not calibrated:
            return len(words), found
        chance = self.log_k + math.log(len(words) + 1)
        return len(words), [(a, b, self.rate * s - chance) for a, b, s in found]

    def statistic(self, found: Iterable[tuple[int, int, float]]) -> float:
        """The extreme-value statistic of segments: minus the logarithm of the least chance of r segments' sum, over r."""
        best, total, log_facts = 0.0, 0.0, 0.0
        for r, x in enumerate(sorted((s for *_, s in found if s > 0), reverse=True), 1):
            total += x
            if r == 1:
                chance = -math.log(-math.expm1(-math.exp(-min(x, 700.0)))) if x < 30 else x
            else:
                log_facts += math.log(r) + math.log(r - 1)
                chance = total - (r - 1) * math.log(total) + log_facts
            best = max(best, chance - r * math.log(2))
        return best

    def features(self, text: str | None) -> tuple[float]:
        return (math.log1p(self.statistic(self.passages(text)[1])),)


def token_counts(known: DataFrame) -> DataFrame:
    """(token, toxic, clean, toxic_docs, clean_docs): occurrences and labelled documents with each word and stem."""
    own = known.select("label", "text")
    names = ("token", "toxic", "clean", "toxic_docs", "clean_docs")

    def work(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                counts: dict[str, list[int]] = {}
                for label, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    words = Counter(TOKEN.findall((text or "").lower()))
                    stems: Counter = Counter()
                    for w, n in words.items():
                        if len(w) >= STEM:
                            stems[f"{w[:STEM]}*"] += n
                    k = 0 if label == 1 else 1
                    for found in (words, stems):
                        for w, n in found.items():
                            c = counts.setdefault(w, [0, 0, 0, 0])
                            c[k] += n
                            c[2 + k] += 1
                yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), *(pa.array([c[i] for c in counts.values()], pa.int64()) for i in range(4))], names=names)

    rows = own.mapInArrow(work, "token string, " + ", ".join(f"{n} long" for n in names[1:]))
    return rows.groupBy("token").agg(*(F.sum(n).alias(n) for n in names[1:]))


def corpus_counts(df: DataFrame, wanted: DataFrame) -> DataFrame:
    """(token, everywhere): occurrences over all texts of the tokens in ``wanted``."""
    own = df.select("text")

    def work(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw: Counter = Counter()

        def told() -> pa.RecordBatch:
            words: Counter = Counter()
            for written, n in raw.items():
                for w in TOKEN.findall(written.lower()):
                    words[w] += n
            raw.clear()
            for w in list(words):
                if len(w) >= STEM:
                    words[f"{w[:STEM]}*"] += words[w]
            return pa.RecordBatch.from_arrays([pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())], names=["token", "n"])

        for b in rows:
            for text in b.column(0):
                raw.update((text.as_py() or "").split())
                if len(raw) > SEEN:
                    yield told()
        if raw:
            yield told()

    rows = own.mapInArrow(work, "token string, n long").groupBy("token").agg(F.sum("n").alias("everywhere"))
    return wanted.select("token").join(rows.hint("merge"), "token")


def log_odds(counts: DataFrame, corpus: DataFrame, toxic_docs: int, clean_docs: int) -> tuple[list[tuple[str, float, float]], float]:
    """(token, score, clean frequency) of the tokens, and lambda. ``counts`` is stored."""
    if not toxic_docs or not clean_docs:
        return [], 1.0
    n1, n0 = counts.where("token not like '%*'").agg(F.sum("toxic"), F.sum("clean")).first()
    total = corpus.where("token not like '%*'").agg(F.sum("everywhere")).first()[0]
    if not n1 or not n0 or not total:
        return [], 1.0
    prior = PRIOR * (n1 + n0)
    a = F.col("everywhere") / total * prior
    odds = lambda y, n: F.log((y + a) / (n + prior - y - a))
    delta = odds(F.col("toxic"), n1) - odds(F.col("clean"), n0)
    share = toxic_docs / (toxic_docs + clean_docs)
    docs = F.col("toxic_docs") + F.col("clean_docs")
    part = lambda seen, due: F.when(seen > 0, seen * F.log(seen / due)).otherwise(0.0)
    z = F.sqrt(F.greatest(2 * (part(F.col("toxic_docs"), docs * share) + part(F.col("clean_docs"), docs * (1 - share))), F.lit(1e-12)))
    toxic = (delta > 0) & (F.col("toxic_docs") > docs * share)
    shrunk = F.when(toxic, delta * F.greatest(F.lit(0.0), 1 - BOUND / z)).otherwise(F.least(delta, F.lit(0.0)))
    score = F.greatest(shrunk - GAP, F.lit(FLOOR))
    found = counts.join(corpus, "token").select("token", score.alias("score"), ((F.col("clean") + a) / (n0 + prior)).alias("p"), (F.col("toxic") + F.col("clean")).alias("n"))
    # A word at minus GAP scores as an unknown one does; stems matter where they are toxic.
    found = found.where(F.when(F.col("token").endswith("*"), F.col("score") > 0).otherwise(F.col("score") != -GAP)).orderBy(F.desc("n"), "token").limit(TOKENS)
    kept = [(r.token, r.score, r.p) for r in found.select("token", "score", "p").toLocalIterator()]
    words = [(s, p) for t, s, p in kept if t[-1] != "*"]
    s, p = np.array([k[0] for k in words]), np.array([k[1] for k in words])
    rest = max(1 - p.sum(), 0.0)
    low, high = 0.0, 5.0
    for _ in range(60 if (s > 0).any() else 0):  # the moment equation has one positive root if the mean score is negative
        mid = (low + high) / 2
        low, high = (mid, high) if (p * np.exp(np.minimum(mid * s, 500))).sum() + rest * math.exp(-mid * GAP) < 1 else (low, mid)
    return kept, max(low, 1e-3) if len(kept) else 1.0


def train(df: DataFrame, labels: DataFrame, label_col: str = "toxic") -> Model:
    own = labels.where((fold(F.col("doc_id"), FOLDS) != HELD_OUT) & F.col(label_col).isNotNull())
    own = own.groupBy("doc_id").agg(F.max(label_col).alias("label"))
    own = drawn(own, F.col("doc_id"), 2 * SAMPLE_ROWS)
    # Copies of a text teach once.
    hashes = df.select("doc_id", F.xxhash64("text").alias("h")).join(F.broadcast(own), "doc_id")
    own = hashes.groupBy("h").agg(F.min("doc_id").alias("doc_id"), F.max("label").alias("label")).select("doc_id", "label")
    known = stored(df.select("doc_id", "text").join(F.broadcast(own), "doc_id").select("text", "label"), "teachers")  # some 40,000 texts at most
    by_label = {r.label: r.n for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not by_label.get(1) or not by_label.get(0):
        return Model({}, {}, 1.0, 0.0, (0.0,), -30.0)
    counts = stored(token_counts(known), "tokens")
    kept, rate = log_odds(counts, stored(corpus_counts(df, counts), "corpus"), by_label[1], by_label[0])
    model = Model({t: s for t, s, _ in kept if t[-1] != "*"}, {t[:-1]: s for t, s, _ in kept if t[-1] == "*"}, rate)
    # Of a clean text of n tokens with best score s, K n exp(-lambda s) is exponential with mean 1.
    clean = known.where("label = 0").select("text").mapInArrow(lambda rows: _bests(rows, model), "n long, s double").toArrow()
    n, s = (clean.column(i).to_numpy().astype(float) for i in (0, 1))
    log_k = math.log(len(n)) - math.log(max((n * np.exp(-rate * s)).sum(), 1e-300)) if len(n) else 0.0
    model = Model(model.scores, model.stems, rate, log_k)
    found = known.select("label", "text").mapInArrow(lambda rows: _featured(rows, model), "label int, a double").toArrow()
    x, y = found.column(1).to_numpy()[:, None], found.column(0).to_numpy().astype(float)
    weights, offset = fit_logistic(x, y)
    return Model(model.scores, model.stems, rate, log_k, tuple(map(float, weights)), offset)


def _bests(rows: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for b in rows:
        found = [x for x in (model.best(t.as_py()) for t in b.column(0)) if x[0]]
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.float64())], names=["n", "s"])


def _featured(rows: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for b in rows:
        x = [model.features(t.as_py())[0] for t in b.column(1)]
        yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int32()), pa.array(x, pa.float64())], names=["label", "a"])


def classify(df: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted, passages) for every row; passages are first:end in words, comma-joined."""
    model = train(df, labels)
    own = df.select("doc_id", "text")

    def work(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = model.weights[0]
        for b in rows:
            x, spans = np.zeros(b.num_rows), []
            for i, t in enumerate(b.column(1)):
                found = model.passages(t.as_py())[1]
                x[i] = math.log1p(model.statistic(found))
                spans.append(",".join(f"{a}:{e}" for a, e, s in found if s > 0))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sigmoid(x * weight + model.offset), pa.float64()), pa.array(spans, pa.string())], names=["doc_id", "score", "passages"])

    scored = own.mapInArrow(work, f"doc_id {own.schema['doc_id'].dataType.simpleString()}, score double, passages string")
    held = F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "passages")
