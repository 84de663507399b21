"""Periodic runs of words in each text, by Crochemore's partition refinement over a whole batch of texts.

At length l, positions are in one class if the l words from them on are equal. Length l + 1 follows by splitting
classes by where their members' successors went; only the smaller parts of the last split act as splitters and only
smaller parts move, so a text of n words takes O(n log n) moves in all. Members of a class are linked in order of
position. Two neighbouring members at distance l, when the length is l, show a square of two equal, primitive halves;
squares of one period from consecutive positions are one run. All texts of a batch are refined together: a step works
on the arrays of all splitters, whichever texts they are in.

A run of at least ``min_length`` words and ``min_exponent`` periods holds every one of its
``gram_width(min_length, min_exponent)`` word windows twice or more. Positions outside repeated windows are therefore in no
run, one sort of window hashes finds them (equal hashes of unlike windows only leave more to refine), and the stretches
between them are refined alone. Past the end of a stretch nothing is compared: such positions stay where they are,
and squares that would reach over the end don't count. A stretch is refined up to the longest period that it can hold.

Defined results: null word lists are empty; texts without a run have an empty list and keep all words; repeated rows each have
their runs; a text of any length is worked through whole, in one row's memory; an empty table gives an empty result; other
columns do not matter, whatever their names. In ``query`` a null id means that the text is not rewritten.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import let, words_of

MIN_LENGTH, MIN_EXPONENT = 24, 3
#: Words that are refined at once, and the longest stretch if that is longer.
TOGETHER = 1_000_000
_FAR = np.int64(1) << 60
_ODD = np.uint64(0x9E3779B97F4A7C15)


def gram_width(min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> int:
    """The widest windows that each occur again, one period on or back, in every run that counts."""
    return min_length * (min_exponent - 2) // min_exponent + 1


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64) * _ODD
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, in turn."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def stretches(codes: np.ndarray, bounds: np.ndarray, min_length: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions that may be in a run, and the bounds of their stretches among these positions.

    Repeated until every window left occurs again in its own stretch.
    """
    at = np.arange(len(codes))
    while len(at):
        sizes = np.diff(bounds)
        group = np.repeat(np.arange(len(sizes)), sizes)
        starts = _ranges(bounds[:-1], np.maximum(sizes - width + 1, 0))
        mixed = _mixed(codes[at] + 1)
        total = np.zeros(len(starts), np.uint64)
        for k in range(width):
            total *= _ODD
            total += mixed[starts + k]
        total ^= _mixed(group[starts] + 1)
        order = np.argsort(total)
        same = total[order[1:]] == total[order[:-1]]
        again = np.zeros(len(starts), bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        step = np.zeros(len(at) + 1, np.int32)
        step[: len(at)] += np.bincount(starts[again], minlength=len(at)).astype(np.int32)
        step -= np.bincount(starts[again] + width, minlength=len(at) + 1).astype(np.int32)
        inside = np.flatnonzero(np.cumsum(step[:-1]) > 0)
        new = np.ones(len(inside), bool)
        new[1:] = (np.diff(inside) > 1) | (np.diff(group[inside]) > 0)
        first = np.append(np.flatnonzero(new), len(inside))
        long = np.diff(first) >= min_length
        keep = inside[np.repeat(long, np.diff(first))]
        settled = len(keep) == len(at) and long.sum() == len(sizes)
        at, bounds = at[keep], np.concatenate([[0], np.cumsum(np.diff(first)[long])])
        if settled:
            break
    return at, bounds if len(at) else np.zeros(1, np.int64)


class _Classes:
    """Equal-factor classes of positions, each a range of ``perm``, with its members linked in order of position."""

    def __init__(self, keys: np.ndarray, ends: np.ndarray):
        n = len(keys)
        self.perm = np.argsort(keys, kind="stable")
        ranked = keys[self.perm]
        new = np.ones(n, bool)
        new[1:] = ranked[1:] != ranked[:-1]
        self.count = int(new.sum())
        self.loc, self.of = np.empty(n, np.int64), np.empty(n, np.int64)
        self.loc[self.perm] = np.arange(n)
        self.of[self.perm] = np.cumsum(new) - 1
        # Every new class takes a member from an older one, so there are never more than positions.
        self.start, self.size = np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.start[: self.count] = np.flatnonzero(new)
        self.size[: self.count] = np.diff(np.append(self.start[: self.count], n))
        self.next, self.prev = np.full(n, _FAR), np.full(n, -1)
        linked = ~new[1:]
        self.next[self.perm[:-1][linked]] = self.perm[1:][linked]
        self.prev[self.perm[1:][linked]] = self.perm[:-1][linked]
        self.since = np.ones(n, np.int64)  # the length from which on a position has had its neighbour
        self.ends, self.flag, self.found = ends, np.zeros(n, bool), []

    def largest_of(self, group: np.ndarray) -> np.ndarray:
        """Whether each position is in the (first) largest class of its stretch."""
        own = np.arange(self.count)
        home = group[self.perm[self.start[own]]]
        order = np.lexsort((own, -self.size[own], home))
        big = np.zeros(self.count, bool)
        big[order[np.append(True, np.diff(home[order]) > 0)]] = True
        return big[self.of]

    def told(self, at: np.ndarray, length: int) -> None:
        """Keeps the squares that positions showed at lengths up to ``length``, before their neighbours change."""
        d = self.next[at] - at
        hit = (self.since[at] <= d) & (d <= length) & (at + 2 * d <= self.ends[at])
        self.found.append((at[hit], d[hit]))

    def relink(self, at: np.ndarray, to: np.ndarray, length: int) -> None:
        changed = self.next[at] != to
        at, to = at[changed], to[changed]
        self.told(at, length)
        self.next[at], self.since[at] = to, length + 1

    def split(self, split_at: np.ndarray, by: np.ndarray, length: int) -> np.ndarray:
        """Splits classes by the successors' classes ``by``; all parts but each class's largest move. Returns what moved."""
        order = np.lexsort((split_at, by, self.of[split_at]))
        p, old, by = split_at[order], self.of[split_at[order]], by[order]
        new = np.ones(len(p), bool)
        new[1:] = (old[1:] != old[:-1]) | (by[1:] != by[:-1])
        g = np.flatnonzero(new)
        sizes, owner = np.diff(np.append(g, len(p))), old[g]
        head = np.ones(len(g), bool)
        head[1:] = owner[1:] != owner[:-1]
        h = np.flatnonzero(head)
        classes, most = owner[h], np.maximum.reduceat(sizes, h)
        rest = self.size[classes] - np.add.reduceat(sizes, h)
        # A stretch's last position has no successor; alone, it stays with the largest group.
        alone = (rest == 1) & (self.of[self.ends[p[g[h]]] - 1] == classes)
        nth = np.cumsum(head) - 1
        # What stays: the rest, or else the first of the largest groups.
        stays = np.zeros(len(g), bool)
        largest = np.flatnonzero((sizes == most[nth]) & ((rest < most) | alone)[nth])
        if len(largest):
            stays[largest[np.unique(nth[largest], return_index=True)[1]]] = True
        moved, label = p[np.repeat(~stays, sizes)], np.repeat(np.arange(len(g)), sizes)[np.repeat(~stays, sizes)]
        out = np.flatnonzero((rest > 0) & (rest < most) & ~alone)
        if len(out):
            self.flag[p] = True
            members = self.perm[_ranges(self.start[classes[out]], self.size[classes[out]])]
            owners = np.repeat(len(g) + out, self.size[classes[out]])
            left = ~self.flag[members]
            moved, label = np.concatenate([moved, members[left]]), np.concatenate([label, owners[left]])
            self.flag[p] = False
        if not len(moved):
            return moved
        old = self.of[moved]

        # Take the moved ones out of their classes' links: chains of neighbours that move leave together.
        order = np.lexsort((moved, old))
        m = moved[order]
        cut = self.next[m[:-1]] != m[1:]
        first, last = m[np.append(True, cut)], m[np.append(cut, True)]
        before, after = self.prev[first], self.next[last]
        has = before >= 0
        self.relink(before[has], after[has], length)
        has = after < _FAR
        self.prev[after[has]] = before[has]

        # Move them to the back of their classes' ranges, part by part, and link each part.
        order = np.lexsort((moved, label, old))
        m, old, label = moved[order], old[order], label[order]
        new = np.ones(len(m), bool)
        new[1:] = (label[1:] != label[:-1]) | (old[1:] != old[:-1])
        to = np.full(len(m), _FAR)
        to[:-1][~new[1:]] = m[1:][~new[1:]]
        self.relink(m, to, length)
        self.prev[m[1:][~new[1:]]] = m[:-1][~new[1:]]
        self.prev[m[new]] = -1
        head = np.append(True, old[1:] != old[:-1])
        classes = old[head]
        many = np.diff(np.append(np.flatnonzero(head), len(m)))
        back = _ranges(self.start[classes] + self.size[classes] - many, many)
        self.flag[m] = True
        there = self.perm[back]
        stay = there[~self.flag[there]]
        free = self.loc[m]
        free = free[free < np.repeat(self.start[classes] + self.size[classes] - many, many)]
        self.flag[m] = False
        self.perm[free], self.loc[stay] = stay, free
        self.perm[back], self.loc[m] = m, back
        self.size[classes] -= many
        parts = np.flatnonzero(new)
        ids = self.count + np.arange(len(parts))
        self.start[ids], self.size[ids] = back[parts], np.diff(np.append(parts, len(m)))
        self.of[m] = np.repeat(ids, self.size[ids])
        self.count += len(parts)
        return m


def squares(codes: np.ndarray, bounds: np.ndarray, min_exponent: int) -> tuple[np.ndarray, np.ndarray]:
    """Position and period of every primitive square in stretches of words, for periods of at most a stretch's share."""
    sizes = np.diff(bounds)
    group = np.repeat(np.arange(len(sizes)), sizes)
    ends, limit = np.repeat(bounds[1:], sizes), np.repeat(sizes // min_exponent, sizes)
    classes = _Classes(group * (int(codes.max(initial=0)) + 1) + codes, ends)
    begins = np.zeros(len(codes), bool)
    begins[bounds[:-1]] = True
    # Length 1 splits a stretch into its words; all but the commonest are the first splitters.
    length, small = 1, np.flatnonzero(~classes.largest_of(group))
    while len(small):
        small = small[~begins[small]]
        small = small[(classes.size[classes.of[small - 1]] > 1) & (limit[small] > length)]
        if len(small):
            small = classes.split(small - 1, classes.of[small], length)
        length += 1
    classes.told(np.arange(len(codes)), len(codes))
    at, d = (np.concatenate(x) for x in zip(*classes.found, strict=True))
    short = d <= limit[at]
    return at[short], d[short]


def runs_of(codes: np.ndarray, bounds: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of all runs in texts of words (as numbers) between bounds, by start and period."""
    codes = codes.astype(np.int64)
    at, parts = stretches(codes, bounds, min_length, gram_width(min_length, min_exponent))
    found = [np.zeros((3, 0), np.int64)]
    k = 0
    while k < len(parts) - 1:
        to = max(k + 1, int(np.searchsorted(parts, parts[k] + TOGETHER, side="right")) - 1)
        own = at[parts[k] : parts[to]]
        pos, d = squares(codes[own], parts[k : to + 1] - parts[k], min_exponent)
        order = np.lexsort((pos, d))
        pos, d = pos[order], d[order]
        new = np.ones(len(pos), bool)
        new[1:] = (np.diff(pos) != 1) | (np.diff(d) != 0)
        first = np.flatnonzero(new)
        period = d[first]
        length = np.diff(np.append(first, len(pos))) + 2 * period - 1
        ok = (length >= min_length) & (length >= min_exponent * period)
        found.append(np.stack([own[pos[first]][ok], length[ok], period[ok]]))
        k = to
    start, length, period = np.concatenate(found, 1)
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def find_runs(df: DataFrame, words_col: str = "words", carry: tuple[str, ...] = ("doc_id",), min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """``carry``; ``runs``, each text's runs by start and period; ``collapsed``, its words without what a run repeats.

    A run is a stretch with smallest period q and at least ``min_length`` words and ``min_exponent`` periods (2 or more) that no
    neighbouring word extends. Collapsing drops the words of a run after its first q.
    """
    if min_exponent < 2 or min_length < 2:
        raise ValueError("a run has two periods at least")
    own = df.select(*(F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(carry)), F.coalesce(F.col(f"`{words_col}`"), F.array()).cast("array<string>").alias("_words"))
    kind = "array<struct<start: long, length: long, period: long>>"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("_words")
            flat = lists.flatten()
            bounds = lists.offsets.to_numpy().astype(np.int64)
            bounds = bounds - bounds[0]
            codes = flat.dictionary_encode().indices.fill_null(-1).to_numpy()
            start, length, period = runs_of(codes, bounds, min_length, min_exponent)
            row = np.searchsorted(bounds, start, side="right") - 1
            fields = [pa.array(start - bounds[row]), pa.array(length), pa.array(period)]
            runs = pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(len(lists) + 1)), pa.int32()), pa.StructArray.from_arrays(fields, names=["start", "length", "period"]))
            if len(start):
                step = np.bincount(start + period, minlength=len(codes) + 1) - np.bincount(start + length, minlength=len(codes) + 1)
                keep = np.cumsum(step[:-1]) == 0
                flat = flat.filter(pa.array(keep))
                bounds = np.concatenate([[0], np.cumsum(keep)])[bounds]
            lines = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), flat.cast(pa.string())), " ")
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], runs, lines], names=[*b.schema.names[:-1], "runs", "collapsed"])

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in own.schema.fields[:-1])
    return own.mapInArrow(work, f"{kinds}runs {kind}, collapsed string").withColumnsRenamed({f"_c{i}": c for i, c in enumerate(carry)})


def query(docs: DataFrame) -> DataFrame:
    """Runs of every text's words, where one text in ten, by its id, repeats a stretch of its own up to its end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))

    def rewritten(words):
        n, g = F.size(words), F.floor(h / 10)
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
        again = let(F.struct(a.alias("a"), p.alias("p")), lambda s: F.transform(words, lambda w, i: F.when(i < s["a"], w).otherwise(F.get(words, (s["a"] + F.pmod(i - s["a"], s["p"])).cast("int")))))
        return F.when((F.pmod(h, F.lit(10)) == 0) & (n > 0), again).otherwise(words)

    found = find_runs(docs.select("doc_id", let(words_of(F.col("text")), rewritten).alias("words")))
    best = F.aggregate(
        "runs",
        F.lit(None).cast("struct<start: long, length: long, period: long>"),
        lambda b, r: F.when(b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b),
    )
    lines = F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"]))
    told = found.select("doc_id", "runs", "collapsed", best.alias("best"))
    return told.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
