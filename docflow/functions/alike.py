"""Edit distance and matching blocks of two strings, for the Pandas UDFs of ``operators.similarity``.

The edit distance of a text and what is left of it without some characters is the number of these, told in one pass. Otherwise it is
bit-parallel: a column of the dynamic programme is two whole numbers with a bit for each step between
neighbouring cells, up and down, so each character of the shorter text costs a few operations on numbers as long as the longer
text. Matching blocks are those of the longest-block-first rule in which, in a second text of 200 characters or more, characters
that make up over a hundredth of it (and one more) start no block but extend them. Runs of all other characters have numbers by
length, and are looked at by falling length, for all regions at once: no pairs of places are formed.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator

import numpy as np

#: Fixed by the rule: texts with popular characters, and how popular these are.
LONG, SHARE = 200, 100
#: The length that is tried first, as most common runs are short, and the pairs of place and number that are Python objects at a time.
FEW, PAIRS = 4, 1_000_000


def edit_distance(a: str, b: str) -> int:
    """The least number of characters to insert, delete or replace."""
    k, least = 0, min(len(a), len(b))
    while k < least and a[k] == b[k]:
        k += 1
    a, b, least = a[k:], b[k:], least - k
    k = 0
    while k < least and a[-1 - k] == b[-1 - k]:
        k += 1
    a, b = a[: len(a) - k], b[: len(b) - k]
    if len(a) < len(b):
        a, b = b, a
    if not b or _within(b, a):
        return len(a) - len(b)
    places = np.frombuffer(a.encode("utf-32-le", "surrogatepass"), np.uint32)
    bits = {c: int.from_bytes(np.packbits(places == ord(c), bitorder="little").tobytes(), "little") for c in set(b)}
    ones = (1 << len(a)) - 1
    up, down = ones, 0  # steps of the column that go up, and down, by one
    for c in b:
        same = bits[c]
        level = (((same & up) + up) ^ up) | same
        rise, fall = down | (ones & ~(level | up)), up & level
        rise, either = ((rise << 1) | 1) & ones, same | down
        up, down = ((fall << 1) & ones) | (ones & ~(either | rise)), rise & either
    return len(b) + up.bit_count() - down.bit_count()


def _within(short: str, long: str) -> bool:
    """Whether the one text is the other without some characters; then their lengths' difference, which no distance is below, is enough."""
    rest = iter(long)
    return all(c in rest for c in short)


class _Runs:
    """Numbers for all runs of rare characters of two texts: equal numbers of one length mean equal runs.

    Numbers of runs of 1, 2, 4, … characters come from pairs of the length before; those of any length from two that overlap.
    """

    def __init__(self, a: str, b: str):
        codes = np.frombuffer((a + b).encode("utf-32-le", "surrogatepass"), np.uint32)
        n, self.shift = len(a), len(a) + 1
        one, other = codes[:n], codes[n:]
        kinds, counts = np.unique(other, return_counts=True)
        if len(other) >= LONG:
            kinds = kinds[counts <= len(other) // SHARE + 1]
        # A place between the texts, and one after them, that no run goes over.
        number = np.full(n + len(other) + 2, -1, np.int64)
        if len(kinds):
            for start, part in ((0, one), (self.shift, other)):
                at = np.minimum(np.searchsorted(kinds, part), len(kinds) - 1)
                number[start : start + len(part)] = np.where(kinds[at] == part, at, -1)
        self.numbers, self.width = [number], len(number)
        ends = np.flatnonzero(number < 0)
        self.upto = ends[np.searchsorted(ends, np.arange(len(number)))] - np.arange(len(number))

    def of(self, k: int, at: np.ndarray) -> np.ndarray:
        """The numbers of the runs of ``k`` characters at these places, which must have as many."""
        p = k.bit_length() - 1
        while len(self.numbers) <= p:
            half = 1 << len(self.numbers) - 1
            places = np.flatnonzero(self.upto >= 2 * half)
            last, number = self.numbers[-1], np.full(self.width, -1, np.int64)
            number[places] = np.unique(last[places] * self.width + last[places + half], return_inverse=True)[1]
            self.numbers.append(number)
        number = self.numbers[p]
        return number[at] * self.width + number[at + k - (1 << p)] if k > 1 << p else number[at]


def _common(runs: _Runs, k: int, a_places: np.ndarray, b_places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The places where a run of ``k`` starts that the other text has too, with the runs' numbers, for both texts."""
    i, j = a_places[runs.upto[a_places] >= k], b_places[runs.upto[b_places] >= k]
    x, y = runs.of(k, i), runs.of(k, j)
    own, theirs = np.isin(x, y), np.isin(y, x)
    return i[own], x[own], j[theirs], y[theirs]


def matching(a: str, b: str) -> int:
    """The characters in the matching blocks of two texts.

    The longest block of a region is its longest common run of rare characters, the first one in a and then in b, made longer by equal characters
    of any kind. So lengths go down: one pass over the runs of a length, left to right, takes the blocks of all regions; what lies left of a
    block has no run of that length any more, what lies right of it is passed over next. Each place is looked at once for each length.
    """
    runs, total = _Runs(a, b), 0
    regions = [(0, len(a), 0, len(b))] if a and b else []
    a_places, b_places = np.flatnonzero(runs.numbers[0][: len(a)] >= 0), np.flatnonzero(runs.numbers[0] >= 0)
    b_places = b_places[b_places >= runs.shift]
    most = int(min(runs.upto[a_places].max(initial=0), runs.upto[b_places].max(initial=0)))
    while regions and most:
        # The greatest length at which the regions' texts have a common run.
        low, high = 0, most
        while low < high:
            k = (low + high + 1) // 2 if low or high <= FEW else max(1, FEW)
            low, high = (k, high) if len(_common(runs, k, a_places, b_places)[0]) else (low, k - 1)
        if not low:
            break
        i_of, x_of, j_of, y_of = _common(runs, low, a_places, b_places)
        where: dict[int, list[int]] = defaultdict(list)
        for j, y in _listed(j_of - runs.shift, y_of):
            where[y].append(j)
        left, rest = [], iter(regions)
        alo, ahi, blo, bhi = next(rest)
        for i, x in _listed(i_of, x_of):
            while i + low > ahi and ahi >= 0:
                if alo < ahi and blo < bhi:
                    left.append((alo, ahi, blo, bhi))
                alo, ahi, blo, bhi = next(rest, (0, -1, 0, 0))
            if ahi < 0:
                break
            if i < alo:
                continue
            places = where[x]
            s = bisect_left(places, blo)
            if s == len(places) or places[s] + low > bhi:
                continue
            j, ai, bj = places[s], i + low, places[s] + low
            while i > alo and j > blo and a[i - 1] == b[j - 1]:
                i, j = i - 1, j - 1
            while ai < ahi and bj < bhi and a[ai] == b[bj]:
                ai, bj = ai + 1, bj + 1
            total += ai - i
            if alo < i and blo < j:
                left.append((alo, i, blo, j))
            alo, blo = ai, bj
        left += [r for r in ((alo, ahi, blo, bhi), *rest) if r[0] < r[1] and r[2] < r[3]]
        regions, most = left, low - 1
        if most and regions:
            spans = np.array(regions)
            a_places = a_places[_inside(a_places, spans[:, 0], spans[:, 1])]
            b_places = b_places[_inside(b_places - runs.shift, spans[:, 2], spans[:, 3])]
            # A run ends where its region does.
            for places, ends, shift in ((a_places, spans[:, 1], 0), (b_places, spans[:, 3], runs.shift)):
                if len(places):
                    runs.upto[places] = np.minimum(runs.upto[places], ends[np.searchsorted(ends, places - shift, side="right")] + shift - places)
    # Without a common rare character a region has a block where both its texts begin alike.
    for alo, ahi, blo, bhi in regions:
        while alo < ahi and blo < bhi and a[alo] == b[blo]:
            total, alo, blo = total + 1, alo + 1, blo + 1
    return total


def _listed(places: np.ndarray, numbers: np.ndarray) -> Iterator[tuple[int, int]]:
    for at in range(0, len(places), PAIRS):
        yield from zip(places[at : at + PAIRS].tolist(), numbers[at : at + PAIRS].tolist(), strict=True)


def _inside(places: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which places lie in one of the spans; spans ascend and don't overlap."""
    at = np.searchsorted(starts, places, side="right") - 1
    return (at >= 0) & (places < ends[np.maximum(at, 0)])


def block_ratio(a: str, b: str) -> float:
    """Twice the matching characters over all; 1 for two empty texts."""
    return 2 * matching(a, b) / (len(a) + len(b)) if a or b else 1.0
