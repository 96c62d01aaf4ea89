"""Periodic run detection: stretches of words that repeat with a short period.

A run is a stretch ``[s, e)`` of a document's words with smallest period q
(words q apart are identical) that no neighbouring word extends, of length
``e - s >= max(LEAST, FOLD * q)``. Such runs are exactly the maximal pairs of
the word sequence whose distance is small against their length: a pair of
equal stretches ``[i, i+l)`` and ``[j, j+l)`` that no word on either side
extends is, with ``p = j - i``, the stretch ``[i, j+l)`` of period p, and the
condition on its length reads ``l + p >= max(LEAST, FOLD * p)``. Nothing is
extended afterwards; the same stretch also turns up at multiples of its
smallest period, so the smallest distance per stretch is kept.

The pairs come from the suffix array (prefix doubling) with its longest common
prefixes: the intervals of the LCP array are visited bottom-up, and each holds
its positions as lists by the word to their left. Where two subintervals meet
at length l, positions of one are looked up in the lists of the other under
another left word, at most ``l // (FOLD - 1)`` words away.

Documents are handled side by side as arrays; the loop over intervals only
visits groups whose closest positions are near enough to hold a pair. A
document is worked on in one task, with memory in proportion to its words.
Word numbers are exact: words are compared as bytes, never by a hash.

Defined results: null, empty and blank texts have no words and no runs; every
row is judged by itself, repeated rows and null ids included; an empty table
gives an empty result; only the id and text columns are read, whatever further
columns are called.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sigflow.llm.common import column
from sigflow.llm.kernels import binary_column, ranges, slices, text_buffer, word_bounds

LEAST, FOLD = 6, 4
# Text bytes worked on at a time; a longer document stands alone.
SLICE = 4 << 20

_RUN = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))
SCHEMA = "doc_id long, n_words long, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"


class Suffixes:
    """Suffix array of many word sequences side by side; suffixes of different rows never compare equal."""

    def __init__(self, words: np.ndarray, rows: np.ndarray, ends: np.ndarray):
        """``words`` are numbers, ``rows`` the row of each, ``ends`` the end of each one's row."""
        self.n, self.ends = len(words), ends
        first = rows.astype(np.int64) * (int(words.max(initial=0)) + 2) + words
        self.levels = [self._dense(first)]  # level t ranks the first 2**t words
        step = 1
        while True:
            rank = self.levels[-1]
            shared = np.bincount(rank)[rank] > 1
            if not shared.any() or step > self.n:
                break
            self.levels.append(self._double(rank, step, shared))
            step *= 2
        self.order = np.argsort(self.levels[-1], kind="stable")

    @staticmethod
    def _dense(keys: np.ndarray) -> np.ndarray:
        order = np.argsort(keys, kind="stable")
        sorted_keys = keys[order]
        rank = np.zeros(len(keys), dtype=np.int32)
        if len(keys):
            new = np.concatenate(([True], sorted_keys[1:] != sorted_keys[:-1]))
            # the rank is the place of the group's first suffix, so finer ranks keep the order
            rank[order] = np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))
        return rank

    def _double(self, rank: np.ndarray, step: int, shared: np.ndarray) -> np.ndarray:
        """Ranks by twice as many words; a suffix with a rank of its own keeps it."""
        at = np.flatnonzero(shared)
        follow = at + step
        inside = follow < self.ends[at]
        second = np.zeros(len(at), dtype=np.int64)
        second[inside] = rank[follow[inside]].astype(np.int64) + 1
        keys = rank[at].astype(np.int64) * (self.n + 1) + second
        order = np.argsort(keys, kind="stable")
        k, r = keys[order], rank[at][order]
        place = np.arange(len(at))
        new = np.concatenate(([True], k[1:] != k[:-1]))
        group = np.concatenate(([True], r[1:] != r[:-1]))
        base = np.maximum.accumulate(np.where(group, place, 0))
        out = rank.copy()
        out[at[order]] = r + np.maximum.accumulate(np.where(new, place, 0)) - base
        return out

    def common(self, a: np.ndarray, b: np.ndarray, least: int) -> np.ndarray:
        """Words that the suffixes at ``a`` and ``b`` have in common from their start;
        0 where that is less than the largest power of two up to ``least``."""
        out = np.zeros(len(a), dtype=np.int64)
        low = min(least.bit_length() - 1, len(self.levels) - 1)
        at = np.flatnonzero(self.levels[low][a] == self.levels[low][b])
        a, b = a[at], b[at]
        for t in range(len(self.levels) - 1, -1, -1):
            inside = np.flatnonzero((a < self.n) & (b < self.n))
            # equal ranks: that many words are there and equal
            same = inside[self.levels[t][a[inside]] == self.levels[t][b[inside]]]
            out[at[same]] += 1 << t
            a[same] += 1 << t
            b[same] += 1 << t
        return out


class Interval:
    """Positions below one LCP interval: all in order, and by the word to their left."""

    __slots__ = ("positions", "by_left")

    def __init__(self, position: int, left: int):
        self.positions, self.by_left = [position], {left: [position]}


def _join(big: Interval, small: Interval, reach: int, left: dict[int, int], found: list, length: int) -> Interval:
    """Unite two subintervals that meet at ``length`` words; pairs with different
    words to the left and a distance of at most ``reach`` are maximal pairs."""
    if len(big.positions) < len(small.positions):
        big, small = small, big
    everything, lists = big.positions, big.by_left
    for x in small.positions:
        lo, hi = bisect_left(everything, x - reach), bisect_right(everything, x + reach)
        if lo == hi:
            continue
        own = left[x]
        if hi - lo <= len(lists):
            near = [y for y in everything[lo:hi] if left[y] != own]
        else:
            near = [
                y for word, at in lists.items() if word != own
                for y in at[bisect_left(at, x - reach) : bisect_right(at, x + reach)]
            ]
        for y in near:
            found.append((x, length, y - x) if x < y else (y, length, x - y))
    for word, at in small.by_left.items():
        have = lists.setdefault(word, [])
        for x in at:
            insort(have, x)
    for x in small.positions:
        insort(everything, x)
    return big


def _pairs_of(positions: list[int], common: list[int], left: list[int], fold: int) -> list[tuple[int, int, int]]:
    """Maximal pairs (start, length, distance) of near positions among suffixes in
    order; ``common[k]`` is the common prefix of suffix k and the one before it."""
    found: list[tuple[int, int, int]] = []
    words = dict(zip(positions, left))
    stack, meets = [Interval(positions[0], left[0])], []  # meets[t]: length at which stack[t] and stack[t + 1] meet

    def close(length: int) -> None:
        """Close all intervals that are at least as deep as ``length``."""
        while meets and meets[-1] >= length:
            at, top = meets.pop(), stack.pop()
            stack[-1] = _join(stack[-1], top, at // (fold - 1), words, found, at)

    for position, length, word in zip(positions[1:], common[1:], left[1:]):
        close(length)
        stack.append(Interval(position, word))
        meets.append(length)
    close(0)
    return found


def find_runs(words: np.ndarray, row_sizes: np.ndarray, least: int = LEAST, fold: int = FOLD) -> np.ndarray:
    """Runs of word sequences that lie one after another, as rows (sequence, start,
    length, period) in order; ``words`` are numbers, equal for equal words."""
    n = len(words)
    none = np.zeros((0, 4), dtype=np.int64)
    if n < 2:
        return none
    firsts = np.cumsum(row_sizes) - row_sizes
    rows = np.repeat(np.arange(len(row_sizes)), row_sizes)
    suffixes = Suffixes(words, rows, np.repeat(firsts + row_sizes, row_sizes))
    order = suffixes.order.astype(np.int64)
    # a pair's length l and distance p: l >= (fold - 1) * p and l + p >= least
    shortest = min(max((fold - 1) * p, least - p) for p in range(1, least + 1))
    common = np.concatenate(([0], suffixes.common(order[1:], order[:-1], shortest)))
    cuts = np.flatnonzero(common < shortest)  # groups of suffixes that share that many words
    sizes = np.diff(np.concatenate((cuts, [n])))
    group = np.repeat(np.arange(len(cuts)), sizes)
    # only groups whose closest positions are near enough for their longest common prefix
    inner = np.where(common >= shortest, common, 0)
    deepest = np.maximum.reduceat(inner, cuts)
    by_place = np.lexsort((order, group))
    gaps = np.full(n, n, dtype=np.int64)
    same = group[by_place][1:] == group[by_place][:-1]
    gaps[1:][same] = np.diff(order[by_place])[same]
    closest = np.minimum.reduceat(gaps, cuts)
    live = np.flatnonzero((sizes > 1) & (closest <= deepest // (fold - 1)))
    left = np.concatenate(([-1], words[:-1])).astype(np.int64)
    left[firsts[row_sizes > 0]] = -1  # the first word of a sequence has nothing to its left
    found: list[tuple[int, int, int]] = []
    for g in live:
        a, b = cuts[g], cuts[g] + sizes[g]
        at = order[a:b]
        found += _pairs_of(at.tolist(), common[a:b].tolist(), left[at].tolist(), fold)
    if not found:
        return none
    pairs = np.unique(np.array(found, dtype=np.int64), axis=0)
    start, length, period = pairs[:, 0], pairs[:, 1] + pairs[:, 2], pairs[:, 2]
    long_enough = length >= np.maximum(least, fold * period)
    start, length, period = start[long_enough], length[long_enough], period[long_enough]
    row = rows[start]
    start = start - firsts[row]
    in_order = np.lexsort((period, length, start, row))
    runs = np.stack((row, start, length, period), axis=1)[in_order]
    if not len(runs):
        return none
    # the same stretch at a multiple of its smallest period
    first = np.concatenate(([True], (runs[1:, :3] != runs[:-1, :3]).any(axis=1)))
    runs = runs[first]
    return runs[np.lexsort((runs[:, 3], runs[:, 1], runs[:, 0]))]


def _planted(n: int, doc_id: int | None) -> tuple[int, int] | None:
    """Start and period from which the words of a document repeat, or None."""
    if doc_id is None or n == 0:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def _detect(least: int, fold: int, planted: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offsets = text_buffer(batch.column(1))
            ids = batch.column(0).to_pylist()
            for i, j in slices(offsets, SLICE):
                yield part(ids[i:j], buf[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])

    def part(ids: list, buf: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
        starts, ends, rows = word_bounds(buf, offsets[:-1])
        sizes = np.bincount(rows, minlength=len(ids)).astype(np.int64)
        firsts = np.cumsum(sizes) - sizes
        # the word that stands at each place
        source = np.arange(len(starts), dtype=np.int64)
        if planted:
            for k, (doc_id, n) in enumerate(zip(ids, sizes.tolist())):
                if at := _planted(n, doc_id):
                    a, p = at
                    source[firsts[k] + a : firsts[k] + n] = firsts[k] + a + np.arange(n - a) % p
        numbers = binary_column(buf, starts, ends).dictionary_encode().indices.to_numpy(zero_copy_only=False)
        runs = find_runs(numbers[source].astype(np.int64), sizes, least, fold)
        row, start, length, period = runs.T if len(runs) else np.zeros((4, 0), dtype=np.int64)
        dropped = np.zeros(len(starts) + 1, dtype=np.int64)
        np.add.at(dropped, firsts[row] + start + period, 1)
        np.add.at(dropped, firsts[row] + start + length, -1)
        kept = np.flatnonzero(np.cumsum(dropped[:-1]) == 0)
        texts = _texts(buf, starts[source[kept]], ends[source[kept]], np.bincount(rows[kept], minlength=len(ids)))
        bounds = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=len(ids))))).astype(np.int32)
        fields = [pa.array(x, pa.int64()) for x in (start, length, period)]
        listed = pa.ListArray.from_arrays(pa.array(bounds), pa.StructArray.from_arrays(fields, fields=list(_RUN.value_type)))
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(sizes), listed, texts], names=["doc_id", "n_words", "runs", "collapsed"]
        )

    return run


def _texts(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """The words of each row joined by one space."""
    lengths = (ends - starts) + 1  # each word and the space after it
    joined = np.full(int(lengths.sum()), 0x20, dtype=np.uint8)
    at = np.cumsum(lengths) - lengths
    joined[ranges(at, ends - starts)] = buf[ranges(starts, ends - starts)]
    bounds = np.concatenate(([0], np.cumsum(lengths)))[np.concatenate(([0], np.cumsum(sizes)))]
    first, last = bounds[:-1], bounds[1:] - (sizes > 0)  # without the last space
    return binary_column(joined, first, last).cast(pa.string())


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    least: int = LEAST, fold: int = FOLD, planted: bool = False,
) -> DataFrame:
    """Per document: doc_id, n_words, its runs in order of start and period (structs
    start, length, period: word numbers) and ``collapsed``, its words without
    those that a run holds after its first period, joined by one space.

    A run has at least ``least`` words and ``fold`` periods. With ``planted``
    the words of every tenth document (by the checksum of its id) repeat from
    some word on before runs are looked for, which gives known long runs.
    """
    slim = docs.select(column(docs, id_col).cast("long").alias("doc_id"), column(docs, text_col).cast("string").alias("text"))
    return slim.mapInArrow(_detect(least, fold, planted), SCHEMA)

