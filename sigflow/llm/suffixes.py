"""Suffix-array dedup by a hash-compared suffix sort.

Documents are UTF-8 bytes. Winnowed anchors (``repeats``) bring together the
spans that can share 50 bytes; suffixes of spans that hold the same anchor at
the same distance, and whose 50 bytes another one of them has by hash, are
sorted by merge sort. Two suffixes are compared
through their longest common extension, found by binary search over prefix
polynomial hashes, so a comparison costs a logarithmic number of probes. All
merges of a round run at once as array operations. Neighbours in sorted
order that agree on 50 bytes by hash are verified byte by byte; if a hash
ever lies, that group is sorted again by its bytes.

Defined results: null or empty texts have no bytes; texts under 50 bytes lose
none; repeated rows, null ids and ids with several texts: see
``repeats.remove_repeats``; an empty table gives an empty result; only the id
and text columns are read, whatever further columns are called.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigflow.llm import kernels as K
from sigflow.llm.repeats import Scheme, Spans, remove_repeats

BYTES = 50
GRAM = 16


def scheme(length: int = BYTES, gram: int = GRAM) -> Scheme:
    return Scheme("bytes", length, min(gram, length), cross_document=True)


class Suffixes:
    """Suffixes of one buffer, each cut after ``length`` bytes."""

    def __init__(self, buf: np.ndarray, length: int, prefix: np.ndarray | None = None):
        self.buf, self.length = buf, length
        self.prefix = K.prefix_hash(buf) if prefix is None else prefix
        self.inverse = K.powers(K._INVERSE, len(buf) + 1)

    def _agree(self, a: np.ndarray, b: np.ndarray, n: np.ndarray | int) -> np.ndarray:
        p = self.prefix
        return (p[a + n] - p[a]) * self.inverse[a] == (p[b + n] - p[b]) * self.inverse[b]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common extension, at most ``length``, by binary search over hashes."""
        out = np.full(len(a), self.length, dtype=np.int64)
        open_ = np.flatnonzero(~self._agree(a, b, self.length))
        if len(open_):
            a, b = a[open_], b[open_]
            low, high = np.zeros(len(a), dtype=np.int64), np.full(len(a), self.length - 1, dtype=np.int64)
            while True:
                mid = (low + high + 1) >> 1
                yes = self._agree(a, b, mid)
                low, high = np.where(yes, mid, low), np.where(yes, high, mid - 1)
                if not (low < high).any():
                    break
            out[open_] = low
        return out

    def before(self, a: np.ndarray, b: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        """Whether suffix a sorts before b, or, where asked, equal to it."""
        n = self.common(a, b)
        tie = n >= self.length
        n = np.where(tie, 0, n)
        return np.where(tie, or_equal, self.buf[a + n] < self.buf[b + n])

    def sort(self, pos: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Order of the suffixes within their groups (``group`` sorted): bottom-up merge sort."""
        edges = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        size = np.diff(np.append(edges, len(group)))
        order = np.arange(len(pos))
        run = 1
        while run < size.max(initial=0):
            big = size > run
            at = K.ranges(edges[big], size[big])  # all places in groups that still hold several runs
            base, m = np.repeat(edges[big], size[big]), np.repeat(size[big], size[big])
            k = at - base
            block, right = k // (2 * run) * (2 * run), (k // run) % 2 == 1
            low = np.where(right, block, np.minimum(block + run, m))
            high = np.where(right, block + run, np.minimum(block + 2 * run, m))
            start = low.copy()
            mine = pos[order[at]]
            open_ = np.flatnonzero(low < high)
            while len(open_):
                mid = (low[open_] + high[open_]) >> 1
                other = pos[order[base[open_] + mid]]
                # how many of the sibling run come before: ties go to the left run
                go = self.before(other, mine[open_], right[open_])
                low[open_] = np.where(go, mid + 1, low[open_])
                high[open_] = np.where(go, high[open_], mid)
                open_ = open_[low[open_] < high[open_]]
            own = k - np.where(right, block + run, block)
            merged = order.copy()
            merged[base + block + own + (low - start)] = order[at]
            order = merged
            run *= 2
        return order

    def equal_neighbours(self, pos: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Order, and for each place whether its suffix equals the one before it, verified by bytes."""
        order = self.sort(pos, group)
        p = pos[order]
        same = np.concatenate(([False], (group[1:] == group[:-1]) & self._agree(p[1:], p[:-1], self.length)))
        at = np.flatnonzero(same)
        step = np.arange(self.length)
        lies = np.zeros(len(at), dtype=bool)
        for i in range(0, len(at), 1 << 16):
            x = at[i : i + (1 << 16)]
            lies[i : i + len(x)] = (self.buf[p[x][:, None] + step] != self.buf[p[x - 1][:, None] + step]).any(axis=1)
        if lies.any():  # sort the groups concerned by their bytes
            for g in np.unique(group[at[lies]]):
                place = np.flatnonzero(group == g)
                text = [self.buf[i : i + self.length].tobytes() for i in pos[place]]
                by = sorted(range(len(place)), key=text.__getitem__)
                order[place] = place[by]
                same[place] = [False] + [text[x] == text[y] for x, y in zip(by, by[1:])]
        return order, same


def _repeated(h: np.ndarray) -> np.ndarray:
    """Places of the values that occur more than once."""
    bits = max(1, (4 * len(h) - 1).bit_length())
    slot = (h >> K.U(64 - bits)).astype(np.int64)
    at = np.flatnonzero(np.bincount(slot, minlength=1 << bits)[slot] > 1)  # most others go here, without a sort
    order = np.argsort(h[at])
    x = h[at][order]
    next_ = np.concatenate((x[1:] == x[:-1], [False])) if len(x) else np.zeros(0, dtype=bool)
    return np.sort(at[order[next_ | np.roll(next_, 1)]])


def sort_suffixes(s: Scheme, x: Spans) -> tuple[np.ndarray, np.ndarray]:
    """Windows of the spans that also start in a document with a smaller id."""
    windows = np.diff(x.offs) - s.length + 1
    row = np.repeat(np.arange(len(windows)), windows)
    window = K.ranges(np.zeros(len(windows), dtype=np.int64), windows)
    key = (x.group[row].astype(np.int64) << 32) + (x.off[row] - window + s.length)
    prefix = K.prefix_hash(x.buf)
    matched = _repeated(K.gram_hash(prefix, s.length)[x.offs[row] + window] ^ K.mix(key.astype(K.U)))
    row, window, key = row[matched], window[matched], key[matched]
    if len(key) == 0:
        return row, window
    order = np.argsort(key, kind="stable")
    row, window, key = row[order], window[order], key[order]
    place, same = Suffixes(x.buf, s.length, prefix).equal_neighbours(x.offs[row] + window, key)
    number = np.cumsum(~same) - 1
    d = x.d[row[place]]
    least = np.full(number[-1] + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, number, d)
    later = place[d > least[number]]
    return row[later], window[later]


def repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = BYTES) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans (long) and the kept bytes."""
    out = remove_repeats(docs, scheme(length), sort_suffixes, id_col, text_col)
    return out.select(F.col("row.c0").alias("doc_id"), F.col("n_units").alias("n_bytes"), "n_removed", "n_spans", "kept")
