"""Repeated windows across a corpus: the part the two substring operators share.

A *window* is ``length`` consecutive units (bytes or words) of one document.
The job finds, for every window, whether the same window also starts earlier:

1. ``scan``: every window selects one of its grams by winnowing, a function
   of the window's content alone. Only the selected grams (*anchors*, about
   2 in ``width + 1`` positions) travel: packed per batch and hash bin.
2. ``match``: a bin holds every copy of its anchors, so an anchor that occurs
   once is dropped; most of a corpus ends here. Copies within one batch are
   already known to be shared, and only one of them travels by its hash.
3. ``cut``: per document, the shared anchors give *spans*: the run of windows
   that select the anchor. Equal spans met in one task are resolved there:
   all but the earliest are repeats whole. Only the others travel on, packed
   by a hash of their anchor. An anchor with very many occurrences (a line that a third of the
   rows hold) would put all its contexts into one task, so its windows travel
   one by one, each by its own content.
4. ``resolve``: an operator-specific step decides the windows of the spans
   that share an anchor. Results are intervals per document.
5. ``finish``: documents and their intervals meet and the intervals are cut.

Documents are exchanged once, by a bin of their id; steps 3 and 5 read the
same exchange. No step holds more than one shuffle partition, emits pairs or
sends anything but the bounded list of very frequent anchors to the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigflow.llm import kernels as K
from sigflow.llm.common import column, shuffle_width
from sigflow.session import ensure_checkpoint_dir

# Rows are hashed in slices of about this many bytes; it bounds the arrays, not the texts.
SLICE_BYTES = 1 << 18
# Anchors of about so many bytes of text are sorted together, spans of about so many bytes compared together.
SCAN_BYTES = 1 << 23
COMPARE_BYTES = 1 << 21
# Anchors are handled window by window from this many occurrences on ...
HOT_LEAST = 4096
# ... or from this share of all anchors, so at most this many are named to all tasks.
HOT_MOST = 100_000
NO_ID = (1 << 63) - 1
# Within a bin, 40 bits of the hash tell anchors apart; a false match only adds a candidate.
SHIFT = 24


@dataclass(frozen=True)
class Scheme:
    """Windows of ``length`` units, found by anchors of ``gram`` units.

    ``cross_document``: only a document with a smaller id counts as earlier;
    otherwise an earlier start in the same document does too.
    """

    unit: str
    length: int
    gram: int
    cross_document: bool

    @property
    def width(self) -> int:
        return self.length - self.gram + 1


@dataclass
class Runs:
    """Runs of windows that select one anchor; positions in units of the row, b0:b1 in bytes of the buffer."""

    row: np.ndarray
    first: np.ndarray
    last: np.ndarray
    anchor: np.ndarray
    h: np.ndarray
    b0: np.ndarray
    b1: np.ndarray

    def take(self, index) -> Runs:
        return Runs(*(getattr(self, f)[index] for f in self.__dataclass_fields__))


def _split_runs(owner: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    key = np.where(valid, owner, -1)
    change = np.flatnonzero(key[1:] != key[:-1]) + 1
    first = np.concatenate(([0], change))
    last = np.concatenate((change - 1, [len(key) - 1]))
    keep = key[first] >= 0
    return first[keep], last[keep], key[first][keep]


def _byte_runs(s: Scheme, seg: np.ndarray, row_starts: np.ndarray, row0: int, at: int, rel: int) -> Iterator[Runs]:
    grams = K.gram_hash(K.prefix_hash(seg), s.gram)
    owner = K.winnow(grams, s.width)
    if len(owner) == 0:
        return
    row = np.repeat(np.arange(len(row_starts)), np.diff(np.append(row_starts, len(seg))))
    valid = row[: len(owner)] == row[s.length - 1 : s.length - 1 + len(owner)]
    first, last, a = _split_runs(owner, valid)
    r = row[first]
    base = row_starts[r] - rel
    yield Runs(r + row0, first - base, last - base, a - base, grams[a], first + at, last + s.length + at)


def _word_runs(s: Scheme, seg: np.ndarray, row_starts: np.ndarray, row0: int, at: int) -> Iterator[Runs]:
    starts, ends, row = K.word_bounds(seg, row_starts)
    grams = K.sequence_hash(K.range_hash(K.prefix_hash(seg), starts, ends), s.gram)
    owner = K.winnow(grams, s.width)
    if len(owner) == 0:
        return
    valid = row[: len(owner)] == row[s.length - 1 : s.length - 1 + len(owner)]
    first, last, a = _split_runs(owner, valid)
    r = row[first]
    base = np.searchsorted(row, np.arange(len(row_starts)))[r]
    yield Runs(
        r + row0, first - base, last - base, a - base, grams[a], starts[first] + at, ends[last + s.length - 1] + at
    )


def runs_of(s: Scheme, buf: np.ndarray, offsets: np.ndarray) -> Iterator[Runs]:
    """Runs of all rows. A row's runs do not depend on the rows it is batched with."""
    for i, j in K.slices(offsets, SLICE_BYTES):
        lo, hi = int(offsets[i]), int(offsets[j])
        if s.unit == "words":
            yield from _word_runs(s, buf[lo:hi], offsets[i:j] - lo, i, lo)
        elif hi - lo <= 2 * SLICE_BYTES:
            yield from _byte_runs(s, buf[lo:hi], offsets[i:j] - lo, i, lo, 0)
        else:  # one long row: pieces that overlap by a window less one byte
            for x in range(0, hi - lo - s.length + 1, SLICE_BYTES):
                piece = buf[lo + x : min(hi, lo + x + SLICE_BYTES + s.length - 1)]
                yield from _byte_runs(s, piece, np.zeros(1, dtype=np.int64), i, lo + x, x)


def _all_runs(s: Scheme, buf: np.ndarray, offsets: np.ndarray) -> Runs:
    parts = list(runs_of(s, buf, offsets))
    if not parts:
        z = np.zeros(0, dtype=np.int64)
        return Runs(z, z, z, z, z.astype(K.U), z, z)
    return Runs(*(np.concatenate([getattr(p, f) for p in parts]) for f in Runs.__dataclass_fields__))


# --- packed rows ----------------------------------------------------------------------

PACKED = "bin int, kind int, n long, data binary"
_PACKED = pa.schema([("bin", pa.int32()), ("kind", pa.int32()), ("n", pa.int64()), ("data", pa.binary())])
ANCHORS, SHARED, FREQUENT = 0, 1, 2


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays one after another, the row count first; the first ids as differences, which compress."""
    return np.array([len(arrays[0])], dtype=np.int64).tobytes() + b"".join(a.tobytes() for a in arrays)


def _unpack(data: bytes, *types: str) -> list[np.ndarray]:
    n, at, out = int(np.frombuffer(data, dtype=np.int64, count=1)[0]), 8, []
    for t in types:
        out.append(np.frombuffer(data, dtype=t, count=n, offset=at))
        at += out[-1].nbytes
    return out


def _delta(x: np.ndarray) -> np.ndarray:
    return np.diff(x, prepend=x.dtype.type(0))


def _packed_batch(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[]] * len(_PACKED)
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(cols, _PACKED)], schema=_PACKED)


def _positions(doc: np.ndarray, pos: np.ndarray, bins: int) -> Iterator[tuple[int, int, int, bytes]]:
    """Positions packed by document bin."""
    of = doc % bins
    order = np.lexsort((pos, doc, of))
    of, doc, pos = of[order], doc[order], pos[order]
    edges = np.flatnonzero(np.diff(of, prepend=-1))
    for a, b in zip(edges, [*edges[1:], len(of)]):
        yield int(of[a]), SHARED, int(b - a), _pack(_delta(doc[a:b]), pos[a:b].astype("<i4"))


def _prime(n: int) -> int:
    while any(n % p == 0 for p in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def _scan(s: Scheme, bins: int, doc_bins: int):
    """Anchors of every document, packed by anchor bin; those shared within the batch by document bin."""

    def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for batch in batches:
            doc = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            buf, offs = K.text_buffer(batch.column(1))
            for i, j in K.slices(offs, SCAN_BYTES):
                yield doc[i:j], buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc, buf, offs in pieces(batches):
            runs = _all_runs(s, buf, offs)
            order = np.argsort(runs.h, kind="stable")
            h, d, pos = runs.h[order], doc[runs.row[order]], runs.anchor[order].astype(np.int32)
            if len(h) == 0:
                continue
            edges = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
            size = np.diff(np.append(edges, len(h)))
            if s.cross_document:
                shared = np.minimum.reduceat(d, edges) != np.maximum.reduceat(d, edges)
            else:
                shared = size > 1
            lead = np.zeros(len(h), dtype=bool)
            lead[edges] = True
            known = np.repeat(shared, size) & ~lead
            count = np.where(np.repeat(shared, size) & lead, np.repeat(size, size), 1).astype("<u4")
            rows = list(_positions(d[known], pos[known], doc_bins))
            h, d, pos, count = h[~known], d[~known], pos[~known], count[~known]
            of = (h % K.U(bins)).astype(np.int64)
            order = np.lexsort((pos, d, of))
            of, h, d, pos, count = of[order], h[order], d[order], pos[order], count[order]
            edges = np.flatnonzero(np.diff(of, prepend=-1))
            for a, b in zip(edges, [*edges[1:], len(of)]):
                top = h[a:b] >> K.U(SHIFT)
                rows.append((int(of[a]), ANCHORS, int(b - a), _pack(
                    (top >> K.U(8)).astype("<u4"), (top & K.U(0xFF)).astype("u1"), _delta(d[a:b]), _delta(pos[a:b]),
                    count[a:b])))
            yield _packed_batch(rows)

    return run


def _match(s: Scheme, doc_bins: int):
    """Anchors of a hash bin that occur more than once, as positions by document bin."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = []
        for batch in batches:
            passed = []
            for b, kind, n, data in zip(*(c.to_pylist() for c in batch.columns)):
                if kind == ANCHORS:
                    hi, lo, d, pos, count = _unpack(data, "<u4", "u1", "<i8", "<i4", "<u4")
                    h = (hi.astype(K.U) << K.U(8)) | lo
                    parts.append((np.full(len(h), b, dtype=np.int32), h, np.cumsum(d), np.cumsum(pos, dtype=np.int32), count))
                else:
                    passed.append((b, kind, n, data))
            if passed:
                yield _packed_batch(passed)
        if not parts:
            return
        b, h, d, pos, count = (np.concatenate(x) for x in zip(*parts))
        del parts
        order = np.lexsort((h, b))
        b, h, d, pos, count = b[order], h[order], d[order], pos[order], count[order].astype(np.int64)
        edges = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (b[1:] != b[:-1]))))
        size = np.diff(np.append(edges, len(h)))
        total = np.add.reduceat(count, edges)
        if s.cross_document:  # a count over 1 stands for several documents
            shared = (np.minimum.reduceat(d, edges) != np.maximum.reduceat(d, edges)) | (
                np.maximum.reduceat(count, edges) > 1
            )
        else:
            shared = total > 1
        keep = np.repeat(shared, size)
        rows = list(_positions(d[keep], pos[keep].astype(np.int64), doc_bins))
        much = shared & (total >= HOT_LEAST)
        for x, y, n in zip(h[edges][much], b[edges][much], total[much].tolist()):
            rows.append((int(y), FREQUENT, n, x.tobytes()))
        del b, h, d, pos, count, order, keep
        yield _packed_batch(rows)
        K.release()

    return run


# --- spans ----------------------------------------------------------------------------

SPAN, DONE = 0, 1


def _canonical(s: Scheme, raw: bytes) -> bytes:
    return b" ".join(raw.split()) if s.unit == "words" else raw


def _spans_of_run(s: Scheme, raw: bytes, first: int, last: int, hot: bool) -> Iterator[tuple[bytes, int, int]]:
    """(content, first window, last window) of a run: whole, or window by window for a frequent anchor."""
    if not hot:
        yield _canonical(s, raw), first, last
    elif s.unit == "words":
        words = raw.split()
        for t in range(last - first + 1):
            yield b" ".join(words[t : t + s.length]), first + t, first + t
    else:
        for t in range(last - first + 1):
            yield raw[t : t + s.length], first + t, first + t


def _row_order(ids: np.ndarray, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows by id, and each row's number among those of its id (by content, so it is the same in every step)."""
    order = np.argsort(ids, kind="stable")
    rank = np.zeros(len(ids), dtype=np.int32)
    same = ids[order][1:] == ids[order][:-1]
    if same.any():
        repeated = np.unique(ids[order][1:][same])
        content = np.zeros(len(ids), dtype=K.U)
        for i in np.flatnonzero(np.isin(ids, repeated)).tolist():
            content[i] = xxhash.xxh64_intdigest(buf[offs[i] : offs[i + 1]].tobytes())
        order = np.lexsort((content, ids))
        new = np.concatenate(([True], ids[order][1:] != ids[order][:-1]))
        at = np.arange(len(ids))
        rank[order] = at - np.maximum.accumulate(np.where(new, at, 0))
    return order, rank


def _pack_cuts(d: np.ndarray, rank: np.ndarray, a: np.ndarray, b: np.ndarray) -> bytes:
    return _pack(d.astype("<i8"), rank.astype("<i4"), a.astype("<i4"), b.astype("<i4"))


def _unpack_cuts(data: bytes) -> list[np.ndarray]:
    return _unpack(data, "<i8", "<i4", "<i4", "<i4")


def _key_type(s: Scheme) -> str:
    """Bytes are compared whole, anchor included, so there a short key will do: a false match only costs time."""
    return "<u8" if s.unit == "words" else "<u4"


def _pack_spans(s: Scheme, squeeze, key, d, rank, off, places: list[list[int]], content: list[bytes]) -> bytes:
    """Spans packed and compressed by ``squeeze``: their text repeats words a lot."""
    body = _pack(
        key.astype(_key_type(s)), _delta(d.astype("<i8")), rank.astype("<i4"), off.astype("<i4"),
        np.array([len(p) for p in places], dtype="<i4"), np.array([len(c) for c in content], dtype="<i4"),
    )
    flat = np.array([x for p in places for x in p], dtype="<i4").tobytes()
    return squeeze(body + flat + b"".join(content))


def _unpack_spans(s: Scheme, span_bin: int, data: bytes) -> tuple[np.ndarray, ...]:
    """key, d, rank, off, number of places, lengths, places, content."""
    data = zstandard.ZstdDecompressor().decompress(data)
    key, d, rank, off, n_places, length = _unpack(data, _key_type(s), "<i8", "<i4", "<i4", "<i4", "<i4")
    at = 8 + key.nbytes + len(key) * 24
    if key.itemsize < 8:  # such keys only differ within their bin
        key = key.astype(K.U) | K.U(span_bin << 32)
    places = np.frombuffer(data, dtype="<i4", count=int(n_places.sum()), offset=at)
    content = np.frombuffer(data, dtype=np.uint8, offset=at + places.nbytes)
    return key, np.cumsum(d), rank, off, n_places, length, places, content


def _frequent(h: np.ndarray, names: np.ndarray, anchor_bins: int) -> np.ndarray:
    """Which anchors are among the frequent ones, ``names`` being pairs of the hash's top and the bin, sorted."""
    if not len(names) or not len(h):
        return np.zeros(len(h), dtype=bool)
    name = np.empty(len(h), dtype=names.dtype)
    name["top"], name["bin"] = h >> K.U(SHIFT), h % K.U(anchor_bins)
    at = np.searchsorted(names["top"], name["top"])
    out = np.zeros(len(h), dtype=bool)
    open_ = np.flatnonzero(at < len(names))
    while len(open_):  # names of one top and several bins stand side by side
        top, mine = names["top"][at[open_]], name["top"][open_]
        out[open_] |= (top == mine) & (names["bin"][at[open_]] == name["bin"][open_])
        at[open_] += 1
        open_ = open_[(top == mine) & (at[open_] < len(names))]
    return out


def _cut(s: Scheme, frequent: set[tuple[int, int]], anchor_bins: int, bins: int):
    """Spans of one document bin, packed by span bin; see the module text, step 3."""
    names = np.array(sorted(frequent), dtype=[("top", "<u8"), ("bin", "<u8")])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        at = [(np.cumsum(d), p) for d, p in (_unpack(x, "<i8", "<i4") for x in right.column("data").to_pylist())]
        if at and left.num_rows:
            buf, offs = K.text_buffer(left.column("t"))
            ids = left.column("d").to_numpy()
            order, rank = _row_order(ids, buf, offs)
            ids, rank = ids[order], rank[order]
            buf, offs = K.text_buffer(left.column("t").take(pa.array(order)))
            known, number = np.unique(ids, return_inverse=True)
            doc, pos = np.concatenate([x[0] for x in at]), np.concatenate([x[1] for x in at])
            shared = np.unique((np.searchsorted(known, doc).astype(np.int64) << 32) | pos)
            seen: dict[tuple[int, bytes], int] = {}
            rows, keys, offsets, places, content = [], [], [], [], []
            done: list[tuple[int, int, int]] = []
            text = buf.tobytes()
            for runs in runs_of(s, buf, offs):
                mine = (number[runs.row].astype(np.int64) << 32) | runs.anchor
                hit = np.searchsorted(shared, mine)
                runs = runs.take(shared[np.minimum(hit, len(shared) - 1)] == mine)
                often = _frequent(runs.h, names, anchor_bins)
                columns = (runs.row, runs.first, runs.last, runs.anchor, runs.h, runs.b0, runs.b1, often)
                for row, first, last, anchor, h, b0, b1, hot in zip(*(c.tolist() for c in columns)):
                    for data, f, l in _spans_of_run(s, text[b0:b1], first, last, hot):
                        key = (0 if hot else h, data)
                        i = seen.get(key)
                        if i is not None:
                            d0, d = ids[rows[i]], ids[row]
                            if d0 < d or (not s.cross_document and d0 == d and places[i][0] < f):
                                done.append((row, f, l + s.length))
                                continue
                            if rows[i] == row:
                                places[i].append(f)
                                continue
                        seen[key] = len(rows)
                        rows.append(row)
                        keys.append(xxhash.xxh64_intdigest(data) if hot else h)
                        offsets.append(0 if hot else anchor - f)
                        places.append([f])
                        content.append(data)
            if rows:
                row, key, off = np.array(rows), np.array(keys, dtype=K.U), np.array(offsets)
                of = (key >> K.U(32)) % K.U(bins)
                order = np.argsort(of, kind="stable")
                edges = np.flatnonzero(np.diff(of[order].astype(np.int64), prepend=-1))
                squeeze = zstandard.ZstdCompressor(level=3).compress
                for a, b in zip(edges, [*edges[1:], len(of)]):
                    i = order[a:b]
                    part = i.tolist()
                    packed = _pack_spans(
                        s, squeeze, key[i], ids[row[i]], rank[row[i]], off[i], [places[x] for x in part], [content[x] for x in part]
                    )
                    out.append((int(of[i[0]]), SPAN, len(part), packed))
            if done:
                row, a, b = (np.array(x) for x in zip(*done))
                doc_bin = left.column("bin")[0].as_py()
                out.append((doc_bin % bins, DONE, doc_bin, _pack_cuts(ids[row], rank[row], a, b)))
        cols = list(zip(*out)) if out else [[]] * len(_PACKED)
        K.release()
        return pa.table([pa.array(c, t.type) for c, t in zip(cols, _PACKED)], schema=_PACKED)

    return run


CUTS = "bin int, data binary"
_CUTS = pa.schema([("bin", pa.int32()), ("data", pa.binary())])


@dataclass
class Spans:
    """Spans of one shuffle partition, sorted by key: content ``buf[offs[i]:offs[i+1]]``.

    ``group`` numbers the keys, ``off`` is the anchor's place in the span in
    units, ``d`` the document and ``first`` the first place it starts there.
    """

    group: np.ndarray
    d: np.ndarray
    off: np.ndarray
    first: np.ndarray
    buf: np.ndarray
    offs: np.ndarray


# Gives the row and the window number of every window of a span that also starts earlier.
Resolver = Callable[[Scheme, Spans], tuple[np.ndarray, np.ndarray]]


def _equal_spans(s: Scheme, x: Spans) -> tuple[np.ndarray, np.ndarray]:
    """Rows whose whole content also starts earlier, and the rows left to compare.

    Equal hashes are verified byte by byte against the earliest row of that hash.
    """
    size = np.diff(x.offs)
    h = K.range_hash(K.prefix_hash(x.buf), x.offs[:-1], x.offs[1:])
    order = np.lexsort((x.first, x.d, h, x.off, x.group))
    same = np.ones(len(order) - 1, dtype=bool)
    for a in (x.group, x.off, h, size):
        same &= a[order][1:] == a[order][:-1]
    lead = order[np.maximum.accumulate(np.where(np.concatenate(([True], ~same)), np.arange(len(order)), 0))]
    copy = order != lead
    row, lead = order[copy], lead[copy]
    later = x.d[row] > x.d[lead]
    if not s.cross_document:
        later |= (x.d[row] == x.d[lead]) & (x.first[row] > x.first[lead])
    row, lead = row[later], lead[later]
    if len(row):
        differs = x.buf[K.ranges(x.offs[row], size[row])] != x.buf[K.ranges(x.offs[lead], size[lead])]
        at = np.concatenate(([0], np.cumsum(size[row])))[:-1]
        row = row[~np.logical_or.reduceat(differs, at)]
    rest = np.ones(len(order), dtype=bool)
    rest[row] = False
    return row, np.flatnonzero(rest)


def _open_groups(s: Scheme, group: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Mask of rows (sorted by group) whose group can hold an earlier start for some row."""
    edges = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    size = np.diff(np.append(edges, len(group)))
    if s.cross_document:
        several = np.minimum.reduceat(d, edges) != np.maximum.reduceat(d, edges)
    else:
        several = size > 1
    return np.repeat(several, size)


def _later_windows(s: Scheme, resolver: Resolver, x: Spans) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first and last window of the runs of windows that also start earlier."""
    size = np.diff(x.offs)
    if s.unit == "words":
        spaces = np.concatenate(([0], np.cumsum(x.buf == 32)))
        windows = spaces[x.offs[1:]] - spaces[x.offs[:-1]] + 2 - s.length
    else:
        windows = size - s.length + 1
    whole, rest = _equal_spans(s, x)
    found = [(whole, np.zeros(len(whole), dtype=np.int64), windows[whole] - 1)]
    rest = rest[_open_groups(s, x.group[rest], x.d[rest])]
    if len(rest):
        part = Spans(
            x.group[rest], x.d[rest], x.off[rest], x.first[rest], x.buf[K.ranges(x.offs[rest], size[rest])],
            np.concatenate(([0], np.cumsum(size[rest]))),
        )
        row, window = resolver(s, part)
        if len(row):
            order = np.lexsort((window, row))
            row, window = row[order], window[order]
            new = np.concatenate(([True], (row[1:] != row[:-1]) | (window[1:] != window[:-1] + 1)))
            a = np.flatnonzero(new)
            b = np.append(a[1:], len(row)) - 1
            found.append((rest[row[a]], window[a], window[b]))
    row, a, b = (np.concatenate(x) for x in zip(*found))
    return row, a, b


def _resolve(s: Scheme, resolver: Resolver, doc_bins: int):
    """Spans of one shuffle partition to cuts by document bin; see the module text, step 4."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = []
        for batch in batches:
            for span_bin, kind, n, data in zip(*(c.to_pylist() for c in batch.columns)):
                if kind == SPAN:
                    parts.append(_unpack_spans(s, span_bin, data))
                else:
                    yield pa.RecordBatch.from_arrays([pa.array([n], pa.int32()), pa.array([data], pa.binary())], schema=_CUTS)
        if not parts:
            return
        key, d, rank, off, n_places, length, places, content = (np.concatenate(x) for x in zip(*parts))
        del parts
        order = np.lexsort((d, key))
        order = order[_open_groups(s, key[order], d[order])]
        if len(order) == 0:
            return
        at_place = np.concatenate(([0], np.cumsum(n_places)))[:-1]
        at_content = np.concatenate(([0], np.cumsum(length, dtype=np.int64)))[:-1]
        # whole groups at a time, so that the arrays stay small
        volume = np.cumsum(length[order], dtype=np.int64)
        start = np.concatenate(([True], key[order][1:] != key[order][:-1]))
        edges = np.flatnonzero(start)
        part_of = np.concatenate(([0], volume))[edges] // COMPARE_BYTES
        firsts = edges[np.concatenate(([True], part_of[1:] != part_of[:-1]))].tolist()
        found = []
        for i, j in zip(firsts, [*firsts[1:], len(order)]):
            mine = order[i:j]
            size = length[mine].astype(np.int64)
            spans = Spans(
                np.cumsum(start[i:j]) - 1, d[mine], off[mine].astype(np.int64), places[at_place[mine]].astype(np.int64),
                content[K.ranges(at_content[mine], size)], np.concatenate(([0], np.cumsum(size))),
            )
            row, a, b = _later_windows(s, resolver, spans)
            row = mine[row]
            # at every place the span starts in its document
            place = places[K.ranges(at_place[row], n_places[row])]
            row, a, b = (np.repeat(x, n_places[row]) for x in (row, a, b))
            found.append((d[row], rank[row], place + a, place + b + s.length))
        doc, number, a, b = (np.concatenate(x) for x in zip(*found))
        of = doc % doc_bins
        order = np.argsort(of, kind="stable")
        doc, number, a, b, of = doc[order], number[order], a[order], b[order], of[order]
        edges = np.flatnonzero(np.diff(of, prepend=-1))
        data = [_pack_cuts(doc[i:j], number[i:j], a[i:j], b[i:j]) for i, j in zip(edges, [*edges[1:], len(of)])]
        del content, places, found
        yield pa.RecordBatch.from_arrays([pa.array(of[edges].astype(np.int32)), pa.array(data, pa.binary())], schema=_CUTS)
        K.release()

    return run


def merged(pairs: np.ndarray) -> np.ndarray:
    """Overlapping or touching intervals joined; rows ``[start, end)`` in order."""
    if len(pairs) == 0:
        return pairs.reshape(0, 2)
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    end = np.maximum.accumulate(pairs[:, 1])
    new = np.concatenate(([True], pairs[1:, 0] > end[:-1]))
    last = np.append(np.flatnonzero(new)[1:], len(pairs)) - 1
    return np.stack((pairs[new, 0], end[last]), axis=1)


def _remove(s: Scheme, data: bytes, cuts: np.ndarray) -> tuple[int, int, int, bytes]:
    """Units, removed units, removed runs and what is left of one text."""
    units = data.split() if s.unit == "words" else data
    kept, at = [], 0
    for a, b in cuts.tolist():
        kept.append(units[at:a])
        at = b
    kept.append(units[at:])
    left = b" ".join(w for k in kept for w in k) if s.unit == "words" else b"".join(kept)
    return len(units), int((cuts[:, 1] - cuts[:, 0]).sum()), len(cuts), left


def _finish(s: Scheme, schema: pa.Schema, as_is: bool):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        buf, offs = K.text_buffer(left.column("t"))
        ids = left.column("d").to_numpy()
        order, rank = _row_order(ids, buf, offs)
        parts = [_unpack_cuts(x) for x in right.column("data").to_pylist()]
        none = np.zeros((0, 2), dtype=np.int64)
        mine = [none] * len(ids)
        if parts and len(ids):
            d, r, a, b = (np.concatenate(x) for x in zip(*parts))
            by = np.lexsort((r, d))
            d, r, pairs = d[by], r[by], np.stack((a[by], b[by]), axis=1).astype(np.int64)
            edges = np.flatnonzero(np.concatenate(([True], (d[1:] != d[:-1]) | (r[1:] != r[:-1]))))
            row_of = {k: i for i, k in enumerate(zip(ids.tolist(), rank.tolist()))}
            for i, j in zip(edges.tolist(), [*edges[1:].tolist(), len(d)]):
                mine[row_of[(int(d[i]), int(r[i]))]] = merged(pairs[i:j])
        out = []
        for i, cuts in enumerate(mine):
            data = buf[offs[i] : offs[i + 1]].tobytes()
            *counts, kept = _remove(s, data, cuts)
            out.append((*counts, kept if len(cuts) or not as_is else data))
        cols = list(zip(*out)) if out else [[]] * 4
        K.release()
        arrays = [left.column("row").combine_chunks()]
        arrays += [pa.array(c, schema.field(k + 1).type) for k, c in enumerate(cols)]
        return pa.table([a.cast(f.type) for a, f in zip(arrays, schema)], schema=schema)

    return run


def remove_repeats(
    docs: DataFrame, s: Scheme, resolver: Resolver, id_col: str, text_col: str, other: list[str] | None = None,
    as_is: bool = False,
) -> DataFrame:
    """Columns ``row`` (struct ``c0, c1, ...`` of the id and the ``other``
    columns), ``n_units``, ``n_removed``, ``n_spans`` (long) and ``kept``
    (binary; words joined by one space, or the untouched text with ``as_is``
    where nothing is removed).

    Null ids count as one document after all others. Rows repeated with the
    same id and text get the same result each; if one id carries several
    texts, each is judged by itself and equal starts are not "earlier".
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import BinaryType, LongType, StructField, StructType

    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    width = shuffle_width(spark)
    bins = _prime(width + 1)  # of anchors and spans
    doc_bins = _prime(4 * width)  # small enough to hold one, and its spans, in a task
    named = docs.select(
        F.struct(
            column(docs, id_col).alias("c0"),
            *(column(docs, c).alias(f"c{k + 1}") for k, c in enumerate(other or [])),
        ).alias("row"),
        F.coalesce(column(docs, id_col).cast("long"), F.lit(NO_ID)).alias("d"),
        column(docs, text_col).cast("string").alias("t"),
    ).withColumn("bin", F.pmod("d", F.lit(doc_bins)).cast("int"))

    anchors = named.select("d", "t").mapInArrow(_scan(s, bins, doc_bins), PACKED)
    shared = anchors.repartition(width, "bin").mapInArrow(_match(s, doc_bins), PACKED).checkpoint()
    # Which anchors count as frequent only routes work; the most frequent ones are named to all tasks.
    top = shared.filter(f"kind = {FREQUENT}").orderBy(F.desc("n")).limit(HOT_MOST).select("bin", "data").collect()
    frequent = {(int.from_bytes(r.data, "little"), r.bin) for r in top}

    places = shared.filter(f"kind = {SHARED}").select("bin", "data")
    texts = named.select("bin", "d", "t", "row")
    spans = texts.groupBy("bin").cogroup(places.groupBy("bin")).applyInArrow(_cut(s, frequent, bins, bins), PACKED)
    cuts = spans.repartition(width, "bin").mapInArrow(_resolve(s, resolver, doc_bins), CUTS)
    result = StructType([
        named.schema["row"], StructField("n_units", LongType()), StructField("n_removed", LongType()),
        StructField("n_spans", LongType()), StructField("kept", BinaryType()),
    ])
    finish = _finish(s, to_arrow_schema(result), as_is)
    return texts.groupBy("bin").cogroup(cuts.groupBy("bin")).applyInArrow(finish, result)
