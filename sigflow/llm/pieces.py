"""SentencePiece encoding and decoding with seeded merge-dropout.

The model is a byte-fallback BPE. Encoding is the usual agenda: of all
neighbouring symbol pairs that form a piece, the one with the best score is
merged, the leftmost on ties, until none is left. With dropout each candidate
merge is skipped when a keyed hash of (seed, variant, left piece, right
piece, place in the word) falls below the rate: the same key always gives the
same segmentation, another variant another one, and every one decodes to the
same text. The variant is a hash of (seed, document id, place of the word), so
every occurrence of a word draws for each of its merges anew.

No piece joins a blank to a symbol before it, so the stretches between blanks
are encoded by themselves, runs of blanks included. Within a batch all
distinct stretches run their agendas side by side as array operations, one
merge each a round; a skipped candidate stays skipped as its key stays.

Each distinct stretch is encoded once without dropout, and the merges it makes
are kept. An occurrence that skips none of them has the same pieces, as merges
left out that were not made change nothing; the others are encoded one by one.

Defined results: null text encodes to null, empty text to no ids; repeated
rows of one id get the same ids; an empty table gives an empty result;
further columns are left alone.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sigflow.llm import kernels as K
from sigflow.llm.common import column

MARK = "▁"
RATE = 0.1
SEED = 17
CACHE_WORDS = 400_000
# Words up to this many symbols share arrays by length in steps of eight; longer ones run one by one over a heap.
WIDE = 64
BLOCK_WORDS = 1 << 13  # words encoded side by side
ONES = (1 << 64) - 1
BATCH_BYTES = 1 << 22  # of text encoded together, so that a word is looked up once in them

# A run of blanks with what follows it, or at the end alone.
_STRETCH = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class Model:
    """Pieces, scores and byte fallback of a SentencePiece BPE model."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.sp = sp
        n = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(n)]
        ordinary = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.id_of = {pieces[i]: i for i in ordinary}
        self.byte_id = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], dtype=np.int32)
        self.size = n
        # Symbols outside the vocabulary (kept until bytes replace them) are n + their code point.
        self.char_id = np.arange(n, n + 0x110000, dtype=np.int32)
        for piece, i in self.id_of.items():
            if len(piece) == 1:
                self.char_id[ord(piece)] = i
        score = np.array([sp.get_score(i) for i in range(n)])
        self.rank = np.full(n, np.iinfo(np.int32).max, dtype=np.int32)
        # equal scores rank alike: then the leftmost pair wins
        self.rank[ordinary] = np.unique(-score[ordinary], return_inverse=True)[1]
        keys, made = [], []
        symbols = self.id_of
        for piece, i in symbols.items():
            for cut in range(1, len(piece)):
                a, b = symbols.get(piece[:cut]), symbols.get(piece[cut:])
                if a is not None and b is not None:
                    keys.append(a * n + b)
                    made.append(i)
        order = np.argsort(keys, kind="stable")
        self.pair = np.array(keys, dtype=np.int64)[order]
        self.made = np.array(made, dtype=np.int64)[order]
        self._pairs: dict[int, int] = {}
        # the pairs in a hash table of arrays
        self.slots = (1 << max(4, 2 * len(self.pair) - 1).bit_length()) - 1
        self.slot_key = np.full(self.slots + 1, -1, dtype=np.int64)
        self.slot_made = np.zeros(self.slots + 1, dtype=np.int32)
        for key, piece in zip(self.pair.tolist(), self.made.tolist()):
            at = (key * 0x9E3779B1) >> 7 & self.slots
            while self.slot_key[at] >= 0:
                at = (at + 1) & self.slots
            self.slot_key[at], self.slot_made[at] = key, piece

    def pairs(self) -> dict[int, int]:
        """The same table as a dictionary, made when first needed."""
        if not self._pairs:
            self._pairs = dict(zip(self.pair.tolist(), self.made.tolist()))
        return self._pairs

    def join(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Piece made of two neighbours, -1 where there is none."""
        a, b = left.ravel().astype(np.int64), right.ravel().astype(np.int64)
        out = np.full(len(a), -1, dtype=np.int32)
        key = a * self.size + b
        slot = (key * 0x9E3779B1) >> 7 & self.slots
        there = self.slot_key[slot]
        known = (a >= 0) & (a < self.size) & (b >= 0) & (b < self.size)
        hit = (there == key) & known
        out[hit] = self.slot_made[slot[hit]]
        at = np.flatnonzero(known & ~hit & (there >= 0))
        while len(at):  # linear probing
            next_ = (slot[at] + 1) & self.slots
            slot[at] = next_
            there = self.slot_key[next_]
            hit = there == key[at]
            out[at[hit]] = self.slot_made[next_[hit]]
            at = at[~hit & (there >= 0)]
        return out.reshape(left.shape)


_models: dict[str, Model] = {}


def model(path: str) -> Model:
    if path not in _models:
        _models[path] = Model(path)
    return _models[path]


def _dropped(m: Model, left, right, place, variant, seed: int, rate: float) -> np.ndarray:
    """Keyed decision for candidate merges."""
    if rate <= 0:
        return np.zeros(np.broadcast(left, right).shape, dtype=bool)
    return _skipped(_merge_keys(m, left, right, place), variant, seed, rate)


def _merge_keys(m: Model, left, right, place) -> np.ndarray:
    """The part of a merge's key that its variant does not change."""
    u = K.U
    key = (np.asarray(left).astype(u) * u(m.size) + np.asarray(right).astype(u)) * u(0x9E3779B97F4A7C15)
    return K.mix(key + np.asarray(place).astype(u) * u(0xC2B2AE3D27D4EB4F))


def _skipped(keys: np.ndarray, variant, seed: int, rate: float) -> np.ndarray:
    u = K.U
    key = K.mix(keys ^ K.mix(np.asarray(variant).astype(u) * u(0x165667B19E3779F9) + u(seed & ONES)))
    return (key >> u(11)).astype(np.float64) < rate * float(1 << 53)


def encode_words(
    m: Model, words: list[str], variant: np.ndarray, seed: int, rate: float, merges: list | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words under their variants, one word after another, and the number of each.

    ``merges`` gets arrays (number of the word, key) of the merges made.
    """
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    step = np.where(sizes <= WIDE, (sizes + 3) // 4, -1)
    order, flat, counts = [], [], []
    for k in np.unique(step).tolist():
        items = np.flatnonzero(step == k)
        order.append(items)
        if k < 0:
            found = []
            for i in items.tolist():
                made = None if merges is None else []
                found.append(_encode_long(m, words[i], int(variant[i]), seed, rate, made))
                if made:
                    merges.append((np.full(len(made), i), _merge_keys(m, *np.array(made, dtype=np.int64).T)))
            flat += found
            counts.append(np.array([len(x) for x in found], dtype=np.int64))
            continue
        for at in range(0, len(items), BLOCK_WORDS):
            part = items[at : at + BLOCK_WORDS]
            made = None if merges is None else []
            ids, n = _encode_block(m, [words[i] for i in part.tolist()], variant[part], 4 * k, seed, rate, made)
            for rows, keys in made or ():
                merges.append((part[rows], keys))
            flat.append(ids)
            counts.append(n)
    if not order:
        return np.zeros(0, dtype=np.int32), sizes
    order, flat, counts = np.concatenate(order), np.concatenate(flat), np.concatenate(counts)
    start = np.cumsum(counts) - counts
    back = np.argsort(order)
    return flat[K.ranges(start[back], counts[back])], counts[back]


def _mix(x: int) -> int:
    """:func:`kernels.mix` of one value."""
    for shift, factor in ((32, int(K._M1)), (29, int(K._M2))):
        x = (x ^ (x >> shift)) * factor & ONES
    return x ^ (x >> 32)


def _encode_long(m: Model, word: str, variant: int, seed: int, rate: float, merges: list | None = None) -> np.ndarray:
    """The same agenda over a heap, for one long word; ``merges`` gets (left, right, place) of those made."""
    made_of = m.pairs()
    sym = [m.id_of.get(c, -1) for c in word]
    after, before = [*range(1, len(word)), -1], list(range(-1, len(word) - 1))
    keyed = _mix((variant * 0x165667B19E3779F9 + (seed & ONES)) & ONES)
    heap: list[tuple[int, int, int, int, int]] = []

    def offer(i: int) -> None:
        j = after[i]
        if j < 0 or sym[i] < 0 or sym[j] < 0:
            return
        pair = sym[i] * m.size + sym[j]
        made = made_of.get(pair)
        if made is None:
            return
        if rate > 0:
            key = _mix((pair * 0x9E3779B97F4A7C15 + i * 0xC2B2AE3D27D4EB4F) & ONES)
            if _mix(key ^ keyed) >> 11 < rate * float(1 << 53):
                return
        heapq.heappush(heap, (int(m.rank[made]), i, made, sym[i], sym[j]))

    for i in range(len(word) - 1):
        offer(i)
    while heap:
        _, i, made, left, right = heapq.heappop(heap)
        j = after[i]
        if sym[i] != left or j < 0 or sym[j] != right:
            continue  # a neighbour has changed meanwhile
        if merges is not None:
            merges.append((left, right, i))
        sym[i], sym[j], after[i] = made, -2, after[j]
        if after[j] >= 0:
            before[after[j]] = i
        if before[i] >= 0:
            offer(before[i])
        offer(i)
    out: list[int] = []
    for i, x in enumerate(sym):
        if x >= 0:
            out.append(x)
        elif x == -1:
            out += m.byte_id[list(word[i].encode())].tolist()
    return np.array(out, dtype=np.int32)


def _encode_block(
    m: Model, words: list[str], variant: np.ndarray, width: int, seed: int, rate: float, merges: list | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Words of at most ``width`` symbols, one merge each a round; ``merges`` gets (rows, keys) of those made."""
    n, far = len(words), np.iinfo(np.int32).max
    length = np.fromiter(map(len, words), dtype=np.int64, count=n)
    symbols = m.char_id[np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4")]
    col = np.arange(width + 1, dtype=np.int32)
    sym = np.full((n, width + 1), -1, dtype=np.int32)
    sym[col[None, :] < length[:, None]] = symbols
    place = np.tile(col, (n, 1))  # where each symbol starts in its word
    made, cost = _candidates(m, sym[:, :-1], sym[:, 1:], place[:, :-1], variant[:, None], seed, rate)
    done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # rows, their number of symbols, the symbols
    row = np.arange(n)
    while len(row):
        best = np.argmin(cost, axis=1)
        at = np.arange(len(row))
        live = cost[at, best] < far
        if not live.all():
            ended = sym[~live]
            there = ended >= 0
            done.append((row[~live], there.sum(axis=1), ended[there]))
            row, best, sym, place, made, cost, variant = (x[live] for x in (row, best, sym, place, made, cost, variant))
            at = at[: len(row)]
            if not len(row):
                break
        if merges is not None:
            merges.append((row, _merge_keys(m, sym[at, best], sym[at, best + 1], place[at, best])))
        # the merged symbol replaces the pair and all behind it move up; every row is one symbol shorter
        new = made[at, best]
        behind = col[None, : sym.shape[1] - 1] > best[:, None]
        sym, place = (np.where(behind, x[:, 1:], x[:, :-1]) for x in (sym, place))
        made, cost = (np.where(behind[:, :-1], x[:, 1:], x[:, :-1]) for x in (made, cost))
        sym[at, best] = new
        if not cost.shape[1]:
            done.append((row, np.ones(len(row), dtype=np.int64), new))
            break
        # the two pairs that hold the new symbol
        first, last = best > 0, best < cost.shape[1]
        r, x = np.concatenate((at[last], at[first])), np.concatenate((best[last], best[first] - 1))
        made[r, x], cost[r, x] = _candidates(m, sym[r, x], sym[r, x + 1], place[r, x], variant[r], seed, rate)
    row, count, flat = (np.concatenate(x) for x in zip(*done))
    back = np.argsort(row)
    start = np.cumsum(count) - count
    flat, count = flat[K.ranges(start[back], count[back])], count[back]
    foreign = flat >= m.size
    if foreign.any():  # bytes for symbols the model does not know
        parts = [chr(c - m.size).encode("utf-8", "surrogatepass") for c in flat[foreign].tolist()]
        size = np.ones(len(flat), dtype=np.int64)
        size[foreign] = [len(x) for x in parts]
        owner = np.repeat(np.arange(n), count)
        count = np.bincount(owner, weights=size, minlength=n).astype(np.int64)
        out = np.repeat(flat, size)
        out[np.repeat(foreign, size)] = m.byte_id[np.frombuffer(b"".join(parts), dtype=np.uint8)]
        flat = out
    return flat.astype(np.int32), count


def _candidates(m: Model, left, right, place, variant, seed: int, rate: float) -> tuple[np.ndarray, np.ndarray]:
    """Piece and cost of merging neighbours; the largest cost where there is none or it is skipped."""
    made = m.join(left, right)
    cost = np.where(made >= 0, m.rank[made], np.int32(np.iinfo(np.int32).max))
    if rate > 0:
        some = np.nonzero(made >= 0)
        if len(some[0]):
            keys = np.broadcast_to(variant, made.shape)[some]
            gone = _dropped(m, left[some], right[some], place[some], keys, seed, rate)
            cost[tuple(i[gone] for i in some)] = np.iinfo(np.int32).max
    return made, cost


class Rows:
    """Arrays one after another in one that grows."""

    def __init__(self, dtype):
        self.flat = np.zeros(1 << 16, dtype=dtype)
        self.offsets = np.zeros(1 << 16, dtype=np.int64)
        self.known = 0

    def add(self, flat: np.ndarray, lengths: np.ndarray) -> None:
        end, at = self.known + len(lengths), int(self.offsets[self.known])
        if end + 1 > len(self.offsets):
            self.offsets = np.concatenate((self.offsets, np.zeros(max(end, len(self.offsets)), dtype=np.int64)))
        self.offsets[self.known + 1 : end + 1] = at + np.cumsum(lengths)
        total = int(self.offsets[end])
        if total > len(self.flat):
            self.flat = np.concatenate((self.flat, np.zeros(max(total, len(self.flat)), dtype=self.flat.dtype)))
        self.flat[at:total] = flat
        self.known = end

    def take(self, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows ``n`` one after another, and their lengths."""
        start = self.offsets[n]
        lengths = self.offsets[n + 1] - start
        return self.flat[K.ranges(start, lengths)], lengths


class WordCache(dict):
    """Ids of (word, variant) and the keys of the merges made, encoded when first met, many at a time."""

    def __init__(self, m: Model, seed: int, rate: float):
        super().__init__()
        self.m, self.seed, self.rate = m, seed, rate
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.new: list[tuple[str, int]] = []
        self.rows, self.merges = Rows(np.int32), Rows(K.U)

    @property
    def ids(self) -> np.ndarray:
        return self.rows.flat

    @property
    def offsets(self) -> np.ndarray:
        return self.rows.offsets

    def __missing__(self, key: tuple[str, int]) -> int:
        n = self[key] = len(self)
        self.new.append(key)
        return n

    def learn(self) -> None:
        made: list[tuple[np.ndarray, np.ndarray]] = []
        variants = np.array([v for _, v in self.new], dtype=np.int64)
        self.rows.add(*encode_words(self.m, [w for w, _ in self.new], variants, self.seed, self.rate, made))
        word = np.concatenate([w for w, _ in made] or [np.zeros(0, dtype=np.int64)])
        keys = np.concatenate([k for _, k in made] or [np.zeros(0, dtype=K.U)])
        self.merges.add(keys[np.argsort(word, kind="stable")], np.bincount(word, minlength=len(self.new)))
        self.new = []


def occurrences(doc_id: int | None, n: int, seed: int) -> np.ndarray:
    """The variant of each of a document's ``n`` words."""
    base = _mix(((doc_id or 0) * 0x9E3779B97F4A7C15 + seed) & ONES)
    return K.mix(np.arange(n, dtype=K.U) * K.U(0xD6E8FEB86659FD93) + K.U(base))


def encode_occurrences(
    cache: WordCache, words: list[str], variant: np.ndarray, seed: int, rate: float
) -> tuple[np.ndarray, np.ndarray]:
    """:func:`encode_words`, with the words' merges without dropout in ``cache``."""
    once = pa.array(words, pa.string()).dictionary_encode()  # each word is looked up once
    distinct = once.dictionary.to_pylist()
    known = np.fromiter((cache[w, 0] for w in distinct), dtype=np.int64, count=len(distinct))
    numbers = known[once.indices.to_numpy()]
    if cache.new:
        cache.learn()
    flat, lengths = cache.rows.take(numbers)
    if rate <= 0 or not len(words):
        return flat, lengths
    keys, made = cache.merges.take(numbers)
    owner = np.repeat(np.arange(len(words)), made)
    hit = np.zeros(len(words), dtype=bool)
    hit[owner[_skipped(keys, variant[owner], seed, rate)]] = True
    again = np.flatnonzero(hit)
    if not len(again):
        return flat, lengths
    more, counts = encode_words(cache.m, [words[i] for i in again.tolist()], variant[again], seed, rate)
    flat = flat[~np.repeat(hit, lengths)]
    lengths[again] = counts
    out = np.empty(int(lengths.sum()), dtype=np.int32)
    anew = np.repeat(hit, lengths)
    out[anew], out[~anew] = more, flat
    return out, lengths


def stretches(normal: str) -> list[str]:
    """The stretches of a normalised text that are encoded by themselves: each
    is a run of blanks, or starts with at most the last blank of a run. Blanks
    before a symbol belong to one run with the symbol's blank, since a piece
    may hold several blanks or one blank and what follows.
    """
    return _STRETCH.findall(normal)


_caches: dict[tuple, WordCache] = {}


class Decoder:
    def __init__(self, m: Model):
        pieces = [m.sp.id_to_piece(i).replace(MARK, " ").encode() for i in range(m.size)]
        for b, i in enumerate(m.byte_id.tolist()):
            pieces[i] = bytes([b])
        for i in range(m.size):
            if m.sp.is_control(i):
                pieces[i] = b""
        self.pieces = pieces

    def text(self, ids) -> str:
        """The text of ids, without the blank that is put before every text."""
        text = b"".join(map(self.pieces.__getitem__, ids)).decode("utf-8", errors="replace")
        return text[1:] if text.startswith(" ") else text


def _encode_texts(path: str, seed: int, rate: float, check: bool):
    """mapInArrow body: (key long, ..., text) to the other columns, ``ids`` and with ``check`` ``lossless``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        decoder = Decoder(m)
        cache = _caches.setdefault((path,), WordCache(m, 0, 0.0))
        for batch in batches:
            for at, end in K.slices(K.text_buffer(batch.column(batch.num_columns - 1))[1], BATCH_BYTES):
                part = batch.slice(at, end - at)
                texts = part.column(-1).to_pylist()
                keys = part.column(0).to_pylist()
                if len(cache) > CACHE_WORDS:
                    cache.forget()
                parts = [stretches(m.sp.normalize(text)) if text else [] for text in texts]
                variant = [occurrences(key, len(words), seed) for key, words in zip(keys, parts)]
                flat, lengths = encode_occurrences(cache, list(chain.from_iterable(parts)), np.concatenate(variant), seed, rate)
                ends = np.concatenate(([0], np.cumsum(lengths)))[np.cumsum([len(words) for words in parts])]
                out = [None if t is None else ids for t, ids in zip(texts, np.split(flat, ends[:-1]))]
                columns, names = [*part.columns[:-1], pa.array(out, pa.list_(pa.int32()))], [*part.schema.names[:-1], "ids"]
                if check:
                    same = [None if x is None else decoder.text(x.tolist()) == t for x, t in zip(out, texts)]
                    columns.append(pa.array(same, pa.bool_()))
                    names.append("lossless")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def encode(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", rate: float = RATE, seed: int = SEED,
    check: bool = False,
) -> DataFrame:
    """Columns doc_id (long), ids (array<int>) and, with ``check``, whether the ids decode to the text."""
    slim = docs.select(
        column(docs, id_col).cast("long").alias("doc_id"), column(docs, text_col).cast("string").alias("text")
    )
    schema = "doc_id long, ids array<int>" + ", lossless boolean" * check
    return slim.mapInArrow(_encode_texts(path, seed, rate, check), schema)


def _decode_ids(path: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(model(path))
        for batch in batches:
            out = []
            for ids in batch.column(-1).to_pylist():
                out.append(None if ids is None else decoder.text(ids))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(out, pa.string())], names=[*batch.schema.names[:-1], "text"]
            )

    return run


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Columns doc_id and text; the exact inverse of :func:`encode` on normalised texts."""
    slim = encoded.select(column(encoded, id_col).alias("doc_id"), column(encoded, ids_col).alias("ids"))
    return slim.mapInArrow(_decode_ids(path), "doc_id long, text string")
