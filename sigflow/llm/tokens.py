"""Token ids of texts, computed per distinct word.

``word_bpe`` files (a BPE over lower-cased, white-space-free words) encode
every stretch between spaces by itself: the normaliser never composes across
a space and the splitting pattern never matches one. So a text's ids are the
ids of its pieces between blanks and newlines, one after another, and each
distinct piece is encoded once per worker. Other white space stays inside the
pieces, where the tokenizer treats it as ever.

Latin texts are brought to fewer distinct pieces first, in ways the tokenizer
cannot tell apart: they are lower-cased, and punctuation that ends a piece
after a letter is cut off, as the splitting pattern does. Texts with
characters beyond Latin Extended-A, where case and composition have more
rules, or with what looks like a special token, are left as they are.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator
from itertools import chain, compress

import numpy as np
import pyarrow as pa

from sigflow.llm import kernels as K

# Distinct pieces a worker remembers before it starts over (bounds its memory).
CACHE_PIECES = 600_000
JOINED = 4096  # words encoded as one text
BEYOND_LATIN = re.compile("[^\x00-\u017f]")
# Between a letter and the punctuation that runs from it to the end of its piece. Without the
# apostrophe, which may start a contraction.
TAIL = re.compile(r"(?<=[a-z\u00df-\u00f6\u00f8-\u017f])(?=[!-&(-/:-@\[-`{-~]+(?: |$))")


def simpler(text: str) -> str:
    """A text with the same ids and fewer distinct pieces."""
    if "<|" in text or BEYOND_LATIN.search(text):
        return text
    return TAIL.sub(" ", text.lower())


class PieceEncoder(dict):
    """Maps a piece to its number; the ids of number i are ``ids[offsets[i]:offsets[i+1]]``."""

    def __init__(self, path: str):
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.ends_word = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.ends_word[i] = token.endswith("</w>")
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.new: list[str] = []
        self.ids = np.zeros(1 << 16, dtype=self.dtype)
        self.offsets = np.zeros(1 << 16, dtype=np.int64)
        self.known = 0  # pieces encoded so far

    def __missing__(self, piece: str) -> int:
        n = self[piece] = len(self)
        self.new.append(piece)
        return n

    def _encode_new(self) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the new pieces one after another, and their lengths."""
        # A piece of lower-case Latin letters is one word to the splitting pattern, so many of
        # them can be encoded as one text: each ends with the next token that ends a word.
        plain = [w.isalpha() and w == w.lower() and not BEYOND_LATIN.search(w) for w in self.new]
        words = list(compress(self.new, plain))
        joined = [" ".join(words[i : i + JOINED]) for i in range(0, len(words), JOINED)]
        ids = list(chain.from_iterable(e.ids for e in self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)))
        ids = np.array(ids, dtype=self.dtype)
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        if len(ends) != len(words):
            plain, ids, ends = [False] * len(plain), ids[:0], ends[:0]
        others = [w for w, p in zip(self.new, plain) if not p]
        lists = [e.ids for e in self.tokenizer.encode_batch_fast(others, add_special_tokens=False)]
        more = np.array(list(chain.from_iterable(lists)), dtype=self.dtype)
        plain = np.array(plain, dtype=bool)
        lengths = np.empty(len(plain), dtype=np.int64)
        lengths[plain] = np.diff(ends, prepend=0)
        lengths[~plain] = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
        flat = np.empty(int(lengths.sum()), dtype=self.dtype)
        of = np.repeat(plain, lengths)
        flat[of], flat[~of] = ids, more
        return flat, lengths

    def _learn(self) -> None:
        flat, lengths = self._encode_new()
        end = self.known + len(lengths)
        at = int(self.offsets[self.known])
        if end + 1 > len(self.offsets):
            self.offsets = np.concatenate((self.offsets, np.zeros(max(end, len(self.offsets)), dtype=np.int64)))
        self.offsets[self.known + 1 : end + 1] = at + np.cumsum(lengths)
        total = int(self.offsets[end])
        if total > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros(max(total, len(self.ids)), dtype=self.dtype)))
        self.ids[at:total] = flat
        self.known, self.new = end, []

    def encode_many(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; pieces not met before are encoded together."""
        if len(self) > CACHE_PIECES:
            self.forget()
        numbers = []
        for text in texts:
            pieces = simpler(text.replace("\n", " ")).split(" ")
            numbers.append(np.fromiter(map(self.__getitem__, pieces), dtype=np.int64, count=len(pieces)))
        if self.new:
            self._learn()
        out = []
        for n in numbers:
            start = self.offsets[n]
            out.append(self.ids[K.ranges(start, self.offsets[n + 1] - start)])
        return out

    def encode(self, text: str) -> np.ndarray:
        return self.encode_many([text])[0]


_encoders: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """One encoder per worker process and file."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


def tokenize(path: str, end_id: int | None):
    """mapInArrow body: replaces the last column (text) by ``n`` (ids) and ``ids`` (little-endian binary)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        tail = np.zeros(0, dtype=enc.dtype) if end_id is None else np.array([end_id], dtype=enc.dtype)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):  # keeps the ids of a few rows in memory
                part = batch.slice(at, 512)
                texts = [t or "" for t in part.column(-1).to_pylist()]
                ids = [np.concatenate((x, tail)) for x in enc.encode_many(texts)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns[:-1],
                        pa.array([len(x) for x in ids], pa.int64()),
                        pa.array([x.tobytes() for x in ids], pa.binary()),
                    ],
                    names=[*part.schema.names[:-1], "n", "ids"],
                )

    return run


def id_type(path: str) -> str:
    """NumPy type of the stored ids; read on the driver, as workers write it."""
    return encoder(path).dtype.str
