"""Token-id output: best-fit-decreasing packing into fixed-length rows.

Documents are tokenized and spread over the partitions by hash. A task packs
block after block of bounded size: documents longer than a row are split,
without loss, into full rows and a rest; the rests are placed longest first,
each into the fullest row that still has room. That row is found by a segment
tree over remaining capacities in logarithmic time.

Defined results: null or empty texts hold the end id alone; repeated rows and
null ids are packed row by row; an empty table gives an empty result; only
the id and text columns are read, whatever further columns are called.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigflow.llm.common import column, shuffle_width
from sigflow.llm.tokens import id_type, tokenize

LENGTH = 2048
END_ID = 1
PAD_ID = 0
# Tokens packed together in a task; bounds its memory, and is ample for a tight fit.
BLOCK_TOKENS = 4_000_000

SCHEMA = (
    "sequence_id long, n_tokens int, ids binary, cu_seqlens array<int>, position_resets array<int>, "
    "doc_ids array<bigint>, doc_starts array<bigint>"
)
_SCHEMA = pa.schema([
    ("sequence_id", pa.int64()), ("n_tokens", pa.int32()), ("ids", pa.binary()), ("cu_seqlens", pa.list_(pa.int32())),
    ("position_resets", pa.list_(pa.int32())), ("doc_ids", pa.list_(pa.int64())), ("doc_starts", pa.list_(pa.int64())),
])


class CapacityTree:
    """Open rows by remaining capacity; finds the least sufficient capacity in O(log n)."""

    def __init__(self, most: int):
        self.base = 1 << most.bit_length()
        self.count = [0] * (2 * self.base)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def _change(self, capacity: int, by: int) -> None:
        node = self.base + capacity
        while node:
            self.count[node] += by
            node >>= 1

    def add(self, capacity: int, row: int) -> None:
        self.rows[capacity].append(row)
        self._change(capacity, 1)

    def best(self, size: int) -> tuple[int, int] | None:
        """Takes out a row of the least capacity >= size; None if no row has room."""
        node = self.base + size
        if not self.count[node]:
            while True:  # up to the first subtree on the right that holds a row
                if node == 1:
                    return None
                if not node & 1 and self.count[node + 1]:
                    node += 1
                    break
                node >>= 1
            while node < self.base:
                node *= 2
                if not self.count[node]:
                    node += 1
        capacity = node - self.base
        self._change(capacity, -1)
        return capacity, self.rows[capacity].pop()


def best_fit_decreasing(sizes: list[int], length: int) -> list[list[int]]:
    """Item numbers per row; every size is at most ``length``."""
    tree, rows = CapacityTree(length), []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        found = tree.best(sizes[i])
        if found is None:
            found = length, len(rows)
            rows.append([])
        capacity, row = found
        rows[row].append(i)
        tree.add(capacity - sizes[i], row)
    return rows


def _pack(length: int, pad_id: int, dtype: str, id_shift: int = 40):
    """mapInArrow body over (doc_id, n, ids)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << id_shift
        made, held, tokens = 0, [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal made, held, tokens
            rows: list[list[tuple]] = []
            rests = []
            for doc_id, ids in held:
                whole = len(ids) // length * length
                rows += [[(doc_id, at, ids[at : at + length])] for at in range(0, whole, length)]
                if whole < len(ids):
                    rests.append((doc_id, whole, ids[whole:]))
            rows += [[rests[i] for i in row] for row in best_fit_decreasing([len(r[2]) for r in rests], length)]
            held, tokens = [], 0
            for at in range(0, len(rows), 256):
                out = []
                for row in rows[at : at + 256]:
                    flat = np.full(length, pad_id, dtype=dtype)
                    ends = np.cumsum([len(r[2]) for r in row])
                    flat[: ends[-1]] = np.concatenate([r[2] for r in row])
                    cu = [0, *ends.tolist()]
                    out.append((first + made, cu[-1], flat.tobytes(), cu, cu[:-1], [r[0] for r in row], [r[1] for r in row]))
                    made += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t.type) for c, t in zip(zip(*out), _SCHEMA)], schema=_SCHEMA
                )

        for batch in batches:
            docs, _, ids = (c.to_pylist() for c in batch.columns)
            for d, data in zip(docs, ids):
                held.append((d, np.frombuffer(data, dtype=dtype)))
                tokens += len(held[-1][1])
                if tokens >= BLOCK_TOKENS:
                    yield from flush()
        if held:
            yield from flush()

    return run


def pack_best_fit(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
    end_id: int | None = END_ID, pad_id: int = PAD_ID,
) -> DataFrame:
    """One row per packed sequence: sequence_id, n_tokens, ids (``length``
    little-endian unsigned ids, 16 bits wide if the vocabulary fits, padded),
    cu_seqlens (0 and the end of every segment), position_resets (where
    positions start over), and per segment the document and the place in it.
    """
    dtype = id_type(tokenizer)
    slim = docs.select(
        column(docs, id_col).cast("long").alias("doc_id"), column(docs, text_col).cast("string").alias("text")
    )
    tokens = slim.mapInArrow(tokenize(tokenizer, end_id), "doc_id long, n long, ids binary")
    key = F.xxhash64("doc_id", "ids")
    # in an order of their own, so that a task that runs again packs the same sequences under the same numbers
    spread = tokens.repartition(shuffle_width(docs.sparkSession), key).sortWithinPartitions(key, "doc_id", "ids")
    return spread.mapInArrow(_pack(length, pad_id, dtype), SCHEMA)


def write_packed(packed: DataFrame, path: str) -> None:
    """Packed sequences as Parquet; ``ids`` of the rows in order of sequence_id form the id matrix."""
    packed.write.mode("error").parquet(path)


def id_matrix(rows, dtype: str = "<u2") -> np.ndarray:
    """Rows read back (Arrow table or list of bytes) as a matrix of ids."""
    data = rows.column("ids").to_pylist() if isinstance(rows, pa.Table) else rows
    return np.stack([np.frombuffer(x, dtype=dtype) for x in data])
