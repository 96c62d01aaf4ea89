"""Mixture-controlled packing: deficit round-robin over source queues.

Documents are tokenized, spread over the partitions by hash and queued by
source. Each window of ``length`` tokens gives every source its share of the
window as credit; the source with the largest credit is served, at least
``piece`` tokens at a time, until the window is full. What a source is owed
or has drawn ahead stays as its deficit for the next windows. A partition
starts with the deficits the partitions before it leave behind: those follow
from the token counts per partition and source, so all partitions can run at
once. Every source of a partition has a queue there; its share and first
deficit come as rows sorted before the partition's documents.

Every token lies in exactly one piece, and windows are full. The last tokens
of a partition fill windows whose lengths are powers of two, so nothing is
padded.

Defined results: null or empty texts hold the end id alone; repeated rows and
null ids are packed row by row; a null source is a source of its own; an
empty table gives an empty result; long texts are cut over many windows; only
the id, text and source columns are read, whatever further columns are called.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sigflow.llm.common import column, shuffle_width
from sigflow.llm.tokens import id_type, tokenize
from sigflow.session import ensure_checkpoint_dir

LENGTH = 2048
PIECE = 128
END_ID = 1
# Tokens queued in a task before windows are made, and at which it stops making them.
FULL, LOW = 4_000_000, 2_000_000
# Sequence numbers: partition above, number in the partition below.
SHIFT = 40

PIECES = "array<struct<doc_id: bigint, start: bigint, length: bigint, ids_crc32: bigint, doc_tokens: bigint, offset: bigint>>"
_PIECES = pa.list_(pa.struct([
    (n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "offset")
]))


class Queue:
    """Documents of one source; gives out tokens from the front."""

    def __init__(self):
        self.docs: deque = deque()
        self.tokens = 0

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.docs.append([doc_id, ids, 0])
        self.tokens += len(ids)

    def take(self, n: int) -> tuple[object, int, np.ndarray, int]:
        """The next piece of at most ``n`` tokens: id, start, ids, tokens of the document."""
        head = self.docs[0]
        doc_id, ids, at = head
        part = ids[at : at + n]
        head[2] += len(part)
        if head[2] == len(ids):
            self.docs.popleft()
        self.tokens -= len(part)
        return doc_id, at, part, len(ids)


class RoundRobin:
    def __init__(self, shares: np.ndarray, owed: np.ndarray, length: int, piece: int):
        self.queues = [Queue() for _ in shares]
        self.shares, self.owed, self.length, self.piece = shares, owed.astype(float), length, piece

    @property
    def tokens(self) -> int:
        return sum(q.tokens for q in self.queues)

    def window(self, length: int) -> list[tuple[object, int, np.ndarray, int]]:
        """One full window; needs ``length`` queued tokens."""
        self.owed += self.shares * length
        room, pieces = length, []
        live = np.array([q.tokens > 0 for q in self.queues])
        while room:
            k = int(np.argmax(np.where(live, self.owed, -np.inf)))
            q = self.queues[k]
            want = min(room, max(self.piece, int(self.owed[k])))
            while want and q.tokens:
                part = q.take(want)
                pieces.append(part)
                want -= len(part[2])
                room -= len(part[2])
                self.owed[k] -= len(part[2])
            live[k] = q.tokens > 0
        return pieces


def _powers_of_two(n: int) -> Iterator[int]:
    while n:
        yield 1 << (n.bit_length() - 1)
        n -= 1 << (n.bit_length() - 1)


def _pack(length: int, piece: int, dtype: str, with_ids: bool):
    """mapInArrow body over (part, doc_id, source, share, owed, ids) rows of one or more
    partitions; the rows without ids, the sources of a partition, come before its documents."""
    columns = ["sequence_id", "length", "pieces"] + ["ids"] * with_ids

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        robin, part_id, made = None, None, 0
        sources: dict[str | None, tuple[int, float, float]] = {}  # queue number, share, deficit

        def emit(lengths: Iterable[int]) -> Iterator[pa.RecordBatch]:
            nonlocal made
            rows = []
            for n in lengths:
                at, out, ids = 0, [], []
                for doc_id, start, part, total in robin.window(n):
                    part = part.astype("<u4")
                    out.append({"doc_id": doc_id, "start": start, "length": len(part),
                                "ids_crc32": zlib.crc32(part), "doc_tokens": total, "offset": at})
                    ids.append(part)
                    at += len(part)
                rows.append(((part_id << SHIFT) + made, n, out, *([np.concatenate(ids).tobytes()] * with_ids)))
                made += 1
                if len(rows) == 256:
                    yield batch_of(rows)
                    rows = []
            if rows:
                yield batch_of(rows)

        def batch_of(rows) -> pa.RecordBatch:
            types = [pa.int64(), pa.int64(), _PIECES, pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=columns)

        def rest() -> Iterator[pa.RecordBatch]:
            if robin is not None:
                left = robin.tokens
                yield from emit(length for _ in range(left // length))
                yield from emit(_powers_of_two(left % length))

        for batch in batches:
            for p, d, source, share, owed, data in zip(*(c.to_pylist() for c in batch.columns)):
                if p != part_id:
                    yield from rest()
                    robin, part_id, made, sources = None, p, 0, {}
                if data is None:
                    sources[source] = (len(sources), share, owed)
                    continue
                if robin is None:
                    robin = RoundRobin(*np.array([x[1:] for x in sources.values()]).T, length, piece)
                robin.queues[sources[source][0]].add(d, np.frombuffer(data, dtype=dtype))
            if robin is not None and robin.tokens > FULL:
                yield from emit(length for _ in range((robin.tokens - LOW) // length))
        yield from rest()

    return run


def pack_mixture(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    mixture: dict[str, float] | None = None,
    length: int = LENGTH,
    piece: int = PIECE,
    end_id: int = END_ID,
    with_ids: bool = True,
) -> DataFrame:
    """One row per sequence: sequence_id, length (long), pieces (array of
    structs: doc_id, start, length, ids_crc32, doc_tokens, offset) and, with
    ``with_ids``, the ids as little-endian unsigned 32-bit binary.

    ``mixture`` maps sources to weights; without it the corpus's own token
    shares are the target.
    """
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    width = shuffle_width(spark)
    dtype = id_type(tokenizer)
    slim = docs.select(
        column(docs, id_col).cast("long").alias("doc_id"), column(docs, source_col).cast("string").alias("source"),
        column(docs, text_col).cast("string").alias("text"),
    )
    tokens = slim.mapInArrow(tokenize(tokenizer, end_id), "doc_id long, source string, n long, ids binary")
    # by content as well as id: rows without an id, or sharing one, spread too
    key = F.xxhash64("doc_id", "ids")
    spread = tokens.withColumns({"key": key, "part": F.pmod(key, F.lit(width)).cast("int")}).checkpoint()
    stats = source_deficits(spread, width, mixture)

    # shares and deficits first, then the documents in the order of their hash
    names = ["part", "doc_id", "source", "share", "owed", "ids"]
    none = F.lit(None)
    heads = stats.select(
        "part", none.cast("long").alias("doc_id"), "source", "share", "owed", none.cast("binary").alias("ids"),
        F.lit(0).alias("kind"), F.lit(0).cast("long").alias("key"),
    )
    rows = spread.select(
        "part", "doc_id", "source", none.cast("double").alias("share"), none.cast("double").alias("owed"), "ids",
        F.lit(1).alias("kind"), "key",
    )
    placed = heads.unionByName(rows).repartitionById(width, "part").sortWithinPartitions("part", "kind", "key", "doc_id")
    schema = f"sequence_id long, length long, pieces {PIECES}" + ", ids binary" * with_ids
    return placed.select(*names).mapInArrow(_pack(length, piece, dtype, with_ids), schema)


def source_deficits(spread: DataFrame, width: int, mixture: dict[str, float] | None) -> DataFrame:
    """(part, source, share, owed) of every source in every partition: its share of a
    window, and what the partitions before leave it owing. ``spread`` has part, source and n."""
    spark = spread.sparkSession
    counts = spread.groupBy("part", "source").agg(F.sum("n").alias("n")).checkpoint()
    before, total = [], 0  # tokens of the partitions before: ``width`` numbers
    by_part = {r.part: r.n for r in counts.groupBy("part").agg(F.sum("n").alias("n")).collect()}
    for p in range(width):
        before.append(total)
        total += by_part.get(p, 0)
    shares = counts.groupBy("source").agg((F.sum("n") / F.lit(float(max(total, 1)))).alias("share"))
    if mixture:
        given = spark.createDataFrame(
            [(k, float(v)) for k, v in mixture.items()], "name string, weight double"
        )
        weighed = shares.join(given, F.col("source").eqNullSafe(F.col("name")), "left")
        weights = weighed.agg(F.sum("weight").alias("w")).first().w
        if weights:
            shares = weighed.select("source", (F.coalesce("weight", F.lit(0.0)) / F.lit(weights)).alias("share"))
    # at most ``width`` rows of a source
    earlier = W.partitionBy("source").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    served = counts.withColumn("served", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    shares = shares.withColumnRenamed("source", "of")
    tokens = F.get(F.array(*(F.lit(float(x)) for x in before)), F.col("part"))
    return served.join(shares, F.col("source").eqNullSafe(F.col("of"))).select(
        "part", "source", "share", (tokens * F.col("share") - F.col("served")).alias("owed")
    )


def piece_rows(packed: DataFrame) -> DataFrame:
    """One row per piece of packed sequences."""
    p = packed.select("sequence_id", F.explode("pieces").alias("p"))
    return p.select("p.doc_id", "p.start", "p.length", "p.ids_crc32", "p.doc_tokens", "sequence_id", "p.offset")
