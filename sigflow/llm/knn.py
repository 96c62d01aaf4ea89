"""Exact top-k search as a Voronoi join.

Vectors become integers, floor(scale * x), and are scored by inner product.

1. A few pivots are drawn (``pivots`` many, a bounded sample) and every vector
   joins the group of its nearest pivot. A group's summary is its count, its
   radius around the pivot and its cells' number; there are at most
   ``pivots`` summaries per vector length.
2. Every query is solved in its own group first. Its k-th best score there is
   a floor no result can fall below.
3. A group can hold a better one only if <q, p> + |q| r reaches the floor
   (Cauchy-Schwarz, with p its pivot and r its radius). Queries go to those
   groups only.

Groups are split into cells of bounded size, however many copies a vector
has, and the queries that visit a group into blocks of the same size, so a task
holds one cell and one block. A group's data are replicated once per block of
its own visitors, and not at all if no query visits it. Results of the cells
are merged by a ranked top-k.

Defined results: vectors that are null, empty or hold a null or non-finite
component take no part; vectors of different lengths are not compared; rows
repeated with one id and vector count once; a query's own id is no candidate;
an empty table gives an empty result; ties go to the smaller id; only the id
and vector columns are read, whatever further columns are called. Scores are
exact: products past 2**53 are computed with Python integers and kept within
64 bits.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sigflow.llm.common import column, shuffle_width
from sigflow.session import ensure_checkpoint_dir

K_BEST = 5
SCALE = 256
# Pivots: an eighth of the square root of the number of vectors, within these bounds.
PIVOTS_LEAST, PIVOTS_MOST = 64, 1024
# A cell holds about one shuffle partition's share of the vectors, within these bounds.
CELL_LEAST, CELL_MOST = 256, 16_384
EXACT = float(1 << 53)


def quantized(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component; null for vectors that take no part."""
    bad = F.exists(
        F.transform(vector, lambda x: x.cast("double")),
        lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))),
    )
    ints = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("bigint"))
    return F.when(vector.isNotNull() & (F.size(vector) > 0) & ~bad, ints)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


class Groups:
    """Pivots by vector length."""

    def __init__(self, pivots: dict[int, np.ndarray]):
        self.pivots = {d: p.astype(float) for d, p in pivots.items()}

    def nearest(self, dim: int, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Group and distance to its pivot, rounded up."""
        x = x.astype(float)
        p = self.pivots.get(dim, np.zeros((1, dim)))
        best = np.full(len(x), np.inf)
        group = np.zeros(len(x), dtype=np.int32)
        for g, pivot in enumerate(p):  # plain differences: no cancellation
            d = np.sqrt(((x - pivot) ** 2).sum(axis=1))
            closer = d < best
            best[closer], group[closer] = d[closer], g
        return group, best * (1 + 1e-9)

    def bounds(self, dim: int, x: np.ndarray, radius: dict[int, float]) -> tuple[np.ndarray, np.ndarray]:
        """Groups of this length and, per query and group, no less than its best score there."""
        x = x.astype(float)
        groups = np.array(sorted(radius))
        p = self.pivots.get(dim, np.zeros((1, dim)))[groups]
        norm = np.sqrt((x**2).sum(axis=1))[:, None]
        centre = x @ p.T
        reach = norm * np.array([radius[g] for g in groups])
        slack = 1e-9 * (norm * np.sqrt((p**2).sum(axis=1)) + reach) + 1
        return groups, centre + reach + slack


def _assign(groups: Groups):
    """mapInArrow body: (id, v) to (id, v, dim, g, dist)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column(1)
            dims = pc.list_value_length(v).to_numpy(zero_copy_only=False)
            g = np.zeros(len(dims), dtype=np.int32)
            dist = np.zeros(len(dims))
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                g[rows], dist[rows] = groups.nearest(int(dim), _matrix(v.take(pa.array(rows)), int(dim)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), v, pa.array(dims.astype(np.int32)), pa.array(g), pa.array(dist)],
                names=["id", "v", "dim", "g", "dist"],
            )

    return run


def _scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    a, b = q.astype(float), x.astype(float)
    if len(q) and len(x) and np.abs(a).max() * np.abs(b).max() * q.shape[1] < EXACT:
        return (a @ b.T).astype(np.int64)
    top = (1 << 63) - 1
    exact = [[max(-top - 1, min(top, sum(i * j for i, j in zip(r, s)))) for s in x.tolist()] for r in q.tolist()]
    return np.array(exact, dtype=np.int64).reshape(len(q), len(x))


FOUND = "query_id long, query_key long, vec_id long, score long"
_FOUND = pa.schema([(n, pa.int64()) for n in ("query_id", "query_key", "vec_id", "score")])


def _solve(k: int):
    """One cell of data against one block of queries: the k best of each query."""

    def run(key: tuple, data: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[np.ndarray] = []
        if data.num_rows and queries.num_rows:
            dim = int(key[0].as_py())
            x, ids = _matrix(data.column("v").combine_chunks(), dim), data.column("id").to_numpy()
            order = np.argsort(ids, kind="stable")
            x, ids = x[order], ids[order]
            q, q_ids = _matrix(queries.column("v").combine_chunks(), dim), queries.column("id").to_numpy()
            keys = queries.column("query_key").to_numpy()
            for at in range(0, len(q), 256):
                score = _scores(q[at : at + 256], x)
                for r, row in enumerate(score):
                    other = np.flatnonzero(ids != q_ids[at + r])
                    if len(other) > k:  # all at or above the k-th score, then ties by id
                        kth = np.partition(row[other], len(other) - k)[len(other) - k]
                        other = other[row[other] >= kth]
                    best = other[np.lexsort((ids[other], -row[other]))][:k]
                    n = len(best)
                    out.append(np.stack((np.full(n, q_ids[at + r]), np.full(n, keys[at + r]), ids[best], row[best])))
        flat = np.concatenate(out, axis=1) if out else np.zeros((4, 0), dtype=np.int64)
        return pa.table([pa.array(c.astype(np.int64)) for c in flat], schema=_FOUND)

    return run


def _others(groups: Groups, radius: dict[int, dict[int, float]]):
    """mapInArrow body: (id, query_key, v, dim, g, floor) to one row per further group worth a visit."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, home = batch.column(3).to_numpy(), batch.column(4).to_numpy()
            floor = batch.column(5).to_numpy(zero_copy_only=False)
            rows, to = [], []
            for dim in np.unique(dims):
                mine = np.flatnonzero(dims == dim)
                if int(dim) not in radius:
                    continue
                x = _matrix(batch.column(2).take(pa.array(mine)), int(dim))
                g, bound = groups.bounds(int(dim), x, radius[int(dim)])
                visit = (bound >= floor[mine][:, None]) & (g[None, :] != home[mine][:, None])
                r, c = np.nonzero(visit)
                rows.append(mine[r])
                to.append(g[c])
            if rows:
                take = pa.array(np.concatenate(rows))
                part = batch.select([0, 1, 2, 3]).take(take)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(np.concatenate(to).astype(np.int32))],
                    names=["id", "query_key", "v", "dim", "g"],
                )

    return run


def shipped(visits: DataFrame, cells: DataFrame, cell: int) -> DataFrame:
    """(dim, g, cells, blocks) of the groups that some query visits: into how many cells
    its data and into how many blocks its visitors are cut. A row per group at most."""
    counted = visits.groupBy("dim", "g").agg(F.ceil(F.count(F.lit(1)) / F.lit(cell)).cast("int").alias("blocks"))
    return cells.join(counted, ["dim", "g"])


def exact_top_k(
    data: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K_BEST,
    scale: int = SCALE, pivots: int | None = None, cell: int | None = None,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best of ``data`` for every row of ``queries``."""
    spark = data.sparkSession
    ensure_checkpoint_dir(spark)

    def clean(df: DataFrame) -> DataFrame:
        v = quantized(column(df, vector_col), scale)
        out = df.select(column(df, id_col).cast("long").alias("id"), v.alias("v"))
        return out.filter(F.col("id").isNotNull() & F.col("v").isNotNull())

    # repeated rows count once; the vector stands in by two hashes
    once = clean(data).dropDuplicates(["id", "v"])
    pivots = pivots or min(PIVOTS_MOST, max(PIVOTS_LEAST, math.isqrt(data.count()) // 8))
    # A bounded sample picks the pivots: the rows of smallest hash, one per distinct vector.
    drawn = clean(data).orderBy(F.xxhash64("v", "id")).limit(pivots).collect()
    by_dim: dict[int, list] = {}
    for r in drawn:
        known = by_dim.setdefault(len(r.v), [])
        if r.v not in known:
            known.append(r.v)
    groups = Groups({d: np.array(v) for d, v in by_dim.items()})
    placed = once.mapInArrow(_assign(groups), "id long, v array<bigint>, dim int, g int, dist double").checkpoint()

    summary = placed.groupBy("dim", "g").agg(F.count(F.lit(1)).alias("n"), F.max("dist").alias("r")).collect()
    total = sum(s.n for s in summary)
    cell = cell or min(CELL_MOST, max(CELL_LEAST, -(-total // shuffle_width(spark))))
    radius: dict[int, dict[int, float]] = {}
    for s in summary:
        radius.setdefault(s.dim, {})[s.g] = s.r
    cells = spark.createDataFrame(
        [(s.dim, s.g, -(-s.n // cell)) for s in summary], "dim int, g int, cells int"
    )
    asked = clean(queries).dropDuplicates(["id", "v"]).mapInArrow(
        _assign(groups), "id long, v array<bigint>, dim int, g int, dist double"
    ).withColumn("query_key", F.xxhash64("v"))
    place = ["dim", "g", "cell", "block"]

    def solved(visits: DataFrame) -> DataFrame:
        """Queries once per cell of the groups they visit, data once per block of their group's visitors."""
        visited = shipped(visits, cells, cell)
        spread = placed.join(F.broadcast(visited), ["dim", "g"]).select(
            "id", "v", "dim", "g", F.pmod(F.xxhash64("id", "v"), F.col("cells")).cast("int").alias("cell"),
            F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        )
        to = visits.join(F.broadcast(visited), ["dim", "g"]).select(
            "id", "query_key", "v", "dim", "g", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias("cell"),
            F.pmod(F.xxhash64("id", "v"), F.col("blocks")).cast("int").alias("block"),
        )
        return spread.groupBy(*place).cogroup(to.groupBy(*place)).applyInArrow(_solve(k), FOUND)

    best = W.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")

    def top(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)

    home = top(solved(asked)).checkpoint()
    floors = home.groupBy("query_id", "query_key").agg(
        F.when(F.count(F.lit(1)) == k, F.min("score").cast("double")).otherwise(F.lit(float("-inf"))).alias("floor")
    )
    with_floor = asked.join(
        floors, (asked["id"] == floors["query_id"]) & (asked["query_key"] == floors["query_key"]), "left"
    ).select(
        "id", asked["query_key"], "v", "dim", "g", F.coalesce("floor", F.lit(float("-inf"))).alias("floor")
    )
    visits = with_floor.mapInArrow(_others(groups, radius), "id long, query_key long, v array<bigint>, dim int, g int").checkpoint()
    found = home.drop("rank").unionByName(solved(visits))
    return top(found).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
