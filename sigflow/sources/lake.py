"""Lake tables: path-based reads and writes in an installed table format.

Parquet is the default; ``fmt="delta"`` works when the Delta jars are on the
classpath. Partitioning by ``signal_date`` lets day filters prune files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_lake(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Latest snapshot of the table at ``path``."""
    return spark.read.format(fmt).load(path)


def write_lake(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
    sort_by: list[str] | None = None,
) -> None:
    """Write a table. ``partition_by`` (e.g. ``signal_date``) lets filters on
    it prune folders; ``sort_by`` (e.g. ``signal_ts``) sorts rows within each
    task, without a shuffle, so per-file min/max statistics are tight and
    range filters skip row groups."""
    if sort_by:
        df = df.sortWithinPartitions(*((partition_by or []) + sort_by))
    writer = df.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
