"""Lake tables written batch by batch: compaction into day partitions, reads by generation or up to a batch.

Below a table's path::

    app_id=Q/batch_id=N/                   a folder per micro-batch, as ``sinks.batch_folder_writer`` leaves it
    _generations/data/segment=S/<day>=D/   rows of many batches, with app_id and batch_id as columns
    _generations/G.json                    generation G: its segments and, per query, the last batch they hold

Compaction writes the batches that no generation holds yet as one new segment
and then publishes the next generation, a small file that appears whole or not
at all. Readers take the newest generation and the batch folders beyond it, so
they see the same rows before, during and after. A compaction that dies leaves
at most a segment that nothing names. Batch folders that a generation holds are
only removed by :func:`drop_covered`, when no reader uses them any more.

The newest batch of a query may be written again after a failure, so it is
left out unless the query is said to have ended (``ended``).
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sigflow.session import drop_folder

APP, BATCH = "app_id", "batch_id"
HOME = "_generations"


@dataclass
class Generation:
    """``segments`` by name; ``held`` has the last batch of every query that they hold."""

    number: int = 0
    segments: list[str] = field(default_factory=list)
    held: dict[str, int] = field(default_factory=dict)
    partition_by: str | None = None
    schema: str | None = None  # of the segments' rows, as JSON


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def put_text(spark: SparkSession, path: str, text: str, overwrite: bool = False) -> None:
    """Write a small file that appears whole: under another name first, then renamed.
    Raises ``FileExistsError`` if it is there and may not be overwritten."""
    fs, target = _fs(spark, path)
    _, staged = _fs(spark, f"{target.getParent()}/.{target.getName()}.{uuid.uuid4().hex}")
    out = fs.create(staged, False)
    out.write(bytearray(text.encode()))
    out.close()
    if overwrite and fs.exists(target):
        fs.delete(target, False)
    if not fs.rename(staged, target):
        fs.delete(staged, False)
        raise FileExistsError(path)


def get_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def batch_folders(spark: SparkSession, path: str) -> dict[tuple[str, int], str]:
    """Complete batch folders (their write has ended) by query and batch."""
    found = {}
    for app in _names(spark, path):
        if app.startswith(f"{APP}="):
            for batch in _names(spark, f"{path}/{app}"):
                folder = f"{path}/{app}/{batch}"
                if batch.startswith(f"{BATCH}=") and "_SUCCESS" in _names(spark, folder):
                    found[app.partition("=")[2], int(batch.partition("=")[2])] = folder
    return found


def generations(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the published generations, oldest first."""
    names = [n for n in _names(spark, f"{path}/{HOME}") if n.endswith(".json") and not n.startswith(".")]
    return sorted(int(n.removesuffix(".json")) for n in names)


def read_generation(spark: SparkSession, path: str, number: int | None = None) -> Generation:
    """A published generation, the newest by default; number 0 (none) is empty."""
    known = generations(spark, path)
    number = max(known, default=0) if number is None else number
    if not number:
        return Generation()
    if number not in known:
        raise ValueError(f"{path} has no generation {number}")
    return Generation(**json.loads(get_text(spark, f"{path}/{HOME}/{number}.json")))


def read_batches(spark: SparkSession, path: str, folders: list[str]) -> DataFrame:
    """Rows of some batch folders of the table at ``path``, with their app_id and batch_id."""
    df = spark.read.option("basePath", path).parquet(*folders)
    return df.withColumns({APP: F.col(APP).cast("string"), BATCH: F.col(BATCH).cast("long")})


def _segments(spark: SparkSession, path: str, g: Generation) -> DataFrame:
    base = f"{path}/{HOME}/data"
    # the schema as written: partition values are not guessed from folder names
    schema = StructType.fromJson(json.loads(g.schema)).add("segment", "string")
    return spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/segment={s}" for s in g.segments]).drop("segment")


def read_table(
    spark: SparkSession, path: str, generation: int | None = None, up_to: int | dict[str, int] | None = None
) -> DataFrame | None:
    """Rows of the table with their app_id and batch_id; None if nothing is written.

    By default everything: the newest generation and the batches beyond it.
    ``generation=G`` gives the rows that generation G holds. ``up_to=N`` keeps
    the rows of batches up to N, of each query, or by query where it is a dict
    (queries it doesn't name are left out).
    """
    g = read_generation(spark, path, generation)
    parts = [_segments(spark, path, g)] if g.segments else []
    if generation is None:
        beyond = [f for (app, batch), f in batch_folders(spark, path).items() if batch > g.held.get(app, -1)]
        if beyond:
            parts.append(read_batches(spark, path, sorted(beyond)))
    if not parts:
        return None
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    if isinstance(up_to, dict):
        wanted = F.lit(False)
        for app, batch in up_to.items():
            wanted = wanted | ((F.col(APP) == app) & (F.col(BATCH) <= batch))
        out = out.filter(wanted)
    elif up_to is not None:
        out = out.filter(F.col(BATCH) <= up_to)
    return out


def compact(
    spark: SparkSession, path: str, partition_by: str | None = "signal_date", ended: bool | set[str] = False,
) -> int | None:
    """Rewrite the batches beyond the newest generation as one segment partitioned
    by ``partition_by`` and publish the next generation; returns its number, or
    None if there is nothing to do. Only new batches are rewritten, whatever the
    table's size; files are sized by the session's advisory partition size, so a
    busy day has several and quiet days don't share a tiny file per batch.

    ``ended`` names the queries that won't run again (or True for all): their
    newest batch is compacted too. Two compactions at once: the later one to
    publish raises ``FileExistsError`` and changes nothing.
    """
    g = read_generation(spark, path)
    newest: dict[str, int] = {}
    folders = batch_folders(spark, path)
    for app, batch in folders:
        newest[app] = max(batch, newest.get(app, -1))
    over = set(newest) if ended is True else set(ended or ())
    held = {app: n if app in over else n - 1 for app, n in newest.items()}
    new = sorted(f for (app, batch), f in folders.items() if g.held.get(app, -1) < batch <= held[app])
    if not new:
        return None
    rows = read_batches(spark, path, new)
    if g.number:  # all segments of a table are laid out alike
        partition_by = g.partition_by
    elif partition_by not in rows.columns:
        partition_by = None
    name = uuid.uuid4().hex
    out = rows.hint("rebalance", *([partition_by] if partition_by else []))
    writer = out.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(f"{path}/{HOME}/data/segment={name}")
    schema = rows.schema
    if g.schema:  # columns that came later are null in earlier segments
        known = StructType.fromJson(json.loads(g.schema))
        schema = StructType(known.fields + [f for f in schema.fields if f.name not in known.names])
    publish = Generation(
        g.number + 1, [*g.segments, name], {**g.held, **{a: max(n, g.held.get(a, -1)) for a, n in held.items()}},
        partition_by, schema.json(),
    )
    put_text(spark, f"{path}/{HOME}/{publish.number}.json", json.dumps(publish.__dict__))
    return publish.number


def drop_covered(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Remove the batch folders that the newest generation holds, all but the
    ``keep`` newest generations and the segments that none of these name.
    Returns how many batch folders went. Running it again is harmless."""
    numbers = generations(spark, path)
    if not numbers:
        return 0
    kept = [read_generation(spark, path, n) for n in numbers[-max(keep, 1) :]]
    gone = [f for (app, batch), f in batch_folders(spark, path).items() if batch <= kept[-1].held.get(app, -1)]
    for folder in gone:
        drop_folder(spark, folder)
    named = {s for g in kept for s in g.segments}
    for number in numbers[: -len(kept)]:
        drop_folder(spark, f"{path}/{HOME}/{number}.json")
    for segment in _names(spark, f"{path}/{HOME}/data"):
        if segment.startswith("segment=") and segment.partition("=")[2] not in named:
            drop_folder(spark, f"{path}/{HOME}/data/{segment}")
    return len(gone)
