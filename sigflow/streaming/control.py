"""Starting, bounding and stopping streaming queries."""

from __future__ import annotations

from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


def with_trigger(writer: DataStreamWriter, trigger: dict | None) -> DataStreamWriter:
    """``trigger`` as keyword arguments of ``DataStreamWriter.trigger``, e.g.
    ``{"availableNow": True}`` or ``{"processingTime": "10 seconds"}``; None
    keeps the default (next micro-batch as soon as the previous one ends)."""
    return writer.trigger(**trigger) if trigger else writer


def run_to_completion(query: StreamingQuery, timeout_s: float | None = None) -> StreamingQuery:
    """Wait for a bounded (``availableNow``) query; re-raise its failure."""
    finished = query.awaitTermination(timeout_s) if timeout_s else query.awaitTermination()
    if finished is False:
        query.stop()
        raise TimeoutError(f"stream {query.name or query.id} did not finish in {timeout_s}s")
    err = query.exception()
    if err is not None:
        raise err
    return query


def run_for(query: StreamingQuery, seconds: float) -> StreamingQuery:
    """Let a query run for at most ``seconds``, then stop it (time-boxed run).

    Work already committed stays committed; a restart with the same
    checkpoint resumes after the last committed batch.
    """
    if not query.awaitTermination(seconds):
        query.stop()
    err = query.exception()
    if err is not None:
        raise err
    return query


def stop_all(spark) -> None:
    for q in spark.streams.active:
        q.stop()


def run_until_stopped(spark, query: StreamingQuery | None = None) -> None:
    """Block on one query (or on whichever active query ends first) and
    re-raise its failure; used for unbounded ingest."""
    if query is not None:
        query.awaitTermination()
        err = query.exception()
    else:
        spark.streams.awaitAnyTermination()
        err = None
    if err is not None:
        raise err
