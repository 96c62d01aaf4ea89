"""Regression on the hourly report: index the band, assemble, split, fit,
score one day, evaluate."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sigflow.operators.ml import (
    assemble_features,
    coefficients_frame,
    fit_label_index,
    fit_linear_regression,
    hash_split,
    model_pipeline,
    random_split,
    save_pipeline,
)
from sigflow.plans.analysis import hourly_report
from sigflow.schemas import LR_FEATURES, LR_LABEL, LR_SCORE_DAY
from sigflow.session import ensure_checkpoint_dir
from sigflow.streaming.sinks import batch_folder_writer, start_foreach_batch


@dataclass
class ModelFrame:
    """The renamed hourly report and the band indexer fitted on all of it."""

    report: DataFrame
    indexer: StringIndexerModel

    def indexed(self, rows: DataFrame | None = None) -> DataFrame:
        return self.indexer.transform(self.report if rows is None else rows)


def ml_frame(
    readings: DataFrame, mapping: DataFrame | None = None, materialize: bool = True
) -> ModelFrame:
    """Renamed hourly report (double means) and its band indexer.

    The report is one row per hour, tiny next to the readings, and the model
    steps read it several times (index fit, model fit, scoring, metrics). With
    ``materialize`` it is computed once and checkpointed to the shared
    checkpoint folder, which also cuts the lineage back to the raw scan.
    """
    report = hourly_report(readings, cast="double", mapping=mapping)
    if materialize:
        ensure_checkpoint_dir(report.sparkSession)
        report = report.checkpoint(eager=True)
    return ModelFrame(report, fit_label_index(report))


def fit_on_split(
    frame: ModelFrame | DataFrame, features=None, label: str = LR_LABEL, key_cols: list[str] | None = None, **params
):
    """Assemble, split 80/20 and fit on the 80 part.

    The split is random with seed 42; with ``key_cols`` it follows the hash of
    the row key, which other engines can reproduce. Returns ``(model,
    test_frame)``; the test frame is assembled.
    """
    features = features or LR_FEATURES
    indexed = frame.indexed() if isinstance(frame, ModelFrame) else frame
    assembled = assemble_features(indexed, features)
    if key_cols:
        marked = hash_split(assembled, key_cols)
        train, test = (marked.filter(m).drop("is_train") for m in ("is_train", "not is_train"))
    else:
        train, test = random_split(assembled)
    return fit_linear_regression(train, label=label, **params), test


def predict_day(model, frame: ModelFrame | DataFrame, day: str = LR_SCORE_DAY, features=None,
                label: str = LR_LABEL) -> DataFrame:
    """Score one day. The day filter runs before the ML stages (their UDF
    projections stop filters from moving down), so it reaches the scan;
    scoring is per row, so rows and values are unchanged."""
    features = features or LR_FEATURES
    on_day = F.col("signal_date") == F.lit(day).cast("date")
    if isinstance(frame, ModelFrame):
        day_rows = frame.indexed(frame.report.filter(on_day))
    else:
        day_rows = frame.filter(on_day)
    scored = model.transform(assemble_features(day_rows, features))
    return scored.select("signal_date", "hour", label, "prediction")


def save_model(frame: ModelFrame, model, path: str, features=None) -> PipelineModel:
    """Save the fitted steps as one pipeline that later jobs load with
    :func:`sigflow.operators.ml.load_pipeline`; returns the pipeline."""
    pipeline = model_pipeline(frame.indexer, features or LR_FEATURES, model)
    save_pipeline(pipeline, path)
    return pipeline


def score_report(pipeline: PipelineModel, report: DataFrame, day: str | None = None, label: str = LR_LABEL) -> DataFrame:
    """Score the renamed hourly report, bounded or a stream, with a loaded pipeline.
    With ``day`` only that day: the filter runs before the pipeline's stages and
    reaches the scan."""
    if day:
        report = report.filter(F.col("signal_date") == F.lit(day).cast("date"))
    return pipeline.transform(report).select("signal_date", "hour", label, "prediction")


def start_scoring(
    pipeline: PipelineModel, report: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Score a stream of report rows into the lake table at ``path``, a folder per (query id, batch)."""
    return start_foreach_batch(score_report(pipeline, report), batch_folder_writer(path), checkpoint, trigger=trigger)


def model_coefficients(model, features=None) -> DataFrame:
    spark = model.summary.predictions.sparkSession
    return coefficients_frame(spark, model, features or LR_FEATURES)
