"""Regression model on the hourly table (Spark MLlib) and its evaluation.

Fitting uses MLlib's ``LinearRegression``: with few features its normal-
equation solver builds the Gram matrix in one distributed aggregation and
solves it on the driver (size features^2, independent of row count). All
evaluation outputs (metrics, residual histogram, scatter bins) are Spark
aggregates, so nothing row-sized travels to the driver.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from sigflow.schemas import LR_FEATURES, LR_LABEL, LR_SPLIT_SEED, LR_SPLIT_WEIGHTS


def fit_label_index(
    df: DataFrame,
    input_col: str = "generation_mapping",
    output_col: str = "generation_status_index",
) -> StringIndexerModel:
    """Label indexer: most frequent label 0.0, ties alphabetical.

    Fitting counts labels with a distributed aggregate and keeps only the
    distinct labels on the driver (a handful of bands here).
    """
    return StringIndexer(inputCol=input_col, outputCol=output_col).fit(df)


def label_index(
    df: DataFrame,
    input_col: str = "generation_mapping",
    output_col: str = "generation_status_index",
) -> DataFrame:
    return fit_label_index(df, input_col, output_col).transform(df)


def drop_invalid_features(df: DataFrame, features: list[str] | None = None) -> DataFrame:
    """Rows whose features are all present: null, and NaN for floating types,
    are invalid (what ``VectorAssembler(handleInvalid="skip")`` drops)."""
    features = features or LR_FEATURES
    types = {f.name: f.dataType for f in df.schema.fields}
    cond = F.lit(True)
    for c in features:
        cond = cond & F.col(c).isNotNull()
        if isinstance(types[c], (DoubleType, FloatType)):
            cond = cond & ~F.isnan(F.col(c))
    return df.filter(cond)


def assemble_features(
    df: DataFrame, features: list[str] | None = None, output_col: str = "features"
) -> DataFrame:
    assembler = VectorAssembler(
        inputCols=features or LR_FEATURES, outputCol=output_col, handleInvalid="skip"
    )
    return assembler.transform(df)


def random_split(df: DataFrame, weights=None, seed: int = LR_SPLIT_SEED):
    """MLlib-style random split; which rows land where depends on partitioning."""
    return df.randomSplit(weights or LR_SPLIT_WEIGHTS, seed=seed)


def split_key_bucket(key_cols: list[str]):
    """Bucket 0-99 from the MD5 of the row key (first 28 bits), the same in any
    engine that has MD5, so a split can be reproduced outside Spark."""
    key = F.concat_ws(" ", *[F.col(c).cast("string") for c in key_cols])
    return F.conv(F.substring(F.md5(key), 1, 7), 16, 10).cast("bigint") % 100


def hash_split(df: DataFrame, key_cols: list[str], train_fraction: float = 0.8) -> DataFrame:
    """Add ``is_train``: a deterministic split on the row key."""
    threshold = int(round(train_fraction * 100))
    return df.withColumn("is_train", split_key_bucket(key_cols) < threshold)


def fit_linear_regression(
    train: DataFrame,
    label: str = LR_LABEL,
    features_col: str = "features",
    **params,
) -> LinearRegressionModel:
    return LinearRegression(featuresCol=features_col, labelCol=label, **params).fit(train)


def model_pipeline(
    indexer: StringIndexerModel, features: list[str], model: LinearRegressionModel
) -> PipelineModel:
    """The fitted steps as one pipeline: label index, assembly, regression. Unlike
    the bare indexer it gives a label that the fit has not seen an index of its
    own, after all known ones, so new data can't end a scoring job."""
    seen = indexer.copy().setHandleInvalid("keep")
    assembler = VectorAssembler(inputCols=features, outputCol=model.getFeaturesCol(), handleInvalid="skip")
    return PipelineModel([seen, assembler, model])


def save_pipeline(pipeline: PipelineModel, path: str) -> None:
    """Write a fitted pipeline (overwrite); any later job can load it."""
    pipeline.write().overwrite().save(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def coefficients_frame(spark, model: LinearRegressionModel, features: list[str]) -> DataFrame:
    """One row per term (intercept first): ``term, coefficient``; its size is
    the feature count."""
    rows = [("intercept", float(model.intercept))] + [
        (f, float(c)) for f, c in zip(features, model.coefficients.toArray())
    ]
    return spark.createDataFrame(rows, "term string, coefficient double")


def regression_metrics(
    df: DataFrame, label: str = LR_LABEL, prediction: str = "prediction"
) -> DataFrame:
    """RMSE, MAE and R^2 (as MLlib's evaluator defines them) in one pass.

    R^2 = 1 - sum((y - p)^2) / sum((y - mean(y))^2); rows with a null label or
    prediction are ignored.
    """
    y, p = F.col(label), F.col(prediction)
    # Aggregates skip nulls, so no filter is needed (a filter on the prediction
    # would be pushed below the model's projection and score every row twice).
    err = y - p
    agg = df.agg(
        F.count(err).alias("n"),
        F.sum(err * err).alias("_sse"),
        F.avg(F.abs(err)).alias("mae"),
        F.var_pop(F.when(err.isNotNull(), y)).alias("_var"),
    )
    return agg.select(
        "n",
        F.sqrt(F.col("_sse") / F.col("n")).alias("rmse"),
        "mae",
        (F.lit(1.0) - F.col("_sse") / (F.col("_var") * F.col("n"))).alias("r2"),
    )


def residual_histogram(
    df: DataFrame, width: float, label: str = LR_LABEL, prediction: str = "prediction"
) -> DataFrame:
    """Counts of ``label - prediction`` in bins ``[k*width, (k+1)*width)``."""
    r = F.col(label) - F.col(prediction)
    binned = df.filter(r.isNotNull()).select(F.floor(r / width).alias("bin"))
    return binned.groupBy("bin").agg(F.count(F.lit(1)).alias("n")).select(
        "bin",
        (F.col("bin") * width).alias("bin_lo"),
        ((F.col("bin") + 1) * width).alias("bin_hi"),
        "n",
    )


# KLL sketches: the rank of a quantile is off by less than this share of the rows at
# the default size, with a chance of 99 %; sketches of up to SKETCH_EXACT rows are exact.
SKETCH_K = 200
SKETCH_RANK_ERROR = 0.0133
SKETCH_EXACT = 200


def residual_sketches(
    df: DataFrame, by: list[str] | None = None, label: str = LR_LABEL, prediction: str = "prediction", k: int = SKETCH_K
) -> DataFrame:
    """Quantile sketch of ``label - prediction`` per group: ``(*by, sketch)``. Of a few
    kilobytes whatever the rows; sketches of parts (days, batches, engines'
    partitions) can be stored and merged later by :func:`sketch_bounds`."""
    residual = (F.col(label) - F.col(prediction)).alias("residual")
    rows = df.select(*(by or []), residual).filter(F.col("residual").isNotNull() & ~F.isnan("residual"))
    return rows.groupBy(*(by or [])).agg(F.kll_sketch_agg_double("residual", F.lit(k)).alias("sketch"))


def sketch_bounds(sketches: DataFrame, bins: int) -> DataFrame:
    """One row per bin, ``(bin, lo, hi)``: bounds between the merged sketches' quantiles
    at ``1/bins, 2/bins, ...``, the first and last open (null). Bins whose bounds
    coincide (ties) are one. No rows if nothing was sketched."""
    merged = sketches.agg(F.kll_merge_agg_double("sketch").alias("sketch")).filter("sketch IS NOT NULL")
    merged = merged.filter(F.kll_sketch_get_n_double("sketch") > 0)
    ranks = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    cuts = F.array_distinct(F.kll_sketch_get_quantile_double("sketch", ranks)) if bins > 1 else F.array().cast("array<double>")
    none = F.array(F.lit(None).cast("double"))
    edges = merged.select(cuts.alias("cuts")).select(F.concat(none, "cuts").alias("lo"), F.concat("cuts", none).alias("hi"))
    return edges.select(F.posexplode(F.arrays_zip("lo", "hi")).alias("bin", "b")).select("bin", "b.lo", "b.hi")


def residual_quantile_bins(
    df: DataFrame, bins: int = 10, label: str = LR_LABEL, prediction: str = "prediction", by: list[str] | None = None
) -> DataFrame:
    """Distribution of the residuals in bins of about equal counts, ``(bin, lo, hi, n)``:
    a row is in the bin with ``lo <= residual < hi``. The bounds come from merged
    sketches (of each ``by`` group, else of all rows), so they follow the data
    however wide or skewed it is; the counts over them are exact.

    The bounds are taken to the driver once, at most ``bins`` of them, as another
    sketch of the same rows may give others.
    """
    spark = df.sparkSession
    bounds = sketch_bounds(residual_sketches(df, by, label, prediction), bins).orderBy("bin").collect()
    r = F.col(label) - F.col(prediction)
    rows = df.select(r.alias("r")).filter(F.col("r").isNotNull() & ~F.isnan("r"))
    at = F.lit(0)
    for b in bounds[1:]:
        at = at + F.when(F.col("r") >= b.lo, 1).otherwise(0)
    counts = rows.select(at.alias("at")).groupBy("at").agg(F.count(F.lit(1)).alias("n"))
    listed = spark.createDataFrame([tuple(b) for b in bounds], "bin int, lo double, hi double")
    return listed.join(counts, F.col("bin") == F.col("at"), "left").select("bin", "lo", "hi", F.coalesce("n", F.lit(0)).alias("n"))


def scatter_bins(
    df: DataFrame, width: float, label: str = LR_LABEL, prediction: str = "prediction"
) -> DataFrame:
    """Actual-vs-predicted point cloud as 2-D bin counts."""
    return (
        df.filter(F.col(label).isNotNull() & F.col(prediction).isNotNull())
        .select(
            F.floor(F.col(label) / width).alias("actual_bin"),
            F.floor(F.col(prediction) / width).alias("predicted_bin"),
        )
        .groupBy("actual_bin", "predicted_bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )

