"""Run log and model store: parameters and metrics of a run appended to a
Parquet table; fitted pipelines saved to and loaded from a path; batch
scoring of a table with a stored model."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.models import probability_of_one


def log_run(spark: SparkSession, path: str, params: Mapping[str, float],
            metrics: DataFrame | None = None, run_id: str | None = None) -> str:
    """Append ``run_id, kind, name, value`` rows: params given as a mapping and
    metrics as a DataFrame of one row (each column a metric), so metric values
    are written by Spark without passing through the driver."""
    run_id = run_id or uuid.uuid4().hex[:12]
    rows = [(run_id, "param", k, float(v)) for k, v in params.items()]
    parts = [spark.createDataFrame(rows, "run_id string, kind string, name string, value double")]
    if metrics is not None:
        stacked = metrics.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value"))
            for c in metrics.columns])).alias("m"))
        parts.append(stacked.select(F.lit(run_id).alias("run_id"), F.lit("metric").alias("kind"),
                                    "m.name", "m.value"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out.write.mode("append").parquet(path)
    return run_id


def read_runs(spark: SparkSession, path: str, run_id: str | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.filter(F.col("run_id") == run_id) if run_id else df


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def batch_score(model: PipelineModel, df: DataFrame, keep=()) -> DataFrame:
    """rawPrediction, probability (and its class-1 value), prediction, label."""
    pred = probability_of_one(model.transform(df))
    return pred.select(*keep, "rawPrediction", "probability", "p1", "prediction", "label")
