"""Metrics that add up over batches.

The state of a scored batch is its distinct scores with positive, negative and
correctly predicted rows. It is stored per batch; states of any batches are summed,
and AUC, KS, average precision and accuracy follow from the sums without the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ordering import grouped_running_sum


def score_state(df: DataFrame, score: str = "score", label: str = "label", by: Sequence[str] = (),
                prediction: str | None = None) -> DataFrame:
    """``by, score, pos, neg, hits`` of a batch (one map-side combined aggregation).

    Rows without a label have no part. A NULL score is a score of its own, below all
    others. ``hits`` is NULL without a prediction; a NULL prediction is no hit."""
    y = F.col(label)
    hits = F.lit(None).cast("long") if prediction is None else F.count_if(
        F.col(prediction).cast("double").eqNullSafe(y.cast("double")))
    return df.filter(y.isNotNull()).groupBy(*by, F.col(score).cast("double").alias("score")).agg(
        F.sum(y.cast("long")).alias("pos"), F.sum(1 - y.cast("long")).alias("neg"), hits.alias("hits"))


def store_batch(state: DataFrame, path: str, batch: str) -> None:
    """Write a batch's state under ``path``. The same batch again replaces itself, so a
    batch that is run twice counts once."""
    state.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def read_states(spark: SparkSession, path: str) -> DataFrame:
    """All stored states, with their ``batch``."""
    return spark.read.option("basePath", path).parquet(path)


def merge_states(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One state from several; merged states merge further."""
    return states.groupBy(*by, "score").agg(*[F.sum(c).alias(c) for c in ("pos", "neg", "hits")])


def threshold_counts(state: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """A merged state with ``tp, fp`` (rows of each class at this score or better) and
    the totals ``p, n`` per ``by``. A hot group spans many tasks."""
    cum = grouped_running_sum(state, list(by), [F.col("score").desc_nulls_last()], ["pos", "neg"],
                              prefix="cum_", totals=True)
    return cum.select(*by, "score", "pos", "neg", "hits", F.col("cum_pos").alias("tp"), F.col("cum_neg").alias("fp"),
                      F.col("total_pos").alias("p"), F.col("total_neg").alias("n"))


def curve_points(state: DataFrame, by: Sequence[str] = (), digits: int = 6) -> DataFrame:
    """``by, threshold, fpr, recall, precision`` at each distinct score."""
    t = threshold_counts(state, by)
    ratio = lambda a, b: F.round(F.try_divide(a.cast("double"), b), digits)
    return t.select(*by, F.col("score").alias("threshold"), ratio(F.col("fp"), F.col("n")).alias("fpr"),
                    ratio(F.col("tp"), F.col("p")).alias("recall"),
                    ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"))


def metrics_from_state(state: DataFrame, by: Sequence[str] = (), digits: int = 6) -> DataFrame:
    """``by, n_rows, n_positive, auc, ks, average_precision, accuracy`` of a merged state.

    KS is the largest distance of the two classes' distributions over all distinct
    scores, in percent (the decile table's is taken at the tile edges only and never
    exceeds it). With one class only, what needs both is NULL."""
    t = threshold_counts(state, by)
    tp, fp, p, n = (F.col(c).cast("double") for c in ("tp", "fp", "p", "n"))
    return t.groupBy(*by).agg(
        F.sum(F.col("pos") + F.col("neg")).alias("n_rows"),
        F.max("p").alias("n_positive"),
        F.round(F.try_divide(F.sum(F.col("neg") * (tp - F.col("pos") / 2.0)), F.max(p * n)), digits).alias("auc"),
        F.round(F.max(F.abs(F.try_divide(tp, p) - F.try_divide(fp, n))) * 100, 4).alias("ks"),
        F.round(F.try_divide(F.sum(F.col("pos") * F.try_divide(tp, tp + fp)), F.max(p)), digits).alias("average_precision"),
        F.round(F.try_divide(F.sum("hits").cast("double"), F.sum(F.col("pos") + F.col("neg"))), digits).alias("accuracy"))
