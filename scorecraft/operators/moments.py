"""Least squares from sums that add up.

One scan leaves, for each group, the sums of products of 1, the features and the
label. A fit on all rows but a group's is the total minus the group's sums, so
leaving out each of any number of groups (or folds) in turn needs no second scan
and no refit on rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path


def group_moments(df: DataFrame, group: str, features: Sequence[str], label: str) -> DataFrame:
    """``group, moments``: the upper triangle, by rows, of the sum of z z^T over the
    group's rows, z = (1, features, label). Tasks sum their batches before anything is
    shuffled, so a group with most rows costs no more than another. A NULL group is a
    group; a missing feature or label (NULL or NaN) raises."""
    import pyarrow as pa

    cols = [*features, label]
    upper = np.triu_indices(len(cols) + 1)

    def sums(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            coded = batch.column(0).dictionary_encode(null_encoding="encode")
            code = coded.indices.to_numpy(zero_copy_only=False)
            z = np.column_stack([np.ones(batch.num_rows)] + [
                c.to_numpy(zero_copy_only=False) for c in batch.columns[1:]])
            if np.isnan(z).any():
                raise ValueError("rows have a missing feature or label: impute them first")
            order = np.argsort(code, kind="stable")
            parts = np.split(z[order], np.flatnonzero(np.diff(code[order])) + 1)
            yield pa.RecordBatch.from_arrays(
                [coded.dictionary.take(pa.array(np.unique(code))),
                 pa.array([(p.T @ p)[upper] for p in parts], pa.list_(pa.float64()))],
                names=["group", "moments"])

    kind = df.schema[group].dataType.simpleString()
    rows = df.select(F.col(group).alias("group"), *[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    return (
        rows.mapInArrow(sums, f"group {kind}, moments array<double>")
        .select("group", F.posexplode("moments").alias("place", "value"))
        .groupBy("group", "place").agg(F.sum("value").alias("value"))
        .groupBy("group").agg(F.array_sort(F.collect_list(F.struct("place", "value"))).alias("m"))
        .select("group", F.col("m.value").alias("moments")))


def leave_one_group_out_linear(df: DataFrame, group: str, features: Sequence[str], label: str) -> DataFrame:
    """For each group, least squares with intercept on the rows of all other groups:
    ``group, n_train, n_test, intercept, coefficients, train_r2, test_r2``.

    The rows are read once. A constant feature gets coefficient 0, dependent features
    share theirs (smallest norm). Without other rows all results are NULL; R2 is NULL on
    a side whose label is constant. The sums are of raw products: a feature whose mean is
    millions of times its spread should be centred first."""
    spark, d = df.sparkSession, len(features)
    path = scratch_path(spark, "group-moments")
    group_moments(df, group, features, label).write.parquet(path)
    per = spark.read.parquet(path)
    total = np.array([r["value"] for r in per.select(F.posexplode("moments").alias("place", "value")).groupBy(
        "place").agg(F.sum("value").alias("value")).orderBy("place").collect()])  # (d+2)(d+3)/2 numbers

    def solve(batches):
        import pandas as pd

        def centred(m):
            full = np.zeros((d + 2, d + 2))
            full[np.triu_indices(d + 2)] = m
            full += np.triu(full, 1).T
            n = round(full[0, 0])
            mean = full[0, 1:] / max(n, 1)
            return n, mean, full[1:, 1:] - n * np.outer(mean, mean), np.diag(full)[1:]

        def r2(side, w, intercept):
            n, mean, c, raw = side
            if n < 2 or c[d, d] <= 1e-12 * raw[d]:
                return None
            off = mean @ w - intercept
            return float(1 - (w @ c @ w + n * off * off) / c[d, d])

        for pdf in batches:
            out = []
            for name, m in zip(pdf["group"], pdf["moments"], strict=True):
                train, test = centred(total - m), centred(np.asarray(m))
                n, mean, c, raw = train
                if not n:
                    out.append((name, 0, test[0], None, None, None, None))
                    continue
                spread = np.diag(c)[:d]
                scale = np.where(spread > 1e-12 * raw[:d], np.sqrt(np.maximum(spread, 1e-300)), np.inf)
                beta = np.linalg.lstsq(c[:d, :d] / np.outer(scale, scale), c[:d, d] / scale, rcond=1e-12)[0] / scale
                intercept = float(mean[d] - mean[:d] @ beta)
                w = np.r_[-beta, 1.0]
                out.append((name, n, test[0], intercept, beta.tolist(), r2(train, w, intercept), r2(test, w, intercept)))
            yield pd.DataFrame(out, columns=["group", "n_train", "n_test", "intercept", "coefficients", "train_r2", "test_r2"])

    kind = per.schema["group"].dataType.simpleString()
    return per.withColumn("group", F.col("group").cast("string")).mapInPandas(
        solve, "group string, n_train long, n_test long, intercept double, coefficients array<double>, "
        "train_r2 double, test_r2 double").withColumn("group", F.col("group").cast(kind))
