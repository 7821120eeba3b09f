"""Feature preparation: category indexing, vector assembly, scaling,
normalisation, imputation, feature names from metadata, PCA / SVD and the
full preparation chain. Fitting runs on Spark (MLlib estimators); only
bounded results (labels per category, d x d matrices) reach the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.feature import PCA, Imputer, Normalizer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import character_columns, is_missing, numeric_columns
from ..session import scratch_path
from . import ordering, sampling


class CategoryDictionary:
    """Indices of the categories of several columns, as a table ``column, label,
    index``: most frequent label first, ties by label, from 0 in each column; NULL has
    no entry. The labels stay on the cluster whatever their number."""

    def __init__(self, df: DataFrame, cols: Sequence[str], suffix: str = "_index") -> None:
        self.cols, self.suffix = list(cols), suffix
        counts = df.select(F.explode(F.array(*[F.struct(
            F.lit(c).alias("column"), F.col(c).cast("string").alias("label")) for c in self.cols])).alias("x")).select(
            "x.*").filter("label IS NOT NULL").groupBy("column", "label").agg(F.count("*").alias("n"))
        path = scratch_path(df.sparkSession, "category-counts")
        counts.write.parquet(path)
        counts = df.sparkSession.read.parquet(path)
        numbered = ordering.grouped_row_number(counts, ["column"], [F.desc("n"), "label"], out="index")
        path = scratch_path(df.sparkSession, "categories")
        numbered.select("column", "label", (F.col("index") - 1).cast("double").alias("index")).write.parquet(path)
        #: Written, so that its true size decides how it is joined.
        self.table = df.sparkSession.read.parquet(path)
        #: Labels of each column: the index of NULL and of labels not seen.
        self.sizes = {r["column"]: r["n"] for r in self.table.groupBy("column").agg(F.count("*").alias("n")).collect()}

    def _of(self, c: str) -> DataFrame:
        return self.table.filter(F.col("column") == c)

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` plus the index of each column. Labels that hold much of the rows are
        split by adaptive execution where the dictionary is too large to broadcast."""
        for c in self.cols:
            out = f"{c}{self.suffix}"
            of = self._of(c).select(F.col("label").alias("_label"), F.col("index").alias(out))
            df = df.join(of, F.col(c).cast("string") == F.col("_label"), "left").drop("_label").fillna(
                float(self.sizes.get(c, 0)), subset=[out])
        return df

    def inverse(self, df: DataFrame, cols: Sequence[str], out_suffix: str = "_label") -> DataFrame:
        """``df`` plus the label of each column's index; NULL for one not in the table."""
        for c in cols:
            of = self._of(c).select(F.col("index").alias("_index"), F.col("label").alias(f"{c}{out_suffix}"))
            df = df.join(of, F.col(f"{c}{self.suffix}") == F.col("_index"), "left").drop("_index")
        return df


def category_index(df: DataFrame, cols: Sequence[str], suffix: str = "_index"):
    """Most frequent value of each column -> 0, ties by value; unseen and NULL values
    get the index after the last. Returns (indexed DataFrame, CategoryDictionary)."""
    model = CategoryDictionary(df, cols, suffix)
    return model.transform(df), model


def index_to_category(df: DataFrame, model: CategoryDictionary, cols: Sequence[str], suffix: str = "_index",
                      out_suffix: str = "_label") -> DataFrame:
    """Inverse of ``category_index`` through its dictionary."""
    if suffix != model.suffix:
        df = df.withColumnsRenamed({f"{c}{suffix}": f"{c}{model.suffix}" for c in cols})
        return model.inverse(df, cols, out_suffix).withColumnsRenamed({f"{c}{model.suffix}": f"{c}{suffix}" for c in cols})
    return model.inverse(df, cols, out_suffix)


def assemble_vectors(df: DataFrame, features: Sequence[str], target: str | None = None,
                     keep: Sequence[str] = (), out: str = "features") -> DataFrame:
    """Assemble numeric columns into a vector; keep target, extra columns and
    the vector (the reference's ``AssembleVectors``)."""
    vec = VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep")
    res = vec.transform(df)
    cols = list(keep) + ([target] if target else []) + [out]
    return res.select(*cols)


def scale_pipeline(features: Sequence[str], out: str = "scaled") -> Pipeline:
    """Assemble + StandardScaler(withStd, no centring), fitted on train and
    applied to other splits (the reference's ``scaled_dataframes``)."""
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol="_vec", handleInvalid="keep"),
        StandardScaler(inputCol="_vec", outputCol=out, withStd=True, withMean=False)])


def vector_columns(df: DataFrame, vec: str, names: Sequence[str], digits: int | None = 6,
                   keep: Sequence[str] = ()) -> DataFrame:
    """Spread a vector column into named double columns (for comparison)."""
    arr = vector_to_array(F.col(vec))
    cols = [arr[i].alias(n) if digits is None else F.round(arr[i], digits).alias(n)
            for i, n in enumerate(names)]
    return df.select(*keep, *cols)


def l1_normalize(df: DataFrame, features: Sequence[str], out: str = "normalized") -> DataFrame:
    vec = VectorAssembler(inputCols=list(features), outputCol="_vec", handleInvalid="keep")
    return Normalizer(inputCol="_vec", outputCol=out, p=1.0).transform(vec.transform(df))


def mean_impute(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Replace NULL and NaN by the column mean over the other values, in place."""
    imp = Imputer(inputCols=list(cols), outputCols=[f"{c}__imp" for c in cols], strategy="mean")
    res = imp.fit(df).transform(df)
    return res.drop(*cols).withColumnsRenamed({f"{c}__imp": c for c in cols})


def feature_names(df: DataFrame, vec: str = "features") -> DataFrame:
    """Vector metadata -> ``(idx, name)`` over all attribute kinds."""
    meta = df.schema[vec].metadata.get("ml_attr", {}).get("attrs", {})
    rows = sorted((int(a["idx"]), a["name"]) for kind in meta.values() for a in kind)
    return df.sparkSession.createDataFrame(rows, "idx int, name string")


def pca_fit(df: DataFrame, features: Sequence[str], k: int = 3, scaled: bool = False):
    """PCA fit; a NULL feature raises (impute first, so no row is lost)."""
    stages = [VectorAssembler(inputCols=list(features), outputCol="_vec", handleInvalid="error")]
    src = "_vec"
    if scaled:
        stages.append(StandardScaler(inputCol="_vec", outputCol="_svec", withStd=True,
                                     withMean=False))
        src = "_svec"
    stages.append(PCA(k=k, inputCol=src, outputCol="pca"))
    return Pipeline(stages=stages).fit(df)


def pca_explained(model, features: Sequence[str], spark) -> DataFrame:
    """Scree table: component, explained variance ratio, cumulative."""
    ev = model.stages[-1].explainedVariance.toArray()
    cum = np.cumsum(ev)
    rows = [(i + 1, float(ev[i]), float(cum[i])) for i in range(len(ev))]
    return spark.createDataFrame(rows, "component int, explained double, cumulative double")


def pca_loadings(model, features: Sequence[str], spark) -> DataFrame:
    """Weight of every feature in every component: ``feature, component, loading``."""
    pc = model.stages[-1].pc.toArray()
    rows = [(f, j + 1, float(pc[i, j])) for i, f in enumerate(features)
            for j in range(pc.shape[1])]
    return spark.createDataFrame(rows, "feature string, component int, loading double")


#: Triangles that one task of the tree takes in.
FAN = 32


def triangular_factor(df: DataFrame, features: Sequence[str]) -> np.ndarray:
    """R of the QR decomposition of the row matrix, d x d on the driver: X = QR, so
    R has X's singular values and right vectors without the squares that X^T X would
    lose digits to. Each task folds its Arrow batches into one triangle; triangles
    meet in a tree of groups of ``FAN``, three levels deep. The number of features is
    bounded by d x d doubles times ``FAN`` in a task, not by generated code. Rows
    beyond the rank are zero. A missing value (NULL or NaN) raises: leaving out rows
    would change the matrix unsaid."""
    import pandas as pd
    import pyarrow as pa

    d, schema = len(features), "r array<double>, missing long"

    def of_rows(batches):
        r, missing = np.zeros((0, d)), 0
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            whole = ~np.isnan(x).any(axis=1)
            missing += int((~whole).sum())
            r = np.linalg.qr(np.vstack([r, x[whole]]), mode="r")
        yield pa.RecordBatch.from_arrays(
            [pa.array([r.ravel()], pa.list_(pa.float64())), pa.array([missing], pa.int64())],
            names=["r", "missing"])

    def of_triangles(pdf: pd.DataFrame) -> pd.DataFrame:
        r = np.linalg.qr(np.vstack([np.reshape(x, (-1, d)) for x in pdf["r"]]), mode="r")
        return pd.DataFrame({"place": [int(pdf["place"].iloc[0]) // FAN], "r": [r.ravel()],
                             "missing": [int(pdf["missing"].sum())]})

    parts = (df.select(*[F.col(f).cast("double").alias(f"f{i}") for i, f in enumerate(features)])
             .mapInArrow(of_rows, schema).withColumn("place", F.spark_partition_id().cast("long")))
    for _ in range(3):
        parts = parts.groupBy(F.expr(f"place div {FAN}")).applyInPandas(of_triangles, f"place long, {schema}")
    r, missing = np.zeros((0, d)), 0
    for row in parts.toLocalIterator():  # one for each FAN^3 tasks of the scan
        r = np.linalg.qr(np.vstack([r, np.reshape(row["r"], (-1, d))]), mode="r")
        missing += row["missing"]
    if missing:
        raise ValueError(f"{missing} rows have a missing feature: impute them first")
    return np.vstack([r, np.zeros((d - len(r), d))])


def svd(df: DataFrame, features: Sequence[str], k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Truncated SVD of the row matrix through its triangular factor: singular values
    and right singular vectors V (d x k), each column signed so that its largest
    entry is positive."""
    _, values, rows = np.linalg.svd(triangular_factor(df, features))
    vecs = rows[:k].T
    top = vecs[np.abs(vecs).argmax(axis=0), np.arange(vecs.shape[1])]
    return values[:k], vecs * np.where(top < 0, -1.0, 1.0)


def svd_values(df: DataFrame, features: Sequence[str], k: int = 5) -> DataFrame:
    """Singular values: ``component, singular_value``."""
    rows = [(i + 1, float(v)) for i, v in enumerate(svd(df, features, k)[0])]
    return df.sparkSession.createDataFrame(rows, "component int, singular_value double")


def svd_vectors(df: DataFrame, features: Sequence[str], k: int = 5) -> DataFrame:
    """Right singular vectors: ``feature, component, weight``."""
    v = svd(df, features, k)[1]
    rows = [(f, j + 1, float(v[i, j])) for i, f in enumerate(features) for j in range(v.shape[1])]
    return df.sparkSession.createDataFrame(rows, "feature string, component int, weight double")


def svd_project(df: DataFrame, features: Sequence[str], k: int = 5, keep: Sequence[str] = ()):
    """Left singular vectors, one row per row: U = X V S^-1 as column
    expressions (distributed); 0 for a singular value of 0."""
    values, v = svd(df, features, k)
    cols = []
    for j, s in enumerate(values):
        expr = F.lit(0.0)
        for i, f in enumerate(features):
            expr = expr + F.col(f).cast("double") * float(v[i, j] / s if s else 0.0)
        cols.append(expr.alias(f"u{j + 1}"))
    return df.select(*keep, *cols)


# ----------------------------------------------------------- full preparation
def missing_keep_list(df: DataFrame, max_share: float = 0.75) -> list[str]:
    """Columns whose missing share is <= max_share (one aggregation)."""
    cols = df.columns
    row = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count(F.when(is_missing(df, c), 1)).alias(c) for c in cols]).first()
    n = row["_n"] or 1
    return [c for c in cols if row[c] / n <= max_share]


def prepare_dataset(x: DataFrame, y: DataFrame, key: str, target: str,
                    seed: int = 12345, weights=(0.4, 0.3, 0.3)):
    """Reference chain: missing filter -> variable types -> category index ->
    fill numerics with 0 -> rename X_index back to X -> join label on a real
    key -> train/valid/test split -> assemble + scale fitted on train.
    Returns (DataFrame with a ``split`` column and ``scaled`` vector, features)."""
    keep = missing_keep_list(x)
    x = x.select(*keep)
    chars = [c for c in character_columns(x) if c != key]
    nums = [c for c in numeric_columns(x) if c != key]
    if chars:
        x, _ = category_index(x, chars)
        x = x.drop(*chars).withColumnsRenamed({f"{c}_index": c for c in chars})
    x = x.fillna(0, subset=nums)
    data = x.join(y, key, "inner")
    features = nums + chars
    parts = sampling.labelled_split(data, list(weights), ["train", "valid", "test"], seed=seed)
    model = scale_pipeline(features).fit(parts.filter(F.col("split") == "train"))
    return model.transform(parts), features
