"""Readers, writers and round trips.

Writes go to paths the caller names; the round-trip helpers use a fresh folder
under the shared checkpoint folder (``scratch_path``), never a machine-local
temporary folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import scratch_path


# ---------------------------------------------------------------------- read
def read_csv(spark: SparkSession, path: str, header: bool = True, sep: str = ",",
             infer_schema: bool = False, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV scan. Without a schema and inference every column is a string (the
    reference's default); prefer an explicit ``schema`` on large inputs since
    inference costs an extra pass."""
    reader = spark.read.format("csv").option("header", header).option("sep", sep)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer_schema:
        reader = reader.option("inferSchema", True)
    return reader.load(path)


def read_csv_headerless(spark: SparkSession, path: str) -> DataFrame:
    """``spark.read.csv(path)`` defaults: no header, ``_c0 … _cN`` strings."""
    return spark.read.csv(path)


def range_source(spark: SparkSession, start: int, end: int, num_partitions: int | None = None):
    """Generated integer range as a distributed source (``id`` column)."""
    return spark.range(start, end, 1, num_partitions)


def sql_on_view(df: DataFrame, view: str, sql: str) -> DataFrame:
    """Register ``df`` as a temp view and run ``sql`` against it."""
    df.createOrReplaceTempView(view)
    return df.sparkSession.sql(sql)


def local_lookup(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Small literal lookup table (bounded driver data only)."""
    return spark.createDataFrame(list(rows), schema)


# --------------------------------------------------------------------- write
def write_csv(df: DataFrame, path: str, sep: str = "|", header: bool = False,
              mode: str = "overwrite") -> str:
    """One file per partition, as Spark writes by default."""
    df.write.mode(mode).option("delimiter", sep).option("header", header).csv(path)
    return path


def write_single_csv(df: DataFrame, path: str, sep: str = "|", header: bool = False,
                     mode: str = "overwrite") -> str:
    """One output file via ``coalesce(1)``: for small (aggregated) results only,
    since all rows pass through one task."""
    df.coalesce(1).write.mode(mode).option("delimiter", sep).option("header", header).csv(path)
    return path


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], fmt: str = "parquet",
                      mode: str = "overwrite") -> str:
    """Directory-partitioned write; readers prune partitions on ``by`` filters.
    Rows are clustered by the partition columns so that a task writes few files;
    the REBALANCE hint lets adaptive execution split a value's rows over several
    writers when they are many."""
    (df.hint("rebalance", *by).write.mode(mode).partitionBy(*by).format(fmt).save(path))
    return path


def save_table(df: DataFrame, name: str, path: str | None = None, mode: str = "error",
               fmt: str = "parquet") -> str:
    """Save as a catalog table (external at ``path`` when given). A table of
    that name is only replaced when ``mode`` says so."""
    w = df.write.mode(mode).format(fmt)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)
    return name


def save_bucketed(df: DataFrame, path: str, by: Sequence[str], buckets: int) -> str:
    """External catalog table at ``path``, dealt by a hash of ``by`` into ``buckets``
    and sorted by it inside each; named after the path. Tables of the same buckets join
    on these columns, or group by them, without a shuffle or a sort. The rows are dealt
    before they are written, so that a bucket is one file whose order readers can use.
    A key that holds most rows makes one bucket long: join such a table unbucketed."""
    name = path.rstrip("/").rsplit("/", 1)[1].replace("-", "_")
    (df.repartition(buckets, *by).write.bucketBy(buckets, *by).sortBy(*by).format("parquet")
     .option("path", path).saveAsTable(name))
    return name


def export_report(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> str:
    """Write a report table (decile table, metrics, importances)."""
    df.write.mode(mode).format(fmt).save(path)
    return path


def fresh_path(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, name)
