"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def written(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back: cuts the lineage, survives lost executors, and pins rows whose order
    or partition a later step relies on. ``codec``: the files' compression, the
    session's by default; whole texts take less disk by ``TEXTS``."""
    path = scratch_path(df.sparkSession, name)
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Compression of written copies of whole texts.
TEXTS = "zstd"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


#: Name of the copy of this package that executors are given.
PACKAGE = "scorecraft-package"
#: Bytes of one Arrow batch that a Python step of this subpackage asks for.
BATCH_BYTES = 8 << 20


def prepare(spark: SparkSession) -> None:
    """What the Python steps of this subpackage need of a session.

    Bounds the Arrow batches by bytes, so that long texts can't make a batch of
    the usual row count outgrow a worker (a smaller setting of the session is
    left alone), and ships this package to the executors, which may have no copy
    of it."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key).rstrip("b")
    if not now.isdigit() or int(now) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))
    sc = spark.sparkContext
    if not any(PACKAGE in os.path.basename(f) for f in sc._python_includes):
        root = Path(__file__).resolve().parent.parent
        target = Path(tempfile.mkdtemp(prefix="scorecraft-")) / f"{PACKAGE}.zip"
        with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f.relative_to(root.parent))
        sc.addPyFile(str(target))


def hash_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
