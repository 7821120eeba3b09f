"""Contiguous shards of near-equal byte size.

Method: order all rows by id, take each range partition's byte total, turn the
totals (one row per partition) into global offsets, add the prefix sum inside
the partition, and cut the global byte line at equal targets. Only narrow rows
(id, size, checksum) are shuffled, never the texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import text_or_empty, written


def byte_shards(docs: DataFrame, n_shards: int = 16, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col, size, text_crc32, start_byte, shard, slot``.

    ``size`` is the UTF-8 length plus one. A row belongs to the shard in whose
    equal share of the byte line its middle lies, so a shard differs from
    ``total / n_shards`` by at most one row at each end. ``slot`` numbers the
    rows of a shard from 0 without gaps, in the global order.

    Order: id (nulls first), checksum, size, then the position in the input,
    which only decides between fully equal rows. A null text counts as empty
    (size 1, checksum 0); repeated rows and ids each keep a slot of their own;
    an empty table gives no rows; other columns are ignored. A row larger than
    a share leaves the shards it spans without rows.
    """
    text = text_or_empty(text_col)
    narrow = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("crc"))
    # Written before the range sampling: texts are read once, and the input
    # position that separates equal rows can't change when a task is repeated.
    narrow = written(narrow.withColumn("pos", F.monotonically_increasing_id()), "shard-sizes")
    order = [F.col("id").asc_nulls_first(), F.col("crc").asc(), F.col("size").asc(),
             F.col("pos").asc()]
    ranged = written(narrow.repartitionByRange(*order).withColumn("pid", F.spark_partition_id()),
                     "shard-ranges")

    # One row per range partition, however large the table.
    before = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    totals = ranged.groupBy("pid").agg(F.sum("size").alias("p_bytes"), F.count("*").alias("p_rows"))
    totals = totals.select(
        "pid",
        F.coalesce(F.sum("p_bytes").over(before), F.lit(0)).alias("base_bytes"),
        F.coalesce(F.sum("p_rows").over(before), F.lit(0)).alias("base_rows"),
        F.sum("p_bytes").over(everything).alias("total"))

    inside = Window.partitionBy("pid").orderBy(*order)
    placed = (
        ranged.withColumn("upto", F.sum("size").over(
            inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .withColumn("rn", F.row_number().over(inside))
        .join(F.broadcast(totals), "pid")
        .withColumn("start_byte", F.col("base_bytes") + F.col("upto") - F.col("size"))
        .withColumn("rank", F.col("base_rows") + F.col("rn") - 1)
        .withColumn("shard", F.least(F.lit(n_shards - 1), F.expr(
            f"((2 * start_byte + size) * {int(n_shards)}) div (2 * total)")).cast("int")))
    firsts = placed.groupBy("shard").agg(F.min("rank").alias("first"))  # n_shards rows
    return placed.join(F.broadcast(firsts), "shard").select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "start_byte",
        "shard", (F.col("rank") - F.col("first")).alias("slot"))
