"""Packing of documents into fixed-length sequences, balanced by cost.

Method: a sequence's cost is the sum over its pieces of a linear term and a
quadratic attention term. Documents go, longest first, to the lowest-cost
sequence that still has room. Documents are dealt into groups of bounded size by
hash; each group is packed in one task, so no step sees the whole corpus, and
only the last sequence of a group can be left unfilled.
"""

from __future__ import annotations

from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, text_or_empty, written
from .encoding import dropped_space_pieces, memory_of, slices

#: Ids of sequences are ``group * SEQUENCES + number in the group``.
SEQUENCES = 1 << 32
#: What a row counts beside its text's bytes, so that a group holds few rows of short texts too.
ROW = 64


def pack_lengths(lengths: np.ndarray, capacity: int, linear: float = 1.0,
                 quadratic: float = 1 / 8192) -> list[tuple[int, int, int, int, int]]:
    """Pieces ``(document, start, length, sequence, offset)``.

    Whole multiples of ``capacity`` become sequences of their own. The rests
    share the fewest sequences that can hold them; one that fits nowhere whole
    is cut into the room that is left, lowest cost first."""
    out = []
    full = lengths // capacity
    n = 0
    for doc in np.flatnonzero(full):
        for k in range(full[doc]):
            out.append((int(doc), k * capacity, capacity, n, 0))
            n += 1
    rest = lengths - full * capacity
    open_ = -(-int(rest.sum()) // capacity)
    room, cost = np.full(open_, capacity), np.zeros(open_)
    for doc in np.argsort(-rest, kind="stable"):
        start, left = int(full[doc]) * capacity, int(rest[doc])
        while left:
            fits = np.flatnonzero(room >= left)
            if not len(fits):
                fits = np.flatnonzero(room)
            s = fits[np.argmin(cost[fits])]
            size = min(left, int(room[s]))
            out.append((int(doc), start, size, n + int(s), capacity - int(room[s])))
            room[s] -= size
            cost[s] += linear * size + quadratic * size * size
            start, left = start + size, left - size
    return out


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = 4096, end_id: int = 2, group_bytes: int = 4 << 20) -> DataFrame:
    """One row per piece: ``id_col, start, length, doc_tokens, sequence_id,
    offset, ids`` (little-endian unsigned 32-bit ids).

    A document is its text's ids and ``end_id``; a null or empty text is the end
    id alone. Pieces of a sequence fill it without gaps from 0. Groups hold
    about ``group_bytes`` of text; their number follows the table's bytes, so it
    behaves alike at every size. Rows are dealt by a hash of id and text, so null
    and repeated ids spread as their texts do. Where that overfills a group, its rows
    are counted by id and text first, and rows equal in both are dealt by number, in
    blocks that fit a group. Every row is packed, repeated or not; an empty table gives
    no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    prepare(spark)
    text = text_or_empty(text_col)
    size = docs.agg(F.sum(F.octet_length(text).cast("long") + ROW)).first()[0] or 0
    groups = max(1, -(-size // group_bytes))
    content = spark.sparkContext.broadcast(Path(tokenizer_path).read_text(encoding="utf-8"))

    def pack_group(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        memory = memory_of(content.value, dropped_space_pieces)
        texts = pdf["text"].tolist()
        ids = []
        for a, b in slices(texts):
            flat, ends = memory.encode(texts[a:b])
            ids += [np.append(x, np.uint32(end_id)).astype("<u4") for x in np.split(flat, ends[:-1])]
        copies = pdf["copies"].to_numpy()
        lengths = np.repeat(np.array([len(x) for x in ids], np.int64), copies)
        row = np.repeat(np.arange(len(ids)), copies)
        pieces = pack_lengths(lengths, capacity)
        doc, start, length, sequence, offset = map(list, zip(*pieces, strict=True))
        return pd.DataFrame({
            "id": pdf["id"].iloc[row[doc]].to_numpy(), "start": start, "length": length,
            "doc_tokens": lengths[doc], "sequence_id": key[0] * SEQUENCES + np.array(sequence, np.int64),
            "offset": offset,
            "ids": [ids[d][s:s + n].tobytes() for d, s, n in zip(row[doc], start, length, strict=True)]})

    # Ids travel as strings: pandas would turn integers with nulls into floats.
    rows = docs.select(F.col(id_col).cast("string").alias("id"), text.alias("text")).withColumn(
        "group", F.pmod(F.xxhash64("id", "text"), F.lit(groups)))
    # Written: few groups, or none, whose true size decides how they are joined.
    over = written(rows.groupBy("group").agg(F.sum(F.octet_length("text").cast("long") + ROW).alias("size")).filter(
        F.col("size") > 2 * group_bytes).select("group"), "overfull")
    block = f"greatest(1, {int(group_bytes)} div (octet_length(text) + {ROW}))"
    equal = rows.join(over, "group").groupBy("id", "text").agg(F.count("*").alias("n")).select(
        "id", "text", "n", F.expr(block).alias("most")).select(
        "*", F.explode(F.expr("sequence(0L, (n - 1) div most)")).alias("number"))
    equal = equal.select("id", "text", F.pmod(F.xxhash64("id", "text", "number"), F.lit(groups)).alias("group"),
                         F.expr("least(most, n - number * most)").alias("copies"))
    rest = rows.join(over, "group", "left_anti").select("id", "text", "group", F.lit(1).cast("long").alias("copies"))
    return (
        rest.unionByName(equal)
        .groupBy("group").applyInPandas(
            pack_group, "id string, start long, length long, doc_tokens long, sequence_id long, "
            "offset long, ids binary")
        .select(F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), "start", "length",
                "doc_tokens", "sequence_id", "offset", "ids"))
