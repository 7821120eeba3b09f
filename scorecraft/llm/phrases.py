"""Document fingerprints by locally consistent parsing.

Method: a text's code points are parsed into phrases in levels. On each level
runs of one symbol become one symbol, deterministic coin tossing turns each
symbol into a small label that differs from its neighbour's (the lowest bit in
which a symbol differs from the one before, and that bit's value, three times
over), and phrases start at the labels' local maxima. A phrase's name is a hash
of its symbols, and names are the next level's symbols. Where a phrase starts
depends on a few symbols around it only, so equal substrings get equal names in
their interior at any offset. A fingerprint samples a text's set of names by
one-permutation MinHash, which estimates how much of two sets is shared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import hash_partitions, prepare, text_or_empty, written
from .encoding import slices

#: Places of a fingerprint, and the mark of one without a name.
PLACES, NONE = 64, 0xFFFF
#: Names from this level on are sampled (a phrase has about 3 symbols).
LEVEL = 2


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


#: Factor of a phrase's n-th symbol. Labels below 8 rise for at most 7 steps and
#: fall for as many, so a phrase is shorter than this.
FACTORS = _mix(np.arange(1, 33, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def _toss(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Labels of symbols: twice the lowest bit in which a symbol differs from
    the one before, plus that bit. The first of a text is held against its
    complement."""
    before = np.empty_like(x)
    before[1:] = x[:-1]
    before[first] = ~x[first]
    differ = x ^ before
    lowest = differ & (~differ + x.dtype.type(1))
    return np.bitwise_count(lowest - x.dtype.type(1)) << 1 | ((x & lowest) != 0)


def _level(x: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One level for several texts in a row: ``x`` symbols, ``doc`` their texts.
    Returns the phrases' names and texts."""
    first = np.r_[True, doc[1:] != doc[:-1]]
    at = np.flatnonzero(first | np.r_[True, x[1:] != x[:-1]])
    if len(at) < len(x):  # runs of one symbol
        length = np.diff(np.r_[at, len(x)])
        x, doc, first = x[at], doc[at], first[at]
        many = length > 1
        x[many] = _mix(x[many] ^ _mix(length[many].astype(np.uint64)))
    label = _toss(_toss(_toss(x, first), first), first)
    start = first.copy()
    start[1:-1] |= (label[1:-1] > label[:-2]) & (label[1:-1] > label[2:]) & ~first[2:]
    at = np.flatnonzero(start)
    length = np.diff(np.r_[at, len(x)])
    place = np.arange(len(x)) - np.repeat(at, length)
    return _mix(np.add.reduceat(x * FACTORS[place], at)), doc[at]


def fingerprints(texts: list[str]) -> np.ndarray:
    """A row of ``PLACES`` 16-bit values per text. A name's top bits choose its
    place, the next bits are its value, the least of a place stays. A text that
    is parsed to one name before ``LEVEL`` gives that name."""
    out = np.full(len(texts) * PLACES, NONE, np.uint16)
    for a, b in slices(texts, 1 << 20):
        points = np.frombuffer("".join(texts[a:b]).encode("utf-32-le", "surrogatepass"), np.uint32)
        doc = np.repeat(np.arange(a, b), [len(t) for t in texts[a:b]])
        x, level = points.astype(np.uint64), 0
        while len(x):
            x, doc = _level(x, doc)
            level += 1
            alone = np.r_[True, doc[1:] != doc[:-1]] & np.r_[doc[1:] != doc[:-1], True]
            use = alone if level < LEVEL else slice(None)
            name = x[use]
            np.minimum.at(out, doc[use] * PLACES + (name >> np.uint64(58)).astype(np.int64),
                          np.minimum(name >> np.uint64(42) & np.uint64(0xFFFF), NONE - 1).astype(np.uint16))
            x, doc = x[~alone], doc[~alone]
    return out.reshape(-1, PLACES)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated share of names in common (twice the common ones over both
    sets' sizes) of fingerprints, row by row; two empty ones are alike."""
    any_ = ((a != NONE) | (b != NONE)).sum(axis=1)
    same = ((a == b) & (a != NONE)).sum(axis=1)
    return np.where(any_ > 0, 2 * same / np.maximum(any_ + same, 1), 1.0)


def fingerprint_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_chars, fingerprint`` (binary) of each row; a null text is empty."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = fingerprints(pdf["text"].tolist()).astype(">u2")
            yield pd.DataFrame({"id": pdf["id"], "n_chars": pdf["text"].str.len(),
                                "fingerprint": [x.tobytes() for x in found]})

    return docs.select(F.col(id_col).cast("string").alias("id"), text_or_empty(text_col).alias("text")).mapInPandas(
        run, "id string, n_chars long, fingerprint binary").withColumn(
        "id", F.col("id").cast(docs.schema[id_col].dataType)).withColumnRenamed("id", id_col)


ROW = ("id string, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, "
       "near_edited double, near_next double, part int, text string")


def _held_against_next(ids: list, texts: list[str], prints: np.ndarray) -> pd.DataFrame:
    """Rows of all but the last text, each with the text after it."""
    n = [len(t) for t in texts[:-1]]
    edited = [t[:k - k // 2] + after[:k // 2] for t, k, after in zip(texts, n, texts[1:], strict=False)]
    others = fingerprints(edited)
    mine = prints[:-1]
    return pd.DataFrame({
        "id": ids[:-1], "n_chars": n,
        "edited_sha256": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited],
        "fingerprint": [x.tobytes() for x in mine.astype(">u2")],
        "edited_fingerprint": [x.tobytes() for x in others.astype(">u2")],
        "near_edited": likeness(mine, others), "near_next": likeness(mine, prints[1:]),
        "part": None, "text": None}, columns=[c.split()[0] for c in ROW.split(", ")])


def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's fingerprint held against two others: its edited text's
    (the last half replaced by the start of the next document) and the next
    document's. Returns ``id_col, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next``; fingerprints are binary.

    The next document is the one with the next larger id; rows that share an id
    follow a hash of their texts, null ids come first, and after the last comes
    the first (a single row is its own next). Null texts are empty. Repeated rows
    give a row each; an empty table gives none; other columns are ignored.

    Texts are range-partitioned once. A task works through its range in order;
    only the first and last text of each range (two rows per partition) go on to
    a second step that joins neighbouring ranges.
    """
    spark = docs.sparkSession
    prepare(spark)
    kind = docs.schema[id_col].dataType

    def inside(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, ids, texts, prints = TaskContext.get().partitionId(), [], [], None
        head = True
        for pdf in batches:
            new = pdf["text"].tolist()
            ids, texts = ids + pdf["id"].tolist(), texts + new
            found = fingerprints(new)
            prints = found if prints is None else np.concatenate([prints, found])
            if head and texts:
                yield end(part, -1, ids[0], texts[0], prints[0])
                head = False
            if len(texts) > 1:
                yield _held_against_next(ids, texts, prints)
                ids, texts, prints = ids[-1:], texts[-1:], prints[-1:]
        if texts:
            yield end(part, -2, ids[-1], texts[-1], prints[-1])

    def end(part: int, mark: int, id_, text: str, found: np.ndarray) -> pd.DataFrame:
        # Marked by a negative n_chars: -1 the first text of a range, -2 the last.
        return pd.DataFrame([[id_, mark, None, found.astype(">u2").tobytes(), None, None, None, part, text]],
                            columns=[c.split()[0] for c in ROW.split(", ")]).astype({"text": object})

    rows = docs.select(F.col(id_col).alias("key"), text_or_empty(text_col).alias("text")).withColumn(
        "tie", F.xxhash64("text"))
    done = written(
        rows.repartitionByRange(hash_partitions(spark), "key", "tie").sortWithinPartitions("key", "tie")
        .select(F.col("key").cast("string").alias("id"), "text").mapInPandas(inside, ROW), "phrases")

    # Two rows per range: its last text meets the next range's first.
    last = done.filter("n_chars = -2").select(F.col("part").alias("of"), F.col("id").alias("l_id"),
                                              F.col("text").alias("l_text"), F.col("fingerprint").alias("l_print"))
    first = done.filter("n_chars = -1").select("part", F.col("text").alias("f_text"),
                                               F.col("fingerprint").alias("f_print"))
    parts = first.select("part").withColumn("before", F.coalesce(
        F.lag("part").over(Window.orderBy("part")), F.max("part").over(Window.partitionBy())))

    def across(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                two = np.stack([np.frombuffer(x, ">u2").astype(np.uint16) for x in (r.l_print, r.f_print)])
                yield _held_against_next([r.l_id, None], [r.l_text, r.f_text], two)

    seams = first.join(parts, "part").join(last, F.col("before") == F.col("of")).select(
        "l_id", "l_text", "l_print", "f_text", "f_print").mapInPandas(across, ROW)
    return done.filter("n_chars >= 0").unionByName(seams).select(
        F.col("id").cast(kind).alias(id_col), "n_chars", "edited_sha256", "fingerprint",
        "edited_fingerprint", "near_edited", "near_next")
