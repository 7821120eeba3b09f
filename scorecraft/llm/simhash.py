"""SimHash near-duplicates by pigeonring filtering.

A 64-bit fingerprint is cut into a ring of eight 8-bit segments. If two
fingerprints differ in at most 3 bits, some chain of consecutive segments keeps
its running difference within the proportional budget ``l * 3 / 8`` after every
length ``l``: nothing in its first two segments and at most one bit in its first
five. So the first two segments are equal and two of the next three are: those
four segments are a 32-bit join key (24 keys per distinct fingerprint). What
shares a key is pruned by the chain's budgets over all lengths and only then
compared in full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import TEXTS, hash_partitions, prepare, written
from .components import components

SEGMENTS = 8
#: Rows of one key compared in one piece; a key with more is dealt into blocks
#: and every pair of blocks becomes a piece of its own.
BLOCK = 2048
_CHUNK = 1 << 15


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Unsigned SimHash of one text: A-Z lower-cased, words between ASCII white
    space, XXH64 (seed 42) of each ``shingle``-word window, repeats included; a
    bit is set if set in over half. Fewer words: the whole sequence is the one
    window. No words: zero."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    xx, n = xxhash.xxh64_intdigest, max(1, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, _CHUNK):
        top = min(n, at + _CHUNK)
        h = np.array([xx(b" ".join(words[i:i + shingle]), 42) for i in range(at, top)], ">u8")
        ones += np.unpackbits(h.view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def _fingerprint_column(text: Column, shingle: int) -> Column:
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            yield pd.Series(np.array([fingerprint(t, shingle) for t in s], np.uint64).view(np.int64))

    return F.pandas_udf(of, T.LongType())(text)


def _keys(fp: str) -> Column:
    """The 24 join keys of a fingerprint: for each chain start, its first two
    segments and two of the next three; the low bits name start and choice."""
    keys = []
    for start in range(SEGMENTS):
        turn = 8 * start
        ring = F.col(fp) if not turn else F.shiftleft(F.col(fp), turn).bitwiseOR(
            F.shiftrightunsigned(F.col(fp), 64 - turn))
        for j, kept in enumerate((0xFFFF00FFFF, 0xFFFFFF00FF, 0xFFFFFFFF00)):
            mask = kept << 24
            mask -= (1 << 64) if mask >= 1 << 63 else 0
            keys.append(ring.bitwiseAND(F.lit(mask)).bitwiseOR(F.lit(start * 4 + j)))
    return F.array(*keys)


def _within(x: np.ndarray, start: np.ndarray, bits: int) -> np.ndarray:
    """Which differences ``x`` pass the chain from segment ``start``, then the
    full Hamming check."""
    parts = np.bitwise_count(x.astype(">u8").view(np.uint8).reshape(-1, SEGMENTS))
    ring = np.take_along_axis(parts, (start[:, None] + np.arange(SEGMENTS)) % SEGMENTS, axis=1)
    run = np.cumsum(ring, axis=1, dtype=np.int64)
    ok = (run[:, :-1] * SEGMENTS <= np.arange(1, SEGMENTS) * bits).all(axis=1)
    return ok & (run[:, -1] <= bits)


def _forest(fps: np.ndarray, start: int, bits: int) -> tuple[list, list]:
    """Links that join what is linked within one key's piece: a spanning
    forest, so at most ``len(fps) - 1`` links whatever the pairs."""
    label, left, right = np.arange(len(fps)), [], []
    for i in range(len(fps) - 1):
        x = fps[i + 1:] ^ fps[i]
        near = np.flatnonzero(np.bitwise_count(x) <= bits)
        near = near[label[near + i + 1] != label[i]]
        if len(near):
            near = near[_within(x[near], np.full(len(near), start), bits)]
            marks, first = np.unique(label[near + i + 1], return_index=True)
            for m, f in zip(marks, first, strict=True):
                if m != label[i]:
                    left.append(fps[i])
                    right.append(fps[i + 1 + near[f]])
            label[np.isin(label, marks)] = label[i]
    return left, right


def _links(key: np.ndarray, piece: np.ndarray, fps: np.ndarray, bits: int) -> pd.DataFrame:
    """Links inside runs of equal ``piece`` (sorted)."""
    cut = np.flatnonzero(np.r_[True, piece[1:] != piece[:-1]])
    length = np.diff(np.r_[cut, len(piece)])
    a, b = [], []
    small = np.repeat(length <= 64, length)
    s_fp, s_piece, s_start = fps[small], piece[small], ((key[small] & 31) >> 2)
    for d in range(1, int(length[length <= 64].max(initial=1))):
        same = np.flatnonzero(s_piece[d:] == s_piece[:-d])
        if not len(same):
            break
        ok = _within(s_fp[same] ^ s_fp[same + d], s_start[same], bits)
        a.append(s_fp[same[ok]])
        b.append(s_fp[same[ok] + d])
    for at, n in zip(cut[length > 64], length[length > 64], strict=True):
        left, right = _forest(fps[at:at + n], int((key[at] & 31) >> 2), bits)
        a.append(np.array(left, np.uint64))
        b.append(np.array(right, np.uint64))
    a = np.concatenate(a) if a else np.zeros(0, np.uint64)
    b = np.concatenate(b) if b else np.zeros(0, np.uint64)
    return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})


def fingerprint_links(fps: DataFrame, bits: int = 3) -> DataFrame:
    """Links ``(a, b)`` among distinct fingerprints (column ``fp``, signed):
    all pairs within ``bits`` (3 at most) are connected through them. Within one
    large piece only a spanning forest is given, never all pairs."""
    if not 0 <= bits <= 3:
        raise ValueError("the ring's keys hold for 0 to 3 bits")
    spark = fps.sparkSession
    prepare(spark)
    keyed = fps.select(F.explode(_keys("fp")).alias("key"), "fp")
    counts = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    shared = (
        keyed.join(counts, "key")
        .withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("key", "fp", F.xxhash64("key", F.least("block", "other"),
                                        F.greatest("block", "other")).alias("piece")))
    shared = (shared.repartition(hash_partitions(spark), "piece")
              .sortWithinPartitions("piece", "key", "fp"))

    def link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None  # the last run may go on in the next batch; BLOCK bounds its length
        for pdf in batches:
            pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            piece = pdf["piece"].to_numpy()
            last = np.searchsorted(piece, piece[-1]) if len(piece) else 0
            held, done = pdf.iloc[last:], pdf.iloc[:last]
            if len(done):
                yield run(done)
        if held is not None and len(held):
            yield run(held)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        # Equal piece hashes of different keys only make a run longer: the pair check is exact.
        return _links(pdf["key"].to_numpy(), pdf["piece"].to_numpy(),
                      pdf["fp"].to_numpy().view(np.uint64), bits)

    return shared.mapInPandas(link, "a long, b long").distinct()


def _grouped(rows: DataFrame, order: Column, bits: int) -> DataFrame:
    """``rows`` (with ``fp``) plus ``first``: the least ``order`` of all rows
    whose fingerprints are connected."""
    least = rows.groupBy("fp").agg(F.min(order).alias("least"))
    least = written(least, "simhash-distinct")
    roots = written(components(fingerprint_links(least.select("fp"), bits), "a", "b"),
                    "simhash-roots")
    rooted = least.join(roots, least["fp"] == roots["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "least")
    firsts = rooted.groupBy("root").agg(F.min("least").alias("first"))
    return rows.join(rooted.join(firsts, "root").select("fp", "first"), "fp")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   shingle: int = 3, bits: int = 3) -> DataFrame:
    """One row per input row: ``id_col, fingerprint, component_id``.

    ``component_id`` is the smallest id reachable over links of ``bits`` or
    fewer differing bits. A null or wordless text has fingerprint zero and links
    like any other; null ids are skipped when the smallest is taken (null if a
    component has no other). Repeated rows and ids give a row each; an empty
    table gives none; other columns are ignored.
    """
    prepare(docs.sparkSession)
    rows = written(docs.select(F.col(id_col).alias("id"),
                               _fingerprint_column(F.col(text_col), shingle).alias("fp")),
                   "simhash-rows")
    return _grouped(rows, F.col("id"), bits).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("first").alias("component_id"))


def keep_one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle: int = 3, bits: int = 3) -> DataFrame:
    """The rows of ``docs``, all columns, with one row of each connected group:
    the one with the smallest id (null ids last, then input order)."""
    prepare(docs.sparkSession)
    rows = written(docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        F.monotonically_increasing_id().alias("rid"),
        _fingerprint_column(F.col(text_col), shingle).alias("fp")), "simhash-docs", TEXTS)
    order = F.struct(F.col(f"doc.`{id_col}`").isNull().alias("n"),
                     F.col(f"doc.`{id_col}`").alias("id"), F.col("rid"))
    # Only ids and fingerprints are grouped; then whole rows are picked by their number.
    kept = _grouped(rows.select(order.alias("o"), "rid", "fp"), F.col("o"), bits).filter(
        F.col("rid") == F.col("first.rid")).select("rid")
    return rows.join(kept, "rid", "left_semi").select("doc.*")
