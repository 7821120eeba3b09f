"""Token-id files with Elias-Fano document boundaries.

A file holds the ids of consecutive documents in one array (2 bytes an id where
the vocabulary allows, else 4) and, in Elias-Fano form, where each document
ends: the low bits of every boundary in a packed array, the high bits in unary
in a bitmap with a sampled select directory. That takes about 2 + log2(ids /
documents) bits a document instead of 64, and a select query reads one bitmap
word or a few. Files are written in ascending order of the document id.

Layout, little-endian: header (``HEADER``), document ids as 64-bit integers,
low bits, high bitmap (64-bit words), select samples, ids.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import hash_partitions, prepare, text_or_empty, written
from .encoding import memory_of, slices, spaced_pieces

#: magic, format version, bytes per id, documents, ids, low bits, high words,
#: select samples, part (range of documents), ids in the part's earlier files,
#: checksum of what follows the header
HEADER = struct.Struct("<8sHHqqqqqqqI")
MAGIC = b"TOKSTORE"
#: Every so many set bits of the bitmap have a sample.
EVERY = 64


class EliasFano:
    """A non-decreasing sequence in near-minimal space, with select."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n, top = len(values), int(values[-1]) if len(values) else 0
        low_bits = max(0, (max(top, 1) // max(n, 1)).bit_length() - 1)
        low = np.zeros(-(-n * low_bits // 8), np.uint8)
        if low_bits:
            bits = (values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
            low = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little")
        at = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bitmap = np.zeros(((int(at[-1]) if n else 0) // 64 + 1) * 64, np.uint8)
        bitmap[at] = 1
        return cls(n, low_bits, low, np.packbits(bitmap, bitorder="little").view("<u8"),
                   at[::EVERY].astype("<i8"))

    def _low(self, i: int) -> int:
        first, out = i * self.low_bits, 0
        if self.low_bits:
            raw = self.low[first // 8:(first + self.low_bits + 7) // 8].tobytes()
            out = int.from_bytes(raw, "little") >> first % 8 & (1 << self.low_bits) - 1
        return out

    def select(self, i: int) -> int:
        """The i-th value: the nearest sample, then bitmap words up to the bit."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        start = int(self.samples[i // EVERY])
        want, word = i % EVERY, start // 64
        bits = int(self.high[word]) >> start % 64 << start % 64
        while want >= (ones := bits.bit_count()):
            want, word = want - ones, word + 1
            bits = int(self.high[word])
        for _ in range(want):
            bits &= bits - 1
        at = word * 64 + (bits & -bits).bit_length() - 1
        return at - i << self.low_bits | self._low(i)

    def all(self) -> np.ndarray:
        """Every value, in one pass."""
        at = np.flatnonzero(np.unpackbits(self.high.view(np.uint8), bitorder="little"))[:self.n]
        values = (at - np.arange(self.n)) << self.low_bits
        if self.low_bits:
            bits = np.unpackbits(self.low, count=self.n * self.low_bits, bitorder="little")
            values |= bits.reshape(self.n, self.low_bits).astype(np.int64) @ (1 << np.arange(self.low_bits))
        return values


def to_bytes(doc_ids: np.ndarray, ids: np.ndarray, ends: np.ndarray, width: int, part: int = 0,
             before: int = 0) -> bytes:
    """A file's content: documents, all their ids, and where each document ends."""
    ef = EliasFano.build(ends)
    parts = [np.asarray(doc_ids, "<i8").tobytes(), ef.low.tobytes(), ef.high.tobytes(),
             ef.samples.tobytes(), np.asarray(ids, f"<u{width}").tobytes()]
    body = b"".join(parts)
    return HEADER.pack(MAGIC, 1, width, len(ends), len(ids), ef.low_bits, len(ef.high),
                       len(ef.samples), part, before, zlib.crc32(body)) + body


class TokenFile:
    """A file's content: ``doc_ids``, ``ids`` and the Elias-Fano ``ends``, with
    ``part`` and ``before`` as in the header."""

    def __init__(self, content: bytes):
        (magic, version, width, docs, ids, low_bits, words, samples, self.part, self.before,
         check) = HEADER.unpack_from(content)
        if magic != MAGIC or version != 1 or zlib.crc32(memoryview(content)[HEADER.size:]) != check:
            raise ValueError("not a whole token file")
        at = HEADER.size

        def take(dtype: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(content, dtype, n, at)
            at += out.nbytes
            return out

        self.doc_ids = take("<i8", docs)
        low = take("u1", -(-docs * low_bits // 8))
        self.ends = EliasFano(docs, low_bits, low, take("<u8", words), take("<i8", samples))
        self.ids = take(f"<u{width}", ids)

    def document(self, i: int) -> np.ndarray:
        """Ids of the i-th document, by two select queries."""
        return self.ids[self.ends.select(i - 1) if i else 0:self.ends.select(i)]


#: Stands in a file for a null id; such documents come first.
NULL_ID = -(2**63)


def _put(folder: str, name: str, content: bytes, attempt: int) -> None:
    """Write a file of the shared folder whole or not at all: a lost or repeated
    task leaves no part of one."""
    from pyarrow import fs

    uri = re.sub(r"^file:/+", "file:///", folder if ":" in folder else f"file:{folder}")
    system, path = fs.FileSystem.from_uri(uri)
    system.create_dir(path, recursive=True)
    with system.open_output_stream(f"{path}/_{name}.{attempt}") as f:
        f.write(content)
    system.move(f"{path}/_{name}.{attempt}", f"{path}/{name}")


def write_tokens(docs: DataFrame, tokenizer_path: str, end_id: int, folder: str | None = None,
                 id_col: str = "doc_id", text_col: str = "text", width: int = 2,
                 file_ids: int = 4 << 20) -> tuple[str, DataFrame]:
    """Write token files; returns their folder and a table ``(name, part, docs,
    ids)`` with a row per file.

    Documents are range-partitioned by id (then by a hash of the text, so rows
    that share an id spread too), and each task writes its range in order, one
    file per ``file_ids`` ids or so. Each document's ids are followed by
    ``end_id``. Null texts are empty; null ids come first; repeated rows are
    written as often as they occur; an empty table gives no files; other columns
    are ignored. ``folder`` must be one that all executors share; by default it
    is a fresh one under ``spark.checkpoint.dir``.
    """
    spark = docs.sparkSession
    prepare(spark)
    folder = folder or scratch_path(spark, "tokens")
    content = spark.sparkContext.broadcast(Path(tokenizer_path).read_text(encoding="utf-8"))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memory = memory_of(content.value, spaced_pieces)
        part, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        doc_ids, ids, sizes, held, before, number = [], [], [], 0, 0, 0

        def flush() -> pd.DataFrame:
            name = f"{part:07d}-{number:07d}.tokens"
            flat = np.concatenate(ids)
            _put(folder, name, to_bytes(np.concatenate(doc_ids), flat, np.cumsum(np.concatenate(sizes)),
                                        width, part, before), attempt)
            return pd.DataFrame({"name": [name], "part": [part], "docs": [sum(map(len, sizes))],
                                 "ids": [len(flat)]})

        for pdf in batches:
            texts, keys = pdf["text"].tolist(), pdf["id"].to_numpy()
            for a, b in slices(texts, min(1 << 21, 4 * file_ids)):
                flat, ends = memory.encode(texts[a:b])
                if len(flat) and int(flat.max()) >> (8 * width):
                    raise ValueError(f"ids need more than {width} bytes")
                ids.append(np.insert(flat, ends, end_id).astype(f"<u{width}"))
                sizes.append(np.diff(ends, prepend=0) + 1)
                doc_ids.append(keys[a:b])
                held += len(ids[-1])
                if held >= file_ids:
                    yield flush()
                    before, number = before + held, number + 1
                    doc_ids, ids, sizes, held = [], [], [], 0
        if sizes:
            yield flush()

    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("id"),
                       text_or_empty(text_col).alias("text")).withColumn("tie", F.xxhash64("text"))
    files = (rows.repartitionByRange(hash_partitions(spark), "id", "tie")
             .sortWithinPartitions("id", "tie").select("id", "text")
             .mapInPandas(write, "name string, part int, docs long, ids long"))
    return folder, written(files, "token-files")


def read_tokens(files: DataFrame, folder: str, id_col: str = "doc_id") -> DataFrame:
    """One row per document, read from the files: ``id_col, start, n_tokens, ids``
    (little-endian unsigned 32-bit); ``start`` counts the ids of all documents
    before it."""
    spark = files.sparkSession
    prepare(spark)
    # One number per range partition.
    totals = files.groupBy("part").agg(F.sum("ids").alias("n")).withColumn("base", F.coalesce(
        F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    base = spark.sparkContext.broadcast({r["part"]: r["base"] for r in totals.collect()})
    schema = "id long, start long, n_tokens long, ids binary"
    if not base.value:
        found = spark.createDataFrame([], schema)
    else:
        def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for content in pdf["content"]:
                    f = TokenFile(content)
                    ends = f.ends.all()
                    starts = np.concatenate([[0], ends[:-1]])
                    for a in range(0, len(ends), 2000):
                        b = min(a + 2000, len(ends))
                        yield pd.DataFrame({
                            "id": f.doc_ids[a:b], "start": base.value[f.part] + f.before + starts[a:b],
                            "n_tokens": ends[a:b] - starts[a:b],
                            "ids": [f.ids[x:y].astype("<u4").tobytes()
                                    for x, y in zip(starts[a:b], ends[a:b], strict=True)]})

        found = (spark.read.format("binaryFile").option("pathGlobFilter", "*.tokens").load(folder)
                 .select("content").mapInPandas(read, schema))
    return found.select(F.when(F.col("id") != NULL_ID, F.col("id")).alias(id_col),
                        "start", "n_tokens", "ids")
