"""Byte-level BPE encoding and decoding with numpy.

Method: the distinct matches of the splitting pattern are laid out in padded
matrices, bucketed by length. In each round every row merges its leftmost pair
of minimum rank: ranks of all neighbouring pairs come from a hashed table, and
rows are compacted by one after the merge. Rows without a mergeable pair leave.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, text_or_empty
from .encoding import PieceMemory, ended_word, slices, spaced_pieces

#: Cells of one padded matrix.
CELLS = 1 << 20
#: Bytes beyond which a word is merged by itself.
LONG = 512


class PairTable:
    """Open-addressing hash table from a pair of token ids to the merged id,
    which is its rank too."""

    EMPTY = np.uint64(2**64 - 1)

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        bits = max(4, int(len(left) * 3).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, self.EMPTY, np.uint64)
        self.values = np.full(1 << bits, -1, np.int32)
        key, value = self._key(left, right), np.asarray(merged, np.int32)
        at = self._slot(key)
        self.reach = 0  # longest way from a key's slot to its place
        while len(key):
            self.reach += 1
            free = self.keys[at] == self.EMPTY
            _, first = np.unique(at[free], return_index=True)
            mine = np.flatnonzero(free)[first]  # one key per free place in a round
            self.keys[at[mine]], self.values[at[mine]] = key[mine], value[mine]
            rest = np.ones(len(key), bool)
            rest[mine] = False
            key, value, at = key[rest], value[rest], (at[rest] + 1) & self.mask

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged id of each pair, -1 where it does not merge."""
        key = self._key(left, right)
        at, out = self._slot(key), np.full(len(key), -1, np.int32)
        todo = np.arange(len(key))
        for _ in range(self.reach):
            held = self.keys[at]
            hit = held == key[todo]
            out[todo[hit]] = self.values[at[hit]]
            on = ~hit & (held != self.EMPTY)
            if not on.any():
                break
            todo, at = todo[on], (at[on] + 1) & self.mask
        return out


class ByteBPE:
    """Encoder and decoder of a rank file (base64 token and rank on each line)."""

    def __init__(self, ranks: bytes):
        self.tokens = {base64.b64decode(t): int(r) for t, r in map(bytes.split, ranks.splitlines())}
        size = max(self.tokens.values()) + 1
        self.byte_id = np.array([self.tokens[bytes([b])] for b in range(256)], np.int64)
        # Every way to split a token into two tokens is a pair that merges to it.
        pairs = [(self.tokens[t[:i]], self.tokens[t[i:]], r) for t, r in self.tokens.items()
                 for i in range(1, len(t)) if t[:i] in self.tokens and t[i:] in self.tokens]
        self.pairs = PairTable(*np.array(pairs, np.int64).reshape(-1, 3).T)
        by_id = [b""] * size
        for t, r in self.tokens.items():
            by_id[r] = t
        self.bytes = np.frombuffer(b"".join(by_id), np.uint8)
        self.ends = np.cumsum([len(t) for t in by_id])

    def encode_words(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word (one match of the splitting pattern). A word that is
        a token is that token, as in the library."""
        whole = [self.tokens.get(w) for w in words]
        out = [None if t is None else np.array([t]) for t in whole]
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        todo = np.fromiter((t is None for t in whole), bool, len(words))
        for i in np.flatnonzero(todo & (sizes > LONG)):
            out[i] = self._merge_long(words[i])
        todo &= sizes <= LONG
        buckets = np.ceil(np.log2(np.maximum(sizes, 1)) * 2)  # widths half an octave apart
        for bucket in np.unique(buckets[todo]):
            rows = np.flatnonzero(todo & (buckets == bucket))
            width = int(sizes[rows].max())
            step = max(1, CELLS // max(1, width))
            for at in range(0, len(rows), step):
                self._merge(words, rows[at:at + step], sizes, width, out)
        return out

    def _merge_long(self, word: bytes) -> np.ndarray:
        """One long word. All pairs of the minimum rank, left to right without
        overlap, are merged in one round, up to the first whose merge makes a
        pair of lower rank (stopping early is always right)."""
        ids = self.byte_id[np.frombuffer(word, np.uint8)]
        while len(ids) > 1:
            rank = self._ranks(ids[:-1], ids[1:])
            least = rank.min()
            if least == self._NONE:
                break
            at = np.flatnonzero(rank == least)
            first = np.r_[True, np.diff(at) > 1]  # overlapping pairs: every second one
            run = at - at[np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))]
            at = at[run % 2 == 0]
            one = np.full(len(at), least)
            lower = (self._ranks(ids[np.maximum(at - 1, 0)], one) < least) | (
                self._ranks(one, ids[np.minimum(at + 2, len(ids) - 1)]) < least)
            if self._ranks(one[:1], one[:1])[0] < least:
                at = at[:1]
            elif lower.any():
                at = at[:int(lower.argmax()) + 1]
            ids[at] = least
            ids = np.delete(ids, at + 1)
        return ids

    def _merge(self, words, rows, sizes, width, out) -> None:
        n = sizes[rows]
        raw = np.frombuffer(b"".join([words[i] for i in rows]), np.uint8)
        ids = np.full((len(rows), width), -1, np.int64)
        inside = np.arange(width) < n[:, None]
        ids[inside] = self.byte_id[raw]
        n, who = n.copy(), rows
        # Ranks of all neighbouring pairs; a merge changes two of them.
        rank = np.full(ids.shape, self._NONE, np.int64)
        r, c = np.nonzero(inside[:, 1:])
        rank[r, c] = self._ranks(ids[r, c], ids[r, c + 1])
        while len(who):
            at = rank.argmin(axis=1) if width else np.zeros(len(who), np.int64)
            row = np.arange(len(who))
            best = rank[row, at] if width else np.full(len(who), self._NONE)
            ended = best == self._NONE
            if ended.any():
                for i in np.flatnonzero(ended):
                    out[who[i]] = ids[i, :n[i]].copy()
                go = ~ended
                ids, rank, n, who, at, best = ids[go], rank[go], n[go], who[go], at[go], best[go]
                if not len(who):
                    return
                row = np.arange(len(who))
            # Compaction: what lies behind the merged pair moves one to the left.
            width = ids.shape[1]
            cols = np.arange(width)
            later = np.minimum(cols + (cols > at[:, None]), width - 1)
            ids = np.take_along_axis(ids, later, axis=1)
            rank = np.take_along_axis(rank, later, axis=1)
            ids[row, at] = best
            n = n - 1
            ids[row, n] = -1
            rank[row, n - 1] = self._NONE
            rank[row, n] = self._NONE
            for place in (at - 1, at):
                ok = np.flatnonzero((place >= 0) & (place < n - 1))
                p = place[ok]
                rank[ok, p] = self._ranks(ids[ok, p], ids[ok, p + 1])
            top = int(n.max())
            if top < width:
                ids, rank = ids[:, :top], rank[:, :top]

    _NONE = 1 << 40

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        got = self.pairs.get(left, right).astype(np.int64)
        got[got < 0] = self._NONE
        return got

    def decode(self, ids: np.ndarray) -> bytes:
        ids = np.asarray(ids, np.int64)
        first = np.where(ids > 0, self.ends[ids - 1], 0)
        size = self.ends[ids] - first
        upto = np.concatenate([[0], np.cumsum(size)])
        return self.bytes[np.repeat(first - upto[:-1], size) + np.arange(upto[-1])].tobytes()


_CODERS: dict[tuple[int, str], tuple[ByteBPE, PieceMemory]] = {}


def coder(ranks: bytes, pattern: str) -> tuple[ByteBPE, PieceMemory]:
    """This process's encoder for a rank file, and its memory of pieces."""
    key = (zlib.crc32(ranks), pattern)
    if key not in _CODERS:
        bpe, split = ByteBPE(ranks), regex.compile(pattern)

        def encode_new(pieces: list[str]) -> list[np.ndarray]:
            matches = [split.findall(p) for p in pieces]
            words = [w for m in matches for w in m]
            distinct = {w: i for i, w in enumerate(dict.fromkeys(words))}
            ids = bpe.encode_words([w.encode("utf-8", "surrogatepass") for w in distinct])
            none = np.zeros(0, np.int64)
            return [ids[distinct[m[0]]] if len(m) == 1 else np.concatenate(
                [ids[distinct[w]] for w in m]) if m else none for m in matches]

        _CODERS[key] = bpe, PieceMemory(spaced_pieces, encode_new, ended_word)
    return _CODERS[key]


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per row: ``id_col, n_tokens, ids`` (little-endian unsigned 32-bit)
    and ``decoded`` (the bytes that the ids stand for).

    Each match of ``pattern`` is encoded by itself, without special tokens. A
    null or empty text has no ids. Rows are encoded where they are read; the rank
    file is broadcast (its size is that of one vocabulary). Other columns are
    ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    prepare(spark)
    with open(ranks_path, "rb") as f:
        ranks = spark.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe, memory = coder(ranks.value, pattern)
        for pdf in batches:
            texts = pdf["text"].tolist()
            for a, b in slices(texts):
                flat, ends = memory.encode(texts[a:b])
                ids = [x.astype("<u4") for x in np.split(flat, ends[:-1])]
                yield pd.DataFrame({
                    "id": pdf["id"].iloc[a:b].to_numpy(), "n_tokens": [len(x) for x in ids],
                    "ids": [x.tobytes() for x in ids], "decoded": [bpe.decode(x) for x in ids]})

    return docs.select(F.col(id_col).cast("string").alias("id"), text_or_empty(text_col).alias("text")).mapInPandas(
        run, "id string, n_tokens long, ids binary, decoded binary").select(
        F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), "n_tokens", "ids", "decoded")
