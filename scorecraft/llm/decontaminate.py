"""Benchmark passages in training documents, through a positional inverted index.

Method: the documents' words are written as an inverted index. Documents are
laid one after the other into segments of bounded length, and each word of a
segment has one posting list, the sorted places where it stands in the segment.
A passage of a test item is looked up from its rarest words: the posting list of
the rarest, moved by the distance between the two, is intersected with that of the
second rarest. Only where both agree are the passage's other words looked for, at
the places where they would have to stand, in their own posting lists. Proximity
matches need no exact distance: the rarest words of a passage all stand within a
few words of each other.

Segments are of bounded length, so a word that makes up a third of all text has one
list of bounded size per segment, and every join is on a word and a segment.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructType

from .common import prepare, written
from .words import Numbering, byte_table

WORD_BYTES = byte_table(digits=True)
#: Consecutive words of an item that count as a passage.
WINDOW = 10
#: Words within which the rarest words of a passage must stand to be near.
WITHIN = 20
#: How many of a window's rarest words proximity looks at.
RAREST = 3
#: Empty places between two documents of a segment; WITHIN may not be larger.
GAP = 32
#: Places of a segment (a longer document has one of its own).
SEGMENT = 1 << 20
#: Posting lists in one Arrow batch.
LISTS = 1 << 14


def _segments(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Rows of the index: a document has ``doc``, ``at`` and ``n_words``, a posting
    list ``term`` and ``places``."""
    segment = TaskContext.get().partitionId() << 32
    names = ["segment", "doc", "at", "n_words", "term", "places"]
    numbers, keys, docs, starts, lengths, at = Numbering(), [], [], [], [], 0

    def flush() -> Iterator[pa.RecordBatch]:
        doc = pa.concat_arrays(docs)
        n = len(doc)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.full(n, segment)), doc, pa.array(np.array(starts, np.int32)),
            pa.array(np.array(lengths, np.int64)), pa.nulls(n, pa.string()), pa.nulls(n, pa.list_(pa.int32()))], names)
        key = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        keys.clear()
        key.sort()
        ends = np.cumsum(np.bincount(key >> 32, minlength=len(numbers)))
        begins = np.concatenate([[0], ends[:-1]]).astype(np.int32) if len(ends) else ends
        places = (key & 0xFFFFFFFF).astype(np.int32)
        del key
        words = pa.array(list(numbers), pa.binary()).cast(pa.string())
        for i in range(0, len(numbers), LISTS):
            j = min(i + LISTS, len(numbers))
            lists = pa.ListArray.from_arrays(
                pa.array(np.append(begins[i:j], ends[j - 1]).astype(np.int32) - begins[i]),
                pa.array(places[begins[i]:ends[j - 1]]))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(j - i, segment)), pa.nulls(j - i, doc.type), pa.nulls(j - i, pa.int32()),
                pa.nulls(j - i, pa.int64()), words[i:j], lists], names)

    for batch in batches:
        first = 0
        for k, text in enumerate(batch.column("t").to_pylist()):
            ids = numbers.of((text or b"").translate(WORD_BYTES).split())
            if len(ids):
                keys.append(ids << 32 | np.arange(at, at + len(ids)))
            starts.append(at)
            lengths.append(len(ids))
            at += len(ids) + GAP
            if at >= size:
                docs.append(batch.column("doc")[first:k + 1])
                yield from flush()
                numbers, keys, docs, starts, lengths, at = Numbering(), [], [], [], [], 0
                segment, first = segment + 1, k + 1
        if first < batch.num_rows:
            docs.append(batch.column("doc")[first:])
    if docs:
        yield from flush()


def build_index(docs: DataFrame, keep: list[str], text_col: str = "text", segment: int = SEGMENT) -> DataFrame:
    """The written positional index of ``docs``; see ``_segments`` for its rows.

    Every document is in it with the columns ``keep`` as a struct ``doc``, null and
    empty texts with no words. Repeated rows are documents of their own."""
    prepare(docs.sparkSession)
    given = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("doc"),
                        F.col(f"`{text_col}`").cast("string").cast("binary").alias("t"))
    schema = (StructType().add("segment", LongType()).add("doc", given.schema["doc"].dataType)
              .add("at", IntegerType()).add("n_words", LongType()).add("term", StringType())
              .add("places", ArrayType(IntegerType())))
    return written(given.mapInArrow(lambda batches: _segments(batches, segment), schema), "index")


def _split_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = [(t or b"").translate(WORD_BYTES).split() for t in batch.column("t").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(words, pa.list_(pa.binary())).cast(pa.list_(pa.string()))], ["id", "words"])


def item_words(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item``, ``id`` (as a string, '' for null), ``j`` and ``term``: the words of
    all items, written. Rows equal in id and words are one item; an item without
    words has no row."""
    prepare(items.sparkSession)
    split = items.select(
        F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"),
        F.col(f"`{text_col}`").cast("string").cast("binary").alias("t"),
    ).mapInArrow(_split_items, "id string, words array<string>").distinct()
    numbered = written(split.withColumn("item", F.monotonically_increasing_id()), "items")
    return written(numbered.select("item", "id", F.posexplode("words").alias("j", "term")), "item-words")


def _lists(index: DataFrame) -> DataFrame:
    return index.filter("term IS NOT NULL").select("segment", "term", "places")


def item_windows(index: DataFrame, words: DataFrame, window: int = WINDOW) -> DataFrame:
    """Windows of all items whose words all occur in the documents: ``item``, ``s``
    (first word), ``n`` (words), ``rare`` (its two rarest places, structs ``tf``,
    ``j``, ``term``) and ``near`` (its RAREST rarest different words)."""
    known = _lists(index).join(words.select("term").distinct(), "term", "left_semi")
    tf = known.groupBy("term").agg(F.sum(F.size("places")).alias("tf"))
    items = (words.join(tf, "term", "left").groupBy("item")
             .agg(F.array_sort(F.collect_list(F.struct("j", F.coalesce("tf", F.lit(0)).alias("tf"), "term"))).alias("w")))
    n = F.least(F.lit(window), F.size("w"))
    cut = items.select("item", n.alias("n"), "w", F.explode(F.sequence(F.lit(0), F.size("w") - n)).alias("s"))
    ranked = cut.select("item", "n", "s", F.array_sort(F.transform(
        F.slice("w", F.col("s") + 1, F.col("n")), lambda x: F.struct(x["tf"], x["j"], x["term"]))).alias("by"))
    names = F.transform(F.array_sort(F.array_distinct(F.transform(
        "by", lambda x: F.struct(x["tf"], x["term"])))), lambda x: x["term"])
    return ranked.filter(F.col("by")[0]["tf"] > 0).select(
        "item", "s", "n", F.slice("by", 1, 2).alias("rare"), F.slice(names, 1, RAREST).alias("near"))


def phrase_matches(index: DataFrame, words: DataFrame, windows: DataFrame) -> DataFrame:
    """``segment``, ``item``, ``at``, ``n``: every place where a window of an item
    stands word for word."""
    first, last = F.col("rare")[0], F.element_at("rare", -1)
    # Windows that share their two rarest words are looked up once, lo to hi.
    probes = written(
        windows.select("item", "s", "n", first["term"].alias("t1"), last["term"].alias("t2"),
                       first["j"].alias("j1"), (last["j"] - first["j"]).alias("d"))
        .groupBy("item", "n", "t1", "t2", "j1", "d")
        .agg(F.min("s").alias("lo"), (F.max("s") + F.col("n") - 1).alias("hi")), "probes")
    pairs = probes.select("t1", "t2", "d").distinct()
    lists = _lists(index)
    rarest = lists.join(pairs, F.col("term") == F.col("t1")).select(
        "segment", "t1", "t2", "d", F.col("places").alias("p1"))
    other = lists.join(pairs.select("t2").distinct(), F.col("term") == F.col("t2"), "left_semi").select(
        "segment", F.col("term").alias("t2"), F.col("places").alias("p2"))
    both = rarest.join(other, ["segment", "t2"]).select("segment", "t1", "t2", "d", F.array_intersect(
        "p2", F.transform("p1", lambda x: x + F.col("d"))).alias("p")).filter(F.size("p") > 0)
    # A diagonal: where word 0 of the item would stand.
    diagonals = (both.join(probes, ["t1", "t2", "d"])
                 .select("segment", "item", "n", "j1", "d", "lo", "hi", F.explode("p").alias("p"))
                 .select("segment", "item", "n", (F.col("p") - F.col("d") - F.col("j1")).alias("start"),
                         F.explode(F.sequence("lo", "hi")).alias("j")).distinct())
    expected = written(diagonals.join(words.select("item", "j", "term"), ["item", "j"]).select(
        "segment", "item", "n", "start", "j", "term", (F.col("start") + F.col("j")).alias("place")), "expected")
    asked = expected.groupBy("segment", "term").agg(F.collect_set("place").alias("places_asked"))
    stands = (lists.join(words.select("term").distinct(), "term", "left_semi").join(asked, ["segment", "term"])
              .select("segment", "term", F.explode(F.array_intersect("places", "places_asked")).alias("place")))
    runs = (expected.join(stands, ["segment", "term", "place"]).groupBy("segment", "item", "n", "start")
            .agg(F.array_sort(F.collect_set("j")).alias("js")))
    # n sorted different numbers that end n - 1 further on are consecutive.
    whole = F.filter("js", lambda j, i: F.get("js", i + F.col("n") - 1) == j + F.col("n") - 1)
    return runs.select("segment", "item", "n", "start", F.explode(whole).alias("j")).select(
        "segment", "item", (F.col("start") + F.col("j")).alias("at"), "n")


def _spans(within: int):
    @F.pandas_udf("array<int>")
    def spans(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
        """First places of the spans shorter than ``within`` with a place of each list."""
        out = []
        for lists in zip(a, b, c, strict=True):
            lists = [np.asarray(x, np.int64) for x in lists]
            starts = np.unique(np.concatenate(lists))
            for x in lists:
                i = np.searchsorted(x, starts)
                there = i < len(x)
                starts, i = starts[there], i[there]
                starts = starts[x[i] - starts < within]
            out.append(starts.astype(np.int32))
        return pd.Series(out)

    return spans


def near_matches(index: DataFrame, windows: DataFrame, within: int = WITHIN) -> DataFrame:
    """``segment``, ``item``, ``at``: places from which the rarest words of a window
    all stand within ``within`` words, in any order."""
    if within > GAP:
        raise ValueError(f"documents are {GAP} places apart; within must not be larger")
    # A window with fewer different words names its rarest more than once.
    t = [F.coalesce(F.get("near", F.lit(k)), F.get("near", F.lit(0))).alias(f"t{k}") for k in range(RAREST)]
    probes = written(windows.select("item", *t).distinct(), "near-probes")
    found = probes.select("t0", "t1", "t2").distinct()
    lists = _lists(index).join(words_of(probes), "term", "left_semi")
    found = found.join(lists.select("segment", F.col("term").alias("t0"), F.col("places").alias("p0")), "t0")
    for k in (1, 2):
        found = found.join(lists.select("segment", F.col("term").alias(f"t{k}"), F.col("places").alias(f"p{k}")),
                           ["segment", f"t{k}"])
    found = found.select("segment", "t0", "t1", "t2", _spans(within)("p0", "p1", "p2").alias("spans"))
    return (found.filter(F.size("spans") > 0).join(probes, ["t0", "t1", "t2"])
            .select("segment", "item", F.explode("spans").alias("at")))


def words_of(probes: DataFrame) -> DataFrame:
    return probes.select(F.explode(F.array(*[f"t{k}" for k in range(RAREST)])).alias("term")).distinct()


def find_contamination(docs: DataFrame, items: DataFrame, keep: list[str], id_col: str = "item_id",
                       text_col: str = "text", window: int = WINDOW, within: int = WITHIN,
                       segment: int = SEGMENT) -> DataFrame:
    """One row per document: the columns ``keep`` as a struct ``doc``, ``n_words``,
    ``n_hit`` (words inside any occurrence of a window of ``window`` consecutive
    words of an item; an item of fewer words is one window), ``exact`` and ``near``,
    the ids of the items found word for word and of those with a window whose rarest
    words stand close together (sorted strings; items of the same id stay apart).

    Words are runs of letters, digits and characters beyond ASCII, A-Z in lower
    case. Null and empty texts have no words and no hits; an empty table of documents
    gives no rows, without items nothing is hit. Repeated documents are judged alike,
    repeated items count once."""
    index = build_index(docs, keep, text_col, segment)
    words = item_words(items, id_col, text_col)
    windows = written(item_windows(index, words, window), "windows")
    names = words.filter("j = 0").select("item", "id")
    exact = phrase_matches(index, words, windows).join(names, "item").select(
        "segment", "at", F.lit(1).alias("kind"), (F.col("at") + F.col("n")).alias("to"),
        F.struct("id", "item").alias("found"))
    near = near_matches(index, windows, within).join(names, "item").select(
        "segment", "at", F.lit(2).alias("kind"), F.lit(None).cast("int").alias("to"),
        F.struct("id", "item").alias("found"))
    rows = (index.filter("term IS NULL").select("segment", "at", F.lit(0).alias("kind"), "doc", "n_words")
            .unionByName(exact, True).unionByName(near, True))
    # Along each segment: the document that a match stands in, and how many of its
    # words the matches before it have not covered.
    along = Window.partitionBy("segment").orderBy("at", "kind", "to")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    here = rows.select(
        "*", F.max(F.when(F.col("kind") == 0, F.col("at"))).over(along.rowsBetween(
            Window.unboundedPreceding, 0)).alias("start"),
        F.greatest(F.lit(0), F.col("to") - F.greatest("at", F.coalesce(F.max("to").over(before), "at"))).alias("new"))

    def ids(kind: int) -> Column:
        return F.collect_set(F.when(F.col("kind") == kind, F.col("found")))

    found = here.groupBy("segment", "start").agg(
        F.first("doc", ignorenulls=True).alias("doc"), F.max("n_words").alias("n_words"),
        F.coalesce(F.sum("new"), F.lit(0)).cast("long").alias("n_hit"), ids(1).alias("exact"), ids(2).alias("near"))
    return found.select("doc", "n_words", "n_hit", *[
        F.transform(F.array_sort(c), lambda x: x["id"]).alias(c) for c in ("exact", "near")])
