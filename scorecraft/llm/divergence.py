"""How the sources of a language differ in the terms that they use.

Method: the terms' strings stay where they are counted. A task counts the terms of
many texts at a time and writes, for each group of language and source, the terms'
64-bit digests and counts, and the strings once. Counts are shuffled by digest alone.
The smallest and the largest string of a digest tell whether two terms share it; such
digests are split by string from the same written counts. Strings are joined back
only for the terms that the result names.

All arithmetic is in whole numbers: a term with n of N occurrences among V kept terms
has p = 1 + floor(SCALE (n + 1) / (N + V)), and a source with p differs from one with
q by floor((p - q)^2 / q) in that term.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare, written
from .words import Numbering, byte_table

TERM_BYTES = byte_table(digits=False)
SCALE = 1_000_000_000
#: Documents of a language that a term must be in.
MIN_DOCS = 3
#: Terms that a task counts before it writes what it has.
FLUSH = 1 << 23
#: Entries of one written row.
ROW = 1 << 15
#: Pairs of sources that a task works out at a time.
PAIRS = 1 << 20
GROUP, DOCS, TEXT = 0, 1, 2
KEY = ["digest", "k"]


def _counted(batches: Iterator[pa.RecordBatch], flush: int, bits: int) -> Iterator[pa.RecordBatch]:
    """Rows of the written counts: ``kind`` GROUP has the occurrences of a language
    and source, DOCS the documents of a language, TEXT the strings. ``twin`` is 0 but
    for a term that shares its digest with an earlier one of the same ``part``."""
    part = TaskContext.get().partitionId() << 32
    mask = (1 << bits) - 1

    def row(kind, lang, source, digest, twin, n, terms) -> Iterator[pa.RecordBatch]:
        for i in range(0, max(len(digest), 1), ROW):
            cut = slice(i, i + ROW)
            yield pa.RecordBatch.from_arrays([
                pa.array([kind], pa.int8()), pa.array([part], pa.int64()), pa.array([lang], pa.string()),
                pa.array([source], pa.string()), pa.array([digest[cut]], pa.list_(pa.int64())),
                pa.array([twin[cut]], pa.list_(pa.int32())), pa.array([n[cut]], pa.list_(pa.int64())),
                pa.array([terms[cut]], pa.list_(pa.binary())).cast(pa.list_(pa.string()))],
                ["kind", "part", "lang", "source", "digest", "twin", "n", "terms"])

    def summed(group: np.ndarray, ids: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = group << 32 | ids
        order = np.argsort(key)
        key, at = np.unique(key[order], return_index=True)
        return key, np.add.reduceat(n[order], at) if len(key) else n

    def emptied() -> Iterator[pa.RecordBatch]:
        terms = list(numbers)
        digest = np.fromiter((xxhash.xxh64_intdigest(t, 42) & mask for t in terms), np.uint64, len(terms)).view(np.int64)
        order = np.argsort(digest, kind="stable")
        at = np.arange(len(terms))
        again = np.append(False, digest[order][1:] == digest[order][:-1])[:len(terms)]
        twin = np.empty(len(terms), np.int32)
        twin[order] = at - np.maximum.accumulate(np.where(again, 0, at)) if len(terms) else at
        key = np.concatenate([np.zeros(0, np.int64), *keys])
        key.sort()
        key, at = np.unique(key, return_index=True)
        times = np.diff(np.append(at, sum(map(len, keys))))
        ids, of = key & 0xFFFFFFFF, np.array(doc_group, np.int64)[key >> 32] if len(key) else key
        no = np.zeros(0, np.int64)
        names = list(groups)
        langs = Numbering()
        of_lang = np.array([langs[lang] for lang, _ in names], np.int64)
        for kind, (key, n) in ((GROUP, summed(of, ids, times)),
                               (DOCS, summed(of_lang[of], ids, np.ones(len(ids), np.int64)))):
            ends = np.searchsorted(key >> 32, np.arange(len(names if kind == GROUP else langs)), "right")
            begin = 0
            for (lang, source), end in zip(names if kind == GROUP else [(x, None) for x in langs], ends, strict=True):
                place = key[begin:end] & 0xFFFFFFFF
                yield from row(kind, lang, source, digest[place], twin[place], n[begin:end], [])
                begin = end
        yield from row(TEXT, None, None, digest, twin, no, terms)

    numbers, groups, keys, doc_group, n = Numbering(), Numbering(), [], [], 0
    for batch in batches:
        for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "t")), strict=True):
            ids = numbers.of(text.translate(TERM_BYTES).split())
            if len(ids):
                keys.append(ids | len(doc_group) << 32)
            doc_group.append(groups[lang, source])
            n += len(ids)
            if n >= flush or len(doc_group) >= flush:
                yield from emptied()
                numbers, groups, keys, doc_group, n = Numbering(), Numbering(), [], [], 0
                part += 1
    if doc_group:
        yield from emptied()


def term_counts(docs: DataFrame, flush: int = FLUSH, bits: int = 64) -> DataFrame:
    """The written counts of all documents by task; see ``_counted``."""
    prepare(docs.sparkSession)
    given = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")],
                        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("t"))
    return written(given.mapInArrow(
        lambda batches: _counted(batches, flush, bits),
        "kind tinyint, part long, lang string, source string, digest array<long>, twin array<int>, "
        "n array<long>, terms array<string>"), "term-counts")


def _entries(counts: DataFrame, kind: int, keep: list[str], *arrays: str) -> DataFrame:
    return counts.filter(F.col("kind") == kind).select(
        *keep, F.explode(F.arrays_zip(*arrays)).alias("x")).select(*keep, *[f"x.{a}" for a in arrays])


def _probability(n: str, total: str) -> Column:
    """p of a term as above; null in a language that keeps no term."""
    return F.expr(f"""CASE WHEN kept > 0 THEN 1 + (cast({n} + 1 AS decimal(19,0)) * cast({SCALE} AS decimal(10,0)))
                      div cast({total} + kept AS decimal(20,0)) END""")


def _apart(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div {q}")


def _pair_sums(batches: Iterator[pa.RecordBatch], at_a_time: int) -> Iterator[pa.RecordBatch]:
    """Sums over terms and the ordered pairs of the groups that have them. Where a
    group lacks a term its p is p0; what the sums over single groups assume for such
    pairs is taken off here."""
    def apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        return (p - q) * (p - q) // q

    for batch in batches:
        column = batch.column("x")
        flat = column.flatten()
        g, p, p0 = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(3))
        size = np.diff(column.offsets.to_numpy())
        begin = np.concatenate([[0], np.cumsum(size)[:-1]]).astype(np.int64)
        # Entry i meets every entry of its term.
        n_other, first = np.repeat(size, size).astype(np.int64), np.repeat(begin, size)
        upto = np.cumsum(n_other)
        names, number = np.unique(g, return_inverse=True)
        i = 0
        while i < len(g):
            j = max(i + 1, int(np.searchsorted(upto, (upto[i - 1] if i else 0) + at_a_time, "right")))
            a = np.repeat(np.arange(i, j), n_other[i:j])
            run = np.cumsum(n_other[i:j]) - n_other[i:j]
            b = np.arange(len(a)) - np.repeat(run, n_other[i:j]) + np.repeat(first[i:j], n_other[i:j])
            a, b = a[a != b], b[a != b]
            v = apart(p[a], p[b]) - apart(p[a], p0[b]) - apart(p0[a], p[b]) + apart(p0[a], p0[b])
            pair = number[a] * len(names) + number[b]
            order = np.argsort(pair, kind="stable")
            pair, at = np.unique(pair[order], return_index=True)
            if len(pair):
                yield pa.RecordBatch.from_arrays([
                    pa.array(names[pair // len(names)]), pa.array(names[pair % len(names)]),
                    pa.array(np.add.reduceat(v[order], at))], ["g", "h", "v"])
            i = j


def _with_others(df: DataFrame, others: DataFrame, salts: int = 32) -> DataFrame:
    """Join on the language ``l``, dealt over ``salts`` keys a language: a language
    may hold most of the groups."""
    return (df.withColumn("salt", F.pmod(F.xxhash64(*df.columns), F.lit(salts)).cast("int"))
            .join(others.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))),
                  ["l", "salt"]).filter("g != h").drop("salt"))


def source_divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = 200, flush: int = FLUSH,
                      bits: int = 64, pairs: int = PAIRS) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank`` for every language
    and source that occurs, null counting as ''.

    Terms are runs of letters and of characters beyond ASCII, A-Z in lower case. A
    language keeps the terms that are in ``min_docs`` of its documents; null and empty
    texts have none. Part ``pair``: each other source of the language with the sum over
    all kept terms of what lies between the two (0 if no term is kept). Part ``term``:
    the ``top`` terms that the source uses more than its language does. ``rank`` goes
    by value downwards, then by the item's bytes. Repeated rows are documents of their
    own; an empty table gives no rows. ``bits`` shortens the digests (for tests: terms
    that share one are told apart whatever its width)."""
    counts = term_counts(docs, flush, bits)
    groups = written(counts.filter(F.col("kind") == GROUP).select("lang", "source").distinct()
                     .withColumn("g", F.monotonically_increasing_id()), "groups")
    langs = written(groups.select("lang").distinct().withColumn("l", F.monotonically_increasing_id()), "langs")
    groups = groups.join(langs, "lang")
    in_langs = _entries(counts.filter(F.col("kind") == DOCS).drop("source").join(langs, "lang"),
                        DOCS, ["l", "part"], "digest", "twin", "n")
    in_groups = _entries(counts.join(groups, ["lang", "source"]), GROUP, ["l", "g", "part"], "digest", "twin", "n")
    texts = _entries(counts, TEXT, ["part"], "digest", "twin", "terms").withColumnRenamed("terms", "term")

    # Terms that share a digest can only make it more frequent.
    frequent = written(in_langs.groupBy("l", "digest").agg(F.sum("n").alias("docs"))
                       .filter(F.col("docs") >= min_docs).select("l", "digest"), "frequent")
    names = written(texts.join(frequent.select("digest").distinct(), "digest", "left_semi").groupBy("digest")
                    .agg(F.min("term").alias("low"), F.max("term").alias("high")), "names")
    shared = written(names.filter("low != high").select("digest"), "shared-digests")
    split = written(texts.join(shared, "digest", "left_semi").withColumn(
        "k", F.dense_rank().over(Window.partitionBy("digest").orderBy("term"))), "split-terms")
    strings = names.filter("low = high").select("digest", F.lit(0).alias("k"), F.col("low").alias("term")).unionByName(
        split.select(*KEY, "term").distinct())
    twins = split.select("part", "digest", "twin", "k")
    kept = written(
        frequent.join(shared, "digest", "left_anti").select("l", "digest", F.lit(0).alias("k")).unionByName(
            in_langs.join(twins, ["part", "digest", "twin"]).groupBy("l", *KEY).agg(F.sum("n").alias("docs"))
            .filter(F.col("docs") >= min_docs).select("l", *KEY)), "kept-terms")

    used = written(
        in_groups.join(twins, ["part", "digest", "twin"], "left")
        .select("l", "g", "digest", F.coalesce("k", F.lit(0)).alias("k"), "n").repartition("l", *KEY)
        .groupBy("l", *KEY, "g").agg(F.sum("n").alias("n")).join(kept, ["l", *KEY])
        .withColumn("n_lang", F.sum("n").over(Window.partitionBy("l", *KEY))), "used-terms")
    sizes = used.groupBy("l", "g").agg(F.sum("n").alias("total"), F.count("*").alias("terms"))
    of_lang = kept.groupBy("l").agg(F.count("*").alias("kept")).join(
        sizes.groupBy("l").agg(F.sum("total").alias("lang_total")), "l", "left")
    stats = groups.join(sizes.drop("l"), "g", "left").join(of_lang, "l", "left").na.fill(0)
    stats = written(stats.withColumn("p0", _probability("0", "total")), "sources")
    # Worked out anew where it is used: it would be as large as the counts again.
    chances = used.join(stats.select("g", "total", "lang_total", "kept", "p0"), "g").select(
        "l", "g", *KEY, _probability("n", "total").alias("p"), _probability("n_lang", "lang_total").alias("q"), "p0")

    # Ties at the last rank stay until their strings are there.
    best = (chances.filter("p > q").select("g", *KEY, _apart("p", "q").alias("value"))
            .withColumn("at", F.rank().over(Window.partitionBy("g").orderBy(F.desc("value"))))
            .filter(F.col("at") <= top).join(strings, KEY))
    terms = best.select("g", F.lit("term").alias("part"), F.col("term").alias("item"), "value")

    met = chances.groupBy("l", *KEY).agg(F.collect_list(F.struct("g", "p", "p0")).alias("x")).select("x").mapInArrow(
        lambda batches: _pair_sums(batches, pairs), "g long, h long, v long")
    one = chances.groupBy("l", "g", "p").agg(F.count("*").cast("decimal(18,0)").alias("c"))
    alone = _with_others(one, stats.select("l", F.col("g").alias("h"), "p0")).select(F.explode(F.array(
        F.struct("g", "h", (F.col("c") * _apart("p", "p0")).cast("decimal(38,0)").alias("v")),
        F.struct(F.col("h").alias("g"), F.col("g").alias("h"),
                 (F.col("c") * _apart("p0", "p")).cast("decimal(38,0)").alias("v")))).alias("x")).select("x.*")
    sums = (met.withColumn("v", F.col("v").cast("decimal(38,0)")).unionByName(alone)
            .groupBy("g", "h").agg(F.sum("v").alias("v")))
    both = _with_others(stats.select("l", "g", "kept", "terms", "p0"), stats.select(
        "l", F.col("g").alias("h"), F.col("terms").alias("h_terms"), F.col("p0").alias("h_p0"),
        F.col("source").alias("item")))
    without = F.when(F.col("kept") > 0, (F.col("kept") - F.col("terms") - F.col("h_terms")).cast(
        "decimal(18,0)") * _apart("p0", "h_p0")).otherwise(0)
    between = both.join(sums, ["g", "h"], "left").select(
        "g", F.lit("pair").alias("part"), "item",
        (F.coalesce("v", F.lit(0)) + without).cast("long").alias("value"))

    order = Window.partitionBy("g", "part").orderBy(F.desc("value"), "item")
    ranked = between.unionByName(terms).withColumn("rank", F.row_number().over(order)).filter(
        (F.col("part") == "pair") | (F.col("rank") <= top))
    return ranked.join(stats.select("g", "lang", "source"), "g").select(
        "lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank"))
