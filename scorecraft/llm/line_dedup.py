"""Removal of repeated multi-line chunks.

Method: a rolling hash over the hashes of neighbouring lines picks the line
breaks at which a text is cut, so the same run of lines is cut alike wherever it
stands. Chunks are grouped by hashes of their lines' hashes; those whose hashes
occur twice are compared by their bytes, and every occurrence but the first of a
repeated chunk is removed. Passages that hold no whole chunk are found through the
smallest runs of lines with enough words, taken from every line on and back from
every line, and compared in the same way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import TEXTS, written
from .pii import _scan

#: One line break in so many is a cut, on average.
SPACING = 4
#: A line of so many words is a chunk of its own.
LONG_LINE = 50
#: Words of a passage that is removed wherever its lines are cut.
PASSAGE = 50
KEY = ["key", "key2"]


def _rolled(h: str) -> Column:
    """Cyclic-polynomial rolling hash over each line and the one before it."""
    before = F.concat(F.array(F.lit(0).cast("long")), F.slice(h, F.lit(1), F.size(h) - 1))
    return F.zip_with(h, before, lambda a, b: a.bitwiseXOR(
        F.shiftleft(b, 1).bitwiseOR(F.shiftrightunsigned(b, 63))))


def _words(x: Column) -> Column:
    return F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) + 1


def _words_or_none(x: Column) -> Column:
    """Words of a line; indents and blank lines have none."""
    x = F.trim(F.replace(x, F.lit("\t"), F.lit(" ")), F.lit(" \r\f\v"))
    return F.when(x == "", 0).otherwise(_words(x))


def with_chunks(df: DataFrame, text: str, spacing: int = SPACING, long_line: int = LONG_LINE) -> DataFrame:
    """``df`` plus the lines of the column ``text`` (``c_lines``), their hashes
    (``c_hash``), spaces (``c_spaces``) and whether each is long (``c_long``), and
    ``c_first`` and ``c_last``, the first and last line of each chunk, in order (null
    for null).

    A chunk ends after a line where the rolling hash of the last two lines is
    divisible by ``spacing``, and before and after every line of ``long_line``
    or more space-separated words."""
    keep = df.columns
    # One step per select, so that no step's array is computed twice.
    df = df.select("*", F.split(text, "\n", -1).alias("c_lines"))
    df = df.select("*", F.transform("c_lines", lambda x: F.xxhash64(x)).alias("c_hash"),
                   F.transform("c_lines", lambda x: _words(x) - 1).alias("c_spaces"))
    df = df.select("*", F.transform("c_spaces", lambda n: n + 1 >= long_line).alias("c_long"))
    by_long = F.zip_with("c_long", F.concat(F.slice("c_long", F.lit(2), F.size("c_long")), F.array(
        F.lit(False))), lambda a, b: a | b)
    df = df.select("*", F.zip_with(_rolled("c_hash"), by_long, lambda r, b: b | (
        F.pmod(r, F.lit(spacing)) == 0)).alias("c_ends"))
    last = F.array_compact(F.transform("c_ends", lambda e, i: F.when(e | (i == F.size("c_ends") - 1), i)))
    df = df.select(*keep, "c_lines", "c_hash", "c_spaces", "c_long", last.alias("c_last"))
    first = F.concat(F.array(F.lit(0)), F.transform("c_last", lambda i: i + 1))
    return df.select("*", F.slice(first, F.lit(1), F.size("c_last")).alias("c_first"))


def _run(array: str | Column, first: Column, last: Column) -> Column:
    return F.slice(array, first + 1, last - first + 1)


def with_passages(df: DataFrame, min_words: int) -> DataFrame:
    """``df`` (with ``c_words``) plus ``c_spans``: the smallest runs of lines with ``min_words``
    words, one from each line on and one back from each line, without repeats;
    first line times 2^32 plus last line.

    If two texts share a run of lines with that many words, the run from a
    shared line on or the run back from it (or from the last shared line) lies
    within what they share, so these runs together cover all of it, whatever
    stands around it."""
    keep = df.columns
    df = df.select(*keep, F.concat(F.array(F.lit(0)), _scan(
        F.col("c_words"), lambda a, b: a + b, 0)).alias("c_upto"))
    df = df.select("*", F.filter(F.array(*[F.lit(1 << k) for k in range(30, -1, -1)]),
                                 lambda d: d < F.size("c_upto")).alias("c_steps"))
    n = F.size("c_lines")

    def upto(i: Column) -> Column:
        return F.get("c_upto", i)

    # Binary search in the running word counts; -1 and n: not enough words.
    def on(i: Column) -> Column:
        return F.aggregate("c_steps", i, lambda at, d: F.when(
            (at + d <= n) & (upto(at + d) - upto(i) < min_words), at + d).otherwise(at))

    def back(i: Column) -> Column:
        return F.aggregate("c_steps", i + 1, lambda at, d: F.when(
            (at >= d) & (upto(i + 1) - upto(at - d) < min_words), at - d).otherwise(at)) - 1

    df = df.select(*keep, F.transform("c_lines", lambda _, i: on(i)).alias("c_on"),
                   F.transform("c_lines", lambda _, i: back(i)).alias("c_back"))
    spans = F.concat(
        F.transform("c_on", lambda e, i: F.when(e < n, F.shiftleft(i.cast("long"), 32) + e)),
        F.transform("c_back", lambda s, i: F.when(s >= 0, F.shiftleft(s.cast("long"), 32) + i)))
    return df.select(*keep, F.array_distinct(F.array_compact(spans)).alias("c_spans"))


def _eligible(first: Column, last: Column, long_line: int) -> Column:
    """Two lines with something on them, or ``long_line`` words."""
    full = F.size(F.filter(_run("c_words", first, last), lambda n: n > 0))
    return (full > 1) | (F.aggregate(_run("c_spaces", first, last), F.lit(1), lambda x, n: x + n) >= long_line)


def _row_key(id_col: str, text: Column) -> list[Column]:
    """Order and key of a document: its id, then 62 bits of its text's hash, which
    together fill a decimal; then a second hash. Null ids last."""
    number = F.coalesce(F.col(id_col).cast("decimal(20,0)"), F.lit(str(2**63)).cast("decimal(20,0)"))
    return [(number * F.lit(str(2**62)).cast("decimal(19,0)")
             + F.xxhash64(text).bitwiseAND(F.lit(2**62 - 1)).cast("decimal(19,0)")).cast("decimal(38,0)").alias("key"),
            F.hash(text).alias("key2")]


def _pieces(min_words: int | None, long_line: int) -> Column:
    """What may count as repeated: ``struct<first, last, h1, h2>``, the hashes being
    those of the lines' hashes."""
    def piece(first: Column, last: Column, may: Column) -> Column:
        run = _run("c_hash", first, last)
        return F.when(may, F.struct(first.alias("first"), last.alias("last"),
                                    F.xxhash64(run).alias("h1"), F.hash(run).alias("h2")))

    chunks = F.zip_with("c_first", "c_last", lambda s, e: piece(s, e, _eligible(s, e, long_line)))
    if min_words is None:
        return F.array_compact(chunks)

    def passage(x: Column) -> Column:
        first, last = F.shiftright(x, 32).cast("int"), x.bitwiseAND(F.lit(2**32 - 1)).cast("int")
        # A long line is a chunk already.
        return piece(first, last, (first < last) | ~F.get("c_long", first))

    return F.array_compact(F.concat(chunks, F.transform("c_spans", passage)))


def _written_alone(df: DataFrame, name: str) -> DataFrame:
    """``written``, and the shuffle files of the query go when it ends, not when
    the driver happens to collect its garbage."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key)
    conf.set(key, "true")
    try:
        return written(df, name, TEXTS)
    finally:
        conf.set(key, before)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                length_col: str | None = "n_chars", spacing: int = SPACING,
                long_line: int = LONG_LINE, min_words: int | None = None) -> DataFrame:
    """``docs`` as a struct ``doc`` with the text shortened (and ``length_col``
    set to its new length), plus ``n_removed``, the number of pieces taken out
    (those that overlap count as one).

    A chunk counts as repeated when the same bytes occur elsewhere, in another
    document or the same one; the occurrence in the smallest id (then the
    smallest text hash, then the earliest place) stays. With ``min_words`` every
    run of lines with so many words is judged in the same way, wherever the
    chunks are cut (see ``with_passages``). A removed line thus always stays
    at an earlier place. Pieces that share both hashes but differ in a byte
    are none of them removed.
    Null texts stay null, a text of nothing but repeats becomes empty. Documents
    with a null id come last in the order. Rows equal in id and text count as one
    document and keep the same chunks. Empty tables and other columns are fine.
    """
    text = F.col(f"`{text_col}`").cast("string")
    cut = with_chunks(docs.filter(text.isNotNull()).select(
        *_row_key(id_col, text), text.alias("t")), "t", spacing, long_line)
    cut = cut.select("*", F.transform("c_lines", _words_or_none).alias("c_words"))
    if min_words is not None:
        cut = with_passages(cut, min_words)
    # The outer form: for the inner one Spark would work out every step once more in a
    # filter on the array's size. Written, as it is read twice.
    pieces = written(cut.select(*KEY, F.explode_outer(_pieces(min_words, long_line)).alias("piece"))
                     .filter("piece IS NOT NULL").select(*KEY, "piece.*"), "pieces")
    repeated = (pieces.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("key").alias("first_key"))
                .filter("n > 1").select("h1", "h2", "first_key"))
    # Of the document that keeps a piece all its places come along, the first of
    # them is left out after the sort.
    found = (pieces.join(repeated, ["h1", "h2"])
             .groupBy(*KEY).agg(F.array_sort(F.collect_set(F.struct(
                 "h1", "h2", "first", "last", (F.col("key") == F.col("first_key")).alias("keeps")))).alias("f")))
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), *_row_key(id_col, text))
    # The same join at every size: what is found grows with the corpus. The texts cross
    # the network here and nowhere else.
    joined = _written_alone(whole.join(found.hint("merge"), KEY, "left"), "texts-and-pieces").withColumn(
        "t", F.col(f"doc.`{text_col}`").cast("string"))
    # Byte comparison of what has the same hashes.
    bodies = joined.filter("f IS NOT NULL").select("f", F.split("t", "\n", -1).alias("lines")).select(
        F.explode(F.transform("f", lambda x: F.struct(x["h1"].alias("h1"), x["h2"].alias("h2"), F.array_join(
            _run("lines", x["first"], x["last"]), "\n").alias("body")))).alias("x")).select("x.*")
    unequal = written(bodies.groupBy("h1", "h2", "body").agg(F.lit(1).alias("one")).groupBy("h1", "h2")
                      .agg(F.count("*").alias("texts")).filter("texts > 1").select("h1", "h2"), "unequal-pieces")
    wrong = (joined.filter("f IS NOT NULL").select(*KEY, F.explode("f").alias("x")).select(*KEY, "x.h1", "x.h2")
             .join(unequal, ["h1", "h2"]).groupBy(*KEY).agg(F.collect_set(F.struct("h1", "h2")).alias("wrong")))
    wrong = written(wrong, "wrong-pieces")
    gone = F.array_sort(F.transform(F.filter("f", lambda x, i: (~x["keeps"] | (
        (i > 0) & (F.get("f", i - 1)["h1"] == x["h1"]) & (F.get("f", i - 1)["h2"] == x["h2"]))) & ~F.coalesce(
            F.array_contains("wrong", F.struct(x["h1"].alias("h1"), x["h2"].alias("h2"))), F.lit(False))),
        lambda x: F.struct(x["first"].alias("first"), x["last"].alias("last"))))
    cut = joined.join(wrong, KEY, "left").select("doc", "t", gone.alias("gone")).select(
        "doc", "t", F.when(F.size("gone") > 0, F.col("gone")).alias("gone"))
    cut = cut.select("doc", "t", "gone", _scan(
        F.transform("gone", lambda x: x["last"] + 1), lambda a, b: F.greatest(a, b), 0).alias("upto"),
        F.split(F.when(F.col("gone").isNotNull(), F.col("t")), "\n", -1).alias("lines"))
    # The runs of lines between removed ones: linear in the text.
    starts = F.concat(F.array(F.lit(0)), F.col("upto"))
    ends = F.concat(F.transform("gone", lambda x: x["first"]), F.array(F.size("lines")))
    kept = F.when(F.col("gone").isNull(), F.col("t")).otherwise(F.array_join(F.flatten(
        F.zip_with(starts, ends, lambda s, e: F.slice("lines", s + 1, F.greatest(e - s, F.lit(0))))), "\n"))
    # Those that start where the ones before have ended.
    apart = F.filter(F.zip_with("gone", F.slice(starts, F.lit(1), F.size("gone")),
                                lambda x, b: x["first"] >= b), lambda x: x)
    out = cut.withColumn("t2", kept)
    fields = [F.col("t2").alias(c) if c == text_col
              else F.when(F.col("t2").isNull(), F.col(f"doc.`{c}`")).otherwise(
                  F.length("t2")).cast(dict(docs.dtypes)[c]).alias(c) if c == length_col
              else F.col(f"doc.`{c}`") for c in docs.columns]
    return out.select(F.struct(*fields).alias("doc"),
                      F.coalesce(F.when(F.col("gone").isNotNull(), F.size(apart)),
                                 F.lit(0)).alias("n_removed"))
