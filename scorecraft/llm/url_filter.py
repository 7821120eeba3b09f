"""URL filtering by editorial rules and by a list of canonical URLs.

Method for the list: a blocked Bloom filter of the listed canonical URLs lets
possible hits through, and an exact hash join on the canonical URL removes the
false positives. Rows the filter excludes never reach a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Words of 64 bits in a block; a key sets one bit in each.
WORDS = 8
#: Query parameters that don't change which page an address names.
TRACKING = r"utm_[^=&]*|ref|gclid|fbclid"


def url_host(url: Column) -> Column:
    """Text after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; empty for null or without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, UPPER, LOWER)


def url_path(url: Column) -> Column:
    """Text after the host up to ``?``, ``#`` or the end; empty like the host."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def canonical_url(url: Column) -> Column:
    """Scheme, ``www.``/``m.`` prefix, default port, fragment, tracking
    parameters and trailing slashes dropped, remaining parameters sorted.
    Empty when there is no ``://``."""
    host = F.regexp_replace(F.regexp_replace(url_host(url), r"^(www|m)\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(url_path(url), r"/+$", "")
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(
        F.split(query, "&"), lambda p: (p != "") & ~p.rlike(rf"^({TRACKING})(=|$)")))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(
        F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit("")))


def rule_columns(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]
                 ) -> tuple[Column, Column]:
    """``(rule, decision)`` of the longest fitting rule, null where none fits.

    ``rules`` are ``(decision, host, path)``; a rule fits its host and every
    subdomain when the path starts with the rule's. The list is written into
    the plan as one CASE, so it is meant for editorial rules (hundreds); long
    lists of addresses belong in ``listed``."""
    found, decided = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, r_host, r_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == r_host) | host.endswith("." + r_host)) & path.startswith(r_path)
        found = F.when(fits, F.lit(r_host + r_path)).otherwise(found)
        decided = F.when(fits, F.lit(decision)).otherwise(decided)
    return found, decided


def _block(key: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n_blocks)).cast("int")


def _word_bits(key: Column) -> list[Column]:
    """One 64-bit mask per word: the i-th 6-bit slice of a second hash."""
    h = F.xxhash64(key, F.lit("bits"))
    return [F.call_function(
        "shiftleft", F.lit(1).cast("long"),
        F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(WORDS)]


def bloom_blocks(keys: DataFrame, key_col: str, n_blocks: int) -> DataFrame:
    """The filter as a table ``(block, w0 .. w7)``: at most ``n_blocks`` rows
    of 68 bytes, built with one map-side combined aggregation."""
    key = F.col(key_col)
    bits = keys.select(_block(key, n_blocks).alias("block"),
                       *[b.alias(f"w{i}") for i, b in enumerate(_word_bits(key))])
    return bits.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def judge_urls(pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str, str]],
               id_col: str = "page_id", url_col: str = "url", listed_col: str = "url",
               bits_per_key: int = 12, max_blocks: int = 1 << 17) -> DataFrame:
    """One row per page: ``id_col, host, path, rule, verdict, canonical, listed``.

    The verdict is the longest fitting rule's, else ``block`` for a page whose
    canonical URL is listed, else ``allow``. The broadcast filter holds at most
    ``max_blocks`` rows (68 bytes each, 9 MB at the default); a longer list only
    raises its false-positive rate, which the exact join takes back. Possible
    hits are shuffled on the canonical URL by a plain equi-join, whose hot keys
    adaptive execution can split.

    A null URL, or one without ``://``, has an empty host, path and canonical
    form and is never listed. Repeated pages and repeated list entries give one
    row per page. Empty tables and other columns are fine.
    """
    canon = (listed.select(canonical_url(F.col(listed_col)).alias("canonical"))
             .filter("canonical <> ''").distinct())
    n_keys = canon.count()
    n_blocks = max(1, min(max_blocks, -(-n_keys * bits_per_key // (64 * WORDS))))
    blocks = bloom_blocks(canon, "canonical", n_blocks)

    url = F.col(url_col)
    host, path = F.col("host"), F.col("path")
    rule, decision = rule_columns(host, path, rules)
    judged = (
        pages.select(F.col(id_col).alias("id"), url_host(url).alias("host"),
                     url_path(url).alias("path"), canonical_url(url).alias("canonical"))
        .withColumn("rule", rule).withColumn("decision", decision)
        .withColumn("block", _block(F.col("canonical"), n_blocks)))
    fits = F.lit(True)
    for i, bit in enumerate(_word_bits(F.col("canonical"))):
        fits = fits & (F.coalesce(F.col(f"w{i}"), F.lit(0)).bitwiseAND(bit) != 0)
    probed = judged.join(F.broadcast(blocks), "block", "left").withColumn(
        "maybe", fits & (F.col("canonical") != "")).select(
            "id", "host", "path", "rule", "decision", "canonical", "maybe")
    exact = (probed.filter("maybe").drop("maybe")
             .join(canon.withColumn("listed", F.lit(True)).hint("shuffle_hash"),
                   "canonical", "left")
             .withColumn("listed", F.coalesce("listed", F.lit(False))))
    rest = probed.filter("not maybe").drop("maybe").withColumn("listed", F.lit(False))
    return exact.unionByName(rest).select(
        F.col("id").alias(id_col), "host", "path", "rule",
        F.coalesce("decision", F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"),
        "canonical", "listed")
