"""URL verdicts and byte shards against plain Python."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from scorecraft.llm import url_filter as U
from scorecraft.llm.queries import URL_RULES
from scorecraft.llm.sharding import byte_shards

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def canonical(url):
    if "://" not in (url or ""):
        return "", "", ""
    rest = url.split("://", 1)[1]
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host):])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    query = re.match(r"[^?#]*(?:\?([^#]*))?", rest)[1] or ""
    kept = sorted(p for p in query.split("&") if p and not re.match(r"(utm_[^=&]*|ref|gclid|fbclid)(=|$)", p))
    canon = re.sub(r":(80|443)$", "", re.sub(r"^(www|m)\.", "", host)) + re.sub("/+$", "", path)
    return host, path, canon + ("?" + "&".join(kept) if kept else "")


def brute(url, listed):
    host, path, canon = canonical(url)
    best = None
    for decision, h, p in URL_RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            best = max(best or (0, "", ""), (len(h + p), h + p, decision))
    hit = canon != "" and canon in listed
    return host, path, best and best[1], best[2] if best else "block" if hit else "allow", canon, hit


FIXED = [None, "", "no scheme", "http://", "://x", "HTTP://WWW.Example.ORG", "http://example.org/en/12", "http://a.com/fr/",
         "http://com/fr/x", "http://xcom/fr/x", "https://m.q.net:443/a//?b=1&a=2&utm_x=3#z", "http://q.net/a?a=2&b=1",
         "x://y://z/p", "http://q.net?ref=1", "http://q.net/#top", "http://ÄB.net/ä", "http://a.example.org/es/1\n2", "http://org/"]


def urls():
    rnd = random.Random(1)
    return FIXED + [rnd.choice(["http://", "https://", "HTTPS://www.", "http://m."]) + rnd.choice(
        ["a", "b.a", "example", "x.example"]) + rnd.choice([".org", ".com", ".net"]) + rnd.choice(
        ["/", "/en/", "/es/", "/fr/", "/de/", "/EN/", ""]) + str(rnd.randrange(30)) + rnd.choice(
        ["", "/", "#a", "?ref=x", "?page=1", "?page=1&utm_a=b"]) for _ in range(600)]


@pytest.mark.parametrize("max_blocks", [1 << 17, 1])
def test_verdicts(spark, max_blocks):
    rows = list(enumerate(urls())) + [(7777, FIXED[6]), (7777, FIXED[6]), (None, FIXED[10])]
    pages = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "1 AS host", "2 AS block", "3 AS w0")
    listed = pages.filter("page_id % 20 = 0")
    marks = {canonical(u)[2] for i, u in rows if i is not None and i % 20 == 0}
    got = U.judge_urls(pages, listed, URL_RULES, max_blocks=max_blocks).collect()
    assert Counter(map(tuple, got)) == Counter((i, *brute(u, marks)) for i, u in rows)
    assert any(r.listed for r in got) and not all(r.listed for r in got)
    none = U.judge_urls(pages, listed.limit(0), URL_RULES).collect()
    assert Counter(map(tuple, none)) == Counter((i, *brute(u, set())) for i, u in rows)
    assert U.judge_urls(pages.limit(0), listed, URL_RULES).collect() == []


def test_filter_has_no_false_negatives_and_few_hits(spark):
    keys = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("key"))
    blocks = U.bloom_blocks(keys, "key", 3000 * 12 // 512)

    def maybe(df):
        fits = F.lit(True)
        for i, bit in enumerate(U._word_bits(F.col("key"))):
            fits = fits & (F.col(f"w{i}").bitwiseAND(bit) != 0)
        return df.withColumn("block", U._block(F.col("key"), 3000 * 12 // 512)).join(blocks, "block").filter(fits).count()

    assert maybe(keys) == 3000
    assert maybe(spark.range(20000).select(F.concat(F.lit("other"), "id").alias("key"))) < 600


def check_shards(rows, got, n):
    total = sum(len((t or "").encode()) + 1 for _, t in rows)
    order = sorted(got, key=lambda r: (r.shard, r.slot))
    slots, at = {}, 0
    for r in order:
        assert r.slot == slots.get(r.shard, -1) + 1 and r.start_byte == at
        slots[r.shard] = r.slot
        at += r.size
    assert at == total
    ids = [(r.doc_id is not None, r.doc_id or 0) for r in order]
    assert ids == sorted(ids)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    largest = max(r.size for r in got)
    for s in range(n):
        assert abs(sum(r.size for r in got if r.shard == s) - total / n) <= largest


def test_shards(spark):
    rnd = random.Random(2)
    rows = [(rnd.randrange(-400, 400), "é" * rnd.randrange(200)) for _ in range(700)]
    rows += [(5, "same")] * 300 + [(None, "x"), (None, None), (9, None), (9, "")]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS).selectExpr(
        "*", "1 AS id", "2 AS size", "3 AS pid", "4 AS shard")
    check_shards(rows, byte_shards(df, 16).collect(), 16)
    one = [(1, "a" * 10000), (2, "b")]
    got = byte_shards(spark.createDataFrame([(i, t, "en", "s", 1) for i, t in one], DOCS), 4).collect()
    assert {r.shard for r in got} == {1, 3} or {r.shard for r in got} == {2, 3}
    assert byte_shards(df.limit(0), 16).collect() == []
