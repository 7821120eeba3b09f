"""Modified Kneser-Ney models of whole code points, one per language.

Spark counts every n-gram of every document and works out discounts, context
weights and probabilities as tables. An n-gram is two numbers: ``b`` holds its
last three code points, ``a`` those before, so nothing is folded and equal codes
are equal n-grams. The model lies in files, one per language and bucket of codes,
as sorted arrays; scoring reads the buckets its texts need. Nothing of the model
passes through the driver, so it may grow with the corpus.
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import prepare, written
from .token_store import _put

ORDER = 5
BITS = 21
#: Stands before a text; no code point.
PAD = 0x110000
#: Distinct n-grams that a counting task holds; characters worked on at once.
HELD, SLICE = 1 << 20, 1 << 20
#: Entries of a bucket, about, and bytes of buckets that a worker keeps.
BUCKET, CACHE = 1 << 17, 96 << 20
#: Languages whose number of buckets a worker remembers.
LANGS = 1 << 12

GRAM = np.dtype([("a", "<i8"), ("b", "<i8")])


def _mask(symbols: int) -> int:
    return (1 << BITS * max(symbols, 0)) - 1


def lang_key(lang: str) -> Column:
    """The language as a key that is never null: null is a language of its own."""
    value = F.col(lang).cast("string")
    return F.when(value.isNull(), "null").otherwise(F.concat(F.lit("="), value))


def _rank(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """64-bit mix of a code by which arrays are sorted; equal mixes are told apart by the code."""
    x = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + b.astype(np.uint64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def text_grams(text: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(a, b)`` of the n-gram that ends at each character."""
    tail = np.full(ORDER - 1, PAD, np.int64)
    for at in range(0, len(text), SLICE):
        points = np.frombuffer(text[at:at + SLICE].encode("utf-32-le", "surrogatepass"), np.uint32)
        s = np.concatenate([tail, points.astype(np.int64)])
        tail = s[-(ORDER - 1):]
        w = [s[i:len(s) - ORDER + 1 + i] for i in range(ORDER)]
        yield w[0] << BITS | w[1], (w[2] << BITS | w[3]) << BITS | w[4]


def distinct(a: np.ndarray, b: np.ndarray, n: np.ndarray | None = None
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct codes and their counts."""
    order = np.argsort(_rank(a, b))
    a, b = a[order], b[order]
    # Codes of equal mix that alternate stay several rows, which are summed later.
    new = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])][:len(a)])
    if n is None:
        return a[new], b[new], np.diff(np.r_[new, len(a)])
    return a[new], b[new], np.add.reduceat(n[order], new) if len(new) else n


def count_grams(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """``lang, a, b, n``: all n-grams of the highest order."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, list] = {}
        fresh: dict[str, list] = {}

        def merge(lang: str) -> None:
            parts = ([held[lang]] if lang in held else []) + [distinct(
                *map(np.concatenate, zip(*fresh.pop(lang), strict=True)))]
            held[lang] = distinct(*map(np.concatenate, zip(*parts, strict=True))) if len(parts) > 1 else parts[0]

        def flush() -> Iterator[pd.DataFrame]:
            for lang in [*fresh]:
                merge(lang)
            for lang, (a, b, n) in held.items():
                yield pd.DataFrame({"lang": lang, "a": a, "b": b, "n": n})
            held.clear()

        size = 0
        for pdf in batches:
            for lang, text in zip(pdf["lang"], pdf["text"], strict=True):
                for a, b in text_grams(text or ""):
                    fresh.setdefault(lang, []).append((a, b))
                    size += len(a)
                    if size > HELD:
                        for x in [*fresh]:
                            merge(x)
                        size = 0
                        if sum(len(h[0]) for h in held.values()) > HELD:
                            yield from flush()
        yield from flush()

    return (docs.select(lang_key(lang_col).alias("lang"), F.col(text_col).cast("string").alias("text"))
            .mapInPandas(count, "lang string, a long, b long, n long")
            .groupBy("lang", "a", "b").agg(F.sum("n").alias("n")))


def model_table(counts: DataFrame) -> DataFrame:
    """``lang, k, a, b, logp, backoff`` of all n-grams and contexts, from the
    counts of the highest order. The empty n-gram is a symbol never seen."""
    c = {ORDER: written(counts, "grams")}
    for k in range(ORDER - 1, 0, -1):  # in how many left contexts
        c[k] = written(c[k + 1].groupBy(
            "lang", F.col("a").bitwiseAND(_mask(k - 3)).alias("a"), F.col("b").bitwiseAND(
                _mask(min(k, 3))).alias("b")).agg(F.count("*").alias("n")), "grams")
    symbols = c[1].groupBy("lang").agg(F.count("*").alias("v"))
    prob = symbols.select("lang", F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"),
                          F.expr("1D / (v + 1)").alias("p"))
    tables, probs = [], {0: prob}
    contexts = {}
    for k in range(1, ORDER + 1):
        few = c[k].groupBy("lang").agg(*[F.sum((F.col("n") == i).cast("long")).alias(f"n{i}") for i in range(1, 5)])
        few = few.selectExpr("*", "CASE WHEN n1 > 0 AND n2 > 0 THEN n1 / (n1 + 2 * n2) END AS y").selectExpr(
            "lang", *[f"CASE WHEN y IS NULL OR n{i} = 0 THEN 0.5D ELSE least(greatest("
                      f"{i} - {i + 1} * y * n{i + 1} / nullif(n{i}, 0), 0.05D), {i} - 0.05D) END AS d{i}" for i in (1, 2, 3)])
        few = written(few, "discounts")  # a row per language: broadcast by its true size
        rows = c[k].join(few, "lang").select(
            "lang", "a", "b", "n", F.expr("CASE n WHEN 1 THEN d1 WHEN 2 THEN d2 ELSE d3 END").alias("d"),
            F.shiftright("a", BITS).alias("ca"),
            F.shiftright("b", BITS).bitwiseOR(F.shiftleft(F.col("a").bitwiseAND(_mask(1)), 2 * BITS)).alias("cb"))
        contexts[k] = written(rows.groupBy("lang", "ca", "cb").agg(
            F.sum("n").alias("total"), F.sum("d").alias("freed")), "contexts")
        lower = probs[k - 1].select("lang", F.col("a").alias("sa"), F.col("b").alias("sb"), F.col("p").alias("lower"))
        probs[k] = written(
            rows.join(contexts[k], ["lang", "ca", "cb"])
            .withColumn("sa", F.col("a").bitwiseAND(_mask(k - 4)))
            .withColumn("sb", F.col("b").bitwiseAND(_mask(min(k - 1, 3)))).join(lower, ["lang", "sa", "sb"])
            .select("lang", "a", "b", F.expr("(n - d) / total + freed / total * lower").alias("p")), "probabilities")
    for k in range(ORDER + 1):
        rows = probs[k].select("lang", "a", "b", F.ln("p").cast("float").alias("logp"))
        if k < ORDER:  # also those that only occur as contexts
            rows = rows.join(contexts[k + 1].select(
                "lang", F.col("ca").alias("a"), F.col("cb").alias("b"),
                F.expr("CAST(ln(freed / total) AS FLOAT)").alias("backoff")), ["lang", "a", "b"], "full")
        else:
            rows = rows.withColumn("backoff", F.lit(0).cast("float"))
        tables.append(rows.select("lang", F.lit(k).alias("k"), "a", "b", "logp", F.coalesce(
            "backoff", F.lit(0).cast("float")).alias("backoff")))
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return written(out, "model")


def _file(lang: str, bucket: int) -> str:
    return f"{hashlib.sha256(lang.encode('utf-8', 'surrogatepass')).hexdigest()}-{bucket}"


#: ``rank`` mixes the whole code and can be undone, so rank and ``ka`` (order and ``a``)
#: say the code exactly: equal entries are equal n-grams.
ENTRY = np.dtype([("rank", "<u8"), ("ka", "<i8"), ("logp", "<f4"), ("backoff", "<f4")])


def _coded(k: np.ndarray | int, a: np.ndarray) -> np.ndarray:
    return a + (np.asarray(k, np.int64) << 2 * BITS)


def write_model(model: DataFrame) -> str:
    """Folder of the model's files: each language's entries in buckets that follow its
    size, and one file with the number of its buckets."""
    spark = model.sparkSession
    folder = scratch_path(spark, "language-model")
    sizes = written(model.groupBy("lang").agg(F.expr(f"2 * (count(*) div {2 * BUCKET}) + 1").alias("buckets")), "buckets")

    def write_size(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        for pdf in batches:
            for lang, n in zip(pdf["lang"], pdf["buckets"], strict=True):
                _put(folder, _file(lang, -1), np.array([n], "<i8").tobytes(), TaskContext.get().taskAttemptId())
            yield pd.DataFrame({"n": [len(pdf)]})

    def write(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        from pyspark import TaskContext

        e = np.zeros(len(pdf), ENTRY)
        for c in ("logp", "backoff"):
            e[c] = pdf[c].to_numpy()
        e["ka"] = _coded(pdf["k"].to_numpy(), pdf["a"].to_numpy())
        e["rank"] = _rank(e["ka"], pdf["b"].to_numpy())
        e = np.sort(e, order=["rank"])
        _put(folder, _file(key[0], key[1]), e.tobytes(), TaskContext.get().taskAttemptId())
        return pd.DataFrame({"n": [len(e)]})

    sizes.mapInPandas(write_size, "n long").agg(F.sum("n")).first()
    (model.join(sizes, "lang").withColumn("bucket", F.expr("pmod(b, buckets)")).drop("buckets").groupBy("lang", "bucket")
     .applyInPandas(write, "n long").agg(F.sum("n")).first())
    return folder


class Reader:
    """Looks codes up in a written model and keeps ``CACHE`` bytes of buckets. They are
    visited in the same order again and again, so what is kept stays and only what does
    not fit is read again; ``bytes_read`` counts what was read."""

    def __init__(self, folder: str):
        self.folder = folder
        self.kept: dict[tuple[str, int], np.ndarray] = {}
        self.counts: OrderedDict[str, int] = OrderedDict()
        self.size = self.bytes_read = 0

    def _read(self, name: str) -> bytes:
        from pyarrow import fs

        uri = self.folder if "://" in self.folder else self.folder.replace("file:", "file://", 1) \
            if self.folder.startswith("file:") else f"file://{self.folder}"
        system, path = fs.FileSystem.from_uri(uri)
        if system.get_file_info(f"{path}/{name}").type != fs.FileType.File:
            return b""
        with system.open_input_file(f"{path}/{name}") as f:
            content = f.read()
        self.bytes_read += len(content)
        return content

    def buckets(self, lang: str) -> int:
        """Number of the language's buckets; 0 for one without a model."""
        if lang not in self.counts:
            if len(self.counts) >= LANGS:
                self.counts.popitem(last=False)
            content = self._read(_file(lang, -1))
            self.counts[lang] = int(np.frombuffer(content, "<i8")[0]) if content else 0
        return self.counts[lang]

    def _bucket(self, lang: str, bucket: int) -> np.ndarray:
        key = (lang, bucket)
        if key in self.kept:
            return self.kept[key]
        entries = np.frombuffer(self._read(_file(lang, bucket)), ENTRY)
        if self.size + entries.nbytes <= CACHE:
            self.kept[key] = entries
            self.size += entries.nbytes
        return entries

    def find(self, lang: str, k: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log probabilities (NaN: none) and log back-off weights (0: none)."""
        logp, backoff = np.full(len(a), np.nan), np.zeros(len(a))
        at = b % self.buckets(lang)
        order = np.argsort(at, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(at[order])) + 1) if len(order) else []:
            e = self._bucket(lang, int(at[part[0]]))
            if not len(e):
                continue
            ka = _coded(k, a[part])
            rank = _rank(ka, b[part])
            i = np.searchsorted(e["rank"], rank)
            todo = np.arange(len(part))
            while len(todo):  # past other entries of the same rank
                todo = todo[i[todo] < len(e)]
                todo = todo[e["rank"][i[todo]] == rank[todo]]
                here = e[i[todo]]
                same = here["ka"] == ka[todo]
                logp[part[todo[same]]] = here["logp"][same]
                backoff[part[todo[same]]] = here["backoff"][same]
                todo = todo[~same]
                i[todo] += 1
        return logp, backoff

    def log_prob(self, lang: str, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Natural log probability of the last symbol of each n-gram."""
        out, todo = np.zeros(len(a)), np.arange(len(a))
        for k in range(ORDER, -1, -1):
            a, b = a & _mask(k - 3), b & _mask(min(k, 3))
            logp, _ = self.find(lang, k, a, b)
            found = ~np.isnan(logp)
            out[todo[found]] += logp[found]
            todo, a, b = todo[~found], a[~found], b[~found]
            if not len(todo):
                break
            # Not seen: the weight of its context, then one symbol less of it.
            out[todo] += self.find(lang, k - 1, a >> BITS, b >> BITS | (a & _mask(1)) << 2 * BITS)[1]
        return out

    def totals(self, langs: list[str], texts: list[str | None]) -> list[float]:
        """Sum of the log probabilities of each text's characters; NaN where the
        language has no model."""
        out = np.zeros(len(texts))
        for lang in dict.fromkeys(langs):
            if not self.buckets(lang):
                out[[i for i, x in enumerate(langs) if x == lang]] = np.nan
                continue
            rows: list[tuple[int, np.ndarray, np.ndarray]] = []
            size = 0
            mine = [i for i, x in enumerate(langs) if x == lang]
            for i in mine:
                for a, b in text_grams(texts[i] or ""):
                    rows.append((i, a, b))
                    size += len(a)
                    if size > HELD:
                        self._add(lang, rows, out)
                        rows, size = [], 0
            self._add(lang, rows, out)
        return out.tolist()

    def _add(self, lang: str, rows: list, out: np.ndarray) -> None:
        if not rows:
            return
        a, b = np.concatenate([r[1] for r in rows]), np.concatenate([r[2] for r in rows])
        doc = np.repeat(np.array([r[0] for r in rows]), [len(r[1]) for r in rows])
        order = np.argsort(_rank(a, b))
        a, b, doc = a[order], b[order], doc[order]
        new = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]
        value = self.log_prob(lang, a[new], b[new])
        np.add.at(out, doc, value[np.cumsum(new) - 1])


def fit_model(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> str:
    prepare(docs.sparkSession)
    return write_model(model_table(count_grams(docs, text_col, lang_col)))
