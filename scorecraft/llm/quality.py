"""Quality rules: counting rules of one text, and n-gram perplexity bands.

Perplexity comes from a modified Kneser-Ney model of whole code points per
language (``language_model``), which grows with the corpus and is read by the
tasks in buckets. A document is rejected when its mean log perplexity lies
outside its language's band, which is set from quantiles over all documents of
the language.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare, written
from .language_model import Reader, fit_model, lang_key

#: Characters worked on at once.
SLICE = 1 << 20

IS_SIGN = np.isin(np.arange(128), [ord(c) for c in "#*$%&|<>"])
IS_SPACE = np.isin(np.arange(128), [32, *range(9, 14)])
STEP = np.array([0x9E3779B97F4A7C15 * (2 * i + 1) & (2**64 - 1) for i in range(1, 6)], np.uint64)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


# ------------------------------------------------------------- counting rules
def rule_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``."""
    text = text or ""
    n_words = word_chars = n_signs = 0
    before = True
    for at in range(0, len(text), SLICE):
        p = code_points(text[at:at + SLICE])
        ascii_, low = p < 128, p & 127
        space = ascii_ & IS_SPACE[low]
        n_words += int((~space & np.r_[before, space[:-1]]).sum())
        word_chars += int((~space).sum())
        n_signs += int((ascii_ & IS_SIGN[low]).sum())
        before = bool(space[-1])
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return n_words, word_chars, n_signs, len(lines) - len(set(lines)), _repeat_words(text)


def _repeat_words(text: str) -> int:
    """Words inside 5-word windows that occur twice or more. Window hashes only
    propose; the words themselves decide."""
    words = text.encode("utf-8", "surrogatepass").split()
    n = len(words) - 4
    if n < 2:
        return 0
    w = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    h = sum((w[i:n + i] * STEP[i] for i in range(1, 5)), w[:n] * STEP[0])
    order = np.argsort(h, kind="stable")
    equal = h[order[1:]] == h[order[:-1]]
    if not equal.any():
        return 0
    maybe = order[np.r_[False, equal] | np.r_[equal, False]]
    seen = Counter(tuple(words[i:i + 5]) for i in maybe.tolist())
    covered = np.zeros(len(words), bool)
    for i in maybe.tolist():
        if seen[tuple(words[i:i + 5])] > 1:
            covered[i:i + 5] = True
    return int(covered.sum())


# -------------------------------------------------------------------- judgement
FEATURES = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, "
            "n_repeat_words long, log_perplexity double")


def _features(folder: str, lang: Column, text: Column) -> Column:
    """Struct of the counting rules' numbers and the mean negative log probability of
    a character (null without characters)."""
    def of(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        reader = Reader(folder)
        for langs, texts in batches:
            totals = reader.totals(langs.tolist(), texts.tolist())
            yield pd.DataFrame([(*rule_counts(t), -total / len(t) if t else None) for t, total in zip(
                texts, totals, strict=True)], columns=[x.split()[0] for x in FEATURES.split(", ")])

    return F.pandas_udf(of, FEATURES)(lang, text)


def judged(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
           width: float = 4.0, settle: float = 1000.0, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all by default) as a struct ``doc`` with the rules' numbers, ``base_failed``,
    ``log_perplexity``, the band ``low``/``high`` of its language, and ``kept``.

    Base rule: fewer than 10 words, or over 20 of 100 words in repeated 5-word
    windows. Band: the language's median log perplexity minus and plus ``width``
    times its distance to the lower and upper quartile (ranks within 1 in 10,000), over
    the documents that pass the base rule, widened by ``sqrt(1 + settle / word_chars)``. A null or empty text has no words and fails. A null
    language is a language of its own. Repeated rows are judged alike; an empty
    table gives an empty result.
    """
    spark = docs.sparkSession
    prepare(spark)
    folder = fit_model(docs, text_col, lang_col)
    scored = written(docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias("doc"),
        lang_key(lang_col).alias("language"),
        _features(folder, lang_key(lang_col), F.col(text_col).cast("string")).alias("q"),
    ).select("doc", "language", "q.*").withColumn("base_failed", F.expr(
        "n_words < 10 OR 100 * n_repeat_words > 20 * n_words")), "quality")
    # Written: a row per language, whose true size decides that it is broadcast. Estimated
    # from the rows behind it, it would have all documents dealt by their language.
    bands = written(scored.filter("not base_failed").groupBy("language").agg(
        F.percentile_approx("log_perplexity", [0.25, 0.5, 0.75], 10000).alias("p")), "bands")
    # The mean over a short text scatters more, so its band is wider.
    reach = f"{float(width)} * sqrt(1 + {float(settle)} / greatest(word_chars, 1))"
    return (
        scored.join(bands, "language", "left")
        .withColumn("low", F.expr(f"p[1] - (p[1] - p[0]) * {reach}"))
        .withColumn("high", F.expr(f"p[1] + (p[2] - p[1]) * {reach}"))
        .withColumn("kept", F.coalesce(
            ~F.col("base_failed") & F.col("log_perplexity").between(F.col("low"), F.col("high")),
            F.lit(False))))


def keep_good(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
              width: float = 4.0, settle: float = 1000.0) -> DataFrame:
    """The rows of ``docs``, all columns, that the rules and the band keep."""
    return judged(docs, text_col, lang_col, width, settle).filter("kept").select("doc.*")
