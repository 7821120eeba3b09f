"""Personal data in texts: spans, scores and masking.

Method: regular expressions propose spans, checksum validators confirm them
(Luhn for cards, mod 97 for bank accounts), and words near a span raise its
score. Everything runs as SQL expressions: matches and the gaps between them
come from the same pattern, so a match starts where the lengths so far add up.

The patterns are written so that their cost stays linear in the text: possessive
loops, and a run of characters is entered at its start or where the last match
ended.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters before and after a span in which context words count.
NEAR = 40


@dataclass(frozen=True)
class Kind:
    """A kind of personal data: its pattern (Java), a test of a match, the score
    of a confirmed match, context words and what one of them adds, and the score
    a span needs."""

    name: str
    pattern: str
    confirm: Callable[[Column], Column]
    score: float
    words: tuple[str, ...]
    must: str = ""  # characters that every match has
    bonus: float = 0.3
    needs: float = 0.5


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Luhn checksum of a string of digits."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(
        i % 2 == 0, c.cast("int")).otherwise(
        F.element_at(F.array(*map(F.lit, (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))), c.cast("int") + 1)))
    return F.aggregate(each, F.lit(0), lambda a, b: a + b) % 10 == 0


def mod97(account: Column) -> Column:
    """ISO 7064 check of an account number without spaces: letters stand for 10
    to 35, the first four characters go last, the remainder must be 1."""
    moved = F.concat(F.substr(account, F.lit(5)), F.substr(account, F.lit(1), F.lit(4)))
    return F.aggregate(F.split(moved, ""), F.lit(0), lambda a, c: F.when(
        c <= "9", (a * 10 + F.ascii(c) - 48) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97)) == 1


def _count_between(x: Column, low: int, high: int) -> Column:
    return F.length(_digits(x)).between(low, high)


_OCTET = r"(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9][0-9]?)|0++)"
_MAIL = "[A-Za-z0-9._%+-]"

#: In the order in which spans are listed.
BASE_KINDS = (
    Kind("email", rf"(?:(?<!{_MAIL})|\G){_MAIL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         lambda x: F.lit(True), 0.8, ("mail", "contact", "kontakt", "correo", "courriel"), "@"),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
         lambda x: x.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"), 0.6, ("ip", "server", "host", "login"), "."),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++",
         lambda x: _count_between(x, 16, 19) & luhn(_digits(x)), 0.7,
         ("card", "karte", "carte", "tarjeta", "visa", "mastercard", "amex")),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]",
         lambda x: _count_between(x, 8, 15), 0.7, ("tel", "phone", "call", "fax", "mobil"), "+"),
)
#: Kinds the method adds. A bank account is confirmed by its checksum, a social
#: security number has none and needs a context word.
MORE_KINDS = (
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
         lambda x: mod97(F.replace(x, F.lit(" "), F.lit(""))), 0.8, ("iban", "account", "konto", "compte")),
    Kind("ssn", r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
         lambda x: F.lit(True), 0.3, ("ssn", "social", "security"), "-"),
)


def _scan(numbers: Column, join: Callable[[Column, Column], Column], zero: int) -> Column:
    """Running totals of an array in n log n steps, by doubling: SQL has no scan
    over an array, and appending to one in an aggregate copies it each time."""
    return F.aggregate(F.array(*[F.lit(1 << k) for k in range(31)]), numbers, lambda a, d: F.when(
        d < F.size(a), F.zip_with(a, F.concat(F.array_repeat(F.lit(zero), d), F.slice(
            a, F.lit(1), F.size(a) - d)), join)).otherwise(a))


def _score(kind: Kind, c: Column) -> Column:
    words = rf"\b(?:{'|'.join(kind.words)})"
    near = F.lower(c["before"]).rlike(words) | F.lower(c["after"]).rlike(words)
    return F.least(F.lit(1.0), F.lit(kind.score) + F.when(near, kind.bonus).otherwise(0.0))


def find_pii(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None,
             more: tuple[Kind, ...] = MORE_KINDS, beyond: bool = False) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all by default) as a struct ``doc``, the
    text ``t`` (null: empty), and ``base`` and ``added``, arrays of
    ``struct<kind, start, end, score>`` in the order of the kinds, then start.

    Spans are leftmost non-overlapping matches of one kind that the validator
    confirms, in code points, end exclusive; spans of different kinds may
    overlap. Base spans stay whatever their score, the others must reach their
    kind's. Context words count in the ``NEAR`` characters before a span, as far
    back as the last match of the kind; with ``beyond`` also past that match and
    in the ``NEAR`` characters after the span. Empty and very long texts, repeated rows
    and empty tables need no special care: each row is judged by itself.
    """
    kinds = (*BASE_KINDS, *more)
    names = [k.name for k in kinds]
    empty = F.array().cast("array<string>")
    t = F.col("t")
    df = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias("doc"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    # One step per select: every result is used twice or more, so none is computed again.
    df = df.select("doc", "t", *[F.when(
        t.contains(k.must), F.regexp_extract_all(t, F.lit(k.pattern), F.lit(0))).otherwise(empty).alias(
        f"f_{k.name}") for k in kinds])
    df = df.select("*", *[F.when(F.size(f"f_{k.name}") > 0, F.slice(F.split(
        t, k.pattern, -1), F.lit(1), F.size(f"f_{k.name}"))).otherwise(empty).alias(f"g_{k.name}")
        for k in kinds])
    df = df.select("*", *[_scan(F.zip_with(f"g_{n}", f"f_{n}", lambda g, m: F.length(g) + F.length(m)),
                                lambda a, b: a + b, 0).alias(f"e_{n}") for n in names])
    df = df.select("doc", "t", *[F.zip_with(F.arrays_zip(
        F.col(f"f_{n}").alias("m"), F.col(f"e_{n}").alias("end")), F.col(f"g_{n}"),
        lambda x, g: F.struct((x["end"] - F.length(x["m"])).alias("start"), x["end"].alias("end"),
                              x["m"].alias("m"), F.length(g).alias("g"))).alias(f"c_{n}") for n in names])
    # With ``beyond`` from the text itself, whatever other matches stand there.
    def back(c: Column) -> Column:
        return F.least(c["start"], F.lit(NEAR)) if beyond else F.least(c["g"], F.lit(NEAR))

    df = df.select("doc", "t", *[F.transform(f"c_{n}", lambda c: F.struct(
        c["start"].alias("start"), c["end"].alias("end"), c["m"].alias("m"),
        F.substr("t", c["start"] - back(c) + 1, back(c)).alias("before"),
        F.substr("t", c["end"] + 1, F.lit(NEAR if beyond else 0)).alias("after"))).alias(f"c_{n}") for n in names])

    def spans(kind: Kind, base: bool) -> Column:
        def good(c: Column) -> Column:
            ok = kind.confirm(c["m"])
            return ok if base else ok & (_score(kind, c) >= kind.needs)

        return F.transform(F.filter(f"c_{kind.name}", good), lambda c: F.struct(
            F.lit(kind.name).alias("kind"), c["start"].alias("start"), c["end"].alias("end"),
            _score(kind, c).alias("score")))

    return df.select("doc", "t", F.concat(*[spans(k, True) for k in BASE_KINDS]).alias("base"),
                     F.concat(*[spans(k, False) for k in more]).alias("added") if more else F.array().cast(
                         "array<struct<kind:string,start:int,end:int,score:double>>").alias("added"))


def span_list(spans: Column) -> Column:
    """``kind:start:end`` of the spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def mask_pii(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars",
             more: tuple[Kind, ...] = MORE_KINDS, beyond: bool = False) -> DataFrame:
    """``docs``, all columns, with each span replaced by its kind in brackets
    and ``length_col`` set to the new length. Where spans overlap, their union is
    replaced by the kind that starts first. A null text stays null."""
    df = find_pii(docs, text_col, more=more, beyond=beyond).select("doc", "t", F.array_sort(F.transform(
        F.concat("base", "added"), lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))).alias("s"))
    df = df.select("doc", "t", "s", _scan(
        F.transform("s", lambda s: s["end"]), lambda a, b: F.greatest(a, b), 0).alias("upto"))
    before = F.concat(F.array(F.lit(0)), F.slice("upto", F.lit(1), F.size("s") - 1))
    parts = F.zip_with("s", before, lambda s, b: F.when(s["start"] >= b, F.concat(
        F.substr("t", b + 1, s["start"] - b), F.lit("["), F.upper(s["kind"]), F.lit("]"))).otherwise(F.lit("")))
    masked = F.when(F.col(f"doc.`{text_col}`").isNull(), F.lit(None)).when(
        F.size("s") == 0, F.col("t")).otherwise(F.concat(
            F.array_join(parts, ""), F.substr("t", F.element_at("upto", -1) + 1)))
    df = df.select("doc", masked.alias("t2"))
    return df.select(*[
        F.col("t2").alias(c) if c == text_col
        else F.when(F.col("t2").isNull(), F.col(f"doc.`{c}`")).otherwise(F.length("t2")).cast(
            dict(docs.dtypes)[c]).alias(c) if c == length_col
        else F.col(f"doc.`{c}`") for c in docs.columns])
