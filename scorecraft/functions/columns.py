"""Column expressions: typed missing tests, buckets, labels, guarded maths,
name matching and token filters. All are built-in expressions (JVM side,
whole-stage codegen); none is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FLOATING = (T.FloatType, T.DoubleType)
NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)


def is_missing(df: DataFrame, name: str) -> Column:
    """NULL, or NaN for float/double, or '' for strings: typed so that ANSI
    mode never sees ``isnan`` on text or ``= ''`` on numbers."""
    dt = df.schema[name].dataType
    c = F.col(name)
    cond = c.isNull()
    if isinstance(dt, _FLOATING):
        cond = cond | F.isnan(c)
    elif isinstance(dt, T.StringType):
        cond = cond | (c == F.lit(""))
    return cond


def buckets(value: Column, edges: Sequence[tuple[float, str]], last: str) -> Column:
    """Multi-way conditional bucket: first ``(upper, label)`` with value < upper,
    else ``last`` (NULL also falls to the last branch, as in the reference)."""
    expr = None
    for upper, label in edges:
        cond = value < F.lit(upper)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(last)) if expr is not None else F.lit(last)


def binary_label(value: Column, positive: Iterable[str]) -> Column:
    """1 when ``value`` is one of ``positive``, else 0 (NULL -> 0)."""
    return F.when(value.isin(list(positive)), F.lit(1)).otherwise(F.lit(0))


def guarded_ratio(num: Column, den: Column) -> Column:
    """num / den with NULL for a zero or NULL denominator (ANSI-safe)."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def safe_log(x: Column) -> Column:
    """Natural log; NULL for x <= 0 instead of an error or -inf."""
    return F.when(x > 0, F.log(x))


def cast_by_type_lists(df: DataFrame, types: Mapping[str, Sequence[str]]) -> DataFrame:
    """Cast columns named in per-type lists with ``try_cast`` (bad text -> NULL)."""
    mapping = {}
    for type_name, cols in types.items():
        for c in cols:
            mapping[c] = F.col(c).try_cast(type_name)
    return df.withColumns(mapping)


def rename_by_mapping(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def rename_index_suffix(df: DataFrame, names: Sequence[str], suffix: str = "_index") -> DataFrame:
    """Drop the originals and rename ``X_index`` back to ``X`` (reference's
    ``RenameColumns``)."""
    return df.drop(*names).withColumnsRenamed({f"{n}{suffix}": n for n in names})


def uppercase_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


def variable_kinds(df: DataFrame, exclude: Sequence[str] = ()) -> list[tuple[str, str]]:
    """(column, kind) with kind 'character' for strings, 'numeric' for numbers,
    'other' for the rest (dates, timestamps, arrays)."""
    out = []
    for f in df.schema.fields:
        if f.name in exclude:
            continue
        if isinstance(f.dataType, T.StringType):
            kind = "character"
        elif isinstance(f.dataType, NUMERIC_TYPES):
            kind = "numeric"
        else:
            kind = "other"
        out.append((f.name, kind))
    return out


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [c for c, k in variable_kinds(df, exclude) if k == "numeric"]


def character_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [c for c, k in variable_kinds(df, exclude) if k == "character"]
