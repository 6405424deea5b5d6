"""Small generic column helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def default_zero(c) -> Column:
    """Missing -> 0.0 (the reference's ``x or 0.0``: NULL and 0 both give 0.0)."""
    return F.coalesce(_c(c), F.lit(0.0))


def one_hot(c, value: str) -> Column:
    """1 when equal, else 0 (NULL -> 0)."""
    return F.coalesce((_c(c) == value).cast("int"), F.lit(0))


def round_half_up(c, digits: int = 2) -> Column:
    """Spark ``round`` (HALF_UP on the decimal text of the double)."""
    return F.round(_c(c), digits)


def abs_error(a, b) -> Column:
    """Absolute difference."""
    return F.abs(_c(a) - _c(b))


def split_pipe(c) -> Column:
    """``a|b|c`` -> array."""
    return F.split(_c(c), r"\|")


def join_pipe(c) -> Column:
    """Array -> ``a|b|c``."""
    return F.array_join(_c(c), "|")


def text_to_bool(c) -> Column:
    """Exactly ``"True"`` is true, anything else false."""
    return F.coalesce(_c(c) == F.lit("True"), F.lit(False))


def rename(df: DataFrame, mapping: dict) -> DataFrame:
    """Rename by map; absent names are ignored."""
    present = {k: v for k, v in mapping.items() if k in df.columns and k != v}
    return df.withColumnsRenamed(present) if present else df


def drop_if_present(df: DataFrame, cols) -> DataFrame:
    """Drop listed columns, ignoring absent ones."""
    return df.drop(*[c for c in cols if c in df.columns])


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    """Names of numeric columns (driver-side metadata only)."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def aliased(df: DataFrame, mapping: dict) -> DataFrame:
    """Project with display names, in mapping order."""
    return df.select(*[_c(k).alias(v) for k, v in mapping.items()])
