"""Row filters and masks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import contains_text


def require_values(df: DataFrame, *columns: str) -> DataFrame:
    """drop rows with a NULL in any of the columns."""
    return df.dropna(subset=list(columns))


def without_marker(df: DataFrame, column: str, marker: str) -> DataFrame:
    """drop rows whose text holds the marker; NULL stays."""
    return df.where(~contains_text(F.col(column), marker))


def in_period(
    df: DataFrame, column: str, start: str, end: str, end_inclusive_day: bool = False
) -> DataFrame:
    """dates from ``start`` to ``end``, both included.

    ``end`` is midnight, so on a timestamp column the rest of the last day is out unless
    ``end_inclusive_day`` is set.
    """
    c = F.col(column)
    first = F.lit(start).cast("timestamp_ntz")
    last = F.lit(end).cast("timestamp_ntz")
    if end_inclusive_day:
        return df.where((c >= first) & (c < F.date_add(last.cast("date"), 1).cast("timestamp_ntz")))
    return df.where(c.between(first, last))


def equal_to(df: DataFrame, **values: object) -> DataFrame:
    """every column equals its value."""
    for column, value in values.items():
        df = df.where(F.col(column) == F.lit(value))
    return df


def only_where(mask: Column, value: Column, column: str) -> Column:
    """the new value where the mask holds, else what was there."""
    return F.when(mask, value).otherwise(F.col(column))


def other_origin(origin: str, column: str = "origen_caso") -> Column:
    """rows of any other origin; a NULL origin counts as other."""
    return ~F.col(column).eqNullSafe(F.lit(origin))


def first_rows(df: DataFrame, columns: Sequence[str], n: int = 5) -> DataFrame:
    """A few sample values for an error message (bounded by ``n``)."""
    return df.select(*columns).limit(n)
