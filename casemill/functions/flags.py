"""Service-level and state flags."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import contains_text

# The flag vocabulary.
YES, NO = "SI", "NO"
WORDS = {"Cumple": "SI", "No cumple": "NO"}
OPEN, CLOSED = "Abierto", "Cerrado"


def sla_word(c: Column, invert: bool = False) -> Column:
    """B1: spelled-out values to SI/NO; with ``invert`` the two are swapped in the same step."""
    yes, no = (NO, YES) if invert else (YES, NO)
    return (
        F.when(c.isin("Cumple", YES), yes).when(c.isin("No cumple", NO), no).otherwise(c)
    )


def normalize_sla(df: DataFrame, column: str = "CUMPLE_ANS", invert: bool = False) -> DataFrame:
    """B1 on a table; a table without the column is returned as it is."""
    if column not in df.columns:
        return df
    return df.withColumn(column, sla_word(F.col(column), invert))


def _require(df: DataFrame, column: str) -> None:
    if column not in df.columns:
        raise ValueError(f"column {column!r} not found; present: {df.columns}")


def in_time(slack: Column) -> Column:
    """B2: SI while there is slack left; 0 and NULL are NO."""
    return F.when(slack > 0, YES).otherwise(NO)


def add_in_time(
    df: DataFrame, column: str = "tiempoTranscurridoAtencion", result: str = "CUMPLE_ANS_ATENCION"
) -> DataFrame:
    _require(df, column)
    return df.withColumn(result, in_time(F.col(column)))


def ahead_of_estimate(overrun: Column) -> Column:
    """SI when real minus estimate is negative; NULL is NO."""
    return F.when(overrun < 0, YES).otherwise(NO)


def add_ahead_of_estimate(df: DataFrame, column: str, result: str = "CUMPLE_ANS") -> DataFrame:
    _require(df, column)
    return df.withColumn(result, ahead_of_estimate(F.col(column)))


def always(value: str = YES) -> Column:
    """The same flag for every row."""
    return F.lit(value)


def open_or_closed(solved: Column) -> Column:
    """Open while there is no solution date."""
    return F.when(solved.isNull(), OPEN).otherwise(CLOSED)


def fill_defaults(df: DataFrame, defaults: Mapping[str, str]) -> DataFrame:
    """Fill NULLs column by column; absent columns are ignored."""
    present = {k: v for k, v in defaults.items() if k in df.columns}
    return df.fillna(present) if present else df


def fill_by_category(c: Column, category: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Fill NULLs with the value of the first rule whose text the category contains."""
    return F.coalesce(
        c, *[F.when(contains_text(category, piece), F.lit(value)) for piece, value in rules]
    )
