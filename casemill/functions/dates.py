"""Date and duration expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The export formats in the order they are tried; the first hit wins. Formats that
# cannot be mistaken for each other share a pattern as optional parts, which saves attempts.
# Besides, "yyyy-M-d H:m:s" is read by a plain cast.
DATE_FORMATS = (
    "[M/d/yyyy h:m:s a][M/d/yyyy H:m:s]",
    "d/M/yyyy H:m:s",
)
# what every value of these formats looks like; keeps others away from parser exceptions
_SLASHED = r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{1,2}:\d{1,2}( [AaPp][Mm])?$"
_ISO = r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$"


def parse_date(c: Column, formats: Sequence[str] | None = None) -> Column:
    """First format that parses, else NULL, as TIMESTAMP_NTZ.

    ``formats`` replaces the export formats by others, tried one after the other.
    """
    tries = F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats or DATE_FORMATS])
    if formats:
        return tries.cast("timestamp_ntz")
    slashed = F.when(F.rlike(c, F.lit(_SLASHED)), tries).cast("timestamp_ntz")
    return F.when(F.rlike(c, F.lit(_ISO)), c.try_cast("timestamp_ntz")).otherwise(slashed)


def is_unparsed(raw: Column, parsed: Column) -> Column:
    """A value was there and no format took it."""
    return raw.isNotNull() & parsed.isNull()


def _require_dates(df: DataFrame, *columns: str) -> None:
    types = dict(df.dtypes)
    for name in columns:
        if name not in types:
            raise ValueError(f"column {name!r} not found; present: {df.columns}")
        if types[name] not in ("timestamp", "timestamp_ntz", "date"):
            raise ValueError(f"column {name!r} must be a date, it is {types[name]}; parse it first")


def add_date_parts(df: DataFrame, column: str) -> DataFrame:
    """Year, month and day of a date column."""
    _require_dates(df, column)
    return df.withColumns(
        {
            f"{column}_anio": F.year(column),
            f"{column}_mes": F.month(column),
            f"{column}_dia": F.dayofmonth(column),
        }
    )


def add_creation_features(df: DataFrame, column: str = "fecha_creacion") -> DataFrame:
    """D3: weekday (Monday is 0), month, day and year of creation."""
    _require_dates(df, column)
    return df.withColumns(
        {
            "diasemana_creacion": F.weekday(column),
            "mes_creacion": F.month(column),
            "dia_creacion": F.dayofmonth(column),
            "año_creacion": F.year(column),
        }
    )


def midnight(c: Column) -> Column:
    """The same day at 00:00."""
    return F.to_date(c).cast("timestamp_ntz")


def minutes_between(start: Column, end: Column) -> Column:
    """``end - start`` in minutes with the fraction; NULL if either is NULL."""
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(60e6)


def add_elapsed(df: DataFrame, start: str, end: str, result: str = "tiempoTranscurrido") -> DataFrame:
    """Elapsed minutes as a column."""
    _require_dates(df, start, end)
    return df.withColumn(result, minutes_between(F.col(start), F.col(end)))


def add_slack(
    df: DataFrame, due: str, actual: str, result: str = "tiempoTranscurridoAtencion"
) -> DataFrame:
    """Minutes left to the target; negative when it was missed."""
    _require_dates(df, due, actual)
    return df.withColumn(result, minutes_between(F.col(actual), F.col(due)))


def add_day_number(df: DataFrame, column: str = "fecha_creacion", result: str = "fecha") -> DataFrame:
    """Days since the first day of the table, starting at 1."""
    first = df.agg(F.min(column)).scalar()
    return df.withColumn(result, F.date_diff(F.col(column), first) + 1)
