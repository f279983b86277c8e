"""Counts, run metrics and source profiles."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import only_digits, strip
from .shape import concat

# The grouping of the daily volume table.
DAY_KEYS = (
    "fecha_creacion", "año_creacion", "mes_creacion", "dia_creacion", "diasemana_creacion",
)


def daily_counts(df: DataFrame) -> DataFrame:
    """A1: cases per day; rows without a creation date vanish."""
    days = df.withColumn("fecha_creacion", F.to_date("fecha_creacion"))
    counted = days.dropna(subset=list(DAY_KEYS)).groupBy(*DAY_KEYS).agg(
        F.count(F.lit(1)).alias("cantidadCasos")
    )
    return counted.withColumn("fecha_creacion", F.col("fecha_creacion").cast("timestamp_ntz"))


def rows_by(df: DataFrame, column: str = "origen_caso") -> DataFrame:
    """A2: rows per value; NULL is not counted."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))


def distinct_values(df: DataFrame, column: str = "servicio") -> DataFrame:
    """A3: number of distinct values, NULL excluded. The values are combined first, so a value
    with many rows costs one row per task."""
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    return values.agg(F.count(F.lit(1)).alias(f"distinct_{column}"))


def row_totals(frames: Mapping[str, DataFrame]) -> DataFrame:
    """A4, Q3: rows per table; ``empty`` marks tables to warn about."""
    return concat(
        [
            df.agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(name).alias("source"), "rows", (F.col("rows") == 0).alias("empty")
            )
            for name, df in frames.items()
        ]
    )


def id_outcomes(resolved: DataFrame, outcome: str) -> DataFrame:
    """A5: candidates and where they were found, from the outcome column of ``resolve_ids``."""
    state = F.col(outcome)
    hits = lambda value: F.count(F.when(state == value, 1)).alias(f"from_{value}")
    return resolved.agg(
        F.count(state).alias("candidates"),
        hits("master"),
        hits("directory"),
        F.count(F.when(state == "unresolved", 1)).alias("unresolved"),
    )


def names_filled(before: DataFrame, after: DataFrame, *columns: str) -> DataFrame:
    """A5: names filled per column, as the drop in NULLs; rows must be the same on both sides."""
    nulls = lambda df: df.agg(
        *[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in columns]
    )
    left = nulls(after)
    missing_before = {c: nulls(before).select(c).scalar() for c in columns}
    return left.select(*[(missing_before[c] - F.col(c)).alias(f"{c}_filled") for c in columns])


def unresolved_rows(df: DataFrame, column: str = "username_ufinal") -> DataFrame:
    """Rows that still carry an id instead of a user name."""
    return df.agg(F.count(F.when(only_digits(F.col(column)), 1)).alias("unresolved_rows"))


def first_day(df: DataFrame, column: str = "fecha_creacion") -> DataFrame:
    """The first date."""
    return df.agg(F.min(column).alias("first_day"))


def volumetry(frames: Mapping[str, DataFrame], column: str = "username_ufinal") -> DataFrame:
    """Rows, columns and distinct ids per source; without the column there are no ids."""
    parts = []
    for name, df in frames.items():
        if column in df.columns:
            value = F.col(column).cast("string")
            ids = F.when(only_digits(value), strip(value))
        else:
            ids = F.lit(None).cast("string")
        counted = df.groupBy(ids.alias("_id")).agg(F.count(F.lit(1)).alias("_n"))
        parts.append(
            counted.agg(
                F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), F.count("_id").alias("distinct_ids")
            ).select(
                F.lit(name).alias("source"), "rows", F.lit(len(df.columns)).alias("columns"),
                "distinct_ids",
            )
        )
    return concat(parts)


def distinct_ids(df: DataFrame, column: str) -> DataFrame:
    """The distinct digit-only values of a column."""
    value = F.col(column).cast("string")
    return df.where(only_digits(value)).select(strip(value).alias("id")).distinct()


def ids_in_both(tickets: DataFrame, master: DataFrame) -> DataFrame:
    """SO1: ids of the tickets the master knows."""
    return tickets.join(master, "id", "left_semi")


def ids_only_left(tickets: DataFrame, master: DataFrame) -> DataFrame:
    """SO1: ids of the tickets the master does not know."""
    return tickets.join(master, "id", "left_anti")


def id_coverage(tickets: DataFrame, master: DataFrame) -> DataFrame:
    """SO1: how many distinct ticket ids the master resolves; both sides are distinct ids."""
    known = master.select("id", F.lit(1).alias("_known"))
    counts = tickets.join(known, "id", "left").agg(
        F.count(F.lit(1)).alias("ids"), F.count("_known").alias("in_master")
    )
    share = F.when(F.col("ids") > 0, F.col("in_master") * 100.0 / F.col("ids")).otherwise(0.0)
    return counts.select(
        "ids", "in_master", (F.col("ids") - F.col("in_master")).alias("only_tickets"),
        share.alias("coverage_pct"),
    )
