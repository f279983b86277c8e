"""Checks on inputs, outputs and rule tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import is_unparsed, parse_date
from .filters import first_rows


class SchemaError(ValueError):
    """A table does not have the columns it must have."""


class RuleError(ValueError):
    """A rule table holds entries that cannot be applied."""


def check_fingerprint(df: DataFrame, required: Sequence[str], source: str) -> DataFrame:
    """Q1: all required columns are there (more may be)."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise SchemaError(f"{source}: missing {missing}; present {df.columns}")
    return df


def check_exact(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Q2: exactly these columns; returned in this order."""
    missing = sorted(set(columns) - set(df.columns))
    extra = sorted(set(df.columns) - set(columns))
    if missing or extra:
        raise SchemaError(f"{target}: missing {missing}, extra {extra}")
    return df.select(*[f"`{c}`" for c in columns])


def unparsed_dates(df: DataFrame, column: str) -> DataFrame:
    """How many values no date format takes."""
    raw = F.col(column)
    return df.agg(F.count(F.when(is_unparsed(raw, parse_date(raw)), 1)).alias("unparsed"))


def require_parsed(df: DataFrame, column: str) -> DataFrame:
    """D1 in strict mode: fail with a few samples if a value does not parse."""
    raw = F.col(column)
    bad = first_rows(df.where(is_unparsed(raw, parse_date(raw))), [column]).collect()
    if bad:
        raise ValueError(f"{column}: dates that do not parse, such as {[r[0] for r in bad]}")
    return df


def _blank(c: str) -> Column:
    return F.col(c).isNull()


def rule_violations(rules: DataFrame, required: Sequence[str]) -> DataFrame:
    """Q4: entries with a missing field."""
    problem = F.coalesce(*[F.when(_blank(c), F.lit(f"missing {c}")) for c in required])
    return rules.withColumn("problem", problem).where("problem IS NOT NULL")


def case_number_violations(rules: DataFrame, column: str = "numero_caso") -> DataFrame:
    """Q4: case numbers that are no whole numbers."""
    text = F.col(column).cast("string")
    problem = F.when(text.isNull(), f"missing {column}").when(
        text.try_cast("bigint").isNull(), f"{column} is not a whole number"
    )
    return rules.withColumn("problem", problem).where("problem IS NOT NULL")


def target_violations(
    rules: DataFrame,
    column: str = "aplica_a",
    allowed: Sequence[str] = ("responsable", "usuariofinal"),
) -> DataFrame:
    """Q4: empty target lists and unknown targets."""
    targets = F.col(column)
    unknown = F.array_except(targets, F.array(*map(F.lit, allowed)))
    problem = (
        F.when(targets.isNull() | (F.size(targets) == 0), "empty target list")
        .when(F.size(unknown) > 0, F.concat(F.lit("unknown target "), F.array_join(unknown, ", ")))
    )
    return rules.withColumn("problem", problem).where("problem IS NOT NULL")


def pending_rules(rules: DataFrame, flag: str = "validacion_pendiente") -> DataFrame:
    """Q4: entries still to be confirmed; they are applied all the same."""
    if flag not in rules.columns:
        return rules.limit(0)
    return rules.where(F.coalesce(F.col(flag), F.lit(False)))


def require_no_violations(violations: DataFrame, section: str) -> None:
    """Q4: raise with the first few problems, if there are any."""
    found = violations.limit(5).collect()
    if found:
        raise RuleError(f"{section}: {[r.problem for r in found]}")
