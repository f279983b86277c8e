"""Lookup joins: many facts, one lookup row per key.

Lookup tables are reduced to one row per key and then joined from the left without a hint:
Spark broadcasts them while their size is under ``spark.sql.autoBroadcastJoinThreshold`` and
falls back to a sort-merge join, with hot keys split at run time, beyond it. Rules the driver
holds can stand in the expression itself while they are few, which keeps a dozen joins out of the
plan; that is a matter of cost only, both ways look a key up by equality of its text.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import normalize_text, trim_lower


# up to here a rule table is a literal map (scanned per row), beyond it a join; rows are the same
INLINE_RULES = 128


def _texts(values: Iterable[str | None]) -> Column:
    """A constant array, handed over as one value instead of one by one."""
    return F.from_json(F.lit(json.dumps(list(values))), "array<string>")


@dataclass(frozen=True)
class RuleTable:
    """A small lookup whose rows the driver holds: unique text keys, one or more text values."""

    key: str
    values: tuple[str, ...]
    rows: Mapping[str, tuple[str | None, ...]]

    def value(self, key: Column, column: str) -> Column:
        """The value for a key, NULL without a hit."""
        if not self.rows:
            return F.lit(None).cast("string")
        at = self.values.index(column)
        mapping = F.map_from_arrays(_texts(self.rows), _texts(r[at] for r in self.rows.values()))
        return F.try_element_at(mapping, key.cast("string"))

    def frame(self, spark: SparkSession) -> DataFrame:
        """The rules as local rows of a size Spark knows."""
        columns = {self.key: pa.array(list(self.rows), pa.string())}
        for at, name in enumerate(self.values):
            columns[name] = pa.array([row[at] for row in self.rows.values()], pa.string())
        return spark.createDataFrame(pa.table(columns))


@dataclass(frozen=True)
class RuleFrame:
    """A rule table kept as a DataFrame with unique text keys, of any size."""

    key: str
    values: tuple[str, ...]
    table: DataFrame

    def frame(self, _: SparkSession) -> DataFrame:
        return self.table


Rules = RuleTable | RuleFrame
Lookup = DataFrame | RuleTable | RuleFrame


def last_wins(df: DataFrame, key: str, order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """One row per key, the last in ``order``; NULL and blank keys are dropped.

    ``max`` over a struct combines before the shuffle, so a key with very many copies costs
    one row per task. The values close the order, which makes it total.
    """
    ranked = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in values if c not in order])
    return (
        df.where(F.col(key).isNotNull() & (F.col(key) != ""))
        .groupBy(key)
        .agg(F.max(ranked).alias("_last"))
        .select(key, *[F.col(f"_last.{c}").alias(c) for c in values])
    )


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """How many rows of a lookup repeat a key that was there before."""
    return df.agg(
        *[(F.count(k) - F.countDistinct(k)).alias(f"dup_{k}") for k in keys]
    )


def look_up(
    facts: DataFrame,
    lookup: Lookup,
    key: Column,
    lookup_on: str,
    columns: Sequence[str],
    spread_by: Sequence[str] = ("numero_caso",),
) -> tuple[DataFrame, list[Column], list[str]]:
    """The values of a lookup with unique keys for every fact, NULL without a hit.

    Returns the facts, the value columns, and the names of helper columns to drop in the end.
    Facts without a key can never match; they get a key of their own kind (0x00 never starts
    a lookup key) spread over many partitions by ``spread_by``, or a shuffle join would send
    them all to one task.
    """
    if isinstance(lookup, RuleTable):
        if len(lookup.rows) <= INLINE_RULES:
            return facts, [lookup.value(key, c) for c in columns], []
    if not isinstance(lookup, DataFrame):
        lookup, key = lookup.frame(facts.sparkSession), key.cast("string")
    n = sum(c.startswith("_key") for c in facts.columns)
    right_key, names = f"_lookup{n}", [f"_value{n}_{c}" for c in columns]
    right = lookup.select(
        F.col(lookup_on).alias(right_key), *[F.col(c).alias(v) for c, v in zip(columns, names)]
    )
    by = [c for c in spread_by if c in facts.columns]
    if by and dict(right.dtypes)[right_key] == "string":
        key = F.coalesce(key, F.concat(F.lit("\x00"), F.xxhash64(*by).cast("string")))
    joined = facts.withColumn(f"_key{n}", key).join(
        right, F.col(f"_key{n}") == F.col(right_key), "left"
    )
    return joined, [F.col(v) for v in names], [f"_key{n}", right_key, *names]


def set_columns(df: DataFrame, values: Mapping[str, Column], helpers: Sequence[str]) -> DataFrame:
    """Set columns, then drop the helper columns of the lookups they came from."""
    out = df.withColumns(dict(values))
    return out.drop(*helpers) if helpers else out


def overwrite(
    facts: DataFrame, lookup: Lookup, key: Column, lookup_on: str, value: str, target: str
) -> DataFrame:
    """The lookup value, also where there is none (NULL)."""
    out, (hit,), helpers = look_up(facts, lookup, key, lookup_on, [value])
    return set_columns(out, {target: hit}, helpers)


def replace_if_found(
    facts: DataFrame,
    lookup: Lookup,
    key: Column,
    lookup_on: str,
    value: str,
    target: str,
    only: Column | None = None,
) -> DataFrame:
    """The lookup value where there is one (and ``only`` holds), else as before."""
    if target not in facts.columns:
        return facts
    if only is not None:
        key = F.when(only, key)
    out, (hit,), helpers = look_up(facts, lookup, key, lookup_on, [value])
    return set_columns(out, {target: F.coalesce(hit, target)}, helpers)


def fill_if_null(
    facts: DataFrame, lookup: Lookup, key: Column, lookup_on: str, value: str, target: str
) -> DataFrame:
    """The lookup value only where the target is NULL; rows with a value skip the lookup."""
    if target not in facts.columns:
        return facts
    key = F.when(F.col(target).isNull(), key)
    out, (hit,), helpers = look_up(facts, lookup, key, lookup_on, [value])
    return set_columns(out, {target: F.coalesce(target, hit)}, helpers)


def remap_by_rules(
    facts: DataFrame,
    rules: Lookup,
    column: str = "servicio",
    target: str | None = None,
    rule_key: str = "from",
    rule_value: str = "to",
) -> DataFrame:
    """Exact, case-sensitive, single pass; without a hit or a column nothing changes."""
    target = target or column
    if column not in facts.columns or target not in facts.columns:
        return facts
    return replace_if_found(facts, rules, F.col(column), rule_key, rule_value, target)


def _dictionary(df: DataFrame, username: str, name: str) -> DataFrame:
    """One row per user name as written: where it first stood and its last name."""
    # ``_row`` is any value that orders the rows
    rows = df if "_row" in df.columns else df.withColumn("_row", F.lit(0))
    return (
        rows.where(F.col(username).isNotNull())
        .groupBy(F.col(username).alias("username"))
        .agg(
            F.min("_row").alias("first"),
            F.max(F.struct("_row", F.col(name).alias("name"))).getField("name").alias("name"),
        )
    )


def forward_dictionary(df: DataFrame, username: str, name: str) -> DataFrame:
    """Normalised user name -> name.

    The last row of a user name counts; of two spellings that normalise to one, the spelling
    that came up later. ``_row`` is the row order; without it the greatest value counts.
    """
    named = _dictionary(df, username, name).where(F.col("name").isNotNull())
    keyed = named.select(
        normalize_text(F.col("username")).alias("key"), F.col("name").alias("value"), "first"
    )
    return last_wins(keyed, "key", ["first"], ["value"])


def inverse_dictionary(
    df: DataFrame, username: str, name: str, strip_accents: bool = False
) -> DataFrame:
    """Name -> user name, both trimmed and in lower case.

    Accents stay unless ``strip_accents``: a consumer that has lost them will not find an
    accented name.
    """
    clean = normalize_text if strip_accents else trim_lower
    keyed = _dictionary(df, username, name).select(
        clean(F.col("name")).alias("key"), trim_lower(F.col("username")).alias("value"), "first"
    )
    return last_wins(keyed, "key", ["first"], ["value"])
