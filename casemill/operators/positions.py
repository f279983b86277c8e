"""Positions in a total order without a global window.

An un-partitioned window would put every row into one task. Here the rows are range
partitioned, numbered inside their partition, and shifted by the sizes of the partitions
before; only one row per partition is ever brought together.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut


# what one range partition should hold by the planner's estimate
PARTITION_BYTES = 256 << 20
# an estimate of a join or an explode can be far too high
MAX_PARTITIONS = 100_000


def range_partitions(df: DataFrame, each: int = PARTITION_BYTES, least: int | None = None) -> int:
    """At least the session's number (or ``least``); more where the estimated size asks for it."""
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) if least is None else least
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(usual, min(-(-size // each), MAX_PARTITIONS))


def add_positions(
    df: DataFrame, order: Sequence[str], result: str = "position", weight: str | None = None
) -> DataFrame:
    """M3: ``result`` = rows (or total ``weight``) before this one in the given order, from 0.

    ``order`` must be total: rows that tie on it could not be spread over partitions. The
    numbered rows are cut to the shared folder, so that the partition sizes and the rows they
    shift come from the same run.
    """
    parts = range_partitions(df)
    sort = [F.col(c).asc_nulls_first() for c in order]
    ranged = df.repartitionByRange(parts, *sort).sortWithinPartitions(*sort)
    numbered = cut(ranged.withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright("_id", 33)
    if weight is None:
        step = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
        local = numbered.withColumn("_part", part).withColumn("_before", step)
        sizes = local.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    else:
        earlier = Window.partitionBy("_part").orderBy("_id").rowsBetween(
            Window.unboundedPreceding, -1
        )
        local = numbered.withColumn("_part", part)
        sizes = local.groupBy("_part").agg(F.sum(weight).alias("_size"))
        local = local.withColumn("_before", F.coalesce(F.sum(weight).over(earlier), F.lit(0)))
    # one row per partition: bounded by the number of range partitions
    running = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(running), F.lit(0)).alias("_offset")
    )
    return local.join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.col("_offset") + F.col("_before")).cast("bigint").alias(result)
    )


# up to so many categories a dictionary is broadcast whole
SMALL_DICTIONARY = 1 << 16
# a category with more than this part of the rows is heavy; a column has at most as many of them
HEAVY_PART = 1000
# partitions that the rows of a heavy category are spread over where they need no look-up
SPREAD = 1 << 12


@dataclass(frozen=True)
class Codes:
    """M2: ``table`` has (column_name, value, code, rows); ``sizes`` per column how many categories
    there are and how many rows they have together."""

    table: DataFrame
    sizes: Mapping[str, tuple[int, int]]


def _sizes(table: DataFrame) -> dict[str, tuple[int, int]]:
    """One row per encoded column."""
    found = table.groupBy("column_name").agg(F.count("*").alias("n"), F.sum("rows").alias("total"))
    return {r.column_name: (r.n, r.total) for r in found.collect()}


def counted_codes(df: DataFrame, columns: Sequence[str]) -> Codes:
    """M2: sorted distinct values of each column numbered from 0, and how many rows have them.

    All columns are coded in one pass and must have one type; text and times are coded apart, each
    in its own order. NULL is a category of its own, the last one of its column.
    """
    kinds = {dict(df.dtypes)[c] for c in columns}
    if len(kinds) != 1:
        raise ValueError(f"columns of several types are coded apart: {sorted(kinds)}")
    pairs = F.explode(
        F.array(
            *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")) for c in columns]
        )
    )
    distinct = cut(
        df.select(pairs.alias("p")).groupBy("p.column_name", "p.value").agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("_missing", F.col("value").isNull())
    )
    sizes = _sizes(distinct)
    order = ["column_name", "_missing", "value"]
    if all(n <= SMALL_DICTIONARY for n, _ in sizes.values()):
        # one task per column, which numbers at most SMALL_DICTIONARY values
        of_column = Window.partitionBy("column_name").orderBy("_missing", "value")
        coded = distinct.withColumn("code", F.row_number().over(of_column).cast("bigint") - 1)
    else:
        placed = add_positions(distinct, order)
        starts = placed.groupBy("column_name").agg(F.min("position").alias("_start"))
        placed = placed.join(F.broadcast(starts), "column_name")  # one row per encoded column
        coded = cut(placed.withColumn("code", F.col("position") - F.col("_start")))
    return Codes(coded.select("column_name", "value", "code", "rows"), sizes)


def category_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """M2: (column_name, value, code), see ``counted_codes``."""
    return counted_codes(df, columns).table.drop("rows")


def encode(df: DataFrame, codes: DataFrame, column: str, result: str | None = None) -> DataFrame:
    """M2: put the code of ``column`` into ``result`` (by default in place); NULL has one too.

    ``codes`` as ``category_codes`` makes them; without counts only the missing category is known
    to be heavy."""
    table = codes if "rows" in codes.columns else codes.withColumn("rows", F.lit(0))
    return encode_columns(df, Codes(table, _sizes(table)), {column: result or column})


def encode_columns(df: DataFrame, codes: Codes, columns: Mapping[str, str]) -> DataFrame:
    """M2: put the code of each column into the column it names.

    A small dictionary is broadcast. Of a large one the heavy categories and the missing one are, and
    only rows of light categories are shuffled to theirs, so no category gathers in a task.
    """
    names = list(df.columns)
    for column, result in columns.items():
        categories, total = codes.sizes.get(column, (0, 0))
        book = codes.table.where(F.col("column_name") == column).select(
            F.col("value").alias("_value"), F.col("code").alias("_code"), "rows"
        )
        value = F.col(f"`{column}`")
        small = categories <= SMALL_DICTIONARY
        heavy = F.lit(True) if small else (F.col("rows") * HEAVY_PART > total) | F.col("_value").isNull()
        # at most SMALL_DICTIONARY or HEAVY_PART + 1 rows
        known = F.broadcast(book.where(heavy).drop("rows"))
        df = df.join(known, value.eqNullSafe(F.col("_value")), "left").drop("_value")
        if not small:
            no_salt = (F.col("rows") < 0).cast("int")  # 0, but not as a constant, which would leave the join key
            light = book.where(~heavy).select(F.col("_value").alias("_light"), F.col("_code").alias("_light_code"), no_salt.alias("_of"))
            salt = F.when(F.col("_code").isNull(), 0).otherwise(1 + F.pmod(F.monotonically_increasing_id(), F.lit(SPREAD)).cast("int"))
            df = df.withColumn("_salt", salt)
            df = df.join(light, (value == F.col("_light")) & (F.col("_salt") == F.col("_of")), "left")
            df = df.withColumn("_code", F.coalesce("_code", "_light_code")).drop("_light", "_light_code", "_of", "_salt")
        kept = [F.col("_code").alias(c) if c == result else F.col(f"`{c}`") for c in names]
        names = names if result in names else [*names, result]
        df = df.select(*kept, *([F.col("_code").alias(result)] if len(names) > len(kept) else []))
    return df
