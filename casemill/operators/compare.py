"""Cell-by-cell comparison of two versions of a table.

Identical rows cancel out first (one aggregation over both sides, combined before the
shuffle), so only rows that differ go on. What is left is paired by position in the order of
the keys and then the remaining columns. Rows with the same content travel as one row with a
weight, and pairing works on blocks of positions: neither a hot key nor a great many copies of
one row end up in one task.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut
from .positions import add_positions, range_partitions

# Tolerance, number of patterns kept, and the text shown for a missing value.
ATOL, RTOL = 1e-3, 1e-5
MAX_PATTERNS = 10
MISSING = "<NaN>"
BLOCK = 4096

CLASSES = ("null_mismatch", "case_difference", "type_mismatch", "value_mismatch")
DIVERGENCE_SCHEMA = "column_name string, left_value string, right_value string, class string, n bigint"


# ---- structure ---------------------------------------------------------------


def strip_columns(df: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """Q6: drop index-like columns and the ignore list."""
    return df.drop(*[c for c in df.columns if re.match(r"^Unnamed:\s*\d+$", c) or c in ignore])


def schema_diff(left: DataFrame, right: DataFrame) -> tuple[list[str], list[str]]:
    """SO2: column names only on the left, only on the right."""
    ours, theirs = set(left.columns), set(right.columns)
    return sorted(ours - theirs), sorted(theirs - ours)


def structure(left: DataFrame, right: DataFrame) -> DataFrame:
    """Q5: one row per column of either side, its types and whether they agree."""
    a, b = dict(left.dtypes), dict(right.dtypes)
    names = left.columns + [c for c in right.columns if c not in a]
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(a.get(c)).cast("string").alias("left_type"),
                F.lit(b.get(c)).cast("string").alias("right_type"),
                F.lit(a.get(c) == b.get(c)).alias("same_type"),
            )
            for c in names
        ]
    )
    return left.sparkSession.range(1).select(F.inline(entries))


def row_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """Q5: rows on both sides."""
    counts = left.agg(F.count(F.lit(1)).alias("left_rows"))
    other = right.agg(F.count(F.lit(1)).alias("n")).scalar()
    out = counts.select("left_rows", other.alias("right_rows"))
    return out.withColumn("rows_match", F.col("left_rows") == F.col("right_rows"))


# ---- pairing -----------------------------------------------------------------


def _cell_type(a: str, b: str) -> str:
    """The type both cells of a column are brought to."""
    if a == b:
        return a
    numbers = ("tinyint", "smallint", "int", "bigint", "float", "double")
    if _family(a) == _family(b) == "number":
        both_whole = a in numbers[:4] and b in numbers[:4]
        return "bigint" if both_whole else "double"
    if _family(a) == _family(b) == "date":
        return "timestamp_ntz"
    return "string"


def _family(dtype: str) -> str:
    if dtype in ("tinyint", "smallint", "int", "bigint", "float", "double") or dtype.startswith(
        "decimal"
    ):
        return "number"
    return "date" if dtype in ("timestamp", "timestamp_ntz", "date") else "text"


# rows of more columns than this are compared by hashes first
NARROW = 8


def differing_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows without an identical partner: all columns, ``_side`` (0 left, 1 right), ``_n`` copies.

    Wide rows are compared by 128 bits of hashes, which is all that is shuffled of identical ones;
    whole rows are fetched in a second scan for the hashes that are left. Narrow rows are hardly
    longer than such hashes and are compared themselves. That is a matter of cost only.
    """
    a, b = dict(left.dtypes), dict(right.dtypes)
    types = {c: _cell_type(a[c], b[c]) for c in left.columns}
    columns = [f"`{c}`" for c in left.columns]

    def side(df: DataFrame, which: int) -> DataFrame:
        kinds = b if which else a
        cells = [_comparable(F.col(f"`{c}`"), kinds[c]).cast(t).alias(c) for c, t in types.items()]
        return df.select(*cells, F.lit(which).alias("_side"))

    both = side(left, 0).unionByName(side(right, 1))
    keys = columns
    if len(columns) > NARROW:
        parts = [p for c in columns for p in (F.col(c), F.col(c).isNull())]  # hashes pass over NULL
        both = both.withColumns({"_h1": F.xxhash64(*parts), "_h2": F.xxhash64(F.lit(1), *parts)})
        keys = ["_h1", "_h2"]
    signed = both.select(*keys, F.when(F.col("_side") == 0, 1).otherwise(-1).cast("bigint").alias("_n"))
    kept = signed.groupBy(*keys).agg(F.sum("_n").alias("_n")).where("_n != 0").select(
        *keys, F.when(F.col("_n") > 0, 0).otherwise(1).alias("_side"), F.abs("_n").alias("_n")
    )
    if keys is columns:
        return kept
    return both.join(kept, [*keys, "_side"]).select(*columns, "_side", "_n").distinct()


def _comparable(c: Column, dtype: str) -> Column:
    """NaN as NULL, and one zero."""
    return F.when(~F.isnan(c), c + F.lit(0).cast(dtype)) if dtype in ("float", "double") else c


def key_mismatches(differing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Q7: per side, the rows whose key has no partner on the other side."""
    balance = differing.groupBy(*keys).agg(
        F.sum(F.when(F.col("_side") == 0, F.col("_n")).otherwise(-F.col("_n"))).alias("_d")
    )
    total = lambda sign: F.coalesce(
        F.sum(F.when(F.col("_d") * sign > 0, F.abs("_d"))), F.lit(0)
    ).cast("bigint")
    return balance.agg(total(1).alias("only_left"), total(-1).alias("only_right"))


# what one task pairs by the planner's estimate of the written rows; the windows hold many times as much
PAIRED_BYTES = 8 << 20


def pair_rows(differing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Q7: (l, r, n): the rows at the same place on both sides, and how many such pairs.

    Every key must be there equally often on both sides (see ``key_mismatches``). Each row
    covers a range of positions; ranges are cut at block borders, and inside a block the last
    row that started on either side is the one that covers the position.
    """
    columns = [c for c in differing.columns if c not in ("_side", "_n")]
    rest = [c for c in columns if c not in keys]
    placed = add_positions(differing, ["_side", *keys, *rest], "_start", weight="_n")
    left_end = placed.where("_side = 0").agg(F.max(F.col("_start") + F.col("_n"))).scalar()
    left_total = F.coalesce(left_end, F.lit(0))
    placed = placed.withColumn(
        "_start", F.when(F.col("_side") == 0, F.col("_start")).otherwise(F.col("_start") - left_total)
    )
    last = F.col("_start") + F.col("_n") - 1
    blocks = placed.withColumn(
        "_block",
        F.explode(F.sequence(F.floor(F.col("_start") / BLOCK), F.floor(last / BLOCK))),
    )
    pieces = blocks.select(
        "_block",
        "_side",
        F.greatest("_start", F.col("_block") * BLOCK).alias("_from"),
        F.least(last + 1, (F.col("_block") + 1) * BLOCK).alias("_to"),
        F.struct(*[f"`{c}`" for c in columns]).alias("_row"),
    ).repartition(range_partitions(differing, PAIRED_BYTES), "_block")
    by_block = Window.partitionBy("_block")
    so_far = by_block.orderBy("_from")  # a RANGE frame: rows that start together see each other
    in_turn = by_block.orderBy("_from", "_side")
    on_side = lambda side: F.last(
        F.when(F.col("_side") == side, F.col("_row")), ignorenulls=True
    ).over(so_far)
    until = F.coalesce(F.lead("_from").over(in_turn), F.max("_to").over(by_block))
    return (
        pieces.select(on_side(0).alias("l"), on_side(1).alias("r"), (until - F.col("_from")).alias("n"))
        .where("n > 0")
    )


# ---- cells -------------------------------------------------------------------


def cells_differ(l: Column, r: Column, family: str, atol: float, ignore_case: bool) -> Column:
    """Q8: both missing is equal, one missing differs; numbers within tolerance, dates exact."""
    if family == "number":
        a, b = l.cast("double"), r.cast("double")
        same = (a == b) | (F.abs(a - b) <= F.lit(atol) + F.lit(RTOL) * F.abs(b))
    elif family == "text" and ignore_case:
        same = F.lower(l) == F.lower(r)
    else:
        same = l == r
    return F.when(l.isNull() & r.isNull(), False).when(l.isNull() | r.isNull(), True).otherwise(~same)


def divergence_class(l: Column, r: Column, family: str, same_type: bool) -> Column:
    """Q9: the kind of a differing pair."""
    kind = F.when(l.isNull() | r.isNull(), "null_mismatch")
    if not same_type:
        return kind.otherwise("type_mismatch")
    if family == "text":
        kind = kind.when(F.lower(l) == F.lower(r), "case_difference")
    return kind.otherwise("value_mismatch")


def divergences(
    pairs: DataFrame,
    left: DataFrame,
    right: DataFrame,
    atol: float = ATOL,
    ignore_case: bool = False,
) -> DataFrame:
    """Q8, Q9: (column_name, left_value, right_value, class, n): differing cells by pattern."""
    a, b = dict(left.dtypes), dict(right.dtypes)
    cells = []
    for c in left.columns:
        l, r = F.col("l").getField(c), F.col("r").getField(c)
        family = _family(_cell_type(a[c], b[c]))
        same_type = _family(a[c]) == _family(b[c])
        cell = F.struct(
            F.lit(c).alias("column_name"),
            F.coalesce(l.cast("string"), F.lit(MISSING)).alias("left_value"),
            F.coalesce(r.cast("string"), F.lit(MISSING)).alias("right_value"),
            divergence_class(l, r, family, same_type).alias("class"),
        )
        cells.append(F.when(cells_differ(l, r, family, atol, ignore_case), cell))
    differing = pairs.select("n", F.inline(F.filter(F.array(*cells), lambda x: x.isNotNull())))
    return differing.groupBy("column_name", "left_value", "right_value", "class").agg(
        F.sum("n").alias("n")
    )


def class_totals(divs: DataFrame) -> DataFrame:
    """Per column and class the differing cells and the distinct patterns: all that the summary and
    the verdict need, in one pass over the divergences. At most four rows a column."""
    return divs.groupBy("column_name", "class").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("patterns")
    )


def column_summary(
    divs: DataFrame, columns: Sequence[str] | None = None, totals: DataFrame | None = None
) -> DataFrame:
    """Q10: per column the differing cells, by class, the dominant class, the distinct patterns.

    With ``columns``, those without a difference are listed too. ``totals``: the ``class_totals``
    if they are there already.
    """
    totals = class_totals(divs) if totals is None else totals
    counts = [
        F.coalesce(F.sum(F.when(F.col("class") == c, F.col("n"))), F.lit(0)).alias(c)
        for c in CLASSES
    ]
    # equal counts: the class that comes first in the alphabet
    dominant = F.min(F.struct((-F.col("n")).alias("n"), "class")).getField("class")
    summary = totals.groupBy("column_name").agg(
        F.sum("n").alias("total"),
        *counts,
        dominant.alias("dominant_class"),
        F.sum("patterns").alias("unique_patterns"),
    )
    if columns is None:
        return summary
    # one row per column of the compared tables
    listed = divs.sparkSession.range(1).select(
        F.explode(F.array(*map(F.lit, columns))).alias("column_name")
    )
    return listed.join(F.broadcast(summary), "column_name", "left").fillna(
        0, subset=["total", *CLASSES, "unique_patterns"]
    )


# up to here every task keeps k patterns a column and one task a column ranks what they kept
SMALL_K = 1000


def top_patterns(divs: DataFrame, k: int = MAX_PATTERNS) -> DataFrame:
    """Q11: the ``k`` most frequent patterns of each column; equal counts in value order.

    For a large ``k`` a histogram of the counts gives each column's cut-off; patterns below it
    are out without being ordered, the others are ranked over range partitions.
    """
    by = [F.desc("n"), "left_value", "right_value", "class"]
    if k <= SMALL_K:
        order = Window.partitionBy("column_name").orderBy(*by)
        return divs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    histogram = divs.groupBy("column_name", "n").agg(F.count(F.lit(1)).alias("_patterns"))
    # a column with T differing cells has less than sqrt(2 T) different counts
    higher = Window.partitionBy("column_name").orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)
    reached = histogram.withColumn("_higher", F.coalesce(F.sum("_patterns").over(higher), F.lit(0)))
    least = reached.where(F.col("_higher") < k).groupBy("column_name").agg(F.min("n").alias("_least"))
    chosen = divs.join(F.broadcast(least), "column_name").where("n >= _least").drop("_least")  # one row a column
    ordered = chosen.withColumn("_less", -F.col("n"))
    placed = add_positions(ordered, ["column_name", "_less", "left_value", "right_value", "class"], "_at")
    starts = placed.groupBy("column_name").agg(F.min("_at").alias("_start"))
    ranked = placed.join(F.broadcast(starts), "column_name").withColumn("rank", (F.col("_at") - F.col("_start") + 1).cast("int"))
    return ranked.where(F.col("rank") <= k).select(*divs.columns, "rank")


def verdict(divs: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """Q12: one row: differing cells, the verdict and its exit code (0 equal, 1 differences).

    Pairs that differ in type only count as cells but do not change the verdict.
    """
    totals = class_totals(divs) if totals is None else totals
    total = F.coalesce(F.sum("n"), F.lit(0)).cast("bigint")
    real = F.coalesce(F.sum(F.when(F.col("class") != "type_mismatch", F.col("n"))), F.lit(0)) > 0
    return totals.agg(
        total.alias("differing_cells"),
        F.when(real, "value_differences").otherwise("equal").alias("verdict"),
        F.when(real, 1).otherwise(0).alias("exit_code"),
    )


def incompatible_verdict(spark: SparkSession) -> DataFrame:
    """Q12 when the tables cannot be compared."""
    return spark.range(1).select(
        F.lit(0).cast("bigint").alias("differing_cells"),
        F.lit("incompatible").alias("verdict"),
        F.lit(2).alias("exit_code"),
    )


# ---- all of it ---------------------------------------------------------------


@dataclass(frozen=True)
class Comparison:
    """What a comparison yields; ``divergences`` is empty when the tables do not match up."""

    compatible: bool
    notes: tuple[str, ...]
    left_rows: int
    right_rows: int
    structure: DataFrame
    divergences: DataFrame
    summary: DataFrame
    patterns: DataFrame
    verdict: DataFrame


def compare_tables(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str] = ("origen_caso", "numero_caso"),
    ignore: Sequence[str] = (),
    atol: float = ATOL,
    ignore_case: bool = False,
    max_patterns: int = MAX_PATTERNS,
) -> Comparison:
    """Structure, keys, then cells; values are compared only if the first two agree."""
    spark = left.sparkSession
    left, right = strip_columns(left, ignore), strip_columns(right, ignore)
    only_left, only_right = schema_diff(left, right)
    notes = []
    missing = [k for k in keys if k not in left.columns]
    if only_left or only_right:
        notes.append(f"columns only left {only_left}, only right {only_right}")
    elif missing:
        notes.append(f"key columns missing: {missing}")
    divs = spark.createDataFrame([], DIVERGENCE_SCHEMA)
    totals = class_totals(divs)
    n_left, n_right = left.count(), right.count()
    if n_left != n_right:
        notes.append(f"rows: {n_left} left, {n_right} right")
    if not notes:
        right = right.select(*[f"`{c}`" for c in left.columns])
        differing = cut(differing_rows(left, right))
        unmatched = key_mismatches(differing, keys).first()
        if unmatched.only_left or unmatched.only_right:
            notes.append(
                f"keys {list(keys)}: {unmatched.only_left} rows only left, "
                f"{unmatched.only_right} only right"
            )
        else:
            # patterns and totals both read them: evaluated once
            divs = cut(divergences(pair_rows(differing, keys), left, right, atol, ignore_case))
            totals = cut(class_totals(divs))  # summary and verdict: one pass
    return Comparison(
        compatible=not notes,
        notes=tuple(notes),
        left_rows=n_left,
        right_rows=n_right,
        structure=structure(left, right),
        divergences=divs,
        summary=column_summary(divs, left.columns, totals),
        patterns=top_patterns(divs, max_patterns),
        verdict=verdict(divs, totals) if not notes else incompatible_verdict(spark),
    )
