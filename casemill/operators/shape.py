"""Projections, schema alignment and unions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by map; absent names are ignored.

    Where several present columns get the same name, they are merged in map order: the first
    value that is not NULL stays.
    """
    present = {c.lower(): c for c in df.columns}
    sources: dict[str, list[str]] = {}
    for old, new in mapping.items():
        actual = present.get(old.lower())
        if actual is not None and actual not in sources.setdefault(new, []):
            sources[new].append(actual)
    if all(len(olds) == 1 for olds in sources.values()) and not set(sources) & set(df.columns):
        return df.withColumnsRenamed({olds[0]: new for new, olds in sources.items()})
    to_new = {old: new for new, olds in sources.items() for old in olds}
    out, seen = [], set()
    for c in df.columns:
        new = to_new.get(c, c)
        if new in seen:
            continue
        seen.add(new)
        olds = sources.get(new, [c])
        col = F.col(f"`{olds[0]}`") if len(olds) == 1 else F.coalesce(*[F.col(f"`{o}`") for o in olds])
        out.append(col.alias(new))
    return df.select(*out)


def drop_if_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop the listed columns that exist."""
    return df.drop(*columns)


def with_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Constant columns."""
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def column_or(df: DataFrame, column: str, default: object, result: str | None = None) -> DataFrame:
    """The column if it exists, else a constant, under ``result``."""
    result = result or column
    if column in df.columns:
        return df.withColumnRenamed(column, result)
    return df.withColumn(result, F.lit(default))


def extra_columns(df: DataFrame, target: T.StructType) -> list[str]:
    """P5: the columns alignment would drop."""
    wanted = set(target.names)
    return [c for c in df.columns if c not in wanted]


def align(df: DataFrame, target: T.StructType, fill: object = None) -> DataFrame:
    """Exactly the target columns, in its order and types; missing ones get ``fill``,
    or NULL where the fill value is not of the column's type."""
    present = set(df.columns)
    missing = [f for f in target.fields if f.name not in present]
    if fill is not None and missing:
        df = df.withColumns({f.name: F.lit(fill).try_cast(f.dataType) for f in missing})
        present |= {f.name for f in missing}
    return df.selectExpr(
        *[
            f"CAST({f'`{f.name}`' if f.name in present else 'NULL'} AS {f.dataType.simpleString()})"
            f" AS `{f.name}`"
            for f in target.fields
        ]
    )


def align_all(
    frames: Mapping[str, DataFrame], target: T.StructType, fill: object = None
) -> dict[str, DataFrame]:
    """P5 for several tables."""
    return {name: align(df, target, fill) for name, df in frames.items()}


def concat(frames: Sequence[DataFrame]) -> DataFrame:
    """Keep duplicates, union of the columns."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def aligned_concat(
    frames: Mapping[str, DataFrame], target: T.StructType, fill: object = None
) -> DataFrame:
    """Align every table to the target, then concatenate."""
    return concat(list(align_all(frames, target, fill).values()))
