"""Registered queries: a Spark function over a folder of tables and, where SQL can say the same,
the SQL text."""

from __future__ import annotations

import re
from collections.abc import Callable
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

from ..session import prepare

Run = Callable[[SparkSession, str], DataFrame]

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

_QUERIES: dict[str, Run] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` may name tables in braces like the stand-ins do."""

    def add(fn: Run) -> Run:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)

        if name in _QUERIES:
            raise ValueError(f"{name} is registered twice")
        _QUERIES[name] = run
        if sql is not None:
            _SQL[name] = plain_sql(sql)
        return fn

    return add


_read: WeakKeyDictionary[SparkSession, dict[str, DataFrame]] = WeakKeyDictionary()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. They never change, so a session looks at a table's files once."""
    path, known = f"{sf_dir}/{name}.parquet", _read.setdefault(spark, {})
    if path not in known:
        known[path] = spark.read.parquet(path)
    return known[path]


def tables_in(text: str) -> list[str]:
    return sorted(set(re.findall(r"\{(\w+)\}", text)))


def stand_in(spark: SparkSession, sf_dir: str, text: str, parts: int | None = None) -> DataFrame:
    """Rows derived from the given tables by SQL both engines read the same way; with ``parts`` the
    tables' own rows are dealt out to as many tasks, before they are made longer."""
    read = {t: table(spark, sf_dir, t) for t in tables_in(text)}
    return spark.sql(text, **(read if parts is None else {t: df.repartition(parts) for t, df in read.items()}))


def plain_sql(text: str) -> str:
    """The same text with bare table names."""
    for name in tables_in(text):
        text = text.replace("{" + name + "}", name)
    return text


def all_queries() -> dict[str, Run]:
    return dict(_QUERIES)


def all_sql() -> dict[str, str]:
    return dict(_SQL)
