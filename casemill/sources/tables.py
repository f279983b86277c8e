"""Database tables and the tables derived from them."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F


def jdbc_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
    one_task: bool = False,
    **more: str,
) -> dict[str, str]:
    """Reader options; with a numeric or date column and its bounds the table is read in slices.

    Without one the whole table goes through one task, which has to be asked for.
    """
    if partition_column is None and not one_task:
        raise ValueError(f"{table}: name a column to slice by, or set one_task")
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **more}
    if partition_column is not None:
        if bounds is None or partitions < 2:
            raise ValueError("a sliced read needs bounds and at least two partitions")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


# cells of equal width that rows are counted in before they are joined to slices
CELLS = 1000


def slice_predicates(
    ask: Callable[[str], Sequence[Row]], table: str, column: str, partitions: int
) -> list[str]:
    """Conditions on a whole-number column that cut a table into slices of about as many
    rows. Every row meets exactly one of them; NULL belongs to the first.

    ``ask`` runs a query in the database. Two aggregates are asked for: the column's bounds, and the
    rows in at most ``CELLS`` cells between them, so a column with gaps or crowded parts is cut
    where its rows are. What one value holds cannot be cut further.
    """
    low, high, rows = ask(f"SELECT min({column}) AS low, max({column}) AS high, count({column}) AS n FROM {table}")[0]
    if not rows or partitions < 2 or low == high:
        return ["1 = 1"]
    low, high = int(low), int(high)
    width = -(-(high - low + 1) // CELLS)
    cell = f"floor(({column} - {low}) / {width}.0)"
    counted = ask(f"SELECT {cell} AS cell, count(*) AS n FROM {table} WHERE {column} IS NOT NULL GROUP BY {cell}")
    edges, held = [], 0
    for at, n in sorted((int(c), int(n)) for c, n in counted):
        # a cell that would overfill its slice begins the next one
        if held and held + n > rows / partitions:
            edges.append(low + at * width)
            held = 0
        held += n
    if not edges:
        return ["1 = 1"]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(edges, edges[1:])]
    return [f"{column} < {edges[0]} OR {column} IS NULL", *inner, f"{column} >= {edges[-1]}"]


def read_in_slices(
    spark: SparkSession, url: str, table: str, column: str, partitions: int, fetch_size: int = 10_000, **more: str
) -> DataFrame:
    """One table, in slices of a whole-number column that are found in the database."""
    options = {"url": url, **more}

    def ask(query: str) -> Sequence[Row]:
        return spark.read.format("jdbc").options(**options).option("query", query).load().collect()

    found = slice_predicates(ask, table, column, partitions)
    properties = {"fetchsize": str(fetch_size), **more}
    return spark.read.jdbc(url, table, predicates=found, properties=properties)


def read_table(spark: SparkSession, **options) -> DataFrame:
    """One table or view. A stored procedure must be offered as a view."""
    return spark.read.format("jdbc").options(**jdbc_options(**options)).load()


def read_tables(spark: SparkSession, tables: Mapping[str, str], **options) -> dict[str, DataFrame]:
    """Several tables of one database; each schema is fetched here, so a missing table fails
    before any work starts."""
    return {name: read_table(spark, table=table, **options) for name, table in tables.items()}


def employee_master(
    employees: DataFrame,
    positions: DataFrame,
    code: str = "cod_empl",
    first_names: str = "nom_empl",
    last_names: str = "ape_empl",
    mail: str = "box_mail",
) -> DataFrame:
    """Employees that hold a position and have a mail address, once each.

    Only membership in ``positions`` counts, so its codes are made distinct before the join
    and an employee with very many positions costs nothing extra.
    """
    held = positions.select(F.col(code).alias("_code")).distinct()
    return (
        employees.where(F.contains(F.col(mail), F.lit("@")))
        .join(held, F.col(code) == F.col("_code"), "left_semi")
        .select(
            F.concat(F.rtrim(first_names), F.lit(" "), F.rtrim(last_names)).alias("NombreCompleto"),
            F.col(code).cast("string").alias("cedula"),
            F.substring_index(mail, "@", 1).alias("username"),
        )
        .distinct()
    )


def user_master(users: DataFrame, name: str, code: str, username: str) -> DataFrame:
    """The secondary user table under the master's names."""
    return users.select(
        F.col(name).alias("NombreCompleto"),
        F.col(code).cast("string").alias("cedula"),
        F.col(username).alias("username"),
    )
