"""Rule checks and table comparison over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import compare, quality
from .base import query, stand_in, table

# ---- rule checks -------------------------------------------------------------------

RULES = """
SELECT p_partkey, CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE p_type END AS match,
       CASE WHEN p_partkey % 15 = 0 THEN NULL ELSE p_name END AS target,
       CASE p_partkey % 4 WHEN 0 THEN CAST(p_partkey AS STRING) WHEN 1 THEN 'n' || CAST(p_partkey AS STRING)
         WHEN 2 THEN CAST(p_size AS STRING) END AS numero_caso,
       CASE p_partkey % 5 WHEN 0 THEN 'responsable' WHEN 1 THEN 'responsable,usuariofinal' WHEN 2 THEN ''
         WHEN 3 THEN 'responsable,servicio' END AS targets
FROM {part}
"""


@query(
    "q4_rule_violations",
    f"""SELECT p_partkey, problem FROM (SELECT p_partkey, CASE WHEN match IS NULL THEN 'missing match'
        WHEN target IS NULL THEN 'missing target' END AS problem FROM ({RULES}) r) x WHERE problem IS NOT NULL""",
)
def _(spark, sf):
    found = quality.rule_violations(stand_in(spark, sf, RULES), ["match", "target"])
    return found.select("p_partkey", "problem")


@query(
    "q4_case_number_violations",
    f"""SELECT p_partkey, CASE WHEN numero_caso IS NULL THEN 'missing numero_caso' ELSE 'numero_caso is not a whole number' END AS problem
        FROM ({RULES}) r WHERE try_cast(numero_caso AS BIGINT) IS NULL""",
)
def _(spark, sf):
    return quality.case_number_violations(stand_in(spark, sf, RULES)).select("p_partkey", "problem")


@query(
    "q4_target_violations",
    f"""SELECT p_partkey, CASE WHEN targets IS NULL OR targets = '' THEN 'empty target list' ELSE 'unknown target servicio' END AS problem
        FROM ({RULES}) r WHERE targets IS NULL OR targets = '' OR contains(targets, 'servicio')""",
)
def _(spark, sf):
    lists = stand_in(spark, sf, RULES).withColumn(
        "aplica_a", F.filter(F.split("targets", ","), lambda x: x != "")
    )
    return quality.target_violations(lists).select("p_partkey", "problem")


@query(
    "q4_pending_rules",
    "SELECT p_partkey, p_type FROM {part} WHERE p_size > 40",
)
def _(spark, sf):
    flagged = table(spark, sf, "part").withColumn("validacion_pendiente", F.col("p_size") > 40)
    return quality.pending_rules(flagged).select("p_partkey", "p_type")


# ---- two versions of a table ---------------------------------------------------------

LEFT = """
SELECT o_orderstatus AS origen_caso, o_orderkey AS numero_caso, o_orderpriority AS prioridad,
       o_totalprice AS importe, o_orderdate AS fecha,
       CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE 'Owner ' || CAST(o_custkey % 97 AS STRING) END AS responsable
FROM {orders}
"""
# some values shifted (inside and outside the tolerance), in other case, missing, or replaced
RIGHT = f"""
SELECT origen_caso, numero_caso,
       CASE WHEN numero_caso % 17 = 0 THEN 'changed' ELSE prioridad END AS prioridad,
       CASE WHEN numero_caso % 7 = 0 THEN importe + 25 WHEN numero_caso % 5 = 0 THEN importe + 0.0005
         WHEN numero_caso % 23 = 0 THEN NULL ELSE importe END AS importe,
       CASE WHEN numero_caso % 19 = 0 THEN fecha + INTERVAL '1' DAY ELSE fecha END AS fecha,
       CASE WHEN numero_caso % 11 = 0 THEN upper(responsable) WHEN numero_caso % 13 = 0 THEN NULL
         WHEN numero_caso % 31 = 0 THEN 'Somebody' ELSE responsable END AS responsable
FROM ({LEFT}) l
"""
FAMILIES = {
    "origen_caso": "text", "numero_caso": "number", "prioridad": "text", "importe": "number",
    "fecha": "date", "responsable": "text",
}
# without the case number rows repeat, so the same row has many copies under one key
LEFT_COPIES = f"SELECT origen_caso, prioridad, responsable FROM ({LEFT}) a"
RIGHT_COPIES = f"SELECT origen_caso, prioridad, responsable FROM ({RIGHT}) b"
COPY_FAMILIES = {"origen_caso": "text", "prioridad": "text", "responsable": "text"}


def sql_pairs(left: str, right: str, keys: list[str], columns) -> str:
    """Identical rows cancel out, the rest is paired in column order under each key."""
    rest = [c for c in columns if c not in keys]
    order = ", ".join(f"{c} NULLS FIRST" for c in rest)
    numbered = f"row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {order}) AS rn"
    cells = ", ".join(f"a.{c} AS l_{c}, b.{c} AS r_{c}" for c in columns)
    on = " AND ".join(f"a.{k} = b.{k}" for k in keys)
    return f"""SELECT {cells} FROM
      (SELECT *, {numbered} FROM (({left}) EXCEPT ALL ({right})) x) a FULL JOIN
      (SELECT *, {numbered} FROM (({right}) EXCEPT ALL ({left})) y) b ON {on} AND a.rn = b.rn"""


def sql_divergences(pairs: str, families: dict[str, str], ignore_case: bool = False) -> str:
    parts = []
    for c, family in families.items():
        l, r = f"l_{c}", f"r_{c}"
        if family == "number":
            differ = f"abs({l} - {r}) > 0.001 + 0.00001 * abs({r})"
        elif family == "text" and ignore_case:
            differ = f"lower({l}) <> lower({r})"
        else:
            differ = f"{l} <> {r}"
        case = f"WHEN lower({l}) = lower({r}) THEN 'case_difference'" if family == "text" else ""
        parts.append(
            f"""SELECT '{c}' AS column_name, coalesce(CAST({l} AS VARCHAR), '<NaN>') AS left_value,
            coalesce(CAST({r} AS VARCHAR), '<NaN>') AS right_value,
            CASE WHEN {l} IS NULL OR {r} IS NULL THEN 'null_mismatch' {case} ELSE 'value_mismatch' END AS class,
            count(*) AS n FROM ({pairs}) p
            WHERE (({l} IS NULL) <> ({r} IS NULL)) OR ({differ}) GROUP BY ALL"""
        )
    return " UNION ALL ".join(parts)


KEYS = ["origen_caso", "numero_caso"]
PAIRS = sql_pairs(LEFT, RIGHT, KEYS, FAMILIES)
DIVERGENCES = sql_divergences(PAIRS, FAMILIES)
COPY_PAIRS = sql_pairs(LEFT_COPIES, RIGHT_COPIES, ["origen_caso"], COPY_FAMILIES)
COPY_DIVERGENCES = sql_divergences(COPY_PAIRS, COPY_FAMILIES)


def _sides(spark, sf):
    return stand_in(spark, sf, LEFT), stand_in(spark, sf, RIGHT)


def _copies(spark, sf):
    return stand_in(spark, sf, LEFT_COPIES), stand_in(spark, sf, RIGHT_COPIES)


ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
SOME_PRICES = "SELECT * FROM {orders} WHERE o_totalprice > 150000"


def sql_cells(columns, source):
    return " UNION ALL ".join(f"SELECT '{name}' AS column_name, count({c}) AS cells FROM {source}" for c, name in columns)


@query(
    "q5_so2_structure",
    f"""WITH a AS (SELECT column_name, CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
         ELSE lower(column_type) END AS t FROM (DESCRIBE orders)),
       b AS (SELECT CASE column_name WHEN 'o_orderpriority' THEN 'prioridad' ELSE column_name END AS column_name,
         CASE column_name WHEN 'o_totalprice' THEN 'bigint' ELSE t END AS t FROM a)
       SELECT coalesce(a.column_name, b.column_name) AS column_name, a.t AS left_type, b.t AS right_type,
         a.t IS NOT DISTINCT FROM b.t AS same_type, l.cells AS left_cells, r.cells AS right_cells,
         CASE WHEN b.t IS NULL THEN 'left' WHEN a.t IS NULL THEN 'right' END AS only_in
       FROM a FULL JOIN b ON a.column_name = b.column_name
       LEFT JOIN ({sql_cells([(c, c) for c in ORDER_COLUMNS], '{orders}')}) l ON l.column_name = a.column_name
       LEFT JOIN ({sql_cells([(c, 'prioridad' if c == 'o_orderpriority' else c) for c in ORDER_COLUMNS], f'({SOME_PRICES}) p')}) r
         ON r.column_name = b.column_name""",
)
def _(spark, sf):
    """Types side by side, filled cells of each side, and the columns only one side has."""
    left = table(spark, sf, "orders")
    right = stand_in(spark, sf, SOME_PRICES).withColumnRenamed("o_orderpriority", "prioridad").withColumn(
        "o_totalprice", F.col("o_totalprice").cast("bigint")
    )

    def cells(df, result):
        counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
        each = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias(result)) for c in df.columns]))
        return counts.select(each.alias("c")).select("c.*")

    only_left, only_right = compare.schema_diff(left, right)
    only = F.when(F.col("column_name").isin(only_left), "left").when(F.col("column_name").isin(only_right), "right")
    both = compare.structure(left, right).join(cells(left, "left_cells"), "column_name", "left")
    return both.join(cells(right, "right_cells"), "column_name", "left").withColumn("only_in", only)


@query(
    "q5_row_counts",
    """SELECT (SELECT count(*) FROM {orders}) AS left_rows, (SELECT count(*) FROM {lineitem}) AS right_rows,
       (SELECT count(*) FROM {orders}) = (SELECT count(*) FROM {lineitem}) AS rows_match""",
)
def _(spark, sf):
    return compare.row_counts(table(spark, sf, "orders"), table(spark, sf, "lineitem"))


@query("q6_strip_columns", "SELECT n_nationkey, n_name FROM {nation}")
def _(spark, sf):
    noisy = table(spark, sf, "nation").withColumns({"Unnamed: 0": F.lit(1), "Unnamed: x": F.lit(1)})
    return compare.strip_columns(noisy, ignore=("n_regionkey", "Unnamed: x"))


MISSING_KEYS = f"SELECT * FROM ({LEFT}) l WHERE prioridad <> '5-LOW' UNION ALL SELECT 'X', numero_caso, prioridad, importe, fecha, responsable FROM ({LEFT}) m WHERE prioridad = '1-URGENT'"


@query(
    "q7_key_mismatches",
    f"""WITH a AS (SELECT origen_caso, numero_caso, count(*) AS n FROM ({LEFT}) x GROUP BY 1, 2),
        b AS (SELECT origen_caso, numero_caso, count(*) AS n FROM ({MISSING_KEYS}) y GROUP BY 1, 2),
        d AS (SELECT coalesce(a.n, 0) - coalesce(b.n, 0) AS d FROM a FULL JOIN b USING (origen_caso, numero_caso))
        SELECT CAST(sum(greatest(d, 0)) AS BIGINT) AS only_left, CAST(sum(greatest(-d, 0)) AS BIGINT) AS only_right FROM d""",
)
def _(spark, sf):
    left, right = stand_in(spark, sf, LEFT), stand_in(spark, sf, MISSING_KEYS)
    return compare.key_mismatches(compare.differing_rows(left, right), KEYS)


def _pair_columns(pairs, columns):
    return pairs.select(
        *[F.col(side).getField(c).alias(f"{side}_{c}") for c in columns for side in ("l", "r")], "n"
    )


@query("q7_pair_rows", f"SELECT *, CAST(1 AS BIGINT) AS n FROM ({PAIRS}) p")
def _(spark, sf):
    differing = compare.differing_rows(*_sides(spark, sf))
    return _pair_columns(compare.pair_rows(differing, KEYS), FAMILIES)


@query("q7_pair_copies_under_hot_keys", f"SELECT *, count(*) AS n FROM ({COPY_PAIRS}) p GROUP BY ALL")
def _(spark, sf):
    differing = compare.differing_rows(*_copies(spark, sf))
    pairs = _pair_columns(compare.pair_rows(differing, ["origen_caso"]), COPY_FAMILIES)
    columns = [c for c in pairs.columns if c != "n"]
    return pairs.groupBy(*columns).agg(F.sum("n").alias("n"))


def _divergences(spark, sf, **options):
    left, right = _sides(spark, sf)
    pairs = compare.pair_rows(compare.differing_rows(left, right), KEYS)
    return compare.divergences(pairs, left, right, **options)


@query("q8_q9_cell_divergences", DIVERGENCES)
def _(spark, sf):
    return _divergences(spark, sf)


@query("q8_cell_divergences_without_case", sql_divergences(PAIRS, FAMILIES, ignore_case=True))
def _(spark, sf):
    return _divergences(spark, sf, ignore_case=True)


SUMMARY = f"""WITH d AS ({DIVERGENCES}),
  by_class AS (SELECT column_name, class, sum(n) AS n, count(*) AS patterns FROM d GROUP BY 1, 2)
  SELECT column_name, CAST(sum(n) AS BIGINT) AS total,
    CAST(coalesce(sum(n) FILTER (class = 'null_mismatch'), 0) AS BIGINT) AS null_mismatch,
    CAST(coalesce(sum(n) FILTER (class = 'case_difference'), 0) AS BIGINT) AS case_difference,
    CAST(0 AS BIGINT) AS type_mismatch,
    CAST(coalesce(sum(n) FILTER (class = 'value_mismatch'), 0) AS BIGINT) AS value_mismatch,
    arg_min(class, (-n, class)) AS dominant_class, CAST(sum(patterns) AS BIGINT) AS unique_patterns
  FROM by_class GROUP BY 1"""


@query("q10_column_summary", SUMMARY)
def _(spark, sf):
    return compare.column_summary(_divergences(spark, sf))


@query(
    "q11_top_patterns",
    f"""SELECT column_name, left_value, right_value, class, n, rank FROM (SELECT *, row_number() OVER
        (PARTITION BY column_name ORDER BY n DESC, left_value, right_value, class) AS rank
        FROM ({COPY_DIVERGENCES}) d) r WHERE rank <= 10""",
)
def _(spark, sf):
    left, right = _copies(spark, sf)
    pairs = compare.pair_rows(compare.differing_rows(left, right), ["origen_caso"])
    return compare.top_patterns(compare.divergences(pairs, left, right))


@query(
    "q12_verdict",
    f"""SELECT CAST(sum(n) AS BIGINT) AS differing_cells, 'value_differences' AS verdict, 1 AS exit_code FROM ({DIVERGENCES}) d""",
)
def _(spark, sf):
    return compare.verdict(_divergences(spark, sf))


@query(
    "q13_gate_on_rows",
    """SELECT CAST(0 AS BIGINT) AS differing_cells, CASE WHEN count(*) > 0 THEN 'incompatible' ELSE 'equal' END AS verdict,
       CASE WHEN count(*) > 0 THEN 2 ELSE 0 END AS exit_code FROM {orders} WHERE o_orderstatus = 'F'""",
)
def _(spark, sf):
    left = stand_in(spark, sf, LEFT)
    return compare.compare_tables(left, left.where("origen_caso <> 'F'")).verdict


# a text column against a number: what differs as text is a difference of type
TYPED_LEFT = "SELECT o_orderstatus AS origen_caso, o_orderkey AS numero_caso, CAST(o_custkey AS STRING) AS cliente, o_orderpriority AS prioridad FROM {orders}"
TYPED_RIGHT = """SELECT o_orderstatus AS origen_caso, o_orderkey AS numero_caso, CASE WHEN o_orderkey % 3 = 0 THEN o_custkey + 1
  WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_custkey END AS cliente, CASE WHEN o_orderkey % 5 = 0 THEN lower(o_orderpriority) ELSE o_orderpriority END AS prioridad FROM {orders}"""
TYPED = f"""SELECT 'cliente' AS column_name, a.cliente AS left_value, coalesce(CAST(b.cliente AS VARCHAR), '<NaN>') AS right_value,
    CASE WHEN b.cliente IS NULL THEN 'null_mismatch' ELSE 'type_mismatch' END AS class
    FROM ({TYPED_LEFT}) a JOIN ({TYPED_RIGHT}) b USING (origen_caso, numero_caso) WHERE a.cliente IS DISTINCT FROM CAST(b.cliente AS VARCHAR)
  UNION ALL SELECT 'prioridad', a.prioridad, b.prioridad, 'case_difference'
    FROM ({TYPED_LEFT}) a JOIN ({TYPED_RIGHT}) b USING (origen_caso, numero_caso) WHERE a.prioridad <> b.prioridad"""


def _typed(spark, sf):
    return compare.compare_tables(stand_in(spark, sf, TYPED_LEFT), stand_in(spark, sf, TYPED_RIGHT))


@query("q9_type_mismatch", f"SELECT *, count(*) AS n FROM ({TYPED}) t GROUP BY ALL")
def _(spark, sf):
    return _typed(spark, sf).divergences


@query(
    "q10_summary_with_types",
    f"""SELECT column_name, count(t.class) AS total, count(*) FILTER (class = 'null_mismatch') AS null_mismatch,
        count(*) FILTER (class = 'case_difference') AS case_difference, count(*) FILTER (class = 'type_mismatch') AS type_mismatch,
        count(*) FILTER (class = 'value_mismatch') AS value_mismatch,
        CASE column_name WHEN 'cliente' THEN 'type_mismatch' WHEN 'prioridad' THEN 'case_difference' END AS dominant_class,
        count(DISTINCT left_value || '|' || right_value) AS unique_patterns
        FROM (VALUES ('origen_caso'), ('numero_caso'), ('cliente'), ('prioridad')) c(column_name) LEFT JOIN ({TYPED}) t USING (column_name) GROUP BY 1""",
)
def _(spark, sf):
    return _typed(spark, sf).summary


@query(
    "q11_large_k",
    f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY n DESC, left_value, right_value) AS rank FROM (
        SELECT 'responsable' AS column_name, 'Owner ' || CAST(o_custkey AS VARCHAR) AS left_value, CAST(o_custkey AS VARCHAR) AS right_value,
          'value_mismatch' AS class, count(*) AS n FROM {{orders}} GROUP BY ALL
        UNION ALL SELECT 'fecha', CAST(o_orderkey AS VARCHAR), 'x' || CAST(o_orderkey AS VARCHAR), 'value_mismatch', 1 FROM {{orders}}) d) r WHERE rank <= 1500""",
)
def _(spark, sf):
    left = stand_in(spark, sf, "SELECT 'x' AS origen_caso, o_orderkey AS numero_caso, CAST(o_orderkey AS STRING) AS fecha, 'Owner ' || CAST(o_custkey AS STRING) AS responsable FROM {orders}")
    right = stand_in(spark, sf, "SELECT 'x' AS origen_caso, o_orderkey AS numero_caso, 'x' || CAST(o_orderkey AS STRING) AS fecha, CAST(o_custkey AS STRING) AS responsable FROM {orders}")
    return compare.compare_tables(left, right, max_patterns=1500).patterns


GATE = "SELECT CAST(0 AS BIGINT) AS differing_cells, CASE WHEN {what} THEN 'incompatible' ELSE 'equal' END AS verdict, CASE WHEN {what} THEN 2 ELSE 0 END AS exit_code FROM {{orders}}"


@query("q13_gate_on_keys", GATE.format(what="count(*) FILTER (o_orderkey % 97 = 0) > 0"))
def _(spark, sf):
    left = stand_in(spark, sf, LEFT)
    moved = left.withColumn("numero_caso", F.when(F.col("numero_caso") % 97 == 0, -F.col("numero_caso")).otherwise(F.col("numero_caso")))
    return compare.compare_tables(left, moved).verdict


@query("q13_gate_on_columns", GATE.format(what="count(*) >= 0"))
def _(spark, sf):
    left = stand_in(spark, sf, LEFT)
    return compare.compare_tables(left, left.withColumnRenamed("responsable", "otro")).verdict


@query(
    "e4_comparison",
    f"""SELECT f.column_name, coalesce(total, 0) AS total, coalesce(null_mismatch, 0) AS null_mismatch,
        coalesce(case_difference, 0) AS case_difference, coalesce(type_mismatch, 0) AS type_mismatch,
        coalesce(value_mismatch, 0) AS value_mismatch, dominant_class, coalesce(unique_patterns, 0) AS unique_patterns
        FROM (VALUES {', '.join(f"('{c}')" for c in FAMILIES)}) f(column_name) LEFT JOIN ({SUMMARY}) s USING (column_name)""",
)
def _(spark, sf):
    return compare.compare_tables(*_sides(spark, sf)).summary
