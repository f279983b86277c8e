"""Sources, sinks, projections, unions, filters and aggregations over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates
from ..functions.text import only_digits
from ..operators import filters, metrics, shape
from ..operators.quality import check_exact
from ..schemas import indicators_schema
from ..session import scratch_path
from ..sources import files, sinks, tables
from .base import query, stand_in, table
from .columns import CASES, CASE_NUMBERS, STRIPPED, sql_date

# ---- sources and sinks: the tables go out in a file format and come back ----------------

REQUEST_TABLE = """
SELECT 'SO-' || CAST(o_orderkey AS STRING) AS numero, o_orderdate AS creada, o_orderstatus AS autor,
       o_orderpriority AS gestor FROM {orders}
"""


@query(
    "s4_request_table",
    f"""SELECT numero AS "Número de solicitud", creada AS "Fecha de creación", autor AS "Autor",
        gestor AS "Usuario que Gestiona" FROM ({REQUEST_TABLE}) r""",
)
def _(spark, sf):
    raw = stand_in(spark, sf, REQUEST_TABLE).select(
        F.col("numero").alias("Número de solicitud"),
        F.col("creada").alias("Fecha de creación"),
        F.col("autor").alias("Autor"),
        F.col("gestor").alias("Usuario que Gestiona"),
    )
    path = sinks.write_interim(raw, scratch_path(spark, "requests"))
    return files.read_requests(spark, path)


EMPLOYEES = """
SELECT c_custkey AS cod_empl, c_name || '  ' AS nom_empl, c_mktsegment || ' ' AS ape_empl,
       CASE WHEN c_custkey % 4 = 0 THEN NULL WHEN c_custkey % 4 = 1 THEN 'no mail'
         ELSE 'u' || CAST(c_custkey AS STRING) || '@mail@x' END AS box_mail
FROM {customer}
"""


@query(
    "s7_employee_master",
    f"""SELECT DISTINCT rtrim(nom_empl) || ' ' || rtrim(ape_empl) AS "NombreCompleto",
        CAST(cod_empl AS VARCHAR) AS cedula, split_part(box_mail, '@', 1) AS username
        FROM ({EMPLOYEES}) e JOIN {{orders}} ON o_custkey = cod_empl WHERE contains(box_mail, '@')""",
)
def _(spark, sf):
    held = table(spark, sf, "orders").select(F.col("o_custkey").alias("cod_empl"))
    return tables.employee_master(stand_in(spark, sf, EMPLOYEES), held)


@query(
    "s8_user_master",
    """SELECT s_name AS "NombreCompleto", CAST(s_suppkey AS VARCHAR) AS cedula, lower(s_name) AS username
       FROM {supplier}""",
)
def _(spark, sf):
    s = table(spark, sf, "supplier").withColumn("login", F.lower("s_name"))
    return tables.user_master(s, "s_name", "s_suppkey", "login")


DATE_COLUMNS = """
SELECT o_orderkey, o_orderdate AS fecha_creacion, CAST(year(o_orderdate) AS STRING) || '-1-2 3:04:05' AS fecha_atencion,
       CASE WHEN o_orderkey % 2 = 0 THEN 'soon' END AS fecha_solucion FROM {orders}
"""


@query(
    "s10_report_read_back",
    f"""SELECT o_orderkey, fecha_creacion, {sql_date('fecha_atencion')} AS fecha_atencion,
        {sql_date('fecha_solucion')} AS fecha_solucion FROM ({DATE_COLUMNS}) d""",
)
def _(spark, sf):
    path = sinks.write_interim(stand_in(spark, sf, DATE_COLUMNS), scratch_path(spark, "report"))
    return files.read_report(spark, path)


@query("s11_k2_interim_table", "SELECT * FROM {orders}")
def _(spark, sf):
    path = sinks.write_interim(table(spark, sf, "orders"), scratch_path(spark, "interim"))
    return files.read_interim(spark, path)


@query(
    "k1_report_table",
    "SELECT o_orderstatus, o_orderkey, o_totalprice FROM {orders}",
)
def _(spark, sf):
    df = table(spark, sf, "orders").select("o_totalprice", "o_orderkey", "o_orderstatus")
    columns = ("o_orderstatus", "o_orderkey", "o_totalprice")
    path = sinks.write_report(df, scratch_path(spark, "report"), columns)
    return files.read_interim(spark, path)


@query(
    "k3_snapshots",
    """SELECT 'orders' AS stage, count(*) AS rows FROM {orders}
       UNION ALL SELECT 'customer', count(*) FROM {customer}""",
)
def _(spark, sf):
    stages = {t: table(spark, sf, t) for t in ("orders", "customer")}
    written = sinks.write_snapshots(stages, scratch_path(spark, "snapshots"), "stage")
    totals = metrics.row_totals({t: files.read_interim(spark, p) for t, p in written.items()})
    return totals.select(F.col("source").alias("stage"), "rows")


# ---- projections --------------------------------------------------------------------


@query(
    "p1_rename",
    """SELECT o_orderkey AS numero_caso, o_custkey, o_orderstatus AS estado, o_totalprice, o_orderdate AS fecha,
       o_orderpriority FROM {orders}""",
)
def _(spark, sf):
    names = {"O_ORDERKEY": "numero_caso", "o_orderstatus": "estado", "o_orderdate": "fecha", "absent": "x"}
    return shape.rename(table(spark, sf, "orders"), names)


TWO_DATES = """
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate END AS d1, CAST('2000-01-01' AS DATE) AS d2 FROM {orders}
"""


@query(
    "p1_rename_merging",
    f"SELECT o_orderkey, coalesce(d1, CAST(d2 AS TIMESTAMP)) AS fecha FROM ({TWO_DATES}) t",
)
def _(spark, sf):
    raw = stand_in(spark, sf, TWO_DATES).withColumn("d2", F.col("d2").cast("timestamp_ntz"))
    return shape.rename(raw, {"d1": "fecha", "d2": "fecha"})


@query("p2_drop_columns", "SELECT o_orderkey, o_custkey, o_orderdate FROM {orders}")
def _(spark, sf):
    return shape.drop_if_present(
        table(spark, sf, "orders"), ["o_orderstatus", "o_totalprice", "o_orderpriority", "absent"]
    )


@query("p3_constants", "SELECT r_regionkey, r_name, 'desk' AS proyecto, '' AS username_ufinal FROM {region}")
def _(spark, sf):
    return shape.with_constants(table(spark, sf, "region"), {"proyecto": "desk", "username_ufinal": ""})


@query(
    "p4_column_or_constant",
    "SELECT n_nationkey, n_regionkey, n_name AS proyecto, 'request' AS tipo_de_caso FROM {nation}",
)
def _(spark, sf):
    df = shape.column_or(table(spark, sf, "nation"), "n_name", "desk", "proyecto")
    return shape.column_or(df, "tipo_de_caso", "request")


def _six_columns():
    return T.StructType(
        [
            T.StructField("numero_caso", T.LongType()),
            T.StructField("responsable", T.StringType()),
            T.StructField("servicio", T.StringType()),
            T.StructField("fecha_creacion", T.TimestampNTZType()),
            T.StructField("tiempoTranscurrido", T.LongType()),
            T.StructField("username_ufinal", T.StringType()),
        ]
    )


ALIGNED_ORDERS = """SELECT o_orderkey AS numero_caso, NULL::VARCHAR AS responsable, o_orderpriority AS servicio,
  o_orderdate AS fecha_creacion, NULL::BIGINT AS "tiempoTranscurrido", CAST(o_custkey AS VARCHAR) AS username_ufinal FROM {orders}"""
ALIGNED_LINES = """SELECT l_orderkey, CAST(l_suppkey AS VARCHAR), l_returnflag, l_shipdate,
  CAST(l_linenumber AS BIGINT), NULL FROM {lineitem}"""
ALIGNED_EVENTS = """SELECT event_id, NULL, event_type, ts, NULL, CAST(user_id AS VARCHAR) FROM {events}"""


def _three_sources(spark, sf):
    orders = shape.rename(
        table(spark, sf, "orders"),
        {"o_orderkey": "numero_caso", "o_orderpriority": "servicio", "o_orderdate": "fecha_creacion",
         "o_custkey": "username_ufinal"},
    )
    lines = shape.rename(
        table(spark, sf, "lineitem"),
        {"l_orderkey": "numero_caso", "l_suppkey": "responsable", "l_returnflag": "servicio",
         "l_shipdate": "fecha_creacion", "l_linenumber": "tiempoTranscurrido"},
    )
    events = shape.rename(
        table(spark, sf, "events"),
        {"event_id": "numero_caso", "event_type": "servicio", "ts": "fecha_creacion", "user_id": "username_ufinal"},
    )
    return {"orders": orders, "lineitem": lines, "events": events}


@query("p5_align_schema", ALIGNED_ORDERS)
def _(spark, sf):
    return shape.align(_three_sources(spark, sf)["orders"], _six_columns())


@query(
    "p6_p7_canonical_projection",
    """SELECT event_id AS numero_caso, event_type AS tipo_de_caso, NULL::VARCHAR AS usuariofinal,
       NULL::VARCHAR AS responsable, event_type AS servicio, ts AS fecha_creacion, ts AS fecha_atencion,
       NULL::TIMESTAMP AS fecha_solucion, NULL::BIGINT AS "tiempoTranscurrido", NULL::VARCHAR AS "CUMPLE_ANS",
       'events' AS origen_caso, NULL::VARCHAR AS proyecto, NULL::VARCHAR AS username_resp,
       CAST(user_id AS VARCHAR) AS username_ufinal FROM {events}""",
)
def _(spark, sf):
    e = table(spark, sf, "events").select(
        F.col("event_id").alias("numero_caso"), F.col("event_type").alias("tipo_de_caso"),
        F.col("event_type").alias("servicio"), F.col("ts").alias("fecha_creacion"),
        F.col("ts").alias("fecha_atencion"), F.lit("events").alias("origen_caso"),
        F.col("user_id").alias("username_ufinal"), "props",
    )
    columns = indicators_schema().names
    return check_exact(shape.align(e, indicators_schema()), columns, "indicators")


@query(
    "u1_concat",
    """SELECT n_name AS name, n_regionkey, NULL::DOUBLE AS balance FROM {nation}
       UNION ALL SELECT s_name, NULL, s_acctbal FROM {supplier}
       UNION ALL SELECT n_name, n_regionkey, NULL FROM {nation}""",
)
def _(spark, sf):
    nation = table(spark, sf, "nation").select(F.col("n_name").alias("name"), "n_regionkey")
    supplier = table(spark, sf, "supplier").select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return shape.concat([nation, supplier, nation])


@query("u2_aligned_concat", f"{ALIGNED_ORDERS} UNION ALL {ALIGNED_LINES} UNION ALL {ALIGNED_EVENTS}")
def _(spark, sf):
    return shape.aligned_concat(_three_sources(spark, sf), _six_columns())


# ---- filters ------------------------------------------------------------------------


@query(
    "f1_require_values",
    f"SELECT l_orderkey, l_linenumber, l_partkey, closed FROM ({CASES}) c WHERE closed IS NOT NULL AND opened IS NOT NULL",
)
def _(spark, sf):
    kept = filters.require_values(stand_in(spark, sf, CASES), "closed", "opened")
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "closed")


@query(
    "f2_without_marker",
    f"SELECT o_orderkey, {STRIPPED} AS raw FROM ({CASE_NUMBERS}) c WHERE NOT coalesce(contains({STRIPPED}, 'RF-COM'), FALSE)",
)
def _(spark, sf):
    from ..functions.text import remove_literal
    from .columns import PREFIXES

    raw = stand_in(spark, sf, CASE_NUMBERS).withColumn("raw", remove_literal(F.col("raw"), *PREFIXES))
    return filters.without_marker(raw, "raw", "RF-COM")


@query(
    "f3_in_period",
    """SELECT event_id, ts FROM {events} WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20'""",
)
def _(spark, sf):
    return filters.in_period(table(spark, sf, "events").select("event_id", "ts"), "ts", "2024-01-05", "2024-01-20")


@query(
    "f3_in_period_whole_last_day",
    """SELECT event_id, ts FROM {events} WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-21'""",
)
def _(spark, sf):
    events = table(spark, sf, "events").select("event_id", "ts")
    return filters.in_period(events, "ts", "2024-01-05", "2024-01-20", end_inclusive_day=True)


@query(
    "f4_equal_to",
    "SELECT o_orderkey FROM {orders} WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'",
)
def _(spark, sf):
    return filters.equal_to(
        table(spark, sf, "orders"), o_orderstatus="F", o_orderpriority="1-URGENT"
    ).select("o_orderkey")


ID_TEXTS = """
SELECT event_id, CASE event_id % 5 WHEN 0 THEN ' ' || CAST(user_id AS STRING) || ' '
  WHEN 1 THEN 'u' || CAST(user_id AS STRING) WHEN 2 THEN '' WHEN 3 THEN CAST(user_id AS STRING) END AS raw
FROM {events}
"""


@query(
    "f5_only_digits",
    f"SELECT event_id, coalesce(regexp_full_match(trim(raw), '[0-9]+'), FALSE) AS is_id FROM ({ID_TEXTS}) t",
)
def _(spark, sf):
    return stand_in(spark, sf, ID_TEXTS).select("event_id", only_digits(F.col("raw")).alias("is_id"))


@query(
    "f6_masked_step",
    """SELECT event_id, CASE WHEN event_type IS DISTINCT FROM 'error' THEN upper(event_type) ELSE event_type END AS event_type
       FROM {events}""",
)
def _(spark, sf):
    mask = filters.other_origin("error", "event_type")
    return table(spark, sf, "events").select(
        "event_id", filters.only_where(mask, F.upper("event_type"), "event_type").alias("event_type")
    )


# ---- aggregations -------------------------------------------------------------------


@query(
    "a1_daily_counts",
    """SELECT CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS fecha_creacion, year(o_orderdate) AS "año_creacion",
       month(o_orderdate) AS mes_creacion, day(o_orderdate) AS dia_creacion, isodow(o_orderdate) - 1 AS diasemana_creacion,
       count(*) AS "cantidadCasos" FROM {orders} WHERE o_orderdate IS NOT NULL GROUP BY ALL""",
)
def _(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderdate").alias("fecha_creacion"))
    return metrics.daily_counts(dates.add_creation_features(o))


@query("a2_rows_by_origin", "SELECT event_type, count(*) AS rows FROM {events} WHERE event_type IS NOT NULL GROUP BY 1")
def _(spark, sf):
    return metrics.rows_by(table(spark, sf, "events"), "event_type")


@query("a3_distinct_values", "SELECT count(DISTINCT p_brand) AS distinct_p_brand FROM {part}")
def _(spark, sf):
    return metrics.distinct_values(table(spark, sf, "part"), "p_brand")


@query(
    "a4_q3_row_totals",
    """SELECT 'orders' AS source, count(*) AS rows, count(*) = 0 AS empty FROM {orders}
       UNION ALL SELECT 'events', count(*), count(*) = 0 FROM {events}
       UNION ALL SELECT 'refunds', count(*), count(*) = 0 FROM {events} WHERE event_type = 'refund'""",
)
def _(spark, sf):
    events = table(spark, sf, "events")
    refunds = events.where("event_type = 'refund'")
    return metrics.row_totals({"orders": table(spark, sf, "orders"), "events": events, "refunds": refunds})


@query(
    "a6_unresolved_rows",
    f"SELECT count(CASE WHEN regexp_full_match(trim(raw), '[0-9]+') THEN 1 END) AS unresolved_rows FROM ({ID_TEXTS}) t",
)
def _(spark, sf):
    return metrics.unresolved_rows(stand_in(spark, sf, ID_TEXTS), "raw")


@query("a8_first_day", "SELECT min(ts) AS first_day FROM {events}")
def _(spark, sf):
    return metrics.first_day(table(spark, sf, "events"), "ts")


@query(
    "a9_volumetry",
    f"""SELECT 'tickets' AS source, count(*) AS rows, 2 AS columns,
        count(DISTINCT CASE WHEN regexp_full_match(trim(raw), '[0-9]+') THEN trim(raw) END) AS distinct_ids FROM ({ID_TEXTS}) t
        UNION ALL SELECT 'nation', count(*), 3, 0 FROM {{nation}}
        UNION ALL SELECT 'lineitem', count(*), 1, count(DISTINCT l_partkey) FROM {{lineitem}}""",
)
def _(spark, sf):
    lines = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("raw"))
    frames = {
        "tickets": stand_in(spark, sf, ID_TEXTS), "nation": table(spark, sf, "nation"), "lineitem": lines,
    }
    return metrics.volumetry(frames, "raw")


@query(
    "so1_ids_in_both",
    "SELECT CAST(user_id AS VARCHAR) AS id FROM {events} INTERSECT SELECT CAST(c_custkey AS VARCHAR) FROM {customer}",
)
def _(spark, sf):
    return metrics.ids_in_both(*_id_sides(spark, sf))


@query(
    "so1_ids_only_in_tickets",
    "SELECT CAST(l_partkey * 2 AS VARCHAR) AS id FROM {lineitem} EXCEPT SELECT CAST(p_partkey AS VARCHAR) FROM {part}",
)
def _(spark, sf):
    lines = table(spark, sf, "lineitem").select((F.col("l_partkey") * 2).alias("id"))
    return metrics.ids_only_left(
        metrics.distinct_ids(lines, "id"), metrics.distinct_ids(table(spark, sf, "part"), "p_partkey")
    )


@query(
    "so1_id_coverage",
    """WITH t AS (SELECT DISTINCT l_partkey * 2 AS id FROM {lineitem}),
       c AS (SELECT count(*) AS ids, count(p_partkey) AS hit FROM t LEFT JOIN {part} ON p_partkey = id)
       SELECT ids, hit AS in_master, ids - hit AS only_tickets, hit * 100.0 / ids AS coverage_pct FROM c""",
)
def _(spark, sf):
    lines = table(spark, sf, "lineitem").select((F.col("l_partkey") * 2).alias("id"))
    return metrics.id_coverage(
        metrics.distinct_ids(lines, "id"), metrics.distinct_ids(table(spark, sf, "part"), "p_partkey")
    )


def _id_sides(spark, sf):
    return (
        metrics.distinct_ids(table(spark, sf, "events"), "user_id"),
        metrics.distinct_ids(table(spark, sf, "customer"), "c_custkey"),
    )
