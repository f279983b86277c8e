"""Text, date, number and flag expressions over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, flags, numbers, text
from ..operators.metrics import daily_counts
from .base import query, stand_in, table

# ---- SQL counterparts --------------------------------------------------------------

BLANK_CHARS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(160)"


def sql_trim(x: str) -> str:
    return f"trim({x}, {BLANK_CHARS})"


def sql_normalize(x: str) -> str:
    """X1 for the letters that occur in the tables."""
    return f"lower({sql_trim(f'''replace(strip_accents({x}), 'ß', 'ss')''')})"


def sql_title(x: str) -> str:
    words = f"regexp_extract_all({x}, '\\p{{L}}+|\\P{{L}}+')"
    return f"array_to_string([replace(upper(w[1]), 'ẞ', 'Ss') || lower(w[2:]) FOR w IN {words}], '')"


def sql_date(x: str) -> str:
    formats = ("%m/%d/%Y %I:%M:%S %p", "%m/%d/%Y %H:%M:%S", "%Y-%m-%d %H:%M:%S", "%d/%m/%Y %H:%M:%S")
    return "coalesce(" + ", ".join(f"try_strptime({x}, '{f}')" for f in formats) + ")"


def sql_minutes(a: str, b: str) -> str:
    """Minutes from a to b with the fraction."""
    return f"(date_diff('microsecond', {a}, {b}) / 60000000.0)"


def sql_number(x: str) -> str:
    return f"try_cast({sql_trim(x)} AS DOUBLE)"


def sql_integer(x: str) -> str:
    n = sql_number(x)
    return f"CASE WHEN {n} = floor({n}) THEN CAST({n} AS BIGINT) END"


def sql_whole(x: str) -> str:
    return f"CAST(trunc(coalesce({x}, 0)) AS BIGINT)"


def sql_reorder(x: str, keep: str) -> str:
    """X7; ``keep`` is a quoted list of names that stay."""
    w = f"string_split(trim(regexp_replace({x}, '\\s+', ' ', 'g')), ' ')"
    return f"""CASE WHEN {x} IS NULL THEN NULL
      WHEN len({w}) = 6 THEN array_to_string({w}[5:] || {w}[:4], ' ')
      WHEN len({w}) > 2 AND lower({x}) NOT IN ({keep}) THEN array_to_string({w}[3:] || {w}[:2], ' ')
      WHEN len({w}) = 2 THEN {w}[2] || ' ' || {w}[1]
      ELSE {x} END"""


# ---- stand-ins ---------------------------------------------------------------------

# names of one to seven words, some with odd blanks, some NULL
NAMES = """
SELECT p_partkey, CASE p_partkey % 9
  WHEN 0 THEN p_type
  WHEN 1 THEN p_name
  WHEN 2 THEN p_name || ' ' || p_type
  WHEN 3 THEN p_name || ' ' || p_type || ' ' || p_brand
  WHEN 4 THEN p_name || ' ' || p_type || ' ' || p_brand || ' ' || p_type
  WHEN 5 THEN p_name || ' ' || p_name || ' ' || p_type || ' ' || p_brand
  WHEN 6 THEN '  ' || p_name || '   ' || p_type || ' ' || p_name || ' ' || p_brand || ' x '
  WHEN 7 THEN p_brand || '  ' || p_type
  END AS raw_name
FROM {part}
"""
KEPT = ("blue bolt economy brand#4", "red widget small brand#17", "hot gear promo brand#3")
KEPT_SQL = ", ".join(f"'{k}'" for k in KEPT)

# order dates written in the four export formats, plus values no format takes
DATE_TEXTS = """
SELECT o_orderkey, CASE o_orderkey % 9
  WHEN 0 THEN CAST(month(o_orderdate) AS STRING) || '/' || CAST(day(o_orderdate) AS STRING) || '/' ||
       CAST(year(o_orderdate) AS STRING) || ' ' || CAST(o_orderkey % 12 + 1 AS STRING) || ':05:09 ' ||
       CASE WHEN o_orderkey % 2 = 0 THEN 'AM' ELSE 'pm' END
  WHEN 1 THEN CAST(month(o_orderdate) AS STRING) || '/' || CAST(day(o_orderdate) AS STRING) || '/' ||
       CAST(year(o_orderdate) AS STRING) || ' ' || CAST(o_orderkey % 24 AS STRING) || ':15:30'
  WHEN 2 THEN CAST(year(o_orderdate) AS STRING) || '-' || lpad(CAST(month(o_orderdate) AS STRING), 2, '0')
       || '-' || lpad(CAST(day(o_orderdate) AS STRING), 2, '0') || ' ' ||
       lpad(CAST(o_orderkey % 24 AS STRING), 2, '0') || ':00:59'
  WHEN 3 THEN lpad(CAST(day(o_orderdate) AS STRING), 2, '0') || '/' ||
       lpad(CAST(month(o_orderdate) AS STRING), 2, '0') || '/' || CAST(year(o_orderdate) AS STRING) || ' 23:59:59'
  WHEN 4 THEN CAST(year(o_orderdate) AS STRING) || '-02-30 10:00:00'
  WHEN 5 THEN CAST(year(o_orderdate) AS STRING) || '-' || lpad(CAST(month(o_orderdate) AS STRING), 2, '0') || '-01'
  WHEN 6 THEN 'not a date ' || CAST(o_orderkey AS STRING)
  WHEN 7 THEN '13/13/' || CAST(year(o_orderdate) AS STRING) || ' 10:00:00'
  END AS raw_date
FROM {orders}
"""

# a case opens with the order and closes with the shipment; every third one is still open
CASES = """
SELECT l_orderkey, l_linenumber, l_partkey, o_orderdate AS opened,
       CASE WHEN (l_orderkey + l_linenumber) % 3 = 0 THEN NULL ELSE l_shipdate END AS closed
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
"""

DURATIONS = """
SELECT l_orderkey, l_linenumber, l_partkey, CASE l_partkey % 8
  WHEN 0 THEN CAST(CAST(l_quantity AS BIGINT) AS STRING) || ' horas ' || CAST(l_linenumber AS STRING) || ' minutos'
  WHEN 1 THEN CAST(CAST(l_quantity AS BIGINT) AS STRING) || ' hora'
  WHEN 2 THEN CAST(CAST(l_quantity AS BIGINT) AS STRING) || ' MINUTOS'
  WHEN 3 THEN '2 Horas ' || CAST(CAST(l_quantity AS BIGINT) AS STRING) || ' min'
  WHEN 4 THEN ''
  WHEN 5 THEN CAST(CAST(l_quantity AS BIGINT) AS STRING)
  WHEN 6 THEN CAST(CAST(l_quantity AS BIGINT) AS STRING) || 'horas' || CAST(l_linenumber AS STRING) || 'minuto'
  END AS raw
FROM {lineitem}
"""

CASE_NUMBERS = """
SELECT o_orderkey, CASE o_orderkey % 8
  WHEN 0 THEN 'SO-' || CAST(o_orderkey AS STRING)
  WHEN 1 THEN 'IN-TI-' || CAST(o_orderkey AS STRING)
  WHEN 2 THEN 'RQ-TI-RF-COM-' || CAST(o_orderkey AS STRING)
  WHEN 3 THEN ' ' || CAST(o_orderkey AS STRING) || ' '
  WHEN 4 THEN CAST(o_orderkey AS STRING) || '.0'
  WHEN 5 THEN CAST(o_orderkey AS STRING) || '.7'
  WHEN 6 THEN 'x' || CAST(o_orderkey AS STRING)
  END AS raw
FROM {orders}
"""
PREFIXES = ("SO-", "IN-TI-", "RQ-TI-", "CM-TI-")
STRIPPED = "replace(replace(replace(replace(raw, 'SO-', ''), 'IN-TI-', ''), 'RQ-TI-', ''), 'CM-TI-', '')"

FLAGS = """
SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'Cumple' WHEN 1 THEN 'No cumple' WHEN 2 THEN 'SI'
  WHEN 3 THEN 'NO' WHEN 4 THEN event_type END AS flag
FROM {events}
"""

# ---- text --------------------------------------------------------------------------


@query("x1_normalize_text", f"SELECT doc_id, coalesce({sql_normalize('text')}, '') AS normalized FROM {{documents}}")
def _(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", text.normalize_text(F.col("text")).alias("normalized"))


PADDED = "SELECT page_id, chr(9) || ' ' || html || chr(10) || ' ' AS raw FROM {pages}"


@query("x2_trim_lower", f"SELECT page_id, lower({sql_trim('raw')}) AS cleaned FROM ({PADDED}) p")
def _(spark, sf):
    return stand_in(spark, sf, PADDED).select("page_id", text.trim_lower(F.col("raw")).alias("cleaned"))


@query("x3_title_case", f"SELECT doc_id, {sql_title('text')} AS titled FROM {{documents}}")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.title_case(F.col("text")).alias("titled"))


PATHS = """
SELECT c_custkey, c_name || '@' || c_mktsegment || '@corp' AS login,
       c_mktsegment || CASE WHEN c_custkey % 2 = 0 THEN ' > ' || c_name || ' > x' ELSE '>y' END AS path
FROM {customer}
"""


@query(
    "x4_before_first",
    f"SELECT c_custkey, split_part(login, '@', 1) AS account, split_part(path, ' > ', 1) AS service FROM ({PATHS}) p",
)
def _(spark, sf):
    return stand_in(spark, sf, PATHS).select(
        "c_custkey",
        text.account_of(F.col("login")).alias("account"),
        text.top_service(F.col("path")).alias("service"),
    )


@query("x5_last_line", "SELECT doc_id, split_part(text, chr(10), -1) AS last_line FROM {documents}")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.last_line(F.col("text")).alias("last_line"))


@query("x6_remove_literal", f"SELECT o_orderkey, replace({STRIPPED}, ' ', '') AS cleaned FROM ({CASE_NUMBERS}) c")
def _(spark, sf):
    raw = stand_in(spark, sf, CASE_NUMBERS)
    return raw.select(
        "o_orderkey", text.remove_literal(F.col("raw"), *PREFIXES, " ").alias("cleaned")
    )


@query("x7_reorder_name", f"SELECT p_partkey, {sql_reorder('raw_name', KEPT_SQL)} AS name FROM ({NAMES}) n")
def _(spark, sf):
    raw = stand_in(spark, sf, NAMES)
    return raw.select("p_partkey", text.reorder_name(F.col("raw_name"), KEPT).alias("name"))


@query(
    "x8_contains_text",
    "SELECT doc_id, contains(text, 'the') AS has_the, contains(text, 'été') AS has_accented FROM {documents}",
)
def _(spark, sf):
    c = F.col("text")
    return table(spark, sf, "documents").select(
        "doc_id",
        text.contains_text(c, "the").alias("has_the"),
        text.contains_text(c, "été").alias("has_accented"),
    )


KEYS = """
SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN '   ' WHEN c_custkey % 5 = 1 THEN NULL
  ELSE '  ' || c_name || chr(9) END AS raw FROM {customer}
"""


@query(
    "x9_lookup_key",
    f"SELECT c_custkey, nullif(lower({sql_trim('raw')}), '') AS lowered, nullif({sql_trim('raw')}, '') AS kept FROM ({KEYS}) k",
)
def _(spark, sf):
    c = F.col("raw")
    return stand_in(spark, sf, KEYS).select(
        "c_custkey", text.lookup_key(c).alias("lowered"), text.lookup_key(c, lower=False).alias("kept")
    )


@query(
    "x10_remap",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN '5-LOW' WHEN '5-LOW' THEN '1-URGENT'
       WHEN '2-HIGH' THEN 'HIGH' ELSE o_orderpriority END AS priority FROM {orders}""",
)
def _(spark, sf):
    mapping = {"1-URGENT": "5-LOW", "5-LOW": "1-URGENT", "2-HIGH": "HIGH"}
    return table(spark, sf, "orders").select(
        "o_orderkey", text.remap(F.col("o_orderpriority"), mapping).alias("priority")
    )


# ---- dates -------------------------------------------------------------------------


@query("d1_parse_date", f"SELECT o_orderkey, {sql_date('raw_date')} AS parsed FROM ({DATE_TEXTS}) d")
def _(spark, sf):
    raw = stand_in(spark, sf, DATE_TEXTS)
    return raw.select("o_orderkey", dates.parse_date(F.col("raw_date")).alias("parsed"))


@query(
    "d1_unparsed_dates",
    f"SELECT count(CASE WHEN raw_date IS NOT NULL AND {sql_date('raw_date')} IS NULL THEN 1 END) AS unparsed FROM ({DATE_TEXTS}) d",
)
def _(spark, sf):
    from ..operators.quality import unparsed_dates

    return unparsed_dates(stand_in(spark, sf, DATE_TEXTS), "raw_date")


@query(
    "d2_date_parts",
    """SELECT o_orderkey, o_orderdate, year(o_orderdate) AS o_orderdate_anio, month(o_orderdate) AS o_orderdate_mes,
       day(o_orderdate) AS o_orderdate_dia FROM {orders}""",
)
def _(spark, sf):
    return dates.add_date_parts(table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate")


@query(
    "d3_creation_features",
    """SELECT event_id, ts, isodow(ts) - 1 AS diasemana_creacion, month(ts) AS mes_creacion,
       day(ts) AS dia_creacion, year(ts) AS "año_creacion" FROM {events}""",
)
def _(spark, sf):
    return dates.add_creation_features(table(spark, sf, "events").select("event_id", "ts"), "ts")


@query("d4_midnight", "SELECT event_id, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS day FROM {events}")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", dates.midnight(F.col("ts")).alias("day"))


@query(
    "d5_elapsed_minutes",
    f"SELECT l_orderkey, l_linenumber, l_partkey, {sql_minutes('opened', 'closed')} AS minutes FROM ({CASES}) c",
)
def _(spark, sf):
    out = dates.add_elapsed(stand_in(spark, sf, CASES), "opened", "closed", "minutes")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "minutes")


@query(
    "d6_slack_minutes",
    f"SELECT l_orderkey, l_linenumber, l_partkey, {sql_minutes('closed', 'opened')} AS slack FROM ({CASES}) c",
)
def _(spark, sf):
    out = dates.add_slack(stand_in(spark, sf, CASES), "opened", "closed", "slack")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "slack")


EVENT_DAYS = "SELECT ts AS fecha_creacion FROM {events}"


@query(
    "d7_day_number",
    """WITH days AS (SELECT CAST(CAST(ts AS DATE) AS TIMESTAMP) AS fecha_creacion, count(*) AS "cantidadCasos"
       FROM {events} GROUP BY 1)
       SELECT fecha_creacion, "cantidadCasos",
         date_diff('day', (SELECT min(fecha_creacion) FROM days), fecha_creacion) + 1 AS fecha FROM days""",
)
def _(spark, sf):
    events = stand_in(spark, sf, EVENT_DAYS)
    daily = daily_counts(dates.add_creation_features(events))
    return dates.add_day_number(daily).select("fecha_creacion", "cantidadCasos", "fecha")


# ---- numbers -----------------------------------------------------------------------


@query(
    "n1_parse_duration",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN raw IS NULL THEN NULL ELSE
        coalesce(try_cast(nullif(regexp_extract(raw, '(?i)(\\d+)\\s*horas?', 1), '') AS DOUBLE), 0) * 60 +
        coalesce(try_cast(nullif(regexp_extract(raw, '(?i)(\\d+)\\s*(?:minutos?|min)', 1), '') AS DOUBLE), 0)
        END AS minutes FROM ({DURATIONS}) d""",
)
def _(spark, sf):
    raw = stand_in(spark, sf, DURATIONS)
    return raw.select(
        "l_orderkey", "l_linenumber", "l_partkey", numbers.parse_duration(F.col("raw")).alias("minutes")
    )


@query("n2_to_integer", f"SELECT o_orderkey, {sql_integer(STRIPPED)} AS numero_caso FROM ({CASE_NUMBERS}) c")
def _(spark, sf):
    raw = stand_in(spark, sf, CASE_NUMBERS)
    cleaned = text.remove_literal(F.col("raw"), *PREFIXES)
    return raw.select("o_orderkey", numbers.to_integer(cleaned).alias("numero_caso"))


@query(
    "n3_whole_minutes",
    f"""SELECT o_orderkey, {sql_whole(sql_number('raw'))} AS from_text,
        {sql_whole('o_totalprice')} AS from_number
        FROM ({CASE_NUMBERS}) c JOIN {{orders}} USING (o_orderkey)""",
)
def _(spark, sf):
    raw = stand_in(spark, sf, CASE_NUMBERS.replace("SELECT o_orderkey,", "SELECT o_orderkey, o_totalprice,"))
    return raw.select(
        "o_orderkey",
        numbers.whole_minutes(F.col("raw")).alias("from_text"),
        numbers.whole_number(F.col("o_totalprice")).alias("from_number"),
    )


@query("n4_fixed_minutes", "SELECT event_id, CAST(300 AS BIGINT) AS minutes FROM {events}")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", numbers.fixed_minutes().alias("minutes"))


# ---- flags -------------------------------------------------------------------------


@query(
    "b1_sla_vocabulary",
    f"""SELECT event_id,
        CASE flag WHEN 'Cumple' THEN 'SI' WHEN 'No cumple' THEN 'NO' ELSE flag END AS plain,
        CASE flag WHEN 'Cumple' THEN 'NO' WHEN 'No cumple' THEN 'SI' WHEN 'SI' THEN 'NO' WHEN 'NO' THEN 'SI'
        ELSE flag END AS swapped FROM ({FLAGS}) f""",
)
def _(spark, sf):
    raw = stand_in(spark, sf, FLAGS).withColumns({"plain": F.col("flag"), "swapped": F.col("flag")})
    out = flags.normalize_sla(flags.normalize_sla(raw, "plain"), "swapped", invert=True)
    return out.drop("flag")


@query(
    "b2_in_time",
    f"""SELECT l_orderkey, l_linenumber, l_partkey,
        CASE WHEN {sql_minutes('closed', 'opened')} > 0 THEN 'SI' ELSE 'NO' END AS in_time FROM ({CASES}) c""",
)
def _(spark, sf):
    out = dates.add_slack(stand_in(spark, sf, CASES), "opened", "closed", "slack")
    return flags.add_in_time(out, "slack", "in_time").select(
        "l_orderkey", "l_linenumber", "l_partkey", "in_time"
    )


@query(
    "b3_ahead_of_estimate",
    """SELECT event_id, CASE WHEN CASE WHEN event_id % 4 = 0 THEN NULL ELSE value - 20 END < 0
       THEN 'SI' ELSE 'NO' END AS flag FROM {events}""",
)
def _(spark, sf):
    e = table(spark, sf, "events")
    e = e.withColumn("overrun", F.when(F.col("event_id") % 4 != 0, F.col("value") - 20))
    return flags.add_ahead_of_estimate(e, "overrun", "flag").select("event_id", "flag")


@query("b4_constant_flag", "SELECT event_id, 'SI' AS flag FROM {events}")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", flags.always().alias("flag"))


@query(
    "b5_open_or_closed",
    f"""SELECT l_orderkey, l_linenumber, l_partkey,
        CASE WHEN closed IS NULL THEN 'Abierto' ELSE 'Cerrado' END AS state FROM ({CASES}) c""",
)
def _(spark, sf):
    return stand_in(spark, sf, CASES).select(
        "l_orderkey", "l_linenumber", "l_partkey", flags.open_or_closed(F.col("closed")).alias("state")
    )


GAPS = """
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END AS razon,
       CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderstatus END AS ubicacion FROM {orders}
"""


@query(
    "b6_fill_defaults",
    f"SELECT o_orderkey, coalesce(razon, 'none') AS razon, coalesce(ubicacion, 'nowhere') AS ubicacion FROM ({GAPS}) g",
)
def _(spark, sf):
    defaults = {"razon": "none", "ubicacion": "nowhere", "absent": "x"}
    return flags.fill_defaults(stand_in(spark, sf, GAPS), defaults)


@query(
    "b7_fill_by_category",
    """SELECT p_partkey, coalesce(CASE WHEN p_partkey % 2 = 0 THEN p_brand END,
       CASE WHEN contains(p_name, 'red') THEN 'first' END,
       CASE WHEN contains(p_name, 'bolt') THEN 'second' END) AS owner FROM {part}""",
)
def _(spark, sf):
    p = table(spark, sf, "part").withColumn("owner", F.when(F.col("p_partkey") % 2 == 0, F.col("p_brand")))
    rules = [("red", "first"), ("bolt", "second")]
    return p.select(
        "p_partkey", flags.fill_by_category(F.col("owner"), F.col("p_name"), rules).alias("owner")
    )
