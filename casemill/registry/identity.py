"""Lookup and identity operators over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import lookup_key, normalize_text, trim_lower
from ..operators import identity, lookups, metrics
from ..sources import rules
from .base import query, stand_in, table
from .columns import sql_normalize

# ---- stand-ins ---------------------------------------------------------------------

# the employee master knows a part of the customers, some under a blank or repeated key
EMPLOYEES = """
SELECT c_name AS NombreCompleto,
       CASE WHEN c_custkey % 10 = 0 THEN NULL WHEN c_custkey % 10 = 1 THEN '  '
         WHEN c_custkey % 10 = 2 THEN CAST(c_custkey - 1 AS STRING)
         ELSE ' ' || CAST(c_custkey AS STRING) || ' ' END AS cedula,
       CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE ' U' || CAST(c_custkey AS STRING) || ' ' END AS username
FROM {customer} WHERE c_mktsegment <> 'MACHINERY'
"""
USERS = """
SELECT s_name AS NombreCompleto, CAST(s_suppkey * 3 AS STRING) AS cedula,
       'sup' || CAST(s_suppkey AS STRING) AS username FROM {supplier}
"""
DIRECTORY = """
SELECT CAST(c_custkey AS STRING) AS employee_id, 'dir' || CAST(c_custkey AS STRING) AS account,
       c_name AS display_name FROM {customer} WHERE c_nationkey < 18
"""
# user names that are ids, logins, blank or missing; names that are partly missing
TICKETS = """
SELECT event_id AS numero_caso, event_type AS servicio,
       CASE event_id % 6 WHEN 0 THEN 'Name ' || CAST(user_id AS STRING) WHEN 1 THEN 'Ana Peña' END AS usuariofinal,
       CASE WHEN event_id % 4 = 0 THEN NULL ELSE 'Owner ' || CAST(event_id % 11 AS STRING) END AS responsable,
       CASE event_id % 5 WHEN 0 THEN ' ' || CAST(user_id AS STRING) || ' ' WHEN 1 THEN 'U' || CAST(user_id AS STRING)
         WHEN 2 THEN '' WHEN 3 THEN CAST(user_id * 7 AS STRING) END AS username_ufinal,
       CASE event_id % 3 WHEN 0 THEN 'SUP' || CAST(user_id AS STRING) WHEN 1 THEN 'sup2 ' END AS username_resp
FROM {events}
"""



RANKED = f"""SELECT 0 AS rnk, trim("NombreCompleto") AS nombre, nullif(trim(cedula), '') AS cedula,
  nullif(lower(trim(username)), '') AS username FROM ({EMPLOYEES}) e
  UNION ALL SELECT 1, trim("NombreCompleto"), nullif(trim(cedula), ''), nullif(lower(trim(username)), '') FROM ({USERS}) u"""


def sql_last(source: str, key: str, order: str) -> str:
    return f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn
      FROM ({source}) s WHERE {key} IS NOT NULL) t WHERE rn = 1"""


def _desc(*columns: str) -> str:
    return ", ".join(f"{c} DESC NULLS LAST" for c in columns)


BY_ID = sql_last(RANKED, "cedula", _desc("rnk", "nombre", "username"))
BY_USERNAME = sql_last(RANKED, "username", _desc("rnk", "nombre", "cedula"))


def _index(spark, sf):
    return identity.build_master_index(stand_in(spark, sf, EMPLOYEES), stand_in(spark, sf, USERS))


@query("j1_master_by_id", f"SELECT cedula, nombre, username FROM ({BY_ID}) i")
def _(spark, sf):
    return _index(spark, sf).by_id


@query("j1_master_by_username", f"SELECT username, nombre, cedula FROM ({BY_USERNAME}) i")
def _(spark, sf):
    return _index(spark, sf).by_username


@query(
    "a7_duplicate_keys",
    f"""SELECT count(cedula) - count(DISTINCT cedula) AS dup_cedula, count(username) - count(DISTINCT username) AS dup_username
        FROM ({RANKED}) r""",
)
def _(spark, sf):
    both = stand_in(spark, sf, EMPLOYEES).unionByName(stand_in(spark, sf, USERS))
    keyed = both.select(
        lookup_key(F.col("cedula"), lower=False).alias("cedula"), lookup_key(F.col("username")).alias("username")
    )
    return lookups.duplicate_keys(keyed, "cedula", "username")


@query("s14_directory_snapshot", f"SELECT employee_id, account FROM ({DIRECTORY}) d")
def _(spark, sf):
    # two copies of the snapshot: keys stay unique
    snapshot = stand_in(spark, sf, DIRECTORY)
    return identity.build_directory(snapshot.unionAll(snapshot))


TICKET_IDS = f"""SELECT t.*, CASE WHEN regexp_full_match(trim(username_ufinal), '[0-9]+') THEN trim(username_ufinal) END AS id
  FROM ({TICKETS}) t"""
RESOLVED = f"""SELECT numero_caso, servicio, coalesce(m.nombre, usuariofinal) AS usuariofinal, responsable,
  coalesce(m.username, d.account, username_ufinal) AS username_ufinal, username_resp,
  CASE WHEN id IS NULL THEN NULL WHEN m.username IS NOT NULL THEN 'master'
       WHEN d.account IS NOT NULL THEN 'directory' ELSE 'unresolved' END AS outcome
  FROM ({TICKET_IDS}) t LEFT JOIN ({BY_ID}) m ON m.cedula = id
  LEFT JOIN ({DIRECTORY}) d ON d.employee_id = id AND m.username IS NULL"""


def _resolved(spark, sf):
    directory = identity.build_directory(stand_in(spark, sf, DIRECTORY))
    return identity.resolve_ids(
        stand_in(spark, sf, TICKETS), _index(spark, sf), directory, outcome="outcome"
    )


@query("j2_j3_j4_resolve_ids", RESOLVED)
def _(spark, sf):
    return _resolved(spark, sf)


@query(
    "a5_id_outcomes",
    f"""SELECT count(outcome) AS candidates, count(CASE WHEN outcome = 'master' THEN 1 END) AS from_master,
        count(CASE WHEN outcome = 'directory' THEN 1 END) AS from_directory,
        count(CASE WHEN outcome = 'unresolved' THEN 1 END) AS unresolved FROM ({RESOLVED}) r""",
)
def _(spark, sf):
    return metrics.id_outcomes(_resolved(spark, sf), "outcome")


FILLED = f"""SELECT numero_caso, servicio, coalesce(usuariofinal, u.nombre) AS usuariofinal,
  coalesce(responsable, o.nombre) AS responsable, username_ufinal, username_resp
  FROM ({TICKETS}) t LEFT JOIN ({BY_USERNAME}) u ON u.username = lower(trim(username_ufinal))
  LEFT JOIN ({BY_USERNAME}) o ON o.username = lower(trim(username_resp))"""


@query("j5_fill_display_names", FILLED)
def _(spark, sf):
    return identity.fill_display_names(stand_in(spark, sf, TICKETS), _index(spark, sf))


@query(
    "a5_names_filled",
    f"""SELECT (SELECT count(*) FROM ({TICKETS}) t WHERE usuariofinal IS NULL)
        - count(CASE WHEN usuariofinal IS NULL THEN 1 END) AS usuariofinal_filled,
        (SELECT count(*) FROM ({TICKETS}) t WHERE responsable IS NULL)
        - count(CASE WHEN responsable IS NULL THEN 1 END) AS responsable_filled FROM ({FILLED}) f""",
)
def _(spark, sf):
    before = stand_in(spark, sf, TICKETS)
    after = identity.fill_display_names(before, _index(spark, sf))
    return metrics.names_filled(before, after, "usuariofinal", "responsable")


@query(
    "j6_overwrite",
    """SELECT c_custkey, n_name AS c_name FROM {customer} LEFT JOIN {nation} ON n_nationkey = c_nationkey AND n_regionkey <> 2""",
)
def _(spark, sf):
    nations = table(spark, sf, "nation").where("n_regionkey <> 2")
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    return lookups.overwrite(
        customers, nations, F.col("c_nationkey"), "n_nationkey", "n_name", "c_name"
    ).drop("c_nationkey")


# a dictionary with two spellings per login, accents in the names
DICTIONARY = """
SELECT CASE WHEN c_custkey % 3 = 0 THEN 'Ú' ELSE 'u' END || CAST(c_custkey % 500 AS STRING) AS username_ufinal,
       ' José ' || CAST(c_custkey AS STRING) || ' NÚÑEZ' AS usuariofinal, c_custkey AS _row
FROM {customer}
"""
# of a login as written the last name; of two spellings that normalise alike the later login
SPELLINGS = f"""SELECT username_ufinal AS username, min(_row) AS first, arg_max(usuariofinal, _row) AS name
  FROM ({DICTIONARY}) d GROUP BY 1"""
FORWARD = f"""SELECT {sql_normalize('username')} AS key, arg_max(name, first) AS value FROM ({SPELLINGS}) s GROUP BY 1"""
INVERSE = f"""SELECT lower(trim(name)) AS key, arg_max(lower(trim(username)), first) AS value FROM ({SPELLINGS}) s GROUP BY 1"""


@query("j10_forward_dictionary", FORWARD)
def _(spark, sf):
    return lookups.forward_dictionary(stand_in(spark, sf, DICTIONARY), "username_ufinal", "usuariofinal")


@query("j10_inverse_dictionary", INVERSE)
def _(spark, sf):
    return lookups.inverse_dictionary(stand_in(spark, sf, DICTIONARY), "username_ufinal", "usuariofinal")


NAMED = """
SELECT o_orderkey AS numero_caso, ' josé ' || CAST(o_custkey AS STRING) || CASE WHEN o_orderkey % 2 = 0
  THEN ' núñez' ELSE ' nunez' END AS usuariofinal, 'old' AS username_ufinal, o_orderstatus AS origen_caso FROM {orders}
"""


@query(
    "j7_replace_if_found",
    f"""SELECT numero_caso, usuariofinal, coalesce(i.value, username_ufinal) AS username_ufinal, origen_caso
        FROM ({NAMED}) n LEFT JOIN ({INVERSE}) i ON i.key = lower(trim(usuariofinal))""",
)
def _(spark, sf):
    inverse = lookups.inverse_dictionary(stand_in(spark, sf, DICTIONARY), "username_ufinal", "usuariofinal")
    return lookups.replace_if_found(
        stand_in(spark, sf, NAMED), inverse, trim_lower(F.col("usuariofinal")), "key", "value", "username_ufinal"
    )


@query(
    "j8_replace_in_subset",
    f"""SELECT numero_caso, usuariofinal, coalesce(i.value, username_ufinal) AS username_ufinal, origen_caso
        FROM ({NAMED}) n LEFT JOIN ({INVERSE}) i ON i.key = lower(trim(usuariofinal)) AND origen_caso <> 'F'""",
)
def _(spark, sf):
    inverse = lookups.inverse_dictionary(stand_in(spark, sf, DICTIONARY), "username_ufinal", "usuariofinal")
    return lookups.replace_if_found(
        stand_in(spark, sf, NAMED), inverse, trim_lower(F.col("usuariofinal")), "key", "value",
        "username_ufinal", only=F.col("origen_caso") != "F",
    )


@query(
    "j9_fill_from_dictionary",
    f"""SELECT numero_caso, servicio, coalesce(usuariofinal, f.value) AS usuariofinal, responsable, username_ufinal, username_resp
        FROM ({TICKETS}) t LEFT JOIN ({FORWARD}) f ON f.key = {sql_normalize('username_ufinal')}""",
)
def _(spark, sf):
    forward = lookups.forward_dictionary(stand_in(spark, sf, DICTIONARY), "username_ufinal", "usuariofinal")
    return lookups.fill_if_null(
        stand_in(spark, sf, TICKETS), forward, normalize_text(F.col("username_ufinal")), "key", "value", "usuariofinal"
    )


CATALOGUE = [
    {"from": "ECONOMY", "to": "STANDARD"}, {"from": "STANDARD", "to": "ECONOMY"},
    {"from": "promo", "to": "never"}, {"from": "SMALL", "to": "first"}, {"from": "SMALL", "to": "TINY"},
]
CATALOGUE_SQL = """CASE p_type WHEN 'ECONOMY' THEN 'STANDARD' WHEN 'STANDARD' THEN 'ECONOMY'
  WHEN 'SMALL' THEN 'TINY' ELSE p_type END"""


@query("s12_j11_service_catalogue", f"SELECT p_partkey, {CATALOGUE_SQL} AS servicio FROM {{part}}")
def _(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", F.col("p_type").alias("servicio"))
    return lookups.remap_by_rules(parts, rules.replacement_rules(CATALOGUE))


@query(
    "j11_service_remap_over_lines",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, {CATALOGUE_SQL} AS servicio
        FROM {{lineitem}} JOIN {{part}} ON p_partkey = l_partkey""",
)
def _(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    parts = table(spark, sf, "part").select("p_partkey", F.col("p_type").alias("servicio"))
    facts = lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).drop("p_partkey")
    return lookups.remap_by_rules(facts, rules.replacement_rules(CATALOGUE))


@query(
    "j11_large_catalogue",
    """SELECT o_orderkey, CASE WHEN o_custkey % 2 = 0 AND o_custkey < 600 THEN 'service ' || CAST(o_custkey + 1 AS VARCHAR)
       ELSE CAST(o_custkey AS VARCHAR) END AS servicio FROM {orders}""",
)
def _(spark, sf):
    many = [{"from": str(k), "to": f"service {k + 1}"} for k in range(0, 600, 2)]
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("servicio"))
    return lookups.remap_by_rules(orders, rules.replacement_rules(many))


@query(
    "j12_project_rule",
    """SELECT event_id, event_type AS servicio, CASE event_type WHEN 'error' THEN 'Software' ELSE 'Desk' END AS proyecto
       FROM {events}""",
)
def _(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.col("event_type").alias("servicio"), F.lit("Desk").alias("proyecto"))
    projects = rules.project_rules([{"match_servicio": "error", "proyecto": "Software"}])
    return lookups.remap_by_rules(e, projects, "servicio", "proyecto", "match_servicio", "proyecto")


SECTIONS = {
    "patrones_especiales": [{"match": "10.0.0.9", "username_ufinal": "u7"}],
    "por_numero_caso": [
        {"numero_caso": 5, "username_ufinal": "alias1"},
        {"numero_caso": 12, "username_ufinal": "casey"},
        {"numero_caso": 15, "username_ufinal": "filly", "origen_caso": "F"},
        {"numero_caso": 16, "username_ufinal": "paul", "origen_caso": "P"},
    ],
    "por_username_alias": [{"from": "alias1", "to": "u9"}, {"from": "u3", "to": "u30"}],
    "nombres_por_username": [
        {"username": "u9", "nombre": "Nina Nueve", "aplica_a": ["usuariofinal"]},
        {"username": "r2", "nombre": "Rita Dos", "aplica_a": ["responsable", "usuariofinal"]},
        {"username": "u30", "nombre": "first", "aplica_a": ["usuariofinal"]},
        {"username": "u30", "nombre": "Tere Treinta", "aplica_a": ["usuariofinal"]},
    ],
    "por_responsable": [
        {"match": " Rita Dos", "responsable_canonico": "Rita D.", "username_resp": "rita"},
        {"match": "owner 4", "responsable_canonico": "Olga Cuatro", "username_resp": "olga"},
    ],
    "por_usuariofinal": [
        {"match": "NINA NUEVE", "usuariofinal_canonico": "Nina N.", "username_ufinal": "nina",
         "validacion_pendiente": True},
        {"match": "user 11", "usuariofinal_canonico": "Úrsula Once", "username_ufinal": "ursula"},
    ],
}
CASES = """
SELECT o_orderkey AS numero_caso, o_orderstatus AS origen_caso,
       ' Owner ' || CAST(o_orderkey % 6 AS STRING) || ' ' AS responsable, 'User ' || CAST(o_custkey AS STRING) AS usuariofinal,
       CASE o_custkey % 8 WHEN 0 THEN '10.0.0.9' WHEN 1 THEN 'alias1' ELSE 'u' || CAST(o_custkey % 50 AS STRING) END AS username_ufinal,
       CASE o_orderkey % 3 WHEN 0 THEN 'u3' WHEN 1 THEN 'r2' ELSE 'r' || CAST(o_orderkey % 7 AS STRING) END AS username_resp
FROM {orders}
"""


def sql_overrides(source: str) -> str:
    """The six sections one after the other."""
    return f"""SELECT * REPLACE (
      CASE lower(trim(responsable)) WHEN 'rita dos' THEN 'Rita D.' WHEN 'owner 4' THEN 'Olga Cuatro' ELSE responsable END AS responsable,
      CASE lower(trim(usuariofinal)) WHEN 'nina nueve' THEN 'Nina N.' WHEN 'user 11' THEN 'Úrsula Once' ELSE usuariofinal END AS usuariofinal,
      CASE lower(trim(usuariofinal)) WHEN 'nina nueve' THEN 'nina' WHEN 'user 11' THEN 'ursula' ELSE username_ufinal END AS username_ufinal,
      CASE lower(trim(responsable)) WHEN 'rita dos' THEN 'rita' WHEN 'owner 4' THEN 'olga' ELSE username_resp END AS username_resp)
    FROM (SELECT * REPLACE (
      CASE username_resp WHEN 'r2' THEN 'Rita Dos' ELSE responsable END AS responsable,
      CASE username_ufinal WHEN 'u9' THEN 'Nina Nueve' WHEN 'r2' THEN 'Rita Dos' WHEN 'u30' THEN 'Tere Treinta'
        ELSE usuariofinal END AS usuariofinal)
    FROM (SELECT * REPLACE (
      CASE username_ufinal WHEN 'alias1' THEN 'u9' WHEN 'u3' THEN 'u30' ELSE username_ufinal END AS username_ufinal,
      CASE username_resp WHEN 'alias1' THEN 'u9' WHEN 'u3' THEN 'u30' ELSE username_resp END AS username_resp)
    FROM (SELECT * REPLACE (
      CASE WHEN numero_caso = 5 THEN 'alias1' WHEN numero_caso = 12 THEN 'casey'
           WHEN numero_caso = 15 AND origen_caso = 'F' THEN 'filly' WHEN numero_caso = 16 AND origen_caso = 'P' THEN 'paul'
           WHEN username_ufinal = '10.0.0.9' THEN 'u7' ELSE username_ufinal END AS username_ufinal)
    FROM ({source}) c0) c1) c2) c3"""


@query("s13_j13_identity_overrides", sql_overrides(CASES))
def _(spark, sf):
    return identity.apply_overrides(stand_in(spark, sf, CASES), rules.override_rules(SECTIONS))


CLEANED = f"""SELECT * REPLACE ({sql_normalize('responsable')} AS responsable, {sql_normalize('usuariofinal')} AS usuariofinal)
  FROM ({sql_overrides(CASES)}) o"""


@query("j14_overrides_around_cleaning", sql_overrides(CLEANED))
def _(spark, sf):
    book = rules.override_rules(SECTIONS)
    df = identity.apply_overrides(stand_in(spark, sf, CASES), book)
    df = df.withColumns(
        {c: normalize_text(F.col(c)) for c in ("responsable", "usuariofinal")}
    )
    return identity.apply_overrides(df, book)


@query(
    "j15_names_from_directory",
    f"""SELECT numero_caso, servicio, coalesce(usuariofinal, display_name) AS usuariofinal, responsable, username_ufinal, username_resp
        FROM (SELECT * REPLACE ('DIR' || CAST(numero_caso % 3000 AS VARCHAR) || ' ' AS username_ufinal) FROM ({TICKETS}) x) t
        LEFT JOIN ({DIRECTORY}) d ON lower(account) = lower(trim(username_ufinal))""",
)
def _(spark, sf):
    tickets = stand_in(spark, sf, TICKETS).withColumn(
        "username_ufinal", F.concat(F.lit("DIR"), F.col("numero_caso") % 3000, F.lit(" "))
    )
    names = identity.directory_names(stand_in(spark, sf, DIRECTORY))
    return identity.fill_names_from_directory(tickets, names)
