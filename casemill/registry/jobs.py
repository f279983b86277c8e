"""The end-to-end jobs over exports derived from the given tables."""

from __future__ import annotations

from ..operators.metrics import distinct_values, rows_by, unresolved_rows
from ..plans import consolidate as plan
from ..plans import profile, service_reports
from ..session import scratch_path
from ..sources import rules
from .base import query, stand_in, table
from .columns import (
    sql_date,
    sql_integer,
    sql_minutes,
    sql_normalize,
    sql_number,
    sql_reorder,
    sql_title,
    sql_whole,
)
from .identity import SECTIONS, sql_last, sql_overrides

# ---- raw exports ---------------------------------------------------------------------


def person(k: str, given_first: bool = False) -> str:
    """A name of two to six words, family names first as the helpdesk writes them."""
    n = f"CAST({k} AS STRING)"
    if given_first:
        forms = (f"'Ana María' || {n} || ' Peña Díaz'", f"'José' || {n} || ' Núñez López'",
                 f"'Eva' || {n} || ' Ruiz'", f"'de Mar' || {n} || ' Gómez Ortiz Luz Ángela'")
    else:
        forms = (f"'Peña Díaz Ana María' || {n}", f"'Núñez López José' || {n}",
                 f"'Ruiz Eva' || {n}", f"'Gómez Ortiz Luz Ángela de Mar' || {n}")
    return f"CASE {k} % 4 WHEN 0 THEN {forms[0]} WHEN 1 THEN {forms[1]} WHEN 2 THEN {forms[2]} ELSE {forms[3]} END"


EMPLOYEES = f"""
SELECT {person('c_custkey', True)} AS NombreCompleto,
       CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE CAST(c_custkey AS STRING) || ' ' END AS cedula,
       CASE WHEN c_custkey % 10 = 1 THEN ' ' ELSE 'U' || CAST(c_custkey AS STRING) END AS username
FROM {{customer}} WHERE c_nationkey < 20
"""
USERS = f"""
SELECT {person('s_suppkey')} AS NombreCompleto, CAST(s_suppkey * 2 AS STRING) AS cedula,
       's' || CAST(s_suppkey AS STRING) AS username FROM {{supplier}}
"""
DIRECTORY = """
SELECT CAST(c_custkey AS STRING) AS employee_id, 'd' || CAST(c_custkey AS STRING) AS account, c_name AS display_name
FROM {customer} WHERE c_nationkey > 10
"""
USER_NAMES = f"""
SELECT 'u' || CAST(c_custkey AS STRING) AS username_ufinal, {person('c_custkey', True)} AS usuariofinal
FROM {{customer}} WHERE c_custkey % 5 <> 0
"""
OWNER_NAMES = f"""
SELECT 's' || CAST(s_suppkey AS STRING) AS username_resp, {person('s_suppkey', True)} AS responsable
FROM {{supplier}} WHERE s_suppkey % 4 <> 3
"""

INVENTORY = f"""
SELECT event_id AS numero_caso, CASE WHEN event_type = 'click' THEN 'INCIDENTE' ELSE 'cambio menor' END AS tipo_de_caso,
       CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'Old Name' END AS usuariofinal,
       CASE WHEN event_id % 5 = 0 THEN NULL ELSE 'owner 4' END AS responsable,
       CASE WHEN event_type = 'signup' AND event_id % 2 = 0 THEN NULL ELSE event_type END AS servicio,
       ts AS fecha_creacion, ts + INTERVAL '30' MINUTE AS fecha_atencion,
       CASE WHEN event_id % 7 = 0 THEN NULL ELSE ts + INTERVAL '2' HOUR END AS fecha_solucion,
       value AS tiempoTranscurrido,
       CASE event_id % 4 WHEN 0 THEN 'Cumple' WHEN 1 THEN 'No cumple' WHEN 2 THEN 'SI' END AS CUMPLE_ANS,
       CASE WHEN event_id % 2 = 0 THEN NULL ELSE 'Inventory' END AS origen_caso,
       CASE WHEN event_id % 2 = 0 THEN 'Soporte' END AS proyecto,
       'S' || CAST(user_id AS STRING) || CASE WHEN event_id % 2 = 0 THEN '@corp' ELSE '' END AS username_resp,
       CASE event_id % 5 WHEN 0 THEN ' ' || CAST(user_id AS STRING) WHEN 1 THEN CAST(user_id AS STRING)
         WHEN 2 THEN 'U' || CAST(user_id AS STRING) WHEN 3 THEN '10.0.0.9' END AS username_ufinal
FROM {{events}}
"""
ITSM = f"""
SELECT o_orderstatus AS kind, o_orderkey AS numero_caso, 'REQUERIMIENTO DE servicio' AS tipo_de_caso,
       {person('o_custkey', True)} AS usuariofinal, 'OWNER ONE' AS responsable, o_orderpriority AS servicio,
       o_orderdate AS fecha_creacion, o_orderdate AS fecha_atencion,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderdate END AS fecha_solucion,
       o_totalprice AS tiempoTranscurrido, CASE WHEN o_orderkey % 2 = 0 THEN 'Cumple' ELSE 'NO' END AS CUMPLE_ANS,
       'Desk' AS origen_caso, 'Soporte' AS proyecto, 'R' || CAST(o_custkey AS STRING) AS username_resp,
       'X' || CAST(o_custkey AS STRING) || '@corp' AS username_ufinal
FROM {{orders}}
"""
US_DATE = "CAST(month(l_shipdate) AS STRING) || '/' || CAST(day(l_shipdate) AS STRING) || '/' || CAST(year(l_shipdate) AS STRING)"
ISO_DATE = "CAST(year(l_shipdate) AS STRING) || '-' || lpad(CAST(month(l_shipdate) AS STRING), 2, '0') || '-' || lpad(CAST(day(l_shipdate) AS STRING), 2, '0')"
CASE_ID = "CAST(l_orderkey * 10 + l_linenumber AS STRING)"

HELPDESK_HEADER = (
    "id", "TITULO", "TIPO", "SOLICITANTE", "ASIGANADO_A", "CATEGORIA", "ESTADO", "PRIORIDAD",
    "FECHA_APERTURA", "TIEMPO_ADUEÑARSE", "FECHA_SOLUCION", "TIEMPO_SOLUCION",
    "TIEMPO_SOLUCION.1", "TIEMPO_RESOLVER_EXCEDIO",
)
HELPDESK = f"""
SELECT CASE WHEN l_linenumber = 1 THEN 'n/n' ELSE ' ' || CAST(l_orderkey AS STRING) || ' ' || CAST(l_linenumber AS STRING) END AS id,
       'a title' AS titulo, CASE WHEN l_linenumber = 2 THEN 'INCIDENCIA' ELSE 'REQUERIMIENTO' END AS tipo,
       CASE l_linenumber WHEN 3 THEN NULL WHEN 4 THEN 'Uno Dos' || chr(10) || ({person('l_partkey % 1500')}) ELSE {person('l_partkey % 1500')} END AS solicitante,
       CASE l_linenumber WHEN 5 THEN NULL WHEN 6 THEN 'Owner 4' ELSE {person('l_suppkey')} END AS asignado,
       CASE l_suppkey % 4 WHEN 0 THEN 'DEV > Apps > X' WHEN 1 THEN 'FARM > y' WHEN 2 THEN 'web old' ELSE 'BANK QA' END AS categoria,
       'Cerrado' AS estado, '1' AS prioridad,
       {ISO_DATE} || ' 08:00:00' AS apertura,
       CASE WHEN l_partkey % 9 = 0 THEN NULL ELSE {ISO_DATE} || ' 08:30:00' END AS tomado,
       CASE WHEN l_partkey % 8 = 0 THEN 'soon' ELSE {ISO_DATE} || ' 17:30:00' END AS solucion,
       'x' AS t1, CAST(l_linenumber AS STRING) || ' horas 5 minutos' AS t2,
       CASE WHEN l_partkey % 2 = 0 THEN 'SI' ELSE 'NO' END AS vencido
FROM {{lineitem}} WHERE l_returnflag = 'R'
"""
REQUEST_HEADER = (
    "Número de solicitud", "Fecha de creación", "Fecha de modificación",
    "(No modificar) Fecha de modificación", "Autor", "Tipo de Requerimiento",
    "Usuario que Gestiona", "Proyecto",
)
REQUESTS = f"""
SELECT 'SO-' || {CASE_ID} AS numero, l_shipdate AS creada, l_shipdate + INTERVAL '1' DAY AS tomada,
       l_shipdate + INTERVAL '2' DAY AS cerrada, {person('l_partkey % 1500', True)} AS autor,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE 'Req ' || CAST(l_linenumber AS STRING) END AS tipo,
       CASE l_linenumber WHEN 6 THEN NULL WHEN 5 THEN ' Rita Dos ' ELSE {person('l_suppkey', True)} END AS gestor,
       CASE WHEN l_linenumber = 4 THEN NULL ELSE 'Web' END AS proyecto
FROM {{lineitem}} WHERE l_returnflag = 'N' AND l_linestatus = 'O'
"""
SUITE_HEADER = (
    "NúMERO DE CASO", "TIPO DE CASO", "USUARIO FINAL", "ESPECIALISTA", "SERVICIO", "FECHA CREACIÓN",
    "FECHA ATENCIÓN", "FECHA SOLUCIÓN", "TIEMPO TRANSCURRIDO", "CUMPLIMIENTO ANS", "ORIGEN CASO",
    "PROYECTO", "LOGIN RESPONSABLE", "LOGIN USUARIO FINAL",
)
SUITE = f"""
SELECT CASE WHEN l_linestatus = 'F' THEN 'incidentes' WHEN l_linenumber <= 3 THEN 'requerimientos' ELSE 'cambios' END AS kind,
       CASE WHEN l_linestatus = 'F' THEN 'IN-TI-' WHEN l_linenumber <= 2 THEN 'RQ-TI-' WHEN l_linenumber = 3 THEN 'RQ-TI-RF-COM-'
         ELSE 'CM-TI-' END || {CASE_ID} AS numero,
       'INCIDENTE grave' AS tipo, {person('l_partkey', True)} AS usuario, {person('l_suppkey', True)} AS especialista,
       CASE l_linenumber WHEN 1 THEN 'OLD MAIL' WHEN 2 THEN NULL ELSE 'BANK' END AS servicio,
       {US_DATE} || ' 9:14:30 AM' AS creacion, {US_DATE} || ' 13:00:00' AS atencion,
       CASE WHEN l_partkey % 10 = 0 THEN NULL ELSE {US_DATE} || ' 5:00:01 PM' END AS solucion,
       CASE l_partkey % 3 WHEN 0 THEN CAST(l_linenumber AS STRING) || '.75' WHEN 1 THEN CAST(l_partkey AS STRING) END AS tiempo,
       CASE WHEN l_partkey % 2 = 0 THEN 'Cumple' ELSE 'No cumple' END AS ans, 'Mail' AS origen, 'other' AS proyecto,
       'S' || CAST(l_suppkey AS STRING) || '@corp' AS login_resp, 'U' || CAST(l_partkey AS STRING) || '@corp@x' AS login_user
FROM {{lineitem}} WHERE l_returnflag = 'A'
"""
TASK_HEADER = (
    "NUMERO DE LA TAREA", "TIPO DE CASO", "AUTOR DE LA TAREA", "SERVICIO", "RESPONSABLE TAREA",
    "FECHA DE REGISTRO CASO", "FECHA INICIO TAREA", "FECHA FIN REAL TAREA", "ORIGEN CASO", "PROYECTO",
    "LOGIN RESPONSABLE TAREA", "LOGIN AUTOR TAREA", "CASO RELACIONADO", "NOMBRE TAREA", "ESTADO TAREA",
    "TIEMPO REAL TAREA",
)
TASKS = f"""
SELECT CASE WHEN l_linenumber = 1 THEN 'T-' ELSE '' END || {CASE_ID} AS numero, 'x' AS tipo,
       {person('l_partkey', True)} AS autor, CASE WHEN l_linenumber = 2 THEN 'OLD MAIL' ELSE 'Tasks' END AS servicio,
       {person('l_suppkey', True)} AS responsable, {US_DATE} || ' 9:14:30 AM' AS registro, {US_DATE} || ' 9:20:00 AM' AS inicio,
       CASE WHEN l_partkey % 10 = 0 THEN NULL ELSE {US_DATE} || ' 5:00:01 PM' END AS fin, 'Mail' AS origen, 'p' AS proyecto,
       's' || CAST(l_suppkey AS STRING) || '@corp' AS login_resp, 'u' || CAST(l_partkey AS STRING) AS login_autor,
       CAST(l_orderkey AS STRING) AS relacionado, 'n' AS nombre, CASE WHEN l_linenumber > 3 THEN 'Cerrada' END AS estado,
       CASE l_partkey % 3 WHEN 0 THEN '-5.5' WHEN 1 THEN '12' END AS real
FROM {{lineitem}}"""
# the suite's tasks are one part of the lines, the task report has them all
SUITE_TASKS = f"{TASKS} WHERE l_returnflag = 'N' AND l_linestatus = 'F'"

CATALOGUE = {
    "general": [{"from": "click", "to": "Web"}, {"from": "Web", "to": "never"}, {"from": "1-URGENT", "to": "Top"},
                {"from": "DEV", "to": "Development"}],
    "suite": [{"from": "OLD MAIL", "to": "Mail"}, {"from": "BANK", "to": "Banking"}],
    "projects": [{"match_servicio": "Development", "proyecto": "Software Desk"}],
}
KEPT = ("peña díaz ana maría8", "núñez lópez josé1")
SETTINGS = plan.Settings(
    helpdesk_services={"web old": "web", "BANK QA": "BANK"},
    owner_spellings={"OWNER ONE": "Öwner Uno"},
    names_in_order=KEPT,
    user_by_category=[("FARM", "Núñez Farm Ana"), ("BANK", "Bank User")],
    owner_by_category=[("FARM", "Farm Owner"), ("DEV", "Dev Owner")],
)


def _headed(spark, sf, sql, header, drop=()):
    df = stand_in(spark, sf, sql).drop(*drop)
    return df.toDF(*header)


def _suite_frames(spark, sf):
    cases = stand_in(spark, sf, SUITE)
    change_header = [
        {"FECHA ATENCIÓN": "FECHA  ESTIMADA ATENCIÓN", "NúMERO DE CASO": "NÚMERO DE CASO"}.get(h, h)
        for h in SUITE_HEADER
    ]
    frames = {
        kind: cases.where(cases.kind == kind).drop("kind").toDF(*header)
        for kind, header in (
            ("incidentes", SUITE_HEADER), ("requerimientos", SUITE_HEADER), ("cambios", change_header),
        )
    }
    return {**frames, "tareas": _headed(spark, sf, SUITE_TASKS, TASK_HEADER)}


def sources(spark, sf) -> plan.Sources:
    itsm = stand_in(spark, sf, ITSM)
    kinds = {"cambios": "F", "requerimientos": "O", "incidentes": "P"}
    return plan.Sources(
        inventory=stand_in(spark, sf, INVENTORY),
        itsm={k: itsm.where(itsm.kind == v).drop("kind") for k, v in kinds.items()},
        helpdesk=_headed(spark, sf, HELPDESK, HELPDESK_HEADER),
        requests=_headed(spark, sf, REQUESTS, REQUEST_HEADER),
        suite=_suite_frames(spark, sf),
    )


def identity(spark, sf) -> plan.Identity:
    return plan.build_identity(
        stand_in(spark, sf, EMPLOYEES), stand_in(spark, sf, USERS), stand_in(spark, sf, USER_NAMES),
        stand_in(spark, sf, OWNER_NAMES), rules.override_rules(SECTIONS), stand_in(spark, sf, DIRECTORY),
    )


# ---- the same consolidation in SQL ---------------------------------------------------

MASTER = f"""SELECT 0 AS rnk, trim(NombreCompleto) AS nombre, nullif(trim(cedula), '') AS cedula,
  nullif(lower(trim(username)), '') AS username FROM ({EMPLOYEES}) e
  UNION ALL SELECT 1, trim(NombreCompleto), nullif(trim(cedula), ''), nullif(lower(trim(username)), '') FROM ({USERS}) u"""
LAST = "rnk DESC, nombre DESC NULLS LAST, username DESC NULLS LAST"
LAST_ID = "rnk DESC, nombre DESC NULLS LAST, cedula DESC NULLS LAST"
USER_BY_NAME = f"SELECT lower(trim(usuariofinal)) AS k, lower(trim(username_ufinal)) AS v FROM ({USER_NAMES}) a"
OWNER_BY_NAME = f"SELECT lower(trim(responsable)) AS k, lower(trim(username_resp)) AS v FROM ({OWNER_NAMES}) a"


def _to_usernames(source: str, clean) -> str:
    """Overrides, cleaned names, user names from names, overrides."""
    return sql_overrides(
        f"""SELECT c.* REPLACE (coalesce(o.v, username_resp) AS username_resp, coalesce(u.v, username_ufinal) AS username_ufinal)
        FROM (SELECT * REPLACE ({clean('usuariofinal')} AS usuariofinal, {clean('responsable')} AS responsable)
              FROM ({sql_overrides(source)}) c0) c
        LEFT JOIN owner_by_name o ON o.k = c.responsable LEFT JOIN user_by_name u ON u.k = c.usuariofinal"""
    )


def _lower(x):
    return f"lower(trim({x}))"


SQL_COLUMNS = """numero_caso, tipo_de_caso, usuariofinal, responsable, servicio, fecha_creacion, fecha_atencion, fecha_solucion,
  tiempo, cumple, origen_caso, proyecto, username_resp, username_ufinal"""


def _helpdesk_sql() -> str:
    name = lambda c: sql_reorder(f"split_part({c}, chr(10), -1)", ", ".join(f"'{k}'" for k in KEPT))
    base = f"""SELECT {sql_integer("replace(id, ' ', '')")} AS numero_caso,
      CASE tipo WHEN 'INCIDENCIA' THEN 'Incidente' WHEN 'REQUERIMIENTO' THEN 'Requerimiento' ELSE tipo END AS tipo_de_caso,
      {name('solicitante')} AS usuariofinal, {name('asignado')} AS responsable,
      CASE split_part(categoria, ' > ', 1) WHEN 'web old' THEN 'web' WHEN 'BANK QA' THEN 'BANK' ELSE split_part(categoria, ' > ', 1) END AS servicio,
      {sql_date('apertura')} AS fecha_creacion, {sql_date('tomado')} AS fecha_atencion, {sql_date('solucion')} AS fecha_solucion,
      CAST(split_part(t2, ' ', 1) AS BIGINT) * 60 + 5 AS tiempo, CASE vencido WHEN 'SI' THEN 'NO' ELSE 'SI' END AS cumple,
      'Helpdesk' AS origen_caso, 'Soporte' AS proyecto, '' AS username_resp, '' AS username_ufinal
    FROM (SELECT * REPLACE (
        coalesce(solicitante, CASE WHEN contains(categoria, 'FARM') THEN 'Núñez Farm Ana' WHEN contains(categoria, 'BANK') THEN 'Bank User' END) AS solicitante,
        coalesce(asignado, CASE WHEN contains(categoria, 'FARM') THEN 'Farm Owner' WHEN contains(categoria, 'DEV') THEN 'Dev Owner' END) AS asignado)
      FROM ({HELPDESK}) h) h WHERE asignado IS NOT NULL AND {sql_date('tomado')} IS NOT NULL"""
    return _to_usernames(base, _lower)


def _requests_sql() -> str:
    base = f"""SELECT CAST(replace(numero, 'SO-', '') AS BIGINT) AS numero_caso, 'Requerimiento' AS tipo_de_caso, autor AS usuariofinal,
      gestor AS responsable, tipo AS servicio, creada AS fecha_creacion, tomada AS fecha_atencion, cerrada AS fecha_solucion,
      300 AS tiempo, 'SI' AS cumple, 'Requests' AS origen_caso, proyecto, '' AS username_resp, '' AS username_ufinal
      FROM ({REQUESTS}) r WHERE gestor IS NOT NULL"""
    return _to_usernames(base, sql_normalize)


def _inventory_sql() -> str:
    ids = f"""SELECT t.*, CASE WHEN regexp_full_match(trim(username_ufinal), '[0-9]+') THEN trim(username_ufinal) END AS id FROM ({INVENTORY}) t"""
    resolved = f"""SELECT t.* EXCLUDE (id) REPLACE (coalesce(m.username, d.account, t.username_ufinal) AS username_ufinal,
        coalesce(m.nombre, t.usuariofinal) AS usuariofinal)
      FROM ({ids}) t LEFT JOIN by_id m ON m.cedula = id
      LEFT JOIN ({DIRECTORY}) d ON d.employee_id = id AND m.username IS NULL"""
    filled = f"""SELECT r.* REPLACE (coalesce(r.usuariofinal, u.nombre) AS usuariofinal, coalesce(r.responsable, o.nombre) AS responsable)
      FROM ({resolved}) r LEFT JOIN by_username u ON u.username = lower(trim(r.username_ufinal))
      LEFT JOIN by_username o ON o.username = lower(trim(r.username_resp))"""
    return f"""SELECT numero_caso, tipo_de_caso, u.usuariofinal, o.responsable, servicio, fecha_creacion, fecha_atencion,
      fecha_solucion, {sql_whole('tiempoTranscurrido')} AS tiempo, CUMPLE_ANS AS cumple, coalesce(origen_caso, 'Inventory') AS origen_caso,
      proyecto, x.username_resp, x.username_ufinal FROM ({sql_overrides(filled)}) x
      LEFT JOIN ({OWNER_NAMES}) o ON o.username_resp = lower(x.username_resp)
      LEFT JOIN ({USER_NAMES}) u ON u.username_ufinal = lower(x.username_ufinal)"""


ITSM_SQL = f"""SELECT numero_caso, tipo_de_caso, usuariofinal, responsable, servicio, fecha_creacion, fecha_atencion, fecha_solucion,
  {sql_whole('tiempoTranscurrido')} AS tiempo, CUMPLE_ANS AS cumple, origen_caso, proyecto, username_resp, username_ufinal FROM ({ITSM}) i"""

SUITE_NUMBER = "replace(replace(replace(numero, 'IN-TI-', ''), 'RQ-TI-', ''), 'CM-TI-', '')"
SUITE_SERVICE = "CASE servicio WHEN 'OLD MAIL' THEN 'Mail' WHEN 'BANK' THEN 'Banking' ELSE servicio END"
SUITE_SQL = f"""SELECT {sql_integer(SUITE_NUMBER)} AS numero_caso, tipo AS tipo_de_caso, usuario AS usuariofinal,
    especialista AS responsable, {SUITE_SERVICE} AS servicio, {sql_date('creacion')} AS fecha_creacion,
    {sql_date('atencion')} AS fecha_atencion, {sql_date('solucion')} AS fecha_solucion, {sql_whole(sql_number('tiempo'))} AS tiempo,
    ans AS cumple, 'Service Suite' AS origen_caso, 'Mesa de Servicios' AS proyecto,
    split_part(login_resp, '@', 1) AS username_resp, split_part(login_user, '@', 1) AS username_ufinal
  FROM ({SUITE}) s WHERE NOT contains({SUITE_NUMBER}, 'RF-COM')
  UNION ALL SELECT {sql_integer('numero')}, 'Tarea', autor, responsable, {SUITE_SERVICE}, {sql_date('registro')}, {sql_date('inicio')},
    {sql_date('fin')}, {sql_whole(sql_minutes(sql_date('registro'), sql_date('fin')))},
    CASE WHEN {sql_number('"real"')} < 0 THEN 'SI' ELSE 'NO' END, 'Service Suite', 'Mesa de Servicios',
    split_part(login_resp, '@', 1), split_part(login_autor, '@', 1) FROM ({SUITE_TASKS}) t"""

CTES = f"""WITH by_id AS ({sql_last(MASTER, 'cedula', LAST)}), by_username AS ({sql_last(MASTER, 'username', LAST_ID)}),
  user_by_name AS ({USER_BY_NAME}), owner_by_name AS ({OWNER_BY_NAME}),
  everything AS (SELECT {SQL_COLUMNS} FROM ({_inventory_sql()}) a UNION ALL SELECT {SQL_COLUMNS} FROM ({ITSM_SQL}) b
    UNION ALL SELECT {SQL_COLUMNS} FROM ({_helpdesk_sql()}) c UNION ALL SELECT {SQL_COLUMNS} FROM ({_requests_sql()}) d
    UNION ALL SELECT {SQL_COLUMNS} FROM ({SUITE_SQL}) e),
  closed AS (SELECT * REPLACE (CASE servicio WHEN 'click' THEN 'Web' WHEN 'Web' THEN 'never' WHEN '1-URGENT' THEN 'Top' WHEN 'DEV' THEN 'Development' ELSE servicio END AS servicio,
      CASE cumple WHEN 'Cumple' THEN 'SI' WHEN 'No cumple' THEN 'NO' ELSE cumple END AS cumple,
      CASE responsable WHEN 'OWNER ONE' THEN 'Öwner Uno' ELSE responsable END AS responsable,
      split_part(username_resp, '@', 1) AS username_resp, split_part(username_ufinal, '@', 1) AS username_ufinal,
      {sql_title('tipo_de_caso')} AS tipo_de_caso)
    FROM everything WHERE servicio IS NOT NULL AND fecha_atencion IS NOT NULL AND fecha_solucion IS NOT NULL),
  others AS (SELECT * REPLACE ({sql_normalize('responsable')} AS responsable, {sql_normalize('usuariofinal')} AS usuariofinal,
      {sql_normalize('username_resp')} AS username_resp, {sql_normalize('username_ufinal')} AS username_ufinal)
    FROM closed WHERE origen_caso <> 'Service Suite'),
  harmonised AS (SELECT o.* REPLACE (coalesce(u.v, o.username_ufinal) AS username_ufinal, {sql_title('o.usuariofinal')} AS usuariofinal)
    FROM others o LEFT JOIN user_by_name u ON u.k = o.usuariofinal
    UNION ALL SELECT * FROM closed WHERE origen_caso = 'Service Suite'),
  indicators AS (SELECT numero_caso, tipo_de_caso, usuariofinal, responsable, servicio, fecha_creacion, fecha_atencion, fecha_solucion,
    CAST(tiempo AS BIGINT) AS "tiempoTranscurrido", cumple AS "CUMPLE_ANS", origen_caso,
    CASE WHEN servicio = 'Development' THEN 'Software Desk' ELSE proyecto END AS proyecto, username_resp, username_ufinal FROM harmonised)"""


def _consolidated(spark, sf):
    return plan.consolidate(
        sources(spark, sf), identity(spark, sf), rules.service_catalogue(**CATALOGUE), SETTINGS
    )


@query("e1_consolidation", f"{CTES} SELECT * FROM indicators")
def _(spark, sf):
    return _consolidated(spark, sf)


@query(
    "e1_rows_by_origin",
    f"{CTES} SELECT origen_caso, count(*) AS rows FROM indicators WHERE origen_caso IS NOT NULL GROUP BY 1",
)
def _(spark, sf):
    return rows_by(_consolidated(spark, sf))


@query("e1_distinct_services", f"{CTES} SELECT count(DISTINCT servicio) AS distinct_servicio FROM indicators")
def _(spark, sf):
    return distinct_values(_consolidated(spark, sf))


@query(
    "e1_unresolved_rows",
    f"{CTES} SELECT count(CASE WHEN regexp_full_match(trim(username_ufinal), '[0-9]+') THEN 1 END) AS unresolved_rows FROM indicators",
)
def _(spark, sf):
    return unresolved_rows(_consolidated(spark, sf))


INVENTORY_IDS = f"""SELECT t.*, CASE WHEN regexp_full_match(trim(username_ufinal), '[0-9]+') THEN trim(username_ufinal) END AS id FROM ({INVENTORY}) t"""


@query(
    "e1_identity_stats",
    f"""WITH by_id AS ({sql_last(MASTER, 'cedula', LAST)}), by_username AS ({sql_last(MASTER, 'username', LAST_ID)}),
      r AS (SELECT id, m.username AS found, d.account, coalesce(m.nombre, t.usuariofinal) AS usuariofinal, t.responsable, t.username_resp,
              coalesce(m.username, d.account, t.username_ufinal) AS username_ufinal
            FROM ({INVENTORY_IDS}) t LEFT JOIN by_id m ON m.cedula = id LEFT JOIN ({DIRECTORY}) d ON d.employee_id = id AND m.username IS NULL)
    SELECT count(id) AS candidates, count(*) FILTER (id IS NOT NULL AND found IS NOT NULL) AS master,
      count(*) FILTER (id IS NOT NULL AND found IS NULL AND account IS NOT NULL) AS directory,
      count(*) FILTER (id IS NOT NULL AND found IS NULL AND account IS NULL) AS unresolved,
      count(*) FILTER (usuariofinal IS NULL AND u.nombre IS NOT NULL) AS usuariofinal_filled,
      count(*) FILTER (responsable IS NULL AND o.nombre IS NOT NULL) AS responsable_filled
    FROM r LEFT JOIN by_username u ON u.username = lower(trim(r.username_ufinal)) LEFT JOIN by_username o ON o.username = lower(trim(r.username_resp))""",
)
def _(spark, sf):
    """Counted while the job writes its table."""
    out = plan.run_consolidation(
        sources(spark, sf), identity(spark, sf), rules.service_catalogue(**CATALOGUE), scratch_path(spark, "indicators"), SETTINGS
    )
    return out["identity"]


# ---- service reports ------------------------------------------------------------------

EXTENDED_HEADER = (
    "NÚMERO DE CASO", "TIPO DE CASO", "USUARIO FINAL", "ESPECIALISTA", "SERVICIO", "FECHA DE REGISTRO",
    "FECHA ATENCIÓN REAL", "FECHA SOLUCIÓN REAL", "FECHA ESTIMADA ATENCION", "FECHA ESTIMADA SOLUCION",
    "TIEMPO TRANSCURRIDO", "CUMPLIMIENTO ANS", "ORIGEN CASO", "PROYECTO", "LOGIN RESPONSABLE",
    "LOGIN USUARIO FINAL", "ESTADO", "RAZON", "GRUPO ESPECIALISTA", "PRIORIDAD", "SERVICIO AGROS",
    "UBICACION", "AUTOR DEL CASO", "PROGRESO %", "ASUNTO",
)
EXTENDED = f"""
SELECT CASE l_returnflag WHEN 'A' THEN 'incidentes' WHEN 'N' THEN 'requerimientos' ELSE 'cambios' END AS kind,
       'RQ-TI-' || {CASE_ID} AS numero, l_returnflag AS tipo, {person('l_partkey', True)} AS usuario, {person('l_suppkey', True)} AS especialista,
       CASE l_linenumber WHEN 1 THEN 'OLD MAIL' WHEN 2 THEN NULL ELSE 'BANK' END AS servicio,
       {US_DATE} || ' 9:14:30 AM' AS registro, CASE WHEN l_partkey % 6 = 0 THEN NULL ELSE {US_DATE} || ' 13:00:' || CAST(l_linenumber AS STRING) END AS atencion,
       CASE WHEN l_partkey % 10 = 0 THEN NULL ELSE {ISO_DATE} || ' 17:30:00' END AS solucion,
       {US_DATE} || CASE l_partkey % 3 WHEN 0 THEN ' 1:00:01 PM' WHEN 1 THEN ' 2:00:00 PM' ELSE ' 12:00:30 PM' END AS estimada, 'x' AS estimada_sol,
       CASE l_partkey % 3 WHEN 0 THEN CAST(l_linenumber AS STRING) || '.75' WHEN 1 THEN CAST(l_partkey AS STRING) WHEN 2 THEN 'x' END AS tiempo,
       CASE WHEN l_partkey % 2 = 0 THEN 'Cumple' ELSE 'No cumple' END AS ans, 'Mail' AS origen, 'p' AS proyecto,
       's' || CAST(l_suppkey AS STRING) || '@corp' AS login_resp, 'u' || CAST(l_partkey AS STRING) AS login_user,
       'Abierto' AS estado, CASE WHEN l_linenumber = 3 THEN NULL ELSE 'r' END AS razon, 'g' AS grupo, 'alta' AS prioridad,
       CASE WHEN l_linenumber = 4 THEN NULL ELSE 'a' END AS agros, CASE WHEN l_linenumber = 5 THEN NULL ELSE 'b' END AS ubicacion,
       'autor' AS autor, '10' AS progreso, 'asunto' AS asunto
FROM {{lineitem}}
"""
# each export reads its own rows: the filter on the flag reaches the scan
EXTENDED_PARTS = {
    "incidentes": "l_returnflag = 'A'",
    "requerimientos": "l_returnflag = 'N'",
    "cambios": "(l_returnflag IS NULL OR l_returnflag NOT IN ('A', 'N'))",
}


def extended_exports(spark, sf):
    parts = {kind: stand_in(spark, sf, f"{EXTENDED} WHERE {part}") for kind, part in EXTENDED_PARTS.items()}
    return {kind: df.drop("kind").toDF(*EXTENDED_HEADER) for kind, df in parts.items()}


REPORT_SETTINGS = service_reports.ReportSettings(
    defaults={"razon": "Nuevo", "servicio_agros": "No Aplica", "ubicacion": "Sede"}
)
SLACK = sql_minutes(sql_date("atencion"), sql_date("estimada"))


@query(
    "e2a_provisional_report",
    f"""SELECT tipo AS tipo_de_caso, 'Service Suite' AS origen_caso, 'Mesa de Servicios' AS proyecto, numero AS numero_caso, prioridad,
        {SUITE_SERVICE} AS servicio, grupo AS grupo_especialista, especialista AS responsable, split_part(login_resp, '@', 1) AS username_resp,
        usuario AS usuariofinal, split_part(login_user, '@', 1) AS username_ufinal, estado, coalesce(razon, 'Nuevo') AS razon,
        {sql_date('registro')} AS fecha_creacion, {sql_date('estimada')} AS fecha_estimada_atencion, {sql_date('atencion')} AS fecha_atencion,
        {sql_date('solucion')} AS fecha_solucion, {sql_whole(sql_number('tiempo'))} AS "tiempoTranscurrido", ans AS "CUMPLE_ANS",
        coalesce(ubicacion, 'Sede') AS ubicacion, coalesce(agros, 'No Aplica') AS servicio_agros,
        {sql_whole(SLACK)} AS "tiempoTranscurridoAtencion", CASE WHEN {SLACK} > 0 THEN 'SI' ELSE 'NO' END AS "CUMPLE_ANS_ATENCION",
        CASE WHEN {sql_date('solucion')} IS NULL THEN 'Abierto' ELSE 'Cerrado' END AS estado_caso FROM ({EXTENDED}) e""",
)
def _(spark, sf):
    exports = extended_exports(spark, sf)
    return service_reports.provisional_report(exports, rules.service_catalogue(**CATALOGUE), REPORT_SETTINGS)


@query(
    "e2b_task_report",
    f"""SELECT 'Tarea' AS tipo_de_caso, 'Service Suite Tasks' AS origen_caso, 'Mesa de Servicios' AS proyecto,
        relacionado AS "CASO RELACIONADO", numero AS numero_caso, {SUITE_SERVICE} AS servicio, responsable,
        split_part(login_resp, '@', 1) AS username_resp, autor AS usuariofinal, split_part(login_autor, '@', 1) AS username_ufinal,
        estado AS "ESTADO TAREA", {sql_date('registro')} AS fecha_creacion, {sql_date('inicio')} AS fecha_atencion, {sql_date('fin')} AS fecha_solucion,
        {sql_whole(sql_minutes(sql_date('registro'), sql_date('fin')))} AS "tiempoTranscurrido",
        CASE WHEN {sql_number('"real"')} < 0 THEN 'SI' ELSE 'NO' END AS "CUMPLE_ANS" FROM ({TASKS}) t""",
)
def _(spark, sf):
    tasks = _headed(spark, sf, TASKS, TASK_HEADER)
    return service_reports.task_report(tasks, rules.service_catalogue(**CATALOGUE), REPORT_SETTINGS)


@query(
    "e2_row_counts",
    f"""SELECT 'provisional' AS report, count(*) AS rows FROM ({EXTENDED}) e UNION ALL SELECT 'tasks', count(*) FROM ({TASKS}) t""",
)
def _(spark, sf):
    """Counted while both reports are written."""
    exports = extended_exports(spark, sf)
    written = service_reports.run_service_reports(
        exports, _headed(spark, sf, TASKS, TASK_HEADER), rules.service_catalogue(**CATALOGUE), scratch_path(spark, "reports"), REPORT_SETTINGS
    )
    return spark.createDataFrame([(name, w.rows) for name, w in written.items()], "report string, rows bigint")


# ---- profile ----------------------------------------------------------------------------


def _profile(spark, sf):
    itsm = stand_in(spark, sf, ITSM)
    frames = {"inventory": stand_in(spark, sf, INVENTORY), "itsm": itsm, "pages": table(spark, sf, "pages")}
    return profile.profile_sources(frames, "inventory", stand_in(spark, sf, EMPLOYEES))


ID = "CASE WHEN regexp_full_match(trim(username_ufinal), '[0-9]+') THEN trim(username_ufinal) END"


@query(
    "e5_volumetry",
    f"""SELECT 'inventory' AS source, count(*) AS rows, 14 AS columns, count(DISTINCT {ID}) AS distinct_ids FROM ({INVENTORY}) i
        UNION ALL SELECT 'itsm', count(*), 15, count(DISTINCT {ID}) FROM ({ITSM}) o
        UNION ALL SELECT 'pages', count(*), 3, 0 FROM {{pages}}""",
)
def _(spark, sf):
    return _profile(spark, sf)["volumetry"]


@query(
    "e5_id_coverage",
    f"""WITH t AS (SELECT DISTINCT {ID} AS id FROM ({INVENTORY}) i WHERE {ID} IS NOT NULL),
        m AS (SELECT DISTINCT trim(cedula) AS known FROM ({EMPLOYEES}) e WHERE cedula IS NOT NULL),
        c AS (SELECT count(*) AS ids, count(known) AS hit FROM t LEFT JOIN m ON known = id)
        SELECT ids, hit AS in_master, ids - hit AS only_tickets, hit * 100.0 / ids AS coverage_pct FROM c""",
)
def _(spark, sf):
    return _profile(spark, sf)["coverage"]
