"""Text exports: written as several files with quoted line breaks, read back by their readers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.positions import range_partitions
from ..operators.quality import check_fingerprint
from ..session import scratch_path, shuffles_go
from ..sources import files
from .base import query, stand_in
from .jobs import EXTENDED, EXTENDED_HEADER, SUITE, SUITE_HEADER, SUITE_TASKS, TASK_HEADER

# cells with quotes, separators, line breaks and words that mean "missing"
TEXT_CELLS = """
SELECT CAST(doc_id AS STRING) AS doc_id, lang, source,
       CASE CAST(doc_id AS BIGINT) % 4 WHEN 0 THEN 'N/A' WHEN 1 THEN 'a "quoted" one, with; both'
         WHEN 2 THEN 'two' || chr(10) || 'lines' ELSE source END AS cell,
       text
FROM {documents}
"""
TEXT_CELLS_READ = f"""
SELECT doc_id, lang, source, nullif(cell, 'N/A') AS cell, text FROM ({TEXT_CELLS}) t
"""


# what one file should hold by the planner's estimate; texts are several times as long as their tables
FILE_BYTES = 8 << 20
# of gzip: twice as fast as its default, for files a fifth larger
LEVEL = "THREE"


def file_count(df: DataFrame, least: int) -> int:
    """How many files the rows ask for, ``least`` at the least."""
    return max(least, range_partitions(df, FILE_BYTES, 1))


def write_csv(df: DataFrame, name: str, sep: str = ",", parts: int = 1, compression: str | None = None) -> str:
    """A folder of CSV files, all cells quoted: ``parts`` of them, or as many as the rows ask for; by
    default as many as ``df`` has partitions."""
    path = scratch_path(df.sparkSession, name)
    df = df.repartition(file_count(df, parts)) if parts > 1 else df
    out = df.write.option("header", True).option("sep", sep).option("escape", '"').option("quoteAll", True)
    with shuffles_go(df.sparkSession):
        (out.option("compression", compression).option("zlib.compress.level", LEVEL) if compression else out).csv(path)
    return path


def _joined(exports: dict[str, DataFrame]) -> DataFrame:
    """kind, number and all cells of each export's rows in one text, in file order."""
    parts = []
    for kind, df in exports.items():
        cells = F.concat_ws("|", *[F.coalesce(F.col(f"`{c}`"), F.lit("~")) for c in df.columns])
        parts.append(df.select(F.lit(kind).alias("kind"), F.col(f"`{df.columns[0]}`").alias("number"), cells.alias("cells")))
    return reduce(DataFrame.unionByName, parts)


def sql_joined(columns) -> str:
    """The same text in SQL; texts that mean "missing" are none."""
    return " || '|' || ".join(f"coalesce(CASE WHEN {c} IN ('', 'None', 'N/A') THEN NULL ELSE {c} END, '~')" for c in columns)


SUITE_CELLS = ("numero", "tipo", "usuario", "especialista", "servicio", "creacion", "atencion", "solucion", "tiempo", "ans", "origen", "proyecto", "login_resp", "login_user")
TASK_CELLS = ("numero", "tipo", "autor", "servicio", "responsable", "registro", "inicio", "fin", "origen", "proyecto", "login_resp", "login_autor", "relacionado", "nombre", "estado", '"real"')
# names over several lines, cells with quotes and separators
SUITE_TEXT = f"SELECT * REPLACE (usuario || CASE WHEN length(numero) % 3 = 0 THEN chr(10) || 'second \"line\"; x' ELSE '' END AS usuario) FROM ({SUITE}) s"
TASK_TEXT = f"SELECT * REPLACE (CASE WHEN length(numero) % 2 = 0 THEN 'a, \"b\"' || chr(10) || 'c' ELSE 'N/A' END AS nombre) FROM ({SUITE_TASKS}) t"


def _suite_text(spark, sf) -> dict[str, DataFrame]:
    cases = stand_in(spark, sf, SUITE)
    broken = F.when(F.length("numero") % 3 == 0, F.lit('\nsecond "line"; x')).otherwise("")
    cases = cases.withColumn("usuario", F.concat("usuario", broken))
    tasks = stand_in(spark, sf, SUITE_TASKS)
    tasks = tasks.withColumn("nombre", F.when(F.length("numero") % 2 == 0, F.lit('a, "b"\nc')).otherwise("N/A"))
    kinds = ("incidentes", "requerimientos", "cambios")
    return {**{k: cases.where(cases.kind == k).drop("kind").toDF(*SUITE_HEADER) for k in kinds}, "tareas": tasks.toDF(*TASK_HEADER)}


@query(
    "s1_suite_exports",
    f"""SELECT kind, numero AS number, {sql_joined(SUITE_CELLS)} AS cells FROM ({SUITE_TEXT}) c
        UNION ALL SELECT 'tareas', numero, {sql_joined(TASK_CELLS)} FROM ({TASK_TEXT}) t""",
)
def _(spark, sf):
    paths = {k: write_csv(df, k, parts=3) for k, df in _suite_text(spark, sf).items()}
    return _joined(files.read_suite_exports(spark, paths))


@query("s1_comma_export", TEXT_CELLS_READ)
def _(spark, sf):
    path = write_csv(stand_in(spark, sf, TEXT_CELLS), "export", parts=3)
    return check_fingerprint(files.read_csv(spark, path), ("doc_id", "cell"), path)


EXTENDED_CELLS = (
    "numero", "tipo", "usuario", "especialista", "servicio", "registro", "atencion", "solucion", "estimada", "estimada_sol", "tiempo", "ans",
    "origen", "proyecto", "login_resp", "login_user", "estado", "razon", "grupo", "prioridad", "agros", "ubicacion", "autor", "progreso", "asunto",
)
# the subject holds a line break, the reason a text that means "missing"
EXTENDED_TEXT = f"""
SELECT * REPLACE (CASE WHEN length(numero) % 2 = 0 THEN 'first' || chr(10) || '"second", third' ELSE asunto END AS asunto,
                  CASE WHEN razon IS NULL THEN 'None' ELSE razon END AS razon) FROM ({EXTENDED}) e
"""
PROBLEMS = """
SELECT CAST(o_orderkey AS STRING) AS numero, o_orderstatus AS autor, CASE WHEN o_orderkey % 5 = 0 THEN 'None' ELSE o_orderpriority END AS login,
       o_orderpriority || chr(10) || '"x"' AS estado FROM {orders}
"""
PROBLEM_HEADER = ("NúMERO DE CASO", "AUTOR DEL CASO", "LOGIN RESPONSABLE", "ESTADO")


def _extended_text(spark, sf, parts: int | None = None) -> dict[str, DataFrame]:
    cases = stand_in(spark, sf, EXTENDED, parts)
    cases = cases.withColumn("asunto", F.when(F.length("numero") % 2 == 0, F.lit('first\n"second", third')).otherwise(F.col("asunto")))
    cases = cases.withColumn("razon", F.coalesce("razon", F.lit("None")))
    frames = {k: cases.where(cases.kind == k).drop("kind").toDF(*EXTENDED_HEADER) for k in ("incidentes", "requerimientos", "cambios")}
    return {**frames, "problemas": stand_in(spark, sf, PROBLEMS, parts).toDF(*PROBLEM_HEADER)}


@query(
    "s2_extended_export",
    f"""SELECT kind, numero AS number, {sql_joined(EXTENDED_CELLS)} AS cells FROM ({EXTENDED_TEXT}) c
        UNION ALL SELECT 'problemas', numero, {sql_joined(("numero", "autor", "login", "estado"))} FROM ({PROBLEMS}) p""",
)
def _(spark, sf):
    paths = {}
    for kind, df in _extended_text(spark, sf).items():
        # the text is many times as long as the tables' rows: those are dealt out, and the files, each
        # small enough for one task, are compressed
        dealt = _extended_text(spark, sf, file_count(df, 2))[kind]
        paths[kind] = write_csv(dealt, kind, compression="gzip")
    return _joined(files.read_extended_exports(spark, paths))


@query(
    "s3_semicolon_export",
    f"""SELECT doc_id AS id, cell AS "TITULO", lang AS "SOLICITANTE", source AS "ESTADO", text AS "FECHA_APERTURA",
        lang AS "TIEMPO_SOLUCION", source AS "TIEMPO_SOLUCION.1" FROM ({TEXT_CELLS_READ}) r""",
)
def _(spark, sf):
    names = ["id", "TITULO", "SOLICITANTE", "ESTADO", "FECHA_APERTURA", "TIEMPO_SOLUCION", "TIEMPO_SOLUCION.1"]
    order = ["doc_id", "cell", "lang", "source", "text", "lang", "source"]
    raw = stand_in(spark, sf, TEXT_CELLS)
    raw = raw.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(order)])
    return files.read_helpdesk(spark, write_csv(raw, "semicolon", ";", parts=3), names)


@query(
    "s9_dictionary_file",
    "SELECT 'u' || CAST(c_custkey AS VARCHAR) AS username_ufinal, c_name AS usuariofinal FROM {customer}",
)
def _(spark, sf):
    rows = stand_in(spark, sf, "SELECT 'u' || CAST(c_custkey AS STRING) AS username_ufinal, c_name AS usuariofinal FROM {customer}")
    return files.read_user_dictionary(spark, write_csv(rows, "usuarios", parts=3)).drop("_row")


@query(
    "s9_specialist_dictionary",
    """SELECT 's' || CAST(s_suppkey AS VARCHAR) AS username_resp, CASE WHEN s_suppkey % 3 > 0 THEN s_name END AS responsable
       FROM {supplier}""",
)
def _(spark, sf):
    rows = stand_in(
        spark, sf, "SELECT 's' || CAST(s_suppkey AS STRING) AS username_resp, CASE WHEN s_suppkey % 3 > 0 THEN s_name ELSE 'NULL' END AS responsable FROM {supplier}"
    )
    return files.read_specialist_dictionary(spark, write_csv(rows, "especialistas", parts=3)).drop("_row")
