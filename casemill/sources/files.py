"""File sources: ticket exports, dictionaries, interim and report tables."""

from __future__ import annotations

import csv
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import parse_date
from ..operators.quality import SchemaError, check_fingerprint
from . import quoted

# Cell texts that mean "missing" in the exports.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Columns an export must have.
SUITE_CASE_COLUMNS = ("CUMPLIMIENTO ANS", "LOGIN RESPONSABLE", "LOGIN USUARIO FINAL")
SUITE_TASK_COLUMNS = (
    "NUMERO DE LA TAREA", "RESPONSABLE TAREA", "LOGIN AUTOR TAREA", "ESTADO TAREA",
)
EXTENDED_CASE_COLUMNS = ("LOGIN RESPONSABLE", "GRUPO ESPECIALISTA", "AUTOR DEL CASO")
EXTENDED_PROBLEM_COLUMNS = ("AUTOR DEL CASO", "LOGIN RESPONSABLE", "ESTADO")
HELPDESK_COLUMNS = ("id", "TITULO", "SOLICITANTE", "ESTADO", "FECHA_APERTURA")
REQUEST_COLUMNS = ("Número de solicitud", "Fecha de creación", "Autor", "Usuario que Gestiona")
CASE_NUMBER_NAMES = ("NúMERO DE CASO", "NÚMERO DE CASO")
SUITE_FILES = {
    "incidentes": SUITE_CASE_COLUMNS,
    "requerimientos": SUITE_CASE_COLUMNS,
    "cambios": SUITE_CASE_COLUMNS,
    "tareas": SUITE_TASK_COLUMNS,
}
EXTENDED_FILES = {
    "incidentes": EXTENDED_CASE_COLUMNS,
    "requerimientos": EXTENDED_CASE_COLUMNS,
    "cambios": EXTENDED_CASE_COLUMNS,
    "problemas": EXTENDED_PROBLEM_COLUMNS,
}


def distinct_names(names: Sequence[str]) -> list[str]:
    """Repeated header names get ``.1``, ``.2``, ... in file order."""
    seen: dict[str, int] = {}
    out = []
    for name in names:
        n = seen.get(name, 0)
        seen[name] = n + 1
        out.append(f"{name}.{n}" if n else name)
    return out


def file_order() -> Column:
    """A row's place: file by path, split by its start, row within the split. Spark itself deals
    large files out first, so a row number alone doesn't follow the files' order."""
    return F.struct(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("row"),
    )


def _header_cells(line: str | None, sep: str) -> list[str]:
    return next(csv.reader([(line or "").lstrip("\ufeff")], delimiter=sep), [])


def check_one_header(spark: SparkSession, path: str) -> None:
    """Refuse a folder whose files have different first lines; one scan that keeps a line a file."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("row"),
        F.ltrim("value", F.lit("\ufeff")).alias("line"),
    )
    heads = (
        lines.where("start = 0").groupBy("path").agg(F.min_by("line", "row").alias("line"))
        .groupBy("line").agg(F.min("path").alias("path")).orderBy("path").limit(2).collect()
    )
    if len(heads) > 1:
        raise SchemaError(f"{heads[0].path} and {heads[1].path} have different headers")


def _spark_csv(spark, path, sep, names, multi_line, compared) -> DataFrame:
    """Spark's own reader; with ``multi_line`` a file is read in one task."""
    if not compared:
        check_one_header(spark, path)
    return (
        spark.read.schema(T.StructType([T.StructField(n, T.StringType()) for n in names]))
        .option("header", True)
        .option("sep", sep)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("enforceSchema", not compared)
        .csv(path)
    )


def read_csv(
    spark: SparkSession,
    path: str,
    sep: str = ",",
    columns: Sequence[str] | None = None,
    multi_line: bool = True,
    row_order: bool = False,
    split: bool = True,
) -> DataFrame:
    """Every column as text, by place in the file.

    ``columns`` are the names in file order (default: the header, made distinct). Quoted cells
    may hold separators and, with ``multi_line``, line breaks; files are split either way.
    ``row_order`` adds ``_row`` for rules like "the last row wins". Since cells go by place, files of
    a folder whose headers differ are refused.

    Reading line breaks in parallel takes quotes to mark cells only (see ``quoted``) and a header of
    one line. ``split=False`` leaves files with loose quotes to Spark's own reader, one task a file.
    Names that look like repeated ones (``a.1``) make it compare the headers by a scan beforehand.
    """
    first = spark.read.option("lineSep", "\n").text(path).first()
    line = (first.value if first else "").lstrip("\ufeff").removesuffix("\r")
    header = distinct_names(_header_cells(line, sep))
    names = list(columns) if columns else header
    if multi_line and split and first:
        if line.count('"') % 2:
            raise SchemaError(f"{path}: a header with line breaks, read it with split=False")
        df = quoted.read_quoted(spark, path, line, names, sep, row_order=row_order)
    else:
        compared = not columns and not any(re.search(r"\.\d+$", n) for n in header)
        df = _spark_csv(spark, path, sep, names, multi_line, compared)
        if row_order:
            df = df.select("*", file_order().alias("_row"))
    cells = [
        F.when(~F.col(f"`{n}`").isin(*NA_TOKENS), F.col(f"`{n}`")).alias(n) for n in names
    ]
    return df.select(*cells, "_row") if row_order else df.select(*cells)


def _case_export(spark: SparkSession, path: str, required: Sequence[str], multi_line: bool) -> DataFrame:
    df = check_fingerprint(read_csv(spark, path, multi_line=multi_line), required, path)
    if "NUMERO DE LA TAREA" not in required and not set(CASE_NUMBER_NAMES) & set(df.columns):
        raise ValueError(f"{path}: no case number column, one of {CASE_NUMBER_NAMES}")
    return df


def read_suite_exports(
    spark: SparkSession, paths: Mapping[str, str], multi_line: bool = True
) -> dict[str, DataFrame]:
    """The four exports of the service suite."""
    return {k: _case_export(spark, paths[k], need, multi_line) for k, need in SUITE_FILES.items()}


def read_extended_exports(
    spark: SparkSession, paths: Mapping[str, str], multi_line: bool = True
) -> dict[str, DataFrame]:
    """The four extended exports; ``problemas`` is read for its row count only."""
    return {k: _case_export(spark, paths[k], need, multi_line) for k, need in EXTENDED_FILES.items()}


def read_helpdesk(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, multi_line: bool = True
) -> DataFrame:
    """S3: semicolons, quoted cells with line breaks, a repeated header name."""
    df = read_csv(spark, path, ";", columns, multi_line)
    return check_fingerprint(df, HELPDESK_COLUMNS, path)


def read_requests(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The request table; its dates are typed already."""
    return check_fingerprint(spark.read.format(fmt).load(path), REQUEST_COLUMNS, path)


def read_user_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """User name -> end user, in file order."""
    df = read_csv(spark, path, multi_line=False, row_order=True)
    return check_fingerprint(df, ("username_ufinal", "usuariofinal"), path)


def read_specialist_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """User name -> specialist, in file order."""
    df = read_csv(spark, path, multi_line=False, row_order=True)
    return check_fingerprint(df, ("username_resp", "responsable"), path)


def read_report(
    spark: SparkSession,
    path: str,
    dates: Sequence[str] = ("fecha_creacion", "fecha_atencion", "fecha_solucion"),
) -> DataFrame:
    """A report table read back; date columns that came as text are parsed."""
    return with_parsed_dates(spark.read.parquet(path), dates)


def with_parsed_dates(df: DataFrame, dates: Sequence[str]) -> DataFrame:
    """Parse those of the columns that are text; bad text becomes NULL."""
    types = dict(df.dtypes)
    return df.withColumns(
        {
            c: parse_date(F.col(c)) if types[c] == "string" else F.col(c).cast("timestamp_ntz")
            for c in dates
        }
    )


def read_interim(spark: SparkSession, path: str) -> DataFrame:
    """An interim table."""
    return spark.read.parquet(path)
