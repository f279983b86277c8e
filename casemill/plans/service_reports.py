"""The provisional report over all cases, open ones included, and the task report."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import add_elapsed, add_slack, parse_date
from ..functions.flags import add_in_time, ahead_of_estimate, fill_defaults, normalize_sla
from ..functions.flags import open_or_closed
from ..functions.numbers import to_number, whole_minutes, whole_number
from ..functions.text import account_of
from ..operators.lookups import remap_by_rules
from ..operators.shape import align, concat, drop_if_present, rename, with_constants
from ..schemas import PROVISIONAL, TASKS, provisional_schema, tasks_schema
from ..sources.rules import ServiceCatalogue
from ..sources.sinks import write_counted
from .exports import (
    CASE_DATES,
    EXTENDED_CASE_NAMES,
    EXTENDED_DROPPED,
    TASK_DROPPED,
    TASK_NAMES,
    TASK_REAL_TIME,
    USERNAMES,
)


@dataclass(frozen=True)
class ReportSettings:
    """What differs between sites."""

    suite_origin: str = "Service Suite"
    task_origin: str = "Service Suite Tasks"
    desk_project: str = "Mesa de Servicios"
    task_type: str = "Tarea"
    defaults: Mapping[str, str] = field(
        default_factory=lambda: {"razon": "Nuevo o Aprobacion", "servicio_agros": "No Aplica"}
    )


def prepare_cases(df: DataFrame, catalogue: ServiceCatalogue, settings: ReportSettings) -> DataFrame:
    """One extended export. The in-time flag looks at the exact slack, before it is cut."""
    df = drop_if_present(rename(df, EXTENDED_CASE_NAMES), EXTENDED_DROPPED)
    df = with_constants(
        df, {"proyecto": settings.desk_project, "origen_caso": settings.suite_origin}
    )
    dates = (*CASE_DATES, "fecha_estimada_atencion")
    values = {
        **{c: account_of(F.col(c)) for c in USERNAMES if c in df.columns},
        **{c: parse_date(F.col(c)) for c in dates if c in df.columns},
    }
    if "tiempoTranscurrido" in df.columns:
        values["tiempoTranscurrido"] = whole_minutes(F.col("tiempoTranscurrido"))
    df = remap_by_rules(df.withColumns(values), catalogue.suite)
    df = fill_defaults(df, settings.defaults)
    df = add_in_time(add_slack(df, "fecha_estimada_atencion", "fecha_atencion"))
    slack = "tiempoTranscurridoAtencion"
    return df.withColumn(slack, whole_number(F.col(slack)))


def provisional_report(
    exports: Mapping[str, DataFrame],
    catalogue: ServiceCatalogue,
    settings: ReportSettings | None = None,
) -> DataFrame:
    """Incidents, requests and changes; problems do not take part."""
    settings = settings or ReportSettings()
    cases = concat(
        [
            prepare_cases(exports[kind], catalogue, settings)
            for kind in ("incidentes", "requerimientos", "cambios")
        ]
    )
    cases = cases.withColumn("estado_caso", open_or_closed(F.col("fecha_solucion")))
    return align(cases, provisional_schema())


def task_report(
    tasks: DataFrame, catalogue: ServiceCatalogue, settings: ReportSettings | None = None
) -> DataFrame:
    """One row per task with elapsed minutes and the estimate flag."""
    settings = settings or ReportSettings()
    df = drop_if_present(rename(tasks, TASK_NAMES), TASK_DROPPED)
    df = with_constants(
        df,
        {
            "proyecto": settings.desk_project,
            "origen_caso": settings.task_origin,
            "tipo_de_caso": settings.task_type,
        },
    )
    values = {
        **{c: account_of(F.col(c)) for c in USERNAMES if c in df.columns},
        **{c: parse_date(F.col(c)) for c in CASE_DATES},
    }
    if TASK_REAL_TIME in df.columns:
        values["CUMPLE_ANS"] = ahead_of_estimate(to_number(F.col(TASK_REAL_TIME)))
    df = add_elapsed(df.withColumns(values), "fecha_creacion", "fecha_solucion")
    df = df.withColumn("tiempoTranscurrido", whole_number(F.col("tiempoTranscurrido")))
    df = normalize_sla(remap_by_rules(df, catalogue.suite))
    return align(df, tasks_schema())


@dataclass(frozen=True)
class WrittenReport:
    """Where a report stands and how many rows it has."""

    path: str
    rows: int


def run_service_reports(
    exports: Mapping[str, DataFrame],
    tasks: DataFrame,
    catalogue: ServiceCatalogue,
    folder: str,
    settings: ReportSettings | None = None,
) -> dict[str, WrittenReport]:
    """Write both reports; their rows are counted while they are written."""
    reports = {
        "provisional": (provisional_report(exports, catalogue, settings), PROVISIONAL),
        "tasks": (task_report(tasks, catalogue, settings), TASKS),
    }
    written = {}
    for name, (df, columns) in reports.items():
        path, counts = write_counted(df, f"{folder}/{name}", columns)
        written[name] = WrittenReport(path, counts["rows"])
    return written
