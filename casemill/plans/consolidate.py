"""Five ticket sources to one consolidated table of closed cases."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.dates import add_elapsed, parse_date
from ..functions.flags import ahead_of_estimate, always, fill_by_category, normalize_sla, sla_word
from ..functions.numbers import fixed_minutes, parse_duration, to_integer, to_number
from ..functions.numbers import whole_minutes, whole_number
from ..functions.text import (
    account_of,
    last_line,
    normalize_or_null,
    normalize_text,
    only_digits,
    remap,
    remove_literal,
    reorder_name,
    title_case,
    top_service,
    trim_lower,
)
from ..operators.filters import only_where, other_origin, require_values, without_marker
from ..operators.identity import (
    MasterIndex,
    OverrideRules,
    apply_overrides,
    build_directory,
    build_master_index,
    fill_display_names,
    resolve_ids,
)
from ..operators.lookups import (
    forward_dictionary,
    inverse_dictionary,
    overwrite,
    remap_by_rules,
    replace_if_found,
)
from ..operators.metrics import distinct_values, rows_by
from ..operators.shape import align, aligned_concat, column_or, concat, drop_if_present, rename
from ..operators.shape import with_constants
from ..schemas import INDICATORS, indicators_schema
from ..sources.rules import ServiceCatalogue
from ..sources.sinks import write_counted, write_snapshots
from .exports import (
    CASE_DATES,
    HELPDESK_DROPPED,
    HELPDESK_NAMES,
    REQUEST_NAMES,
    SUITE_CASE_NAMES,
    TASK_DROPPED,
    TASK_NAMES,
    TASK_REAL_TIME,
    USERNAMES,
)


@dataclass(frozen=True)
class Settings:
    """What differs between sites. Names and categories are the site's own."""

    inventory_origin: str = "Inventory"
    helpdesk_origin: str = "Helpdesk"
    requests_origin: str = "Requests"
    suite_origin: str = "Service Suite"
    support_project: str = "Soporte"
    desk_project: str = "Mesa de Servicios"
    request_type: str = "Requerimiento"
    task_type: str = "Tarea"
    request_prefix: str = "SO-"
    suite_prefixes: Mapping[str, str] = field(
        default_factory=lambda: {
            "incidentes": "IN-TI-", "requerimientos": "RQ-TI-", "cambios": "CM-TI-",
        }
    )
    dropped_marker: str = "RF-COM"
    case_types: Mapping[str, str] = field(
        default_factory=lambda: {"INCIDENCIA": "Incidente", "REQUERIMIENTO": "Requerimiento"}
    )
    helpdesk_services: Mapping[str, str] = field(default_factory=dict)
    owner_spellings: Mapping[str, str] = field(default_factory=dict)
    names_in_order: Sequence[str] = ()
    user_by_category: Sequence[tuple[str, str]] = ()
    owner_by_category: Sequence[tuple[str, str]] = ()


@dataclass(frozen=True)
class Identity:
    """The lookups the sources share."""

    index: MasterIndex
    directory: DataFrame | None
    users_by_username: DataFrame
    owners_by_username: DataFrame
    usernames_by_user: DataFrame
    usernames_by_owner: DataFrame
    overrides: OverrideRules


def build_identity(
    employees: DataFrame,
    users: DataFrame,
    user_dictionary: DataFrame,
    specialist_dictionary: DataFrame,
    overrides: OverrideRules,
    directory: DataFrame | None = None,
) -> Identity:
    """The second master stands after the first, so it wins where both know a key."""
    return Identity(
        index=build_master_index(employees, users),
        directory=None if directory is None else build_directory(directory),
        users_by_username=forward_dictionary(user_dictionary, "username_ufinal", "usuariofinal"),
        owners_by_username=forward_dictionary(specialist_dictionary, "username_resp", "responsable"),
        usernames_by_user=inverse_dictionary(user_dictionary, "username_ufinal", "usuariofinal"),
        usernames_by_owner=inverse_dictionary(specialist_dictionary, "username_resp", "responsable"),
        overrides=overrides,
    )


# ---- the five sources ----------------------------------------------------------


def _typed(df: DataFrame) -> DataFrame:
    """Canonical types for a source that arrives under canonical names."""
    types = dict(df.dtypes)
    values: dict[str, Column] = {}
    for c in CASE_DATES:
        if types.get(c) == "string":
            values[c] = parse_date(F.col(c))
    if types.get("numero_caso") == "string":
        values["numero_caso"] = to_integer(F.col("numero_caso"))
    if "tiempoTranscurrido" in types:
        cut = whole_minutes if types["tiempoTranscurrido"] == "string" else whole_number
        values["tiempoTranscurrido"] = cut(F.col("tiempoTranscurrido"))
    return df.withColumns(values) if values else df


def prepare_inventory(
    df: DataFrame, identity: Identity, settings: Settings, seen: Observation | None = None
) -> DataFrame:
    """Ids to user names, missing names, overrides; then names come from the dictionaries alone.

    ``seen`` gets the counts of A5 while the rows go by: candidates, where they were found, and
    names filled.
    """
    outcome = "_outcome" if seen is not None else None
    df = resolve_ids(_typed(df), identity.index, identity.directory, outcome=outcome)
    if seen is None:
        df = fill_display_names(df, identity.index)
    else:
        df, counts = _with_outcomes(df, identity, outcome)
        df = df.observe(seen, *counts).drop(outcome, *_MISSING)
    df = apply_overrides(df, identity.overrides)
    df = overwrite(
        df, identity.owners_by_username, normalize_text(F.col("username_resp")), "key", "value",
        "responsable",
    )
    df = overwrite(
        df, identity.users_by_username, normalize_text(F.col("username_ufinal")), "key", "value",
        "usuariofinal",
    )
    return df.fillna({"origen_caso": settings.inventory_origin})


_MISSING = ("_no_usuariofinal", "_no_responsable")


def _with_outcomes(df: DataFrame, identity: Identity, outcome: str) -> tuple[DataFrame, list[Column]]:
    """Names filled in rows whose ids are resolved, and the counts of A5 over them."""
    names = [c for c in ("usuariofinal", "responsable") if c in df.columns]
    df = df.withColumns({f"_no_{c}": F.col(c).isNull() for c in names})
    df = fill_display_names(df, identity.index)
    found = [F.count_if(F.col(outcome) == v).alias(v) for v in ("master", "directory", "unresolved")]
    filled = [F.count_if(F.col(f"_no_{c}") & F.col(c).isNotNull()).alias(f"{c}_filled") for c in names]
    return df, [F.count(outcome).alias("candidates"), *found, *filled]


def identity_counts(inventory: DataFrame, identity: Identity) -> DataFrame:
    """A5: one row with the candidates, where they were found, and names filled, in one pass."""
    resolved = resolve_ids(_typed(inventory), identity.index, identity.directory, outcome="_outcome")
    df, counts = _with_outcomes(resolved, identity, "_outcome")
    return df.agg(*counts)


def _observed(seen: Observation, otherwise: DataFrame) -> dict[str, int]:
    """What was counted while the rows went by. Where no row of a branch gets past it, Spark may
    drop the branch at run time and its counts with it; then they are counted by themselves."""
    try:
        found = seen.get
    except Py4JJavaError:
        found = otherwise.first().asDict()
    return {name: int(value) for name, value in found.items()}


def prepare_itsm(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Changes, requests and incidents as they come."""
    return concat([_typed(frames[k]) for k in ("cambios", "requerimientos", "incidentes")])


def prepare_helpdesk(df: DataFrame, identity: Identity, settings: Settings) -> DataFrame:
    df = rename(drop_if_present(df, HELPDESK_DROPPED), HELPDESK_NAMES)
    df = df.withColumns(
        {
            **{c: parse_date(F.col(c)) for c in CASE_DATES},
            "CUMPLE_ANS": sla_word(F.col("CUMPLE_ANS"), invert=True),
            "usuariofinal": fill_by_category(
                F.col("usuariofinal"), F.col("servicio"), settings.user_by_category
            ),
            "responsable": fill_by_category(
                F.col("responsable"), F.col("servicio"), settings.owner_by_category
            ),
        }
    )
    df = require_values(df, "responsable", "fecha_atencion")

    def name(c: str) -> Column:
        return reorder_name(last_line(F.col(c)), settings.names_in_order)

    df = df.withColumns(
        {
            "numero_caso": to_integer(remove_literal(F.col("numero_caso"), " ")),
            "tiempoTranscurrido": whole_number(parse_duration(F.col("tiempoTranscurrido"))),
            "responsable": name("responsable"),
            "usuariofinal": name("usuariofinal"),
            "servicio": remap(top_service(F.col("servicio")), settings.helpdesk_services),
        }
    )
    df = with_constants(
        df,
        {
            "proyecto": settings.support_project,
            "origen_caso": settings.helpdesk_origin,
            "username_ufinal": "",
            "username_resp": "",
        },
    )
    df = _names_to_usernames(df, identity, trim_lower)
    return df.withColumn("tipo_de_caso", remap(F.col("tipo_de_caso"), settings.case_types))


def prepare_requests(df: DataFrame, identity: Identity, settings: Settings) -> DataFrame:
    df = require_values(rename(df, REQUEST_NAMES), "responsable")
    if "Proyecto" in df.columns:
        df = column_or(df, "Proyecto", settings.support_project, "proyecto")
    else:
        df = column_or(df, "proyecto", settings.support_project)
    df = column_or(df, "tipo_de_caso", settings.request_type)
    number = remove_literal(F.col("numero_caso").cast("string"), settings.request_prefix)
    df = df.withColumns(
        {
            "tiempoTranscurrido": fixed_minutes(),
            "CUMPLE_ANS": always(),
            "numero_caso": to_integer(number),
            "username_ufinal": F.lit(""),
            "username_resp": F.lit(""),
            "origen_caso": F.lit(settings.requests_origin),
        }
    )
    return _names_to_usernames(df, identity, normalize_or_null)


def _names_to_usernames(df: DataFrame, identity: Identity, clean) -> DataFrame:
    """Overrides, clean the names, user names from the names, overrides once more."""
    df = apply_overrides(df, identity.overrides)
    df = df.withColumns(
        {"usuariofinal": clean(F.col("usuariofinal")), "responsable": clean(F.col("responsable"))}
    )
    df = replace_if_found(
        df, identity.usernames_by_owner, F.col("responsable"), "key", "value", "username_resp"
    )
    df = replace_if_found(
        df, identity.usernames_by_user, F.col("usuariofinal"), "key", "value", "username_ufinal"
    )
    return apply_overrides(df, identity.overrides)


def prepare_suite(
    frames: Mapping[str, DataFrame], catalogue: ServiceCatalogue, settings: Settings
) -> DataFrame:
    cases = []
    for kind, prefix in settings.suite_prefixes.items():
        df = rename(frames[kind], SUITE_CASE_NAMES)
        df = with_constants(
            df, {"proyecto": settings.desk_project, "origen_caso": settings.suite_origin}
        )
        df = df.withColumn("numero_caso", remove_literal(F.col("numero_caso"), prefix))
        if kind == "requerimientos":
            df = without_marker(df, "numero_caso", settings.dropped_marker)
        values = {
            **{c: account_of(F.col(c)) for c in USERNAMES if c in df.columns},
            **{c: parse_date(F.col(c)) for c in CASE_DATES if c in df.columns},
            "tiempoTranscurrido": whole_minutes(F.col("tiempoTranscurrido")),
            "numero_caso": to_integer(F.col("numero_caso")),
        }
        cases.append(df.withColumns(values))
    tasks = prepare_suite_tasks(frames["tareas"], settings)
    return remap_by_rules(concat([*cases, tasks]), catalogue.suite)


def prepare_suite_tasks(df: DataFrame, settings: Settings) -> DataFrame:
    df = drop_if_present(
        rename(df, TASK_NAMES), [*TASK_DROPPED, "CASO RELACIONADO", "ESTADO TAREA"]
    )
    df = with_constants(
        df,
        {
            "proyecto": settings.desk_project,
            "origen_caso": settings.suite_origin,
            "tipo_de_caso": settings.task_type,
        },
    )
    values = {
        **{c: account_of(F.col(c)) for c in USERNAMES if c in df.columns},
        **{c: parse_date(F.col(c)) for c in CASE_DATES},
        "numero_caso": to_integer(F.col("numero_caso")),
    }
    if TASK_REAL_TIME in df.columns:
        values["CUMPLE_ANS"] = ahead_of_estimate(to_number(F.col(TASK_REAL_TIME)))
    df = add_elapsed(df.withColumns(values), "fecha_creacion", "fecha_solucion")
    df = df.withColumn("tiempoTranscurrido", whole_number(F.col("tiempoTranscurrido")))
    return df.drop(TASK_REAL_TIME)


# ---- consolidation -------------------------------------------------------------


def finalise(
    frames: Mapping[str, DataFrame],
    identity: Identity,
    catalogue: ServiceCatalogue,
    settings: Settings,
) -> DataFrame:
    """Align, concatenate, harmonise. Rows without a service or with an open date go first:
    no later step sets or clears those columns."""
    df = aligned_concat(frames, indicators_schema())
    df = require_values(df, "servicio", "fecha_atencion", "fecha_solucion")
    df = remap_by_rules(df, catalogue.general)
    df = remap_by_rules(
        df, catalogue.projects, "servicio", "proyecto", "match_servicio", "proyecto"
    )
    df = normalize_sla(df)
    others = other_origin(settings.suite_origin)

    def identity_text(c: Column, column: str) -> Column:
        return F.when(others, normalize_or_null(c)).otherwise(c).alias(column)

    df = df.withColumns(
        {
            "tipo_de_caso": title_case(F.col("tipo_de_caso")),
            "responsable": identity_text(
                remap(F.col("responsable"), settings.owner_spellings), "responsable"
            ),
            "usuariofinal": identity_text(F.col("usuariofinal"), "usuariofinal"),
            **{c: identity_text(account_of(F.col(c)), c) for c in USERNAMES},
        }
    )
    df = replace_if_found(
        df, identity.usernames_by_user, F.col("usuariofinal"), "key", "value", "username_ufinal",
        only=others,
    )
    shown = only_where(others, title_case(F.col("usuariofinal")), "usuariofinal")
    df = df.withColumns(
        {
            "usuariofinal": shown,
            "tiempoTranscurrido": F.coalesce("tiempoTranscurrido", F.lit(0).cast("bigint")),
        }
    )
    return align(df, indicators_schema())


@dataclass(frozen=True)
class Sources:
    """Raw inputs of the job."""

    inventory: DataFrame
    itsm: Mapping[str, DataFrame]
    helpdesk: DataFrame
    requests: DataFrame
    suite: Mapping[str, DataFrame]


def prepare_all(
    sources: Sources,
    identity: Identity,
    catalogue: ServiceCatalogue,
    settings: Settings,
    seen: Observation | None = None,
) -> dict[str, DataFrame]:
    return {
        "inventory": prepare_inventory(sources.inventory, identity, settings, seen),
        "itsm": prepare_itsm(sources.itsm),
        "helpdesk": prepare_helpdesk(sources.helpdesk, identity, settings),
        "requests": prepare_requests(sources.requests, identity, settings),
        "suite": prepare_suite(sources.suite, catalogue, settings),
    }


def consolidate(
    sources: Sources, identity: Identity, catalogue: ServiceCatalogue, settings: Settings | None = None
) -> DataFrame:
    """E1 as one lazy DataFrame."""
    settings = settings or Settings()
    frames = prepare_all(sources, identity, catalogue, settings)
    return finalise(frames, identity, catalogue, settings)


def run_consolidation(
    sources: Sources,
    identity: Identity,
    catalogue: ServiceCatalogue,
    output: str,
    settings: Settings | None = None,
    snapshots: str | None = None,
) -> dict[str, DataFrame]:
    """Write the table. Rows, unresolved rows and the identity counts are taken while it is
    written; the others read the one written column that they need."""
    settings = settings or Settings()
    seen = Observation("identity")
    frames = prepare_all(sources, identity, catalogue, settings, seen)
    result = finalise(frames, identity, catalogue, settings)
    unresolved = F.count_if(only_digits(F.col("username_ufinal")))
    _, counts = write_counted(result, output, INDICATORS, unresolved=unresolved)
    if snapshots:
        write_snapshots(frames, snapshots, "consolidation")
    spark = result.sparkSession
    written = spark.read.parquet(output)

    def row(values: Mapping[str, int]) -> DataFrame:
        return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} bigint" for k in values))

    return {
        "indicators": written,
        "total_rows": row({"total_rows": counts["rows"]}),
        "identity": row(_observed(seen, identity_counts(sources.inventory, identity))),
        "rows_by_origin": rows_by(written),
        "distinct_services": distinct_values(written),
        "unresolved": row({"unresolved_rows": counts["unresolved"]}),
    }
