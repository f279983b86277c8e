"""Rule tables: the service catalogue, project rules and identity overrides.

Entries come as a list the driver holds or as a DataFrame of any size. Both are checked and reduced
to one row per key; the last entry wins, in list order or by the column ``_row``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import BLANKS, trim_lower
from ..operators.identity import OverrideRules, case_key
from ..operators.lookups import RuleFrame, Rules, RuleTable, last_wins
from ..operators.quality import RuleError
from .files import file_order

TARGETS = ("responsable", "usuariofinal")
Entries = Iterable[Mapping] | DataFrame


def read_rule_entries(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Entries of a JSON-lines or CSV rule file or folder; ``_row`` is their order."""
    reader = spark.read.option("header", True) if fmt == "csv" else spark.read
    return reader.format(fmt).load(path).select("*", file_order().alias("_row"))


def _need(entries: Iterable[Mapping], section: str, *fields: str) -> list[dict]:
    checked = []
    for i, entry in enumerate(entries):
        missing = [f for f in fields if entry.get(f) is None]
        if missing:
            raise RuleError(f"{section}[{i}]: missing {missing}")
        checked.append(dict(entry))
    return checked


def _needed(entries: DataFrame, section: str, *fields: str) -> DataFrame:
    """The same check for a table: one pass, only counts reach the driver."""
    absent = [f for f in fields if f not in entries.columns]
    if absent:
        raise RuleError(f"{section}: missing {absent}")
    empty = entries.agg(*[F.count_if(F.col(f).isNull()).alias(f) for f in fields]).first()
    found = {f: empty[f] for f in fields if empty[f]}
    if found:
        raise RuleError(f"{section}: rows without {found}")
    return entries


def _text(value: object) -> str:
    """A rule's cell as text: whole numbers in digits, truth values in lower case."""
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, (float, Decimal)):
        if value != value // 1:
            raise RuleError(f"{value}: fractional numbers are no rule texts")
        return str(int(value))
    return str(value)


def _text_column(df: DataFrame, column: str) -> Column:
    """The same for a table's column."""
    c, kind = F.col(f"`{column}`"), dict(df.dtypes)[column]
    if kind in ("float", "double") or kind.startswith("decimal"):
        refused = F.raise_error(F.concat(c.cast("string"), F.lit(": fractional numbers are no rule texts")))
        return F.when(c != F.floor(c), refused).otherwise(c.cast("decimal(38,0)").cast("string")).alias(column)
    return c.cast("string").alias(column)


def _table(entries: Iterable[Mapping] | DataFrame, key: str, *values: str) -> Rules:
    """One row per key, the last one; blank keys match nothing and are dropped."""
    if isinstance(entries, DataFrame):
        rows = entries if "_row" in entries.columns else entries.withColumn("_row", F.lit(0))
        texts = rows.select("_row", *[_text_column(rows, c) for c in (key, *values)])
        return RuleFrame(key, values, last_wins(texts, key, ["_row"], values))
    rows = {_text(e[key]): tuple(_text(e[v]) for v in values) for e in entries}
    rows.pop("", None)
    return RuleTable(key, values, rows)


def _checked(entries: Entries, section: str, *fields: str) -> list[dict] | DataFrame:
    check = _needed if isinstance(entries, DataFrame) else _need
    return check(entries, section, *fields)


def replacement_rules(entries: Entries, section: str = "rules") -> Rules:
    """From -> to."""
    return _table(_checked(entries, section, "from", "to"), "from", "to")


def project_rules(entries: Entries) -> Rules:
    """match_servicio -> proyecto."""
    entries = _checked(entries, "project rules", "match_servicio", "proyecto")
    return _table(entries, "match_servicio", "proyecto")


def pending_entries(entries: Iterable[Mapping]) -> list[str]:
    """Q4: what still has to be confirmed; such entries are applied all the same."""
    return [str(e["match"]) for e in entries if e.get("validacion_pendiente")]


def override_rules(sections: Mapping[str, Iterable[Mapping]]) -> OverrideRules:
    """The six sections under the names they have in the rule file, as entries the driver
    holds; ``override_tables`` takes tables.

    Keys of the two match sections are trimmed and lowercased. A rule by case number may name
    an ``origen_caso``; without one it holds for all sources.
    """

    def entries(name, *fields):
        return _need(sections.get(name) or [], name, *fields)

    def table(rows, key, *values):
        return _table(rows, key, *values) if rows else None

    cases = entries("por_numero_caso", "numero_caso", "username_ufinal")
    for i, e in enumerate(cases):
        try:
            e["numero_caso"] = int(e["numero_caso"])
        except (TypeError, ValueError) as error:
            raise RuleError(f"por_numero_caso[{i}]: {error}") from error
    of_one_source = [e for e in cases if e.get("origen_caso") is not None]
    for e in of_one_source:
        e["key"] = case_key(e["numero_caso"], e["origen_caso"])

    names = entries("nombres_por_username", "username", "nombre", "aplica_a")
    for i, e in enumerate(names):
        if isinstance(e["aplica_a"], str) or not e["aplica_a"]:
            raise RuleError(f"nombres_por_username[{i}]: aplica_a must be a filled list")
        unknown = [t for t in e["aplica_a"] if t not in TARGETS]
        if unknown:
            raise RuleError(f"nombres_por_username[{i}]: unknown targets {unknown}")

    def named(target):
        return table([e for e in names if target in e["aplica_a"]], "username", "nombre")

    def matched(name, canonical, username):
        rows = entries(name, "match", canonical, username)
        for e in rows:
            e["match"] = _text(e["match"]).strip(BLANKS).lower()
        return table(rows, "match", canonical, username)

    special = entries("patrones_especiales", "match", "username_ufinal")
    return OverrideRules(
        special_values=table(special, "match", "username_ufinal"),
        by_case=table(
            [e for e in cases if e.get("origen_caso") is None], "numero_caso", "username_ufinal"
        ),
        by_case_and_origin=table(of_one_source, "key", "username_ufinal"),
        aliases=table(entries("por_username_alias", "from", "to"), "from", "to"),
        owner_names=named("responsable"),
        user_names=named("usuariofinal"),
        by_owner=matched("por_responsable", "responsable_canonico", "username_resp"),
        by_user=matched("por_usuariofinal", "usuariofinal_canonico", "username_ufinal"),
    )


def _whole_numbers(cases: DataFrame) -> DataFrame:
    """Case numbers as whole numbers, whatever they are written as."""
    number = F.trim(F.col("numero_caso").cast("string"))
    bad = cases.where(number.try_cast("bigint").isNull() | number.contains(".")).select(number).limit(1).collect()
    if bad:
        raise RuleError(f"por_numero_caso: {bad[0][0]} is no case number")
    return cases.withColumn("numero_caso", number.cast("bigint"))


def _known_targets(names: DataFrame) -> DataFrame:
    unknown = F.array_except("aplica_a", F.lit(list(TARGETS)))
    bad = names.where((F.size("aplica_a") <= 0) | (F.size(unknown) > 0)).select("username").limit(1).collect()
    if bad:
        raise RuleError(f"nombres_por_username: {bad[0][0]} needs aplica_a, a filled list of {TARGETS}")
    return names


def override_tables(
    special_values: DataFrame | None = None,
    aliases: DataFrame | None = None,
    by_owner: DataFrame | None = None,
    by_user: DataFrame | None = None,
    by_case: DataFrame | None = None,
    names: DataFrame | None = None,
) -> OverrideRules:
    """The six sections as tables of any size, with the columns of ``override_rules``.

    ``by_case`` may have a column ``origen_caso``, ``names`` has ``aplica_a`` as an array. The last
    row of a key by ``_row`` wins, without it the greatest.
    """

    def table(df, section, key, *values):
        return None if df is None else _table(_needed(df, section, key, *values), key, *values)

    def matched(df):
        return None if df is None else df.withColumn("match", trim_lower(F.col("match")))

    of_any = of_origin = None
    if by_case is not None:
        cases = _whole_numbers(_needed(by_case, "por_numero_caso", "numero_caso", "username_ufinal"))
        if "origen_caso" in cases.columns:
            key = F.concat(F.col("numero_caso").cast("string"), F.lit("|"), F.col("origen_caso").cast("string"))
            of_origin = _table(cases.where("origen_caso IS NOT NULL").withColumn("key", key), "key", "username_ufinal")
            cases = cases.where("origen_caso IS NULL")
        of_any = _table(cases, "numero_caso", "username_ufinal")

    def named(target):
        if names is None:
            return None
        of_target = _known_targets(_needed(names, "nombres_por_username", "username", "nombre", "aplica_a"))
        return _table(of_target.where(F.array_contains("aplica_a", target)), "username", "nombre")

    return OverrideRules(
        special_values=table(special_values, "patrones_especiales", "match", "username_ufinal"),
        by_case=of_any,
        by_case_and_origin=of_origin,
        aliases=table(aliases, "por_username_alias", "from", "to"),
        owner_names=named("responsable"),
        user_names=named("usuariofinal"),
        by_owner=table(matched(by_owner), "por_responsable", "match", "responsable_canonico", "username_resp"),
        by_user=table(matched(by_user), "por_usuariofinal", "match", "usuariofinal_canonico", "username_ufinal"),
    )


@dataclass(frozen=True)
class ServiceCatalogue:
    """The general catalogue, the suite's own, and the project rules."""

    general: Rules
    suite: Rules
    projects: Rules


def service_catalogue(
    general: Entries = (),
    suite: Entries = (),
    projects: Entries = (),
) -> ServiceCatalogue:
    return ServiceCatalogue(
        general=replacement_rules(general, "general catalogue"),
        suite=replacement_rules(suite, "suite catalogue"),
        projects=project_rules(projects),
    )
