"""Identity repair: master index, id resolution, display names, override rules."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import BLANKS, lookup_key, only_digits, strip, trim_lower
from ..session import cut
from .lookups import INLINE_RULES, RuleFrame, Rules, RuleTable, fill_if_null, last_wins, look_up, set_columns
from .shape import concat


@dataclass(frozen=True)
class MasterIndex:
    """The master by id and by user name, one row per key."""

    by_id: DataFrame  # cedula, username, nombre
    by_username: DataFrame  # username, nombre, cedula


def build_master_index(*masters: DataFrame) -> MasterIndex:
    """Both directions over the concatenated masters; of equal keys the last row wins.

    Rows are ordered by the master's place in the call, then by name, then by all columns.
    """
    ranked = concat([m.withColumn("_rank", F.lit(i)) for i, m in enumerate(masters)]).select(
        "_rank",
        strip(F.col("NombreCompleto")).alias("nombre"),
        lookup_key(F.col("cedula"), lower=False).alias("cedula"),
        lookup_key(F.col("username")).alias("username"),
    )
    order = ["_rank", "nombre"]
    return MasterIndex(
        by_id=last_wins(ranked, "cedula", order, ["nombre", "username"]),
        by_username=last_wins(ranked, "username", order, ["nombre", "cedula"]),
    )


def build_directory(snapshot: DataFrame) -> DataFrame:
    """Id -> account, one row per id; blank ids are dropped, the greatest account wins."""
    keyed = snapshot.select(
        lookup_key(F.col("employee_id"), lower=False).alias("employee_id"),
        strip(F.col("account")).alias("account"),
    )
    return last_wins(keyed.where(F.col("account") != ""), "employee_id", ["account"], ["account"])


def directory_names(snapshot: DataFrame) -> DataFrame:
    """Account (lower case) -> display name."""
    keyed = snapshot.select(lookup_key(F.col("account")).alias("account"), "display_name")
    return last_wins(keyed, "account", ["display_name"], ["display_name"])


def resolve_ids(
    df: DataFrame,
    index: MasterIndex,
    directory: DataFrame | None = None,
    column: str = "username_ufinal",
    name_column: str = "usuariofinal",
    outcome: str | None = None,
) -> DataFrame:
    """Replace digit-only user names.

    First the master (user name and display name), then the directory for what the master
    left (user name only); ids found nowhere stay. ``outcome`` names an optional column with
    ``master``, ``directory`` or ``unresolved`` for candidates, for the counts of A5.
    """
    id_text = F.when(only_digits(F.col(column)), strip(F.col(column)))
    out, (user, name), helpers = look_up(
        df.withColumn("_id", id_text), index.by_id, F.col("_id"), "cedula", ["username", "nombre"]
    )
    found = [user]
    if directory is not None:
        left = F.when(user.isNull(), F.col("_id"))
        out, (account,), more = look_up(out, directory, left, "employee_id", ["account"])
        found.append(account)
        helpers += more
    values = {column: F.coalesce(*found, F.col(column))}
    if name_column in df.columns:
        values[name_column] = F.coalesce(name, name_column)
    if outcome:
        state = F.when(F.col("_id").isNull(), None).when(user.isNotNull(), "master")
        if directory is not None:
            state = state.when(account.isNotNull(), "directory")
        values[outcome] = state.otherwise("unresolved")
    return set_columns(out, values, ["_id", *helpers])


def fill_display_names(
    df: DataFrame,
    index: MasterIndex,
    pairs=(("usuariofinal", "username_ufinal"), ("responsable", "username_resp")),
) -> DataFrame:
    """Fill missing names by user name; a pair with an absent column is skipped."""
    for name, username in pairs:
        if name in df.columns and username in df.columns:
            df = fill_if_null(
                df, index.by_username, trim_lower(F.col(username)), "username", "nombre", name
            )
    return df


def fill_names_from_directory(
    df: DataFrame, names: DataFrame, name: str = "usuariofinal", username: str = "username_ufinal"
) -> DataFrame:
    """Fill missing names by directory account."""
    return fill_if_null(df, names, trim_lower(F.col(username)), "account", "display_name", name)


@dataclass(frozen=True)
class OverrideRules:
    """The six sections, each with unique keys; ``None`` for an empty section."""

    special_values: Rules | None = None  # match -> username_ufinal
    by_case: Rules | None = None  # numero_caso -> username_ufinal
    by_case_and_origin: Rules | None = None  # case_key(...) -> username_ufinal
    aliases: Rules | None = None  # from -> to
    owner_names: Rules | None = None  # username -> nombre, rules that apply to the owner
    user_names: Rules | None = None  # username -> nombre, rules that apply to the end user
    by_owner: Rules | None = None  # match -> responsable_canonico, username_resp
    by_user: Rules | None = None  # match -> usuariofinal_canonico, username_ufinal
    _composed: dict = field(default_factory=dict, compare=False, repr=False)

    def composed(self, spark: SparkSession, columns: frozenset[str]) -> Composed:
        """The sections as one look-up per key column, made once for each set of columns."""
        key = (spark.sparkContext.applicationId, columns)
        if key not in self._composed:
            self._composed[key] = compose(spark, self, columns)
        return self._composed[key]


def case_key(number: object, origin: object) -> str:
    """The key of a rule for one case of one source."""
    return f"{number}|{origin}"


HIT = ("username", "name")


@dataclass(frozen=True)
class Composed:
    """J13 as look-ups by key column. What a value leads to, through aliases, names by user name
    and canonical names, is followed when the rules are composed, not for every fact: the first
    three give the final user name and, where a section sets it, the final name."""

    cases: RuleTable | None  # numero_caso -> HIT, rules as values only
    cases_of_origin: RuleTable | None  # case_key(...) -> HIT, rules as values only
    case_frame: RuleFrame | None  # numero_caso -> HIT and a map origin -> HIT
    users: Rules | None  # username_ufinal -> HIT
    owners: Rules | None  # username_resp -> HIT
    by_owner: Rules | None
    by_user: Rules | None


def _followed(username: str, aliases: Mapping, names: Mapping, canonical: Mapping) -> tuple[str, str | None]:
    """Where a user name ends: alias, name by user name, canonical name and user name by name."""
    username = aliases.get(username, (username,))[0]
    name = names.get(username, (None,))[0]
    if name is not None:
        name, username = canonical.get(name.strip(BLANKS).lower(), (name, username))
    return username, name


def _rows(table: RuleTable | None) -> Mapping:
    return {} if table is None else table.rows


def _compose_rows(rules: OverrideRules, user_names, owner_names, by_user, by_owner) -> Composed:
    aliases = _rows(rules.aliases)

    def table(key: str, usernames: Mapping[str, str], names, canonical) -> RuleTable | None:
        if not usernames:
            return None
        return RuleTable(key, HIT, {k: _followed(v, aliases, names, canonical) for k, v in usernames.items()})

    def by_value(key: str, special: Mapping, names, canonical) -> RuleTable | None:
        starts = {k: k for k in (*aliases, *names)} | {k: v[0] for k, v in special.items()}
        return table(key, starts, names, canonical)

    user = (_rows(user_names), _rows(by_user))
    first = lambda t: {k: v[0] for k, v in _rows(t).items()}
    return Composed(
        cases=table("numero_caso", first(rules.by_case), *user),
        cases_of_origin=table("key", first(rules.by_case_and_origin), *user),
        case_frame=None,
        users=by_value("value", _rows(rules.special_values), *user),
        owners=by_value("value", {}, _rows(owner_names), _rows(by_owner)),
        by_owner=rules.by_owner,
        by_user=rules.by_user,
    )


def _compose_frames(spark: SparkSession, rules: OverrideRules, user_names, owner_names, by_user, by_owner) -> Composed:
    """The same with joins of rule tables; what comes out is written once, so that Spark knows its
    size wherever it is used."""

    def pairs(table: Rules | None, *names: str) -> DataFrame | None:
        return None if table is None else table.frame(spark).select(table.key, *table.values).toDF(*names)

    def then(df: DataFrame, table: DataFrame | None, on: str, values: Mapping[str, str]) -> DataFrame:
        """Left join; ``values``: column to set -> its new name in the table."""
        if table is None:
            return df
        joined = df.join(table, df[on] == table["_k"], "left")
        kept = [F.coalesce(values[c], c).alias(c) if c in values else F.col(c) for c in df.columns]
        return joined.select(*kept)

    aliases = pairs(rules.aliases, "_k", "_to")

    def followed(df: DataFrame, names: Rules | None, canonical: Rules | None) -> DataFrame:
        df = then(df, aliases, "username", {"username": "_to"}).withColumn("name", F.lit(None).cast("string"))
        df = then(df, pairs(names, "_k", "_name"), "username", {"name": "_name"})
        df = df.withColumn("_by", trim_lower(F.col("name")))
        return then(df, pairs(canonical, "_k", "_name", "_user"), "_by", {"name": "_name", "username": "_user"}).drop("_by")

    def by_value(special: Rules | None, names: Rules | None, canonical: Rules | None) -> RuleFrame | None:
        tables = [t for t in (special, rules.aliases, names) if t is not None]
        if not tables:
            return None
        keys = reduce(DataFrame.union, [t.frame(spark).select(F.col(t.key).alias("value")) for t in tables])
        starts = keys.distinct().withColumn("username", F.col("value"))
        starts = then(starts, pairs(special, "_k", "_to"), "value", {"username": "_to"})
        return RuleFrame("value", HIT, cut(followed(starts, names, canonical)))

    def cases() -> RuleFrame | None:
        number = F.substring_index("key", "|", 1)
        parts = []
        if rules.by_case is not None:
            parts.append(pairs(rules.by_case, "number", "username").withColumn("origin", F.lit(None).cast("string")))
        if rules.by_case_and_origin is not None:
            own = pairs(rules.by_case_and_origin, "key", "username")
            origin = F.expr("substring(key, length(substring_index(key, '|', 1)) + 2)")
            parts.append(own.select(number.alias("number"), "username", origin.alias("origin")))
        if not parts:
            return None
        hits = followed(reduce(DataFrame.unionByName, parts), user_names, by_user)
        hit = F.struct(*HIT)
        by_number = hits.groupBy(F.col("number").alias("numero_caso")).agg(
            F.max(F.when(F.col("origin").isNull(), hit)).alias("any"),
            F.map_from_entries(F.collect_list(F.when(F.col("origin").isNotNull(), F.struct("origin", hit)))).alias("of_origin"),
        )
        return RuleFrame("numero_caso", (*HIT, "of_origin"), cut(by_number.select("numero_caso", "any.username", "any.name", "of_origin")))

    return Composed(
        cases=None,
        cases_of_origin=None,
        case_frame=cases(),
        users=by_value(rules.special_values, user_names, by_user),
        owners=by_value(None, owner_names, by_owner),
        by_owner=rules.by_owner,
        by_user=rules.by_user,
    )


def compose(spark: SparkSession, rules: OverrideRules, columns: frozenset[str]) -> Composed:
    """One look-up per key column for facts with these columns. A section that sets a column the
    facts don't have is left out, as is what would follow from it. A few rules are composed as
    values, many or tables as joins; both give the same."""
    user, owner = "usuariofinal" in columns, "responsable" in columns
    sections = (
        rules.user_names if user else None, rules.owner_names if owner else None,
        rules.by_user if user else None, rules.by_owner if owner else None,
    )
    tables = [t for t in (rules.special_values, rules.by_case, rules.by_case_and_origin, rules.aliases, *sections) if t is not None]
    few = all(isinstance(t, RuleTable) for t in tables) and sum(len(t.rows) for t in tables) <= INLINE_RULES
    return _compose_rows(rules, *sections) if few else _compose_frames(spark, rules, *sections)


def apply_overrides(df: DataFrame, rules: OverrideRules) -> DataFrame:
    """The sections in order, later ones win; sections without their columns are skipped.

    User names by literal value, by case, by alias; names by user name; canonical names and user
    names by name. At most one look-up for each of the five key columns, and one projection.
    """
    has = frozenset(df.columns).__contains__
    shape = frozenset(c for c in ("usuariofinal", "username_ufinal", "responsable", "username_resp") if has(c))
    book = rules.composed(df.sparkSession, shape)
    helpers: list[str] = []
    values: dict[str, Column] = {}

    def hit(table: Rules, key, columns=HIT):
        nonlocal df
        df, found, more = look_up(df, table, key, table.key, columns)
        helpers.extend(more)
        return found

    def side(name: str, username: str, found, by_name: Rules | None, canonical: str) -> None:
        """``found``: (user name, name) by key, the first with a user name counts."""
        user = F.coalesce(*[u for u, _ in found], username) if has(username) else None
        set_name = F.lit(None).cast("string")
        for u, n in reversed(found):
            set_name = F.when(u.isNotNull(), n).otherwise(set_name)
        if has(name):
            own = F.col(name)
            if by_name is not None:
                key = trim_lower(F.col(name))
                shown, account = hit(by_name, F.when(set_name.isNull(), key) if found else key, (canonical, username))
                own = F.coalesce(shown, own)
                user = None if user is None else F.coalesce(account, user)
            if found or by_name is not None:
                values[name] = F.coalesce(set_name, own) if found else own
        if user is not None and (found or (has(name) and by_name is not None)):
            values[username] = user

    found = []
    if has("username_ufinal"):
        if has("numero_caso"):
            if book.case_frame is not None:
                user, name, of_origin = hit(book.case_frame, F.col("numero_caso"), (*HIT, "of_origin"))
                if has("origen_caso"):
                    own = F.try_element_at(of_origin, F.col("origen_caso").cast("string"))
                    found.append((own.getField("username"), own.getField("name")))
                found.append((user, name))
            if book.cases_of_origin is not None and has("origen_caso"):
                found.append(hit(book.cases_of_origin, F.concat(F.col("numero_caso").cast("string"), F.lit("|"), "origen_caso")))
            if book.cases is not None:
                found.append(hit(book.cases, F.col("numero_caso")))
        if book.users is not None:
            found.append(hit(book.users, F.col("username_ufinal")))
    side("usuariofinal", "username_ufinal", found, book.by_user, "usuariofinal_canonico")
    found = [hit(book.owners, F.col("username_resp"))] if has("username_resp") and book.owners is not None else []
    side("responsable", "username_resp", found, book.by_owner, "responsable_canonico")
    return set_columns(df, values, helpers) if values else df
