"""Override rules as a few values, as many and as tables: the same rows as one section after another."""

import random

import pytest

from casemill.operators import identity, lookups
from casemill.operators.quality import RuleError
from casemill.sources import rules

COLUMNS = ("numero_caso", "origen_caso", "usuariofinal", "username_ufinal", "responsable", "username_resp")
FACTS = "numero_caso bigint, origen_caso string, usuariofinal string, username_ufinal string, responsable string, username_resp string"


def invented(seed, n=12):
    rng = random.Random(seed)
    user = lambda: f"u{rng.randrange(9)}"
    name = lambda: rng.choice([f"Name {rng.randrange(6)}", "ÁNA", " Blank "])
    return {
        "patrones_especiales": [{"match": rng.choice([user(), "10.0.0.9"]), "username_ufinal": user()} for _ in range(n // 4)],
        "por_numero_caso": [
            {"numero_caso": rng.randrange(30), "username_ufinal": user(), **({"origen_caso": rng.choice("AB|")} if rng.random() < 0.5 else {})}
            for _ in range(n)
        ],
        "por_username_alias": [{"from": user(), "to": user()} for _ in range(n // 3)],
        "nombres_por_username": [
            {"username": user(), "nombre": name(), "aplica_a": rng.choice([["responsable"], ["usuariofinal"], ["responsable", "usuariofinal"]])}
            for _ in range(n // 3)
        ],
        "por_responsable": [{"match": name(), "responsable_canonico": name(), "username_resp": user()} for _ in range(n // 3)],
        "por_usuariofinal": [{"match": name(), "usuariofinal_canonico": name(), "username_ufinal": user()} for _ in range(n // 3)],
    }


def invented_facts(seed, n=200):
    rng = random.Random(seed)
    text = lambda *more: rng.choice([None, "", *[f"u{i}" for i in range(9)], *more])
    name = lambda: rng.choice([None, "", "name 1", " Name 2 ", "ána", "blank", "Name 5", "other"])
    return [(rng.choice([None, *range(30)]), rng.choice([None, "A", "B", "|"]), name(), text("10.0.0.9"), name(), text()) for i in range(n)]


def one_after_another(sections, fact, columns):
    f = dict(zip(COLUMNS, fact))
    f = {c: f[c] for c in columns}
    last = lambda name, key, value: {e[key]: e[value] for e in sections[name]}
    clean = lambda t: None if t is None else t.strip().lower()
    if "username_ufinal" in f:
        f["username_ufinal"] = last("patrones_especiales", "match", "username_ufinal").get(f["username_ufinal"], f["username_ufinal"])
        for with_origin in (False, True):
            for e in sections["por_numero_caso"]:
                own = e.get("origen_caso")
                if "numero_caso" in f and e["numero_caso"] == f["numero_caso"] and (own is not None) == with_origin:
                    if not with_origin or ("origen_caso" in f and own == f["origen_caso"]):
                        f["username_ufinal"] = e["username_ufinal"]
    for c in ("username_ufinal", "username_resp"):
        if c in f:
            f[c] = last("por_username_alias", "from", "to").get(f[c], f[c])
    for name, username in (("responsable", "username_resp"), ("usuariofinal", "username_ufinal")):
        if name in f and username in f:
            for e in sections["nombres_por_username"]:
                if name in e["aplica_a"] and e["username"] == f[username]:
                    f[name] = e["nombre"]
    for section, name, canonical, username in (
        ("por_responsable", "responsable", "responsable_canonico", "username_resp"),
        ("por_usuariofinal", "usuariofinal", "usuariofinal_canonico", "username_ufinal"),
    ):
        if name in f:
            hits = {clean(e["match"]): e for e in sections[section] if clean(e["match"])}
            hit = hits.get(clean(f[name]))
            if hit:
                f[name] = hit[canonical]
                if username in f:
                    f[username] = hit[username]
    return tuple(f[c] for c in columns)


def as_tables(spark, sections):
    def table(name, schema, *fields):
        rows = [(*[e.get(f) for f in fields], i) for i, e in enumerate(sections[name])]
        return spark.createDataFrame(rows, f"{schema}, _row int")

    return rules.override_tables(
        special_values=table("patrones_especiales", "match string, username_ufinal string", "match", "username_ufinal"),
        aliases=table("por_username_alias", "`from` string, `to` string", "from", "to"),
        by_owner=table("por_responsable", "match string, responsable_canonico string, username_resp string", "match", "responsable_canonico", "username_resp"),
        by_user=table("por_usuariofinal", "match string, usuariofinal_canonico string, username_ufinal string", "match", "usuariofinal_canonico", "username_ufinal"),
        by_case=table("por_numero_caso", "numero_caso bigint, username_ufinal string, origen_caso string", "numero_caso", "username_ufinal", "origen_caso"),
        names=table("nombres_por_username", "username string, nombre string, aplica_a array<string>", "username", "nombre", "aplica_a"),
    )


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_every_way_gives_the_rows_of_the_sections_in_order(spark, monkeypatch, seed):
    sections, facts = invented(seed), invented_facts(seed + 10)
    df = spark.createDataFrame(facts, FACTS)
    want = sorted((one_after_another(sections, f, COLUMNS) for f in facts), key=repr)
    for book, inline in ((rules.override_rules(sections), 128), (rules.override_rules(sections), 0), (as_tables(spark, sections), 128)):
        monkeypatch.setattr(identity, "INLINE_RULES", inline)
        monkeypatch.setattr(lookups, "INLINE_RULES", inline)
        out = identity.apply_overrides(df, book)
        assert out.columns == list(COLUMNS)
        assert sorted(map(tuple, out.collect()), key=repr) == want


@pytest.mark.parametrize("without", [("usuariofinal",), ("username_ufinal",), ("responsable", "origen_caso"), ("username_resp", "numero_caso")])
def test_sections_without_their_columns(spark, monkeypatch, without):
    sections, facts = invented(4), invented_facts(5)
    left = [c for c in COLUMNS if c not in without]
    df = spark.createDataFrame(facts, FACTS).drop(*without)
    want = sorted((one_after_another(sections, f, left) for f in facts), key=repr)
    for inline in (128, 0):
        monkeypatch.setattr(identity, "INLINE_RULES", inline)
        got = identity.apply_overrides(df, rules.override_rules(sections))
        assert sorted(map(tuple, got.collect()), key=repr) == want


def test_many_rules_take_one_join_per_key_column(spark):
    sections = invented(6)
    sections["por_numero_caso"] += [{"numero_caso": 100 + i, "username_ufinal": f"c{i}", "origen_caso": "A" if i % 2 else None} for i in range(50_000)]
    facts = invented_facts(7) + [(50_099, "A", None, "x", None, None), (50_098, "B", None, "x", None, None), (50_097, "B", None, "x", None, None)]
    out = identity.apply_overrides(spark.createDataFrame(facts, FACTS), rules.override_rules(sections))
    assert sorted(map(tuple, out.collect()), key=repr) == sorted((one_after_another(sections, f, COLUMNS) for f in facts), key=repr)
    joins = out._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter")
    assert joins <= 5


def test_blank_and_numeric_keys_are_the_same_in_lists_and_tables(spark):
    entries = [("", "blank"), ("1", "one"), ("10000000000", "ten"), ("7", "seven")]
    listed = [{"from": "", "to": "blank"}, {"from": 1, "to": "one"}, {"from": 1e10, "to": "ten"}, {"from": 7.0, "to": "seven"}]
    facts = spark.createDataFrame([(k,) for k in ["", " ", "1", "10000000000", "7", None, "1.0"]], "servicio string")
    number = spark.createDataFrame([(1.0, "one"), (1e10, "ten"), (7.0, "seven")], "`from` double, `to` string")
    text = spark.createDataFrame(entries, "`from` string, `to` string")
    many = [*listed, *[{"from": f"x{i}", "to": "y"} for i in range(lookups.INLINE_RULES)]]
    want = ["", " ", "1.0", None, "one", "seven", "ten"]
    for given in (listed, many, number, text):
        out = lookups.remap_by_rules(facts, rules.replacement_rules(given))
        assert sorted((r.servicio for r in out.collect()), key=lambda v: (v is None, v or "")) == sorted(want, key=lambda v: (v is None, v or ""))
    with pytest.raises(RuleError, match="fractional"):
        rules.replacement_rules([{"from": 1.5, "to": "x"}])
    half = spark.createDataFrame([(1.5, "x")], "`from` double, `to` string")
    with pytest.raises(Exception, match="fractional"):
        lookups.remap_by_rules(facts, rules.replacement_rules(half)).collect()


def test_rule_tables_are_checked(spark):
    bad = spark.createDataFrame([("x", "u")], "numero_caso string, username_ufinal string")
    with pytest.raises(RuleError, match="no case number"):
        rules.override_tables(by_case=bad)
    bad = spark.createDataFrame([("u", "n", ["servicio"])], "username string, nombre string, aplica_a array<string>")
    with pytest.raises(RuleError, match="aplica_a"):
        rules.override_tables(names=bad)
