from datetime import datetime

import pytest
from pyspark.sql import functions as F

from casemill.operators import filters, identity, lookups, metrics, positions, quality, shape
from casemill.schemas import INDICATORS, indicators_schema, provisional_schema
from casemill.sources import rules


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_schema_copies_are_fresh():
    first = indicators_schema()
    first.add("x", "string")
    assert tuple(indicators_schema().names) == INDICATORS
    assert dict(zip(provisional_schema().names, provisional_schema().fields))["numero_caso"].dataType.simpleString() == "string"


def test_align(rows):
    df = rows("servicio string, extra int, numero_caso int", ("Mail", 1, 7))
    out = shape.align(df, indicators_schema())
    assert out.columns == list(INDICATORS)
    assert out.first().numero_caso == 7 and out.first().proyecto is None
    assert shape.extra_columns(df, indicators_schema()) == ["extra"]
    filled = shape.align(df.drop("numero_caso"), indicators_schema(), fill="0")
    assert filled.first().numero_caso == 0 and filled.first().proyecto == "0"


def test_align_empty(rows):
    assert shape.align(rows("a string"), indicators_schema()).count() == 0


def test_rename_merges_in_map_order(rows):
    df = rows("A string, b string, c string", (None, "x", "1"), ("y", "z", "2"))
    out = shape.rename(df, {"a": "n", "B": "n", "absent": "q"})
    assert out.columns == ["n", "c"] and [r.n for r in out.collect()] == ["x", "y"]


def test_rename_onto_an_existing_name(rows):
    out = shape.rename(rows("Proyecto string, id int", ("p", 1)), {"Proyecto": "proyecto", "id": "numero_caso"})
    assert out.columns == ["proyecto", "numero_caso"]


def test_column_or_in_other_case(rows):
    df = rows("Proyecto string", ("p",), (None,))
    assert [r.proyecto for r in shape.column_or(df, "Proyecto", "d", "proyecto").collect()] == ["p", None]
    assert shape.column_or(df, "tipo", "d").first().tipo == "d"


def test_period_bounds(rows):
    df = rows(
        "t timestamp_ntz",
        (datetime(2025, 1, 1),), (datetime(2025, 12, 31),), (datetime(2025, 12, 31, 10),), (None,),
    )
    assert filters.in_period(df, "t", "2025-01-01", "2025-12-31").count() == 2
    assert filters.in_period(df, "t", "2025-01-01", "2025-12-31", end_inclusive_day=True).count() == 3


def test_marker_filter_keeps_null(rows):
    df = rows("n string", ("RF-COM-9",), ("x",), (None,))
    assert [r.n for r in filters.without_marker(df, "n", "RF-COM").collect()] == ["x", None]


MASTER = "cedula string, username string, NombreCompleto string"


@pytest.fixture()
def index(rows):
    first = rows(
        MASTER, ("100200", "aperez", "Ana Peña"), ("100200", "ana.p", "Ana Peña R"), (None, None, "No Key"),
        ("  100400 ", " BLUZ ", "Luz Díaz"), ("5", "old", "Zoe"),
    )
    second = rows(MASTER, ("5", "new", "Abe"), (" ", "", "Blank"))
    return identity.build_master_index(first, second)


def test_last_row_wins(index):
    by_id = {r.cedula: r.username for r in index.by_id.collect()}
    assert by_id == {"100200": "ana.p", "100400": "bluz", "5": "new"}
    assert {r.username: r.nombre for r in index.by_username.collect()}["bluz"] == "Luz Díaz"


TICKET = "numero_caso bigint, usuariofinal string, username_ufinal string, responsable string, username_resp string"


def test_resolution_chain(rows, index):
    directory = identity.build_directory(
        rows("employee_id string, account string, display_name string", ("100300", "dir3", "D"), ("5", "no", "N"), ("", "b", "B"))
    )
    tickets = rows(
        TICKET, (1, None, "100200", None, None), (2, "Ana", " 100300 ", None, None), (3, None, "999999", None, None),
        (4, "x", "10.0.0.9", None, None), (5, "old name", "5", None, None), (6, None, None, None, " BLUZ"),
    )
    out = identity.resolve_ids(tickets, index, directory, outcome="how")
    assert out.columns == [*tickets.columns, "how"]
    got = {r.numero_caso: (r.username_ufinal, r.usuariofinal, r.how) for r in out.collect()}
    assert got == {
        1: ("ana.p", "Ana Peña R", "master"), 2: ("dir3", "Ana", "directory"), 3: ("999999", None, "unresolved"),
        4: ("10.0.0.9", "x", None), 5: ("new", "Abe", "master"), 6: (None, None, None),
    }
    stats = metrics.id_outcomes(out, "how").first()
    assert tuple(stats) == (4, 2, 1, 1)
    named = identity.fill_display_names(out.drop("how"), index)
    assert {r.numero_caso: r.responsable for r in named.collect()}[6] == "Luz Díaz"


def test_overrides(rows):
    book = rules.override_rules(
        {
            "patrones_especiales": [{"match": "VALOR", "username_ufinal": "u"}],
            "por_numero_caso": [{"numero_caso": "100", "username_ufinal": "case"}],
            "por_username_alias": [{"from": "u", "to": "alias"}],
            "nombres_por_username": [{"username": "alias", "nombre": "Named", "aplica_a": ["usuariofinal"]}],
            "por_responsable": [{"match": " Juan P ", "responsable_canonico": "Juan Pérez", "username_resp": "jp"}],
            "por_usuariofinal": [{"match": "named", "usuariofinal_canonico": "Final", "username_ufinal": "fin"}],
        }
    )
    df = rows(TICKET, (1, "a", "VALOR", "JUAN P", "z"), (100, "b", "VALOR", "x", "u"), (2, "c", "valor", None, None))
    out = identity.apply_overrides(df, book)
    assert out.columns == df.columns
    assert [tuple(r) for r in out.orderBy("numero_caso").collect()] == [
        (1, "Final", "fin", "Juan Pérez", "jp"), (2, "c", "valor", None, None), (100, "b", "case", "x", "alias"),
    ]
    assert "Join" not in plan_of(out)


def test_overrides_skip_absent_columns(rows):
    book = rules.override_rules({"por_responsable": [{"match": "x", "responsable_canonico": "X", "username_resp": "xu"}]})
    assert identity.apply_overrides(rows("otra string", ("dato",)), book).columns == ["otra"]
    assert identity.apply_overrides(rows("responsable string", ("X",)), book).first().responsable == "X"


@pytest.mark.parametrize("n", [2, lookups.INLINE_RULES, lookups.INLINE_RULES + 1, 50_000])
def test_any_number_of_rules_gives_the_same_rows(rows, n):
    odd = "a\x1fb\x1ec"
    many = [{"from": odd, "to": "old"}, *[{"from": str(i), "to": f"t{i}"} for i in range(n - 2)], {"from": odd, "to": "n\x1few"}]
    df = rows("servicio string, numero_caso bigint", (odd, 1), ("x", 2), (None, 3), ("A\x1fb\x1ec", 4))
    want = [(odd.replace(odd, "n\x1few"), 1), ("x", 2), (None, 3), ("A\x1fb\x1ec", 4)]
    out = lookups.remap_by_rules(df, rules.replacement_rules(many))
    assert [tuple(r) for r in out.orderBy("numero_caso").collect()] == want
    table = rows("`from` string, `to` string, _row int", *[(e["from"], e["to"], i) for i, e in enumerate(many)])
    out = lookups.remap_by_rules(df, rules.replacement_rules(table))
    assert [tuple(r) for r in out.orderBy("numero_caso").collect()] == want


def test_large_lookup_is_not_broadcast_and_null_keys_spread(spark, rows):
    """Beyond the size limit a sort-merge join runs; rows without a key do not share one task."""
    facts = spark.range(20000).select(
        F.col("id").alias("numero_caso"), F.when(F.col("id") % 10 == 0, F.col("id").cast("string")).alias("k")
    )
    lookup = spark.range(20000).select(F.col("id").cast("string").alias("key"), F.lit("hit").alias("value"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = lookups.replace_if_found(facts.withColumn("t", F.lit("old")), lookup, F.col("k"), "key", "value", "t")
        assert "SortMergeJoin" in plan_of(out)
        got = out.select("t", F.spark_partition_id().alias("p"))
        assert got.where("t = 'hit'").count() == 2000 and got.count() == 20000
        joined, _, _ = lookups.look_up(facts, lookup, F.col("k"), "key", ["value"])
        spread = joined.where("k IS NULL").select(F.countDistinct("_key0")).first()[0]
        assert spread == 18000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_dictionaries_follow_the_file(rows):
    df = rows("u string, n string, _row bigint", ("Ú1", "A", 0), ("u1", "B", 1), ("Ú1", "C", 2), (None, "D", 3))
    # "u1" came up later than "Ú1", so it wins although "Ú1" was written again afterwards
    assert [tuple(r) for r in lookups.forward_dictionary(df, "u", "n").collect()] == [("u1", "B")]
    inverse = lookups.inverse_dictionary(df, "u", "n")
    assert {r.key: r.value for r in inverse.collect()} == {"c": "ú1", "b": "u1"}


def test_positions_are_dense_and_ordered(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("k"))
    out = positions.add_positions(df, ["k"]).collect()
    assert all(r.k == r.position for r in out) and len(out) == 1000


def test_weighted_positions(rows):
    df = rows("k int, w bigint", *[(i, i % 3 + 1) for i in range(50)])
    out = {r.k: r.p for r in positions.add_positions(df, ["k"], "p", weight="w").collect()}
    assert out == {i: sum(j % 3 + 1 for j in range(i)) for i in range(50)}


def test_codes_sort_times_with_null_last(rows):
    df = rows("t timestamp_ntz", (datetime(2025, 1, 2),), (datetime(2025, 1, 1, 0, 0, 0, 5),), (datetime(2025, 1, 1),), (None,))
    codes = positions.category_codes(df, ["t"])
    out = {r.t: r.code for r in positions.encode(df, codes, "t", "code").collect()}
    assert out == {datetime(2025, 1, 1): 0, datetime(2025, 1, 1, 0, 0, 0, 5): 1, datetime(2025, 1, 2): 2, None: 3}


def test_checks(rows):
    df = rows("a string, b string", ("x", "2026-01-01 00:00:00"))
    assert quality.check_fingerprint(df, ["a"], "s") is df
    with pytest.raises(quality.SchemaError, match="c"):
        quality.check_fingerprint(df, ["c"], "s")
    with pytest.raises(quality.SchemaError):
        quality.check_exact(df, ["a"], "t")
    assert quality.check_exact(df, ["b", "a"], "t").columns == ["b", "a"]
    assert quality.require_parsed(df, "b") is df
    with pytest.raises(ValueError, match="x"):
        quality.require_parsed(df, "a")


def test_rule_checks():
    with pytest.raises(quality.RuleError, match="missing"):
        rules.replacement_rules([{"from": "a"}])
    with pytest.raises(quality.RuleError):
        rules.override_rules({"por_numero_caso": [{"numero_caso": "x", "username_ufinal": "u"}]})
    with pytest.raises(quality.RuleError, match="unknown"):
        rules.override_rules({"nombres_por_username": [{"username": "u", "nombre": "n", "aplica_a": ["servicio"]}]})
    with pytest.raises(quality.RuleError):
        rules.override_rules({"nombres_por_username": [{"username": "u", "nombre": "n", "aplica_a": []}]})
    assert rules.override_rules({}).by_owner is None
    pending = [{"match": "a", "validacion_pendiente": True}, {"match": "b"}]
    assert rules.pending_entries(pending) == ["a"]


def test_rule_violations_raise(rows):
    table = rows("match string", ("a",), (None,))
    found = quality.rule_violations(table, ["match"])
    with pytest.raises(quality.RuleError, match="missing match"):
        quality.require_no_violations(found, "section")


def test_empty_coverage(rows):
    ids = rows("id string")
    assert metrics.id_coverage(ids, ids).first().coverage_pct == 0.0


def test_a_hot_key_is_split(spark):
    """A third of the facts under one key and a lookup too large to broadcast."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        facts = spark.range(0, 300000, 1, 8).select(
            F.col("id").alias("numero_caso"),
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
            F.lit("old").alias("t"),
        )
        lookup = spark.range(200000).select(
            F.when(F.col("id") == 0, "hot").otherwise(F.col("id").cast("string")).alias("key"), F.lit("hit").alias("value")
        )
        out = lookups.replace_if_found(facts, lookup, F.col("k"), "key", "value", "t")
        hits = {r.t: r["count"] for r in out.groupBy("t").count().collect()}
        counted = out.select("numero_caso", "t")
        counted.collect()
        assert "skew=true" in plan_of(counted)
        # ids 1..199999 not divisible by three, and the hot third
        assert hits == {"hit": 100000 + 133333, "old": 300000 - 233333}
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
