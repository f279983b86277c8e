import re
from collections import Counter

import pytest
from pyarrow import parquet

from casemill.operators import compare
from casemill.operators.compare import compare_tables, differing_rows, pair_rows

KEYS = ("origen_caso", "numero_caso")
SCHEMA = "origen_caso string, numero_caso bigint, valor string"


def test_equal(rows):
    df = rows(SCHEMA, ("A", 1, "hola"), ("A", 2, None))
    c = compare_tables(df, df, KEYS)
    assert c.compatible and tuple(c.verdict.first()) == (0, "equal", 0)
    assert c.divergences.count() == 0
    assert {r.column_name: r.total for r in c.summary.collect()} == {k: 0 for k in df.columns}


@pytest.mark.parametrize(
    "left, right, kind",
    [("X", "Y", "value_mismatch"), ("HOLA", "hola", "case_difference"), (None, "x", "null_mismatch")],
)
def test_classes(rows, left, right, kind):
    c = compare_tables(rows(SCHEMA, ("A", 1, left)), rows(SCHEMA, ("A", 1, right)), KEYS)
    row = c.divergences.first()
    assert (row["class"], row.n, row.left_value) == (kind, 1, left or "<NaN>")
    assert c.verdict.first().exit_code == 1


def test_ignore_case(rows):
    c = compare_tables(rows(SCHEMA, ("A", 1, "HOLA")), rows(SCHEMA, ("A", 1, "hola")), KEYS, ignore_case=True)
    assert c.verdict.first().verdict == "equal"


def test_tolerance(rows):
    schema = "origen_caso string, numero_caso bigint, valor double"
    left = rows(schema, ("A", 1, 1.0), ("A", 2, 2.0), ("A", 3, 1000.0), ("A", 4, float("nan")), ("A", 5, float("inf")))
    right = rows(schema, ("A", 1, 1.0005), ("A", 2, 2.5), ("A", 3, 1000.01), ("A", 4, None), ("A", 5, float("inf")))
    assert [(r.left_value, r.right_value) for r in compare_tables(left, right, KEYS).divergences.collect()] == [("2.0", "2.5")]


def test_types_of_different_families(rows):
    left = rows("origen_caso string, numero_caso bigint, valor string", ("A", 1, "1"), ("A", 2, "x"))
    right = rows("origen_caso string, numero_caso int, valor bigint", ("A", 1, 1), ("A", 2, 3))
    c = compare_tables(left, right, KEYS)
    assert [r["class"] for r in c.divergences.collect()] == ["type_mismatch"]
    assert c.verdict.first().verdict == "equal"
    assert {r.column_name: r.same_type for r in c.structure.collect()} == {"origen_caso": True, "numero_caso": False, "valor": False}


def test_incompatible(rows):
    left = rows(SCHEMA, ("A", 1, "x"))
    for right in (
        rows("origen_caso string, numero_caso bigint, otra string", ("A", 1, "x")),
        rows(SCHEMA),
        rows(SCHEMA, ("A", 2, "x")),
    ):
        c = compare_tables(left, right, KEYS)
        assert not c.compatible and c.notes and tuple(c.verdict.first()) == (0, "incompatible", 2)
    assert not compare_tables(left, left, ("absent",)).compatible


def test_columns_left_out(rows):
    left = rows("origen_caso string, numero_caso bigint, `Unnamed: 0` int, nota string", ("A", 1, 5, "x"))
    right = rows("nota string, numero_caso bigint, origen_caso string", ("y", 1, "A"))
    assert compare_tables(left, right, KEYS, ignore=("nota",)).verdict.first().verdict == "equal"


@pytest.mark.parametrize("narrow", [8, 0])
def test_copies_and_hot_keys_against_brute_force(rows, monkeypatch, narrow):
    """One key holds nearly all rows, most of them copies; more than one block of positions."""
    monkeypatch.setattr(compare, "NARROW", narrow)
    left = [("H", 1, "same")] * 9000 + [("H", 1, f"l{i % 700:03}") for i in range(3000)] + [("B", 2, None)] * 5
    right = [("H", 1, "same")] * 4000 + [("H", 1, f"r{i % 900:03}") for i in range(8000)] + [("B", 2, "z")] * 5
    a, b = rows(SCHEMA, *left), rows(SCHEMA, *right)
    pairs = pair_rows(differing_rows(a, b), KEYS)
    got = Counter()
    for r in pairs.collect():
        got[tuple(r.l), tuple(r.r)] += r.n
    order = lambda t: (t[0], t[1], t[2] is not None, t[2] or "")
    only_left = sorted((Counter(left) - Counter(right)).elements(), key=order)
    only_right = sorted((Counter(right) - Counter(left)).elements(), key=order)
    assert got == Counter(zip(only_left, only_right))


@pytest.mark.parametrize("narrow", [8, 0])
def test_hashes_tell_missing_values_and_zeros_apart(rows, monkeypatch, narrow):
    monkeypatch.setattr(compare, "NARROW", narrow)
    schema = "a string, b string, x double"
    left = rows(schema, (None, "v", 0.0), ("v", None, 1.0), ("v", None, 1.0), ("k", "k", -0.0))
    right = rows(schema, ("v", None, 1.0), ("k", "k", 0.0), ("k", "k", float("nan")), (None, None, None))
    got = {(r.a, r.b, r.x, r._side): r._n for r in differing_rows(left, right).collect()}
    assert got == {(None, "v", 0.0, 0): 1, ("v", None, 1.0, 0): 1, ("k", "k", None, 1): 1, (None, None, None, 1): 1}


@pytest.mark.parametrize("k", [1001, 5000, 100_000])
def test_large_k_is_ranked_over_partitions(spark, k):
    """A column of patterns that occur once, and one with repeated counts."""
    from pyspark.sql import functions as F

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "220")
    try:
        one = spark.range(120_000).select(F.lit("once").alias("column_name"), F.md5(F.col("id").cast("string")).alias("left_value"), F.lit("r").alias("right_value"), F.lit("value_mismatch").alias("class"), F.lit(1).cast("bigint").alias("n"))
        two = spark.range(3_000).select(F.lit("many").alias("column_name"), F.col("id").cast("string").alias("left_value"), F.lit("r").alias("right_value"), F.lit("value_mismatch").alias("class"), (F.col("id") % 7 + 1).alias("n"))
        divs = one.unionByName(two)
        top = compare.top_patterns(divs, k)
        got = {c: [r.left_value for r in top.where(F.col("column_name") == c).orderBy("rank").collect()] for c in ("once", "many")}
        want = {c: [r.left_value for r in divs.where(F.col("column_name") == c).orderBy(F.desc("n"), "left_value").limit(k).collect()] for c in ("once", "many")}
        assert got == want
        # one file per task that ordered
        most = max(parquet.read_metadata(f.removeprefix("file:")).num_rows for f in top.inputFiles())
        assert most <= 123_000 / 100
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_pairs_are_dealt_out_by_their_size(spark, rows, monkeypatch):
    """Tasks that pair rows get no more where there are more rows."""
    from casemill.operators import compare
    from casemill.session import cut

    monkeypatch.setattr(compare, "PAIRED_BYTES", 64)
    left = rows("origen_caso string, numero_caso bigint, v string", *[("x", i, "a") for i in range(50)])
    right = rows("origen_caso string, numero_caso bigint, v string", *[("x", i, "b") for i in range(50)])
    pairs = compare.pair_rows(cut(compare.differing_rows(left, right)), ["origen_caso", "numero_caso"])
    dealt = str(pairs._jdf.queryExecution().optimizedPlan())
    found = [int(x) for x in re.findall(r"RepartitionByExpression \[_block\S*\], (\d+)", dealt)]
    assert found and found[0] > int(spark.conf.get("spark.sql.shuffle.partitions")) and pairs.count() == 50
