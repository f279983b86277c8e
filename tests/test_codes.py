"""Codes of categories, one of which holds most rows."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from casemill.operators import positions


def codes_of(values):
    order = sorted({v for v in values if v is not None})
    return {**{v: i for i, v in enumerate(order)}, None: len(order)}


@pytest.mark.parametrize("small", [positions.SMALL_DICTIONARY, 0])
def test_heavy_missing_and_light_categories(spark, monkeypatch, small):
    monkeypatch.setattr(positions, "SMALL_DICTIONARY", small)
    monkeypatch.setattr(positions, "HEAVY_PART", 20)
    values = ["hot"] * 9000 + [None] * 3000 + [f"k{i % 700}" for i in range(2000)]
    rows = [(i, v, None if i % 2 else "even") for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "id int, v string, w string").withColumn("rows", F.lit(1))
    codes = positions.counted_codes(df, ["v", "w"])
    assert {r.value: r.rows for r in codes.table.where("column_name = 'v'").collect()} == Counter(values)
    out = positions.encode_columns(df, codes, {"v": "v", "w": "w_code"})
    assert out.columns == ["id", "v", "w", "rows", "w_code"]
    want = codes_of(values)
    got = out.collect()
    assert len(got) == len(rows) and all((r.v, r.w_code) == (want[values[r.id]], r.id % 2) for r in got)


def test_one_category_with_most_rows_is_spread(spark, monkeypatch):
    monkeypatch.setattr(positions, "SMALL_DICTIONARY", 0)
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        df = spark.range(60_000).select("id", F.when(F.col("id") % 10 > 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 3000)).alias("v"))
        out = positions.encode_columns(df, positions.counted_codes(df, ["v"]), {"v": "code"})
        assert out.where("v = 'hot'").select("code").distinct().count() == 1
        per_task = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert len(per_task) == 40 and max(per_task) < 3 * 60_000 / 40
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
