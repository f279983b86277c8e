"""Feature engineering and models over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import positions
from ..plans import volume
from ..session import cut, scratch_path
from .base import query, stand_in, table

PERIOD = ("1997-01-01", "1997-12-31")

# cases of the training table: every order one incident or request of a project
INDICATORS = """
SELECT o_orderkey AS numero_caso, CASE WHEN o_orderstatus = 'F' THEN 'Requerimiento' ELSE 'Incidente' END AS tipo_de_caso,
       'User ' || CAST(o_custkey AS STRING) AS usuariofinal,
       CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE 'Owner ' || CAST(o_custkey % 40 AS STRING) END AS responsable,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderpriority END AS servicio, o_orderdate AS fecha_creacion, o_orderdate AS fecha_atencion,
       CASE WHEN o_orderkey % 9 = 0 THEN o_orderdate + INTERVAL '5' HOUR ELSE o_orderdate END AS fecha_solucion,
       CAST(floor(o_totalprice) AS BIGINT) AS tiempoTranscurrido,
       CASE WHEN o_totalprice > 250000 THEN 'NO' WHEN o_totalprice < 20000 THEN NULL ELSE 'SI' END AS CUMPLE_ANS,
       CASE WHEN o_custkey % 3 = 0 THEN 'Helpdesk' ELSE 'Inventory' END AS origen_caso,
       CASE WHEN o_orderkey % 4 = 0 THEN 'Mesa de Servicios' ELSE 'Soporte' END AS proyecto,
       'r' AS username_resp, 'u' AS username_ufinal
FROM {orders}
"""

DAILY = """SELECT CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS fecha_creacion, year(o_orderdate) AS "año_creacion",
  month(o_orderdate) AS mes_creacion, day(o_orderdate) AS dia_creacion, isodow(o_orderdate) - 1 AS diasemana_creacion,
  count(*) AS "cantidadCasos" FROM orders GROUP BY ALL"""
SERIES = f"""SELECT *, date_diff('day', (SELECT min(fecha_creacion) FROM ({DAILY}) m
    WHERE fecha_creacion BETWEEN '{PERIOD[0]}' AND '{PERIOD[1]}'), fecha_creacion) + 1 AS fecha
  FROM ({DAILY}) d WHERE fecha_creacion BETWEEN TIMESTAMP '{PERIOD[0]}' AND TIMESTAMP '{PERIOD[1]}'"""


def _series(spark, sf):
    return volume.volume_of_period(volume.daily_volume(stand_in(spark, sf, INDICATORS)), *PERIOD)


@query("m1_daily_volume_of_period", SERIES)
def _(spark, sf):
    return _series(spark, sf)


# categories with missing values
SOME_BRANDS = "SELECT CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_brand END AS p_brand, p_name FROM {part}"
SOME_TIMES = "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE ts END AS ts FROM {events}"


@query(
    "m2_category_codes",
    f"""SELECT 'p_brand' AS column_name, p_brand AS value, dense_rank() OVER (ORDER BY p_brand NULLS LAST) - 1 AS code
       FROM (SELECT DISTINCT p_brand FROM ({SOME_BRANDS}) x) b
       UNION ALL SELECT 'p_name', p_name, dense_rank() OVER (ORDER BY p_name NULLS LAST) - 1
       FROM (SELECT DISTINCT p_name FROM ({SOME_BRANDS}) y) n""",
)
def _(spark, sf):
    return positions.category_codes(stand_in(spark, sf, SOME_BRANDS), ["p_brand", "p_name"])


@query(
    "m2_encoded_times",
    f"SELECT event_id, dense_rank() OVER (ORDER BY ts NULLS LAST) - 1 AS code FROM ({SOME_TIMES}) e",
)
def _(spark, sf):
    events = stand_in(spark, sf, SOME_TIMES)
    codes = positions.counted_codes(events, ["ts"])
    return positions.encode_columns(events, codes, {"ts": "code"}).drop("ts")


@query(
    "m3_row_numbers",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1 AS indice FROM {lineitem}",
)
def _(spark, sf):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return positions.add_positions(table(spark, sf, "lineitem").select(*keys), keys, "indice")


CHOSEN = f"""SELECT * FROM ({INDICATORS}) i WHERE tipo_de_caso = 'Incidente' AND proyecto = 'Soporte'
  AND fecha_solucion BETWEEN TIMESTAMP '{PERIOD[0]}' AND TIMESTAMP '{PERIOD[1]}'"""
MATRIX = f"""SELECT numero_caso,
  dense_rank() OVER (ORDER BY responsable NULLS LAST) - 1 AS responsable,
  dense_rank() OVER (ORDER BY servicio NULLS LAST) - 1 AS servicio, tiempoTranscurrido AS "tiempoTranscurrido",
  dense_rank() OVER (ORDER BY CUMPLE_ANS NULLS LAST) - 1 AS "CUMPLE_ANS",
  dense_rank() OVER (ORDER BY origen_caso NULLS LAST) - 1 AS origen_caso,
  dense_rank() OVER (ORDER BY fecha_solucion NULLS LAST) - 1 AS "fechaCaso" FROM ({CHOSEN}) c"""


def _matrix(spark, sf):
    rows = volume.training_rows(stand_in(spark, sf, INDICATORS), *PERIOD)
    return volume.training_matrix(rows)


@query("m4_training_matrix", MATRIX)
def _(spark, sf):
    return _matrix(spark, sf).drop("indice")


def sql_bucket(key: str, seed: int) -> str:
    return f"(CAST('0x' || substr(md5('{seed}|' || CAST({key} AS VARCHAR)), 1, 8) AS BIGINT) % 100)"


@query(
    "m5_split_buckets",
    f"""SELECT o_orderkey, {sql_bucket('o_orderkey', 42)} AS bucket, {sql_bucket('o_orderkey', 42)} < 60 AS train FROM {{orders}}""",
)
def _(spark, sf):
    bucket = volume.split_bucket(F.col("o_orderkey"), volume.LOGISTIC_SEED)
    return table(spark, sf, "orders").select(
        "o_orderkey", bucket.alias("bucket"), (bucket < volume.LOGISTIC_TRAIN).alias("train")
    )


DAY = "strftime(fecha_creacion, '%Y-%m-%d')"
TRAIN = f"SELECT * FROM ({SERIES}) s WHERE {sql_bucket(DAY, 1000)} < 78"
TEST = f"SELECT * FROM ({SERIES}) s WHERE {sql_bucket(DAY, 1000)} >= 78"


def _series_split(spark, sf):
    key = F.date_format("fecha_creacion", "yyyy-MM-dd")
    # one row per day of a year, used by both parts
    series = cut(_series(spark, sf))
    return volume.split(series, key, volume.REGRESSION_TRAIN, volume.REGRESSION_SEED)


@query(
    "m6_linear_regression",
    f"""SELECT round(regr_slope("cantidadCasos", fecha), 8) AS slope, round(regr_intercept("cantidadCasos", fecha), 6) AS intercept,
        round(regr_r2("cantidadCasos", fecha), 8) AS r2 FROM ({TRAIN}) t""",
)
def _(spark, sf):
    train, _ = _series_split(spark, sf)
    fit = volume.linear_fit(train)
    return fit.select(
        F.round("slope", 8).alias("slope"), F.round("intercept", 6).alias("intercept"), F.round("r2", 8).alias("r2")
    )


# least squares of degree 2 around the mean of x
CURVE = f"""m AS (SELECT avg(fecha) AS mx FROM ({TRAIN}) t0),
  s AS (SELECT count(*) AS n, sum(x * x) AS s2, sum(x * x * x) AS s3, sum(x * x * x * x) AS s4,
      sum(y) AS t0, sum(x * y) AS t1, sum(x * x * y) AS t2
    FROM (SELECT fecha - mx AS x, CAST("cantidadCasos" AS DOUBLE) AS y FROM ({TRAIN}) t, m) c),
  a AS (SELECT *, (t2 - s2 * t0 / n - s3 * t1 / s2) / (s4 - s2 * s2 / n - s3 * s3 / s2) AS a2 FROM s),
  f AS (SELECT a2, (t1 - s3 * a2) / s2 AS a1, (t0 - s2 * a2) / n AS a0 FROM a),
  scored AS (SELECT fecha_creacion, "cantidadCasos" AS y, a0 + a1 * (fecha - mx) + a2 * (fecha - mx) * (fecha - mx) AS p
    FROM ({TEST}) t, m, f)"""


def _curve(spark, sf):
    train, test = _series_split(spark, sf)
    return volume.score_polynomial(volume.polynomial_fit(train), test)


@query("m7_polynomial_regression", f"WITH {CURVE} SELECT fecha_creacion, round(p, 5) AS prediction FROM scored")
def _(spark, sf):
    return _curve(spark, sf).select("fecha_creacion", F.round("prediction", 5).alias("prediction"))


@query(
    "m9_regression_metrics",
    f"""WITH {CURVE} SELECT round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) AS r2,
        round(sqrt(avg((y - p) * (y - p))), 6) AS rmse, count(*) AS test_rows FROM scored""",
)
def _(spark, sf):
    metrics = volume.regression_metrics(_curve(spark, sf), "cantidadCasos")
    return metrics.select(F.round("r2", 6).alias("r2"), F.round("rmse", 6).alias("rmse"), "test_rows")


@query(
    "m9_accuracy",
    """SELECT avg(CASE WHEN quality = 1 - toxic THEN 1 ELSE 0 END) AS accuracy, count(*) AS test_rows FROM {labels}""",
)
def _(spark, sf):
    labels = table(spark, sf, "labels").withColumn("prediction", 1 - F.col("toxic"))
    return volume.accuracy(labels, "quality")


# labels that follow from the origin alone, so every test row must be right; some rows lack a number
SEPARABLE = INDICATORS.replace("o_totalprice > 250000", "o_custkey % 3 = 0").replace("WHEN o_totalprice < 20000 THEN NULL ", "").replace(
    "CAST(floor(o_totalprice) AS BIGINT)", "CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(floor(o_totalprice) AS BIGINT) END"
)
ORIGIN_KEY = "(CASE WHEN origen_caso = 'Helpdesk' THEN '0|' ELSE '1|' END || CAST(numero_caso AS VARCHAR))"
LABELLED = f"""SELECT * FROM ({SEPARABLE}) i WHERE tipo_de_caso = 'Incidente' AND proyecto = 'Soporte'
  AND fecha_solucion BETWEEN TIMESTAMP '{PERIOD[0]}' AND TIMESTAMP '{PERIOD[1]}'"""
TESTED = f"""SELECT count(*) FILTER (tiempoTranscurrido IS NOT NULL AND {sql_bucket(ORIGIN_KEY, 42)} >= 60) AS test_rows,
  count(*) FILTER (tiempoTranscurrido IS NULL) AS unusable, count(*) AS matrix_rows FROM ({LABELLED}) l"""


@query("m8_logistic_regression", f"SELECT CAST(1 AS DOUBLE) AS accuracy, test_rows, unusable FROM ({TESTED}) t")
def _(spark, sf):
    rows = volume.training_rows(stand_in(spark, sf, SEPARABLE), *PERIOD)
    scores = volume.train_logistic(cut(volume.training_matrix(rows)))
    row = [scores.logistic_accuracy, scores.logistic_test_rows, scores.logistic_unusable]
    return spark.createDataFrame([row], "accuracy double, test_rows bigint, unusable bigint")


@query(
    "m10_too_few_rows",
    """SELECT o_orderstatus, count(*) AS rows, CASE WHEN count(*) >= 5 THEN round(regr_slope(o_totalprice, o_custkey), 6) END AS slope
       FROM {orders} GROUP BY 1""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders")
    enough = F.count(F.lit(1)) >= volume.MIN_ROWS
    return orders.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("rows"),
        F.when(enough, F.round(F.regr_slope("o_totalprice", "o_custkey"), 6)).alias("slope"),
    )


FOLLOWING = ("1998-01-01", "1998-12-31")


@query(
    "e3_models",
    f"""WITH {CURVE},
      l AS (SELECT regr_slope("cantidadCasos", fecha) AS b, regr_intercept("cantidadCasos", fecha) AS a FROM ({TRAIN}) t),
      straight AS (SELECT "cantidadCasos" AS y, a + b * fecha AS p FROM ({TEST}) t, l)
    SELECT (SELECT round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) FROM straight) AS linear_r2,
      (SELECT round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) FROM scored) AS polynomial_r2,
      (SELECT round(sqrt(avg((y - p) * (y - p))), 6) FROM scored) AS polynomial_rmse,
      CAST(1 AS DOUBLE) AS logistic_accuracy, test_rows AS logistic_test_rows, unusable AS logistic_unusable, matrix_rows,
      (SELECT count(*) FROM ({SERIES}) s) AS period_training,
      (SELECT count(*) FROM ({DAILY}) d WHERE fecha_creacion BETWEEN TIMESTAMP '{FOLLOWING[0]}' AND TIMESTAMP '{FOLLOWING[1]}') AS period_next
    FROM ({TESTED}) t""",
)
def _(spark, sf):
    found = volume.run_models(stand_in(spark, sf, SEPARABLE), scratch_path(spark, "models"), PERIOD, FOLLOWING)
    row = [
        *[round(x, 6) for x in (found.linear_r2, found.polynomial_r2, found.polynomial_rmse)],
        found.logistic_accuracy, found.logistic_test_rows, found.logistic_unusable,
        found.rows["matrix"], found.rows["period_training"], found.rows["period_next"],
    ]
    return spark.createDataFrame(
        [row],
        "linear_r2 double, polynomial_r2 double, polynomial_rmse double, logistic_accuracy double, "
        "logistic_test_rows bigint, logistic_unusable bigint, matrix_rows bigint, period_training bigint, period_next bigint",
    )
