"""Daily volume series, the training matrix and the models on them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark import SparkContext
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import PolynomialExpansion, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import add_creation_features, add_day_number
from ..operators.filters import equal_to, in_period
from ..operators.metrics import daily_counts
from ..operators.positions import counted_codes, encode_columns
from ..operators.shape import drop_if_present
from ..session import cut, temporary_cuts
from ..sources.sinks import write_counted

# Splits, windows and the columns of the training matrix.
REGRESSION_TRAIN, REGRESSION_SEED = 78, 1000
LOGISTIC_TRAIN, LOGISTIC_SEED = 60, 42
DEGREE = 2
MIN_ROWS = 5
TRAINING_PERIOD = ("2025-01-01", "2025-12-31")
NEXT_PERIOD = ("2026-01-01", "2026-12-31")
CODED = ("CUMPLE_ANS", "origen_caso", "servicio", "responsable")
FEATURES = ("numero_caso", "responsable", "servicio", "tiempoTranscurrido", "origen_caso")
MATRIX = (
    "numero_caso", "responsable", "servicio", "tiempoTranscurrido", "CUMPLE_ANS", "origen_caso",
    "fechaCaso", "indice",
)
MATRIX_DROPPED = (
    "tipo_de_caso", "proyecto", "username_resp", "usuariofinal", "username_ufinal",
    "fecha_solucion", "fecha_creacion", "fecha_atencion", "diasemana_creacion", "mes_creacion",
    "dia_creacion", "año_creacion",
)


# ---- data sets -----------------------------------------------------------------


def daily_volume(indicators: DataFrame) -> DataFrame:
    """Cases per creation day."""
    return daily_counts(add_creation_features(indicators))


def volume_of_period(daily: DataFrame, start: str, end: str) -> DataFrame:
    """M1: the days of a period, numbered from its first day.

    One row per day: it is cut, so that finding the first day doesn't count all cases again.
    """
    return add_day_number(cut(in_period(daily, "fecha_creacion", start, end)))


def training_rows(
    indicators: DataFrame,
    start: str = TRAINING_PERIOD[0],
    end: str = TRAINING_PERIOD[1],
    case_type: str = "Incidente",
    project: str = "Soporte",
    end_inclusive_day: bool = False,
) -> DataFrame:
    """M4: the cases the matrix is built from."""
    chosen = equal_to(indicators, tipo_de_caso=case_type, proyecto=project)
    return in_period(chosen, "fecha_solucion", start, end, end_inclusive_day)


def training_matrix(rows: DataFrame) -> DataFrame:
    """M2, M3, M4: categories and the solution time as codes, plus a row number.

    The row number only has to be unique, so it costs no shuffle.
    """
    times, codes = counted_codes(rows, ["fecha_solucion"]), counted_codes(rows, CODED)
    rows = rows.withColumn("indice", F.monotonically_increasing_id())
    rows = encode_columns(rows, times, {"fecha_solucion": "fechaCaso"})
    rows = encode_columns(rows, codes, {c: c for c in CODED})
    return drop_if_present(rows, MATRIX_DROPPED).select(*MATRIX)


# ---- split and metrics -----------------------------------------------------------


def split_bucket(key: Column, seed: int) -> Column:
    """M5: 0 to 99 from the row's key; the same on every run and engine."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100


def split(df: DataFrame, key: Column, train_percent: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """M5: training and test rows."""
    bucket = split_bucket(key, seed)
    return df.where(bucket < train_percent), df.where(bucket >= train_percent)


def regression_metrics(scored: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """M9: R2 and RMSE in one pass over the test rows."""
    y, p = F.col(label).cast("double"), F.col(prediction)
    error = F.sum((y - p) * (y - p))
    spread = F.var_pop(y) * F.count(y)
    return scored.agg(
        F.when(spread > 0, 1 - error / spread).alias("r2"),
        F.sqrt(F.avg((y - p) * (y - p))).alias("rmse"),
        F.count(y).alias("test_rows"),
    )


def accuracy(scored: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """M9: share of right predictions."""
    hit = (F.col(label) == F.col(prediction)).cast("int")
    return scored.agg(F.avg(hit).alias("accuracy"), F.count(hit).alias("test_rows"))


# ---- models ------------------------------------------------------------------------


def linear_fit(train: DataFrame, x: str = "fecha", y: str = "cantidadCasos") -> DataFrame:
    """M6: slope, intercept and R2 of the one-feature regression, in one aggregation."""
    return train.agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
    )


def polynomial_fit(train: DataFrame, x: str = "fecha", y: str = "cantidadCasos", degree: int = DEGREE):
    """M7: the fitted model; ``score_polynomial`` applies it."""
    data = _powers(train, x, degree).withColumn("label", F.col(y).cast("double"))
    model = LinearRegression(featuresCol="powers", labelCol="label", solver="normal").fit(data)
    return _without_summary(model)


def score_polynomial(model, df: DataFrame, x: str = "fecha", degree: int = DEGREE) -> DataFrame:
    return model.transform(_powers(df, x, degree)).drop("powers")


def _powers(df: DataFrame, x: str, degree: int) -> DataFrame:
    assembled = VectorAssembler(inputCols=[x], outputCol="_x").transform(df)
    expand = PolynomialExpansion(degree=degree, inputCol="_x", outputCol="powers")
    return expand.transform(assembled).drop("_x")


def usable(df: DataFrame, features=FEATURES, label: str = "CUMPLE_ANS") -> DataFrame:
    """M8: the rows a model can read: no missing number and a label. Codes are never missing."""
    return df.dropna(subset=[*features, label])


def logistic_fit(train: DataFrame, n: int, features=FEATURES, label: str = "CUMPLE_ANS"):
    """M8: L2 with C = 1 over the ``n`` usable rows, so the weight per row is 1 / n; no
    standardised penalty."""
    model = LogisticRegression(
        featuresCol="features",
        labelCol=label,
        regParam=1.0 / n,
        elasticNetParam=0.0,
        standardization=False,
        maxIter=100,
    )
    return _without_summary(model.fit(assemble(train, features)))


def _without_summary(model):
    """The model alone: its training summary keeps the session, which can't go to tasks with the
    model once the session has observed a query."""
    option = SparkContext._active_spark_context._jvm.scala.Option
    model._java_obj.setSummary(option.apply(None))
    return model


def assemble(df: DataFrame, features=FEATURES) -> DataFrame:
    assembler = VectorAssembler(
        inputCols=list(features), outputCol="features", handleInvalid="error"
    )
    return assembler.transform(df)


@dataclass(frozen=True)
class Scores:
    """What the models reach on their test rows; ``None`` where there were too few rows."""

    linear_r2: float | None = None
    polynomial_r2: float | None = None
    polynomial_rmse: float | None = None
    logistic_accuracy: float | None = None
    logistic_test_rows: int = 0
    # rows of the matrix that lack a number and so were neither fitted nor tested
    logistic_unusable: int = 0
    # rows of each data set that was written
    rows: Mapping[str, int] = field(default_factory=dict)


def train_regressions(period: DataFrame, key: str = "fecha_creacion") -> Scores:
    """M6, M7, M9, M10 on a daily series (one row per day of a period)."""
    if period.count() < MIN_ROWS:
        return Scores()
    train, test = split(period, F.date_format(key, "yyyy-MM-dd"), REGRESSION_TRAIN, REGRESSION_SEED)
    line = linear_fit(train).first()
    straight = test.withColumn(
        "prediction", F.lit(line.slope) * F.col("fecha") + F.lit(line.intercept)
    )
    linear = regression_metrics(straight, "cantidadCasos").first()
    curved = score_polynomial(polynomial_fit(train), test)
    poly = regression_metrics(curved, "cantidadCasos").first()
    return Scores(linear_r2=linear.r2, polynomial_r2=poly.r2, polynomial_rmse=poly.rmse)


def train_logistic(matrix: DataFrame) -> Scores:
    """Accuracy on the usable test rows, and how many rows were not usable.

    A matrix with one class only is answered with that class, without a fit."""
    whole = usable(matrix)
    key = F.concat_ws("|", "origen_caso", "numero_caso")
    train, test = split(whole, key, LOGISTIC_TRAIN, LOGISTIC_SEED)
    in_train = split_bucket(key, LOGISTIC_SEED) < LOGISTIC_TRAIN
    size = whole.agg(
        F.count_if(in_train).alias("train"),
        F.count_if(~in_train).alias("test"),
        F.min(F.when(in_train, F.col("CUMPLE_ANS"))).alias("low"),
        F.max(F.when(in_train, F.col("CUMPLE_ANS"))).alias("high"),
    ).first()
    left_out = matrix.count() - size.train - size.test
    if size.train + size.test < MIN_ROWS or not size.train:
        return Scores(logistic_unusable=left_out)
    if size.low == size.high:
        scored = test.withColumn("prediction", F.lit(size.low).cast("double"))
    else:
        scored = logistic_fit(train, size.train).transform(assemble(test))
    reached = accuracy(scored, "CUMPLE_ANS").first()
    return Scores(
        logistic_accuracy=reached.accuracy,
        logistic_test_rows=reached.test_rows,
        logistic_unusable=left_out,
    )


def run_models(
    indicators: DataFrame,
    folder: str,
    training: tuple[str, str] = TRAINING_PERIOD,
    following: tuple[str, str] = NEXT_PERIOD,
    case_type: str = "Incidente",
    project: str = "Soporte",
) -> Scores:
    """Write both periods and the matrix; the models train on what was written."""
    spark = indicators.sparkSession
    with temporary_cuts(spark):
        daily = cut(daily_volume(indicators))
        chosen = training_rows(indicators, *training, case_type, project)
        written, rows = {}, {}
        for name, df in (
            ("period_training", volume_of_period(daily, *training)),
            ("period_next", volume_of_period(daily, *following)),
            ("matrix", training_matrix(chosen)),
        ):
            path, counts = write_counted(df, f"{folder}/{name}")
            written[name], rows[name] = spark.read.parquet(path), counts["rows"]
        regressions = train_regressions(written["period_training"])
        return replace(
            train_logistic(written["matrix"]),
            linear_r2=regressions.linear_r2,
            polynomial_r2=regressions.polynomial_r2,
            polynomial_rmse=regressions.polynomial_rmse,
            rows=rows,
        )
