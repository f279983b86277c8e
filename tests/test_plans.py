import tempfile
from datetime import datetime, timedelta

import pytest

from casemill.plans import consolidate, volume
from casemill.registry import jobs
from casemill.schemas import INDICATORS
from casemill.sources import rules

SF = "/root/testdata/sf0.001"


def days(rows, fn, n=120):
    return rows(
        "fecha_creacion timestamp_ntz, cantidadCasos bigint, fecha int",
        *[(datetime(2025, 1, 1) + timedelta(days=d), fn(d + 1), d + 1) for d in range(n)],
    )


def test_exact_curve_is_found(rows):
    scores = volume.train_regressions(days(rows, lambda d: 3 * d * d + 2 * d + 7))
    assert scores.polynomial_r2 == pytest.approx(1.0, abs=1e-6)
    assert scores.polynomial_rmse == pytest.approx(0.0, abs=1e-2)
    assert 0.8 < scores.linear_r2 < 1


def test_too_few_days(rows):
    assert volume.train_regressions(days(rows, lambda d: d, n=4)) == volume.Scores()


def matrix(rows, n):
    return rows(
        "numero_caso bigint, responsable int, servicio int, tiempoTranscurrido bigint, CUMPLE_ANS int, origen_caso int, fechaCaso int, indice bigint",
        *[(i, i % 7, i % 2, (i % 2) * 100, i % 2, 0, i, i) for i in range(n)],
    )


def test_separable_labels(rows):
    assert volume.train_logistic(matrix(rows, 300)).logistic_accuracy == 1.0


def test_too_few_cases(rows):
    assert volume.train_logistic(matrix(rows, 4)).logistic_accuracy is None


def test_split_is_stable_and_near_its_share(spark):
    from pyspark.sql import functions as F

    train, test = volume.split(spark.range(5000), F.col("id"), 60, 42)
    n = train.count()
    assert n + test.count() == 5000 and 2850 < n < 3150
    assert n == volume.split(spark.range(5000), F.col("id"), 60, 42)[0].count()


def test_run_models(spark):
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    from casemill.registry.base import stand_in
    from casemill.registry.volume import INDICATORS as TICKETS

    scores = volume.run_models(stand_in(spark, SF, TICKETS), folder, ("1996-01-01", "1997-12-31"), ("1998-01-01", "1998-12-31"))
    assert 0 <= scores.logistic_accuracy <= 1 and scores.polynomial_rmse > 0
    assert scores.rows["matrix"] > scores.logistic_test_rows > 0 and scores.logistic_unusable == 0
    assert spark.read.parquet(f"{folder}/matrix").columns == list(volume.MATRIX)
    written = spark.read.parquet(f"{folder}/matrix")
    assert written.select("indice").distinct().count() == written.count()


def test_run_consolidation(spark):
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    out = consolidate.run_consolidation(
        jobs.sources(spark, SF), jobs.identity(spark, SF), rules.service_catalogue(**jobs.CATALOGUE),
        f"{folder}/indicators", jobs.SETTINGS, snapshots=f"{folder}/stages",
    )
    total = out["indicators"].count()
    assert out["indicators"].columns == list(INDICATORS)
    assert sum(r["rows"] for r in out["rows_by_origin"].collect()) == total > 0
    assert out["distinct_services"].first()[0] > 5
    assert out["total_rows"].first()[0] == total
    seen = out["identity"].first()
    assert seen.candidates == seen.master + seen.directory + seen.unresolved > 0 and seen.responsable_filled > 0
    assert spark.read.parquet(f"{folder}/stages/consolidation_helpdesk.parquet").count() > 0


def test_suite_rows_keep_their_text(spark):
    frame = consolidate.consolidate(
        jobs.sources(spark, SF), jobs.identity(spark, SF), rules.service_catalogue(**jobs.CATALOGUE), jobs.SETTINGS
    )
    suite = frame.where("origen_caso = 'Service Suite' AND usuariofinal LIKE '%Núñez%'")
    others = frame.where("origen_caso <> 'Service Suite' AND usuariofinal RLIKE '[áéíóúñ]'")
    assert suite.limit(1).count() == 1 and others.limit(1).count() == 0


def test_lines_of_the_lookup_step_stay_columnar(spark):
    """Only the two line columns and the part columns the result needs reach the scan."""
    from casemill.registry import all_queries

    plan = all_queries()["j11_service_remap_over_lines"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in plan and "p_retailprice" not in plan
