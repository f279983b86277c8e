"""Reading the given tables and a few Spark helpers shared by the operators."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut, forget, prepare, scratch_path, temporary_cuts  # noqa: F401

# Batches handed to Python are kept small, as documents may be long and workers hold several copies.
ARROW = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}

_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Hand this package to the executors once per application, as a zip file that Spark serves."""
    for key, value in ARROW.items():
        spark.conf.set(key, value)
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parent.parent
        folder = Path(tempfile.mkdtemp(prefix="run-"))
        staged = folder / "code" / package.name
        shutil.copytree(package, staged, ignore=shutil.ignore_patterns("__pycache__"))
        context.addPyFile(shutil.make_archive(str(folder / package.name), "zip", folder / "code"))
        _shipped.add(context.applicationId)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(prepare(spark)).read.parquet(f"{sf_dir}/{name}.parquet")


def fold(id_column: str, folds: int) -> Column:
    """crc32 of the id's decimal text modulo ``folds``; null for a null id."""
    return F.pmod(F.crc32(F.col(id_column).cast("string").cast("binary")), F.lit(folds))


def is_fold(id_column: str, folds: int, which: int) -> Column:
    """True for the rows of one fold; a null id is in none."""
    return F.coalesce(fold(id_column, folds) == which, F.lit(False))
