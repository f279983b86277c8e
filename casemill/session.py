"""Session settings the jobs rely on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

# SQL settings that decide results or skew handling; everything else is left to the cluster.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot key even where that costs one more shuffle further up the plan
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # the JVM never compiles methods above 8000 bytes; long projections then run operator by
    # operator in compiled pieces instead of interpreted as one
    "spark.sql.codegen.hugeMethodLimit": "8000",
}
# a local session's own scratch folder, where spark.checkpoint.dir is not set
FALLBACK = "spark.casemill.scratchDir"
# with it a job's shuffle files go when it ends, else when the driver happens to collect its garbage
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_open_scopes: list[list[str]] = []
_folders: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the SQL settings on a running session and return it."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", name: str = "casemill", **conf) -> SparkSession:
    """A single-machine session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
    )
    for key, value in {**SQL_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named in ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own: on a cluster a machine-local
    folder would vanish with its machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(FALLBACK, None)
    if named:
        return named
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    fallback = tempfile.mkdtemp(prefix="run-")
    spark.conf.set(FALLBACK, fallback)
    return fallback


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; inside ``temporary_cuts`` it goes when that ends."""
    path = f"{shared_dir(spark)}/casemill-{uuid.uuid4().hex}"
    for made in _open_scopes:
        made.append(path)
    return f"{path}/{name}"


def _delete(spark: SparkSession, paths: list[str]) -> None:
    configuration = spark._jsc.hadoopConfiguration()
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(configuration).delete(where, True)


@contextmanager
def temporary_cuts(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Delete the cuts made inside when the work that reads them is over, also after an error.

    Only for work that hands on nothing lazy: a result must be written elsewhere by then, or be a cut
    itself and go through the function this gives, which leaves that cut to the scope around.
    """
    made: list[str] = []
    _open_scopes.append(made)

    def keep(df: DataFrame) -> DataFrame:
        made.remove(_folders[df])
        return df

    try:
        yield keep
    finally:
        _open_scopes[:] = [scope for scope in _open_scopes if scope is not made]
        _delete(spark, made)


@contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """Delete the shuffle files of each job run inside as soon as it ends; for writes whose frame isn't
    used again, as that would shuffle anew."""
    before = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLES_GO) if before is None else spark.conf.set(SHUFFLES_GO, before)


def forget(*cuts: DataFrame) -> None:
    """Delete cuts that nothing reads any more."""
    for df in cuts:
        path = _folders.pop(df)
        for scope in _open_scopes:
            if path in scope:
                scope.remove(path)
        _delete(df.sparkSession, [path])


def cut(df: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the written table.

    The files survive the loss of executors, every consumer reads exactly the same rows, and
    Spark knows the table's size when it picks a join.
    """
    path = scratch_path(df.sparkSession, "cut.parquet")
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _folders[out] = path.rpartition("/")[0]
    return out
