"""Report and interim tables."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import check_exact

log = logging.getLogger(__name__)


def write_report(
    df: DataFrame,
    path: str,
    columns: Sequence[str] | None = None,
    overwrite: bool = True,
    partition_by: Sequence[str] = (),
) -> str:
    """K1: a report table with exactly the given columns in their order."""
    if columns is not None:
        df = check_exact(df, columns, path)
    return write_interim(df, path, overwrite, partition_by)


def write_counted(
    df: DataFrame, path: str, columns: Sequence[str] | None = None, **counts: Column
) -> tuple[str, dict[str, int]]:
    """K1 with run metrics (A4): ``rows`` and the named aggregates, taken while the rows go by."""
    seen = Observation()
    rows = F.count(F.lit(1)).alias("rows")
    observed = df.observe(seen, rows, *[c.alias(name) for name, c in counts.items()])
    write_report(observed, path, columns)
    return path, {name: int(value or 0) for name, value in seen.get.items()}


def write_interim(
    df: DataFrame, path: str, overwrite: bool = True, partition_by: Sequence[str] = ()
) -> str:
    """K2: a Parquet table; an existing one is replaced, or an error without ``overwrite``.

    The new table is written beside the old one, which stays as it is until the new one is whole;
    then two renames put it in its place. A write that fails leaves the old table. If a run is
    ended between the renames, the next write or ``recover`` finishes it.
    """
    spark = df.sparkSession
    files, target = _place(spark, path)
    recover(spark, path)
    if files.exists(target) and not overwrite:
        raise FileExistsError(f"{path} exists already")
    mark = uuid.uuid4().hex
    new, old = f"{path.rstrip('/')}{NEW}{mark}", f"{path.rstrip('/')}{OLD}{mark}"
    try:
        (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(new)
        if files.exists(target):
            _move(files, target, _place(spark, old)[1])
        _move(files, _place(spark, new)[1], target)
    except Exception:
        recover(spark, path)
        raise
    files.delete(_place(spark, old)[1], True)
    return path


# names of the folders beside a table while it is replaced
NEW, OLD = ".new-", ".old-"


def _place(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _move(files, source, target) -> None:
    if not files.rename(source, target):
        raise OSError(f"{source.toString()} couldn't be moved to {target.toString()}")


def recover(spark: SparkSession, path: str) -> None:
    """Put back the old table if a replacement was left between its renames, and take away what a
    broken replacement has left. For the one writer of a table."""
    files, target = _place(spark, path)
    folder, name = target.getParent(), target.getName()
    if folder is None or not files.exists(folder):
        return
    beside = [f.getPath() for f in files.listStatus(folder)]
    olds = [p for p in beside if p.getName().startswith(name + OLD)]
    news = [p for p in beside if p.getName().startswith(name + NEW)]
    if olds and not files.exists(target):
        _move(files, olds.pop(), target)
    for left in (*olds, *news):
        files.delete(left, True)


def write_snapshots(frames: Mapping[str, DataFrame], folder: str, prefix: str) -> dict[str, str]:
    """K3: every stage by name; a failed write only warns."""
    written = {}
    for name, df in frames.items():
        path = f"{folder}/{prefix}_{name}.parquet"
        try:
            written[name] = write_interim(df, path)
        except Exception as error:  # noqa: BLE001 - snapshots are for tracing only
            log.warning("snapshot %s not written: %s", path, error)
    return written
