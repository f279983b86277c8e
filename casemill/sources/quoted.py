"""Delimited text with line breaks in quoted cells, read in parallel.

A file is split at any line. Whether a split starts inside a quoted cell follows from the number of
quotes before it, so one scan counts the quotes of each split, and a running sum over a file's splits
gives every split its start. A second scan then joins the lines of each record: a record belongs to
the split it starts in. What a cut leaves open, at most one piece at either end of a split, is put
together by file and place.

Quotes mark cells here: a quote within a cell is doubled, and a cell that isn't quoted has none. An
opening line that breaks this rule stops the read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.quality import SchemaError
from ..session import cut

# 8 bytes for each split that starts inside a cell go to every task; beyond this many, files are
# read in groups
MAX_INSIDE = 1 << 22
WHOLE, HEAD, TAIL = 0, 1, 2
PIECES = "file long, start long, line long, kind int, value string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Physical lines with their file and split. Only the line feed ends a line, so that other
    line breaks stay what they are."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        "value",
    )


def _without_return(value: Column) -> Column:
    return F.when(value.endswith("\r"), F.expr("left(value, length(value) - 1)")).otherwise(value)


def _is_odd(quote: str) -> Column:
    bare = F.replace(F.col("value"), F.lit(quote), F.lit(""))
    return (F.octet_length("value") - F.octet_length(bare)) % 2


def split_states(spark: SparkSession, path: str, header: str, quote: str = '"') -> DataFrame:
    """(file, path, start, inside, open_end, headed): one row per split of every file.

    ``inside``: it starts in a quoted cell; ``open_end``: the whole file's last cell isn't closed;
    ``headed``: the file's first line is ``header``. All sums and minima of numbers, so the lines
    are aggregated where they are read.
    """
    counted = (
        _lines(spark, path)
        .withColumn("row", F.monotonically_increasing_id())
        .withColumn("same", _without_return(F.ltrim("value", F.lit("\ufeff"))) == F.lit(header))
        .groupBy("file", "path", "start")
        .agg(
            F.sum(_is_odd(quote)).alias("odd"),
            F.min("row").alias("first"),
            F.min(F.when(F.col("same"), F.col("row"))).alias("first_same"),
        )
    )
    before = Window.partitionBy("file").orderBy("start")
    inside = F.coalesce(F.sum("odd").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2 == 1
    return counted.select(
        "file",
        "path",
        "start",
        inside.alias("inside"),
        (F.sum("odd").over(Window.partitionBy("file")) % 2 == 1).alias("open_end"),
        ((F.col("start") > 0) | F.coalesce(F.col("first") == F.col("first_same"), F.lit(False))).alias("headed"),
    )


def _key(file: np.ndarray, start: np.ndarray) -> np.ndarray:
    """One number for each split."""
    return file.astype(np.uint64) ^ (start.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


class _Split:
    """The lines of one split, gathered into records. ``held``: the lines of the open record."""

    def __init__(self, file: int, start: int, inside: bool):
        self.file, self.start = file, start
        self.open, self.from_before = inside, inside
        self.line, self.first_line, self.held = 0, 0, []

    def add(self, values: pa.Array, odd: np.ndarray) -> Iterator[tuple[np.ndarray, int, pa.Array]]:
        """(line numbers, kind, texts) of the records that end in these lines, by line."""
        before = (int(self.open) + np.cumsum(odd) - odd) & 1
        starts = np.flatnonzero(before == 0)  # lines that begin a record
        self.open = bool((int(self.open) + int(odd.sum())) & 1)
        first, last = (int(starts[0]), int(starts[-1])) if len(starts) else (len(odd), len(odd))
        closed = not self.open or len(starts) > 0
        if first:  # lines of the record that was open
            self.held.append(values.slice(0, first))
            if closed:
                yield np.array([self.first_line]), HEAD if self.from_before else WHOLE, self._joined()
        if len(starts):
            whole = starts[:-1] if self.open else starts
            end = last if self.open else len(odd)
            if len(whole) == end - first:
                texts = values.slice(first, end - first)
            else:
                bounds = pa.array(np.append(whole, end), pa.int32())
                texts = pc.binary_join(pa.ListArray.from_arrays(bounds, values), "\n")
            if len(whole):
                yield self.line + whole, WHOLE, texts
            if self.open:
                self.held, self.first_line = [values.slice(last)], self.line + last
        self.line += len(odd)

    def _joined(self) -> pa.Array:
        lines = pa.concat_arrays(self.held)
        self.held, self.from_before = [], False
        return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(lines)], pa.int32()), lines), "\n")

    def end(self) -> Iterator[tuple[np.ndarray, int, pa.Array]]:
        if self.held:
            # a split that lies in one cell goes on with what came before it
            yield np.array([self.first_line]), HEAD if self.from_before else TAIL, self._joined()


def _assemble(inside: np.ndarray, quote: str, pieces: bool):
    """Lines to records, or to the pieces that splits leave open; ``inside`` has the keys of the
    splits that start in a cell, sorted."""

    def rows(split: _Split, found) -> Iterator[pa.RecordBatch]:
        for lines, kind, texts in found:
            if (kind != WHOLE) == pieces:
                n = len(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, split.file), pa.int64()),
                        pa.array(np.full(n, split.start), pa.int64()),
                        pa.array(lines, pa.int64()),
                        pa.array(np.full(n, kind), pa.int32()),
                        texts,
                    ],
                    names=["file", "start", "line", "kind", "value"],
                )

    def run(batches):
        split = None
        for b in batches:
            file, start = np.asarray(b.column("file")), np.asarray(b.column("start"))
            values = b.column("value").cast(pa.string())
            odd = np.asarray(pc.count_substring(values, quote)).astype(np.int64) & 1
            edges = np.flatnonzero((np.diff(file) != 0) | (np.diff(start) != 0)) + 1
            edges = [0, *edges.tolist(), len(b)]
            for lo, hi in zip(edges, edges[1:]):
                if lo == hi:
                    continue
                if split is None or (split.file, split.start) != (file[lo], start[lo]):
                    if split is not None:
                        yield from rows(split, split.end())
                    key = _key(file[lo : lo + 1], start[lo : lo + 1])[0]
                    at = np.searchsorted(inside, key)
                    split = _Split(int(file[lo]), int(start[lo]), at < len(inside) and inside[at] == key)
                yield from rows(split, split.add(values.slice(lo, hi - lo), odd[lo:hi]))
        if split is not None:
            yield from rows(split, split.end())

    return run


def _stitched(pieces: DataFrame) -> DataFrame:
    """Open ends and what follows them, as whole records at the place of the open end. There are at
    most two pieces per split."""
    place = Window.partitionBy("file").orderBy("start", "kind")
    numbered = pieces.withColumn("record", F.sum((F.col("kind") == TAIL).cast("int")).over(place))
    whole = numbered.groupBy("file", "record").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "line", "value"))).alias("p"))
    return whole.select(
        "file", F.col("p")[0]["start"].alias("start"), F.col("p")[0]["line"].alias("line"),
        F.lit(WHOLE).alias("kind"), F.array_join(F.col("p")["value"], "\n").alias("value"),
    )


def _broken(sep: str, quote: str) -> str:
    """Matches a line that ends within a quoted cell."""
    q, s = f"\\x{ord(quote):02x}", f"\\x{ord(sep):02x}"
    closed = f"{q}[^{q}]*+(?:{q}{q}[^{q}]*+)*+{q}"
    return f"(?s)^\\x{{feff}}?(?:(?:{closed}|[^{q}{s}][^{s}]*+|){s})*+{q}[^{q}]*+(?:{q}{q}[^{q}]*+)*+$"


def records(spark: SparkSession, path: str, header: str, sep: str = ",", quote: str = '"') -> tuple[DataFrame, DataFrame]:
    """(file, start, line, value): the records of all files but their headers, each as one text, with
    the split and the line in it where it starts; and (file, path) of all files.

    Refuses files whose first line isn't ``header`` and files whose last quoted cell isn't closed.
    A file may have splits of any size, down to ones within a single cell.
    """
    states = split_states(spark, path, header, quote)
    notable = states.where("inside OR open_end OR NOT headed").limit(MAX_INSIDE + 1).toArrow()  # splits are few
    if len(notable) > MAX_INSIDE:
        states = cut(states)
        notable = states.where("open_end OR NOT headed").limit(1).toArrow()
        groups = -(-states.where("inside").count() // MAX_INSIDE)
    else:
        groups = 1
    for bad in notable.filter(pc.or_(notable["open_end"], pc.invert(notable["headed"]))).slice(0, 1).to_pylist():
        if bad["headed"]:
            raise SchemaError(f"{bad['path']}: the last quoted cell isn't closed")
        raise SchemaError(f"files with different headers, one is {bad['path']}")
    lines, out = _lines(spark, path).select("file", "start", "value"), None
    for g in range(groups):
        of_group, starts = lines, notable
        if groups > 1:
            mine = F.pmod("file", F.lit(groups)) == g
            of_group, starts = lines.where(mine), states.where(mine & F.col("inside")).toArrow()
        keys = np.sort(_key(np.asarray(starts["file"]), np.asarray(starts["start"])))
        whole = of_group.mapInArrow(_assemble(keys, quote, False), PIECES)
        if len(keys):
            whole = whole.unionByName(_stitched(of_group.mapInArrow(_assemble(keys, quote, True), PIECES)))
        out = whole if out is None else out.unionByName(whole)
    opening = F.split_part("value", F.lit("\n"), F.lit(1))
    multi = F.contains("value", F.lit("\n"))
    stop = F.raise_error(F.concat(F.lit("a quote inside a cell that isn't quoted, read it with split=False: "), F.left(opening, F.lit(200))))
    checked = F.when(multi & ~opening.rlike(_broken(sep, quote)), stop).otherwise(_without_return(F.col("value")))
    kept = out.where("NOT (start = 0 AND line = 0) AND trim(value) NOT IN ('', '\r')").select(
        "file", "start", "line", checked.alias("value")
    )
    return kept, states.where("start = 0").select("file", "path")


def read_quoted(
    spark: SparkSession, path: str, header: str, names: Sequence[str], sep: str = ",", quote: str = '"', row_order: bool = False
) -> DataFrame:
    """The cells of all records as text under ``names``; with ``row_order`` also ``_row``, the
    record's file, split and line."""
    kind = ", ".join(f"c{i} string" for i in range(len(names)))
    options = {"sep": sep, "quote": quote, "escape": quote, "multiLine": "true"}
    found, files = records(spark, path, header, sep, quote)
    cells = [F.col(f"r.c{i}").alias(n) for i, n in enumerate(names)]
    if row_order:
        found = found.join(files, "file")
        cells.append(F.struct("path", "start", F.col("line").alias("row")).alias("_row"))
    return found.withColumn("r", F.from_csv("value", kind, options)).select(*cells)
