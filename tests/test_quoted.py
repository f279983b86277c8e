"""Quoted cells with line breaks, read in many splits, give the rows of a read in one task."""

import csv
import io
import random
import tempfile

import pytest

from casemill.operators.quality import SchemaError
from casemill.sources import files, quoted


@pytest.fixture()
def small_splits(spark):
    """splits(n): files are cut every n bytes or so."""
    settings = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {k: spark.conf.get(k, None) for k in settings}

    def splits(n):
        for k, v in zip(settings, (str(n), "1", "1")):
            spark.conf.set(k, v)

    yield splits
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def write(rows, ending="\n", name="1.csv", folder=None, sep=",", quoting=csv.QUOTE_MINIMAL):
    folder = folder or tempfile.mkdtemp(prefix="run-", dir="/tmp")
    out = io.StringIO()
    csv.writer(out, delimiter=sep, lineterminator=ending, quoting=quoting).writerows(rows)
    with open(f"{folder}/{name}", "w", encoding="utf-8", newline="") as f:
        f.write(out.getvalue())
    return folder


def invented(seed, n=60):
    rng = random.Random(seed)
    cells = ["x", "", "two\nlines", 'say "hi"', '"', '""', "a,b;c", "\n", "é\n\nü", "line\r\nend", " padded ", 'q"\n"q', "plain text", "long " * 30, "l\n" * 40]
    return [["a", "b", "c"], *[[f"r{i}", rng.choice(cells), rng.choice(cells)] for i in range(n)]]


def plain(rows):
    missing = set(files.NA_TOKENS)
    return sorted([tuple(None if c in missing else c for c in r) for r in rows[1:]], key=repr)


@pytest.mark.parametrize("size, ending", [(11, "\n"), (100, "\r\n"), (1000, "\n"), (1_000_000, "\r\n")])
def test_any_split_gives_the_rows_of_one_task(spark, small_splits, size, ending):
    one, two = invented(size, 8 if size < 40 else 40), invented(size + 1, 8)
    folder = write(one, ending)
    write(two, ending, "2.csv", folder)
    write([one[0]], ending, "3.csv", folder)
    small_splits(size)
    got = files.read_csv(spark, folder)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(plain(one) + plain(two), key=repr)
    if size == 100:
        assert spark.read.text(folder).rdd.getNumPartitions() > 10


def test_same_as_the_reader_of_whole_files(spark, small_splits):
    folder = write(invented(5, 60), quoting=csv.QUOTE_ALL)
    small_splits(64)
    whole = files.read_csv(spark, folder, split=False)
    assert sorted(map(tuple, files.read_csv(spark, folder).collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)


def test_rows_keep_the_order_of_files_and_lines(spark, small_splits):
    folder = None
    for f in range(3):
        folder = write([["k", "v"], *[[f"{f}-{i:03}", "a\nb" if i % 3 else "c"] for i in range(50)]], name=f"{f}.csv", folder=folder)
    small_splits(90)
    got = files.read_csv(spark, folder, row_order=True).orderBy("_row").collect()
    assert [r.k for r in got] == [f"{f}-{i:03}" for f in range(3) for i in range(50)]


def test_one_cell_longer_than_several_splits(spark, small_splits):
    rows = [["a", "b"], ["1", "x\n" * 300 + "y"], ["2", "z" * 500], ["3", "p\nq"]]
    folder = write(rows)
    small_splits(100)
    assert sorted(map(tuple, files.read_csv(spark, folder).collect())) == plain(rows)


def test_groups_of_files_give_the_same(spark, small_splits, monkeypatch):
    folder = None
    for f in range(4):
        folder = write(invented(f, 8), name=f"{f}.csv", folder=folder)
    small_splits(60)
    want = sorted(map(tuple, files.read_csv(spark, folder).collect()), key=repr)
    monkeypatch.setattr(quoted, "MAX_INSIDE", 5)
    assert sorted(map(tuple, files.read_csv(spark, folder).collect()), key=repr) == want


def test_semicolons_and_repeated_names(spark, small_splits):
    rows = [["id", "TITULO", "SOLICITANTE", "ESTADO", "FECHA_APERTURA", "T", "T"], *[[str(i), 'a;"b"\nc', "s", "N/A", "", "1", "2"] for i in range(40)]]
    small_splits(50)
    got = files.read_helpdesk(spark, write(rows, sep=";")).collect()
    assert len(got) == 40 and {(r.TITULO, r.ESTADO, r.T, r["T.1"]) for r in got} == {('a;"b"\nc', None, "1", "2")}


def test_short_long_and_blank_records(spark, small_splits):
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    with open(f"{folder}/1.csv", "w", encoding="utf-8") as f:
        f.write('﻿a,b,c\n1,2\n\n  \n"3\n4",5,6,7\n8,9,"0"')
    small_splits(5)
    got = sorted(map(tuple, files.read_csv(spark, folder).collect()), key=repr)
    assert got == [("1", "2", None), ("3\n4", "5", "6"), ("8", "9", "0")]


def test_loose_quotes_are_refused_not_misread(spark):
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    with open(f"{folder}/1.csv", "w", encoding="utf-8") as f:
        f.write('a,b\n1,5" pipe\n2,x\n3,6" pipe\n')
    with pytest.raises(Exception, match="split=False"):
        files.read_csv(spark, folder).collect()
    assert files.read_csv(spark, folder, split=False).count() == 3
    with open(f"{folder}/1.csv", "w", encoding="utf-8") as f:
        f.write('a,b\n1,"open\n2,x\n')
    with pytest.raises(SchemaError, match="isn't closed"):
        files.read_csv(spark, folder)


def test_empty_files(spark):
    folder = write([["a", "b"]])
    write([], name="2.csv", folder=folder)
    got = files.read_csv(spark, folder)
    assert got.columns == ["a", "b"] and got.collect() == []
