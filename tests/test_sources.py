import os
import tempfile

import pytest

from casemill.operators import lookups
from casemill.operators.quality import RuleError, SchemaError
from casemill.sources import files, rules, sinks, tables


@pytest.fixture()
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def write(folder, name, content):
    path = f"{folder}/{name}"
    with open(path, "w", encoding="utf-8") as f:
        f.write(content)
    return path


def test_helpdesk_file(spark, folder):
    path = write(
        folder, "h.csv",
        'id;TITULO;SOLICITANTE;ESTADO;FECHA_APERTURA;TIEMPO_SOLUCION;TIEMPO_SOLUCION\n'
        '1;"two\nlines; and ""quotes""";Ana;N/A;2026-01-01 00:00:00;x;5 horas\n2;;Luz;Abierto;;y;\n',
    )
    out = files.read_helpdesk(spark, path).collect()
    assert out[0].TITULO == 'two\nlines; and "quotes"' and out[0].ESTADO is None
    assert out[0]["TIEMPO_SOLUCION.1"] == "5 horas" and out[1].TITULO is None and out[1]["TIEMPO_SOLUCION.1"] is None


def test_missing_column_is_named(spark, folder):
    path = write(folder, "x.csv", "a,b\n1,2\n")
    with pytest.raises(SchemaError, match="username_resp"):
        files.read_specialist_dictionary(spark, path)


def test_dictionary_in_file_order(spark, folder):
    path = write(folder, "d.csv", "username_ufinal,usuariofinal\n" + "".join(f"u{i},N{i}\n" for i in range(50)))
    out = files.read_user_dictionary(spark, path).orderBy("_row").collect()
    assert [r.username_ufinal for r in out] == [f"u{i}" for i in range(50)]


def test_suite_exports(spark, folder):
    case = "NúMERO DE CASO,CUMPLIMIENTO ANS,LOGIN RESPONSABLE,LOGIN USUARIO FINAL\nIN-1,Cumple,a,b\n"
    task = "NUMERO DE LA TAREA,RESPONSABLE TAREA,LOGIN AUTOR TAREA,ESTADO TAREA\n1,r,a,c\n"
    paths = {k: write(folder, f"{k}.csv", task if k == "tareas" else case) for k in files.SUITE_FILES}
    assert {k: df.count() for k, df in files.read_suite_exports(spark, paths).items()} == dict.fromkeys(paths, 1)
    bad = dict(paths, cambios=write(folder, "bad.csv", case.replace("NúMERO DE CASO", "x")))
    with pytest.raises(ValueError, match="case number"):
        files.read_suite_exports(spark, bad)


def test_repeated_headers():
    assert files.distinct_names(["a", "b", "a", "a"]) == ["a", "b", "a.1", "a.2"]


def test_rule_files(spark, folder):
    path = write(folder, "r.json", '{"from":"a","to":"b"}\n{"from":"a","to":"c"}\n')
    table = rules.replacement_rules(rules.read_rule_entries(spark, path))
    assert [tuple(r) for r in table.table.collect()] == [("a", "c")]
    csv = write(folder, "r.csv", "match_servicio,proyecto\nDEV,Software\n")
    projects = rules.project_rules(rules.read_rule_entries(spark, csv, "csv"))
    assert [tuple(r) for r in projects.table.collect()] == [("DEV", "Software")]
    with pytest.raises(RuleError, match="rows without"):
        rules.replacement_rules(rules.read_rule_entries(spark, write(folder, "n.json", '{"from":"a","to":null}\n{"from":"b","to":"c"}\n')))


def test_files_of_a_folder_need_one_header(spark, folder):
    write(folder, "1.csv", "a,b\n1,2\n")
    assert [tuple(r) for r in files.read_csv(spark, folder).collect()] == [("1", "2")]
    write(folder, "2.csv", "b,a\n9,8\n")
    for multi_line in (True, False):
        with pytest.raises(Exception, match="(?i)header"):
            files.read_csv(spark, folder, multi_line=multi_line).collect()
        with pytest.raises(SchemaError, match="different headers"):
            files.read_csv(spark, folder, columns=["x", "y"], multi_line=multi_line)


def test_repeated_names_are_compared_beforehand(spark, folder):
    write(folder, "1.csv", "\ufeffa,b,a\n1,2,3\n")
    assert [r.asDict() for r in files.read_csv(spark, folder).collect()] == [{"a": "1", "b": "2", "a.1": "3"}]
    write(folder, "2.csv", "a,a,b\n1,2,3\n")
    with pytest.raises(SchemaError, match="different headers"):
        files.read_csv(spark, folder)


def test_byte_order_marks_are_no_part_of_a_name(spark, folder):
    write(folder, "1.csv", "\ufeffa,b\n1,2\n")
    write(folder, "2.csv", "a,b\n3,4\n")
    for multi_line in (True, False):
        got = files.read_csv(spark, folder, multi_line=multi_line).collect()
        assert sorted((r.a, r.b) for r in got) == [("1", "2"), ("3", "4")]


def test_last_row_of_the_last_file_wins(spark, folder):
    write(folder, "part-0.csv", "username_ufinal,usuariofinal\nu1,old\n")
    write(folder, "part-1.csv", "username_ufinal,usuariofinal\n" + "".join(f"x{i},N\n" for i in range(400)) + "u1,new\n")
    write(folder, "part-2.csv", "username_ufinal,usuariofinal\nu2,last\n")
    names = lookups.forward_dictionary(files.read_user_dictionary(spark, folder), "username_ufinal", "usuariofinal")
    got = {r.key: r.value for r in names.where("key IN ('u1', 'u2')").collect()}
    assert got == {"u1": "new", "u2": "last"}


def test_helpdesk_can_be_split(spark, folder):
    head = "id;TITULO;SOLICITANTE;ESTADO;FECHA_APERTURA\n"
    path = write(folder, "h.csv", head + "".join(f"{i};t;s;e;2026-01-01\n" for i in range(3000)))
    assert files.read_helpdesk(spark, path, multi_line=False).count() == 3000


def test_report_sink(rows, spark, folder):
    df = rows("a int, b int", (1, 2))
    path = sinks.write_report(df, f"{folder}/r", ["b", "a"])
    assert spark.read.parquet(path).columns == ["b", "a"]
    with pytest.raises(SchemaError):
        sinks.write_report(df, f"{folder}/x", ["a"])
    with pytest.raises(Exception, match="(?i)exists"):
        sinks.write_report(df, path, ["b", "a"], overwrite=False)


def test_a_write_that_fails_leaves_the_old_table(rows, spark, folder):
    path = sinks.write_interim(rows("a int", (1,), (2,)), f"{folder}/t")
    bad = spark.range(0, 100, 1, 4).selectExpr("CAST(IF(id = 99, raise_error('no'), id) AS INT) AS a")
    with pytest.raises(Exception, match="no"):
        sinks.write_interim(bad, path)
    assert sorted(r.a for r in spark.read.parquet(path).collect()) == [1, 2]
    assert os.listdir(folder) == ["t"]
    # the new table may be made from the old one
    sinks.write_interim(spark.read.parquet(path).selectExpr("a + 1 AS a"), path)
    assert sorted(r.a for r in spark.read.parquet(path).collect()) == [2, 3]
    with pytest.raises(FileExistsError, match="exists"):
        sinks.write_interim(rows("a int", (1,)), path, overwrite=False)


def test_a_replacement_left_between_its_renames_is_taken_up(rows, spark, folder):
    path = sinks.write_interim(rows("a int", (1,)), f"{folder}/t")
    os.rename(path, f"{path}{sinks.OLD}x")
    rows("a int", (7,)).write.parquet(f"{path}{sinks.NEW}x")
    sinks.recover(spark, path)
    assert [r.a for r in spark.read.parquet(path).collect()] == [1] and os.listdir(folder) == ["t"]


def test_rows_are_counted_while_they_are_written(rows, spark, folder):
    from pyspark.sql import functions as F

    path, counts = sinks.write_counted(rows("a int, b int", (1, 2), (3, None)), f"{folder}/t", ["b", "a"], missing=F.count_if(F.col("b").isNull()))
    assert counts == {"rows": 2, "missing": 1} and spark.read.parquet(path).columns == ["b", "a"]
    assert sinks.write_counted(rows("a int"), f"{folder}/e")[1] == {"rows": 0}


def test_snapshot_failure_only_warns(rows, folder):
    good, bad = rows("a int", (1,)), rows("a int", (1,)).selectExpr("raise_error('no') AS a")
    assert list(sinks.write_snapshots({"good": good, "bad": bad}, folder, "p")) == ["good"]


def test_jdbc_options():
    with pytest.raises(ValueError, match="one_task"):
        tables.jdbc_options("jdbc:x", "cases")
    plain = tables.jdbc_options("jdbc:x", "cases", one_task=True)
    assert plain["dbtable"] == "cases" and "numPartitions" not in plain
    sliced = tables.jdbc_options("jdbc:x", "cases", "id", (0, 100), 8)
    assert (sliced["partitionColumn"], sliced["upperBound"], sliced["numPartitions"]) == ("id", "100", "8")
    with pytest.raises(ValueError):
        tables.jdbc_options("jdbc:x", "cases", "id")


def test_employee_master(rows):
    employees = rows(
        "cod_empl bigint, nom_empl string, ape_empl string, box_mail string",
        (1, "Ana  ", "Peña ", "aperez@corp"), (2, "No", "Mail", "none"), (3, "No", "Post", "np@corp"),
    )
    posts = rows("cod_empl bigint", *[(1,)] * 5, (2,))
    out = tables.employee_master(employees, posts).collect()
    assert [tuple(r) for r in out] == [("Ana Peña", "1", "aperez")]


def test_slices_follow_the_rows(spark):
    """A crowded part, a wide gap, a value with many rows, missing ones."""
    values = [*range(5000), *range(10**9, 10**9 + 900), *[77] * 3000, *[None] * 50, -5]
    spark.createDataFrame([(v,) for v in values], "id bigint").createOrReplaceTempView("sliced")

    def ask(query):
        return spark.sql(query).collect()

    found = tables.slice_predicates(ask, "sliced", "id", 8)
    sizes = [ask(f"SELECT count(*) FROM sliced WHERE {p}")[0][0] for p in found]
    assert sum(sizes) == len(values) and len(found) >= 2
    spark.createDataFrame([(v * 7,) for v in range(8000)], "id bigint").createOrReplaceTempView("sliced")
    even = tables.slice_predicates(ask, "sliced", "id", 8)
    sizes = [ask(f"SELECT count(*) FROM sliced WHERE {p}")[0][0] for p in even]
    assert len(even) >= 8 and sum(sizes) == 8000 and max(sizes) <= 1000
    spark.createDataFrame([], "id bigint").createOrReplaceTempView("sliced")
    assert tables.slice_predicates(ask, "sliced", "id", 8) == ["1 = 1"]


def test_exports_have_as_many_files_as_their_size_asks_for(spark, tmp_path):
    from pathlib import Path

    from casemill.registry import exports

    spark.range(2_000_000).selectExpr("CAST(id AS STRING) AS a", "CAST(id * 7 AS STRING) AS b").write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    files = lambda df: len(list(Path(exports.write_csv(df, "x", parts=2).removeprefix("file:")).glob("part-*")))
    assert files(rows) > 2 and files(rows.limit(10)) <= 2


def test_exports_leave_no_shuffle_files(spark, tmp_path):
    import time

    from casemill.registry import exports
    from casemill.session import SHUFFLES_GO

    kept = lambda: {f for f in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f}
    setting, before = spark.conf.get(SHUFFLES_GO), kept()
    spark.range(10_000).selectExpr("CAST(id AS STRING) AS a").write.parquet(f"{tmp_path}/rows")
    exports.write_csv(spark.read.parquet(f"{tmp_path}/rows"), "x", parts=2)
    until = time.time() + 10
    while kept() - before and time.time() < until:  # the executors are told, not waited for
        time.sleep(0.1)
    assert kept() <= before and spark.conf.get(SHUFFLES_GO) == setting


def test_extended_exports_take_little_more_room_than_their_tables(spark, tmp_path, monkeypatch):
    from pathlib import Path

    from casemill import session
    from casemill.registry import all_queries

    monkeypatch.setattr(session, "shared_dir", lambda spark: f"{tmp_path}/scratch")
    some = lambda n, salt: f"pmod(xxhash64(id, {salt}), {n})"
    spark.range(60_000).selectExpr(
        "id DIV 4 AS l_orderkey", f"{some(20_000, 1)} AS l_partkey", f"{some(1_000, 2)} AS l_suppkey", "CAST(id % 4 + 1 AS INT) AS l_linenumber",
        f"{some(50, 3)} * 1.0D AS l_quantity", f"{some(10_000_000, 4)} / 100D AS l_extendedprice", f"{some(11, 5)} / 100D AS l_discount", f"{some(9, 6)} / 100D AS l_tax",
        "CASE id % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'N' WHEN 2 THEN 'R' END AS l_returnflag", "'F' AS l_linestatus", f"TIMESTAMP '1992-01-01' + make_dt_interval(CAST({some(2_500, 7)} AS INT)) AS l_shipdate",
    ).repartition(1).write.parquet(f"{tmp_path}/in/lineitem.parquet")
    spark.range(15_000).selectExpr("id AS o_orderkey", "'F' AS o_orderstatus", f"{some(10_000_000, 8)} / 100D AS o_totalprice", "'1-URGENT' AS o_orderpriority").repartition(1).write.parquet(f"{tmp_path}/in/orders.parquet")
    out = all_queries()["s2_extended_export"](spark, f"{tmp_path}/in")
    counts = {r.kind: (r.n, r.two) for r in out.groupBy("kind").agg({"*": "count"}).toDF("kind", "n").join(out.where("cells LIKE '%\n%'").groupBy("kind").count().toDF("kind", "two"), "kind").collect()}
    assert {k: n for k, (n, _) in counts.items()} == {"incidentes": 15_000, "requerimientos": 15_000, "cambios": 30_000, "problemas": 15_000}
    assert all(two > 1_000 for _, two in counts.values()) and out.select("kind", "number").distinct().count() == 75_000
    size = lambda at: sum(f.stat().st_size for f in Path(at).rglob("part-*"))
    assert 0 < size(f"{tmp_path}/scratch") < 4 * size(f"{tmp_path}/in")
