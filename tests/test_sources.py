import csv
import io
import random
import re

from pyspark.sql import functions as F

import pytest

from gridloom.functions.cells import CASE_ALIASES, WD_ALIASES, WS_ALIASES, batch_number, case_id, wall_check_token
from gridloom.functions.angles import wind_direction, wind_direction_text
from gridloom.functions.cells import to_number
from gridloom.plans import batch_run, training_pairs
from gridloom.sources import batch_csv, logs, stage_csv, workspace
from gridloom.sources.lines import read_lines
from tests.conftest import rows


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode() if isinstance(text, str) else text)
    return str(path)


def read_cases(spark, tmp_path, text, name="output_batch_3.csv"):
    return batch_csv.case_columns(batch_csv.read_batches(spark, put(tmp_path / name, text)))


def test_reordered_header_with_carriage_returns(spark, tmp_path):
    df = read_cases(spark, tmp_path, "met__WD_deg,met__WS_mps,Case\r\n270.0,3.5,zeta\r\n")
    got = df.select("batch_id", "row_number", case_id("raw_case"), "raw_ws", "raw_wd").collect()
    assert [tuple(r) for r in got] == [("3", 2, "case_zeta", "3.5", "270.0")]


def test_first_alias_wins(spark, tmp_path):
    df = read_cases(spark, tmp_path, "Case,WS,met__WS_mps,WD,met__WD_deg\nzeta,7.5,3.5,90.0,270.0\n")
    got = df.select("raw_ws", wind_direction_text(to_number("raw_wd"))).collect()
    assert [tuple(r) for r in got] == [("7.5", "90.000")]


def test_directions_have_no_negative_zero_and_round_the_exact_value(spark):
    df = spark.sql("select * from values (0, -0.0D), (1, -360.0D), (2, 0.0625D), (3, 12.3455D), (4, -0.25D), (5, cast(null as double)) t(k, v)")
    got = rows(df.select("k", wind_direction_text(F.col("v")).alias("t"), wind_direction(F.col("v")).cast("string").alias("d")))
    assert got == [
        (0, "0.000", "0.0"), (1, "0.000", "0.0"), (2, "0.062", "0.0625"), (3, "12.345", "12.3455"), (4, "359.750", "359.75"), (5, None, None)
    ]


def test_later_of_two_equal_headers_wins(spark, tmp_path):
    df = read_cases(spark, tmp_path, "Case,cAsE,met__WS_mps,met__WD_deg\nalpha,beta,3.5,270.0\n")
    assert rows(df, case_id("raw_case")) == [("case_beta",)]


def test_blank_lines_count_and_short_rows_are_empty(spark, tmp_path):
    df = read_cases(spark, tmp_path, "met__WD_deg,met__WS_mps,Case\n\n270.0,,zeta\n   \n270.0,3.5,\n270.0,3.5,x,extra,1")
    assert rows(df, "row_number", "raw_ws", "raw_case") == [(3, "", "zeta"), (5, "3.5", ""), (6, "3.5", "x")]


def test_quotes_do_not_protect_commas_in_the_simple_dialect(spark, tmp_path):
    path = put(tmp_path / "b_1.csv", 'note,Case,WS\n"a,b",7,3.5\n')
    simple = batch_csv.read_batch_csv(spark, path)
    assert rows(simple, batch_csv.cell("header", "cells", "Case")) == [('b"',)]
    quoted = batch_csv.read_batch_csv(spark, path, "rfc")
    assert rows(quoted, batch_csv.cell("header", "cells", "Case"), "row_number") == [("7", 2)]


def test_quoted_dialect_drops_the_byte_order_mark(spark, tmp_path):
    path = put(tmp_path / "b_1.csv", b"\xef\xbb\xbfCase , note\n5,\"x\ny\"\n6,z\n")
    df = batch_csv.read_batch_csv(spark, path, "rfc")
    assert rows(df, "row_number", batch_csv.cell("header", "cells", "case"), batch_csv.cell("header", "cells", "note")) == [
        (2, "5", "x\ny"), (3, "6", "z"),
    ]


def test_quoted_records_over_many_splits(spark, tmp_path):
    draw = random.Random(7)
    texts = ["", "a", 'q "x"', "two\nlines", "\n", "a,b", '"', '""\n"', "\n\n,\n", 'mid "quote', "é\n", " ", "x" * 40, "a\r\nb"]
    table = [["id", "a\nwide, header", "b"]] + [[str(i), draw.choice(texts), draw.choice(texts)] for i in range(90)]
    for end in ("\n", "\r\n"):
        out = io.StringIO()
        csv.writer(out, lineterminator=end).writerows(table)
        path = put(tmp_path / f"b_{len(end)}.csv", out.getvalue() + '7,5" pipe,tail"s' + end + end + '"8"x,"",z"')
        want = [r for r in csv.reader(io.StringIO(open(path, newline="").read(), newline="")) if r]
        for size in ("200", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            try:
                df = batch_csv.read_batch_csv(spark, path, "rfc")
                got = [(r.row_number, list(r.header), list(r.cells)) for r in df.orderBy("row_number").collect()]
                splits = batch_csv.read_splits(spark, path).select("_start").distinct().count()
            finally:
                spark.conf.unset("spark.sql.files.maxPartitionBytes")
            assert got == [(i, want[0], r) for i, r in enumerate(want[1:], 2)]
            assert splits > 8 if size == "200" else splits == 1


def test_quoted_lines_are_not_sorted_and_batches_of_a_task_go_on(spark, tmp_path):
    draw = random.Random(3)
    texts = ["", "a", 'q "x"', "two\nlines", "\n\n", '"', "\n\n,\n", "a\r\nb"]
    want = {}
    for name in ("b_1.csv", "b_2.csv", "b_3.csv"):
        out = io.StringIO()
        csv.writer(out).writerows([["id", "a\nwide, header"]] + [[str(i), draw.choice(texts)] for i in range(12)] + [[], ["7", "x"]])
        put(tmp_path / name, ("\ufeff" + out.getvalue()).encode())
        table = [r for r in csv.reader(io.StringIO(out.getvalue(), newline="")) if r]
        want |= {(name, i): (table[0], r) for i, r in enumerate(table[1:], 2)}
    for batch, size in (("1", "128m"), ("3", "60"), ("10000", "60")):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            df = batch_csv.read_batch_csv(spark, f"{tmp_path}/*.csv", "rfc")
            plan = df._jdf.queryExecution().executedPlan().toString()
            got = {(r.file_name, r.row_number): (list(r.header), list(r.cells)) for r in df.collect()}
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert got == want
        # Tasks that sort the lines of their splits need memory that grows with the table.
        assert not re.search(r"Sort \[[^\]]*_id#", plan)


def test_quoted_files_are_read_once(spark, tmp_path):
    df = batch_csv.read_batch_csv(spark, put(tmp_path / "b_1.csv", 'Case,n\n1,"a\nb"\n'), "rfc")
    assert "FileScan text" not in df._jdf.queryExecution().executedPlan().toString()
    assert rows(df, "row_number", F.to_json("cells")) == [(2, '["1","a\\nb"]')]


def test_quoted_files_that_are_empty_or_never_closed(spark, tmp_path):
    put(tmp_path / "b_1.csv", "")
    put(tmp_path / "b_2.csv", 'Case,n\n1,"open\n2,x\n')
    got = batch_csv.read_batch_csv(spark, f"{tmp_path}/b_*.csv", "rfc")
    assert rows(got, "file_name", "row_number", F.to_json("cells")) == [("b_2.csv", 2, '["1","open\\n2,x"]')]


def test_deep_and_wide_workspaces_are_listed_level_by_level(spark, tmp_path):
    root = tmp_path / "ws"
    for i in range(40):
        put(root / "batch_1" / "case_wide" / f"t{i}" / "U.gz", "x" * i)
    put(root / "batch_1" / "case_deep" / "a" / "b" / "c" / "d" / "marker", "")
    put(root / "batch_2" / "summary.csv", "abc")
    (root / "batch_3").mkdir()
    want = sorted((str(f), f.stat().st_size) for f in root.rglob("*") if f.is_file())
    assert rows(workspace.read_workspace(spark, str(root)), "path", "length") == want
    two = [str(root / "batch_2"), str(root / "batch_3") + "/"]
    assert rows(workspace.read_workspace(spark, two), "path", "length") == [(str(root / "batch_2" / "summary.csv"), 3)]
    with pytest.raises(ValueError, match="levels deep"):
        workspace.read_workspace(spark, str(root), max_depth=3)


def test_natural_order_and_missing_columns(spark, tmp_path):
    for i in (10, 2):
        put(tmp_path / f"output_batch_{i}.csv", "Case,WD\n1,2\n")
    df = batch_csv.read_batches(spark, str(tmp_path / "output_batch_*.csv"))
    assert rows(df, "file_ord", "batch_id") == [(1, "2"), (2, "10")]
    missing = batch_csv.require_columns(df, CASE_ALIASES, WS_ALIASES, WD_ALIASES)
    assert {tuple(r["missing"]) for r in missing.collect()} == {("WS",)}


def test_line_numbers_over_many_splits(spark, tmp_path):
    path = put(tmp_path / "long.log", "".join(f"{i}\n" for i in range(1, 5001)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        df = read_lines(spark, path)
        assert df.filter(F.col("line") != F.col("line_no").cast("string")).count() == 0
        assert df.count() == 5000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_batch_numbers_and_tokens(spark):
    df = spark.createDataFrame([("output_batch_07.csv",), ("BATCH-3x9.csv",), ("run12.csv",), ("none.csv",)], "n string")
    assert [r[0] for r in df.select(batch_number("n")).collect()] == ["07", "3", "12", None]
    assert spark.range(1).select(wall_check_token(F.lit("a/b  c#"))).first()[0] == "a_b__c_"


def test_params_map_keeps_the_last_of_equal_headers(spark):
    from gridloom.operators.cases import params_map

    df = spark.createDataFrame([(["A", "b", " a "], ["1", "2"])], "h array<string>, c array<string>")
    assert df.select(params_map(F.col("h"), F.col("c"))).first()[0] == {"b": "2", "a": ""}


def test_summary_round_trip_keeps_quotes_commas_and_newlines(spark, tmp_path):
    message = 'see "log", /w/a b.log\nnext'
    df = spark.createDataFrame([("c.csv", "2", "case_1", "case_1/flow", "/d", "failed", message)], list(stage_csv.STAGE_COLUMNS["mesh"]))
    stage_csv.write_stage_results(df, "mesh", str(tmp_path / "batch_4" / stage_csv.STAGE_FILES["mesh"]))
    back = stage_csv.read_stage_results(spark, str(tmp_path), ["mesh"])
    assert rows(back, "batch_id", "stage", "case_id", "status", "message") == [("4", "mesh", "case_1", "failed", message)]
    assert df.select(stage_csv.quote_field(F.col("message"))).first()[0] == '"see ""log"", /w/a b.log\nnext"'


def test_key_values_split_at_the_first_sign(spark, tmp_path):
    put(tmp_path / "_mesh_state" / "a.state", "case=case_1\nmessage=a=b\nstage=x\n")
    df = stage_csv.read_kv(spark, str(tmp_path / "_mesh_state"), ["case", "message", "log"])
    assert rows(df, "case", "message", "log") == [("case_1", "a=b", None)]


def test_stl_and_tool_log(spark, tmp_path):
    facet = "facet normal 0 0 1\nouter loop\nvertex 0 0 0\nvertex 1 0 0\nvertex 0 1e0 0\nendloop\nendfacet\n"
    path = put(tmp_path / "cup.stl", "solid cup\n" + facet * 2 + "endsolid cup\n")
    df = logs.read_stl(spark, path)
    assert rows(df, "surface", "facet_id", "vertex_no", "y")[2] == ("cup", 0, 2, 1.0)
    assert df.count() == 6
    line = "Set centre of rotation to (297.57 -836.476 22.985)\n"
    log = logs.parse_tool_log(read_lines(spark, put(tmp_path / "t.log", line)))
    assert rows(log, "centre", "bounds") == [([297.57, -836.476, 22.985], None)]


def test_documents(spark, tmp_path):
    put(tmp_path / "s" / "a.json", '{"wind_speed_mps": 2.0,\n "stability": "neutral"}')
    df = workspace.read_scenarios(spark, str(tmp_path / "s"))
    assert df.first()["params"] == {"wind_speed_mps": "2.0", "stability": "neutral"}
    put(tmp_path / "bad" / "a.json", "[1, 2]")
    with pytest.raises(Exception, match="not a JSON object"):
        workspace.read_scenarios(spark, str(tmp_path / "bad")).collect()


def test_status_report_of_real_files(spark, tmp_path):
    csv = put(tmp_path / "output_batch_1.csv", "Case,WS,WD\n0,1,2\n1,1,2\n0,1,2\n,1,2\n")
    root = tmp_path / "out"
    put(root / "batch_1" / "case_0" / "flow" / "restart.marker", "")
    put(root / "batch_1" / "case_0" / "vtk" / "post_processing.complete", "")
    df = batch_run.report_status(spark, csv, str(root))
    assert rows(df) == [
        ("1", "case_0", "present", "present", "absent", "absent", "present"),
        ("1", "case_1", "absent", "absent", "absent", "absent", "absent"),
    ]


def test_training_pairs_of_real_files(spark, tmp_path):
    csv = put(tmp_path / "b.csv", "Case,x\n1,a\n2,b\n1,c\n,d\n3,e\n4,f\n")
    root = tmp_path / "data"
    for p in ("case_1/vtk/flow_0.vtu", "case_1/vtk/flow_latest_9.vtu", "case_1/vtk/flow_latest_10.vtu",
              "case_3/flow/vtk/flow_0.vtu", "case_4/vtk/flow_0.vtu", "cases/case_4/vtk/flow_0.vtu"):
        put(root / p, "")
    got = {r["row_number"]: r for r in training_pairs.discover(spark, csv, str(root)).collect()}
    assert got[2]["output_vtu"] == f"{root}/case_1/vtk/flow_latest_10.vtu" and got[2]["problem"] is None
    assert got[3]["problem"].startswith("Cannot find flow_0.vtu for 'case_2'")
    assert got[4]["problem"] == "Duplicate case in CSV: case_1" and got[4]["case_id"] == "1"
    assert got[5]["problem"] == "Empty Case value" and got[5]["case_id"] == "row_5"
    assert got[6]["problem"] == f"No flow_latest_#.vtu found in {root}/case_3/flow/vtk"
    assert got[7]["problem"] == (
        f"Multiple VTK directories found for case_4: {root}/case_4/vtk, {root}/cases/case_4/vtk"
    )
