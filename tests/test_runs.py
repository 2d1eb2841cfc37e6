"""Golden decisions and reports."""

from pyspark.sql import functions as F

from gridloom.operators import cases, convergence, inventory, report
from gridloom.sources import logs
from gridloom.sources.stage_csv import STAGES
from tests.conftest import rows


def files(spark, *paths):
    df = spark.createDataFrame([(f"/ws/batch_1/case_0/{p}",) for p in paths], "path string")
    return inventory.parse_inventory(df)


def stored(spark, text):
    return spark.createDataFrame([("1", "case_0", text)], "batch_id string, case_id string, stored_signature string")


def test_setup_golden_rows(spark):
    df = spark.createDataFrame(
        [("1", 2, "zeta", "", "270.0"), ("1", 3, "", "3.5", "270.0"), ("1", 5, "a", "3.5", "x"), ("1", 6, "b", "0", "-90")],
        "batch_id string, row_number long, raw_case string, raw_ws string, raw_wd string",
    )
    none = spark.createDataFrame([("1", "case_b", "flow")], "batch_id string, case_id string, domain string")
    got = rows(cases.setup_status(df, none, "/out", dry_run=True), "row_number", "case_name", "wd", "status", "message")
    assert got == [
        (2, "", "270.0", "failed", "invalid WS"),
        (3, "NA/flow", "270.000", "dry_run", "would create flow case"),
        (3, "NA/trd", "270.000", "dry_run", "would create transport case"),
        (5, "", "x", "failed", "invalid WD"),
        (6, "case_b/flow", "270.000", "dry_run", "would create flow case"),
        (6, "case_b/trd", "270.000", "dry_run", "would create transport case"),
    ]
    made = rows(cases.setup_status(df.filter("row_number = 6"), none, "/out", mode="epsilon"), "case_dir", "ws_for_setup", "status")
    assert made == [("/out/batch_1/case_b/flow", "0.001", "skipped"), ("/out/batch_1/case_b/trd", "0.001", "created")]


def test_setup_of_a_negative_zero_direction(spark):
    df = spark.createDataFrame(
        [("1", 2, "a", "3.5", "-0.00"), ("1", 3, "b", "-0.00", "-0.00"), ("1", 4, "c", "3.5", "0.0625")],
        "batch_id string, row_number long, raw_case string, raw_ws string, raw_wd string",
    )
    none = spark.createDataFrame([], "batch_id string, case_id string, domain string")
    kept = cases.setup_status(df, none, "/out", mode="keep")
    assert rows(kept.distinct(), "row_number", "wd", "status") == [
        (n, wd, "created") for n, wd in ((2, "0.000"), (3, "0.000"), (4, "0.062")) for _ in ("flow", "trd")
    ]
    dry = cases.setup_status(df, none, "/out", mode="skip", dry_run=True)
    assert rows(dry.select("row_number", "wd", "status").distinct()) == [
        (2, "0.000", "dry_run"), (3, "0.000", "skipped"), (4, "0.062", "dry_run")
    ]


def test_post_sequence(spark):
    base = ["flow/0/U", "flow/3000/U", "trd/constant/polyMesh/points", "trd/0/T", "trd/300/T"]
    vtk = ["vtk/flow_0.vtu", "vtk/flow_latest_3000.vtu", "vtk/trd_0.vtu", "vtk/trd_300.vtu", "vtk/post_processing.complete"]
    first = files(spark, *base)
    assert inventory.post_decision(first, stored(spark, "")).first()["decision"] == "rebuild"
    signature = inventory.post_signature(first).first()["signature"]
    assert signature.split("\n")[:3] == ["flow_latest=3000", "transport_ready=1", "transport_times=0,300"]
    done = files(spark, *base, *vtk)
    again = inventory.post_decision(done, stored(spark, signature)).first()
    assert (again["decision"], again["message"]) == ("skip", "source results unchanged; existing VTU outputs reused")
    assert inventory.post_decision(done, stored(spark, signature), force=True).first()["decision"] == "rebuild"
    grown = files(spark, *base, "trd/600/T", *vtk)
    assert inventory.post_decision(grown, stored(spark, signature)).first()["decision"] == "rebuild"
    lost = files(spark, *base, *[v for v in vtk if "trd_300" not in v])
    assert inventory.post_decision(lost, stored(spark, signature)).first()["decision"] == "rebuild"
    # Readiness 1 -> 0 changes the signature.
    bare = files(spark, "flow/0/U", "flow/3000/U", "trd/0/T", *vtk)
    assert inventory.post_decision(bare, stored(spark, signature)).first()["status"] == "completed"


def test_times_are_numbers(spark):
    inv = files(spark, "trd/0/T", "trd/60/T", "trd/120.5/T", "trd/.5/T")
    assert inventory.time_list(inv, "trd").first()["times"] == "0,.5,60,120.5"
    assert inventory.latest_time(inv, "trd").first()["latest_time"] == "120.5"
    req = spark.createDataFrame([("1", "case_0", t) for t in ("60.0", "0.50", "61")], "batch_id string, case_id string, req_name string")
    have = inventory.times(inv, "trd").withColumn("list_ord", F.col("time_value"))
    matched = inventory.match_times(req, have)
    assert rows(matched, "req_name", "matched_time") == [("0.50", ".5"), ("60.0", "60"), ("61", None)]
    text = inventory.unmatched_times(matched, inventory.time_list(inv, "trd")).first()["message"]
    assert text == "Requested time 61 was not written by the solver. Available times: 0,.5,60,120.5"


def test_large_times_match_with_relative_tolerance(spark):
    req = spark.createDataFrame([("a", "123456789"), ("a", "5")], "c string, req_name string")
    have = spark.createDataFrame([("a", "123456789.01", 1), ("a", "5.000000001", 2)], "c string, time_name string, list_ord int")
    assert rows(inventory.match_times(req, have, ["c"]), "req_name", "matched_time") == [("123456789", "123456789.01"), ("5", None)]


def test_requested_times_are_not_broadcast(spark):
    """A few rows with long arrays of times look small to Spark, but their requests may be many."""
    req = spark.range(3).select(F.col("id").alias("c"), F.explode(F.sequence(F.lit(0), F.lit(9)).cast("array<string>")).alias("req_name"))
    have = spark.range(60).select((F.col("id") % 3).alias("c"), (F.col("id") % 20 * 2).cast("string").alias("time_name"), F.col("id").alias("list_ord"))
    matched = inventory.match_times(req, have, ["c"])
    assert "Broadcast" not in matched._jdf.queryExecution().executedPlan().toString()
    assert matched.count() == 30 and {r["req_name"] for r in matched.filter("matched_time is null").collect()} <= set("13579")


def test_run_report_golden(spark):
    plan = spark.createDataFrame([(1, "7")], "ordinal int, batch_id string")
    batches = spark.createDataFrame([("7", "failed")], "batch_id string, batch_result string")
    stages = spark.createDataFrame([("7", "setup", "succeeded"), ("7", "mesh", "failed")], "batch_id string, stage string, stage_result string")
    results = spark.createDataFrame(
        [("7", "setup", "2", "case_0", "created", "x"), ("7", "setup", "3", "case_1", "created", "x"),
         ("7", "mesh", "2", "case_0", "meshed", "OK"), ("7", "mesh", "3", "case_1", "failed", "see log: /w/logs/case_1.log"),
         ("7", "mesh", "4", "case_2", "failed", "mesh precondition not satisfied"), ("7", "flow", "2", "case_0", "solved", "old")],
        "batch_id string, stage string, row_number string, case_id string, status string, message string",
    )
    got = report.run_report(plan, batches, stages, results, ["flow", "setup", "mesh"]).orderBy("stage_ordinal")
    assert [tuple(r) for r in got.select("stage", "stage_result", "total", "succeeded", "skipped", "failed", "other").collect()] == [
        ("setup", "succeeded", "2", "2", "0", "0", "0"),
        ("mesh", "failed", "3", "1", "0", "2", "0"),
        ("flow", "not_attempted", "unknown", "unknown", "unknown", "unknown", "unknown"),
    ]
    failures = report.in_report_order(report.failed_rows(results.filter("stage <> 'flow'")))
    assert [tuple(r) for r in failures.select("case_id", "log_path").collect()] == [("case_1", "/w/logs/case_1.log"), ("case_2", "unavailable")]
    assert tuple(report.run_totals(plan, batches).first()) == (1, 1, 0, 1, 0)
    assert report.stage_order(["flow", "setup"]) == ["setup", "flow"] and len(STAGES) == 5


def test_stuck_run_is_not_converged(spark):
    text = [
        "Time = 2999", "smoothSolver:  Solving for Uy, Initial residual = 1e-9, Final residual = 1e-10, No Iterations 1",
        "Time = 3000", "smoothSolver:  Solving for Uy, Initial residual = 1.74519e-4, Final residual = 1e-6, No Iterations 2",
        "GAMG:  Solving for p, Initial residual = 1.36639e-3, Final residual = 1e-5, No Iterations 9",
        "GAMG:  Solving for p, Initial residual = 1.46973e-4, Final residual = 1e-5, No Iterations 3",
        "time step continuity errors : sum local = 1e-08, global = -2e-10, cumulative = 3e-07",
    ]
    df = spark.createDataFrame([("l", i + 1, t) for i, t in enumerate(text)], "path string, line_no long, line string")
    log = logs.parse_solver_log(df, block=2)
    got = convergence.convergence(log).first()
    assert (got["final_time"], got["residuals"], got["above_limit"], got["converged"]) == (3000.0, 3, 3, False)
    assert rows(convergence.last_residuals(log), "field", "solve_no") == [("Uy", 1), ("p", 1), ("p", 2)]


def test_mean_speed_states(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0, 3.0, 4.0, 0.0), ("a", 1.0, 2.0, 0.0, 0.0, 1.0), ("b", 1.0, 0.0, 1.0, 0.0, 0.0)],
                               "c string, time double, volume double, ux double, uy double, uz double")
    assert rows(convergence.mean_speed(df, ["c"]), "c", "cells", "mean_speed") == [("a", 2, 3.0), ("b", 1, None)]
