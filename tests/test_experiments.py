import pytest
from pyspark.sql import functions as F

from gridloom.operators import doe
from gridloom.plans.campaign import default_factors, plan_campaign, write_campaign
from gridloom.sources import batch_csv


def test_classification():
    assert doe.classify_param("x", (0.0, 1850.0, 2)) == {"name": "x", "kind": "discrete", "levels": [0.0, 1850.0]}
    assert doe.classify_param("x", (0.5, 4.5))["kind"] == "continuous"
    assert doe.classify_param("x", (2, 2)) == {"name": "x", "kind": "fixed", "value": 2.0}
    assert doe.classify_param("x", [7]) == {"name": "x", "kind": "fixed", "value": 7}
    assert doe.classify_param("x", (True, 2))["kind"] == "fixed"
    assert doe.classify_param("x", (0.0, 1.0, 1)) == {"name": "x", "kind": "fixed", "value": 0.0}
    for bad in ([], (0.0, 1.0, 0), (2.0, 1.0), (2.0, 1.0, 3)):
        with pytest.raises(ValueError):
            doe.classify_param("x", bad)
    with pytest.raises(ValueError):
        doe.normalize_params({"wind": 1.0})
    with pytest.raises(ValueError):
        doe.normalize_params({"met__WS_mps": 1.0, " met__WS_mps": 2.0})


def test_strata_are_hit_once_at_any_partitioning(spark):
    a = doe.lhs(spark, 97, 3, seed=4, partitions=1)
    b = doe.lhs(spark, 97, 3, seed=4, partitions=13)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    for d in range(3):
        strata = sorted(int(r["u"] * 97) for r in a.filter(F.col("dim") == d).collect())
        assert strata == list(range(97))
    assert sorted(map(tuple, doe.lhs(spark, 97, 3, seed=5).collect())) != sorted(map(tuple, a.collect()))


def test_row_numbers_in_many_partitions(spark):
    df = spark.range(0, 20_000, 1, 7).select((F.col("id") * 37 % 20_011).alias("k"))
    for parts in (1, 4, 64):
        numbered = doe.global_row_number(df, "k", "n", partitions=parts)
        got = [tuple(r) for r in numbered.orderBy("k").collect()]
        assert [n for _, n in got] == list(range(1, 20_001))


def test_row_numbers_by_text_date_and_tied_keys(spark):
    df = spark.range(0, 3000, 1, 5).select(
        F.concat(F.lit("case_"), (F.col("id") * 7 % 3001).cast("string")).alias("t"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") * 7 % 3001).cast("int")).alias("d"),
        F.lit(1).alias("same"),
        F.when(F.col("id") % 2 == 0, F.col("id")).alias("half_null"),
    )
    for key in ("t", "d", "same", "half_null"):
        got = [tuple(r) for r in doe.global_row_number(df, key, "n", partitions=16).select("n", key).orderBy("n").collect()]
        assert [n for n, _ in got] == list(range(1, 3001))
        keys = [k for _, k in got if k is not None]
        assert keys == sorted(keys) and all(k is None for _, k in got[: 3000 - len(keys)])


def test_default_campaign(spark, tmp_path):
    plan = plan_campaign(spark, default_factors(), n=128, seed=1)
    assert plan.combinations.first()[0] == 27_648
    assert len(plan.table.columns) == 81
    found = plan.table.toPandas()
    assert sorted(found["Case"]) == list(range(128)) and not found.drop(columns="Case").duplicated().any()
    audit = plan.audit.toPandas()
    assert set(audit.groupby("parameter")["count"].sum()) == {128}
    write_campaign(plan, str(tmp_path))
    back = batch_csv.read_batch_csv(spark, f"{tmp_path}/batches/batch_id=*/*.csv")
    sizes = back.groupBy("path").count().select("count").collect()
    assert [r[0] for r in sizes] == [16] * 8


def test_all_discrete_space_is_filled_and_then_exhausted(spark):
    factors = {"met__WS_mps": [1.0, 2.0, 3.0], "met__stability": ["a", "b"], "terrain__z0_m": 0.1}
    table = doe.generate(spark, factors, 6, seed=3)
    assert table.select("met__WS_mps", "met__stability").distinct().count() == 6
    with pytest.raises(RuntimeError):
        doe.generate(spark, factors, 7, seed=3, max_attempts=2)
    assert doe.generate(spark, factors, 9, seed=3, unique=False).count() == 9
    with pytest.raises(ValueError):
        doe.generate(spark, {"met__WS_mps": 1.0}, 2, seed=3)


def test_case_names_and_prefix(spark):
    table = doe.generate(spark, {"met__WS_mps": (0.0, 1.0)}, 3, seed=3, case_prefix="run", case_names=True)
    assert table.columns == ["case", "met__ws_mps"]
    assert sorted(r["case"] for r in table.collect()) == ["run0000", "run0001", "run0002"]


def test_audit_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "p string")
    assert [tuple(r) for r in doe.coverage_audit(empty, {"p": ["a"]}).select("level", "count", "fraction").collect()] == [("a", 0, 0.0)]


def test_audit_compares_numbers_as_numbers(spark):
    df = spark.createDataFrame([(10.0,), (1e7,)], "p double")
    got = doe.coverage_audit(df, {"p": [10, 10000000.0]}).select("count").collect()
    assert [r[0] for r in got] == [1, 1]
