"""Outcomes per sample, turned grids, statistics of several documents and digests."""

import csv
import hashlib
import math
import os
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.operators import grid as grids, manifest, masks as m, normalize as norm, resample as rs, tensor as ts
from gridloom.plans import field_transform
from gridloom.plans.field_transform import transform
from gridloom.session import cut_lineage, settings
from gridloom.sources import one_file, stage_csv, workspace
from tests.test_fields import CONTRACT, STATISTICS, box_mesh

BLOCKS = "sample_id string, block_id int, priority int, is_volumetric boolean"


def tables_of(spark, samples="abcdef"):
    cells, points, values = box_mesh(spark)
    one = lambda df: df.filter("sample_id = 'a'").drop("sample_id")
    names = spark.createDataFrame([(s,) for s in samples], "sample_id string")
    many = lambda df: names.crossJoin(one(df))
    return {
        "source_block": spark.createDataFrame([(s, 0, 0, True) for s in samples], BLOCKS),
        "source_cell": many(cells), "source_point": many(points), "source_value": many(values),
    }


def test_bad_samples_do_not_stop_the_others(spark):
    tables = tables_of(spark)
    kind = F.col("sample_id")
    nan = F.transform("values", lambda v: F.lit(float("nan")))
    values = tables["source_value"].filter(kind != "b").withColumn("values", F.when(kind == "c", nan).otherwise(F.col("values")))
    scenarios = spark.createDataFrame(
        [("a", {"wind": "180"}), ("b", {"wind": "0"}), ("c", {"wind": "0"}), ("d", {"wind": "north"}), ("e", {"speed": "1"})],
        "sample_id string, params map<string,string>",
    )
    made = transform(
        spark, {**tables, "source_value": values}, CONTRACT, STATISTICS, scenarios, [m.BoundaryValue("nope", "x_min", 1.0)]
    )
    told = {r.sample_id: (r.status, r.message) for r in made.outcomes.collect()}
    nope = "nope: overridden channel is not produced"
    assert told["a"] == ("failed", nope) and told["b"] == ("failed", f"T: required field is absent; {nope}")
    assert told["c"][1] == f"T: no finite values; {nope}" and told["d"][1] == f"{nope}; wind: unusable value of wind: north"
    assert told["e"][1] == told["f"][1] == f"{nope}; wind: scenario lacks wind"
    assert made.tensors.count() == 0
    made = transform(spark, {**tables, "source_value": values}, CONTRACT, STATISTICS, scenarios)
    assert {r.sample_id for r in made.outcomes.collect() if r.status == "ok"} == {"a"}
    for df in (made.tensors, made.mask_tensors, made.global_features, made.metadata):
        assert {r.sample_id for r in df.select("sample_id").collect()} == {"a"}
    assert {r.ordinal for r in made.tensors.collect()} == {0, 1}


def test_values_that_cannot_be_normalised_fail_their_sample_only(spark):
    tables = tables_of(spark, "ab")
    low = F.transform("values", lambda v: F.when(F.col("sample_id") == "b", F.lit(-5.0)).otherwise(v))
    values = tables["source_value"].withColumn("values", low)
    stats = {**STATISTICS, "channels": {**STATISTICS["channels"], "T": {"method": "log1p_zscore", "mean": 0.0, "std": 1.0}}}
    given = spark.createDataFrame([(s, {"wind": "180"}) for s in "ab"], "sample_id string, params map<string,string>")
    made = transform(spark, {**tables, "source_value": values}, CONTRACT, stats, given)
    assert sorted(map(tuple, made.outcomes.collect())) == [("a", "ok", ""), ("b", "failed", "T: value is not finite")]
    with pytest.raises(ValueError, match="no statistic"):
        transform(spark, tables, CONTRACT, {"frozen": True, "channels": {"T": {"method": "identity"}}}, given)


def test_a_document_for_each_sample(spark):
    tables = tables_of(spark, "abcd")
    other = {"frozen": True, "channels": {**STATISTICS["channels"], "T": {"method": "zscore", "mean": 0.0, "std": 1.0}}}
    less = {"frozen": True, "channels": {k: v for k, v in STATISTICS["channels"].items() if k not in ("T", "s")}}
    documents = {("one", 1): other, ("one", 3): STATISTICS, ("less", 1): less}
    declared = spark.createDataFrame([("a", "one", 1), ("b", "one", None), ("c", "less", 1)], "sample_id string, document string, version int")
    given = spark.createDataFrame([(s, {"wind": "180"}) for s in "abcd"], "sample_id string, params map<string,string>")
    made = transform(spark, tables, CONTRACT, documents, given, declared=declared)
    told = {r.sample_id: r.message for r in made.outcomes.collect()}
    assert told["a"] == told["b"] == "" and told["c"] == "T: channel has no statistic; s: channel has no statistic"
    assert told["d"].count("no statistics document is declared") == 4
    data = {(r.sample_id, r.channel): np.array(r.data) for r in made.tensors.collect()}
    np.testing.assert_allclose(data["a", "T"], data["b", "T"] * 2 + 4, atol=1e-5)  # padding is normalised by the same document
    used = {r.sample_id: (r.statistics.document, r.statistics.version) for r in made.metadata.collect()}
    assert used == {"a": ("one", 1), "b": ("one", 3)}


def test_turned_grid(spark):
    a, b = math.radians(30), math.radians(-40)
    turn = np.array([[math.cos(a), -math.sin(a), 0], [math.sin(a), math.cos(a), 0], [0, 0, 1]]) @ np.array(
        [[1, 0, 0], [0, math.cos(b), -math.sin(b)], [0, math.sin(b), math.cos(b)]]
    )
    cmap = grids.CoordinateMap(1.5, tuple(map(tuple, turn.tolist())), (2.0, 1.0, 2.5))
    assert not cmap.axis_aligned and grids.CoordinateMap(rotation=((0.0, -1.0, 0.0), (1.0, 0.0, 0.0), (0.0, 0.0, 1.0))).axis_aligned
    grid = grids.Grid((-1.0, -1.0, -1.0), (0.7, 0.6, 0.8), (10, 11, 9))
    cells, points, values = (df.filter("sample_id = 'a'") for df in box_mesh(spark))
    on_points = rs.spread_values(values, 1).filter("association = 'POINT'").withColumnRenamed("entity_id", "point_id")
    got = {r.idx: r.v0 for r in rs.resample_linear(cells, points, on_points, grid, 1, cmap).collect()}
    k = np.arange(grid.size)
    centres = np.stack([k % 10 * 0.7 - 1, k // 10 % 11 * 0.6 - 1, k // 110 * 0.8 - 1], 1)
    source = (centres - np.array(cmap.translation)) @ turn / 1.5
    inside = ((source >= 0) & (source <= 3)).all(1)
    assert set(got) == set(k[inside]) and 0 < inside.sum() < grid.size
    want = 1 + 2 * source[:, 0] + 3 * source[:, 1] - source[:, 2]
    np.testing.assert_allclose([got[i] for i in k[inside]], want[inside], atol=1e-9)
    numbered = cells.select("sample_id", "block_id", "cell_id", F.col("cell_id").cast("double").alias("v0"))
    near = {r.idx: r.v0 for r in rs.resample_nearest(cells, numbered, grid, 1, cmap).collect()}
    box = {r.cell_id: r for r in cells.collect()}
    assert set(near) == set(got)
    for i, c in near.items():
        assert all(box[c][f"{x}lo"] <= v <= box[c][f"{x}hi"] for x, v in zip("xyz", source[i]))
    wide = grids.map_bounds(cells, cmap).first()
    first = cells.first()
    corners = np.array([[first[f"x{i}"], first[f"y{j}"], first[f"z{h}"]] for i in ("lo", "hi") for j in ("lo", "hi") for h in ("lo", "hi")])
    mapped = corners * 1.5 @ turn.T + np.array(cmap.translation)
    for n, x in enumerate("xyz"):
        assert wide[f"{x}lo"] == pytest.approx(mapped[:, n].min()) and wide[f"{x}hi"] == pytest.approx(mapped[:, n].max())


def test_turned_samples_of_the_whole_transform(spark):
    tables = tables_of(spark, "a")
    turn = [[math.cos(0.5), -math.sin(0.5), 0.0], [math.sin(0.5), math.cos(0.5), 0.0], [0.0, 0.0, 1.0]]
    contract = {**CONTRACT, "coordinate_map": {"rotation_source_to_target": turn, "translation_target_xyz": [1.5, 0.0, 0.0]}}
    given = spark.createDataFrame([("a", {"wind": "180"})], "sample_id string, params map<string,string>")
    made = transform(spark, tables, contract, STATISTICS, given)
    valid = {r.idx: r.value for r in made.channels.filter("channel = 'T' and valid").collect()}
    k = np.arange(27)
    x, y, z = k % 3 + 0.5 - 1.5, k // 3 % 3 + 0.5, k // 9 + 0.5
    sx, sy = x * math.cos(0.5) + y * math.sin(0.5), y * math.cos(0.5) - x * math.sin(0.5)
    inside = (sx >= 0) & (sx <= 3) & (sy >= 0) & (sy <= 3)
    assert set(valid) == set(k[inside]) and 0 < inside.sum() < 27
    np.testing.assert_allclose([valid[i] for i in k[inside]], (1 + 2 * sx + 3 * sy - z)[inside], rtol=1e-5)
    assert made.outcomes.first().status == "ok"


def test_float_bits(spark):
    rng = np.random.default_rng(4)
    raw = rng.integers(0, 2**32, 4000, dtype=np.uint32)
    edges = [0.0, -0.0, 1.0, -1.0, 2.0**-126, 2.0**-149, -(2.0**-127), 3.4028235e38, float("inf"), -float("inf"), *[2.0**k for k in range(-149, 128)], *[-(2.0**k) * (1 - 2.0**-24) for k in range(-120, 128)]]
    values = np.concatenate([raw.view(np.float32), np.array(edges, np.float32)])
    values = values[~np.isnan(values)]
    df = spark.createDataFrame([(float(v),) for v in values], "v float")
    got = [r[0] for r in df.select(ts.float_bits(F.col("v"))).collect()]
    assert got == values.view(np.uint32).tolist()
    nan = spark.createDataFrame([(float("nan"),), (None,)], "v float").select(ts.float_bits(F.col("v"))).collect()
    assert [r[0] for r in nan] == [0x7FC00000, None]


def test_digests_in_two_levels(spark):
    rng = np.random.default_rng(2)
    data = {(r, o): rng.standard_normal((3, 2, 4)).astype(np.float32) for r, o in (("x", 0), ("x", 1), ("y", 0))}
    rows = [("s", r, o, f"c{o}", [3, 2, 4], a.ravel().tolist()) for (r, o), a in data.items()] + [("t", "y", 0, "c0", [3, 2, 4], [0.0] * 24)]
    df = spark.createDataFrame(rows, "sample_id string, role string, ordinal int, channel string, shape array<int>, data array<float>")

    def digest(arrays):
        layers = [hashlib.sha256(layer.astype(">f4").tobytes()).hexdigest() for a in arrays for layer in a]
        return hashlib.sha256("\n".join(["float32", f"{len(arrays)}x3x2x4", *layers]).encode()).hexdigest()

    got = {r.sample_id: (r.x_digest, r.y_digest) for r in ts.content_digests(df.repartition(3)).collect()}
    assert got["s"] == (digest([data["x", 0], data["x", 1]]), digest([data["y", 0]]))
    assert got["t"] == (None, digest([np.zeros((3, 2, 4), np.float32)]))


def test_one_file_of_many_tasks(spark, tmp_path):
    rows = [(f"case_{n:04d}", n % 7 or None, 'a "q", \u00e9' * (n % 5) or None) for n in range(300)]
    df = spark.createDataFrame(rows, "case_id string, row_number int, message string").repartition(5)
    df = df.select(*[F.col(c) if c in df.columns else F.lit("").alias(c) for c in stage_csv.MANIFEST_COLUMNS])
    path = str(tmp_path / "manifest")
    for _ in range(2):  # the second run replaces the first
        stage_csv.write_manifest(df, path)
        assert os.listdir(path) == ["manifest.csv"] and os.listdir(tmp_path) == ["manifest"]
    with open(f"{path}/manifest.csv", newline="", encoding="utf-8") as f:
        head, *got = csv.reader(f)
    assert head == list(stage_csv.MANIFEST_COLUMNS)
    at = [head.index(c) for c in ("case_id", "row_number", "message")]
    want = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[0]))
    assert [tuple(r[k] for k in at) for r in got] == [(c, str(n or ""), m or "") for c, n, m in want]
    assert [r.case_id for r in stage_csv.read_manifest(spark, path).collect()] == [c for c, _, _ in want]
    stage_csv.write_manifest(df.limit(0), path)
    assert open(f"{path}/manifest.csv").read() == ",".join(head) + "\n" and stage_csv.read_manifest(spark, path).count() == 0
    lines = spark.range(0, 100, 1, 4).orderBy(F.desc("id")).select(F.col("id").cast("string").alias("line"))
    one_file.in_one_task(lines, f"{tmp_path}/one", "id")
    assert [r.value for r in spark.read.text(f"{tmp_path}/one").collect()] == ["id", *map(str, reversed(range(100)))]
    one_file.in_one_task(lines.limit(0), f"{tmp_path}/none", "id")
    assert [r.value for r in spark.read.text(f"{tmp_path}/none").collect()] == ["id"]


def test_chunks_of_tensors(spark, tmp_path):
    shape, nan = (5, 2, 3), float("nan")
    cells = [(s, c, i, float(100 * int(s) + i)) for s in ("1", "2") for c in ("p", "U") for i in range(30) if (s, c, i) != ("2", "p", 13)]
    cells = [(s, c, i, nan if (s, c, i) == ("2", "U", 29) else v) for s, c, i, v in cells] + [("2", "p", 14, 5.0), ("1", "other", 0, 1.0)]
    rows = spark.createDataFrame(cells, "sample_id string, channel string, idx int, value double")
    samples = spark.createDataFrame([("1",), ("2",), ("2",), ("3",)], "sample_id string")
    made = ts.chunk_tensors(rows, samples, shape, ["p", "U"], ["U"], layers=2).cache()
    wrong = {(r.sample_id, r.role, r.channel, r.chunk): r.problem for r in made.where("problem is not null").collect()}
    none = {("3", r, c, k): "chunk is absent" for r, c in (("x", "p"), ("x", "U"), ("y", "U")) for k in range(3)}
    bad = {("2", r, "U", 2): "value is not finite" for r in "xy"}
    assert wrong == none | bad | {("2", "x", "p", 1): "chunk is incomplete"} and made.count() == 27
    assert made.where("problem is not null and data is not null").count() == 0
    good = made.where("problem is null")
    assert {(r.z0, r.z1, tuple(r.shape), len(r.data)) for r in good.collect()} == {(0, 2, (2, 2, 3), 12), (2, 4, (2, 2, 3), 12), (4, 5, (1, 2, 3), 6)}
    path = str(tmp_path / "chunks")
    workspace.write_chunks(good, path)
    assert workspace.read_chunks(spark, path).count() == good.count()
    part = workspace.read_chunks(spark, path, channels=["p"], z=(1, 3)).where("sample_id = 1").orderBy("z0")
    assert [(r.z0, r.z1, list(r.shape), r.data) for r in part.collect()] == [
        (1, 2, [1, 2, 3], [100.0 + i for i in range(6, 12)]), (2, 3, [1, 2, 3], [100.0 + i for i in range(12, 18)]),
    ]
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(z0,3)" in plan and "GreaterThan(z1,1)" in plan and "In(channel" in plan or "EqualTo(channel,p)" in plan
    assert workspace.read_chunks(spark, path, z=(3, 3)).count() == 0
    with pytest.raises(ValueError):
        ts.chunk_tensors(rows, samples, shape, [], [])
    with pytest.raises(ValueError):
        ts.chunk_tensors(rows, samples, shape, ["p"], [], layers=0)
    heads = {(r.sample_id, r.role): (r.channels, r["shape"]) for r in ts.tensor_heads(samples, shape, [], ["U"]).collect()}
    assert len(heads) == 6 and heads["3", "x"] == ([], [0, 5, 2, 3]) and heads["3", "y"] == (["U"], [1, 5, 2, 3])


def test_manifest_of_outcomes(spark):
    outcome = "sample_id string, status string, message string"
    inputs = spark.createDataFrame([("a", "ok", ""), ("b", "failed", "T: bad"), ("c", "ok", "")], outcome)
    outputs = spark.createDataFrame([("a", "ok", ""), ("b", "failed", None), ("d", "ok", "")], outcome)
    got = {r.case_id: r.error for r in manifest.pair_outcomes(inputs, outputs).collect()}
    assert got == {"a": None, "b": "input: T: bad; output: ", "c": "output has no sample", "d": "input has no sample"}
    pairs = spark.createDataFrame([("a", 1, "i", "o", None), ("e", 2, "i", "o", None), ("f", 3, None, None, "lost")], "case_id string, row_number int, input_vtu string, output_vtu string, problem string")
    made = manifest.build_manifest(pairs, manifest.pair_outcomes(inputs, outputs), "/i", "/o")
    assert {(r.case_id, r.status, r.message) for r in made.collect()} == {
        ("a", "ok", "input=ok: ; output=ok: "), ("e", "transform_failed", "no outcome of the transform"), ("f", "discovery_failed", "lost")
    }


@pytest.mark.parametrize("small, slab", [(0, 30), (10**9, 10**9), (0, 75)])
def test_distances_in_slabs(spark, monkeypatch, small, slab):
    from tests.test_fields import brute_distance, table_of, volume

    monkeypatch.setattr(m, "SMALL_PLANE", small)
    monkeypatch.setattr(m, "SLAB_CELLS", slab)
    grid = grids.Grid((0, 0, 0), (2.0, 1.0, 0.5), (6, 5, 4))
    rng = np.random.default_rng(7)
    fluid = rng.random((4, 5, 6)) < 0.9
    full = np.ones_like(fluid)
    got = m.distance_to_background(table_of(spark, grid, a=fluid, b=full), grid, {"a": "da", "b": "db"})
    np.testing.assert_allclose(volume(got, grid, "da"), brute_distance(fluid, np.array([0.5, 1.0, 2.0])), atol=1e-12)
    assert got.where("db is not null").count() == 0


def test_lower_envelope(monkeypatch):
    monkeypatch.setattr(m, "SMALL_PLANE", 0)
    rng = np.random.default_rng(0)
    for n in (1, 2, 5, 17, 40):
        f = np.where(rng.random((50, n)) < 0.4, np.inf, rng.integers(0, 50, (50, n)) * rng.choice([0, 1.0, 0.37]))
        f[0] = np.inf
        at = np.arange(n) * 0.3
        np.testing.assert_allclose(m.lower_envelope(f, 0.3), (f[:, None, :] + (at[:, None] - at[None]) ** 2).min(2))


def planned(spark, monkeypatch):
    """Plans of the tables that ``transform`` writes, with the settings under which they are written."""
    plans = []

    def spy(df, **conf):
        with settings(spark, conf):
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut_lineage(df, **conf)

    monkeypatch.setattr(field_transform, "cut_lineage", spy)
    return plans


def shuffled_by(plan):
    """Columns by which a plan shuffles, one list for each shuffle."""
    return [re.findall(r"([a-z_]\w*)#\d+", keys) for keys in re.findall(r"Exchange hashpartitioning\((.*?)\), [A-Z]", plan)]


def test_whole_samples_are_shuffled_once(spark, monkeypatch):
    """Neither corners nor hits nor grid cells travel: rows are dealt out by sample, once for each table."""
    plans = planned(spark, monkeypatch)
    contract = {
        **CONTRACT, "fields": [*CONTRACT["fields"], {"source_name": "T", "output_channels": ["K"], "role": "TARGET", "kind": "categorical"}],
        "derived_features": {"fluid_reference_channel": "T", "derive_signed_distance": False}, "scenario_parameters": [],
        "input_channels": ["T"], "target_channels": ["K"], "padding": {"channel_pad_values_physical": {"T": 4.0, "K": 0.0}},
    }
    stats = {"frozen": True, "channels": {"T": {"method": "identity"}, "K": {"method": "identity"}}}
    before = spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition")
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        made = transform(spark, tables_of(spark, "abc"), contract, stats)
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == before
    assert made.tensors.count() == 6 and {r.status for r in made.outcomes.collect()} == {"ok"}
    for part in ("point_ids", "Window", "collect_list"):
        keys = shuffled_by(next(p for p in plans if part in p))
        assert keys and not {k for ks in keys for k in ks} & {"cell_id", "point_id", "idx", "iz", "channel"}, (part, keys)


def test_large_samples_are_spread(spark, monkeypatch):
    """A sample that is too large for one task goes its own way, with the same results; the others stay in tasks of whole samples."""
    tables = tables_of(spark, "ab")
    also = {t: df.filter("sample_id = 'b'").withColumn("block_id", F.lit(1)) for t, df in tables.items()}
    also["source_block"] = also["source_block"].withColumn("priority", F.lit(-1))
    also["source_value"] = also["source_value"].withColumn("values", F.transform("values", lambda v: v + 1))
    twice = {t: df.unionByName(also[t]) for t, df in tables.items()}
    for limit, whole in ((0, [False]), (4_000_000, [True]), (400, [True, False])):
        monkeypatch.setattr(field_transform, "SAMPLE_ROWS", limit)
        groups, tasks = field_transform.sample_groups(twice, grids.parse_grid(CONTRACT))
        assert [n is not None for _, n in groups] == whole and (tasks is None) == (limit == 0)
    assert [{r.sample_id for r in part["source_cell"].collect()} for part, _ in groups] == [{"a"}, {"b"}]
    scenarios = spark.createDataFrame([(s, {"wind": "180"}) for s in "ab"], "sample_id string, params map<string,string>")
    made = transform(spark, twice, CONTRACT, STATISTICS, scenarios)
    assert {(r.sample_id, r.status) for r in made.outcomes.collect()} == {("a", "ok"), ("b", "ok")}
    data = {(r.sample_id, r.channel): r.data for r in made.tensors.collect()}
    axis = np.arange(3) + 0.5
    field = 1 + 2 * axis[None, None, :] + 3 * axis[None, :, None] - axis[:, None, None]
    for s, more in (("a", 0), ("b", 1)):
        want = np.zeros((4, 4, 4), dtype=np.float32)
        want[:3, :3, :3] = (field + more - 4.0) / 2.0
        np.testing.assert_array_equal(np.array(data[s, "T"], dtype=np.float32).reshape(4, 4, 4), want)
    assert made.masks.count() == 54 and made.masks.filter("fluid_boundary_mask").count() == 52
