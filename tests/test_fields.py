"""Field operators against NumPy on small grids."""

import hashlib
import itertools
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.functions.statistics import denormalize, normalize
from gridloom.operators import contract, grid as grids, masks as m, normalize as norm, resample as rs, scenario as sc, tensor as ts
from gridloom.plans.field_transform import transform
from tests.conftest import rows


def volume(df, grid, column):
    nx, ny, nz = grid.dims
    out = np.full(nz * ny * nx, np.nan)
    for r in df.select("idx", column).collect():
        out[r["idx"]] = np.nan if r[column] is None else float(r[column])
    return out.reshape(nz, ny, nx)


def table_of(spark, grid, **arrays):
    data = [("s", i, *[a.ravel()[i].item() for a in arrays.values()]) for i in range(grid.size)]
    kinds = {"b": "boolean", "f": "double"}
    schema = "sample_id string, idx long, " + ", ".join(f"{n} {kinds[a.dtype.kind]}" for n, a in arrays.items())
    return spark.createDataFrame(data, schema)


def brute_distance(mask, spacing):
    background = np.argwhere(~mask)
    out = np.full(mask.shape, np.nan)
    for p in np.argwhere(mask):
        if len(background):
            out[tuple(p)] = np.sqrt((((background - p) * spacing) ** 2).sum(axis=1).min())
    out[~mask] = 0.0
    return out


def test_discrete_cells_take_the_smallest_of_the_most_frequent_values(spark):
    """Two components, ties, nulls and a cell without any value; no map of values per cell is built."""
    points = spark.sql(
        "select 's' sample_id, 0 block_id, id point_id, cast(get(array(2, 2, 1, 1, null, null), cast(id as int)) as double) v0,"
        " cast(get(array(7, 5, 5, null, null, null), cast(id as int)) as double) v1 from range(6)"
    )
    cells = spark.sql(
        "select 's' sample_id, 0 block_id, * from values (0L, array(0L, 1L, 2L, 3L)), (1L, array(0L, 1L, 3L)), (2L, array(4L, 5L)), (3L, array(3L, 4L, 5L)) t(cell_id, point_ids)"
    )
    got = rs.point_to_cell(cells, points, 2, "categorical")
    assert rows(got, "cell_id", "v0", "v1") == [(0, 1.0, 5.0), (1, 2.0, 5.0), (2, None, None), (3, 1.0, None)]
    assert "mode(" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_linear_hits_are_blended_before_they_are_shuffled(spark):
    """Only the key, the cell and its value travel to the choice among cells."""
    cells = spark.sql(
        "select 's' sample_id, 0 block_id, id cell_id, 1.0D * id xlo, 1.0D + id xhi, 0.0D ylo, 1.0D yhi, 0.0D zlo, 1.0D zhi,"
        " transform(sequence(0, 7), c -> (id + c % 2) * 4 + floor(c / 2)) point_ids from range(2)"
    )
    points = spark.sql(
        "select 's' sample_id, 0 block_id, id point_id, 1.0D * floor(id / 4) x, 1.0D * (id % 2) y, 1.0D * (floor(id / 2) % 2) z from range(12)"
    )
    values = points.select("sample_id", "block_id", "point_id", (2 * F.col("x") + F.col("y") - F.col("z")).alias("v0"))
    made = rs.resample_linear(cells, points, values, grids.Grid((0.5, 0.25, 0.5), (0.5, 0.5, 1.0), (4, 2, 1)))
    assert rows(made, "idx", "v0") == [(0, 0.75), (1, 1.75), (2, 2.75), (3, 3.75), (4, 1.25), (5, 2.25), (6, 3.25), (7, 4.25)]
    last = [line for line in made._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Aggregate" in line][0]
    assert "cell_id" in last and "xlo" not in last

def test_index_law(spark):
    grid = grids.Grid((1.0, 2.0, 3.0), (0.5, 1.0, 2.0), (4, 3, 2))
    got = {r["idx"]: (r["iz"], r["iy"], r["ix"], r["x"], r["y"], r["z"]) for r in grids.canonical_grid(spark, grid).collect()}
    for i, (z, y, x) in enumerate(itertools.product(range(2), range(3), range(4))):
        assert got[i] == (z, y, x, 1.0 + 0.5 * x, 2.0 + y, 3.0 + 2.0 * z)
    assert grid.bounds == (0.75, 2.75, 1.5, 4.5, 2.0, 6.0)


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_distance_and_erosion(spark, seed):
    grid = grids.Grid((0, 0, 0), (2.0, 1.0, 0.5), (6, 5, 4))
    rng = np.random.default_rng(seed)
    fluid = rng.random((4, 5, 6)) < (0.97 if seed else 0.6)
    domain = np.ones_like(fluid)
    df = m.phase_masks(table_of(spark, grid, valid=fluid, domain_mask=domain), "valid")
    got = volume(m.signed_distance(df, grid), grid, "signed_distance")
    spacing = np.array([0.5, 1.0, 2.0])
    want = np.where(fluid, brute_distance(fluid, spacing), -brute_distance(~fluid, spacing))
    np.testing.assert_allclose(got, want, atol=1e-12)
    padded = np.pad(fluid, 1)
    core = np.ones_like(fluid)
    for dz, dy, dx in itertools.product(range(3), repeat=3):
        core &= padded[dz : dz + 4, dy : dy + 5, dx : dx + 6]
    boundary = volume(m.fluid_boundary(df, grid), grid, "fluid_boundary_mask")
    np.testing.assert_array_equal(boundary.astype(bool), fluid & ~core)


def test_no_background_has_no_distance(spark):
    grid = grids.Grid((0, 0, 0), (1, 1, 1), (3, 2, 2))
    full = np.ones((2, 2, 3), dtype=bool)
    df = m.phase_masks(table_of(spark, grid, valid=full, domain_mask=full), "valid")
    assert np.isnan(volume(m.signed_distance(df, grid), grid, "signed_distance")).all()


def test_cases_keep_placements_and_facets_are_placed_on_read(spark):
    facets = spark.createDataFrame(
        [(name, i, 0, float(i), 2.0 * i, 1.0) for name, n in (("base", 3), ("hull", 40)) for i in range(n)],
        "surface string, facet_id long, vertex_no int, x double, y double, z double",
    )
    cases = spark.createDataFrame([("c0", 0.0), ("c1", 90.0), ("c2", None)], "case_id string, angle double")
    kept = grids.surface_placements(facets, grids.place_surfaces(cases, ["base", "hull", "absent"]), "base")
    assert kept.count() == 9 and [tuple(r) for r in kept.select("cx", "cy").distinct().collect()] == [(1.0, 2.0)]
    view = grids.placed_facets(facets, kept)
    assert view.count() == 3 * 43
    turned = {r.facet_id: (r.x, r.y) for r in view.where("case_id = 'c1' AND surface = 'hull'").collect()}
    assert len(turned) == 40
    for i, at in turned.items():  # a quarter turn about (1, 2)
        np.testing.assert_allclose(at, (1 - (2.0 * i - 2), 2 + (i - 1)), atol=1e-12)
    same = {r.facet_id: (r.x, r.y) for r in view.where("case_id = 'c0' AND surface = 'base'").collect()}
    assert same == {0: (0.0, 0.0), 1: (1.0, 2.0), 2: (2.0, 4.0)}
    assert view.where("case_id = 'c2' AND x IS NOT NULL").isEmpty()  # no angle, no place
    with pytest.raises(ValueError, match="base surface"):
        grids.surface_placements(facets, cases.withColumn("surface", F.lit("hull")), "gone")


def box_mesh(spark, n=3):
    """n^3 unit boxes in two samples and the function 1 + 2x + 3y - z on the points."""
    cells, points, values = [], [], []
    k = n + 1
    pid = lambda x, y, z: (z * k + y) * k + x
    for sample in ("a", "b"):
        for z, y, x in itertools.product(range(n), repeat=3):
            corners = [pid(x + i, y + j, z + l) for l in (0, 1) for j in (0, 1) for i in (0, 1)]
            cells.append((sample, 0, (z * n + y) * n + x, 3, float(x), x + 1.0, float(y), y + 1.0, float(z), z + 1.0, corners[::-1]))
        for z, y, x in itertools.product(range(k), repeat=3):
            points.append((sample, 0, pid(x, y, z), float(x), float(y), float(z)))
            values.append((sample, 0, "T", "POINT", pid(x, y, z), [1 + 2.0 * x + 3.0 * y - z]))
    return (
        spark.createDataFrame(cells, "sample_id string, block_id int, cell_id long, cell_dim int, xlo double, xhi double, ylo double, yhi double, zlo double, zhi double, point_ids array<long>"),
        spark.createDataFrame(points, "sample_id string, block_id int, point_id long, x double, y double, z double"),
        spark.createDataFrame(values, "sample_id string, block_id int, field string, association string, entity_id long, values array<double>"),
    )


def test_linear_field_is_exact_inside_and_absent_outside(spark):
    cells, points, values = box_mesh(spark)
    grid = grids.Grid((-0.5, 0.25, 0.5), (0.7, 0.7, 0.9), (6, 4, 3))
    at = rs.spread_values(values, 1).withColumnRenamed("entity_id", "point_id")
    found = rs.resample_linear(cells, points, at, grid).filter("sample_id = 'a'")
    got = volume(found, grid, "v0")
    x, y, z = (np.array(grid.origin)[i] + np.arange(grid.dims[i]) * grid.spacing[i] for i in range(3))
    want = 1 + 2 * x[None, None, :] + 3 * y[None, :, None] - z[:, None, None]
    inside = (x[None, None, :] >= 0) & (x[None, None, :] <= 3) & (y[None, :, None] <= 3) & (z[:, None, None] <= 3)
    np.testing.assert_allclose(got[inside], want[inside], atol=1e-12)
    assert np.isnan(got[~inside]).all()


CONTRACT = {
    "grid": {
        "physical_grid": {"cell_center_origin_xyz": [0.5, 0.5, 0.5], "spacing_xyz": [1.0, 1.0, 1.0], "dimensions_xyz": [3, 3, 3]},
        "model_grid": {"tensor_shape_zyx": [4, 4, 4], "divisibility_zyx": [2, 2, 2]},
    },
    "fields": [{"source_name": "T", "output_channels": ["T"], "role": "INPUT", "kind": "continuous_scalar"}],
    "derived_features": {
        "fluid_reference_channel": "T", "domain_mask_mode": "source_bounds", "output_channels": ["solid", "signed_distance"],
        "mask_channel_map": {"solid": "solid_mask"}, "wind_direction_parameter": "wind",
    },
    "scenario_parameters": [{"name": "wind", "type": "angle", "representation": "global", "output_channels": ["s", "c"]},
                            {"name": "speed", "type": "scalar", "representation": "broadcast", "output_channels": ["speed"], "default": 2.0}],
    "input_channels": ["T", "speed"],
    "target_channels": [],
    "padding": {"channel_pad_values_physical": {"T": 4.0, "speed": 0.0}},
}
STATISTICS = {"frozen": True, "channels": {"T": {"method": "zscore", "mean": 4.0, "std": 2.0}, "speed": {"method": "identity"},
                                           "s": {"method": "identity"}, "c": {"method": "identity"}}}


def test_whole_transform(spark):
    cells, points, values = box_mesh(spark)
    blocks = spark.createDataFrame([("a", 0, 0, True), ("b", 0, 0, True)], "sample_id string, block_id int, priority int, is_volumetric boolean")
    scenarios = spark.createDataFrame([("a", {"wind": "180"}), ("b", {"wind": "90", "speed": "3"})], "sample_id string, params map<string,string>")
    made = transform(
        spark, {"source_block": blocks, "source_cell": cells, "source_point": points, "source_value": values},
        CONTRACT, STATISTICS, scenarios, [m.BoundaryValue("T", "x_min", 10.0)],
    )
    axis = np.arange(3) + 0.5
    field = 1 + 2 * axis[None, None, :] + 3 * axis[None, :, None] - axis[:, None, None]
    field[:, :, 0] = 10.0
    want = np.zeros((4, 4, 4), dtype=np.float32)
    want[:3, :3, :3] = ((field - 4.0) / 2.0).astype(np.float32)
    tensors = {(r["sample_id"], r["channel"]): r for r in made.tensors.collect()}
    np.testing.assert_array_equal(np.array(tensors["a", "T"]["data"], dtype=np.float32).reshape(4, 4, 4), want)
    speed = np.zeros((4, 4, 4), dtype=np.float32)
    speed[:3, :3, :3] = 3.0
    np.testing.assert_array_equal(np.array(tensors["b", "speed"]["data"]).reshape(4, 4, 4), speed)
    assert [tensors["a", c]["ordinal"] for c in ("T", "speed")] == [0, 1]
    stacked = np.stack([want, np.where(speed > 0, np.float32(2.0), np.float32(0.0))]).astype(np.float32)
    digest = hashlib.sha256(b"float32" + np.array(stacked.shape, dtype=np.int64).tobytes() + stacked.tobytes()).hexdigest()
    meta = {r["sample_id"]: r for r in made.metadata.collect()}
    assert meta["a"]["tensor_hashes"]["x_sha256"] == digest
    assert meta["a"]["padding"]["pad_before_zyx"] == [0, 0, 0] and meta["a"]["padding"]["pad_after_zyx"] == [1, 1, 1]
    assert meta["b"]["boundary_conditions"]["bc_00"] == 9
    text = json.dumps(CONTRACT, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert meta["a"]["contract_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    features = {r["sample_id"]: r["features"] for r in made.global_features.collect()}
    np.testing.assert_allclose(features["a"], [1.0, 0.0], atol=1e-6)
    np.testing.assert_allclose(features["b"], [0.0, -1.0], atol=1e-6)
    assert made.problems.count() == 0
    strict = {**CONTRACT, "fields": [{**CONTRACT["fields"][0], "extrapolation_policy": "ERROR"},
                                     {"source_name": "Q", "output_channels": ["Q"], "role": "AUXILIARY", "kind": "continuous_scalar"}]}
    shifted = {**strict, "grid": {**CONTRACT["grid"], "physical_grid": {**CONTRACT["grid"]["physical_grid"], "cell_center_origin_xyz": [1.5, 0.5, 0.5]}}}
    bad = transform(spark, {"source_block": blocks, "source_cell": cells, "source_point": points, "source_value": values}, shifted, STATISTICS, scenarios)
    assert set(map(tuple, bad.problems.select("subject", "problem").collect())) == {
        ("Q", "required field is absent"), ("T", "too few valid cells")
    }
    wind = made.masks.filter("sample_id = 'a' and wind_inlet_mask").select("iy" if "iy" in made.masks.columns else "idx").count()
    assert wind == 9


def test_padding_round_trip(spark):
    grid = grids.Grid((0, 0, 0), (1, 1, 1), (3, 3, 3))
    pad = ts.plan_padding(grid, divisor=(4, 4, 4))
    assert pad.model == (4, 4, 4) and pad.before == (0, 0, 0) and pad.after == (1, 1, 1)
    values = np.arange(27, dtype=float).reshape(3, 3, 3)
    df = table_of(spark, grid, value=values).withColumn("channel", F.lit("p"))
    padded = ts.pad_channels(df, df.select("sample_id").distinct(), pad, {"p": -1.0})
    tensor = ts.build_tensors(padded, pad.model, [], ["p"])
    row = tensor.first()
    np.testing.assert_array_equal(np.array(row["data"]).reshape(4, 4, 4), np.pad(values, ((0, 1),) * 3, constant_values=-1))
    one = tensor.select("sample_id", F.lit([1, 1, 4, 4, 4]).alias("shape"), "data")
    stats = norm.stat_table(spark, norm.parse_statistics({"frozen": True, "channels": {"p": {"method": "identity"}}}))
    back = ts.inverse_prediction(one, pad, stats, ["p"])
    np.testing.assert_array_equal(volume(back, grid, "value"), values)
    with pytest.raises(Exception, match="wrong prediction shape"):
        ts.inverse_prediction(one.withColumn("shape", F.lit([2, 1, 4, 4, 4])), pad, stats, ["p"]).collect()
    with pytest.raises(Exception, match="incomplete channel"):
        ts.build_tensors(df, pad.model, ["p"], []).collect()
    with pytest.raises(ValueError):
        ts.plan_padding(grid, (2, 4, 4), (1, 1, 1))
    with pytest.raises(ValueError):
        ts.plan_padding(grid, (5, 4, 4), (4, 4, 4))


def test_array_hash_of_masks(spark):
    bits = [True, False, True, True]
    want = hashlib.sha256(b"bool" + np.array([1, 2, 2], dtype=np.int64).tobytes() + np.array(bits).tobytes()).hexdigest()
    df = spark.createDataFrame([(bits, [1, 2, 2])], "data array<boolean>, shape array<int>")
    assert df.select(ts.array_hash("bool")("data", "shape")).first()[0] == want


def test_normalisation_round_trip(spark):
    doc = {"frozen": True, "channels": {
        "a": {"method": "zscore", "mean": 1.5, "std": 3.0}, "b": {"method": "minmax", "min": -1, "max": 3, "output_range": [-1, 1]},
        "c": {"method": "log1p_zscore", "mean": 0.2, "std": 2.0, "epsilon": 0.1}, "d": {"method": "signed_log1p_zscore", "mean": 0.1, "std": 0.7},
        "e": {"method": "robust_zscore", "median": 1.0, "scale": 2.0}, "f": {}}}
    stats = norm.stat_table(spark, norm.parse_statistics(doc))
    df = spark.createDataFrame([(c, float(v)) for c in "abcdef" for v in (0.0, 0.5, 2.5)], "channel string, value double")
    got = norm.with_stats(df, stats).withColumn("n", normalize(F.col("value"))).select("value", "channel", denormalize(F.col("n")).alias("b"), "n").collect()
    assert all(abs(r["value"] - r["b"]) < 1e-12 for r in got)
    one = {(r["channel"], r["value"]): r["n"] for r in got}
    rows = {r[0]: r for r in norm.parse_statistics(doc)}
    for (c, v), n in one.items():
        assert abs(norm.normalize_number(v, rows[c]) - n) < 1e-12
    assert norm.invalid_statistics(stats).count() == 0
    with pytest.raises(Exception, match="normalisation of c is not finite"):
        norm.apply_normalization(spark.createDataFrame([("c", -2.0)], "channel string, value double"), stats).collect()
    with pytest.raises(ValueError):
        norm.parse_statistics({"channels": {}})


def test_grid_and_map_checks():
    with pytest.raises(ValueError):
        grids.Grid((0, 0, 0), (1, 0, 1), (1, 1, 1))
    with pytest.raises(ValueError):
        grids.CoordinateMap(rotation=((1, 0, 0), (0, 1, 0), (0, 0, -1)))
    with pytest.raises(ValueError):
        sc.Parameter("a", "angle", "global", ("s",))


def test_contract_documents(spark):
    good = {"a": CONTRACT}
    declared, model = contract.contract_channels(spark, good)
    names = [(c, ch) for c in good for ch in STATISTICS["channels"]]
    stats = spark.createDataFrame(names, "contract_id string, channel string")
    assert contract.check_contract(declared, model, stats).count() == 0
    broken = {**CONTRACT, "input_channels": ["T", "T", "nope"]}
    declared, model = contract.contract_channels(spark, {"a": broken})
    found = {(r["rule"], r["channel"]) for r in contract.check_contract(declared, model, stats).collect()}
    assert ("duplicate input channel", "T") in found and ("model channel has no producer", "nope") in found
    with pytest.raises(ValueError):
        contract.parse_fields({"fields": [{"source_name": "U", "output_channels": ["x", "y"], "role": "INPUT", "kind": "vector"}]})
