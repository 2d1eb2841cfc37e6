"""From decoded field tables to model-ready samples, for many samples at once.

The steps keep one order: inspect, resample, masks, scenario, boundary
overrides, normalise, pad, assemble, describe. Overrides come after the masks
and before normalising; padding values are normalised.

What is wrong with the contract or a document stops the job. What is wrong
with a sample becomes a row of ``problems``: that sample is left out of the
results and named in ``outcomes``, and the others go on.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridloom.operators import contract as contracts
from gridloom.operators import grid as grids
from gridloom.operators import masks as m
from gridloom.operators import normalize as norm
from gridloom.operators import resample as rs
from gridloom.operators import scenario as sc
from gridloom.operators import tensor as ts
from gridloom.operators.doe import union_all
from gridloom.operators.order import small_table
from gridloom.session import cut_lineage

FACE_MASKS = tuple(f"{f}_face_mask" for f in grids.FACES)

#: Rows of a sample (cells, their corners, values and grid cells) up to which a task takes whole samples, and rows for one task.
SAMPLE_ROWS, TASK_ROWS = 4_000_000, 500_000
#: Shuffle files are deleted once a table is written; tables dealt out by sample are joined by longer keys as they lie.
CLEANED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
IN_PLACE = {**CLEANED, "spark.sql.requireAllClusterKeysForCoPartition": "false"}


@dataclass
class Samples:
    """Results of the good samples; ``outcomes`` and ``problems`` speak of all of them.

    ``outcomes``: sample_id, status (``ok`` or ``failed``), message.
    ``channels`` and ``masks`` are the intermediate tables of all samples.
    """

    tensors: DataFrame
    mask_tensors: DataFrame
    global_features: DataFrame | None
    metadata: DataFrame
    quality: DataFrame
    problems: DataFrame
    channels: DataFrame
    masks: DataFrame
    outcomes: DataFrame


def map_tables(tables: Mapping[str, DataFrame], cmap: grids.CoordinateMap) -> dict[str, DataFrame]:
    """Source tables in target coordinates, where cells stay axis-aligned boxes.

    Under a rotation that does more than swap or flip axes they stay in source
    coordinates, and the grid is taken to them when it is resampled.
    """
    if cmap == grids.CoordinateMap() or not cmap.axis_aligned:
        return dict(tables)
    low = grids.map_points(tables["source_cell"], cmap, ("xlo", "ylo", "zlo"))
    both = grids.map_points(low, cmap, ("xhi", "yhi", "zhi"))
    ordered = {}
    for a in "xyz":
        ordered[f"{a}lo"] = F.least(f"{a}lo", f"{a}hi")
        ordered[f"{a}hi"] = F.greatest(f"{a}lo", f"{a}hi")
    return {
        **tables,
        "source_cell": both.withColumns(ordered),
        "source_point": grids.map_points(tables["source_point"], cmap),
    }


def sample_groups(tables: Mapping[str, DataFrame], grid: grids.Grid) -> tuple[list[tuple[dict[str, DataFrame], int | None]], int | None]:
    """The tables with the number of tasks that take whole samples of them, and that number for grids.

    Samples that are too large for one task form a group of their own, whose
    number is None: their rows are spread by longer keys at each step.
    """
    corners = F.greatest(F.coalesce(F.size("point_ids"), F.lit(0)), F.lit(0))
    cells = tables["source_cell"].groupBy("sample_id").agg(F.sum(corners + 1).alias("_rows"))
    values = tables["source_value"].groupBy("sample_id").agg(F.count(F.lit(1)).alias("_rows"))
    rows = cells.unionByName(values).groupBy("sample_id").agg((F.sum("_rows") + grid.size).alias("_rows"))
    found = rows.agg(
        F.count_if(F.col("_rows") > SAMPLE_ROWS).alias("large"), F.sum(F.least("_rows", F.lit(SAMPLE_ROWS))).alias("rows")
    ).first()
    if grid.size > SAMPLE_ROWS:
        return [(dict(tables), None)], None
    # A small table is spread over the cores, down to a tenth of a task. One partition alone is no hash partitioning to Spark.
    cores, count = cells.sparkSession.sparkContext.defaultParallelism, found["rows"] or 0
    tasks = max(2, -(-count // TASK_ROWS), min(cores, -(-count * 10 // TASK_ROWS)))
    if not found["large"]:
        return [(dict(tables), tasks)], tasks
    # Each of them has millions of rows, so their ids are few.
    large = F.broadcast(cut_lineage(rows.filter(F.col("_rows") > SAMPLE_ROWS).select("sample_id")))
    kinds = (("left_anti", tasks), ("left_semi", None))
    return [({t: df.join(large, "sample_id", how) for t, df in tables.items()}, n) for how, n in kinds], tasks


def deal(df: DataFrame, tasks: int | None) -> DataFrame:
    """The rows by whole samples. All sides of a join need the same number of tasks to stay where they are."""
    return df if tasks is None else df.repartition(tasks, "sample_id")


def written(df: DataFrame, tasks: int | None) -> DataFrame:
    """``cut_lineage`` of a table made from rows that were dealt out so."""
    return cut_lineage(df, **(CLEANED if tasks is None else IN_PLACE))


def resample_field(
    tables: Mapping[str, DataFrame], grid: grids.Grid, cmap: grids.CoordinateMap, spec, tasks: int | None = None
) -> DataFrame:
    """(sample_id, field, block_id, priority, idx, v0 …, valid) of one field.

    With ``tasks`` the tables are dealt out by sample once and nothing is moved
    after that: neither corners nor hits.
    """
    turned = None if cmap.axis_aligned else cmap
    (name, channels, _, kind, _, n, association, interpolation, *_rest) = spec
    scale, offset, rotate, volumetric = spec[10], spec[11], spec[12], spec[13]
    together = tasks is not None
    blocks, points = deal(tables["source_block"], tasks), deal(tables["source_point"], tasks)
    cells = tables["source_cell"]
    if together:
        # Rows travel in an array, where no reader's columns and filters reach them: all readers share one shuffle.
        used = F.struct(*rs.CELL_KEY[1:], "point_ids", *[f"{a}{s}" for a in "xyz" for s in ("lo", "hi")])
        cells = deal(cells.select("sample_id", F.array(used).alias("_row")), tasks).select("sample_id", F.inline("_row"))
    if volumetric:
        blocks = blocks.filter("is_volumetric")
        cells = cells.join(blocks.select("sample_id", "block_id"), ["sample_id", "block_id"], "left_semi")
    stored = tables["source_value"].filter(F.col("field") == name)

    # A field on points and cells of one block follows the declared association.
    kinds = stored.groupBy("sample_id", "block_id").agg(
        F.bool_or(F.col("association") == "CELL").alias("_cell"), F.bool_or(F.col("association") == "POINT").alias("_point")
    )
    found = kinds.agg(
        F.bool_or("_cell").alias("cell"), F.bool_or("_point").alias("point"), F.count_if(F.expr("_cell and _point")).alias("both")
    ).first()
    if found["both"]:
        double = kinds.filter("_cell and _point").select("sample_id", "block_id", F.lit(association or "POINT").alias("_keep"))
        stored, double = deal(stored, tasks), deal(double, tasks)
        stored = stored.join(double, ["sample_id", "block_id"], "left").filter(
            F.col("_keep").isNull() | (F.col("association") == F.col("_keep"))
        )
    values = rs.spread_values(stored.drop("_keep"), n)
    parts = rs.components(n)
    if kind == "vector":
        values = grids.map_vectors(values, cmap, scale, parts, rotate)
    elif (scale, offset) != (1.0, 0.0):
        values = values.withColumns({v: grids.convert_units(F.col(v), scale, offset) for v in parts})
    values = values if found["both"] else deal(values, tasks)
    on_cells = values.filter("association = 'CELL'").withColumnRenamed("entity_id", "cell_id")
    on_points = values.filter("association = 'POINT'").withColumnRenamed("entity_id", "point_id")
    if interpolation == "nearest":
        ready = on_cells.select(*rs.CELL_KEY, *parts)
        if found["point"]:
            ready = ready.unionByName(rs.point_to_cell(cells, on_points, n, kind, together).select(*rs.CELL_KEY, *parts))
        sampled = rs.resample_nearest(cells, ready, grid, n, turned)
    else:
        ready = on_points.select(*rs.POINT_KEY, *parts)
        if found["cell"]:
            ready = ready.unionByName(rs.cell_to_point(cells, on_cells, n).select(*rs.POINT_KEY, *parts))
        sampled = rs.resample_linear(cells, points, ready, grid, n, turned, together)
    order = blocks.select("sample_id", "block_id", "priority")
    return sampled.join(order, ["sample_id", "block_id"]).withColumn("field", F.lit(name))


def transform(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    contract: Mapping,
    statistics: Mapping,
    scenarios: DataFrame | None = None,
    boundary_values: Sequence[m.BoundaryValue] = (),
    declared: DataFrame | None = None,
    array_hashes: bool = True,
) -> Samples:
    """All samples of the field tables.

    ``scenarios``: sample_id, params map<string,string>. ``statistics`` is one
    document for all samples; with ``declared`` (sample_id, document, version)
    it maps (name, version) to documents and each sample uses the one it
    declares. ``array_hashes`` adds the hash over a sample's whole arrays to
    the metadata, for which its channels must fit one row; the digests in two
    levels are always there.

    A sample fails if a field is absent, ambiguous or without finite values, if
    too few cells are valid, sources overlap against the policy, masks or
    padding contradict each other, a scenario parameter is missing or unusable,
    an overridden channel isn't produced, a statistic is missing, or a channel
    is incomplete or not finite after normalising. Channels, masks and tensors
    are written once to the shared folder, because several results read them.

    Each of these tables is made from rows dealt out by sample, except for
    samples that are too large for one task: meanwhile the disk holds the
    source rows once, and neither the corners of all cells nor the hits.
    """
    grid = grids.parse_grid(contract)
    cmap = grids.parse_coordinate_map(contract)
    specs = contracts.parse_fields(contract)
    inputs, targets = list(contract["input_channels"]), list(contract["target_channels"])
    model_channels = list(dict.fromkeys([*inputs, *targets]))
    if declared is None:
        stat_rows = norm.parse_statistics(statistics)
        stats = norm.stat_table(spark, stat_rows)
        by_channel = {r[0]: r for r in stat_rows}
        unknown = [c for c in [*model_channels, *global_channels(contract)] if c not in by_channel]
        if unknown:
            raise ValueError(f"no statistic for {unknown}")
    else:
        stats = norm.versioned_statistics(spark, [(name, version, d) for (name, version), d in statistics.items()])
    derived = contract.get("derived_features", {})
    model = contract.get("grid", {}).get("model_grid", {})
    padding = ts.plan_padding(
        grid, model.get("tensor_shape_zyx"), model.get("divisibility_zyx", (16, 16, 16)),
        model.get("padding_alignment", "symmetric"),
    )
    pads = contract.get("padding", {}).get("channel_pad_values_physical", {})
    missing = ts.unpadded_channels([*inputs, *targets], pads)
    if missing:
        raise ValueError(f"no padding value for {missing}")
    policy = contract.get("source_assembly", {}).get("conflict_policy", "REGION_PRIORITY")

    mapped = map_tables(tables, cmap)
    samples = mapped["source_block"].select("sample_id").distinct()
    groups, tasks = sample_groups(mapped, grid)

    invalid = norm.invalid_statistics(stats).collect()
    if invalid:
        raise ValueError(f"unusable statistics: {[tuple(r) for r in invalid]}")

    field_specs = contracts.field_table(spark, specs)
    report = rs.inspect_fields(mapped["source_block"], mapped["source_value"], field_specs)
    problems = [
        rs.missing_required(samples, report, field_specs).select("sample_id", F.col("field").alias("subject"), "problem"),
        report.filter("problem is not null").select("sample_id", F.col("field").alias("subject"), "problem"),
    ]
    held = []
    for some, n in groups:
        parts = []
        for spec in specs:
            sampled = resample_field(some, grid, cmap, spec, n)
            chosen = rs.assemble(sampled, policy, spec[5])
            if policy == "ERROR_ON_OVERLAP":
                clash = rs.check_overlaps(chosen)
                problems.append(clash.select("sample_id", F.col("field").alias("subject"), F.lit("overlapping sources").alias("problem")))
            due = deal(some["source_block"].select("sample_id").distinct(), n)
            parts.append(rs.fill_and_split(chosen, spec[1], grid, spec[9], due))
        # Channels are float32 from here on, masks and normalisation read them as such.
        held.append(written(union_all(parts).withColumn("value", F.col("value").cast("float").cast("double")), n))
    channels = union_all(held)
    limits = small_table(
        spark, [(c, s[14], s[8]) for s in specs for c in s[1]], "channel string, min_valid double, extrapolation string"
    )
    quality = rs.field_quality(channels, ["sample_id", "channel"]).drop("passed").join(limits, "channel").withColumn(
        "passed",
        (F.col("valid_fraction") >= F.col("min_valid"))
        & ((F.col("extrapolation") != "ERROR") | (F.col("valid_cells") == F.col("cells"))),
    )
    problems.append(
        quality.filter("not passed").select(
            "sample_id", F.col("channel").alias("subject"), F.lit("too few valid cells").alias("problem")
        )
    )

    # Masks: one wide row per cell from the validity of the channels they need.
    reference = derived.get("fluid_reference_channel", "Ux")
    wall_name = derived.get("wall_distance_channel", "wallDistance")
    produced = {c for s in specs for c in s[1]}
    wall = wall_name if wall_name in produced else None
    valid_from = [derived["target_valid_reference_channel"]] if derived.get("target_valid_reference_channel") else targets
    watched = sorted({reference, *(valid_from if targets else [])})
    pick = [
        F.bool_or(F.when(F.col("channel") == c, F.col("valid"))).alias(f"valid_{i}") for i, c in enumerate(watched)
    ]
    if wall:
        pick += [
            F.max(F.when(F.col("channel") == wall, F.col("value"))).alias("_wall"),
            F.bool_or(F.when(F.col("channel") == wall, F.col("valid"))).alias("_wall_valid"),
        ]
    used = [*watched, wall] if wall else watched
    cells = deal(channels.filter(F.col("channel").isin(*used)), tasks).groupBy("sample_id", "idx").agg(*pick)
    bounds = None
    if derived.get("domain_mask_mode", "source_bounds") == "source_bounds":
        field = next(s[0] for s in specs if reference in s[1])
        holding = mapped["source_value"].filter(F.col("field") == field).select("sample_id", "block_id").distinct()
        volumetric = mapped["source_block"].filter("is_volumetric").join(holding, ["sample_id", "block_id"], "left_semi")
        boxes = mapped["source_cell"] if cmap.axis_aligned else grids.map_bounds(mapped["source_cell"], cmap)
        # Reduced to one box a block first: no cell is shuffled.
        boxes = boxes.groupBy("sample_id", "block_id").agg(
            *[F.min(f"{a}lo").alias(f"{a}lo") for a in "xyz"], *[F.max(f"{a}hi").alias(f"{a}hi") for a in "xyz"]
        ).join(volumetric.select("sample_id", "block_id"), ["sample_id", "block_id"], "left_semi")
        bounds = deal(boxes.groupBy("sample_id").agg(
            *[F.min(f"{a}lo").alias(f"{a}min") for a in "xyz"], *[F.max(f"{a}hi").alias(f"{a}max") for a in "xyz"]
        ), tasks)
    w, wv = ("_wall", "_wall_valid") if wall else (None, None)
    masks = m.phase_masks(m.domain_mask(cells, grid, bounds), f"valid_{watched.index(reference)}")
    if derived.get("derive_signed_distance", True):
        masks = m.signed_distance(masks, grid, w, wv)
    masks = m.near_wall(m.fluid_boundary(masks, grid, tasks is not None), grid, w, wv, derived.get("near_wall_threshold"))
    masks = grids.face_masks(masks, grid)
    masks = m.target_masks(masks, [f"valid_{watched.index(c)}" for c in valid_from] if targets else [])
    mask_names = [
        "domain_mask", "fluid_mask", "solid_mask", "outside_mask", "near_wall_mask", "fluid_boundary_mask",
        *FACE_MASKS, "target_valid_mask", "loss_mask", "metric_mask",
    ]
    wind = derived.get("wind_direction_parameter")
    if wind and scenarios is not None:
        angle = F.try_element_at("params", F.lit(wind)).try_cast("double").alias("_wind")
        masks = masks.join(deal(scenarios.select("sample_id", angle), tasks), "sample_id", "left")
        masks = m.wind_masks(masks, grid, "_wind", **derived.get("wind_direction_convention", {}))
        masks = masks.withColumns(
            {c: F.coalesce(c, F.lit(False)) for c in ("wind_inlet_mask", "wind_outlet_mask")}
        )
        mask_names += ["wind_inlet_mask", "wind_outlet_mask"]
    masks = written(masks, tasks)
    broken = m.check_masks(masks).filter("fluid_and_solid + outside_domain + loss_without_target > 0")
    problems.append(
        broken.select("sample_id", F.lit("masks").alias("subject"), F.lit("mask invariant broken").alias("problem"))
    )

    mask_map = {
        c: derived["mask_channel_map"][c]
        for c in derived.get("output_channels", [])
        if c in derived.get("mask_channel_map", {})
    }
    everything = channels
    if derived.get("derive_signed_distance", True):
        name = derived.get("signed_distance_name", "signed_distance")
        distance = masks.select(
            "sample_id", F.lit(name).alias("channel"), "idx", F.col("signed_distance").alias("value"),
            F.lit(True).alias("valid"),
        )
        everything = everything.unionByName(distance)
    if mask_map:
        everything = everything.unionByName(m.mask_channels(m.select_masks(masks, mask_map)))
    encoded = None
    parameters = sc.parse_parameters(contract.get("scenario_parameters", []))
    if parameters and scenarios is not None:
        # A sample without a scenario has an empty one: defaults hold, anything else is missing.
        given = samples.join(scenarios.select("sample_id", "params"), "sample_id", "left")
        none = F.create_map().cast("map<string,string>")
        encoded = cut_lineage(sc.encode_scenarios(given.withColumn("params", F.coalesce("params", none)), parameters))
        problems.append(sc.scenario_problems(encoded))
        if any(p.representation == "broadcast" for p in parameters):
            everything = everything.unionByName(sc.broadcast_channels(encoded, masks))
    wanted = deal(everything.filter(F.col("channel").isin(*model_channels)), tasks)
    if boundary_values:
        produced_here = channels.select("sample_id", "channel").distinct()
        overridden = [*dict.fromkeys(b.channel for b in boundary_values)]
        known_elsewhere = set(mask_map) | {p for q in parameters for p in q.output_channels if q.representation == "broadcast"}
        if derived.get("derive_signed_distance", True):
            known_elsewhere.add(derived.get("signed_distance_name", "signed_distance"))
        problems.append(m.unknown_overrides(samples, produced_here, [c for c in overridden if c not in known_elsewhere]))
        fluid = deal(masks.select("sample_id", "idx", "fluid_mask"), tasks)
        with_fluid = wanted.join(fluid, ["sample_id", "idx"])
        wanted = m.apply_boundary_values(with_fluid, grid, boundary_values).drop("fluid_mask")

    if declared is None:
        normalized = norm.normalized_or_null(wanted, stats)
        pad_values = {c: norm.normalize_number(float(pads[c]), by_channel[c]) for c in model_channels}
    else:
        chosen = samples.join(declared.select("sample_id", "document", "version"), "sample_id", "left")
        per_sample = cut_lineage(norm.declared_statistics(chosen, stats, [*dict.fromkeys([*model_channels, *global_channels(contract)])]))
        unstated = per_sample.filter("problem is not null").select("sample_id", F.col("channel").alias("subject"), "problem")
        problems.append(unstated)
        own = per_sample.drop("document", "version", "problem")
        normalized = norm.normalized_or_null(wanted, deal(own, tasks), ["sample_id", "channel"])
        physical = F.element_at(F.create_map(*[F.lit(v) for c in model_channels for v in (c, float(pads[c]))]), F.col("channel"))
        to_pad = own.filter(F.col("channel").isin(*model_channels)).select("sample_id", "channel", physical.alias("value"))
        pad_values = deal(norm.normalized_or_null(to_pad, own, ["sample_id", "channel"]), tasks)
    padded = ts.pad_channels(normalized, deal(samples, tasks), padding, pad_values)
    marked = written(ts.mark_tensors(padded, deal(samples, tasks), padding.model, inputs, targets), tasks)
    unmade = marked.filter("problem is not null").select("sample_id", F.col("channel").alias("subject"), "problem")
    # A channel without a statistic has no values either; the first reason is the one to tell.
    problems.append(unmade if declared is None else unmade.join(unstated, ["sample_id", "subject"], "left_anti"))
    padded_masks = ts.pad_masks(masks, samples, padding, mask_names)
    problems.append(
        ts.padding_overlap(padded_masks).filter("overlap > 0").select(
            "sample_id", F.lit("padding").alias("subject"), F.lit("padding meets the domain").alias("problem")
        )
    )
    found = written(union_all(problems).distinct(), tasks if len(groups) == 1 else None)
    outcomes = sample_outcomes(samples, found)
    failed = found.select("sample_id").distinct()

    def good(df: DataFrame) -> DataFrame:
        return df.join(failed, "sample_id", "left_anti")

    tensors = good(marked).drop("problem")
    shown = [*dict.fromkeys(mask_map.values())]
    mask_tensors = ts.build_mask_tensors(good(padded_masks), padding.model, shown or ["fluid_mask"])
    features = None
    if encoded is not None:
        features = sc.global_features(good(encoded), stats) if declared is None else sc.global_features(
            good(encoded), own, ["sample_id", "channel"]
        )

    facts = spark.createDataFrame(
        [(c, s[0], s[2], s[3], s[8], s[9]) for s in specs for c in s[1]],
        "channel string, source_field string, role string, kind string, extrapolation_policy string, "
        "fill_value double",
    )
    described = {
        "resampling": ts.channel_provenance(good(channels), facts),
        "mask_fractions": m.mask_fractions(good(masks), mask_names),
        "content_digests": ts.content_digests(tensors),
    }
    if array_hashes:
        described["tensor_hashes"] = ts.tensor_hashes(tensors)
    if boundary_values:
        described["boundary_conditions"] = m.boundary_cells(good(masks), grid, boundary_values)
    if declared is not None:
        described["statistics"] = per_sample.groupBy("sample_id").agg(
            F.first("document").alias("document"), F.first("version").alias("version")
        )
    metadata = ts.provenance(
        good(samples), grid, padding, inputs, targets, ts.document_hash(contract),
        ts.document_hash(statistics if declared is None else {f"{n}/{v}": d for (n, v), d in statistics.items()}), described,
    )
    return Samples(tensors, mask_tensors, features, metadata, quality, found, channels, masks, outcomes)


def global_channels(contract: Mapping) -> list[str]:
    """Channels of the scenario parameters that travel as one vector per sample."""
    parameters = sc.parse_parameters(contract.get("scenario_parameters", []))
    return [c for p in parameters if p.representation == "global" for c in p.output_channels]


def sample_outcomes(samples: DataFrame, problems: DataFrame) -> DataFrame:
    """One row per sample: sample_id, status ``ok`` or ``failed``, and what is wrong, in alphabetical order."""
    text = F.concat_ws(": ", "subject", "problem")
    told = problems.groupBy("sample_id").agg(F.array_join(F.array_sort(F.collect_set(text)), "; ").alias("_told"))
    return samples.select("sample_id").distinct().join(told, "sample_id", "left").select(
        "sample_id",
        F.when(F.col("_told").isNull(), F.lit("ok")).otherwise(F.lit("failed")).alias("status"),
        F.coalesce("_told", F.lit("")).alias("message"),
    )
