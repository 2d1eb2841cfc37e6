"""File inventories of a campaign: what exists per case, what is current, what to run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from gridloom.functions.cells import is_time_name, path_token, time_value

CASE = ("batch_id", "case_id")
_LAYOUT = r"(?:^|/)batch_([^/]+)/([^/]+)/(flow|trd|vtk)/(.*)$"

# Marker file of each stage, relative to the case folder.
MARKERS = {
    "mesh_restart_marker": ("flow", "restart.marker"),
    "flow_marker": ("flow", "flow.marker"),
    "transport_marker": ("trd", "transport.marker"),
    "post_signature": ("vtk", "post_processing.complete"),
}


def parse_inventory(files: DataFrame) -> DataFrame:
    """Batch, case, domain, inner path, file name and time folder of every path."""
    # One pattern match per path; its groups come back as one array.
    parts = F.regexp_replace("path", _LAYOUT, "\n$1\n$2\n$3\n$4")
    cut = files.select("path", F.split(parts, "\n").alias("_p")).filter(F.size("_p") == 5)
    inner = F.col("_p")[4]
    head = F.substring_index(inner, "/", 1)
    return cut.select(
        "path",
        F.col("_p")[1].alias("batch_id"),
        F.col("_p")[2].alias("case_id"),
        F.col("_p")[3].alias("domain"),
        inner.alias("inner_path"),
        F.substring_index("path", "/", -1).alias("file_name"),
        F.when((F.instr(inner, "/") > 0) & is_time_name(head), head).alias("time_name"),
    )


def case_dirs(inv: DataFrame) -> DataFrame:
    """Existing (batch_id, case_id, domain): a folder is implied by its files."""
    return inv.select(*CASE, "domain").distinct()


def case_state(inv: DataFrame) -> DataFrame:
    """What each domain of a case holds."""
    inner = F.col("inner_path")
    return inv.groupBy(*CASE, "domain").agg(
        (
            F.bool_or(inner == "constant/polyMesh/points")
            & F.bool_or(inner == "constant/polyMesh/boundary")
        ).alias("has_mesh"),
        F.bool_or(inner.startswith("constant/polyMesh/")).alias("ready"),
        F.bool_or(inner == "restart.marker").alias("has_restart_marker"),
        F.bool_or(inner == "flow.marker").alias("has_flow_marker"),
        F.bool_or(inner == "transport.marker").alias("has_transport_marker"),
        F.coalesce(
            F.bool_or(F.col("time_name").isNotNull() & (F.col("time_name") != "0")), F.lit(False)
        ).alias("has_nonzero_time"),
        F.bool_or(inner.isin("0/wallDistance", "0/wallDistance.gz")).alias("has_wall_distance"),
    )


def _mode(go_on: Column, force: bool) -> Column:
    return F.when(go_on & F.lit(not force), F.lit("continue")).otherwise(F.lit("fresh"))


def mesh_mode(state: DataFrame, force: bool = False) -> DataFrame:
    go_on = F.col("has_mesh") & (F.col("has_restart_marker") | F.col("has_nonzero_time"))
    return state.filter("domain = 'flow'").select(*CASE, _mode(go_on, force).alias("mode"))


def flow_mode(state: DataFrame, force: bool = False) -> DataFrame:
    go_on = F.col("has_flow_marker") | F.col("has_nonzero_time")
    return state.filter("domain = 'flow'").select(*CASE, _mode(go_on, force).alias("mode"))


def transport_mode(state: DataFrame, force: bool = False) -> DataFrame:
    go_on = F.col("has_transport_marker") | F.col("has_nonzero_time")
    return state.filter("domain = 'trd'").select(*CASE, _mode(go_on, force).alias("mode"))


def wall_distance_status(
    before: DataFrame, after: DataFrame | None = None, force: bool = False
) -> DataFrame:
    """``existing`` or ``todo`` per flow case; with ``after`` also generated or failed.

    Both arguments are case states.
    """
    flow = before.filter("domain = 'flow'").select(*CASE, F.col("has_wall_distance").alias("_had"))
    had = F.col("_had") & F.lit(not force)
    if after is None:
        status = F.when(had, F.lit("existing")).otherwise(F.lit("todo"))
        return flow.select(*CASE, status.alias("status"))
    now = after.filter("domain = 'flow'").select(*CASE, F.col("has_wall_distance").alias("_has"))
    has = F.coalesce("_has", F.lit(False))
    status = F.when(had, F.lit("existing")).when(has, F.lit("generated")).otherwise(F.lit("failed"))
    return flow.join(now, list(CASE), "left").select(*CASE, status.alias("status"))


# ---------------------------------------------------------------------- times


def times(inv: DataFrame, domain: str) -> DataFrame:
    """Distinct time folders of a domain with their numeric value."""
    return (
        inv.filter((F.col("domain") == domain) & F.col("time_name").isNotNull())
        .select(*CASE, "time_name", time_value("time_name").alias("time_value"))
        .distinct()
    )


def latest_time(inv: DataFrame, domain: str) -> DataFrame:
    """Greatest time by value, then by name."""
    return times(inv, domain).groupBy(*CASE).agg(
        F.max_by("time_name", F.struct("time_value", "time_name")).alias("latest_time")
    )


def time_list(inv: DataFrame, domain: str) -> DataFrame:
    """Time names of a case joined by commas in numeric order."""
    ordered = F.array_sort(F.collect_list(F.struct("time_value", "time_name")))
    return times(inv, domain).groupBy(*CASE).agg(
        F.array_join(F.transform(ordered, lambda t: t["time_name"]), ",").alias("times")
    )


def match_times(requested: DataFrame, available: DataFrame, keys: Sequence[str] = CASE) -> DataFrame:
    """First available time that equals each requested one within 1e-10 * (1 + |t|).

    ``requested``: keys, req_name. ``available``: keys, time_name, list_ord.
    The tolerance is relative, so both sides meet on a bucket of log(1 + t);
    only the requested side is tripled for the neighbour buckets. Both sides
    are shuffled: the times of a case come out of arrays or text, so Spark
    takes a table of many requests for a small one and would broadcast it.
    """
    keys = list(keys)
    bucket = F.floor(F.log1p("_t") / 1e-9)
    want = requested.withColumn("_t", time_value("req_name"))
    probes = want.withColumn("_b", F.explode(F.array(bucket - 1, bucket, bucket + 1)))
    have = available.select(
        *keys, "time_name", "list_ord", time_value("time_name").alias("_t")
    ).select(*keys, "time_name", "list_ord", F.col("_t").alias("_a"), bucket.alias("_b"))
    near = F.abs(F.col("_a") - F.col("_t")) <= 1e-10 * (1 + F.abs(F.col("_t")))
    found = (
        probes.hint("merge").join(have, [*keys, "_b"])
        .filter(near)
        .groupBy(*keys, "req_name")
        .agg(F.min_by("time_name", "list_ord").alias("matched_time"))
    )
    return requested.hint("merge").join(found, [*keys, "req_name"], "left")


def unmatched_times(matched: DataFrame, lists: DataFrame, keys: Sequence[str] = CASE) -> DataFrame:
    """Requested times without a match, with the times that exist."""
    text = F.concat(
        F.lit("Requested time "), F.col("req_name"),
        F.lit(" was not written by the solver. Available times: "),
        F.coalesce("times", F.lit("none")),
    )
    return (
        matched.filter("matched_time is null")
        .join(lists, list(keys), "left")
        .select(*keys, "req_name", text.alias("message"))
    )


# ------------------------------------------------------------ post-processing


def post_state(inv: DataFrame) -> DataFrame:
    """What post-processing needs to know of a case, in one aggregate.

    Only the distinct time names of a case are kept: they are its signature.
    """
    domain, inner, name = F.col("domain"), F.col("inner_path"), F.col("time_name")
    timed = F.when(name.isNotNull(), F.struct(time_value("time_name").alias("v"), name.alias("n")))
    return inv.groupBy(*CASE).agg(
        F.bool_or((domain == "trd") & inner.startswith("constant/polyMesh/")).alias("ready"),
        F.bool_or(domain == "flow").alias("has_flow"),
        F.bool_or((domain == "vtk") & (inner == "post_processing.complete")).alias("has_marker"),
        F.max(F.when(domain == "flow", timed))["n"].alias("latest_time"),
        F.array_sort(F.collect_set(F.when(domain == "trd", timed)))["n"].alias("trd_times"),
    )


def _signed(state: DataFrame, scalar_field: str, flow_zero_fields: str, flow_result_fields: str) -> DataFrame:
    times_text = F.when(F.col("ready"), F.array_join("trd_times", ",")).otherwise(F.lit(""))
    signature = F.concat_ws(
        "\n",
        F.concat(F.lit("flow_latest="), F.coalesce("latest_time", F.lit(""))),
        F.concat(F.lit("transport_ready="), F.col("ready").cast("int").cast("string")),
        F.concat(F.lit("transport_times="), times_text),
        F.lit(f"scalar_field={scalar_field}"),
        F.lit(f"flow_zero_fields={flow_zero_fields}"),
        F.lit(f"flow_result_fields={flow_result_fields}"),
        F.lit("vtu_point_data=included"),
    )
    return state.filter("has_flow").withColumn("signature", signature)


def post_signature(
    inv: DataFrame,
    scalar_field: str = "T",
    flow_zero_fields: str = "U p wallDistance",
    flow_result_fields: str = "U p",
) -> DataFrame:
    """Structural signature of a case's source results, and its readiness."""
    signed = _signed(post_state(inv), scalar_field, flow_zero_fields, flow_result_fields)
    return signed.select(*CASE, "ready", "latest_time", "signature")


def _expected(state: DataFrame) -> DataFrame:
    """Explode the output names that a complete post-processing leaves."""
    def named(prefix: str, time: Column) -> Column:
        return F.concat(F.lit(prefix), path_token(time), F.lit(".vtu"))

    flow = F.when(
        F.col("latest_time").isNotNull(),
        F.array(F.lit("flow_0.vtu"), named("flow_latest_", F.col("latest_time"))),
    ).otherwise(F.array().cast("array<string>"))
    later = F.transform(F.filter("trd_times", lambda t: t != "0"), lambda t: named("trd_", t))
    trd = F.when(F.col("ready"), F.concat(F.array(F.lit("trd_0.vtu")), later)).otherwise(
        F.array().cast("array<string>")
    )
    return state.select(*CASE, F.explode(F.array_distinct(F.concat(flow, trd))).alias("file_name"))


def expected_outputs(inv: DataFrame) -> DataFrame:
    """File names that a complete post-processing leaves in ``vtk``."""
    return _expected(post_state(inv))


def _absent(expected: DataFrame, inv: DataFrame) -> DataFrame:
    present = inv.filter("domain = 'vtk' and inner_path = file_name").select(*CASE, "file_name")
    return expected.join(present, [*CASE, "file_name"], "left_anti")


def missing_outputs(inv: DataFrame) -> DataFrame:
    """Expected minus present output files."""
    return _absent(expected_outputs(inv), inv)


def post_decision(
    inv: DataFrame,
    stored: DataFrame,
    force: bool = False,
    scalar_field: str = "T",
    flow_zero_fields: str = "U p wallDistance",
    flow_result_fields: str = "U p",
) -> DataFrame:
    """skip or rebuild per case. ``stored``: (batch_id, case_id, stored_signature).

    Only a case whose marker holds the current signature can be skipped, so the
    output files are checked for those cases alone.
    """
    signed = _signed(post_state(inv), scalar_field, flow_zero_fields, flow_result_fields)
    judged = signed.join(stored, list(CASE), "left").withColumn(
        "_same",
        F.col("has_marker")
        & F.coalesce(F.col("stored_signature") == F.col("signature"), F.lit(False))
        & F.col("latest_time").isNotNull()
        & F.lit(not force),
    )
    gaps = _absent(_expected(judged.filter("_same")), inv).select(*CASE, F.lit(True).alias("_gap")).distinct()
    joined = judged.join(gaps, list(CASE), "left")
    current = F.col("_same") & F.col("_gap").isNull()
    message = (
        F.when(
            current & F.col("ready"),
            F.lit("source results unchanged; existing VTU outputs reused"),
        )
        .when(
            current,
            F.lit(
                "flow VTU files reused; transport conversion skipped because the transport "
                "subcase is not prepared"
            ),
        )
        .when(F.col("ready"), F.lit("flow and transport VTU files created"))
        .otherwise(
            F.lit(
                "flow VTU files created; transport conversion skipped because the transport "
                "subcase is not prepared"
            )
        )
    )
    return joined.select(
        *CASE,
        "ready",
        F.when(current, F.lit("skip")).otherwise(F.lit("rebuild")).alias("decision"),
        F.when(current, F.lit("skipped")).otherwise(F.lit("completed")).alias("status"),
        message.alias("message"),
    )


def output_status(requested: DataFrame, files: DataFrame, keys: Sequence[str], overwrite: bool = False) -> DataFrame:
    """created or skipped per requested output set (skip only when all exist)."""
    there = files.select("path").distinct().withColumn("_there", F.lit(True))
    joined = requested.join(there, requested["output"] == there["path"], "left")
    complete = F.every(F.coalesce("_there", F.lit(False)))
    return joined.groupBy(*keys).agg(
        F.when(complete & F.lit(not overwrite), F.lit("skipped")).otherwise(F.lit("created")).alias("status")
    )


def status_report(cases: DataFrame, inv: DataFrame) -> DataFrame:
    """Case folder and the four markers, present or absent, for every listed case."""
    inner = F.col("inner_path")
    found = inv.groupBy(*CASE).agg(
        F.lit(True).alias("_dir"),
        *[
            F.bool_or((F.col("domain") == domain) & (inner == name)).alias(f"_{label}")
            for label, (domain, name) in MARKERS.items()
        ],
    )

    def state(c: str) -> Column:
        return F.when(F.coalesce(F.col(c), F.lit(False)), F.lit("present")).otherwise(F.lit("absent"))

    listed = cases.select(*CASE).distinct()
    return listed.join(found, list(CASE), "left").select(
        *CASE, state("_dir").alias("case_dir"), *[state(f"_{m}").alias(m) for m in MARKERS]
    )


# -------------------------------------------------------------- field pairing


def latest_vtu(files: DataFrame) -> DataFrame:
    """Greatest ``flow_latest_<n>.vtu`` per folder: (vtk_dir, output_vtu)."""
    pattern = r"(?i)^flow_latest_(\d+)\.vtu$"
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    folder = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    named = files.select("path", name.alias("_name"), folder.alias("vtk_dir")).filter(
        F.col("_name").rlike(pattern)
    )
    number = F.regexp_extract("_name", pattern, 1).cast("decimal(38,0)")
    return named.groupBy("vtk_dir").agg(
        F.max_by("path", F.struct(number.alias("n"), F.col("_name"))).alias("output_vtu")
    )


def discover_vtk(cases: DataFrame, files: DataFrame, root: str) -> DataFrame:
    """Folders with ``flow_0.vtu`` that belong to each case.

    First choice: a folder named ``vtk`` below a folder of the case, both below
    the root. Only when there is none: any folder with an ancestor of the case.
    Returns case_id, vtk_dir (when unique), n_dirs and dirs (sorted).
    """
    prefix = root.rstrip("/")
    folder = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    sources = (
        files.filter(F.col("path").endswith("/flow_0.vtu"))
        .select(folder.alias("dir"))
        .filter(F.col("dir").startswith(prefix + "/"))
        .distinct()
    )
    inside = F.split(F.expr(f"substring(dir, {len(prefix) + 1})"), "/")
    named = sources.select(
        "dir", inside.alias("_inside"), F.explode(F.array_distinct(F.split("dir", "/"))).alias("case_id")
    ).filter(F.col("case_id").startswith("case_"))
    first = (F.element_at(F.split("dir", "/"), -1) == "vtk") & F.array_contains("_inside", F.col("case_id"))
    ids = cases.select("case_id").distinct()
    found = named.join(ids, "case_id").groupBy("case_id").agg(
        F.sort_array(F.collect_set(F.when(first, F.col("dir")))).alias("_first"),
        F.sort_array(F.collect_set("dir")).alias("_any"),
    )
    dirs = F.when(F.size("_first") > 0, F.col("_first")).otherwise(F.col("_any"))
    chosen = found.select("case_id", dirs.alias("dirs"))
    return (
        ids.join(chosen, "case_id", "left")
        .withColumn("n_dirs", F.coalesce(F.size("dirs"), F.lit(0)))
        .withColumn("n_dirs", F.greatest("n_dirs", F.lit(0)))
        .withColumn("vtk_dir", F.when(F.col("n_dirs") == 1, F.get("dirs", F.lit(0))))
    )


def latest_generated(files: DataFrame, keys: Sequence[str], name: str = "internal.vtu") -> DataFrame:
    """The last generated file by path."""
    wanted = files.filter(F.regexp_extract("path", r"([^/]*)$", 1) == name)
    return wanted.groupBy(*keys).agg(F.max("path").alias("latest_file"))
