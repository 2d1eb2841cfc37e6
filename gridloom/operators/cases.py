"""What to do with each row of a batch table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from gridloom.functions.angles import rotate_xy, wind_direction_text
from gridloom.functions.cells import (
    case_id,
    is_number,
    to_number,
    trim_cell,
    uniform_scalar,
    uniform_vector,
)
from gridloom.functions.names import doe_case_name, is_param_name, parse_param
from gridloom.operators.order import first_of_group

# Folder of each stage below a case, plants, zones and sides.
STAGE_FOLDER = {"mesh": "flow", "flow": "flow", "transport": "trd", "post-processing": None}
PLANTS = (("f18p1", "P1"), ("f18p2", "P2"), ("f18p3", "P3"))
ZONES = ("SEB", "AEX", "SEX", "VOC")
SIDES = ("A", "B")
INTAKE_SPEED = 5.0
# Intake direction of each plant and side before rotation.
INTAKES = (
    ("f18p1", "a", 0.0, -1.0),
    ("f18p1", "b", 0.0, 1.0),
    ("f18p2", "a", 1.0, 0.0),
    ("f18p2", "b", -1.0, 0.0),
    ("f18p3", "a", 1.0, 0.0),
    ("f18p3", "b", -1.0, 0.0),
)
STEADY_SOLVERS = (
    "simpleFoam", "buoyantSimpleFoam", "porousSimpleFoam", "buoyantBoussinesqSimpleFoam",
)
KNOWN_FIELDS = ("U", "p", "k", "nut", "omega", "epsilon")


def param_names(df: DataFrame, name: str) -> DataFrame:
    """Check and take apart parameter names: valid, output_name, parsed."""
    c = F.col(name)
    return df.select(
        "*",
        is_param_name(c).alias("valid"),
        doe_case_name(c).alias("output_name"),
        parse_param(c).alias("parsed"),
    )


def mark_duplicates(
    df: DataFrame, group: str = "case_id", row_key: Sequence[str] = ("file_ord", "row_number")
) -> DataFrame:
    """``is_first``: the first row of each case over all files of the run."""
    return first_of_group(df, [group], row_key, "is_first")


def classify_rows(rows: DataFrame, dirs: DataFrame, stage: str, root: str) -> DataFrame:
    """Status of every row before a stage starts; NULL status means it runs.

    ``rows``: batch_id, file_ord, row_number, raw_case. ``dirs``: the existing
    (batch_id, case_id, domain). Order of the rules: missing case, duplicate,
    missing folder. Post-processing drops the first two kinds.
    """
    post = stage == "post-processing"
    missing = F.col("raw_case") == ""
    id_column = case_id("raw_case", strip_quotes=post)
    # Rows without a case must not compete with a case that is named NA.
    keyed = rows.withColumn("case_id", F.when(missing, F.lit(None)).otherwise(id_column))
    marked = mark_duplicates(keyed)
    case_root = F.concat(F.lit(root.rstrip("/") + "/batch_"), F.col("batch_id"), F.lit("/"), F.col("case_id"))
    flow_dir, trd_dir = F.concat(case_root, F.lit("/flow")), F.concat(case_root, F.lit("/trd"))

    have = dirs.groupBy("batch_id", "case_id").agg(
        F.bool_or(F.col("domain") == "flow").alias("_flow"),
        F.bool_or(F.col("domain") == "trd").alias("_trd"),
    )
    joined = marked.join(have.withColumn("_any", F.lit(True)), ["batch_id", "case_id"], "left")
    has_flow = F.coalesce("_flow", F.lit(False))
    has_trd = F.coalesce("_trd", F.lit(False))
    has_any = F.coalesce("_any", F.lit(False))

    def verdict(status: str, message: Column | str) -> Column:
        text = F.lit(message) if isinstance(message, str) else message
        return F.struct(F.lit(status).alias("status"), text.alias("message"))

    rule = F.when(missing, verdict("skipped", "missing Case")).when(
        ~F.col("is_first"), verdict("skipped", "duplicate case id")
    )
    if stage in ("mesh", "flow"):
        rule = rule.when(~has_flow, verdict("skipped", "case directory not found"))
        name, folder = F.concat("case_id", F.lit("/flow")), flow_dir
    elif stage == "transport":
        rule = rule.when(
            ~has_flow,
            verdict("failed", F.concat(F.lit("flow case directory not found: "), flow_dir)),
        ).when(
            ~has_trd,
            verdict("failed", F.concat(F.lit("transport case directory not found: "), trd_dir)),
        )
        name = F.concat("case_id", F.lit("/flow|"), "case_id", F.lit("/trd"))
        folder = trd_dir
    elif post:
        rule = rule.when(~has_any, verdict("failed", "case directory not found"))
        name, folder = F.col("case_id"), case_root
    else:
        raise ValueError(f"unknown stage {stage!r}")
    if post:
        joined = joined.filter(~missing & F.col("is_first") & (F.col("case_id") != "NA"))
    return joined.withColumn("_v", rule).select(
        *rows.columns,
        F.coalesce("case_id", F.lit("")).alias("case_id"),
        F.coalesce(name, F.lit("")).alias("case_name"),
        F.coalesce(folder, F.lit("")).alias("case_dir"),
        F.col("_v.status").alias("status"),
        F.col("_v.message").alias("message"),
    )


def resolve_ws(ws: Column, mode: str = "keep", min_ws: str = "0.001") -> Column:
    """Wind speed for setup by the zero-wind policy: (ws_for_setup, status, message)."""
    if mode not in ("skip", "epsilon", "keep", "error"):
        raise ValueError(f"unknown zero-wind mode {mode!r}")

    def result(value: Column, status: str | None, message: str | None) -> Column:
        return F.struct(
            value.alias("ws_for_setup"),
            F.lit(status).cast("string").alias("status"),
            F.lit(message).cast("string").alias("message"),
        )

    none = F.lit("")
    at_zero = {
        "skip": result(none, "skipped", "WS<=0 and ZERO_WS_MODE=skip"),
        "epsilon": result(F.lit(min_ws), None, None),
        "keep": result(ws, None, None),
        "error": result(none, "failed", "invalid WS for setup"),
    }[mode]
    return (
        F.when(~is_number(ws), result(none, "failed", "invalid WS"))
        .when(to_number(ws) > 0, result(ws, None, None))
        .otherwise(at_zero)
    )


def setup_status(
    rows: DataFrame,
    existing: DataFrame,
    root: str,
    mode: str = "keep",
    min_ws: str = "0.001",
    dry_run: bool = False,
    transport: bool = True,
) -> DataFrame:
    """Setup result rows. A valid case gives a flow row and a transport row.

    ``rows``: batch_id, row_number, raw_case, raw_ws, raw_wd and more;
    ``existing``: (batch_id, case_id, domain) of prepared case folders. Of
    several rows with one case id, the first in row order creates the folder
    and the later ones find it there.
    """
    ws, wd = trim_cell("raw_ws"), trim_cell("raw_wd")
    base = rows.select(
        *rows.columns, case_id("raw_case").alias("case_id"), ws.alias("ws"), wd.alias("_wd")
    ).withColumn("_ws", resolve_ws(F.col("ws"), mode, min_ws))
    bad_wd = ~is_number("_wd")
    bad_ws = ~is_number("ws")
    early = (
        F.when(bad_ws, F.struct(F.lit("failed").alias("status"), F.lit("invalid WS").alias("message")))
        .when(bad_wd, F.struct(F.lit("failed").alias("status"), F.lit("invalid WD").alias("message")))
        .when(F.col("_ws.status").isNotNull(), F.struct("_ws.status", "_ws.message"))
    )
    domains = ["flow", "trd"] if transport else ["flow"]
    judged = base.withColumn("_early", early).withColumn(
        "domain",
        F.explode(
            F.when(F.col("_early").isNotNull(), F.array(F.lit(None).cast("string"))).otherwise(
                F.array(*[F.lit(d) for d in domains])
            )
        ),
    )
    have = existing.select("batch_id", "case_id", "domain").distinct().withColumn("_there", F.lit(True))
    joined = judged.join(have, ["batch_id", "case_id", "domain"], "left")
    kind = F.when(F.col("domain") == "flow", F.lit("flow")).otherwise(F.lit("transport"))
    valid = F.col("domain").isNotNull()
    if dry_run:
        status, message = F.lit("dry_run"), F.concat(F.lit("would create "), kind, F.lit(" case"))
    else:
        keys = ["batch_id", "case_id", "domain"]
        firsts = judged.where(valid).groupBy(*keys).agg(F.min("row_number").alias("_first"))
        joined = joined.join(firsts, keys, "left")
        there = F.coalesce("_there", F.col("row_number") > F.col("_first"), F.lit(False))
        status = F.when(there, F.lit("skipped")).otherwise(F.lit("created"))
        message = F.concat(
            kind, F.when(there, F.lit(" case already exists")).otherwise(F.lit(" case created"))
        )
    case_name = F.concat_ws("/", "case_id", "domain")
    folder = F.concat(F.lit(root.rstrip("/") + "/batch_"), "batch_id", F.lit("/"), case_name)
    keep_raw_wd = F.col("_early.message").isin("invalid WS", "invalid WD")
    return joined.select(
        *rows.columns,
        "case_id",
        F.when(valid, case_name).otherwise(F.lit("")).alias("case_name"),
        F.when(keep_raw_wd, F.col("_wd")).otherwise(wind_direction_text(to_number("_wd"))).alias("wd"),
        "ws",
        F.when(valid, F.col("_ws.ws_for_setup")).otherwise(F.lit("")).alias("ws_for_setup"),
        F.when(valid, folder).otherwise(F.lit("")).alias("case_dir"),
        F.when(valid, status).otherwise(F.col("_early.status")).alias("status"),
        F.when(valid, message).otherwise(F.col("_early.message")).alias("message"),
    )


# ----------------------------------------------------------------- boundaries


def params_map(header: Column, cells: Column) -> Column:
    """Lower-cased header to trimmed cell; of two equal headers the later wins."""
    keys = F.transform(header, lambda h: F.lower(trim_cell(h)))
    pairs = F.transform(keys, lambda k, i: F.struct(k.alias("k"), i.alias("i")))
    backwards = F.reverse(keys)
    last = F.filter(
        pairs, lambda p: F.size(keys) - F.array_position(backwards, p["k"]) == p["i"]
    )
    return F.map_from_entries(
        F.transform(
            last, lambda p: F.struct(p["k"], trim_cell(F.get(cells, p["i"].cast("int"))))
        )
    )


def stack_boundaries(
    df: DataFrame,
    params: str,
    variable: str,
    patches: Sequence[tuple[str, str, str]] | None = None,
) -> DataFrame:
    """Boundary text per case and stack patch, with the legacy column as fallback.

    ``params`` is a map of lower-cased column name to cell. ``variable`` is
    ``Uexit_mps`` (velocity, legacy suffix _U) or ``Cemit_ugpm3`` (scalar,
    legacy suffix _C). A row without a usable value keeps NULL and a warning.
    """
    legacy = {"Uexit_mps": "_U", "Cemit_ugpm3": "_C"}[variable]
    if patches is None:
        patches = [
            (
                f"{plant}_{zone.lower()}_{side.lower()}",
                f"{prefix}_{zone}_{side}__{variable}",
                f"{prefix}_{zone}_{side}{legacy}",
            )
            for plant, prefix in PLANTS
            for zone in ZONES
            for side in SIDES
        ]
    dims = F.array(
        *[
            F.struct(F.lit(p).alias("patch"), F.lit(n).alias("column"), F.lit(o).alias("legacy"))
            for p, n, o in patches
        ]
    )
    keep = [c for c in df.columns if c != params]
    rows = df.select(*keep, params, F.explode(dims).alias("_d"))

    def lookup(name: str) -> Column:
        return F.nullif(trim_cell(F.try_element_at(F.col(params), F.lower(F.col(f"_d.{name}")))), F.lit(""))

    read = rows.select(
        *keep, "_d", lookup("column").alias("_new"), lookup("legacy").alias("_old")
    ).withColumn("raw_value", F.coalesce("_new", "_old"))
    used = F.when(F.col("_new").isNotNull(), F.col("_d.column")).otherwise(F.col("_d.legacy"))
    if variable == "Uexit_mps":
        # The number is its own column, so that it is parsed once per row.
        read = read.withColumn("_number", to_number("raw_value"))
        text = uniform_vector("raw_value", F.col("_number"))
    else:
        text = uniform_scalar("raw_value")
    kind = "velocity" if variable == "Uexit_mps" else "scalar"
    warning = F.when(
        F.col("raw_value").isNull(),
        F.concat(
            F.lit(f"CSV {kind} column missing or empty: "), F.col("_d.column"), F.lit("; skip "), F.col("_d.patch")
        ),
    ).when(
        F.col("boundary").isNull(),
        F.concat(
            F.lit(f"Invalid {kind} value '"), F.col("raw_value"), F.lit("' for "), F.col("_used"),
            F.lit("; skip "), F.col("_d.patch"),
        ),
    )
    return (
        read.withColumn("boundary", text)
        .withColumn("_used", used)
        .select(*keep, F.col("_d.patch").alias("patch"), "raw_value", "boundary", warning.alias("warning"))
    )


def intake_vectors(df: DataFrame, degrees: Column, speed: float = INTAKE_SPEED) -> DataFrame:
    """Rotated intake velocity per case, plant and side."""
    dims = F.array(
        *[
            F.struct(
                F.lit(p).alias("plant"),
                F.lit(s).alias("side"),
                F.lit(x * speed).alias("ux"),
                F.lit(y * speed).alias("uy"),
            )
            for p, s, x, y in INTAKES
        ]
    )
    rows = df.withColumn("_deg", degrees).withColumn("_d", F.explode(dims))
    turned = rows.withColumn("_v", rotate_xy(F.col("_d.ux"), F.col("_d.uy"), F.col("_deg")))
    return turned.select(
        *df.columns, "_d.plant", "_d.side", F.col("_v.x").alias("ux"), F.col("_v.y").alias("uy")
    )


# ----------------------------------------------------------------- turbulence


def required_fields(sim_type: Column, model: Column) -> Column:
    """Start fields that a turbulence setting needs; NULL for an unknown setting."""
    def names(*fields: str) -> Column:
        return F.array(*[F.lit(f) for f in fields])

    return (
        F.when((sim_type == "RAS") & model.isin("kOmega", "kOmegaSST"), names("U", "p", "k", "nut", "omega"))
        .when((sim_type == "RAS") & model.isin("kEpsilon", "realizableKE"), names("U", "p", "k", "nut", "epsilon"))
        .when(sim_type == "LES", names("U", "p", "nut"))
    )


def incompatible_solver(sim_type: Column, solver: Column) -> Column:
    """LES cannot run with a steady solver."""
    return (sim_type == "LES") & solver.isin(*STEADY_SOLVERS)


def missing_fields(cases: DataFrame, present: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Required minus present: ``cases`` has ``required``, ``present`` has ``field``."""
    wanted = cases.select(*keys, F.explode("required").alias("field"))
    return wanted.join(present.select(*keys, "field"), [*keys, "field"], "left_anti")


def extra_fields(cases: DataFrame, present: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Present known fields that the setting does not need; they are pruned."""
    known = F.array(*[F.lit(f) for f in KNOWN_FIELDS])
    surplus = cases.select(*keys, F.explode(F.array_except(known, "required")).alias("field"))
    return surplus.join(present.select(*keys, "field"), [*keys, "field"], "left_semi")


# ----------------------------------------------------------------- identities


def same_table(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that only one of two tables has, with their multiplicity kept."""
    columns = a.columns
    left = a.exceptAll(b.select(*columns)).withColumn("side", F.lit("left"))
    right = b.select(*columns).exceptAll(a).withColumn("side", F.lit("right"))
    return left.unionByName(right)


def file_digests(spark, paths) -> DataFrame:
    """SHA-256 per file, for the byte identity of two copies of a small table."""
    return (
        spark.read.format("binaryFile")
        .load(paths)
        .select("path", "length", F.sha2("content", 256).alias("sha256"))
    )

