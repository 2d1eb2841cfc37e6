"""Normalisation, scenario encoding, padding, tensors, hashes and contracts."""

from pyspark.sql import functions as F

from catalog import query, table
from catalog.fields import CELLS_SQL, GRID, HITS_SQL, MESH_SQL, TARGET, field_cells, mesh
from gridloom.functions.statistics import denormalize, normalize
from gridloom.operators import contract, manifest
from gridloom.operators import normalize as norm
from gridloom.operators import scenario as sc
from gridloom.operators import tensor as ts
from gridloom.plans.field_transform import transform

# channel, method, mean, std, median, scale, min, max, out_lo, out_hi, epsilon
STATS = [
    ("extendedprice", "zscore", 50000.0, 28000.0, None, None, None, None, None, None, None),
    ("quantity", "minmax", None, None, None, None, 1.0, 50.0, -1.0, 1.0, None),
    ("discount", "robust_zscore", None, None, 0.05, 0.025, None, None, None, None, None),
    ("tax", "identity", None, None, None, None, None, None, None, None, None),
    ("partkey", "log1p_zscore", 6.0, 1.5, None, None, None, None, None, None, 0.5),
    ("balance", "signed_log1p_zscore", 1.0, 2.0, None, None, None, None, None, None, None),
]
NAMES = [s[0] for s in STATS]

LONG_SQL = """
    SELECT l_orderkey, l_linenumber, l_suppkey, unnest([{'c': 'extendedprice', 'v': l_extendedprice}, {'c': 'quantity', 'v': l_quantity}, {'c': 'discount', 'v': l_discount},
       {'c': 'tax', 'v': l_tax}, {'c': 'partkey', 'v': l_partkey::double}, {'c': 'balance', 'v': (l_partkey - 900)::double}]) AS e FROM lineitem
"""
NORMAL_SQL = """CASE e.c WHEN 'extendedprice' THEN (e.v - 50000.0::double) / 28000.0::double WHEN 'quantity' THEN -1.0::double + (e.v - 1.0::double) * 2.0::double / 49.0::double
    WHEN 'discount' THEN (e.v - 0.05::double) / 0.025::double WHEN 'tax' THEN e.v WHEN 'partkey' THEN (ln(1 + e.v + 0.5::double) - 6.0::double) / 1.5::double
    ELSE (sign(e.v) * ln(1 + abs(e.v)) - 1.0::double) / 2.0::double END"""


def long_values(spark, sf):
    values = [
        F.col("l_extendedprice"), F.col("l_quantity"), F.col("l_discount"), F.col("l_tax"),
        F.col("l_partkey").cast("double"), (F.col("l_partkey") - 900).cast("double"),
    ]
    pairs = [F.struct(F.lit(n).alias("channel"), v.alias("value")) for n, v in zip(NAMES, values)]
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", F.inline(F.array(*pairs)))


@query(f"WITH u AS ({LONG_SQL}) SELECT l_orderkey, l_linenumber, l_suppkey, e.c AS channel, round({NORMAL_SQL}, 7) AS value FROM u")
def normalized_values(spark, sf):
    rows = norm.with_stats(long_values(spark, sf), norm.stat_table(spark, STATS))
    return rows.select(
        "l_orderkey", "l_linenumber", "l_suppkey", "channel", F.round(normalize(F.col("value")), 7).alias("value")
    )


@query(f"WITH u AS ({LONG_SQL}) SELECT l_orderkey, l_linenumber, l_suppkey, e.c AS channel, round(e.v, 6) + 0.0::double AS value FROM u")
def denormalized_values(spark, sf):
    """The inverse brings every value back."""
    rows = norm.with_stats(long_values(spark, sf), norm.stat_table(spark, STATS))
    back = rows.withColumn("value", normalize(F.col("value"))).withColumn("value", denormalize(F.col("value")))
    return back.select(
        "l_orderkey", "l_linenumber", "l_suppkey", "channel", (F.round("value", 6) + 0.0).alias("value")
    )


@query(
    f"""
    WITH u AS ({LONG_SQL}) SELECT e.c AS channel, count(*) AS rows, round(sum(round(({NORMAL_SQL})::float::double * 1000)), 0) AS checksum FROM u GROUP BY ALL
    """
)
def model_channels(spark, sf):
    """The whole step: statistics joined, applied and stored as float32."""
    done = norm.apply_normalization(long_values(spark, sf), norm.stat_table(spark, STATS))
    return done.groupBy("channel").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.round(F.col("value").cast("double") * 1000)).alias("checksum")
    )


@query(
    """
    SELECT 's' || p_partkey AS channel, CASE p_partkey % 6 WHEN 0 THEN CASE WHEN p_size <= 10 THEN 'std must be finite and positive' END
       WHEN 1 THEN CASE WHEN p_size <= 10 THEN 'scale must be finite and positive' END WHEN 2 THEN CASE WHEN p_size <= 10 THEN 'max-min must be finite and positive' END
       WHEN 3 THEN CASE WHEN p_size <= 10 THEN 'output range must be finite and positive' END WHEN 4 THEN 'unsupported method' END AS problem
    FROM part WHERE p_partkey % 6 <> 5 AND (p_size <= 10 OR p_partkey % 6 = 4)
    """
)
def invalid_statistics(spark, sf):
    size = F.col("p_size") - 10
    method = F.get(
        F.array(*[F.lit(v) for v in ("zscore", "robust_zscore", "minmax", "minmax", "cubic", "identity")]),
        (F.col("p_partkey") % 6).cast("int"),
    )
    d = size.cast("double")
    span = F.col("p_partkey") % 6 == 3
    stats = table(spark, sf, "part").select(
        F.concat(F.lit("s"), F.col("p_partkey").cast("string")).alias("channel"), method.alias("method"),
        F.lit(0.0).alias("mean"), d.alias("std"), F.lit(0.0).alias("median"), d.alias("scale"),
        F.lit(0.0).alias("min"), F.when(span, F.lit(1.0)).otherwise(d).alias("max"),
        F.lit(0.0).alias("out_lo"), F.when(span, d).otherwise(F.lit(1.0)).alias("out_hi"), F.lit(0.0).alias("epsilon"),
    )
    return norm.invalid_statistics(stats)


@query(
    f"""
    WITH u AS ({LONG_SQL}) SELECT e.c AS channel, count(*) AS rows FROM u WHERE e.c = 'partkey' AND e.v < 3 GROUP BY ALL
    """
)
def values_without_result(spark, sf):
    """log1p has no value at or below -1: rows that would fail the job."""
    shifted = long_values(spark, sf).withColumn(
        "value", F.when(F.col("channel") == "partkey", F.col("value") - 4.0).otherwise(F.col("value"))
    )
    return norm.unnormalizable(shifted, norm.stat_table(spark, STATS))


@query(f"WITH u AS ({LONG_SQL}) SELECT DISTINCT e.c || '_' || l_suppkey % 3 AS channel FROM u WHERE l_suppkey % 3 <> 0")
def channels_without_stats(spark, sf):
    renamed = long_values(spark, sf).withColumn(
        "channel", F.concat_ws("_", "channel", (F.col("l_suppkey") % 3).cast("string"))
    )
    known = norm.stat_table(spark, [(f"{s[0]}_0", *s[1:]) for s in STATS])
    return norm.channels_without_stats(renamed, known)


# ------------------------------------------------------------------- scenario

PARAMETERS = [
    sc.Parameter("wind_speed_mps", "scalar", "broadcast", ("wind_speed_mps",)),
    sc.Parameter("wind_direction_deg", "angle", "global", ("wind_dir_sin", "wind_dir_cos"), default=180.0),
    sc.Parameter(
        "segment", "categorical", "global", ("s_auto", "s_build", "s_house"),
        categories=("AUTOMOBILE", "BUILDING", "HOUSEHOLD"),
    ),
]
ENCODED_SQL = """
    WITH s AS (SELECT c_custkey AS sample_id, c_acctbal AS speed, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_nationkey * 11 END AS deg, c_mktsegment AS seg FROM customer),
    d AS (SELECT *, radians(coalesce(deg, 180)::double) AS r FROM s),
    e AS (SELECT sample_id, unnest([
      {'o': 0, 'n': 'wind_speed_mps', 'r': 'broadcast', 'c': 'wind_speed_mps', 'v': speed, 'd': false, 'p': NULL::varchar},
      {'o': 1000, 'n': 'wind_direction_deg', 'r': 'global', 'c': 'wind_dir_sin', 'v': round(-sin(pi() / 2 - r), 9) + 0.0::double, 'd': deg IS NULL, 'p': NULL},
      {'o': 1001, 'n': 'wind_direction_deg', 'r': 'global', 'c': 'wind_dir_cos', 'v': round(-cos(pi() / 2 - r), 9) + 0.0::double, 'd': deg IS NULL, 'p': NULL},
      {'o': 2000, 'n': 'segment', 'r': 'global', 'c': 's_auto', 'v': CASE WHEN seg IN ('AUTOMOBILE', 'BUILDING', 'HOUSEHOLD') THEN (seg = 'AUTOMOBILE')::int::double END, 'd': false,
         'p': CASE WHEN seg NOT IN ('AUTOMOBILE', 'BUILDING', 'HOUSEHOLD') THEN 'unusable value of segment: ' || seg END},
      {'o': 2001, 'n': 'segment', 'r': 'global', 'c': 's_build', 'v': CASE WHEN seg IN ('AUTOMOBILE', 'BUILDING', 'HOUSEHOLD') THEN (seg = 'BUILDING')::int::double END, 'd': false,
         'p': CASE WHEN seg NOT IN ('AUTOMOBILE', 'BUILDING', 'HOUSEHOLD') THEN 'unusable value of segment: ' || seg END},
      {'o': 2002, 'n': 'segment', 'r': 'global', 'c': 's_house', 'v': CASE WHEN seg IN ('AUTOMOBILE', 'BUILDING', 'HOUSEHOLD') THEN (seg = 'HOUSEHOLD')::int::double END, 'd': false,
         'p': CASE WHEN seg NOT IN ('AUTOMOBILE', 'BUILDING', 'HOUSEHOLD') THEN 'unusable value of segment: ' || seg END}]) AS x FROM d)
"""


def encoded(spark, sf):
    params = F.map_from_entries(
        F.array_compact(
            F.array(
                F.struct(F.lit("wind_speed_mps").alias("k"), F.col("c_acctbal").cast("string").alias("v")),
                F.when(
                    F.col("c_custkey") % 3 != 0,
                    F.struct(F.lit("wind_direction_deg").alias("k"), (F.col("c_nationkey") * 11).cast("string").alias("v")),
                ),
                F.struct(F.lit("segment").alias("k"), F.col("c_mktsegment").alias("v")),
            )
        )
    )
    samples = table(spark, sf, "customer").select(F.col("c_custkey").alias("sample_id"), params.alias("params"))
    return sc.encode_scenarios(samples, PARAMETERS)


@query(f"{ENCODED_SQL} SELECT sample_id, x.o AS ordinal, x.n AS name, x.r AS representation, x.c AS channel, x.v AS value, x.d AS used_default, x.p AS problem FROM e")
def encoded_scenarios(spark, sf):
    angle = F.col("name") == "wind_direction_deg"
    return encoded(spark, sf).withColumn(
        "value", F.when(angle, F.round("value", 9) + 0.0).otherwise(F.col("value"))
    )


@query(
    f"""
    {ENCODED_SQL} SELECT sample_id, string_agg(x.c, ',' ORDER BY x.o) AS names,
        string_agg(round(x.v * 1e4)::int::varchar, ',' ORDER BY x.o) AS features FROM e WHERE x.r = 'global' AND x.p IS NULL GROUP BY sample_id
    """
)
def global_features(spark, sf):
    vectors = sc.global_features(encoded(spark, sf).filter("problem is null"))
    whole = F.transform("features", lambda v: F.round(v.cast("double") * 1e4).cast("int").cast("string"))
    return vectors.select("sample_id", F.array_join("names", ",").alias("names"), F.array_join(whole, ",").alias("features"))


@query(
    f"""
    WITH c AS ({CELLS_SQL}), s AS (SELECT c_custkey::varchar AS sample_id, c_acctbal AS v FROM customer)
    SELECT sample_id, 'wind_speed_mps' AS channel, idx, v AS value, true AS valid FROM c JOIN s USING (sample_id)
    """
)
def broadcast_channels(spark, sf):
    per_sample = encoded(spark, sf).withColumn("sample_id", F.col("sample_id").cast("string"))
    return sc.broadcast_channels(per_sample, field_cells(spark, sf))


# -------------------------------------------------------------------- padding

PADDING = ts.plan_padding(GRID, divisor=(4, 4, 8))
PADDED_SQL = f"""
    WITH c AS ({CELLS_SQL}),
    g AS (SELECT s.sample_id, i AS idx, i // 192 - 1 AS z, i // 16 % 12 - 1 AS y, i % 16 AS x FROM (SELECT DISTINCT sample_id FROM c) s, (SELECT unnest(range(0, 12 * 12 * 16)) AS i)),
    p AS (SELECT g.*, z BETWEEN 0 AND 9 AND y BETWEEN 0 AND 9 AND x BETWEEN 0 AND 14 AS inside, (z * 10 + y) * 15 + x AS src FROM g)
"""


def channel_rows(spark, sf):
    return field_cells(spark, sf).select(
        "sample_id", "idx",
        F.inline(
            F.array(
                F.struct(F.lit("Ux").alias("channel"), F.col("custkey").cast("float").alias("value")),
                F.struct(F.lit("p").alias("channel"), F.col("wall").cast("float").alias("value")),
            )
        ),
    )


def samples_of(df):
    return df.select("sample_id").distinct()


@query(
    f"""
    {PADDED_SQL}, j AS (SELECT p.*, c.custkey, c.wall FROM p LEFT JOIN c ON c.sample_id = p.sample_id AND p.inside AND c.idx = p.src),
    u AS (SELECT sample_id, idx, inside, unnest([{{'c': 'Ux', 'v': custkey::double, 'f': -5.0}}, {{'c': 'p', 'v': wall, 'f': 0.25}}]) AS e FROM j)
    SELECT sample_id, e.c AS channel, idx, CASE WHEN inside THEN e.v ELSE e.f END AS value FROM u
    """
)
def padded_channels(spark, sf):
    rows = channel_rows(spark, sf)
    padded = ts.pad_channels(rows, samples_of(rows), PADDING, {"Ux": -5.0, "p": 0.25})
    return padded.withColumn("value", F.col("value").cast("double"))


@query(
    f"""
    {PADDED_SQL} SELECT p.sample_id, p.idx, coalesce(inside AND c.valid, false) AS fluid_mask, inside AS domain_mask, NOT inside AS padding_mask
    FROM p LEFT JOIN c ON c.sample_id = p.sample_id AND p.inside AND c.idx = p.src
    """
)
def padded_masks(spark, sf):
    cells = field_cells(spark, sf).select("sample_id", "idx", F.col("valid").alias("fluid_mask"), F.lit(True).alias("domain_mask"))
    return ts.pad_masks(cells, samples_of(cells), PADDING, ["fluid_mask", "domain_mask"])


@query(f"WITH c AS ({CELLS_SQL}) SELECT sample_id, 0::bigint AS overlap FROM c GROUP BY sample_id")
def padding_overlaps(spark, sf):
    return ts.padding_overlap(padded_masks(spark, sf))


# ---------------------------------------------------- statistics of documents

DOCUMENTS = [
    ("plain", 1, {"frozen": True, "channels": {"price": {"method": "zscore", "mean": 40000.0, "std": 20000.0}, "part": {"method": "identity"}}}),
    ("plain", 2, {"frozen": True, "channels": {"price": {"method": "zscore", "mean": 38000.0, "std": 23000.0}, "part": {"method": "minmax", "min": 0.0, "max": 50.0}}}),
    ("other", 7, {"frozen": True, "channels": {"price": {"method": "robust_zscore", "median": 36000.0, "scale": 25000.0}}}),
]
# Suppliers declare a document each: the latest of one, an old version, one that lacks a channel, unknown ones, two, or none.
DECLARED_SQL = """
    d AS (SELECT s_suppkey AS sample_id, (['plain', 'plain', 'other', 'plain', 'lost', NULL, 'plain', 'plain'])[s_suppkey % 8 + 1] AS document,
            CASE s_suppkey % 8 WHEN 1 THEN 1 WHEN 3 THEN 9 END AS version, s_suppkey % 8 AS k FROM supplier)
"""
DECLARED_STATS_SQL = f"""
    {DECLARED_SQL},
    w AS (SELECT *, CASE document WHEN 'plain' THEN coalesce(version, 2) WHEN 'other' THEN coalesce(version, 7) ELSE version END AS used, unnest(['price', 'part', 'tax']) AS channel FROM d),
    p AS (SELECT *, CASE WHEN k = 6 THEN 'several statistics documents are declared' WHEN document IS NULL THEN 'no statistics document is declared'
            WHEN document = 'lost' THEN 'unknown statistics document lost' WHEN used = 9 THEN 'plain has no version 9'
            WHEN channel = 'tax' OR (document = 'other' AND channel = 'part') THEN 'channel has no statistic' END AS problem FROM w)
"""


def declared_documents(spark, sf):
    key = F.col("s_suppkey")
    names = F.array(*[F.lit(n) for n in ("plain", "plain", "other", "plain", "lost", None, "plain", "plain")])
    one = table(spark, sf, "supplier").select(
        key.alias("sample_id"), F.get(names, (key % 8).cast("int")).alias("document"),
        F.when(key % 8 == 1, 1).when(key % 8 == 3, 9).alias("version"),
    )
    return one.unionByName(one.filter("sample_id % 8 = 6"))


@query(
    f"""
    WITH {DECLARED_STATS_SQL}
    SELECT sample_id, channel, document, used AS version, problem, CASE WHEN channel = 'tax' OR document = 'lost' OR used = 9 OR document IS NULL OR (document = 'other' AND channel = 'part') THEN NULL
      WHEN document = 'other' THEN 'robust_zscore' WHEN channel = 'price' THEN 'zscore' WHEN used = 2 THEN 'minmax' ELSE 'identity' END AS method FROM p
    """
)
def declared_statistics(spark, sf):
    """Which statistic each channel of each sample has, and what is wrong where it has none."""
    stats = norm.versioned_statistics(spark, DOCUMENTS)
    found = norm.declared_statistics(declared_documents(spark, sf), stats, ["price", "part", "tax"])
    return found.select("sample_id", "channel", "document", "version", "problem", "method")


@query(
    f"""
    WITH {DECLARED_STATS_SQL},
    l AS (SELECT l_suppkey AS sample_id, unnest([{{'c': 'price', 'v': l_extendedprice}}, {{'c': 'part', 'v': (l_partkey % 50)::double}}, {{'c': 'tax', 'v': l_tax}}]) AS e FROM lineitem),
    v AS (SELECT l.sample_id, e.c AS channel, CASE WHEN p.problem IS NOT NULL AND k <> 6 THEN NULL WHEN e.c = 'tax' THEN NULL WHEN document = 'other' THEN (e.v - 36000.0::double) / 25000.0::double
            WHEN e.c = 'price' AND used = 1 THEN (e.v - 40000.0::double) / 20000.0::double WHEN e.c = 'price' THEN (e.v - 38000.0::double) / 23000.0::double WHEN used = 1 THEN e.v ELSE e.v / 50.0::double END AS v
          FROM l JOIN p ON p.sample_id = l.sample_id AND p.channel = e.c)
    SELECT sample_id, channel, count(*) AS rows, count(v) AS with_value, round(sum(round(v::float::double * 1000)), 0) + 0.0::double AS checksum FROM v GROUP BY ALL
    """
)
def values_by_document(spark, sf):
    """Every sample's values by the document that it declares: no row multiplies, none is lost."""
    rows = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("sample_id"),
        F.inline(
            F.array(
                F.struct(F.lit("price").alias("channel"), F.col("l_extendedprice").alias("value")),
                F.struct(F.lit("part").alias("channel"), (F.col("l_partkey") % 50).cast("double").alias("value")),
                F.struct(F.lit("tax").alias("channel"), F.col("l_tax").alias("value")),
            )
        ),
    )
    stats = norm.versioned_statistics(spark, DOCUMENTS)
    own = norm.declared_statistics(declared_documents(spark, sf), stats, ["price", "part", "tax"]).drop("document", "version", "problem")
    done = norm.normalized_or_null(rows, own, ["sample_id", "channel"])
    return done.groupBy("sample_id", "channel").agg(
        F.count(F.lit(1)).alias("rows"), F.count("value").alias("with_value"),
        (F.sum(F.round(F.col("value").cast("double") * 1000)) + 0.0).alias("checksum"),
    )


# -------------------------------------------------------------------- tensors


@query(
    f"""
    WITH c AS ({CELLS_SQL}), u AS (SELECT sample_id, idx, unnest([{{'r': 'x', 'o': 0, 'c': 'p', 'v': wall}}, {{'r': 'y', 'o': 0, 'c': 'Ux', 'v': custkey::double}}]) AS e FROM c)
    SELECT sample_id, e.r AS role, e.o AS ordinal, e.c AS channel, '10x10x15' AS shape, string_agg((e.v * 4)::int::varchar, ',' ORDER BY idx) AS data
    FROM u GROUP BY ALL
    """
)
def sample_tensors(spark, sf):
    tensors = ts.build_tensors(channel_rows(spark, sf), (10, 10, 15), ["p"], ["Ux"])
    whole = F.transform("data", lambda v: (v * 4).cast("int").cast("string"))
    return tensors.withColumns(
        {"data": F.array_join(whole, ","), "shape": F.array_join(F.col("shape").cast("array<string>"), "x")}
    )


@query(
    f"""
    WITH c AS ({CELLS_SQL}), n AS (SELECT * FROM (VALUES (0::int, 0::int, 3::int), (1, 3, 6), (2, 6, 9), (3, 9, 10)) AS v(chunk, z0, z1)),
    u AS (SELECT sample_id, idx, unnest([{{'r': 'x', 'c': 'p', 'v': wall}}, {{'r': 'y', 'c': 'Ux', 'v': custkey::double}}]) AS e FROM c),
    g AS (SELECT sample_id, e.r AS r, (idx // 450)::int AS chunk, count(*) AS n, string_agg((e.v * 4)::int::varchar, ',' ORDER BY idx) AS data
          FROM u WHERE NOT (sample_id::int % 3 = 1 AND idx = 700 AND e.r = 'x') AND NOT (sample_id::int % 3 = 2 AND idx >= 1350 AND e.r = 'y') GROUP BY ALL),
    d AS (SELECT * FROM (SELECT DISTINCT sample_id FROM c), (VALUES ('x', 'p'), ('y', 'Ux')) AS k(r, channel), n)
    SELECT sample_id, r AS role, 0::int AS ordinal, channel, chunk, z0, z1, (z1 - z0) || 'x10x15' AS shape, CASE WHEN n = (z1 - z0) * 150 THEN data END AS data,
      CASE WHEN n IS NULL THEN 'chunk is absent' WHEN n <> (z1 - z0) * 150 THEN 'chunk is incomplete' END AS problem
    FROM d LEFT JOIN g USING (sample_id, r, chunk)
    """
)
def tensor_chunks(spark, sf):
    """Tensors in chunks of three layers; some samples lack a cell or the last layer."""
    rows = channel_rows(spark, sf)
    lacking = ((F.col("sample_id").cast("int") % 3 == 1) & (F.col("idx") == 700) & (F.col("channel") == "p")) | (
        (F.col("sample_id").cast("int") % 3 == 2) & (F.col("idx") >= 1350) & (F.col("channel") == "Ux")
    )
    chunks = ts.chunk_tensors(rows.where(~lacking), samples_of(rows), (10, 10, 15), ["p"], ["Ux"], layers=3)
    whole = F.transform("data", lambda v: (v * 4).cast("int").cast("string"))
    return chunks.withColumns(
        {"data": F.array_join(whole, ","), "shape": F.array_join(F.col("shape").cast("array<string>"), "x")}
    )


@query(
    f"""
    WITH s AS (SELECT DISTINCT sample_id FROM ({CELLS_SQL}))
    SELECT sample_id, 'x' AS role, '' AS channels, '0x10x10x15' AS shape, 0::bigint AS chunks FROM s
    UNION ALL SELECT sample_id, 'y', 'Ux,p', '2x10x10x15', 20::bigint FROM s
    """
)
def target_only_samples(spark, sf):
    """Samples of a contract of targets alone: an x of 0 channels beside all chunks of y."""
    rows = channel_rows(spark, sf)
    heads = ts.tensor_heads(samples_of(rows), (10, 10, 15), [], ["Ux", "p"])
    chunks = ts.chunk_tensors(rows, samples_of(rows), (10, 10, 15), [], ["Ux", "p"])
    made = chunks.where("problem is null").groupBy("sample_id", "role").agg(F.count(F.lit(1)).alias("chunks"))
    return heads.join(made, ["sample_id", "role"], "left").select(
        "sample_id", "role", F.array_join("channels", ",").alias("channels"),
        F.array_join(F.col("shape").cast("array<string>"), "x").alias("shape"), F.coalesce("chunks", F.lit(0)).alias("chunks"),
    )


@query(
    f"""
    WITH c AS ({CELLS_SQL}), u AS (SELECT sample_id, idx, unnest([{{'o': 0, 'c': 'valid', 'v': valid}}, {{'o': 1, 'c': 'wall_valid', 'v': wall_valid}}]) AS e FROM c)
    SELECT sample_id, 'mask' AS role, e.o AS ordinal, e.c AS channel, '1x10x10x15' AS shape, string_agg(e.v::int::varchar, '' ORDER BY idx) AS data FROM u GROUP BY ALL
    """
)
def mask_tensors(spark, sf):
    tensors = ts.build_mask_tensors(field_cells(spark, sf), (10, 10, 15), ["valid", "wall_valid"])
    bits = F.transform("data", lambda v: v.cast("int").cast("string"))
    return tensors.withColumns(
        {"data": F.array_join(bits, ""), "shape": F.array_join(F.col("shape").cast("array<string>"), "x")}
    )


@query(
    """
    SELECT vec_id AS sample_id, label, (i - 1)::bigint AS idx, embedding[i]::double AS value FROM embeddings, (SELECT unnest(range(1, 65)) AS i)
    """
)
def tensor_cells(spark, sf):
    tensors = table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("sample_id"), "label", F.col("embedding").alias("data"),
        F.array(F.lit(4), F.lit(4), F.lit(4)).alias("shape"),
    )
    return ts.to_cells(tensors).withColumn("value", F.col("value").cast("double"))


INVERSE_GRID_PAD = ts.Padding((3, 2, 3), (4, 2, 4), (0, 0, 1))
INVERSE_STATS = [
    ("Ux", "zscore", 1.5, 3.0, None, None, None, None, None, None, None),
    ("p", "minmax", None, None, None, None, -2.0, 2.0, 0.0, 1.0, None),
]


@query(
    """
    WITH c AS (SELECT vec_id AS sample_id, k, z, y, x, embedding[((k * 4 + z) * 2 + y) * 4 + x + 1 + 1]::double AS v FROM embeddings,
       (SELECT unnest(range(0, 2)) AS k), (SELECT unnest(range(0, 3)) AS z), (SELECT unnest(range(0, 2)) AS y), (SELECT unnest(range(0, 3)) AS x))
    SELECT sample_id, CASE k WHEN 0 THEN 'Ux' ELSE 'p' END AS channel, (z * 2 + y) * 3 + x AS idx,
           round((CASE k WHEN 0 THEN v * 3.0::double + 1.5::double ELSE -2.0::double + v * 4.0::double END)::float::double, 5) AS value FROM c
    """
)
def inverse_predictions(spark, sf):
    predictions = table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("sample_id"), F.col("embedding").alias("data"),
        F.when(F.col("label") % 2 == 0, F.array(*[F.lit(v) for v in (2, 4, 2, 4)]))
        .otherwise(F.array(*[F.lit(v) for v in (1, 2, 4, 2, 4)]))
        .alias("shape"),
    )
    out = ts.inverse_prediction(predictions, INVERSE_GRID_PAD, norm.stat_table(spark, INVERSE_STATS), ["Ux", "p"])
    return out.withColumn("value", F.round(F.col("value").cast("double"), 5))


@query("SELECT doc_id, sha256(text) AS sha256 FROM documents")
def text_hashes(spark, sf):
    return table(spark, sf, "documents").select("doc_id", ts.content_hash(F.col("text")).alias("sha256"))


# The 32 bits of a float, from its exponent and fraction.
BITS_SQL = """(CASE WHEN isnan(v) THEN 2143289344 WHEN isinf(v) THEN 2139095040 WHEN abs(v) < pow(2.0, -126) THEN abs(v) * pow(2.0, 149)
    ELSE (floor(log2(abs(v)) - 1e-9) + 126) * 8388608 + abs(v) / pow(2.0, floor(log2(abs(v)) - 1e-9)) * 8388608 END)::bigint
    + CASE WHEN v < 0 OR v::varchar = '-0.0' THEN 2147483648 ELSE 0 END"""
FLOATS_SQL = f"""
    WITH c AS ({CELLS_SQL}), u AS (SELECT sample_id, idx, iz, unnest([{{'c': 0, 'v': wall::float::double}}, {{'c': 1, 'v': custkey::float::double}}, {{'c': 2, 'v': (value - 1e5)::float::double}}]) AS e FROM c),
    w AS (SELECT sample_id, idx, iz, e.c AS c, e.v AS v FROM u),
    f AS (SELECT sample_id, idx, iz, c, {BITS_SQL} AS b FROM w)
"""


def float_channels(spark, sf):
    names = {"wall": F.col("wall"), "custkey": F.col("custkey"), "value": F.col("value") - 1e5}
    pairs = [F.struct(F.lit(c).alias("channel"), v.cast("float").alias("value")) for c, v in names.items()]
    return field_cells(spark, sf).select("sample_id", "idx", F.inline(F.array(*pairs)))


@query(
    f"""
    {FLOATS_SQL},
    h AS (SELECT sample_id, c, '666C6F61743332' || '01000000000000000A000000000000000A000000000000000F00000000000000' ||
            string_agg(printf('%02X%02X%02X%02X', b & 255, b >> 8 & 255, b >> 16 & 255, b >> 24), '' ORDER BY idx) AS hex FROM f WHERE c < 2 GROUP BY ALL)
    SELECT sample_id, max(sha256(unhex(hex))) FILTER (c = 0) AS x_sha256, max(sha256(unhex(hex))) FILTER (c = 1) AS y_sha256 FROM h GROUP BY sample_id
    """
)
def tensor_hashes(spark, sf):
    """Hashes over type, shape and the bytes of whole arrays."""
    return ts.tensor_hashes(ts.build_tensors(channel_rows(spark, sf), (10, 10, 15), ["p"], ["Ux"]))


@query(
    f"""
    {FLOATS_SQL},
    l AS (SELECT sample_id, c, iz, sha256(unhex(string_agg(printf('%08X', b), '' ORDER BY idx))) AS d FROM f GROUP BY ALL),
    r AS (SELECT sample_id, unnest([{{'r': 'x', 'o': (2 - c)::int}}, {{'r': CASE WHEN c = 1 THEN 'y' END, 'o': 0}}]) AS e, iz, d FROM l),
    t AS (SELECT sample_id, e.r AS r, sha256('float32' || chr(10) || count(DISTINCT e.o) || 'x10x10x15' || chr(10) || string_agg(d, chr(10) ORDER BY e.o, iz)) AS d
          FROM r WHERE e.r IS NOT NULL GROUP BY ALL)
    SELECT sample_id, max(d) FILTER (r = 'x') AS x_digest, max(d) FILTER (r = 'y') AS y_digest FROM t GROUP BY sample_id
    """
)
def content_digests(spark, sf):
    """Digests in two levels; no row holds more than one channel."""
    return ts.content_digests(ts.build_tensors(float_channels(spark, sf), (10, 10, 15), ["value", "custkey", "wall"], ["custkey"]))


@query(
    f"""
    WITH c AS ({CELLS_SQL}) SELECT sample_id, 'p:2.0:T:' || round(avg(valid_u::int), 6) AS p, 'U:0.0:I:' || round(avg(valid::int), 6) AS ux,
      '15,10,10' AS dims, '1,1,0' AS before, '1,1,1' AS after, 'Ux' AS x, 'p' AS y, round(avg(valid::int), 6) AS fluid, 64::int AS hash_length FROM c GROUP BY sample_id
    """
)
def sample_provenance(spark, sf):
    cells = field_cells(spark, sf)
    long = cells.select(
        "sample_id", "idx",
        F.inline(
            F.array(
                F.struct(F.lit("Ux").alias("channel"), F.col("valid").alias("valid")),
                F.struct(F.lit("p").alias("channel"), F.col("valid_u").alias("valid")),
            )
        ),
    )
    facts = spark.createDataFrame(
        [("Ux", "U", "I", 0.0), ("p", "p", "T", 2.0)], "channel string, source_field string, role string, fill_value double"
    )
    fractions = cells.groupBy("sample_id").agg(F.avg(F.col("valid").cast("int")).alias("fluid_mask"))
    doc = ts.document_hash({"version": 1})
    out = ts.provenance(
        samples_of(cells), GRID, PADDING, ["Ux"], ["p"], doc, doc,
        {"fields": ts.channel_provenance(long, facts), "fractions": fractions},
    )

    def fact(channel):
        entry = F.col("fields.resampling")[channel]
        return F.concat_ws(
            ":", entry["source_field"], entry["fill_value"].cast("string"), entry["role"],
            F.round(entry["valid_fraction"], 6).cast("string"),
        )

    def text(c):
        return F.array_join(F.col(c).cast("array<string>"), ",")

    return out.select(
        "sample_id", fact("p").alias("p"), fact("Ux").alias("ux"), text("grid.dimensions_xyz").alias("dims"),
        text("padding.pad_before_zyx").alias("before"), text("padding.pad_after_zyx").alias("after"),
        text("channel_order.x").alias("x"), text("channel_order.y").alias("y"),
        F.round("fractions.fluid_mask", 6).alias("fluid"), F.length("contract_sha256").alias("hash_length"),
    )


# ------------------------------------------------------------------ contracts


@query(
    """
    WITH l AS (SELECT l_orderkey AS contract_id, 'c' || l_linenumber AS channel, l_partkey % 3 AS origin, (['INPUT', 'TARGET', 'AUXILIARY'])[l_suppkey % 3 + 1] AS role,
       l_quantity > 5 AS required, CASE WHEN l_quantity > 25 THEN 'broadcast' WHEN l_quantity > 3 THEN 'global' ELSE 'other' END AS rep, l_discount > 0.02 AS has_producer, l_tax
       FROM lineitem),
    f AS (SELECT contract_id, channel, count(*) AS declared, count(*) FILTER (origin <> 2 OR rep = 'broadcast') AS spatial, count(*) FILTER (origin = 2 AND rep = 'global') AS gl,
       count(*) FILTER (origin = 0 AND role = 'TARGET') AS tf, count(*) FILTER (origin = 0 AND role <> 'TARGET') AS nf, count(*) FILTER (origin = 0 AND NOT required) AS opt,
       count(*) FILTER (origin = 1 AND NOT has_producer) AS nop, count(*) FILTER (origin = 2 AND rep = 'other') AS bad FROM l GROUP BY ALL),
    m AS (SELECT contract_id, channel, count(*) FILTER (l_tax < 0.04) AS i, count(*) FILTER (l_tax > 0.06) AS t FROM l GROUP BY ALL),
    s AS (SELECT DISTINCT contract_id, channel FROM l WHERE l_tax <> 0.01),
    j AS (SELECT f.*, coalesce(i, 0) AS i, coalesce(t, 0) AS t, s.channel IS NOT NULL AS has_stat FROM f LEFT JOIN m USING (contract_id, channel) LEFT JOIN s USING (contract_id, channel)),
    r AS (SELECT contract_id, channel, unnest([CASE WHEN i > 1 THEN 'duplicate input channel' END, CASE WHEN t > 1 THEN 'duplicate target channel' END,
       CASE WHEN i > 0 AND t > 0 THEN 'channel is input and target' END, CASE WHEN declared > 1 THEN 'channel is declared twice' END,
       CASE WHEN opt > 0 AND i + t > 0 THEN 'optional field feeds the model' END, CASE WHEN nop > 0 THEN 'derived channel has no producer' END,
       CASE WHEN bad > 0 THEN 'unknown representation' END, CASE WHEN i + t > 0 AND spatial = 0 THEN 'model channel has no producer' END,
       CASE WHEN tf > 0 AND i > 0 THEN 'target field is an input' END, CASE WHEN nf > 0 AND t > 0 THEN 'field-backed target needs role TARGET' END,
       CASE WHEN tf > 0 AND t = 0 THEN 'target field is not a target' END, CASE WHEN gl > 0 AND i + t > 0 THEN 'global channel is spatial' END,
       CASE WHEN (i + t > 0 OR gl > 0) AND NOT has_stat THEN 'channel has no statistic' END]) AS rule FROM j)
    SELECT contract_id, rule, channel FROM r WHERE rule IS NOT NULL
    """
)
def contract_violations(spark, sf):
    q = F.col("l_quantity")

    def pick(options, key):
        return F.get(F.array(*[F.lit(o) for o in options]), (F.col(key) % 3).cast("int"))

    rows = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("contract_id"),
        F.concat(F.lit("c"), F.col("l_linenumber").cast("string")).alias("channel"),
        pick(["field", "derived", "scenario"], "l_partkey").alias("origin"),
        pick(["INPUT", "TARGET", "AUXILIARY"], "l_suppkey").alias("role"),
        (q > 5).alias("required"),
        F.when(q > 25, F.lit("broadcast")).when(q > 3, F.lit("global")).otherwise(F.lit("other")).alias("representation"),
        (F.col("l_discount") > 0.02).alias("has_producer"),
        "l_tax",
    )
    model = rows.filter("l_tax < 0.04").withColumn("list", F.lit("input")).unionByName(
        rows.filter("l_tax > 0.06").withColumn("list", F.lit("target"))
    )
    return contract.check_contract(
        rows.drop("l_tax"), model.select("contract_id", "list", "channel"), rows.filter("l_tax <> 0.01").select("contract_id", "channel")
    )


SPEC_SQL = """
    SELECT p_partkey, p_name AS source_name, (['vector', ' Categorical', 'continuous_scalar', 'odd'])[p_partkey % 4 + 1] AS raw_kind, p_size,
       CASE WHEN p_size % 5 = 0 THEN p_size % 4 END AS given_n, CASE WHEN p_size % 3 = 0 THEN 'linear' END AS given_i FROM part
"""


def field_specs(spark, sf):
    size = F.col("p_size")
    kind = F.get(
        F.array(*[F.lit(k) for k in ("vector", " Categorical", "continuous_scalar", "odd")]), (F.col("p_partkey") % 4).cast("int")
    )
    none = F.lit(None)
    return table(spark, sf, "part").select(
        "p_partkey", F.col("p_name").alias("source_name"),
        F.when(F.col("p_partkey") % 4 == 0, F.array(F.lit("a"), F.lit("b"), F.when(size > 40, F.lit("a")).otherwise(F.lit("c"))))
        .otherwise(F.array(F.lit("a")))
        .alias("output_channels"),
        kind.alias("kind"), F.lit("input").alias("role"), none.cast("boolean").alias("required"),
        F.when(size % 5 == 0, (size % 4).cast("int")).alias("expected_components"), none.cast("string").alias("association"),
        F.when(size % 3 == 0, F.lit("linear")).alias("interpolation"), none.cast("string").alias("extrapolation"),
        none.cast("double").alias("fill"), none.cast("double").alias("scale"),
        F.when(size == 7, F.lit(2.0)).alias("offset"), none.cast("boolean").alias("rotate"),
        none.cast("boolean").alias("volumetric"), F.when(size == 9, F.lit(1.5)).alias("min_valid"),
    )


@query(
    f"""
    WITH s AS ({SPEC_SQL}), d AS (SELECT *, lower(trim(raw_kind)) AS kind FROM s)
    SELECT p_partkey, source_name, kind, 'INPUT' AS role, true AS required, coalesce(given_n, CASE WHEN kind = 'vector' THEN 3 ELSE 1 END) AS expected_components,
           coalesce(given_i, CASE WHEN kind = 'categorical' THEN 'nearest' ELSE 'linear' END) AS interpolation, 'MARK_INVALID' AS extrapolation,
           0.0::double AS fill, 1.0::double AS scale, CASE WHEN p_size = 7 THEN 2.0 ELSE 0.0 END::double AS "offset", kind = 'vector' AS rotate, true AS volumetric,
           CASE WHEN p_size = 9 THEN 1.5 ELSE 0.0 END::double AS min_valid FROM d
    """
)
def spec_defaults(spark, sf):
    return contract.with_defaults(field_specs(spark, sf)).drop("output_channels", "association")


@query(
    f"""
    WITH s AS ({SPEC_SQL}), d AS (SELECT *, lower(trim(raw_kind)) AS kind FROM s),
    e AS (SELECT *, coalesce(given_n, CASE WHEN kind = 'vector' THEN 3 ELSE 1 END) AS n, CASE WHEN kind = 'vector' THEN 3 ELSE 1 END AS c,
            coalesce(given_i, CASE WHEN kind = 'categorical' THEN 'nearest' ELSE 'linear' END) AS i FROM d),
    p AS (SELECT p_partkey, source_name, unnest([CASE WHEN kind = 'vector' AND p_size > 40 THEN 'duplicate output channels' END, CASE WHEN kind = 'odd' THEN 'unsupported kind' END,
       CASE WHEN n <= 0 THEN 'expected_components must be positive' END, CASE WHEN kind = 'vector' AND n <> 3 THEN 'a vector has three components' END,
       CASE WHEN n <> c THEN 'component count differs from the channels' END, CASE WHEN kind = 'categorical' AND i <> 'nearest' THEN 'a discrete field needs nearest interpolation' END,
       CASE WHEN p_size = 9 THEN 'min_valid is outside 0..1' END, CASE WHEN kind = 'vector' AND p_size = 7 THEN 'a vector has no offset' END]) AS problem FROM e)
    SELECT * FROM p WHERE problem IS NOT NULL
    """
)
def spec_problems(spark, sf):
    return contract.spec_problems(contract.with_defaults(field_specs(spark, sf)), ["p_partkey"])


@query(
    """
    WITH g AS (SELECT l_orderkey, list_sort(list(DISTINCT l_linenumber)) FILTER (l_returnflag = 'A') AS a, list_sort(list(DISTINCT l_linenumber)) FILTER (l_returnflag <> 'A') AS b FROM lineitem GROUP BY ALL),
    h AS (SELECT l_orderkey, coalesce(list_sort(list(DISTINCT CASE WHEN l_returnflag = 'A' THEN l_linenumber END)), []) AS a,
                 coalesce(list_sort(list(DISTINCT CASE WHEN l_returnflag <> 'A' THEN l_linenumber END)), []) AS b FROM lineitem GROUP BY ALL)
    SELECT l_orderkey, array_to_string(list_filter(a, lambda v: v IS NOT NULL AND NOT list_contains(b, v)), ',') AS only_inputs,
           array_to_string(list_filter(a, lambda v: list_contains(b, v)), ',') AS both_lists,
           array_to_string(list_concat(list_filter(a, lambda v: v IS NOT NULL), list_filter(b, lambda v: v IS NOT NULL AND NOT list_contains(a, v))), ',') AS merged FROM h
    """
)
def channel_lists(spark, sf):
    flag, line = F.col("l_returnflag") == "A", F.col("l_linenumber").cast("string")
    lists = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.sort_array(F.collect_set(F.when(flag, line))).alias("a"), F.sort_array(F.collect_set(F.when(~flag, line))).alias("b")
    )
    a, b = F.col("a"), F.col("b")
    return lists.select(
        "l_orderkey",
        F.array_join(contract.list_difference(a, b), ",").alias("only_inputs"),
        F.array_join(contract.list_overlap(a, b), ",").alias("both_lists"),
        F.array_join(contract.merge_lists(a, b), ",").alias("merged"),
    )


# ------------------------------------------------------------- the whole job

CONTRACT = {
    "source_assembly": {"conflict_policy": "REGION_PRIORITY"},
    "coordinate_map": {"length_scale": 1.0},
    "grid": {
        "physical_grid": {
            "cell_center_origin_xyz": list(TARGET.origin), "spacing_xyz": list(TARGET.spacing), "dimensions_xyz": list(TARGET.dims),
        },
        "model_grid": {"divisibility_zyx": [4, 4, 8], "padding_alignment": "symmetric"},
    },
    "fields": [
        {"source_name": "p", "output_channels": ["p"], "role": "INPUT", "kind": "continuous_scalar"},
        {"source_name": "k", "output_channels": ["k"], "role": "TARGET", "kind": "categorical", "fill_value_physical": 7.0},
    ],
    "derived_features": {
        "fluid_reference_channel": "p", "derive_signed_distance": False,
        "output_channels": ["loss_mask"], "mask_channel_map": {"loss_mask": "loss_mask"},
    },
    "scenario_parameters": [],
    "input_channels": ["p"],
    "target_channels": ["k"],
    "padding": {"channel_pad_values_physical": {"p": 100.0, "k": 0.0}},
}
STATISTICS = {
    "frozen": True,
    "channels": {"p": {"method": "zscore", "mean": 700.0, "std": 400.0}, "k": {"method": "identity"}},
}


RESAMPLED_SQL = f"""
    {MESH_SQL}, {HITS_SQL},
    best AS (SELECT sample_id, idx, min(cell_id) AS cell_id FROM hits GROUP BY ALL),
    b AS (SELECT h.*, (0.75 + gx * 2.0 - xlo) / 3.0 AS tx, (0.5 + gy * 1.5 - ylo) / 2.0 AS ty, (0.25 + gz * 2.0 - zlo) / 2.5 AS tz
          FROM hits h JOIN best USING (sample_id, idx, cell_id)),
    c AS (SELECT *, unnest(range(0, 8)) AS c FROM b),
    k AS (SELECT c.*, pts.v AS pv FROM c JOIN pts ON pts.sample_id = c.sample_id
            AND pts.point_id = ((cz + c.c // 4) * 11 + cy + c.c // 2 % 2) * 16 + cx + c.c % 2),
    p AS (SELECT sample_id, idx, sum(pv * (CASE WHEN c % 2 = 1 THEN tx ELSE 1 - tx END) * (CASE WHEN c // 2 % 2 = 1 THEN ty ELSE 1 - ty END)
           * (CASE WHEN c // 4 = 1 THEN tz ELSE 1 - tz END)) AS v FROM k GROUP BY sample_id, idx),
    n AS (SELECT sample_id, idx, arg_min(v % 5, cell_id) AS v FROM hits GROUP BY ALL),
    size AS (SELECT 16 * 16 * 24 AS total, 23 * 14 * 13 AS cells),
"""


@query(
    f"""
    {RESAMPLED_SQL}
    x AS (SELECT sample_id, sum((v - 700.0) / 400.0) + (total - cells) * (100.0 - 700.0) / 400.0 AS s, count(*) AS valid FROM p, size GROUP BY sample_id, total, cells),
    y AS (SELECT sample_id, sum(v) + (cells - count(*)) * 7.0 AS s FROM n, size GROUP BY sample_id, cells)
    SELECT x.sample_id, 6144::int AS values, round(x.s, 1) AS x_sum, round(y.s, 1) AS y_sum, valid AS loss_cells FROM x JOIN y USING (sample_id)
    """
)
def transformed_samples(spark, sf):
    """Resample, mask, normalise, pad and assemble every sample of the meshes."""
    made = transform(spark, mesh_tables(spark, sf), CONTRACT, STATISTICS)
    loss = made.mask_tensors.select("sample_id", F.size(F.filter("data", lambda v: v)).cast("bigint").alias("loss_cells"))
    return tensor_sums(made).join(loss, "sample_id")


def tensor_sums(made):
    total = F.aggregate("data", F.lit(0.0), lambda a, v: a + v.cast("double"))
    return made.tensors.groupBy("sample_id").agg(
        F.max(F.size("data")).alias("values"),
        F.round(F.max(F.when(F.col("role") == "x", total)), 1).alias("x_sum"),
        F.round(F.max(F.when(F.col("role") == "y", total)), 1).alias("y_sum"),
    )


def mesh_tables(spark, sf):
    """Source tables of the box meshes with a linear field p and a discrete field k."""
    cells, points, values = mesh(spark, sf)
    stored = values.select(
        "sample_id", "block_id", F.col("cell_id").alias("entity_id"), F.lit("CELL").alias("association"),
        F.inline(
            F.array(
                F.struct(F.lit("p").alias("field"), F.array("v0").alias("values")),
                F.struct(F.lit("k").alias("field"), F.array(F.col("v0") % 5).alias("values")),
            )
        ),
    )
    blocks = cells.select("sample_id", "block_id").distinct().select(
        "*", F.lit(0).alias("priority"), F.lit(True).alias("is_volumetric")
    )
    return {"source_block": blocks, "source_cell": cells, "source_point": points, "source_value": stored}


TWO_DOCUMENTS = {
    ("base", 1): {"frozen": True, "channels": {"p": {"method": "zscore", "mean": 1.0, "std": 1.0}, "k": {"method": "identity"}}},
    ("base", 2): STATISTICS,
    ("wide", 1): {"frozen": True, "channels": {"p": {"method": "zscore", "mean": 600.0, "std": 500.0}, "k": {"method": "identity"}}},
}
SPEED = {"name": "speed", "type": "scalar", "representation": "global", "output_channels": ["speed"]}


@query(
    f"""
    {RESAMPLED_SQL}
    s AS (SELECT DISTINCT sample_id, sample_id::int % 6 AS k FROM hits),
    x AS (SELECT sample_id, sum((v - m) / d) + (total - cells) * (100.0 - m) / d AS s
          FROM (SELECT p.*, CASE WHEN k = 5 THEN 600.0::double ELSE 700.0::double END AS m, CASE WHEN k = 5 THEN 500.0::double ELSE 400.0::double END AS d FROM p JOIN s USING (sample_id)), size
          GROUP BY sample_id, total, cells, m, d),
    y AS (SELECT sample_id, sum(v) + (cells - count(*)) * 7.0 AS s FROM n, size GROUP BY sample_id, cells)
    SELECT s.sample_id, CASE WHEN k IN (0, 5) THEN 'ok' ELSE 'failed' END AS status,
      CASE k WHEN 1 THEN 'k: required field is absent' WHEN 2 THEN 'speed: scenario lacks speed' WHEN 3 THEN 'speed: unusable value of speed: fast'
        WHEN 4 THEN 'k: unknown statistics document lost; p: unknown statistics document lost' ELSE '' END
        || CASE WHEN k = 4 THEN '; speed: unknown statistics document lost' ELSE '' END AS message,
      CASE WHEN k IN (0, 5) THEN 6144::int END AS values, CASE WHEN k IN (0, 5) THEN round(x.s, 1) END AS x_sum, CASE WHEN k IN (0, 5) THEN round(y.s, 1) END AS y_sum
    FROM s LEFT JOIN x USING (sample_id) LEFT JOIN y USING (sample_id)
    """
)
def sample_outcomes(spark, sf):
    """Good and bad samples in one job: each says what is wrong with it, and the good ones are made."""
    tables = mesh_tables(spark, sf)
    kind = F.col("sample_id").cast("int") % 6
    tables["source_value"] = tables["source_value"].filter(~((kind == 1) & (F.col("field") == "k")))
    samples = tables["source_block"].select("sample_id").distinct()
    given = F.when(kind == 3, F.create_map(F.lit("speed"), F.lit("fast"))).otherwise(F.create_map(F.lit("speed"), F.lit("3.5")))
    scenarios = samples.filter(kind != 2).select("sample_id", given.alias("params"))
    document = F.when(kind == 4, F.lit("lost")).when(kind == 5, F.lit("wide")).otherwise(F.lit("base"))
    declared = samples.select("sample_id", document.alias("document"), F.lit(None).cast("int").alias("version"))
    stats = {k: {**d, "channels": {**d["channels"], "speed": {"method": "identity"}}} for k, d in TWO_DOCUMENTS.items()}
    made = transform(spark, tables, {**CONTRACT, "scenario_parameters": [SPEED]}, stats, scenarios, declared=declared)
    return made.outcomes.join(tensor_sums(made), "sample_id", "left")


@query(
    """
    WITH i AS (SELECT o_orderkey::varchar AS case_id, CASE o_orderstatus WHEN 'F' THEN 'failed' ELSE 'ok' END AS s, CASE o_orderstatus WHEN 'F' THEN o_orderpriority ELSE '' END AS m FROM orders WHERE o_orderkey % 7 <> 0),
    o AS (SELECT o_orderkey::varchar AS case_id, CASE WHEN o_custkey % 4 = 0 THEN 'failed' ELSE 'ok' END AS s, CASE WHEN o_custkey % 8 = 0 THEN NULL ELSE o_orderstatus END AS m FROM orders WHERE o_orderkey % 5 <> 0),
    b AS (SELECT case_id, i.s AS si, i.m AS mi, o.s AS so, o.m AS mo FROM i FULL JOIN o USING (case_id)),
    e AS (SELECT *, nullif(concat_ws('; ', CASE WHEN si IS NULL THEN 'input has no sample' WHEN si <> 'ok' THEN 'input: ' || coalesce(mi, '') END,
            CASE WHEN so IS NULL THEN 'output has no sample' WHEN so <> 'ok' THEN 'output: ' || coalesce(mo, '') END), '') AS error FROM b)
    SELECT o_orderkey AS row_number, o_orderkey::varchar AS case_id, CASE WHEN o_orderkey % 11 = 0 THEN 'discovery_failed' WHEN e.case_id IS NULL OR error IS NOT NULL THEN 'transform_failed' ELSE 'ok' END AS status,
      CASE WHEN o_orderkey % 11 = 0 THEN 'no files' WHEN e.case_id IS NULL THEN 'no outcome of the transform' WHEN error IS NOT NULL THEN error
        ELSE 'input=' || si || ': ' || coalesce(mi, '') || '; output=' || so || ': ' || coalesce(mo, '') END AS message
    FROM orders LEFT JOIN e ON e.case_id = o_orderkey::varchar
    """
)
def manifest_of_outcomes(spark, sf):
    """Outcomes of both transforms and failures of discovery in one manifest; a pair that nothing came of is in it too."""
    orders = table(spark, sf, "orders")
    case, key = F.col("o_orderkey").cast("string").alias("sample_id"), F.col("o_orderkey")
    failed = F.col("o_orderstatus") == "F"
    inputs = orders.filter(key % 7 != 0).select(
        case, F.when(failed, "failed").otherwise("ok").alias("status"), F.when(failed, F.col("o_orderpriority")).otherwise("").alias("message")
    )
    outputs = orders.filter(key % 5 != 0).select(
        case, F.when(F.col("o_custkey") % 4 == 0, "failed").otherwise("ok").alias("status"),
        F.when(F.col("o_custkey") % 8 != 0, F.col("o_orderstatus")).alias("message"),
    )
    pairs = orders.select(
        key.cast("string").alias("case_id"), key.alias("row_number"), F.lit("in").alias("input_vtu"), F.lit("out").alias("output_vtu"),
        F.when(key % 11 == 0, F.lit("no files")).alias("problem"),
    )
    made = manifest.build_manifest(pairs, manifest.pair_outcomes(inputs, outputs), "/in", "/out")
    return made.select("row_number", "case_id", "status", "message")
