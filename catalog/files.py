"""Round trips through files in the shared folder, on data of the given tables."""

from pyspark.sql import Window, functions as F

from catalog import query, table
from catalog.reports import RESULTS_SQL, results
from catalog.samples import channel_rows
from catalog.workspace import MANIFEST_SQL, manifest_table
from gridloom.operators import doe
from gridloom.operators import tensor as ts
from gridloom.session import scratch_path
from gridloom.sources import batch_csv, stage_csv, workspace
from gridloom.sources.lines import read_lines

BATCH_SQL = """
    WITH o AS (SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus, row_number() OVER (ORDER BY o_orderkey) - 1 AS i FROM orders)
    SELECT (i // 1500)::varchar AS batch_id, i % 1500 + 2 AS row_number, o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM o
"""


@query(
    f"""
    WITH b AS ({BATCH_SQL})
    SELECT batch_id, row_number, o_orderkey::varchar AS raw_case, o_totalprice::varchar AS raw_ws, o_custkey::varchar AS raw_wd FROM b
    """
)
def batch_files(spark, sf):
    """Write the orders as batches of 1,500 rows and read them in the simple dialect."""
    frame = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("met__WD_deg"), F.col("o_orderkey").alias("Case"), F.col("o_totalprice").alias(" WS ")
    )
    path = scratch_path(spark, "batches")
    batch_csv.write_batches(frame, "Case", path, 1500)
    rows = batch_csv.read_batch_csv(spark, f"{path}/batch_id=*/*.csv")
    named = batch_csv.case_columns(rows)
    return named.select(
        F.regexp_extract("path", r"batch_id=(\d+)", 1).alias("batch_id"), "row_number", "raw_case", "raw_ws", "raw_wd"
    )


@query(
    f"""
    WITH b AS ({BATCH_SQL})
    SELECT batch_id, row_number, o_orderkey::varchar AS raw_case, 'status "' || o_orderstatus || '", ' || o_custkey AS note FROM b
    """
)
def quoted_batch_files(spark, sf):
    """The quoted dialect keeps commas and quotes inside a cell."""
    frame = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("Case"),
        F.concat(F.lit('status "'), "o_orderstatus", F.lit('", '), F.col("o_custkey").cast("string")).alias("note"),
    )
    path = scratch_path(spark, "quoted")
    (
        doe.batch_of(frame, "Case", 1500)
        .repartition("batch_id")
        .sortWithinPartitions("batch_id", "Case")
        .write.option("header", True)
        .option("escape", '"')
        .partitionBy("batch_id")
        .csv(path)
    )
    rows = batch_csv.read_batch_csv(spark, f"{path}/batch_id=*/*.csv", dialect="rfc")
    return rows.select(
        F.regexp_extract("path", r"batch_id=(\d+)", 1).alias("batch_id"),
        "row_number",
        batch_csv.cell("header", "cells", "case").alias("raw_case"),
        batch_csv.cell("header", "cells", "NOTE").alias("note"),
    )


@query(
    f"""
    WITH b AS ({BATCH_SQL})
    SELECT batch_id, row_number, o_orderkey::varchar AS raw_case,
           CASE o_custkey % 3 WHEN 0 THEN '"' WHEN 1 THEN 'a,' || chr(10) || chr(10) || '"b" ' || o_custkey ELSE o_orderstatus || chr(10) || '",' END AS note FROM b
    """
)
def quoted_line_ends(spark, sf):
    """Line ends, commas and quotes inside cells of the header and of the rows; lines are read by split."""
    key = F.col("o_custkey")
    note = F.when(key % 3 == 0, F.lit('"')).when(key % 3 == 1, F.concat(F.lit('a,\n\n"b" '), key.cast("string")))
    frame = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("Case"), note.otherwise(F.concat("o_orderstatus", F.lit('\n",'))).alias("note")
    )
    path = scratch_path(spark, "line-ends")
    parts = doe.batch_of(frame, "Case", 1500).repartition("batch_id").sortWithinPartitions("batch_id", "Case")
    field = lambda c: stage_csv.quote_field(F.col(c).cast("string"))
    # The first row of a batch carries the header, a cell of which holds a line end.
    head = F.when(F.col("Case") == F.min("Case").over(Window.partitionBy("batch_id")), F.lit('"Case","first\nline, ""note"""\n'))
    lines = parts.select("batch_id", "Case", F.concat(F.coalesce(head, F.lit("")), field("Case"), F.lit(","), field("note")).alias("line"))
    lines.sortWithinPartitions("batch_id", "Case").select("batch_id", "line").write.partitionBy("batch_id").text(path)
    rows = batch_csv.read_batch_csv(spark, f"{path}/batch_id=*/*.txt", dialect="rfc")
    return rows.select(
        F.regexp_extract("path", r"batch_id=(\d+)", 1).alias("batch_id"),
        "row_number",
        batch_csv.cell("header", "cells", "case").alias("raw_case"),
        batch_csv.cell("header", "cells", 'first\nline, "note"').alias("note"),
    )


@query("SELECT o_orderkey::varchar AS case_id, lower(c) AS parameter, v AS value FROM (SELECT o_orderkey, unnest([{'c': 'Case', 'v': o_orderkey::varchar}, {'c': 'Priority', 'v': split_part(o_orderpriority, '-', 1)}], recursive := true) FROM orders)")
def long_parameters(spark, sf):
    frame = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("Case"), F.split("o_orderpriority", "-")[0].alias("Priority")
    )
    path = scratch_path(spark, "long")
    batch_csv.write_csv(frame, path)
    rows = batch_csv.read_batch_csv(spark, f"{path}/*.csv")
    keyed = rows.withColumn("case_id", batch_csv.cell("header", "cells", "Case"))
    return batch_csv.long_params(keyed).select("case_id", F.lower("parameter").alias("parameter"), "value")


@query(
    f"""
    WITH r AS ({RESULTS_SQL})
    SELECT batch_id, stage, CASE WHEN stage IN ('post-processing') THEN NULL ELSE row_number END AS row_number, CASE WHEN case_id = '' THEN NULL ELSE case_id END AS case_id,
           status, 'a "q", ' || chr(10) || message AS message,
           CASE stage WHEN 'transport' THEN event_id || '|x' WHEN 'post-processing' THEN NULL ELSE event_id::varchar END AS case_name FROM r
    """
)
def stage_summaries(spark, sf):
    """All five layouts with quotes, commas and newlines inside the message."""
    found = results(spark, sf).withColumns(
        {
            "message": F.concat(F.lit('a "q", \n'), F.col("message")),
            "case_name": F.when(F.col("stage") == "transport", F.concat(F.col("event_id").cast("string"), F.lit("|x"))).otherwise(
                F.col("event_id").cast("string")
            ),
        }
    )
    root = scratch_path(spark, "stages")
    for stage, name in stage_csv.STAGE_FILES.items():
        of_stage = found.filter(F.col("stage") == stage).repartition(2)
        stage_csv.write_stage_results(of_stage.withColumn("csv_file", F.col("batch_id")), stage, f"{root}/batch_0/{name}")
        if stage == "post-processing":
            stage_csv.write_stage_results(
                of_stage.withColumn("case_dir", F.col("batch_id")), stage, f"{root}/batch_0/{name}"
            )
    back = stage_csv.read_stage_results(spark, root)
    return back.select(
        F.coalesce("csv_file", "case_dir").alias("batch_id"), "stage", "row_number", "case_id", "status", "message", "case_name"
    )


@query(f"{MANIFEST_SQL} SELECT case_id, row_number::int AS row_number, nullif(input_vtu, '') AS input_vtu, status, message FROM m")
def manifest_file(spark, sf):
    path = scratch_path(spark, "manifest")
    stage_csv.write_manifest(manifest_table(spark, sf), path)
    return stage_csv.read_manifest(spark, path).select("case_id", "row_number", "input_vtu", "status", "message")


@query("SELECT 'case_' || c_custkey AS case_id, c_mktsegment AS stage, 'a=b ' || c_name AS message FROM customer")
def key_value_files(spark, sf):
    """One metadata record per customer: 50 customers share a file by their key."""
    rows = table(spark, sf, "customer").select(
        F.floor(F.col("c_custkey") / 50).alias("f"),
        F.concat(F.lit("case_"), F.col("c_custkey").cast("string")).alias("case_id"), "c_mktsegment", "c_name",
    )
    lines = rows.select(
        "f",
        F.explode(
            F.array(
                F.concat("case_id", F.lit(".stage="), "c_mktsegment"), F.concat("case_id", F.lit(".message=a=b "), "c_name"), F.lit("# no pair")
            )
        ).alias("value"),
    )
    path = scratch_path(spark, "state")
    lines.repartition("f").write.partitionBy("f").text(path)
    pairs = stage_csv.parse_key_values(read_lines(spark, f"{path}/f=*/*.txt"))
    split = pairs.select(
        F.substring_index("key", ".", 1).alias("path"), F.substring_index("key", ".", -1).alias("key"), "value"
    )
    return stage_csv.pivot_key_values(split, ["stage", "message"]).withColumnRenamed("path", "case_id")


@query("SELECT 'case_' || user_id || '/trd' AS case_name, event_type AS stage, event_id::varchar AS message, '2024' AS updated, '/w/' || event_id || '.log' AS log FROM events")
def state_files(spark, sf):
    e = F.col("event_id").cast("string")
    lines = table(spark, sf, "events").select(
        F.concat_ws(
            "|", F.concat(F.lit("case_"), F.col("user_id").cast("string"), F.lit("/trd")), "event_type", e, F.lit("2024"),
            F.concat(F.lit("/w/"), e, F.lit(".log")),
        )
    )
    path = scratch_path(spark, "states")
    lines.write.text(path)
    return stage_csv.read_state(spark, path)


@query("SELECT o_orderkey // 1000 AS folder, o_orderkey AS key FROM orders")
def numbered_lines(spark, sf):
    """Lines of many files get their physical number; it brings the order back."""
    lines = table(spark, sf, "orders").select(
        F.floor(F.col("o_orderkey") / 1000).alias("folder"), "o_orderkey", F.lit("x").alias("value")
    )
    path = scratch_path(spark, "lines")
    (
        lines.repartition("folder").sortWithinPartitions("folder", "o_orderkey")
        .select("folder", "value").write.partitionBy("folder").text(path)
    )
    numbered = read_lines(spark, f"{path}/folder=*/*.txt")
    folder = F.regexp_extract("path", r"folder=(\d+)", 1).cast("bigint")
    return numbered.select(folder.alias("folder"), (folder * 1000 + F.col("line_no") - 1).alias("key"))


@query("SELECT c_nationkey::varchar AS batch_id, count(DISTINCT c_mktsegment) AS files FROM customer GROUP BY ALL")
def workspace_files(spark, sf):
    """An inventory of real files: one file per nation and segment."""
    path = scratch_path(spark, "workspace")
    rows = table(spark, sf, "customer").select(F.col("c_nationkey").alias("batch"), F.col("c_mktsegment").alias("part"), "c_name")
    rows.repartition("batch", "part").write.partitionBy("batch", "part").csv(path)
    files = workspace.read_workspace(spark, path).filter("path like '%/part-%.csv'")
    return files.groupBy(F.regexp_extract("path", r"/batch=(\d+)/", 1).alias("batch_id")).agg(
        F.count(F.lit(1)).alias("files")
    )


@query("SELECT (p_partkey // 100)::varchar AS name, count(*) AS entries, min(p_size)::varchar AS least FROM part GROUP BY ALL")
def scenario_documents(spark, sf):
    """One JSON object per hundred parts; every part's size is one of its keys."""
    key = F.floor(F.col("p_partkey") / 100).alias("doc")
    docs = table(spark, sf, "part").groupBy(key).agg(
        F.map_from_entries(
            F.collect_list(F.struct(F.concat(F.lit("k"), F.col("p_partkey").cast("string")), F.col("p_size").cast("string")))
        ).alias("m")
    )
    text = docs.select("doc", F.to_json("m").alias("value"))
    path = scratch_path(spark, "scenarios")
    text.repartition("doc").write.partitionBy("doc").text(path)
    read = workspace.read_scenarios(spark, f"{path}/doc=*/*.txt")
    sizes = F.transform(F.map_values("params"), lambda v: v.cast("int"))
    return read.select(
        F.regexp_extract("path", r"doc=([^/]+)/", 1).alias("name"), F.size("params").cast("bigint").alias("entries"),
        F.array_min(sizes).cast("string").alias("least"),
    )


@query(
    """
    SELECT p_type AS document, p_brand AS channel, 'zscore' AS method, avg(p_size) AS mean, max(p_size)::double AS std, true AS frozen, 0.0::double AS out_lo, 1.0::double AS out_hi
    FROM part GROUP BY ALL
    """
)
def statistics_documents(spark, sf):
    """Frozen statistics: one document per part type, one channel per brand."""
    per_channel = table(spark, sf, "part").groupBy("p_type", "p_brand").agg(
        F.avg("p_size").alias("mean"), F.max("p_size").cast("double").alias("std")
    )
    stat = F.struct(F.lit("ZScore").alias("method"), "mean", "std", F.array(F.lit(0.0), F.lit(1.0)).alias("output_range"))
    docs = per_channel.groupBy("p_type").agg(F.map_from_entries(F.collect_list(F.struct("p_brand", stat))).alias("channels"))
    text = docs.select("p_type", F.to_json(F.struct(F.lit(True).alias("frozen"), "channels")).alias("value"))
    path = scratch_path(spark, "statistics")
    text.repartition("p_type").write.partitionBy("p_type").text(path)
    stats = workspace.read_statistics(spark, f"{path}/p_type=*/*.txt")
    return stats.select(
        F.regexp_extract("path", r"p_type=([^/]+)/", 1).alias("document"), "channel", "method", "mean", "std", "frozen", "out_lo", "out_hi"
    )


@query(
    """
    WITH c AS (SELECT o_orderkey // 1500 AS sample_id, o_custkey, (o_custkey % 50) / 4 AS wall FROM orders)
    SELECT sample_id::int AS sample_id, 'x' AS role, 'p' AS channel, 1500::int AS cells, sum(wall)::double AS total FROM c GROUP BY ALL
    UNION ALL SELECT sample_id::int, 'y', 'Ux', 1500::int, sum(o_custkey)::double FROM c GROUP BY ALL
    """
)
def sample_files(spark, sf):
    path = scratch_path(spark, "samples")
    workspace.write_samples(ts.build_tensors(channel_rows(spark, sf), (10, 10, 15), ["p"], ["Ux"]), path)
    back = workspace.read_samples(spark, path)
    total = F.aggregate("data", F.lit(0.0), lambda a, v: a + v.cast("double"))
    return back.select("sample_id", "role", "channel", F.size("data").alias("cells"), total.alias("total"))


@query(
    """
    WITH c AS (SELECT o_orderkey // 1500 AS sample_id, o_orderkey % 1500 AS idx, o_custkey FROM orders)
    SELECT sample_id::int AS sample_id, (CASE idx // 150 WHEN 2 THEN 2 WHEN 6 THEN 6 ELSE 3 END)::int AS z0, count(*)::int AS cells, sum(o_custkey)::double AS total
    FROM c WHERE idx // 150 BETWEEN 2 AND 6 GROUP BY ALL
    """
)
def tensor_regions(spark, sf):
    """Layers 2 to 6 of one channel, read from chunks of three layers."""
    rows, path = channel_rows(spark, sf), scratch_path(spark, "chunks")
    chunks = ts.chunk_tensors(rows, rows.select("sample_id"), (10, 10, 15), ["p"], ["Ux"], layers=3)
    workspace.write_chunks(chunks, path)
    total = F.aggregate("data", F.lit(0.0), lambda a, v: a + v.cast("double"))
    back = workspace.read_chunks(spark, path, channels=["Ux"], z=(2, 7))
    return back.select("sample_id", "z0", F.size("data").alias("cells"), total.alias("total"))


@query("SELECT count(*) AS blocks, sum(n) AS cells FROM (SELECT o_orderkey // 1500, count(*) AS n FROM orders GROUP BY 1)")
def field_files_roundtrip(spark, sf):
    """Decoded field tables written and read as a set of Parquet folders."""
    from catalog.fields import mesh

    cells, points, values = mesh(spark, sf)
    block = cells.select("sample_id", "block_id").distinct().withColumn("priority", F.lit(0))
    root = scratch_path(spark, "fields")
    workspace.write_fields(
        {"source_block": block, "source_cell": cells, "source_point": points, "source_value": values}, root
    )
    back = workspace.read_fields(spark, root)
    per_block = back["source_cell"].join(back["source_block"], ["sample_id", "block_id"]).groupBy("sample_id").count()
    return per_block.agg(F.count(F.lit(1)).alias("blocks"), F.sum("count").alias("cells"))
