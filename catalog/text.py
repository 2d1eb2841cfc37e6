"""Cells, tokens, names, times and messages."""

from pyspark.sql import functions as F

from catalog import query, table
from gridloom.functions import cells, names

# SQL helpers used by several oracles.
TOKEN = (
    "coalesce(nullif(regexp_replace(regexp_replace(regexp_replace(regexp_replace("
    r"regexp_replace(replace({c}, chr(13), ''), '^\s+|\s+$', '', 'g'), '\s+', '_', 'g'),"
    r" '[^0-9A-Za-z._-]', '_', 'g'), '_+', '_', 'g'), '^_|_$', '', 'g'), ''), 'NA')"
)


def token_sql(c: str) -> str:
    return TOKEN.replace("{c}", c)


@query(
    r"""
    WITH raw AS (SELECT p_partkey, '  ' || p_name || chr(13) || ' ' || chr(9) AS plain,
                        '" ' || p_type || ' "' AS quoted FROM part)
    SELECT p_partkey,
           regexp_replace(replace(plain, chr(13), ''), '^\s+|\s+$', '', 'g') AS trimmed,
           regexp_replace(regexp_replace(regexp_replace(quoted, '^"', ''), '"$', ''), '^\s+|\s+$', '', 'g') AS unquoted,
           regexp_replace(quoted, '^\s+|\s+$', '', 'g') AS kept
    FROM raw
    """
)
def trim_cell(spark, sf):
    raw = table(spark, sf, "part").select(
        "p_partkey",
        F.concat(F.lit("  "), "p_name", F.lit("\r \t")).alias("plain"),
        F.concat(F.lit('" '), "p_type", F.lit(' "')).alias("quoted"),
    )
    return raw.select(
        "p_partkey",
        cells.trim_cell("plain").alias("trimmed"),
        cells.trim_cell("quoted", strip_quotes=True).alias("unquoted"),
        cells.trim_cell("quoted").alias("kept"),
    )


@query(f"SELECT doc_id, {token_sql('text')} AS token FROM documents")
def sanitize_token(spark, sf):
    return table(spark, sf, "documents").select("doc_id", cells.sanitize_token("text").alias("token"))


RAW_CASE = (
    "CASE p_partkey % 5 WHEN 0 THEN ' ' WHEN 1 THEN 'NA' WHEN 2 THEN 'case_' || p_name "
    "WHEN 3 THEN ' ' || p_name || '/' || p_type || ' ' ELSE cast(p_partkey AS varchar) END"
)


def raw_cases(spark, sf):
    k = F.col("p_partkey") % 5
    return table(spark, sf, "part").select(
        "p_partkey",
        F.when(k == 0, F.lit(" "))
        .when(k == 1, F.lit("NA"))
        .when(k == 2, F.concat(F.lit("case_"), "p_name"))
        .when(k == 3, F.concat(F.lit(" "), "p_name", F.lit("/"), "p_type", F.lit(" ")))
        .otherwise(F.col("p_partkey").cast("string"))
        .alias("raw"),
    )


@query(
    f"""
    WITH t AS (SELECT p_partkey, {token_sql(RAW_CASE)} AS token FROM part)
    SELECT p_partkey,
           CASE WHEN token = 'NA' OR starts_with(token, 'case_') THEN token ELSE 'case_' || token END AS stage_id,
           CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN starts_with(token, 'case_') THEN token
                ELSE 'case_' || token END AS pair_id
    FROM t
    """
)
def case_identity(spark, sf):
    return raw_cases(spark, sf).select(
        "p_partkey", cells.case_id("raw").alias("stage_id"), cells.pair_case_id("raw").alias("pair_id")
    )


@query(
    f"""
    SELECT page_id, {token_sql("replace(url, '/', '_')")} AS path_token,
           regexp_replace(url, '[^0-9A-Za-z._-]', '_', 'g') AS wall_token
    FROM pages
    """
)
def path_tokens(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", cells.path_token("url").alias("path_token"), cells.wall_check_token("url").alias("wall_token")
    )


@query(
    r"""
    WITH n AS (SELECT p_partkey, p_brand || '  ' || p_name || '__' || p_type || '-Level_' || p_size AS name FROM part)
    SELECT p_partkey,
           regexp_replace(regexp_replace(lower(name), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS snake,
           regexp_replace(regexp_replace(lower(split_part(name, '__', 1)), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g')
           || '__' ||
           regexp_replace(regexp_replace(lower(split_part(name, '__', 2)), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g')
           AS doe_name
    FROM n
    """
)
def column_names(spark, sf):
    name = F.concat(
        "p_brand", F.lit("  "), "p_name", F.lit("__"), "p_type", F.lit("-Level_"), F.col("p_size").cast("string")
    )
    return table(spark, sf, "part").select(
        "p_partkey", names.snake_case(name).alias("snake"), names.doe_case_name(name).alias("doe_name")
    )


NAME_SQL = """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           CASE WHEN l_returnflag = 'A' THEN 'met__WS_' || l_linenumber || CASE WHEN l_linestatus = 'F' THEN '_mps' ELSE '__x' END
           ELSE 'P' || (l_suppkey % 4) || '_' ||
                CASE l_linenumber % 5 WHEN 0 THEN 'SEB' WHEN 1 THEN 'AEX' WHEN 2 THEN 'SEX' WHEN 3 THEN 'VOC' ELSE 'XXX' END
                || '_' || CASE WHEN l_linestatus = 'F' THEN 'A' ELSE 'B' END || '__' ||
                CASE l_partkey % 3 WHEN 0 THEN 'Uexit_mps' WHEN 1 THEN 'Cemit_ugpm3' ELSE 'Texit_K' END END AS name
    FROM lineitem
"""


@query(
    rf"""
    WITH n AS ({NAME_SQL}),
    c AS (SELECT name, count(*) AS rows FROM n GROUP BY name)
    SELECT name, rows,
        regexp_full_match(name, 'P[0-9]+_(SEB|AEX|SEX|VOC)_[AB]__(Uexit_mps|Cemit_ugpm3|Texit_K)')
        OR regexp_full_match(name, '(met|amb|terrain)__[A-Za-z][A-Za-z0-9]*(_[A-Za-z0-9]+)*') AS valid,
        lower(name) AS output_name,
        CASE WHEN regexp_full_match(name, 'P[0-9]+_(SEB|AEX|SEX|VOC)_[AB]__.*') THEN split_part(name, '_', 1) END AS plant,
        CASE WHEN regexp_full_match(name, 'P[0-9]+_(SEB|AEX|SEX|VOC)_[AB]__.*') THEN split_part(name, '_', 2) END AS zone,
        CASE WHEN regexp_full_match(name, 'P[0-9]+_(SEB|AEX|SEX|VOC)_[AB]__.*') THEN split_part(name, '_', 3) END AS side,
        CASE WHEN regexp_full_match(name, 'P[0-9]+_(SEB|AEX|SEX|VOC)_[AB]__.*')
             THEN split_part(split_part(name, '__', 2), '_', 1) END AS variable,
        CASE WHEN regexp_full_match(name, 'P[0-9]+_(SEB|AEX|SEX|VOC)_[AB]__.*')
             THEN split_part(split_part(name, '__', 2), '_', 2) END AS unit
    FROM c
    """
)
def param_names(spark, sf):
    from gridloom.operators.cases import param_names as check

    line = F.col("l_linenumber")
    zone = F.get(F.array(*[F.lit(z) for z in ("SEB", "AEX", "SEX", "VOC", "XXX")]), line % 5)
    variable = F.get(
        F.array(*[F.lit(v) for v in ("Uexit_mps", "Cemit_ugpm3", "Texit_K")]), (F.col("l_partkey") % 3).cast("int")
    )
    finished = F.col("l_linestatus") == "F"
    context = F.concat(
        F.lit("met__WS_"), line.cast("string"), F.when(finished, F.lit("_mps")).otherwise(F.lit("__x"))
    )
    source = F.concat(
        F.lit("P"), (F.col("l_suppkey") % 4).cast("string"), F.lit("_"), zone, F.lit("_"),
        F.when(finished, F.lit("A")).otherwise(F.lit("B")), F.lit("__"), variable,
    )
    named = table(spark, sf, "lineitem").select(
        F.when(F.col("l_returnflag") == "A", context).otherwise(source).alias("name")
    )
    counted = named.groupBy("name").agg(F.count(F.lit(1)).alias("rows"))
    return check(counted, "name").select("name", "rows", "valid", "output_name", "parsed.*")


@query(
    r"""
    WITH f AS (SELECT o_orderkey, CASE o_orderkey % 4
                 WHEN 0 THEN '/in/output_batch_' || o_orderkey || '.csv' WHEN 1 THEN 'My-Batch-' || o_custkey || '_v2.csv'
                 WHEN 2 THEN '/a/batch_1/run.' || o_orderkey || '.csv' ELSE 'table.csv' END AS name FROM orders),
    g AS (SELECT o_orderkey, name, regexp_extract(name, '([^/]*)$', 1) AS base FROM f)
    SELECT o_orderkey,
           coalesce(nullif(regexp_extract(base, '(?i)batch[_-]?(\d+)', 1), ''),
                    nullif(regexp_extract(regexp_replace(base, '\.[^.]*$', ''), '(\d+)$', 1), '')) AS batch_id
    FROM g
    """
)
def batch_numbers(spark, sf):
    k = F.col("o_orderkey") % 4
    key = F.col("o_orderkey").cast("string")
    name = (
        F.when(k == 0, F.concat(F.lit("/in/output_batch_"), key, F.lit(".csv")))
        .when(k == 1, F.concat(F.lit("My-Batch-"), F.col("o_custkey").cast("string"), F.lit("_v2.csv")))
        .when(k == 2, F.concat(F.lit("/a/batch_1/run."), key, F.lit(".csv")))
        .otherwise(F.lit("table.csv"))
    )
    return table(spark, sf, "orders").select("o_orderkey", cells.batch_number(name).alias("batch_id"))


@query(
    r"""
    WITH r AS (SELECT l_orderkey, l_linenumber, l_quantity, l_partkey,
                  l_linenumber * 10 || ';' || cast(l_quantity AS int) || ',60 60.0' ||
                  CASE WHEN l_returnflag = 'N' THEN ' x' ELSE '' END AS raw FROM lineitem),
    s AS (SELECT *, list_filter(string_split_regex(raw, '[,;\s]+'), lambda v: v <> '') AS parts FROM r),
    d AS (SELECT *, list_filter(parts, lambda v, i: list_position(parts, v) = i) AS names FROM s),
    ok AS (SELECT *, len(list_filter(names, lambda v: NOT regexp_full_match(v, '\d+(\.\d+)?|\.\d+'))) = 0 AS good FROM d),
    t AS (SELECT CASE WHEN good THEN array_to_string(names, ',') END AS times,
                 CASE WHEN good THEN l_partkey >= list_max(list_transform(names, lambda v: try_cast(v AS double))) END AS covered
          FROM ok)
    SELECT times, covered, count(*) AS rows FROM t GROUP BY times, covered
    """
)
def save_times(spark, sf):
    raw = F.concat(
        (F.col("l_linenumber") * 10).cast("string"), F.lit(";"), F.col("l_quantity").cast("int").cast("string"),
        F.lit(",60 60.0"), F.when(F.col("l_returnflag") == "N", F.lit(" x")).otherwise(F.lit("")),
    )
    parsed = table(spark, sf, "lineitem").select("l_partkey", cells.save_times(raw).alias("t"))
    rows = parsed.select(
        F.array_join("t", ",").alias("times"),
        cells.covers_end_time(F.col("l_partkey").cast("string"), F.col("t")).alias("covered"),
    )
    return rows.groupBy("times", "covered").agg(F.count(F.lit(1)).alias("rows"))


@query(
    r"""
    SELECT page_id, coalesce(nullif(regexp_extract(html, '(?:^|\s)(/\S*)', 1), ''), 'unavailable') AS in_page,
           coalesce(nullif(regexp_extract(CASE WHEN page_id % 3 = 0 THEN 'no path in x/' || page_id
               ELSE 'see log: /w/logs/case_' || page_id || '.log /other' END, '(?:^|\s)(/\S*)', 1), ''), 'unavailable') AS in_message
    FROM pages
    """
)
def absolute_paths(spark, sf):
    page = F.col("page_id").cast("string")
    message = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("no path in x/"), page)).otherwise(
        F.concat(F.lit("see log: /w/logs/case_"), page, F.lit(".log /other"))
    )
    return table(spark, sf, "pages").select(
        "page_id",
        cells.first_absolute_path("html").alias("in_page"),
        cells.first_absolute_path(message).alias("in_message"),
    )


CELL_SQL = """CASE l_partkey % 9 WHEN 0 THEN cast(cast(l_quantity AS int) AS varchar) WHEN 1 THEN l_linenumber || 'f'
    WHEN 2 THEN 'nan' WHEN 3 THEN '' WHEN 4 THEN '+.' || l_linenumber || 'e2' WHEN 5 THEN '-' || l_linenumber || '.'
    WHEN 6 THEN '.' || l_linenumber WHEN 7 THEN l_linenumber || '.25' ELSE ' ' || l_linenumber END"""


def odd_cells(spark, sf):
    n = F.col("l_linenumber").cast("string")
    k = F.col("l_partkey") % 9
    text = (
        F.when(k == 0, F.col("l_quantity").cast("int").cast("string"))
        .when(k == 1, F.concat(n, F.lit("f")))
        .when(k == 2, F.lit("nan"))
        .when(k == 3, F.lit(""))
        .when(k == 4, F.concat(F.lit("+."), n, F.lit("e2")))
        .when(k == 5, F.concat(F.lit("-"), n, F.lit(".")))
        .when(k == 6, F.concat(F.lit("."), n))
        .when(k == 7, F.concat(n, F.lit(".25")))
        .otherwise(F.concat(F.lit(" "), n))
    )
    return table(spark, sf, "lineitem").select(text.alias("cell"))


@query(
    rf"""
    WITH c AS (SELECT {CELL_SQL} AS cell FROM lineitem),
    n AS (SELECT cell, count(*) AS rows FROM c GROUP BY cell)
    SELECT cell, rows, regexp_full_match(cell, '[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?') AS is_number,
           CASE WHEN regexp_full_match(cell, '[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?') THEN try_cast(cell AS double) END AS number,
           regexp_full_match(cell, '\d+(\.\d+)?|\.\d+') AS is_time,
           CASE WHEN regexp_full_match(cell, '\d+(\.\d+)?|\.\d+') THEN try_cast(cell AS double) END AS time_value
    FROM n
    """
)
def numeric_cells(spark, sf):
    counted = odd_cells(spark, sf).groupBy("cell").agg(F.count(F.lit(1)).alias("rows"))
    return counted.select(
        "cell", "rows",
        cells.is_number("cell").alias("is_number"), cells.to_number("cell").alias("number"),
        cells.is_time_name("cell").alias("is_time"), cells.time_value("cell").alias("time_value"),
    )


@query(
    r"""
    WITH c AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
        CASE l_linenumber WHEN 1 THEN 'uniform ' || l_partkey WHEN 2 THEN '(1 2 ' || l_partkey || ')'
             WHEN 3 THEN 'uniform (0 0 ' || l_partkey || ')' WHEN 4 THEN 'x' || l_partkey WHEN 5 THEN ''
             ELSE cast(cast(l_partkey AS decimal(18,2)) / 100 AS varchar) END AS cell,
        l_extendedprice * CASE l_linenumber % 4 WHEN 0 THEN 1e-9 WHEN 1 THEN 1e6 WHEN 2 THEN 1 ELSE -0.001 END AS x FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, printf('%.9g', x) AS general
           , CASE WHEN cell = '' OR l_linenumber = 4 THEN NULL WHEN starts_with(cell, 'uniform') THEN cell
                WHEN cell LIKE '(%' THEN NULL ELSE 'uniform ' || cell END AS scalar_text
           , CASE WHEN cell = '' OR l_linenumber IN (1, 4) THEN NULL WHEN starts_with(cell, 'uniform') THEN cell
                WHEN cell LIKE '(%' THEN 'uniform ' || cell
                ELSE 'uniform (0 0 ' || printf('%.9g', cast(cell AS double)) || ')' END AS vector_text
    FROM c
    """
)
def boundary_text(spark, sf):
    part, line = F.col("l_partkey").cast("string"), F.col("l_linenumber")
    cell = (
        F.when(line == 1, F.concat(F.lit("uniform "), part))
        .when(line == 2, F.concat(F.lit("(1 2 "), part, F.lit(")")))
        .when(line == 3, F.concat(F.lit("uniform (0 0 "), part, F.lit(")")))
        .when(line == 4, F.concat(F.lit("x"), part))
        .when(line == 5, F.lit(""))
        .otherwise((F.col("l_partkey").cast("decimal(18,2)") / 100).cast("double").cast("string"))
    )
    factor = (
        F.when(line % 4 == 0, F.lit(1e-9)).when(line % 4 == 1, F.lit(1e6)).when(line % 4 == 2, F.lit(1.0)).otherwise(F.lit(-0.001))
    )
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        cells.general_number(F.col("l_extendedprice") * factor).alias("general"),
        cells.uniform_scalar(cell).alias("scalar_text"),
        cells.uniform_vector(cell).alias("vector_text"),
    )
