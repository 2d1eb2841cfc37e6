"""Experiment tables: definitions, draws, audits, numbering and batches."""

from pyspark.sql import functions as F

from catalog import query, table
from gridloom.operators import doe
from gridloom.plans.campaign import default_factors

STATUS = ["F", "O", "P", "X"]
PRIORITY = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "0-NEVER"]
LEVELS = {"o_orderstatus": STATUS, "o_orderpriority": PRIORITY, "not_a_column": ["a"]}

AUDIT_SQL = """
    WITH d AS (SELECT * FROM (VALUES
        (0, 'o_orderstatus', 0, 'F'), (0, 'o_orderstatus', 1, 'O'), (0, 'o_orderstatus', 2, 'P'), (0, 'o_orderstatus', 3, 'X'),
        (1, 'o_orderpriority', 0, '1-URGENT'), (1, 'o_orderpriority', 1, '2-HIGH'), (1, 'o_orderpriority', 2, '3-MEDIUM'),
        (1, 'o_orderpriority', 3, '4-NOT SPECIFIED'), (1, 'o_orderpriority', 4, '0-NEVER'))
        v(parameter_ordinal, parameter, level_ordinal, level)),
    u AS (SELECT 'o_orderstatus' AS parameter, o_orderstatus AS value FROM orders
          UNION ALL SELECT 'o_orderpriority', o_orderpriority FROM orders),
    n AS (SELECT count(*) AS total FROM orders)
    SELECT d.*, count(u.value) AS "count", count(u.value) / any_value(n.total) AS fraction
    FROM d LEFT JOIN u ON u.parameter = d.parameter AND u.value = d.level, n GROUP BY ALL
"""


@query(AUDIT_SQL)
def coverage_audit(spark, sf):
    return doe.coverage_audit(table(spark, sf, "orders"), LEVELS)


@query(
    f"""
    WITH a AS ({AUDIT_SQL})
    SELECT parameter_ordinal, parameter,
           parameter || ': ' || string_agg(level || ': ' || "count", ', ' ORDER BY level_ordinal) AS line
    FROM a GROUP BY parameter_ordinal, parameter
    """
)
def coverage_lines(spark, sf):
    return doe.coverage_lines(coverage_audit(spark, sf))


def measured_definitions(spark, sf):
    """Definitions read off the data: one per part type, by its sizes and prices."""
    return (
        table(spark, sf, "part")
        .groupBy("p_brand")
        .agg(
            F.sort_array(F.collect_set("p_size")).cast("array<string>").alias("sizes"),
            F.min("p_retailprice").alias("low"),
            F.max("p_retailprice").alias("high"),
            F.max("p_type").alias("top"),
        )
        .select(
            F.regexp_extract("p_brand", r"(\d+)", 1).cast("int").alias("ordinal"),
            F.col("p_brand").alias("name"),
            F.get(
                F.array(F.lit("fixed"), F.lit("discrete"), F.lit("continuous")),
                F.regexp_extract("p_brand", r"(\d+)", 1).cast("int") % 3,
            ).alias("kind"),
            F.lit(None).cast("double").alias("value_num"),
            F.col("top").alias("value_str"),
            F.col("sizes").alias("levels"),
            "low",
            "high",
        )
    )


DEFS_SQL = r"""
    SELECT cast(regexp_extract(p_brand, '(\d+)', 1) AS int) AS ordinal, p_brand AS name,
           ['fixed', 'discrete', 'continuous'][cast(regexp_extract(p_brand, '(\d+)', 1) AS int) % 3 + 1] AS kind,
           max(p_type) AS value_str, list_transform(list_sort(list(DISTINCT p_size)), lambda v: cast(v AS varchar)) AS levels,
           min(p_retailprice) AS low, max(p_retailprice) AS high
    FROM part GROUP BY p_brand
"""


@query(
    rf"""
    WITH d AS ({DEFS_SQL})
    SELECT ordinal, name AS parameter, kind AS type,
           CASE kind WHEN 'continuous' THEN 'continuous' WHEN 'discrete' THEN cast(len(levels) AS varchar) ELSE '1' END AS n_levels,
           CASE kind WHEN 'continuous' THEN '[' || low || ', ' || high || ']' WHEN 'discrete' THEN array_to_string(levels, '; ')
                ELSE value_str END AS levels
    FROM d
    """
)
def level_summary(spark, sf):
    return doe.level_summary(measured_definitions(spark, sf))


@query(
    rf"""
    WITH d AS ({DEFS_SQL}), k AS (SELECT unnest([0, 2]) AS dropped)
    SELECT 'without continuous' AS scope,
           cast(product(CASE WHEN kind = 'discrete' THEN len(levels) ELSE 1 END) AS decimal(38,0)) AS combinations
    FROM d WHERE kind <> 'continuous' AND ordinal < 10
    UNION ALL SELECT 'all', CASE WHEN bool_or(kind = 'continuous') THEN NULL ELSE 0 END FROM d
    """
)
def full_factorial(spark, sf):
    defs = measured_definitions(spark, sf)
    few = doe.full_factorial(defs.filter("kind <> 'continuous' and ordinal < 10"))
    return few.withColumn("scope", F.lit("without continuous")).unionByName(
        doe.full_factorial(defs).withColumn("scope", F.lit("all"))
    )


@query(
    """
    WITH p AS (SELECT p_partkey, p_size AS low, p_size + p_retailprice AS high, p_partkey % 6 AS n FROM part),
    i AS (SELECT *, unnest(range(0, n)) AS i FROM p)
    SELECT p_partkey, cast(i AS int) AS ordinal,
           CASE WHEN n = 1 THEN round(low::double, 6) ELSE round(low + i * (high - low) / (n - 1), 6) END AS level
    FROM i
    """
)
def linspace_levels(spark, sf):
    levels = doe.linspace_levels(
        F.col("p_size").cast("double"), F.col("p_size") + F.col("p_retailprice"), F.col("p_partkey") % 6
    )
    return table(spark, sf, "part").select("p_partkey", F.posexplode(levels).alias("ordinal", "level"))


@query(
    """
    WITH u AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, (l_quantity - 1) / 50 AS u, l_extendedprice AS x FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, u,
           (['neutral', 'stable', 'unstable'])[cast(least(floor(u * 3), 2) AS int) + 1] AS level,
           round(0.5 + u * (x - 0.5), 4) AS value
    FROM u
    """
)
def unit_samples(spark, sf):
    u = (F.col("l_quantity") - 1) / 50
    names = F.array(F.lit("neutral"), F.lit("stable"), F.lit("unstable"))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", u.alias("u"),
        doe.level_of_unit(u, names).alias("level"),
        doe.value_of_unit(u, F.lit(0.5), F.col("l_extendedprice"), 4).alias("value"),
    )


@query(
    """
    WITH b AS (SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 16 AS batch_id FROM orders)
    SELECT batch_id, count(*) AS rows, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key FROM b GROUP BY batch_id
    """
)
def batch_split(spark, sf):
    rows = doe.batch_of(table(spark, sf, "orders"), "o_orderkey", 16)
    return rows.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("rows"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key")
    )


@query(
    """
    WITH n AS (SELECT c_custkey, c_mktsegment, row_number() OVER (ORDER BY c_custkey) - 1 + 7 AS i, count(*) OVER () AS c FROM customer)
    SELECT 'run' || lpad(cast(i AS varchar), greatest(4, length(cast(c + 6 AS varchar)))::int, '0') AS "Case", c_mktsegment FROM n
    """
)
def case_numbers(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return doe.number_cases(rows, "c_custkey", start=7, prefix="run")


@query(
    """
    WITH d AS (SELECT unnest([0, 1, 2])::int AS dim), n AS (SELECT count(*) AS n FROM orders)
    SELECT dim, n AS samples, n AS strata, 0::bigint AS first_stratum, n - 1 AS last_stratum FROM d, n
    """
)
def lhs_strata(spark, sf):
    """One unit sample per order and dimension; every stratum is hit once."""
    orders = table(spark, sf, "orders").select("o_orderkey")
    n = orders.count()
    numbered = doe.global_row_number(orders, "o_orderkey", "_n").withColumn("sample", F.col("_n") - 1)
    drawn = numbered.join(doe.lhs(spark, n, 3, seed=11), "sample")
    stratum = F.floor(F.col("u") * n)
    return drawn.groupBy("dim").agg(
        F.count(F.lit(1)).alias("samples"),
        F.count_distinct(stratum).alias("strata"),
        F.min(stratum).alias("first_stratum"),
        F.max(stratum).alias("last_stratum"),
    )


@query(
    """
    SELECT l_quantity AS quantity, l_discount + 1e-14 AS discount, l_tax AS tax, l_returnflag AS flag,
           min(l_orderkey * 10 + l_linenumber) AS draw
    FROM lineitem GROUP BY ALL
    """
)
def unique_rows(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        F.col("l_quantity").alias("quantity"),
        # Differences below twelve decimals do not make two rows distinct.
        (F.col("l_discount") + 1e-14).alias("discount"),
        F.col("l_tax").alias("tax"),
        F.col("l_returnflag").alias("flag"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("draw"),
    )
    return doe.unique_rows(rows, "draw")


@query(
    """
    WITH u AS (SELECT o_custkey, o_orderstatus, o_orderpriority, min(o_orderkey) AS draw FROM orders GROUP BY ALL)
    SELECT * FROM u ORDER BY draw LIMIT 128
    """
)
def first_unique_rows(spark, sf):
    rows = table(spark, sf, "orders").select(
        "o_custkey", "o_orderstatus", "o_orderpriority", F.col("o_orderkey").alias("draw")
    )
    return doe.unique_rows(rows, "draw").orderBy("draw").limit(128)


@query("SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_keys(spark, sf):
    return doe.duplicates(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    """
    WITH n AS (SELECT count(*) AS n FROM customer)
    SELECT n AS rows, n AS distinct_rows, 0::bigint AS first_case, n - 1 AS last_case, n AS strata, 81::bigint AS columns FROM n
    """
)
def experiment_table(spark, sf):
    """The committed factor space with a continuous speed, one case per customer."""
    n = table(spark, sf, "customer").count()
    factors = {**default_factors(), "met__WS_mps": (0.01, 5.0)}
    doe_table = doe.generate(spark, factors, n, seed=5, digits=None)
    stratum = F.floor((F.col("met__WS_mps") - 0.01) / (5.0 - 0.01) * n)
    return doe_table.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct(F.struct(*[F.col(f"`{c}`") for c in doe_table.columns[1:]])).alias("distinct_rows"),
        F.min("Case").alias("first_case"),
        F.max("Case").alias("last_case"),
        F.count_distinct(stratum).alias("strata"),
        F.lit(len(doe_table.columns)).cast("bigint").alias("columns"),
    )
