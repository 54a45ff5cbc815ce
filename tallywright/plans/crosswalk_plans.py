"""Two mappings = line items by line status; partner scores = orders."""

from pyspark.sql import functions as F

from ..operators import counts, crosswalk
from .catalog import query, table


def mapping_a(spark, d):
    rows = table(spark, d, "lineitem").where("l_linestatus = 'F'")
    return rows.select(F.col("l_orderkey").alias("link"), F.col("l_partkey").alias("email"), F.col("l_suppkey").alias("social"))


def mapping_b(spark, d):
    rows = table(spark, d, "lineitem").where("l_linestatus = 'O'")
    return rows.select(
        F.col("l_orderkey").alias("partner"),
        F.col("l_partkey").alias("email_b"),
        F.col("l_suppkey").alias("social"),
        F.col("l_linenumber").cast("bigint").alias("level"),
    )


AB = """
WITH a AS (SELECT l_orderkey AS link, l_partkey AS email, l_suppkey AS social FROM lineitem WHERE l_linestatus = 'F'),
     b AS (SELECT l_orderkey AS partner, l_partkey AS email_b, l_suppkey AS social, CAST(l_linenumber AS BIGINT) AS level
           FROM lineitem WHERE l_linestatus = 'O'),
     best AS (SELECT link, partner, email FROM (
        SELECT a.link, b.partner, a.email, row_number() OVER (PARTITION BY a.link ORDER BY b.partner, a.email) AS rn
        FROM a JOIN b ON a.email = b.email_b AND a.social = b.social) WHERE rn = 1)
"""


@query("crosswalk_common_keys", AB + "SELECT email FROM a INTERSECT SELECT email_b FROM b")
def crosswalk_common_keys(spark, d):
    return crosswalk.common_keys(mapping_a(spark, d), mapping_b(spark, d), [("email", "email_b")])


@query("crosswalk_common_pairs", AB + "SELECT email, social FROM a INTERSECT SELECT email_b, social FROM b")
def crosswalk_common_pairs(spark, d):
    return crosswalk.common_keys(mapping_a(spark, d), mapping_b(spark, d), [("email", "email_b"), ("social", "social")])


@query("crosswalk_population_counts", AB + """
SELECT 'emails' AS what, CAST((SELECT count(*) FROM (SELECT DISTINCT email FROM a)) AS BIGINT) AS n
UNION ALL SELECT 'socials', (SELECT count(*) FROM (SELECT DISTINCT social FROM a))
UNION ALL SELECT 'pairs', (SELECT count(*) FROM (SELECT DISTINCT email, social FROM a))
""")
def crosswalk_population_counts(spark, d):
    sets = {"emails": ["email"], "socials": ["social"], "pairs": ["email", "social"]}
    return crosswalk.population_counts(mapping_a(spark, d), sets)


@query("crosswalk_best_match", AB + "SELECT link, partner, email FROM best")
def crosswalk_best_match(spark, d):
    on = [("email", "email_b"), ("social", "social")]
    return crosswalk.crosswalk_best(mapping_a(spark, d), mapping_b(spark, d), on, "link", "partner", ["email"])


@query("crosswalk_attach_scores", AB + """
SELECT DISTINCT best.link, best.email, o.o_orderdate AS latest_action, o.o_orderpriority AS latest_scorable, o.o_totalprice AS score
FROM best JOIN orders AS o ON o.o_orderkey = best.partner
""")
def crosswalk_attach_scores(spark, d):
    scored = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("partner"),
        F.col("o_orderdate").alias("latest_action"),
        F.col("o_orderpriority").alias("latest_scorable"),
        F.col("o_totalprice").alias("score"),
    )
    cols = ["link", "email", "latest_action", "latest_scorable", "score"]
    return crosswalk.attach_scores(crosswalk_best_match(spark, d), scored, "partner", cols)


@query("argmin_struct", AB + """
SELECT social, partner, level FROM (SELECT social, partner, level, row_number() OVER (PARTITION BY social ORDER BY partner, level) AS rn FROM b) WHERE rn = 1
""")
def argmin_struct(spark, d):
    return crosswalk.argmin_struct(mapping_b(spark, d), ["social"], ["partner", "level"])


@query("count_by_level", AB + "SELECT level, CAST(count(*) AS BIGINT) AS n FROM b GROUP BY 1")
def count_by_level(spark, d):
    return counts.count_by(mapping_b(spark, d), "level")


@query("decimal_sum", "SELECT l_returnflag, sum(CAST(l_extendedprice AS DECIMAL(28,2))) AS total FROM lineitem GROUP BY 1")
def decimal_sum(spark, d):
    return counts.exact_sum(table(spark, d, "lineitem"), "l_extendedprice", 2, ["l_returnflag"])


@query("counter_report", """
SELECT '{"all_orders":' || count(*) || ',"open_orders":' || count(*) FILTER (o_orderstatus = 'O') || ',"customers":' || count(DISTINCT o_custkey) || '}' AS report FROM orders
""")
def counter_report(spark, d):
    counters = [
        ("all orders", F.count(F.lit(1))),
        ("open orders", F.count_if(F.col("o_orderstatus") == "O")),
        ("customers", F.count_distinct("o_custkey")),
    ]
    return counts.counter_report(table(spark, d, "orders"), counters)
