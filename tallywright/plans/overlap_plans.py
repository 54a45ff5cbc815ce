"""Lists = event types, values = user and day; ladder = order kinds over customers by segment."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import counts, overlap, rules
from .catalog import query, table


def event_lists(spark: SparkSession, d: str) -> DataFrame:
    key = F.concat(F.lit(" User_"), F.col("user_id").cast("string"), F.lit("@"), F.date_format("ts", "yyyy-MM-dd"), F.lit(" "))
    return table(spark, d, "events").select(F.col("event_type").alias("list_name"), key.alias("value"))


def segments(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select(F.col("c_mktsegment").alias("base_name"), F.col("c_custkey").cast("string").alias("value"))


def order_rungs(spark: SparkSession, d: str) -> DataFrame:
    kind = F.concat_ws("/", "o_orderstatus", "o_orderpriority")
    return table(spark, d, "orders").select(kind.alias("rung_name"), F.col("o_custkey").cast("string").alias("value"))


LISTS = """
WITH l AS (SELECT DISTINCT event_type AS list_name,
                  'user_' || user_id || '@' || strftime(ts, '%Y-%m-%d') AS value FROM events),
     names AS (SELECT DISTINCT event_type AS list_name FROM events)
"""

LADDER = """
WITH b AS (SELECT DISTINCT c_mktsegment AS base_name, CAST(c_custkey AS VARCHAR) AS value FROM customer),
     r AS (SELECT DISTINCT o_orderstatus || '/' || o_orderpriority AS rung_name, CAST(o_custkey AS VARCHAR) AS value FROM orders),
     bn AS (SELECT DISTINCT base_name FROM b), rn AS (SELECT DISTINCT rung_name FROM r),
     hits AS (SELECT b.base_name, r.rung_name, b.value FROM b JOIN r USING (value)
              WHERE NOT EXISTS (SELECT 1 FROM r AS h WHERE h.value = r.value AND h.rung_name < r.rung_name)),
     cells AS (SELECT bn.base_name, rn.rung_name,
                      (SELECT count(*) FROM hits WHERE hits.base_name = bn.base_name AND hits.rung_name = rn.rung_name) AS n
               FROM bn CROSS JOIN rn),
     sizes AS (SELECT base_name, count(*) AS size FROM b GROUP BY base_name)
"""


@query("overlap_counts", LISTS + """
SELECT a.list_name AS list_a, b.list_name AS list_b,
       CAST((SELECT count(*) FROM l AS x JOIN l AS y ON x.value = y.value
             WHERE x.list_name = a.list_name AND y.list_name = b.list_name) AS BIGINT) AS n_common
FROM names AS a CROSS JOIN names AS b
""")
def overlap_counts(spark, d):
    return overlap.overlap_counts(event_lists(spark, d))


@query("overlap_percent", LISTS + """
, m AS (SELECT a.list_name AS list_a, b.list_name AS list_b,
       (SELECT count(*) FROM l AS x JOIN l AS y ON x.value = y.value
        WHERE x.list_name = a.list_name AND y.list_name = b.list_name) AS n
FROM names AS a CROSS JOIN names AS b),
s AS (SELECT list_name, count(*) AS size FROM l GROUP BY list_name)
SELECT m.list_a, CAST(s.size AS BIGINT) AS size, m.list_b,
       CAST(round(CAST(m.n * 100.0 / s.size AS DECIMAL(24,8)), 2) AS DOUBLE) AS pct
FROM m JOIN s ON s.list_name = m.list_a
""")
def overlap_percent(spark, d):
    return overlap.overlap_percent(event_lists(spark, d))


@query("list_normalise", LISTS + "SELECT list_name, value, CAST(count(*) AS BIGINT) AS n FROM (SELECT event_type AS list_name, 'user_' || user_id || '@' || strftime(ts, '%Y-%m-%d') AS value FROM events) GROUP BY 1, 2")
def list_normalise(spark, d):
    return counts.count_by(rules.drop_blank_normalised(event_lists(spark, d), "value"), "list_name", "value")


@query("distinct_set", LISTS + "SELECT DISTINCT value FROM l")
def distinct_set(spark, d):
    return counts.distinct_set(rules.drop_blank_normalised(event_lists(spark, d), "value"), "value")


@query("ladder_counts", LADDER + "SELECT base_name, rung_name, CAST(n AS BIGINT) AS n_new FROM cells")
def ladder_counts(spark, d):
    return overlap.ladder_counts(segments(spark, d), order_rungs(spark, d))


@query("ladder_percent", LADDER + """
SELECT base_name, rung_name, CAST(round(CAST(n * 100.0 / size AS DECIMAL(24,8)), 2) AS DOUBLE) AS pct
FROM cells JOIN sizes USING (base_name)
""")
def ladder_percent(spark, d):
    return overlap.ladder_percent(segments(spark, d), order_rungs(spark, d))


@query("ladder_totals", LADDER + """
SELECT base_name, CAST(sum(n) AS BIGINT) AS n_total,
       CAST(round(CAST(sum(n) * 100.0 / max(size) AS DECIMAL(24,8)), 2) AS DOUBLE) AS pct_total
FROM cells JOIN sizes USING (base_name) GROUP BY base_name
""")
def ladder_totals(spark, d):
    return overlap.ladder_totals(segments(spark, d), order_rungs(spark, d))


@query("ladder_sizes", LADDER + "SELECT rung_name, CAST(count(*) AS BIGINT) AS size FROM r GROUP BY rung_name")
def ladder_sizes(spark, d):
    return overlap.ladder_sizes(order_rungs(spark, d))


@query("ladder_base_sizes", LADDER + "SELECT base_name, CAST(size AS BIGINT) AS size FROM sizes")
def ladder_base_sizes(spark, d):
    return overlap.base_sizes(segments(spark, d))


@query("ladder_powerset", LADDER + """
, sets AS (SELECT b.base_name, b.value, string_agg(r.rung_name, ',' ORDER BY r.rung_name) AS rung_set
           FROM b JOIN r USING (value) GROUP BY 1, 2)
SELECT base_name, rung_set, CAST(count(*) AS BIGINT) AS n FROM sets GROUP BY 1, 2
""")
def ladder_powerset(spark, d):
    return overlap.ladder_powerset(segments(spark, d), order_rungs(spark, d)).withColumn("rung_set", F.array_join("rung_set", ","))
