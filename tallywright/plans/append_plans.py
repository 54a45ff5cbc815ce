"""Base = customers, middle = their orders, appends = line items of the order."""

from pyspark.sql import functions as F

from ..operators import appending
from .catalog import query, table

APP = ["l_returnflag", "l_linestatus", "l_partkey", "l_suppkey"]
NAMES = {
    "base_id": "c_custkey",
    "base_cols": ["c_name", "c_mktsegment"],
    "base_order": ["c_name"],
    "mid_id": "o_custkey",
    "mid_key": "o_orderkey",
    "mid_cols": ["o_orderkey", "o_orderstatus"],
    "mid_order": ["o_orderdate", "o_orderkey"],
    "app_key": "l_orderkey",
    "app_cols": APP,
    "app_order": ["l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus"],
}


def sides(spark, d):
    return [table(spark, d, name) for name in ("customer", "orders", "lineitem")]


@query("append_two_stage", """
WITH m AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1),
a AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus) AS rn FROM lineitem) WHERE rn = 1)
SELECT CAST(c.c_custkey AS VARCHAR) AS c_custkey, c.c_name, c.c_mktsegment, coalesce(a.l_returnflag, '') AS l_returnflag, coalesce(a.l_linestatus, '') AS l_linestatus,
 coalesce(CAST(a.l_partkey AS VARCHAR), '') AS l_partkey, coalesce(CAST(a.l_suppkey AS VARCHAR), '') AS l_suppkey,
 coalesce(CAST(m.o_orderkey AS VARCHAR), '') AS o_orderkey, coalesce(m.o_orderstatus, '') AS o_orderstatus
FROM customer AS c LEFT JOIN m ON m.o_custkey = c.c_custkey LEFT JOIN a ON a.l_orderkey = m.o_orderkey
""")
def append_two_stage(spark, d):
    return appending.append_two_stage(*sides(spark, d), **NAMES)


@query("append_counters", """
WITH m AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1),
j AS (SELECT m.o_orderkey AS m, EXISTS (SELECT 1 FROM lineitem AS l WHERE l.l_orderkey = m.o_orderkey) AS a FROM customer AS c LEFT JOIN m ON m.o_custkey = c.c_custkey)
SELECT 'records' AS counter, CAST(count(*) AS BIGINT) AS n FROM j UNION ALL SELECT 'with_mid', count(m) FROM j UNION ALL SELECT 'without_mid', count(*) FILTER (m IS NULL) FROM j
UNION ALL SELECT 'with_app', count(*) FILTER (a) FROM j UNION ALL SELECT 'without_app', count(*) FILTER (NOT a) FROM j
""")
def append_counters(spark, d):
    """The counters that the job writing the appended rows makes."""
    return appending.append_counted(*sides(spark, d), **NAMES).stored()[1]


@query("append_match_counts", """
SELECT 'only_mid' AS counter, CAST((SELECT count(*) FROM orders AS o WHERE NOT EXISTS (SELECT 1 FROM lineitem AS l WHERE l.l_orderkey = o.o_orderkey)) AS BIGINT) AS n
UNION ALL SELECT 'only_base', (SELECT count(*) FROM customer AS c WHERE NOT EXISTS (SELECT 1 FROM orders AS o WHERE o.o_custkey = c.c_custkey))
""")
def append_match_counts(spark, d):
    return appending.append_match_counts(
        table(spark, d, "customer"),
        table(spark, d, "orders"),
        table(spark, d, "lineitem"),
        base_id="c_custkey",
        mid_id="o_custkey",
        mid_key="o_orderkey",
        app_key="l_orderkey",
    )


@query("project_positions", "SELECT l_orderkey, l_returnflag, l_shipdate FROM lineitem")
def project_positions(spark, d):
    return appending.pick(table(spark, d, "lineitem"), [0, -3, -1])


@query("project_config", """
SELECT replace(p_type, ',', '') AS p_type, replace(CAST(p_partkey AS VARCHAR), ',', '') AS p_partkey, replace(p_name, ',', '') AS p_name,
       replace(CAST(p_size AS VARCHAR), ',', '') AS p_size, replace(p_brand, ',', '') AS p_brand FROM part
""")
def project_config(spark, d):
    # the index file is shaped from the regions: the last token of each line is a column index
    places = F.array(*[F.lit(i) for i in (3, 0, 1, 4, 2)])
    index = table(spark, d, "region").select(
        F.concat_ws(",", "r_name", F.get(places, F.col("r_regionkey")).cast("string")).alias("value")
    )
    return appending.pick_from_config(table(spark, d, "part"), index)
