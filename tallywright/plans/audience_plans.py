"""Audience labels = order priorities; stored = the earlier half of the orders, incoming = the later half."""

from pyspark.sql import functions as F

from ..operators import audience
from ..sources import readers
from .catalog import query, table
from .drift_plans import HALVES, halves


def codes(spark, d):
    p = F.col("o_orderpriority")
    return table(spark, d, "orders").select(F.substring(p, 1, 1).alias("code"), F.substring(p, 3, 100).alias("label")).distinct()


def incoming(spark, d):
    return halves(spark, d)[1].select(F.col("o_custkey").alias("id"), F.substring("o_orderpriority", 1, 1).alias("code"))


MERGED = HALVES + """
, u AS (SELECT DISTINCT o_custkey AS id, substr(o_orderpriority, 3) AS label FROM n
        UNION SELECT o_custkey, substr(o_orderpriority, 3) FROM o WHERE o_custkey IN (SELECT o_custkey FROM n)),
  m AS (SELECT id, string_agg(label, ',' ORDER BY label) AS labels, count(*) AS k FROM u GROUP BY 1)
"""


@query("audience_map_codes", HALVES + "SELECT o_custkey AS id, substr(o_orderpriority, 3) AS label FROM n")
def audience_map_codes(spark, d):
    return audience.map_codes(incoming(spark, d), codes(spark, d))


@query("audience_map_code_lists", """
SELECT o_orderkey AS id, CASE WHEN substr(o_orderpriority, 1, 1) = '1' THEN substr(o_orderpriority, 3) || ',' || substr(o_orderpriority, 3)
       WHEN substr(o_orderpriority, 3) < 'URGENT' THEN substr(o_orderpriority, 3) || ',URGENT' ELSE 'URGENT,' || substr(o_orderpriority, 3) END AS labels FROM orders
""")
def audience_map_code_lists(spark, d):
    rows = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"), F.array(F.substring("o_orderpriority", 1, 1), F.lit("1")).alias("codes")
    )
    return audience.map_code_lists(rows, codes(spark, d)).withColumn("labels", F.array_join("labels", ","))


def _merged(spark, d):
    stored = halves(spark, d)[0].select(F.col("o_custkey").alias("id"), F.substring("o_orderpriority", 3, 100).alias("label"))
    return audience.merge_audiences(stored, incoming(spark, d), codes(spark, d))


@query("audience_merge", MERGED + "SELECT id, labels FROM m")
def audience_merge(spark, d):
    return _merged(spark, d).withColumn("labels", F.array_join("labels", ","))


@query("audience_merge_counts", MERGED + "SELECT CAST(count(*) AS BIGINT) AS total_records, CAST(sum(k) AS BIGINT) AS total_labels FROM m")
def audience_merge_counts(spark, d):
    return audience.merge_counts(_merged(spark, d))


@query("tag_add", """
SELECT c_custkey AS id, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 200000)
       THEN CASE WHEN lower(c_mktsegment) < 'pending' THEN lower(c_mktsegment) || ',pending' ELSE 'pending,' || lower(c_mktsegment) END
       ELSE lower(c_mktsegment) END AS tags FROM customer
""")
def tag_add(spark, d):
    rows = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.array(F.lower("c_mktsegment")).alias("tags"))
    chosen = table(spark, d, "orders").where("o_orderstatus = 'P' AND o_totalprice > 200000").select(F.col("o_custkey").alias("id"))
    return audience.add_tag(rows, chosen, "pending").select("id", F.array_join(F.array_sort("tags"), ",").alias("tags"))


URL = "https://twitter.com/"


def _cells(pairs: str) -> str:
    return f"""(SELECT 'graph' AS store, s AS node, 'Out' AS direction, t AS other FROM {pairs} UNION ALL SELECT 'graph', t, 'In', s FROM {pairs}
    UNION ALL SELECT 'links', '{URL}' || s, 'e_Out', '{URL}' || t FROM {pairs} UNION ALL SELECT 'links', '{URL}' || t, 'e_In', '{URL}' || s FROM {pairs}
    UNION ALL SELECT 'links', '{URL}' || t, 'eNew_In', '{URL}' || s FROM {pairs})"""


@query("edges_drop", f"""
WITH p AS (SELECT DISTINCT 'p' || l_partkey AS s, 's' || l_suppkey AS t FROM lineitem),
     x AS (SELECT DISTINCT 'p' || l_partkey AS s, 's' || l_suppkey AS t FROM lineitem WHERE l_returnflag = 'R'),
     keep AS (SELECT * FROM p WHERE NOT EXISTS (SELECT 1 FROM x WHERE x.s = p.s AND x.t = p.t))
SELECT 'kept' AS outcome, store, node, direction, other FROM {_cells('keep')} UNION ALL
SELECT 'dropped', store, node, direction, other FROM {_cells('x')}
""")
def edges_drop(spark, d):
    items = table(spark, d, "lineitem")

    def pairs(df):
        return df.select(F.concat(F.lit("p"), "l_partkey").alias("src"), F.concat(F.lit("s"), "l_suppkey").alias("tgt"))

    edges = audience.edge_tombstones(pairs(items))
    marked = audience.mark_edges(edges, pairs(items.where("l_returnflag = 'R'")))
    return marked.withColumn("outcome", F.when(F.col("dropped"), "dropped").otherwise("kept")).drop("dropped")


@query("job_history_select", """
WITH h AS (SELECT CAST(o_custkey AS VARCHAR) AS id, o_orderpriority AS seg, 'https://s3.amazonaws.com/jobs/' || o_orderkey AS uri, o_orderkey AS pos FROM orders),
     j AS (SELECT CAST(c_custkey AS VARCHAR) AS id FROM customer WHERE c_mktsegment <> 'BUILDING')
SELECT label, base_uri FROM (SELECT id || '-' || seg AS label, uri AS base_uri, row_number() OVER (PARTITION BY id, seg ORDER BY pos DESC) AS rn
 FROM h WHERE id IN (SELECT id FROM j)) WHERE rn = 1
""")
def job_history_select(spark, d):
    body = F.to_json(
        F.struct(
            F.col("o_custkey").cast("string").alias("id"),
            F.struct(F.struct(F.col("o_orderpriority").alias("segment")).alias("selection")).alias("job_submission"),
            F.struct(F.concat(F.lit("https://s3.amazonaws.com/jobs/"), "o_orderkey").alias("base_uri")).alias("export_submission"),
        )
    )
    docs = table(spark, d, "orders").select(F.from_json(body, readers.HISTORY_SCHEMA).alias("h"), F.col("o_orderkey").alias("pos"))
    jobs = table(spark, d, "customer").where("c_mktsegment <> 'BUILDING'").select(F.col("c_custkey").cast("string").alias("id"))
    return readers.select_jobs(docs.select("h.*", "pos"), jobs)


@query("uri_split", """
SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) AS bucket, regexp_extract(url, '^https?://[^/]+/([^?#]*)', 1) AS path FROM pages
""")
def uri_split(spark, d):
    host = F.regexp_extract("url", "^https?://([^/]+)", 1)
    path = F.regexp_extract("url", "^https?://[^/]+/([^?#]*)", 1)
    by_host = F.concat(F.lit("https://"), host, F.lit(".s3.amazonaws.com/"), path)
    in_path = F.concat(F.lit("https://s3.amazonaws.com/"), host, F.lit("/"), path)
    uri = F.when(F.col("page_id") % 2 == 0, by_host).otherwise(in_path)
    return table(spark, d, "pages").select("page_id", readers.split_object_uri(uri).alias("o")).select("page_id", "o.*")
