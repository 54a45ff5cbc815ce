"""Round trips through stored tables and files in the shared folder: written, changed, read back."""

import uuid

from pyspark.sql import functions as F

from ..functions.exprs import csv_line
from ..operators import audience, identity
from ..runtime import shared_dir
from ..sources import exports, readers, sinks
from ..sources.keyed import KeyedTable
from .audience_plans import codes, incoming
from .catalog import query, table
from .drift_plans import HALVES, halves


def place(spark) -> str:
    return f"{shared_dir(spark)}/tallywright/store-{uuid.uuid4().hex}"


def audience_table(spark, d) -> KeyedTable:
    """Labels of the earlier half of the orders, stored by id."""
    store = KeyedTable(spark, place(spark), "id long, labels array<string>", buckets=16)
    labels = halves(spark, d)[0].select(F.col("o_custkey").alias("id"), F.substring("o_orderpriority", 3, 100).alias("label"))
    store.upsert(labels.groupBy("id").agg(F.array_sort(F.collect_set("label")).alias("labels")))
    return store


@query("audience_store", HALVES + """
, u AS (SELECT DISTINCT o_custkey AS id, substr(o_orderpriority, 3) AS label FROM n UNION SELECT o_custkey, substr(o_orderpriority, 3) FROM o)
SELECT id, string_agg(label, ',' ORDER BY label) AS labels FROM u GROUP BY 1
""")
def audience_store(spark, d):
    """Every stored id after the later half was merged in, twice."""
    store = audience_table(spark, d)
    for _ in range(2):
        audience.store_merged(store, incoming(spark, d), codes(spark, d))
    return store.read().withColumn("labels", F.array_join("labels", ","))


@query("tag_store", """
SELECT c_custkey AS id, lower(c_mktsegment) || CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 200000) THEN ',~big' ELSE '' END AS tags FROM customer
""")
def tag_store(spark, d):
    store = KeyedTable(spark, place(spark), "id long, tags array<string>", buckets=16)
    store.upsert(table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.array(F.lower("c_mktsegment")).alias("tags")))
    chosen = table(spark, d, "orders").where("o_totalprice > 200000").select(F.col("o_custkey").alias("id"))
    for _ in range(2):
        audience.store_tag(store, chosen, "~big")
    return store.read().withColumn("tags", F.array_join("tags", ","))


def cells(spark, d):
    """Events as cells: the type is the attribute."""
    e = table(spark, d, "events")
    return e.select(F.col("user_id").alias("key"), F.col("event_type").alias("attr"), F.col("event_id").alias("value"), "ts")


@query("cells_stored", "SELECT user_id AS key, min_by(event_id, struct_pack(a := ts, b := event_id)) AS value FROM events WHERE event_type = 'purchase' GROUP BY 1")
def cells_stored(spark, d):
    """The first cell of one attribute of each key, read from a table laid out by attribute."""
    at = place(spark)
    sinks.write_cells(cells(spark, d), at)
    stored = spark.read.schema("key long, value long, ts timestamp, attr string").parquet(at)
    return identity.dump_lookup(stored, "purchase", tie="value")


@query("dated_latest", "SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, o_orderstatus FROM orders WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)")
def dated_latest(spark, d):
    """The newest of several dated snapshots, found by its folder's name."""
    base = place(spark)
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("y"))
    top = orders.agg(F.max("y")).first()[0]
    for y in (top - 1, top, top - 2):
        sinks.write_dated(orders.where(F.col("y") == y).drop("y"), base, f"{y}0101")
    return spark.read.parquet(readers.resolve_dated(spark, base))


@query("text_round_trip", "SELECT CAST(p_partkey AS VARCHAR) AS k, p_name AS name, p_brand AS brand FROM part")
def text_round_trip(spark, d):
    """Comma-separated lines, spread over files, read back by position."""
    at = place(spark)
    sinks.write_text(table(spark, d, "part").select("p_partkey", "p_name", "p_brand"), at, n_files=4)
    return readers.read_positional(spark, at, ["k", "name", "brand"])


@query("csv_round_trip", "SELECT CAST(s_suppkey AS BIGINT) AS s_suppkey, s_name, CAST(s_acctbal AS DOUBLE) AS s_acctbal FROM supplier")
def csv_round_trip(spark, d):
    at = place(spark)
    sinks.write_csv(table(spark, d, "supplier").select("s_suppkey", "s_name", "s_acctbal"), at)
    return readers.read_typed_csv(spark, at, "s_suppkey long, s_name string, s_acctbal double")


@query("header_round_trip", "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus FROM orders")
def header_round_trip(spark, d):
    """Names from a header file of its own, data without a header and with one field more than named."""
    at, orders = place(spark), table(spark, d, "orders")
    spark.createDataFrame([("o_orderkey,o_orderstatus",)], "value string").coalesce(1).write.text(f"{at}/header")
    sinks.write_text(orders.select("o_orderkey", "o_orderstatus", "o_custkey"), f"{at}/data")
    return readers.read_with_header_file(spark, f"{at}/data", f"{at}/header")


@query("arity_round_trip", """
SELECT CAST(l_orderkey AS VARCHAR) AS k, l_returnflag || l_linestatus AS mode, false AS rejected FROM lineitem WHERE l_linenumber > 1
UNION ALL SELECT CAST(l_orderkey AS VARCHAR), NULL, true FROM lineitem WHERE l_linenumber = 1
""")
def arity_round_trip(spark, d):
    """Fields between bars, commas inside them dropped; lines with fewer fields than named are kept apart."""
    at, li = place(spark), table(spark, d, "lineitem")
    key, more = F.col("l_orderkey").cast("string"), F.concat_ws("|", "l_orderkey", F.concat_ws(",", "l_returnflag", "l_linestatus"), "l_partkey")
    li.select(F.when(F.col("l_linenumber") > 1, more).otherwise(key).alias("value")).write.text(at)
    good, rejects = readers.read_fixed_arity(spark, at, ["k", "mode"])
    none = F.lit(None).cast("string")
    return good.withColumn("rejected", F.lit(False)).unionByName(rejects.select(F.col("line").alias("k"), none.alias("mode"), F.lit(True).alias("rejected")))


@query("report_round_trip", "SELECT o_orderpriority AS priority, CAST(count(*) AS VARCHAR) AS n FROM orders GROUP BY 1")
def report_round_trip(spark, d):
    at = place(spark)
    sinks.write_report(table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("priority")).agg(F.count(F.lit(1)).alias("n")), at)
    return spark.read.option("header", True).option("escape", '"').csv(at)


@query("export_jobs", """
SELECT 'job' || substr(o_orderpriority, 1, 1) || '-' || substr(o_orderpriority, 3) AS name, CAST(o_orderkey AS VARCHAR) || ',' || o_orderstatus AS value
FROM orders WHERE substr(o_orderpriority, 1, 1) IN ('1', '3', '5')
""")
def export_jobs(spark, d):
    """Lines of three of the jobs in a history, each from its own folder to one folder per label."""
    at, host = place(spark), readers.OBJECT_HOST
    p = F.col("o_orderpriority")
    orders = table(spark, d, "orders").withColumn("i", F.substring(p, 1, 1))
    lines = orders.select(csv_line("o_orderkey", "o_orderstatus").alias("value"), F.concat(F.lit("part"), "i").alias("folder"))
    lines.write.partitionBy("folder").text(f"{at}/objects/store")
    jobs = orders.select("i", F.substring(p, 3, 100).alias("segment")).distinct()
    doc = F.struct(
        F.concat(F.lit("job"), "i").alias("id"),
        F.struct(F.struct("segment").alias("selection")).alias("job_submission"),
        F.struct(F.concat(F.lit(f"http://store.{host}/folder=part"), "i").alias("base_uri")).alias("export_submission"),
    )
    jobs.select(F.to_json(doc).alias("value")).agg(F.concat(F.lit("["), F.array_join(F.collect_list("value"), ","), F.lit("]")).alias("value")).write.text(f"{at}/history")
    listed = spark.createDataFrame([("job1",), ("job3",), ("job5",)], "id string")
    exports.export_jobs(readers.read_history(spark, f"{at}/history"), listed, f"{at}/objects", f"{at}/out")
    return spark.read.schema("value string, name string").text(f"{at}/out").select("name", "value")


def _send(text: str) -> None:
    if text.endswith("7"):
        raise ValueError(text)


@query("delivery_ledger", """
SELECT CASE WHEN c_custkey % 10 = 7 THEN 'failure' ELSE 'success' END AS outcome, CAST(CASE WHEN c_custkey % 10 = 7 THEN 2 ELSE 1 END AS BIGINT) AS sent,
 CAST(count(*) AS BIGINT) AS payloads FROM customer GROUP BY 1, 2
""")
def delivery_ledger(spark, d):
    """Two runs over the same payloads: the second sends only what the first could not."""
    at = f"{place(spark)}/ledger"
    payloads = table(spark, d, "customer").select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("payload"))
    runs = [sinks.deliver_once(payloads, _send, at) for _ in range(2)]
    per = runs[0].unionByName(runs[1]).groupBy("payload", "outcome").agg(F.count(F.lit(1)).alias("sent"))
    return per.groupBy("outcome", "sent").agg(F.count(F.lit(1)).alias("payloads"))
