"""Attribute cells = events: key is user and day, attribute the event type, value the whole part of the value."""

from pyspark.sql import functions as F

from ..operators import identity
from .catalog import query, table


def cells(spark, d):
    return table(spark, d, "events").select(
        F.concat_ws("@", F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd")).alias("key"),
        F.col("event_type").alias("attr"),
        F.floor("value").cast("string").alias("value"),
        "ts",
        "event_id",
    )


CELLS = """
WITH c AS (SELECT user_id || '@' || strftime(ts, '%Y-%m-%d') AS key, event_type AS attr,
                  CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS value, ts, event_id FROM events)
"""


@query("cells_scan", CELLS + "SELECT key, value, ts FROM c WHERE attr = 'click'")
def cells_scan(spark, d):
    return identity.scan_cells(cells(spark, d), "click").select("key", "value", "ts")


@query("cells_dump_lookup", CELLS + "SELECT key, value FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY ts, event_id) AS rn FROM c WHERE attr = 'view') WHERE rn = 1")
def cells_dump_lookup(spark, d):
    return identity.dump_lookup(cells(spark, d), "view", tie="event_id")


@query("latest_per_key", CELLS + "SELECT key, value, ts FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY ts DESC, event_id DESC) AS rn FROM c WHERE attr = 'click') WHERE rn = 1")
def latest_per_key(spark, d):
    return identity.latest_per_key(identity.scan_cells(cells(spark, d), "click"), tie="event_id")


@query("earliest_per_key", CELLS + "SELECT key, value, ts FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY ts, event_id) AS rn FROM c WHERE attr = 'click') WHERE rn = 1")
def earliest_per_key(spark, d):
    return identity.earliest_per_key(identity.scan_cells(cells(spark, d), "click"), tie="event_id")


@query("ids_duplicate", CELLS + """
, l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY ts DESC, event_id DESC) AS rn FROM c WHERE attr = 'click') WHERE rn = 1)
SELECT value, key, ts FROM l AS x WHERE EXISTS (SELECT 1 FROM l AS y WHERE y.value = x.value AND y.key <> x.key)
""")
def ids_duplicate(spark, d):
    return identity.duplicate_ids(cells(spark, d), "click", tie="event_id")


@query("ids_recycled", CELLS + """
SELECT key, value, ts, CAST(n AS BIGINT) AS n_cells FROM (SELECT *, count(*) OVER (PARTITION BY key) AS n FROM c WHERE attr = 'signup') WHERE n > 1
""")
def ids_recycled(spark, d):
    return identity.recycled_ids(cells(spark, d), "signup")


@query("ids_recycled_counts", CELLS + """
SELECT CAST(count(*) AS BIGINT) AS records, CAST(count(*) FILTER (n > 1) AS BIGINT) AS hits FROM (SELECT key, count(*) AS n FROM c WHERE attr = 'signup' GROUP BY 1)
""")
def ids_recycled_counts(spark, d):
    return identity.recycled_counts(cells(spark, d), "signup")


ROLES = {"followers": "view", "tweets": "click", "tags": "signup", "good_tags": ["3", "5", "7", "11"], "tie": "event_id"}


def _activity_sql(extra: str) -> str:
    return CELLS + f"""
, k AS (SELECT DISTINCT key FROM c),
  q AS (SELECT k.key,
    coalesce((SELECT CAST(v.value AS BIGINT) FROM c AS v WHERE v.key = k.key AND v.attr = 'view' ORDER BY v.ts, v.event_id LIMIT 1), 0) AS n_followers,
    CAST((SELECT count(*) FROM c AS w WHERE w.key = k.key AND w.attr = 'click'{extra}) AS BIGINT) AS n_tweets,
    EXISTS (SELECT 1 FROM c AS g WHERE g.key = k.key AND g.attr = 'signup' AND g.value IN ('3', '5', '7', '11')) AS tagged FROM k)
SELECT key, n_followers, n_tweets, tagged, (n_followers >= 8 OR n_tweets >= 2 OR tagged) AS active FROM q
"""


@query("activity_qualify", _activity_sql(""))
def activity_qualify(spark, d):
    c = cells(spark, d)
    return identity.qualify_activity(c.select("key"), c, min_followers=8, **ROLES)


@query("activity_qualify_recent", _activity_sql(" AND w.ts > TIMESTAMP '2024-01-16'"))
def activity_qualify_recent(spark, d):
    c = cells(spark, d)
    now = F.lit("2025-01-16").cast("timestamp")
    return identity.qualify_activity(c.select("key"), c, min_followers=8, now=now, recent_only=True, **ROLES)


@query("activity_route", "SELECT key, CASE WHEN active THEN 'exist' ELSE 'not_found' END AS route FROM (" + _activity_sql("") + ")")
def activity_route(spark, d):
    return identity.activity_route(activity_qualify(spark, d))


@query("lookup_batch_left", """
SELECT p.p_partkey AS id, coalesce(c.c_name, '') AS name, c.c_mktsegment AS segment FROM part AS p LEFT JOIN customer AS c ON c.c_custkey = p.p_partkey
""")
def lookup_batch_left(spark, d):
    return _lookup(spark, d, True)


@query("lookup_batch_semi", """
SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer WHERE c_custkey IN (SELECT p_partkey FROM part)
""")
def lookup_batch_semi(spark, d):
    return _lookup(spark, d, False)


def _lookup(spark, d, keep):
    keys = table(spark, d, "part").select(F.col("p_partkey").alias("id"))
    store = table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    return identity.lookup_batch(keys, store, "id", ["name", "segment"], {"name": ""}, keep)


@query("lookup_collect_set", """
SELECT DISTINCT p.p_partkey AS id, o.o_orderpriority AS value FROM part AS p LEFT JOIN orders AS o ON o.o_custkey = p.p_partkey
""")
def lookup_collect_set(spark, d):
    keys = table(spark, d, "part").select(F.col("p_partkey").alias("id"))
    docs = table(spark, d, "orders").select(F.col("o_custkey").alias("id"), "o_orderpriority")
    return identity.collect_lookup(keys, docs, "id", "o_orderpriority")
