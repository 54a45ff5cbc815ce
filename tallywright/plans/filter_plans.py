"""Ready-made filters and dated partitions over events and orders."""

from datetime import datetime

from pyspark.sql import functions as F

from ..functions.exprs import chain
from ..operators import rules
from ..sources import readers
from .catalog import query, table


def dated(spark, d):
    return table(spark, d, "events").withColumn("dt", F.date_format("ts", "yyyyMMdd"))


@query("filter_window_days", "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-24' AND ts <= TIMESTAMP '2024-01-31'")
def filter_window_days(spark, d):
    out = rules.search_filter(table(spark, d, "events"), created="ts", window_days=7, now=F.lit("2024-01-31").cast("timestamp"))
    return out.select("event_id", "ts")


@query("filter_between", "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts <= TIMESTAMP '2024-01-20 12:30:00'")
def filter_between(spark, d):
    span = (datetime(2024, 1, 5, 17, 45), datetime(2024, 1, 20, 12, 30))
    return rules.search_filter(table(spark, d, "events"), created="ts", between=span).select("event_id", "ts")


@query("filter_conjunction", "SELECT event_id FROM events WHERE event_type = 'click' AND value >= 10 AND props IS NOT NULL AND user_id > 20")
def filter_conjunction(spark, d):
    e = table(spark, d, "events").withColumns({"tags": F.array(F.lit("all"), "event_type"), "known": F.col("user_id") > 20})
    out = rules.search_filter(e, tag=("tags", "click"), at_least=("value", 10), has="props", flag="known")
    return out.select("event_id")


@query("filter_not", "SELECT event_id FROM events WHERE NOT (event_type = 'click' OR value < 5)")
def filter_not(spark, d):
    return rules.reject(table(spark, d, "events"), "event_type = 'click' OR value < 5").select("event_id")


DATED = "WITH e AS (SELECT *, strftime(ts, '%Y%m%d') AS dt FROM events) "


@query("latest_partition", DATED + "SELECT event_id, dt FROM e WHERE dt = (SELECT max(dt) FROM e)")
def latest_partition(spark, d):
    return readers.latest_partition(dated(spark, d), "dt").select("event_id", "dt")


@query("nth_partition", DATED + "SELECT event_id, dt FROM e WHERE (SELECT count(DISTINCT x.dt) FROM e AS x WHERE x.dt > e.dt) = 3")
def nth_partition(spark, d):
    return readers.nth_partition(dated(spark, d), "dt", 3).select("event_id", "dt")


@query("partition_boundary", "SELECT CAST(date_trunc('month', min(o_orderdate)) AS DATE) AS boundary FROM orders")
def partition_boundary(spark, d):
    names = table(spark, d, "orders").select(F.concat(F.lit("orders-"), F.date_format("o_orderdate", "yyyy-MM")).alias("name"))
    return readers.partition_boundary(names, "name", "orders")


@query("chain_transforms", "SELECT event_type, CAST(count(*) AS BIGINT) AS n, round(sum(value), 2) AS total FROM events WHERE value >= 5 GROUP BY 1")
def chain_transforms(spark, d):
    return chain(
        table(spark, d, "events"),
        lambda x: x.where(F.col("value") >= 5),
        lambda x: x.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")),
        lambda x: x.withColumn("total", F.round("total", 2)),
    )
