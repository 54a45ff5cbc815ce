"""Snapshots = the orders before and after the middle of the period; records = the last order of a customer."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import drift, rules
from .catalog import query, table

MIDDLE = "1998-04-15"


def halves(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, d, "orders")
    return orders.where(F.col("o_orderdate") < F.lit(MIDDLE).cast("timestamp")), orders.where(
        F.col("o_orderdate") >= F.lit(MIDDLE).cast("timestamp")
    )


def last_orders(orders: DataFrame) -> DataFrame:
    fields = F.struct(
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
        F.when(F.col("o_totalprice") > 250000, "Y").otherwise("N").alias("big"),
        F.when(F.month("o_orderdate") > 6, "Y").otherwise("N").alias("late"),
    )
    best = orders.groupBy(F.col("o_custkey").alias("id")).agg(
        F.max(F.struct("o_orderdate", "o_orderkey", fields.alias("f"))).alias("m")
    )
    return best.select("id", "m.f.*").withColumn("flags", F.concat("big", "late"))


def order_dictionary(spark: SparkSession, d: str) -> DataFrame:
    """Labels for two of the statuses and all priorities, so other codes stay unknown."""
    orders = table(spark, d, "orders")

    def rows(title, field, col, name, keep):
        return orders.where(keep).select(
            F.lit(title).alias("title"), F.lit(field).alias("field"), col.alias("value"), name.alias("value_name"), F.lit("Demog").alias("category")
        )

    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    return (
        rows("Order status", "status", status, F.concat(F.lit("Status "), status), status.isin("F", "O"))
        .unionByName(rows("Order priority", "priority", priority, F.substring(priority, 3, 100), priority.isNotNull()))
        .unionByName(rows("Flags", "flags", F.lit("-"), F.lit("-"), priority.isNotNull()))
        .distinct()
    )


def fixed_records(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Per customer and priority the last order key of each status as text, blank when none."""
    grid = table(spark, d, "customer").select(
        "c_custkey", "c_mktsegment", F.explode(F.array(*[F.lit(str(i)) for i in range(1, 6)])).alias("prio")
    )

    def side(orders):
        wide = orders.groupBy(F.col("o_custkey").alias("c_custkey"), F.substring("o_orderpriority", 1, 1).alias("prio")).agg(
            *[F.max(F.when(F.col("o_orderstatus") == s, F.col("o_orderkey"))).cast("string").alias(s) for s in "FOP"]
        )
        return grid.join(wide, ["c_custkey", "prio"], "left").select(
            F.concat_ws("/", "c_custkey", "prio").alias("id"),
            *[F.coalesce(s, F.lit("")).alias(s) for s in "FOP"],
            F.col("c_mktsegment").alias("segment"),
        )

    old, new = halves(spark, d)
    return side(old), side(new)


HALVES = f"""
WITH o AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '{MIDDLE}'),
     n AS (SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '{MIDDLE}')
"""

PAIRS = HALVES + """
, po AS (SELECT o_custkey AS k, list(DISTINCT o_orderpriority ORDER BY o_orderpriority) AS s FROM o GROUP BY 1),
  pn AS (SELECT o_custkey AS k, list(DISTINCT o_orderpriority ORDER BY o_orderpriority) AS s FROM n GROUP BY 1),
  st AS (SELECT coalesce(po.k, pn.k) AS o_custkey,
                CASE WHEN po.k IS NULL THEN 'added' WHEN pn.k IS NULL THEN 'deleted'
                     WHEN po.s = pn.s THEN 'constant' ELSE 'changed' END AS status
         FROM po FULL JOIN pn ON po.k = pn.k)
"""


@query("drift_pairs_status", PAIRS + "SELECT o_custkey, status FROM st")
def drift_pairs_status(spark, d):
    return drift.drift_pairs(*halves(spark, d), "o_custkey", "o_orderpriority")


@query("drift_pairs_summary", PAIRS + """
SELECT s.status, CAST((SELECT count(*) FROM st WHERE st.status = s.status) AS BIGINT) AS n
FROM (VALUES ('added'), ('deleted'), ('constant'), ('changed')) AS s(status)
""")
def drift_pairs_summary(spark, d):
    return drift.drift_pairs_summary(*halves(spark, d), "o_custkey", "o_orderpriority")


@query("drift_distribution", HALVES + """
, co AS (SELECT o_custkey || ':' || o_orderpriority AS key, count(*) AS c FROM o GROUP BY 1),
  cn AS (SELECT o_custkey || ':' || o_orderpriority AS key, count(*) AS c FROM n GROUP BY 1),
  b AS (SELECT coalesce(co.key, cn.key) AS key, coalesce(co.c, 0) AS a, coalesce(cn.c, 0) AS z FROM co FULL JOIN cn ON co.key = cn.key)
SELECT key, CAST(a AS DOUBLE) AS old_count, CAST(z AS DOUBLE) AS new_count, CAST(z - a AS DOUBLE) AS diff,
       CASE WHEN a = 0 THEN 'Infinity' ELSE printf('%.2f', CAST(round(CAST((z - a) * 100.0 / a AS DECIMAL(24,8)), 2) AS DOUBLE)) END AS pct,
       CASE WHEN a = 0 THEN 'Infinity' ELSE printf('%.2f', abs(CAST(round(CAST((z - a) * 100.0 / a AS DECIMAL(24,8)), 2) AS DOUBLE))) END AS abs_pct
FROM b
""")
def drift_distribution(spark, d):
    def side(orders):
        key = F.concat_ws(":", F.col("o_custkey").cast("string"), "o_orderpriority")
        return orders.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("cnt"))

    old, new = halves(spark, d)
    out = drift.drift_distribution(side(old), side(new), "key", "cnt")
    for c in ("pct", "abs_pct"):
        finite = ~F.isnan(c) & (F.abs(c) != float("inf"))
        out = out.withColumn(c, F.when(finite, F.format_string("%.2f", c)).otherwise(F.col(c).cast("string")))
    return out


RECORDS = HALVES + """
, ro AS (SELECT * FROM (SELECT o_custkey AS id, o_orderstatus AS status, o_orderpriority AS priority,
           CASE WHEN o_totalprice > 250000 THEN 'Y' ELSE 'N' END AS big, CASE WHEN month(o_orderdate) > 6 THEN 'Y' ELSE 'N' END AS late,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM o) WHERE rn = 1),
  rn AS (SELECT * FROM (SELECT o_custkey AS id, o_orderstatus AS status, o_orderpriority AS priority,
           CASE WHEN o_totalprice > 250000 THEN 'Y' ELSE 'N' END AS big, CASE WHEN month(o_orderdate) > 6 THEN 'Y' ELSE 'N' END AS late,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM n) WHERE rn = 1),
  j AS (SELECT coalesce(ro.id, rn.id) AS id, ro.id AS oid, rn.id AS nid, ro.status AS os, rn.status AS ns,
               ro.priority AS op, rn.priority AS np, ro.big AS ob, rn.big AS nb, ro.late AS ol, rn.late AS nl
        FROM ro FULL JOIN rn ON ro.id = rn.id),
  f AS (SELECT id, 'Order status' AS field_label, CASE WHEN os IN ('F', 'O') THEN 'Status ' || os ELSE 'Unk' END AS old_label,
               CASE WHEN ns IN ('F', 'O') THEN 'Status ' || ns ELSE 'Unk' END AS new_label
        FROM j WHERE oid IS NOT NULL AND nid IS NOT NULL AND os <> ns
        UNION ALL
        SELECT id, 'Order priority', substr(op, 3), substr(np, 3) FROM j WHERE oid IS NOT NULL AND nid IS NOT NULL AND op <> np
        UNION ALL
        SELECT id, 'big', ob, nb FROM j WHERE oid IS NOT NULL AND nid IS NOT NULL AND ob <> nb
        UNION ALL
        SELECT id, 'late', ol, nl FROM j WHERE oid IS NOT NULL AND nid IS NOT NULL AND ol <> nl)
"""


RECORD_COUNTS = RECORDS + """
SELECT 'added' AS status, CAST(count(*) FILTER (oid IS NULL) AS BIGINT) AS n FROM j
UNION ALL SELECT 'deleted', count(*) FILTER (nid IS NULL) FROM j
UNION ALL SELECT 'constant', count(*) FILTER (os = ns AND op = np AND ob = nb AND ol = nl) FROM j
UNION ALL SELECT 'changed', count(*) FILTER (oid IS NOT NULL AND nid IS NOT NULL AND NOT (os = ns AND op = np AND ob = nb AND ol = nl)) FROM j
UNION ALL SELECT 'in_both', count(*) FILTER (oid IS NOT NULL AND nid IS NOT NULL) FROM j
"""


@query("drift_records_summary", RECORD_COUNTS)
def drift_records_summary(spark, d):
    old, new = halves(spark, d)
    return drift.drift_records_summary(last_orders(old), last_orders(new), "id")


@query("drift_records_counters", f"SELECT status AS counter, n FROM ({RECORD_COUNTS})")
def drift_records_counters(spark, d):
    """The counters that the job writing the status of every key makes."""
    old, new = halves(spark, d)
    return drift.drift_records_counted(last_orders(old), last_orders(new), "id").stored()[1]


@query("drift_fields", RECORDS + "SELECT id, field_label, old_label, new_label FROM f")
def drift_fields(spark, d):
    old, new = halves(spark, d)
    return drift.drift_fields(
        last_orders(old), last_orders(new), "id", order_dictionary(spark, d), expand={"flags": ["big", "late"]}
    )


@query("drift_field_counts", RECORDS + "SELECT field_label, old_label, new_label, CAST(count(*) AS BIGINT) AS n FROM f GROUP BY 1, 2, 3")
def drift_field_counts(spark, d):
    old, new = halves(spark, d)
    return drift.transition_counts(
        last_orders(old), last_orders(new), "id", order_dictionary(spark, d), expand={"flags": ["big", "late"]}
    )


CHECKS = [
    ("event_type = 'click' AND value > 50", 5.0),
    ("event_type = 'view'", -10.0),
    ("value < 0", 0.0),
    ("event_type = 'purchase' OR value BETWEEN 10 AND 20", 50.0),
    ("value > 5", -50.0),
]


def _checks_sql() -> str:
    parts = []
    for p, limit in CHECKS:
        text = p.replace("'", "''")
        parts.append(f"SELECT '{text}' AS predicate, CAST({limit} AS DOUBLE) AS allowed_pct, count(*) FILTER (half = 0 AND ({p})) AS a, count(*) FILTER (half = 1 AND ({p})) AS z FROM e")
    return (
        "WITH e AS (SELECT *, CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 0 ELSE 1 END AS half FROM events), c AS ("
        + " UNION ALL ".join(parts)
        + """)
SELECT predicate, CAST(a AS BIGINT) AS old_count, CAST(z AS BIGINT) AS new_count,
       CASE WHEN a = 0 AND z = 0 THEN 'NaN' WHEN a = 0 THEN 'Infinity'
            ELSE printf('%.2f', CAST(round(CAST((z - a) * 100.0 / a AS DECIMAL(24,8)), 2) AS DOUBLE)) END AS pct,
       allowed_pct,
       CASE WHEN a = 0 THEN z > 0 ELSE round((z - a) * 100.0 / a, 2) > allowed_pct END AS flagged
FROM c"""
    )


@query("regression_check", _checks_sql())
def regression_check(spark, d):
    events = table(spark, d, "events")
    cut = F.lit("2024-01-16").cast("timestamp")
    out = drift.regression_check(events.where(F.col("ts") < cut), events.where(F.col("ts") >= cut), CHECKS)
    finite = ~F.isnan("pct") & (F.abs("pct") != float("inf"))
    return out.withColumn("pct", F.when(finite, F.format_string("%.2f", "pct")).otherwise(F.col("pct").cast("string")))


SPARSE = HALVES + """
, g AS (SELECT c.c_custkey AS k, p.p FROM customer AS c CROSS JOIN (VALUES ('1'), ('2'), ('3'), ('4'), ('5')) AS p(p)),
  eo AS (SELECT DISTINCT o_custkey AS k, substr(o_orderpriority, 1, 1) AS p FROM o),
  en AS (SELECT DISTINCT o_custkey AS k, substr(o_orderpriority, 1, 1) AS p FROM n)
"""


@query("records_empty", SPARSE + "SELECT g.k || '/' || g.p AS id FROM g WHERE NOT EXISTS (SELECT 1 FROM en WHERE en.k = g.k AND en.p = g.p)")
def records_empty(spark, d):
    return drift.empty_records(fixed_records(spark, d)[1], "id")


@query("records_nonempty", SPARSE + "SELECT k || '/' || p AS id FROM eo")
def records_nonempty(spark, d):
    return drift.nonempty_records(fixed_records(spark, d)[0], "id")


@query("records_newly_empty", SPARSE + "SELECT k || '/' || p AS id FROM eo WHERE NOT EXISTS (SELECT 1 FROM en WHERE en.k = eo.k AND en.p = eo.p)")
def records_newly_empty(spark, d):
    old, new = fixed_records(spark, d)
    return drift.newly_empty(new, old, "id")


# Coded household fields shaped from the line items
HOUSEHOLD = {
    "k_gender": "CASE WHEN l_linestatus = 'F' THEN 'F' ELSE 'M' END",
    "k_hh_composition": "substr('ABCDEFGHIJKL', CAST(1 + (l_linenumber * 5 + CAST(l_quantity AS INT)) % 12 AS INT), 1)",
    "k_children_present": "CASE l_returnflag WHEN 'A' THEN 'Y' WHEN 'R' THEN 'N' ELSE '' END",
    "k_children_0_2": "CASE WHEN l_discount < 0.02 THEN 'Y' ELSE '' END",
    "k_children_3_5": "CASE WHEN l_tax < 0.02 THEN 'Y' ELSE '' END",
    "k_children_6_10": "CASE WHEN l_linenumber = 3 THEN 'Y' ELSE '' END",
    "k_children_11_15": "CASE WHEN l_quantity < 5 THEN 'Y' ELSE '' END",
    "k_children_16_18": "CASE WHEN l_suppkey < 10 THEN 'Y' ELSE '' END",
}

LABELLED = (
    "WITH h AS (SELECT *, " + ", ".join(f"{e} AS {n}" for n, e in HOUSEHOLD.items()) + " FROM lineitem), c AS (SELECT *, CASE "
    "WHEN k_gender = 'F' AND k_hh_composition = 'J' THEN 'code1' WHEN k_gender = 'F' AND k_hh_composition = 'I' THEN 'code2' "
    "WHEN k_gender = 'M' AND k_hh_composition = 'L' THEN 'code3' WHEN k_gender = 'M' AND k_hh_composition = 'K' THEN 'code4' "
    "WHEN k_children_present = 'Y' AND k_hh_composition IN ('B', 'D', 'F', 'H', 'J', 'L') "
    "THEN 'code' || (5 + list_position(['B', 'D', 'F', 'H', 'J', 'L'], k_hh_composition) - 1) "
    "WHEN k_children_present = '' AND k_children_0_2 = 'Y' THEN 'code11' WHEN k_children_present = '' AND k_children_3_5 = 'Y' THEN 'code12' "
    "WHEN k_children_present = '' AND k_children_6_10 = 'Y' THEN 'code13' WHEN k_children_present = '' AND k_children_11_15 = 'Y' THEN 'code14' "
    "WHEN k_children_present = '' AND k_children_16_18 = 'Y' THEN 'code15' ELSE 'perfect' END AS label FROM h) "
)


def households(spark, d):
    return table(spark, d, "lineitem").withColumns({n: F.expr(e) for n, e in HOUSEHOLD.items()})


@query("classify_rules", LABELLED + "SELECT l_orderkey, l_partkey, l_linenumber, label FROM c")
def classify_rules(spark, d):
    return rules.classify(households(spark, d), rules.conflict_rules()).select("l_orderkey", "l_partkey", "l_linenumber", "label")


@query("classify_counts", LABELLED + "SELECT label, CAST(count(*) AS BIGINT) AS n FROM c GROUP BY 1")
def classify_counts(spark, d):
    return rules.classify(households(spark, d), rules.conflict_rules()).groupBy("label").agg(F.count(F.lit(1)).alias("n"))
