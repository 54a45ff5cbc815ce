"""One profile document per event, with up to four profiles and some broken lines, all shaped from its columns."""

from pyspark.sql import functions as F

from ..operators import profiles
from ..runtime import compute_once
from .catalog import query, table

TYPES = ["click", "view", "add_to_cart", "purchase", "signup"]


def lines(spark, d):
    e = table(spark, d, "events").withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))
    eid, k = F.col("event_id"), F.col("k")

    def profile(j):
        type_ = F.get(F.array(*[F.lit(t) for t in TYPES]), ((k + j * F.col("user_id")) % 5).cast("int"))
        name = F.when((eid + j) % 7 == 0, F.lit("bad name!")).otherwise(F.concat(F.lit("@User_"), eid.cast("string"), F.lit("_"), j.cast("string")))
        return F.struct(
            F.when((k + j) % 11 != 0, type_).alias("type"),
            F.when((eid + j) % 2 != 0, name).alias("username"),
            F.when((eid + j) % 5 != 0, F.concat(F.lit("id"), eid.cast("string"))).alias("id"),
        )

    n = (k % 5).cast("int")
    found = F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), profile))
    e = compute_once(e, "event_id", "k", "value", F.coalesce(F.to_json(found), F.lit("[]")).alias("array"))
    array = F.col("array")
    doc = F.when(k % 17 == 0, F.lit('{"other": 1}')).when(k % 19 == 0, array).otherwise(F.concat(F.lit('{"socialProfiles": '), array, F.lit("}")))
    key = F.concat(F.lit("k"), eid.cast("string"))
    line = F.when(F.col("value") < 1, F.concat_ws("\t", F.lit("a"), key, doc)).otherwise(F.concat_ws("\t", F.lit("a"), F.lit("b"), key, doc))
    return e.select(line.alias("value"))


def parsed(spark, d):
    return profiles.parse_profiles(lines(spark, d))


DOCS = """
WITH e AS (SELECT *, CAST(regexp_extract(props, '(\\d+)', 1) AS BIGINT) AS k FROM events),
 doc AS (SELECT event_id, user_id, k, 'k' || event_id AS key,
   CASE WHEN value < 1 THEN 'bad_line' WHEN k % 17 = 0 THEN 'no_profiles' WHEN k % 19 = 0 THEN 'bad_json' ELSE 'ok' END AS status FROM e),
 p AS (SELECT doc.event_id, doc.key, j.j,
   CASE WHEN (k + j) % 11 <> 0 THEN list_extract(['click', 'view', 'add_to_cart', 'purchase', 'signup'], CAST((k + j * user_id) % 5 + 1 AS BIGINT)) END AS type,
   CASE WHEN (event_id + j) % 2 <> 0 THEN CASE WHEN (event_id + j) % 7 = 0 THEN 'bad name!' ELSE '@User_' || event_id || '_' || j END END AS username,
   CASE WHEN (event_id + j) % 5 <> 0 THEN 'id' || event_id END AS id
   FROM doc JOIN range(1, 5) AS j(j) ON j.j <= doc.k % 5 WHERE doc.status = 'ok'),
 t AS (SELECT DISTINCT event_id, coalesce(type, 'NONE') AS type FROM p),
 pairs AS (SELECT x.type AS type_a, y.type AS type_b FROM t AS x JOIN t AS y ON x.event_id = y.event_id AND x.type < y.type),
 tokens AS (SELECT 'records' AS token FROM doc UNION ALL SELECT coalesce(type, 'NONE') FROM p UNION ALL SELECT type_a || '-' || type_b FROM pairs
   UNION ALL SELECT 'has_' || type FROM t UNION ALL SELECT 'no-sp' FROM doc WHERE status = 'no_profiles'),
 hit AS (SELECT * FROM p WHERE type = 'click'),
 out AS (SELECT event_id, key, CASE WHEN username IS NOT NULL AND username <> 'bad name!' AND length(username) <= 16 THEN lower(substr(username, 2)) ELSE '' END AS handle,
   lower(coalesce(username, '')) AS raw_handle, coalesce(id, '') AS id, (username IS NULL AND id IS NULL) AS bare, id IS NULL AS no_id FROM hit)
"""


@query("profiles_parse", DOCS + """
SELECT CASE WHEN status <> 'bad_line' THEN key END AS key, status, CASE WHEN status = 'ok' THEN CAST(k % 5 AS BIGINT) END AS n_profiles FROM doc
""")
def profiles_parse(spark, d):
    n = F.when(F.col("status") == "ok", F.size("profiles").cast("bigint"))
    return parsed(spark, d).select("key", "status", n.alias("n_profiles"))


@query("profile_token_counts", DOCS + "SELECT token, CAST(count(*) AS BIGINT) AS n FROM tokens GROUP BY 1")
def profile_token_counts(spark, d):
    return profiles.profile_token_counts(parsed(spark, d))


@query("profile_pair_counts", DOCS + "SELECT type_a, type_b, CAST(count(*) AS BIGINT) AS n FROM pairs GROUP BY 1, 2")
def profile_pair_counts(spark, d):
    return profiles.profile_pair_counts(parsed(spark, d))


@query("profile_token_percent", DOCS + """
SELECT 'per_' || token AS token, round(count(*) * 100.0 / (SELECT count(*) FROM doc), 6) AS pct FROM tokens WHERE contains(token, '_') GROUP BY token
""")
def profile_token_percent(spark, d):
    return profiles.token_percent(profile_token_counts(spark, d)).withColumn("pct", F.round("pct", 6))


@query("profile_extract", DOCS + """
SELECT key, handle, id FROM out WHERE NOT bare UNION ALL
SELECT key, '', '' FROM doc WHERE status = 'ok' AND NOT EXISTS (SELECT 1 FROM out WHERE out.event_id = doc.event_id AND NOT out.bare)
""")
def profile_extract(spark, d):
    return profiles.extract_profiles(parsed(spark, d), "click")


@query("profile_extract_lenient", DOCS + "SELECT key, raw_handle AS handle, id FROM out")
def profile_extract_lenient(spark, d):
    return profiles.extract_profiles(parsed(spark, d), "click", lenient=True)


COUNTERS = DOCS + """
, n AS (SELECT doc.event_id, (SELECT count(*) FROM out WHERE out.event_id = doc.event_id AND NOT bare) AS c FROM doc WHERE status = 'ok')
SELECT 'records' AS counter, CAST(count(*) AS BIGINT) AS n FROM doc UNION ALL SELECT 'no_profiles', count(*) FROM doc WHERE status = 'no_profiles'
UNION ALL SELECT 'of_type', count(*) FROM hit UNION ALL SELECT 'other_type', count(*) FROM p WHERE type IS NULL OR type <> 'click'
UNION ALL SELECT 'tuples', count(*) FROM out WHERE NOT bare UNION ALL SELECT 'with_0', count(*) FROM n WHERE c = 0
UNION ALL SELECT 'with_1', count(*) FROM n WHERE c = 1 UNION ALL SELECT 'with_2', count(*) FROM n WHERE c = 2
UNION ALL SELECT 'with_n', count(*) FROM n WHERE c > 2 UNION ALL SELECT 'no_id', count(*) FROM out WHERE NOT bare AND no_id
"""


@query("profile_counters", COUNTERS)
def profile_counters(spark, d):
    return profiles.profile_counters(parsed(spark, d), "click")


@query("profile_extract_counters", COUNTERS)
def profile_extract_counters(spark, d):
    """The counters that the job writing the extracted rows makes."""
    return profiles.extract_counted(parsed(spark, d), "click").stored()[1]


@query("dictionary_flatten", """
WITH b AS (SELECT DISTINCT p_brand, p_type, CAST(substr(p_brand, 7) AS BIGINT) AS i FROM part),
r AS (SELECT CASE WHEN i % 2 = 0 THEN 'Brand of ' || i ELSE 'Title ' || p_brand END AS title, lower(replace(p_brand, '#', '_')) AS field, p_type AS value,
 'Type ' || p_type AS value_name, i % 3 = 0 AS displayable, CASE WHEN i % 5 = 0 THEN 'Indiv' ELSE 'Demog' END AS category, 'standard' AS source, CASE WHEN i % 4 = 0 THEN 'child_a,child_b' ELSE '' END AS children FROM b
 UNION ALL SELECT 'State', 'g_state', 'state', 'state', true, 'Geo', 'standard', '' UNION ALL SELECT 'Metro Area', 'residence_metro_area', 'metro_area', 'metro_area', true, 'Geo', 'standard', ''
 UNION ALL SELECT 'DMA', 'g_dma_code', CAST(n_nationkey AS VARCHAR), n_name || ', region ' || n_regionkey, true, 'Geo', 'standard', '' FROM nation)
SELECT title, field, value, value_name, displayable, category, source, children FROM r
""")
def dictionary_flatten(spark, d):
    i = F.substring("p_brand", 7, 10).cast("bigint")
    none = F.lit(None).cast("string")
    entry = F.struct(
        F.when(i % 2 == 0, F.concat(F.lit("brand_of_"), i.cast("string"))).alias("name"),
        F.concat(F.lit(" Title "), "p_brand").alias("title"),
        F.when(i % 3 == 0, F.array(F.lit("web"), F.lit(" excel_xml "))).alias("displayable"),
        F.when(i % 5 == 0, none).otherwise(F.lit(" Demog ")).alias("category"),
        F.when(i % 4 == 0, F.array(F.lit(" child_a"), F.lit("child_b "))).alias("children"),
        F.lit("standard").alias("datasource"),
        F.col("list"),
    )
    values = F.struct(F.concat(F.lit("Type "), "p_type", F.lit(" ")).alias("title"), F.concat(F.lit(" "), "p_type").alias("value"))
    brands = table(spark, d, "part").groupBy("p_brand").agg(F.collect_set(values).alias("list"))
    docs = brands.select(F.to_json(F.create_map(F.lower(F.replace("p_brand", F.lit("#"), F.lit("_"))), entry)).alias("value"))
    codes = table(spark, d, "nation").select(F.concat(F.col("n_nationkey").cast("string"), F.lit(","), "n_name", F.lit(", region "), F.col("n_regionkey").cast("string")).alias("value"))
    return profiles.flatten_dictionary(docs, "standard", codes).withColumn("children", F.array_join("children", ","))
