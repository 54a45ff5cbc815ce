"""Scored population = customers; files = market segments; cents where large scores are wanted."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import histogram, rank, scoring
from .catalog import query, table


def scored(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("score"), F.col("c_mktsegment").alias("file")
    )


def cents(spark: SparkSession, d: str) -> DataFrame:
    return scored(spark, d).withColumn("score", F.col("score") * 100)


S = "WITH s AS (SELECT c_custkey AS id, c_acctbal AS score, c_mktsegment AS file, CAST(floor(c_acctbal + 0.5) AS BIGINT) AS v FROM customer)"
C = "WITH s AS (SELECT c_custkey AS id, c_acctbal * 100 AS score, c_mktsegment AS file, CAST(floor(c_acctbal * 100 + 0.5) AS BIGINT) AS v FROM customer)"

MOMENTS = """min(score) AS min_score, max(score) AS max_score, CAST(count(*) AS BIGINT) AS n, round(sum(score), 2) AS sum_score,
round(avg(score), 4) AS mean, round(stddev_samp(score), 4) AS sd, round(avg(score) + stddev_samp(score), 4) AS mean_plus_sd"""


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 2 if c == "sum_score" else 4) for c in ("sum_score", "mean", "sd", "mean_plus_sd")})


@query("score_moments", f"{S} SELECT {MOMENTS} FROM s")
def score_moments(spark, d):
    return _rounded(scoring.score_moments(scored(spark, d), "score"))


@query("scored_per_file", f"{S} SELECT file, {MOMENTS} FROM s GROUP BY file")
def scored_per_file(spark, d):
    return _rounded(scoring.score_moments(scored(spark, d), "score", ["file"]))


@query("score_signs", f"""{S}, c AS (SELECT count(*) AS t, count(*) FILTER (v > 0) AS p, count(*) FILTER (v = 0) AS z, count(*) FILTER (v < 0) AS n FROM s)
SELECT 'positive' AS sign, CAST(p AS BIGINT) AS n, round(p / t, 6) AS share FROM c UNION ALL SELECT 'zero', z, round(z / t, 6) FROM c
UNION ALL SELECT 'negative', n, round(n / t, 6) FROM c UNION ALL SELECT 'total', t, 1.0 FROM c""")
def score_signs(spark, d):
    return scoring.score_signs(scored(spark, d), "score").withColumn("share", F.round("share", 6))


@query("score_bands", f"""{C} SELECT CAST(-10000 AS BIGINT) AS low, CAST(-5001 AS BIGINT) AS high, CAST(count(*) FILTER (v <= -5001 AND v >= -10000) AS BIGINT) AS n FROM s
UNION ALL SELECT -15000, -10001, count(*) FILTER (v <= -10001 AND v >= -15000) FROM s""")
def score_bands(spark, d):
    return scoring.score_bands(cents(spark, d), "score")


@query("score_above_threshold", f"{S} SELECT id, score FROM s WHERE score > (SELECT avg(score) + stddev_samp(score) FROM s)")
def score_above_threshold(spark, d):
    return scoring.above_mean_plus_sd(scored(spark, d), "score").select("id", "score")


@query("score_rounded_distribution", f"{C} SELECT CAST(floor(score / 1000 + 0.5) AS BIGINT) * 1000 AS rounded, CAST(count(*) AS BIGINT) AS n FROM s GROUP BY 1")
def score_rounded_distribution(spark, d):
    return scoring.rounded_distribution(cents(spark, d), "score")


BOUNDS = (-500, 0, 2000, 4000, 6000, 8000)


@query("histogram_fixed", f"""{S}, b AS (SELECT CASE WHEN v = 0 THEN 1 WHEN v <= -500 THEN 0 WHEN v < 0 THEN 1 WHEN v < 2000 THEN 2
 WHEN v < 4000 THEN 3 WHEN v < 6000 THEN 4 WHEN v < 8000 THEN 5 ELSE 6 END AS bucket FROM s),
l(bucket, label) AS (VALUES (0, '(-inf, -500]'), (1, '(-500, 0]'), (2, '(0, 2000)'), (3, '[2000, 4000)'), (4, '[4000, 6000)'), (5, '[6000, 8000)'), (6, '[8000, inf)'))
SELECT CAST(l.bucket AS BIGINT) AS bucket, l.label, CAST(count(b.bucket) AS BIGINT) AS n FROM l LEFT JOIN b ON l.bucket = b.bucket GROUP BY 1, 2""")
def histogram_fixed(spark, d):
    return histogram.histogram(scored(spark, d), "score", BOUNDS).withColumn("bucket", F.col("bucket").cast("bigint"))


@query("histogram_merge", f"""{S}, b AS (SELECT CASE WHEN v = 0 THEN 1 WHEN v <= -500 THEN 0 WHEN v < 0 THEN 1 WHEN v < 2000 THEN 2
 WHEN v < 4000 THEN 3 WHEN v < 6000 THEN 4 WHEN v < 8000 THEN 5 ELSE 6 END AS bucket FROM (SELECT v FROM s UNION ALL
 SELECT CAST(floor(s_acctbal + 0.5) AS BIGINT) FROM supplier)),
l(bucket, label) AS (VALUES (0, '(-inf, -500]'), (1, '(-500, 0]'), (2, '(0, 2000)'), (3, '[2000, 4000)'), (4, '[4000, 6000)'), (5, '[6000, 8000)'), (6, '[8000, inf)'))
SELECT CAST(l.bucket AS BIGINT) AS bucket, l.label, CAST(count(b.bucket) AS BIGINT) AS n FROM l LEFT JOIN b ON l.bucket = b.bucket GROUP BY 1, 2""")
def histogram_merge(spark, d):
    first = histogram.histogram(scored(spark, d), "score", BOUNDS)
    second = histogram.histogram(table(spark, d, "supplier"), "s_acctbal", BOUNDS)
    return histogram.merge_histograms(first, second).withColumn("bucket", F.col("bucket").cast("bigint"))


@query("histogram_signed", f"""{S}, k AS (SELECT CAST(greatest(0, floor((floor(abs(min(score))) - 1) / 100)) AS BIGINT) AS kn, CAST(greatest(0, floor((floor(max(score)) - 1) / 100)) AS BIGINT) AS kp FROM s),
g AS (SELECT -1 AS side, unnest(range(0, kn + 1)) AS step, kn AS last FROM k UNION ALL SELECT 1, unnest(range(0, kp + 1)), kp FROM k
      UNION ALL SELECT 0, 0, 0 FROM k WHERE EXISTS (SELECT 1 FROM s WHERE v = 0)),
e AS (SELECT CAST(side AS BIGINT) AS side, CAST(step AS BIGINT) AS step,
      CASE WHEN side = 0 THEN 0 WHEN side = 1 THEN 1 + step * 100 WHEN step < last THEN -(1 + (step + 1) * 100) + 1 END AS lower,
      CASE WHEN side = 0 THEN 0 WHEN side = -1 THEN -(1 + step * 100) WHEN step < last THEN (1 + (step + 1) * 100) - 1 END AS upper FROM g)
SELECT side, step, CAST(lower AS BIGINT) AS lower, CAST(upper AS BIGINT) AS upper,
       CAST((SELECT count(*) FROM s WHERE (e.lower IS NULL OR v >= e.lower) AND (e.upper IS NULL OR v <= e.upper)) AS BIGINT) AS n FROM e""")
def histogram_signed(spark, d):
    return histogram.histogram_signed(scored(spark, d), "score", 100)


CUTS = (2000, 4000, 6000, 8000)


@query("cumulative_distribution", f"""{S}, k(pos, bound) AS (VALUES (0, 2000), (1, 4000), (2, 6000), (3, 8000))
SELECT CAST(pos AS BIGINT) AS pos, CAST(bound AS BIGINT) AS bound, false AS overflow, CAST((SELECT count(*) FROM s WHERE v <= bound) AS BIGINT) AS n FROM k
UNION ALL SELECT 4, 8000, true, count(*) FROM s WHERE v > 8000""")
def cumulative_distribution(spark, d):
    return histogram.cumulative_distribution(scored(spark, d), "score", CUTS)


@query("cumulative_complement", f"""{S}, k(pos, bound) AS (VALUES (0, 0), (1, 2000), (2, 4000), (3, 6000))
SELECT CAST(pos AS BIGINT) AS pos, CAST(bound AS BIGINT) AS bound, false AS overflow, CAST((SELECT count(*) FROM s WHERE v > bound) AS BIGINT) AS n FROM k
UNION ALL SELECT 4, 8000, true, count(*) FILTER (v > 8000) + count(*) FILTER (v <= 0) FROM s""")
def cumulative_complement(spark, d):
    return histogram.cumulative_distribution(scored(spark, d), "score", CUTS, complementary=True, compat=True)


@query("score_analysis", f"""{C}, a AS (SELECT count(*) AS t, count(*) FILTER (v > 0) AS p, count(*) FILTER (v = 0) AS z, count(*) FILTER (v < 0) AS n,
 avg(score) AS mean, stddev_samp(score) AS sd FROM s),
r(pos, metric, value, share) AS (
 SELECT 0, 'Positive', p, p / t FROM a UNION ALL SELECT 1, 'Zero', z, z / t FROM a UNION ALL SELECT 2, 'Negative', n, n / t FROM a
 UNION ALL SELECT 3, 'Total', t, NULL FROM a UNION ALL SELECT 4, 'Mean', mean, NULL FROM a UNION ALL SELECT 5, 'Standard Deviation', sd, NULL FROM a
 UNION ALL SELECT 6, 'Standard Deviation + Mean', mean + sd, NULL FROM a
 UNION ALL SELECT 7, 'Standard Deviation + Mean Count', (SELECT count(*) FROM s WHERE score > (SELECT mean + sd FROM a)), NULL FROM a
 UNION ALL SELECT 8, '(-inf, 0]', count(*) FILTER (v <= 0), NULL FROM s UNION ALL SELECT 9, '(0, 100000)', count(*) FILTER (v > 0 AND v < 100000), NULL FROM s
 UNION ALL SELECT 10 + i, '[' || (i + 1) * 100000 || ', ' || (i + 2) * 100000 || ')', (SELECT count(*) FROM s WHERE v >= (i + 1) * 100000 AND v < (i + 2) * 100000), NULL FROM range(4) AS x(i)
 UNION ALL SELECT 14, '[500000, inf)', count(*) FILTER (v >= 500000), NULL FROM s
 UNION ALL SELECT 15, '(-inf, 0]', count(*) FILTER (v <= 0), NULL FROM s UNION ALL SELECT 16, '(0, 1000000)', count(*) FILTER (v > 0 AND v < 1000000), NULL FROM s
 UNION ALL SELECT 17 + i, '[' || 1000000 + i * 500000 || ', ' || 1500000 + i * 500000 || ')', (SELECT count(*) FROM s WHERE v >= 1000000 + i * 500000 AND v < 1500000 + i * 500000), NULL FROM range(4) AS x(i)
 UNION ALL SELECT 21, '[3000000, inf)', count(*) FILTER (v >= 3000000), NULL FROM s)
SELECT CAST(pos AS BIGINT) AS pos, metric, round(CAST(value AS DOUBLE), 2) AS value, round(CAST(share AS DOUBLE), 6) AS share FROM r""")
def score_analysis(spark, d):
    return scoring.analysis_report(cents(spark, d), "score").withColumns({"value": F.round("value", 2), "share": F.round("share", 6)})


BUCKET = "(v // 100) * 100"
PICKED = f"""{S}, p AS (SELECT id, score, CAST({BUCKET} AS BIGINT) AS rounded_score,
 row_number() OVER (PARTITION BY {BUCKET} ORDER BY id) AS rn FROM s)"""


@query("sample_per_bucket", f"{PICKED} SELECT id, score, rounded_score FROM p WHERE rn <= 3")
def sample_per_bucket(spark, d):
    picked = scoring.sample_per_group(scored(spark, d), "score", [F.col("id").asc()])
    return picked.select("id", "score", "rounded_score")


@query("sample_enriched", f"""{PICKED} SELECT p.id, p.score, p.rounded_score, CAST(c.c_nationkey AS BIGINT) AS social_id,
 'https://twitter.com/intent/user?user_id=' || c.c_nationkey AS profile_url
FROM p LEFT JOIN customer AS c ON c.c_custkey = p.id AND c.c_mktsegment <> 'BUILDING' WHERE rn <= 3""")
def sample_enriched(spark, d):
    ids = table(spark, d, "customer").where("c_mktsegment <> 'BUILDING'")
    ids = ids.select(F.col("c_custkey").alias("id"), F.col("c_nationkey").cast("bigint").alias("social_id"))
    return scoring.left_enrich(sample_per_bucket(spark, d), ids, "id", "social_id")


RANKED = f"{S}, r AS (SELECT *, row_number() OVER (ORDER BY score DESC, id) AS rank, (SELECT count(*) FROM s WHERE v > 0) // 10 AS chunk FROM s)"


@query("global_rank", "SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders")
def global_rank(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return rank.global_rank(orders, [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()]).select("o_orderkey", "rank")


@query("decile_bounds", f"{RANKED} SELECT CAST((rank - 1) // chunk AS BIGINT) AS chunk, max(score) AS max_score, min(score) AS min_score, CAST(count(*) AS BIGINT) AS n FROM r GROUP BY 1")
def decile_bounds(spark, d):
    return scoring.chunk_bounds(scored(spark, d), "score", ["id"])


@query("top_deciles", f"{RANKED} SELECT id, score FROM r WHERE rank <= 3 * chunk")
def top_deciles(spark, d):
    return scoring.top_deciles(scored(spark, d), "score", ["id"], deciles=3, with_rank=False).select("id", "score")


@query("top_deciles_per_file", f"""{S}, c AS (SELECT file, count(*) FILTER (v > 0) // 10 AS chunk, 1 + length(file) % 3 AS deciles FROM s GROUP BY 1),
r AS (SELECT s.*, c.chunk, c.deciles, row_number() OVER (PARTITION BY s.file ORDER BY score DESC, id) AS rank FROM s JOIN c ON c.file = s.file)
SELECT file, id, score FROM r WHERE rank <= deciles * chunk""")
def top_deciles_per_file(spark, d):
    data = scored(spark, d)
    choice = data.select("file").distinct().withColumn("deciles", 1 + F.length("file") % 3)
    return scoring.top_deciles(data, "score", ["id"], choice=choice, group_cols=["file"], with_rank=False).select("file", "id", "score")


@query("top_deciles_ranked", f"{RANKED} SELECT id, score, rank FROM r WHERE rank <= 11 * chunk")
def top_deciles_ranked(spark, d):
    return scoring.top_deciles(scored(spark, d), "score", ["id"], deciles=11).select("id", "score", "rank")


@query("batch_keys", f"""{S}, r AS (SELECT id, row_number() OVER (ORDER BY id) - 1 AS p FROM s)
SELECT CAST(p // 128 AS BIGINT) AS batch, printf('batch-%09d', p // 128) AS batch_name, CAST(count(*) AS BIGINT) AS n, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS keys FROM r GROUP BY 1, 2""")
def batch_keys(spark, d):
    out = rank.batch_keys(scored(spark, d).select("id"), "id", [F.col("id").asc()], 128)
    return out.withColumn("keys", F.array_join(F.col("keys").cast("array<string>"), ","))
