"""Fuzzy match of part names with themselves, and of suppliers with customers."""

from pyspark.sql import functions as F

from ..operators import matching
from .catalog import query, table


def titles(spark, d):
    return table(spark, d, "part").select(F.col("p_name").alias("title"), F.col("p_type").alias("category"))


def handles(spark, d):
    p = table(spark, d, "part")
    return p.select(F.replace("p_name", F.lit(" "), F.lit("")).alias("handle"), F.col("p_name").alias("name"), F.col("p_brand").alias("category"))


FUZZY = """
WITH t AS (SELECT DISTINCT p_name AS title, p_type AS category FROM part),
     h AS (SELECT DISTINCT replace(p_name, ' ', '') AS handle, p_name AS name, p_brand AS handle_category FROM part),
     c AS (SELECT x.title, y.handle, y.name,
                  round(jaro_winkler_similarity(lower(x.title), lower(y.handle)), 6) AS handle_sim,
                  round(jaro_winkler_similarity(lower(x.title), lower(y.name)), 6) AS title_sim,
                  regexp_replace(lower(x.title), '[^A-Za-z0-9_]', '', 'g') = y.handle AS squish
           FROM (SELECT DISTINCT title FROM t) AS x CROSS JOIN (SELECT DISTINCT handle, name FROM h) AS y)
SELECT t.title, t.category, h.handle, h.name, h.handle_category, c.handle_sim, c.title_sim, c.squish
FROM c JOIN t ON t.title = c.title JOIN h ON h.handle = c.handle AND h.name = c.name
WHERE c.squish OR c.handle_sim > 0.8 OR c.title_sim > 0.8
"""


@query("fuzzy_match", FUZZY)
def fuzzy_match(spark, d):
    return matching.fuzzy_match(titles(spark, d), handles(spark, d))


@query("fuzzy_match_parties", """
SELECT lower(s_name) AS a, lower(c_name) AS b, round(jaro_winkler_similarity(lower(s_name), lower(c_name)), 6) AS similarity
FROM supplier CROSS JOIN customer WHERE round(jaro_winkler_similarity(lower(s_name), lower(c_name)), 6) > 0.8
""")
def fuzzy_match_parties(spark, d):
    s = table(spark, d, "supplier").select(F.lower("s_name").alias("text"))
    return matching.similar_texts(s, table(spark, d, "customer").select(F.lower("c_name").alias("text")))


@query("fuzzy_squish", """
SELECT DISTINCT p_name AS title, p_type AS category, replace(p_name, ' ', '') AS handle FROM part
""")
def fuzzy_squish(spark, d):
    return matching.squish_match(titles(spark, d), handles(spark, d))


@query("fuzzy_distinct_titles", "SELECT DISTINCT p_name AS title, p_type AS category FROM part")
def fuzzy_distinct_titles(spark, d):
    return matching.distinct_titles(titles(spark, d))
