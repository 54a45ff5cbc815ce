"""Scalar expressions over whole tables, and seeds from parts."""

from pyspark.sql import functions as F

from ..functions import exprs
from ..sources import readers, seeds
from .catalog import query, table


@query("expr_rounding", """
SELECT c_custkey, CAST(floor(c_acctbal + 0.5) AS BIGINT) AS rounded, CAST(trunc(floor(c_acctbal + 0.5) / 100) * 100 AS BIGINT) AS hundreds FROM customer
""")
def expr_rounding(spark, d):
    r = exprs.jround("c_acctbal")
    return table(spark, d, "customer").select("c_custkey", r.alias("rounded"), exprs.trunc_to(r, 100).alias("hundreds"))


@query("expr_pct_change", """
WITH p AS (SELECT DISTINCT CAST(l_linenumber - 1 AS BIGINT) AS a, CAST(l_quantity - 1 AS BIGINT) AS z FROM lineitem)
SELECT a, z, CASE WHEN a = 0 AND z = 0 THEN 'NaN' WHEN a = 0 AND z > 0 THEN 'Infinity' WHEN a = 0 THEN '-Infinity'
 ELSE printf('%.2f', CAST(round(CAST((z - a) * 100.0 / a AS DECIMAL(24,8)), 2) AS DOUBLE)) END AS pct FROM p
""")
def expr_pct_change(spark, d):
    pairs = table(spark, d, "lineitem").select((F.col("l_linenumber") - 1).cast("bigint").alias("a"), (F.col("l_quantity") - 1).cast("bigint").alias("z")).distinct()
    pct = exprs.pct_change("a", "z")
    return pairs.select("a", "z", F.when(~F.isnan(pct) & (F.abs(pct) != float("inf")), F.format_string("%.2f", pct)).otherwise(pct.cast("string")).alias("pct"))


@query("expr_pct_text", """
WITH p AS (SELECT DISTINCT CAST(l_linenumber AS BIGINT) AS n, CAST(l_quantity - 1 AS BIGINT) AS d FROM lineitem)
SELECT n, d, CASE WHEN d <> 0 THEN printf('%.2f', CAST(round(CAST(n * 100.0 / d AS DECIMAL(24,8)), 2) AS DOUBLE)) || '%' END AS pct FROM p
""")
def expr_pct_text(spark, d):
    pairs = table(spark, d, "lineitem").select(F.col("l_linenumber").cast("bigint").alias("n"), (F.col("l_quantity") - 1).cast("bigint").alias("d")).distinct()
    return pairs.select("n", "d", exprs.pct_text("n", "d").alias("pct"))


@query("expr_handles", """
WITH h AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_name ELSE ' @User_' || c_custkey || ' ' END AS raw FROM customer)
SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN 'user_' || c_custkey END AS handle,
 CASE WHEN c_custkey % 3 <> 0 THEN 'user_' || c_custkey ELSE replace(raw, '@', '') END AS lookup,
 'https://twitter.com/' || CASE WHEN c_custkey % 3 <> 0 THEN 'user_' || c_custkey ELSE '' END AS url FROM h
""")
def expr_handles(spark, d):
    raw = F.when(F.col("c_custkey") % 3 == 0, F.col("c_name")).otherwise(F.concat(F.lit(" @User_"), F.col("c_custkey").cast("string"), F.lit(" ")))
    return table(spark, d, "customer").select("c_custkey", exprs.norm_handle(raw).alias("handle"), exprs.handle_or_bare(raw).alias("lookup"), exprs.handle_url(raw).alias("url"))


@query("expr_html_unescape", """
SELECT page_id, md5(replace(replace(replace(replace(replace(replace(replace(html, '&middot;', chr(183)), '&copy;', chr(169)),
 '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&nbsp;', chr(160)), '&amp;', '&')) AS html_md5 FROM pages
""")
def expr_html_unescape(spark, d):
    return table(spark, d, "pages").select("page_id", F.md5(exprs.html_unescape("html")).alias("html_md5"))


@query("expr_clean_text", r"""
SELECT doc_id, md5(regexp_replace(text, '[^\x00-\x7F]', '', 'g')) AS ascii_md5, md5(regexp_replace(text, '[^A-Za-z0-9_]', '', 'g')) AS squish_md5 FROM documents
""")
def expr_clean_text(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(exprs.ascii_only("text")).alias("ascii_md5"), F.md5(exprs.squish("text")).alias("squish_md5"))


@query("expr_titles", "SELECT p_partkey, upper(substr(p_name, 1, 1)) || substr(p_name, 2) AS title FROM part")
def expr_titles(spark, d):
    return table(spark, d, "part").select("p_partkey", exprs.pretty_title(F.replace("p_name", F.lit(" "), F.lit("_"))).alias("title"))


@query("expr_dsl_terms", """
SELECT event_id, CASE event_type WHEN 'click' THEN CAST(user_id AS VARCHAR) WHEN 'view' THEN '#tag' || user_id WHEN 'error' THEN NULL ELSE event_type || ' ' || user_id END AS term FROM events
""")
def expr_dsl_terms(spark, d):
    u = F.col("user_id").cast("string")
    t = F.col("event_type")
    field = (
        F.when(t == "click", F.concat(F.lit("mentions_twids:"), u))
        .when(t == "view", F.concat(F.lit("hashtags:tag"), u))
        .when(t == "error", F.concat(F.lit("place:"), u))
        .otherwise(F.concat(F.lit('text:"'), t, F.lit(" "), u, F.lit('"')))
    )
    return table(spark, d, "events").select("event_id", exprs.dsl_term(field).alias("term"))


@query("expr_dates", """
SELECT event_id, strftime(ts, '%Y%m%d%H%M%S') AS stamp, strftime(ts, '%Y%m%d') AS day, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS iso FROM events
""")
def expr_dates(spark, d):
    return table(spark, d, "events").select("event_id", exprs.stamp("ts").alias("stamp"), exprs.day("ts").alias("day"), exprs.iso("ts").alias("iso"))


@query("expr_pad", "SELECT p_partkey, array_to_string(list_resize(string_split(p_name, ' '), 5, ''), '|') AS padded FROM part")
def expr_pad(spark, d):
    return table(spark, d, "part").select("p_partkey", F.array_join(exprs.pad(F.split("p_name", " "), 5), "|").alias("padded"))


@query("expr_csv_line", '''
SELECT p_partkey, p_partkey || ',"' || p_name || ', ""' || p_type || '""",' || p_brand || ',' AS line FROM part
''')
def expr_csv_line(spark, d):
    quoted = F.concat("p_name", F.lit(', "'), "p_type", F.lit('"'))
    return table(spark, d, "part").select("p_partkey", exprs.csv_line("p_partkey", quoted, "p_brand", F.lit(None)).alias("line"))


@query("expr_unquote", "SELECT l_orderkey, CASE WHEN l_linenumber = 7 THEN 0.0 ELSE l_quantity END AS n FROM lineitem")
def expr_unquote(spark, d):
    text = F.when(F.col("l_linenumber") == 7, F.lit('""')).otherwise(F.concat(F.lit('"'), F.col("l_quantity").cast("int").cast("string"), F.lit('"')))
    return table(spark, d, "lineitem").select("l_orderkey", exprs.unquote_number(text).alias("n"))


@query("seed_payload", """
WITH s AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 4 = 0 THEN '' ELSE p_name END AS title, CASE WHEN p_partkey % 9 = 0 THEN 'no handle' ELSE '@Part_' || p_partkey END AS h,
  CASE WHEN p_partkey % 5 = 0 THEN '' ELSE CAST(p_partkey AS VARCHAR) END AS id FROM part),
 j AS (SELECT s.*, 'part_' || k AS handle, m.s_name || ' & Co' AS m_name, CASE WHEN m.s_suppkey % 2 = 0 THEN 'Bio <' || m.s_suppkey || '>' END AS m_bio
  FROM s LEFT JOIN supplier AS m ON m.s_suppkey = s.k WHERE h <> 'no handle')
SELECT handle, '{"name":"' || coalesce(m_name, nullif(title, ''), '@' || handle) || '","twitterHandle":"@' || handle || '","twitterBio":"' || coalesce(m_bio, '') ||
 '","mediaTitle":' || coalesce('"' || nullif(title, '') || '"', 'null') || ',"mediaId":' || coalesce('"' || nullif(id, '') || '"', 'null') || '}' AS payload FROM j
""")
def seed_payload(spark, d):
    k = F.col("p_partkey")
    rows = table(spark, d, "part").select(
        F.when(k % 4 == 0, "").otherwise(F.col("p_name")).alias("title"),
        F.when(k % 9 == 0, "no handle").otherwise(F.concat(F.lit("@Part_"), k.cast("string"))).alias("handle"),
        F.when(k % 5 == 0, "").otherwise(k.cast("string")).alias("id"),
    )
    s = F.col("s_suppkey").cast("string")
    meta = table(spark, d, "supplier").select(
        F.concat(F.lit("part_"), s).alias("handle"),
        F.concat("s_name", F.lit(" &amp; Co")).alias("name"),
        F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("Bio &lt;"), s, F.lit("&gt;"))).alias("bio"),
    )
    return seeds.seed_payload(rows, meta)


@query("checked_csv_rejects", """
SELECT CASE WHEN p_partkey % 6 = 0 THEN 'reject' ELSE 'good' END AS outcome, CASE WHEN p_partkey % 6 <> 0 THEN p_name || ', ' || p_type END AS title,
 CASE WHEN p_partkey % 6 <> 0 THEN 'part_' || p_partkey END AS handle, CASE WHEN p_partkey % 6 <> 0 THEN CAST(p_partkey AS VARCHAR) END AS id,
 CASE WHEN p_partkey % 6 = 0 THEN '"' || p_name || ', ' || p_type || '",part_' || p_partkey || CASE WHEN p_partkey % 12 = 0 THEN ',a,b' ELSE '' END END AS line FROM part
""")
def checked_csv_rejects(spark, d):
    k = F.col("p_partkey")
    two = F.concat(F.lit('"'), "p_name", F.lit(", "), "p_type", F.lit('",part_'), k.cast("string"))
    line = F.when(k % 12 == 0, F.concat(two, F.lit(",a,b"))).when(k % 6 == 0, two).otherwise(F.concat(two, F.lit(","), k.cast("string")))
    good, rejects = readers.parse_checked_csv(table(spark, d, "part").select(line.alias("value")), ["title", "handle", "id"])
    return good.select(F.lit("good").alias("outcome"), "*", F.lit(None).cast("string").alias("line")).unionByName(
        rejects.select(F.lit("reject").alias("outcome"), "line"), allowMissingColumns=True
    )
