"""URL filter: rules indexed by their rarest literal token, regular expressions run for fetched candidates only."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import durable, small_side
from .common import only

SEPARATORS = r"[^a-z0-9]+"


@dataclass(frozen=True)
class Rule:
    """A pattern over a whole URL whose host is lower-cased; ``tokens`` are whole tokens of every URL it matches.

    ``name`` and ``length`` are set for host and path rules: of those that fit, the longest decides and is reported.
    """

    pattern: str
    action: str
    tokens: tuple[str, ...]
    name: str | None = None
    length: int = 0


def place(host: str, path: str, action: str) -> Rule:
    """Rule for a host with its subdomains and a path prefix; the URL it sees is ``//host`` and its path."""
    head, _, tail = path.rpartition("/")
    tokens = [t for t in re.split(SEPARATORS, host.lower()) if t]
    tokens += [t for t in re.split(SEPARATORS, head.lower()) if t] if head or tail else []
    return Rule(rf"\A//([^/]*\.)?{re.escape(host)}{re.escape(path)}", action, tuple(tokens), host + path, len(host) + len(path))


#: Places judged by name (fixed by the rule), then patterns of addresses no corpus wants.
PLACES = (place("net", "/", "block"), place("example.net", "/en/", "allow"), place("example.com", "/de/", "block"), place("org", "/fr/", "allow"))
PATTERNS = tuple(
    Rule(pattern, "block", tokens)
    for pattern, tokens in (
        (r"\A//([^/]*[.-])?spam-farm\.", ("spam", "farm")),
        (r"\A//([^/]*[.-])?casino[.-]", ("casino",)),
        (r"\A//([^/]*[.-])?adult[.-]", ("adult",)),
        (r"/login(/|\z)", ("login",)),
        (r"/cart(/|\z)", ("cart",)),
        (r"/cgi-bin/", ("cgi", "bin")),
        (r"/wp-admin/", ("wp", "admin")),
    )
)


def parts(url: str = "url") -> tuple[Column, Column]:
    """Host (A-Z lower-cased) after the first ``://`` and the path up to ``?`` or ``#``; both empty without ``://`` or for null."""
    rest = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)\A.*?://(.*)\z", 1)
    host = F.regexp_extract(rest, r"(?s)\A([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)\A[^/?#]*([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


def _table(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    rows = [(i, r.pattern, r.action, list(dict.fromkeys(r.tokens)), r.name, r.length) for i, r in enumerate(rules)]
    return spark.createDataFrame(rows, "rule_id long, pattern string, action string, tokens array<string>, rule string, length int")


def indexed(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Each rule with its literal token that fewest of ``urls(tokens)`` hold (``token``, null if it has none)."""
    literal = rules.select("rule_id", F.explode("tokens").alias("token"))
    wanted = small_side(literal.select("token").distinct())
    seen = urls.select(F.explode("tokens").alias("token")).join(wanted, "token").groupBy("token").agg(F.count(F.lit(1)).alias("times"))
    rank = literal.join(seen, "token", "left").select("rule_id", F.struct(F.coalesce("times", F.lit(0)).alias("times"), "token").alias("t"))
    rarest = rank.groupBy("rule_id").agg(F.min("t").alias("t")).select("rule_id", F.col("t.token").alias("token"))
    return rules.join(rarest, "rule_id", "left")


def filtered(pages: DataFrame, rules: Sequence[Rule] = PLACES + PATTERNS, default: str = "allow") -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every row.

    Each distinct URL is judged once: its tokens fetch the rules indexed under them, and only those run their regular
    expression. Rules without a literal token are few by design and are tried on every URL. The longest fitting place
    decides and is named in ``rule``; otherwise any matching pattern decides (block before allow), else ``default``.

    A null url, or one without ``://``, has empty host and path, fits no rule and gets ``default``. Hosts that many rows
    share only meet as distinct URLs; rows with one url are joined to its one verdict. Other columns are ignored.
    """
    spark = pages.sparkSession
    host, path = parts()
    rows = only(pages, ["page_id", "url"]).select("page_id", "url", host.alias("host"), path.alias("path"))
    seen = rows.where("host <> '' OR path <> ''").select("host", "path").distinct()
    seen = durable(seen.withColumn("tokens", F.array_distinct(F.split(F.lower(F.concat_ws("/", "host", "path")), SEPARATORS))))
    index = durable(indexed(seen, _table(spark, rules)))
    known = seen.select("host", "path", F.explode("tokens").alias("token")).join(small_side(index.where("token IS NOT NULL")), "token")
    loose = index.where("token IS NULL")
    if not loose.isEmpty():
        every = F.explode(F.array(*[F.struct(*[F.lit(r[c]).alias(c) for c in ("pattern", "action", "rule", "length")]) for r in loose.collect()]))
        tried = seen.select("host", "path", every.alias("r")).select("host", "path", "r.*")
        known = known.select(*tried.columns).unionByName(tried)
    fits = known.where(F.expr("concat('//', host, path) rlike pattern"))
    order = F.struct(F.col("rule").isNotNull().alias("named"), F.col("length"), (F.col("action") == "block").alias("block"), F.col("rule"), F.col("action"))
    best = fits.groupBy(F.col("host").alias("h"), F.col("path").alias("p")).agg(F.max(order).alias("best"))
    joined = rows.join(best, (F.col("host") == F.col("h")) & (F.col("path") == F.col("p")), "left")
    return joined.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.action", F.lit(default)).alias("verdict"))
