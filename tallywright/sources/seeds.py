"""Seed records: checked input lines enriched and rendered as payloads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import first_non_empty, html_unescape, norm_handle

#: Names of the members of the payload, unless the caller gives others: name, handle, text about it, title, id.
PAYLOAD_KEYS = ("name", "twitterHandle", "twitterBio", "mediaTitle", "mediaId")


def seed_payload(seeds: DataFrame, meta: DataFrame | None = None, keys: Sequence[str] = PAYLOAD_KEYS) -> DataFrame:
    """``title, handle, id`` rows to ``handle, payload``; rows without a valid handle are dropped.

    ``meta`` may hold ``handle, name, bio``. The name is the first of profile name, title and ``@handle``;
    members without a value are explicit nulls. ``keys`` names the five members.
    """
    known = seeds.withColumn("h", norm_handle("handle")).where(F.col("h").isNotNull())
    if meta is not None:
        names = meta.select(F.col("handle").alias("h"), F.col("name").alias("m_name"), F.col("bio").alias("m_bio"))
        known = known.join(names, "h", "left")
    else:
        known = known.withColumns({"m_name": F.lit(None).cast("string"), "m_bio": F.lit(None).cast("string")})
    at = F.concat(F.lit("@"), F.col("h"))
    title, ident = F.nullif(F.trim("title"), F.lit("")), F.nullif(F.trim("id"), F.lit(""))
    values = (
        F.coalesce(first_non_empty(html_unescape("m_name")), title, at),
        at,
        F.coalesce(html_unescape("m_bio"), F.lit("")),
        title,
        ident,
    )
    body = F.struct(*[v.alias(k) for k, v in zip(keys, values, strict=True)])
    return known.select(F.col("h").alias("handle"), F.to_json(body, {"ignoreNullFields": "false"}).alias("payload"))
