"""Nested profile documents and data dictionaries.

A document arrives as a tab-separated line of four parts: skip, skip, key, JSON. The JSON object may hold
an array of profiles ``{type, username, id}``. Documents are read as VARIANT values, so wrong shapes can
be told from missing fields.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import norm_handle, pretty_title
from ..observed import Counted, total, watched
from ..runtime import compute_once, durable, rows_of

PROFILES_PATH = "$.socialProfiles"  # fixed value: name of the array in the document


_MEMBERS = ("type", "username", "id")


def parse_profiles(lines: DataFrame, value: str = "value", mode: str = "quarantine") -> DataFrame:
    """``key, status, profiles`` per line.

    status: ``ok``, ``no_profiles`` (no array), ``bad_line`` (not four parts), ``bad_json`` (not an object).
    ``mode='strict'`` raises on ``bad_json``. Each profile is a struct of ``is_object, type, username, id`` and
    the kinds of the three members.
    """
    cut = compute_once(lines, F.split(F.col(value), "\t", 4).alias("_p"))
    four = F.size("_p") == 4
    doc = compute_once(
        cut,
        four.alias("_four"),
        F.when(four, F.get("_p", F.lit(2))).alias("key"),
        F.when(four, F.get("_p", F.lit(3))).alias("_json"),
        F.when(four, F.try_parse_json(F.get("_p", F.lit(3)))).alias("_doc"),
    )
    # a value that parses and opens with a brace is an object; entries that are not become null
    shape = "array<struct<" + ",".join(f"{m}:variant" for m in _MEMBERS) + ">>"
    doc = compute_once(
        doc,
        "_four",
        "key",
        (F.col("_doc").isNotNull() & F.col("_json").rlike(r"^\s*\{")).alias("_object"),
        F.try_variant_get("_doc", PROFILES_PATH, shape).alias("_arr"),
    )

    def profile(e: Column) -> Column:
        members = []
        for m in _MEMBERS:
            members.append(F.try_variant_get(e.getField(m), "$", "string").alias(m))
            members.append(F.schema_of_variant(e.getField(m)).alias(f"{m}_kind"))
        return F.struct(e.isNotNull().alias("is_object"), *members)

    status = (
        F.when(~F.col("_four"), "bad_line")
        .when(~F.col("_object"), "bad_json")
        .when(F.col("_arr").isNull(), "no_profiles")
        .otherwise("ok")
    )
    if mode == "strict":
        fail = F.raise_error(F.concat(F.lit("not a JSON object: "), F.coalesce("key", F.lit("?"))))
        status = F.when(F.col("_four") & ~F.col("_object"), fail.cast("string")).otherwise(status)
    return compute_once(doc, "key", status.alias("status"), F.transform("_arr", profile).alias("profiles"))


def _non_string(kind: Column) -> Column:
    return kind.isNotNull() & (kind != "STRING")


def _objects(profiles: Column) -> Column:
    return F.filter(profiles, lambda p: p.getField("is_object"))


def _types(strict: bool) -> Column:
    """Types of the object entries (``NONE`` where absent)."""
    bad = F.exists(_objects(F.col("profiles")), lambda p: _non_string(p.getField("type_kind")))
    types = F.transform(_objects(F.col("profiles")), lambda p: F.coalesce(p.getField("type"), F.lit("NONE")))
    wrong = F.raise_error(F.lit("profile type is not a string")).cast("array<string>") if strict else F.lit(None).cast("array<string>")
    return F.when(F.col("status") == "ok", F.when(bad, wrong).otherwise(types))


def _pairs(types: Column) -> Column:
    """Unordered pairs of distinct types within a record, as ``a-b`` with a before b."""
    distinct = F.array_sort(F.array_distinct(types))
    return F.flatten(
        F.transform(
            distinct,
            lambda x, i: F.transform(F.slice(distinct, i + 2, F.size(distinct)), lambda y: F.concat(x, F.lit("-"), y)),
        )
    )


def _type_sets(parsed: DataFrame, strict: bool) -> DataFrame:
    """``none, types, n``: lines by their types in order, repeats included, and by whether they have no array.

    There are few such lists, so all that follows works on these instead of on the lines.
    """
    typed = compute_once(parsed, (F.col("status") == "no_profiles").alias("none"), F.array_sort(_types(strict)).alias("types"))
    return typed.groupBy("none", "types").agg(F.count(F.lit(1)).alias("n"))


def profile_token_counts(parsed: DataFrame, strict: bool = False) -> DataFrame:
    """``token, n`` over all lines: ``records``, types, type pairs, ``has_<type>`` and ``no-sp``."""
    nothing = F.array().cast("array<string>")
    tokens = F.concat(
        F.array(F.lit("records")),
        F.coalesce("types", nothing),
        F.coalesce(_pairs(F.col("types")), nothing),
        F.coalesce(F.transform(F.array_distinct("types"), lambda t: F.concat(F.lit("has_"), t)), nothing),
        F.when(F.col("none"), F.array(F.lit("no-sp"))).otherwise(nothing),
    )
    listed = _type_sets(parsed, strict).select("n", F.explode(tokens).alias("token"))
    return listed.groupBy("token").agg(F.sum("n").alias("n"))


def profile_pair_counts(parsed: DataFrame, strict: bool = False) -> DataFrame:
    """How many records hold both types: ``type_a, type_b, n``."""
    distinct = _type_sets(parsed, strict).select("n", F.array_distinct("types").alias("types"))
    pairs = F.flatten(
        F.transform(
            "types",
            lambda x, i: F.transform(
                F.slice("types", i + 2, F.size("types")), lambda y: F.struct(x.alias("type_a"), y.alias("type_b"))
            ),
        )
    )
    listed = compute_once(distinct, "n", pairs.alias("pairs"))
    return listed.select("n", F.inline("pairs")).groupBy("type_a", "type_b").agg(F.sum("n").alias("n"))


def token_percent(counts: DataFrame) -> DataFrame:
    """``per_<token>`` in percent of all records, for every token with an underscore."""
    counts = durable(counts)  # the number of records comes from the same rows
    records = counts.where(F.col("token") == "records").agg(F.max("n")).scalar()
    return counts.where(F.col("token").contains("_")).select(
        F.concat(F.lit("per_"), F.col("token")).alias("token"), (F.col("n").cast("double") * 100 / records).alias("pct")
    )


def _wanted(type_: str) -> Column:
    return F.filter(
        "profiles", lambda p: p.getField("is_object") & (p.getField("type_kind") == "STRING") & (p.getField("type") == type_)
    )


def _has(p: Column, member: str) -> Column:
    return p.getField(f"{member}_kind").isNotNull()


def _chosen(parsed: DataFrame, type_: str) -> DataFrame:
    """Per line its status, profiles in all, profiles of the wanted type, and those of them with a handle or an id."""
    ok = F.col("status") == "ok"
    first = compute_once(parsed, "key", "status", F.when(ok, F.size("profiles")).alias("size"), F.when(ok, _wanted(type_)).alias("wanted"))
    return compute_once(first, "key", "status", "size", "wanted", F.filter("wanted", lambda p: _has(p, "username") | _has(p, "id")).alias("emitted"))


def _rows(profiles: Column, strict: bool, lenient: bool) -> Column:
    """One ``handle, id`` per profile."""

    def text(p: Column, f: str) -> Column:
        fine = p.getField(f"{f}_kind") == "STRING"
        other = F.lit("")
        if strict:
            wrong = F.raise_error(F.lit(f"profile {f} is not a string")).cast("string")
            other = F.when(_has(p, f) & ~fine, wrong).otherwise(F.lit(""))
        return F.when(fine, p.getField(f)).otherwise(other)

    def row(p: Column) -> Column:
        handle = F.lower(text(p, "username")) if lenient else F.coalesce(norm_handle(text(p, "username")), F.lit(""))
        return F.struct(handle.alias("handle"), text(p, "id").alias("id"))

    rows = F.transform(profiles, row)
    if lenient:
        return rows
    blank = F.array(F.struct(F.lit("").alias("handle"), F.lit("").alias("id")))
    return F.when(F.size(rows) == 0, blank).otherwise(rows)


def extract_profiles(parsed: DataFrame, type_: str, strict: bool = False, lenient: bool = False) -> DataFrame:
    """``key, handle, id`` per profile of the wanted type that has a handle or an id.

    An invalid handle is blank; a record with an array but no such profile gives one row with blanks; a
    record without array gives none. ``lenient`` only lower-cases the handle, keeps profiles with neither and
    gives no blank rows. A handle or id that is not text raises when ``strict``, else is blank.
    """
    wanted = _wanted(type_)
    if not lenient:
        wanted = F.filter(wanted, lambda p: _has(p, "username") | _has(p, "id"))
    kept = parsed.where(F.col("status") == "ok")
    return compute_once(kept, "key", _rows(wanted, strict, lenient).alias("rows")).select("key", F.inline("rows"))


def _counters() -> dict[str, Column]:
    """The ten counters of an extraction over the lines of ``_chosen``."""
    ok = F.col("status") == "ok"
    emitted, out = F.col("emitted"), F.when(ok, F.size("emitted"))
    wanted = F.when(ok, F.size("wanted"))
    return {
        "records": F.count(F.lit(1)),
        "no_profiles": F.count_if(F.col("status") == "no_profiles"),
        "of_type": total(wanted),
        "other_type": total(F.col("size") - wanted),
        "tuples": total(out),
        "with_0": F.count_if(out == 0),
        "with_1": F.count_if(out == 1),
        "with_2": F.count_if(out == 2),
        "with_n": F.count_if(out > 2),
        "no_id": total(F.when(ok, F.size(F.filter(emitted, lambda p: ~_has(p, "id"))))),
    }


def extract_counted(parsed: DataFrame, type_: str, strict: bool = False, lenient: bool = False) -> Counted:
    """The rows of ``extract_profiles`` and, from the same pass, the counters of ``profile_counters``.

    Lines are counted before those without a profile go; there is no second scan and no shuffle.
    """
    lines, seen = watched(_chosen(parsed, type_), _counters())
    kept = lines.where(F.col("status") == "ok")
    rows = _rows(F.col("wanted" if lenient else "emitted"), strict, lenient)
    return Counted(compute_once(kept, "key", rows.alias("rows")).select("key", F.inline("rows")), seen, list(_counters()))


def profile_counters(parsed: DataFrame, type_: str) -> DataFrame:
    """The ten counters of an extraction as ``counter, n`` rows, from one aggregate."""
    wide = _chosen(parsed, type_).agg(*[c.alias(n) for n, c in _counters().items()])
    return rows_of(wide, "counter", "n", [(c, F.col(c)) for c in wide.columns]).select("counter", "n")


# Fixed values (rows appended for places, which the dictionary does not translate)
GEO_FIELDS = {
    "standard": (("State", "g_state", "state"), ("Metro Area", "residence_metro_area", "metro_area")),
    "partner1": (("State", "state", "state"), ("Metro Area", "metro_area", "metro_area")),
}
CODE_FIELD = ("DMA", "g_dma_code")

_ENTRY = (
    "struct<name:string,title:string,displayable:array<string>,category:string,children:array<string>,"
    "datasource:string,list:array<struct<title:string,value:string>>>"
)


def flatten_dictionary(docs: DataFrame, source: str, codes: DataFrame | None = None, value: str = "value") -> DataFrame:
    """Data dictionary documents (a map of field to entry) to one row per field value.

    ``title, field, value, value_name, displayable, category, source, children``. The title is the prettified
    name, else the title of the entry; a null category is ``Indiv``. Geography rows of the source are added, for
    the standard source also one row per line of ``codes`` (``code,description`` text, split once).
    """
    entries = docs.select(F.explode(F.from_json(value, f"map<string,{_ENTRY}>")).alias("field", "e"))
    rows = entries.select("field", "e", F.inline("e.list").alias("value_name", "value")).select(
        F.trim(F.coalesce(pretty_title("e.name"), F.col("e.title"))).alias("title"),
        "field",
        F.trim("value").alias("value"),
        F.trim("value_name").alias("value_name"),
        F.coalesce(F.exists("e.displayable", lambda d: F.trim(d) == "excel_xml"), F.lit(False)).alias("displayable"),
        F.trim(F.coalesce("e.category", F.lit("Indiv"))).alias("category"),
        F.col("e.datasource").alias("source"),
        F.coalesce(F.transform("e.children", lambda c: F.trim(c)), F.array().cast("array<string>")).alias("children"),
    )
    none = F.array().cast("array<string>").alias("children")
    geo = GEO_FIELDS.get(source, ())
    if geo:
        cells = [
            F.struct(F.lit(t).alias("title"), F.lit(f).alias("field"), F.lit(v).alias("value"), F.lit(v).alias("value_name"))
            for t, f, v in geo
        ]
        fixed = docs.sparkSession.range(1).select(F.inline(F.array(*cells)))
        rows = rows.unionByName(
            fixed.select("*", F.lit(True).alias("displayable"), F.lit("Geo").alias("category"), F.lit(source).alias("source"), none)
        )
    if source == "standard" and codes is not None:
        parts = F.split("value", ",", 2)
        rows = rows.unionByName(
            codes.select(
                F.lit(CODE_FIELD[0]).alias("title"),
                F.lit(CODE_FIELD[1]).alias("field"),
                F.get(parts, F.lit(0)).alias("value"),
                F.get(parts, F.lit(1)).alias("value_name"),
                F.lit(True).alias("displayable"),
                F.lit("Geo").alias("category"),
                F.lit(source).alias("source"),
                none,
            )
        )
    return rows
