"""Scalar expressions. Everything here stays inside the JVM."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values (profile addresses and identifier shape)
HANDLE_PATTERN = r"^@?([a-z0-9_]{1,15})$"
PROFILE_URL_PREFIX = "https://twitter.com/"
PROFILE_URL_BY_ID = "https://twitter.com/intent/user?user_id="

def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def jround(c: Column | str) -> Column:
    """Round half toward positive infinity (``round`` in Spark goes away from zero)."""
    return F.floor(_col(c) + F.lit(0.5)).cast("bigint")


def trunc_to(c: Column | str, step: int) -> Column:
    """Whole multiples of ``step``, cut toward zero."""
    n = _col(c).cast("bigint")
    return n - n % F.lit(step)


def pct_change(old: Column | str, new: Column | str) -> Column:
    """Change in percent of the old value, two places half up; 0/0 is NaN and x/0 is infinite."""
    a, b = _col(old).cast("double"), _col(new).cast("double")
    diff = b - a
    at_zero = (
        F.when(diff == 0, F.lit(float("nan"))).when(diff > 0, F.lit(float("inf"))).otherwise(F.lit(float("-inf")))
    )
    return F.when(a == 0, at_zero).otherwise(F.round(diff / F.when(a != 0, a) * 100, 2))


def pct_of(n: Column | str, d: Column | str) -> Column:
    """``n`` in percent of ``d``, two places; null when ``d`` is zero."""
    den = _col(d).cast("double")
    return F.round(_col(n).cast("double") / F.when(den != 0, den) * 100, 2)


def pct_text(n: Column | str, d: Column | str, sign: str = "%") -> Column:
    """``pct_of`` as text with two decimals; null when ``d`` is zero."""
    return F.when(_col(d) != 0, F.concat(F.format_string("%.2f", pct_of(n, d)), F.lit(sign)))


def norm_handle(c: Column | str) -> Column:
    """Lower-case handle without ``@``; null when it is not a valid handle."""
    found = F.regexp_extract(F.lower(F.trim(_col(c))), HANDLE_PATTERN, 1)
    return F.nullif(found, F.lit(""))


def handle_or_bare(c: Column | str) -> Column:
    """Normalised handle, else the text itself without ``@``."""
    return F.coalesce(norm_handle(c), F.replace(_col(c), F.lit("@"), F.lit("")))


def handle_url(c: Column | str) -> Column:
    """Profile address; the bare prefix when the handle is not valid."""
    return F.concat(F.lit(PROFILE_URL_PREFIX), F.coalesce(norm_handle(c), F.lit("")))


def _named_entities() -> Column:
    """Code points of the named HTML 4 entities."""
    return F.create_map(*[F.lit(x) for pair in sorted(name2codepoint.items()) for x in pair])


def _unescaped(piece: Column, named: Column) -> Column:
    """What follows an ampersand, with the reference it may start with resolved; else as it was."""
    name = F.regexp_extract(piece, r"\A([A-Za-z][A-Za-z0-9]*);", 1)
    decimal = F.regexp_extract(piece, r"\A#0*([0-9]{1,7});", 1)
    hexadecimal = F.regexp_extract(piece, r"\A#[xX]0*([0-9A-Fa-f]{1,6});", 1)
    code = F.coalesce(
        F.try_element_at(named, name),
        F.nullif(decimal, F.lit("")).cast("int"),
        F.conv(F.nullif(hexadecimal, F.lit("")), 16, 10).cast("int"),
    )
    valid = code.between(0, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return F.when(valid, F.concat(char, F.regexp_replace(piece, r"\A[^;]*;", ""))).otherwise(F.concat(F.lit("&"), piece))


def html_unescape(c: Column | str) -> Column:
    """Named HTML 4, decimal and hexadecimal character references resolved in one pass from left to right.

    A reference needs its semicolon; an unknown name, a surrogate or a number beyond Unicode stays as it is, and what a
    reference yields is not read again.
    """
    pieces, named = F.split(_col(c), "&"), _named_entities()
    rest = F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0)))
    return F.array_join(F.concat(F.slice(pieces, 1, 1), F.transform(rest, lambda p: _unescaped(p, named))), "")


def ascii_only(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), r"[^\x00-\x7F]", "")


def squish(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), r"[^A-Za-z0-9_]", "")


def first_non_empty(*cols: Column | str) -> Column:
    return F.coalesce(*[F.nullif(F.trim(_col(c)), F.lit("")) for c in cols])


def pretty_title(c: Column | str) -> Column:
    spaced = F.replace(_col(c), F.lit("_"), F.lit(" "))
    return F.concat(F.upper(F.substring(spaced, 1, 1)), F.substring(spaced, 2, 2**31 - 1))


def dsl_term(c: Column | str) -> Column:
    """Search field text back to the term it was built from; null for other fields."""
    s = _col(c)
    quoted = F.regexp_replace(F.regexp_replace(s, '^text:"', ""), '"$', "")
    return (
        F.when(s.startswith("mentions_twids:"), F.regexp_replace(s, "^mentions_twids:", ""))
        .when(s.startswith("hashtags:"), F.concat(F.lit("#"), F.regexp_replace(s, "^hashtags:", "")))
        .when(s.startswith("text:"), quoted)
    )


def stamp(c: Column | str) -> Column:
    return F.date_format(_col(c), "yyyyMMddHHmmss")


def day(c: Column | str) -> Column:
    return F.date_format(_col(c), "yyyyMMdd")


def iso(c: Column | str) -> Column:
    return F.date_format(_col(c), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def pad(c: Column | str, n: int) -> Column:
    """Right-pad an array of text with blanks up to ``n`` entries."""
    arr = _col(c)
    return F.concat(arr, F.array_repeat(F.lit(""), F.greatest(F.lit(n) - F.size(arr), F.lit(0))))


def csv_line(*cols: Column | str) -> Column:
    """One line of quote-escaped text; nulls become blanks."""

    def cell(c: Column) -> Column:
        s = F.coalesce(c.cast("string"), F.lit(""))
        quoted = F.concat(F.lit('"'), F.replace(s, F.lit('"'), F.lit('""')), F.lit('"'))
        return F.when(s.rlike('[",\r\n]'), quoted).otherwise(s)

    return F.concat_ws(",", *[cell(_col(c)) for c in cols])


def unquote_number(c: Column | str) -> Column:
    """Number from text that may be quoted; blank counts as zero."""
    bare = F.replace(_col(c), F.lit('"'), F.lit(""))
    return F.coalesce(F.nullif(bare, F.lit("")).cast("double"), F.lit(0.0))


def drop_commas(c: Column | str) -> Column:
    return F.replace(_col(c), F.lit(","), F.lit(""))


def counter_json(counters: Sequence[tuple[str, Column]]) -> Column:
    """JSON object of named counters; spaces in names become underscores."""
    return F.to_json(F.struct(*[c.cast("bigint").alias(n.replace(" ", "_")) for n, c in counters]))


def chain(df: DataFrame, *steps: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Apply transformations from left to right."""
    return reduce(lambda d, f: d.transform(f), steps, df)
