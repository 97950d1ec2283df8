"""Scalar functions over text, numbers and lists as column expressions; null handling is stated per function."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_of(c) -> Column:
    """The text, empty for null."""
    return F.coalesce(_col(c), F.lit(""))


def words(c) -> Column:
    """Lower-case runs of letters, digits and underscores; a null text has none."""
    return F.regexp_extract_all(F.lower(text_of(c)), F.lit(r"([\p{L}\p{N}_]+)"), F.lit(1))


def word_count(c) -> Column:
    """Words parted by any Unicode white space."""
    return F.size(F.filter(F.split(text_of(c), r"(?U)\s+"), lambda x: x != ""))


def space_word_count(c) -> Column:
    """Words parted by spaces only, as a spreadsheet counts them: 0 for an empty text."""
    t = F.trim(F.regexp_replace(text_of(c), " +", " "))
    return F.when(t == "", 0).otherwise(F.length(t) - F.length(F.replace(t, F.lit(" "))) + 1)


def bare(c, chars: str = " .!?") -> Column:
    """Lower case without the given characters at both ends."""
    return F.btrim(F.lower(text_of(c)), F.lit(chars))


def mentions(c, pattern: str) -> Column:
    """Whether a pattern is found, letter case aside; false for null."""
    return F.coalesce(_col(c).rlike(f"(?iu){pattern}"), F.lit(False))


def has_substring(c, *needles: str) -> Column:
    """Whether one of the texts is inside, letter case aside."""
    t, out = F.lower(text_of(c)), F.lit(False)
    for n in needles:
        out = out | t.contains(n.lower())
    return out


def yes_no(flag: Column) -> Column:
    return F.when(flag, "ya").otherwise("tidak")


def prefix(c, n: int) -> Column:
    return F.substring(_col(c), 1, n)


def pick_media_url(urls) -> Column:
    """First address with ``.mp4`` in it, else the first, else null."""
    u = F.array_distinct(_col(urls))
    return F.coalesce(F.get(F.filter(u, lambda x: x.contains(".mp4")), F.lit(0)), F.get(u, F.lit(0)))


def file_stem(c) -> Column:
    """Base name without its last suffix."""
    return F.regexp_replace(F.regexp_extract(_col(c), r"([^/\\]*)$", 1), r"\.[^.]*$", "")


def media_stem(platform, post_id) -> Column:
    return F.concat_ws("_", F.coalesce(_col(platform), F.lit("unknown")), _col(post_id))


def no_carriage_return(c) -> Column:
    return F.translate(text_of(c), "\r", " ")


def decimal_comma(c) -> Column:
    """One decimal with a comma; empty for null."""
    return F.coalesce(F.replace(F.format_string("%.1f", F.round(_col(c), 1)), F.lit("."), F.lit(",")), F.lit(""))


def mmss(c) -> Column:
    """Minutes and two-digit seconds, rounded down."""
    t = _col(c)
    return F.format_string("%d:%02d", F.floor(t / 60).cast("int"), F.floor(t - F.floor(t / 60) * 60).cast("int"))


def whole(c) -> Column:
    """No decimals, halves to even."""
    return F.format_string("%.0f", F.bround(_col(c), 0))


def percent(c) -> Column:
    return F.concat(F.format_string("%.0f", F.bround(_col(c) * 100, 0)), F.lit("%"))


def differs(a, b) -> Column:
    """Inequality in which two nulls are equal."""
    return ~_col(a).eqNullSafe(_col(b))


def joined(parts: Column, sep: str) -> Column:
    """Texts joined without nulls and empty ones."""
    return F.array_join(F.filter(parts, lambda x: x.isNotNull() & (x != "")), sep)


def language_hint(c, known: tuple[str, ...] = ("id", "en")) -> Column:
    return F.when(_col(c).isin(list(known)), _col(c))


def host(c) -> Column:
    return F.try_parse_url(_col(c), F.lit("HOST"))


def key_value(c) -> Column:
    """Struct of key and value, parted at the first ``=``."""
    parts = F.split(_col(c), "=", 2)
    return F.struct(parts[0].alias("key"), F.get(parts, F.lit(1)).alias("value"))


def ratio(a, b) -> Column:
    """a / b; 0 where it can't be computed."""
    return F.coalesce(F.try_divide(_col(a).cast("double"), _col(b).cast("double")), F.lit(0.0))
