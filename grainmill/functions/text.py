"""Portable text expressions: character classes are spelled out, so other engines agree with Spark on them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A letter, mark, digit or underscore of any script.
WORD_CHAR = r"[\p{L}\p{M}\p{N}_]"
#: Anything but ASCII white space.
TOKEN = r"[^ \t\n\x0B\f\r]+"
BLANKS = r"[ \t\n\x0B\f\r]+"


def text_of(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def count_of(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def token_count(text: Column) -> Column:
    """Number of stretches between white space."""
    return count_of(text, TOKEN)


def stripped(text: Column) -> Column:
    """Without white space at both ends; trim() takes off spaces alone."""
    return F.regexp_replace(text, r"^[ \t\n\x0B\f\r]+|[ \t\n\x0B\f\r]+$", "")


def safe_ratio(a: Column, b: Column) -> Column:
    """a / b, 0 where b is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def percent(a: Column, b: Column) -> Column:
    return F.round(safe_ratio(a, b) * 100, 6)


def rounded(value: Column) -> Column:
    return F.round(value.cast("double"), 6)


def preview(text: Column, chars: int = 500) -> Column:
    return F.substring(F.regexp_replace(text, BLANKS, " "), 1, chars)


def slug(text: Column, default: str = "unknown") -> Column:
    cleaned = F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9._-]+", "-"), "^-+|-+$", "")
    return F.coalesce(F.nullif(cleaned, F.lit("")), F.lit(default))


def source_name(text: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(text)), "_", "-")


def sample_uid(id_col: str, scheme: str = "doc") -> Column:
    return F.concat(F.lit(f"{scheme}://"), F.col(id_col).cast("string"))


def sample_key(uid: Column) -> Column:
    """The first 15 hex digits of the uid's SHA-256 as a number below 2^62."""
    return (F.conv(F.substring(F.sha2(uid, 256), 1, 15), 16, 10).cast("long") % (1 << 62)).cast("long")


def month_bucket(date: Column) -> Column:
    return F.when(F.substring(date, 5, 1) == "-", F.substring(date, 1, 7)).otherwise("unknown")


def forum_time(text: Column) -> Column:
    """Two forum formats, twelve-hour first; ISO with an offset; anything else is null."""
    return F.coalesce(F.try_to_timestamp(text, F.lit("d-M-yyyy hh:mm a")), F.try_to_timestamp(text, F.lit("d-M-yyyy HH:mm")), F.try_to_timestamp(text))


def int32_or_null(text: Column) -> Column:
    value = text.try_cast("long")
    return F.when(value.between(-(2**31), 2**31 - 1), value.cast("int"))
