"""Scalar expressions shared by the models. All stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: text standing for NULL inside a surrogate key.
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"

# Fixed value: timestamps enter keys with all six fraction digits.
KEY_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"

# Fixed value: ends a packed text that is no key, which so has more than a packed key's 16 bytes.
_OTHER = bytes(17)


def full_name(first: Column, last: Column) -> Column:
    """``first last``; NULL when either part is NULL."""
    return F.concat(first, F.lit(" "), last)


def timestamp_text(c: Column) -> Column:
    return F.date_format(c, KEY_TIMESTAMP_FORMAT)


def surrogate_key(*parts: Column) -> Column:
    """MD5 over the text of all parts; NULL and empty text give different keys.

    Pass timestamps through :func:`timestamp_text`.
    """
    texts = [F.coalesce(p.cast("string"), F.lit(NULL_KEY_PART)) for p in parts]
    return F.md5(F.concat_ws("-", *texts))


def pack_key(key: Column) -> Column:
    """A text in as few bytes as it can: 32 hex digits as 16 bytes, others longer than that."""
    other = F.concat(key.cast("binary"), F.lit(_OTHER))
    return F.when(key.rlike("^[0-9a-f]{32}\\z"), F.unhex(key)).otherwise(other)


def unpack_key(packed: Column) -> Column:
    """The text :func:`pack_key` was given."""
    other = F.substring(packed, F.lit(1), F.octet_length(packed) - len(_OTHER)).cast("string")
    return F.when(F.octet_length(packed) == 16, F.lower(F.hex(packed))).otherwise(other)


def pack_id(text: Column) -> Column:
    """A text in few bytes: two characters a byte where it has digits and hyphens only."""
    digits = F.replace(text, F.lit("-"), F.lit("A"))
    # F stands for no character: it begins a packed text and fills it up to whole bytes.
    filled = F.concat(F.when(F.length(text) % 2 == 1, "F").otherwise("FF"), digits)
    other = F.concat(F.lit(b"\0"), text.cast("binary"))
    return F.when(text.rlike("^[0-9-]*\\z"), F.unhex(filled)).otherwise(other)


def unpack_id(packed: Column) -> Column:
    """The text :func:`pack_id` was given."""
    digits = F.hex(packed)
    text = F.replace(F.ltrim(digits, F.lit("F")), F.lit("A"), F.lit("-"))
    other = F.substring(packed, F.lit(2), F.octet_length(packed)).cast("string")
    return F.when(digits.startswith("F"), text).otherwise(other)


def whole_days(start: Column, end: Column) -> Column:
    """Whole 24-hour days from ``start`` to ``end``, cut toward zero; NULL if either is NULL."""
    return F.extract(F.lit("DAY"), end - start).cast("int")


def money(c: Column) -> Column:
    return c.cast("decimal(10,2)")
