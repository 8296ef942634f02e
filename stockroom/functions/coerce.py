"""Lenient type coercion for landed values: a bad value becomes NULL, never an error.

Strict casts belong to staging, where a value that still does not fit fails the job.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Text forms accepted as a number. Digits may be grouped by single
# underscores; type suffixes such as ``3d``, which a plain cast would accept, are not numbers.
_DIGITS = r"[0-9]+(_[0-9]+)*"
_FLOAT = rf"^[+-]?(({_DIGITS})(\.({_DIGITS})?)?|\.{_DIGITS})([eE][+-]?{_DIGITS})?$"
_SPECIAL = r"^(?i)[+-]?(inf|infinity|nan)$"
_INTEGER = rf"^[+-]?{_DIGITS}$"


def _is_text(c: Column) -> Column:
    return F.typeof(c) == "string"


def _text(c: Column) -> Column:
    return F.regexp_replace(c.cast("string"), r"^\s+|\s+$", "")


def coerce_bool(c: Column) -> Column:
    """True for the text ``true`` in any case, false for any other value, NULL stays NULL."""
    return F.lower(c.cast("string")) == "true"


def coerce_decimal(c: Column) -> Column:
    """Number or numeric text to DOUBLE; anything else NULL."""
    text = _text(c)
    number = F.regexp_replace(text, "_", "").try_cast("double")
    parsed = F.when(text.rlike(_FLOAT) | text.rlike(_SPECIAL), number)
    return F.when(_is_text(c), parsed).otherwise(c.try_cast("double"))


def coerce_int(c: Column) -> Column:
    """Whole number to BIGINT: text must be an integer, a number is cut toward zero.

    Infinity and NaN have no integer value and become NULL.
    """
    text = _text(c)
    parsed = F.when(text.rlike(_INTEGER), F.regexp_replace(text, "_", "").try_cast("bigint"))
    number = c.try_cast("double")
    cut = F.when(~F.isnan(number), F.when(_is_text(c), None).otherwise(c).try_cast("bigint"))
    return F.when(_is_text(c), parsed).otherwise(cut)


def coerce_quantity(c: Column) -> Column:
    """Quantities pass through a decimal first, so ``'3.7'`` becomes 3."""
    return coerce_int(coerce_decimal(c))


def coerce_ts(c: Column) -> Column:
    """ISO text to TIMESTAMP in the session zone; unreadable text becomes NULL."""
    return c.try_cast("timestamp")


# Which landed fields each rule applies to.
BOOLEAN_FIELDS = ("is_deleted",)
DECIMAL_FIELDS = ("unit_price", "cost_price", "amount_paid", "discount_amount", "total_amount")
QUANTITY_FIELDS = ("quantity",)
INTEGER_FIELDS = ("stock_quantity",)
TIMESTAMP_FIELDS = (
    "created_at",
    "updated_at",
    "effective_from",
    "registered_at",
    "ordered_at",
    "paid_at",
    "shipped_at",
    "delivered_at",
    "cancelled_at",
    "moved_at",
)

RULES: Mapping[str, object] = {
    **dict.fromkeys(BOOLEAN_FIELDS, coerce_bool),
    **dict.fromkeys(DECIMAL_FIELDS, coerce_decimal),
    **dict.fromkeys(QUANTITY_FIELDS, coerce_quantity),
    **dict.fromkeys(INTEGER_FIELDS, coerce_int),
    **dict.fromkeys(TIMESTAMP_FIELDS, coerce_ts),
}


def coerce(df: DataFrame, rules: Mapping[str, object] = RULES) -> DataFrame:
    """Apply the rule of every known column in one projection; other columns pass through."""
    return df.withColumns({c: rules[c](F.col(c)) for c in df.columns if c in rules})
