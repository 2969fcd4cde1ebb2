"""Number parsing as native column expressions (no UDF).

The source texts come from a strict decoder, while Spark's casts trim blanks, accept type
suffixes and turn overflow into infinity. Each parser therefore checks the text first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_INTEGER = r"^[+-]?[0-9]+\z"
_FINITE_FLOAT = (
    r"^[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"
    r"|0[xX]([0-9a-fA-F]+\.?[0-9a-fA-F]*|\.[0-9a-fA-F]+)[pP][+-]?[0-9]+)\z"
)
_WORD_FLOAT = r"(?i)^([+-]?(inf|infinity)|nan)\z"
_PLAIN_INTEGER = r"^-?[0-9]+\z"
_ZERO_FRACTION = r"^[^.]*\.0*\z"
_EDGE_BLANKS = r"^\s+|\s+\z"
_INT_MIN, _INT_MAX = -(1 << 31), (1 << 31) - 1
_SHORT_MIN, _SHORT_MAX = -(1 << 15), (1 << 15) - 1


def parse_int_or_null(text: Column) -> Column:
    """Base-10 64-bit integer with optional sign; anything else, or out of range, is NULL."""
    return F.when(text.rlike(_INTEGER), text.try_cast("bigint"))


def parse_int_or_zero(text: Column) -> Column:
    """As :func:`parse_int_or_null` with invalid text read as 0."""
    return F.coalesce(parse_int_or_null(text), F.lit(0).cast("bigint"))


def parse_float_or_null(text: Column) -> Column:
    """Strict float text; finite text that overflows a double is NULL."""
    value = text.try_cast("double")
    finite = F.when(F.abs(value) != F.lit(float("inf")), value)
    return F.when(text.rlike(_FINITE_FLOAT), finite).when(text.rlike(_WORD_FLOAT), value)


def parse_fraction(text: Column) -> Column:
    """``a/b`` or plain float text as FLOAT; empty, malformed, or ``b = 0`` is NULL."""
    slash = F.instr(text, "/")
    top = parse_float_or_null(F.substring(text, F.lit(1), slash - 1))
    bottom = parse_float_or_null(F.substring(text, slash + 1, F.length(text)))
    quotient = F.when(bottom != 0, F.try_divide(top, bottom))
    return F.when(slash > 0, quotient).otherwise(parse_float_or_null(text)).cast("float")


def clean_integer(text: Column) -> Column:
    """Integer text, or a decimal whose fraction is all zeros, as integer text; else NULL.

    The part before a dot is returned unchecked: the caller decides what a non-number means.
    """
    whole = F.substring_index(text, ".", 1)
    return F.when(text.rlike(_PLAIN_INTEGER), text).when(
        text.rlike(_ZERO_FRACTION), F.when(whole.isin("", "-"), F.lit("0")).otherwise(whole)
    )


def parse_decimal_text(text: Column) -> Column:
    """Trimmed plain decimal text; "" is "0", a bare leading dot gets a zero, exponents are NULL."""
    trimmed = F.regexp_replace(text, _EDGE_BLANKS, "")
    padded = F.regexp_replace(trimmed, r"^(-?)\.", "$10.")
    return F.when(trimmed == "", F.lit("0")).when(
        padded.rlike(r"^[+-]?[0-9]+(\.[0-9]*)?\z"), padded
    )


def parse_price(text: Column) -> Column:
    """Price text as DECIMAL(38,18); NULL when it is no plain decimal or does not fit."""
    return parse_decimal_text(text).try_cast("decimal(38,18)")


def fits_int(value: Column) -> Column:
    return value.between(_INT_MIN, _INT_MAX)


def fits_short(value: Column) -> Column:
    return value.between(_SHORT_MIN, _SHORT_MAX)


def display_amount(amount: Column, factor: Column) -> Column:
    """``amount / factor`` exact to 18 places, as DECIMAL(38,18).

    One DECIMAL(38,0) division would keep only six places, so the whole and the rest are
    divided apart. The rest is below the factor, which is at most 10^18.
    """
    amount = amount.cast("decimal(38,0)")
    factor = factor.cast("decimal(38,0)")
    rest = amount % factor
    whole = F.try_divide(amount - rest, factor).try_cast("decimal(38,18)")
    part = F.try_divide(rest.try_cast("decimal(19,0)"), factor.try_cast("decimal(19,0)"))
    return F.try_add(whole, part).try_cast("decimal(38,18)")


def value_usd(shown: Column, price: Column) -> Column:
    """Display amount times price, as DECIMAL(38,12); ``shown`` should be a stored column.

    A product of two DECIMAL(38,18) keeps only six places, so whole and fractional parts are
    multiplied apart; each product below stays within 38 digits.
    """
    price = price.cast("decimal(38,18)")
    shown_whole, price_whole = (F.floor(c).cast("decimal(19,0)") for c in (shown, price))
    shown_part = (shown - shown_whole).cast("decimal(18,18)")
    price_part = (price - price_whole).cast("decimal(18,18)")
    terms = [
        shown_whole * price_whole,
        shown_whole * price_part,
        shown_part * price_whole,
        shown_part * price_part,
    ]
    # three additions of DECIMAL(34,12) still fit 38 digits at scale 12
    narrowed = [t.try_cast("decimal(34,12)") for t in terms]
    return (narrowed[0] + narrowed[1] + narrowed[2] + narrowed[3]).cast("decimal(38,12)")
