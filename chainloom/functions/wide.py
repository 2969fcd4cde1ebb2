"""Exact arithmetic on whole numbers of up to 40 digits, which no DECIMAL holds.

A number travels as plain text. Inside an expression it is cut into limbs of 18 digits, most significant first; sums of
limb products and remainders times 10^18 stay below 38 digits, so DECIMAL arithmetic on limbs is exact. Everything is
built-in expressions; loops over limbs are ``aggregate`` calls of fixed length.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Digits of the widest stored whole number, of a limb, and of fractions shown and valued.
WIDE_DIGITS, LIMB, PLACES, VALUE_PLACES = 40, 18, 18, 12
_D = "decimal(38,0)"


def whole_text(text: Column) -> Column:
    """Canonical text of a whole number of at most 40 digits: no plus sign, no leading zeros; else NULL."""
    digits = F.regexp_extract(text, r"^[+-]?0*([0-9]+?)\z", 1)
    fits = text.rlike(r"^[+-]?[0-9]+\z") & (F.length(digits) <= WIDE_DIGITS)
    return F.when(fits, F.when(text.startswith("-") & (digits != "0"), F.concat(F.lit("-"), digits)).otherwise(digits))


def _magnitude(text: Column) -> Column:
    return F.regexp_replace(text, "^-", "")


def _negative(text: Column) -> Column:
    return text.startswith("-")


def _limbs(digits: Column, n: int) -> list[Column]:
    """``n`` limbs of a text of digits."""
    padded = F.lpad(digits, n * LIMB, "0")
    return [F.substring(padded, 1 + i * LIMB, LIMB).cast(_D) for i in range(n)]


def _unit() -> Column:
    return F.lit("1" + "0" * LIMB).cast(_D)


def _exact(n: Column, by: Column) -> Column:
    """The whole part of ``n / by``: what is left after the remainder divides without rounding."""
    return ((n - n % by) / by).cast(_D)


def _text_of(limbs: Column) -> Column:
    return F.array_join(F.transform(limbs, lambda x: F.lpad(x.cast("string"), LIMB, "0")), "")


def _carried(sums: Column) -> Column:
    """Limbs, most significant first, of sums that may each exceed a limb; one more limb is in front."""
    kind = f"struct<c:{_D},out:array<{_D}>>"
    start = F.struct(F.lit(0).cast(_D).alias("c"), F.array().cast(f"array<{_D}>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        total = (acc["c"] + x).cast(_D)
        low = (total % _unit()).cast(_D)
        return F.struct(_exact(total, _unit()).alias("c"), F.concat(F.array(low), acc["out"]).alias("out")).cast(kind)

    return F.aggregate(F.reverse(sums), start.cast(kind), step, lambda acc: F.concat(F.array(acc["c"]), acc["out"]))


def _shown(digits: Column, places: int, negative: Column, cut: int = 0) -> Column:
    """Digits as a number with ``places`` places, the last ``cut`` digits left out."""
    split = rf"^0*([0-9]+)([0-9]{{{places}}})[0-9]{{{cut}}}\z"
    signed = F.concat(F.when(negative, "-").otherwise(""), F.regexp_replace(digits, split, "$1.$2"))
    return F.regexp_replace(signed, r"^-(0\.0+)\z", "$1")


def quotient_text(amount: Column, factor: Column) -> Column:
    """``amount / factor`` as text with 18 places, rounded half away from zero.

    ``amount`` is canonical text, ``factor`` a whole number from 1 to 10^18; NULL for other factors.
    """
    factor = factor.cast(_D)
    kind = f"struct<r:{_D},q:array<{_D}>>"
    start = F.struct(F.lit(0).cast(_D).alias("r"), F.array().cast(f"array<{_D}>").alias("q")).cast(kind)
    limbs = F.array(*_limbs(_magnitude(amount), 3), F.lit(0).cast(_D))  # one limb more for the places

    def step(acc: Column, x: Column) -> Column:
        whole = (acc["r"] * _unit() + x).cast(_D)
        return F.struct((whole % factor).cast(_D).alias("r"), F.concat(acc["q"], F.array(_exact(whole, factor))).alias("q")).cast(kind)

    def rounded(acc: Column) -> Column:
        up = F.when(acc["r"] * 2 >= factor, 1).otherwise(0).cast(_D)
        last = F.element_at(acc["q"], -1) + up
        return _text_of(_carried(F.concat(F.slice(acc["q"], 1, 3), F.array(last.cast(_D)))))

    digits = F.aggregate(limbs, start, step, rounded)
    return F.when(amount.isNotNull() & (factor >= 1) & (factor <= _unit()), _shown(digits, PLACES, _negative(amount)))


def product_text(shown: Column, price: Column) -> Column:
    """A number with 18 places (text) times a DECIMAL(38,18), as text with 12 places, rounded half away from zero."""
    price = price.cast("decimal(38,18)")
    size = F.abs(price)
    whole = F.floor(size).cast("decimal(20,0)")
    # a fraction may print with an exponent, so it is made a whole number first
    places = ((size % F.lit(1).cast("decimal(1,0)")) * F.lit("1" + "0" * PLACES).cast("decimal(19,0)")).cast(_D)
    a = _limbs(F.replace(_magnitude(shown), F.lit("."), F.lit("")), 4)
    b = [*_limbs(whole.cast("string"), 2), places]
    sums = [_sum([a[i] * b[s - i] for i in range(4) if 0 <= s - i < 3]) for s in range(6)]
    # half a unit of the last place kept: 36 places become 12, so it lies in the limb before the last
    cut = 2 * PLACES - VALUE_PLACES
    sums[-2] = (sums[-2] + F.lit(5 * 10 ** (cut - 1 - LIMB)).cast(_D)).cast(_D)
    valued = _shown(_text_of(_carried(F.array(*sums))), VALUE_PLACES, _negative(shown) != (price < 0), cut)
    return F.when(shown.isNotNull() & price.isNotNull(), valued)


def _sum(terms: list[Column]) -> Column:
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total.cast(_D)


def order_key(text: Column) -> Column:
    """A struct that sorts canonical texts by value."""
    size = F.length(_magnitude(text))
    flipped = F.translate(_magnitude(text), "0123456789", "9876543210")
    return F.struct((~_negative(text)).alias("up"), F.when(_negative(text), -size).otherwise(size).alias("size"),
                    F.when(_negative(text), flipped).otherwise(text).alias("digits"))


def difference_text(a: Column, b: Column) -> Column:
    """``a - b`` of canonical texts as canonical text."""
    la, lb = (F.array(*_limbs(_magnitude(x), 3)) for x in (a, b))
    same = _negative(a) == _negative(b)
    a_larger = _text_of(la) >= _text_of(lb)
    big, small = F.when(a_larger, la).otherwise(lb), F.when(a_larger, lb).otherwise(la)

    def borrowed() -> Column:
        kind = f"struct<c:{_D},out:array<{_D}>>"
        start = F.struct(F.lit(0).cast(_D).alias("c"), F.array().cast(f"array<{_D}>").alias("out")).cast(kind)

        def step(acc: Column, x: Column) -> Column:
            left = (x + acc["c"]).cast(_D)
            low = F.when(left < 0, left + _unit()).otherwise(left).cast(_D)
            return F.struct(F.when(left < 0, -1).otherwise(0).cast(_D).alias("c"), F.concat(F.array(low), acc["out"]).alias("out")).cast(kind)

        parts = F.zip_with(big, small, lambda x, y: (x - y).cast(_D))
        return F.aggregate(F.reverse(parts), start, step, lambda acc: acc["out"])

    added = _carried(F.zip_with(la, lb, lambda x, y: (x + y).cast(_D)))
    digits = F.regexp_replace(_text_of(F.when(same, borrowed()).otherwise(added)), "^0+(?=[0-9])", "")
    negative = F.when(same, _negative(a) != ~a_larger).otherwise(_negative(a))
    signed = F.concat(F.when(negative & (digits != "0"), "-").otherwise(""), digits)
    return F.when(a.isNotNull() & b.isNotNull(), signed)
