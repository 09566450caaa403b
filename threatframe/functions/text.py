"""Text helpers: exact number formatting and titles."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_UNIT = 1 << 53


def fixed(value: Column, digits: int = 1) -> Column:
    """Decimal text of a non-negative double, rounded the way C and Python format it.

    ``format_string`` rounds the shortest decimal text half up, so 92.25 becomes 92.3; here the
    binary fraction itself decides and exact ties go to the even digit (92.2). Up to 3 digits.
    The value is first brought to 9 decimals, which removes noise from the order of summation.
    """
    scale = 10 ** digits

    def units(clean):
        whole = F.floor(clean).cast("bigint")
        fraction = (clean - whole) * float(_UNIT)
        bits = fraction.cast("bigint")
        small = (fraction - bits) * scale
        scaled = bits * scale + small.cast("bigint")
        kept, rest = F.shiftright(scaled, 53), scaled % _UNIT
        above_tie = (kept % 2 == 1) | (small > small.cast("bigint"))
        up = (rest > _UNIT // 2) | ((rest == _UNIT // 2) & above_tie)
        return whole * scale + kept + F.when(up, 1).otherwise(0)

    def shown(number):
        tail = number % scale
        head = ((number - tail) / scale).cast("bigint")
        return F.concat(head.cast("string"), F.lit("."), F.lpad(tail.cast("string"), digits, "0"))

    return once(once(F.round(value.cast("double"), 9), units), shown)


def once(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body has it."""
    return F.transform(F.array(value), body)[0]


def percent(value: Column, digits: int = 1) -> Column:
    """A share as a percentage, such as ``85.0%``."""
    return F.concat(fixed(value * 100, digits), F.lit("%"))


def title(value: Column) -> Column:
    """``brute_force_attack`` as ``Brute Force Attack``."""
    return F.initcap(F.replace(value, F.lit("_"), F.lit(" ")))


def listed(values: Column, empty: str = "N/A") -> Column:
    return F.when(F.size(values) > 0, F.array_join(values, ", ")).otherwise(F.lit(empty))


def lines(*parts: Column) -> Column:
    """Join the non-null parts by line breaks."""
    return F.concat_ws("\n", *parts)
