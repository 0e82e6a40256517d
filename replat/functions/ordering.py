"""Orders as single numbers: a double and a position in one decimal of fixed width."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A double has 52 bits of fraction; its exponent goes from -1022 to 1023.
_FRACTION, _LEAST, _MOST = 52, -1022, 1023
#: Positions must be below this.
POSITIONS = 1 << 62


def ordered_bits(value: Column) -> Column:
    """A bigint for each double, in the doubles' own order: exponent and fraction, negated for negative values.

    Both zeros are 0, infinities stand at the ends, and not-a-number is above all others, as in Spark's own
    order. Every step is exact: powers of two are, and so is scaling by one.
    """
    size = F.abs(value)
    usual = F.greatest(F.lit(_LEAST), F.least(F.lit(_MOST), F.floor(F.log2(size)).cast("int")))
    # the logarithm is rounded, so near a power of two it may be one off
    high = F.when(size < F.pow(F.lit(2.0), usual), usual - 1)
    high = high.when((usual < _MOST) & (size / 2 >= F.pow(F.lit(2.0), usual)), usual + 1).otherwise(usual)
    fraction = (size / F.pow(F.lit(2.0), high) - 1) * float(1 << _FRACTION)
    normal = (high - _LEAST + 1).cast("bigint") * (1 << _FRACTION) + fraction.cast("bigint")
    tiny = (size * 2.0**537 * 2.0**537).cast("bigint")
    top = (_MOST - _LEAST + 2) << _FRACTION
    bits = (
        F.when(F.isnan(value), F.lit(top + 1))
        .when(size == float("inf"), F.lit(top))
        .when(size < 2.0**_LEAST, tiny)
        .otherwise(normal)
    )
    return F.when(value.isNotNull(), F.when(value < 0, -bits).otherwise(bits))


def first_of_largest(value: Column, position: Column) -> Column:
    """DECIMAL(38, 0) whose maximum belongs to the largest value and, among equal ones, to the first position.

    64 bits of the value stand above 62 of the position, which together stay below 10 ** 38.
    """
    above = ordered_bits(value).cast("decimal(20,0)") + F.lit(Decimal(1 << 63))
    return above * F.lit(Decimal(POSITIONS)) + F.lit(Decimal(POSITIONS - 1)) - position.cast("decimal(19,0)")
