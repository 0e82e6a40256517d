"""On which side of an edge a point lies, exactly, as column expressions on doubles.

The usual difference of two products is right in sign whenever it is larger than its own rounding can be. Only
near the edge's line it is not; there the same determinant is added up without rounding, from products and sums
split into a rounded value and its error. Signs are exact as long as no product of coordinates leaves the range
of doubles (above about 1e300 or, other than zero, below 1e-290).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Half a unit in the last place of 1, and how many of these the plain determinant can be off by, for each unit of its terms.
_HALF_ULP = 2.0**-53
_BOUND = (3 + 16 * _HALF_ULP) * _HALF_ULP
#: Cuts a double into two halves whose products are exact.
_SPLITTER = 2.0**27 + 1
_SMALLEST = 1e-280


def _halves(a: Column) -> tuple[Column, Column]:
    c = a * F.lit(_SPLITTER)
    high = c - (c - a)
    return high, a - high


def _product(a: Column, b: Column) -> list[Column]:
    """Error and rounded value of a product; their sum is the product."""
    p = a * b
    (ah, al), (bh, bl) = _halves(a), _halves(b)
    return [al * bl - (((p - ah * bh) - al * bh) - ah * bl), p]


def _grown(terms: Column, value: Column) -> Column:
    """An expansion (terms that do not overlap, smallest first) with one more value added to it, exactly."""
    start = F.struct(value.alias("rest"), F.array().cast("array<double>").alias("terms"))

    def add(acc: Column, term: Column) -> Column:
        both = acc["rest"] + term
        part = both - acc["rest"]
        error = (acc["rest"] - (both - part)) + (term - part)
        return F.struct(both.alias("rest"), F.when(error == 0, acc["terms"]).otherwise(F.array_append(acc["terms"], error)).alias("terms"))

    return F.aggregate(terms, start, add, lambda acc: F.array_append(acc["terms"], acc["rest"]))


def exact_sum_sign(values: list[Column]) -> Column:
    """Sign (-1.0, 0.0 or 1.0) of the sum of doubles, without rounding."""
    expansion = F.aggregate(F.array(*values), F.array().cast("array<double>"), _grown)
    largest = F.try_element_at(F.filter(expansion, lambda t: t != 0), F.lit(-1))
    return F.coalesce(F.signum(largest), F.lit(0.0))


def side(e: Column, px: Column, py: Column) -> Column:
    """Positive where the point is left of the directed edge, negative right of it, zero on its line."""
    left = (e["x2"] - e["x1"]) * (py - e["y1"])
    right = (px - e["x1"]) * (e["y2"] - e["y1"])
    terms = F.abs(left) + F.abs(right)
    plain = left - right
    sure = (F.abs(plain) > terms * F.lit(_BOUND)) & (terms > F.lit(_SMALLEST))
    exact = exact_sum_sign(
        [
            *_product(e["x2"], py), *_product(-e["x2"], e["y1"]), *_product(-e["x1"], py),
            *_product(-px, e["y2"]), *_product(px, e["y1"]), *_product(e["x1"], e["y2"]),
        ]
    )
    return F.when(sure, plain).when(plain.isNotNull(), exact)
