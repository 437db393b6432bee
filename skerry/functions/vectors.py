"""Vector expressions on array columns, in double precision."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A literal vector up to this size becomes one arithmetic expression, which is compiled; a longer one a fold.
UNROLLED = 128


def dot(a: Column, b: Column | Sequence[float]) -> Column:
    if isinstance(b, Column):
        return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    if len(b) > UNROLLED:
        return dot(a, F.array(*[F.lit(float(x)) for x in b]))
    total = F.lit(0.0)
    for i, x in enumerate(b):
        total = total + a[i].cast("double") * F.lit(float(x))
    return total


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def unit(a: Column) -> Column:
    """a over its norm; a zero or non-finite norm is an error."""
    n = norm(a)
    checked = F.when((n > 0) & (n < float("inf")), n).otherwise(F.raise_error(F.lit("vector without a finite norm")).cast("double"))
    return F.transform(a, lambda x: x.cast("double") / checked)


def l2(a: Column, b: Column | Sequence[float]) -> Column:
    b = b if isinstance(b, Column) else F.array(*[F.lit(float(x)) for x in b])
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))), F.lit(0.0), lambda s, x: s + x))


def unit_list(vector: Sequence[float], dimension: int) -> list[float]:
    """A query vector of the expected dimension, normalised; otherwise ValueError."""
    if len(vector) != dimension:
        raise ValueError(f"expected {dimension} dimensions, got {len(vector)}")
    n = math.sqrt(sum(float(x) * float(x) for x in vector))
    if not math.isfinite(n) or n == 0:
        raise ValueError("query vector without a finite norm")
    return [float(x) / n for x in vector]


#: Half precision: significant bits behind the first, the smallest exponent of a full number, and the bound of infinity.
HALF_BITS, HALF_LEAST, HALF_ENDS = 10, -14, 65520.0


def half(x: Column) -> Column:
    """x rounded to half precision, ties to even, as a float: small numbers keep fewer bits, 65,520 and beyond are infinite."""
    v = x.cast("double")
    size = F.abs(v)
    guess = F.floor(F.log2(F.when(size > 0, size).otherwise(1.0)))
    two = lambda e: F.pow(F.lit(2.0), e.cast("double"))
    # a logarithm may miss a power of two by one
    exponent = guess + F.when(size >= two(guess + 1), 1).when(size < two(guess), -1).otherwise(0)
    step = two(F.greatest(exponent, F.lit(HALF_LEAST)) - HALF_BITS)
    infinite = F.lit(float("inf")) * F.signum(v)
    return F.when(v.isNull() | F.isnan(v) | (size == 0) | (size == float("inf")), v).when(size >= HALF_ENDS, infinite).otherwise(F.rint(v / step) * step).cast("float")


def half_dot(a: Column, b: Sequence[float]) -> Column:
    """The product of two vectors that are stored in half precision: summed up in order in single precision, and rounded to half."""
    literal = F.transform(F.array(*[F.lit(float(x)) for x in b]), half)
    products = F.zip_with(F.transform(a, half), literal, lambda x, y: x * y)
    return half(F.aggregate(products, F.lit(0.0).cast("float"), lambda s, x: s + x))
