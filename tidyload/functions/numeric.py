"""Rounding that gives the same double in every engine.

``round`` differs between engines on ties (Spark rounds the shortest decimal
string half-up, others round the binary value), so figures that are compared
across engines use explicit formulas:

* ``ratio(n, d, k)`` — a count ratio rounded half-up on the EXACT rational
  n/d: ``(2·n·10^k + d) div (2·d) / 10^k`` in decimal arithmetic, exact for
  counts up to 10^18.
* ``exact_sum(x, n)`` — the sum of doubles (each ``n`` times) without rounding on
  the way: a value is cut into its whole part and two 48-bit pieces of its fraction,
  each a whole number that is exact as a double; the pieces are summed as longs of 21
  bits each, in any order and over any partitions, and put together as decimals at the
  end. Exact to 2^-96 for values below 2^63 and up to 2^42 of them (an error beyond, in
  ANSI mode); larger values are added as doubles.
* ``round_half_up(x, k)`` — ``floor(x·10^k + 0.5) / 10^k`` on a double, which
  also agrees with Python's ``round`` on binary values such as 2.675.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(n, d, digits: int, empty: float = 0.0) -> Column:
    n, d = _c(n).cast("decimal(19,0)"), _c(d).cast("decimal(19,0)")
    scale = 10 ** digits
    top = n * F.lit(2 * scale).cast("decimal(8,0)") + d
    q = F.call_function("div", top, F.when(d > 0, d * F.lit(2).cast("decimal(1,0)")))
    return F.when(d > 0, q / F.lit(float(scale))).otherwise(F.lit(empty))


def round_half_up(x, digits: int) -> Column:
    scale = float(10 ** digits)
    return F.floor(_c(x) * scale + 0.5) / scale


LIMB = float(1 << 48)
LARGE = float(1 << 63)
SUM_BITS = 21


def exact_sum(x, n=None) -> Column:
    """The sum of a double column, the same whatever the order and partitions; null
    without values. ``n`` (a whole number): how often each value counts."""
    x = _c(x)
    size = F.abs(x)
    fits = F.coalesce(size < LARGE, F.lit(False))
    times = F.when(x < 0, F.lit(-1)).otherwise(F.lit(1)).cast("long") * (F.lit(1) if n is None else _c(n)).cast("long")
    whole = F.when(fits, F.floor(size))
    rest = F.when(fits, size - whole.cast("double"))
    upper = F.floor(rest * LIMB)
    parts = [whole, upper, F.floor((rest * LIMB - upper.cast("double")) * LIMB)]
    total = F.lit(0.0)
    for i, part in enumerate(parts):
        summed = F.lit(0).cast("decimal(38,0)")
        for low in range(0, 48 if i else 63, SUM_BITS):
            piece = F.sum(F.shiftright(part, low).bitwiseAND(F.lit((1 << SUM_BITS) - 1)) * times)
            summed = summed + F.coalesce(piece, F.lit(0)).cast("decimal(19,0)") * F.lit(1 << low).cast("decimal(14,0)")
        total = summed.cast("double") * (LIMB ** -i) + (total if i else F.lit(0.0))
    weight = F.lit(1.0) if n is None else _c(n).cast("double")
    large = F.sum(F.when(~fits & x.isNotNull(), x * weight))
    return F.when(F.count(x) > 0, total + F.coalesce(large, F.lit(0.0)))
