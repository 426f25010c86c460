"""Numbers as native columns: rounding on a double's exact value (FN35)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPLIT = 134217729.0  # 2 ** 27 + 1: parts a double into two halves whose products are exact


def round_exact(x: Column, places: int) -> Column:
    """x to `places` (0 to 22) decimal places, ties of its exact binary value to even, as Python's round does.

    x * 10^places is a double and an exact remainder, got from products of halves. Only where that double lies half way
    between two integers does the remainder decide, and where it is 0 the even integer. Doubles whose product is from
    2^53 on have no such places and stay; nulls, NaN and infinities stay. The sign of zero is kept.
    """
    # A lambda's variable stands for x in all places, so a long expression is neither repeated nor worked out again.
    return F.get(F.transform(F.array(x.cast("double")), lambda v: _rounded(v, places)), F.lit(0))


def _rounded(x: Column, places: int) -> Column:
    scale = float(10**places)
    high = _SPLIT * scale - (_SPLIT * scale - scale)
    low = scale - high
    a = F.abs(x)
    p = a * scale
    ah = a * _SPLIT - (a * _SPLIT - a)
    rest = ((ah * high - p) + ah * low + (a - ah) * high) + (a - ah) * low
    down = F.floor(p).cast("double")
    tie = p - down == 0.5
    n = F.when(tie & (rest > 0), down + 1).when(tie & (rest < 0), down).otherwise(F.rint(p)) / scale
    return F.when(F.isnan(a) | (x == 0) | (p >= float(2**53)), x).otherwise(F.when(x < 0, -n).otherwise(n))
