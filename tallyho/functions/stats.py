"""Exact aggregate state for decimal(3,1) measures.

The state per group is (min, max, sum DECIMAL(18,1), count).  The sum input is
widened to DECIMAL(8,1), so Catalyst evaluates it as a long sum of unscaled
tenths: exact, order-free and a primitive add inside whole-stage codegen; ANSI
mode raises instead of wrapping on overflow (past 1e17, i.e. about 1e15 rows
of one station).

The mean is rounded once, from the exact quotient, half away from zero:
    mean_tenths = sign(s) * ((2*|s| + n) div (2*n))
which is what ``CAST(AVG(x) AS DECIMAL(3,1))`` means, without the double rounding
of Spark's ``avg(decimal)`` (decimal(7,5) first, then (3,1)).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyho.schema import MEASURE_DECIMAL, SUM_DECIMAL


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def tenths(measure) -> Column:
    """Unscaled value of a one-decimal measure as BIGINT (12.3 -> 123).

    Through a double (|x| < 1e15 is exact after ``rint``), which stays a
    primitive op instead of a BigDecimal multiply.
    """
    return F.rint(_c(measure).cast("double") * F.lit(10.0)).cast("bigint")


def from_tenths(t, dtype=MEASURE_DECIMAL) -> Column:
    """BIGINT tenths back to a one-decimal DECIMAL (exact)."""
    return (_c(t).cast("decimal(20,0)") / F.lit(10)).cast(dtype)


def int_div(a, b) -> Column:
    """Integral division (SQL ``div``): truncates toward zero, BIGINT result."""
    return F.call_function("div", _c(a), _c(b))


def rounded_mean_tenths(sum_tenths, count) -> Column:
    """Exact mean in tenths, half away from zero; NULL when count is 0/NULL."""
    s, n = _c(sum_tenths), _c(count)
    q = int_div(F.abs(s) * 2 + n, n * 2)
    return F.when(n > 0, F.when(s < 0, -q).otherwise(q))


def sum_input(measure) -> Column:
    """Measure widened to DECIMAL(8,1) for summing: Catalyst turns ``sum`` over a
    decimal of precision <= 8 into a plain long sum of unscaled values, typed
    DECIMAL(18,1) (exact up to 1e17, i.e. ~1e15 rows of one station)."""
    return _c(measure).cast("decimal(8,1)")


def state_aggs(measure="measure") -> list[Column]:
    """Partial state over raw measures: min, max, sum DECIMAL(18,1), count.

    The measure is taken as DECIMAL(3,1) (a no-op for such columns; other numeric
    input is rounded to one decimal first, as a decimal read of the text would).
    """
    m = _c(measure).cast(MEASURE_DECIMAL)
    return [
        F.min(m).alias("min"),
        F.max(m).alias("max"),
        F.sum(sum_input(m)).alias("sum"),
        F.count(m).alias("count"),
    ]


def merge_aggs() -> list[Column]:
    """Merge of partial states (associative and commutative)."""
    return [
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        F.sum("sum").cast(SUM_DECIMAL).alias("sum"),
        F.sum("count").alias("count"),
    ]


def sum_tenths(sum_col) -> Column:
    """Unscaled tenths of a one-decimal sum (exact, BIGINT); per group, not per row."""
    return (_c(sum_col).cast(SUM_DECIMAL) * F.lit(10)).cast("bigint")


def exact_mean(sum_col, count, dtype=MEASURE_DECIMAL) -> Column:
    """Mean of a group from its DECIMAL sum and count, rounded once."""
    return from_tenths(rounded_mean_tenths(sum_tenths(sum_col), count), dtype)
