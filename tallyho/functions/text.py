"""Text renderings of summary values, as column expressions (no Python per row)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyho.functions.stats import int_div

# The awk number text uses 6 significant digits (its default
# output format "%.6g"); exponent form below 1e-4; byte units of the size
# estimate and their format "%3.1f %s".
SIG_DIGITS = 6
BYTE_UNITS = ["bytes", "KiB", "MiB", "GiB"]

# Decimal exponents handled: 10**1 down to 10**-17 (a nonzero mean of one-decimal
# values is at least 1/(10*count), so this covers up to 1e16 rows per station).
_HIGHEST_EXPONENT, _LOWEST_EXPONENT = 1, -17


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _dec(v: int) -> Column:
    return F.lit(Decimal(v))


def _pow10(e: Column, dtype: str) -> Column:
    # 10**e is exact in a double for 0 <= e <= 22.
    return F.pow(F.lit(10.0), e).cast(dtype)


def _strip_zeros(digits: Column) -> Column:
    return F.regexp_replace(digits, "0+$", "")


def with_awk_mean_text(df: DataFrame, sum_tenths: str, count: str, out: str) -> DataFrame:
    """Add ``out``: P9 mean text of ``sum/count`` (sum in tenths), 6 significant digits.

    Rounded from the exact quotient, half away from zero, trailing zeros and a
    bare point dropped (integers print without a point), exponent form below
    1e-4.  Integer arithmetic on DECIMAL(38,0), so no double rounding: the
    decimal exponent comes from exact comparisons, then one scaled integer
    division gives the six digits.  Staged over three projections so each
    intermediate is computed once.
    """
    s, n = F.col(sum_tenths), F.col(count)
    p = SIG_DIGITS - 1
    a = F.abs(s).cast("decimal(38,0)")
    den = n.cast("decimal(38,0)") * _dec(10)
    x = None
    for e in range(_HIGHEST_EXPONENT, _LOWEST_EXPONENT - 1, -1):
        cond = (a * _dec(10 ** max(0, -e))) >= (den * _dec(10 ** max(0, e)))
        x = F.when(cond, F.lit(e)) if x is None else x.when(cond, F.lit(e))
    x = x.otherwise(F.lit(_LOWEST_EXPONENT))
    step1 = df.withColumn("_x", x)
    # a / den < 10**(x+1), so a * 10**(p-x) < den * 10**(p+1): fits DECIMAL(38,0).
    mant = int_div(a * _pow10(F.lit(p) - F.col("_x"), "decimal(38,0)") * _dec(2) + den,
                   den * _dec(2))
    step2 = step1.withColumn("_m", mant)
    bump = F.col("_m") >= F.lit(10 ** SIG_DIGITS)
    step3 = step2.withColumns({
        "_m": F.when(bump, int_div(F.col("_m"), F.lit(10))).otherwise(F.col("_m")),
        "_x": F.when(bump, F.col("_x") + 1).otherwise(F.col("_x")),
    })
    m, xc = F.col("_m"), F.col("_x")
    d = F.greatest(F.lit(p) - xc, F.lit(0))
    unit = _pow10(d, "bigint")
    frac = _strip_zeros(F.call_function("lpad", (m % unit).cast("string"), d, F.lit("0")))
    fixed = F.concat(int_div(m, unit).cast("string"),
                     F.when(frac != "", F.concat(F.lit("."), frac)).otherwise(F.lit("")))
    rest = _strip_zeros(F.lpad((m % F.lit(10 ** p)).cast("string"), p, "0"))
    expo = F.concat(int_div(m, F.lit(10 ** p)).cast("string"),
                    F.when(rest != "", F.concat(F.lit("."), rest)).otherwise(F.lit("")),
                    F.lit("e-"), F.lpad((-xc).cast("string"), 2, "0"))
    body = F.concat(F.when(s < 0, F.lit("-")).otherwise(F.lit("")),
                    F.when(xc >= -4, fixed).otherwise(expo))
    text = F.when(n > 0, F.when(s == 0, F.lit("0")).otherwise(body))
    return step3.withColumn(out, text).drop("_x", "_m")


def human_bytes(num) -> Column:
    """Size text ``"%3.1f <unit>"`` with 1024-based units; NULL from 1024 GiB up.

    Python's ``%.1f`` rounds the exact binary value half to even; ``bround``
    does the same on the (exactly divided) double.
    """
    v = _c(num).cast("double")
    expr = None
    for i, unit in enumerate(BYTE_UNITS):
        scaled = v / F.lit(float(1024 ** i))
        text = F.concat(F.format_string("%3.1f", F.bround(scaled, 1)), F.lit(" " + unit))
        cond = scaled < F.lit(1024.0)
        expr = F.when(cond, text) if expr is None else expr.when(cond, text)
    return expr


def triple_text(mn, mean, mx) -> Column:
    """``min/mean/max`` from one-decimal decimals; a NULL is an empty field."""
    return delimited("/", mn, mean, mx)


def delimited(sep: str, *columns) -> Column:
    """Fields as text with ``sep`` between them; a NULL is an empty field, never a missing one."""
    return F.concat_ws(sep, *[F.coalesce(_c(c).cast("string"), F.lit("")) for c in columns])
