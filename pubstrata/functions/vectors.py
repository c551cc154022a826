"""Vector column expressions on ``array<float|double>`` columns (JVM-side, codegen-friendly).

Spark 4.1 has no vector_* SQL functions, so these are built from the
higher-order array functions (``aggregate``, ``transform``, ``zip_with``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HALF_MAX_EXP = 15
HALF_MIN_NORMAL = 2.0 ** -14
HALF_SUBNORMAL_STEP = 2.0 ** -24
HALF_OVERFLOW = 65520.0  # values at or above round to infinity in binary16


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def sq_norm(v) -> Column:
    return F.aggregate(_c(v), F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))


def norm(v) -> Column:
    return F.sqrt(sq_norm(v))


def dot(a, b) -> Column:
    prod = F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(prod, F.lit(0.0), lambda acc, x: acc + x)


def l2_normalize(v, eps: float = 1e-12) -> Column:
    """v / max(||v||, eps) element-wise, as doubles."""
    n = F.greatest(norm(v), F.lit(eps))
    return F.transform(_c(v), lambda x: x.cast("double") / n)


def half_round_scalar(x: Column) -> Column:
    """Round a double to the nearest IEEE binary16 value (ties to even), returned as double.

    Normal range: 11 significant bits, step 2^(e-10) for |x| in [2^e, 2^(e+1));
    subnormal range: fixed step 2^-24; |x| >= 65520 overflows to +-infinity.
    """
    a = F.abs(x)
    e0 = F.floor(F.log2(a))
    # correct the exponent where log2 rounds across a power of two
    e = (
        F.when(F.pow(F.lit(2.0), e0) > a, e0 - 1)
        .when(F.pow(F.lit(2.0), e0 + 1) <= a, e0 + 1)
        .otherwise(e0)
    )
    step = F.when(a < HALF_MIN_NORMAL, F.lit(HALF_SUBNORMAL_STEP)).otherwise(F.pow(F.lit(2.0), e - 10))
    q = F.rint(a / step) * step
    q = F.when(a >= HALF_OVERFLOW, F.lit(float("inf"))).otherwise(q)
    return F.when(x.isNull() | F.isnan(x) | (x == 0), x).otherwise(F.signum(x) * q)


def half_round(v) -> Column:
    """Element-wise binary16 rounding of an array, kept as float32 (half values are exact in float32)."""
    return F.transform(_c(v), lambda x: half_round_scalar(x.cast("double")).cast("float"))


def dim_ok(v, dim: int) -> Column:
    return F.size(_c(v)) == F.lit(int(dim))
