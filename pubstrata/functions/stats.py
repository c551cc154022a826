"""Statistical column helpers shared by the metric operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

# spreads below this are floating-point noise, treated as zero (no z-score)
ZERO_SPREAD = 1e-12


def safe_div(num: Column, den: Column) -> Column:
    """num / den, NULL when den is 0 or NULL (DuckDB ``x / NULLIF(y, 0)``)."""
    return F.try_divide(num.cast("double"), F.when(den != 0, den.cast("double")))


def with_global_stats(df: DataFrame, aggs: dict[str, Column]) -> DataFrame:
    """Attach one-row global aggregates of ``df`` to every row of ``df``.

    The aggregate is computed map-side-partial then merged to one row; the
    one-row side is broadcast (size bound: exactly one row) and joined on a
    constant key, so no partition ever has to hold all rows of ``df``.
    """
    stats = df.agg(*[c.alias(n) for n, c in aggs.items()]).withColumn("__one", F.lit(1))
    return (
        df.withColumn("__one", F.lit(1))
        .join(F.broadcast(stats), "__one")
        .drop("__one")
    )


def zscore(df: DataFrame, value: str, out: str, kind: str = "pop") -> DataFrame:
    """(x - mean) / std over all rows of ``df``; NULL when std is 0/NULL.

    ``kind='pop'`` uses the population deviation (impact family),
    ``kind='samp'`` the sample deviation (trend family).
    """
    sd = F.stddev_pop(value) if kind == "pop" else F.stddev_samp(value)
    g = with_global_stats(df, {"__mu": F.avg(value), "__sd": sd})
    spread = F.when(F.col("__sd").isNotNull() & (F.col("__sd") >= ZERO_SPREAD), F.col("__sd"))
    return g.withColumn(out, F.try_divide(F.col(value) - F.col("__mu"), spread)).drop("__mu", "__sd")


def ols_slope(n: Column, sx: Column, sxx: Column, sy: Column, sxy: Column) -> Column:
    """Least-squares slope from raw sums; 0.0 when x has no spread."""
    den = sxx - sx * sx / n
    return F.when(F.abs(den) < ZERO_SPREAD, F.lit(0.0)).otherwise((sxy - sx * sy / n) / den)


def finalize(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every floating column (and -0.0 -> 0.0) for stable comparison."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            cols.append((F.round(F.col(f.name).cast("double"), digits) + F.lit(0.0)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def best_first(df: DataFrame, value: str = "metric", *ties: str) -> DataFrame:
    """Rows by falling ``value``; NaN and then NULL come last (Spark alone puts NaN first), ``ties`` rise within equal values.

    A range-partitioned sort: no task holds the whole frame.
    """
    v = F.col(value)
    place = F.when(v.isNull(), 2).when(F.isnan(v), 1).otherwise(0)
    return df.orderBy(place, v.desc(), *[F.col(t) for t in ties])
