"""Linear trend with prediction intervals for any number of series in one aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions.measures import month_from_number, month_number

Z_95 = 1.96


def fill_missing_months(series: DataFrame, keys: Sequence[str], month: str, values: Sequence[str]) -> DataFrame:
    """Adds the months a series lacks between its first and last one, with value 0."""
    span = series.groupBy(*keys).agg(F.min(month).alias("_first"), F.max(month).alias("_last"))
    every = span.select(
        *keys, F.explode(F.expr("sequence(_first, _last, interval 1 month)")).alias(month)
    )
    filled = every.join(series, [*keys, month], "left")
    return filled.na.fill(0, subset=list(values))


def fit_trend(series: DataFrame, keys: Sequence[str], month: str, value: str) -> DataFrame:
    """One row of least-squares statistics per series; months count on one running scale."""
    t = month_number(F.col(month)).cast("double")
    y = F.col(value).cast("double")
    return series.groupBy(*keys).agg(
        F.regr_count(y, t).alias("_n"),
        F.regr_slope(y, t).alias("_slope"),
        F.regr_avgx(y, t).alias("_mean_t"),
        F.regr_avgy(y, t).alias("_mean_y"),
        F.regr_sxx(y, t).alias("_sxx"),
        F.regr_sxy(y, t).alias("_sxy"),
        F.regr_syy(y, t).alias("_syy"),
        F.max(month_number(F.col(month))).alias("_last"),
    )


def predict(fitted: DataFrame, keys: Sequence[str], periods: int, z: float = Z_95) -> DataFrame:
    """The next `periods` months of each series: month, forecast, lower, upper.

    y(t) = mean_y + slope (t - mean_t); half-width
    z * s * sqrt(1 + 1/n + (t - mean_t)^2 / Sxx) with s^2 = SSE / (n - 2).
    The interval is NULL for fewer than 3 points or no spread in time.
    """
    n = F.col("_n").cast("double")
    offset = F.col("_t") - F.col("_mean_t")
    point = F.col("_mean_y") + F.col("_slope") * offset
    # Rounding can leave a perfect fit with a tiny negative remainder.
    sse = F.greatest(F.col("_syy") - F.col("_slope") * F.col("_sxy"), F.lit(0.0))
    spread = F.sqrt(F.lit(1.0) + F.lit(1.0) / n + F.try_divide(offset * offset, F.col("_sxx")))
    usable = (F.col("_n") >= 3) & (F.col("_sxx") > 0)
    half = F.when(usable, F.lit(z) * F.sqrt(sse / F.greatest(n - 2, F.lit(1.0))) * spread)
    return (
        fitted.withColumn("_step", F.explode(F.sequence(F.lit(1), F.lit(periods))))
        .withColumn("_t", F.col("_last") + F.col("_step"))
        .select(
            *keys,
            month_from_number(F.col("_t")).alias("month"),
            point.alias("forecast"),
            (point - half).alias("lower"),
            (point + half).alias("upper"),
        )
    )


def forecast_months(
    series: DataFrame,
    keys: Sequence[str],
    month: str,
    value: str,
    periods: int,
    *,
    fill: str = "none",
    z: float = Z_95,
) -> DataFrame:
    """Forecast of monthly series. `fill="zero"` counts absent months as 0, "none" skips them."""
    if fill not in ("none", "zero"):
        raise ValueError(f"fill must be 'none' or 'zero', not {fill!r}")
    if fill == "zero":
        series = fill_missing_months(series, keys, month, [value])
    return predict(fit_trend(series, keys, month, value), keys, periods, z)


def inside(value: Column, low: Column, high: Column) -> Column:
    """True where the value lies in a known interval; False where the interval is NULL."""
    return F.coalesce(value.between(low, high), F.lit(False))
