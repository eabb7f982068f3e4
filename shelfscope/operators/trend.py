"""I-family: monthly series, OLS trend, seasonality, month-over-month change,
margin drift and monthly P&L.

A *series* is a DataFrame ``(period, value)``.  Series are one row per month,
so the few windows here that order the whole series run over a table whose
size is the number of periods, never the number of transactions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import clip_lower, div, safe_corr, trend_direction
from ..functions.pvalues import t_two_sided_udf


def monthly_sum(tx: DataFrame, value: str, period: str = "period") -> DataFrame:
    """Σ value per period."""
    return tx.groupBy(F.col(period).alias("period")).agg(F.sum(value).alias("value"))


def monthly_ratio(tx: DataFrame, num: str, den: str, period: str = "period",
                  scale: float = 100.0, floor: float = 1.0) -> DataFrame:
    """Ratio of sums per period, denominator floored (I6 margin %)."""
    return tx.groupBy(F.col(period).alias("period")).agg(
        (F.sum(num) / clip_lower(F.sum(den), floor) * F.lit(scale)).alias("value"))


def monthly_distinct(tx: DataFrame, key: str, period: str = "period") -> DataFrame:
    """Distinct active keys per period."""
    return tx.groupBy(F.col(period).alias("period")).agg(
        F.count_distinct(key).cast("double").alias("value"))


def efficiency_series(revenue: DataFrame, spend: DataFrame, period: str = "period",
                      revenue_col: str = "revenue", spend_col: str = "spend") -> DataFrame:
    """I8: per period Σ revenue ÷ max(Σ spend, 1), inner-aligned on period."""
    r = revenue.groupBy(F.col(period).alias("period")).agg(F.sum(revenue_col).alias("r"))
    s = spend.groupBy(F.col(period).alias("period")).agg(F.sum(spend_col).alias("s"))
    return r.join(s, "period").select("period", (F.col("r") / clip_lower("s", 1.0)).alias("value"))


def _indexed(series: DataFrame) -> DataFrame:
    # positional index 0..n-1 over the sorted periods (series-sized window)
    return series.withColumn("x", (F.row_number().over(Window.orderBy("period")) - 1).cast("double"))


def ols_trend(series: DataFrame) -> DataFrame:
    """Least-squares line of value on the period index.

    One row: n_periods, slope, intercept, r_squared, t_stat, df,
    first_value, last_value, pct_change (÷|first|, 0 when first is 0)."""
    agg = _indexed(series).agg(
        F.count("value").alias("n_periods"),
        F.regr_slope("value", "x").alias("slope"),
        F.regr_intercept("value", "x").alias("intercept"),
        safe_corr("value", "x").alias("r"),
        F.min_by("value", "x").alias("first_value"),
        F.max_by("value", "x").alias("last_value"),
    )
    r2 = F.col("r") * F.col("r")
    n = F.col("n_periods")
    return agg.select(
        "n_periods", "slope", "intercept",
        r2.alias("r_squared"),
        F.when(n > 2, F.col("r") * F.sqrt(div(n - 2, F.lit(1.0) - r2))).alias("t_stat"),
        (n - 2).alias("df"),
        "first_value", "last_value",
        F.when(F.col("first_value") != 0,
               (F.col("last_value") - F.col("first_value")) / F.abs("first_value") * 100)
        .otherwise(F.lit(0.0)).alias("pct_change"),
    )


def with_trend_test(trend: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Two-sided p for the slope and the stable/growing/declining label."""
    p = F.when(F.col("r_squared") >= 1.0, F.lit(0.0)).otherwise(
        t_two_sided_udf(F.col("t_stat"), F.col("df").cast("double")))
    return (trend.withColumn("p_value", p)
            .withColumn("direction", trend_direction("slope", "p_value", alpha)))


def seasonal_index(series: DataFrame, min_periods: int = 12) -> DataFrame:
    """I4: month value ÷ its year's mean (floored at 1e-9), averaged per
    calendar month.  Empty when the series has fewer than ``min_periods``."""
    w_year = Window.partitionBy(F.year("period"))
    w_all = Window.partitionBy()
    idx = (series
           .withColumn("n_all", F.count(F.lit(1)).over(w_all))
           .where(F.col("n_all") >= min_periods)
           .withColumn("year_avg", F.avg("value").over(w_year))
           .withColumn("idx", F.col("value") / clip_lower("year_avg", 1e-9)))
    return idx.groupBy(F.month("period").alias("month")).agg(F.avg("idx").alias("seasonal_index"))


def seasonal_peaks(series: DataFrame, min_periods: int = 12) -> DataFrame:
    """Peak / trough calendar month of the seasonal index (ties → the
    earliest month); NULLs when the series is too short."""
    si = seasonal_index(series, min_periods)
    return si.agg(
        F.max(F.struct(F.col("seasonal_index").alias("v"), (-F.col("month")).alias("m"))).alias("hi"),
        F.min(F.struct(F.col("seasonal_index").alias("v"), F.col("month").alias("m"))).alias("lo"),
    ).select((-F.col("hi.m")).cast("int").alias("peak_month"),
             F.col("lo.m").cast("int").alias("trough_month"))


def trend_summary(series: DataFrame, metric: str, with_test: bool = False) -> DataFrame:
    """Trend line + seasonal peaks in one row, labelled by metric."""
    t = ols_trend(series)
    if with_test:
        t = with_trend_test(t)
    return (t.crossJoin(F.broadcast(seasonal_peaks(series)))  # 1 row × 1 row
            .select(F.lit(metric).alias("metric"), "*"))


def mom_change(series: DataFrame) -> DataFrame:
    """Month-over-month % change and up/down sign."""
    w = Window.orderBy("period")
    prev = F.lag("value").over(w)
    return (series.withColumn("prev_value", prev)
            .withColumn("pct_change", F.when(F.col("prev_value") != 0,
                                             (F.col("value") / F.col("prev_value") - 1) * 100))
            .withColumn("direction", F.when(F.col("pct_change").isNull(), F.lit(None))
                        .when(F.col("pct_change") >= 0, "up").otherwise("down")))


def monthly_pnl(tx: DataFrame, revenue: str = "gross_revenue", profit: str = "gross_profit",
                period: str = "period") -> DataFrame:
    """Revenue, profit and margin % per period."""
    return tx.groupBy(F.col(period).alias("period")).agg(
        F.sum(revenue).alias("revenue"), F.sum(profit).alias("profit"),
    ).withColumn("margin_pct", F.when(F.col("revenue") != 0,
                                      F.col("profit") / F.col("revenue") * 100))


def margin_drift(pnl: DataFrame, n_months: int = 12) -> DataFrame:
    """Ratio-of-sums margin over the first vs the last ``n_months``
    periods, and the revenue change between those windows."""
    first = F.dense_rank().over(Window.orderBy("period"))
    last = F.dense_rank().over(Window.orderBy(F.col("period").desc()))
    tagged = pnl.withColumn("rk_first", first).withColumn("rk_last", last)
    head = F.col("rk_first") <= n_months
    tail = F.col("rk_last") <= n_months
    agg = tagged.agg(
        F.sum(F.when(head, F.col("profit"))).alias("p0"), F.sum(F.when(head, F.col("revenue"))).alias("r0"),
        F.sum(F.when(tail, F.col("profit"))).alias("p1"), F.sum(F.when(tail, F.col("revenue"))).alias("r1"),
    )
    return agg.select(
        F.lit(n_months).alias("n_months"),
        (div("p0", "r0") * 100).alias("margin_first"),
        (div("p1", "r1") * 100).alias("margin_last"),
        ((div("p1", "r1") - div("p0", "r0")) * 100).alias("margin_change_pp"),
        F.col("r0").alias("revenue_first"), F.col("r1").alias("revenue_last"),
        F.when(F.col("r0") != 0, (F.col("r1") / F.col("r0") - 1) * 100).alias("revenue_change_pct"),
    )


def margin_line_fit(series: DataFrame) -> DataFrame:
    """Per period the value, the fitted OLS line and the series mean."""
    ix = _indexed(series)
    w = Window.partitionBy()
    n = F.count(F.lit(1)).over(w)
    mx, my = F.avg("x").over(w), F.avg("value").over(w)
    sxy = F.sum(F.col("x") * F.col("value")).over(w) - n * mx * my
    sxx = F.sum(F.col("x") * F.col("x")).over(w) - n * mx * mx
    slope = F.when(sxx != 0, sxy / sxx)
    return ix.select("period", "value",
                     (my + slope * (F.col("x") - mx)).alias("fitted"),
                     my.alias("mean_value"))


def margin_drift_mean(pnl: DataFrame, n_months: int = 3) -> DataFrame:
    """I11 (report variant): mean of the monthly margins over the first vs the
    last ``n_months`` periods and the relative change in %.  The month-grained
    P&L is bounded by the horizon, so the period ranks are series-sized."""
    m = pnl.withColumn("_m", div("profit", "revenue") * 100)
    tagged = (m.withColumn("_f", F.row_number().over(Window.orderBy("period")))
              .withColumn("_l", F.row_number().over(Window.orderBy(F.col("period").desc()))))
    a = tagged.agg(F.avg(F.when(F.col("_f") <= n_months, F.col("_m"))).alias("margin_start_pct"),
                   F.avg(F.when(F.col("_l") <= n_months, F.col("_m"))).alias("margin_end_pct"))
    return a.select(F.lit(n_months).alias("n_months"), "margin_start_pct", "margin_end_pct",
                    (div(F.col("margin_end_pct") - F.col("margin_start_pct"), F.col("margin_start_pct")) * 100)
                    .alias("margin_change_pct"))
