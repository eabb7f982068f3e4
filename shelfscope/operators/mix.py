"""Adstock, spend pivot, ridge marketing-mix fit from covariances,
contributions, ROI, prediction metrics, budget split, channel allocation.

The fit never moves rows to the driver: the design is reduced by Spark to one row of covariances per segment, and the
p×p ridge system of that row is solved by column expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import div

# Fixed adstock decay rates per channel (values that must match the reference).
CHANNEL_DECAY = {"tv": 0.7, "digital": 0.2, "email": 0.1, "radio": 0.5, "outdoor": 0.6,
                 "social": 0.3, "search": 0.15, "print": 0.4}
DEFAULT_DECAY = 0.5
BLOCK = 32  # periods of a block of the decay recurrence


def decay_column(channel: str, mapping: dict[str, str] | None = None):
    """λ per row: channel (optionally renamed through ``mapping``) → decay."""
    c = F.col(channel)
    if mapping:
        c = F.coalesce(F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])[c], c)
    m = F.create_map(*[x for k, v in CHANNEL_DECAY.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(m[c], F.lit(DEFAULT_DECAY))


def adstock(df: DataFrame, keys: list[str], period: str, value: str, decay) -> DataFrame:
    """a_t = x_t + λ·a_{t−1} per series (keys), in period order, over the rows given.  NULL counts as 0."""
    lam = decay if not isinstance(decay, (int, float)) else F.lit(float(decay))
    s = df.groupBy(*keys, period).agg(F.sum(value).alias(value)).withColumn("_lam", lam.cast("double"))
    s = _decayed(s.withColumn("adstock", F.col(value)), keys, period, {"adstock": F.col("_lam")})
    return s.select(*keys, period, F.col(value).cast("double").alias(value), "adstock")


def _decayed(df: DataFrame, keys: list[str], period: str, rates: dict) -> DataFrame:
    """Columns of ``rates`` (name → λ) replaced by their decayed sums along ``period``.

    The recurrence is an associative scan: a series is cut into blocks of ``BLOCK`` rows, a block is reduced to its tail
    (λ^BLOCK carries over it), and a row is its place in the block's own recurrence plus λ^(place + 1) times what the
    tails before carry in.  A row thus sees a block and one tail per earlier block, never the series."""
    series = Window.partitionBy(*keys).orderBy("_row")
    block = Window.partitionBy(*keys, "_block").orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
    d = df.withColumn("_row", F.row_number().over(Window.partitionBy(*keys).orderBy(period)) - 1)
    d = d.withColumns({"_block": F.floor(F.col("_row") / BLOCK), "_place": F.col("_row") % BLOCK})

    def fold(values, rate):
        return F.aggregate(values, F.lit(0.0), lambda a, x: a * rate + x)
    own = {c: fold(F.collect_list(F.coalesce(F.col(c).cast("double"), F.lit(0.0))).over(block), lam) for c, lam in rates.items()}
    d = d.withColumns(own)
    tails = {c: F.collect_list(F.when(F.col("_place") == BLOCK - 1, F.col(c))).over(series.rowsBetween(Window.unboundedPreceding, -1)) for c in rates}
    d = d.withColumns({f"_in_{c}": fold(t, F.pow(rates[c], F.lit(BLOCK))) for c, t in tails.items()})
    carried = {c: F.col(c) + F.pow(lam, F.col("_place") + 1) * F.col(f"_in_{c}") for c, lam in rates.items()}
    return d.withColumns(carried).drop("_row", "_block", "_place", *[f"_in_{c}" for c in rates])


def adstock_design(design: DataFrame, channels: list[str], decay: dict[str, float], period: str = "period",
                   group: list[str] | None = None) -> DataFrame:
    """Adstock of every channel column of a zero-filled design, in period order per segment
    (one row per period, so a segment's rows are bounded by the horizon)."""
    return _decayed(design, list(group or []), period, {c: F.lit(decay.get(c, DEFAULT_DECAY)) for c in channels})


def spend_pivot(spend: DataFrame, revenue: DataFrame, channels: list[str], period: str = "period",
                min_periods: int = 4, group: list[str] | None = None) -> DataFrame:
    """Period × channel spend (zero filled) aligned (inner) with period revenue, per segment;
    segments with fewer than ``min_periods`` aligned periods are left out."""
    group = list(group or [])
    wide = spend.groupBy(*group, period).pivot("channel", channels).agg(F.sum("spend")).na.fill(0.0, channels)
    rev = revenue.groupBy(*group, period).agg(F.sum("revenue").alias("revenue"))
    j = wide.join(rev, [*group, period])
    n = F.count(F.lit(1)).over(Window.partitionBy(*group))  # one row per period: bounded by the horizon
    return j.withColumn("_n", n).where(F.col("_n") >= min_periods).drop("_n")


def mmm_fit(design: DataFrame, channels: list[str], target: str = "revenue", alpha: float = 1.0,
            group: list[str] | None = None) -> DataFrame:
    """Standardised ridge (α, unpenalised intercept) of target on channel columns.  One row per
    (group, channel): beta (standardised), mean / std of the channel, mean / std of the target, in-sample R²
    (NaN for a constant target).  A constant channel has beta 0.

    Covariances are mergeable aggregates; the p×p system of a group is one row, solved by symmetric
    elimination, a projection per pivot."""
    group = list(group or [])
    p = len(channels)
    upper = [(i, j) for i in range(p) for j in range(i, p)]
    stats = design.groupBy(*[F.col(c).cast("string").alias(c) for c in group]).agg(
        F.count(F.lit(1)).alias("n"), F.avg(target).alias("y_mean"), F.stddev_pop(target).alias("y_std"),
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(channels)], *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(channels)],
        *[F.covar_pop(c, target).alias(f"cy{i}") for i, c in enumerate(channels)],
        *[F.covar_pop(channels[i], channels[j]).alias(f"c{i}_{j}") for i, j in upper])

    def scale(c: str):
        return F.when(F.col(c) > 0, F.col(c)).otherwise(1.0)
    z = stats.withColumns({**{f"zy{i}": F.col("n") * F.col(f"cy{i}") / (scale(f"s{i}") * scale("y_std")) for i in range(p)},
                           **{f"z{i}_{j}": F.col("n") * F.col(f"c{i}_{j}") / (scale(f"s{i}") * scale(f"s{j}")) for i, j in upper}})
    # (Z + αI) β = zy: a holds what is left of the matrix, r of the right side
    left = z.withColumns({**{f"a{i}_{j}": F.col(f"z{i}_{j}") + (alpha if i == j else 0.0) for i, j in upper},
                          **{f"r{i}": F.col(f"zy{i}") for i in range(p)}})
    for k in range(p - 1):
        ratio = {i: div(f"a{k}_{i}", f"a{k}_{k}") for i in range(k + 1, p)}
        left = left.withColumns({**{f"a{i}_{j}": F.col(f"a{i}_{j}") - ratio[i] * F.col(f"a{k}_{j}") for i, j in upper if i > k},
                                 **{f"r{i}": F.col(f"r{i}") - ratio[i] * F.col(f"r{k}") for i in ratio}})
    for i in reversed(range(p)):
        known = sum((F.col(f"a{i}_{j}") * F.col(f"b{j}") for j in range(i + 1, p)), F.lit(0.0))
        left = left.withColumn(f"b{i}", div(F.col(f"r{i}") - known, F.col(f"a{i}_{i}")))
    explained = sum((2 * F.col(f"b{i}") * F.col(f"zy{i}") for i in range(p)), F.lit(0.0)) - sum(
        (F.col(f"b{i}") * F.col(f"b{j}") * F.col(f"z{i}_{j}") * (1.0 if i == j else 2.0) for i, j in upper), F.lit(0.0))
    r2 = F.when(F.col("y_std") > 0, explained / F.col("n")).otherwise(float("nan"))
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("channel"), F.col(f"b{i}").alias("beta"), F.col(f"m{i}").alias("x_mean"),
                                        F.col(f"s{i}").alias("x_std")) for i, c in enumerate(channels)])).alias("_c")
    return left.select(*group, rows, "y_mean", "y_std", r2.alias("r_squared"), "n").select(
        *group, "_c.channel", "_c.beta", "_c.x_mean", "_c.x_std", "y_mean", "y_std", "r_squared", "n")


def mmm_contributions(coef: DataFrame, group: list[str] | None = None) -> DataFrame:
    """max(β, 0) share in % per segment."""
    w = Window.partitionBy(*(group or []))  # one row per channel: bounded
    pos = F.greatest(F.col("beta"), F.lit(0.0))
    tot = F.sum(pos).over(w)
    return coef.withColumn("contribution_pct", F.when(tot > 0, pos / tot * 100).otherwise(0.0))


def mmm_roi(coef: DataFrame, spend_totals: DataFrame, n_channels: int, group: list[str] | None = None) -> DataFrame:
    """|β|·x̄·std(y)·n_channels ÷ Σ spend per channel (the reference's formula, x̄ the mean of the
    channel's design column); 0 without spend."""
    j = coef.join(spend_totals, [*(group or []), "channel"])
    value = F.abs("beta") * F.col("x_mean") * F.col("y_std") * n_channels
    return j.withColumn("roi", F.when(F.col("total_spend") > 0, value / F.col("total_spend")).otherwise(0.0))


def mmm_predict(design: DataFrame, coef: DataFrame, channels: list[str], target: str = "revenue",
                group: list[str] | None = None) -> DataFrame:
    """In-sample prediction ŷ = ȳ + σy·Σ β·(x−x̄)/σx and RMSE / MAE / R² per segment.
    Coefficients are one row per segment and channel."""
    group = list(group or [])
    names = [f"coef_{c}" for c in channels]
    d, c = (design, coef) if group else (design.withColumn("_g", F.lit(1)), coef.withColumn("_g", F.lit(1)))
    keys = group or ["_g"]
    wide = (c.withColumn("_k", F.concat(F.lit("coef_"), F.col("channel")))
            .groupBy(*keys).pivot("_k", names).agg(F.first(F.struct("beta", "x_mean", "x_std"))))
    info = c.groupBy(*keys).agg(F.first("y_mean").alias("ym"), F.first("y_std").alias("ys"))
    d = d.join(wide, keys).join(info, keys)
    z = sum((F.col(f"{k}.beta") * (F.col(ch) - F.col(f"{k}.x_mean")) /
             F.when(F.col(f"{k}.x_std") > 0, F.col(f"{k}.x_std")).otherwise(1.0)
             for ch, k in zip(channels, names)), F.lit(0.0))
    pred = d.withColumn("prediction", F.col("ym") + F.col("ys") * z)
    err = F.col(target) - F.col("prediction")
    return pred.groupBy(*group).agg(F.sqrt(F.avg(err * err)).alias("rmse"), F.avg(F.abs(err)).alias("mae"),
                                    (1 - F.sum(err * err) / (F.count(F.lit(1)) * F.var_pop(target))).alias("r_squared"))


def budget_recommendation(roi: DataFrame, budget: float, default_split: dict[str, float]) -> DataFrame:
    """Budget × ROI share over channels with ROI > 0; the default split
    when no channel has positive ROI."""
    w = Window.partitionBy()  # one row per channel
    pos = F.when(F.col("roi") > 0, F.col("roi")).otherwise(0.0)
    tot = F.sum(pos).over(w)
    dflt = F.create_map(*[x for k, v in default_split.items() for x in (F.lit(k), F.lit(v))])
    share = F.when(tot > 0, pos / tot).otherwise(F.coalesce(dflt[F.col("channel")], F.lit(0.0)))
    return roi.select("channel", "roi", share.alias("share"), (share * budget).alias("recommended_budget"))


def channel_allocation(spend: DataFrame, by: list[str], periods_per_year: float) -> DataFrame:
    """Annualised spend and share by channel (optionally within a segment)."""
    g = spend.groupBy(*by, "channel").agg(F.sum("spend").alias("spend"))
    n_periods = spend.agg(F.count_distinct("period")).scalar()
    w = Window.partitionBy(*by)  # channel rows per segment: bounded by channel count
    return (g.withColumn("annual_spend", F.col("spend") / n_periods * periods_per_year)
            .withColumn("share_pct", div(F.col("spend"), F.sum("spend").over(w)) * 100))


def whatif_marketing(scenarios: DataFrame, spend: DataFrame, baseline: DataFrame, roi: DataFrame,
                     annual: "F.Column", tolerance: float = 0.02, all_label: str = "all") -> DataFrame:
    """O2: marketing reallocation per scenario row set (scenario_id, segment | 'all', channel, new_share).

    ``spend`` (segment, channel, spend), ``baseline`` (segment, revenue, profit, n_stores) and ``roi`` (segment,
    channel, roi) are segment-grained; ``annual`` turns sums into a year.  Shares are normalised when their
    sum is off by more than ``tolerance``.  The ROI of 'all' blends the segments by store count; a channel without
    ROI counts 1.  Revenue lift = annual budget × (new − current weighted ROI), earned at the segment's margin;
    the result is scaled back to the portfolio.  Confidence 0.72."""
    total = baseline.agg(F.struct((F.sum("revenue") * annual).alias("rev"), (F.sum("profit") * annual).alias("profit")).alias("t")).scalar()
    seg = baseline.select("segment", "revenue", "profit").unionByName(
        baseline.agg(F.sum("revenue").alias("revenue"), F.sum("profit").alias("profit")).select(F.lit(all_label).alias("segment"), "*"))
    per = spend.groupBy("segment", "channel").agg(F.sum("spend").alias("spend"))
    per = per.unionByName(per.groupBy("channel").agg(F.sum("spend").alias("spend")).select(F.lit(all_label).alias("segment"), "*"))
    budget = per.groupBy("segment").agg(F.sum("spend").alias("seg_spend"))
    known = roi.join(baseline.select("segment", "n_stores"), "segment")
    blended = known.groupBy("channel").agg((F.sum(F.col("roi") * F.col("n_stores")) / F.sum("n_stores")).alias("roi"))
    rates = roi.select("segment", "channel", "roi").unionByName(blended.select(F.lit(all_label).alias("segment"), "channel", "roi"))
    cur = (per.join(budget, "segment").join(rates, ["segment", "channel"], "left").groupBy("segment").agg(
        F.sum(div("spend", "seg_spend") * F.coalesce("roi", F.lit(1.0))).alias("current_roi"), F.first("seg_spend").alias("seg_spend")))
    sums = scenarios.groupBy("scenario_id").agg(F.sum("new_share").alias("share_sum"))
    share = F.when(F.abs(F.col("share_sum") - 1) > tolerance, div("new_share", "share_sum")).otherwise(F.col("new_share"))
    new = (scenarios.join(sums, "scenario_id").join(rates, ["segment", "channel"], "left").groupBy("scenario_id", "segment").agg(
        F.first("share_sum").alias("share_sum"), F.sum(share * F.coalesce("roi", F.lit(1.0))).alias("new_roi")))
    x = new.join(cur, "segment").join(seg, "segment").withColumn("_t", total)
    lift = F.col("seg_spend") * annual * (F.col("new_roi") - F.col("current_roi"))
    base_rev, base_profit = F.col("revenue") * annual, F.col("profit") * annual
    margin = F.when(base_rev > 0, base_profit / base_rev).otherwise(0.0)
    gain = (base_rev + lift) * margin - base_profit
    return x.select(
        "scenario_id", F.lit("marketing_reallocation").alias("scenario_type"), "segment", "share_sum", "current_roi", "new_roi",
        F.col("_t.rev").alias("baseline_revenue"), F.col("_t.profit").alias("baseline_profit"),
        (F.col("_t.rev") + lift).alias("projected_revenue"), (F.col("_t.profit") + gain).alias("projected_profit"),
        lift.alias("revenue_delta"), gain.alias("profit_delta"), F.lit(0.72).alias("confidence"))
