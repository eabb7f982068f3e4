"""B-family helpers: guarded ratios, NULL-preserving clips, period arithmetic,
threshold labels and output rounding.  All return JVM-side Column
expressions (no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def div(a, b) -> Column:
    """a / b, NULL when b is 0 or NULL.  Spark 4 runs in ANSI mode, where a
    plain ``/`` by zero raises; an empty or zero denominator means "no
    value" here, as in the reference's NaN results."""
    return F.try_divide(col(a), col(b))


def safe_corr(x, y) -> Column:
    """Pearson r as an aggregate, NULL for a constant input (the built-in
    ``corr`` divides by a zero standard deviation and raises in ANSI mode)."""
    return div(F.covar_pop(x, y), F.sqrt(F.var_pop(x) * F.var_pop(y)))


def clip_lower(c, k: float) -> Column:
    """pandas ``clip(lower=k)``: NULL stays NULL (``greatest`` alone would turn
    NULL into k)."""
    c = col(c)
    return F.when(c.isNotNull(), F.greatest(c, F.lit(k)))


def clip(c, lo: float, hi: float) -> Column:
    c = col(c)
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(lo)), F.lit(hi)))


def month_index(period, first_period) -> Column:
    """1-based month number of ``period`` counted from ``first_period``."""
    p, f = col(period), col(first_period)
    return (F.year(p) - F.year(f)) * 12 + F.month(p) - F.month(f) + 1


def whole_months_between(later, earlier) -> Column:
    """Calendar-month difference, floored at 0."""
    a, b = col(later), col(earlier)
    return F.greatest(F.lit(0), (F.year(a) - F.year(b)) * 12 + F.month(a) - F.month(b))


# Offset of the rounding grid: deep binary expansion (√2 − 1) so that values
# built from cents, halvings or ratios of them never sit exactly on a step.
ROUND_OFFSET = 0.4142135623730951


def rnd(c, bits: int) -> Column:
    """Deterministic rounding to the grid 2^-bits: ``floor(x·2^k + φ) / 2^k``.

    Scaling by a power of two is exact and the offset φ = √2 − 1 is one IEEE
    addition, so DuckDB evaluates the identical formula bit for bit.  A
    plain half-step (φ = 0.5) or decimal grid is hit exactly by values such
    as cent sums halved k times; φ's deep binary expansion is not.  Used in
    the presentation step of checked queries only.

    Values with |x| ≥ 2^(53−k) (already on the grid, and beyond Spark's
    long range for large k) and non-finite values pass through unchanged."""
    scale = float(2 ** bits)
    c = col(c)
    keep = c.isNull() | F.isnan(c) | (F.abs(c) >= F.lit(float(2 ** (53 - bits))))
    return F.when(keep, c).otherwise(F.floor(c * F.lit(scale) + F.lit(ROUND_OFFSET)) / F.lit(scale))


# ---- threshold labels (fixed values that must equal the reference) -------
# Cohen's d: < 0.2 negligible, < 0.5 small, < 0.8 medium, else large.
COHEN_D_CUTS = (0.2, 0.5, 0.8)
# eta squared: < 0.01 negligible, < 0.06 small, < 0.14 medium, else large.
ETA_SQ_CUTS = (0.01, 0.06, 0.14)
# |r|: >= 0.70 strong, >= 0.40 moderate, >= 0.20 weak, else negligible.
CORR_CUTS = (0.20, 0.40, 0.70)


def size_label(value, cuts=COHEN_D_CUTS) -> Column:
    v = F.abs(col(value))
    small, medium, large = cuts
    return (F.when(v.isNull(), F.lit(None))
            .when(v < small, "negligible").when(v < medium, "small")
            .when(v < large, "medium").otherwise("large"))


def correlation_strength(r) -> Column:
    v = F.abs(col(r))
    weak, moderate, strong = CORR_CUTS
    return (F.when(v.isNull(), F.lit(None))
            .when(v >= strong, "strong").when(v >= moderate, "moderate")
            .when(v >= weak, "weak").otherwise("negligible"))


def trend_direction(slope, p_value, alpha: float = 0.05) -> Column:
    s, p = col(slope), col(p_value)
    return (F.when(p.isNull() | (p >= alpha), "stable")
            .when(s > 0, "growing").otherwise("declining"))


def one_row_join(a: DataFrame, b: DataFrame) -> DataFrame:
    """Side-by-side concatenation of two *global* aggregates (each exactly
    one row by construction); the right side is broadcast, so this is a
    projection, never a pairing of data rows."""
    return a.crossJoin(F.broadcast(b))
