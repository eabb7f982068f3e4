"""Coercing ingest of text columns.  Values that do not convert become NULL in the typed table and
stay visible, with their counts, in a quarantine table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Text that stands for "no value"; not an error
MISSING = ("", "na", "n/a", "nan", "null", "none")
WHOLE = r"^[+-]?[0-9]+$"


def coerced(raw: Column, kind: str, formats: tuple[str, ...] = ()) -> Column:
    """``raw`` text as ``kind`` ('long', 'double', 'timestamp'), NULL where it does not convert: whole numbers are
    digits with an optional sign, timestamps are tried in the order of ``formats`` (none: the ISO form)."""
    text = F.trim(raw)
    if kind == "long":
        return F.when(text.rlike(WHOLE), text.try_cast("bigint"))
    if kind == "timestamp":
        tried = [F.try_to_timestamp(text, F.lit(f)) for f in formats] or [text.try_cast("timestamp")]
        return F.coalesce(*tried).cast("timestamp_ntz")
    if kind == "double":
        number = text.try_cast("double")
        return F.when(~F.isnan(number) & (F.abs(number) < float("inf")), number)
    raise ValueError(f"unknown kind {kind!r}")


def _missing(raw: Column) -> Column:
    return raw.isNull() | F.lower(F.trim(raw)).isin(*MISSING)


def coerce(df: DataFrame, kinds: dict[str, str], formats: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """``df`` with the columns of ``kinds`` converted; rejected and missing values are NULL."""
    formats = formats or {}
    return df.withColumns({c: F.when(~_missing(F.col(c)), coerced(F.col(c), k, formats.get(c, ()))) for c, k in kinds.items()})


def _long_form(df: DataFrame, kinds: dict[str, str], formats) -> DataFrame:
    """(column_name, value, missing, ok) of every value, one scan."""
    formats = formats or {}
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"), _missing(F.col(c)).alias("missing"),
                      coerced(F.col(c), k, formats.get(c, ())).isNotNull().alias("ok")) for c, k in kinds.items()]
    return df.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def quarantine(df: DataFrame, kinds: dict[str, str], formats: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """Rejected values: column_name, value, n_rows.  A frequent bad value is one row, counted before it moves."""
    return (_long_form(df, kinds, formats).where("not missing and not ok")
            .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n_rows")))


def coercion_report(df: DataFrame, kinds: dict[str, str], formats: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """One row per column: n_rows, n_missing, n_converted, n_rejected; passed without rejected values."""
    bad = F.count_if(~F.col("missing") & ~F.col("ok"))
    return _long_form(df, kinds, formats).groupBy("column_name").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if("missing").alias("n_missing"),
        F.count_if(~F.col("missing") & F.col("ok")).alias("n_converted"), bad.alias("n_rejected"), (bad == 0).alias("passed"))
