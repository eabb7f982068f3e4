"""G-family: declarative validation rules, column / table profiles, audit
flags and the quality scorecard.

Validation rules are data (``Rule`` rows).  Row-level rules of one table are
evaluated together in a single aggregate (one scan per table); duplicate-key
rules are one grouped count each and referential rules one anti join each.
The same rule list renders to DuckDB SQL for the oracle.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expr import one_row_join
from ..functions.ranks import quantiles

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
           T.DecimalType)


@dataclass(frozen=True)
class Rule:
    table: str
    check: str
    kind: str          # required | not_null | unique | allowed | positive | non_negative |
    #                    range | column_order | identity | fk | group_mean_order | expected
    cols: tuple = ()
    args: tuple = ()


# ---- Spark rendering -------------------------------------------------------

def _bad_expr(rule: Rule) -> Column:
    c = [F.col(x) for x in rule.cols]
    k = rule.kind
    if k == "not_null":
        return reduce(lambda a, b: a | b, [x.isNull() for x in c])
    if k == "allowed":
        # NULL is outside the allowed set (pandas ~isin semantics)
        return F.coalesce(~c[0].isin(list(rule.args)), F.lit(True))
    if k == "positive":
        return c[0] <= 0
    if k == "non_negative":
        return c[0] < 0
    if k == "range":
        lo, hi = rule.args
        return (c[0] < lo) | (c[0] > hi)
    if k == "column_order":  # cols[0] must be >= cols[1]
        return c[0] < c[1]
    if k == "identity":      # |a - round(b - c, 2)| > tol
        (tol,) = rule.args
        return F.abs(c[0] - F.round(c[1] - c[2], 2)) > tol
    raise ValueError(k)


KEYS_A_TASK = 1 << 17  # keys that one task counts for a rule of uniqueness

ROW_KINDS = {"not_null", "allowed", "positive", "non_negative", "range", "column_order", "identity"}


def _result(table: str, check: str, n_checked: Column, n_bad: Column) -> list[Column]:
    return [F.lit(table).alias("table_name"), F.lit(check).alias("check_name"),
            n_checked.cast("long").alias("n_checked"), n_bad.cast("long").alias("n_bad"),
            (n_bad == 0).alias("passed")]


def run_rules(tables: dict[str, DataFrame], rules: list[Rule]) -> DataFrame:
    """One result row per rule: table_name, check_name, n_checked,
    n_bad, passed."""
    parts: list[DataFrame] = []
    counted: dict[str, int] = {}
    by_table: dict[str, list[Rule]] = {}
    for r in rules:
        by_table.setdefault(r.table, []).append(r)
    for table, trs in by_table.items():
        df = tables[table]
        present = set(df.columns)
        flat = [r for r in trs if r.kind in ROW_KINDS | {"required", "group_mean_order"}]
        if flat:  # one scan answers all of them
            aggs, rows = [F.count(F.lit(1)).alias("_n")], []
            for i, r in enumerate(flat):
                got, outs = _flat_aggregates(r, i, present)
                aggs += got
                rows.append(F.struct(*_result(table, r.check, *outs)))
            parts.append(df.agg(*aggs).select(F.explode(F.array(*rows)).alias("s")).select("s.*"))
        for r in trs:
            if r.kind == "unique":
                # a key per row is the rule: tasks are as many as the rows ask for, so none holds more than its share of keys
                if table not in counted:
                    counted[table] = df.count()
                g = (df.select(*r.cols).repartition(1 + counted[table] // KEYS_A_TASK, *r.cols)
                     .groupBy(*r.cols).agg(F.count(F.lit(1)).alias("_c")))
                parts.append(g.agg(F.sum("_c").alias("n"), F.sum(F.col("_c") - 1).alias("b")).select(
                    *_result(table, r.check, F.coalesce(F.col("n"), F.lit(0)),
                             F.coalesce(F.col("b"), F.lit(0)))))
        fks = [r for r in trs if r.kind == "fk"]
        if fks:  # one pass: a left join per parent, then one aggregate
            child = df.select(*sorted({r.cols[0] for r in fks}))
            for i, r in enumerate(fks):
                parent, pcol = r.args
                known = tables[parent].select(F.col(pcol).alias(f"_k{i}")).where(F.col(f"_k{i}").isNotNull()).distinct()
                child = child.join(known, F.col(r.cols[0]) == F.col(f"_k{i}"), "left")
            agg = child.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(f"_k{i}").isNull()).alias(f"_b{i}") for i in range(len(fks))])
            parts.append(agg.select(F.explode(F.array(*[
                F.struct(*_result(table, r.check, F.col("_n"), F.col(f"_b{i}"))) for i, r in enumerate(fks)])).alias("s")).select("s.*"))
    return reduce(DataFrame.unionByName, parts)


def _flat_aggregates(r: Rule, i: int, present: set[str]) -> tuple[list[Column], tuple[Column, Column]]:
    """Aggregates of a rule that one scan of its table answers, and its (n_checked, n_bad) over them."""
    if r.kind == "required":
        # a required column is there and holds a value somewhere (any row of a non-empty table)
        there = [c for c in r.cols if c in present]
        empty = [F.when((F.col(f"_r{i}_{c}") == 0) & (F.col("_n") > 0), 1).otherwise(0) for c in there]
        return ([F.count(c).alias(f"_r{i}_{c}") for c in there],
                (F.lit(len(r.cols)), sum(empty, F.lit(len(r.cols) - len(there)))))
    if not set(r.cols) <= present:
        return [], (F.col("_n"), F.lit(None).cast("long"))
    if r.kind == "group_mean_order":
        gcol, hi_val, lo_val = r.args
        v, g = F.col(r.cols[0]), F.col(gcol)
        return ([F.avg(F.when(g == hi_val, v)).alias(f"_hi{i}"), F.avg(F.when(g == lo_val, v)).alias(f"_lo{i}")],
                (F.col("_n"), F.when(F.col(f"_hi{i}") > F.col(f"_lo{i}"), 0).otherwise(1)))
    return [F.count_if(_bad_expr(r)).alias(f"_b{i}")], (F.col("_n"), F.col(f"_b{i}"))


NUMBER_KINDS = {"positive", "non_negative", "range", "identity"}
KINDS = ROW_KINDS | {"required", "unique", "fk", "group_mean_order"}


def _rule_error(rule: Rule, tables: dict[str, DataFrame]) -> str | None:
    """Why a rule cannot be run on these tables."""
    if rule.kind not in KINDS:
        return f"unknown kind {rule.kind}"
    needed = [] if rule.kind == "required" else [(rule.table, c) for c in rule.cols]
    if rule.kind == "fk":
        needed.append(rule.args)
    if rule.kind == "group_mean_order":
        needed.append((rule.table, rule.args[0]))
    for t, c in [(rule.table, None), *needed]:
        if t not in tables:
            return f"missing table {t}"
        if c is not None and c not in tables[t].columns:
            return f"missing column {t}.{c}"
    return None


def audit_rules(tables: dict[str, DataFrame], rules: list[Rule]) -> DataFrame:
    """``run_rules`` where a rule that errs is a violation of its own: passed is false and ``error`` says why
    (else NULL).  A rule errs if its table, a column or its kind does not exist (counts are NULL), or if a rule on
    numbers meets text that is no number; the readable values are counted as usual.  NULL is no error."""
    errors = [(r, _rule_error(r, tables)) for r in rules]
    spark = next(iter(tables.values())).sparkSession
    schema = "table_name string, check_name string, n_checked long, n_bad long, passed boolean, error string"
    parts = [spark.createDataFrame([(r.table, r.check, None, None, False, e) for r, e in errors if e], schema)]
    sound, views, text = [], dict(tables), {}
    for r in (r for r, e in errors if not e):
        fields = tables[r.table].schema
        cols = [c for c in r.cols if isinstance(fields[c].dataType, T.StringType)] if r.kind in NUMBER_KINDS else []
        if cols:  # numbers are read beside the text, which other rules of the table still see
            views[r.table] = views[r.table].withColumns({f"_number_{c}": F.expr(f"try_cast(`{c}` AS double)") for c in cols})
            text.setdefault(r.table, []).append((r.check, cols))
            r = replace(r, cols=tuple(f"_number_{c}" if c in cols else c for c in r.cols))
        sound.append(r)
    unread = [views[t].agg(F.array(*[
        F.struct(F.lit(t).alias("table_name"), F.lit(check).alias("check_name"),
                 sum((F.count_if(F.col(c).isNotNull() & F.col(f"_number_{c}").isNull()) for c in cols), F.lit(0)).alias("n_unread"))
        for check, cols in checks]).alias("s")).select(F.explode("s").alias("s")).select("s.*") for t, checks in text.items()]
    if sound:
        found = run_rules(views, sound)
        if unread:
            found = found.join(reduce(DataFrame.unionByName, unread), ["table_name", "check_name"], "left")  # a row per rule either side
        else:
            found = found.withColumn("n_unread", F.lit(0))
        bad = F.coalesce(F.col("n_unread"), F.lit(0)) > 0
        parts.append(found.select("table_name", "check_name", "n_checked", "n_bad", (F.coalesce("passed", F.lit(False)) & ~bad).alias("passed"),
                                  F.when(bad, F.concat(F.col("n_unread").cast("string"), F.lit(" values are no number"))).alias("error")))
    return reduce(DataFrame.unionByName, parts)


def validate_all(results: DataFrame) -> DataFrame:
    """Per table: checks run, failed, passed flag (all checks pass)."""
    return results.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("n_checks"),
        F.count_if(~F.coalesce(F.col("passed"), F.lit(False))).alias("n_failed"),
    ).withColumn("passed", F.col("n_failed") == 0)


def offending_values(df: DataFrame, column: str, allowed: list) -> DataFrame:
    """values outside the allowed set (NULL included), one row per value with its row count."""
    c = F.col(column)
    return df.where(c.isNull() | ~c.isin(allowed)).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def expected_by_group(df: DataFrame, group: str, value: str, expected: DataFrame,
                      expected_col: str = "expected") -> DataFrame:
    """Rows whose value differs from the expected value of their group
    (expected table is one row per group)."""
    j = df.select(group, value).join(expected, group, "left")
    return j.groupBy(group).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(expected_col).isNull() | (F.col(value) != F.col(expected_col))).alias("n_mismatch"),
    )


# ---- profiles --------------------------------------------------------------

def _is_numeric(dt) -> bool:
    return isinstance(dt, NUMERIC)


def _beside_double(field: T.StructField) -> Column:
    """What tells values apart that are equal as doubles: the long itself, the sign of a zero (its text differs)."""
    c = F.col(field.name)
    if isinstance(field.dataType, T.LongType):
        return c
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        return F.when(c == 0, (c.cast("string") == "-0.0").cast("long"))
    return F.lit(None).cast("long")


def profile_columns(df: DataFrame, table: str, n_buckets: int | None = None) -> DataFrame:
    """G16 for one table (see ``profile_tables``)."""
    return profile_tables({table: df}, n_buckets)


def profile_tables(tables: dict[str, DataFrame], n_buckets: int | None = None) -> DataFrame:
    """Per (table, column) dtype, nulls, distinct values, moments, exact
    quartiles and 1.5·IQR outliers.

    One scan per table answers nulls and moments.  The numbers are unpivoted once to (column, value) and counted per
    distinct value; quartiles, outliers and distinct values come from these counts, which one shuffle makes for all
    tables.  Other values are counted as 128-bit hashes (times as themselves), so long texts and arrays do not travel."""
    flat_parts, num_parts, time_parts, hash_parts, meta = [], [], [], [], []
    ids = {}
    flat = "column_name string, null_count long, _n long, mean double, std double, min double, max double"
    for table, df in tables.items():
        meta += [(table, f.name, f.dataType.simpleString()) for f in df.schema.fields]
        # cells (id, value) of the columns that are numbers counted exactly, times, and others
        num, time, other = {}, {}, {}
        aggs, rows = [F.count(F.lit(1)).alias("_rows")], []
        for f in df.schema.fields:
            i = ids[table, f.name] = len(ids)
            aggs.append(F.count_if(F.col(f.name).isNull()).alias(f"_null{i}"))
            x = F.col(f.name).cast("double")
            if _is_numeric(f.dataType):
                aggs += [F.count(x).alias(f"_n{i}"), F.avg(x).alias(f"_mean{i}"), F.stddev_samp(x).alias(f"_std{i}"),
                         F.min(x).alias(f"_min{i}"), F.max(x).alias(f"_max{i}")]
                moments = [F.col(f"_{s}{i}") for s in ("n", "mean", "std", "min", "max")]
                num[i] = F.struct(F.lit(i).alias("id"), x.alias("v"), _beside_double(f).alias("k"))
            else:
                moments = [F.lit(None)] * 5
            if isinstance(f.dataType, T.TimestampNTZType):
                time[i] = F.struct(F.lit(i).alias("id"), F.col(f.name).alias("s"))
            elif not isinstance(f.dataType, T.MapType) and (i not in num or isinstance(f.dataType, T.DecimalType)):
                other[i] = F.struct(F.lit(i).alias("id"), F.unhex(F.md5(F.col(f.name).cast("string"))).alias("s"))
            rows.append(F.struct(F.lit(f.name).alias("column_name"), F.col(f"_null{i}").alias("null_count"),
                                 *[m.cast(t).alias(c) for m, (c, t) in zip(moments, [x.split() for x in flat.split(", ")[2:]])]))
        flat_parts.append(df.agg(*aggs).select(F.lit(table).alias("table_name"), F.col("_rows").alias("n_rows"), F.inline(F.array(*rows))))
        for cells, parts in ((num, num_parts), (time, time_parts), (other, hash_parts)):
            if cells:
                parts.append(df.select(F.inline(F.array(*cells.values()))))
    keys = ["table_name", "column_name"]
    spark = next(iter(tables.values())).sparkSession
    named = F.broadcast(spark.createDataFrame([(i, *key) for key, i in ids.items()], "id int, table_name string, column_name string"))
    uniq = [reduce(DataFrame.unionByName, parts).where(F.col("s").isNotNull())
            .groupBy("id", "s").agg(F.lit(1).alias("_one")).groupBy("id").agg(F.count(F.lit(1)).alias("unique_count"))
            for parts in (time_parts, hash_parts) if parts]
    stats = None
    if num_parts:
        counts = (reduce(DataFrame.unionByName, num_parts).where(F.col("v").isNotNull())
                  .groupBy("id", "v", "k").agg(F.count(F.lit(1)).alias("cnt")))
        qs = quantiles(counts, "v", [0.25, 0.5, 0.75], ["p25", "p50", "p75"], group=["id"], n_buckets=n_buckets, count="cnt")
        iqr = F.col("p75") - F.col("p25")
        # one fence row per numeric column: bounded by the schema widths
        fences = F.broadcast(qs.select("id", "p25", "p50", "p75", (F.col("p25") - 1.5 * iqr).alias("_lo"), (F.col("p75") + 1.5 * iqr).alias("_hi")))
        stats = counts.join(fences, "id").groupBy("id", "p25", "p50", "p75").agg(
            F.sum(F.when((F.col("v") < F.col("_lo")) | (F.col("v") > F.col("_hi")), F.col("cnt")).otherwise(0)).alias("outlier_count"),
            F.count_if(F.col("cnt") > 0).alias("_values"))
        decimals = [ids[t, f.name] for t, df in tables.items() for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)]
        uniq.append(stats.where(~F.col("id").isin(decimals)).select("id", F.col("_values").alias("unique_count")))
        stats = stats.drop("_values").join(named, "id").drop("id")
    out = reduce(DataFrame.unionByName, flat_parts)
    if uniq:
        out = out.join(reduce(DataFrame.unionByName, uniq).join(named, "id").drop("id"), keys, "left")
    else:
        out = out.withColumn("unique_count", F.lit(None).cast("long"))
    if stats is not None:
        out = out.join(stats, keys, "left")
    else:
        out = out.withColumns({c: F.lit(None).cast("double") for c in ["p25", "p50", "p75"]}).withColumn("outlier_count", F.lit(None).cast("long"))
    dtypes = F.broadcast(spark.createDataFrame(meta, "table_name string, column_name string, dtype string"))
    n = F.col("n_rows")
    return out.join(dtypes, keys, "left").select(
        "table_name", "column_name", "dtype", "n_rows",
        F.col("null_count").cast("long").alias("null_count"),
        F.when(n > 0, F.col("null_count") / n * 100).otherwise(0.0).alias("null_pct"),
        F.coalesce(F.col("unique_count"), F.lit(0)).cast("long").alias("unique_count"),
        F.when(n > 0, F.coalesce(F.col("unique_count"), F.lit(0)) / n * 100).otherwise(0.0).alias("unique_pct"),
        "mean", "std", "min", "p25", "p50", "p75", "max",
        F.col("outlier_count").cast("long").alias("outlier_count"),
        F.when(F.col("_n") > 0, F.col("outlier_count") / F.col("_n") * 100).alias("outlier_pct"),
    )


def profile_table(df: DataFrame, table: str) -> DataFrame:
    """G17 for one table (see ``profile_table_many``)."""
    return profile_table_many({table: df})


def profile_table_many(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows, columns, duplicate rows (beyond the first copy) and % per
    table.  Each row is the 256-bit hash of its columns as JSON, keyed by
    table, so all tables are de-duplicated by one grouped aggregate and no row travels."""
    enc = reduce(DataFrame.unionByName, [
        df.select(F.lit(t).alias("table_name"), F.unhex(F.sha2(F.to_json(F.struct(*[F.col(c) for c in df.columns])), 256)).alias("_row"))
        for t, df in tables.items()])
    g = enc.groupBy("table_name", "_row").agg(F.count(F.lit(1)).alias("_c"))
    a = g.groupBy("table_name").agg(F.sum("_c").alias("n"), F.sum(F.col("_c") - 1).alias("d"))
    spark = next(iter(tables.values())).sparkSession
    names = spark.createDataFrame([(t, len(df.columns)) for t, df in tables.items()],
                                  "table_name string, column_count long")
    x = names.join(a, "table_name", "left")  # one row per table either side
    n = F.coalesce(F.col("n"), F.lit(0))
    d = F.coalesce(F.col("d"), F.lit(0))
    return x.select("table_name", n.cast("long").alias("row_count"), "column_count",
                    d.cast("long").alias("duplicate_row_count"),
                    F.when(n > 0, d / n * 100).otherwise(0.0).alias("duplicate_row_pct"))


def audit_flags(profiles: DataFrame, tables: DataFrame, null_pct: float = 5.0,
                outlier_pct: float = 10.0, dup_pct: float = 1.0) -> DataFrame:
    """Flagged items: columns with > null_pct % NULLs or > outlier_pct %
    outliers, tables with > dup_pct % duplicate rows."""
    col_flags = profiles.select(
        "table_name", "column_name",
        F.explode(F.array(
            F.when(F.col("null_pct") > null_pct, F.lit("high_nulls")),
            F.when(F.col("outlier_pct") > outlier_pct, F.lit("high_outliers")))).alias("flag")
    ).where(F.col("flag").isNotNull())
    tbl_flags = tables.where(F.col("duplicate_row_pct") > dup_pct).select(
        "table_name", F.lit(None).cast("string").alias("column_name"), F.lit("high_duplicates").alias("flag"))
    return col_flags.unionByName(tbl_flags)


def audit_totals(table_profiles: DataFrame, rules: DataFrame) -> DataFrame:
    """G19 totals in one row: tables, their rows and duplicate rows, rules checked and rules violated."""
    t = table_profiles.agg(F.count(F.lit(1)).alias("total_tables"), F.coalesce(F.sum("row_count"), F.lit(0)).alias("total_rows"),
                           F.coalesce(F.sum("duplicate_row_count"), F.lit(0)).alias("total_duplicate_rows"))
    v = rules.agg(F.count(F.lit(1)).alias("total_rules"), F.count_if(~F.col("passed")).alias("total_rule_violations"))
    return one_row_join(t, v)


def quality_scorecard(df: DataFrame, table: str, numeric_cols: list[str] | None = None,
                      z: float = 3.0) -> DataFrame:
    """Completeness %, duplicate %, % rows with any |z| > 3 over the
    numeric columns (std + 1e-9), PASS if completeness ≥ 99 and dup < 1."""
    num = numeric_cols or [f.name for f in df.schema.fields if _is_numeric(f.dataType)]
    cells = len(df.columns)
    stats = df.agg(F.struct(*[x for c in num for x in (
        F.avg(c).alias(f"m_{c}"), F.stddev_samp(c).alias(f"s_{c}"))]).alias("st"))
    withz = df.withColumn("_st", stats.scalar())  # one subquery for all columns
    zs = [F.abs((F.col(c) - F.col(f"_st.m_{c}")) / (F.col(f"_st.s_{c}") + F.lit(1e-9))) for c in num]
    any_out = reduce(lambda a, b: a | b, [F.coalesce(x > z, F.lit(False)) for x in zs]) if zs else F.lit(False)
    nn = sum((F.col(c).isNotNull().cast("long") for c in df.columns), F.lit(0))
    a = withz.agg(F.count(F.lit(1)).alias("n"), F.sum(nn).alias("filled"),
                  F.count_if(any_out).alias("z_rows"))
    dup = profile_table(df, table).select("duplicate_row_pct").scalar()
    r = a.withColumn("duplicate_row_pct", dup)
    completeness = F.when(F.col("n") > 0, F.col("filled") / (F.col("n") * cells) * 100).otherwise(100.0)
    return r.select(
        F.lit(table).alias("table_name"), F.col("n").alias("row_count"),
        completeness.alias("completeness_pct"), "duplicate_row_pct",
        F.when(F.col("n") > 0, F.col("z_rows") / F.col("n") * 100).otherwise(0.0).alias("outlier_row_pct"),
        F.when((completeness >= 99) & (F.col("duplicate_row_pct") < 1), "PASS").otherwise("REVIEW").alias("status"))
