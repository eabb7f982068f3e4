"""Registered data-quality queries (G1-G20) over every driver table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import quality as Q
from ..operators.quality import Rule
from ..sources.retail import Retail
from ..sources.tables import SCHEMAS, TABLES
from .registry import STAT, UNIT, register
from .sql import MARKETING, TX, with_

# Fixed domains of the driver tables (values that must match the data).
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
PART_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
ORDER_STATUS = ("F", "O", "P")
RETURN_FLAGS = ("A", "N", "R")
LINE_STATUS = ("F", "O")
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")

TX_COLS = ("order_id", "customer_id", "product_id", "store_id", "date", "quantity",
           "gross_revenue", "cogs", "gross_profit")

RULES: list[Rule] = [
    # transactions (derived retail view)
    Rule("transactions", "required_columns", "required", TX_COLS),
    Rule("transactions", "null_order_id", "not_null", ("order_id",)),
    Rule("transactions", "duplicate_transaction_key", "unique", ("order_id", "line_no")),
    Rule("transactions", "quantity_positive", "positive", ("quantity",)),
    Rule("transactions", "unit_price_positive", "positive", ("unit_price",)),
    Rule("transactions", "revenue_non_negative", "non_negative", ("gross_revenue",)),
    Rule("transactions", "cogs_non_negative", "non_negative", ("cogs",)),
    Rule("transactions", "discount_in_range", "range", ("discount_pct",), (0.0, 1.0)),
    Rule("transactions", "ship_after_order", "column_order", ("ship_date", "date")),
    Rule("transactions", "profit_identity", "identity", ("gross_profit", "gross_revenue", "cogs"), (0.02,)),
    Rule("transactions", "private_label_margin_above_national", "group_mean_order",
         ("margin",), ("brand_type", "private_label", "national_brand")),
    Rule("transactions", "customer_fk", "fk", ("customer_id",), ("customer", "c_custkey")),
    Rule("transactions", "product_fk", "fk", ("product_id",), ("part", "p_partkey")),
    Rule("transactions", "store_fk", "fk", ("store_id",), ("supplier", "s_suppkey")),
    # supplier = stores
    Rule("supplier", "required_columns", "required", ("s_suppkey", "s_name", "s_nationkey", "s_acctbal")),
    Rule("supplier", "null_s_suppkey", "not_null", ("s_suppkey",)),
    Rule("supplier", "duplicate_s_suppkey", "unique", ("s_suppkey",)),
    Rule("supplier", "nationkey_in_range", "range", ("s_nationkey",), (0, 24)),
    Rule("supplier", "acctbal_positive", "positive", ("s_acctbal",)),
    Rule("supplier", "nation_fk", "fk", ("s_nationkey",), ("nation", "n_nationkey")),
    # customer
    Rule("customer", "required_columns", "required", ("c_custkey", "c_name", "c_nationkey", "c_mktsegment")),
    Rule("customer", "null_c_custkey", "not_null", ("c_custkey",)),
    Rule("customer", "duplicate_c_custkey", "unique", ("c_custkey",)),
    Rule("customer", "segment_allowed", "allowed", ("c_mktsegment",), SEGMENTS),
    Rule("customer", "nation_fk", "fk", ("c_nationkey",), ("nation", "n_nationkey")),
    # part = products
    Rule("part", "required_columns", "required", ("p_partkey", "p_name", "p_brand", "p_type", "p_retailprice")),
    Rule("part", "null_p_partkey", "not_null", ("p_partkey",)),
    Rule("part", "duplicate_p_partkey", "unique", ("p_partkey",)),
    Rule("part", "type_allowed", "allowed", ("p_type",), PART_TYPES),
    Rule("part", "retailprice_positive", "positive", ("p_retailprice",)),
    Rule("part", "size_in_range", "range", ("p_size",), (1, 50)),
    # orders / lineitem
    Rule("orders", "null_o_orderkey", "not_null", ("o_orderkey",)),
    Rule("orders", "duplicate_o_orderkey", "unique", ("o_orderkey",)),
    Rule("orders", "status_allowed", "allowed", ("o_orderstatus",), ORDER_STATUS),
    Rule("orders", "totalprice_positive", "positive", ("o_totalprice",)),
    Rule("orders", "customer_fk", "fk", ("o_custkey",), ("customer", "c_custkey")),
    Rule("lineitem", "null_keys", "not_null", ("l_orderkey", "l_partkey", "l_suppkey")),
    Rule("lineitem", "quantity_positive", "positive", ("l_quantity",)),
    Rule("lineitem", "discount_in_range", "range", ("l_discount",), (0.0, 1.0)),
    Rule("lineitem", "tax_in_range", "range", ("l_tax",), (0.0, 1.0)),
    Rule("lineitem", "returnflag_allowed", "allowed", ("l_returnflag",), RETURN_FLAGS),
    Rule("lineitem", "linestatus_allowed", "allowed", ("l_linestatus",), LINE_STATUS),
    Rule("lineitem", "order_fk", "fk", ("l_orderkey",), ("orders", "o_orderkey")),
    # events and text / vector tables
    Rule("events", "null_event_id", "not_null", ("event_id",)),
    Rule("events", "duplicate_event_id", "unique", ("event_id",)),
    Rule("events", "event_type_allowed", "allowed", ("event_type",), EVENT_TYPES),
    Rule("events", "value_non_negative", "non_negative", ("value",)),
    Rule("events", "user_fk", "fk", ("user_id",), ("customer", "c_custkey")),
    Rule("documents", "null_doc_id", "not_null", ("doc_id",)),
    Rule("documents", "duplicate_doc_id", "unique", ("doc_id",)),
    Rule("documents", "n_chars_non_negative", "non_negative", ("n_chars",)),
    Rule("labels", "quality_boolean", "allowed", ("quality",), (0, 1)),
    Rule("labels", "toxic_boolean", "allowed", ("toxic",), (0, 1)),
    Rule("labels", "document_fk", "fk", ("doc_id",), ("documents", "doc_id")),
    Rule("pages", "duplicate_page_id", "unique", ("page_id",)),
    Rule("conversations", "null_conv_id", "not_null", ("conv_id",)),
    Rule("conversations", "duplicate_turn", "unique", ("conv_id", "turn")),
    Rule("embeddings", "duplicate_vec_id", "unique", ("vec_id",)),
    Rule("benchmark", "duplicate_item_id", "unique", ("item_id",)),
    Rule("region", "duplicate_r_regionkey", "unique", ("r_regionkey",)),
    Rule("nation", "duplicate_n_nationkey", "unique", ("n_nationkey",)),
    Rule("nation", "region_fk", "fk", ("n_regionkey",), ("region", "r_regionkey")),
]

# audit twin (G14): business rules per table, incl. marketing and cost tables
BUSINESS_RULES: list[Rule] = [
    Rule("transactions", "negative_revenue", "non_negative", ("gross_revenue",)),
    Rule("transactions", "discount_out_of_range", "range", ("discount_pct",), (0.0, 1.0)),
    Rule("transactions", "profit_identity", "identity", ("gross_profit", "gross_revenue", "cogs"), (0.02,)),
    Rule("stores", "duplicate_store_id", "unique", ("store_id",)),
    Rule("stores", "cluster_allowed", "allowed", ("cluster",),
         ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")),
    Rule("products", "unit_cost_positive", "positive", ("unit_cost",)),
    Rule("products", "category_allowed", "allowed", ("category",), PART_TYPES),
    Rule("marketing", "spend_non_negative", "non_negative", ("spend",)),
    Rule("store_costs", "cost_non_negative", "non_negative", ("total_operating_cost",)),
]

KIND_QUERIES = {
    "dq_required_columns": ("G1", {"required"}),
    "dq_null_keys": ("G2", {"not_null"}),
    "dq_duplicate_keys": ("G3", {"unique"}),
    "dq_allowed_values": ("G4", {"allowed"}),
    "dq_positive": ("G5", {"positive"}),
    "dq_non_negative": ("G6", {"non_negative"}),
    "dq_range": ("G7", {"range"}),
    "dq_column_order": ("G9", {"column_order"}),
    "dq_identity": ("G10", {"identity"}),
    "dq_group_mean_order": ("G11", {"group_mean_order"}),
    "dq_referential": ("G12", {"fk"}),
}


def rule_tables(r: Retail) -> dict[str, DataFrame]:
    t = r.tables.every()
    t.update(transactions=r.transactions, stores=r.stores, products=r.products,
             marketing=r.marketing, store_costs=r.store_costs)
    return t


# ---- SQL renderer for the same rules ---------------------------------------

SQL_SOURCES = {
    "transactions": "tx",
    "stores": "(SELECT s_suppkey AS store_id, r_name AS cluster FROM supplier LEFT JOIN nation ON "
              "s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey)",
    "products": "(SELECT p_partkey AS product_id, p_type AS category, p_retailprice AS unit_cost FROM part)",
    "marketing": "mkt",
    "store_costs": "(SELECT sum(operating_cost) AS total_operating_cost FROM tx GROUP BY store_id, period)",
}


def _lit(v) -> str:
    return f"'{v}'" if isinstance(v, str) else repr(v)


def _bad_sql(rule: Rule) -> str:
    c, k = rule.cols, rule.kind
    if k == "not_null":
        return " OR ".join(f"{x} IS NULL" for x in c)
    if k == "allowed":
        return f"coalesce(NOT ({c[0]} IN ({', '.join(_lit(v) for v in rule.args)})), true)"
    if k == "positive":
        return f"{c[0]} <= 0"
    if k == "non_negative":
        return f"{c[0]} < 0"
    if k == "range":
        lo, hi = rule.args
        return f"({c[0]} < {lo} OR {c[0]} > {hi})"
    if k == "column_order":
        return f"{c[0]} < {c[1]}"
    if k == "identity":
        return f"abs({c[0]} - round({c[1]} - {c[2]}, 2)) > {rule.args[0]}"
    raise ValueError(k)


def _head(rule: Rule) -> str:
    return f"'{rule.table}' AS table_name, '{rule.check}' AS check_name"


def rule_sql(rule: Rule) -> str:
    src = SQL_SOURCES.get(rule.table, rule.table)
    k = rule.kind
    if k == "required":
        cols = {f.name for f in SCHEMAS[rule.table].fields} if rule.table in SCHEMAS else set(rule.cols)
        missing = len(set(rule.cols) - cols)
        bad = " + ".join([str(missing), *(f"CAST(count(*) > 0 AND count({c}) = 0 AS BIGINT)" for c in rule.cols if c in cols)])
        return (f"SELECT {_head(rule)}, CAST({len(rule.cols)} AS BIGINT) AS n_checked, "
                f"CAST({bad} AS BIGINT) AS n_bad, {bad} = 0 AS passed FROM {src}")
    if k in Q.ROW_KINDS:
        bad = _bad_sql(rule)
        return (f"SELECT {_head(rule)}, count(*) AS n_checked, count_if({bad}) AS n_bad, "
                f"count_if({bad}) = 0 AS passed FROM {src}")
    if k == "unique":
        g = ", ".join(rule.cols)
        return (f"SELECT {_head(rule)}, CAST(coalesce(sum(c), 0) AS BIGINT) AS n_checked, "
                f"CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS n_bad, coalesce(sum(c - 1), 0) = 0 AS passed "
                f"FROM (SELECT count(*) AS c FROM {src} GROUP BY {g})")
    if k == "fk":
        parent, pcol = rule.args
        orphans = (f"(SELECT count(*) FROM {src} t WHERE NOT EXISTS "
                   f"(SELECT 1 FROM {parent} p WHERE p.{pcol} = t.{rule.cols[0]}))")
        return (f"SELECT {_head(rule)}, (SELECT count(*) FROM {src}) AS n_checked, "
                f"{orphans} AS n_bad, {orphans} = 0 AS passed")
    if k == "group_mean_order":
        g, hi, lo = rule.args
        v = rule.cols[0]
        bad = (f"CASE WHEN avg(CASE WHEN {g} = '{hi}' THEN {v} END) > "
               f"avg(CASE WHEN {g} = '{lo}' THEN {v} END) THEN 0 ELSE 1 END")
        return (f"SELECT {_head(rule)}, count(*) AS n_checked, CAST({bad} AS BIGINT) AS n_bad, "
                f"{bad} = 0 AS passed FROM {src}")
    raise ValueError(k)


def rules_sql(rules: list[Rule]) -> str:
    return with_(TX, MARKETING) + "\nUNION ALL\n".join(rule_sql(r) for r in rules)


def _subset(kinds):
    return [r for r in RULES if r.kind in kinds]


@register("dq_checks", sql=rules_sql(RULES), survey_id="G1-G12")
def dq_checks(r: Retail):
    return Q.run_rules(rule_tables(r), RULES)


for _name, (_sid, _kinds) in KIND_QUERIES.items():
    register(_name, sql=rules_sql(_subset(_kinds)), survey_id=_sid)(
        lambda r, k=_kinds: Q.run_rules(rule_tables(r), _subset(k)))


@register("dq_boolean", survey_id="G8",
          sql=rules_sql([x for x in RULES if x.check.endswith("_boolean")]))
def dq_boolean(r: Retail):
    return Q.run_rules(rule_tables(r), [x for x in RULES if x.check.endswith("_boolean")])


@register("dq_validate_all", survey_id="G13", sql=with_(TX, MARKETING) + f""", res AS ({rules_sql(RULES)[len(with_(TX, MARKETING)):]})
SELECT table_name, count(*) AS n_checks, count_if(NOT coalesce(passed, false)) AS n_failed,
       count_if(NOT coalesce(passed, false)) = 0 AS passed FROM res GROUP BY table_name""")
def dq_validate_all(r: Retail):
    return Q.validate_all(Q.run_rules(rule_tables(r), RULES))


@register("dq_business_rules", sql=rules_sql(BUSINESS_RULES), survey_id="G14")
def dq_business_rules(r: Retail):
    return Q.run_rules(rule_tables(r), BUSINESS_RULES)


# rules that cannot be run, or meet text that is no number: each is a violation with a reason
ERRING_RULES: list[Rule] = [
    Rule("stores", "tenure_range", "range", ("tenure_years",), (0, 50)),
    Rule("warehouses", "capacity_positive", "positive", ("capacity",)),
    Rule("stores", "warehouse_fk", "fk", ("store_id",), ("warehouses", "warehouse_id")),
    Rule("products", "unit_cost_shape", "convex", ("unit_cost",)),
    Rule("orders", "status_non_negative", "non_negative", ("o_orderstatus",)),
    Rule("balances", "balance_range", "range", ("balance",), (0.0, 5000.0)),
]
BALANCES_SQL = "(SELECT c_custkey, CAST(c_acctbal AS VARCHAR) AS balance FROM customer)"


def _erring_sql() -> str:
    reasons = {"tenure_range": "missing column stores.tenure_years", "capacity_positive": "missing table warehouses",
               "warehouse_fk": "missing table warehouses", "unit_cost_shape": "unknown kind convex"}
    rows = [f"SELECT {_head(x)}, CAST(NULL AS BIGINT) AS n_checked, CAST(NULL AS BIGINT) AS n_bad, false AS passed, '{reasons[x.check]}' AS error"
            for x in ERRING_RULES if x.check in reasons]
    rows.append("SELECT 'orders', 'status_non_negative', count(*), count(*) FILTER (WHERE TRY_CAST(o_orderstatus AS DOUBLE) < 0), "
                "count_if(coalesce(TRY_CAST(o_orderstatus AS DOUBLE) < 0, o_orderstatus IS NOT NULL)) = 0, "
                "CASE WHEN count(o_orderstatus) > count(TRY_CAST(o_orderstatus AS DOUBLE)) "
                "THEN (count(o_orderstatus) - count(TRY_CAST(o_orderstatus AS DOUBLE))) || ' values are no number' END FROM orders")
    rows.append("SELECT 'balances', 'balance_range', count(*), count_if(TRY_CAST(balance AS DOUBLE) NOT BETWEEN 0 AND 5000), "
                f"count_if(TRY_CAST(balance AS DOUBLE) NOT BETWEEN 0 AND 5000) = 0, NULL FROM {BALANCES_SQL}")
    return "\nUNION ALL\n".join(rows)


@register("audit_business_rules", survey_id="G14",
          sql=f"SELECT *, CAST(NULL AS VARCHAR) AS error FROM ({rules_sql(BUSINESS_RULES)})\nUNION ALL\n" + _erring_sql())
def audit_business_rules(r: Retail):
    balances = r.tables["customer"].select("c_custkey", F.col("c_acctbal").cast("string").alias("balance"))
    return Q.audit_rules({**rule_tables(r), "balances": balances}, BUSINESS_RULES + ERRING_RULES)


# Lines of a finished (open) order are expected to be finished (open); partial orders have no expectation
EXPECTED_STATUS = [("F", "F"), ("O", "O")]


@register("dq_expected_by_group", survey_id="G15", sql="WITH e(o_orderstatus, expected) AS (VALUES "
          + ", ".join(f"('{a}', '{b}')" for a, b in EXPECTED_STATUS) + """)
SELECT o.o_orderstatus, count(*) AS n_rows, count_if(expected IS NULL OR l_linestatus <> expected) AS n_mismatch
FROM lineitem JOIN orders o ON l_orderkey = o_orderkey LEFT JOIN e ON o.o_orderstatus = e.o_orderstatus
GROUP BY o.o_orderstatus""")
def dq_expected_by_group(r: Retail):
    lines = r.tables["lineitem"].join(r.tables["orders"], F.col("l_orderkey") == F.col("o_orderkey"))
    expected = lines.sparkSession.createDataFrame(EXPECTED_STATUS, "o_orderstatus string, expected string")
    return Q.expected_by_group(lines, "o_orderstatus", "l_linestatus", expected)


# ---- profiles ---------------------------------------------------------------

PROFILE_TABLES = TABLES
_NUM = {"int", "bigint", "double", "float", "smallint", "tinyint"}


def _profile_sql_one(table: str) -> str:
    fields = SCHEMAS[table].fields
    out = []
    for f in fields:
        c, dt = f.name, f.dataType.simpleString()
        uniq = f"count(DISTINCT {c})"
        head = (f"SELECT '{table}' AS table_name, '{c}' AS column_name, '{dt}' AS dtype, "
                f"count(*) AS n_rows, count(*) - count({c}) AS null_count, "
                f"CASE WHEN count(*) > 0 THEN (count(*) - count({c})) / count(*) * 100 ELSE 0.0 END AS null_pct, "
                f"{uniq} AS unique_count, "
                f"CASE WHEN count(*) > 0 THEN {uniq} / count(*) * 100 ELSE 0.0 END AS unique_pct")
        if dt in _NUM:
            v = f"CAST({c} AS DOUBLE)"
            q = (f"(SELECT quantile_cont({v}, 0.25) AS a, quantile_cont({v}, 0.75) AS b FROM {table})")
            outl = (f"(SELECT count_if({v} < a - 1.5 * (b - a) OR {v} > b + 1.5 * (b - a)) "
                    f"FROM {table}, {q})")
            out.append(head + f", avg({v}) AS mean, stddev_samp({v}) AS std, min({v}) AS min, "
                       f"quantile_cont({v}, 0.25) AS p25, quantile_cont({v}, 0.5) AS p50, "
                       f"quantile_cont({v}, 0.75) AS p75, max({v}) AS max, {outl} AS outlier_count, "
                       f"CASE WHEN count({c}) > 0 THEN {outl} / count({c}) * 100 END AS outlier_pct "
                       f"FROM {table}")
        else:
            nul = "CAST(NULL AS DOUBLE)"
            out.append(head + f", {nul} AS mean, {nul} AS std, {nul} AS min, {nul} AS p25, {nul} AS p50, "
                       f"{nul} AS p75, {nul} AS max, CAST(NULL AS BIGINT) AS outlier_count, "
                       f"{nul} AS outlier_pct FROM {table}")
    return "\nUNION ALL\n".join(out)


PROFILE_DIGITS = {**{c: STAT for c in ("null_pct", "unique_pct", "outlier_pct")},
                  **{c: UNIT for c in ("mean", "std", "min", "p25", "p50", "p75", "max")}}


@register("profile_columns", survey_id="G16", digits=PROFILE_DIGITS,
          sql="\nUNION ALL\n".join(_profile_sql_one(t) for t in PROFILE_TABLES))
def profile_columns(r: Retail):
    return Q.profile_tables({t: r.tables[t] for t in PROFILE_TABLES})


def _table_profile_sql(t: str) -> str:
    n = len(SCHEMAS[t].fields)
    return (f"SELECT '{t}' AS table_name, count(*) AS row_count, CAST({n} AS BIGINT) AS column_count, "
            f"count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {t})) AS duplicate_row_count, "
            f"CASE WHEN count(*) > 0 THEN (count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {t}))) "
            f"/ count(*) * 100 ELSE 0.0 END AS duplicate_row_pct FROM {t}")


TABLE_PROFILE_SQL = "\nUNION ALL\n".join(_table_profile_sql(t) for t in PROFILE_TABLES)


@register("profile_table", survey_id="G17-G18", digits={"duplicate_row_pct": STAT}, sql=TABLE_PROFILE_SQL)
def profile_table(r: Retail):
    return Q.profile_table_many({t: r.tables[t] for t in PROFILE_TABLES})


@register("audit_flags", survey_id="G19", sql=f"""WITH p AS ({"UNION ALL ".join(
    _profile_sql_one(t) + " " for t in PROFILE_TABLES)}), tp AS ({TABLE_PROFILE_SQL}),
f AS (SELECT table_name, column_name, unnest([CASE WHEN null_pct > 5.0 THEN 'high_nulls' END,
             CASE WHEN outlier_pct > 10.0 THEN 'high_outliers' END]) AS flag FROM p)
SELECT * FROM f WHERE flag IS NOT NULL
UNION ALL SELECT table_name, CAST(NULL AS VARCHAR), 'high_duplicates' FROM tp WHERE duplicate_row_pct > 1.0""")
def audit_flags(r: Retail):
    prof = Q.profile_tables({t: r.tables[t] for t in PROFILE_TABLES})
    tp = Q.profile_table_many({t: r.tables[t] for t in PROFILE_TABLES})
    return Q.audit_flags(prof, tp)


@register("audit_totals", survey_id="G19", sql=f"""WITH tp AS ({TABLE_PROFILE_SQL}), rules AS ({rules_sql(BUSINESS_RULES)})
SELECT count(*) AS total_tables, CAST(sum(row_count) AS BIGINT) AS total_rows, CAST(sum(duplicate_row_count) AS BIGINT) AS total_duplicate_rows,
  (SELECT count(*) FROM rules) AS total_rules, (SELECT count_if(NOT passed) FROM rules) AS total_rule_violations FROM tp""")
def audit_totals(r: Retail):
    return Q.audit_totals(Q.profile_table_many({t: r.tables[t] for t in PROFILE_TABLES}), Q.run_rules(rule_tables(r), BUSINESS_RULES))


SCORECARD_TABLES = TABLES


def _scorecard_sql(t: str) -> str:
    fields = SCHEMAS[t].fields
    num = [f.name for f in fields if f.dataType.simpleString() in _NUM]
    cells = len(fields)
    filled = " + ".join(f"CAST({f.name} IS NOT NULL AS BIGINT)" for f in fields)
    st = ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in num)
    anyz = " OR ".join(f"coalesce(abs(({c} - m_{c}) / (s_{c} + 1e-9)) > 3.0, false)" for c in num) or "false"
    dup = (f"(CASE WHEN (SELECT count(*) FROM {t}) > 0 THEN ((SELECT count(*) FROM {t}) - "
           f"(SELECT count(*) FROM (SELECT DISTINCT * FROM {t}))) / (SELECT count(*) FROM {t}) * 100 ELSE 0.0 END)")
    comp = f"CASE WHEN count(*) > 0 THEN sum({filled}) / (count(*) * {cells}) * 100 ELSE 100.0 END"
    return (f"SELECT '{t}' AS table_name, count(*) AS row_count, {comp} AS completeness_pct, "
            f"{dup} AS duplicate_row_pct, CASE WHEN count(*) > 0 THEN count_if({anyz}) / count(*) * 100 "
            f"ELSE 0.0 END AS outlier_row_pct, CASE WHEN {comp} >= 99 AND {dup} < 1 THEN 'PASS' "
            f"ELSE 'REVIEW' END AS status FROM {t}, (SELECT {st} FROM {t})")


@register("quality_scorecard", survey_id="G20",
          digits={"completeness_pct": STAT, "duplicate_row_pct": STAT, "outlier_row_pct": STAT},
          sql="\nUNION ALL\n".join(_scorecard_sql(t) for t in SCORECARD_TABLES))
def quality_scorecard(r: Retail):
    return reduce(DataFrame.unionByName, [Q.quality_scorecard(r.tables[t], t) for t in SCORECARD_TABLES])
