"""DuckDB-side twins of the retail role mapping (``sources/retail.py``),
used to build oracle SQL for the registered queries."""

TX = """tx AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line_no, o_custkey AS customer_id,
         l_partkey AS product_id, l_suppkey AS store_id, o_orderdate AS date, l_shipdate AS ship_date,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS period,
         l_quantity AS quantity, l_discount AS discount_pct,
         l_extendedprice * (1 - l_discount) AS gross_revenue,
         l_quantity * p_retailprice AS cogs,
         l_extendedprice * (1 - l_discount) - l_quantity * p_retailprice AS gross_profit,
         CASE WHEN l_extendedprice * (1 - l_discount) <> 0 THEN
           (l_extendedprice * (1 - l_discount) - l_quantity * p_retailprice) / (l_extendedprice * (1 - l_discount)) END AS margin,
         l_extendedprice * (1 - l_discount) / l_quantity AS unit_price,
         l_extendedprice * l_tax AS operating_cost,
         p_type AS category, p_brand AS subcategory,
         CASE WHEN p_type = 'PROMO' THEN 'private_label' WHEN p_type IS NOT NULL THEN 'national_brand' END AS brand_type
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey)"""

STORES = """stores AS (
  SELECT s_suppkey AS store_id, s_name AS store_name, n_name AS store_nation,
         r_name AS cluster, s_acctbal AS size
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey)"""

CUSTOMERS = """customers AS (
  SELECT c_custkey AS customer_id, c_mktsegment AS tier, n_name AS customer_nation,
         r_name AS customer_region, c_acctbal AS acctbal
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey)"""

PRODUCTS = """products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
         p_brand AS subcategory,
         CASE WHEN p_type = 'PROMO' THEN 'private_label' WHEN p_type IS NOT NULL THEN 'national_brand' END AS brand_type,
         p_retailprice AS unit_cost, p_size AS size
  FROM part)"""

EV = """ev AS (
  SELECT e.*, n_name AS market, CAST(ts AS DATE) AS day
  FROM events e LEFT JOIN customer ON user_id = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey)"""

MARKETING = EV + """,
mkt AS (SELECT market, day AS period, event_type AS channel, sum(value) AS spend
        FROM ev WHERE event_type <> 'purchase' GROUP BY ALL),
resp AS (SELECT market, day AS period, sum(value) AS revenue
         FROM ev WHERE event_type = 'purchase' GROUP BY ALL)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# ---- p-values in SQL: Simpson sums of the densities, independent of functions/pvalues.py ----
_N = 20000
_W = f"(CASE WHEN k IN (0, {_N}) THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END)"


def _simpson(f: str, top: str) -> str:
    """∫ f(u) du from 0 to ``top``; ``f`` uses {u}."""
    return f"((SELECT sum({_W} * ({f.format(u=f'({top} * k / {_N}.0)')})) FROM range(0, {_N} + 1) steps(k)) * ({top}) / {_N}.0 / 3)"


def t_two_sided_sql(t: str, df: str) -> str:
    body = _simpson(f"pow(1 + {{u}} * {{u}} / ({df}), -(({df}) + 1) / 2.0)", f"least(abs({t}), 40.0)")
    scale = f"exp(lgamma((({df}) + 1) / 2.0) - lgamma(({df}) / 2.0)) / sqrt(({df}) * pi())"
    return f"greatest(0.0, 1 - 2 * {scale} * {body})"


def t_greater_sql(t: str, df: str) -> str:
    two = t_two_sided_sql(t, df)
    return f"CASE WHEN {t} > 0 THEN {two} / 2 ELSE 1 - {two} / 2 END"


def norm_sf_sql(z: str) -> str:
    body = _simpson("exp(-{u} * {u} / 2)", f"least(abs({z}), 40.0)")
    half = f"greatest(0.0, 0.5 - {body} / sqrt(2 * pi()))"
    return f"CASE WHEN {z} > 0 THEN {half} ELSE 1 - {half} END"


def f_sf_sql(f: str, d1: str, d2: str) -> str:
    """The beta integral up to d2 / (d2 + d1 f), for d1 ≥ 2."""
    a, b = f"(({d2}) / 2.0)", f"(({d1}) / 2.0)"
    body = _simpson(f"CASE WHEN k = 0 THEN 0.0 ELSE pow({{u}}, {a} - 1) * pow(1 - {{u}}, {b} - 1) END", f"(({d2}) / (({d2}) + ({d1}) * ({f})))")
    return f"exp(lgamma({a} + {b}) - lgamma({a}) - lgamma({b})) * {body}"


def t_quantile_sql(z: float, df: str) -> str:
    """Student quantile at the normal quantile z by the Cornish-Fisher series (df of a hundred or more)."""
    z3, z5, z7, z9 = z ** 3, z ** 5, z ** 7, z ** 9
    terms = [z, (z3 + z) / 4, (5 * z5 + 16 * z3 + 3 * z) / 96, (3 * z7 + 19 * z5 + 17 * z3 - 15 * z) / 384,
             (79 * z9 + 776 * z7 + 1482 * z5 - 1920 * z3 - 945 * z) / 92160]
    return "(" + " + ".join(f"CAST({c!r} AS DOUBLE) / pow(({df}), {k})" for k, c in enumerate(terms)) + ")"
