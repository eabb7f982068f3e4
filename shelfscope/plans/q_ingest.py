"""Registered queries of the coercing ingest (B10, B17) and the exact sample (F8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import ranks
from ..sources import ingest
from ..sources.retail import Retail
from .registry import MONEY, register
from .sql import TX, with_

# Text columns with numbers in them: the last path segment and the page parameter of a url
KINDS = {"segment": "long", "page": "long", "rest": "double"}
PAGES_SQL = """raw AS (SELECT regexp_extract(url, '/([^/?#]*)(?:[?#].*)?$', 1) AS segment,
  regexp_extract(url, '[?&]page=([^&#]*)', 1) AS page, regexp_extract(url, '#(.*)$', 1) AS rest FROM pages),
cells AS (SELECT 'segment' AS column_name, segment AS value, 'w' AS kind FROM raw UNION ALL SELECT 'page', page, 'w' FROM raw
  UNION ALL SELECT 'rest', rest, 'd' FROM raw),
judged AS (SELECT column_name, value, value IS NULL OR lower(trim(value)) IN ('', 'na', 'n/a', 'nan', 'null', 'none') AS missing,
  CASE WHEN kind = 'w' THEN regexp_matches(trim(value), '^[+-]?[0-9]+$') AND TRY_CAST(trim(value) AS BIGINT) IS NOT NULL
  ELSE isfinite(TRY_CAST(trim(value) AS DOUBLE)) END AS ok FROM cells)"""


def _raw(r: Retail):
    url = F.col("url")
    return r.tables["pages"].select(F.regexp_extract(url, r"/([^/?#]*)(?:[?#].*)?$", 1).alias("segment"),
                                    F.regexp_extract(url, r"[?&]page=([^&#]*)", 1).alias("page"),
                                    F.regexp_extract(url, r"#(.*)$", 1).alias("rest"))


@register("ingest_report", survey_id="B10,B17", sql=with_(PAGES_SQL) + """SELECT column_name, count(*) AS n_rows, count_if(missing) AS n_missing,
  count_if(NOT missing AND coalesce(ok, false)) AS n_converted, count_if(NOT missing AND NOT coalesce(ok, false)) AS n_rejected,
  count_if(NOT missing AND NOT coalesce(ok, false)) = 0 AS passed FROM judged GROUP BY column_name""")
def ingest_report(r: Retail):
    return ingest.coercion_report(_raw(r), KINDS)


@register("ingest_quarantine", survey_id="B10,B17", sql=with_(PAGES_SQL) + """SELECT column_name, value, count(*) AS n_rows
  FROM judged WHERE NOT missing AND NOT coalesce(ok, false) GROUP BY column_name, value""")
def ingest_quarantine(r: Retail):
    return ingest.quarantine(_raw(r), KINDS)


SAMPLE_N = 1000
HASH_SQL = "CAST('0x' || substr(md5(CAST({key} AS VARCHAR) || '-42'), 1, 12) AS BIGINT)"


@register("exact_sample", survey_id="F8,H10", digits={"gross_revenue": MONEY},
          sql=with_(TX) + f"""SELECT order_id, line_no, gross_revenue FROM (SELECT *, row_number() OVER
  (ORDER BY {HASH_SQL.format(key="order_id || '-' || line_no || '-' || product_id || '-' || store_id")}, order_id, line_no, product_id, store_id) AS k FROM tx) WHERE k <= {SAMPLE_N}""")
def exact_sample(r: Retail):
    keys = ["order_id", "line_no", "product_id", "store_id"]
    rows = ranks.sample_n(r.transactions.select(*keys, "gross_revenue"), SAMPLE_N, keys)
    return rows.select("order_id", "line_no", "gross_revenue")
