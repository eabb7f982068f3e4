"""Query registry: each entry pairs a Spark builder with an optional DuckDB
oracle SQL string and a rounding spec for its double columns.

Rounding is a presentation step applied identically on both sides
(``floor(x·2^k + φ) / 2^k``, see ``functions.expr.rnd``) so order-dependent last-bit differences of
floating sums cannot break the comparison.  Operators themselves keep full
precision.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from ..functions.expr import ROUND_OFFSET, rnd
from ..sources.retail import Retail, retail


@dataclass
class Query:
    name: str
    build: Callable[[Retail], DataFrame]
    sql: str | None = None
    digits: dict[str, int] = field(default_factory=dict)
    survey_id: str = ""


REGISTRY: dict[str, Query] = {}

# binary rounding levels (bits below the point): money sums, per-unit values, statistics
MONEY, UNIT, STAT = 4, 12, 30


def register(name: str, sql: str | None = None, digits: dict[str, int] | None = None,
             survey_id: str = ""):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, dict(digits or {}), survey_id)
        return fn
    return deco


def round_columns(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    if not digits:
        return df
    return df.withColumns({c: rnd(c, d) for c, d in digits.items()})


def wrap_sql(sql: str, digits: dict[str, int]) -> str:
    if not digits:
        return sql
    off = f"CAST('{ROUND_OFFSET!r}' AS DOUBLE)"

    def one(c: str, d: int) -> str:
        x = f'"{c}"'
        return (f"CASE WHEN {x} IS NULL OR isnan({x}) OR abs({x}) >= CAST({float(2 ** (53 - d))!r} AS DOUBLE) "
                f"THEN {x} ELSE floor({x} * {2 ** d} + {off}) / {2 ** d} END AS {x}")
    repl = ", ".join(one(c, d) for c, d in digits.items())
    return f"SELECT * REPLACE ({repl}) FROM ({sql}) AS q"


def run_query(name: str, spark: SparkSession, sf_dir: str, fact_path: str | None = None) -> DataFrame:
    """The query's lazy plan; ``fact_path`` names transactions written by ``prepare_fact``."""
    q = REGISTRY[name]
    return round_columns(q.build(retail(spark, sf_dir, fact_path)), q.digits)


def bigint_counts(sql: str) -> str:
    """DuckDB types ``count_if`` as HUGEINT; Spark's ``count_if`` is BIGINT.
    Wrap every ``count_if(...)`` call in ``CAST(... AS BIGINT)``."""
    out, i, key = [], 0, "count_if("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 0, j + len(key) - 1
        while True:
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        out.append(sql[i:j])
        inner = bigint_counts(sql[j + len(key):k])
        out.append(f"CAST({key}{inner}) AS BIGINT)")
        i = k + 1


def oracle(name: str) -> str | None:
    q = REGISTRY[name]
    return None if q.sql is None else wrap_sql(bigint_counts(q.sql), q.digits)
