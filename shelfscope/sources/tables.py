"""A1-A3: declared-schema Parquet scans, lazy table bundles, table manifest."""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

L, I, D, S, TS = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(), T.TimestampNTZType()


def _schema(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


# Declared schemas of the input tables (no inference on read).
SCHEMAS: dict[str, T.StructType] = {
    "region": _schema(("r_regionkey", I), ("r_name", S)),
    "nation": _schema(("n_nationkey", I), ("n_name", S), ("n_regionkey", I)),
    "customer": _schema(("c_custkey", L), ("c_name", S), ("c_nationkey", I),
                        ("c_acctbal", D), ("c_mktsegment", S)),
    "supplier": _schema(("s_suppkey", L), ("s_name", S), ("s_nationkey", I), ("s_acctbal", D)),
    "part": _schema(("p_partkey", L), ("p_name", S), ("p_brand", S), ("p_type", S),
                    ("p_size", I), ("p_retailprice", D)),
    "orders": _schema(("o_orderkey", L), ("o_custkey", L), ("o_orderstatus", S),
                      ("o_totalprice", D), ("o_orderdate", TS), ("o_orderpriority", S)),
    "lineitem": _schema(("l_orderkey", L), ("l_partkey", L), ("l_suppkey", L),
                        ("l_linenumber", I), ("l_quantity", D), ("l_extendedprice", D),
                        ("l_discount", D), ("l_tax", D), ("l_returnflag", S),
                        ("l_linestatus", S), ("l_shipdate", TS)),
    "events": _schema(("event_id", L), ("ts", TS), ("user_id", L), ("event_type", S),
                      ("value", D), ("props", S)),
    "documents": _schema(("doc_id", L), ("text", S), ("lang", S), ("source", S), ("n_chars", L)),
    "labels": _schema(("doc_id", L), ("quality", I), ("toxic", I)),
    "pages": _schema(("page_id", L), ("url", S), ("html", S)),
    "benchmark": _schema(("item_id", L), ("text", S)),
    "conversations": _schema(("conv_id", L), ("turn", L), ("role", S), ("text", S)),
    "embeddings": _schema(("vec_id", L), ("embedding", T.ArrayType(T.FloatType())), ("label", I)),
}

TABLES = tuple(SCHEMAS)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def scan_table(spark: SparkSession, sf_dir: str, name: str,
               schema: T.StructType | None = None) -> DataFrame:
    """Lazy Parquet scan with a declared schema (A1).

    Raises FileNotFoundError for a missing local table so a bad path fails at
    plan-construction time instead of inside the first action."""
    path = table_path(sf_dir, name)
    if "://" not in path and not os.path.exists(path):
        raise FileNotFoundError(f"table {name!r} not found at {path}")
    schema = schema or SCHEMAS.get(name)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def load_all(spark: SparkSession, sf_dir: str, names=TABLES) -> dict[str, DataFrame]:
    """A2: dict of lazy scans; nothing is read until an action runs."""
    return {n: scan_table(spark, sf_dir, n) for n in names}


def table_manifest(tables: dict[str, DataFrame]) -> DataFrame:
    """A3: one row per table: name, row count, column count, column names.

    Each branch is a global count (Parquet footers answer it without a full
    read); the branches are unioned into one plan."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.lit(name).alias("table_name"), "n_rows",
                F.lit(len(df.columns)).cast("long").alias("n_columns"),
                F.lit(",".join(df.columns)).alias("column_names"))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)
