"""Parquet / JSON sinks, a feature store with a manifest table and
run lineage records.  Paths are expected on shared storage (the cluster's
checkpoint / warehouse location), never a machine-local folder."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_base


def shared_root(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's ``spark.checkpoint.dir`` (the
    cluster's shared folder).  There is no local fallback: without a
    configured folder the sink refuses to write."""
    return f"{checkpoint_base(spark)}/shelfscope-{name}-{uuid.uuid4().hex[:8]}"


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> str:
    """Parquet table (optionally partitioned)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a fresh folder of the shared root and read back: what follows starts from the files."""
    spark = df.sparkSession
    return spark.read.schema(df.schema).parquet(write_table(df, shared_root(spark, name)))


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """JSON lines of (possibly nested) result rows."""
    df.write.mode(mode).json(path)
    return path


class FeatureStore:
    """Named feature tables under one root plus a manifest table
    (name, path, rows, columns, column names, saved_at)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, name: str, df: DataFrame) -> None:
        write_table(df, self.path(name))
        saved = self.spark.read.parquet(self.path(name))
        entry = saved.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("name"), F.lit(self.path(name)).alias("path"), "n_rows",
            F.lit(len(saved.columns)).cast("long").alias("n_columns"),
            F.lit(",".join(saved.columns)).alias("columns"),
            F.lit(dt.datetime.now(dt.timezone.utc).isoformat()).alias("saved_at"))
        entry.write.mode("append").parquet(f"{self.root}/_manifest")

    def load(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def manifest(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/_manifest")


def lineage_records(tables: dict[str, DataFrame], sources: dict[str, str], version: str) -> DataFrame:
    """A4: one record per table: name, source path, row / column count,
    version and the generation timestamp (a union of per-table counts)."""
    now = dt.datetime.now(dt.timezone.utc).isoformat()
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(name).alias("table_name"), F.lit(sources.get(name, "")).alias("source"), "n_rows",
        F.lit(len(df.columns)).cast("long").alias("n_columns"), F.lit(version).alias("version"),
        F.lit(now).alias("generated_at")) for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
