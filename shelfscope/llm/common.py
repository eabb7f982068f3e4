"""Helpers shared by the training-data operators.

* ``shared_path`` / ``materialise``: lineage is cut by writing a table into the shared folder that the
  session names in ``spark.checkpoint.dir`` (every executor can reread it); nothing is kept on one machine.
* ``words``: the word rule of the contracts on UTF-8 bytes.
* ``map_groups``: Arrow-in / Arrow-out over bounded groups.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Word characters in UTF-8: 0-9, a-z and every byte of a multi-byte character; the rest separates.
_WORD_TABLE = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``.  Raises when the session names none."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        raise RuntimeError("spark.checkpoint.dir is not set: no shared folder to write to")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: later stages and lost
    executors restart from the files."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(nullable(df.schema)).parquet(path)


def nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def words(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased, as UTF-8;
    a null text has none."""
    if text is None:
        return []
    # bytes.lower() changes A-Z only, so other letters stay as they are
    return text.encode("utf-8", "replace").lower().translate(_WORD_TABLE).split()


def group_batches(batches, keys: list[str]):
    """The groups of neighbouring rows that agree in ``keys``, a record batch each (one is held at a time)."""
    carry = None
    for b in batches:
        if not b.num_rows:
            continue
        if carry is not None:
            b = pa.Table.from_batches([carry, b]).combine_chunks().to_batches()[0]
        edge = np.zeros(b.num_rows - 1, bool)
        for k in keys:
            col = b.column(b.schema.names.index(k))
            edge |= ~np.asarray(pc.fill_null(pc.equal(col[1:], col[:-1]), False))
        cuts = np.concatenate([[0], np.flatnonzero(edge) + 1]).tolist()
        for s, e in zip(cuts, cuts[1:]):
            yield b.slice(s, e - s)
        carry = b.slice(cuts[-1])
    if carry is not None:
        yield carry


def map_groups(df: DataFrame, keys: list[str], fn, schema: str) -> DataFrame:
    """``fn(pa.RecordBatch of one group) -> {column: values} | None`` for every group of ``keys`` (bounded
    groups only: one is held at a time).  Rows meet by a shuffle on the keys and are read in their order, so
    many small groups cost no worker call each."""
    out = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches):
        kept: list[dict] = []
        size = 0

        def flush():
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([g[f.name] for g in kept]), f.type) for f in out], schema=out)

        for g in group_batches(batches, keys):
            got = fn(g)
            if got is not None:
                kept.append(got)
                size += len(next(iter(got.values())))
                if size >= 20_000:
                    yield flush()
                    kept, size = [], 0
        if kept:
            yield flush()
    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def fixed(column: pa.Array, dtype) -> np.ndarray:
    """A binary column of equally long values as the rows of a matrix."""
    flat = b"".join(column.to_pylist())
    return np.frombuffer(flat, dtype).reshape(len(column), -1) if flat else np.empty((len(column), 0), dtype)
