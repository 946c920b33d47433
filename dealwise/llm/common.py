"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealwise.session import scratch_path

#: Rows per Arrow batch.  Texts can be long, so a batch must stay small for the
#: memory of a Python worker to be bounded.
BATCH_ROWS = 256


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound the rows that one Arrow batch carries to a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (names compare without case)."""
    have = {c.lower() for c in df.columns}
    while base.lower() in have:
        base += "_"
    return base


def utf8(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column; null reads as empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b"" if x is None else x for x in column.cast(kind).to_pylist()]


def stored_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` to the shared scratch folder: (frame read back, its folder).

    Cuts lineage in a way that survives lost executors: the files are in the
    folder named by ``spark.checkpoint.dir``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def stored(df: DataFrame, name: str) -> DataFrame:
    """:func:`stored_at` for a frame that a lazy result reads: its files stay until the
    checkpoint folder is cleared."""
    return stored_at(df, name)[0]


def hash_sample(df: DataFrame, rows: int, keys: list[str], total: int | None = None) -> DataFrame:
    """At most ``rows`` rows of ``df``, those with the least hash of ``keys``.

    Only about three times as many rows get into the sort, at any table size.
    """
    total = df.count() if total is None else total
    key = F.xxhash64(*keys)
    share = min(1.0, 3.0 * rows / max(total, 1))
    near = df if share >= 1 else df.where(key < F.lit(int(-(1 << 63) + share * (1 << 64))))
    return near.orderBy(key, *keys).limit(rows)


def checked_broadcast(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast ``df``, whose number of rows the caller has proved to be at most ``rows``."""
    return F.broadcast(df.limit(rows))
