"""Scans of Parquet tables (S7: column-pruned table scan)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dealwise.session import configure


def read_table(spark: SparkSession, base_dir: str, name: str,
               columns: list[str] | None = None) -> DataFrame:
    """Read ``{base_dir}/{name}.parquet``.

    Column pruning and filter pushdown are left to Catalyst: callers select
    and filter lazily and the scan's ``ReadSchema``/``PushedFilters`` follow.
    ``columns`` is only a convenience for an explicit projection.
    """
    configure(spark)
    df = spark.read.parquet(f"{base_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str,
              lower: int, upper: int, num_partitions: int,
              properties: dict | None = None) -> DataFrame:
    """Partitioned JDBC scan: one task per key range instead of one cursor.

    The reference reads its BI sources in 25k-row chunks over one connection
    and concatenates them in memory; here each range is a separate task.
    """
    return spark.read.jdbc(url, table, column=partition_column,
                           lowerBound=lower, upperBound=upper,
                           numPartitions=num_partitions,
                           properties=properties or {})
