"""Run statistics as tables (A3-A7, A9) instead of an in-process metrics registry.

Every function is a grouped aggregate over a log frame (runs, batches, API
calls); counters that would be Prometheus series in a service become
columns, histograms become cumulative bucket counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealwise.functions.text import endpoint_of
from dealwise.operators.joins import broadcast_if_small

# Histogram bucket edges of the reference's run metrics.
RUN_DURATION_EDGES = (10, 30, 60, 120, 300, 600, 1800, 3600, 7200, 10800)
BATCH_DURATION_EDGES = (0.1, 0.5, 1, 2, 5, 10, 30, 60)
REQUEST_DURATION_EDGES = (0.01, 0.05, 0.1, 0.5, 1, 2, 5, 10, 20, 30, 60)


def flow_counters(runs: DataFrame, flow: str = "flow") -> DataFrame:
    """A3: runs, failures, processed rows, empty batches, invalid rows per flow."""
    return runs.groupBy(flow).agg(
        F.count(F.lit(1)).alias("runs"),
        F.count_if(F.col("failed")).alias("failures"),
        F.sum("rows").alias("rows_processed"),
        F.sum("empty_batches").alias("empty_batches"),
        F.sum("invalid_rows").alias("invalid_rows"))


def throughput(rows: Column, seconds: Column) -> Column:
    """A4: rows per second of a batch; NULL for a zero or missing duration."""
    return rows.cast("double") / F.nullif(seconds.cast("double"), F.lit(0.0))


def bucket_histogram(df: DataFrame, value: str, edges: Sequence[float],
                     by: Sequence[str] = (), prefix: str = "le_") -> DataFrame:
    """A5: cumulative bucket counts ``count(value <= edge)`` per edge, plus ``le_inf``.

    One aggregate with a conditional count per edge (irregular edges rule
    out ``width_bucket``); partial aggregation keeps it map-side.
    """
    def name(e: float) -> str:
        return prefix + (str(int(e)) if float(e).is_integer() else str(e).replace(".", "_"))
    aggs = [F.count_if(F.col(value) <= F.lit(e)).alias(name(e)) for e in edges]
    aggs.append(F.count(F.col(value)).alias(prefix + "inf"))
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def usage_cost(calls: DataFrame, routes: DataFrame, endpoint: str = "endpoint",
               n_calls: str = "calls") -> DataFrame:
    """Σ(cost × calls) per normalised endpoint (first path segment, X26).

    The route catalogue is configuration (tens of rows); the broadcast is
    still guarded by a row bound.
    """
    r = broadcast_if_small(routes.select(F.col("endpoint").alias("__ep"), "cost"), 10_000)
    j = calls.join(r, F.col(endpoint) == F.col("__ep"), "left")
    return (j.groupBy(endpoint_of(F.col(endpoint)).alias("endpoint"))
             .agg(F.sum(n_calls).alias("calls"),
                  F.sum(F.coalesce(F.col("cost"), F.lit(0)) * F.col(n_calls)).alias("cost_total")))


def cache_ratio(calls: DataFrame, entity: str = "entity", hit: str = "hit") -> DataFrame:
    """Share of cache hits per entity."""
    return calls.groupBy(entity).agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if(F.col(hit)).alias("hits"),
        (F.count_if(F.col(hit)) / F.count(F.lit(1))).alias("hit_ratio"))


def row_accounting(written: DataFrame, sentinel_flag: str = "is_sentinel") -> DataFrame:
    """Rows written by a history run and deals that had no change."""
    return written.agg(F.count_if(~F.col(sentinel_flag)).alias("change_rows"),
                       F.count_if(F.col(sentinel_flag)).alias("deals_without_changes"))
