"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealwise.llm.common import stored_at
from dealwise.session import delete_path


def _minima(edges: DataFrame) -> DataFrame:
    """(u, v, m): every edge with the least of u and its neighbours.

    The least is a map-side combined aggregate, and the join back has one row per
    node on its other side, so a node with very many edges is split by AQE.
    """
    least = edges.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
    return (edges.join(least, F.col("u") == F.col("w"))
            .select("u", "v", F.least("u", "m").alias("m")))


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns u and v); root is the least node.

    Each round hangs neighbours with greater ids to the least neighbour and then
    smaller ones, until nothing changes: a logarithmic number of rounds in
    practice.  Each round is written to the shared folder and the one before is
    removed; only a count and a checksum reach the driver.
    """
    now, place = stored_at(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                           .distinct(), "edges")
    mark = _mark(now)
    while mark[0]:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _minima(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        # here u > v in every row: each node hangs itself and its smaller neighbours to the least
        low = _minima(large)
        small = (low.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
                 .where("u != v").distinct())
        old = place
        now, place = stored_at(small, "edges")
        delete_path(edges.sparkSession, old)
        last, mark = mark, _mark(now)
        if last == mark:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
