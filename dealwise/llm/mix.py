"""Mixing sources to target weights by Poisson replication.

A document of a group with mean rate r is repeated Poisson(r) times.  The draw
inverts the Poisson distribution at a uniform number made from a hash of seed, doc_id
and text, so it is the same in every run and on every executor.  Rates follow from
the groups' bytes: r = weight * epochs * all bytes / bytes of the group.  Each copy
gets a random key, and the copies are dealt out and sorted by it, which is a global
shuffle in one exchange.

Every row without an id has a draw of its own, by its place in the input's splits; rows
that repeat both id and text are one document and draw alike, but are dealt out apart.
Null and empty texts count as one byte, so that no group of rows weighs nothing.  Groups
outside ``weights`` (null as well) share what is left of one as one group.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealwise.llm.common import checked_broadcast

#: A larger mean is drawn as a sum of Poisson numbers with means up to this one.
STEP = 16.0


def cdf(mean: float) -> list[float]:
    """P(X <= k) for k = 0, 1, ... up to where it is 1 for any 52-bit number."""
    term = total = math.exp(-mean)
    out, k = [], 0
    while term > 1e-19 or k < mean:
        out.append(total)
        k += 1
        term *= mean / k
        total += term
    return out


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from 52 bits of md5 of the parts joined by ':'."""
    digest = F.md5(F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


def _named(group: str, weights: dict[str, float]) -> Column:
    return F.when(F.col(group).isin(*weights), F.col(group)) if weights else F.lit(None).cast("string")


def group_rates(df: DataFrame, group: str, weights: dict[str, float], epochs: float = 1.0,
                text: str = "text") -> dict[str | None, float]:
    """Mean repetitions by group; the key None stands for all groups not in ``weights``.

    Only ``len(weights) + 1`` sums reach the driver, whatever the table's groups are.
    """
    rows = (df.select(_named(group, weights).alias("g"), F.greatest(F.coalesce(F.octet_length(text), F.lit(0)), F.lit(1)).alias("b"))
            .groupBy("g").agg(F.sum("b").alias("b")).collect())
    total = sum(r["b"] for r in rows)
    rest = max(0.0, 1.0 - sum(weights.values()))
    return {r["g"]: (weights.get(r["g"], rest) if r["g"] is not None else rest) * epochs * total / r["b"] for r in rows}


def poisson_mix(df: DataFrame, weights: dict[str, float], group: str = "source", doc_id: str = "doc_id",
                text: str = "text", epochs: float = 1.0, seed: str = "mix",
                copy: str | None = "copy") -> DataFrame:
    """Every row of ``df`` repeated by its draw, in globally shuffled order.

    ``copy`` names the column of the copy's number from 0 (None: no such column; an
    input column of that name is replaced).  All other columns stay.
    """
    spark = df.sparkSession
    rates = group_rates(df, group, weights, epochs, text)
    if not rates:
        return df.select(*[c for c in df.columns if copy is None or c.lower() != copy.lower()],
                         *([F.lit(0).alias(copy)] if copy else []))
    table = []
    for g, rate in rates.items():
        draws = max(1, math.ceil(rate / STEP))
        table.append((g, draws, cdf(rate / draws)))
    cdfs = checked_broadcast(spark.createDataFrame(table, "g string, draws int, cdf array<double>"), len(weights) + 1)
    # the input row travels as one struct, so its column names cannot clash with ours
    kept = [c for c in df.columns if copy is None or c.lower() != copy.lower()]
    rows = (df.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), _named(group, weights).alias("g"),
                      F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("print"),
                      F.monotonically_increasing_id().alias("at"))
            .join(cdfs.withColumnRenamed("g", "h"), F.col("g").eqNullSafe(F.col("h")), "left"))
    ident = F.coalesce(F.col("row").getField(doc_id).cast("string"), F.concat(F.lit("row "), F.col("at")))

    def draw(j: Column) -> Column:
        u = uniform(F.lit(seed), ident, F.col("print"), j)
        return F.size(F.filter("cdf", lambda c: c <= u))

    times = F.aggregate(F.sequence(F.lit(0), F.col("draws") - 1), F.lit(0), lambda acc, j: acc + draw(j))
    copies = (rows.select("row", "at", times.alias("times")).where("times > 0")
              .select("row", "at", F.explode(F.sequence(F.lit(0), F.col("times") - 1)).alias("n")))
    keyed = copies.withColumn("key", F.xxhash64(F.lit(seed), F.col("row").getField(doc_id), F.col("at"), F.col("n")))
    out = keyed.repartition(F.col("key")).sortWithinPartitions("key")
    return out.select("row.*", *([F.col("n").alias(copy)] if copy else []))
