"""Centroid clustering of integer vectors in JVM expressions only.

Vectors become integers, ``floor(scale * x)``, so that distances, sums and centroids are
exact and do not depend on the order in which tasks add them up.  Each round is one scan:

* ``zip_with`` and ``aggregate`` give the squared distance to each literal centroid,
* ``array_min`` over ``struct(distance, number)`` chooses the nearest, ties by number,
* one grouped aggregate with a plain sum per component (map-side combined, whole-stage
  codegen) gives ``k`` rows, from which the driver divides the next centroids.

Nothing else reaches the driver, no row is shuffled, and a lost executor costs the scan
of its splits.  One vector that fills a third of the table is added up like any other.

Kept are vectors of exactly ``dim`` components, none null, NaN or infinite; other rows
give no row.  Fewer kept vectors than ``k`` give fewer centroids, an empty table gives no
rows.  Rows that repeat an id are vectors of their own; equal hashes at the start go by
components.  A null id reads as empty text in its hash.  A component with
|floor(scale * x)| over LIMIT stops the job by name, since its squares would not fit
64 bits.  Columns of the input that clash with the result's name are replaced by it.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealwise.llm.common import fresh

K, ROUNDS, DIM, SCALE = 16, 3, 64, 64
#: Greatest integer component: (2 * 2^27)^2 * 64 components = 2^62.
LIMIT = 1 << 27


def integer_vectors(df: DataFrame, vector: str = "embedding", *, dim: int = DIM, scale: int = SCALE,
                    out: str = "q") -> DataFrame:
    """The kept rows of ``df`` with their integer vector as column ``out``."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    kept = df.where((F.size(vector) == dim) & whole)

    def step(x: Column) -> Column:
        y = F.floor(x.cast("double") * scale)
        return F.when(F.abs(x.cast("double") * scale) <= LIMIT, y).otherwise(
            F.raise_error(F.lit(f"a vector component exceeds {LIMIT} / {scale}")).cast("bigint"))

    return kept.withColumn(out, F.transform(vector, step))


def squared_distance(vector: str, centroid: list[int]) -> Column:
    there = F.array(*[F.lit(c).cast("bigint") for c in centroid])
    return F.aggregate(F.zip_with(F.col(vector), there, lambda x, y: (x - y) * (x - y)),
                       F.lit(0).cast("bigint"), lambda s, d: s + d)


def nearest(vector: str, centroids: list[list[int]]) -> Column:
    """struct(distance, cluster) of the nearest centroid; the smaller number wins a tie."""
    return F.array_min(F.array(*[F.struct(squared_distance(vector, c).alias("distance"), F.lit(i).alias("cluster"))
                                 for i, c in enumerate(centroids)]))


def first_centroids(vectors: DataFrame, vec_id: str, k: int, seed: int = 1, q: str = "q") -> list[list[int]]:
    """The ``k`` vectors with the least hash of ``seed:id``, in that order (a top-k, no sort)."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(vec_id).cast("string"), F.lit(""))).cast("binary"), 256)
    return [list(r[0]) for r in vectors.orderBy(order, q).limit(k).select(q).collect()]


def moved(vectors: DataFrame, centroids: list[list[int]], q: str = "q") -> list[list[int]]:
    """One round: every centroid that has vectors becomes their floored mean."""
    at = vectors.select(q, nearest(q, centroids)["cluster"].alias("cluster"))
    sums = at.groupBy("cluster").agg(F.count("*").alias("n"),
                                     *[F.sum(F.col(q)[i]).alias(f"s{i}") for i in range(len(centroids[0]))])
    out = list(centroids)
    for row in sums.collect():  # at most one row per centroid
        out[row["cluster"]] = [row[f"s{i}"] // row["n"] for i in range(len(centroids[0]))]
    return out


def fit(vectors: DataFrame, vec_id: str, *, k: int = K, rounds: int = ROUNDS, seed: int = 1,
        q: str = "q") -> list[list[int]]:
    """Integer centroids after ``rounds`` rounds over all rows of ``vectors``."""
    found = first_centroids(vectors, vec_id, k, seed, q)
    for _ in range(rounds if found else 0):
        found = moved(vectors, found, q)
    return found


def cluster_vectors(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", *, k: int = K,
                    rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE, seed: int = 1,
                    out: str = "placed") -> DataFrame:
    """The kept rows of ``df`` with struct ``out``: cluster, distance, cluster_inertia,
    inertia, centroid_sha256 and the centroid itself."""
    q, near = fresh(df, "q"), fresh(df, "near")
    vectors = integer_vectors(df, vector, dim=dim, scale=scale, out=q)
    centroids = fit(vectors, vec_id, k=k, rounds=rounds, seed=seed, q=q)
    if not centroids:
        empty = F.struct(F.lit(0).alias("cluster"), *[F.lit(0).cast("bigint").alias(c) for c in
                         ("distance", "cluster_inertia", "inertia")], F.lit("").alias("centroid_sha256"),
                         F.col(q).alias("centroid"))
        return vectors.where(F.lit(False)).withColumn(out, empty).drop(q)
    placed = vectors.withColumn(near, nearest(q, centroids))
    sums = placed.groupBy(F.col(near)["cluster"].alias("c")).agg(F.sum(F.col(near)["distance"]).alias("s")).collect()
    inertia = {r["c"]: r["s"] for r in sums}

    def per_cluster(values: list, kind: str) -> Column:
        return F.array(*[F.lit(v).cast(kind) for v in values])[F.col(near)["cluster"]]

    prints = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    there = F.array(*[F.array(*[F.lit(x).cast("bigint") for x in c]) for c in centroids])
    struct = F.struct(F.col(near)["cluster"].alias("cluster"), F.col(near)["distance"].alias("distance"),
                      per_cluster([inertia.get(i, 0) for i in range(len(centroids))], "bigint").alias("cluster_inertia"),
                      F.lit(sum(inertia.values())).cast("bigint").alias("inertia"),
                      per_cluster(prints, "string").alias("centroid_sha256"),
                      there[F.col(near)["cluster"]].alias("centroid"))
    return placed.withColumn(out, struct).drop(q, near)
