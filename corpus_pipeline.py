"""Corpus pipeline: quality rules, near duplicates, decontamination, mixing, shards.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of documents.  ``run`` writes each stage's result to the shared
folder and reads it back, so a lost executor costs one stage's tasks at most.

Null, empty or repeated rows and further columns: see the operators.  No stage takes a
doc_id for a key: rows without one, or that repeat one, are judged each by itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealwise.llm import common, decontaminate, mix, neardups, quality, shard
from dealwise.llm.queries import WEIGHTS

#: The last stage's capacity is a binary search over group sizes, which SQL cannot
#: say in a bounded query; tests hold the stages against brute force.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    out = common.fresh(docs, "quality")
    return quality.quality_cascade(docs, out=out).where(F.col(out)["kept"]).drop(out)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: that of the least id, then text (rows
    without an id come last).  Rows that repeat an id are judged by their texts, each by
    itself, and rows without words all stay."""
    number = common.fresh(docs, "row_number")
    rows = neardups.numbered(docs, number)
    classes = neardups.near_classes(rows.select(F.col(number).alias("id"), "text"))
    place = F.struct(F.col("doc_id").isNull().alias("lost"), "doc_id", F.xxhash64("text").alias("hash"), F.col("id"))
    named = rows.select(F.col(number).alias("id"), "doc_id", "text").withColumn("place", place).select("id", "place")
    kept = classes.join(named, "id").groupBy("class").agg(F.min("place")["id"].alias("kept"))
    return rows.join(kept.select("kept"), F.col(number) == F.col("kept"), "left_semi").drop(number)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    out = common.fresh(docs, "hits")
    found = decontaminate.benchmark_hits(docs, common.table(spark, sf_dir, "benchmark"), out=out)
    return found.where(F.col(out)["n_hit"] == 0).drop(out)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the sources' target shares, in shuffled order."""
    return mix.poisson_mix(docs, WEIGHTS, copy=None)


def shard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their place (size, text_crc32, law, shard, slot, grown_shard)."""
    return shard.shard_texts(docs, 24, out="placed")


STAGES = [
    ("quality rules", quality_stage),
    ("near duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mix_stage),
    ("sharding", shard_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = common.table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = common.stored(docs, f"stage{k}")
    return docs
