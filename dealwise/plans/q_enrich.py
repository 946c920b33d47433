"""Lookup enrichment queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealwise.operators.enrich import enrich
from dealwise.plans.registry import register
from dealwise.sources.tables import read_table
from dealwise.spec import LookupSpec

# Deal lookups of the catalogue (J4-style configuration).
DEAL_LOOKUPS = (
    LookupSpec("person_id", "persons", "person_name", candidates=("full_name", "name")),
    LookupSpec("org_id", "organizations", "org_name", value_col="company"),
    LookupSpec("stage_id", "stages", "stage_name"),
    LookupSpec("pipeline_id", "pipelines", "pipeline_name"),  # no such column: skipped (J3)
)


def _deals(spark: SparkSession, base: str) -> DataFrame:
    o = read_table(spark, base, "orders")
    return o.select(F.col("o_orderkey").alias("id"),
                    F.when(F.col("o_orderkey") % 11 == 0, F.lit(None).cast("bigint"))
                     .otherwise(F.col("o_custkey")).alias("person_id"),
                    (F.col("o_orderkey") % 30).alias("org_id"),
                    (F.col("o_orderkey") % 25).alias("stage_id"),
                    F.lit("old").alias("org_name"))


def _dims(spark: SparkSession, base: str, string_keys: bool = False) -> dict[str, DataFrame]:
    c = read_table(spark, base, "customer")
    n = read_table(spark, base, "nation")
    key = (lambda col: F.col(col).cast("string")) if string_keys else F.col
    return {
        "persons": c.select(key("c_custkey").alias("id"), F.col("c_name").alias("name")),
        "organizations": n.select(key("n_nationkey").alias("id"), F.col("n_name").alias("company")),
        "stages": n.select(key("n_nationkey").alias("id"),
                           F.concat(F.col("n_name"), F.lit("#"), F.col("n_regionkey").cast("string"))
                            .alias("title")),
    }


ENRICH_SQL = """
SELECT o.o_orderkey AS id,
       CASE WHEN o.o_orderkey % 11 = 0 THEN NULL ELSE o.o_custkey END AS person_id,
       o.o_orderkey % 30 AS org_id, o.o_orderkey % 25 AS stage_id,
       CASE WHEN n1.n_nationkey IS NOT NULL THEN n1.n_name ELSE 'old' END AS org_name,
       c.c_name AS person_name,
       n2.n_name || '#' || CAST(n2.n_regionkey AS VARCHAR) AS stage_name
FROM orders o
LEFT JOIN customer c ON c.c_custkey = CASE WHEN o.o_orderkey % 11 = 0 THEN NULL ELSE o.o_custkey END
LEFT JOIN nation n1 ON n1.n_nationkey = o.o_orderkey % 30
LEFT JOIN nation n2 ON n2.n_nationkey = o.o_orderkey % 25
"""


@register("lookup_enrich", ENRICH_SQL)
def q_lookup_enrich(spark: SparkSession, base: str) -> DataFrame:
    """Labels from three dimensions; unmatched rows keep their old label."""
    return enrich(_deals(spark, base), DEAL_LOOKUPS, _dims(spark, base))


@register("lookup_string_key", ENRICH_SQL)
def q_lookup_string_key(spark: SparkSession, base: str) -> DataFrame:
    """The same lookups against dimensions whose ids are stored as text."""
    return enrich(_deals(spark, base), DEAL_LOOKUPS, _dims(spark, base, True), string_keys=True)
