"""Declared casts, inferred types, the activity rollup and the end-to-end run.

(K13 K14, X24, A8, C9 + B3.)
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealwise.functions.custom_fields import cast_inferred, infer_types
from dealwise.operators.bi import activity_rollup, build_bi_fact
from dealwise.operators.evolve import cast_declared, cast_rejects
from dealwise.plans import q_sync as QS
from dealwise.plans.registry import register
from dealwise.plans.sync import read_synced, run_all
from dealwise.session import scratch_path
from dealwise.sources.tables import read_table

DECLARED = {"value": "decimal(18,4)", "add_date": "date", "priority": "int", "status": "varchar(10)"}


def _raw_orders(spark: SparkSession, base: str) -> DataFrame:
    o = read_table(spark, base, "orders")
    return o.select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("value"),
                    F.col("o_orderdate").cast("string").alias("add_date"),
                    F.substring("o_orderpriority", 1, 1).alias("priority"),
                    F.col("o_orderstatus").alias("status"),
                    F.when(F.col("o_orderkey") % 7 == 0, F.lit("n/a"))
                     .otherwise(F.col("o_custkey").cast("string")).alias("person_ref"))


@register("declared_cast", """
SELECT o_orderkey AS id, CAST(o_totalprice AS DECIMAL(18,4)) AS value, CAST(o_orderdate AS DATE) AS add_date,
       CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority, o_orderstatus AS status,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_custkey END AS person_ref
FROM orders
""")
def q_declared_cast(spark: SparkSession, base: str) -> DataFrame:
    """Declared types override inferred ones; bad values become NULL."""
    return cast_declared(_raw_orders(spark, base), {**DECLARED, "person_ref": "bigint"})


@register("cast_rejects", """
SELECT CAST(count(*) FILTER (WHERE o_orderkey % 7 = 0) AS BIGINT) AS rejects_person_ref,
       CAST(0 AS BIGINT) AS rejects_value
FROM orders
""")
def q_cast_rejects(spark: SparkSession, base: str) -> DataFrame:
    """Per declared column, how many non-null values failed to cast (one pass)."""
    df = _raw_orders(spark, base)
    aggs = cast_rejects(df, {"person_ref": "bigint", "value": "decimal(18,4)"})
    return df.agg(*aggs.values())


@register("infer_types", """
SELECT event_id, CASE WHEN event_id % 2 = 0 THEN user_id ELSE user_id + 1 END AS uid,
       event_type AS kind, CAST(json_extract(props, '$.k') AS BIGINT) AS k
FROM events
""")
def q_infer_types(spark: SparkSession, base: str) -> DataFrame:
    """Generated VARIANT columns get the narrowest common type from the data."""
    e = read_table(spark, base, "events")
    v = e.select("event_id",
                 F.when(F.col("event_id") % 2 == 0, F.col("user_id").cast("variant"))
                  .otherwise(F.parse_json((F.col("user_id") + 1).cast("string"))).alias("uid"),
                 F.col("event_type").cast("variant").alias("kind"),
                 F.try_variant_get(F.parse_json("props"), "$.k", "variant").alias("k"))
    return cast_inferred(v, infer_types(v, ["uid", "kind", "k"]))


@register("bi_activity_rollup", """
SELECT l_orderkey AS deal_id, CAST(count(*) AS INTEGER) AS activity_count,
       max(CASE WHEN l_linestatus = 'O' THEN l_shipdate END) AS last_activity_due_date
FROM lineitem GROUP BY l_orderkey
""")
def q_bi_activity_rollup(spark: SparkSession, base: str) -> DataFrame:
    """Per-deal activity count and latest open due date (one partial+final aggregate)."""
    li = read_table(spark, base, "lineitem")
    return activity_rollup(li, deal_key="l_orderkey", due="l_shipdate",
                           open_flag=F.col("l_linestatus") == "O")


@register("sync_all_bi", """
SELECT o.o_orderkey AS deal_id, 'Order #' || CAST(o.o_orderkey AS VARCHAR) AS title,
       CASE o.o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'won' ELSE 'lost' END AS status,
       CAST(o.o_totalprice AS DECIMAL(18,4)) AS value, 'USD' AS currency, o.o_orderdate AS add_time,
       o.o_orderdate + INTERVAL 1 DAY AS update_time, NULL::TIMESTAMP AS close_time,
       c.c_name AS contact_name, 'w' || CAST(c.c_custkey AS VARCHAR) || '@example.com' AS contact_email,
       CASE WHEN c.c_custkey % 2 = 0 THEN '+55 11 ' || CAST(c.c_custkey AS VARCHAR) END AS contact_phone,
       n.n_name AS company_name, NULL::INTEGER AS deal_duration_days, NULL::DOUBLE AS value_per_day
FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey
LEFT JOIN nation n ON n.n_nationkey = o.o_orderkey % 30
""")
def q_sync_all_bi(spark: SparkSession, base: str) -> DataFrame:
    """C9 + B3: organizations, persons and deals synced in dependency order, then the
    BI fact built from the synced tables (the reference's end-to-end flow)."""
    root = scratch_path(spark, f"sync/all-{uuid.uuid4().hex}")
    raws = {
        "organizations": QS.raw_organizations(spark, base),
        "persons": QS.raw_persons(spark, base),
        "deals": QS.raw_deals(spark, base),
    }
    entities = {"organizations": QS.ORG, "persons": QS.PERSON, "deals": QS.DEAL}
    run_all(spark, {k: QS._records(v) for k, v in raws.items()}, entities, root)
    deals = read_synced(spark, root, QS.DEAL)
    people = read_synced(spark, root, QS.PERSON).select(
        "id", F.col("name").alias("contact_name"),
        F.col("email_contatos_primary_value").alias("contact_email"),
        F.col("telefone_contatos_primary_value").alias("contact_phone"))
    orgs = read_synced(spark, root, QS.ORG).select("id", F.col("name").alias("company_name"))
    return build_bi_fact(deals, people, orgs)


@register("sync_run_stats", """
SELECT 'stages' AS flow, CAST(1 AS BIGINT) AS runs, CAST(0 AS BIGINT) AS failures,
       CAST(count(*) AS BIGINT) AS rows_processed, CAST(0 AS BIGINT) AS empty_batches,
       CAST(count(*) FILTER (WHERE n_nationkey % 7 = 0) AS BIGINT) AS invalid_rows,
       CAST(count(*) FILTER (WHERE n_nationkey % 7 = 0) AS BIGINT) AS rejects_kept
FROM nation
""")
def q_sync_run_stats(spark: SparkSession, base: str) -> DataFrame:
    """A3 over a real run log (V1 rejects kept aside): a stage sync where every
    7th record has a non-numeric id, then per-flow counters and kept rejects."""
    from dealwise.operators.runlog import flow_counters
    from dealwise.plans.sync import sync_entity
    n = read_table(spark, base, "nation")
    k = F.col("n_nationkey")
    raw = n.select(k.cast("bigint").alias("order_key"),
                   F.when(k % 7 == 0, F.lit("x")).otherwise(k.cast("string")).alias("id"),
                   F.col("n_name").alias("name"), F.col("n_regionkey").alias("pipelineId"),
                   (k % 5 + 1).alias("orderNr"), (k * 4).cast("string").alias("dealProbability"))
    from dealwise.sources.pages import build_page_landing, scan_pages
    pages = build_page_landing(raw, "order_key", 500)
    root = scratch_path(spark, f"sync/stats-{uuid.uuid4().hex}")
    sync_entity(spark, scan_pages(pages.select("page", "value"), page_col="page"), QS.STAGE, root)
    counters = flow_counters(spark.read.parquet(f"{root}/_run_log"))
    kept = spark.read.parquet(f"{root}/_rejects").groupBy("entity").agg(
        F.count(F.lit(1)).alias("rejects_kept"))
    return counters.join(kept, counters.flow == kept.entity, "left").drop("entity")
