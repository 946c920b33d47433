"""Structured Streaming backfills.

Page landings arrive in drops; each run drains whatever is new with
``Trigger.AvailableNow`` in bounded micro-batches and upserts every batch
(idempotent per batch id).  The streaming checkpoint in the shared folder is
the resume point: a second run over the same checkpoint only sees new files.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealwise.operators.upsert import read_table_at, upsert_table
from dealwise.plans.q_sources import ORDER_FIELDS, ORDERS_SQL, _orders
from dealwise.plans.q_sync import ACTIVITY, _iso
from dealwise.plans.registry import ORACLE, register
from dealwise.plans.sync import EXTRAS, read_synced, sync_entity
from dealwise.session import scratch_path
from dealwise.sources.pages import build_page_landing, record_fields, scan_pages
from dealwise.sources.tables import read_table
from dealwise.streaming.backfill import stream_backfill
from dealwise.streaming.state import save_sync_state


# Fixed value (reference limit): rows per backfill run.
ACTIVITY_BUDGET = 100_000


def _drop(pages: DataFrame, path: str, files: int = 4) -> None:
    pages.select("value").repartition(files).write.mode("overwrite").text(path)


@register("backfill_resume", ORDERS_SQL)
def q_backfill_resume(spark: SparkSession, base: str) -> DataFrame:
    """Two landing drops, two AvailableNow runs on one checkpoint, one table."""
    root = scratch_path(spark, f"stream/orders-{uuid.uuid4().hex}")
    pages = build_page_landing(_orders(spark, base), "o_orderkey", 500)
    last = pages.agg(F.max("page")).first()[0] or 0
    table, ckpt = f"{root}/table", f"{root}/checkpoint"

    def handle(batch: DataFrame, batch_id: int) -> None:
        recs = scan_pages(batch, "value")
        rows = recs.select(*record_fields(F.col("record"), ORDER_FIELDS))
        upsert_table(batch.sparkSession, table, rows, ["o_orderkey"], buckets=8, order=[F.lit(0)])

    _drop(pages.filter(F.col("page") <= last // 2), f"{root}/landing/drop1")
    stream_backfill(spark, f"{root}/landing/*", "value string", handle, ckpt,
                    files_per_batch=4, fmt="text")
    save_sync_state(spark, f"{root}/_state", "orders", (last // 2 + 1) * 500, False)
    _drop(pages.filter(F.col("page") > last // 2), f"{root}/landing/drop2")
    stream_backfill(spark, f"{root}/landing/*", "value string", handle, ckpt,
                    files_per_batch=4, fmt="text")
    save_sync_state(spark, f"{root}/_state", "orders", None, True)
    return read_table_at(spark, table)


@register("micro_batch_upsert", ORACLE["entity_sync_activities"])
def q_micro_batch_upsert(spark: SparkSession, base: str) -> DataFrame:
    """The activities entity synced batch by batch from a streaming landing."""
    root = scratch_path(spark, f"stream/activities-{uuid.uuid4().hex}")
    li = read_table(spark, base, "lineitem")
    raw = li.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").alias("dealId"),
        F.concat(F.lit("Line "), F.col("l_linenumber").cast("string")).alias("subject"),
        F.col("l_returnflag").alias("type"), (F.col("l_linestatus") == "F").alias("done"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("dueDate"), F.lit("10:30").alias("dueTime"),
        _iso(F.timestamp_add("SECOND", (F.col("l_partkey") % 1000).cast("int"), F.col("l_shipdate")))
         .alias("updateTime"))
    # pages group ids, so every copy of an id lands in the same micro-batch
    _drop(build_page_landing(raw, "id", 500), f"{root}/landing/drop1", files=8)

    def handle(batch: DataFrame, batch_id: int) -> None:
        sync_entity(batch.sparkSession, scan_pages(batch, "value"), ACTIVITY, f"{root}/tables", run_id=f"batch-{batch_id}")

    stream_backfill(spark, f"{root}/landing/*", "value string", handle, f"{root}/checkpoint",
                    files_per_batch=4, fmt="text")
    return read_synced(spark, f"{root}/tables", ACTIVITY).drop(EXTRAS)


@register("paged_stream_backfill", ORDERS_SQL)
def q_paged_stream_backfill(spark: SparkSession, base: str) -> DataFrame:
    """The offset page source as a stream: page ranges fetched by tasks, a
    100,000-row budget per run, drained on one checkpoint by runs over what is available now
    (the batches of one stream, see ``drain_paged_stream``), upserted per batch."""
    from dealwise.plans.q_sources import _landing
    from dealwise.sources.paged import register_sources
    from dealwise.streaming.backfill import drain_paged_stream
    root = scratch_path(spark, f"stream/paged-{uuid.uuid4().hex}")
    landing = _landing(spark, base, cursor=False)
    register_sources(spark)
    table = f"{root}/table"

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = scan_pages(batch, "body").select(*record_fields(F.col("record"), ORDER_FIELDS))
        upsert_table(batch.sparkSession, table, rows, ["o_orderkey"], buckets=8, order=[F.lit(0)])

    drain_paged_stream(spark, "offset_pages",
                       {"landing": landing, "endpoint": "/deals", "maxRowsPerBatch": str(ACTIVITY_BUDGET)},
                       handle, f"{root}/checkpoint", state=(f"{root}/_state", "orders"))
    return read_table_at(spark, table)
