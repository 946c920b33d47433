"""Resumable backfills.

* :func:`history_run` — one stage-history run (C7): pending deals (anti
  join), newest first within the run budget, their change logs, changes plus
  sentinels, ready for a single upsert.  Idempotent: re-running after a
  crash recomputes the same rows, and the upsert makes them land once.
* :func:`stream_backfill` — C5/C6 with Structured Streaming: a file landing
  is drained in bounded micro-batches (``maxFilesPerTrigger``), each batch
  validated, transformed and upserted in ``foreachBatch``; the checkpoint
  (in the shared checkpoint folder) holds the cursor, so a restarted job
  resumes where the last committed batch ended.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from concurrent.futures import Future, ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType

from dealwise.operators import history as H
from dealwise.operators.pending import ONE_TASK, newest_first, newest_stored, pending_keys
from dealwise.operators.segments import read_table_at, table_exists, upsert_table
from dealwise.session import stored
from dealwise.streaming.state import get_sync_state, save_sync_state


def history_run(deals: DataFrame, pages: DataFrame, done: DataFrame, budget: int,
                run_ts: Column | None = None) -> DataFrame:
    """The rows one history run writes (``deal_id, stage_id, change_time, user_id``)."""
    pend = pending_keys(deals, done, "id", "deal_id")
    batch = newest_first(pend, budget, [F.col("add_time")], ["id"])
    # the batch holds at most ``budget`` keys (the LIMIT is the size proof)
    keys = F.broadcast(batch.select(F.col("id").alias("deal_id")))
    items = H.change_items(pages.join(keys, "deal_id", "left_semi"))
    changes = H.stage_changes(items)
    return H.latest_per_stage(changes).unionByName(H.stage_sentinels(batch, changes, run_ts))


#: Tables of the stage-history flow: the history, and the deals it has gone through.
HISTORY, HISTORY_DONE = "negocios_etapas_historico", "negocios_etapas_processados"
HISTORY_LOG = ("run_id string, deals bigint, change_rows bigint, deals_without_changes bigint, rejected_changes bigint")


def history_flow(spark: SparkSession, deals: DataFrame, pages: DataFrame | Callable[[DataFrame], DataFrame], root: str,
                 budget: int, run_id: str, order: Sequence[str] = ("update_time", "add_time"),
                 run_ts: Column | None = None) -> dict | None:
    """One stage-history run that writes; None when no deal is left.

    The newest ``budget`` deals that no run went through are stored, their change logs
    (``pages``: a frame, or a function of the keys that fetches them) decoded and
    summarised once, and the summary stored: rows to write, sentinels, rejects and the
    accounting (A9) all read it.  History first, then the deals gone through: a run that
    dies between the two is done again and writes the same.  A deal without a change and
    without a stage writes no row, but is gone through like any other.
    """
    done = f"{root}/{HISTORY_DONE}"
    left = pending_keys(deals, read_table_at(spark, done), "id", "deal_id") if table_exists(spark, done) else deals
    by = F.coalesce(*[F.col(c) for c in order if c in deals.columns])
    batch = newest_stored(left.select("id", "stage_id", "add_time", by.alias("__by")), budget, [F.col("__by")], ["id"],
                          "history-deals").drop("__by")
    n_deals = batch.count()
    if not n_deals:
        return None
    keys = batch.select(F.col("id").alias("deal_id"))
    # a small LIMIT proves the batch's size; a budget that grows with the table is left to Catalyst
    few = F.broadcast(keys.limit(budget)) if budget <= ONE_TASK else keys
    found = pages(keys) if callable(pages) else pages.join(few, "deal_id", "left_semi")
    summary = stored(H.change_summary(H.change_items(found)), "history-changes")
    changes = summary.where(F.col(H.STAGE_KEY).isNotNull()).select("deal_id", H.STAGE_KEY, "change_time", "user_id")
    rows = changes.unionByName(H.stage_sentinels(batch, changes, run_ts))
    report = upsert_table(spark, f"{root}/{HISTORY}", rows, ["deal_id", H.STAGE_KEY], dedupe=False, flow="stage_history",
                          batch_id=run_id)
    kept = F.col(H.STAGE_KEY).isNotNull()
    n = summary.agg(F.count_if(kept).alias("rows"), F.sum(F.when(~kept, F.col("n"))).alias("rejected")).first()
    rejected = n["rejected"] or 0
    if rejected:
        (summary.where(~kept).select("deal_id", "raw_value", "change_time", "n").write.mode("overwrite")
         .parquet(f"{root}/_history_rejects/run_id={run_id}"))
    upsert_table(spark, done, keys.withColumn("run_id", F.lit(run_id)), ["deal_id"], dedupe=False)
    log = (run_id, n_deals, n["rows"], report["rows"] - n["rows"], rejected)
    spark.createDataFrame([log], HISTORY_LOG).drop("run_id").write.mode("overwrite").parquet(f"{root}/_history_log/run_id={run_id}")
    return dict(zip(("run_id", "deals", "change_rows", "deals_without_changes", "rejected_changes"), log))


def stream_backfill(spark: SparkSession, landing: str, schema: StructType | str,
                    handle_batch: Callable[[DataFrame, int], None], checkpoint: str, *,
                    files_per_batch: int = 1, fmt: str = "json") -> int:
    """Drain ``landing`` with ``Trigger.AvailableNow`` in bounded batches.

    ``handle_batch(df, batch_id)`` must be idempotent per ``batch_id`` (an
    upsert is).  Returns the number of micro-batches processed in this run.
    """
    stream = (spark.readStream.format(fmt).schema(schema)
              .option("maxFilesPerTrigger", files_per_batch).load(landing))
    seen = []

    def _each(df: DataFrame, batch_id: int) -> None:
        seen.append(batch_id)
        handle_batch(df, batch_id)

    q = (stream.writeStream.foreachBatch(_each)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return len(seen)


def drain_paged_stream(spark: SparkSession, fmt: str, options: dict,
                       handle_batch: Callable[[DataFrame, int], None], checkpoint: str,
                       state: tuple[str, str] | None = None) -> int:
    """C4 C5 T3 for page sources: runs of at most ``maxRowsPerBatch`` records until one finds no more.

    A run is a micro-batch of its own offsets, upsert and checkpoint entry.  The runs share
    one stream, which is stopped when it finds no more: Spark gives a Python source a single
    batch for each ``AvailableNow`` stream, and starting one (a Python process that plans the
    source, the checkpoint's recovery) takes longer than the rows of a run.

    The cursor is kept in the sync-state table (``state``: its root and the entity's name;
    beside the checkpoint by default), so a flow that was stopped goes on where it was, and
    a finished one takes up what has come since.  The state is saved after the batch, beside
    the next one and before that is committed: if it is lost, the next flow names the same
    end again, which the checkpoint knows.  Returns the number of runs that brought rows.
    """
    from dealwise.sources.paged import OffsetPagesStream
    root, entity = state or (f"{checkpoint}_state", "pages")
    cursor = get_sync_state(spark, root, entity)[0] or int(options.get("start", 0))
    runs = 0
    with ThreadPoolExecutor(1) as beside:
        while (end := OffsetPagesStream({**options, "start": cursor}).available()) != cursor:
            query, handled = Future(), []  # a first batch may come before the stream is at hand

            def _each(df: DataFrame, batch_id: int) -> None:
                saved = None
                if handled:  # the batch before is committed by now
                    saved = beside.submit(save_sync_state, spark, root, entity, _reached(query.result()), False)
                try:
                    handle_batch(df, batch_id)
                finally:
                    if saved:
                        saved.result()
                handled.append(batch_id)

            query.set_result(spark.readStream.format(fmt).options(**{**options, "start": str(cursor)}).load()
                             .writeStream.foreachBatch(_each).option("checkpointLocation", checkpoint)
                             .trigger(processingTime="0 seconds").start())
            try:
                query.result().processAllAvailable()
            finally:
                query.result().stop()
            # without a batch, only the state was behind: the checkpoint was at this end
            cursor = _reached(query.result()) if handled else end
            runs += len(handled)
            save_sync_state(spark, root, entity, cursor, False)
    save_sync_state(spark, root, entity, cursor, True)
    return runs


def _reached(query: StreamingQuery) -> int:
    """The end of the stream's last committed batch."""
    return json.loads(query.lastProgress.json)["sources"][0]["endOffset"]["start"]
