"""Stage history, pending work and de-duplication queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealwise.operators import history as H
from dealwise.operators.dedupe import keep_first
from dealwise.operators.joins import fits_broadcast
from dealwise.operators.pending import newest_first, pending_keys, whole_page_budget
from dealwise.plans import crm_views as v
from dealwise.plans.registry import register
from dealwise.session import stored
from dealwise.sources.tables import read_table

# Fixed values (reference limits): deals per history run.
MAX_DEALS_PER_RUN = 10_000

CHANGES_SQL = """
e AS (SELECT event_id, ts, user_id AS deal_id, event_type,
             CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events),
c AS (SELECT deal_id, k AS stage_id, ts AS change_time, event_id % 50 AS user_id FROM e
      WHERE event_type <> 'view'
        AND NOT (event_type = 'signup' AND event_id % 2 = 0)
        AND NOT (event_id % 3 <> 1 AND k = 0)),
h AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY deal_id, stage_id
                                                 ORDER BY change_time DESC, user_id DESC) = 1)"""


def history(spark: SparkSession, base: str) -> DataFrame:
    items = H.change_items(v.change_log_pages(spark, base))
    return H.latest_per_stage(H.stage_changes(items))


@register("stage_history", f"WITH {CHANGES_SQL} SELECT * FROM h")
def q_stage_history(spark: SparkSession, base: str) -> DataFrame:
    """Change-log pages -> stage changes -> latest per (deal, stage)."""
    return history(spark, base)


@register("stage_sentinel", f"""
WITH {CHANGES_SQL}
SELECT o_orderkey AS deal_id, o_orderkey % 25 AS stage_id, o_orderdate AS change_time,
       NULL::BIGINT AS user_id
FROM orders WHERE o_orderkey % 13 <> 0 AND o_orderkey NOT IN (SELECT deal_id FROM c)
""")
def q_stage_sentinel(spark: SparkSession, base: str) -> DataFrame:
    """A deal without stage changes gets its current stage at add_time."""
    items = H.change_items(v.change_log_pages(spark, base))
    return H.stage_sentinels(v.stage_deals(spark, base), H.stage_changes(items))


def known_stage_ids(spark: SparkSession, base: str) -> list[int]:
    """Stage ids from the stage dimension (metadata-sized, bound checked)."""
    n = read_table(spark, base, "nation").select("n_nationkey")
    if not fits_broadcast(n, 10_000):
        raise ValueError("more than 10,000 stages")
    return sorted(int(r[0]) for r in n.collect())


STAGE_PIVOT_SQL = (f"WITH {CHANGES_SQL} SELECT deal_id, "
                   + ", ".join(f"max(CASE WHEN stage_id = {s} THEN change_time END) AS movido_para_etapa_{s}"
                               for s in range(25))
                   + " FROM h GROUP BY deal_id")


@register("stage_pivot", STAGE_PIVOT_SQL)
def q_stage_pivot(spark: SparkSession, base: str) -> DataFrame:
    """Arrival time per known stage, one column per stage."""
    return H.stage_arrivals(history(spark, base), known_stage_ids(spark, base))


PENDING_SQL = f"""
WITH {CHANGES_SQL},
d AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderkey % 25 END AS stage_id,
             o_orderdate AS add_time FROM orders),
p AS (SELECT * FROM d WHERE id NOT IN (SELECT DISTINCT deal_id FROM h))"""


@register("pending_topn", PENDING_SQL + f"""
SELECT * FROM p ORDER BY add_time DESC NULLS LAST, id DESC LIMIT {MAX_DEALS_PER_RUN}
""")
def q_pending_topn(spark: SparkSession, base: str) -> DataFrame:
    """Deals without history, newest first, one run's budget."""
    pend = pending_keys(v.stage_deals(spark, base), history(spark, base), "id", "deal_id")
    return newest_first(pend, MAX_DEALS_PER_RUN, [F.col("add_time")], ["id"])


@register("pending_gauge", PENDING_SQL + "\nSELECT count(*) AS pending FROM p")
def q_pending_gauge(spark: SparkSession, base: str) -> DataFrame:
    """A10: how many deals still wait for history (before the budget)."""
    pend = pending_keys(v.stage_deals(spark, base), history(spark, base), "id", "deal_id")
    return pend.agg(F.count(F.lit(1)).alias("pending"))


@register("pending_loop", f"""
WITH {CHANGES_SQL},
d AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderkey % 25 END AS stage_id,
             o_orderdate AS add_time FROM orders),
b AS (SELECT * FROM d ORDER BY add_time DESC NULLS LAST, id DESC LIMIT {MAX_DEALS_PER_RUN})
SELECT h.* FROM h WHERE h.deal_id IN (SELECT id FROM b)
UNION ALL
SELECT id, stage_id, add_time, NULL::BIGINT FROM b
WHERE stage_id IS NOT NULL AND id NOT IN (SELECT deal_id FROM c)
""")
def q_pending_loop(spark: SparkSession, base: str) -> DataFrame:
    """One history run: pending batch -> its change logs -> changes ∪ sentinels."""
    from dealwise.streaming.backfill import history_run
    empty = spark.createDataFrame([], "deal_id bigint, stage_id bigint, change_time timestamp, user_id bigint")
    return history_run(v.stage_deals(spark, base), v.change_log_pages(spark, base), empty,
                       MAX_DEALS_PER_RUN)


#: Runs that the loop takes, whatever the number of deals.
LOOP_RUNS = 4


@register("history_loop_full", """
WITH e AS (SELECT event_id, ts, user_id AS deal_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events),
s AS (SELECT deal_id, k AS stage_id, ts AS change_time, event_id % 50 AS user_id, event_id % 11 = 5 AS junk FROM e
      WHERE event_type <> 'view' AND (event_id % 11 = 5 OR NOT (event_type = 'signup' AND event_id % 2 = 0)
                                      AND NOT (event_id % 3 <> 1 AND k = 0))),
d AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderkey % 25 END AS stage_id,
             o_orderdate AS add_time FROM orders),
c AS (SELECT deal_id, stage_id, change_time, user_id FROM s WHERE NOT junk AND deal_id IN (SELECT id FROM d)),
h AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY deal_id, stage_id ORDER BY change_time DESC, user_id DESC) = 1),
w AS (SELECT * FROM h UNION ALL
      SELECT id, stage_id, add_time, NULL::BIGINT FROM d WHERE stage_id IS NOT NULL AND id NOT IN (SELECT deal_id FROM c))
SELECT w.*, (SELECT count(*) FROM d) AS deals_done, (SELECT count(*) FROM s WHERE junk AND deal_id IN (SELECT id FROM d))
         AS rejected, CAST(0 AS BIGINT) AS pending
FROM w
""")
def q_history_loop_full(spark: SparkSession, base: str) -> DataFrame:
    """Budgeted history runs until no deal is left (those without a stage too)."""
    import uuid
    from dealwise.operators.segments import read_table_at
    from dealwise.session import scratch_path
    from dealwise.streaming.backfill import HISTORY, HISTORY_DONE, history_flow
    root = scratch_path(spark, f"history/{uuid.uuid4().hex}")
    deals = v.stage_deals(spark, base)
    pages = stored(v.change_log_pages(spark, base, junk=F.col("event_id") % 11 == 5), "change-log")
    budget = max(1, -(-deals.count() // LOOP_RUNS))
    run = 0
    while history_flow(spark, deals, pages, root, budget, f"run-{run}") is not None:
        run += 1
    done = read_table_at(spark, f"{root}/{HISTORY_DONE}")
    log = spark.read.parquet(f"{root}/_history_log").agg(F.sum("deals").alias("deals"), F.sum("rejected_changes").alias("rejected")).first()
    pending = pending_keys(deals, done, "id", "deal_id").count()
    return read_table_at(spark, f"{root}/{HISTORY}").select(
        "deal_id", "stage_id", "change_time", "user_id", F.lit(log["deals"]).cast("bigint").alias("deals_done"),
        F.lit(log["rejected"]).cast("bigint").alias("rejected"), F.lit(pending).cast("bigint").alias("pending"))


LINE_COLS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
             "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@register("dedupe_first", """
SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
           l_returnflag, l_linestatus) = 1
""")
def q_dedupe_first(spark: SparkSession, base: str) -> DataFrame:
    """First row per key by a declared order (aggregate, map-side combined)."""
    li = read_table(spark, base, "lineitem").select(*LINE_COLS)
    return keep_first(li, ["l_orderkey", "l_linenumber"], [F.col("l_shipdate")])


ROW_BUDGET = 25_000
LINES_PER_PAGE_KEY = 125  # ~4 lines per order -> ~500 activities per page


@register("row_budget", f"""
WITH p AS (SELECT l_orderkey // {LINES_PER_PAGE_KEY} AS page, count(*) AS n_rows FROM lineitem GROUP BY 1),
q AS (SELECT page, coalesce(sum(n_rows) OVER (ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING
                                               AND 1 PRECEDING), 0) AS rows_before FROM p)
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, q.page, CAST(q.rows_before AS BIGINT) AS rows_before
FROM lineitem l JOIN q ON q.page = l.l_orderkey // {LINES_PER_PAGE_KEY}
WHERE q.rows_before < {ROW_BUDGET}
""")
def q_row_budget(spark: SparkSession, base: str) -> DataFrame:
    """Whole pages of activities while the run's row budget lasts.

    The page counts are stored once.  What is taken is a prefix of the pages, so the rows
    are read by a bound on the key that reaches the scan.
    """
    li = read_table(spark, base, "lineitem")
    page = F.floor(F.col("l_orderkey") / LINES_PER_PAGE_KEY)
    pages = stored(li.groupBy(page.alias("page")).agg(F.count(F.lit(1)).alias("n_rows")), "row-budget")
    chosen = stored(whole_page_budget(pages, ROW_BUDGET).select("page", "rows_before"), "row-budget")
    last = chosen.agg(F.max("page")).first()[0]
    rows = li.where(F.col("l_orderkey") < ((last if last is not None else -1) + 1) * LINES_PER_PAGE_KEY)
    rows = rows.select("l_orderkey", "l_linenumber", "l_partkey", page.alias("page"))
    # a page holds a row at least, so the budget bounds the pages
    return rows.join(F.broadcast(chosen.limit(ROW_BUDGET)), "page").select(
        "l_orderkey", "l_linenumber", "l_partkey", "page", "rows_before")


@register("detail_fetch_history", f"WITH {CHANGES_SQL} SELECT * FROM h")
def q_detail_fetch_history(spark: SparkSession, base: str) -> DataFrame:
    """S8 live path: every deal's change log fetched page by page through a
    fetcher in parallel tasks (mapInArrow), then B4 + W1 in Spark."""
    import uuid
    from dealwise.session import scratch_path, ship_package
    from dealwise.sources.details import detail_items, fetch_details
    from dealwise.sources.saved_pages import details, write_details
    ship_package(spark)
    root = scratch_path(spark, f"details/{uuid.uuid4().hex}")
    write_details(v.change_log_pages(spark, base), root)   # stands in for the API
    deals = read_table(spark, base, "events").groupBy(F.col("user_id").alias("deal_id")).agg(F.count("*").alias("n_items"))
    pages = fetch_details(deals, "deal_id", lambda: details(root), partitions=16, items_col="n_items")
    return H.latest_per_stage(H.stage_changes(H.change_items(detail_items(pages))))


ARRIVALS_APPLY_SQL = (f"WITH {CHANGES_SQL}, piv AS (SELECT deal_id, "
                      + ", ".join(f"max(CASE WHEN stage_id = {s} THEN change_time END) AS movido_para_etapa_{s}"
                                  for s in range(25))
                      + " FROM h GROUP BY deal_id) SELECT o.o_orderkey AS id, "
                      + "CASE WHEN o.o_orderkey % 13 = 0 THEN NULL ELSE o.o_orderkey % 25 END AS stage_id, "
                      + ", ".join(f"coalesce(piv.movido_para_etapa_{s}, CASE WHEN o.o_orderkey % 25 = {s} "
                                  f"THEN o.o_orderdate END) AS movido_para_etapa_{s}" for s in range(25))
                      + " FROM orders o LEFT JOIN piv ON piv.deal_id = o.o_orderkey")


@register("stage_arrivals_apply", ARRIVALS_APPLY_SQL)
def q_stage_arrivals_apply(spark: SparkSession, base: str) -> DataFrame:
    """B6 + K15: per-stage arrival times pivoted from the history and applied to the
    deals table in one join (existing values kept where a deal never reached a stage)."""
    from dealwise.operators.upsert import update_from_frame
    stages = known_stage_ids(spark, base)
    deals = v.stage_deals(spark, base)
    # the table already knows the arrival at the deal's current stage (its add_time)
    target = deals.select("id", "stage_id", *[
        F.when(F.col("id") % 25 == s, F.col("add_time")).alias(f"movido_para_etapa_{s}") for s in stages])
    arrivals = H.stage_arrivals(history(spark, base), stages).withColumnRenamed("deal_id", "id")
    return update_from_frame(target, arrivals, ["id"], unique=True)  # pivot: one row per deal
