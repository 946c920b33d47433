"""Run statistics, incremental state and small column-function queries.

(A3-A7, A9, X19, X20, X22, X25, X26, C2, C3, P2, P4, J11.)
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealwise.functions.parse import normalize_temporal
from dealwise.functions.text import endpoint_of, fingerprint, strip_nul
from dealwise.operators import runlog as R
from dealwise.operators.evolve import rename_duplicates
from dealwise.operators import history as H
from dealwise.plans import crm_views as v
from dealwise.plans.q_history import CHANGES_SQL
from dealwise.plans.registry import register
from dealwise.session import stored
from dealwise.sources.routes import routes_frame
from dealwise.sources.tables import read_table
from dealwise.streaming import state as S

ENDPOINT_SQL = ("regexp_extract(regexp_extract({u}, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)?([^?#]*)', 1),"
                " '^/*([^/]+)', 1)")


@register("endpoint_norm", f"SELECT page_id, {ENDPOINT_SQL.format(u='url')} AS endpoint FROM pages")
def q_endpoint_norm(spark: SparkSession, base: str) -> DataFrame:
    """First path segment of each page URL."""
    p = read_table(spark, base, "pages")
    return p.select("page_id", endpoint_of(F.col("url")).alias("endpoint"))


def _calls(spark: SparkSession, base: str) -> DataFrame:
    """Events as an API call log: the event type picks the route called."""
    e = read_table(spark, base, "events")
    t = F.col("event_type")
    ep = (F.when(t == "signup", "/users").when(t == "click", "/deals")
           .when(t == "view", "/persons/detail").when(t == "purchase", "/deals/detail/flow")
           .otherwise("/activities"))
    return e.select(ep.alias("endpoint"), (F.lit(1) + F.col("event_id") % 3).alias("calls"),
                    (F.col("value") < 20).alias("hit"), "event_id")


CALLS_SQL = """
calls AS (SELECT CASE event_type WHEN 'signup' THEN '/users' WHEN 'click' THEN '/deals'
                   WHEN 'view' THEN '/persons/detail' WHEN 'purchase' THEN '/deals/detail/flow'
                   ELSE '/activities' END AS endpoint,
                 1 + event_id % 3 AS calls, value < 20 AS hit FROM events),
costs(endpoint, cost) AS (VALUES ('/users', 20), ('/deals', 10), ('/persons/detail', 1),
                                 ('/deals/detail/flow', 40), ('/activities', 10))"""


@register("usage_cost", f"""
WITH {CALLS_SQL}
SELECT split_part(ltrim(c.endpoint, '/'), '/', 1) AS endpoint,
       CAST(sum(c.calls) AS BIGINT) AS calls, CAST(sum(k.cost * c.calls) AS BIGINT) AS cost_total
FROM calls c LEFT JOIN costs k ON k.endpoint = c.endpoint GROUP BY 1
""")
def q_usage_cost(spark: SparkSession, base: str) -> DataFrame:
    """A6 (with S5): token cost per normalised endpoint."""
    return R.usage_cost(_calls(spark, base), routes_frame(spark))


@register("cache_ratio", f"""
WITH {CALLS_SQL}
SELECT split_part(ltrim(endpoint, '/'), '/', 1) AS entity, count(*) AS requests,
       count(*) FILTER (WHERE hit) AS hits,
       count(*) FILTER (WHERE hit) / count(*) AS hit_ratio
FROM calls GROUP BY 1
""")
def q_cache_ratio(spark: SparkSession, base: str) -> DataFrame:
    """Cache hit ratio per entity."""
    c = _calls(spark, base).withColumn("entity", endpoint_of(F.col("endpoint")))
    return R.cache_ratio(c)


def _runs(spark: SparkSession, base: str) -> DataFrame:
    """Events as flow runs: one run per event, the event type is the flow."""
    e = read_table(spark, base, "events")
    i = F.col("event_id")
    k = F.try_variant_get(F.parse_json("props"), "$.k", "bigint")
    return e.select(F.col("event_type").alias("flow"), (i % 17 == 0).alias("failed"),
                    (F.col("user_id") * 10).alias("rows"),
                    (i % 5 == 0).cast("int").alias("empty_batches"),
                    (k % 7).alias("invalid_rows"),
                    (F.col("value") * 100).alias("duration_s"),
                    "user_id", "value")


@register("run_log", """
SELECT event_type AS flow, count(*) AS runs, count(*) FILTER (WHERE event_id % 17 = 0) AS failures,
       CAST(sum(user_id * 10) AS BIGINT) AS rows_processed,
       CAST(sum(CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS empty_batches,
       CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT) % 7) AS BIGINT) AS invalid_rows
FROM events GROUP BY 1
""")
def q_run_log(spark: SparkSession, base: str) -> DataFrame:
    """A3: per-flow counters from the run log."""
    return R.flow_counters(_runs(spark, base))


@register("throughput", """
SELECT event_id, user_id * 10 / nullif(value, 0) AS rows_per_sec FROM events
""")
def q_throughput(spark: SparkSession, base: str) -> DataFrame:
    """A4: rows per second of each batch."""
    e = read_table(spark, base, "events")
    return e.select("event_id", R.throughput(F.col("user_id") * 10, F.col("value")).alias("rows_per_sec"))


HIST_SQL = ", ".join(f"count(*) FILTER (WHERE value * 100 <= {e}) AS le_{e}" for e in R.RUN_DURATION_EDGES)


@register("duration_histogram", f"""
SELECT event_type AS flow, {HIST_SQL}, count(value) AS le_inf FROM events GROUP BY 1
""")
def q_duration_histogram(spark: SparkSession, base: str) -> DataFrame:
    """A5: cumulative run-duration buckets per flow (edges 10 s … 10,800 s)."""
    return R.bucket_histogram(_runs(spark, base), "duration_s", R.RUN_DURATION_EDGES, by=["flow"])


@register("row_accounting", f"""
WITH {CHANGES_SQL},
d AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderkey % 25 END AS stage_id
      FROM orders)
SELECT (SELECT count(*) FROM h) AS change_rows,
       (SELECT count(*) FROM d WHERE stage_id IS NOT NULL AND id NOT IN (SELECT deal_id FROM c))
         AS deals_without_changes
""")
def q_row_accounting(spark: SparkSession, base: str) -> DataFrame:
    """Rows written by one full history pass and deals without changes."""
    summary = stored(H.change_summary(H.change_items(v.change_log_pages(spark, base))), "history-changes")
    changes = summary.where(F.col(H.STAGE_KEY).isNotNull()).select("deal_id", H.STAGE_KEY, "change_time", "user_id")
    written = (changes.withColumn("is_sentinel", F.lit(False))
               .unionByName(H.stage_sentinels(v.stage_deals(spark, base), changes).withColumn("is_sentinel", F.lit(True))))
    return R.row_accounting(written)


# ------------------------------------------------------------ incremental
LAST_SUCCESS = dt.datetime(2024, 1, 15, 0, 0, 5, tzinfo=dt.timezone.utc)


@register("incremental_filter", """
SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'
""")
def q_incremental_filter(spark: SparkSession, base: str) -> DataFrame:
    """since = last success − 5 s, pushed to the Parquet scan."""
    since, full = S.compute_updated_since(LAST_SUCCESS)
    e = read_table(spark, base, "events").select("event_id", "ts")
    return S.incremental(e, "ts", None if full else since)


DEP_SINCE = dt.datetime(2001, 7, 15, tzinfo=dt.timezone.utc)


@register("dep_freshness", """
SELECT 'orders' AS dep, EXISTS (SELECT 1 FROM orders WHERE o_orderdate >= TIMESTAMP '2001-07-15') AS changed
UNION ALL SELECT 'lineitem', EXISTS (SELECT 1 FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-07-15')
UNION ALL SELECT 'events', EXISTS (SELECT 1 FROM events WHERE ts >= TIMESTAMP '2001-07-15')
UNION ALL SELECT 'customer', false
""")
def q_dep_freshness(spark: SparkSession, base: str) -> DataFrame:
    """Which dependencies changed since T (one job, first match per table)."""
    deps = {
        "orders": (read_table(spark, base, "orders"), ["o_orderdate", "update_time"]),
        "lineitem": (read_table(spark, base, "lineitem"), ["l_shipdate", "l_commitdate"]),
        "events": (read_table(spark, base, "events"), ["ts"]),
        "customer": (read_table(spark, base, "customer"), ["add_time", "update_time"]),
    }
    return S.dependency_changes(deps, DEP_SINCE)


@register("sync_mode", """
WITH runs AS (SELECT event_type AS flow, max(ts) FILTER (WHERE event_id % 17 <> 0) AS last_ok
              FROM events GROUP BY 1),
v AS (SELECT flow, last_ok, CASE WHEN flow IN ('signup', 'purchase') THEN 'v1' ELSE 'v2' END AS version,
             EXISTS (SELECT 1 FROM events e WHERE e.event_type = 'error' AND e.ts >= runs.last_ok) AS deps_changed
      FROM runs)
SELECT flow, version, deps_changed,
       CASE WHEN last_ok IS NULL OR version = 'v1' THEN 'FULL'
            WHEN deps_changed THEN 'INCREMENTAL' ELSE 'SKIP' END AS mode,
       CASE WHEN last_ok IS NOT NULL AND version <> 'v1' AND deps_changed
            THEN last_ok - INTERVAL 5 SECOND END AS since
FROM v
""")
def q_sync_mode(spark: SparkSession, base: str) -> DataFrame:
    """Per-flow FULL / INCREMENTAL / SKIP from watermarks and dependency changes."""
    e = read_table(spark, base, "events")
    runs = e.groupBy(F.col("event_type").alias("flow")).agg(
        F.max(F.when(F.col("event_id") % 17 != 0, F.col("ts"))).alias("last_ok"))
    # dependency freshness: the newest 'error' event, one scalar from an aggregate
    dep_ts = e.filter(F.col("event_type") == "error").agg(F.max("ts")).first()[0]
    j = runs
    version = F.when(F.col("flow").isin("signup", "purchase"), F.lit("v1")).otherwise(F.lit("v2"))
    dep = F.lit(dep_ts).cast("timestamp") if dep_ts is not None else F.lit(None).cast("timestamp")
    changed = F.coalesce(dep >= F.col("last_ok"), F.lit(False))
    mode = S.sync_mode_expr(F.col("last_ok"), version, changed)
    return j.select("flow", version.alias("version"), changed.alias("deps_changed"),
                    mode.alias("mode"),
                    F.when(mode == S.INCREMENTAL, S.since_expr(F.col("last_ok"))).alias("since"))


# ------------------------------------------------ small column functions
@register("fingerprint", """
SELECT c_custkey, md5(to_json({'c_custkey': c_custkey, 'c_mktsegment': c_mktsegment,
                               'c_name': c_name, 'c_nationkey': c_nationkey})) AS fingerprint
FROM customer
""")
def q_fingerprint(spark: SparkSession, base: str) -> DataFrame:
    """md5 of the record's canonical (key-sorted) JSON."""
    c = read_table(spark, base, "customer")
    return c.select("c_custkey", fingerprint(["c_name", "c_nationkey", "c_custkey", "c_mktsegment"])
                    .alias("fingerprint"))


@register("column_hygiene", """
SELECT n.n_nationkey AS id, n.n_name AS name, r.r_name AS name__dup1,
       n.n_name || 'x' AS clean_text,
       CAST(strftime(n.n_nationkey * INTERVAL 1 DAY + TIMESTAMP '2024-01-01 10:30:00', '%Y-%m-%d') AS DATE)
         AS as_date,
       n.n_nationkey * INTERVAL 1 DAY + TIMESTAMP '2024-01-01 10:30:00' AS as_ts
FROM nation n JOIN region r ON r.r_regionkey = n.n_regionkey
""")
def q_column_hygiene(spark: SparkSession, base: str) -> DataFrame:
    """X19 duplicate names kept, X20 NUL stripped, X22 DATE/TIMESTAMP normalisation."""
    n = read_table(spark, base, "nation")
    r = read_table(spark, base, "region")
    j = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
    text_ts = F.date_format(F.timestamp_add("DAY", F.col("n_nationkey"),
                                            F.lit("2024-01-01 10:30:00").cast("timestamp")),
                            "yyyy-MM-dd HH:mm:ss")
    wide = j.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"),
                    F.col("r_name").alias("name"),
                    strip_nul(F.concat(F.col("n_name"), F.lit("\u0000"), F.lit("x"))).alias("clean_text"),
                    normalize_temporal(text_ts, "date").alias("as_date"),
                    normalize_temporal(text_ts, "timestamp").alias("as_ts"))
    return rename_duplicates(wide)
