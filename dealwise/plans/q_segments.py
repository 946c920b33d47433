"""Segment-table queries.

The table is built from ``orders``; the batches are the line items by line number, keys
shifted so that each batch updates some rows and adds others.  Whole tables throughout.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealwise.operators import segments as G
from dealwise.plans import q_sync as QS
from dealwise.plans.q_tables import TARGET_SQL, _deal_target, _people
from dealwise.plans.registry import register
from dealwise.plans.sync import sync_entity
from dealwise.session import scratch_path
from dealwise.sources.pages import build_page_landing, scan_pages
from dealwise.sources.tables import read_table
from dealwise.streaming.backfill import stream_backfill

#: Columns of the batches by line number: 3 brings no value, 5 no status.
PARTIAL = {3: ("id", "status", "update_time"), 5: ("id", "value", "update_time")}
#: The batch that only inserts.
INSERTS = 6
BATCHES = range(1, 8)


def _path(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"segments/{name}-{uuid.uuid4().hex}")


def _batch(spark: SparkSession, base: str, k: int) -> DataFrame:
    li = read_table(spark, base, "lineitem").where(F.col("l_linenumber") == k)
    rows = li.select((F.col("l_orderkey") + 5000).alias("id"), F.col("l_linestatus").alias("status"),
                     F.col("l_extendedprice").alias("value"), F.col("l_shipdate").alias("update_time"))
    return rows.select(*PARTIAL.get(k, rows.columns))


def _apply(spark: SparkSession, base: str, name: str, compact: bool) -> str:
    path = _path(spark, name)
    G.create_table(spark, path, _deal_target(spark, base), ["id"], buckets=16)
    for k in BATCHES:
        G.upsert_table(spark, path, _batch(spark, base, k), ["id"], insert_only=k == INSERTS, compact=compact)
    return path


def _last(column: str) -> str:
    """SQL: the latest batch that has the key and the column, else the table's value."""
    have = [k for k in reversed(BATCHES) if k != INSERTS and column in PARTIAL.get(k, (column,))]
    later = [k for k in have if k > INSERTS]
    new = f"t.id IS NULL AND s{INSERTS}.id IS NOT NULL AND " + " AND ".join(f"s{k}.id IS NULL" for k in BATCHES if k < INSERTS)
    return ("CASE " + " ".join(f"WHEN s{k}.id IS NOT NULL THEN s{k}.{column}" for k in later)
            + f" WHEN {new} THEN s{INSERTS}.{column} "
            + " ".join(f"WHEN s{k}.id IS NOT NULL THEN s{k}.{column}" for k in have if k < INSERTS)
            + f" ELSE t.{column} END AS {column}")


def _batch_sql(k: int) -> str:
    cols = PARTIAL.get(k, ("id", "status", "value", "update_time"))
    order = ", ".join(f"{c} DESC" for c in ("update_time", "status", "value") if c in cols)
    return (f"s{k} AS (SELECT {', '.join(cols)} FROM (SELECT l_orderkey + 5000 AS id, l_linestatus AS status, "
            f"l_extendedprice AS value, l_shipdate AS update_time FROM lineitem WHERE l_linenumber = {k}) "
            f"QUALIFY row_number() OVER (PARTITION BY id ORDER BY {order}) = 1)")


DELTA_SQL = (f"WITH {TARGET_SQL}, " + ", ".join(_batch_sql(k) for k in BATCHES)
             + ", ids AS (SELECT id FROM t " + " ".join(f"UNION SELECT id FROM s{k}" for k in BATCHES) + ") "
             + f"SELECT ids.id, {_last('status')}, {_last('value')}, {_last('update_time')}, t.priority FROM ids "
             + "LEFT JOIN t ON t.id = ids.id " + " ".join(f"LEFT JOIN s{k} ON s{k}.id = ids.id" for k in BATCHES))


@register("upsert_delta", DELTA_SQL)
def q_upsert_delta(spark: SparkSession, base: str) -> DataFrame:
    """K1 K4 K5: seven batches as deltas, with missing columns and an insert-only one, folded on read."""
    return G.read_table_at(spark, _apply(spark, base, "delta", compact=False))


@register("upsert_compacted", DELTA_SQL)
def q_upsert_compacted(spark: SparkSession, base: str) -> DataFrame:
    """K1 K7: the same batches, merged by size tiers on the way and fully at the end, old versions removed."""
    path = _apply(spark, base, "compacted", compact=True)
    G.compact_table(spark, path, full=True)
    G.vacuum_table(spark, path, keep=1)
    return G.read_table_at(spark, path)


@register("snapshot_read", f"""
WITH {TARGET_SQL},
s AS (SELECT l_orderkey + 5000 AS id FROM lineitem WHERE l_linenumber = 1)
SELECT 'before' AS version, count(*) AS n, count(DISTINCT id) AS ids FROM t
UNION ALL
SELECT 'after', count(*), count(DISTINCT id) FROM (SELECT id FROM t UNION SELECT id FROM s)
""")
def q_snapshot_read(spark: SparkSession, base: str) -> DataFrame:
    """K6: a version read after later commits and a compaction is what it was."""
    path = _path(spark, "snapshot")
    G.create_table(spark, path, _deal_target(spark, base), ["id"], buckets=8)
    first = G.read_manifest(spark, path).version
    G.upsert_table(spark, path, _batch(spark, base, 1), ["id"])
    G.compact_table(spark, path, full=True)
    both = [G.read_table_at(spark, path, v).agg(F.count("*").alias("n"), F.countDistinct("id").alias("ids"))
            .select(F.lit(name).alias("version"), "n", "ids") for name, v in (("before", first), ("after", None))]
    return both[0].unionByName(both[1])


@register("evolve_type_lazy", """
WITH t AS (SELECT c_custkey AS id, c_name AS name, CAST(c_nationkey AS VARCHAR) AS nationkey FROM customer),
s AS (SELECT s_suppkey * 13 AS id, 'N' || CAST(s_nationkey AS VARCHAR) AS nationkey, s_acctbal AS acctbal FROM supplier)
SELECT coalesce(t.id, s.id) AS id, t.name,
       CASE WHEN s.id IS NOT NULL THEN s.nationkey ELSE t.nationkey END AS nationkey, s.acctbal,
       CAST(0 AS BIGINT) AS rewritten_bytes
FROM t FULL OUTER JOIN s ON t.id = s.id
""")
def q_evolve_type_lazy(spark: SparkSession, base: str) -> DataFrame:
    """INT meets text and a column comes in; segments written before stay as they are."""
    path = _path(spark, "types")
    G.create_table(spark, path, _people(spark, base), ["id"], buckets=8)
    before = G.read_manifest(spark, path).segments
    s = read_table(spark, base, "supplier").select(
        (F.col("s_suppkey") * 13).alias("id"), F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("nationkey"),
        F.col("s_acctbal").alias("acctbal"))
    G.upsert_table(spark, path, s, ["id"])
    after = G.read_manifest(spark, path).segments
    gone = [g for g in before if g not in after]
    return G.read_table_at(spark, path).withColumn("rewritten_bytes", F.lit(sum(g.bytes for g in gone)).cast("bigint"))


# ------------------------------------------------------------------ batch ledger

JUNK = 97  # line items whose order is divisible by this come without a usable id


@register("run_log_replay", f"""
WITH a AS (SELECT l_orderkey * 8 + l_linenumber AS id, l_orderkey % {JUNK} = 0 AS junk FROM lineitem)
SELECT 'records' AS what, count(*) AS n FROM a
UNION ALL SELECT 'invalid', count(*) FILTER (junk) FROM a
UNION ALL SELECT 'rejects', count(*) FILTER (junk) FROM a
UNION ALL SELECT 'table rows', count(DISTINCT id) FILTER (NOT junk) FROM a
UNION ALL SELECT 'batches not replayed', 0
""")
def q_run_log_replay(spark: SparkSession, base: str) -> DataFrame:
    """Every micro-batch comes twice; rows, rejects and the run log count it once."""
    root = _path(spark, "replay")
    raw = QS.raw_activities(spark, base).withColumn(
        "id", F.when(F.col("dealId") % JUNK == 0, F.concat(F.lit("no. "), F.col("id"))).otherwise(F.col("id").cast("string")))
    pages = build_page_landing(raw.withColumn("n", F.col("dealId")), "n", 500)
    pages.select("value").repartition(8).write.mode("overwrite").text(f"{root}/landing/drop1")
    batches, replays = [], []

    def handle(batch: DataFrame, batch_id: int) -> None:
        batches.append(batch_id)
        for again in (False, True):
            report = sync_entity(batch.sparkSession, scan_pages(batch, "value"), QS.ACTIVITY, f"{root}/tables",
                                 run_id=f"batch-{batch_id}")
            if again and report.get("replayed"):
                replays.append(batch_id)

    stream_backfill(spark, f"{root}/landing/*", "value string", handle, f"{root}/checkpoint", files_per_batch=4, fmt="text")
    log = spark.read.parquet(f"{root}/tables/_run_log").agg(F.sum("rows").alias("records"), F.sum("invalid_rows").alias("invalid"))
    counts = log.select(F.expr("stack(2, 'records', records, 'invalid', invalid) as (what, n)"))
    rejects = spark.read.parquet(f"{root}/tables/_rejects").agg(F.count("*").alias("n"))
    rows = G.read_table_at(spark, f"{root}/tables/{QS.ACTIVITY.table}").agg(F.count("*").alias("n"))
    return (counts.unionByName(rejects.select(F.lit("rejects").alias("what"), "n"))
            .unionByName(rows.select(F.lit("table rows").alias("what"), "n"))
            .unionByName(spark.range(1).select(F.lit("batches not replayed").alias("what"),
                                                      F.lit(len(batches) - len(replays)).cast("bigint").alias("n"))))


# ------------------------------------------------------------------ freshness

BOUNDS = tuple(dt.datetime(y, m, 1, tzinfo=dt.timezone.utc) for y in (1992, 1995, 1998, 2024) for m in (1, 7))
_BOUND_SQL = ", ".join(f"(TIMESTAMP '{b:%Y-%m-%d %H:%M:%S}')" for b in BOUNDS)


@register("dep_freshness_stats", f"""
WITH b(since) AS (VALUES {_BOUND_SQL}),
d AS (SELECT 'deals' AS dep, max(o_orderdate) AS last FROM orders
      UNION ALL SELECT 'activities', max(l_shipdate) FROM lineitem
      UNION ALL SELECT 'events', max(ts) FROM events)
SELECT dep, since, last >= since AS changed FROM d, b
""")
def q_dep_freshness_stats(spark: SparkSession, base: str) -> DataFrame:
    """What changed since when, from the time ranges that the manifests keep; no table is scanned."""
    frames = {"deals": (_deal_target(spark, base), "update_time"),
              "activities": (read_table(spark, base, "lineitem").select(
                  (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"), F.col("l_shipdate").alias("update_time")), "update_time"),
              "events": (read_table(spark, base, "events").select(F.col("event_id").alias("id"), "ts"), "ts")}
    found = []
    for name, (df, column) in frames.items():
        path = _path(spark, name)
        G.upsert_table(spark, path, df, ["id"], buckets=8)
        found += [(name, b, G.changed_since(spark, path, [column], b)) for b in BOUNDS]
    return spark.createDataFrame(found, "dep string, since timestamp, changed boolean")
