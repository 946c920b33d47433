"""Queries whose input holds what goes wrong: other key types, bucket counts, empty
batches, unusable keys, mixed decimals, unreadable pages, zero dates, unknown keys."""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealwise.operators import evolve as E
from dealwise.operators import upsert as U
from dealwise.operators.bi import activity_rollup, build_bi_fact
from dealwise.operators.validate import FieldRule as R
from dealwise.plans import q_sync as QS
from dealwise.plans.registry import register
from dealwise.plans.sync import EXTRAS, Entity, read_synced, run_all, sync_entity
from dealwise.session import scratch_path
from dealwise.sources.pages import build_page_landing, page_rejects, scan_pages
from dealwise.sources.tables import read_table


def _path(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"safety/{name}-{uuid.uuid4().hex}")


def _orders(spark: SparkSession, base: str) -> DataFrame:
    return read_table(spark, base, "orders").select(
        F.col("o_orderkey").cast("bigint").alias("id"), F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("value"))


def _int_batch(spark: SparkSession, base: str) -> DataFrame:
    """One row per line-item order, with INT ids: some in the table, some new."""
    li = read_table(spark, base, "lineitem").groupBy("l_orderkey").agg(F.max("l_extendedprice").alias("value"))
    return li.select((F.col("l_orderkey") + 5000).cast("int").alias("id"), "value")


MERGED_SQL = """
WITH t AS (SELECT CAST(o_orderkey AS BIGINT) AS id, o_orderstatus AS status, o_totalprice AS value FROM orders),
s AS (SELECT CAST(l_orderkey + 5000 AS BIGINT) AS id, max(l_extendedprice) AS value FROM lineitem GROUP BY 1)
SELECT coalesce(t.id, s.id) AS id, t.status AS status,
       CASE WHEN s.id IS NOT NULL THEN s.value ELSE t.value END AS value
FROM t FULL OUTER JOIN s ON t.id = s.id
"""


@register("upsert_key_types", MERGED_SQL)
def q_upsert_key_types(spark: SparkSession, base: str) -> DataFrame:
    """K1 K7: an INT-keyed batch meets a BIGINT-keyed table and finds its buckets."""
    path = _path(spark, "keys")
    U.create_table(spark, path, _orders(spark, base), ["id"], buckets=8)
    U.upsert_table(spark, path, _int_batch(spark, base), ["id"])
    return U.read_table_at(spark, path)


@register("upsert_rebucket", MERGED_SQL)
def q_upsert_rebucket(spark: SparkSession, base: str) -> DataFrame:
    """K7: laid out anew in more buckets, then upserted by a caller that names yet another count."""
    path = _path(spark, "rebucket")
    U.create_table(spark, path, _orders(spark, base), ["id"], buckets=4)
    U.rebucket_table(spark, path, 12)
    U.upsert_table(spark, path, _int_batch(spark, base), ["id"], buckets=64)
    return U.read_table_at(spark, path)


@register("upsert_empty_first", """
SELECT CAST(o_orderkey AS BIGINT) AS id, o_orderstatus AS status, o_totalprice AS value FROM orders
""")
def q_upsert_empty_first(spark: SparkSession, base: str) -> DataFrame:
    """K6: the first batch is empty, the second is not."""
    path = _path(spark, "empty")
    orders = _orders(spark, base)
    U.upsert_table(spark, path, orders.where("id is null"), ["id"], buckets=8)
    U.upsert_table(spark, path, orders, ["id"])
    return U.read_table_at(spark, path)


@register("upsert_null_key_rejects", """
WITH b AS (SELECT CASE WHEN o_orderkey % 7 = 0 THEN 'id:null' WHEN o_orderkey % 11 = 0 THEN 'id:type' ELSE 'kept' END AS reason
           FROM orders)
SELECT reason, count(*) AS n FROM b GROUP BY reason
""")
def q_upsert_null_key_rejects(spark: SparkSession, base: str) -> DataFrame:
    """K1: NULL and unfitting keys are kept aside, once, though the batch comes twice."""
    path = _path(spark, "nulls")
    orders = _orders(spark, base)
    k = F.col("id")
    key = F.when(k % 7 == 0, F.lit(None)).when(k % 11 == 0, F.concat(F.lit("x"), k)).otherwise(k.cast("string"))
    U.upsert_table(spark, path, orders.limit(0), ["id"], buckets=4)
    for _ in range(2):
        U.upsert_table(spark, path, orders.withColumn("id", key), ["id"], batch_id="b1")
    kept = U.read_table_at(spark, path).select(F.lit("kept").alias("reason"))
    return (kept.unionByName(spark.read.parquet(f"{path}__rejects").select("reason"))
            .groupBy("reason").agg(F.count(F.lit(1)).alias("n")))


@register("evolve_decimal", """
SELECT CAST(o_orderkey AS BIGINT) AS id,
       CAST(CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey AS DECIMAL(18,4)) + 12345678901234.5678
                 ELSE CAST(o_orderkey AS DECIMAL(18,4)) + 0.25 END AS VARCHAR) AS value
FROM orders
""")
def q_evolve_decimal(spark: SparkSession, base: str) -> DataFrame:
    """DECIMAL(18,4) with DECIMAL(10,2) stays exact."""
    o = _orders(spark, base)
    k = F.col("id").cast("decimal(18,4)")
    wide = o.where("id % 2 = 0").select("id", (k + F.lit("12345678901234.5678").cast("decimal(18,4)"))
                                        .cast("decimal(18,4)").alias("value"))
    narrow = o.where("id % 2 = 1").select("id", (F.col("id").cast("decimal(10,2)") + F.lit("0.25").cast("decimal(10,2)"))
                                          .cast("decimal(10,2)").alias("value"))
    return E.union_evolving([narrow, wide]).select("id", F.col("value").cast("string").alias("value"))


@register("corrupt_page_rejects", """
WITH p AS (SELECT CAST(floor(o_orderkey / 50) AS BIGINT) AS page FROM orders)
SELECT CASE WHEN page % 5 = 1 THEN 'page:json' WHEN page % 7 = 2 THEN 'page:error' ELSE 'record' END AS what,
       CASE WHEN page % 5 = 1 OR page % 7 = 2 THEN count(DISTINCT page) ELSE count(*) END AS n
FROM p GROUP BY what, (page % 5 = 1 OR page % 7 = 2)
""")
def q_corrupt_page_rejects(spark: SparkSession, base: str) -> DataFrame:
    """Cut and error pages are counted with their reason, all other records are read."""
    pages = build_page_landing(_orders(spark, base), "id", 50).select("page", "value")
    bad = (F.when(F.col("page") % 5 == 1, F.concat(F.lit("{"), F.col("value")))
           .when(F.col("page") % 7 == 2, F.lit('{"success":false,"error":"rate limit"}')).otherwise(F.col("value")))
    pages = pages.withColumn("value", bad)
    records = scan_pages(pages, page_col="page", on_bad="skip").select(F.lit("record").alias("what"))
    return (records.unionByName(page_rejects(pages).select(F.col("reason").alias("what")))
            .groupBy("what").agg(F.count(F.lit(1)).alias("n")))


TASK = Entity(
    name="tasks", table="tarefas", pk=("id",),
    fields=(R("id", "bigint", True), R("subject", "string"), R("due_date", "date"), R("done_at", "timestamp"),
            R("update_time", "string")),
    core=("subject", "due_date", "done_at", "update_time"), buckets=4)


def _tasks(spark: SparkSession, base: str) -> DataFrame:
    """Every order twice, the second record later in the landing; each shape on a residue of the key."""
    o = read_table(spark, base, "orders").select(F.col("o_orderkey").cast("bigint").alias("id"),
                                                 F.date_format("o_orderdate", "yyyy-MM-dd").alias("d"))
    k = F.col("id")
    due = F.when(k % 4 == 1, "0000-00-00").when(k % 4 == 2, "").when(k % 4 == 3, F.col("d"))
    done = F.when(k % 3 == 1, "-0001-11-30T00:00:00Z").when(k % 3 == 2, F.concat("d", F.lit("T08:30:00Z")))
    upd = F.when(k % 5 == 1, "0000-00-00 00:00:00").otherwise(F.concat("d", F.lit(" 01:02:03")))
    twice = o.select("*", F.explode(F.array(F.lit("zeta"), F.lit("alpha"))).alias("subject"))
    body = F.to_json(F.struct(k.alias("id"), F.col("subject"), due.alias("dueDate"), done.alias("doneAt"),
                              upd.alias("updateTime"), F.when(k % 2 == 0, k).alias("newAttr")))
    # one page per order: the later record is the one of higher ordinal
    return (twice.withColumn("j", body).groupBy("id").agg(F.reverse(F.sort_array(F.collect_list(F.struct("subject", "j")))).alias("r"))
            .select(F.col("id").alias("page"), F.concat(F.lit('{"data":['), F.array_join("r.j", ","), F.lit("]}")).alias("value")))


def _synced_tasks(spark: SparkSession, base: str) -> DataFrame:
    root = _path(spark, "tasks")
    sync_entity(spark, scan_pages(_tasks(spark, base), page_col="page"), TASK, root)
    return read_synced(spark, root, TASK)


@register("entity_sync_dirty", """
SELECT CAST(o_orderkey AS BIGINT) AS id, 'alpha' AS subject,
       CASE WHEN o_orderkey % 4 = 3 THEN CAST(o_orderdate AS DATE) END AS due_date,
       CASE WHEN o_orderkey % 3 = 2 THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + INTERVAL '8 hours 30 minutes' END AS done_at,
       CASE WHEN o_orderkey % 5 <> 1 THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP)
            + INTERVAL '1 hour 2 minutes 3 seconds' END AS update_time
FROM orders
""")
def q_entity_sync_dirty(spark: SparkSession, base: str) -> DataFrame:
    """Zero dates are NULL and reject nothing; the last record in wins ties."""
    return _synced_tasks(spark, base).drop(EXTRAS)


@register("entity_sync_extras", """
SELECT CAST(o_orderkey AS BIGINT) AS id,
       CASE WHEN o_orderkey % 2 = 0 THEN '{"new_attr":' || CAST(o_orderkey AS VARCHAR) || '}' END AS extra_attributes
FROM orders
""")
def q_entity_sync_extras(spark: SparkSession, base: str) -> DataFrame:
    """Keys that nothing describes are kept."""
    return _synced_tasks(spark, base).select("id", EXTRAS)


CUTOFF = dt.datetime(1995, 6, 17, tzinfo=dt.timezone.utc)


@register("sync_incremental_second_run", """
SELECT o_orderkey AS id, 'Order #' || CAST(o_orderkey AS VARCHAR) AS title, o_totalprice AS value,
       o_orderdate + INTERVAL 1 DAY AS update_time
FROM orders
""")
def q_sync_incremental_second_run(spark: SparkSession, base: str) -> DataFrame:
    """A full run up to a moment, then a run that reads the landing only from
    its watermark on, give the whole table."""
    root = _path(spark, "incremental")
    raw = QS.raw_deals(spark, base)
    old = raw.where(F.col("updateTime").cast("timestamp") < F.lit(CUTOFF))

    def landing(since: dt.datetime | None) -> DataFrame:
        new = raw if since is None else raw.where(F.col("updateTime").cast("timestamp") >= F.lit(since))
        return QS._records(new)

    run_all(spark, {"deals": QS._records(old)}, {"deals": QS.DEAL}, root, run_start=CUTOFF)
    run_all(spark, {"deals": landing}, {"deals": QS.DEAL}, root)
    return read_synced(spark, root, QS.DEAL).select("id", "title", F.col("value").cast("double").alias("value"), "update_time")


CLOSED_DEAL = replace(QS.DEAL, core=(*QS.DEAL.core, "close_time"))


@register("sync_bi_persisted", """
WITH a AS (SELECT l_orderkey * 8 + l_linenumber AS id, l_orderkey AS deal_id, CAST(l_shipdate AS DATE) AS due,
                  l_shipdate + CAST(l_partkey % 1000 AS INTEGER) * INTERVAL 1 SECOND AS u FROM lineitem),
l AS (SELECT deal_id, max(due) AS due, count(DISTINCT id) AS n FROM a GROUP BY deal_id)
SELECT o.o_orderkey AS deal_id, CAST(CAST(o.o_totalprice AS DECIMAL(18,4)) AS VARCHAR) AS value,
       o.o_orderdate + (o.o_custkey % 90) * INTERVAL 1 DAY AS close_time, c.c_name AS contact_name,
       n.n_name AS company_name, CAST(coalesce(l.n, 0) AS INTEGER) AS activity_count,
       CAST(o.o_custkey % 90 AS INTEGER) AS deal_duration_days
FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey
LEFT JOIN nation n ON n.n_nationkey = o.o_orderkey % 30 LEFT JOIN l ON l.deal_id = o.o_orderkey
""")
def q_sync_bi_persisted(spark: SparkSession, base: str) -> DataFrame:
    """Organizations, persons, deals and activities synced, then the fact with
    durations and DECIMAL(18,4) values upserted by deal, twice, and read back."""
    root = _path(spark, "bi")
    deals = QS.raw_deals(spark, base)
    closed = F.timestamp_add("DAY", F.col("personId") % 90, F.col("addTime").cast("timestamp"))
    raws = {"organizations": QS.raw_organizations(spark, base), "persons": QS.raw_persons(spark, base),
            "deals": deals.withColumn("closeTime", F.date_format(closed, "yyyy-MM-dd HH:mm:ss")),
            "activities": QS.raw_activities(spark, base)}
    entities = {"organizations": QS.ORG, "persons": QS.PERSON, "deals": CLOSED_DEAL, "activities": QS.ACTIVITY}
    table = f"{root}/bi_deals"

    def fact(spark: SparkSession, root: str) -> dict:
        people = read_synced(spark, root, QS.PERSON).select(
            "id", F.col("name").alias("contact_name"), F.col("email_contatos_primary_value").alias("contact_email"),
            F.col("telefone_contatos_primary_value").alias("contact_phone"))
        orgs = read_synced(spark, root, QS.ORG).select("id", F.col("name").alias("company_name"))
        rollup = activity_rollup(read_synced(spark, root, QS.ACTIVITY))
        rows = build_bi_fact(read_synced(spark, root, CLOSED_DEAL), people, orgs, rollup)
        rows = rows.withColumn("value", F.col("value").cast("decimal(18,4)"))
        return U.upsert_table(spark, table, rows, ["deal_id"], buckets=8, dedupe=False)

    run_all(spark, {k: QS._records(v) for k, v in raws.items()}, entities, root, derived={"bi": fact})
    fact(spark, root)
    return U.read_table_at(spark, table).select(
        "deal_id", F.col("value").cast("string").alias("value"), "close_time", "contact_name", "company_name",
        "activity_count", "deal_duration_days")
