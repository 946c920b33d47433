"""Source and scan queries.

Landings are produced by Spark from the driver tables into the shared
checkpoint folder, then read back through the package's scans; the result
must equal the base table.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealwise.operators import history as H
from dealwise.plans import crm_views as v
from dealwise.plans.registry import register
from dealwise.session import scratch_path
from dealwise.sources import pages as PG
from dealwise.sources.csv_stage import read_staged_csv, write_staged_csv
from dealwise.sources.paged import read_route
from dealwise.sources.routes import register_route
from dealwise.sources.tables import read_table

ORDER_FIELDS = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string",
                "o_totalprice": "double", "o_orderdate": "timestamp"}
ORDERS_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders"


def _orders(spark: SparkSession, base: str) -> DataFrame:
    return read_table(spark, base, "orders").select(*ORDER_FIELDS)


def _landing(spark: SparkSession, base: str, cursor: bool, keyed: bool = True) -> str:
    """Orders as API pages: keyed by offset/cursor for the paged sources, or a
    plain file landing for the scans."""
    path = scratch_path(spark, f"landing/orders-{'c' if cursor else 'o'}-{uuid.uuid4().hex}")
    pages = PG.build_page_landing(_orders(spark, base), "o_orderkey", 500, cursor)
    (PG.write_keyed_landing if keyed else PG.write_page_landing)(pages, path)
    return path


def _typed(records: DataFrame, col: str) -> DataFrame:
    rec = F.parse_json(col) if dict(records.dtypes)[col] == "string" else F.col(col)
    return records.select(*PG.record_fields(rec, ORDER_FIELDS))


@register("page_scan", ORDERS_SQL)
def q_page_scan(spark: SparkSession, base: str) -> DataFrame:
    """Page-envelope landing read as text, parsed once, exploded to records."""
    path = _landing(spark, base, cursor=False, keyed=False)
    return _typed(PG.scan_pages(PG.read_pages(spark, path)), "record")


@register("offset_pages", ORDERS_SQL)
def q_offset_pages(spark: SparkSession, base: str) -> DataFrame:
    """Offset pagination through the Python data source, page ranges in parallel."""
    path = _landing(spark, base, cursor=False)
    register_route("/orderPages", "v1", 20)
    return _typed(PG.scan_pages(read_route(spark, "/orderPages", landing=path, numPartitions="8"), "body"), "record")


@register("cursor_pages", ORDERS_SQL)
def q_cursor_pages(spark: SparkSession, base: str) -> DataFrame:
    """Cursor pagination, the collection cut into eight chains by key range."""
    path = _landing(spark, base, cursor=True)
    last = read_table(spark, base, "orders").agg(F.max("o_orderkey")).first()[0] or 0
    pages = last // PG.DEFAULT_LIMIT + 1
    step = -(-pages // 8)
    chains = [{"from_page": a, "to_page": min(a + step, pages)} for a in range(0, pages, step)]
    return _typed(PG.scan_pages(read_route(spark, "/deals", landing=path, chains=json.dumps(chains)), "body"), "record")


@register("detail_scan", """
SELECT user_id AS deal_id, ts AS change_time,
       CASE WHEN event_type = 'view' THEN 'title' ELSE 'stage_id' END AS field_key
FROM events
""")
def q_detail_scan(spark: SparkSession, base: str) -> DataFrame:
    """Per-deal change-log pages exploded back to one row per item."""
    items = H.change_items(v.change_log_pages(spark, base))
    it = F.col("it")
    has_data = it["data"].isNotNull()
    fk = F.coalesce(F.when(has_data, it["data"]["field_key"]).otherwise(it["field_key"]),
                    F.when(has_data, it["data"]["details"]["field_key"]))
    return items.select("deal_id", F.try_to_timestamp(it["timestamp"]).alias("change_time"),
                        fk.alias("field_key"))


@register("csv_stage_roundtrip", """
SELECT c_custkey AS id, c_name AS name,
       CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN '' ELSE c_mktsegment END AS segment,
       c_acctbal AS acctbal,
       CASE WHEN c_custkey % 3 = 0 THEN 'say "hi", \\ ok' ELSE 'plain' END AS note
FROM customer
""")
def q_csv_stage_roundtrip(spark: SparkSession, base: str) -> DataFrame:
    """Staging CSV written and read back; NULL and '' stay distinct."""
    c = read_table(spark, base, "customer")
    k = F.col("c_custkey")
    df = c.select(k.alias("id"), F.col("c_name").alias("name"),
                  F.when(k % 5 == 0, F.lit(None).cast("string")).when(k % 7 == 0, F.lit(""))
                   .otherwise(F.col("c_mktsegment")).alias("segment"),
                  F.col("c_acctbal").alias("acctbal"),
                  F.when(k % 3 == 0, F.lit('say "hi", \\ ok')).otherwise(F.lit("plain")).alias("note"))
    path = scratch_path(spark, f"staging/customer-{uuid.uuid4().hex}")
    write_staged_csv(df, path)
    return read_staged_csv(spark, path, df.schema)


@register("table_scan", """
SELECT l_returnflag, l_linestatus, count(*) AS n_lines, sum(l_quantity) AS sum_qty,
       min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
FROM lineitem GROUP BY l_returnflag, l_linestatus
""")
def q_table_scan(spark: SparkSession, base: str) -> DataFrame:
    """Column-pruned scan (4 of 11 columns reach the reader) with a grouped aggregate."""
    li = read_table(spark, base, "lineitem")
    return (li.groupBy("l_returnflag", "l_linestatus")
              .agg(F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("sum_qty"),
                   F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship")))
