"""Upsert, table and schema-evolution queries.

Scenario: the target is a table built from one driver table; the incoming
batch comes from another, with keys mapped so that part of it updates
existing rows and part of it inserts new ones.  Whole tables on both sides.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealwise.operators import evolve as E
from dealwise.operators import upsert as U
from dealwise.plans.crm_views import status_of
from dealwise.plans.registry import register
from dealwise.session import scratch_path
from dealwise.sources.tables import read_table


def _deal_target(spark: SparkSession, base: str) -> DataFrame:
    o = read_table(spark, base, "orders")
    return o.select(F.col("o_orderkey").alias("id"), status_of(F.col("o_orderstatus")).alias("status"),
                    F.col("o_totalprice").alias("value"), F.col("o_orderdate").alias("update_time"),
                    F.col("o_orderpriority").alias("priority"))


def _line_batch(spark: SparkSession, base: str) -> DataFrame:
    """Incoming batch with many rows per key (W3): line items, keys shifted by 5000."""
    li = read_table(spark, base, "lineitem")
    return li.select((F.col("l_orderkey") + 5000).alias("id"), F.col("l_linestatus").alias("status"),
                     F.col("l_extendedprice").alias("value"), F.col("l_shipdate").alias("update_time"),
                     F.col("l_linenumber").alias("line"))


TARGET_SQL = """t AS (SELECT o_orderkey AS id,
  CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'won' WHEN 'P' THEN 'lost' END AS status,
  o_totalprice AS value, o_orderdate AS update_time, o_orderpriority AS priority FROM orders)"""

UPSERT_SQL = f"""
WITH {TARGET_SQL},
s0 AS (SELECT l_orderkey + 5000 AS id, l_linestatus AS status, l_extendedprice AS value,
              l_shipdate AS update_time, l_linenumber AS line FROM lineitem),
s AS (SELECT * FROM s0 QUALIFY row_number() OVER (PARTITION BY id ORDER BY update_time DESC,
      status DESC, value DESC, line DESC) = 1)
SELECT coalesce(t.id, s.id) AS id,
       CASE WHEN s.id IS NOT NULL THEN s.status ELSE t.status END AS status,
       CASE WHEN s.id IS NOT NULL THEN s.value ELSE t.value END AS value,
       CASE WHEN s.id IS NOT NULL THEN s.update_time ELSE t.update_time END AS update_time,
       t.priority AS priority, s.line AS line
FROM t FULL OUTER JOIN s ON t.id = s.id
"""


@register("upsert_basic", UPSERT_SQL)
def q_upsert_basic(spark: SparkSession, base: str) -> DataFrame:
    """Latest line per key wins; matched rows updated, new rows inserted."""
    return U.merge_frames(_deal_target(spark, base), _line_batch(spark, base), ["id"])


@register("upsert_table", UPSERT_SQL)
def q_upsert_table(spark: SparkSession, base: str) -> DataFrame:
    """K1 K6 K7 through the bucketed Parquet table: create, upsert, read back."""
    path = scratch_path(spark, f"tables/deals-{uuid.uuid4().hex}")
    U.create_table(spark, path, _deal_target(spark, base), ["id"], buckets=16)
    U.upsert_table(spark, path, _line_batch(spark, base), ["id"], buckets=16)
    return U.read_table_at(spark, path)


def _customer_batch(spark: SparkSession, base: str) -> DataFrame:
    c = read_table(spark, base, "customer")
    return c.select((F.col("c_custkey") * 11).alias("id"),
                    F.when(F.col("c_custkey") % 4 == 0, F.lit(None).cast("string"))
                     .otherwise(F.col("c_mktsegment")).alias("status"))


@register("upsert_partial", f"""
WITH {TARGET_SQL},
s AS (SELECT c_custkey * 11 AS id, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_mktsegment END AS status
      FROM customer)
SELECT coalesce(t.id, s.id) AS id,
       CASE WHEN s.id IS NOT NULL THEN s.status ELSE t.status END AS status,
       t.value, t.update_time, t.priority
FROM t FULL OUTER JOIN s ON t.id = s.id
""")
def q_upsert_partial(spark: SparkSession, base: str) -> DataFrame:
    """K5: columns absent from the batch keep target values; a NULL in the batch wins."""
    return U.merge_frames(_deal_target(spark, base), _customer_batch(spark, base), ["id"])


@register("insert_only", f"""
WITH {TARGET_SQL},
s AS (SELECT c_custkey * 11 AS id, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_mktsegment END AS status
      FROM customer)
SELECT * FROM t
UNION ALL
SELECT s.id, s.status, NULL, NULL, NULL FROM s WHERE s.id NOT IN (SELECT id FROM t)
""")
def q_insert_only(spark: SparkSession, base: str) -> DataFrame:
    """Only new keys are appended (anti join); existing rows untouched."""
    return U.insert_new_only(_deal_target(spark, base), _customer_batch(spark, base), ["id"])


@register("bucketed_table", """
SELECT o_orderkey AS id, o_custkey AS person_id, o_totalprice AS value, o_orderdate AS add_time
FROM orders
""")
def q_bucketed_table(spark: SparkSession, base: str) -> DataFrame:
    """K6 K7: hash-bucketed table written and read back (bucket pruning on read)."""
    o = read_table(spark, base, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("person_id"),
        F.col("o_totalprice").alias("value"), F.col("o_orderdate").alias("add_time"))
    path = scratch_path(spark, f"tables/bucketed-{uuid.uuid4().hex}")
    U.create_table(spark, path, o, ["id"], buckets=8)
    return U.read_table_at(spark, path)


def _people(spark: SparkSession, base: str) -> DataFrame:
    c = read_table(spark, base, "customer")
    return c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                    F.col("c_nationkey").alias("nationkey"))


@register("evolve_add", """
WITH t AS (SELECT c_custkey AS id, c_name AS name, c_nationkey AS nationkey FROM customer),
s AS (SELECT s_suppkey * 13 AS id, s_name AS name, s_acctbal AS acctbal FROM supplier)
SELECT coalesce(t.id, s.id) AS id,
       CASE WHEN s.id IS NOT NULL THEN s.name ELSE t.name END AS name,
       t.nationkey, s.acctbal
FROM t FULL OUTER JOIN s ON t.id = s.id
""")
def q_evolve_add(spark: SparkSession, base: str) -> DataFrame:
    """A batch with a new column widens the table; old rows get NULL."""
    s = read_table(spark, base, "supplier").select(
        (F.col("s_suppkey") * 13).alias("id"), F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("acctbal"))
    return U.merge_frames(_people(spark, base), s, ["id"])


@register("evolve_type", """
WITH t AS (SELECT c_custkey AS id, c_name AS name, CAST(c_nationkey AS VARCHAR) AS nationkey FROM customer),
s AS (SELECT s_suppkey * 13 AS id, 'N' || CAST(s_nationkey AS VARCHAR) AS nationkey FROM supplier)
SELECT coalesce(t.id, s.id) AS id, t.name,
       CASE WHEN s.id IS NOT NULL THEN s.nationkey ELSE t.nationkey END AS nationkey
FROM t FULL OUTER JOIN s ON t.id = s.id
""")
def q_evolve_type(spark: SparkSession, base: str) -> DataFrame:
    """INT column meets STRING values; the column becomes STRING (try_cast)."""
    s = read_table(spark, base, "supplier").select(
        (F.col("s_suppkey") * 13).alias("id"),
        F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("nationkey"))
    return U.merge_frames(_people(spark, base), s, ["id"])


@register("union_by_name", """
SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, NULL::DOUBLE AS acctbal FROM customer
UNION ALL
SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier
""")
def q_union_by_name(spark: SparkSession, base: str) -> DataFrame:
    """Batches with differing columns concatenated by name."""
    c = read_table(spark, base, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    s = read_table(spark, base, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("acctbal"))
    return E.union_evolving([c, s])


@register("overflow_json", """
SELECT p_partkey, p_name, p_brand,
  '{"p_type":"' || p_type || '","p_size":' || CAST(p_size AS VARCHAR)
  || CASE WHEN p_partkey % 5 = 0 THEN '' ELSE ',"p_container":"BOX ' || CAST(p_size AS VARCHAR) || '"' END
  || '}' AS custom_fields_overflow
FROM part
""")
def q_overflow_json(spark: SparkSession, base: str) -> DataFrame:
    """A 4-column cap; surplus non-null values packed into JSON."""
    p = read_table(spark, base, "part")
    wide = p.select("p_partkey", "p_name", "p_brand", "p_type", "p_size",
                    F.when(F.col("p_partkey") % 5 == 0, F.lit(None).cast("string"))
                     .otherwise(F.concat(F.lit("BOX "), F.col("p_size").cast("string"))).alias("p_container"))
    return E.apply_column_cap(wide, 4, protected=("p_partkey",))


@register("drop_null_columns", """
SELECT s_suppkey AS id, s_name, s_acctbal, NULL::BIGINT AS legacy_id FROM supplier
""")
def q_drop_null_columns(spark: SparkSession, base: str) -> DataFrame:
    """All-NULL and all-empty columns dropped, protected ones kept (one pass)."""
    s = read_table(spark, base, "supplier")
    wide = s.select(F.col("s_suppkey").alias("id"), "s_name", "s_acctbal",
                    F.lit(None).cast("string").alias("fax"),
                    F.array().cast("array<string>").alias("tags"),
                    F.when(F.col("s_acctbal") > 1e18, F.lit(1)).alias("never"),
                    F.lit(None).cast("bigint").alias("legacy_id"))
    out, _ = E.drop_null_columns(wide, protected=("id", "legacy_id"))
    return out


@register("keyed_column_update", """
WITH u1 AS (SELECT user_id AS id, max(CAST(json_extract(props, '$.k') AS BIGINT)) AS stage_id
            FROM events GROUP BY user_id),
u2 AS (SELECT DISTINCT user_id AS id, 'purchased' AS status FROM events WHERE event_type = 'purchase')
SELECT o.o_orderkey AS id,
  CASE WHEN u1.id IS NOT NULL THEN u1.stage_id ELSE o.o_orderkey % 25 END AS stage_id,
  CASE WHEN u2.id IS NOT NULL THEN u2.status
       ELSE CASE o.o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'won' WHEN 'P' THEN 'lost' END
  END AS status
FROM orders o LEFT JOIN u1 ON u1.id = o.o_orderkey LEFT JOIN u2 ON u2.id = o.o_orderkey
""")
def q_keyed_column_update(spark: SparkSession, base: str) -> DataFrame:
    """Several column updates folded into one join, existing rows only."""
    o = read_table(spark, base, "orders")
    target = o.select(F.col("o_orderkey").alias("id"), (F.col("o_orderkey") % 25).alias("stage_id"),
                      status_of(F.col("o_orderstatus")).alias("status"))
    e = read_table(spark, base, "events")
    k = F.try_variant_get(F.parse_json("props"), "$.k", "bigint")
    stage = e.select(F.col("user_id").alias("id"), k.alias("stage"))
    status = e.filter(F.col("event_type") == "purchase").select(
        F.col("user_id").alias("id"), F.lit("purchased").alias("s"))
    return U.update_existing(target, {"stage_id": stage, "status": status}, "id")
