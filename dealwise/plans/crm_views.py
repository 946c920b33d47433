"""CRM entities derived from the driver's TPC-H-like tables.

The catalogue of queries runs the CRM operators on the driver tables through
one fixed analogy (SURVEY §7.3):

  deals          <- orders   (status O/F/P -> open/won/lost, close time =
                              latest ship date of the order's line items)
  persons        <- customer
  organizations  <- nation   (org_id = o_orderkey % 30, so 25..29 dangle)
  pipelines      <- region
  stages         <- nation
  users          <- supplier
  activities     <- lineitem
  change log     <- events   (deal = user_id, stage = props.k, time = ts)

Each function is lazy and mirrors a CTE in :mod:`dealwise.plans.oracle`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dealwise.sources.tables import read_table


def order_rollup(spark: SparkSession, base: str) -> DataFrame:
    """One aggregate over line items per order: close time plus activity stats.

    Computed once and shared by the deal view and the BI activity columns, so
    the large table is scanned and shuffled a single time.
    """
    li = read_table(spark, base, "lineitem")
    return (li.groupBy(F.col("l_orderkey").alias("id"))
            .agg(F.max("l_shipdate").alias("close_time"),
                 F.count(F.lit(1)).cast("int").alias("activity_count"),
                 F.max(F.when(F.col("l_linestatus") == "O", F.col("l_shipdate")))
                  .alias("last_activity_due_date")))


def status_of(code: Column) -> Column:
    return (F.when(code == "O", "open").when(code == "F", "won")
             .when(code == "P", "lost"))


def deals(spark: SparkSession, base: str, rollup: DataFrame | None = None) -> DataFrame:
    o = read_table(spark, base, "orders")
    roll = rollup if rollup is not None else order_rollup(spark, base)
    j = o.join(roll, o.o_orderkey == roll.id, "left")
    close = F.col("close_time")
    return j.select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderkey") % 11 == 0, F.lit(None).cast("bigint"))
         .otherwise(F.col("o_custkey")).alias("person_id"),
        (F.col("o_orderkey") % 30).alias("org_id"),
        F.concat(F.lit("Order #"), F.col("o_orderkey").cast("string")).alias("title"),
        status_of(F.col("o_orderstatus")).alias("status"),
        F.col("o_totalprice").alias("value"),
        F.lit("USD").alias("currency"),
        F.col("o_orderdate").alias("add_time"),
        F.coalesce(close, F.col("o_orderdate")).alias("update_time"),
        close.alias("close_time"),
        F.date_add(F.to_date("o_orderdate"), 30).alias("expected_close_date"),
        F.when(F.col("o_orderstatus") == "P", close).alias("lost_time"),
        F.when(F.col("o_orderstatus") == "F", close).alias("won_time"),
        (F.col("o_custkey") % 100).alias("creator_user_id"),
        (F.col("o_orderkey") % 97).alias("user_id"),
        (F.col("o_orderkey") % 5).alias("pipeline_id"),
        (F.col("o_orderkey") % 25).alias("stage_id"),
        F.col("activity_count"),
        F.col("last_activity_due_date"),
    )


def contacts(spark: SparkSession, base: str) -> DataFrame:
    c = read_table(spark, base, "customer")
    return c.select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("contact_name"),
        F.concat(F.lower(F.regexp_replace("c_name", "#", ".")), F.lit("@example.com"))
         .alias("contact_email"),
        F.concat(F.lit("+55 11 "), F.col("c_custkey").cast("string")).alias("contact_phone"),
    )


def companies(spark: SparkSession, base: str) -> DataFrame:
    n = read_table(spark, base, "nation")
    return n.select(F.col("n_nationkey").cast("bigint").alias("id"),
                    F.col("n_name").alias("company_name"))


PAGE_SIZE = 500


def _jq(c: Column) -> Column:
    return F.regexp_extract(F.to_json(F.array(c)), r"^\[(.*)\]$", 1)


def change_log_item(e: DataFrame, junk: Column | None = None) -> Column:
    """One change-log item per event, as JSON text, in one of three layouts.

    field_key is ``stage_id`` except for ``view`` events; new_value is the
    event's ``props.k`` as a number, as a string (every third event), or an
    empty string (even ``signup`` events), or text that is no number where ``junk`` holds; old layout for even ids, new
    layout (``details``) for odd ids, and no ``data`` wrapper every 7th id.
    """
    i = F.col("event_id")
    k = F.try_variant_get(F.parse_json("props"), "$.k", "bigint").cast("string")
    fk = F.when(F.col("event_type") == "view", F.lit('"title"')).otherwise(F.lit('"stage_id"'))
    nv = (F.when((F.col("event_type") == "signup") & (i % 2 == 0), F.lit('""'))
           .when(i % 3 == 1, F.concat(F.lit('"'), k, F.lit('"')))
           .otherwise(k))
    if junk is not None:
        nv = F.when(junk, F.lit('"n/a"')).otherwise(nv)
    uid = (i % 50).cast("string")
    ts = _jq(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    old = F.concat(F.lit('{"field_key":'), fk, F.lit(',"new_value":'), nv, F.lit(',"user_id":'), uid, F.lit("}"))
    new = F.concat(F.lit('{"user_id":'), uid, F.lit(',"details":{"field_key":'), fk,
                   F.lit(',"new_value":'), nv, F.lit("}}"))
    payload = F.when(i % 2 == 0, old).otherwise(new)
    bare = F.concat(F.lit('{"timestamp":'), ts, F.lit(',"field_key":'), fk, F.lit(',"new_value":'), nv,
                    F.lit(',"user_id":'), uid, F.lit("}"))
    wrapped = F.concat(F.lit('{"timestamp":'), ts, F.lit(',"data":'), payload, F.lit("}"))
    return F.when(i % 7 == 0, bare).otherwise(wrapped)


def change_log_pages(spark: SparkSession, base: str, junk: Column | None = None) -> DataFrame:
    """S8 landing: ``(deal_id, page, items)`` with at most PAGE_SIZE items a page.

    Pages group a deal's items by ``event_id div PAGE_SIZE``, so every array
    is bounded however many changes one deal has.
    """
    e = read_table(spark, base, "events")
    return (e.select(F.col("user_id").alias("deal_id"),
                     F.floor(F.col("event_id") / PAGE_SIZE).alias("page"),
                     F.col("event_id"), change_log_item(e, junk).alias("item"))
             .groupBy("deal_id", "page")
             .agg(F.sort_array(F.collect_list(F.struct("event_id", "item"))).alias("items"))
             .select("deal_id", "page", F.col("items.item").alias("items")))


def stage_deals(spark: SparkSession, base: str) -> DataFrame:
    """Deals with a current stage (NULL every 13th) for the history queries."""
    o = read_table(spark, base, "orders")
    return o.select(F.col("o_orderkey").alias("id"),
                    F.when(F.col("o_orderkey") % 13 == 0, F.lit(None).cast("bigint"))
                     .otherwise(F.col("o_orderkey") % 25).alias("stage_id"),
                    F.col("o_orderdate").alias("add_time"))
