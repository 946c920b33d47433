"""Deal stage history from change logs.

Change logs land as pages ``(deal_id, items ARRAY<STRING|VARIANT>)``; each
page is bounded by the API page size, so no single row grows with the
number of changes of a hot deal.  Items are exploded, both item layouts are
read with ``try_variant_get``, and the stage changes are reduced per
``(deal_id, stage_id)`` with an aggregate (map-side combined).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from dealwise.functions import parse as P
from dealwise.operators.dedupe import keep_last

STAGE_KEY = "stage_id"


def _truthy(v: Column) -> Column:
    """A falsy ``new_value`` (null, 0, "", false) is not a stage change."""
    return P.truthy(v)


# One typed view of a change-log item: a single variant traversal per item;
# every later step reads plain struct fields.
ITEM_SCHEMA = ("struct<timestamp:string, field_key:string, new_value:variant, user_id:variant,"
               " details:struct<field_key:string, new_value:variant>,"
               " data:struct<field_key:string, new_value:variant, user_id:variant,"
               " details:struct<field_key:string, new_value:variant>>>")


def change_items(pages: DataFrame, deal_col: str = "deal_id", items_col: str = "items") -> DataFrame:
    """One row per change-log item ``(deal_id, [page,] pos, it)``.

    Each item (JSON text or VARIANT) is decoded to :data:`ITEM_SCHEMA`
    *inside* the explode: the decoded value is generator output, so later
    filters cannot be pushed below it and re-run the decoding per predicate.
    """
    elem = pages.schema[items_col].dataType.elementType
    if isinstance(elem, StringType):
        typed = F.transform(items_col, lambda x: F.try_variant_get(F.try_parse_json(x), "$", ITEM_SCHEMA))
    else:
        typed = F.transform(items_col, lambda x: F.try_variant_get(x, "$", ITEM_SCHEMA))
    return pages.select(F.col(deal_col).alias("deal_id"),
                        *[c for c in pages.columns if c == "page"],
                        F.posexplode(typed).alias("pos", "it"))


def _typed_changes(items: DataFrame) -> DataFrame:
    """Stage changes in either layout, falsy ``new_value`` dropped: ``stage_id`` is NULL
    where ``raw_value`` is no integer.

    Old layout: ``payload.field_key == 'stage_id'``; new layout:
    ``payload.details.field_key``.  ``payload`` is ``item.data`` when present,
    else the item itself.
    """
    it = F.col("it")
    has_data = it["data"].isNotNull()

    def pay(field: str) -> Column:
        return F.when(has_data, it["data"][field]).otherwise(it[field])

    old_key = pay("field_key")
    details = pay("details")
    is_old = F.coalesce(old_key == STAGE_KEY, F.lit(False))
    is_new = ~is_old & F.coalesce(details["field_key"] == STAGE_KEY, F.lit(False))
    flat = items.select(
        "deal_id",
        F.when(is_old, pay("new_value")).when(is_new, details["new_value"]).alias("nv"),
        (is_old | is_new).alias("is_stage"),
        pay("user_id").alias("uid"),
        F.try_to_timestamp(it["timestamp"]).alias("change_time"))
    rows = flat.filter(F.col("is_stage")).select(
        "deal_id", "nv", "change_time", P.vget(F.col("uid"), "$", "bigint").alias("user_id"),
        _truthy(F.col("nv")).alias("truthy"))
    return rows.filter("truthy").select(
        "deal_id", P.vget(F.col("nv"), "$", "bigint").alias(STAGE_KEY), "change_time", "user_id",
        P.vstr(F.col("nv")).alias("raw_value"))


def stage_changes(items: DataFrame, with_rejects: bool = False):
    """The stage changes of change-log items.

    A non-integer ``new_value`` does not fail the job (D23): with ``with_rejects`` those
    rows are returned aside.
    """
    typed = _typed_changes(items)
    good = typed.filter(F.col(STAGE_KEY).isNotNull()).drop("raw_value")
    if not with_rejects:
        return good
    return good, typed.filter(F.col(STAGE_KEY).isNull())


def change_summary(items: DataFrame) -> DataFrame:
    """B4 W1 in one aggregate: a row per (deal, stage) with its latest change, and one per
    (deal, unusable value) with ``stage_id`` NULL; ``n`` counts the changes behind it.

    Everything a history run needs is read from this: the rows to write, which deals had a
    change, and the rejects.  Store it, and the change log is decoded once.
    """
    typed = _typed_changes(items).withColumn("raw_value", F.when(F.col(STAGE_KEY).isNull(), F.col("raw_value")))
    latest = F.max(F.struct("change_time", "user_id")).alias("latest")
    return typed.groupBy("deal_id", STAGE_KEY, "raw_value").agg(latest, F.count(F.lit(1)).alias("n")).select(
        "deal_id", STAGE_KEY, "raw_value", F.col("latest.change_time").alias("change_time"),
        F.col("latest.user_id").alias("user_id"), "n")


def latest_per_stage(changes: DataFrame, keep: str = "last") -> DataFrame:
    """One row per ``(deal_id, stage_id)``: the latest (parsed) change.

    ``keep='all'`` keeps every visit (the table key includes ``change_time``,
    D16).
    """
    if keep == "all":
        return keep_last(changes, ["deal_id", STAGE_KEY, "change_time"], [F.col("user_id")])
    return keep_last(changes, ["deal_id", STAGE_KEY], [F.col("change_time")])


def stage_sentinels(deals: DataFrame, changes: DataFrame, run_ts: Column | None = None,
                    deal_key: str = "id") -> DataFrame:
    """Deals with no stage change get ``(current stage, add_time or run start)``.

    Deals whose current stage is NULL produce nothing.
    """
    run_ts = run_ts if run_ts is not None else F.current_timestamp()
    seen = changes.select("deal_id").distinct()
    pending = deals.join(seen, F.col(deal_key) == F.col("deal_id"), "left_anti")
    return pending.filter(F.col(STAGE_KEY).isNotNull()).select(
        F.col(deal_key).alias("deal_id"), F.col(STAGE_KEY).cast("bigint").alias(STAGE_KEY),
        F.coalesce(F.col("add_time"), run_ts).alias("change_time"),
        F.lit(None).cast("bigint").alias("user_id"))


def stage_arrivals(history: DataFrame, stage_ids: Sequence[int],
                   prefix: str = "movido_para_etapa_") -> DataFrame:
    """Per deal, the arrival time at each known stage (pivot on known ids)."""
    piv = (history.groupBy("deal_id").pivot(STAGE_KEY, list(stage_ids))
                  .agg(F.max("change_time")))
    return piv.select("deal_id", *[F.col(f"`{s}`").alias(f"{prefix}{s}") for s in stage_ids])
