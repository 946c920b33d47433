"""BI fact table.

The fact is one row per deal: deals LEFT JOIN contacts LEFT JOIN companies,
plus per-deal activity statistics and two derived metrics.  Everything is a
single lazy plan; the right sides are de-duplicated by an aggregate (W2) so
the join can never multiply deal rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealwise.operators.dedupe import keep_first
from dealwise.operators.joins import DEFAULT_BROADCAST_ROWS, fits_broadcast

MICROS_PER_DAY = 86_400_000_000

# Fixed output layout of the fact table (names are the reference's).
BI_COLUMNS = [
    "deal_id", "title", "status", "value", "currency", "add_time", "update_time",
    "close_time", "expected_close_date", "lost_time", "won_time",
    "stage_change_time", "creator_user_id", "user_id", "pipeline_id", "stage_id",
    "label_ids", "contact_name", "contact_email", "contact_phone", "company_name",
    "activity_count", "last_activity_due_date", "deal_duration_days", "value_per_day",
]


def deal_duration_days(close: Column, add: Column) -> Column:
    """B1: whole days between two instants, floored (−1 s → −1 day).

    Elapsed-time based, not calendar based: ``datediff`` would count date
    boundaries instead.  NULL when either side is NULL.
    """
    diff = F.unix_micros(close) - F.unix_micros(add)
    return F.floor(diff / F.lit(MICROS_PER_DAY)).cast("int")


def value_per_day(value: Column, duration: Column) -> Column:
    """B2: value divided by the duration, NULL for a zero-day deal."""
    return value.cast("double") / F.nullif(duration, F.lit(0))


def activity_rollup(activities: DataFrame, deal_key: str = "deal_id",
                    due: str = "due_date", open_flag: Column | None = None) -> DataFrame:
    """Per-deal activity count and latest due time.

    One partial+final hash aggregate; with ``open_flag`` the latest due time
    only looks at open activities.
    """
    due_col = F.col(due) if open_flag is None else F.when(open_flag, F.col(due))
    return (activities.groupBy(F.col(deal_key).alias("deal_id"))
            .agg(F.count(F.lit(1)).cast("int").alias("activity_count"),
                 F.max(due_col).alias("last_activity_due_date")))


def build_bi_fact(deals: DataFrame, contacts: DataFrame, companies: DataFrame,
                  activities: DataFrame | None = None, *,
                  contact_order: str = "id", company_order: str = "id",
                  broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """The denormalised fact.

    ``deals``: ``id, person_id, org_id`` plus any of the fact's deal columns.
    ``contacts``: ``id, contact_name, contact_email, contact_phone``.
    ``companies``: ``id, company_name``.
    ``activities``: optional output of :func:`activity_rollup`; when absent,
    ``activity_count``/``last_activity_due_date`` are taken from ``deals`` if
    present there, else NULL.

    Joins are typed (BIGINT) so a NULL foreign key simply finds no partner.
    Companies and small contact sets are broadcast after a row-count proof;
    large contact sets go through a shuffle join planned by Catalyst/AQE.
    """
    people = keep_first(
        contacts.select(F.col("id").cast("bigint").alias("person_id"),
                        "contact_name", "contact_email", "contact_phone",
                        F.col(contact_order).alias("__ord")),
        ["person_id"], [F.col("__ord")]).drop("__ord")
    orgs = keep_first(
        companies.select(F.col("id").cast("bigint").alias("org_id"), "company_name",
                         F.col(company_order).alias("__ord")),
        ["org_id"], [F.col("__ord")]).drop("__ord")

    fact = deals.withColumn("person_id", F.col("person_id").cast("bigint")) \
                .withColumn("org_id", F.col("org_id").cast("bigint"))
    # The row bound is proven on the raw inputs (a scan stops early); the
    # de-duplicated sides can only be smaller.
    if fits_broadcast(contacts, broadcast_rows):
        people = F.broadcast(people)
    if fits_broadcast(companies, broadcast_rows):
        orgs = F.broadcast(orgs)
    fact = fact.join(people, "person_id", "left")
    fact = fact.join(orgs, "org_id", "left")
    if activities is not None:
        fact = fact.drop("activity_count", "last_activity_due_date") \
                   .join(activities.withColumnRenamed("deal_id", "id"), "id", "left")

    for name, typ in (("close_time", "timestamp"), ("add_time", "timestamp"),
                      ("value", "double")):
        if name not in fact.columns:
            fact = fact.withColumn(name, F.lit(None).cast(typ))
    duration = deal_duration_days(F.col("close_time"), F.col("add_time"))
    fact = (fact.withColumn("deal_duration_days", duration)
                .withColumn("value_per_day",
                            value_per_day(F.col("value"), F.col("deal_duration_days")))
                .withColumnRenamed("id", "deal_id")
                .drop("person_id", "org_id"))
    if "activity_count" in fact.columns:
        fact = fact.withColumn("activity_count",
                               F.coalesce(F.col("activity_count"), F.lit(0)))
    present = set(fact.columns)
    return fact.select(*[c for c in BI_COLUMNS if c in present])
