"""Plan-shape checks for the scale properties the operators promise."""

from pyspark.sql import functions as F

from dealwise.operators.bi import build_bi_fact
from dealwise.operators.dedupe import keep_last


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_keep_last_combines_before_the_shuffle(spark):
    # one key holds a third of the rows
    df = spark.range(0, 30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("ts"), (F.col("id") * 2).alias("v"))
    out = keep_last(df, ["k"], [F.col("ts")])
    plan = physical(out)
    exchange = plan.index("Exchange")
    assert "Aggregate" in plan[exchange:], plan  # partial aggregate below the exchange
    assert plan.count("Aggregate") >= 2
    got = {r.k: r.ts for r in out.collect()}
    assert got[0] == 29_997 and len(got) == 20_001


def test_dimension_broadcast_only_under_the_bound(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        deals = spark.range(0, 1000).select(F.col("id"), (F.col("id") % 50).alias("person_id"),
                                            (F.col("id") % 7).alias("org_id"))
        contacts = spark.range(0, 50).select(F.col("id"), F.lit("n").alias("contact_name"),
                                             F.lit("e").alias("contact_email"), F.lit("p").alias("contact_phone"))
        companies = spark.range(0, 7).select(F.col("id"), F.lit("c").alias("company_name"))
        small = physical(build_bi_fact(deals, contacts, companies, broadcast_rows=100))
        assert small.count("BroadcastHashJoin") == 2
        big = physical(build_bi_fact(deals, contacts, companies, broadcast_rows=10))
        # contacts (50 rows) exceed the bound: sort-merge; companies (7) still broadcast
        assert big.count("BroadcastHashJoin") == 1 and big.count("SortMergeJoin") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_incremental_filter_reaches_the_scan(spark):
    import datetime as dt
    from dealwise.sources.tables import read_table
    from dealwise.streaming.state import incremental
    e = read_table(spark, "/root/testdata/sf0.001", "events").select("event_id", "ts")
    plan = physical(incremental(e, "ts", dt.datetime(2024, 1, 15, tzinfo=dt.timezone.utc)))
    # rows without an update time are kept, and the whole condition still reaches the reader
    assert "PushedFilters: [Or(GreaterThanOrEqual(ts," in plan and "IsNull(ts))]" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp>" in plan
