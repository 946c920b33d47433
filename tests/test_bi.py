import datetime as dt

from pyspark.sql import functions as F

from dealwise.operators.bi import activity_rollup, build_bi_fact


def ts(s):
    return dt.datetime.fromisoformat(s)


def test_duration_and_value_per_day(spark):
    deals = spark.createDataFrame(
        [(1, None, None, 10.0, ts("2024-01-01 10:00:00"), ts("2024-01-02 09:59:00")),
         (2, None, None, 10.0, ts("2024-01-01 10:00:00"), ts("2024-01-01 09:59:59")),
         (3, None, None, 10.0, ts("2024-01-01 10:00:00"), None),
         (4, None, None, 30.0, ts("2024-01-01 00:00:00"), ts("2024-01-04 00:00:00"))],
        "id long, person_id long, org_id long, value double, add_time timestamp, close_time timestamp")
    contacts = spark.createDataFrame([], "id long, contact_name string, contact_email string, contact_phone string")
    companies = spark.createDataFrame([], "id long, company_name string")
    got = {r.deal_id: (r.deal_duration_days, r.value_per_day)
           for r in build_bi_fact(deals, contacts, companies).collect()}
    assert got == {1: (0, None), 2: (-1, -10.0), 3: (None, None), 4: (3, 10.0)}


def test_left_joins_dedupe_right_sides(spark):
    deals = spark.createDataFrame(
        [(1, 7, 3), (2, None, 3), (3, 8, 99)],
        "id long, person_id long, org_id long")
    contacts = spark.createDataFrame(
        [(7, "Ana", "a@x", "1"), (7, "Ana2", "b@x", "2"), (8, "Bo", None, None)],
        "id long, contact_name string, contact_email string, contact_phone string")
    companies = spark.createDataFrame([(3, "Acme"), (3, "Acme dup")], "id long, company_name string")
    acts = activity_rollup(spark.createDataFrame(
        [(1, ts("2024-01-01 00:00:00")), (1, ts("2024-02-01 00:00:00"))],
        "deal_id long, due_date timestamp"))
    out = build_bi_fact(deals, contacts, companies, acts,
                        contact_order="contact_name", company_order="company_name")
    rows = {r.deal_id: r for r in out.collect()}
    assert len(rows) == 3 and out.count() == 3
    assert rows[1].contact_name == "Ana" and rows[1].company_name == "Acme"
    assert rows[2].contact_name is None and rows[2].company_name == "Acme"
    assert rows[3].company_name is None
    assert rows[1].activity_count == 2 and rows[2].activity_count == 0
    assert rows[1].last_activity_due_date == ts("2024-02-01 00:00:00")
    assert "person_id" not in out.columns and "org_id" not in out.columns


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "deal_id"
