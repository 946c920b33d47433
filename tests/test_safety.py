"""Inputs that used to lose rows: the table layout, keys, pages, labels, run accounting."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, LongType, StringType

from dealwise.functions import custom_fields as X
from dealwise.operators import upsert as U
from dealwise.operators.evolve import common_type
from dealwise.operators.validate import FieldRule
from dealwise.plans.sync import Entity, read_synced, sync_entity
from dealwise.sources.pages import page_rejects, scan_pages
from dealwise.spec import FieldMeta
from dealwise.streaming.state import incremental


def new_path():
    return os.path.join(tempfile.mkdtemp(prefix="dw-test-"), "t")


def test_int_batch_on_bigint_table_keeps_every_row(spark):
    path = new_path()
    U.create_table(spark, path, spark.range(100).select("id", F.lit("old").alias("v")), ["id"], 4)
    U.upsert_table(spark, path, spark.createDataFrame([(7, "new")], "id int, v string"), ["id"], buckets=16)
    got = {r["id"]: r["v"] for r in U.read_table_at(spark, path).collect()}
    assert len(got) == 100 and got[7] == "new" and U.read_manifest(spark, path).buckets == 4


def test_small_batch_replaces_only_its_buckets(spark):
    path = new_path()
    U.create_table(spark, path, spark.range(1000).select("id", F.lit("old").alias("v")), ["id"], 64)
    before = {f for f in spark.read.parquet(path).inputFiles()}
    U.upsert_table(spark, path, spark.createDataFrame([(7, "new"), (8, "new")], "id long, v string"), ["id"])
    after = {f for f in spark.read.parquet(path).inputFiles()}
    assert len(before - after) <= 2 and U.read_table_at(spark, path).count() == 1000


def test_wrong_key_columns_are_refused(spark):
    path = new_path()
    U.create_table(spark, path, spark.range(5).select("id", F.col("id").alias("k")), ["id"], 2)
    with pytest.raises(ValueError):
        U.upsert_table(spark, path, spark.range(5).select("id", F.col("id").alias("k")), ["k"])


def test_common_type_is_lossless():
    assert common_type(DecimalType(18, 4), DecimalType(10, 2)) == DecimalType(18, 4)
    assert common_type(DecimalType(10, 2), LongType()) == DecimalType(22, 2)
    assert common_type(DecimalType(38, 2), DecimalType(38, 10)) == StringType()


@pytest.mark.parametrize("body", ['{"success":false,"error":"rate limit"}', '{"data":[{"id":1}', "[1,2]", '{"data":{"id":1}}'])
def test_unreadable_page_fails_the_run_or_is_kept_aside(spark, body):
    pages = spark.createDataFrame([(0, '{"data":[{"id":1}]}'), (1, body), (2, '{"success":true,"data":null}')], "page long, value string")
    with pytest.raises(Exception, match="unreadable page"):
        scan_pages(pages, page_col="page").collect()
    assert scan_pages(pages, page_col="page", on_bad="skip").count() == 1
    assert [r["page"] for r in page_rejects(pages).collect()] == [1]


def test_two_fields_with_one_label_keep_both(spark):
    df = spark.sql("""select 1L as id, from_json('{"a":"x","b":"y"}', 'map<string,variant>') as custom_fields""")
    out = X.explode_custom_fields(df, [FieldMeta("a", "Nome", "varchar"), FieldMeta("b", "Nome", "varchar")])
    assert set(out.first().asDict().values()) == {1, "x", "y"}


def test_incremental_keeps_rows_without_update_time(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (2, None), (3, dt.datetime(2024, 3, 1))], "id long, t timestamp")
    assert {r["id"] for r in incremental(df, "t", "2024-02-01").collect()} == {2, 3}


def test_replayed_and_failed_runs_are_counted_once(spark):
    root = new_path()
    ent = Entity(name="e", table="e", pk=("id",), order=None, fields=(FieldRule("id", "bigint", True), FieldRule("v", "string")), buckets=2)
    pages = spark.createDataFrame([(0, '{"data":[{"id":1,"v":"a"},"no object",{"id":"x"}]}')], "page long, value string")
    for _ in range(2):
        sync_entity(spark, scan_pages(pages, page_col="page"), ent, root, run_id="b7")
    rejects = spark.read.parquet(f"{root}/_rejects").collect()
    assert len(rejects) == 2 and '"no object"' in {r["body"] for r in rejects}
    bad = spark.createDataFrame([(0, '{"success":false}')], "page long, value string")
    with pytest.raises(Exception, match="unreadable page"):
        sync_entity(spark, scan_pages(bad, page_col="page"), ent, root, run_id="b8")
    log = {r["run_id"]: r for r in spark.read.parquet(f"{root}/_run_log").collect()}
    assert len(log) == 2 and log["b8"]["failed"] and not log["b7"]["failed"] and log["b7"]["rows"] == 3
    assert read_synced(spark, root, ent).count() == 1
