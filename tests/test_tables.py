"""Upsert, evolution and enrichment: golden rows and properties."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from dealwise.operators import evolve as E
from dealwise.operators import upsert as U
from dealwise.operators.enrich import enrich
from dealwise.spec import LookupSpec


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_partial_upsert_null_overwrites(spark):
    t = spark.createDataFrame([(1, "a", "k"), (2, "b", "k")], "id long, v string, z string")
    s = spark.createDataFrame([(2, None), (3, "c")], "id long, v string")
    out = U.merge_frames(t, s, ["id"])
    assert rows(out, "id", "v", "z") == [(1, "a", "k"), (2, None, "k"), (3, "c", None)]


def test_upsert_idempotent_and_split(spark):
    t = spark.createDataFrame([(i, f"t{i}") for i in range(10)], "id long, v string")
    s = spark.createDataFrame([(i, f"s{i}") for i in range(5, 15)], "id long, v string")
    once = U.merge_frames(t, s, ["id"])
    twice = U.merge_frames(once, s, ["id"])
    assert rows(once, "id", "v") == rows(twice, "id", "v")
    # insert-only ∪ update-only == upsert
    upd = s.join(t.select("id"), "id", "left_semi")
    new = s.join(t.select("id"), "id", "left_anti")
    both = U.insert_new_only(U.merge_frames(t, upd, ["id"]), new, ["id"])
    assert rows(both, "id", "v") == rows(once, "id", "v")


def test_latest_row_per_key_wins(spark):
    t = spark.createDataFrame([], "id long, v string, update_time timestamp")
    s = spark.createDataFrame([(1, "old", dt.datetime(2024, 1, 1)), (1, "new", dt.datetime(2024, 1, 2))],
                              "id long, v string, update_time timestamp")
    assert rows(U.merge_frames(t, s, ["id"]), "id", "v") == [(1, "new")]


def test_bucketed_table_upsert_touches_only_needed_buckets(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="dw-test-"), "t")
    base = spark.createDataFrame([(i, f"v{i}") for i in range(100)], "id long, v string")
    U.create_table(spark, path, base, ["id"], buckets=8)
    src = spark.createDataFrame([(3, "x"), (200, "y")], "id long, v string")
    rep = U.upsert_table(spark, path, src, ["id"], buckets=8, order=[F.lit(0)])
    assert len(rep["touched"]) <= 2
    got = dict(rows(U.read_table_at(spark, path), "id", "v"))
    assert len(got) == 101 and got[3] == "x" and got[200] == "y" and got[4] == "v4"
    # the same batch again changes nothing (idempotent foreachBatch)
    U.upsert_table(spark, path, src, ["id"], buckets=8, order=[F.lit(0)])
    assert dict(rows(U.read_table_at(spark, path), "id", "v")) == got


def test_schema_evolution_add_and_type_change(spark):
    t = spark.createDataFrame([(1, 5)], "id long, n int")
    s = spark.createDataFrame([(2, "x", 1.5)], "id long, n string, extra double")
    out = U.merge_frames(t, s, ["id"])
    assert dict(out.dtypes)["n"] == "string" and "extra" in out.columns
    assert rows(out, "id", "n", "extra") == [(1, "5", None), (2, "x", 1.5)]


def test_drop_null_columns_keeps_protected(spark):
    df = spark.createDataFrame([(1, None, [], None)], "id long, a string, b array<string>, pk2 long")
    out, dropped = E.drop_null_columns(df, protected=("id", "pk2"))
    assert out.columns == ["id", "pk2"] and set(dropped) == {"a", "b"}


def test_enrich_keeps_previous_label_when_unmatched(spark):
    deals = spark.createDataFrame([(1, 10, "old"), (2, 99, "old")], "id long, stage_id long, stage_name string")
    stages = spark.createDataFrame([(10, "Won")], "id long, title string")
    out = enrich(deals, [LookupSpec("stage_id", "stages", "stage_name")], {"stages": stages})
    assert rows(out, "id", "stage_name") == [(1, "Won"), (2, "old")]
