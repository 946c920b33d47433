"""Segment tables: deltas against a model, commits that fail or collide, plans, statistics."""

import datetime as dt
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from dealwise.operators import segments as G
from dealwise.operators.upsert import merge_frames

UTC = dt.timezone.utc


def new_path():
    return os.path.join(tempfile.mkdtemp(prefix="dw-test-"), "t")


def content(spark, path, version=None):
    df = G.read_table_at(spark, path, version)
    return {r["id"]: {c: r[c] for c in df.columns if c != "id"} for r in df.collect()}


def test_random_keys_write_little_and_read_like_a_rewrite(spark):
    path = new_path()
    rows = spark.range(200_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"))
    G.create_table(spark, path, rows, ["id"], 16)
    batch = spark.range(200_000).where(F.xxhash64("id") % 500 == 0).select("id", F.lit("new").alias("v"))
    n = batch.count()
    assert 200 < n < 600  # 0.2 % of the keys, in every bucket
    G.upsert_table(spark, path, batch, ["id"])
    base, delta = G.read_manifest(spark, path).segments
    assert delta.rows == n and delta.bytes < 0.01 * base.bytes
    want, got = merge_frames(rows, batch, ["id"]), G.read_table_at(spark, path)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_batches_against_a_model(spark, seed):
    """Updates, missing and new columns, NULLs, inserts and merges in any order."""
    rng, path, model = random.Random(seed), new_path(), {}
    cols = ["a", "b", "c"]
    for step in range(9):
        have = cols if step == 0 else rng.sample(cols, rng.randrange(1, 4))
        rows = {k: {c: rng.choice([None, f"{step}.{k}"]) for c in have} for k in rng.sample(range(30), rng.randrange(0, 15))}
        insert = step and rng.random() < 0.3
        df = spark.createDataFrame([(k, *[r[c] for c in have]) for k, r in rows.items()],
                                   "id long, " + ", ".join(f"{c} string" for c in have))
        G.upsert_table(spark, path, df, ["id"], buckets=3, insert_only=insert, compact=rng.random() < 0.5)
        for k, r in rows.items():
            if k not in model:
                model[k] = {c: None for c in cols} | r
            elif not insert:
                model[k].update(r)
        if rng.random() < 0.2:
            G.compact_table(spark, path, full=True)
    assert content(spark, path) == model
    G.compact_table(spark, path, full=True)
    assert content(spark, path) == model and len(G.read_manifest(spark, path).segments) == 1


def test_a_writer_that_dies_leaves_the_old_version(spark, monkeypatch):
    path = new_path()
    G.create_table(spark, path, spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string"), ["id"], 2)
    old = content(spark, path)

    def die(*_):
        raise RuntimeError("killed before the rename")

    for step in (lambda: G.upsert_table(spark, path, spark.createDataFrame([(1, "x")], "id long, v string"), ["id"]),
                 lambda: G.rebucket_table(spark, path, 4),
                 lambda: G.create_table(spark, path, spark.createDataFrame([(9, "z")], "id long, v string"), ["id"], 2)):
        with monkeypatch.context() as m:
            m.setattr(G, "rename_new", die)
            with pytest.raises(RuntimeError):
                step()
        assert content(spark, path) == old and G.read_manifest(spark, path).buckets == 2
    G.upsert_table(spark, path, spark.createDataFrame([(1, "y"), (3, "c")], "id long, v string"), ["id"])
    assert {k: r["v"] for k, r in content(spark, path).items()} == {1: "y", 2: "b", 3: "c"}


@pytest.mark.parametrize("insert", [False, True])
def test_a_writer_that_comes_second_starts_over(spark, monkeypatch, insert):
    """Another writer commits between this writer's job and its rename."""
    path = new_path()
    G.create_table(spark, path, spark.createDataFrame([(1, "a")], "id long, v string"), ["id"], 2)
    real, first = G.publish, []

    def late(spark_, path_, manifest):
        if not first:
            first.append(True)
            G.upsert_table(spark, path, spark.createDataFrame([(1, "other"), (2, "other")], "id long, v string"), ["id"])
        return real(spark_, path_, manifest)

    monkeypatch.setattr(G, "publish", late)
    G.upsert_table(spark, path, spark.createDataFrame([(2, "mine"), (3, "mine")], "id long, v string"), ["id"], insert_only=insert)
    assert {k: r["v"] for k, r in content(spark, path).items()} == {1: "other", 2: "other" if insert else "mine", 3: "mine"}


def test_two_first_batches_both_stay(spark, monkeypatch):
    path, real, first = new_path(), G.publish, []

    def late(spark_, path_, manifest):
        if not first:
            first.append(True)
            G.upsert_table(spark, path, spark.createDataFrame([(1, "other")], "id long, v string"), ["id"], buckets=2)
        return real(spark_, path_, manifest)

    monkeypatch.setattr(G, "publish", late)
    G.upsert_table(spark, path, spark.createDataFrame([(2, "mine")], "id long, v string"), ["id"], buckets=2)
    assert set(content(spark, path)) == {1, 2}


def test_readers_keep_their_version(spark):
    path = new_path()
    G.create_table(spark, path, spark.range(50).select("id", F.lit("old").alias("v")), ["id"], 2)
    reader = G.read_table_at(spark, path)
    for k in range(6):
        G.upsert_table(spark, path, spark.range(k, k + 40).select("id", F.lit(f"new{k}").alias("v")), ["id"])
    G.compact_table(spark, path, full=True)
    assert {r["v"] for r in reader.collect()} == {"old"} and reader.count() == 50
    now = content(spark, path)
    gone = G.vacuum_table(spark, path, keep=1)
    assert gone and content(spark, path) == now and len(G.versions(spark, path)) == 1
    assert len([n for n in os.listdir(path) if n.startswith("seg=")]) == 1


def test_merge_moves_only_the_batch(spark):
    """With more shuffle partitions than buckets, still no exchange of the table."""
    path = new_path()
    G.create_table(spark, path, spark.range(1000).select("id", F.lit("a").alias("v")), ["id"], 4)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        G.upsert_table(spark, path, spark.range(5).select("id", F.lit("b").alias("v")), ["id"])
        G.upsert_table(spark, path, spark.range(3).select("id", F.lit("c").alias("v")), ["id"])
        plan = G.read_table_at(spark, path)._jdf.queryExecution().executedPlan().toString()
        merge = plan[plan.index("SortMergeJoin"):]
        target = merge[:merge.index("Bucketed: true")]
        assert "Exchange" not in target and "seg_base" in target, plan
        assert "Exchange" not in plan[:plan.index("SortMergeJoin")]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    G.compact_table(spark, path, full=True)
    base = G.read_manifest(spark, path).segments[0]
    files = [f for f in os.listdir(f"{path}/seg={base.name}") if f.endswith(".parquet")]
    assert len(files) == 4  # one file a bucket: the join's rows were written as they were dealt


def test_new_session_reads_the_buckets(spark):
    path = new_path()
    G.create_table(spark, path, spark.range(10).select("id", F.lit("a").alias("v w")), ["id"], 2)
    spark.sql(f"DROP TABLE {G._table(G.read_manifest(spark, path).segments[0].name)}")  # as a new catalogue
    df = G.read_table_at(spark, path)
    assert df.count() == 10 and df.columns == ["id", "v w"]
    assert "Bucketed: true" in df._jdf.queryExecution().executedPlan().toString() or "seg_base" in \
        df._jdf.queryExecution().executedPlan().toString()


def test_type_change_rewrites_nothing(spark):
    path = new_path()
    G.create_table(spark, path, spark.createDataFrame([(1, 5), (2, 6)], "id long, n int"), ["id"], 2)
    base = G.read_manifest(spark, path).segments[0]
    report = G.upsert_table(spark, path, spark.createDataFrame([(2, "x"), (3, "7")], "id int, n string"), ["id"])
    assert report["changed"] == ["n"] and G.read_manifest(spark, path).segments[0] == base
    assert {k: r["n"] for k, r in content(spark, path).items()} == {1: "5", 2: "x", 3: "7"}
    G.compact_table(spark, path, full=True)
    assert dict(G.read_table_at(spark, path).dtypes) == {"id": "bigint", "n": "string"}


def test_ledger_applies_a_batch_once(spark):
    path, asked = new_path(), []
    schema = "id string, v string"
    for again in range(2):
        df = spark.createDataFrame([("1", "a"), ("2", "b"), (None, "c")], schema)
        r = G.upsert_table(spark, path, df, ["id"], flow="f", batch_id="7", note=lambda: asked.append(1) or {"seen": 3})
        assert r["seen"] == 3 and r["rejected_keys"] == 1 and bool(r.get("replayed")) == bool(again)
    G.upsert_table(spark, path, spark.createDataFrame([("1", "other flow")], schema), ["id"], flow="g", batch_id="7")
    assert len(asked) == 1 and content(spark, path)["1"]["v"] == "other flow"
    assert spark.read.parquet(f"{path}__rejects").count() == 1


def test_rows_set_aside_come_from_the_same_job(spark):
    path, got = new_path(), []
    df = spark.createDataFrame([(1, "a", None, 1), (1, "b", None, 2), (None, None, "{broken", 3), (None, None, "{broken", 4)],
                               "id long, v string, wrong string, pos int")
    G.upsert_table(spark, path, df, ["id"], order=["pos"], drop=["pos"], aside="wrong",
                   set_aside=lambda r: got.extend(x["body"] for x in r.collect()))
    assert got == ["{broken"] * 2 and content(spark, path) == {1: {"v": "b"}}
    assert not os.path.exists(f"{path}__rejects")


def test_freshness_needs_no_job_and_old_segments_no_scan(spark):
    path = new_path()
    day = [dt.datetime(2024, 1, d, tzinfo=UTC) for d in range(1, 29)]
    G.create_table(spark, path, spark.createDataFrame([(i, day[i]) for i in range(10)], "id long, t timestamp"), ["id"], 2)
    G.upsert_table(spark, path, spark.createDataFrame([(3, day[20]), (50, day[25])], "id long, t timestamp"), ["id"])
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("freshness", "")
    try:
        assert G.changed_since(spark, path, ["t", "no such"], day[25]) and not G.changed_since(spark, path, ["t"], day[26])
        assert not tracker.getJobIdsForGroup("freshness")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    late = G.read_table_at(spark, path, since=("t", day[15]))
    assert {r["id"] for r in late.where(F.col("t") >= F.lit(day[15])).collect()} == {3, 50}
    assert all("seg=delta" in f for f in late.inputFiles())
    assert G.read_table_at(spark, path, since=("t", day[5])).count() == 11


def test_rows_without_a_time_are_always_read(spark):
    path = new_path()
    G.create_table(spark, path, spark.createDataFrame([(1, None)], "id long, t timestamp"), ["id"], 2)
    G.upsert_table(spark, path, spark.createDataFrame([(2, dt.datetime(2024, 1, 1))], "id long, t timestamp"), ["id"])
    assert G.read_table_at(spark, path, since=("t", dt.datetime(2023, 1, 1))).count() == 2


def test_many_small_batches_stay_few_segments(spark):
    path = new_path()
    G.create_table(spark, path, spark.range(20_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v")), ["id"], 2)
    for k in range(10):
        G.upsert_table(spark, path, spark.createDataFrame([(k, f"n{k}")], "id long, v string"), ["id"])
    assert len(G.read_manifest(spark, path).segments) <= G.FANOUT + 1
    got = {r["id"]: r["v"] for r in G.read_table_at(spark, path).where("id < 10").collect()}
    assert got == {k: f"n{k}" for k in range(10)}


def test_the_latest_version_is_probed_and_not_listed(spark, monkeypatch):
    path, listed, names = new_path(), [], G.list_names
    rows = spark.range(3).select("id", F.lit("a").alias("v"))
    G.create_table(spark, path, rows, ["id"], 1)
    G.read_manifest(spark, path)
    monkeypatch.setattr(G, "list_names", lambda *a: listed.append(a) or names(*a))
    for _ in range(3):
        G.upsert_table(spark, path, rows, ["id"], compact=False)
    assert G.read_manifest(spark, path).version == 4 and not listed
    G._SEEN[path] = 1  # another process wrote the versions since
    assert G.read_manifest(spark, path).version == 4 and not listed
    G.vacuum_table(spark, path, keep=1)
    G._SEEN[path] = 1  # and removed the one that was seen
    assert G.read_manifest(spark, path).version == 4
    assert G.read_manifest(spark, new_path()) is None
