"""Stage history, pending work, incremental state and paged sources."""

import datetime as dt
import json
import os
import tempfile

from pyspark.sql import functions as F

from dealwise.operators import history as H
from dealwise.sources.paged import walk_cursor, walk_offset
from dealwise.streaming import state as S
from dealwise.streaming.backfill import history_run, stream_backfill


def pages_of(spark, deal_items):
    data = [(d, 0, [json.dumps(i) for i in items]) for d, items in deal_items.items()]
    return spark.createDataFrame(data, "deal_id long, page long, items array<string>")


def test_stage_changes_both_layouts_and_falsy(spark):
    items = [
        {"timestamp": "2024-01-01 00:00:00", "data": {"field_key": "stage_id", "new_value": "5", "user_id": 1}},
        {"timestamp": "2024-01-02 00:00:00", "data": {"user_id": 2, "details": {"field_key": "stage_id", "new_value": 6}}},
        {"timestamp": "2024-01-03 00:00:00", "data": {"field_key": "stage_id", "new_value": None}},
        {"timestamp": "2024-01-03 00:00:00", "data": {"field_key": "stage_id", "new_value": 0}},
        {"timestamp": "2024-01-03 00:00:00", "data": {"field_key": "stage_id", "new_value": ""}},
        {"timestamp": "2024-01-03 00:00:00", "data": {"field_key": "title", "new_value": 9}},
        {"timestamp": "2024-01-04 00:00:00", "data": {"field_key": "stage_id", "new_value": "abc"}},
    ]
    ch, rej = H.stage_changes(H.change_items(pages_of(spark, {7: items})), with_rejects=True)
    assert sorted((r.stage_id, r.user_id) for r in ch.collect()) == [(5, 1), (6, 2)]
    assert rej.count() == 1


def test_keep_last_per_stage(spark):
    items = [{"timestamp": t, "field_key": "stage_id", "new_value": s}
             for t, s in [("2024-01-01 00:00:00", 5), ("2024-01-02 00:00:00", 6), ("2024-01-03 00:00:00", 5)]]
    latest = H.latest_per_stage(H.stage_changes(H.change_items(pages_of(spark, {1: items}))))
    got = sorted((r.stage_id, r.change_time.day) for r in latest.collect())
    assert got == [(5, 3), (6, 2)]


def test_sentinels_and_history_run(spark):
    deals = spark.createDataFrame([(1, 4, dt.datetime(2024, 1, 1)), (2, None, dt.datetime(2024, 1, 2)),
                                   (3, 8, dt.datetime(2024, 1, 3))], "id long, stage_id long, add_time timestamp")
    items = {3: [{"timestamp": "2024-02-01 00:00:00", "field_key": "stage_id", "new_value": 9}]}
    done = spark.createDataFrame([], "deal_id long")
    out = history_run(deals, pages_of(spark, items), done, budget=10)
    got = sorted((r.deal_id, r.stage_id, r.user_id) for r in out.collect())
    assert got == [(1, 4, None), (3, 9, None)]
    # a later run with the first run recorded as done has nothing to do
    again = history_run(deals, pages_of(spark, items), out.select("deal_id"), budget=10)
    assert again.count() == 0


def test_watermark_and_modes(spark):
    assert S.compute_updated_since(None) == (None, True)
    last = dt.datetime(2024, 1, 1, 12, 0, 0, tzinfo=dt.timezone.utc)
    assert S.compute_updated_since(last) == ("2024-01-01T11:59:55Z", False)
    assert S.decide_sync_mode(None, "v2", True)[0] == "FULL"
    assert S.decide_sync_mode(last, "v1", True)[0] == "FULL"
    assert S.decide_sync_mode(last, "v2", True) == ("INCREMENTAL", last - dt.timedelta(seconds=5))
    assert S.decide_sync_mode(last, "v2", False)[0] == "SKIP"
    root = tempfile.mkdtemp(prefix="dw-state-")
    assert S.get_watermark(spark, root, "deals") is None
    S.set_watermark(spark, root, "deals", last)
    S.set_watermark(spark, root, "deals", last + dt.timedelta(hours=1))
    assert S.get_watermark(spark, root, "deals") == last + dt.timedelta(hours=1)
    S.save_sync_state(spark, root, "activities", 500, False)
    assert S.get_sync_state(spark, root, "activities") == (500, False)


def test_offset_walk_semantics():
    book = {0: {"data": [1, 2], "additional_data": {"pagination": {"more_items_in_collection": True}}},
            2: {"data": [3], "additional_data": {"pagination": {"more_items_in_collection": True,
                                                                 "next_start": 10}}},
            10: {"data": [], "additional_data": {"pagination": {"more_items_in_collection": True}}}}
    rows = list(walk_offset(lambda ep, p: book[p["start"]], "/x", {}, 0, None))
    assert [x for r in rows for x in json.loads(r[2])["data"]] == [1, 2, 3]
    chain = {None: {"data": [1], "additional_data": {"next_cursor": "b"}}, "b": {"data": [2], "additional_data": {}}}
    rows = list(walk_cursor(lambda ep, p: chain[p.get("cursor")], "/x", {}, None))
    assert [x for r in rows for x in json.loads(r[2])["data"]] == [1, 2]


def test_stream_backfill_resumes_from_checkpoint(spark):
    root = tempfile.mkdtemp(prefix="dw-stream-")
    seen = []
    spark.createDataFrame([(str(i),) for i in range(4)], "value string").repartition(2) \
        .write.text(os.path.join(root, "land", "a"))
    handle = lambda df, bid: seen.extend(r.value for r in df.collect())
    n1 = stream_backfill(spark, os.path.join(root, "land", "*"), "value string", handle,
                         os.path.join(root, "ckpt"), files_per_batch=1, fmt="text")
    spark.createDataFrame([("9",)], "value string").write.text(os.path.join(root, "land", "b"))
    stream_backfill(spark, os.path.join(root, "land", "*"), "value string", handle,
                    os.path.join(root, "ckpt"), files_per_batch=1, fmt="text")
    assert n1 >= 2 and sorted(seen) == ["0", "1", "2", "3", "9"]


def test_paged_stream_drains_in_budgeted_runs(spark):
    from dealwise.sources.pages import build_page_landing, scan_pages, write_keyed_landing
    from dealwise.sources.paged import register_sources
    from dealwise.streaming.backfill import drain_paged_stream
    root = tempfile.mkdtemp(prefix="dw-paged-")
    recs = spark.range(0, 2300).select(F.col("id"), (F.col("id") * 2).alias("v"))
    write_keyed_landing(build_page_landing(recs, "id", 500), os.path.join(root, "land"))
    register_sources(spark)
    seen = []

    def handle(df, bid):
        seen.extend(r.id for r in scan_pages(df, "body").select(
            F.try_variant_get("record", "$.id", "bigint").alias("id")).collect())

    runs = drain_paged_stream(spark, "offset_pages", {"landing": os.path.join(root, "land"),
                                                      "maxRowsPerBatch": "1000"},
                              handle, os.path.join(root, "ckpt"))
    assert runs == 3  # whole pages: 1000 + 1000 + 300 rows
    assert sorted(seen) == list(range(2300))


def test_sync_entity_keeps_rejects_and_logs_the_run(spark):
    from dealwise.operators.runlog import flow_counters
    from dealwise.operators.validate import FieldRule
    from dealwise.plans.sync import Entity, read_synced, sync_entity
    from dealwise.sources.pages import scan_pages
    root = tempfile.mkdtemp(prefix="dw-sync-")
    page = json.dumps({"data": [{"id": 1, "dealTitle": "a"}, {"dealTitle": "no id"},
                                {"id": "x", "dealTitle": "bad id"}, {"id": 2, "dealTitle": "b"}]})
    pages = spark.createDataFrame([(0, page)], "page long, value string")
    ent = Entity(name="t", table="t", pk=("id",), order=None,
                 fields=(FieldRule("id", "bigint", True), FieldRule("deal_title", "string")))
    rep = sync_entity(spark, scan_pages(pages, page_col="page"), ent, root)
    assert rep["counts"] == {"records": 4, "invalid": 2}
    assert sorted((r.id, r.deal_title) for r in read_synced(spark, root, ent).collect()) == [(1, "a"), (2, "b")]
    rej = spark.read.parquet(os.path.join(root, "_rejects")).collect()
    assert sorted(tuple(r.errors) for r in rej) == [("id:bigint",), ("id:missing",)]
    log = flow_counters(spark.read.parquet(os.path.join(root, "_run_log")).withColumnRenamed("invalid_rows", "invalid_rows"))
    row = log.first()
    assert row.flow == "t" and row.rows_processed == 4 and row.invalid_rows == 2


def _page(spark, recs):
    from dealwise.sources.pages import scan_pages
    return scan_pages(spark.createDataFrame([(0, json.dumps({"data": recs}))], "page long, value string"),
                      page_col="page")


def test_incremental_after_full_equals_full(spark):
    from dealwise.operators.validate import FieldRule
    from dealwise.plans.sync import Entity, read_synced, sync_entity
    ent = Entity(name="e", table="e", pk=("id",),
                 fields=(FieldRule("id", "bigint", True), FieldRule("v", "string"),
                         FieldRule("update_time", "string")))
    v1 = [{"id": i, "v": f"a{i}", "updateTime": "2024-01-01 00:00:00"} for i in range(10)]
    v2 = [dict(r, v=f"b{r['id']}", updateTime="2024-02-01 00:00:00") if r["id"] % 3 == 0 else r for r in v1]
    v2.append({"id": 99, "v": "new", "updateTime": "2024-02-01 00:00:00"})
    inc_root, full_root = tempfile.mkdtemp(prefix="dw-inc-"), tempfile.mkdtemp(prefix="dw-full-")
    sync_entity(spark, _page(spark, v1), ent, inc_root)
    since, full = S.compute_updated_since(dt.datetime(2024, 1, 15, tzinfo=dt.timezone.utc))
    rep = sync_entity(spark, _page(spark, v2), ent, inc_root, since=since)
    assert not full and len(rep["touched"]) <= 5       # only the changed keys' buckets
    sync_entity(spark, _page(spark, v2), ent, full_root)
    key = lambda r: (r.id, r.v, r.update_time)
    assert sorted(map(key, read_synced(spark, inc_root, ent).collect())) == \
        sorted(map(key, read_synced(spark, full_root, ent).collect()))


def test_history_backfill_in_runs_equals_one_run(spark):
    deals = spark.createDataFrame([(i, i % 4, dt.datetime(2024, 1, 1 + i)) for i in range(1, 8)],
                                  "id long, stage_id long, add_time timestamp")
    items = {i: [{"timestamp": f"2024-02-0{i} 00:00:00", "field_key": "stage_id", "new_value": 10 + i}]
             for i in (2, 5, 7)}
    pages = pages_of(spark, items)
    empty = spark.createDataFrame([], "deal_id long")
    once = history_run(deals, pages, empty, budget=100).collect()
    done, runs = empty, []
    for _ in range(4):   # budget 2 -> four runs cover seven deals
        out = history_run(deals, pages, done, budget=2).cache()
        runs.extend(out.collect())
        done = done.unionByName(out.select("deal_id"))
    key = lambda r: (r.deal_id, r.stage_id, r.change_time)
    assert sorted(map(key, runs)) == sorted(map(key, once))


def test_history_flow_writes_until_no_deal_is_left(spark):
    from dealwise.operators.segments import read_table_at
    from dealwise.streaming.backfill import HISTORY, history_flow
    root = tempfile.mkdtemp(prefix="dw-history-")
    deals = spark.createDataFrame([(i, None if i in (3, 5) else i % 4, dt.datetime(2024, 1, 1 + i)) for i in range(1, 8)],
                                  "id long, stage_id long, add_time timestamp")
    items = {i: [{"timestamp": f"2024-02-0{i} 00:00:00", "field_key": "stage_id", "new_value": 10 + i},
                 {"timestamp": f"2024-03-0{i} 00:00:00", "field_key": "stage_id", "new_value": "n/a"}] for i in (2, 5, 7)}
    pages = pages_of(spark, items)
    logs = []
    for k in range(9):
        log = history_flow(spark, deals, pages, root, 3, f"r{k}")
        if log is None:
            break
        logs.append(log)
    got = {(r.deal_id, r.stage_id) for r in read_table_at(spark, f"{root}/{HISTORY}").collect()}
    assert got == {(2, 12), (5, 15), (7, 17), (1, 1), (4, 0), (6, 2)}  # 3 has no stage and no change
    assert [x["deals"] for x in logs] == [3, 3, 1] and sum(x["rejected_changes"] for x in logs) == 3
    assert sum(x["change_rows"] for x in logs) == 3 and sum(x["deals_without_changes"] for x in logs) == 3
    assert spark.read.parquet(f"{root}/_history_rejects").select("raw_value").distinct().collect()[0][0] == "n/a"


def test_change_log_is_decoded_once(spark):
    from dealwise.operators.history import change_items, change_summary
    pages = pages_of(spark, {1: [{"timestamp": "2024-01-01", "field_key": "stage_id", "new_value": 4}]})
    plan = change_summary(change_items(pages))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate") == 1 and plan.count("parse_json") <= 1


def test_sync_transform_is_compiled_at_any_width(spark):
    """A generator over a hundred columns is evaluated expression by expression; projections are compiled."""
    from dealwise.entities import ACTIVITIES
    from dealwise.plans.sync import transform
    records = spark.sql("""SELECT 0L AS page, 0 AS ordinal, parse_json('{"id": 1, "dealId": "2", "dueDate": "x"}') AS record""")
    rows = transform(records, ACTIVITIES)
    assert "Generate" not in rows._jdf.queryExecution().optimizedPlan().toString()
    row = rows.first()
    assert (row["id"], row["deal_id"], row["due_date"], row["done"], row["active_flag"]) == (1, 2, None, False, True)
    assert json.loads(row["__invalid"])["errors"] == ["due_date:date"]


def test_a_large_budget_is_cut_by_ranges(spark):
    """Same rows as one global sort, also over ties, NULL times and a budget beyond the table."""
    from dealwise.operators.pending import newest_first, newest_stored
    df = spark.range(5000).select("id", F.when(F.col("id") % 11 != 0, F.col("id") % 300).alias("t"))
    for budget in (1, 700, 2500, 4999, 5000, 9000):
        want = newest_first(df, budget, [F.col("t")], ["id"]).collect()
        got = newest_stored(df, budget, [F.col("t")], ["id"], "test-newest", one_task=0)
        assert sorted(r.id for r in got.collect()) == sorted(r.id for r in want)


def test_a_records_keys_are_renamed_together(spark):
    """Same names as key by key, also with odd keys; only keys that hold the separator go one by one."""
    from dealwise.plans.sync import CAMEL, KEY_END, snake_keys
    records = [{"id": 1, "dealId": 2, "Title": 3, "aID": 4, "x Y": 5, "": 6}, {"éTat": 1, "ΟΔΟΣ": 2, "_B": 3, "a\nB": 4}, {},
               {"a" + KEY_END + "B": 1, "cD": 2}, {KEY_END: 1}, {"": 1}, {"Z": None}, [1], None]
    df = spark.createDataFrame([(json.dumps(r),) for r in records], "j string").select(F.parse_json("j").alias("r"))
    one = F.transform_keys(F.try_variant_get("r", "$", "map<string,variant>"), lambda k, _: F.lower(F.regexp_replace(k, CAMEL, "_")))
    for r in df.select(F.to_json(snake_keys(F.col("r"))).alias("got"), F.to_json(one).alias("want")).collect():
        assert r["got"] == r["want"]
    plan = df.select(snake_keys(F.col("r")))._jdf.queryExecution().optimizedPlan().toString()
    assert "map_from_arrays" in plan


def test_keys_beyond_the_rules_are_looked_for_only_where_there_are_some(spark):
    """Custom and unknown keys are kept as before; a record of nothing but fields is told by counting."""
    from dataclasses import replace
    from dealwise.entities import ACTIVITIES
    from dealwise.operators.validate import validate_stage
    from dealwise.plans.sync import EXTRAS, transform
    from dealwise.spec import FieldMeta
    bodies = ['{"id": 1, "dealId": 2, "subject": null}', '{"id": 2, "k1": "a", "other": 5}',
              '{"id": 3, "customFields": {"k1": "b", "more": 1}}', '{"id": 4, "k1": "c", "custom_fields": {"k1": "d"}}', "[1]"]
    df = spark.createDataFrame([(0, i, b) for i, b in enumerate(bodies)], "page long, ordinal int, j string")
    records = df.select("page", "ordinal", F.parse_json("j").alias("record"))
    rows = transform(records, replace(ACTIVITIES, custom_fields=(FieldMeta("k1", "Origem", "varchar"),)))
    got = {r["ordinal"]: (r["id"], r["origem_text"], r[EXTRAS]) for r in rows.collect()}
    assert got == {0: (1, None, None), 1: (2, "a", '{"other":5}'), 2: (3, "b", '{"more":1}'), 3: (4, "d", None), 4: (None, None, None)}
    maps = records.select("ordinal", F.try_variant_get("record", "$", "map<string,variant>").alias("m"))
    rules = [f for f in ACTIVITIES.fields if f.name == "id"]
    staged = validate_stage(maps, "m", rules, keep=("ordinal",), filtered=False, more="more")
    assert [r["more"] for r in staged.orderBy("ordinal").collect()] == [True, True, True, True, False]
