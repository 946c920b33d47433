"""Paged sources: error payloads, page ranges, ends that move, split chains, routes."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from dealwise.sources import details as D
from dealwise.sources import paged as PG
from dealwise.sources import saved_pages
from dealwise.sources.pages import build_page_landing, scan_pages, write_keyed_landing
from dealwise.sources.routes import register_route
from dealwise.streaming.backfill import drain_paged_stream
from dealwise.streaming.state import get_sync_state

BAD = [{"success": False, "error": "rate limit"}, {"success": True, "data": {"id": 1}}, {"data": "x"}, ["no object"]]


def api(n, bad_at=None, bad=None):
    """An offset API over the records 0..n-1, with an error payload in the middle."""
    def fetch(endpoint, params):
        start, limit = int(params["start"]), int(params["limit"])
        if bad_at is not None and start >= bad_at:
            return bad
        return {"success": True, "data": list(range(start, min(start + limit, n))) or None,
                "additional_data": {"pagination": {"more_items_in_collection": start + limit < n}}}
    return fetch


@pytest.mark.parametrize("bad", BAD)
def test_an_error_payload_fails_every_walk(bad):
    with pytest.raises(ValueError, match="unreadable page"):
        list(PG.walk_offset(api(50, 20, bad), "/x", {"limit": 10}, 0, None))
    chain = {None: {"data": [1], "additional_data": {"next_cursor": "b"}}, "b": bad}
    with pytest.raises(ValueError, match="unreadable page"):
        list(PG.walk_cursor(lambda ep, p: chain[p.get("cursor")], "/x", {}, None))
    with pytest.raises(ValueError, match="unreadable page"):
        list(D.walk_details(lambda k, s: api(50, 20, bad)("", {"start": s, "limit": 10}), 7, page_size=10))
    with pytest.raises(ValueError, match="unreadable page"):
        PG.collection_end(api(50, 20, bad), "/x", {"limit": 10}, 0, None)


def test_null_data_is_an_empty_page():
    assert list(PG.walk_offset(lambda ep, p: {"success": True, "data": None}, "/x", {}, 0, None)) == []


def test_collection_end_brute():
    for n in (0, 1, 9, 10, 11, 57, 100, 101):
        for start in (0, 5, 10, 56, 57, 200):
            for until in (None, 0, 7, 30, 57, 300):
                want = max(start, min(n, n if until is None else until))
                calls = []
                fetch = api(n)
                got = PG.collection_end(lambda e, p: calls.append(1) or fetch(e, p), "/x", {"limit": 10}, start, until)
                assert got == want, (n, start, until)
                assert len(calls) <= 12


def test_ranges_meet_and_respect_the_end():
    for start, end in ((0, 57), (5, 57), (20, 40), (33, 34)):
        parts = PG._ranges("/x", start, end, 10, 2)
        got = [x for p in parts for r in PG.walk_offset(api(1000), "/x", {"limit": 10}, p.start, p.end)
               for x in json.loads(r[2])["data"]]
        assert got == list(range(start, end))


def records(spark, n):
    return spark.range(n).select("id", (F.col("id") * 2).alias("v"))


def ids(df):
    return [r["id"] for r in scan_pages(df, "body").select(F.try_variant_get("record", "$.id", "bigint").alias("id")).collect()]


def test_stream_replays_the_same_range_and_sees_later_pages(spark):
    root = tempfile.mkdtemp(prefix="dw-paged-")
    land, ckpt = os.path.join(root, "land"), os.path.join(root, "ckpt")
    write_keyed_landing(build_page_landing(records(spark, 1300), "id", 500), land)
    PG.register_sources(spark)
    seen, fail, parts = [], [True], []

    def handle(df, bid):
        got = ids(df)
        parts.append(df.rdd.getNumPartitions())
        if bid == 1 and fail:
            fail.clear()
            raise RuntimeError("executor lost")
        seen.append((bid, sorted(got)))

    options = {"landing": land, "maxRowsPerBatch": "1000", "pagesPerTask": "1"}
    state = (os.path.join(root, "state"), "orders")
    with pytest.raises(Exception, match="executor lost"):
        drain_paged_stream(spark, "offset_pages", options, handle, ckpt, state)
    assert get_sync_state(spark, *state) == (1000, False)
    drain_paged_stream(spark, "offset_pages", options, handle, ckpt, state)
    assert seen == [(0, list(range(1000))), (1, list(range(1000, 1300)))]
    assert parts[0] == 2  # page ranges are tasks; no row goes through the driver
    assert get_sync_state(spark, *state) == (1300, True)
    write_keyed_landing(build_page_landing(records(spark, 2100), "id", 500), land)  # the collection grows, its last page too
    drain_paged_stream(spark, "offset_pages", options, handle, ckpt, state)
    assert sorted(x for _, got in seen for x in got) == list(range(2100))


def test_lost_state_names_the_same_end_again(spark):
    """The batch is committed but the state behind it is not saved: nothing comes twice."""
    root = tempfile.mkdtemp(prefix="dw-paged-")
    land, ckpt = os.path.join(root, "land"), os.path.join(root, "ckpt")
    write_keyed_landing(build_page_landing(records(spark, 900), "id", 500), land)
    PG.register_sources(spark)
    seen = []
    for k in range(2):
        drain_paged_stream(spark, "offset_pages", {"landing": land}, lambda df, b: seen.extend(ids(df)), ckpt,
                           (os.path.join(root, f"state{k}"), "orders"))
    assert sorted(seen) == list(range(900))


def test_batch_reads_hold_one_page(spark):
    root = tempfile.mkdtemp(prefix="dw-paged-")
    write_keyed_landing(build_page_landing(records(spark, 2300), "id", 500), os.path.join(root, "o"))
    write_keyed_landing(build_page_landing(records(spark, 2300), "id", 500, cursor=True), os.path.join(root, "c"))
    register_route("/savedOffsets", "v1", 1)
    offsets = PG.read_route(spark, "/savedOffsets", landing=os.path.join(root, "o"), numPartitions="3")
    assert offsets.rdd.getNumPartitions() == 3 and sorted(ids(offsets)) == list(range(2300))
    chains = [{"from_page": 0, "to_page": 2}, {"from_page": 2, "to_page": 5}]
    cursors = PG.read_route(spark, "/deals", landing=os.path.join(root, "c"), chains=json.dumps(chains))
    assert cursors.rdd.getNumPartitions() == 2 and sorted(ids(cursors)) == list(range(2300))
    out = PG._batches(iter([("/x", "0", "a"), ("/x", "1", "b")]))
    assert [b.num_rows for b in out] == [1, 1]


def test_unknown_route_fails_by_name(spark):
    with pytest.raises(ValueError, match="/noSuchThing"):
        PG.read_route(spark, "/noSuchThing")


def test_details_fetch_one_page_at_a_time_and_split_hot_keys(spark):
    fetched, handed = [], []

    def fetch(key, start):
        assert len(fetched) == len(handed)  # the page before has left the walk
        fetched.append(start)
        return {"data": [1] * 10, "additional_data": {"pagination": {"more_items_in_collection": start < 90}}}

    for row in D.walk_details(fetch, 1, page_size=10):
        handed.append(row)
    assert len(handed) == 10

    root = tempfile.mkdtemp(prefix="dw-details-")
    items = spark.range(3000).select(F.when(F.col("id") < 2500, 1).otherwise(F.col("id") % 7).cast("bigint").alias("deal_id"), "id")
    pages = (items.withColumn("page", F.floor(F.col("id") / 10)).groupBy("deal_id", "page")
             .agg(F.sort_array(F.collect_list(F.to_json(F.struct("id")))).alias("items")))
    saved_pages.write_details(pages, root, buckets=4)
    keys = items.groupBy("deal_id").agg(F.count("*").alias("n")).unionByName(spark.createDataFrame([(99, None)], "deal_id long, n long"))
    got = D.fetch_details(keys, "deal_id", lambda: saved_pages.details(root, 10, 4), partitions=5, items_col="n",
                          page_size=10, pages_per_range=16)
    rows = D.detail_items(got).select("deal_id", "page", F.explode("items").alias("i")).select(
        "deal_id", F.try_variant_get("i", "$.id", "bigint").alias("id"))
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, items.collect()))
    hot = got.where("deal_id = 1").select(F.spark_partition_id().alias("p")).distinct().count()
    assert hot > 1  # one deal's pages come from several tasks


def test_details_read_a_row_group_once_and_small_pages_leave_together(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="dw-details-")
    items = spark.range(60_000).select((F.col("id") % 600).alias("deal_id"), F.floor(F.col("id") / 600).alias("page"),
                                       F.array(F.concat(F.lit('"'), F.repeat(F.lit("x"), 80), F.col("id"), F.lit('"'))).alias("items"))
    saved_pages.write_details(items, root, buckets=2)
    reads = []

    class Counted(saved_pages.pq.ParquetFile):
        def read_row_group(self, g, **kwargs):
            reads.append(g)
            return super().read_row_group(g, **kwargs)

    monkeypatch.setattr(saved_pages.pq, "ParquetFile", Counted)
    fetch = saved_pages.details(root, 10, 2)
    rows = [row for key in range(600) for row in D.walk_details(fetch, key, page_size=10)]
    assert len(rows) == 60_000 and len({(k, p) for k, p, _ in rows}) == 60_000
    # a group that two keys share is read again at most once a key; far from once a page
    assert len(reads) < 3_000
    assert [b.num_rows for b in D.page_batches(iter([(1, 0, "abc"), (1, 1, "d"), (2, 0, "e")]), 4)] == [2, 1]


def test_runs_share_one_stream_and_keep_their_budget(spark, monkeypatch):
    """A stream costs a Python process: one for all runs, which are batches of at most the budget."""
    from pyspark.sql.streaming.readwriter import DataStreamWriter
    root = tempfile.mkdtemp(prefix="dw-paged-")
    land, state = os.path.join(root, "land"), (os.path.join(root, "state"), "orders")
    write_keyed_landing(build_page_landing(records(spark, 4700), "id", 500), land)
    PG.register_sources(spark)
    starts, seen, start = [], [], DataStreamWriter.start
    monkeypatch.setattr(DataStreamWriter, "start", lambda self, *a, **b: starts.append(1) or start(self, *a, **b))
    runs = drain_paged_stream(spark, "offset_pages", {"landing": land, "maxRowsPerBatch": "1000"},
                              lambda df, b: seen.append((b, sorted(ids(df)))), os.path.join(root, "ckpt"), state)
    assert runs == 5 and len(starts) == 1
    assert seen == [(k, list(range(1000 * k, min(1000 * k + 1000, 4700)))) for k in range(5)]
    assert get_sync_state(spark, *state) == (4700, True)


def test_state_follows_each_committed_run(spark):
    """The fourth run fails: the state names the end of the third, and a flow goes on from there."""
    root = tempfile.mkdtemp(prefix="dw-paged-")
    land, ckpt, state = os.path.join(root, "land"), os.path.join(root, "ckpt"), (os.path.join(root, "state"), "orders")
    write_keyed_landing(build_page_landing(records(spark, 4700), "id", 500), land)
    PG.register_sources(spark)
    seen, fail = [], [3]

    def handle(df, b):
        if b in fail:
            raise RuntimeError("table is locked")
        seen.extend(ids(df))

    options = {"landing": land, "maxRowsPerBatch": "1000"}
    with pytest.raises(Exception, match="table is locked"):
        drain_paged_stream(spark, "offset_pages", options, handle, ckpt, state)
    assert get_sync_state(spark, *state) == (3000, False) and sorted(seen) == list(range(3000))
    fail.clear()
    assert drain_paged_stream(spark, "offset_pages", options, handle, ckpt, state) == 2
    assert sorted(seen) == list(range(4700)) and get_sync_state(spark, *state) == (4700, True)


def test_stream_reader_counts_its_budget_from_the_last_planned_batch(monkeypatch):
    monkeypatch.setattr(PG.saved_pages, "fetch", api(2300))
    reader = PG.OffsetPagesStream({"maxrowsperbatch": "1000", "start": "300"})
    assert reader.latestOffset() == reader.latestOffset() == {"start": 1300}
    reader.partitions({"start": 300}, {"start": 1300})
    assert reader.latestOffset() == {"start": 2300}
    reader.partitions({"start": 1300}, {"start": 2300})
    assert reader.latestOffset() == {"start": 2300}
    assert PG.OffsetPagesStream({}).latestOffset() == {"start": 2300}


def test_keyed_landing_holds_many_pages_a_file_and_a_fetch_reads_one(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="dw-paged-")
    pages = build_page_landing(records(spark, 1500), "id", 10)
    write_keyed_landing(pages, os.path.join(root, "o"))
    write_keyed_landing(build_page_landing(records(spark, 1500), "id", 10, cursor=True), os.path.join(root, "c"))
    files = [f for d, _, names in os.walk(os.path.join(root, "o")) for f in names if f.endswith(".parquet")]
    assert len(files) == 3  # 150 pages, 64 to a file
    read = []

    class Counted(saved_pages.pq.ParquetFile):
        def read_row_group(self, g, **kwargs):
            table = super().read_row_group(g, **kwargs)
            read.append(table.num_rows)
            return table

    monkeypatch.setattr(saved_pages.pq, "ParquetFile", Counted)
    for row in pages.collect():
        body = json.loads(row["value"])
        got = saved_pages.fetch("/x", {"landing": os.path.join(root, "o"), "start": row["key"], "limit": 10, "page_size": 10})
        assert got["data"] == body["data"]
        chained = saved_pages.fetch("/x", {"landing": os.path.join(root, "c"), "cursor": f"c{row['page']}"})
        assert chained["data"] == body["data"]
    assert read == [1] * 300
    assert saved_pages.fetch("/x", {"landing": os.path.join(root, "o"), "start": 1500, "page_size": 10})["data"] == []
