"""Per-key detail fetch (S8 live path): paginated calls per key, spread over tasks.

The reference fetched each pending deal's change log from a thread pool.
Here the keys are a DataFrame, hash-partitioned over ``partitions`` tasks;
each task walks the pagination of its keys with a user fetcher inside
``mapInArrow``.  Pages leave the task in Arrow batches of about BATCH_CHARS, so a task holds
no more than that and one page, and a key whose number of items is known is walked in ranges of pages, each a row
of its own: a key with very many items is spread like many keys.  Python only does the
I/O and the pagination walk; the page bodies are parsed by Spark afterwards
(``from_json`` to ``ARRAY<VARIANT>``), so per-item work stays in the JVM.  A lost executor
re-fetches only its tasks' ranges.

An error payload, or ``data`` that is no list, fails the task wherever it comes (D8).
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealwise.sources.paged import PAGES_PER_TASK, page_data
from dealwise.sources.pages import DEFAULT_LIMIT

#: Text of an Arrow batch of pages: small pages leave together, a larger one leaves by itself.
BATCH_CHARS, MAX_BATCH_PAGES = 1 << 20, 10_000
PAGES_SCHEMA = "deal_id long, page long, body string"
ARROW = pa.schema([("deal_id", pa.int64()), ("page", pa.int64()), ("body", pa.string())])


def walk_details(fetch: Callable[[int, int], dict], key: int, start: int = 0, end: int | None = None,
                 page_size: int = DEFAULT_LIMIT) -> Iterator[tuple[int, int, str]]:
    """(key, page number, body) from offset ``start`` to ``end`` (None: to the last page)."""
    while end is None or start < end:
        page = fetch(key, start)
        data = page_data(page, f"key={key} start={start}")
        if not data:
            return
        yield key, start // page_size, json.dumps({"data": data}, separators=(",", ":"))
        pag = (page.get("additional_data") or {}).get("pagination") or {}
        if not pag.get("more_items_in_collection"):
            return
        nxt = pag.get("next_start")
        start = int(nxt) if nxt is not None else start + len(data)


def fetch_details(keys: DataFrame, key_col: str, fetcher_factory: Callable[[], Callable[[int, int], dict]],
                  partitions: int = 16, items_col: str | None = None, page_size: int = DEFAULT_LIMIT,
                  pages_per_range: int = PAGES_PER_TASK) -> DataFrame:
    """``(deal_id, page, body)`` for every key, fetched in parallel.

    ``fetcher_factory`` builds the fetcher once per task (e.g. an HTTP
    session); it must be picklable.  ``items_col`` names a column with the key's number
    of items, as the API's counters give it; it only decides how the key is cut, the last
    range goes on to the last page.
    """
    size = page_size * pages_per_range
    most = F.coalesce(F.col(items_col), F.lit(0)) if items_col else F.lit(0)
    starts = F.sequence(F.lit(0).cast("bigint"), F.greatest(most.cast("bigint") - 1, F.lit(0).cast("bigint")),
                        F.lit(size).cast("bigint"))
    ranges = keys.select(F.col(key_col).cast("bigint").alias("key"), F.posexplode(starts).alias("n", "start"), F.size(starts).alias("of"))
    ranges = ranges.select("key", "start", F.when(F.col("n") + 1 < F.col("of"), F.col("start") + size).alias("end"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fetch = fetcher_factory()
        rows = (row for batch in batches
                for key, start, end in zip(*(batch.column(c).to_pylist() for c in ("key", "start", "end")))
                for row in walk_details(fetch, key, start, end, page_size))
        yield from page_batches(rows)

    # a task walks its keys in order, so that a fetcher may keep what neighbours share
    return ranges.repartition(partitions, "key", "start").sortWithinPartitions("key", "start").mapInArrow(run, PAGES_SCHEMA)


def page_batches(rows: Iterator[tuple[int, int, str]], size: int = BATCH_CHARS) -> Iterator[pa.RecordBatch]:
    """Pages as Arrow batches; a batch ends with the page that brings its text to ``size``."""
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += len(row[2])
        if chars >= size or len(held) >= MAX_BATCH_PAGES:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), ARROW.types)], schema=ARROW)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), ARROW.types)], schema=ARROW)


def detail_items(pages: DataFrame) -> DataFrame:
    """Page bodies -> ``(deal_id, page, items ARRAY<VARIANT>)`` for the history operators."""
    return pages.select("deal_id", "page", F.from_json("body", "data array<variant>")["data"].alias("items"))
