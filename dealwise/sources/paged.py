"""Paged API sources as PySpark Python data sources.

``offset_pages`` walks ``start``/``limit`` pagination, ``cursor_pages`` walks
``cursor``/``next_cursor``.  A *fetcher* (``fetch(endpoint, params) -> page dict``, named by
a ``module:function`` option) does the I/O; without one, saved pages are read.

Every page is fetched by a task and leaves it as one Arrow batch, so a task holds one page:

* An offset range is cut into page ranges, each its own partition, in batch and stream.
* A cursor chain is a sequence by nature.  ``chains`` (a JSON list of request parameters,
  such as key or time ranges that the API filters by) cuts a collection into as many.
* The stream's offset is the number of records read, ``{"start": n}``.  The driver only
  looks for the end of the collection, by a search over page starts; a batch is the range
  between two offsets, of at most ``maxRowsPerBatch`` records, and reads the same pages when
  it is run again, and the next batch starts at the end of the last one, whatever has come since.

Semantics follow the source API: an empty page is not emitted and ends the walk; a missing
``next_start`` falls back to ``start + len(page)``.  An error payload, or a page whose
``data`` is not a list, fails the task and so the job, wherever it comes: partial data is
never reported as success (D8).  ``data: null`` is an empty page.
"""

from __future__ import annotations

import importlib
import json
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from dealwise.sources import saved_pages
from dealwise.sources.pages import DEFAULT_LIMIT

# One row per fetched page: the envelope is split into records by Spark
# (``from_json`` + ``explode`` in the JVM, see ``sources.pages.scan_pages``),
# so Python only walks the pagination.
SCHEMA = "endpoint string, page_key string, body string"
ARROW = pa.schema([("endpoint", pa.string()), ("page_key", pa.string()), ("body", pa.string())])
#: Pages that one task of a batch or stream fetches.
PAGES_PER_TASK = 64


def _opt(options, name: str, default=None):
    """Option lookup ignoring case (the data source API lowercases keys)."""
    for k, v in options.items():
        if k.lower() == name.lower():
            return v
    return default


def _load(options: dict) -> Callable[[str, dict], dict]:
    named = _opt(options, "fetcher")
    if not named:
        return saved_pages.fetch
    mod, fn = named.split(":")
    return getattr(importlib.import_module(mod), fn)


def page_data(page: dict, where: str) -> list:
    """The records of a page; an error payload or ``data`` that is no list raises."""
    data = page.get("data") if isinstance(page, dict) else None
    if not isinstance(page, dict) or page.get("success") is False or not (data is None or isinstance(data, list)):
        raise ValueError(f"unreadable page, {where}: {json.dumps(page)[:200]}")
    return data or []


def _limit(options: dict) -> int:
    return int(_opt(options, "limit", DEFAULT_LIMIT))


def walk_offset(fetch, endpoint: str, opts: dict, start: int, end: int | None) -> Iterator[tuple]:
    """Pages from ``start`` on, none of them beyond ``end``."""
    limit = _limit(opts)
    while end is None or start < end:
        size = limit if end is None else min(limit, end - start)
        page = fetch(endpoint, {**opts, "start": start, "limit": size})
        data = page_data(page, f"{endpoint} start={start}")
        if not data:
            return
        yield endpoint, str(start), json.dumps(page, separators=(",", ":"))
        pag = (page.get("additional_data") or {}).get("pagination") or {}
        if not pag.get("more_items_in_collection", False):
            return
        nxt = pag.get("next_start")
        start = int(nxt) if nxt is not None else start + len(data)


def walk_cursor(fetch, endpoint: str, opts: dict, cursor: str | None) -> Iterator[tuple]:
    """The chain of pages from ``cursor`` (None: from the first one)."""
    while True:
        params = {**opts, "limit": _limit(opts), **({"cursor": cursor} if cursor else {})}
        page = fetch(endpoint, params)
        if page_data(page, f"{endpoint} cursor={cursor}"):
            yield endpoint, cursor or "", json.dumps(page, separators=(",", ":"))
        cursor = (page.get("additional_data") or {}).get("next_cursor")
        if not cursor:
            return


def collection_end(fetch, endpoint: str, opts: dict, start: int, until: int | None) -> int:
    """Where the collection ends, at most ``until``: the number of records before its end.

    A search over page starts, so it takes a logarithmic number of requests.
    """
    limit = _limit(opts)

    def size(at: int, n: int) -> int:
        return len(page_data(fetch(endpoint, {**opts, "start": at, "limit": n}), f"{endpoint} start={at}"))

    def page_start(k: int) -> int:  # of the k-th page after the one that holds ``start``
        return start if k == 0 else (start // limit + k) * limit

    if (until is not None and until <= start) or not size(start, 1):
        return start
    low, high = 0, 1  # page ``low`` has records; is there an empty one?
    while (until is None or page_start(high) < until) and size(page_start(high), 1):
        low, high = high, high * 2
    while high - low > 1:
        mid = (low + high) // 2
        if (until is None or page_start(mid) < until) and size(page_start(mid), 1):
            low = mid
        else:
            high = mid
    last = page_start(low)
    room = page_start(low + 1) - last
    end = last + min(size(last, room), room)
    return end if until is None else min(end, until)


def _ranges(endpoint: str, start: int, end: int, limit: int, pages: int) -> list[_Range]:
    """[start, end) in ranges of ``pages`` whole pages."""
    cuts = [start, *range((start // limit + pages) * limit, end, pages * limit), end]
    return [_Range(endpoint, a, b) for a, b in zip(cuts, cuts[1:]) if a < b]


def _batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """One Arrow batch per page."""
    for row in rows:
        yield pa.RecordBatch.from_pylist([dict(zip(ARROW.names, row))], schema=ARROW)


class _Range(InputPartition):
    def __init__(self, endpoint: str, start: int = 0, end: int | None = None, params: dict | None = None):
        self.endpoint, self.start, self.end, self.params = endpoint, start, end, params or {}


class OffsetPagesReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = dict(options)

    def partitions(self):
        endpoint = self.options.get("endpoint", "")
        total = _opt(self.options, "total")
        end = int(total) if total is not None else collection_end(_load(self.options), endpoint, self.options, 0, None)
        limit = _limit(self.options)
        n = _opt(self.options, "numPartitions")
        pages = -(-end // limit)
        out = _ranges(endpoint, 0, end, limit, max(1, -(-pages // int(n))) if n else PAGES_PER_TASK)
        if out:
            out[-1].end = None  # records that came while the read was planned
        return out or [_Range(endpoint)]

    def read(self, partition: _Range):
        yield from _batches(walk_offset(_load(self.options), partition.endpoint, self.options, partition.start, partition.end))


class CursorPagesReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = dict(options)

    def partitions(self):
        endpoints = _opt(self.options, "endpoints", _opt(self.options, "endpoint", "")).split(",")
        chains = json.loads(_opt(self.options, "chains", "[{}]"))
        return [_Range(e, params=c) for e in endpoints for c in chains]

    def read(self, partition: _Range):
        opts = {k: v for k, v in self.options.items() if k.lower() not in ("chains", "cursor")}
        yield from _batches(walk_cursor(_load(self.options), partition.endpoint, {**opts, **partition.params},
                                        self.options.get("cursor")))


class OffsetPagesStream(DataSourceStreamReader):
    """Offset pagination as a stream; offset ``{"start": n}``, the records before it.

    A batch takes at most ``maxRowsPerBatch`` records, without it what there is.  Spark asks
    for the latest offset without naming the last one, so the reader counts from the end of
    the batch that it planned last, and from ``start`` before the first: a stream that is
    started again with a budget has to be told there where it was (see
    ``streaming.backfill.drain_paged_stream``).
    """

    def __init__(self, options: dict):
        self.options = dict(options)
        self.planned = self.initialOffset()["start"]

    def initialOffset(self):
        return {"start": int(_opt(self.options, "start", 0))}

    def available(self) -> int:
        """Where the next batch ends: at the collection's end, or where the budget is used up."""
        budget = int(_opt(self.options, "maxRowsPerBatch", 0))
        return collection_end(_load(self.options), self.options.get("endpoint", ""), self.options, self.planned,
                              self.planned + budget if budget else None)

    def latestOffset(self):
        return {"start": self.available()}

    def partitions(self, start: dict, end: dict):
        self.planned = int(end["start"])
        return _ranges(self.options.get("endpoint", ""), int(start["start"]), int(end["start"]), _limit(self.options),
                       int(_opt(self.options, "pagesPerTask", PAGES_PER_TASK)))

    def read(self, partition: _Range):
        yield from _batches(walk_offset(_load(self.options), partition.endpoint, self.options, partition.start, partition.end))


class OffsetPagesSource(DataSource):
    @classmethod
    def name(cls):
        return "offset_pages"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return OffsetPagesReader(self.options)

    def streamReader(self, schema):
        return OffsetPagesStream(self.options)


class CursorPagesSource(DataSource):
    @classmethod
    def name(cls):
        return "cursor_pages"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return CursorPagesReader(self.options)


def register_sources(spark) -> None:
    """Make ``offset_pages`` and ``cursor_pages`` available to ``spark.read.format``.

    The reader classes and the saved pages' fetcher are pickled by value: a source is
    planned in a process that does not see files added with ``addPyFile``.
    """
    import sys
    from pyspark import cloudpickle
    from dealwise.session import ship_package
    ship_package(spark)
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    cloudpickle.register_pickle_by_value(saved_pages)
    spark.dataSource.register(OffsetPagesSource)
    spark.dataSource.register(CursorPagesSource)


#: How the routes of an API version are paged.
FORMATS = {"v1": "offset_pages", "v2": "cursor_pages"}


def read_route(spark: SparkSession, endpoint: str, **options: str) -> DataFrame:
    """The pages of a registered route, by the pagination of its API version.

    An endpoint that no route names fails by its name before anything is fetched.
    """
    from dealwise.sources.routes import ROUTES
    if endpoint not in ROUTES:
        raise ValueError(f"unknown route {endpoint!r}; see routes.register_route")
    register_sources(spark)
    return spark.read.format(FORMATS[ROUTES[endpoint].version]).options(endpoint=endpoint, **options).load()
