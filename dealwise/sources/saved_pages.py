"""Saved pages that answer like the API (the fetchers of the tests and the catalogue).

A fetch reads the one page it returns from the shared folder and keeps nothing, so a task
holds one page.  File systems are opened by pyarrow from the folder's URI.
"""

from __future__ import annotations

import json
from bisect import bisect_left, bisect_right
from collections.abc import Callable
from itertools import accumulate

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealwise.sources.pages import DEFAULT_LIMIT, PAGES_PER_FILE

EMPTY = {"data": [], "additional_data": {}}
DETAIL_BUCKETS = 64


def _place(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri.removeprefix("file:"))


def _page(root: str, page: int) -> dict:
    fs, path = _place(f"{root}/block={page // PAGES_PER_FILE}")
    for f in fs.get_file_info(pafs.FileSelector(path, allow_not_found=True)):
        if f.base_name.startswith("part-"):
            with fs.open_input_file(f.path) as source:
                file = pq.ParquetFile(source)
                at = file.schema_arrow.get_field_index("page")
                for g in range(file.num_row_groups):
                    pages = file.metadata.row_group(g).column(at).statistics
                    if pages.min <= page <= pages.max:
                        rows = file.read_row_group(g, columns=["page", "value"], use_threads=False).to_pydict()
                        if page in rows["page"]:
                            return json.loads(rows["value"][rows["page"].index(page)])
    return EMPTY


def fetch(endpoint: str, params: dict) -> dict:
    """A page written by ``pages.write_keyed_landing``; ``params['landing']`` is the folder.

    Offsets: records from ``start`` on, at most ``limit`` of them.  Cursors: the page of
    ``cursor``, or the first one from ``from_page`` on; ``to_page`` ends the chain, as a
    filter of the API on a range of keys does.
    """
    root = params["landing"]
    if "start" not in params:
        number = int((params.get("cursor") or f"c{params.get('from_page', 0)}")[1:])
        page = _page(root, number)
        if "to_page" in params and number + 1 >= int(params["to_page"]):
            page = {**page, "additional_data": {}}
        return page
    start, limit, size = int(params["start"]), int(params.get("limit", DEFAULT_LIMIT)), int(params.get("page_size", DEFAULT_LIMIT))
    first = start // size * size
    page = _page(root, start // size)
    data = page["data"][start - first:start - first + limit]
    more = bool(page["additional_data"].get("pagination", {}).get("more_items_in_collection"))
    rest = start - first + limit < len(page["data"])
    return {"data": data, "additional_data": {"pagination": {
        "start": start, "limit": limit, "more_items_in_collection": more or rest,
        "next_start": start + limit if rest else first + size}}}


def write_details(pages: DataFrame, root: str, buckets: int = DETAIL_BUCKETS) -> None:
    """Save ``(deal_id, page, items)`` for :func:`details`: sorted by key within buckets, in
    small row groups, so that a fetch reads one of them."""
    rows = pages.select(F.pmod("deal_id", F.lit(buckets)).alias("bucket"), "deal_id", "page",
                        F.concat(F.lit("["), F.array_join("items", ","), F.lit("]")).alias("body"))
    (rows.repartition(buckets, "bucket").sortWithinPartitions("bucket", "deal_id", "page")
     .write.option("parquet.block.size", 1 << 16).mode("overwrite").partitionBy("bucket").parquet(root))


def details(root: str, page_size: int = DEFAULT_LIMIT, buckets: int = DETAIL_BUCKETS) -> Callable[[int, int], dict]:
    """The fetcher ``(key, start) -> page`` over pages of :func:`write_details`: the key's
    n-th saved page for ``start // page_size``.

    A key's row groups are found by bisection of their ranges.  Kept are the files' footers,
    the last row group read of each bucket, and where the last key's pages are, so a walk
    in the order of the keys reads a row group once.
    """
    opened: dict[int, tuple] = {}
    held: dict[int, tuple] = {}
    last: list = [None, None]

    def groups(b: int) -> tuple[list, list, list]:
        if b not in opened:
            fs, path = _place(f"{root}/bucket={b}")
            found = []
            for f in fs.get_file_info(pafs.FileSelector(path, allow_not_found=True)):
                if f.base_name.endswith(".parquet"):
                    file = pq.ParquetFile(fs.open_input_file(f.path))
                    at = file.schema_arrow.get_field_index("deal_id")
                    for g in range(file.num_row_groups):
                        meta = file.metadata.row_group(g)
                        stats = meta.column(at).statistics
                        found.append((stats.min, stats.max, file, g, meta.num_rows))
            found.sort(key=lambda x: x[:2])
            # lower ends ascend; so do the greatest upper ends so far
            opened[b] = found, [x[0] for x in found], list(accumulate((x[1] for x in found), max))
        return opened[b]

    def rows(b: int, i: int) -> tuple[dict, pa.ChunkedArray]:
        """Row group ``i`` of a bucket: the places of its keys, and its bodies."""
        if b not in held or held[b][0] != i:
            _, _, file, g, _ = groups(b)[0][i]
            table = file.read_row_group(g, columns=["deal_id", "body"])
            at: dict[int, list] = {}
            for place, k in enumerate(table.column("deal_id").to_pylist()):
                at.setdefault(k, []).append(place)
            held[b] = i, at, table.column("body")
        return held[b][1:]

    def spans(b: int, key: int) -> tuple[list, list, int]:
        """The row groups that hold the key, the number of its pages before each, and in all."""
        if last[0] != key:
            found, lows, highs = groups(b)
            at, before, n = [], [], 0
            for i in range(bisect_left(highs, key), bisect_right(lows, key)):
                low, high, _, _, size = found[i]
                here = size if low == high == key else len(rows(b, i)[0].get(key, ())) if high >= key else 0
                if here:
                    at.append(i)
                    before.append(n)
                    n += here
            last[:] = key, (at, before, n)
        return last[1]

    def fetch_detail(key: int, start: int) -> dict:
        b, n = key % buckets, start // page_size
        at, before, total = spans(b, key)
        if not 0 <= n < total:
            return EMPTY
        s = bisect_right(before, n) - 1
        places, bodies = rows(b, at[s])
        found = bodies[places[key][n - before[s]]].as_py()
        return {"data": json.loads(found), "additional_data": {"pagination": {
            "start": start, "limit": page_size, "more_items_in_collection": total > n + 1, "next_start": start + page_size}}}

    return fetch_detail
