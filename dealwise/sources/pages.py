"""Page-envelope landing and scan.

API pages land as JSON text, one page per line:
``{"data": [...], "additional_data": {"pagination": {...}} | {"next_cursor": ...}}``.
The scan parses each page once (``from_json`` to ``ARRAY<VARIANT>``), skips
pages whose ``data`` is not a non-empty list, and explodes one row per
record keeping ``(page, ordinal)`` so ingest order stays known (W3 uses it
as the last tiebreak).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_LIMIT = 500  # Fixed value: the API's default page size.
PAGES_PER_FILE = 64  # of a keyed landing
ENVELOPE = "data array<variant>, additional_data variant"


def page_error(body: Column) -> Column:
    """Why a page cannot be read, or NULL: text that is no JSON object, an error
    payload (``success: false``), or ``data`` that is not a list.  A page whose
    ``data`` is missing or null is empty, which is no error."""
    page = F.try_parse_json(body)
    kind = F.schema_of_variant(page)
    data = F.try_variant_get(page, "$.data", "variant")
    return (F.when(page.isNull() | ~kind.startswith("OBJECT"), "page:json")
             .when(~F.coalesce(F.try_variant_get(page, "$.success", "boolean"), F.lit(True)), "page:error")
             .when(data.isNotNull() & ~F.is_variant_null(data) & ~F.schema_of_variant(data).startswith("ARRAY"),
                   "page:data"))


def page_rejects(pages: DataFrame, body: str = "value") -> DataFrame:
    """The pages that cannot be read, whole, with ``reason``."""
    return pages.withColumn("reason", page_error(F.col(body))).where("reason is not null")


def scan_pages(pages: DataFrame, body: str = "value", page_col: str | None = None,
               on_bad: str = "fail") -> DataFrame:
    """``(page, ordinal, record VARIANT)`` from page bodies.

    ``page_col`` names a column holding the page position; without one it is the
    page's own offset, or for cursor pages its place in the landing's files.  An
    unreadable page fails the run; ``on_bad="skip"`` leaves such pages to
    :func:`page_rejects`.
    """
    text = F.col(body)
    env = F.from_json(text, ENVELOPE)
    meta = env["additional_data"]
    page = F.col(page_col) if page_col else F.coalesce(
        F.try_variant_get(meta, "$.pagination.start", "bigint"), F.monotonically_increasing_id())
    parsed = pages.select(page.alias("page"), env["data"].alias("data"), text.alias("body"))
    # the dear check runs only on pages that gave no records
    empty = F.coalesce(F.size("data") <= 0, F.lit(True))
    reason = F.when(empty, page_error(F.col("body")))
    if on_bad == "fail":
        message = F.concat(F.lit("unreadable page: "), reason, F.lit(" "), F.substring("body", 1, 200))
        data = F.when(reason.isNull(), F.col("data")).otherwise(F.raise_error(message).cast("array<variant>"))
    else:
        data = F.when(~empty, F.col("data"))
    return parsed.select("page", F.posexplode(data).alias("ordinal", "record"))


def read_pages(spark: SparkSession, landing: str) -> DataFrame:
    """Read a page landing (one JSON page per line) as page bodies."""
    return spark.read.text(landing).withColumn("file", F.input_file_name())


def record_fields(record: Column, fields: dict[str, str]) -> list[Column]:
    """Typed columns from a record VARIANT (``{name: spark type}``)."""
    return [F.try_variant_get(record, f"$.{k}", t).alias(k) for k, t in fields.items()]


def build_page_landing(records: DataFrame, order_col: str, page_size: int = 500,
                       cursor: bool = False) -> DataFrame:
    """Pages of ``page_size`` records as envelope JSON text (a Spark job).

    Records are grouped by ``order_col div page_size``: every page is bounded
    by construction.  Offset pages carry ``pagination`` (start, limit,
    more_items_in_collection, next_start); cursor pages carry
    ``next_cursor`` (absent on the last page).
    """
    cols = [c for c in records.columns]
    rec = records.select(F.floor(F.col(order_col) / page_size).cast("bigint").alias("page"),
                         F.col(order_col).alias("__o"),
                         F.to_json(F.struct(*[F.col(c) for c in cols])).alias("__j"))
    # the last page number is one scalar (an aggregate, not data)
    last = rec.agg(F.max("page")).first()[0]
    pages = (rec.groupBy("page")
                .agg(F.sort_array(F.collect_list(F.struct("__o", "__j"))).alias("recs")))
    data = F.concat(F.lit("["), F.array_join(F.col("recs.__j"), ","), F.lit("]"))
    more = F.col("page") < F.lit(last if last is not None else -1)
    if cursor:
        nxt = F.when(more, F.concat(F.lit('{"next_cursor":"c'), (F.col("page") + 1).cast("string"),
                                    F.lit('"}'))).otherwise(F.lit("{}"))
        body = F.concat(F.lit('{"data":'), data, F.lit(',"additional_data":'), nxt, F.lit("}"))
        key = F.concat(F.lit("c"), F.col("page").cast("string"))
    else:
        start = F.col("page") * page_size
        pag = F.concat(F.lit('{"pagination":{"start":'), start.cast("string"),
                       F.lit(f',"limit":{page_size},"more_items_in_collection":'),
                       F.when(more, F.lit("true")).otherwise(F.lit("false")),
                       F.lit(',"next_start":'), (start + page_size).cast("string"), F.lit("}}"))
        body = F.concat(F.lit('{"data":'), data, F.lit(',"additional_data":'), pag, F.lit("}"))
        key = start.cast("string")
    return pages.select("page", key.alias("key"), body.alias("value"))


def write_page_landing(pages: DataFrame, path: str) -> None:
    """A file landing: one page envelope per text line (what the scans read)."""
    pages.select("value").write.mode("overwrite").text(path)


def write_keyed_landing(pages: DataFrame, path: str) -> None:
    """Pages addressable by their key (offset or cursor) for ``saved_pages.fetch``:
    PAGES_PER_FILE pages that follow one another are a Parquet file in a ``block=<n>`` folder,
    in the order of their keys and with a row group each, so that a fetch reads one page."""
    block = F.floor(F.col("page") / PAGES_PER_FILE).cast("bigint")
    (pages.select(block.alias("block"), "page", F.col("key").cast("string").alias("key"), "value")
     .repartition("block").sortWithinPartitions("block", "page")
     .write.option("parquet.block.row.count.limit", 1).mode("overwrite").partitionBy("block").parquet(path))
