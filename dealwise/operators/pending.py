"""Pending work selection (J10, T1, A1, A10) and row budgets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dealwise.session import stored


def pending_keys(items: DataFrame, done: DataFrame, key: str, done_key: str) -> DataFrame:
    """Rows of ``items`` whose key is not yet in ``done``.

    ``NOT IN (SELECT DISTINCT …)`` compiles to a null-aware broadcast anti
    join; keys are non-null primary keys here, so the plain anti join is
    equivalent and is planned as a shuffle join when ``done`` is large.
    """
    return items.join(done.select(F.col(done_key).alias("__done")).distinct(),
                      F.col(key) == F.col("__done"), "left_anti")


def newest_first(df: DataFrame, budget: int, order: Sequence[Column], tiebreak: Sequence[str]) -> DataFrame:
    """``ORDER BY order DESC NULLS LAST, tiebreak DESC LIMIT budget``.

    The budget is the feature (work per run); Spark plans it as a
    ``TakeOrderedAndProject``: each task keeps its local top ``budget`` and
    only those reach the final merge.  One task merges them: for a budget that grows with
    the table see :func:`newest_stored`.
    """
    sort = [o.desc_nulls_last() for o in order] + [F.col(t).desc() for t in tiebreak]
    return df.orderBy(*sort).limit(budget)


#: Budget up to which one task may merge the rows taken.
ONE_TASK = 100_000


def newest_stored(df: DataFrame, budget: int, order: Sequence[Column], tiebreak: Sequence[str], name: str,
                  one_task: int = ONE_TASK) -> DataFrame:
    """The rows of :func:`newest_first`, stored; a large budget goes through no single task.

    The rows are range-partitioned by the order and stored with their range, so the ranges
    before the one that the budget ends in are taken whole, and only that one is sorted and cut.
    """
    if budget <= one_task:
        return stored(newest_first(df, budget, order, tiebreak), name)
    sort = [o.desc_nulls_last() for o in order] + [F.col(t).desc() for t in tiebreak]
    ranked = stored(df.repartitionByRange(*sort).withColumn("__range", F.spark_partition_id()), name)
    left, whole = budget, -1
    for r in sorted(ranked.groupBy("__range").count().collect()):  # a row per range
        if r["count"] > left:
            cut = ranked.where(F.col("__range") == r["__range"]).orderBy(*sort).limit(left)
            return stored(ranked.where(F.col("__range") <= whole).unionByName(cut).drop("__range"), name)
        left, whole = left - r["count"], r["__range"]
    return ranked.drop("__range")


#: Consecutive numbers that one task sums up.
BLOCK = 4096


def sums_before(pages: DataFrame, page_col: str, rows_col: str, block: int = BLOCK) -> DataFrame:
    """``pages`` with ``rows_before``: the sum of ``rows_col`` over all lower page numbers.

    A scan in levels: pages form blocks of ``block`` consecutive numbers, blocks form blocks
    of blocks, until one holds all.  Each level is summed within its blocks and moved by the
    sum before the block, so no task sorts more than ``block`` rows whatever their number.
    ``pages`` is read once per level: pass a stored frame.
    """
    low, high = pages.agg(F.min(page_col), F.max(page_col)).first()
    levels = 1
    while low is not None and (high - low) // block ** levels:
        levels += 1
    number = (F.col(page_col) - F.lit(low)).cast("bigint")  # from 0 on

    def at(k: int) -> Column:
        return F.floor(number / F.lit(block ** k)).cast("bigint")

    before = None  # of the blocks one level up
    for k in reversed(range(levels)):
        rows = pages.groupBy(at(k).alias("__no")).agg(F.sum(rows_col).alias("__n"))
        up = F.floor(F.col("__no") / block).cast("bigint")
        w = Window.partitionBy("__up").orderBy("__no").rowsBetween(Window.unboundedPreceding, -1)
        here = rows.withColumn("__up", up).withColumn("__in", F.coalesce(F.sum("__n").over(w), F.lit(0)))
        if before is not None:
            here = here.join(before.select(F.col("__no").alias("__up"), F.col("__before").alias("__off")), "__up")
            here = here.withColumn("__in", F.col("__in") + F.col("__off"))
        before = here.select("__no", F.col("__in").alias("__before"))
    return pages.join(before, number == F.col("__no")).drop("__no").withColumn(
        "rows_before", F.col("__before").cast("bigint")).drop("__before")


def whole_page_budget(pages: DataFrame, budget: int, page_col: str = "page",
                      rows_col: str = "n_rows", block: int = BLOCK) -> DataFrame:
    """Pages in order while the rows *before* a page are under ``budget``.

    Whole pages only (a page that starts under the budget is taken entirely).  Pages
    without rows aside, at most ``budget`` pages come out.
    """
    return sums_before(pages, page_col, rows_col, block).where(F.col("rows_before") < budget)
