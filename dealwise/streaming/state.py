"""Incremental-sync state and decisions.

State lives in two small Parquet tables under the shared checkpoint folder,
written through the same keyed upsert as the data (K1):

* ``flow_meta``  — ``flow_id, last_success_ts``  (the watermark, C1)
* ``sync_state`` — ``entity, last_cursor, backfill_done, updated_at`` (C4)

Watermarks are UTC and stamped with the run's *start* time (D3, D4), so an
update made during a run is picked up by the next run.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dealwise.operators.upsert import read_table_at, table_exists, upsert_table
from dealwise.session import one_row

# Watermark overlap and sync modes.
SAFETY_SKEW = dt.timedelta(seconds=5)
FULL, INCREMENTAL, SKIP = "FULL", "INCREMENTAL", "SKIP"

FLOW_META = "flow_id string, last_success_ts timestamp"
SYNC_STATE = "entity string, last_cursor bigint, backfill_done boolean, updated_at timestamp"


def _utc(ts: dt.datetime) -> dt.datetime:
    return ts.replace(tzinfo=dt.timezone.utc) if ts.tzinfo is None else ts.astimezone(dt.timezone.utc)


def get_watermark(spark: SparkSession, root: str, flow_id: str) -> dt.datetime | None:
    """Last successful run start of ``flow_id`` (UTC) or ``None``."""
    path = f"{root}/flow_meta"
    if not table_exists(spark, path):
        return None
    row = (read_table_at(spark, path).filter(F.col("flow_id") == flow_id)
           .select("last_success_ts").first())
    return None if row is None or row[0] is None else _utc(row[0])


def set_watermark(spark: SparkSession, root: str, flow_id: str, ts: dt.datetime) -> None:
    """Upsert the watermark row (K1 on a one-bucket table)."""
    df = one_row(spark, (flow_id, _utc(ts)), FLOW_META)
    upsert_table(spark, f"{root}/flow_meta", df, ["flow_id"], buckets=1, dedupe=False)


def get_sync_state(spark: SparkSession, root: str, entity: str) -> tuple[int | None, bool]:
    """C4: ``(last_cursor, backfill_done)``; ``(None, False)`` before the first save."""
    path = f"{root}/sync_state"
    if not table_exists(spark, path):
        return None, False
    row = read_table_at(spark, path).filter(F.col("entity") == entity).first()
    return (None, False) if row is None else (row["last_cursor"], bool(row["backfill_done"]))


def save_sync_state(spark: SparkSession, root: str, entity: str, cursor: int | None,
                    done: bool) -> None:
    df = one_row(spark, (entity, cursor, done, dt.datetime.now(dt.timezone.utc)), SYNC_STATE)
    upsert_table(spark, f"{root}/sync_state", df, ["entity"], buckets=1, dedupe=False)


def compute_updated_since(last_ok: dt.datetime | None,
                          skew: dt.timedelta = SAFETY_SKEW) -> tuple[str | None, bool]:
    """``(since ISO-8601 UTC, is_full)``: FULL only when the flow never ran."""
    if last_ok is None:
        return None, True
    return (_utc(last_ok) - skew).strftime("%Y-%m-%dT%H:%M:%SZ"), False


def decide_sync_mode(last_ok: dt.datetime | None, endpoint_version: str,
                     deps_changed: bool) -> tuple[str, dt.datetime | None]:
    """Never ran or v1 endpoint -> FULL; v2 with changed deps -> INCREMENTAL
    from ``last_ok - skew``; otherwise SKIP."""
    if last_ok is None or endpoint_version == "v1":
        return FULL, None
    if deps_changed:
        return INCREMENTAL, _utc(last_ok) - SAFETY_SKEW
    return SKIP, None


def sync_mode_expr(last_ok: Column, version: Column, deps_changed: Column) -> Column:
    """C3 as a column expression (for a table of flows)."""
    return (F.when(last_ok.isNull() | (version == "v1"), F.lit(FULL))
             .when(deps_changed, F.lit(INCREMENTAL))
             .otherwise(F.lit(SKIP)))


def since_expr(last_ok: Column) -> Column:
    """The incremental lower bound as a column (``last_ok - 5 s``)."""
    return last_ok - F.expr(f"INTERVAL {int(SAFETY_SKEW.total_seconds())} SECONDS")


def incremental(df: DataFrame, column: str, since: dt.datetime | str | None, keep: Column | None = None) -> DataFrame:
    """Rows updated at or after ``since`` (full table when ``since`` is None).

    A row without an update time may have changed, so it is kept, as are those of ``keep``.  The bound is a literal, so the comparison reaches the Parquet reader as a
    pushed filter (row groups outside the window are skipped).
    """
    if since is None:
        return df
    late = is_late(column, since)
    return df.filter(late if keep is None else late | keep)


def is_late(column: str, since: dt.datetime | str) -> Column:
    """Whether a row was updated at or after ``since``, or has no update time."""
    lit = F.lit(since).cast("timestamp") if isinstance(since, str) else F.lit(_utc(since))
    return (F.col(column) >= lit) | F.col(column).isNull()


def freshness_predicate(columns: Sequence[str], present: Sequence[str], since: Column) -> Column | None:
    """``c1 >= t OR c2 >= t …`` over the configured columns that exist."""
    cols = [c for c in columns if c in set(present)]
    if not cols:
        return None
    pred = None
    for c in cols:
        p = F.col(c) >= since
        pred = p if pred is None else (pred | p)
    return pred


def dependency_changes(deps: Mapping[str, tuple[DataFrame, Sequence[str]]],
                       since: dt.datetime | None) -> DataFrame:
    """One row per dependency ``(dep, changed)`` from a single job.

    Each dependency contributes ``filter(P4).limit(1)``; the probes are
    unioned so one action answers all of them, each stopping at its first
    match.  With no ``since`` every dependency counts as changed.
    """
    frames = []
    for name, (df, cols) in deps.items():
        spark = df.sparkSession
        if since is None:
            frames.append(spark.range(1).select(F.lit(name).alias("dep"), F.lit(True).alias("changed")))
            continue
        pred = freshness_predicate(cols, df.columns, F.lit(_utc(since)))
        if pred is None:
            frames.append(spark.range(1).select(F.lit(name).alias("dep"), F.lit(False).alias("changed")))
            continue
        hit = df.filter(pred).limit(1).select(F.lit(1).alias("h"))
        probe = (spark.range(1).select(F.lit(name).alias("dep"))
                 .join(hit.select(F.lit(name).alias("dep"), "h"), "dep", "left")
                 .select("dep", F.col("h").isNotNull().alias("changed")))
        frames.append(probe)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def has_recent_updates(deps: Mapping[str, tuple[DataFrame, Sequence[str]]],
                       since: dt.datetime | None) -> bool:
    """J11 as a decision: any dependency changed since ``since``."""
    return dependency_changes(deps, since).filter("changed").limit(1).count() > 0
