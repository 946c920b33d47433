"""Keyed upsert as frames (K1-K5, K14, K15, J8, J9, W3); tables are in ``segments``.

Parquet has no MERGE/UPDATE, so an upsert is a plan:

1. W3: one row per key in the source (latest ``order`` wins, by aggregate).
2. K1/K5: ``target FULL OUTER JOIN source ON pk``; per column, the source
   value wins whenever the key matched the source (also when it is NULL:
   a NULL in the source overwrites), columns absent from the source keep
   the target value.  K4: insert-only keeps every existing row untouched.

:mod:`dealwise.operators.segments` keeps such tables: batches are written as
delta segments and merged by the same rule when the table is read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealwise.operators.dedupe import keep_last
from dealwise.operators.evolve import align, evolved_schema
from dealwise.operators.segments import (compact_table, create_table, read_manifest, read_table_at,  # noqa: F401
                                         rebucket_table, table_exists, upsert_table, vacuum_table)

_S = "__src"
_T = "__tgt"


def one_per_key(source: DataFrame, pk: Sequence[str],
                order: Sequence[Column | str] | None = None) -> DataFrame:
    """The latest row per key (``order`` desc, then the rest of the row)."""
    if order is None:
        order = [c for c in ("update_time",) if c in source.columns]
    return keep_last(source, pk, order or [F.lit(0)])


def merge_frames(target: DataFrame, source: DataFrame, pk: Sequence[str], *,
                 insert_only: bool = False, dedupe: bool = True,
                 order: Sequence[Column | str] | None = None,
                 protected: Sequence[str] = ()) -> DataFrame:
    """K1-K5 as a lazy frame: the table after upserting ``source`` into ``target``.

    Columns: target's (types widened where the source needs it, K9), then
    the source's new columns (K8).  The join is a plain equi full outer join
    on typed keys; Catalyst plans it as a sort-merge join (shuffle on the
    key) or, with AQE, a broadcast when one side turns out small.
    """
    pk = list(pk)
    missing = [k for k in pk if k not in source.columns]
    if missing:
        raise ValueError(f"source lacks primary key column(s) {missing}")
    if dedupe:
        source = one_per_key(source, pk, order)
    schema, _, _ = evolved_schema(target.schema, source.schema, protected=list(pk) + list(protected))
    tcols = [c for c in schema if c in target.columns]
    scols = [c for c in schema if c in source.columns]
    t = align(target.select(*tcols), {c: schema[c] for c in tcols}).withColumn(_T, F.lit(True))
    s = align(source.select(*scols), {c: schema[c] for c in scols}).withColumn(_S, F.lit(True))
    j = t.alias("t").join(s.alias("s"), [F.col(f"t.{k}") == F.col(f"s.{k}") for k in pk], "full_outer")
    matched_src = F.col(f"s.{_S}").isNotNull()
    has_tgt = F.col(f"t.{_T}").isNotNull()
    out = []
    for c in schema:
        tc, sc = F.col(f"t.`{c}`"), F.col(f"s.`{c}`")
        if c in pk:
            e = F.coalesce(tc, sc)
        elif c in scols and c in tcols:
            # K5: choose by the match flag, never coalesce (NULL overwrites)
            e = F.when(has_tgt, tc).otherwise(sc) if insert_only else F.when(matched_src, sc).otherwise(tc)
        elif c in scols:
            e = F.when(~has_tgt, sc) if insert_only else sc
        else:
            e = tc
        out.append(e.cast(schema[c]).alias(c))
    return j.select(*out)


def insert_new_only(target: DataFrame, source: DataFrame, pk: Sequence[str]) -> DataFrame:
    """``target ∪ (source ⋉̸ target)`` — new keys appended, nothing updated."""
    new = one_per_key(source, pk).join(target.select(*pk), list(pk), "left_anti")
    return align_union(target, new)


def align_union(a: DataFrame, b: DataFrame) -> DataFrame:
    schema, _, _ = evolved_schema(a.schema, b.schema)
    return align(a, schema).unionByName(align(b, schema))


def update_existing(target: DataFrame, updates: dict[str, DataFrame], pk: str = "id") -> DataFrame:
    """Set columns of *existing* rows from ``{column: frame(pk, value)}``.

    All update frames are folded into one (full outer join on the key, each
    de-duplicated first), then one left join against the target; rows
    without an update, and keys absent from the target, are unaffected.
    """
    upd = None
    for col, f in updates.items():
        value_col = [c for c in f.columns if c != pk][0]
        g = one_per_key(f.select(pk, F.col(value_col).alias(f"__upd_{col}")), [pk],
                        [F.col(f"__upd_{col}")])
        g = g.withColumn(f"__has_{col}", F.lit(True))
        upd = g if upd is None else upd.join(g, pk, "full_outer")
    if upd is None:
        return target
    j = target.join(upd, pk, "left")
    cols = []
    for c in target.columns:
        if c in updates:
            cols.append(F.when(F.col(f"__has_{c}").isNotNull(), F.col(f"__upd_{c}"))
                         .otherwise(F.col(c)).cast(target.schema[c].dataType).alias(c))
        else:
            cols.append(F.col(c))
    return j.select(*cols)


def update_from_frame(target: DataFrame, updates: DataFrame, pk: Sequence[str],
                      columns: Sequence[str] | None = None, unique: bool = False) -> DataFrame:
    """K15, wide form: one frame ``(pk, c1, c2, …)`` updates existing rows in one join.

    A non-NULL update value replaces the target value; NULL means "no update
    for this column" (pivoted updates such as stage arrivals are sparse).
    Update rows whose key is not in the target are ignored.  The update frame
    is de-duplicated on the key first, unless ``unique`` says it already is
    (e.g. it is the output of a ``groupBy`` on the key).
    """
    pk = list(pk)
    cols = list(columns) if columns is not None else [c for c in updates.columns if c not in pk]
    upd = updates.select(*pk, *cols)
    if not unique:
        upd = one_per_key(upd, pk, [F.lit(0)])
    upd = upd.select(*pk, *[F.col(c).alias(f"__upd_{c}") for c in cols])
    j = target.join(upd, pk, "left")
    out = []
    for c in target.columns:
        if c in cols:
            out.append(F.coalesce(F.col(f"__upd_{c}"), F.col(c)).cast(target.schema[c].dataType).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)
