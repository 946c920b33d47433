"""Lookup enrichment (J1-J5): fill label columns from dimension tables.

Each lookup is a left equi-join against a de-duplicated dimension (D22: a
repeated dimension key would otherwise multiply rows or pick an arbitrary
label).  Rows without a partner keep the value they already had.  All
lookups of an entity are chained in one plan; dimensions under a proven row
bound are broadcast, larger ones are shuffle-joined.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealwise.operators.dedupe import keep_first
from dealwise.operators.joins import DEFAULT_BROADCAST_ROWS, fits_broadcast, key_expr
from dealwise.spec import LookupSpec

log = logging.getLogger(__name__)

# Fallback label columns tried in this order.
DEFAULT_VALUE_COLUMNS = ("title", "name", "label", "display_name")


def resolve_value_column(columns: Sequence[str], spec: LookupSpec) -> str:
    """Configured column, then the spec's candidates, then the defaults."""
    tried = ([spec.value_col] if spec.value_col else []) + list(spec.candidates) + list(DEFAULT_VALUE_COLUMNS)
    for c in tried:
        if c in columns:
            return c
    raise ValueError(f"lookup {spec.source_table}.{spec.dest_col}: none of {tried} exists "
                     f"(columns: {list(columns)})")


def enrich(df: DataFrame, lookups: Sequence[LookupSpec], tables: Mapping[str, DataFrame], *,
           string_keys: bool = False, broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Apply ``lookups`` to ``df``.

    J3: a lookup whose destination key is missing from ``df`` is skipped
    with a warning; a missing source key is an error.  J5: ``string_keys``
    compares keys as text (for tables whose ids are stored as TEXT).
    """
    out = df
    # each (dimension, label) is sized once, however many lookups read it
    small: dict[tuple[str, str, str], bool] = {}
    for i, spec in enumerate(lookups):
        if spec.dest_key not in out.columns:
            log.warning("lookup %s skipped: column %s absent", spec.dest_col, spec.dest_key)
            continue
        dim = tables[spec.source_table]
        if spec.source_key not in dim.columns:
            raise ValueError(f"lookup source {spec.source_table} lacks key {spec.source_key}")
        value = resolve_value_column(dim.columns, spec)
        k, v, m = f"__k{i}", f"__v{i}", f"__m{i}"
        side = keep_first(dim.select(key_expr(spec.source_key, string_keys).alias(k),
                                     F.col(value).alias(v)), [k], [F.col(v)])
        side = side.withColumn(m, F.lit(True))
        read = (spec.source_table, spec.source_key, value)
        if read not in small:
            small[read] = fits_broadcast(dim.select(*dict.fromkeys((spec.source_key, value))), broadcast_rows)
        if small[read]:
            side = F.broadcast(side)
        out = out.join(side, key_expr(spec.dest_key, string_keys) == F.col(k), "left")
        prev = F.col(spec.dest_col) if spec.dest_col in df.columns else F.lit(None)
        out = (out.withColumn(spec.dest_col,
                              F.when(F.col(m).isNotNull(), F.col(v)).otherwise(prev.cast("string")))
                  .drop(k, v, m))
    return out
