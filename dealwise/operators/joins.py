"""Join helpers: size-checked broadcast and typed/string key joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Upper bounds (rows, bytes) for a dimension we are willing to ship to every executor.
# Lookup tables in the reference (stages, pipelines, users, activity types,
# currencies) hold tens to thousands of rows; persons/organizations can hold
# millions and must not be broadcast blindly.
DEFAULT_BROADCAST_ROWS = 200_000
DEFAULT_BROADCAST_BYTES = 64 << 20


def fits_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                   max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """Prove ``df`` has at most ``max_rows`` rows of at most ``max_bytes`` in all.

    ``limit(max_rows + 1)`` stops reading once the bound is crossed, so the check
    costs at most ``max_rows + 1`` rows however large ``df`` is.  Text and binary
    columns count with their bytes, fixed-width ones with 8; frames with nested
    columns count those as JSON text.
    """
    width = F.lit(0).cast("bigint")
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.dataType.typeName() in ("string", "varchar", "char", "binary"):
            width = width + F.coalesce(F.octet_length(c), F.lit(0))
        elif f.dataType.typeName() in ("array", "map", "struct", "variant"):
            width = width + F.coalesce(F.octet_length(F.to_json(c)), F.lit(0))
        else:
            width = width + 8
    rows, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum(width)).first()
    return rows <= max_rows and (size or 0) <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only behind proven bounds.

    Beyond the bound the frame is returned untouched: Catalyst plans a
    shuffle join and AQE may still switch to broadcast from runtime sizes.
    """
    return F.broadcast(df) if fits_broadcast(df, max_rows) else df


def key_expr(c: Column | str, as_string: bool = False) -> Column:
    """Join key; ``as_string`` reproduces text-typed keys (``a::text = b::text``)."""
    col = F.col(c) if isinstance(c, str) else c
    return col.cast("string") if as_string else col
