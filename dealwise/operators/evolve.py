"""Schema evolution and column hygiene.

Parquet tables cannot ``ALTER COLUMN TYPE`` or ``DROP COLUMN``, so every
change here is a projection: new columns are unioned in by name, type
changes are a ``try_cast`` to a common type, dropped columns are simply not
selected.  All decisions are taken on the driver from schemas (metadata);
the only data-dependent decision (K12) is one single-pass aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, ByteType, DataType, DateType,
                               DecimalType, DoubleType, FloatType, IntegerType, LongType,
                               MapType, NullType, ShortType, StringType, StructType,
                               TimestampType, VariantType)

from dealwise.functions.text import safe_json

_INTEGRAL = (ByteType, ShortType, IntegerType, LongType)
_RANK = {ByteType: 1, ShortType: 2, IntegerType: 3, LongType: 4}


#: Greatest precision of a Spark decimal.
MAX_DIGITS = 38
_DIGITS = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 20}


def _decimal(t: DataType) -> DecimalType:
    return t if isinstance(t, DecimalType) else DecimalType(_DIGITS[type(t)], 0)


def common_type(a: DataType, b: DataType) -> DataType:
    """K9: the type both values fit in without loss (numeric widening, else STRING).

    Exact numbers stay exact: a decimal with another decimal or an integer gives
    the decimal that holds both, and text if none does.
    """
    if a == b:
        return a
    if isinstance(a, NullType):
        return b
    if isinstance(b, NullType):
        return a
    if isinstance(a, _INTEGRAL) and isinstance(b, _INTEGRAL):
        return a if _RANK[type(a)] >= _RANK[type(b)] else b
    exact = _INTEGRAL + (DecimalType,)
    if isinstance(a, exact) and isinstance(b, exact):
        a, b = _decimal(a), _decimal(b)
        scale = max(a.scale, b.scale)
        digits = max(a.precision - a.scale, b.precision - b.scale) + scale
        return DecimalType(digits, scale) if digits <= MAX_DIGITS else StringType()
    numeric = exact + (FloatType, DoubleType)
    if isinstance(a, numeric) and isinstance(b, numeric):
        return DoubleType()
    if {type(a), type(b)} == {DateType, TimestampType}:
        return TimestampType()
    return StringType()


def _cast(c: Column, src: DataType, dst: DataType) -> Column:
    if src == dst:
        return c
    if isinstance(dst, StringType) and isinstance(src, (StructType, ArrayType, MapType)):
        return F.to_json(c)
    return c.try_cast(dst)


def align(df: DataFrame, schema: dict[str, DataType]) -> DataFrame:
    """Project ``df`` onto ``schema``: cast present columns, add missing ones as NULL."""
    cur = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for name, dt in schema.items():
        if name in cur:
            cols.append(_cast(F.col(name), cur[name], dt).alias(name))
        else:
            cols.append(F.lit(None).cast(dt).alias(name))
    return df.select(*cols)


def evolved_schema(target: StructType, source: StructType,
                   protected: Sequence[str] = ()) -> tuple[dict[str, DataType], list[str], list[str]]:
    """K8/K9: merged schema plus (added columns, type-changed columns).

    Target column order is kept; new source columns follow in source order.
    Protected columns (PK, partition key) never change type: the source is
    cast to the target's type instead.
    """
    out: dict[str, DataType] = {f.name: f.dataType for f in target.fields}
    added, changed = [], []
    for f in source.fields:
        if f.name not in out:
            out[f.name] = f.dataType
            added.append(f.name)
        elif out[f.name] != f.dataType and f.name not in protected:
            new = common_type(out[f.name], f.dataType)
            if new != out[f.name]:
                changed.append(f.name)
            out[f.name] = new
    return out, added, changed


def union_evolving(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate frames with differing columns (by name, types unified)."""
    schema: dict[str, DataType] = {}
    for df in frames:
        for f in df.schema.fields:
            schema[f.name] = common_type(schema[f.name], f.dataType) if f.name in schema else f.dataType
    out = None
    for df in frames:
        a = align(df, schema)
        out = a if out is None else out.unionByName(a)
    return out


def cast_declared(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast declared columns with ``try_cast``; others keep their type.

    A value that does not fit becomes NULL; :func:`cast_rejects` gives the
    counters of how many did.
    """
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name in types:
            c = c.try_cast(types[f.name])
        cols.append(c.alias(f.name))
    return df.select(*cols)


def cast_rejects(df: DataFrame, types: dict[str, str]) -> dict[str, Column]:
    """Per declared column, a counter of non-null values that failed to cast."""
    return {f"rejects_{n}": F.sum(F.when(F.col(n).isNotNull() & F.col(n).try_cast(t).isNull(), 1)
                                  .otherwise(0)).alias(f"rejects_{n}")
            for n, t in types.items() if n in df.columns}


def non_null_value(c: Column, dt: DataType) -> Column:
    if isinstance(dt, (ArrayType, MapType)):
        return F.when(F.size(c) > 0, c)
    if isinstance(dt, VariantType):
        return F.when(~F.is_variant_null(c), c)
    if isinstance(dt, (FloatType, DoubleType)):
        return F.when(~F.isnan(c), c)
    return c


def _as_variant(c: Column, dt: DataType) -> Column:
    if isinstance(dt, VariantType):
        return c
    if isinstance(dt, (StructType, ArrayType, MapType)):
        return F.try_parse_json(F.to_json(c))
    return c.cast("variant")


def apply_column_cap(df: DataFrame, cap: int, protected: Sequence[str] = (),
                     overflow_col: str = "custom_fields_overflow") -> DataFrame:
    """Keep at most ``cap`` columns; pack the surplus into JSON.

    Protected columns and columns in frame order come first; the overflow
    column itself counts against the cap.  Surplus values that are NULL
    (or empty arrays) are left out; a row with nothing left gets NULL.  An
    existing overflow JSON is merged with the new surplus (D13).
    """
    cols = [c for c in df.columns if c != overflow_col]
    if len(cols) + (1 if overflow_col in df.columns else 0) <= cap:
        return df
    prot = [c for c in cols if c in protected]
    rest = [c for c in cols if c not in protected]
    slots = max(cap - 1 - len(prot), 0)
    keep, spill = prot + rest[:slots], rest[slots:]
    types = {f.name: f.dataType for f in df.schema.fields}
    pairs: list[Column] = []
    for c in spill:
        pairs += [F.lit(c), _as_variant(non_null_value(F.col(f"`{c}`"), types[c]), types[c])]
    packed = F.map_filter(F.create_map(*pairs), lambda k, v: v.isNotNull())
    if overflow_col in df.columns:
        old = F.coalesce(F.from_json(F.col(overflow_col), "map<string,variant>"),
                         F.create_map().cast("map<string,variant>"))
        packed = F.map_concat(F.map_filter(old, lambda k, v: ~F.array_contains(F.map_keys(packed), k)),
                              packed)
    js = F.when(F.size(packed) > 0, safe_json(packed))
    return df.select(*[F.col(f"`{c}`") for c in keep], js.alias(overflow_col))


def non_null_counts(df: DataFrame) -> dict[str, int]:
    """A2: one aggregate pass counting non-null (non-empty) values per column."""
    exprs = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (ArrayType, MapType)):
            e = F.count_if(F.size(c) > 0)
        elif isinstance(f.dataType, VariantType):
            e = F.count_if(c.isNotNull() & ~F.is_variant_null(c))
        else:
            e = F.count(c)
        exprs.append(e.alias(f.name))
    row = df.agg(*exprs).first()
    return {f.name: int(row[i]) for i, f in enumerate(df.schema.fields)}


def drop_null_columns(df: DataFrame, protected: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """Drop columns with no non-null value (arrays: no non-empty value).

    One aggregate job computes every count; protected columns (PK, core,
    partition key) always stay.  Returns the pruned frame and the dropped
    column names.
    """
    counts = non_null_counts(df)
    dropped = [c for c, n in counts.items() if n == 0 and c not in protected]
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in dropped]), dropped


def rename_duplicates(df: DataFrame) -> DataFrame:
    """Keep every column of a frame with repeated names (``c__dupN``)."""
    from dealwise.functions.text import dedupe_names
    return df.toDF(*dedupe_names(df.columns))
