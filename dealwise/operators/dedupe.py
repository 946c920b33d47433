"""Row de-duplication (W1 keep-last, W2 keep-first, W3 one row per key).

All variants are written as a grouped ``min``/``max`` over a struct whose
leading fields are the ordering columns.  Rows with text columns make Spark plan a
sort aggregate: each input partition is sorted by key and combined before the
shuffle, so a key holding a third of all rows is one row per input partition
there, instead of being sorted in one task as a ``row_number()`` window would do.  Struct comparison is
lexicographic, so the remaining columns act as a deterministic tiebreak.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, MapType, StructType, ArrayType, VariantType

_ORDER = "__o"
_ROW = "__r"


def _orderable(dt: DataType) -> bool:
    if isinstance(dt, (MapType, VariantType)):
        return False
    if isinstance(dt, StructType):
        return all(_orderable(f.dataType) for f in dt.fields)
    if isinstance(dt, ArrayType):
        return _orderable(dt.elementType)
    return True


def _as_cols(cols: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
          last: bool) -> DataFrame:
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    order_cols = _as_cols(order)
    if all(_orderable(df.schema[c].dataType) for c in rest):
        packed = F.struct(
            F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order_cols)]).alias(_ORDER),
            F.struct(*[F.col(c) for c in rest]).alias(_ROW),
        )
        agg = F.max(packed) if last else F.min(packed)
        out = df.groupBy(*keys).agg(agg.alias("__pick"))
        return out.select(*[F.col(k) for k in keys],
                          *[F.col(f"__pick.{_ROW}.{c}").alias(c) for c in rest]
                          ).select(*df.columns)
    # Maps/variants cannot be compared: fall back to a ranking window.
    sort = [o.desc_nulls_last() if last else o.asc_nulls_first() for o in order_cols]
    w = Window.partitionBy(*keys).orderBy(*sort)
    return (df.withColumn("__rn", F.row_number().over(w))
              .filter(F.col("__rn") == 1).drop("__rn"))


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key, the one with the greatest ``order`` value."""
    return _pick(df, keys, order, last=True)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key, the one with the smallest ``order`` value."""
    return _pick(df, keys, order, last=False)
