"""Tolerant parsing of raw JSON values.

Raw API values are VARIANT columns (``parse_json``/``from_json`` to
``map<string,variant>``).  Every function here is a native expression: bad
input becomes NULL through the ``try_*`` family (ANSI mode is on, so a bare
cast on raw data would fail the whole job).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sentinel "zero" dates the source system emits for "no date".
ZERO_DATETIME_PREFIXES = ("0000-00-00", "-0001-11-30T00:00:00")
ZERO_DATE_EXACT = "0000-00-00"
ZERO_DATE_PREFIX = "-0001"

# Components of the source system's address objects.
ADDRESS_FIELDS = ("value", "country", "admin_area_level_1", "admin_area_level_2",
                  "locality", "sublocality", "route", "street_number", "postal_code")


def vget(v: Column, path: str, typ: str) -> Column:
    """``try_variant_get`` shorthand (lax coercion, V2: '12' -> 12, 1 -> true)."""
    return F.try_variant_get(v, path, typ)


def vstr(v: Column, path: str = "$") -> Column:
    return F.try_variant_get(v, path, "string")


def field(record: Column, key: str) -> Column:
    """Sub-value of a VARIANT object as VARIANT (SQL NULL when the key is absent)."""
    return F.try_variant_get(record, f"$.{key}", "variant")


def vkind(v: Column) -> Column:
    """Variant type name: BIGINT, DECIMAL(p,s), DOUBLE, STRING, BOOLEAN, OBJECT<..>, ARRAY<..>, VOID."""
    return F.schema_of_variant(v)


def _is_number(kind: Column) -> Column:
    return (kind.isin("BIGINT", "INT", "SMALLINT", "TINYINT", "DOUBLE", "FLOAT")
            | kind.startswith("DECIMAL"))


def is_zero_date(s: Column) -> Column:
    """Whether a text is one of the source system's ways to say "no date"."""
    t = F.trim(s)
    return reduce(lambda a, b: a | b, [t == "", t.startswith(ZERO_DATE_PREFIX),
                                       *[t.startswith(p) for p in ZERO_DATETIME_PREFIXES]])


def clean_timestamp(s: Column) -> Column:
    """V3: blank / ``0000-00-00…`` / ``-0001-11-30T00:00:00…`` -> NULL, else a UTC instant."""
    t = F.trim(s)
    zero = (t == "")
    for p in ZERO_DATETIME_PREFIXES:
        zero = zero | t.startswith(p)
    return F.when(zero, F.lit(None).cast("timestamp")).otherwise(F.try_to_timestamp(t))


def clean_date(s: Column) -> Column:
    """V4: blank / ``0000-00-00`` / ``-0001…`` -> NULL, else a date (time part dropped)."""
    t = F.trim(s)
    zero = (t == "") | (t == ZERO_DATE_EXACT) | t.startswith(ZERO_DATE_PREFIX)
    return F.when(zero, F.lit(None).cast("date")).otherwise(F.try_to_date(t))


def nan_to_null(c: Column) -> Column:
    """Floating NaN -> NULL (NaN, NaT and NA all become SQL NULL)."""
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def flex_fk(v: Column) -> Column:
    """V6: FK given as a scalar or as ``{value, id}``; a falsy ``value`` falls to ``id``."""
    return F.coalesce(F.nullif(vget(v, "$.value", "bigint"), F.lit(0)),
                      vget(v, "$.id", "bigint"),
                      vget(v, "$", "bigint"))


def wrap_address(v: Column) -> Column:
    """V7: a bare string becomes ``{value: s}``; an object keeps its fields."""
    is_str = vkind(v) == "STRING"
    fields = []
    for f in ADDRESS_FIELDS:
        from_obj = vstr(v, f"$.{f}")
        fields.append((F.when(is_str, vstr(v) if f == "value" else F.lit(None).cast("string"))
                        .otherwise(from_obj)).alias(f))
    return F.when(v.isNull() | F.is_variant_null(v), F.lit(None)).otherwise(F.struct(*fields))


def money(v: Column) -> Column:
    """V8: ``{value, currency}`` -> ``struct(amount, currency)``; other shapes -> NULL."""
    is_obj = vkind(v).startswith("OBJECT")
    return F.when(is_obj, F.struct(vget(v, "$.value", "double").alias("amount"),
                                   vstr(v, "$.currency").alias("currency")))


def utc_offset_minutes(v: Column) -> Column:
    """V9: ``'-03:00'`` -> -180, ``'+05:30'`` -> 330, ``'60'``/60 -> 60, blank or bad -> NULL."""
    t = F.trim(vstr(v))
    hhmm = r"^[+-]*\s*(\d+)\s*:\s*(\d+)\s*$"
    sign = F.when(t.startswith("-"), F.lit(-1)).otherwise(F.lit(1))
    h = F.regexp_extract(t, hhmm, 1)
    m = F.regexp_extract(t, hhmm, 2)
    by_colon = F.when(t.rlike(hhmm),
                      sign * (h.try_cast("int") * 60 + m.try_cast("int")))
    return (F.when(t.isNull() | (t == ""), F.lit(None).cast("int"))
             .when(t.contains(":"), by_colon)
             .otherwise(t.try_cast("int")))


def lang_norm(v: Column) -> Column:
    """Numeric language ids become text, blank text becomes NULL."""
    s = vstr(v)
    return F.when(F.trim(s) == "", F.lit(None).cast("string")).otherwise(s)


def flex_bool(v: Column) -> Column:
    """1/"1"/"true" -> true, 0/"0"/"false" -> false, NULL -> NULL, else truthiness."""
    kind = vkind(v)
    s = F.lower(vstr(v))
    num = vget(v, "$", "double")
    return (F.when(v.isNull() | F.is_variant_null(v), F.lit(None).cast("boolean"))
             .when(kind == "BOOLEAN", vget(v, "$", "boolean"))
             .when(_is_number(kind), num != 0)
             .when(s.isin("1", "true"), F.lit(True))
             .when(s.isin("0", "false"), F.lit(False))
             .when(kind == "STRING", s != "")
             .when(kind.startswith("ARRAY"), F.array_size(vget(v, "$", "array<variant>")) > 0)
             .when(kind.startswith("OBJECT"), s != "{}")
             .otherwise(F.lit(True)))


def truthy(v: Column) -> Column:
    """Python truthiness of a JSON value: null, false, 0, "" and empty
    arrays/objects are falsy; everything else (including the string "false")
    is truthy."""
    kind = vkind(v)
    num = vget(v, "$", "double")
    s = vstr(v)
    return (F.when(v.isNull() | F.is_variant_null(v), F.lit(False))
             .when(kind == "BOOLEAN", vget(v, "$", "boolean"))
             .when(kind == "STRING", s != "")
             .when(_is_number(kind), num != 0)
             .when(kind.startswith("ARRAY"), s != "[]")
             .when(kind.startswith("OBJECT"), s != "{}")
             .otherwise(F.lit(True)))


def field_or_default(record: Column, key: str, typ: str, default) -> Column:
    """Default only when the key is *absent*; an explicit JSON null stays NULL."""
    raw = F.try_variant_get(record, f"$.{key}", "variant")
    return (F.when(raw.isNull(), F.lit(default).cast(typ))
             .otherwise(F.try_variant_get(record, f"$.{key}", typ)))


def normalize_temporal(c: Column, declared: str) -> Column:
    """Coerce a string/timestamp column to its declared DATE or TIMESTAMP type."""
    if declared == "date":
        return F.try_to_date(c.cast("string"))
    return F.try_to_timestamp(c.cast("string"))
