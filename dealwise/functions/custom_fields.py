"""Custom-field explosion.

Tenant-defined fields arrive inside each record as ``custom_fields`` (or as
top-level keys).  Field metadata (a few hundred rows at most) is read on the
driver and turned into *one* ``select`` with every generated expression, so a
thousand-field tenant still yields a single projection node instead of a
thousand-deep ``withColumn`` chain.  Every generated expression is native;
no Python runs per row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructType, VariantType

from dealwise.functions import parse as P
from dealwise.functions.text import slugify_name
from dealwise.spec import FieldMeta, Handler

# Source field type -> internal kind (unknown type => skipped).
FIELD_TYPE_MAP: dict[str, str] = {
    "varchar": "text",
    "text": "text",
    "int": "numeric",
    "double": "numeric",
    "monetary": "monetary",
    "enum": "enum",
    "set": "enum",
    "phone": "phone_list",
    "phone_list": "phone_list",
    "user": "user_id",
    "person": "person_id",
    "date": "date",
    "time": "time",
    "timerange": "timerange",
    "daterange": "daterange",
    "address": "address",
    "picture": "text",
}

# Address components and their column suffixes.
ADDRESS_COMPONENTS = ("formatted_address", "street_number", "route", "sublocality",
                      "subpremise", "locality", "admin_area_level_1",
                      "admin_area_level_2", "country", "postal_code")

ColumnFn = Callable[..., dict[str, Column]]


def _digits(s: Column) -> Column:
    return s.rlike(r"^[0-9]+$")


def explode_text(v: Column, slug: str, **_) -> dict[str, Column]:
    """``{slug}_text``; objects/arrays are kept as their JSON text."""
    return {f"{slug}_text": P.vstr(v)}


def explode_numeric(v: Column, slug: str, **_) -> dict[str, Column]:
    """``{slug}_value`` as DOUBLE; unparsable -> NULL."""
    return {f"{slug}_value": P.vget(v, "$", "double")}


def explode_monetary(v: Column, slug: str, **_) -> dict[str, Column]:
    """``{slug}_valor``/``{slug}_moeda`` from ``{value, currency}`` or a bare number."""
    is_obj = P.vkind(v).startswith("OBJECT")
    return {
        f"{slug}_valor": F.when(is_obj, P.vget(v, "$.value", "double"))
                          .otherwise(P.vget(v, "$", "double")),
        f"{slug}_moeda": F.when(is_obj, P.vstr(v, "$.currency")),
    }


def options_map(options: Sequence[tuple[int, str]]) -> Column:
    """Literal ``map<bigint,string>`` of option id -> label (metadata-sized)."""
    if not options:
        return F.create_map().cast("map<bigint,string>")
    flat: list[Column] = []
    for oid, label in options:
        flat += [F.lit(int(oid)).cast("bigint"), F.lit(label)]
    return F.create_map(*flat)


def _label_of(m: Column, s: Column) -> Column:
    return F.try_element_at(m, F.trim(s).try_cast("bigint"))


def explode_enum(v: Column, slug: str, *, options: Sequence[tuple[int, str]] = (),
                 multiple: bool = False, **_) -> dict[str, Column]:
    """Option ids -> labels in ``{slug}_label``.

    Single (``multiple=False``): a digit string or integer -> its label,
    unknown id / non-digit -> NULL.  Multiple: a JSON array keeps its digit
    elements (unknown ids -> NULL elements); a CSV string is split first; a
    single id gives a one-element list.  Without options the raw value passes
    through (X8).
    """
    name = f"{slug}_label"
    kind = P.vkind(v)
    raw = P.vstr(v)
    if not options:
        return {name: raw if not multiple else
                F.when(kind.startswith("ARRAY"),
                       P.vget(v, "$", "array<string>")).otherwise(F.array(raw))}
    m = options_map(options)
    if not multiple:
        return {name: F.when(~kind.startswith("ARRAY") & _digits(raw), _label_of(m, raw))}
    arr = P.vget(v, "$", "array<variant>")
    from_arr = F.transform(F.filter(arr, lambda x: _digits(P.vstr(x))),
                           lambda x: _label_of(m, P.vstr(x)))
    parts = F.split(raw, ",")
    from_csv = F.transform(F.filter(parts, lambda x: _digits(F.trim(x))),
                           lambda x: _label_of(m, x))
    single = F.when(_digits(raw), F.array(_label_of(m, raw)))
    return {name: F.when(kind.startswith("ARRAY"), from_arr)
                   .when((kind == "STRING") & raw.contains(","), from_csv)
                   .otherwise(single)}


def explode_address(v: Column, slug: str, **_) -> dict[str, Column]:
    """Ten component columns from an object, a JSON string, or free text."""
    kind = P.vkind(v)
    text = P.vstr(v)
    parsed = F.try_parse_json(text)
    obj = (F.when(kind.startswith("OBJECT"), v)
            .when((kind == "STRING") & P.vkind(parsed).startswith("OBJECT"), parsed))
    free = (kind == "STRING") & (F.trim(text) != "") & obj.isNull()
    out = {}
    for comp in ADDRESS_COMPONENTS:
        col = f"{slug}_{comp.replace('admin_area_level_', 'aal')}"
        value = P.vstr(obj, f"$.{comp}")
        if comp == "formatted_address":
            # objects of the Address model carry the text in "value"
            value = F.coalesce(value, P.vstr(obj, "$.value"))
            value = F.when(free, text).otherwise(value)
        out[col] = value
    return out


def explode_contact_list(v: Column, slug: str, *, value_key: str = "value",
                         label_key: str = "label", primary_key: str = "primary",
                         **_) -> dict[str, Column]:
    """``{slug}_list`` (non-empty values) and the first primary's value/label."""
    arr = F.coalesce(P.vget(v, "$", "array<variant>"), F.array().cast("array<variant>"))
    values = F.filter(F.transform(arr, lambda d: P.vstr(d, f"$.{value_key}")),
                      lambda x: x.isNotNull() & (x != ""))
    # "primary" uses plain truthiness, like the source records' own consumers
    prim = F.get(F.filter(arr, lambda d: P.vkind(d).startswith("OBJECT")
                          & P.truthy(F.try_variant_get(d, f"$.{primary_key}", "variant"))), 0)
    return {
        f"{slug}_list": values,
        f"{slug}_primary_{value_key}": P.vstr(prim, f"$.{value_key}"),
        f"{slug}_primary_{label_key}": P.vstr(prim, f"$.{label_key}"),
    }


def explode_date(v: Column, slug: str, **_) -> dict[str, Column]:
    """X11: ``{slug}_date`` as a UTC timestamp, bad -> NULL."""
    return {f"{slug}_date": F.try_to_timestamp(P.vstr(v))}


def _as_text(suffix: str) -> ColumnFn:
    def fn(v: Column, slug: str, **_) -> dict[str, Column]:
        return {f"{slug}_{suffix}": P.vstr(v)}
    fn.__name__ = f"explode_{suffix}"
    fn.__doc__ = f"X12: ``{{slug}}_{suffix}`` kept as text (NULL stays NULL)."
    return fn


def _as_ref(suffix: str) -> ColumnFn:
    def fn(v: Column, slug: str, **_) -> dict[str, Column]:
        return {f"{slug}_{suffix}": P.flex_fk(v)}
    fn.__name__ = f"explode_{suffix}"
    fn.__doc__ = f"X13: ``{{slug}}_{suffix}`` as BIGINT (scalar or {{value,id}} object)."
    return fn


# Kind -> column function.  Users may register more with :func:`register_kind`.
REGISTRY: dict[str, ColumnFn] = {
    "text": explode_text,
    "numeric": explode_numeric,
    "monetary": explode_monetary,
    "enum": explode_enum,
    "address": explode_address,
    "phone_list": explode_contact_list,
    "date": explode_date,
    "time": _as_text("time"),
    "timerange": _as_text("timerange"),
    "daterange": _as_text("daterange"),
    "user_id": _as_ref("user_id"),
    "person_id": _as_ref("person_id"),
}

# Generated columns that hold time-of-day text, never parsed as instants.
TIME_OF_DAY_KINDS = ("time", "timerange", "daterange")


def time_of_day_columns(meta: Iterable[FieldMeta]) -> list[str]:
    """Names of generated columns holding time-of-day/range text (exempt from X18)."""
    out = []
    for m in meta:
        kind = FIELD_TYPE_MAP.get(m.field_type)
        if kind in TIME_OF_DAY_KINDS:
            out.append(f"{slugify_name(m.name or m.key)}_{kind}")
    return out


def register_kind(kind: str, fn: ColumnFn) -> None:
    """Add or replace a column function (returns ``{name: Column}``)."""
    REGISTRY[kind] = fn


def to_variant(df: DataFrame, name: str) -> Column:
    """A top-level column as VARIANT (atomic values are wrapped as they are;
    structs, arrays and maps become variant objects/arrays)."""
    dt = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dt, VariantType):
        return c
    if isinstance(dt, (StructType, MapType, ArrayType)):
        return F.try_parse_json(F.to_json(c))
    return c.cast("variant")


def custom_field_columns(meta: Iterable[FieldMeta], source: Callable[[str], Column | None], *,
                         pk: Sequence[str] = (), core: Sequence[str] = (),
                         handler_params: dict | None = None,
                         cap: int | None = None, used: int = 0,
                         existing: Sequence[str] = ()) -> tuple[dict[str, Column], list[str], list[str]]:
    """X15 on the driver: metadata -> ``({column: expr}, consumed keys, capped keys)``.

    ``source(key)`` returns the raw VARIANT for a key.  ``cap``/``used``
    implement the column budget: once ``used + generated`` reaches ``cap``,
    further *new* columns are not generated and their keys are reported as
    capped (the caller sends them to the overflow column).
    """
    out: dict[str, Column] = {}
    consumed: list[str] = []
    capped: list[str] = []
    existing_set = set(existing)
    handler_params = handler_params or {}
    for m in meta:
        if not m.key or m.key in pk:
            continue
        slug = slugify_name(m.name or m.key)
        if m.key in core or slug in core:
            continue
        kind = FIELD_TYPE_MAP.get(m.field_type)
        fn = REGISTRY.get(kind) if kind else None
        if fn is None:
            continue
        kwargs = dict(handler_params.get(m.key, {}))
        if kind == "enum":
            kwargs.update(options=m.options, multiple=(m.field_type == "set"))
        cols = fn(source(m.key), slug, **kwargs)
        # another field with the same label keeps its own columns, named as X19 does
        named = {}
        for c, e in cols.items():
            name, n = c, 0
            while name in out:
                n += 1
                name = f"{c}__dup{n}"
            named[name] = e
        cols = named
        new = [c for c in cols if c not in existing_set]
        if cap is not None and new and used + len(out) + len(new) > cap:
            capped.append(m.key)
            continue
        out.update(cols)
        consumed.append(m.key)
    return out, consumed, capped


def explode_custom_fields(df: DataFrame, meta: Sequence[FieldMeta], *,
                          pk: Sequence[str] = ("id",), core: Sequence[str] = (),
                          custom_col: str = "custom_fields",
                          handler_params: dict | None = None,
                          cap: int | None = None, existing: Sequence[str] = (),
                          overflow_col: str = "custom_fields_overflow") -> DataFrame:
    """Replace ``custom_col`` (``map<string,variant>`` or JSON text) and any
    top-level copies of field keys by typed columns, in one ``select``.

    Fields over the column budget are written, non-null values only, into
    ``overflow_col`` as JSON (K10) instead of being lost.
    """
    cf = None
    if custom_col in df.columns:
        dt = df.schema[custom_col].dataType
        cf = F.col(custom_col)
        if isinstance(dt, StringType):
            cf = F.from_json(cf, "map<string,variant>")
    top = set(df.columns) - {custom_col}

    def source(key: str) -> Column:
        if key in top:
            return to_variant(df, key)
        if cf is None:
            return F.lit(None).cast("variant")
        return F.try_element_at(cf, F.lit(key))

    passthrough = [c for c in df.columns if c != custom_col]
    gen, consumed, capped = custom_field_columns(
        meta, source, pk=pk, core=core, handler_params=handler_params,
        cap=None if cap is None else cap, used=len(passthrough),
        existing=list(existing) + passthrough)
    keep = [F.col(c) for c in passthrough if c not in consumed and c not in gen]
    exprs = keep + [e.alias(n) for n, e in gen.items()]
    if capped:
        pairs = []
        for k in capped:
            pairs += [F.lit(k), source(k)]
        m = F.map_filter(F.create_map(*pairs), lambda k, v: v.isNotNull() & ~F.is_variant_null(v))
        exprs.append(F.when(F.size(m) > 0, F.to_json(m)).alias(overflow_col))
    return df.select(*exprs)


def apply_handlers(df: DataFrame, handlers: dict[str, Handler], pk: Sequence[str] = ()) -> DataFrame:
    """Entity-specific handlers on top-level columns, in the same single select."""
    gen: dict[str, Column] = {}
    used: set[str] = set()
    for col, h in handlers.items():
        if col not in df.columns or col in pk:
            continue
        fn = REGISTRY[h.kind]
        gen.update(fn(to_variant(df, col), slugify_name(h.slug_name or col), **h.params))
        used.add(col)
    if not gen:
        return df
    keep = [F.col(c) for c in df.columns if c not in used and c not in gen]
    return df.select(*keep, *[e.alias(n) for n, e in gen.items()])


def normalize_schema(df: DataFrame, pk: Sequence[str], core: Sequence[str],
                     types: dict | None = None,
                     time_of_day: Sequence[str] = ()) -> DataFrame:
    """Add missing PK/core columns as typed NULLs, parse ``*_time``/``*_date``
    text columns as timestamps (zero dates are NULL; time-of-day columns excluded, D6), order
    PK, core, then the rest alphabetically, first of duplicate names wins."""
    types = types or {}
    skip_parse = set(time_of_day)
    cols: dict[str, Column] = {}
    for c in df.columns:
        if c in cols:
            continue
        e = F.col(c)
        if (c.endswith(("_time", "_date")) and c not in skip_parse
                and isinstance(df.schema[c].dataType, StringType)):
            e = P.clean_timestamp(e)
        cols[c] = e
    for c in list(pk) + list(core):
        if c not in cols:
            cols[c] = F.lit(None).cast(types.get(c, "string"))
    head = [c for c in list(dict.fromkeys(list(pk) + list(core)))]
    tail = sorted(c for c in cols if c not in head)
    return df.select(*[cols[c].alias(c) for c in head + tail])


def infer_types(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """The narrowest type that holds every value of each VARIANT column.

    One aggregate (``schema_of_variant_agg``) over the data; the result is a
    handful of type names brought to the driver.
    """
    row = df.agg(*[F.schema_of_variant_agg(F.col(c)).alias(c) for c in columns]).first()
    out = {}
    for c in columns:
        t = (row[c] or "STRING").lower()
        out[c] = "string" if t.startswith(("object", "array", "void")) else t
    return out


def cast_inferred(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Apply :func:`infer_types` results (VARIANT -> typed column)."""
    return df.select(*[F.try_variant_get(F.col(c), "$", types[c]).alias(c) if c in types else F.col(c)
                       for c in df.columns])
