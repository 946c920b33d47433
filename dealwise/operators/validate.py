"""Record validation with rejects kept aside.

A record is valid when every *present, non-null* field converts to its
declared type (lax coercion: ``"12"`` -> 12) and every required field is
present and non-null.  Instead of silently dropping bad records, the
failing ones go to a rejects frame with the list of failing fields.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType

from dealwise.functions.once import evaluate_once, project_once
from dealwise.functions.parse import clean_date, clean_timestamp, is_zero_date

CLEANED = {"date": clean_date, "timestamp": clean_timestamp}


@dataclass(frozen=True)
class FieldRule:
    name: str
    type: str
    required: bool = False
    key: str | None = None  # JSON key when it differs from the column name
    default: object = None  # V13: value of an absent key (an explicit null stays NULL)


def _record(df: DataFrame, body: str) -> Column:
    c = F.col(body)
    return F.try_parse_json(c) if isinstance(df.schema[body].dataType, StringType) else c


def extra_fields(body: Column | str, known: Sequence[str]) -> Column:
    """The record's unknown top-level keys as ``map<string,variant>``."""
    c = F.col(body) if isinstance(body, str) else body
    m = F.from_json(c, "map<string,variant>")
    return F.map_filter(m, lambda k, _: ~k.isin(*known))


def validate_stage(df: DataFrame, body: str, rules: Sequence[FieldRule],
                   keep: Sequence[str] = (), filtered: bool = True, more: str | None = None) -> DataFrame:
    """Typed fields + ``errors`` array (+ the raw body as ``__body``).

    Field values and presence flags are produced once per row as generator
    output, so the error checks and any later filter on ``errors`` read
    plain columns instead of re-running the lookups and casts.  A caller that
    filters nothing says ``filtered=False`` and gets them from compiled projections; for
    maps it may name a column ``more`` for whether a record has other keys than the rules'.
    """
    once = evaluate_once if filtered else project_once
    is_map = isinstance(df.schema[body].dataType, MapType)
    if is_map:
        # each key is searched for once; the rest reads the values found (a projection shares
        # equal subexpressions by itself)
        df = df if not filtered else once(df, **{f"__v{i}": F.try_element_at(F.col(body), F.lit(r.key or r.name)) for i, r in enumerate(rules)})
        rec = F.col(body)
    else:
        df = once(df, __vrec=_record(df, body))
        rec = F.col("__vrec")

    def get(i: int, r: FieldRule, typ: str) -> Column:
        if not is_map:
            return F.try_variant_get(rec, f"$.{r.key or r.name}", typ)
        v = F.col(f"__v{i}") if filtered else F.try_element_at(F.col(body), F.lit(r.key or r.name))
        return v if typ == "variant" else F.try_variant_get(v, "$", typ)

    fields: dict[str, Column] = {}
    for i, r in enumerate(rules):
        raw = get(i, r, "variant")
        if r.type in CLEANED:
            # V3/V4: "no date" is NULL and no error
            text = get(i, r, "string")
            fields[r.name] = CLEANED[r.type](text)
            fields[f"__z_{r.name}"] = F.coalesce(is_zero_date(text), F.lit(False))
        else:
            fields[r.name] = get(i, r, r.type)
        if r.default is not None:
            fields[r.name] = F.when(raw.isNull(), F.lit(r.default).cast(r.type)).otherwise(fields[r.name])
        fields[f"__p_{r.name}"] = raw.isNotNull() & ~F.is_variant_null(raw)
    fields["__bad"] = F.lit(False) if is_map else (rec.isNull() & F.col(body).isNotNull())
    if more:
        found = {r.key or r.name: get(i, r, "variant").isNotNull().cast("int") for i, r in enumerate(rules)}
        fields[more] = F.coalesce(F.size(body) > reduce(lambda a, b: a + b, found.values(), F.lit(0)), F.lit(False))
    staged = once(df, **fields)
    errs = []
    for r in rules:
        present, val = F.col(f"__p_{r.name}"), F.col(r.name)
        if r.type in CLEANED:
            present = present & ~F.col(f"__z_{r.name}")
        errs.append(F.when(~present, F.lit(f"{r.name}:missing") if r.required else F.lit(None))
                     .when(val.isNull(), F.lit(f"{r.name}:{r.type}")))
    # the list is made only where there is an error: filters of arrays are never compiled
    errors = F.when(F.coalesce(*errs, F.lit(None).cast("string")).isNotNull(), F.filter(F.array(*errs), lambda x: x.isNotNull())) \
        .otherwise(F.array().cast("array<string>"))
    errors = F.when(F.col("__bad"), F.array(F.lit("record:json"))).otherwise(errors)
    return staged.select(*keep, *[r.name for r in rules], errors.alias("errors"),
                         F.col(body).alias("__body"), *([more] if more else []))


def validate_records(df: DataFrame, body: str, rules: Sequence[FieldRule],
                     keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """V1: ``(valid, rejects)``; both derive from one staged projection.

    Writers that emit both sides should persist the staged frame or write
    both sides from one ``foreachBatch`` so the source is read once.
    """
    staged = validate_stage(df, body, rules, keep)
    valid = staged.filter(F.size("errors") == 0).drop("errors", "__body")
    rejects = staged.filter(F.size("errors") > 0).select(
        *keep, F.col("__body").alias(body), "errors")
    return valid, rejects
