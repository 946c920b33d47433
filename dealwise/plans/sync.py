"""Entity synchronisation (C8) and the dependency-ordered run.

One lazy plan per entity:

  page landing --S1--> records --V12--> snake_case keys --V1/V14--> typed core
  + rejects --X16--> handlers --X15--> custom fields --X17/X18--> normalised
  --K10--> column cap --W3/K1--> keyed upsert --C1--> watermark

The only driver-side inputs are configuration (the entity spec and the
field metadata); data never leaves the executors except the bucket ids the
upsert touches (bounded by the bucket count).
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dealwise.functions import custom_fields as X
from dealwise.functions.once import evaluate_once, project_once
from dealwise.lookups import LOOKUPS
from dealwise.operators.enrich import enrich
from dealwise.operators.evolve import apply_column_cap, cast_declared, cast_rejects
from dealwise.operators.segments import changed_since, drop_empty_columns
from dealwise.operators.upsert import read_table_at, table_exists, upsert_table
from dealwise.operators.validate import FieldRule, validate_stage
from dealwise.session import one_row
from dealwise.spec import FieldMeta, Handler
from dealwise.streaming import state as S

CAMEL = "(?<!^)(?=[A-Z])"
#: Between keys that are renamed together, and CAMEL for such a text.
KEY_END = "\x1f"
JOINED_CAMEL = f"(?=[A-Z])(?<!^)(?<!{KEY_END})"
#: Column for record keys that are neither fields nor custom fields (JSON, NULL if none).
EXTRAS = "extra_attributes"
#: Column for what is wrong with a record (JSON of page, ordinal, body and errors, NULL if nothing).
INVALID = "__invalid"
RUN_LOG = ("flow string, started timestamp, seconds double, rows bigint, invalid_rows bigint, "
           "failed boolean, empty_batches int")


def snake_keys(record: Column) -> Column:
    """V12 on data: top-level keys ``dealTitle`` -> ``deal_title``.

    VARIANT record in, ``map<string,variant>`` out (no new VARIANT is built;
    fields are then read with map lookups).  All keys of a record are renamed in one text:
    functions of a single key run once a key and are never compiled.
    """
    m = F.try_variant_get(record, "$", "map<string,variant>")
    joined = F.array_join(F.map_keys(m), KEY_END)
    keys = F.split(F.lower(F.regexp_replace(joined, JOINED_CAMEL, "_")), KEY_END)
    # not so where a key holds the separator, or where there is no key
    parted = F.length(joined) - F.length(F.replace(joined, F.lit(KEY_END), F.lit(""))) == F.size(m) - 1
    return F.when(parted, F.map_from_arrays(keys, F.map_values(m))) \
        .otherwise(F.transform_keys(m, lambda k, _: F.lower(F.regexp_replace(k, CAMEL, "_"))))


@dataclass(frozen=True)
class Entity:
    """What a sync needs to know about one entity."""
    name: str
    table: str
    pk: tuple[str, ...]
    fields: tuple[FieldRule, ...]
    core: tuple[str, ...] = ()
    handlers: Mapping[str, Handler] = field(default_factory=dict)
    custom_fields: tuple[FieldMeta, ...] = ()
    order: str | None = "update_time"
    parsers: Mapping[str, object] = field(default_factory=dict)  # column -> Column -> Column
    time_of_day: tuple[str, ...] = ()
    column_cap: int = 1500
    buckets: int = 16
    version: str = "v2"
    endpoint: str = ""
    types: Mapping[str, str] = field(default_factory=dict)  # K13: declared column types


def transform(records: DataFrame, entity: Entity, record_col: str = "record",
              observation: Observation | None = None) -> DataFrame:
    """Records -> typed rows ready to upsert; a record that fails validation stays a row
    with its content and errors as JSON in the column INVALID, for the same job to set aside.

    With ``observation``, record and invalid-record counts are collected by
    whichever job first runs the plan (no extra pass over the data).
    """
    snake = project_once(records.select("page", "ordinal", record_col), __rec=snake_keys(F.col(record_col)))
    known = {r.key or r.name for r in entity.fields}
    staged = validate_stage(snake, "__rec", entity.fields, keep=("page", "ordinal", record_col), filtered=False, more="__more")
    if observation is not None:
        staged = staged.observe(observation, F.count(F.lit(1)).alias("records"),
                                F.count_if(F.size("errors") > 0).alias("invalid"))
    # the record becomes text again only where it is set aside
    failed = F.when(F.size("errors") > 0, F.to_json(F.struct("page", "ordinal", F.to_json(record_col).alias("body"), "errors")))
    valid = staged.withColumn(INVALID, failed).drop("errors", record_col)
    raw_map = F.col("__body")
    extras = F.map_filter(raw_map, lambda k, _: ~k.isin(*known, "custom_fields"))
    nested = F.coalesce(F.try_variant_get(F.try_element_at(raw_map, F.lit("custom_fields")), "$",
                                          "map<string,variant>"),
                        F.create_map().cast("map<string,variant>"))
    # custom fields may arrive nested (v2) or as top-level keys (v1); nested wins
    cf = F.map_concat(F.map_filter(extras, lambda k, _: ~F.array_contains(F.map_keys(nested), k)), nested)
    if "custom_fields" not in known:  # most records hold nothing but fields
        cf = F.when(F.col("__more"), cf).otherwise(F.create_map().cast("map<string,variant>"))
    typed = [entity.parsers[r.name](F.col(r.name)).alias(r.name) if r.name in entity.parsers
             else F.col(r.name) for r in entity.fields]
    rows = project_once(valid.select(*typed, "page", "ordinal", INVALID, "__body", "__more"), custom_fields=cf).drop("__body", "__more")
    # Keys that no field and no metadata knows are kept as JSON
    fields = [m.key for m in entity.custom_fields]
    unknown = F.map_filter("custom_fields", lambda k, v: ~k.isin(*fields) & v.isNotNull() & ~F.is_variant_null(v)) \
        if fields else F.map_filter("custom_fields", lambda k, v: v.isNotNull() & ~F.is_variant_null(v))
    rows = rows.withColumn(EXTRAS, F.when(F.size(unknown) > 0, F.to_json(unknown)))
    if entity.handlers:
        rows = X.apply_handlers(rows, dict(entity.handlers), pk=entity.pk)
    rows = X.explode_custom_fields(rows, entity.custom_fields, pk=entity.pk, core=entity.core,
                                   cap=entity.column_cap)
    rows = X.normalize_schema(rows, pk=entity.pk, core=entity.core,
                              time_of_day=X.time_of_day_columns(entity.custom_fields)
                              + list(entity.time_of_day))
    rows = apply_column_cap(rows, entity.column_cap, protected=tuple(entity.pk) + tuple(entity.core)
                            + ("page", "ordinal", INVALID, EXTRAS))
    return rows


def sync_entity(spark: SparkSession, records: DataFrame, entity: Entity, root: str, *,
                run_start: dt.datetime | None = None, since: dt.datetime | str | None = None,
                run_id: str | None = None) -> dict:
    """Transform and upsert one entity; stamp the watermark at the run start.

    Rejected records go to ``{root}/_rejects`` (only when there are any, known
    from the observed counts) and one row per run to ``{root}/_run_log`` (A3/A4
    read it), each in a folder of the entity and ``run_id`` (the run start unless
    given): a run or micro-batch that is replayed under its id replaces what it
    wrote.  A run that fails leaves a row with ``failed`` and raises.
    """
    run_start = run_start or dt.datetime.now(dt.timezone.utc)
    run_id = run_id or run_start.strftime("%Y%m%dT%H%M%S%f")
    t0 = time.monotonic()
    try:
        return _sync(spark, records, entity, root, run_start, since, run_id)
    except Exception:
        _log_run(spark, root, entity, run_start, run_id, time.monotonic() - t0, {}, failed=True)
        raise


def _log_run(spark: SparkSession, root: str, entity: Entity, run_start: dt.datetime, run_id: str,
             seconds: float, counts: Mapping[str, int], failed: bool = False) -> None:
    records = int(counts.get("records", 0))
    one_row(spark, (entity.name, run_start, seconds, records, int(counts.get("invalid", 0)), failed,
                    int(not failed and not records)), RUN_LOG).write.mode("overwrite").parquet(
        f"{root}/_run_log/run_entity={entity.name}/run_id={run_id}")


def _sync(spark: SparkSession, records: DataFrame, entity: Entity, root: str, run_start: dt.datetime,
          since: dt.datetime | str | None, run_id: str) -> dict:
    t0 = time.monotonic()
    obs = Observation(f"sync_{entity.name}_{uuid.uuid4().hex[:8]}")
    rows = transform(records, entity, observation=obs)
    if since is not None and entity.order and entity.order in rows.columns:
        # only the verdict is generator output: a filter on it cannot copy the projections below it
        late = evaluate_once(rows, __late=S.is_late(entity.order, since) | F.col(INVALID).isNotNull())
        rows = late.where("__late").drop("__late")
    # Latest ``order`` wins, of equal ones the record that came in last
    order = [F.col(c) for c in (entity.order, "page", "ordinal") if c and c in rows.columns]
    place = f"{root}/_rejects/run_entity={entity.name}/run_id={run_id}"

    def reject(found: DataFrame) -> None:
        r = F.from_json("body", "page long, ordinal long, body string, errors array<string>")
        (found.select(F.lit(entity.name).alias("entity"), F.lit(run_start).alias("run_start"), r.alias("r"))
         .select("entity", "run_start", "r.*").write.mode("overwrite").parquet(place))

    # Declared types on write; values that do not fit are counted by the same job
    declared = {c: t for c, t in entity.types.items() if c in rows.columns and dict(rows.dtypes)[c] != t}
    casts = Observation(f"casts_{entity.name}_{uuid.uuid4().hex[:8]}")
    if declared:
        rows = cast_declared(rows.observe(casts, *cast_rejects(rows, declared).values()), declared)
    path, held = f"{root}/{entity.table}", (*entity.pk, *entity.core)
    report = upsert_table(spark, path, rows, entity.pk, buckets=entity.buckets, order=order, drop=("page", "ordinal"),
                          aside=INVALID, set_aside=reject, batch_id=run_id, flow=f"sync:{entity.name}",
                          track=[c for c in rows.columns if c not in held],
                          note=lambda: {"counts": {**obs.get, **({k: v or 0 for k, v in casts.get.items()} if declared else {})}})
    report["pruned"] = drop_empty_columns(spark, path, held)  # K12
    counts = report["counts"]
    rejects = spark.read.parquet(place) if counts.get("invalid") else None
    seconds = time.monotonic() - t0
    _log_run(spark, root, entity, run_start, run_id, seconds, counts)
    S.set_watermark(spark, f"{root}/_state", entity.name, run_start)
    report.update(rejects=rejects, seconds=seconds)
    return report


def read_synced(spark: SparkSession, root: str, entity: Entity) -> DataFrame:
    return read_table_at(spark, f"{root}/{entity.table}")


def fill_lookups(spark: SparkSession, root: str, entity: Entity, run_id: str | None = None) -> dict:
    """Fill the label columns of a synced table from the tables synced before it.

    Lookups whose key column or source table does not exist (yet) are left out.  Only
    rows whose labels change are upserted, so a run without changes writes no bucket.
    """
    rows = read_synced(spark, root, entity)
    specs = [s for s in LOOKUPS.get(entity.table, ())
             if s.dest_key in rows.columns and table_exists(spark, f"{root}/{s.source_table}")]
    if not specs:
        return {"labels": [], "touched": []}
    tables = {t: read_table_at(spark, f"{root}/{t}") for t in {s.source_table for s in specs}}
    labels = [s.dest_col for s in specs]
    before = F.struct(*[(F.col(c) if c in rows.columns else F.lit(None)).cast("string").alias(c) for c in labels])
    held = rows.select(*entity.pk, *dict.fromkeys(s.dest_key for s in specs if s.dest_key not in entity.pk),
                       *[c for c in labels if c in rows.columns], before.alias("__before"))
    now = enrich(held, specs, tables)
    changed = now.where(~F.col("__before").eqNullSafe(F.struct(*labels))).select(*entity.pk, *labels)
    report = upsert_table(spark, f"{root}/{entity.table}", changed, entity.pk, dedupe=False, batch_id=run_id)
    return {"labels": labels, **report}


# Dependency order of the entity flows, then the derived tables.
RUN_ORDER = ("users", "pipelines", "stages", "organizations", "persons", "deals",
             "activities", "activity_types", "bi", "stage_history")


#: A source of records: a frame, or a function of the incremental bound (NULL: everything)
#: that reads only the landing partitions from there on.
Source = DataFrame | Callable[[dt.datetime | None], DataFrame]


def run_all(spark: SparkSession, sources: Mapping[str, Source], entities: Mapping[str, Entity],
            root: str, derived: Mapping[str, Callable] | None = None,
            depends: Mapping[str, Sequence[tuple[str, Sequence[str]]]] | None = None,
            run_start: dt.datetime | None = None, lookups: bool = False) -> dict:
    """Every entity in dependency order inside one application.

    The watermark of each entity decides its mode.  An entity that never ran, or
    whose endpoint cannot filter (v1), is read in FULL; others are read from the
    watermark less the skew (C2).  An entity named in ``depends`` (entity -> the tables it
    depends on with their time columns, as in ``dependencies.DEPENDENCIES``) follows C3: it
    is skipped when none of those changed since its last run (J11), which the tables'
    manifests tell without a scan.  ``derived`` steps run
    at their place in the order with ``(spark, root)``.  With ``lookups`` each synced
    table gets its labels (:func:`fill_lookups`) right after its sync.
    """
    run_start = run_start or dt.datetime.now(dt.timezone.utc)
    out = {}
    for name in RUN_ORDER:
        if name in entities and name in sources:
            entity = entities[name]
            last = S.get_watermark(spark, f"{root}/_state", entity.name)
            changed = True
            if last is not None and depends and name in depends:
                changed = any(changed_since(spark, f"{root}/{table}", columns, last) for table, columns in depends[name])
            mode, since = S.decide_sync_mode(last, entity.version, changed)
            if mode == S.SKIP:
                out[name] = {"mode": mode}
                continue
            given = sources[name]
            records = given(since) if callable(given) else given
            out[name] = {"mode": mode, **sync_entity(spark, records, entity, root, run_start=run_start, since=since)}
            if lookups:
                out[name]["lookups"] = fill_lookups(spark, root, entity)
        elif derived and name in derived:
            out[name] = derived[name](spark, root)
    return out
