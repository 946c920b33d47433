"""Keyed tables as Parquet segments under a manifest.

A table is a folder of immutable segments, each written once by one Spark job:

* the **base**, bucketed and sorted by the key, so that a merge join reads it without an
  exchange, and
* **deltas**, the batches that came since: one row per key, only the columns that the
  batch brought.  A batch writes its own rows and nothing else.

``_manifest/<version>.json`` names the segments of a version, oldest first, with their
schemas, sizes and the range of each time column.  A commit is one rename to the next
version's name that fails if the name is taken: readers see the version before or the
version after, a writer that dies before the rename leaves the table as it was, and of two
writers one starts over from the other's version.  (The file system has to refuse a rename
onto an existing name, as HDFS does; elsewhere keep to one writer at a time.)

Reading folds the deltas (the latest one that has a column and a key wins, so columns that
a batch lacks keep their values, K5) and joins the fold to the base.  Compaction merges
FANOUT deltas of one size tier into one, and all into a new base once they hold FULL_SHARE
of its bytes, so a row is rewritten a logarithmic number of times.  A column whose type
changed is cast when an older segment is read; no segment is rewritten for it (K9).

A batch's rows without a usable key are written in the same job, flagged, and copied from
there to the rejects, so the source is computed once.  With ``flow`` and ``batch_id`` the
commit also enters the batch in the table's ledger: the same batch again is not applied
again, and its report comes from the ledger (C6).
"""

from __future__ import annotations

import datetime as dt
import json
import math
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, StringType, StructField, StructType, TimestampType

from dealwise.operators.dedupe import keep_last
from dealwise.operators.evolve import align, evolved_schema, non_null_value
from dealwise.session import (delete_path, folder_bytes, list_names, path_exists, read_small, rename_new,
                              write_small)

MANIFEST = "_manifest"
#: Deltas of one tier that are merged into one; bytes of the lowest tier.
FANOUT, TIER_BYTES = 4, 4 << 20
#: Share of the base's bytes in deltas from which all are merged into a new base.
FULL_SHARE = 0.5
BAD, BODY, _ROW_ID, _SEQ = "__bad", "__body", "__row_id", "__seq"
#: The reason of rows that the caller set aside.
ASIDE = "aside"


@dataclass(frozen=True)
class Segment:
    name: str
    base: bool
    schema: StructType
    rows: int
    bytes: int
    flagged: bool = False  # holds rows without a usable key
    #: per time column: least and greatest value in microseconds, and the number of NULLs
    times: Mapping[str, tuple] = field(default_factory=dict)
    #: columns known to hold no value (neither NULL nor an empty list)
    empty: tuple[str, ...] = ()


@dataclass(frozen=True)
class Manifest:
    version: int
    schema: StructType
    pk: tuple[str, ...]
    buckets: int
    segments: tuple[Segment, ...]
    #: flow -> its last batch, with the report
    ledger: Mapping[str, dict] = field(default_factory=dict)

    def types(self) -> dict[str, DataType]:
        return {f.name: f.dataType for f in self.schema.fields}

    def key_types(self) -> dict[str, DataType]:
        return {k: self.schema[k].dataType for k in self.pk}

    def text(self) -> str:
        def seg(s: Segment) -> dict:
            return {"name": s.name, "base": s.base, "schema": json.loads(s.schema.json()), "rows": s.rows, "bytes": s.bytes,
                    "flagged": s.flagged, "times": {c: list(t) for c, t in s.times.items()}, "empty": list(s.empty)}

        return json.dumps({"schema": json.loads(self.schema.json()), "pk": list(self.pk), "buckets": self.buckets,
                           "segments": [seg(s) for s in self.segments], "ledger": dict(self.ledger)})

    @staticmethod
    def parse(version: int, text: str) -> Manifest:
        d = json.loads(text)
        segments = tuple(Segment(s["name"], s["base"], StructType.fromJson(s["schema"]), s["rows"], s["bytes"], s["flagged"],
                                 {c: tuple(t) for c, t in s["times"].items()}, tuple(s["empty"])) for s in d["segments"])
        return Manifest(version, StructType.fromJson(d["schema"]), tuple(d["pk"]), d["buckets"], segments, d["ledger"])


# ------------------------------------------------------------------ versions

def _file(path: str, version: int) -> str:
    return f"{path}/{MANIFEST}/{version:012d}.json"


def versions(spark: SparkSession, path: str) -> list[int]:
    """The versions that can be read, oldest first."""
    return sorted(int(n[:-5]) for n in list_names(spark, f"{path}/{MANIFEST}") if n[:-5].isdigit() and n.endswith(".json"))


#: The last version of each table that this process has seen.
_SEEN: dict[str, int] = {}


def latest_version(spark: SparkSession, path: str) -> int | None:
    """The latest version, None if there is none.  Versions follow one another without a gap,
    so from one that is there only its successors are tried: listing them all, batch by
    batch, would grow with the square of the number of batches."""
    version = _SEEN.get(path)
    if version is None or not path_exists(spark, _file(path, version)):
        version = max(versions(spark, path), default=None)
    else:
        while path_exists(spark, _file(path, version + 1)):
            version += 1
    if version is not None:
        _SEEN[path] = version
    return version


def read_manifest(spark: SparkSession, path: str, version: int | None = None) -> Manifest | None:
    """The manifest of ``version`` (default: the latest), None if there is none."""
    if version is None:
        version = latest_version(spark, path)
        if version is None:
            return None
    text = read_small(spark, _file(path, version))
    return None if text is None else Manifest.parse(version, text)


def publish(spark: SparkSession, path: str, manifest: Manifest) -> bool:
    """Make ``manifest`` its version; False if another writer made that version."""
    draft = f"{path}/{MANIFEST}/.draft-{uuid.uuid4().hex}"
    write_small(spark, draft, manifest.text())
    if rename_new(spark, draft, _file(path, manifest.version)):
        return True
    delete_path(spark, draft)
    return False


# ------------------------------------------------------------------ segments

def _folder(path: str, name: str) -> str:
    return f"{path}/seg={name}"


def _times(schema: StructType) -> list[str]:
    return [f.name for f in schema.fields if isinstance(f.dataType, (TimestampType, DateType))]


def _write(spark: SparkSession, path: str, df: DataFrame, pk: Sequence[str], buckets: int | None,
           dealt: bool = False, track: Sequence[str] = ()) -> Segment:
    """Write one segment (a base if ``buckets``) and measure it in the same job.

    ``dealt``: the frame is hash-partitioned by the key into ``buckets`` already.  ``track``:
    columns of which to learn whether they hold a value.
    """
    name = f"{'base' if buckets else 'delta'}-{uuid.uuid4().hex}"
    schema = StructType([f for f in df.schema.fields if f.name not in (BAD, BODY)])
    bad = F.col(BAD).isNotNull() if BAD in df.columns else F.lit(False)
    stats = [F.count_if(~bad).alias("rows"), F.count_if(bad).alias("bad")]
    times = _times(schema)
    for i, c in enumerate(times):
        t = F.when(~bad, F.unix_micros(F.col(f"`{c}`").cast("timestamp")))
        stats += [F.min(t).alias(f"low{i}"), F.max(t).alias(f"high{i}"), F.count_if(~bad & t.isNull()).alias(f"nulls{i}")]
    track = [c for c in track if c in schema.names]
    for i, c in enumerate(track):
        stats.append(F.max(~bad & non_null_value(F.col(f"`{c}`"), schema[c].dataType).isNotNull()).alias(f"filled{i}"))
    seen = Observation(name)
    if buckets:
        dealt_df = df if dealt else df.repartition(buckets, *pk)
        (dealt_df.observe(seen, *stats).write.bucketBy(buckets, *pk).sortBy(*pk).mode("overwrite").format("parquet")
         .option("path", _folder(path, name)).saveAsTable(_table(name)))
    else:
        df.observe(seen, *stats).write.parquet(_folder(path, name))
    got = seen.get
    ranges = {c: (got[f"low{i}"], got[f"high{i}"], got[f"nulls{i}"]) for i, c in enumerate(times)}
    empty = tuple(c for i, c in enumerate(track) if not got[f"filled{i}"])
    return Segment(name, bool(buckets), schema, got["rows"], folder_bytes(spark, _folder(path, name)), got["bad"] > 0, ranges,
                   empty)


def _table(name: str) -> str:
    """The catalogue's name of a base: bucketed files are read as such by catalogue tables only."""
    return "seg_" + name.replace("-", "_")


def _frame(spark: SparkSession, path: str, manifest: Manifest, seg: Segment) -> DataFrame:
    """A segment's rows with the table's present types (K9: older types are cast here)."""
    fields = list(seg.schema.fields)
    if seg.flagged:
        fields.append(StructField(BAD, StringType()))
    folder = _folder(path, seg.name)
    if seg.base:
        if not spark.catalog.tableExists(_table(seg.name)):
            keys = ", ".join(f"`{k}`" for k in manifest.pk)
            spark.sql(f"CREATE TABLE IF NOT EXISTS {_table(seg.name)} ({StructType(fields).toDDL()}) USING parquet "
                      f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {manifest.buckets} BUCKETS LOCATION '{folder}'")
        df = spark.table(_table(seg.name))
    else:
        df = spark.read.schema(StructType(fields)).parquet(folder)
    if seg.flagged:
        df = df.where(F.col(BAD).isNull())
    types = manifest.types()
    return align(df, {f.name: types[f.name] for f in seg.schema.fields if f.name in types})


def _folded(frames: Sequence[DataFrame], pk: Sequence[str], buckets: int | None = None) -> tuple[DataFrame, dict[str, str]]:
    """Deltas (oldest first) as one row per key, and where each column is: columns that the
    same deltas have are one struct, NULL for a key that none of those deltas holds.

    With ``buckets`` the rows are dealt as a base with so many buckets is, so that the join
    with it moves nothing more.
    """
    groups: dict[tuple[int, ...], list[str]] = {}
    for c in dict.fromkeys(c for f in frames for c in f.columns if c not in pk):
        groups.setdefault(tuple(i for i, f in enumerate(frames) if c in f.columns), []).append(c)
    places = {c: f"__g{g}" for g, cols in enumerate(groups.values()) for c in cols}

    def packed(cols: list[str]) -> Column:
        return F.struct(*[F.col(f"`{c}`") for c in cols])

    if len(frames) == 1:
        return frames[0].select(*pk, *[packed(cols).alias(f"__g{g}") for g, cols in enumerate(groups.values())]), places
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                   [f.withColumn(_SEQ, F.lit(i)) for i, f in enumerate(frames)])
    if buckets:
        union = union.repartition(buckets, *pk)
    aggs = [F.max_by(packed(cols), F.when(F.col(_SEQ).isin(*at), F.col(_SEQ))).alias(f"__g{g}")
            for g, (at, cols) in enumerate(groups.items())]
    return (union.groupBy(*pk).agg(*aggs) if aggs else union.select(*pk).distinct()), places


def _merged(spark: SparkSession, path: str, manifest: Manifest, segments: Sequence[Segment]) -> DataFrame:
    """The rows of ``segments`` (oldest first), latest values per key."""
    frames = [_frame(spark, path, manifest, s) for s in segments]
    pk, types = list(manifest.pk), manifest.types()
    if len(frames) == 1:
        return align(frames[0], types)
    if not segments[0].base:
        fold, places = _folded(frames, pk)
        return fold.select(*[F.col(c) if c in pk else
                             (F.col(places[c])[c] if c in places else F.lit(None)).cast(t).alias(c) for c, t in types.items()])
    fold, places = _folded(frames[1:], pk, manifest.buckets)
    b, d = align(frames[0], types).alias("b"), fold.alias("d")
    rows = b.join(d, [F.col(f"b.`{k}`") == F.col(f"d.`{k}`") for k in pk], "full_outer")
    out = []
    for c in types:
        old = F.col(f"b.`{c}`")
        if c in pk:
            out.append(F.coalesce(old, F.col(f"d.`{c}`")).alias(c))
        elif c in places:  # chosen by presence, never by coalesce: a NULL in a batch wins
            new = F.col(f"d.{places[c]}")
            out.append(F.when(new.isNotNull(), new[c]).otherwise(old).alias(c))
        else:
            out.append(old.alias(c))
    return rows.select(*out)


# ------------------------------------------------------------------ reading

def table_exists(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path}/{MANIFEST}")


def read_table_at(spark: SparkSession, path: str, version: int | None = None,
                  since: tuple[str, dt.datetime] | None = None) -> DataFrame:
    """The table at ``version`` (default: the latest).

    ``since`` (time column, bound) says that the caller keeps only rows at or after the
    bound, or without a time: the oldest segments whose range shows that they hold none,
    and whose columns the later ones all have, are not read.
    """
    manifest = read_manifest(spark, path, version)
    if manifest is None:
        raise ValueError(f"{path} is not a table")
    segments = list(manifest.segments)
    while since and len(segments) > 1 and _older(segments[0], since) and all(
            {f.name for f in s.schema.fields} >= set(manifest.schema.names) for s in segments[1:]):
        segments.pop(0)
    return _merged(spark, path, manifest, segments)


def _micros(t: dt.datetime) -> int:
    t = t if t.tzinfo else t.replace(tzinfo=dt.timezone.utc)
    return (t - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(microseconds=1)


def _older(seg: Segment, since: tuple[str, dt.datetime]) -> bool:
    low_high_nulls = seg.times.get(since[0])
    if low_high_nulls is None:
        return False
    _, high, nulls = low_high_nulls
    return nulls == 0 and (high is None or high < _micros(since[1]))


def changed_since(spark: SparkSession, path: str, columns: Sequence[str], since: dt.datetime) -> bool:
    """P4 J11 without reading data: whether some segment holds a time at or after ``since``.

    The ranges are those of the rows as written, so a row that a later batch replaced by
    one with an earlier time still counts as a change.
    """
    manifest = read_manifest(spark, path)
    highs = [s.times[c][1] for s in (manifest.segments if manifest else ()) for c in columns if c in s.times]
    return any(h is not None and h >= _micros(since) for h in highs)


# ------------------------------------------------------------------ writing

def create_table(spark: SparkSession, path: str, df: DataFrame, pk: Sequence[str], buckets: int) -> None:
    """K6/K7: create the table, or replace what it holds, from ``df``; the PK must be present."""
    missing = [k for k in pk if k not in df.columns]
    if missing:
        raise ValueError(f"primary key column(s) {missing} missing")
    base = _write(spark, path, df, pk, buckets)
    while True:
        old = read_manifest(spark, path)
        if publish(spark, path, Manifest(old.version + 1 if old else 1, df.schema, tuple(pk), buckets, (base,))):
            return


def _keyed(source: DataFrame, types: Mapping[str, DataType], aside: str | None) -> DataFrame:
    """Keys cast to the table's types; a row whose key is NULL or does not fit names no
    row and gets the reason and its content beside it, as does one with text in ``aside``."""
    row = F.struct(*[F.col(f"`{c}`") for c in source.columns])
    given = source.select(*[F.col(f"`{c}`").try_cast(t).alias(f"__k_{c}") for c, t in types.items()], row.alias("__row"))
    bad = reduce(lambda a, b: a | b, [F.col(f"__k_{c}").isNull() for c in types])
    reason = F.concat_ws(",", *[F.when(F.col(f"__k_{c}").isNull(), F.when(F.col("__row").getField(c).isNull(), f"{c}:null")
                                       .otherwise(f"{c}:type")) for c in types])
    why, what = F.when(bad, reason), F.when(bad, F.to_json("__row"))
    if aside:
        given_up = F.col("__row").getField(aside)
        why, what = F.when(given_up.isNotNull(), ASIDE).otherwise(why), F.coalesce(given_up, what)
    return given.select(*[F.col(f"__k_{c}").alias(c) if c in types else F.col("__row").getField(c).alias(c)
                          for c in source.columns if c != aside], why.alias(BAD), what.alias(BODY))


def upsert_table(spark: SparkSession, path: str, source: DataFrame, pk: Sequence[str], *, buckets: int = 16,
                 insert_only: bool = False, order: Sequence[Column | str] | None = None, dedupe: bool = True,
                 batch_id: str | None = None, flow: str | None = None, note: Callable[[], dict] | None = None,
                 drop: Sequence[str] = (), aside: str | None = None,
                 set_aside: Callable[[DataFrame], None] | None = None, compact: bool = True,
                 track: Sequence[str] = ()) -> dict:
    """K1: upsert ``source`` into the table at ``path``; the first batch creates it.

    ``buckets`` counts only then; afterwards the table's own layout holds (see
    :func:`rebucket_table`).  Keys are cast to the table's key types.  Rows without a
    usable key go to ``{path}__rejects``, one folder per ``batch_id``: the same batch
    again replaces its rejects.  ``dedupe=False`` when the caller already holds one row
    per key.  ``flow`` with ``batch_id`` enters the batch in the ledger, with what
    ``note()`` says once the job has run.  Columns in ``drop`` serve ``order`` only.  Rows
    with text in the column ``aside`` are not merged either: ``set_aside`` gets them as
    ``(body)``, from the same job's files and before the commit.  ``compact=False`` leaves
    merging to :func:`compact_table`; ``track`` names columns for :func:`drop_empty_columns`.  Returns a small report.
    """
    pk = list(pk)
    missing = [k for k in pk if k not in source.columns]
    if missing:
        raise ValueError(f"source lacks primary key column(s) {missing}")
    manifest = read_manifest(spark, path)
    if manifest is not None and list(manifest.pk) != pk:
        raise ValueError(f"{path} has the key {list(manifest.pk)}, not {pk}")
    done = applied(manifest, flow, batch_id)
    if done is not None:
        return {**done, "replayed": True}
    types = manifest.key_types() if manifest else {k: source.schema[k].dataType for k in pk}
    batch = _keyed(source, types, aside)
    if dedupe:  # a row without a key is a group of its own
        order = order if order is not None else [c for c in ("update_time",) if c in source.columns]
        batch = batch.withColumn(_ROW_ID, F.when(F.col(BAD).isNotNull(), F.monotonically_increasing_id()))
        batch = keep_last(batch, [*pk, _ROW_ID], order or [F.lit(0)]).drop(_ROW_ID)
    batch = batch.drop(*drop)
    while True:
        fresh = batch
        if insert_only and manifest is not None:
            held = _merged(spark, path, manifest, manifest.segments).select(*pk)
            fresh = batch.join(held, pk, "left_anti")
        seg = _write(spark, path, fresh, pk, None if manifest else buckets, track=track)
        report = {"created": manifest is None, "rows": seg.rows, "touched": [seg.name] if seg.rows else [], "added": [],
                  "changed": [], "rejected_keys": 0}
        if seg.flagged:
            report["rejected_keys"] = _put_aside(spark, path, seg, batch_id, set_aside)
        report.update(note() if note else {})
        while True:
            now = _with_batch(manifest, seg, pk, buckets, report, flow, batch_id)
            if publish(spark, path, now):
                if not seg.base and seg not in now.segments:
                    delete_path(spark, _folder(path, seg.name))
                if compact:
                    compact_table(spark, path)
                return report
            manifest = read_manifest(spark, path)
            done = applied(manifest, flow, batch_id)
            if done is not None:
                return {**done, "replayed": True}
            if insert_only or seg.base:
                break  # what is new depends on the other writer's version


def _put_aside(spark: SparkSession, path: str, seg: Segment, batch_id: str | None,
               set_aside: Callable[[DataFrame], None] | None) -> int:
    """Copy a segment's flagged rows to where they belong; the number of unusable keys."""
    flagged = spark.read.parquet(_folder(path, seg.name)).where(F.col(BAD).isNotNull()).select(
        F.col(BAD).alias("reason"), F.col(BODY).alias("body"))
    given_up = F.col("reason") == ASIDE
    n = flagged.agg(F.count_if(given_up).alias("aside"), F.count_if(~given_up).alias("keys")).first()
    if n["aside"] and set_aside:
        set_aside(flagged.where(given_up).select("body"))
    if n["keys"]:
        (flagged.where(~given_up).write.mode("overwrite")
         .parquet(f"{path}__rejects/batch={batch_id or uuid.uuid4().hex}"))
    return n["keys"]


def applied(manifest: Manifest | None, flow: str | None, batch_id: str | None) -> dict | None:
    """The report of a batch that the table holds already."""
    entry = manifest.ledger.get(flow) if manifest and flow and batch_id is not None else None
    return dict(entry["report"]) if entry and entry["batch"] == str(batch_id) else None


def _with_batch(manifest: Manifest | None, seg: Segment, pk: list[str], buckets: int, report: dict,
                flow: str | None, batch_id: str | None) -> Manifest:
    entry = {flow: {"batch": str(batch_id), "report": dict(report)}} if flow and batch_id is not None else {}
    if manifest is None:
        return Manifest(1, seg.schema, tuple(pk), buckets, (seg,), entry)
    schema, added, changed = evolved_schema(manifest.schema, seg.schema, protected=pk)
    report.update(added=added, changed=changed)
    segments = manifest.segments + ((seg,) if seg.rows or seg.flagged else ())
    return replace(manifest, version=manifest.version + 1, segments=segments, ledger={**manifest.ledger, **entry},
                   schema=StructType([StructField(c, t) for c, t in schema.items()]))


# ------------------------------------------------------------------ compaction

def _tier(seg: Segment) -> int:
    return max(0, math.floor(math.log(max(seg.bytes, 1) / TIER_BYTES, FANOUT)) + 1) if seg.bytes >= TIER_BYTES else 0


def _due(manifest: Manifest) -> list[Segment]:
    """The segments to merge now: all, a run of deltas of one tier and one set of columns, or none."""
    base, deltas = manifest.segments[0], manifest.segments[1:]
    if len(deltas) >= FANOUT and sum(d.bytes for d in deltas) >= FULL_SHARE * base.bytes:
        return list(manifest.segments)
    tail = deltas[-FANOUT:]
    if len(tail) == FANOUT and len({_tier(d) for d in tail}) == 1:
        if len({frozenset(d.schema.names) for d in tail}) == 1:
            return list(tail)
        if len(deltas) >= FANOUT * FANOUT:
            return list(manifest.segments)
    return []


def compact_table(spark: SparkSession, path: str, full: bool = False) -> dict:
    """Merge the segments that are due (all with ``full``); the table's rows do not change."""
    manifest = read_manifest(spark, path)
    due = list(manifest.segments) if full else _due(manifest)
    if len(due) < 2:
        return {"merged": 0}
    return _replace(spark, path, manifest, due, manifest.buckets)


def rebucket_table(spark: SparkSession, path: str, buckets: int) -> None:
    """K7: lay the table out anew in ``buckets`` buckets (a maintenance job)."""
    manifest = read_manifest(spark, path)
    if manifest is None:
        raise ValueError(f"{path} is not a table")
    _replace(spark, path, manifest, list(manifest.segments), buckets)


def _replace(spark: SparkSession, path: str, manifest: Manifest, due: list[Segment], buckets: int) -> dict:
    rows = _merged(spark, path, manifest, due)
    track = sorted({c for s in due for c in s.empty})
    if due[0].base:
        # the join with the base leaves the rows dealt by the key into its buckets
        seg = _write(spark, path, rows, manifest.pk, buckets, dealt=len(due) > 1 and buckets == manifest.buckets, track=track)
    else:
        names = {f.name for s in due for f in s.schema.fields}
        seg = _write(spark, path, rows.select(*[c for c in rows.columns if c in names]), manifest.pk, None, track=track)
    while True:
        at = manifest.segments.index(due[0])
        kept = manifest.segments[:at] + (seg,) + manifest.segments[at + len(due):]
        if publish(spark, path, replace(manifest, version=manifest.version + 1, segments=kept, buckets=buckets)):
            return {"merged": len(due), "into": seg.name}
        manifest = read_manifest(spark, path)
        if manifest.segments[manifest.segments.index(due[0]) if due[0] in manifest.segments else 0:][:len(due)] != tuple(due):
            delete_path(spark, _folder(path, seg.name))  # another writer merged them
            return {"merged": 0}


def drop_empty_columns(spark: SparkSession, path: str, protected: Sequence[str] = ()) -> list[str]:
    """Leave out the columns that hold no value in any segment; the columns left out.

    Decided from what the segments' jobs counted, and done in the manifest: nothing is
    read or rewritten.  Columns that were not tracked stay.
    """
    while True:
        manifest = read_manifest(spark, path)
        segments = manifest.segments
        gone = [c for c in manifest.schema.names if c not in manifest.pk and c not in protected and segments
                and all(c in s.empty or c not in s.schema.names for s in segments)]
        if not gone:
            return []
        schema = StructType([f for f in manifest.schema.fields if f.name not in gone])
        if publish(spark, path, replace(manifest, version=manifest.version + 1, schema=schema)):
            return gone


def vacuum_table(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete versions before the last ``keep`` and the segments that only they name."""
    held = versions(spark, path)
    old, kept = held[:-keep], held[-keep:]
    live = {s.name for v in kept for s in read_manifest(spark, path, v).segments}
    gone: dict[str, Segment] = {}
    for v in old:
        gone.update({s.name: s for s in read_manifest(spark, path, v).segments if s.name not in live})
    for name, seg in gone.items():
        if seg.base:
            spark.sql(f"DROP TABLE IF EXISTS {_table(name)}")
        delete_path(spark, _folder(path, name))
    for v in old:
        delete_path(spark, _file(path, v))
    return sorted(gone)
