"""Custom-field metadata from the pages of a fields endpoint.

The metadata records are checked by Spark like any other records; what reaches the
driver is the checked configuration of one entity, from which the sync makes its
columns.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealwise.spec import FieldMeta

log = logging.getLogger(__name__)


def _text(record: Column, name: str) -> Column:
    """A member that is JSON text, else NULL."""
    kind = F.schema_of_variant(F.try_variant_get(record, f"$.{name}", "variant"))
    return F.when(kind == "STRING", F.try_variant_get(record, f"$.{name}", "string"))


def field_metadata(records: DataFrame, record_col: str = "record") -> DataFrame:
    """``(page, ordinal, key, name, field_type, options, reason)`` of metadata records.

    ``reason`` says why a record is no metadata (no key or no type), else NULL.
    Options without a label or with an id that is no whole number are left out.
    """
    rec = F.col(record_col)
    entries = F.try_variant_get(rec, "$.options", "array<variant>")
    options = F.transform(entries, lambda o: F.struct(
        F.trim(F.try_variant_get(o, "$.id", "string")).alias("id"),
        F.try_variant_get(o, "$.label", "string").alias("label")))
    usable = F.filter(options, lambda o: o["id"].rlike(r"^[+-]?\d{1,18}$") & o["label"].isNotNull())
    typed = F.transform(usable, lambda o: F.struct(o["id"].cast("bigint").alias("id"), o["label"].alias("label")))
    out = records.select(
        "page", "ordinal", _text(rec, "key").alias("key"), _text(rec, "name").alias("name"),
        _text(rec, "field_type").alias("field_type"),
        F.coalesce(typed, F.array().cast("array<struct<id:bigint,label:string>>")).alias("options"))
    return out.withColumn("reason", F.when(F.coalesce(F.length("key"), F.lit(0)) == 0, "key")
                          .when(F.col("field_type").isNull(), "field_type"))


def field_metas(metadata: DataFrame) -> tuple[FieldMeta, ...]:
    """The usable metadata in page order, for ``Entity.custom_fields``; of records with
    one key the last stands.  Unusable records are counted in a warning."""
    bad = metadata.where("reason is not null").count()
    if bad:
        log.warning("%d metadata records without key or type are left out", bad)
    rows = metadata.where("reason is null").orderBy("page", "ordinal").collect()
    return tuple({r["key"]: FieldMeta(r["key"], r["name"], r["field_type"],
                                      tuple((o["id"], o["label"]) for o in r["options"])) for r in rows}.values())
