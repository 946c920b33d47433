"""The CRM's own lookups (J4) and field metadata from pages."""

from __future__ import annotations

import uuid
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealwise.lookups import LOOKUPS
from dealwise.operators.enrich import enrich
from dealwise.plans import q_sync as QS
from dealwise.plans.registry import register
from dealwise.plans.sync import EXTRAS, fill_lookups, read_synced, run_all, sync_entity
from dealwise.session import scratch_path
from dealwise.sources.field_metadata import field_metadata, field_metas
from dealwise.sources.pages import build_page_landing, scan_pages
from dealwise.sources.tables import read_table
from dealwise.spec import FieldMeta

# Source tables of the lookups: driver table, id, label.
DIMENSIONS = {
    "usuarios": ("supplier", "s_suppkey", "s_name"), "pessoas": ("customer", "c_custkey", "c_name"),
    "organizacoes": ("nation", "n_nationkey", "n_name"), "etapas_funil": ("nation", "n_nationkey", "n_name"),
    "pipelines": ("region", "r_regionkey", "r_name"),
}
# Tables with lookups: driver table, id, key columns (some keys have no partner).
KEYED = {
    "negocios": ("orders", "o_orderkey", {
        "owner_id": "o_custkey % 13", "creator_user_id": "o_orderkey % 17", "person_id": "o_custkey",
        "stage_id": "o_orderkey % 30", "pipeline_id": "o_orderkey % 7"}),
    "leads": ("orders", "o_orderkey", {
        "owner_id": "o_orderkey % 11", "person_id": "o_custkey + 5", "organization_id": "o_custkey % 28"}),
    "organizacoes": ("nation", "n_nationkey", {"owner_id": "n_nationkey + 1"}),
    "pessoas": ("customer", "c_custkey", {"owner_id": "c_custkey % 12", "org_id": "c_nationkey + 2"}),
    "etapas_funil": ("nation", "n_nationkey", {"pipeline_id": "n_regionkey + 1"}),
    "atividades": ("lineitem", "l_orderkey * 8 + l_linenumber", {
        "user_id": "l_suppkey", "person_id": "l_partkey % 200", "org_id": "l_linenumber * 5",
        "created_by_user_id": "l_suppkey + 2", "assigned_to_user_id": "l_partkey % 15",
        "update_user_id": "l_orderkey % 9"}),
}


def _lookups_sql() -> str:
    parts = []
    for table, (base, ident, keys) in KEYED.items():
        for spec in LOOKUPS[table]:
            dim, key, label = DIMENSIONS[spec.source_table]
            parts.append(f"SELECT '{table}' AS tbl, CAST({ident} AS BIGINT) AS id, '{spec.dest_col}' AS label, "
                         f"d.{label} AS value FROM {base} LEFT JOIN (SELECT {key} AS k, {label} FROM {dim}) d "
                         f"ON d.k = {keys[spec.dest_key]}")
    return "\nUNION ALL\n".join(parts)


@register("lookups_all", _lookups_sql())
def q_lookups_all(spark: SparkSession, base: str) -> DataFrame:
    """All 18 lookups over the six tables, one row per label."""
    dims = {t: read_table(spark, base, src).select(F.col(k).cast("bigint").alias("id"), F.col(v).alias("name"))
            for t, (src, k, v) in DIMENSIONS.items()}
    out = []
    for table, (src, ident, keys) in KEYED.items():
        rows = read_table(spark, base, src).select(
            F.expr(ident).cast("bigint").alias("id"), *[F.expr(e).cast("bigint").alias(k) for k, e in keys.items()])
        labels = [s.dest_col for s in LOOKUPS[table]]
        done = enrich(rows, LOOKUPS[table], dims).unpivot(["id"], labels, "label", "value")
        out.append(done.select(F.lit(table).alias("tbl"), "id", "label", "value"))
    return reduce(DataFrame.unionByName, out)


@register("lookups_after_sync", """
SELECT c_custkey AS id, CAST(c_nationkey AS BIGINT) AS org_id, n_name AS org_name, NULL::VARCHAR AS owner_name
FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey
UNION ALL
SELECT CAST(n_nationkey AS BIGINT), NULL, NULL, s_name FROM nation LEFT JOIN supplier
ON s_suppkey = CASE WHEN n_nationkey % 2 = 0 THEN n_regionkey + 1 ELSE 7 END
""")
def q_lookups_after_sync(spark: SparkSession, base: str) -> DataFrame:
    """The run fills each table's labels after its sync; a second pass finds nothing to change."""
    root = scratch_path(spark, f"lookups/{uuid.uuid4().hex}")
    raws = {"users": QS.raw_users(spark, base), "organizations": QS.raw_organizations(spark, base),
            "persons": QS.raw_persons(spark, base)}
    entities = {"users": QS.USER, "organizations": QS.ORG, "persons": QS.PERSON}
    run_all(spark, {k: QS._records(v) for k, v in raws.items()}, entities, root, lookups=True)
    again = fill_lookups(spark, root, QS.PERSON)
    if again["touched"]:
        raise AssertionError(f"unchanged labels were written: {again}")
    people = read_synced(spark, root, QS.PERSON).select("id", "org_id", "org_name", F.lit(None).cast("string").alias("owner_name"))
    orgs = read_synced(spark, root, QS.ORG).select(
        "id", F.lit(None).cast("bigint").alias("org_id"), F.lit(None).cast("string").alias("org_name"), "owner_name")
    return people.unionByName(orgs)


def _metadata_records(spark: SparkSession, base: str) -> DataFrame:
    """Each part as a metadata record; some lack a key or type, some options are unusable."""
    k = F.col("p_partkey")
    options = F.concat(F.lit('[{"id":'), F.col("p_size").cast("string"), F.lit(',"label":"'), F.col("p_brand"),
                       F.lit('"},{"id":" 12 ","label":7},{"id":"x","label":"no id"},{"id":3},{"id":"1.5","label":"half"}]'))
    raw = read_table(spark, base, "part").select(
        k.alias("id"),
        F.parse_json(F.when(k % 7 == 0, "5").when(k % 7 == 1, '""').when(k % 7 == 2, "null")
                     .otherwise(F.concat(F.lit('"f'), k.cast("string"), F.lit('"')))).alias("key"),
        F.when(k % 5 != 0, F.col("p_name")).alias("name"),
        F.parse_json(F.when(k % 11 == 0, "9").otherwise('"enum"')).alias("field_type"),
        F.parse_json(F.when(k % 3 == 0, options).when(k % 3 == 1, '"none"').otherwise("[]")).alias("options"))
    pages = build_page_landing(raw, "id", 500)
    return scan_pages(pages.select("page", "value"), page_col="page")


@register("field_metadata_scan", """
SELECT CASE WHEN p_partkey % 7 = 0 OR p_partkey % 7 = 2 THEN NULL WHEN p_partkey % 7 = 1 THEN ''
            ELSE 'f' || CAST(p_partkey AS VARCHAR) END AS key,
       CASE WHEN p_partkey % 5 <> 0 THEN p_name END AS name,
       CASE WHEN p_partkey % 11 <> 0 THEN 'enum' END AS field_type,
       CASE WHEN p_partkey % 3 = 0 THEN CAST(p_size AS VARCHAR) || '=' || p_brand || ',12=7' ELSE '' END AS options,
       CASE WHEN p_partkey % 7 < 3 THEN 'key' WHEN p_partkey % 11 = 0 THEN 'field_type' END AS reason
FROM part
""")
def q_field_metadata_scan(spark: SparkSession, base: str) -> DataFrame:
    """Metadata records checked, unusable ones with the reason, unusable options left out."""
    listed = F.transform("options", lambda o: F.concat(o["id"].cast("string"), F.lit("="), o["label"]))
    return field_metadata(_metadata_records(spark, base)).select(
        "key", "name", "field_type", F.array_join(listed, ",").alias("options"), "reason")


@register("field_metadata_sync", """
SELECT o_orderkey AS id, o_orderpriority AS prioridade_label, o_orderpriority AS origem_do_lead_text FROM orders
""")
def q_field_metadata_sync(spark: SparkSession, base: str) -> DataFrame:
    """The option list comes from metadata pages made of the orders' priorities; the sync decodes with it."""
    priorities = read_table(spark, base, "orders").groupBy("o_orderpriority").count()
    option = F.struct(F.substring("o_orderpriority", 1, 1).alias("id"), F.col("o_orderpriority").alias("label"))
    enum = priorities.agg(F.sort_array(F.collect_list(option)).alias("options")).select(
        F.lit(0).alias("id"), F.lit(QS.K_PRIOR).alias("key"), F.lit("Prioridade").alias("name"),
        F.lit("enum").alias("field_type"), "options")
    text = enum.select(F.lit(1).alias("id"), F.lit(QS.K_ORIGEM).alias("key"), F.lit("Origem do Lead").alias("name"),
                       F.lit("varchar").alias("field_type"), F.filter("options", lambda o: F.lit(False)).alias("options"))
    broken = text.withColumn("id", F.lit(2)).withColumn("key", F.lit(None).cast("string"))
    pages = build_page_landing(enum.unionByName(text).unionByName(broken), "id", 500)
    metas: tuple[FieldMeta, ...] = field_metas(field_metadata(scan_pages(pages.select("page", "value"), page_col="page")))
    entity = replace(QS.DEAL, custom_fields=metas)
    root = scratch_path(spark, f"metadata/{uuid.uuid4().hex}")
    sync_entity(spark, QS._records(QS.raw_deals(spark, base)), entity, root)
    return read_synced(spark, root, entity).drop(EXTRAS).select("id", "prioridade_label", "origem_do_lead_text")
