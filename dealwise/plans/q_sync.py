"""Entity-sync queries (C8, C9, S5, V12 and the pipeline as a whole).

For each entity, the driver table is turned (by Spark) into API pages of raw
JSON records with camelCase keys, then synced through the full pipeline into
a fresh bucketed table; the query returns the table as read back.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dealwise import entities as E
from dealwise.dependencies import DEPENDENCIES
from dealwise.operators.segments import read_table_at, upsert_table
from dealwise.plans.registry import register
from dealwise.plans.sync import EXTRAS, Entity, read_synced, run_all, sync_entity
from dealwise.session import scratch_path, stored
from dealwise.sources.pages import build_page_landing, scan_pages
from dealwise.sources.tables import read_table
from dealwise.spec import FieldMeta


#: Start of the first run of :func:`q_run_all_ten_steps`, later than any time in the tables.
RUN_START = dt.datetime(2029, 1, 1, tzinfo=dt.timezone.utc)


def _iso(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def _records(raw: DataFrame) -> DataFrame:
    """Raw rows -> 500-record envelope pages -> scanned records."""
    pages = build_page_landing(raw, "id", 500)
    return scan_pages(pages.select("page", "value"), page_col="page")


def _run(spark: SparkSession, raw: DataFrame, entity: Entity) -> DataFrame:
    root = scratch_path(spark, f"sync/{entity.name}-{uuid.uuid4().hex}")
    sync_entity(spark, _records(raw), entity, root)
    return read_synced(spark, root, entity).drop(EXTRAS)


# ------------------------------------------------------------------ deals
# Fixed 40-hex custom-field keys of the synthetic tenant (metadata, not data).
K_VALOR = "3f1c9a7e5b2d4c6e8a0b1d3f5a7c9e1b3d5f7a90"
K_PRIOR = "9b8a7c6d5e4f3a2b1c0d9e8f7a6b5c4d3e2f1a0b"
K_ORIGEM = "0a1b2c3d4e5f60718293a4b5c6d7e8f9a0b1c2d3"

DEAL = replace(E.DEALS, custom_fields=(
    FieldMeta(K_VALOR, "Valor Estimado", "monetary"),
    FieldMeta(K_PRIOR, "Prioridade", "enum", ((1, "alta"), (2, "média"), (3, "baixa"))),
    FieldMeta(K_ORIGEM, "Origem do Lead", "varchar")))


@register("entity_sync_deals", f"""
SELECT o_orderkey AS id, 'Order #' || CAST(o_orderkey AS VARCHAR) AS title, CAST(o_totalprice AS DECIMAL(18,4)) AS value,
       'USD' AS currency,
       CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'won' ELSE 'lost' END AS status,
       o_custkey AS person_id, o_orderkey % 30 AS org_id,
       o_orderdate AS add_time, o_orderdate + INTERVAL 1 DAY AS update_time,
       o_totalprice / 2 AS valor_estimado_valor, 'BRL' AS valor_estimado_moeda,
       CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'alta' WHEN '2' THEN 'média'
            WHEN '3' THEN 'baixa' END AS prioridade_label,
       o_orderpriority AS origem_do_lead_text
FROM orders
""")
def q_entity_sync_deals(spark: SparkSession, base: str) -> DataFrame:
    """C8 for deals: v1-style custom fields as top-level hash keys."""
    return _run(spark, raw_deals(spark, base), DEAL)


def raw_deals(spark: SparkSession, base: str) -> DataFrame:
    o = read_table(spark, base, "orders")
    status = (F.when(F.col("o_orderstatus") == "O", "open").when(F.col("o_orderstatus") == "F", "won")
               .otherwise("lost"))
    raw = o.select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("Order #"), F.col("o_orderkey").cast("string")).alias("title"),
        F.col("o_totalprice").alias("value"), F.lit("USD").alias("currency"), status.alias("status"),
        F.col("o_custkey").alias("personId"), (F.col("o_orderkey") % 30).alias("orgId"),
        _iso(F.col("o_orderdate")).alias("addTime"),
        _iso(F.date_add(F.col("o_orderdate"), 1)).alias("updateTime"),
        F.struct((F.col("o_totalprice") / 2).alias("value"), F.lit("BRL").alias("currency")).alias(K_VALOR),
        F.substring("o_orderpriority", 1, 1).alias(K_PRIOR),
        F.col("o_orderpriority").alias(K_ORIGEM))
    return raw


# ----------------------------------------------------------------- persons
PERSON = replace(E.PERSONS, custom_fields=(FieldMeta("k4", "Saldo", "double"), FieldMeta("k5", "Segmento", "varchar")))


@register("entity_sync_persons", """
SELECT c_custkey AS id, c_name AS name, CAST(c_nationkey AS BIGINT) AS org_id,
       TIMESTAMP '2024-01-01 00:00:00' + c_custkey * INTERVAL 1 MINUTE AS add_time,
       TIMESTAMP '2024-01-02 00:00:00' + c_custkey * INTERVAL 1 MINUTE AS update_time,
       ['w' || CAST(c_custkey AS VARCHAR) || '@example.com'] AS email_contatos_list,
       'w' || CAST(c_custkey AS VARCHAR) || '@example.com' AS email_contatos_primary_value,
       'work' AS email_contatos_primary_label,
       ['+55 11 ' || CAST(c_custkey AS VARCHAR)] AS telefone_contatos_list,
       CASE WHEN c_custkey % 2 = 0 THEN '+55 11 ' || CAST(c_custkey AS VARCHAR) END
         AS telefone_contatos_primary_value,
       c_acctbal AS saldo_value, c_mktsegment AS segmento_text, false AS is_deleted
FROM customer
""")
def q_entity_sync_persons(spark: SparkSession, base: str) -> DataFrame:
    """C8 for persons: contact-list handlers (X16) and nested custom fields (v2)."""
    return _run(spark, raw_persons(spark, base), PERSON)


def raw_persons(spark: SparkSession, base: str) -> DataFrame:
    c = read_table(spark, base, "customer")
    k = F.col("c_custkey")
    minute = F.lit("2024-01-01 00:00:00").cast("timestamp")
    raw = c.select(
        k.alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("orgId"),
        F.array(F.struct(F.concat(F.lit("w"), k.cast("string"), F.lit("@example.com")).alias("value"),
                         F.lit(True).alias("primary"), F.lit("work").alias("label"))).alias("emails"),
        F.array(F.struct(F.concat(F.lit("+55 11 "), k.cast("string")).alias("value"),
                         (k % 2 == 0).alias("primary"))).alias("phones"),
        _iso(F.timestamp_add("MINUTE", k, minute)).alias("addTime"),
        _iso(F.timestamp_add("MINUTE", k, F.timestamp_add("DAY", F.lit(1), minute))).alias("updateTime"),
        F.struct(F.col("c_acctbal").alias("k4"), F.col("c_mktsegment").alias("k5")).alias("customFields"))
    return raw


# ------------------------------------------------------------------- users
USER = E.USERS


@register("entity_sync_users", """
SELECT s_suppkey AS id, s_name AS name, lower(replace(s_name, '#', '.')) || '@example.com' AS email,
       CASE WHEN s_suppkey % 2 = 0 THEN -180 ELSE 60 END AS timezone_offset,
       CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE CAST(s_nationkey AS VARCHAR) END AS lang,
       s_suppkey % 4 <> 0 AS active_flag,
       TIMESTAMP '2023-06-01 00:00:00' + s_suppkey * INTERVAL 1 HOUR AS created,
       TIMESTAMP '2023-07-01 00:00:00' + s_suppkey * INTERVAL 1 HOUR AS modified
FROM supplier
""")
def q_entity_sync_users(spark: SparkSession, base: str) -> DataFrame:
    """C8 for users: offset/lang/flag parsers (V9-V11) inside the sync."""
    return _run(spark, raw_users(spark, base), USER)


def raw_users(spark: SparkSession, base: str) -> DataFrame:
    s = read_table(spark, base, "supplier")
    k = F.col("s_suppkey")
    t0 = F.lit("2023-06-01 00:00:00").cast("timestamp")
    t1 = F.lit("2023-07-01 00:00:00").cast("timestamp")
    raw = s.select(
        k.alias("id"), F.col("s_name").alias("name"),
        F.concat(F.lower(F.regexp_replace("s_name", "#", ".")), F.lit("@example.com")).alias("email"),
        F.when(k % 2 == 0, F.lit("-03:00")).otherwise(F.lit("60")).alias("timezoneOffset"),
        F.when(k % 3 == 0, F.lit(" ")).otherwise(F.col("s_nationkey").cast("string")).alias("lang"),
        F.when(k % 4 == 0, F.lit("0")).otherwise(F.lit("1")).alias("activeFlag"),
        F.date_format(F.timestamp_add("HOUR", k, t0), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created"),
        F.date_format(F.timestamp_add("HOUR", k, t1), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("modified"))
    return raw


# -------------------------------------------------------------- activities
ACTIVITY = E.ACTIVITIES


@register("entity_sync_activities", """
WITH a AS (
  SELECT l_orderkey * 8 + l_linenumber AS id, l_orderkey AS deal_id,
         'Line ' || CAST(l_linenumber AS VARCHAR) AS subject, l_returnflag AS type,
         l_linestatus = 'F' AS done, CAST(l_shipdate AS DATE) AS due_date,
         '10:30' AS due_time, true AS active_flag,
         l_shipdate + CAST(l_partkey % 1000 AS INTEGER) * INTERVAL 1 SECOND AS update_time
  FROM lineitem)
SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY id ORDER BY update_time DESC,
  deal_id DESC, subject DESC, type DESC, done DESC, due_date DESC, due_time DESC) = 1
""")
def q_entity_sync_activities(spark: SparkSession, base: str) -> DataFrame:
    """C8 for activities: repeated ids in one batch (W3), time-of-day kept as text."""
    return _run(spark, raw_activities(spark, base), ACTIVITY)


def raw_activities(spark: SparkSession, base: str) -> DataFrame:
    li = read_table(spark, base, "lineitem")
    return li.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").alias("dealId"),
        F.concat(F.lit("Line "), F.col("l_linenumber").cast("string")).alias("subject"),
        F.col("l_returnflag").alias("type"), (F.col("l_linestatus") == "F").alias("done"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("dueDate"), F.lit("10:30").alias("dueTime"),
        _iso(F.timestamp_add("SECOND", (F.col("l_partkey") % 1000).cast("int"), F.col("l_shipdate")))
         .alias("updateTime"))


# --------------------------------------------------------------- pipelines
PIPELINE = E.PIPELINES


@register("entity_sync_pipelines", """
SELECT CAST(r_regionkey AS BIGINT) AS id, r_name AS name, r_regionkey + 1 AS order_nr,
       r_regionkey = 4 AS is_deleted, false AS is_selected, false AS is_deal_probability_enabled FROM region
""")
def q_entity_sync_pipelines(spark: SparkSession, base: str) -> DataFrame:
    return _run(spark, raw_pipelines(spark, base), PIPELINE)


def raw_pipelines(spark: SparkSession, base: str) -> DataFrame:
    r = read_table(spark, base, "region")
    return r.select(F.col("r_regionkey").cast("bigint").alias("id"), F.col("r_name").alias("name"),
                   (F.col("r_regionkey") + 1).alias("orderNr"),
                   F.when(F.col("r_regionkey") == 4, F.lit("true")).otherwise(F.lit("false")).alias("isDeleted"))


# ------------------------------------------------------------------ stages
STAGE = E.STAGES


@register("entity_sync_stages", """
SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name, CAST(n_regionkey AS BIGINT) AS pipeline_id,
       n_nationkey % 5 + 1 AS order_nr, n_nationkey * 4 AS deal_probability,
       false AS is_deleted, false AS is_deal_rot_enabled FROM nation
""")
def q_entity_sync_stages(spark: SparkSession, base: str) -> DataFrame:
    return _run(spark, raw_stages(spark, base), STAGE)


def raw_stages(spark: SparkSession, base: str) -> DataFrame:
    n = read_table(spark, base, "nation")
    return n.select(F.col("n_nationkey").cast("bigint").alias("id"), F.col("n_name").alias("name"),
                   F.col("n_regionkey").alias("pipelineId"), (F.col("n_nationkey") % 5 + 1).alias("orderNr"),
                   (F.col("n_nationkey") * 4).cast("string").alias("dealProbability"))


# ----------------------------------------------------------- organizations
ORG = E.ORGANIZATIONS


@register("entity_sync_organizations", """
SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name,
       CASE WHEN n_nationkey % 2 = 0 THEN CAST(n_regionkey + 1 AS BIGINT) ELSE 7 END AS owner_id,
       'Rua ' || n_name AS endereco_formatted_address,
       CASE WHEN n_nationkey % 3 = 0 THEN 'BR' END AS endereco_country, false AS is_deleted
FROM nation
""")
def q_entity_sync_organizations(spark: SparkSession, base: str) -> DataFrame:
    """C8 for organizations: object-or-scalar FK (V6) and address handler."""
    return _run(spark, raw_organizations(spark, base), ORG)


def raw_organizations(spark: SparkSession, base: str) -> DataFrame:
    n = read_table(spark, base, "nation")
    k = F.col("n_nationkey")
    owner = F.when(k % 2 == 0, F.to_json(F.struct((F.col("n_regionkey") + 1).alias("id"),
                                                  F.lit("owner").alias("name")))).otherwise(F.lit("7"))
    addr = F.when(k % 3 == 0, F.to_json(F.struct(F.concat(F.lit("Rua "), F.col("n_name")).alias("value"),
                                                 F.lit("BR").alias("country"))))\
            .otherwise(F.to_json(F.concat(F.lit("Rua "), F.col("n_name")).cast("variant")))
    raw = n.select(k.cast("bigint").alias("id"), F.col("n_name").alias("name"),
                   F.parse_json(owner).alias("ownerId"),
                   F.parse_json(addr).alias("address"))
    return raw


# ---------------------------------------------------------- activity types
ACTIVITY_TYPE = E.ACTIVITY_TYPES


@register("entity_sync_activity_types", """
SELECT p_partkey AS id, p_type || ' ' || CAST(p_size AS VARCHAR) AS name,
       lower(p_type) || '_' || CAST(p_size AS VARCHAR) AS key_string,
       p_size % 2 = 0 AS active_flag, p_size AS order_nr
FROM part
""")
def q_entity_sync_activity_types(spark: SparkSession, base: str) -> DataFrame:
    return _run(spark, raw_activity_types(spark, base), ACTIVITY_TYPE)


def raw_activity_types(spark: SparkSession, base: str) -> DataFrame:
    p = read_table(spark, base, "part")
    return p.select(F.col("p_partkey").alias("id"),
                   F.concat_ws(" ", "p_type", F.col("p_size").cast("string")).alias("name"),
                   F.concat(F.lower("p_type"), F.lit("_"), F.col("p_size").cast("string")).alias("keyString"),
                   (1 - F.col("p_size") % 2).alias("activeFlag"), F.col("p_size").alias("orderNr"))


# -------------------------------------------------------------- the whole run
def history_step(spark: SparkSession, base: str):
    """C7 as a step of the run: history runs over the synced deals until none is left."""
    from dealwise.plans.crm_views import change_log_pages
    from dealwise.streaming.backfill import history_flow

    def step(spark: SparkSession, root: str) -> dict:
        deals = read_synced(spark, root, DEAL).select("id", F.lit(None).cast("bigint").alias("stage_id"), "add_time", "update_time")
        pages, run = stored(change_log_pages(spark, base), "change-log"), 0
        budget = max(1, -(-deals.count() // 2))
        while history_flow(spark, deals, pages, root, budget, f"run-{run}"):
            run += 1
        return {"runs": run}

    return step


def bi_step(spark: SparkSession, root: str) -> dict:
    """B2: the fact of the synced tables, upserted by deal."""
    from dealwise.operators.bi import activity_rollup, build_bi_fact
    people = read_synced(spark, root, PERSON).select(
        "id", F.col("name").alias("contact_name"), F.col("email_contatos_primary_value").alias("contact_email"),
        F.col("telefone_contatos_primary_value").alias("contact_phone"))
    orgs = read_synced(spark, root, ORG).select("id", F.col("name").alias("company_name"))
    rows = build_bi_fact(read_synced(spark, root, DEAL), people, orgs, activity_rollup(read_synced(spark, root, ACTIVITY)))
    return upsert_table(spark, f"{root}/bi_deals", rows, ["deal_id"], buckets=8, dedupe=False)


@register("run_all_ten_steps", """
WITH c AS (SELECT user_id AS deal_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
           WHERE event_type <> 'view' AND NOT (event_type = 'signup' AND event_id % 2 = 0)
             AND NOT (event_id % 3 <> 1 AND CAST(json_extract(props, '$.k') AS BIGINT) = 0))
SELECT 'users' AS step, 'FULL' AS mode, (SELECT count(*) FROM supplier) AS n
UNION ALL SELECT 'pipelines', 'FULL', (SELECT count(*) FROM region)
UNION ALL SELECT 'stages', 'FULL', (SELECT count(*) FROM nation)
UNION ALL SELECT 'organizations', 'FULL', (SELECT count(*) FROM nation)
UNION ALL SELECT 'persons', 'FULL', (SELECT count(*) FROM customer)
UNION ALL SELECT 'deals', 'FULL', (SELECT count(*) FROM orders)
UNION ALL SELECT 'activities', 'FULL', (SELECT count(DISTINCT l_orderkey * 8 + l_linenumber) FROM lineitem)
UNION ALL SELECT 'activity_types', 'FULL', (SELECT count(*) FROM part)
UNION ALL SELECT 'bi', NULL, (SELECT count(*) FROM orders)
UNION ALL SELECT 'stage_history', NULL, (SELECT count(DISTINCT (deal_id, k)) FROM c WHERE deal_id IN (SELECT o_orderkey FROM orders))
UNION ALL SELECT 'organizations again', 'INCREMENTAL', (SELECT count(*) FROM nation)
UNION ALL SELECT 'deals again', 'SKIP', (SELECT count(*) FROM orders)
""")
def q_run_all_ten_steps(spark: SparkSession, base: str) -> DataFrame:
    """The ten steps in one run, then a second run whose dependency tables decide
    from the manifests' time ranges (users changed: organizations run; nothing changed
    for deals' other tables: they are skipped)."""
    from dealwise.streaming.backfill import HISTORY
    root = scratch_path(spark, f"ten/{uuid.uuid4().hex}")
    raws = {"users": raw_users, "pipelines": raw_pipelines, "stages": raw_stages, "organizations": raw_organizations,
            "persons": raw_persons, "deals": raw_deals, "activities": raw_activities, "activity_types": raw_activity_types}
    sources = {name: _records(raw(spark, base)) for name, raw in raws.items()}
    entities = {e.name: e for e in (USER, PIPELINE, STAGE, ORG, PERSON, DEAL, ACTIVITY, ACTIVITY_TYPE)}
    first = run_all(spark, sources, entities, root, derived={"bi": bi_step, "stage_history": history_step(spark, base)},
                    run_start=RUN_START)
    found = [(name, first[name].get("mode"), read_table_at(spark, f"{root}/{table}").count()) for name, table in
             [*((n, entities[n].table) for n in raws), ("bi", "bi_deals"), ("stage_history", HISTORY)]]
    # a user changes after the run; organizations depend on users, deals look at a table that did not change
    late = raw_users(spark, base).limit(1).withColumn("modified", F.lit("2030-01-01T00:00:00Z"))
    sync_entity(spark, _records(late), USER, root)
    for name, depends in (("organizations", DEPENDENCIES["organizations"]), ("deals", (("pipelines", ("add_time", "update_time")),))):
        again = run_all(spark, {name: sources[name]}, entities, root, depends={name: depends})
        found.append((f"{name} again", again[name]["mode"], read_synced(spark, root, entities[name]).count()))
    return spark.createDataFrame(found, "step string, mode string, n bigint")
