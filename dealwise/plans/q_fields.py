"""Field-level queries: tolerant parsing and custom-field explosion (X*, V*).

Raw API records are built from driver-table rows as JSON text (by Spark, per
row), parsed to VARIANT and decoded by the package functions.  Each shape the
source system emits (number, numeric string, junk, null, object, list, CSV)
is injected on a fixed residue of the row key, so the whole table runs and
every branch is exercised.  The oracle computes the expected typed values
straight from the source columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dealwise.functions import custom_fields as X
from dealwise.functions import parse as P
from dealwise.functions.text import slugify
from dealwise.operators.options import decode_options
from dealwise.operators.validate import FieldRule, extra_fields, validate_records
from dealwise.plans.registry import register
from dealwise.sources.tables import read_table
from dealwise.sources.tables import read_table as scan_table
from dealwise.spec import FieldMeta


def jq(c: Column) -> Column:
    """A string column as a JSON string literal (escaped)."""
    return F.regexp_extract(F.to_json(F.array(c)), r"^\[(.*)\]$", 1)


def jnum(c: Column) -> Column:
    return c.cast("string")


def obj(*pairs: tuple[str, Column]) -> Column:
    """JSON object text from (key, json-text) pairs."""
    parts: list[Column] = [F.lit("{")]
    for i, (k, v) in enumerate(pairs):
        parts += [F.lit(("," if i else "") + f'"{k}":'), v]
    parts.append(F.lit("}"))
    return F.concat(*parts)


def case(key: Column, mod: int, *branches: Column) -> Column:
    """JSON text chosen by ``key % mod`` (branch i for residue i)."""
    e = None
    for i, b in enumerate(branches):
        e = F.when(key % mod == i, b) if e is None else e.when(key % mod == i, b)
    return e


NORM_SLUG = ("regexp_replace(regexp_replace(regexp_replace(lower({x}), "
             "'[^\\pL\\pN_]+', '_', 'g'), '^_+|_+$', '', 'g'), '_{{2,}}', '_', 'g')")


# ---------------------------------------------------------------- X1 slug
@register("slugify", f"""
SELECT 'doc' AS src, doc_id AS id, {NORM_SLUG.format(x='text')} AS slug FROM documents
UNION ALL
SELECT 'part', p_partkey, {NORM_SLUG.format(x="p_name || ' ' || p_brand || ' (' || p_type || ')'")}
FROM part
""")
def q_slugify(spark: SparkSession, base: str) -> DataFrame:
    """X1 over whole document texts and part labels."""
    d = read_table(spark, base, "documents").select(
        F.lit("doc").alias("src"), F.col("doc_id").alias("id"), slugify(F.col("text")).alias("slug"))
    p = read_table(spark, base, "part")
    label = F.concat_ws("", "p_name", F.lit(" "), "p_brand", F.lit(" ("), "p_type", F.lit(")"))
    return d.unionByName(p.select(F.lit("part").alias("src"), F.col("p_partkey").alias("id"),
                                  slugify(label).alias("slug")))


# ------------------------------------------------------- X2 X3 text/numeric
@register("explode_text_numeric", """
SELECT event_id, event_type AS note_text,
       CASE WHEN event_id % 4 IN (0, 1) THEN value END AS amount_value
FROM events
""")
def q_explode_text_numeric(spark: SparkSession, base: str) -> DataFrame:
    e = read_table(spark, base, "events")
    k = F.col("event_id")
    amount = case(k, 4, jnum(F.col("value")), jq(F.col("value").cast("string")),
                  F.lit('"x"'), F.lit("null"))
    rec = F.parse_json(obj(("note", jq(F.col("event_type"))), ("amount", amount)))
    cols = {**X.explode_text(P.field(rec, "note"), "note"),
            **X.explode_numeric(P.field(rec, "amount"), "amount")}
    return e.select("event_id", *[c.alias(n) for n, c in cols.items()])


# ---------------------------------------------------------------- X4 money
@register("explode_money", """
SELECT o_orderkey AS id,
       CASE WHEN o_orderkey % 3 IN (0, 1) THEN o_totalprice END AS price_valor,
       CASE WHEN o_orderkey % 3 = 0 THEN 'BRL' END AS price_moeda
FROM orders
""")
def q_explode_money(spark: SparkSession, base: str) -> DataFrame:
    o = read_table(spark, base, "orders")
    k, price = F.col("o_orderkey"), jnum(F.col("o_totalprice"))
    raw = case(k, 3, obj(("value", price), ("currency", F.lit('"BRL"'))), price, F.lit('"z"'))
    cols = X.explode_monetary(F.parse_json(raw), "price")
    return o.select(k.alias("id"), *[c.alias(n) for n, c in cols.items()])


# ------------------------------------------------------------ X5-X8 enums
def nation_options(spark: SparkSession, base: str, *fields: str) -> DataFrame:
    """Option metadata (field, id, label) for the enum fields, from ``nation``."""
    n = scan_table(spark, base, "nation")
    return n.select(F.explode(F.array(*[F.lit(f) for f in fields])).alias("field"), F.col("n_nationkey").alias("id"),
                    F.col("n_name").alias("label"))


@register("enum_decode", """
WITH e AS (SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)
SELECT e.event_id,
       CASE WHEN e.event_id % 5 IN (0, 1) THEN n1.n_name END AS segment_label,
       [n1.n_name, n2.n_name, NULL::VARCHAR] AS regions_label,
       [n1.n_name, n2.n_name] AS tags_label,
       e.event_type AS kind_label
FROM e
LEFT JOIN nation n1 ON n1.n_nationkey = e.k
LEFT JOIN nation n2 ON n2.n_nationkey = (e.k + 7) % 40
""")
def q_enum_decode(spark: SparkSession, base: str) -> DataFrame:
    """X5 single id, X6 id list, X7 CSV ids, X8 enum without options."""
    e = read_table(spark, base, "events")
    k = F.try_variant_get(F.parse_json("props"), "$.k", "bigint")
    k2 = ((k + 7) % 40).cast("string")
    i = F.col("event_id")
    single = case(i, 5, k.cast("string"), jq(k.cast("string")), F.lit('"x"'), F.lit("null"),
                  jq(F.concat(F.lit(" "), k.cast("string"))))
    multi = F.concat(F.lit("["), k.cast("string"), F.lit(',"'), k2, F.lit('","x",99]'))
    csv = jq(F.concat(k.cast("string"), F.lit(", "), k2, F.lit(",x")))
    decoded = decode_options(
        e, "event_id", {"segment_label": (F.parse_json(single), False), "regions_label": (F.parse_json(multi), True),
                        "tags_label": (F.parse_json(csv), True)},
        nation_options(spark, base, "segment_label", "regions_label", "tags_label"))
    kind = X.explode_enum(F.parse_json(jq(F.col("event_type"))), "kind")["kind_label"]
    return decoded.select("event_id", "segment_label", "regions_label", "tags_label", kind.alias("kind_label"))


@register("enum_decode_large", """
WITH o AS (SELECT l_orderkey * 8 + l_linenumber AS id, max(l_returnflag || '-' || CAST(l_partkey AS VARCHAR)) AS label
           FROM lineitem GROUP BY 1),
c AS (SELECT c_custkey, [c_custkey * 8 + 1, c_custkey * 16 + 3, c_custkey * 8 + 2, -1, c_custkey * 8 + 1] AS ids FROM customer),
u AS (SELECT c_custkey, unnest(ids) AS id, unnest(range(len(ids))) AS pos FROM c)
SELECT u.c_custkey, list(o.label ORDER BY pos) FILTER (pos <> 3) AS tags_label,
       any_value(o.label) FILTER (pos = 0) AS first_label
FROM u LEFT JOIN o ON o.id = u.id GROUP BY u.c_custkey
""")
def q_enum_decode_large(spark: SparkSession, base: str) -> DataFrame:
    """X5 X6 with an option per line item: too many for a literal, joined in their order."""
    li = read_table(spark, base, "lineitem")
    options = li.groupBy((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id")).agg(
        F.max(F.concat(F.col("l_returnflag"), F.lit("-"), F.col("l_partkey").cast("string"))).alias("label"))
    options = options.select(F.explode(F.array(F.lit("tags_label"), F.lit("first_label"))).alias("field"), "id", "label")
    c = read_table(spark, base, "customer")
    k = F.col("c_custkey")
    ids = [(k * 8 + 1).cast("string"), jq((k * 16 + 3).cast("string")), (k * 8 + 2).cast("string"), F.lit('"x"'),
           (k * 8 + 1).cast("string")]
    tags = F.concat(F.lit("["), F.concat_ws(",", *ids), F.lit("]"))
    return decode_options(c.select("c_custkey"), "c_custkey", {"tags_label": (F.parse_json(tags), True),
                          "first_label": (F.parse_json((k * 8 + 1).cast("string")), False)}, options)


# ------------------------------------------------------------ X9 address
@register("address_components", """
SELECT c_custkey AS id,
  CASE c_custkey % 4 WHEN 2 THEN 'Rua ' || c_name END AS addr_formatted_address,
  CASE c_custkey % 4 WHEN 1 THEN CAST(c_custkey % 100 AS VARCHAR) END AS addr_street_number,
  CASE c_custkey % 4 WHEN 1 THEN 'Rua ' || CAST(c_custkey AS VARCHAR) END AS addr_route,
  NULL::VARCHAR AS addr_sublocality, NULL::VARCHAR AS addr_subpremise,
  CASE c_custkey % 4 WHEN 0 THEN 'City ' || CAST(c_nationkey AS VARCHAR) END AS addr_locality,
  CASE c_custkey % 4 WHEN 0 THEN c_mktsegment END AS addr_aal1,
  NULL::VARCHAR AS addr_aal2,
  CASE c_custkey % 4 WHEN 0 THEN 'BR' END AS addr_country,
  CASE c_custkey % 4 WHEN 0 THEN lpad(CAST(c_custkey AS VARCHAR), 8, '0') END AS addr_postal_code
FROM customer
""")
def q_address_components(spark: SparkSession, base: str) -> DataFrame:
    c = read_table(spark, base, "customer")
    k = F.col("c_custkey")
    as_obj = F.to_json(F.struct(F.lit("BR").alias("country"),
                                F.col("c_mktsegment").alias("admin_area_level_1"),
                                F.concat(F.lit("City "), F.col("c_nationkey").cast("string")).alias("locality"),
                                F.lpad(k.cast("string"), 8, "0").alias("postal_code")))
    as_json_text = jq(F.to_json(F.struct(F.concat(F.lit("Rua "), k.cast("string")).alias("route"),
                                         (k % 100).cast("string").alias("street_number"))))
    raw = case(k, 4, as_obj, as_json_text, jq(F.concat(F.lit("Rua "), F.col("c_name"))), F.lit('"  "'))
    cols = X.explode_address(F.parse_json(raw), "addr")
    return c.select(k.alias("id"), *[v.alias(n) for n, v in cols.items()])


# ------------------------------------------------------------ X10 contacts
@register("contact_list", """
SELECT c_custkey AS id,
  CASE WHEN c_custkey % 5 = 0 THEN CAST([] AS VARCHAR[])
       ELSE ['w' || CAST(c_custkey AS VARCHAR) || '@example.com',
             'h' || CAST(c_custkey AS VARCHAR) || '@example.com'] END AS email_list,
  CASE WHEN c_custkey % 5 <> 0 AND c_custkey % 2 = 0
       THEN 'h' || CAST(c_custkey AS VARCHAR) || '@example.com' END AS email_primary_value,
  CASE WHEN c_custkey % 5 <> 0 AND c_custkey % 2 = 0 THEN 'home' END AS email_primary_label
FROM customer
""")
def q_contact_list(spark: SparkSession, base: str) -> DataFrame:
    c = read_table(spark, base, "customer")
    k = F.col("c_custkey")
    w = jq(F.concat(F.lit("w"), k.cast("string"), F.lit("@example.com")))
    h = jq(F.concat(F.lit("h"), k.cast("string"), F.lit("@example.com")))
    prim = F.when(k % 2 == 0, F.lit("true")).otherwise(F.lit("false"))
    arr = F.concat(F.lit("["), obj(("value", w), ("primary", F.lit("false")), ("label", F.lit('"work"'))),
                   F.lit(","), obj(("value", h), ("primary", prim), ("label", F.lit('"home"'))),
                   F.lit(',{"value":""},7]'))
    raw = F.when(k % 5 == 0, F.lit('"n/a"')).otherwise(arr)
    cols = X.explode_contact_list(F.parse_json(raw), "email")
    return c.select(k.alias("id"), *[v.alias(n) for n, v in cols.items()])


# ------------------------------------------------ X11 X12 X13 typed fields
@register("typed_custom_fields", """
SELECT event_id,
  CASE WHEN event_id % 6 = 0 THEN NULL ELSE date_trunc('second', ts) END AS due_date,
  strftime(ts, '%H:%M') AS slot_time,
  CASE event_id % 3 WHEN 0 THEN user_id WHEN 1 THEN nullif(user_id, 0) END AS owner_user_id
FROM events
""")
def q_typed_custom_fields(spark: SparkSession, base: str) -> DataFrame:
    e = read_table(spark, base, "events")
    i = F.col("event_id")
    due = F.when(i % 6 == 0, F.lit('"not a date"')).otherwise(
        jq(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")))
    slot = jq(F.date_format("ts", "HH:mm"))
    uid = jnum(F.col("user_id"))
    owner = case(i, 3, uid, obj(("value", uid), ("name", F.lit('"u"'))), F.lit('"abc"'))
    cols = {**X.REGISTRY["date"](F.parse_json(due), "due"),
            **X.REGISTRY["time"](F.parse_json(slot), "slot"),
            **X.REGISTRY["user_id"](F.parse_json(owner), "owner")}
    return e.select("event_id", *[v.alias(n) for n, v in cols.items()])


# ------------------------------------------------- X15-X18 all custom fields
# Field metadata of the synthetic tenant (configuration, not data).
EVENT_FIELDS = (
    FieldMeta("h1", "Valor Estimado", "double"),
    FieldMeta("h2", "Tipo de Evento!", "varchar"),
    FieldMeta("h3", "Nº Segmento", "enum", ((1, "um"), (2, "dois"), (3, "três"), (4, "quatro"), (5, "cinco"))),
    FieldMeta("h4", "Receita (R$)", "monetary"),
    FieldMeta("h5", "Data Prevista", "date"),
    FieldMeta("h6", "Hora", "time"),
    FieldMeta("h7", "Responsável", "user"),
    FieldMeta("h8", "Estranho", "weirdtype"),
    FieldMeta("h9", "update time", "varchar"),
)


@register("custom_fields_all", """
SELECT event_id AS id,
  date_trunc('second', ts) AS update_time,
  date_trunc('day', ts) AS data_prevista_date,
  strftime(ts, '%H:%M') AS hora_time,
  CASE CAST(json_extract(props, '$.k') AS BIGINT) % 6
       WHEN 1 THEN 'um' WHEN 2 THEN 'dois' WHEN 3 THEN 'três' WHEN 4 THEN 'quatro'
       WHEN 5 THEN 'cinco' END AS "nº_segmento_label",
  'EUR' AS receita_r_moeda,
  value AS receita_r_valor,
  user_id AS "responsável_user_id",
  event_type AS tipo_de_evento_text,
  value AS valor_estimado_value
FROM events
""")
def q_custom_fields_all(spark: SparkSession, base: str) -> DataFrame:
    """Raw records -> handlers -> explode -> normalise, as in an entity sync."""
    e = read_table(spark, base, "events")
    k = F.try_variant_get(F.parse_json("props"), "$.k", "bigint")
    val = jnum(F.col("value"))
    cf = obj(("h1", val), ("h2", jq(F.col("event_type"))), ("h3", (k % 6).cast("string")),
             ("h4", obj(("value", val), ("currency", F.lit('"EUR"')))),
             ("h5", jq(F.date_format("ts", "yyyy-MM-dd"))),
             ("h6", jq(F.date_format("ts", "HH:mm"))), ("h8", F.lit('"x"')),
             ("h9", F.lit('"ignored"')))
    raw = e.select(
        F.col("event_id").alias("id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("update_time"),
        F.col("user_id").alias("h7"),
        F.from_json(cf, "map<string,variant>").alias("custom_fields"))
    out = X.explode_custom_fields(raw, EVENT_FIELDS, pk=("id",), core=("update_time",))
    return X.normalize_schema(out, pk=("id",), core=("update_time",),
                              types={"update_time": "timestamp"},
                              time_of_day=X.time_of_day_columns(EVENT_FIELDS))


# ------------------------------------------------------------ V3 V4 dates
@register("zero_dates", """
SELECT o_orderkey AS id,
  CASE WHEN o_orderkey % 7 < 4 THEN NULL ELSE o_orderdate END AS add_time,
  CASE WHEN o_orderkey % 5 < 3 THEN NULL ELSE CAST(o_orderdate AS DATE) + 30 END AS expected_close_date
FROM orders
""")
def q_zero_dates(spark: SparkSession, base: str) -> DataFrame:
    o = read_table(spark, base, "orders")
    k = F.col("o_orderkey")
    add = case(k, 7, F.lit(""), F.lit("0000-00-00 00:00:00"), F.lit("-0001-11-30T00:00:00Z"),
               F.lit("   "), *[F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")] * 3)
    exp = case(k, 5, F.lit("0000-00-00"), F.lit("-0001-01-01"), F.lit("garbage"),
               *[F.date_format(F.date_add(F.to_date("o_orderdate"), 30), "yyyy-MM-dd")] * 2)
    return o.select(k.alias("id"), P.clean_timestamp(add).alias("add_time"),
                    P.clean_date(exp).alias("expected_close_date"))


# ------------------------------------------------------- V5 V6 X23 fk/NaN
@register("flex_fk", """
SELECT o_orderkey AS id,
  CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_custkey END AS person_id,
  CASE o_orderkey % 4 WHEN 0 THEN o_orderkey % 30 WHEN 1 THEN o_orderkey % 30
       WHEN 2 THEN o_orderkey % 30 + 100 ELSE o_orderkey % 30 + 200 END AS org_id,
  CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_totalprice END AS value
FROM orders
""")
def q_flex_fk(spark: SparkSession, base: str) -> DataFrame:
    o = read_table(spark, base, "orders")
    k = F.col("o_orderkey")
    org = (k % 30).cast("string")
    raw = case(k, 4, org, obj(("value", org), ("id", F.lit("999"))),
               obj(("value", F.lit("0")), ("id", ((k % 30) + 100).cast("string"))),
               obj(("id", ((k % 30) + 200).cast("string"))))
    nan = F.lit(float("nan"))
    person = F.when(k % 9 == 0, nan).otherwise(F.col("o_custkey").cast("double"))
    value = F.when(k % 9 == 0, nan).otherwise(F.col("o_totalprice"))
    return o.select(k.alias("id"), P.nan_to_null(person).cast("bigint").alias("person_id"),
                    P.flex_fk(F.parse_json(raw)).alias("org_id"),
                    P.nan_to_null(value).alias("value"))


# ------------------------------------------------------- V7 V8 wrap/money
@register("address_money", """
SELECT c_custkey AS id,
  CASE WHEN c_custkey % 2 = 0 THEN 'Rua ' || c_name END AS address_value,
  CASE WHEN c_custkey % 2 = 1 THEN 'BR' END AS address_country,
  CASE WHEN c_custkey % 2 = 1 THEN 'City ' || CAST(c_nationkey AS VARCHAR) END AS address_locality,
  CASE c_custkey % 3 WHEN 0 THEN c_acctbal WHEN 2 THEN 12.5 END AS money_amount,
  CASE WHEN c_custkey % 3 = 0 THEN 'BRL' END AS money_currency,
  c_custkey % 3 = 1 AS money_missing
FROM customer
""")
def q_address_money(spark: SparkSession, base: str) -> DataFrame:
    c = read_table(spark, base, "customer")
    k = F.col("c_custkey")
    addr = F.when(k % 2 == 0, jq(F.concat(F.lit("Rua "), F.col("c_name")))).otherwise(
        obj(("country", F.lit('"BR"')),
            ("locality", jq(F.concat(F.lit("City "), F.col("c_nationkey").cast("string"))))))
    bal = jnum(F.col("c_acctbal"))
    mon = case(k, 3, obj(("value", bal), ("currency", F.lit('"BRL"'))), bal,
               obj(("value", F.lit('"12.5"'))))
    a = P.wrap_address(F.parse_json(addr))
    m = P.money(F.parse_json(mon))
    return c.select(k.alias("id"), a["value"].alias("address_value"),
                    a["country"].alias("address_country"), a["locality"].alias("address_locality"),
                    m["amount"].alias("money_amount"), m["currency"].alias("money_currency"),
                    m.isNull().alias("money_missing"))


# ---------------------------------------------------- V9 V10 V11 user flags
@register("user_flags", """
SELECT s_suppkey AS id,
  CASE s_suppkey % 6 WHEN 0 THEN -180 WHEN 1 THEN 330 WHEN 2 THEN 60
       WHEN 3 THEN CAST(s_suppkey AS INTEGER) END AS timezone_offset,
  CASE s_suppkey % 3 WHEN 0 THEN CAST(s_nationkey AS VARCHAR) WHEN 2 THEN 'pt' END AS lang,
  CASE s_suppkey % 6 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true WHEN 3 THEN true
       WHEN 4 THEN false END AS active_flag
FROM supplier
""")
def q_user_flags(spark: SparkSession, base: str) -> DataFrame:
    s = read_table(spark, base, "supplier")
    k = F.col("s_suppkey")
    off = case(k, 6, F.lit('"-03:00"'), F.lit('"+05:30"'), F.lit('"60"'), k.cast("string"),
               F.lit('""'), F.lit('"a:b"'))
    lang = case(k, 3, F.col("s_nationkey").cast("string"), F.lit('"  "'), F.lit('"pt"'))
    flag = case(k, 6, F.lit("1"), F.lit('"0"'), F.lit('"TRUE"'), F.lit('"no"'), F.lit('""'),
                F.lit("null"))
    return s.select(k.alias("id"),
                    P.utc_offset_minutes(F.parse_json(off)).alias("timezone_offset"),
                    P.lang_norm(F.parse_json(lang)).alias("lang"),
                    P.flex_bool(F.parse_json(flag)).alias("active_flag"))


# ----------------------------------------------------- V13 V15 defaults/extras
@register("defaults_extras", """
SELECT event_id,
  CASE WHEN event_id % 4 = 0 THEN false WHEN event_id % 3 = 0 THEN true
       WHEN event_id % 3 = 1 THEN false END AS done,
  ['x_' || event_type] AS extra_keys
FROM events
""")
def q_defaults_extras(spark: SparkSession, base: str) -> DataFrame:
    e = read_table(spark, base, "events")
    i = F.col("event_id")
    done = case(i, 3, F.lit("true"), F.lit("false"), F.lit("null"))
    head = F.concat(F.lit('{"id":'), jnum(i), F.lit(',"kind":'), jq(F.col("event_type")),
                    F.lit(',"score":'), jnum(F.col("value")),
                    F.lit(',"x_'), F.col("event_type"), F.lit('":1'))
    text = F.concat(head, F.when(i % 4 == 0, F.lit(""))
                             .otherwise(F.concat(F.lit(',"done":'), done)), F.lit("}"))
    rec = F.parse_json(text)
    extras = extra_fields(text, ("id", "kind", "score", "done"))
    return e.select(i, P.field_or_default(rec, "done", "boolean", False).alias("done"),
                    F.array_sort(F.map_keys(extras)).alias("extra_keys"))


# ----------------------------------------------------- V1 V2 V14 validation
EVENT_RULES = (
    FieldRule("id", "bigint", required=True),
    FieldRule("user_id", "bigint"),
    FieldRule("value", "double"),
    FieldRule("ts", "timestamp"),
)


def _event_landing(spark: SparkSession, base: str) -> DataFrame:
    e = read_table(spark, base, "events")
    i = F.col("event_id")
    uid = F.when(i % 13 == 0, jq(F.concat(F.lit("u"), F.col("user_id").cast("string")))) \
           .otherwise(jnum(F.col("user_id")))
    val = F.when(i % 5 == 0, F.lit('"12"')).otherwise(jnum(F.col("value")))
    ts = jq(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    with_id = obj(("id", jnum(i)), ("user_id", uid), ("value", val), ("ts", ts))
    without = obj(("user_id", uid), ("value", val), ("ts", ts))
    return e.select(i.alias("seq"), F.when(i % 17 == 0, without).otherwise(with_id).alias("body"))


@register("validate_records", """
SELECT event_id AS id, user_id,
       CASE WHEN event_id % 5 = 0 THEN 12.0 ELSE value END AS value, ts
FROM events WHERE event_id % 17 <> 0 AND event_id % 13 <> 0
""")
def q_validate_records(spark: SparkSession, base: str) -> DataFrame:
    valid, _ = validate_records(_event_landing(spark, base), "body", EVENT_RULES, keep=("seq",))
    return valid.drop("seq")


@register("reject_records", """
SELECT event_id AS seq,
       concat_ws(',', CASE WHEN event_id % 17 = 0 THEN 'id:missing' END,
                      CASE WHEN event_id % 13 = 0 THEN 'user_id:bigint' END) AS reason
FROM events WHERE event_id % 17 = 0 OR event_id % 13 = 0
""")
def q_reject_records(spark: SparkSession, base: str) -> DataFrame:
    _, rejects = validate_records(_event_landing(spark, base), "body", EVENT_RULES, keep=("seq",))
    return rejects.select("seq", F.array_join("errors", ",").alias("reason"))
