"""DuckDB SQL equivalents of the catalogue queries (the correctness oracle).

Views ``region nation customer supplier part orders lineitem events documents
embeddings pages benchmark labels conversations`` are registered by the
caller.  CTE fragments below mirror :mod:`dealwise.plans.crm_views`.
"""

from __future__ import annotations

ROLLUP_CTE = """
roll AS (
  SELECT l_orderkey AS id, max(l_shipdate) AS close_time,
         CAST(count(*) AS INTEGER) AS activity_count,
         max(CASE WHEN l_linestatus = 'O' THEN l_shipdate END) AS last_activity_due_date
  FROM lineitem GROUP BY l_orderkey)"""

DEALS_CTE = ROLLUP_CTE + """,
deals AS (
  SELECT o.o_orderkey AS id,
         CASE WHEN o.o_orderkey % 11 = 0 THEN NULL ELSE o.o_custkey END AS person_id,
         o.o_orderkey % 30 AS org_id,
         'Order #' || CAST(o.o_orderkey AS VARCHAR) AS title,
         CASE o.o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'won'
                              WHEN 'P' THEN 'lost' END AS status,
         o.o_totalprice AS value, 'USD' AS currency,
         o.o_orderdate AS add_time,
         coalesce(r.close_time, o.o_orderdate) AS update_time,
         r.close_time AS close_time,
         CAST(o.o_orderdate AS DATE) + 30 AS expected_close_date,
         CASE WHEN o.o_orderstatus = 'P' THEN r.close_time END AS lost_time,
         CASE WHEN o.o_orderstatus = 'F' THEN r.close_time END AS won_time,
         o.o_custkey % 100 AS creator_user_id,
         o.o_orderkey % 97 AS user_id,
         o.o_orderkey % 5 AS pipeline_id,
         o.o_orderkey % 25 AS stage_id,
         r.activity_count AS activity_count,
         r.last_activity_due_date AS last_activity_due_date
  FROM orders o LEFT JOIN roll r ON r.id = o.o_orderkey)"""

CONTACTS_CTE = """
contacts AS (
  SELECT c_custkey AS id, c_name AS contact_name,
         lower(replace(c_name, '#', '.')) || '@example.com' AS contact_email,
         '+55 11 ' || CAST(c_custkey AS VARCHAR) AS contact_phone
  FROM customer)"""

COMPANIES_CTE = """
companies AS (
  SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS company_name FROM nation)"""

DURATION = ("CAST(floor((epoch_us({close}) - epoch_us({add})) / 86400000000.0) AS INTEGER)")


def duration_sql(close: str = "close_time", add: str = "add_time") -> str:
    return DURATION.format(close=close, add=add)


BI_FACT = f"""
WITH {DEALS_CTE}, {CONTACTS_CTE}, {COMPANIES_CTE},
people AS (SELECT * FROM contacts
           QUALIFY row_number() OVER (PARTITION BY id ORDER BY id) = 1),
orgs AS (SELECT * FROM companies
         QUALIFY row_number() OVER (PARTITION BY id ORDER BY id) = 1)
SELECT d.id AS deal_id, d.title, d.status, d.value, d.currency, d.add_time,
       d.update_time, d.close_time, d.expected_close_date, d.lost_time, d.won_time,
       d.creator_user_id, d.user_id, d.pipeline_id, d.stage_id,
       p.contact_name, p.contact_email, p.contact_phone, c.company_name,
       coalesce(d.activity_count, 0) AS activity_count, d.last_activity_due_date,
       {duration_sql('d.close_time', 'd.add_time')} AS deal_duration_days,
       d.value / nullif({duration_sql('d.close_time', 'd.add_time')}, 0) AS value_per_day
FROM deals d
LEFT JOIN people p ON p.id = d.person_id
LEFT JOIN orgs c ON c.id = d.org_id
"""
