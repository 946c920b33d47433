"""BI fact queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dealwise.operators.bi import build_bi_fact
from dealwise.plans import crm_views as v
from dealwise.plans import oracle as o
from dealwise.plans.registry import register


@register("bi_fact", o.BI_FACT)
def q_bi_fact(spark: SparkSession, base: str) -> DataFrame:
    """deals ⟕ contacts ⟕ companies with activity statistics and duration metrics."""
    roll = v.order_rollup(spark, base)
    return build_bi_fact(v.deals(spark, base, roll), v.contacts(spark, base),
                         v.companies(spark, base))
