"""Evaluate an expensive per-row expression exactly once.

Catalyst inlines a projected expression into every consumer: a filter pushed
below a projection, or a projection collapsed into the next one, can copy a
JSON parse or a key-renaming map rewrite dozens of times per row.  Producing
the value as generator output (``inline`` of a one-element array) makes it a
plain attribute that nothing can inline again.

A generator is evaluated expression by expression once a plan is too wide for generated
code (over a hundred columns).  Where no filter follows that could copy the expressions,
:func:`project_once` computes the same columns in a projection, which is compiled at any
width; Catalyst keeps it apart from consumers that read a costly column more than once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def evaluate_once(df: DataFrame, **named: Column) -> DataFrame:
    """``df`` plus the ``named`` columns, each computed once per row."""
    packed = F.array(F.struct(*[c.alias(n) for n, c in named.items()]))
    return df.select("*", F.inline(packed))


def project_once(df: DataFrame, **named: Column) -> DataFrame:
    """:func:`evaluate_once` for plans without a filter on what is computed."""
    return df.select("*", *[c.alias(n) for n, c in named.items()])
