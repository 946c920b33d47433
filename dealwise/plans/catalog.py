"""The query catalogue: one callable per operator family.

Each entry takes ``(spark, base_dir)`` and returns a lazy DataFrame over the
driver tables; the registry also keeps the matching DuckDB SQL.
"""

from __future__ import annotations

from dealwise.plans import (q_bi, q_enrich, q_fields, q_history, q_sources, q_stats,  # noqa: F401
                            q_extra, q_lookups, q_safety, q_segments, q_stream, q_sync, q_tables)
from dealwise.plans.registry import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
