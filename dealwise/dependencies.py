"""Which tables an entity's labels depend on, and the time columns that show a change."""

from __future__ import annotations

# Entity -> (table, time columns) of what it depends on.
DEPENDENCIES: dict[str, tuple[tuple[str, tuple[str, ...]], ...]] = {
    "deals": (
        ("usuarios", ("created", "modified")),
        ("pessoas", ("add_time", "update_time")),
        ("etapas_funil", ("add_time", "update_time")),
        ("pipelines", ("add_time", "update_time")),
        ("organizacoes", ("add_time", "update_time")),
    ),
    "persons": (
        ("usuarios", ("created", "modified")),
        ("organizacoes", ("add_time", "update_time")),
    ),
    "organizations": (
        ("usuarios", ("created", "modified")),
    ),
    "activities": (
        ("usuarios", ("created", "modified")),
        ("pessoas", ("add_time", "update_time")),
        ("organizacoes", ("add_time", "update_time")),
    ),
}
