"""Driver-side specifications: lookups, handlers, custom-field metadata.

These are plain dataclasses.  They hold configuration only (tens to
thousands of entries) and are turned into column expressions on the driver;
data never flows through them.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class FieldMeta:
    """One custom-field metadata row (S6): key, display name, type, options."""
    key: str
    name: str | None
    field_type: str
    options: tuple[tuple[int, str], ...] = ()

    @staticmethod
    def from_row(row: dict) -> "FieldMeta | None":
        """Validate a metadata record; invalid rows give ``None`` (skipped)."""
        key = row.get("key")
        ftype = row.get("field_type")
        if not isinstance(key, str) or not key or not isinstance(ftype, str):
            return None
        opts = []
        for o in row.get("options") or ():
            if not isinstance(o, dict) or o.get("label") is None:
                continue
            try:
                opts.append((int(str(o.get("id")).strip()), str(o["label"])))
            except ValueError:
                continue
        name = row.get("name")
        return FieldMeta(key, name if isinstance(name, str) else None, ftype, tuple(opts))


@dataclass(frozen=True)
class LookupSpec:
    """Fill ``dest_col`` of the target from ``source_table`` by key."""
    dest_key: str
    source_table: str
    dest_col: str
    source_key: str = "id"
    value_col: str | None = None
    candidates: tuple[str, ...] = ()


@dataclass(frozen=True)
class Handler:
    """Apply a registered column function to a top-level column."""
    kind: str
    slug_name: str | None = None
    params: dict = field(default_factory=dict)
