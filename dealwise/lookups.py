"""Which label columns each CRM table takes from which other table."""

from __future__ import annotations

from dealwise.spec import LookupSpec

# Label columns in the order they are tried, by kind of table.
USER_LABELS = ("name", "display_name", "label", "title")
PARTY_LABELS = ("name", "label", "title")
FUNNEL_LABELS = ("name", "title", "label")


def _user(key: str, label: str) -> LookupSpec:
    return LookupSpec(key, "usuarios", label, value_col="name", candidates=USER_LABELS)


def _person(key: str, label: str) -> LookupSpec:
    return LookupSpec(key, "pessoas", label, value_col="name", candidates=PARTY_LABELS)


def _organization(key: str, label: str) -> LookupSpec:
    return LookupSpec(key, "organizacoes", label, value_col="name", candidates=PARTY_LABELS)


def _funnel(key: str, table: str, label: str) -> LookupSpec:
    return LookupSpec(key, table, label, value_col="name", candidates=FUNNEL_LABELS)


# Table -> its lookups (key, source, label column).
LOOKUPS: dict[str, tuple[LookupSpec, ...]] = {
    "negocios": (_user("owner_id", "owner_name"), _user("creator_user_id", "creator_user_name"),
                 _person("person_id", "person_name"), _funnel("stage_id", "etapas_funil", "stage_name"),
                 _funnel("pipeline_id", "pipelines", "pipeline_name")),
    "leads": (_user("owner_id", "owner_name"), _person("person_id", "person_name"),
              _organization("organization_id", "organization_name")),
    "organizacoes": (_user("owner_id", "owner_name"),),
    "pessoas": (_user("owner_id", "owner_name"), _organization("org_id", "org_name")),
    "etapas_funil": (_funnel("pipeline_id", "pipelines", "pipeline_name"),),
    "atividades": (_user("user_id", "user_name"), _person("person_id", "person_name"),
                   _organization("org_id", "org_name"), _user("created_by_user_id", "created_by_user_name"),
                   _user("assigned_to_user_id", "assigned_to_user_name"), _user("update_user_id", "update_user_name")),
}
