"""The entities of the CRM with all their fields, defaults and declared types.

An absent key takes the field's default, an explicit null stays NULL (V13).  Lists and
objects without a handler are kept as JSON text.  Columns that no record fills are left out
of a table after its sync (K12), except for the key and ``core``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dealwise.functions import parse as P
from dealwise.operators.validate import FieldRule as R
from dealwise.plans.sync import Entity
from dealwise.spec import Handler


def json_text(v: Column) -> Column:
    """A list or object as JSON text; empty ones and null are NULL."""
    text = F.to_json(v)
    return F.when(v.isNotNull() & ~F.is_variant_null(v) & ~text.isin("[]", "{}"), text)


def _rules(kind: str, names: str, default=None) -> tuple[R, ...]:
    return tuple(R(n, kind, default=default) for n in names.split())


ID = R("id", "bigint", True)

# Declared column types on write.
TYPES = {"value": "decimal(18,4)", "order_nr": "int", "deal_probability": "int", "due_date": "date",
         "expected_close_date": "date", "add_time": "timestamp", "update_time": "timestamp"}

# Fixed values from here on: field names, types and defaults of the CRM's entities.
DEALS = Entity(
    name="deals", table="negocios", pk=("id",), endpoint="/deals", version="v2",
    fields=(ID, *_rules("string", "title currency status lost_reason"),
            *_rules("bigint", "creator_user_id user_id owner_id person_id org_id stage_id pipeline_id visible_to"),
            *_rules("double", "value probability"),
            *_rules("timestamp", "add_time update_time stage_change_time close_time won_time lost_time"),
            *_rules("date", "expected_close_date"), *_rules("variant", "label_ids")),
    core=("title", "value", "currency", "status", "person_id", "org_id", "add_time", "update_time"),
    parsers={"label_ids": json_text}, types=TYPES,
)

PERSONS = Entity(
    name="persons", table="pessoas", pk=("id",), endpoint="/persons",
    fields=(ID, *_rules("string", "name first_name last_name notes job_title"),
            *_rules("bigint", "owner_id org_id visible_to picture_id"),
            *_rules("timestamp", "add_time update_time"), *_rules("date", "birthday"),
            *_rules("boolean", "is_deleted", False), *_rules("variant", "emails phones im label_ids postal_address")),
    core=("name", "org_id", "add_time", "update_time"),
    handlers={"emails": Handler("phone_list", "Email Contatos"), "phones": Handler("phone_list", "Telefone Contatos")},
    parsers={"im": json_text, "label_ids": json_text, "postal_address": json_text}, types=TYPES,
)

USERS = Entity(
    name="users", table="usuarios", pk=("id",), endpoint="/users", version="v1", order="modified",
    fields=(ID, *_rules("string", "name email locale timezone_name default_currency icon_url phone company_id company_name "
                                  "company_domain"),
            *_rules("variant", "timezone_offset lang active_flag access"),
            *_rules("boolean", "is_deleted is_admin activated has_created_company is_you"), *_rules("bigint", "role_id"),
            *_rules("timestamp", "created modified last_login")),
    core=("name", "email", "timezone_offset", "lang", "active_flag", "created", "modified"),
    parsers={"timezone_offset": P.utc_offset_minutes, "lang": P.lang_norm, "active_flag": P.flex_bool, "access": json_text},
    types=TYPES,
)

ACTIVITIES = Entity(
    name="activities", table="atividades", pk=("id",), endpoint="/activities",
    fields=(ID, *_rules("bigint", "company_id user_id deal_id person_id org_id project_id update_user_id created_by_user_id "
                                  "assigned_to_user_id"),
            *_rules("boolean", "done", False), *_rules("boolean", "active_flag", True), *_rules("boolean", "busy_flag"),
            *_rules("string", "type subject due_time duration note location location_subpremise location_street_number "
                              "location_route location_sublocality location_locality location_admin_area_level_1 "
                              "location_admin_area_level_2 location_country location_postal_code location_formatted_address "
                              "public_description gcal_event_id google_calendar_id google_calendar_etag "
                              "conference_meeting_client conference_meeting_url conference_meeting_id owner_name person_name "
                              "org_name deal_title person_dropbox_bcc deal_dropbox_bcc"),
            *_rules("date", "due_date"), *_rules("timestamp", "add_time update_time marked_as_done_time"),
            *_rules("variant", "participants attendees")),
    core=("deal_id", "subject", "type", "done", "due_date", "due_time", "update_time"),
    parsers={"participants": json_text, "attendees": json_text}, time_of_day=("due_time", "duration"), types=TYPES,
)

PIPELINES = Entity(
    name="pipelines", table="pipelines", pk=("id",), endpoint="/pipelines", order=None,
    fields=(ID, R("name", "string"), R("order_nr", "int"), R("is_deleted", "variant"),
            *_rules("boolean", "is_selected is_deal_probability_enabled", False), *_rules("timestamp", "add_time update_time")),
    core=("name", "order_nr", "is_deleted"), parsers={"is_deleted": P.flex_bool}, types=TYPES,
)

STAGES = Entity(
    name="stages", table="etapas_funil", pk=("id",), endpoint="/stages", order=None,
    fields=(ID, R("name", "string"), R("pipeline_id", "bigint"), *_rules("int", "order_nr deal_probability days_to_rotten"),
            *_rules("boolean", "is_deleted is_deal_rot_enabled", False), *_rules("timestamp", "add_time update_time")),
    core=("name", "pipeline_id", "order_nr", "deal_probability"), types=TYPES,
)

ORGANIZATIONS = Entity(
    name="organizations", table="organizacoes", pk=("id",), endpoint="/organizations", order=None,
    fields=(ID, R("name", "string"), R("owner_id", "variant"), *_rules("bigint", "org_id visible_to"),
            *_rules("timestamp", "add_time update_time"), *_rules("boolean", "is_deleted", False), R("address", "variant")),
    core=("name", "owner_id"), parsers={"owner_id": P.flex_fk}, handlers={"address": Handler("address", "Endereco")},
    types=TYPES,
)

ACTIVITY_TYPES = Entity(
    name="activity_types", table="atividade_tipos", pk=("id",), endpoint="/activityTypes", version="v1", order=None,
    fields=(ID, *_rules("string", "name key_string icon_key color"), R("active_flag", "variant"),
            *_rules("boolean", "is_custom_flag"), R("order_nr", "int"), *_rules("timestamp", "add_time update_time")),
    core=("name", "key_string", "active_flag", "order_nr"), parsers={"active_flag": P.flex_bool}, types=TYPES,
)

ENTITIES = {e.name: e for e in (USERS, PIPELINES, STAGES, ORGANIZATIONS, PERSONS, DEALS, ACTIVITIES, ACTIVITY_TYPES)}
