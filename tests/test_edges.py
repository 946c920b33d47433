"""Edge rules from SURVEY §2.12 and the support rows."""

import json

import pytest
from pyspark.sql import functions as F

from dealwise.functions import custom_fields as X
from dealwise.lookups import LOOKUPS
from dealwise.operators import history as H
from dealwise.operators.enrich import enrich
from dealwise.operators.evolve import apply_column_cap
from dealwise.operators.joins import fits_broadcast
from dealwise.sources.field_metadata import field_metadata, field_metas
from dealwise.spec import FieldMeta, LookupSpec


def test_overflow_merges_existing_json(spark):
    df = spark.createDataFrame([(1, "a", 5, '{"old":1,"b":9}')],
                               "id int, a string, b int, custom_fields_overflow string")
    out = apply_column_cap(df, 3, protected=("id",))
    assert json.loads(out.first().custom_fields_overflow) == {"old": 1, "b": 5}


def test_history_keep_all_visits(spark):
    items = [{"timestamp": t, "field_key": "stage_id", "new_value": 5}
             for t in ("2024-01-01 00:00:00", "2024-01-03 00:00:00")]
    pages = spark.createDataFrame([(1, 0, [json.dumps(i) for i in items])],
                                  "deal_id long, page long, items array<string>")
    ch = H.stage_changes(H.change_items(pages))
    assert H.latest_per_stage(ch).count() == 1
    assert H.latest_per_stage(ch, keep="all").count() == 2


def test_field_metadata_validation():
    ok = FieldMeta.from_row({"key": "k1", "name": "Status", "field_type": "enum",
                             "options": [{"id": "1", "label": "A"}, {"id": "x", "label": "B"}, "junk"]})
    assert ok.options == ((1, "A"),)
    assert FieldMeta.from_row({"name": "no key", "field_type": "text"}) is None
    assert FieldMeta.from_row({"key": "k", "field_type": None}) is None


def test_lookup_errors_and_skips(spark):
    deals = spark.createDataFrame([(1, 2)], "id long, stage_id long")
    stages = spark.createDataFrame([(2, "x")], "id long, code string")
    with pytest.raises(ValueError, match="none of"):
        enrich(deals, [LookupSpec("stage_id", "stages", "stage_name")], {"stages": stages})
    with pytest.raises(ValueError, match="lacks key"):
        enrich(deals, [LookupSpec("stage_id", "stages", "stage_name", source_key="nope")],
               {"stages": stages})
    out = enrich(deals, [LookupSpec("absent_col", "stages", "x")], {"stages": stages})
    assert out.columns == deals.columns


def test_register_kind_extends_the_generator(spark):
    X.register_kind("upper_text", lambda v, slug, **_: {f"{slug}_upper": F.upper(F.try_variant_get(v, "$", "string"))})
    X.FIELD_TYPE_MAP.setdefault("shout", "upper_text")
    df = spark.createDataFrame([(1, '{"k": "hey"}')], "id long, custom_fields string")
    out = X.explode_custom_fields(df, [FieldMeta("k", "Grito", "shout")])
    assert out.first().grito_upper == "HEY"


def test_dependency_decision_and_route_registration(spark):
    import datetime as dt
    from dealwise.sources.routes import ROUTES, register_route, routes_frame
    from dealwise.streaming.state import has_recent_updates
    t = spark.createDataFrame([(dt.datetime(2024, 1, 2),)], "update_time timestamp")
    deps = {"t": (t, ["update_time", "add_time"])}
    assert has_recent_updates(deps, dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc))
    assert not has_recent_updates(deps, dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc))
    assert has_recent_updates(deps, None)  # never ran: everything counts as changed
    register_route("/projects", "v2", 7)
    assert ROUTES["/projects"].cost == 7
    assert routes_frame(spark).filter("endpoint = '/projects'").count() == 1


def test_broadcast_bound_counts_rows_and_bytes(spark):
    df = spark.range(100).select("id", F.repeat(F.lit("x"), 1000).alias("t"), F.array("id").alias("a"),
                                 F.lit(None).cast("string").alias("n"))
    assert fits_broadcast(df, 100) and not fits_broadcast(df, 99)
    assert not fits_broadcast(df, 100, max_bytes=50_000) and fits_broadcast(df.limit(0), 0)


def test_lookup_catalogue_is_whole():
    assert {t: len(specs) for t, specs in LOOKUPS.items()} == {
        "negocios": 5, "leads": 3, "organizacoes": 1, "pessoas": 2, "etapas_funil": 1, "atividades": 6}


def test_field_metas_keep_the_last_of_a_key(spark):
    rows = spark.createDataFrame([(0, 0, '{"key":"k","field_type":"enum","options":[{"id":1,"label":"a"}]}'),
                                  (0, 1, '{"key":"k","field_type":"enum","name":"N","options":null}'),
                                  (0, 2, '{"name":"no key"}'), (0, 3, "17")], "page int, ordinal int, j string")
    found = field_metadata(rows.select("page", "ordinal", F.try_parse_json("j").alias("record")))
    assert field_metas(found) == (FieldMeta("k", "N", "enum"),)
    assert field_metas(found.limit(0)) == ()
