"""Golden rows for the column functions (FIXTURES.md §3)."""

import datetime as dt

from pyspark.sql import functions as F

from dealwise.functions import custom_fields as X
from dealwise.functions import parse as P
from dealwise.functions.text import dedupe_names, slugify, slugify_name, to_snake_name


def one_col(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, j string")
    out = df.select("i", fn(F.try_parse_json("j")).alias("o")).orderBy("i").collect()
    return [r.o for r in out]


def test_slug_driver_and_column_agree(spark):
    labels = ["Nº Aviso de Sinistro", "  Ação -- Valor (R$) ", "a__b", "Tipo de Evento!"]
    expect = ["nº_aviso_de_sinistro", "ação_valor_r", "a_b", "tipo_de_evento"]
    assert [slugify_name(x) for x in labels] == expect
    df = spark.createDataFrame([(x,) for x in labels], "x string")
    assert [r[0] for r in df.select(slugify(F.col("x"))).collect()] == expect
    assert slugify_name("!!!").startswith("field_")


def test_snake_and_dup_names():
    assert to_snake_name("dealTitle") == "deal_title"
    assert to_snake_name("Id") == "id"
    assert dedupe_names(["a", "b", "a", "a"]) == ["a", "b", "a__dup1", "a__dup2"]


def test_numeric_and_money(spark):
    assert one_col(spark, ['"12.5"', '"x"', None],
                   lambda v: X.explode_numeric(v, "s")["s_value"]) == [12.5, None, None]
    vals = ['{"value":10,"currency":"BRL"}', "7", '"z"']
    assert one_col(spark, vals, lambda v: X.explode_monetary(v, "m")["m_valor"]) == [10.0, 7.0, None]
    assert one_col(spark, vals, lambda v: X.explode_monetary(v, "m")["m_moeda"]) == ["BRL", None, None]


def test_enum_single_multi_csv(spark):
    opts = ((1, "A"), (2, "B"))
    single = one_col(spark, ['"1"', "9", '"x"', None],
                     lambda v: X.explode_enum(v, "e", options=opts)["e_label"])
    assert single == ["A", None, None, None]
    multi = one_col(spark, ['[1,"2","x",9]', '"1, 2,x"'],
                    lambda v: X.explode_enum(v, "e", options=opts, multiple=True)["e_label"])
    assert multi == [["A", "B", None], ["A", "B"]]


def test_address(spark):
    vals = ['"Rua X 1"', '{"country":"BR","admin_area_level_1":"SP"}', '""']
    cols = lambda v: X.explode_address(v, "a")
    assert one_col(spark, vals, lambda v: cols(v)["a_formatted_address"]) == ["Rua X 1", None, None]
    assert one_col(spark, vals, lambda v: cols(v)["a_country"]) == [None, "BR", None]
    assert one_col(spark, vals, lambda v: cols(v)["a_aal1"]) == [None, "SP", None]


def test_contact_list(spark):
    vals = ['[{"value":"a","primary":false,"label":"w"},{"value":"b","primary":true,"label":"h"},{"value":""}]',
            None, '"n/a"']
    cols = lambda v: X.explode_contact_list(v, "c")
    assert one_col(spark, vals, lambda v: cols(v)["c_list"]) == [["a", "b"], [], []]
    assert one_col(spark, vals, lambda v: cols(v)["c_primary_value"]) == ["b", None, None]
    assert one_col(spark, vals, lambda v: cols(v)["c_primary_label"]) == ["h", None, None]


def test_zero_dates(spark):
    df = spark.createDataFrame([("",), ("0000-00-00 00:00:00",), ("-0001-11-30T00:00:00Z",),
                                ("2024-01-02T03:04:05Z",)], "s string")
    got = [r[0] for r in df.select(P.clean_timestamp(F.col("s"))).collect()]
    assert got == [None, None, None, dt.datetime(2024, 1, 2, 3, 4, 5)]
    d = spark.createDataFrame([("0000-00-00",), ("-0001-01-01",), ("2024-02-03",)], "s string")
    assert [r[0] for r in d.select(P.clean_date(F.col("s"))).collect()] == [None, None, dt.date(2024, 2, 3)]


def test_flex_fk_offset_bool(spark):
    assert one_col(spark, ["5", '{"value":6,"id":7}', '{"value":0,"id":7}', '{"id":7}'], P.flex_fk) == [5, 6, 7, 7]
    assert one_col(spark, ['"-03:00"', '"+05:30"', '"60"', "90", '""', '"a:b"'],
                   P.utc_offset_minutes) == [-180, 330, 60, 90, None, None]
    assert one_col(spark, ["1", '"0"', '"TRUE"', '"no"', '""', None],
                   P.flex_bool) == [True, False, True, True, False, None]
    assert one_col(spark, ["12", '"  "', '"pt"'], P.lang_norm) == ["12", None, "pt"]


def test_default_only_when_absent(spark):
    df = spark.createDataFrame([('{"done":null}',), ("{}",), ('{"done":true}',)], "j string")
    got = [r[0] for r in df.select(P.field_or_default(F.parse_json("j"), "done", "boolean", False)).collect()]
    assert got == [None, False, True]


def test_custom_field_generator_single_select(spark):
    meta = [X.FieldMeta("k1", "Valor", "double"), X.FieldMeta("k2", "Hora", "time"),
            X.FieldMeta("k3", "x", "unknown-type"), X.FieldMeta("id", "Id", "varchar")]
    df = spark.createDataFrame([(1, '{"k1": "2.5", "k2": "10:30", "k3": "z"}')], "id long, custom_fields string")
    out = X.explode_custom_fields(df, meta, pk=("id",))
    assert set(out.columns) == {"id", "valor_value", "hora_time"}
    r = out.first()
    assert r.valor_value == 2.5 and r.hora_time == "10:30"
    norm = X.normalize_schema(out, pk=("id",), core=("update_time",), types={"update_time": "timestamp"},
                              time_of_day=X.time_of_day_columns(meta))
    assert norm.columns == ["id", "update_time", "hora_time", "valor_value"]
    assert norm.first().hora_time == "10:30"


def test_column_cap_sends_surplus_to_overflow(spark):
    from dealwise.operators.evolve import apply_column_cap
    df = spark.createDataFrame([(1, "a", 1, None, 2), (2, "b", None, None, None)],
                               "id int, a string, b int, c int, d int")
    out = apply_column_cap(df, 3, protected=("id",))
    assert out.columns == ["id", "a", "custom_fields_overflow"]
    rows = {r.id: r.custom_fields_overflow for r in out.collect()}
    assert rows == {1: '{"b":1,"d":2}', 2: None}
