"""Multi-level prefix sums and options decoded by a join."""

import json
import random

import pytest
from pyspark.sql import functions as F

from dealwise.functions import custom_fields as X
from dealwise.operators.options import decode_options
from dealwise.operators.pending import sums_before, whole_page_budget


@pytest.mark.parametrize("block", [2, 3, 1000])
def test_sums_before_brute(spark, block):
    rng = random.Random(block)
    pages = sorted({rng.randrange(-40, 200) for _ in range(60)})
    rows = [(p, rng.randrange(0, 9)) for p in pages]
    df = spark.createDataFrame(rows, "page long, n_rows long")
    want = [(p, sum(m for q, m in rows if q < p)) for p, _ in rows]
    got = sums_before(df, "page", "n_rows", block)
    assert sorted((r["page"], r["rows_before"]) for r in got.collect()) == want
    taken = whole_page_budget(df, 50, block=block)
    assert sorted(r["page"] for r in taken.collect()) == [p for p, s in want if s < 50]
    assert sums_before(df.limit(0), "page", "n_rows", block).count() == 0


def test_no_window_over_all_pages(spark):
    df = spark.range(0, 5000).select(F.col("id").alias("page"), F.lit(1).alias("n_rows"))
    plan = sums_before(df, "page", "n_rows", 64)._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "SinglePartition" not in plan
    assert sums_before(df, "page", "n_rows", 64).count() == 5000


VALUES = ['1', '"2"', '"x"', 'null', '" 3"', '[1,"2",9,"x",1]', '[]', '"3, 1,zz"', '"a,b"', '{"id":1}', 'true', '[[1]]', '7', '"1,1"']


def test_options_by_join_decode_like_the_literal_map(spark):
    """Every value, single and multiple, against the literal decoding of custom fields."""
    options = [(1, "one"), (2, "two"), (3, None)]
    df = spark.createDataFrame(list(enumerate(VALUES)) + [(None, "1")], "id long, v string")
    v = F.parse_json("v")
    want = df.select("id", X.explode_enum(v, "a", options=options)["a_label"].alias("one"),
                     X.explode_enum(v, "b", options=options, multiple=True)["b_label"].alias("many"))
    table = spark.createDataFrame([(f, i, label) for f in ("one", "many", "other") for i, label in options]
                                  + [("other", 7, "not here")], "field string, id int, label string")
    got = decode_options(df, "id", {"one": (v, False), "many": (v, True)}, table).select("id", "one", "many")

    def rows(d):
        return sorted(json.dumps(list(r)) for r in d.where("id is not null").collect())

    assert rows(got) == rows(want)
    assert got.where("id is null").count() == 1


def test_a_hundred_thousand_options(spark):
    table = spark.range(100_000).select(F.lit("f").alias("field"), "id", F.concat(F.lit("o"), "id").alias("label"))
    df = spark.range(2000).select("id", F.concat(F.lit("["), F.col("id") * 50, F.lit(","), F.col("id"), F.lit("]")).alias("v"))
    got = decode_options(df, "id", {"f": (F.parse_json("v"), True)}, table)
    assert all(r["f"] == [f"o{r['id'] * 50}", f"o{r['id']}"] for r in got.collect())
