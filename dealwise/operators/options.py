"""Option codes decoded by a join (X5-X7): option tables of any size.

``custom_fields.explode_enum`` decodes through a literal map, which suits metadata that the
driver holds anyway.  Here the options are a frame: all codes of a record are exploded with
their field and place, joined to the options on (field, id), and put together again in
their order.  The record itself is joined back once, by its key.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealwise.functions import parse as P
from dealwise.functions.once import evaluate_once


def option_ids(v: Column, multiple: bool) -> Column:
    """The option ids of a VARIANT value as ``array<bigint>``, NULL where it is none.

    Single: a digit string or integer.  Multiple: the digit elements of a JSON array, the
    digit parts of a CSV string, or a single id.
    """
    kind, raw = P.vkind(v), P.vstr(v)

    def digits(s: Column) -> Column:
        return s.rlike("^[0-9]+$")

    def ids(parts: Column) -> Column:
        return F.transform(parts, lambda x: F.trim(x).try_cast("bigint"))

    one = F.when(digits(raw), ids(F.array(raw)))
    if not multiple:
        return F.when(~kind.startswith("ARRAY"), one)
    elements = F.transform(P.vget(v, "$", "array<variant>"), lambda x: P.vstr(x))
    return (F.when(kind.startswith("ARRAY"), ids(F.filter(elements, digits)))
            .when((kind == "STRING") & raw.contains(","), ids(F.filter(F.split(raw, ","), lambda x: digits(F.trim(x)))))
            .otherwise(one))


def decode_options(df: DataFrame, pk: str, fields: Mapping[str, tuple[Column, bool]], options: DataFrame) -> DataFrame:
    """``df`` with a column per entry of ``fields`` (name -> VARIANT value, multiple).

    ``options`` has (field, id, label), one row per id of a field; ``field`` is the name in
    ``fields``.  Single: the label; multiple: the labels in order, NULL for an unknown id,
    an empty list for a list without ids.  ``pk`` is the record's key; a record without one
    gets no labels.
    """
    names = list(fields)
    given = evaluate_once(df, **{f"__ids{i}": option_ids(*fields[n]) for i, n in enumerate(names)})

    def coded(i: int) -> Column:
        return F.transform(F.coalesce(F.col(f"__ids{i}"), F.array().cast("array<bigint>")),
                           lambda x, at: F.struct(F.lit(i).alias("f"), at.alias("at"), x.alias("id")))

    codes = F.concat(*[coded(i) for i in range(len(names))])
    long = given.where(F.col(pk).isNotNull()).select(F.col(pk).alias("__pk"), F.inline(codes))
    numbers = F.create_map(*[x for i, n in enumerate(names) for x in (F.lit(n), F.lit(i))])
    known = options.select(F.try_element_at(numbers, F.col("field")).alias("__f"), F.col("id").cast("bigint").alias("__id"), "label")
    found = long.join(known.where("__f is not null"), (F.col("f") == F.col("__f")) & (F.col("id") == F.col("__id")), "left")
    lists = found.groupBy("__pk").agg(F.array_sort(F.collect_list(F.struct("f", "at", "label"))).alias("__labels"))
    out = given.join(lists, F.col(pk) == F.col("__pk"), "left")

    def labels(i: int) -> Column:
        mine = F.filter("__labels", lambda x: x["f"] == i)
        return F.coalesce(F.transform(mine, lambda x: x["label"]), F.array().cast("array<string>"))

    cols = [F.when(F.col(f"__ids{i}").isNotNull(), labels(i) if fields[n][1] else F.get(labels(i), 0)).alias(n)
            for i, n in enumerate(names)]
    return out.select(*[F.col(c) for c in df.columns if c not in names], *cols)
