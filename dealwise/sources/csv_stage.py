r"""CSV staging (S9): the bulk-load exchange format, written and read by Spark.

Dialect: header row, ``"`` quotes, ``\\`` escapes, NULL written as ``\N``
(the bulk-load convention) and the empty string as ``""`` — so NULL and
``''`` survive a round trip as two different values (an empty-field NULL
marker would turn ``''`` into NULL, D11).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

CSV_OPTIONS = {"header": "true", "quote": '"', "escape": "\\", "nullValue": "\\N",
               "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def write_staged_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def read_staged_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Read with an explicit schema (no inference pass over the data)."""
    return spark.read.options(**CSV_OPTIONS).schema(schema).csv(path)
