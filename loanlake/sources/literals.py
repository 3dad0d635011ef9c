"""Literal rows under a schema: seed and master tables written out as text or numbers."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _text(value) -> str | None:
    if value is None or isinstance(value, str):
        return value
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (int, float, Decimal, dt.date, dt.datetime)):
        return value.isoformat(sep=" ") if isinstance(value, dt.datetime) else str(value)
    raise TypeError(f"no literal of a row: {value!r}")


def literal_rows(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType | str) -> DataFrame:
    """Rows of literals as a table of ``schema``: text becomes dates, stamps and numbers, whole numbers become
    decimals, by Spark's own casts. A value that is none of the column's type fails the job, and a row of another length
    fails here; None is null. No rows give an empty table of the schema.

    For tables that are written out (masters, parameters); the rows go through the driver.
    """
    if isinstance(schema, str):
        schema = spark.createDataFrame([], schema).schema
    text = [tuple(_text(v) for v in row) for row in rows]
    wrong = next((row for row in text if len(row) != len(schema.fields)), None)
    if wrong is not None:
        raise ValueError(f"{len(schema.fields)} values to a row, got {wrong}")
    raw = spark.createDataFrame(text, T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields]))
    checked = []
    for f in schema.fields:
        # under any setting, text that is not of the type is an error and not a null
        message = F.concat(F.lit(f"{f.name}: "), F.col(f"`{f.name}`"))
        tried = F.col(f"`{f.name}`").try_cast(f.dataType)
        bad = tried.isNull() & F.col(f"`{f.name}`").isNotNull()
        checked.append(F.when(bad, F.raise_error(message).cast(f.dataType)).otherwise(tried).alias(f.name))
    return raw.select(*checked)
