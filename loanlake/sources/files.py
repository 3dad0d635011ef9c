"""Landing-file readers for the raw tables (daily CSV / JSON / Parquet drops).

The raw edge is never schema-inferred: every read names the table's explicit schema, so a bad
file fails on types instead of silently changing the plan. ``mode`` controls malformed rows for
the text formats (``PERMISSIVE`` keeps them with NULLs so staging flags them; ``FAILFAST`` stops).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlake.sources import schemas


def read_landing(spark: SparkSession, path: str, table: str, fmt: str = "csv",
                 mode: str = "PERMISSIVE", options: dict | None = None) -> DataFrame:
    """Read landed files of ``table``. ``options`` passes reader options through, e.g.
    ``{"nullValue": "\\N"}`` for CSV drops that must keep empty strings apart from NULLs."""
    schema = schemas.RAW[table]
    reader = spark.read.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("mode", mode)
    elif fmt == "json":
        reader = reader.option("mode", mode)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.load(path)


CORRUPT = "_corrupt_record"


def read_landing_checked(spark: SparkSession, path: str, table: str, fmt: str = "csv",
                         options: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """(well-formed rows, malformed rows) of landed text files. A row that does not fit the schema goes to
    the second frame as its raw text with the file it came from, instead of into the first with NULLs.

    The files are read as lines and parsed by column functions, so either frame can be counted or pruned by
    itself. A line equal to the header (the schema's column names) is no row."""
    schema = T.StructType([*schemas.RAW[table].fields, T.StructField(CORRUPT, T.StringType())])
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, **(options or {})}
    lines = spark.read.text(path).withColumn("source_file", F.input_file_name()).where("value <> ''")
    if fmt == "csv":
        header = opts.get("sep", ",").join(schemas.RAW[table].fieldNames())
        parsed = F.from_csv("value", schema.toDDL(), opts)
        lines = lines.where(F.col("value") != header)
    else:
        parsed = F.from_json("value", schema, opts)
    rows = lines.withColumn("row", parsed)
    bad = F.col(f"row.{CORRUPT}").isNotNull()
    return (rows.where(~bad).select(*[F.col(f"row.{f}") for f in schemas.RAW[table].fieldNames()]),
            rows.where(bad).select(F.col("value").alias("raw_text"), "source_file"))


def stamp_load_time(df: DataFrame, column: str = "loaded_at") -> DataFrame:
    """Set the load stamp of a landed batch: ``current_timestamp()`` is evaluated once per query,
    so every row of the batch shares the same mark (ties are expected by the incremental step)."""
    return df.withColumn(column, F.current_timestamp().cast("timestamp_ntz"))


def read_landing_stream(spark: SparkSession, path: str, table: str, fmt: str = "csv") -> DataFrame:
    """Streaming counterpart (file source); see ``streaming.incremental.stream_payments``."""
    reader = spark.readStream.schema(schemas.RAW[table]).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.load(path)
