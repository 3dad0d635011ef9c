"""Readers for the driver's parquet tables (``<dir>/<name>.parquet``).

The schemas are declared, so opening a table costs no footer-reading job (schema inference runs
a Spark job per ``read.parquet`` call); Catalyst still prunes columns and pushes filters into each
scan. Only the tables the lending model reads are declared; the others fall back to inference.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
                 "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

_L, _I, _D, _S, _TS = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(), T.TimestampNTZType()


def _st(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


DRIVER_SCHEMAS: dict[str, T.StructType] = {
    "region": _st(("r_regionkey", _I), ("r_name", _S)),
    "nation": _st(("n_nationkey", _I), ("n_name", _S), ("n_regionkey", _I)),
    "customer": _st(("c_custkey", _L), ("c_name", _S), ("c_nationkey", _I), ("c_acctbal", _D),
                    ("c_mktsegment", _S)),
    "orders": _st(("o_orderkey", _L), ("o_custkey", _L), ("o_orderstatus", _S), ("o_totalprice", _D),
                  ("o_orderdate", _TS), ("o_orderpriority", _S)),
    "lineitem": _st(("l_orderkey", _L), ("l_partkey", _L), ("l_suppkey", _L), ("l_linenumber", _I),
                    ("l_quantity", _D), ("l_extendedprice", _D), ("l_discount", _D), ("l_tax", _D),
                    ("l_returnflag", _S), ("l_linestatus", _S), ("l_shipdate", _TS)),
    "events": _st(("event_id", _L), ("ts", _TS), ("user_id", _L), ("event_type", _S), ("value", _D),
                  ("props", _S)),
}


class DriverTables:
    """Lazy parquet scans with declared schemas."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def table(self, name: str) -> DataFrame:
        if name not in DRIVER_TABLES:
            raise KeyError(name)
        schema = DRIVER_SCHEMAS.get(name)
        reader = self.spark.read.schema(schema) if schema is not None else self.spark.read
        return reader.parquet(self.path(name))
