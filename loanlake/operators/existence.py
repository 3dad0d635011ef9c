"""Membership tests against another table, written as shuffle-able joins.

SQL ``x NOT IN (SELECT k FROM parent)`` has three-valued semantics: it is TRUE for every row when
the parent is empty, NULL when ``x`` is NULL, FALSE on a match, NULL when there is no match but the
parent holds a NULL key, and TRUE otherwise. Spark plans the SQL form as a null-aware anti join
that must broadcast the parent (or, inside a projection, as a nested-loop existence join, O(n*m)).
Here the same semantics are one equi-join against the parent's distinct keys (a normal shuffle/sort-merge or
size-checked broadcast join) plus two scalar facts about the parent (row count, NULL-key count) from the same
grouping. Rows with a NULL key take a salt as join key, so they neither match nor meet in one partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_counts(parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows per distinct parent key (``_p_key``, ``_cnt``), the NULL key included.

    Serves the uniqueness checks (``_cnt > 1``); partial aggregation combines a hot key before the
    shuffle.
    """
    return parent.groupBy(F.col(parent_key).alias("_p_key")).agg(F.count(F.lit(1)).alias("_cnt"))


NULL_SALTS = 1024


def _marked(key: Column) -> Column:
    """A parent key that is never null: ``k`` and the key, or ``n``."""
    return F.coalesce(F.concat(F.lit("k"), key.cast("string")), F.lit("n"))


def salted(key: Column, columns: list[str]) -> Column:
    """A child key that is never null: ``k`` and the key, or a salt that no parent key equals. Rows without a
    key thus spread over the partitions of the join, by their first two columns (more would be read for this alone)."""
    salt = F.pmod(F.xxhash64(*columns[:2]), F.lit(NULL_SALTS)).cast("string")
    return F.coalesce(F.concat(F.lit("k"), key.cast("string")), F.concat(F.lit("s"), salt))


def _joined(child: DataFrame, child_key: Column, parent: DataFrame, parent_key: str) -> tuple[DataFrame, Column]:
    """The child's rows, once each, and the value of ``child_key NOT IN parent`` with NULL read as FALSE.

    One grouping of the parent gives its distinct keys, null included, and their counts. The join takes it with the
    partitioning it has; the parent's facts (rows, rows without a key) are a scalar aggregate of the same
    grouping, whose shuffle Spark reuses. The child is read once. It is dealt to as many partitions as the session
    has for shuffles, which Spark does not merge (nor those of the keys, which lie alike): merged by their compressed
    bytes, a task sorts as many rows of both sides as the input is large over the cores.
    """
    keys = parent.groupBy(_marked(F.col(parent_key)).alias("_p_key")).agg(F.count(F.lit(1)).alias("_p_cnt"))
    facts = keys.agg(F.struct(
        F.coalesce(F.sum("_p_cnt"), F.lit(0)).alias("n"),
        F.coalesce(F.sum(F.when(F.col("_p_key") == "n", F.col("_p_cnt"))), F.lit(0)).alias("nn")).alias("f")).scalar()
    keyed = child.withColumn("_l_null", child_key.isNull()).withColumn("_l_key", salted(child_key, child.columns))
    keyed = keyed.repartition(int(child.sparkSession.conf.get("spark.sql.shuffle.partitions")), "_l_key")
    rows = keyed.join(keys, F.col("_l_key") == F.col("_p_key"), "left")
    missing = ~F.col("_l_null") & F.col("_p_cnt").isNull() & (facts["nn"] == 0)
    return rows, (facts["n"] == 0) | missing


def with_not_in_flag(left: DataFrame, left_key: Column, parent: DataFrame, parent_key: str,
                     flag_name: str) -> DataFrame:
    """Add ``flag_name = CASE WHEN left_key NOT IN (SELECT parent_key FROM parent) THEN TRUE ELSE FALSE``."""
    rows, not_in = _joined(left, left_key, parent, parent_key)
    return rows.withColumn(flag_name, not_in).select(*left.columns, flag_name)


def not_in_rows(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows of ``child`` for which ``child_key NOT IN (SELECT parent_key FROM parent)`` is TRUE: all if
    the parent is empty, none if it holds a NULL, else those with a non-null key without a match."""
    rows, not_in = _joined(child, F.col(child_key), parent, parent_key)
    return rows.where(not_in).select(*child.columns)


def with_in_flag(left: DataFrame, left_key: Column, keys: DataFrame, key: str, flag_name: str) -> DataFrame:
    """Add ``flag_name`` = (``left_key IN keys``) where a NULL outcome reads as FALSE.

    Used inside ``SUM(CASE WHEN ... IN (subquery) ...)``, where NULL and FALSE behave alike.
    """
    k = keys.select(F.col(key).alias("_in_key")).distinct().withColumn("_in_hit", F.lit(True))
    joined = left.withColumn("_l_key", left_key).join(k, F.col("_l_key") == F.col("_in_key"), "left")
    return (joined.withColumn(flag_name, F.col("_in_hit").isNotNull())
            .drop("_l_key", "_in_key", "_in_hit"))
