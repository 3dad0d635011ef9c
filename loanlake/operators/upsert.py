"""Key-based dedup, upsert and insert-only append on plain DataFrames.

All three are groupings or anti joins, never windows over a key: ``max(struct(order..., row))``
is a declarative aggregate with map-side partial aggregation, so a key that holds a third of all
rows collapses to one row per map task before the shuffle instead of landing whole in one task.
The struct comparison is total and deterministic (earlier fields first; NULL sorts lowest), so
"latest by load stamp" is well defined even on ties.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_latest(df: DataFrame, key: list[str], order_by: list[str]) -> DataFrame:
    """Keep one row per ``key``: the greatest by ``order_by``, then by the remaining columns."""
    rest = [c for c in df.columns if c not in key and c not in order_by]
    packed = F.struct(*[F.col(c) for c in order_by + rest]).alias("_best")
    best = df.groupBy(*key).agg(F.max(packed).alias("_best"))
    return best.select(*key, *[F.col(f"_best.{c}").alias(c) for c in order_by + rest]).select(*df.columns)


def upsert(existing: DataFrame, updates: DataFrame, key: list[str], order_by: list[str]) -> DataFrame:
    """MERGE semantics: a key present in ``updates`` takes the update with the greatest
    ``order_by`` (matched -> update), new keys are inserted, untouched keys are kept."""
    tagged = (existing.select(*existing.columns, F.lit(0).alias("_src"))
              .unionByName(updates.select(*existing.columns, F.lit(1).alias("_src"))))
    # updates win over the stored row for the same key regardless of stamps; then latest stamp
    return dedup_latest(tagged, key, ["_src", *order_by]).drop("_src")


def append_new(existing: DataFrame, updates: DataFrame, key: list[str]) -> DataFrame:
    """Insert-only load: rows of ``updates`` whose key is not stored yet are appended."""
    fresh = updates.select(*existing.columns).join(existing.select(*key).distinct(), key, "left_anti")
    return existing.unionByName(fresh)


def merge_versions(existing: DataFrame, versions: DataFrame, key: list[str], order_by: str, keep: str) -> DataFrame:
    """MERGE of row versions: per key the newest by ``order_by`` decides (a tie: the new version); the
    row stays only if that version has ``keep``. This is the matched-delete branch that a plain upsert
    of clean rows lacks. One grouping with partial aggregation, whatever the key's frequency."""
    cols = existing.columns
    tagged = (existing.select(*cols, F.lit(True).alias("_keep"), F.lit(0).alias("_src"))
              .unionByName(versions.select(*cols, F.col(keep).alias("_keep"), F.lit(1).alias("_src"))))
    return dedup_latest(tagged, key, [order_by, "_src"]).where("_keep").select(*cols)
