"""Mixing sources to target weights, in DataFrame functions.

Sizes are summed per source. Sources in code point order (null last) weigh ``weights``, repeating, and share
the total by weight; a target stops at ``cap`` times its source's size, and what exceeds it is shared again among
the others until none is above. All shares have one price per weight, a fraction of two whole numbers, so a
round is one aggregate over the table of sources and compares exactly. A source's rate is its target over its
size: a document is taken floor(rate) times, and once more if its hash, read as a number in (0, 1), is below the
rest of the rate.

A document's hash covers all its columns and, for equal rows, their number, so that copies draw apart. Equal
rows are counted before the shuffle and expanded after it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlake.llm.common import stored
from loanlake.operators.windows import prefix_sums

WORD = r"[^\x20\x09-\x0D]+"
HEX_DIGITS = 12  # of the MD5 that make the number in (0, 1)
WEIGHTS, CAP = (5, 2, 1), 3


def word_count(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def row_key(df: DataFrame) -> Column:
    """MD5 of all columns; equal for equal rows."""
    shown = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\\N")) for c in df.columns]
    return F.md5(F.concat_ws("|", *shown).cast("binary"))


def coin(key: Column, number: Column, seed: int) -> Column:
    """A number in (0, 1) from the hash of a row and its number among equal rows."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), key, number.cast("string")).cast("binary"))
    return (F.conv(F.substring(digest, 1, HEX_DIGITS), 16, 10).cast("double") + 0.5) / float(16 ** HEX_DIGITS)


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, source_size) -> the same with ``target`` (double) and ``rate`` (double, at most ``cap``).

    Sources of size 0 have target and rate 0. Sizes are whole numbers, 0 or more; each source has one row.
    """
    ranked = prefix_sums(sizes.withColumn("_one", F.lit(1).cast("long")), ["source"], "_one", "_rank")
    turn = F.pmod(F.col("_rank") - 1, F.lit(len(weights))).cast("int")
    weighed = stored(ranked.select(
        "source", F.col("source_size").cast("long").alias("source_size"),
        F.element_at(F.array(*[F.lit(int(w)) for w in weights]), turn + 1).cast("long").alias("weight")), "sources")
    total, share, _ = weighed.agg(F.sum("source_size"), F.sum("weight"), F.count(F.lit(1))).first()
    price, per, count = total or 0, share or 1, -1  # a unit of weight takes price / per
    big = "decimal(38,0)"

    def over(price: int, per: int) -> Column:
        return (F.col("weight").cast("decimal(10,0)") * F.lit(price).cast("decimal(20,0)")).cast(big) > (
            F.col("source_size").cast("decimal(20,0)") * F.lit(cap * per).cast("decimal(17,0)")).cast(big)

    while True:
        held, rest, n = weighed.agg(
            F.sum(F.when(over(price, per), F.col("source_size") * cap)),
            F.sum(F.when(~over(price, per), F.col("weight"))), F.count_if(over(price, per))).first()
        if not n or n == count:
            break
        # while caps add up to more than the total, some source is below its cap
        price, per, count = total - held, rest, n
    target = F.when(over(price, per), (F.col("source_size") * cap).cast("double")).otherwise(
        (F.col("weight") * F.lit(price)).cast("double") / F.lit(float(per)))
    priced = weighed.withColumn("target", F.when(F.col("source_size") == 0, 0.0).otherwise(target))
    return priced.withColumn("rate", F.when(F.col("source_size") == 0, 0.0).otherwise(
        F.least(F.col("target") / F.col("source_size"), F.lit(float(cap))))).drop("weight")


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: int = 0) -> DataFrame:
    """A row per row of ``docs``: id, ``source``, ``row_key``, ``size``, ``source_size``, ``target`` and
    ``copies``, the number of times the mix takes it.

    * ``size`` is the number of words (null and empty: 0). A null source is a source, the last one.
    * Rows with equal values in all columns of ``docs`` share a ``row_key`` and draw one by one. Null ids
      are values like any other.
    * A source of no words has target 0 and none of its documents is taken. If ``cap`` is 1 or more the targets add
      up to the total size. Empty input: empty result. Columns of any names may be there.
    """
    if cap < 1 or not weights or any(w < 1 for w in weights):
        raise ValueError("weights and cap are whole numbers of 1 or more")
    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{source}`").cast("string").alias("source"),
                       word_count(F.col(f"`{text}`")).alias("size"), row_key(docs).alias("row_key"))
    counted = stored(rows.groupBy("id", "source", "size", "row_key").agg(F.count(F.lit(1)).alias("n")), "sizes")
    totals = stored(counted.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), "totals")
    targets = source_targets(totals, weights, cap).select(
        F.col("source").alias("of"), "source_size", "target", "rate")
    joined = counted.join(targets, F.col("source").eqNullSafe(F.col("of"))).withColumn(
        "number", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    whole = F.floor("rate")
    extra = (coin(F.col("row_key"), F.col("number"), seed) < F.col("rate") - whole).cast("long")
    return joined.select(F.col("id").alias(doc_id), F.col("source").alias("source"), "row_key", "size", "source_size",
                         "target", (whole + extra).alias("copies"))


def emit(docs: DataFrame, mixed: DataFrame, copy: str = "copy") -> DataFrame:
    """The documents of the mix: each row of ``docs`` as often as ``mixed`` (``mix`` of the same rows) takes it,
    numbered from 1 in ``copy`` (which replaces a column of that name) over all equal rows."""
    taken = mixed.groupBy(F.col("row_key").alias("__key")).agg(F.sum("copies").alias("__n")).where("__n > 0")
    rows = docs.withColumn("__key", row_key(docs)).dropDuplicates(["__key"])
    return (rows.join(taken, "__key").withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col("__n"))))
            .drop("__key", "__n"))
