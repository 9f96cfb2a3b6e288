"""Numbers of rows in a total order, and joins with a table of one row a key, whatever a key weighs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.session import written

#: Bits that number the rows of one slice; the bits above number the slices.
AT_BITS = 33
FEW_KEYS, HEAVY_SHARE = 10_000, 1_000


def numbered(rows: DataFrame, order: list, name: str) -> DataFrame:
    """``rows`` with their ``number`` from 0 in ``order``.

    Rows are cut into sorted slices, numbered within, and the sizes of earlier
    slices added: one row a slice, so no more than there are shuffle
    partitions. ``order`` must tell all rows apart that aren't alike. ``rows``
    are read twice, so they should be cheap to read.
    """
    sliced = written(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()), name)
    sizes = sliced.groupBy(F.shiftright("__at", AT_BITS).alias("__slice")).agg(F.count(F.lit(1)).alias("__rows"))
    earlier = Window.orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__slice", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__start"))
    found = sliced.withColumn("__slice", F.shiftright("__at", AT_BITS)).join(F.broadcast(starts), "__slice")
    return found.withColumn("number", F.col("__start") + F.col("__at").bitwiseAND(F.lit((1 << AT_BITS) - 1))).drop("__slice", "__start", "__at")


def join_keys(rows: DataFrame, keyed: DataFrame, keys: list[str], weight: str) -> DataFrame:
    """``rows`` with the columns of ``keyed``: a written table of one row for each key of ``rows``, null included, whose ``weight`` counts its rows.

    Up to 10,000 keys are broadcast. Beyond, those with over a thousandth of
    the rows are (fewer than a thousand), and the others meet by a shuffle.
    """
    def same(side: str) -> Column:
        return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{side}{k}")) for k in keys])

    def met(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
        named = right.select(*[F.col(k).alias(f"__{k}") for k in keys], *[c for c in right.columns if c not in keys])
        return left.join(named, same("__"), how).drop(*[f"__{k}" for k in keys])

    if keyed.limit(FEW_KEYS + 1).count() <= FEW_KEYS:
        return met(rows, F.broadcast(keyed))
    limit = keyed.agg(F.sum(weight)).first()[0] // HEAVY_SHARE
    heavy, light = keyed.filter(F.col(weight) > limit), keyed.filter(F.col(weight) <= limit)
    return met(rows, F.broadcast(heavy)).unionByName(met(met(rows, F.broadcast(heavy.select(*keys)), "left_anti"), light))
