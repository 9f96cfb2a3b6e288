"""Exact running totals and quantiles over the values of a column.

Running totals: rows are first reduced to one per (keys, value) with map-side
partial counts, so a value shared by a third of the rows is one row per task.
The distinct values of each key set are then cut into ordered slices, each
totalled by its own task, and the totals of the earlier slices are carried in.
Slices end at quantiles that a sketch of the key set's own values estimates;
they only say where a row goes, so an estimate changes no result, and each
column is spread over its own slices.

Quantiles of rows: the pass that counts a column's rows also sketches it. The
sketch brackets each wanted quantile; a second pass counts what lies between the
brackets and the distinct values inside them, which gives the exact ranks.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.session import pinned, written

SLICE = "__slice"
ALL = "__all"


def keyed(df: DataFrame, keys: list[str]) -> tuple[DataFrame, list[str]]:
    """A frame with at least one key column; a constant stands in where none is named."""
    return (df, keys) if keys else (df.withColumn(ALL, F.lit(1)), [ALL])


#: Groups that end at quantiles, and slices of equal width in each.
COARSE, FINE, SLICE_ACCURACY = 32, 16, 2_000


def value_limits(rows: DataFrame, value: str) -> list[float]:
    """The ends of groups that hold about equally many rows; fixed on the driver, so all passes place a row alike."""
    shares = [i / COARSE for i in range(COARSE + 1)]
    found = rows.agg(F.percentile_approx(F.col(value).cast("double"), shares, SLICE_ACCURACY).alias("v")).first()["v"]
    return sorted(set(found or []))


def slice_of(value: Column, limits: list[float]) -> Column:
    """Slice number that never decreases as the value grows: the group by binary search, then the place in it. Null counts as lowest."""
    x = value.cast("double")

    def place(low: int, high: int) -> Column:
        if high - low == 1:
            start, end = limits[low], limits[high]
            return F.least(F.greatest(F.floor((x - start) / (end - start) * FINE), F.lit(0)), F.lit(FINE - 1)) + low * FINE
        middle = (low + high) // 2
        return F.when(x <= limits[middle], place(low, middle)).otherwise(place(middle, high))

    return F.coalesce(place(0, len(limits) - 1), F.lit(0).cast("long")) if len(limits) > 1 else F.lit(0).cast("long")


def running(counts: DataFrame, keys: list[str], value: str, measures: list[str]) -> DataFrame:
    """Add ``<m>_to`` (this and all smaller values) and ``<m>_sum`` (all values of the keys) for each measure.

    Rows whose keys are null are left out, as in any grouping of the statistics.
    ``counts`` is written once; its own limits, slices and totals read it back.
    """
    counts = written(counts, "counts")
    shares = [i / COARSE for i in range(COARSE + 1)]
    sketch = F.percentile_approx(F.col(value).cast("double"), shares, SLICE_ACCURACY)
    limits, few = pinned(counts.groupBy(*keys).agg(F.array_sort(F.array_distinct(sketch)).alias("__limits")))
    if few:
        # Never null, so that the join adds no filter to one side and both sides read one exchange.
        df = counts.join(limits, keys).withColumn(SLICE, slice_in(F.col(value), F.col("__limits"))).drop("__limits")
    else:  # so many key sets that each has few values
        df = with_slice(counts, value, value_limits(counts, value))
    own = Window.partitionBy(*keys, SLICE).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(*keys)
    # One row per slice and keys.
    carry = df.groupBy(*keys, SLICE).agg(*[F.sum(m).alias(m) for m in measures]).select(
        *keys, SLICE,
        *[F.coalesce(F.sum(m).over(before), F.lit(0)).alias(f"__b_{m}") for m in measures],
        *[F.sum(m).over(everything).alias(f"{m}_sum") for m in measures],
    )
    out = df.withColumns({f"{m}_to": F.sum(m).over(own) for m in measures}).join(carry, [*keys, SLICE])
    return out.withColumns({f"{m}_to": F.col(f"{m}_to") + F.col(f"__b_{m}") for m in measures}).drop(
        SLICE, *[f"__b_{m}" for m in measures]
    )


def slice_in(value: Column, limits: Column) -> Column:
    """``slice_of`` for limits held in an array column."""
    x = value.cast("double")
    group = F.greatest(F.least(F.size(F.filter(limits, lambda limit: limit < x)), F.size(limits) - 1), F.lit(1))
    start, end = F.element_at(limits, group), F.element_at(limits, group + 1)
    fine = F.least(F.greatest(F.floor((x - start) / (end - start) * FINE), F.lit(0)), F.lit(FINE - 1))
    return F.when(F.size(limits) < 2, F.lit(0).cast("long")).otherwise(F.coalesce(fine + (group - 1) * FINE, F.lit(0).cast("long")))


def with_slice(rows: DataFrame, value: str, limits: list[float]) -> DataFrame:
    return rows.withColumn(SLICE, slice_of(F.col(value), limits))


def prob_list(probs: list[float]) -> list[float]:
    return [float(p) for p in probs]


#: Sketches are off by a share of 1/ACCURACY of the rows at most; brackets reach this far to both sides of a quantile.
ACCURACY, REACH = 10_000, (0.001, 0.05)
#: Columns sketched in one pass.
COLUMNS_PER_PASS = 200
WHOLE = (float("-inf"), float("inf"))


def sketch_shares(probs: Iterable[float]) -> list[float]:
    """The shares to ask of a sketch, so that it can bracket the given quantiles."""
    around = {p + side * reach for p in probs for reach in REACH for side in (-1, 1)}
    return sorted({0.0, 1.0} | {s for s in around if 0 < s < 1})


def bracket(prob: float, n: int, shares: list[float], points: list[float]) -> tuple[float, float]:
    """Values between which the quantile of ``n`` rows lies; all values where a sketch of so few rows can't tell."""
    for reach in REACH:
        if n * (reach - 1 / ACCURACY) > 3:
            low, high = prob - reach, prob + reach
            return (points[shares.index(low)] if low > 0 else WHOLE[0], points[shares.index(high)] if high < 1 else WHOLE[1])
    return WHOLE


def merged(brackets: Iterable[tuple[float, float]]) -> tuple[list[float], list[float]]:
    """Overlapping brackets as disjoint ones: their lower and upper ends."""
    lows: list[float] = []
    highs: list[float] = []
    for low, high in sorted(brackets):
        if lows and low <= highs[-1]:
            highs[-1] = max(highs[-1], high)
        else:
            lows.append(low)
            highs.append(high)
    return lows, highs


#: For each key set the probabilities and their brackets.
Wanted = dict[tuple, dict[float, tuple[float, float]]]


class KeyedRows:
    """Values of rows, by keys of which there are at most 10,000."""

    def __init__(self, rows: DataFrame, keys: list[str], value: str):
        self.rows, self.keys, self.value = rows, keys, value
        self.types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keys).schema)

    def places(self, wanted: Wanted) -> DataFrame:
        """Where each value lies: an even ``place`` between brackets, an odd one inside, and there the value ``x``."""
        table = [(*key, *merged(probs.values())) for key, probs in wanted.items()]
        bounds = F.broadcast(self.rows.sparkSession.createDataFrame(table, f"{self.types}, __lows array<double>, __highs array<double>"))
        x = F.col(self.value).cast("double")
        place = F.size(F.filter("__lows", lambda low: low <= x)) + F.size(F.filter("__highs", lambda high: high < x))
        placed = self.rows.join(bounds, self.keys).select(*self.keys, place.alias("place"), x.alias("x"))
        return placed.withColumn("x", F.when(F.col("place") % 2 == 1, F.col("x")))


class ColumnRows:
    """Values of columns; their name is the key."""

    keys, types = ["variavel"], "variavel string"

    def __init__(self, df: DataFrame):
        self.rows = df

    def places(self, wanted: Wanted) -> DataFrame:
        """As of ``KeyedRows``; the brackets are comparisons in the row, and only places are stacked."""
        stacked = {}
        for (c,), probs in wanted.items():
            x = F.nanvl(F.col(c).cast("double"), F.lit(None))
            lows, highs = merged(probs.values())
            place = reduce(lambda a, b: a + b, [(x >= F.lit(v)).cast("int") for v in lows] + [(x > F.lit(v)).cast("int") for v in highs])
            stacked[c] = F.struct(place.alias("place"), x.alias("x")).alias(c)
        long = self.rows.select(*stacked.values()).unpivot([], list(stacked), "variavel", "v").filter(F.col("v.x").isNotNull())
        return long.select("variavel", "v.place", F.when(F.col("v.place") % 2 == 1, F.col("v.x")).alias("x"))


def ranked(rows: KeyedRows | ColumnRows, wanted: Wanted) -> DataFrame:
    """Exact quantiles by linear interpolation, (keys, prob, quantile), from one pass over ``rows``.

    A quantile that proves to lie outside its bracket is looked for again among
    all values of its keys.
    """
    spark, keys, types = rows.rows.sparkSession, rows.keys, rows.types
    out = f"{types}, prob double, quantile double"
    wanted = {key: probs for key, probs in wanted.items() if None not in key and probs}
    if not wanted:
        return spark.createDataFrame([], out)
    held = written(rows.places(wanted).groupBy(*keys, "place", "x").agg(F.count(F.lit(1)).alias("n")), "ranked")
    sizes: dict[tuple, list] = {}
    for r in held.groupBy(*keys, "place").agg(F.sum("n").alias("n")).collect():  # at most a few rows a bracket
        sizes.setdefault(tuple(r)[:-2], []).append((r["place"], r["n"]))
    hits, missed = [], {}
    for key, places in sizes.items():
        total = sum(n for _, n in places)
        for prob in wanted[key]:
            at, first = (total - 1) * prob, 0
            for number, n in sorted(places):
                if number % 2 and first <= math.floor(at) and math.ceil(at) < first + n:
                    hits.append((*key, number, first, prob, math.floor(at), math.ceil(at), at - math.floor(at)))
                    break
                first += n
            else:
                missed.setdefault(key, {})[prob] = WHOLE
    spots = F.broadcast(spark.createDataFrame(hits, f"{types}, place int, first long, prob double, lower long, upper long, part double"))
    to_here = Window.partitionBy(*keys, "place").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    found = held.filter("place % 2 = 1").withColumn("to", F.sum("n").over(to_here)).join(spots, [*keys, "place"])
    first, last = F.col("first") + F.col("to") - F.col("n"), F.col("first") + F.col("to") - 1

    def of(rank: str) -> Column:
        return F.max(F.when((F.col(rank) >= first) & (F.col(rank) <= last), F.col("x")))

    ends = found.groupBy(*keys, "prob").agg(of("lower").alias("lo"), of("upper").alias("hi"), F.max("part").alias("part"))
    result = ends.select(*keys, "prob", (F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("part")).alias("quantile"))
    return result.unionByName(ranked(rows, missed)) if missed else result


def quantiles(rows: DataFrame, keys: list[str], value: str, probs: list[float]) -> DataFrame:
    """Exact quantiles with linear interpolation: one row per (keys, prob). Two passes, none of which shuffles the column."""
    shares = sketch_shares(probs)
    sketch, few = pinned(rows.groupBy(*keys).agg(F.count(value).alias("n"), F.percentile_approx(F.col(value).cast("double"), shares, ACCURACY).alias("points")))
    if not few:
        return counted_quantiles(rows.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n")), keys, value, probs)
    wanted = {tuple(r[k] for k in keys): {p: bracket(p, r["n"], shares, r["points"]) for p in probs} for r in sketch.collect() if r["n"]}
    return ranked(KeyedRows(rows, keys, value), wanted)


def counted_quantiles(counts: DataFrame, keys: list[str], value: str, probs: list[float]) -> DataFrame:
    """``quantiles`` of values with their number of rows in ``n``: read off their running totals."""
    line = running(counts, keys, value, ["n"]).withColumn("prob", F.explode(F.lit(list(probs))))
    at = (F.col("n_sum") - 1) * F.col("prob")

    def of(rank: Column) -> Column:
        return F.max(F.when((rank >= F.col("n_to") - F.col("n")) & (rank < F.col("n_to")), F.col(value)))

    ends = line.groupBy(*keys, "prob").agg(of(F.floor(at)).alias("lo"), of(F.ceil(at)).alias("hi"), F.max(at - F.floor(at)).alias("part"))
    return ends.select(*keys, "prob", (F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("part")).alias("quantile"))


def column_values(df: DataFrame, columns: list[str], extra: list[Column] | None = None) -> DataFrame:
    """The numeric columns stacked as (variavel, value); null and NaN are left out."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns], *(extra or []))
    ids = [c for c in long.columns if c not in columns]
    return long.unpivot(ids, columns, "variavel", "value").filter(F.col("value").isNotNull() & ~F.isnan("value"))


def column_sketches(df: DataFrame, columns: list[str], shares: list[float], also: dict[str, Callable[[Column], Column]] | None = None) -> dict[str, dict]:
    """Rows (``n``), sketch (``points`` at ``shares``) and further aggregates of each column, 200 columns a pass."""
    measures = {"n": F.count, "points": lambda x: F.percentile_approx(x, shares, ACCURACY), **(also or {})}
    out = {}
    for i in range(0, len(columns), COLUMNS_PER_PASS):
        part = columns[i: i + COLUMNS_PER_PASS]
        row = df.agg(*[f(F.nanvl(F.col(c).cast("double"), F.lit(None))).alias(f"{j}:{name}") for j, c in enumerate(part) for name, f in measures.items()]).first()
        out |= {c: {name: row[f"{j}:{name}"] for name in measures} for j, c in enumerate(part)}
    return out


def column_quantile_table(df: DataFrame, columns: list[str], probs: dict[str, list[float]], shares: list[float], sketches: dict[str, dict]) -> DataFrame:
    """Exact quantiles of sketched columns: (variavel, prob, quantile)."""
    wanted = {(c,): {p: bracket(p, sketches[c]["n"], shares, sketches[c]["points"]) for p in probs[c]} for c in columns if sketches[c]["n"]}
    return ranked(ColumnRows(df), wanted)


def column_quantiles(df: DataFrame, columns: list[str], probs: list[float], accuracy: int | None = None) -> dict[str, list[float]]:
    """Quantiles of many columns, returned to the driver (columns x probs values).

    Exact by default, in two passes. ``accuracy`` asks for Spark's sketch
    instead, one pass.
    """
    out: dict[str, list] = {c: [None] * len(probs) for c in columns}
    if not columns:
        return out
    if accuracy is not None:
        row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), probs, accuracy).alias(c) for c in columns]).first()
        return {c: list(row[c]) if row[c] is not None else out[c] for c in columns}
    probs = prob_list(probs)
    shares = sketch_shares(probs)
    table = column_quantile_table(df, columns, {c: probs for c in columns}, shares, column_sketches(df, columns, shares))
    place = {p: i for i, p in enumerate(probs)}
    for r in table.collect():
        out[r["variavel"]][place[r["prob"]]] = r["quantile"]
    return out


def bin_of(value: Column, edges: list[float]) -> Column:
    """1-based bin for sorted distinct edges: right-closed, the lowest edge included, null outside."""
    inner = [F.when(value > e, 1).otherwise(0) for e in edges[1:-1]]
    number = reduce(lambda a, b: a + b, inner, F.lit(1))
    return F.when((value >= edges[0]) & (value <= edges[-1]), number)


def equal_edges(low: float, high: float, bins: int) -> list[float]:
    step = (high - low) / bins
    return [low + i * step for i in range(bins)] + [high]


def equal_bin_of(value: Column, edges: list[float]) -> Column:
    """1-based bin for equal-width edges: left-closed, the last bin closed, null outside."""
    inner = [F.when(value >= e, 1).otherwise(0) for e in edges[1:-1]]
    number = reduce(lambda a, b: a + b, inner, F.lit(1))
    return F.when((value >= edges[0]) & (value <= edges[-1]), number)


def distinct_edges(values: list[float | None]) -> list[float]:
    return sorted({v for v in values if v is not None})


def banded(counts: DataFrame, keys: list[str], value: str, n_bins: int, name: str = "quantil") -> DataFrame:
    """Give each distinct value its quantile band within the keys; equal edges merge into fewer bands."""
    counts = written(counts, "counted")
    edges = counted_quantiles(counts, keys, value, [i / n_bins for i in range(n_bins + 1)]).groupBy(*keys).agg(
        F.sort_array(F.collect_set("quantile")).alias("__edges")
    )
    few, _ = pinned(edges)
    return (
        counts.join(few, keys)
        .withColumn(name, F.greatest(F.size(F.filter("__edges", lambda e: e < F.col(value))), F.lit(1)))
        .drop("__edges")
    )
