"""Running aggregates over ordered histories, whatever an entity's length.

The log is dealt by ranges of (entity, time). A range ends where an entity does,
and inside an entity that holds more rows than a range should: such entities,
the one without a name included, are cut at quantiles of their times. Frames
run inside each range; what the ranges before hold under the same keys is
carried in as a row of totals that stands first, so the second level of the scan
needs no join and no list of entities. A cut is a whole second, so rows of one
second stay together.

``time_cuts`` finds the cuts. There are at most about twice as many as
``RANGES``, as every cut entity holds over that share of the log.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from waymark.session import pinned, written
from waymark.spec import ENTITY, TIME

CELL, MARK = "__cell", "__mark"
#: An entity is cut if it has more rows than one range: 100,000, or a 1,024th of the log where that is more.
RANGE_ROWS, RANGES = 100_000, 1_024
DAY = 86_400
EARLIER = (Window.unboundedPreceding, -1)


@dataclass(frozen=True)
class Measure:
    """A running total, maximum or row count of an expression."""

    kind: str
    value: Column | None = None

    def aggregate(self) -> Column:
        if self.kind == "count":
            return F.count(F.lit(1))
        return F.sum(self.value) if self.kind == "sum" else F.max(self.value)

    def merge(self, name: str) -> Column:
        return F.max(name) if self.kind == "max" else F.sum(name)

    def with_carry(self, real: Column, carried: Column, w: WindowSpec) -> Column:
        """The aggregate over a window where real rows count by themselves and other rows stand for ``carried``."""
        value = F.when(real, F.lit(1) if self.kind == "count" else self.value).otherwise(carried)
        out = F.max(value).over(w) if self.kind == "max" else F.sum(value).over(w)
        return F.coalesce(out, F.lit(0)) if self.kind == "count" else out


def total(value: Column) -> Measure:
    return Measure("sum", value)


def latest(value: Column) -> Measure:
    return Measure("max", value)


def rows() -> Measure:
    return Measure("count")


def seconds(time: Column, unit: float = 1.0) -> Column:
    """Whole seconds of a time in days (or in ``unit`` to a day)."""
    return F.floor(time / F.lit(float(unit)) * DAY).cast("long")


def time_cuts(
    log: DataFrame, entity: str = ENTITY, time: str = TIME, range_rows: int = RANGE_ROWS, least_days: float = 0.0,
) -> DataFrame | None:
    """Where the histories of large entities are cut: (entity, ascending seconds), or None where no entity is large.

    Copies are counted too, so pieces hold no more rows than wanted. Fixed on
    the driver, the cuts are the same for every pass and every repeated task.
    ``least_days`` keeps cuts apart.
    """
    total = log.count()
    if total <= range_rows:
        return None
    limit = max(range_rows, total // RANGES)
    rows = log.groupBy(entity).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > limit)
    large, _ = pinned(rows.select(F.col(entity).alias("__entity"), "n"), 2 * RANGES)
    sizes = {r["__entity"]: r["n"] for r in large.collect()}
    if not sizes:
        return None
    pieces = min(-(-max(sizes.values()) // limit), 2 * RANGES)
    shares = [i / pieces for i in range(1, pieces)]
    own = log.join(large, F.col(entity).eqNullSafe(F.col("__entity")), "left_semi")
    found = own.groupBy(entity).agg(F.percentile_approx(seconds(F.col(time)), shares, 10 * pieces).alias("at"))
    out = []
    for name, at in found.select(entity, "at").collect():
        wanted = -(-sizes[name] // limit)
        cuts: list[int] = []
        for i in range(1, wanted):
            second = at[max(i * pieces // wanted, 1) - 1] if at else 0
            if not cuts or second - cuts[-1] > least_days * DAY:
                cuts.append(second)
        out.append((name, cuts))
    return F.broadcast(log.sparkSession.createDataFrame(out, f"{entity} string, cuts array<long>"))


@dataclass(frozen=True)
class Frames:
    """Builds frames over histories, in the ranges that ``cuts`` (of ``time_cuts``) make."""

    cuts: DataFrame | None = None

    @property
    def cut(self) -> bool:
        return self.cuts is not None

    def _joined(self, df: DataFrame, key: str, how: str) -> DataFrame:
        cuts = self.cuts.select(F.col(self.cuts.columns[0]).alias("__entity"), F.col("cuts").alias("__cuts"))
        return df.join(F.broadcast(cuts), F.col(key).eqNullSafe(F.col("__entity")), how)

    def placed(self, df: DataFrame, time: str = TIME, unit: float = 1.0, key: str = ENTITY) -> DataFrame:
        """Add the number of the range, within its entity, that a row's time lies in."""
        if not self.cut:
            return df.withColumn(CELL, F.lit(0))
        at = seconds(F.col(time), unit)
        cell = F.coalesce(F.size(F.filter("__cuts", lambda c: c <= at)), F.lit(0))
        return self._joined(df, key, "left").withColumn(CELL, F.when(F.col("__cuts").isNotNull() & at.isNotNull(), cell).otherwise(0)).drop("__entity", "__cuts")

    def covered(self, df: DataFrame, start: str, end: str, key: str = ENTITY) -> DataFrame:
        """A row for each range that its time span touches."""
        if not self.cut:
            return df.withColumn(CELL, F.lit(0))
        first, last = (F.size(F.filter("__cuts", lambda c: c <= seconds(F.col(t)))) for t in (start, end))
        cells = F.when(F.col("__cuts").isNull(), F.array(F.lit(0))).otherwise(F.sequence(first, last))
        return self._joined(df, key, "left").withColumn(CELL, F.explode(cells)).drop("__entity", "__cuts")

    def every_cell(self, df: DataFrame, key: str = ENTITY) -> DataFrame:
        """A row for each range of its entity; entities that are not cut have no ranges to fill and are left out."""
        return self._joined(df, key, "inner").withColumn(CELL, F.explode(F.sequence(F.lit(0), F.size("__cuts")))).drop("__entity", "__cuts")

    def only_cut(self, df: DataFrame, key: str = ENTITY) -> DataFrame:
        return self._joined(df, key, "left_semi")

    def never_cut(self, df: DataFrame, key: str = ENTITY) -> DataFrame:
        return self._joined(df, key, "left_anti")

    def gather(self, df: DataFrame, *keys: str) -> DataFrame:
        """Bring each range's rows together once; all windows below it on finer keys need no exchange."""
        return df if self.cut else df.repartition(*keys)

    def earlier(
        self,
        df: DataFrame,
        keys: list[str],
        order: list,
        measures: dict[str, Measure],
        time: str = TIME,
        unit: float = 1.0,
        frame: tuple = EARLIER,
    ) -> DataFrame:
        """Add each measure over the rows before the current one (``order`` must be total and start with time)."""
        return self.earlier_each(df, [(keys, measures)], order, time, unit, frame)

    def earlier_each(
        self,
        df: DataFrame,
        groups: list[tuple[list[str], dict[str, Measure]]],
        order: list,
        time: str = TIME,
        unit: float = 1.0,
        frame: tuple = EARLIER,
    ) -> DataFrame:
        """``earlier`` for several key sets at once; the entity comes first in each."""
        if not self.cut:
            for keys, measures in groups:
                w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(*frame)
                df = df.withColumns({n: m.aggregate().over(w) for n, m in measures.items()})
            return df
        entity = groups[0][0][0]
        placed = self.placed(df, time, unit, entity).withColumn(MARK, F.lit(1))
        carries = [self._carried(placed, i, keys, measures) for i, (keys, measures) in enumerate(groups)]
        # Written, so that the main plan holds the history once.
        carry = written(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), carries), "carried")
        line = placed.unionByName(carry, allowMissingColumns=True).repartition(entity, CELL)
        for i, (keys, measures) in enumerate(groups):
            w = Window.partitionBy(*keys, CELL).orderBy(MARK, *order).rowsBetween(*frame)
            line = line.withColumns({n: m.with_carry(F.col(MARK) == 1, F.col(f"__c{i}_{n}"), w) for n, m in measures.items()})
        return line.filter(F.col(MARK) == 1).select(*df.columns, *[n for _, measures in groups for n in measures])

    def _carried(self, placed: DataFrame, i: int, keys: list[str], measures: dict[str, Measure]) -> DataFrame:
        """For each range of a cut entity and each of its keys the totals of the ranges before: a row a range and key."""
        totals = self.only_cut(placed, keys[0]).groupBy(*keys, CELL).agg(*[m.aggregate().alias(n) for n, m in measures.items()])
        before = Window.partitionBy(*keys).orderBy(CELL).rowsBetween(*EARLIER)
        return totals.select(*keys, CELL, F.lit(0).alias(MARK), *[m.merge(n).over(before).alias(f"__c{i}_{n}") for n, m in measures.items()])

    def tick_start(self, df: DataFrame, keys: list[str], order: list, names: dict[str, str], time: str = TIME) -> DataFrame:
        """Turn "rows before" into "times before": the value at the first row of each instant."""
        w = Window.partitionBy(*keys, time).orderBy(*order)
        return df.withColumns({new: F.first(old).over(w) for new, old in names.items()})

    def trailing(
        self,
        df: DataFrame,
        key: str,
        second: str,
        measures: dict[str, tuple[Column, int]],
        anchor: Column,
    ) -> DataFrame:
        """Add sums over the last ``days`` before the current second, on anchor rows.

        A span of days that crosses ranges is the difference of two running
        totals, at the anchor and ``days`` before it; so it is for cut
        entities. The sum is null when no row falls in between.
        """
        if not self.cut:
            return self._moving(df, key, second, measures).filter(anchor)
        across = self._differences(written(self.only_cut(df, key), "history"), key, second, measures, anchor)
        return self._moving(self.never_cut(df, key), key, second, measures).filter(anchor).unionByName(across)

    def _moving(self, df: DataFrame, key: str, second: str, measures: dict[str, tuple[Column, int]]) -> DataFrame:
        return df.withColumns({
            name: F.sum(value).over(Window.partitionBy(key).orderBy(second).rangeBetween(-days * DAY, -1))
            for name, (value, days) in measures.items()
        })

    def _differences(self, df: DataFrame, key: str, second: str, measures: dict[str, tuple[Column, int]], anchor: Column) -> DataFrame:
        spans = sorted({days for _, days in measures.values()})
        flags = {f"__v{i}": value for i, (value, _) in enumerate(measures.values())}
        points = df.select(key, F.col(second).alias("__at"), F.lit(1).alias("__kind"),
                           F.lit(None).cast("int").alias("__span"), F.lit(None).cast("long").alias("__anchor"),
                           *[v.cast("double").alias(n) for n, v in flags.items()])
        probes = (
            df.filter(anchor).select(key, second).dropDuplicates()
            .select(key, F.col(second).alias("__anchor"), F.explode(F.array(*[F.lit(d) for d in [0, *spans]])).alias("__span"))
            .select(key, (F.col("__anchor") - F.col("__span") * DAY).alias("__at"), F.lit(0).alias("__kind"), "__span", "__anchor",
                    *[F.lit(None).cast("double").alias(n) for n in flags])
        )
        running = self.earlier(
            points.unionByName(probes), [key], ["__at", "__kind", "__span", "__anchor"],
            {"__n": total(F.col("__kind")), **{f"{n}_sum": total(F.col(n)) for n in flags}},
            time="__at", unit=DAY,
        ).filter(F.col("__kind") == 0)

        def at(name: str, span: int) -> Column:
            return F.coalesce(F.max(F.when(F.col("__span") == span, F.col(name))), F.lit(0))

        sums = []
        for i, (name, (_, days)) in enumerate(measures.items()):
            inside = at("__n", 0) - at("__n", days)
            sums.append(F.when(inside > 0, (at(f"__v{i}_sum", 0) - at(f"__v{i}_sum", days)).cast("long")).alias(name))
        found = running.groupBy(F.col(key).alias("__key"), "__anchor").agg(*sums)
        same = F.col(key).eqNullSafe(F.col("__key")) & (F.col(second) == F.col("__anchor"))
        return df.filter(anchor).join(found, same, "left").drop("__key", "__anchor")


def most_recent(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row per key: the first in ``order``.

    Spark limits the groups before the shuffle as well, so a hot pair sends one
    row per task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")
