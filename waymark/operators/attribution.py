"""Which received item earned each conversion."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waymark.operators.events import with_items
from waymark.operators.frames import CELL, EARLIER, Frames, latest
from waymark.spec import DEFAULT, ENTITY, EVENT, ITEM, MATCHES, TARGET, TIME, EventSpec

NEVER_VIEWED = 1e9
_OUT_ROWS = 10_000


def _open_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One pass over (entity, range, time): spans enter a heap when they start and leave it when they end; each conversion emits the open ones."""
    names = [ENTITY, TIME, ITEM, "start_t", "end_t"]
    types = [pa.string(), pa.float64(), pa.string(), pa.float64(), pa.float64()]
    owner, held, out = None, [], []
    for batch in batches:
        for entity, cell, at, kind, item, end in zip(*(batch.column(c).to_pylist() for c in (ENTITY, CELL, TIME, "kind", ITEM, "end_t"))):
            if (entity, cell) != owner:
                owner, held = (entity, cell), []
            if kind == 0:
                heapq.heappush(held, (end, at, item))
                continue
            while held and held[0][0] < at:
                heapq.heappop(held)
            out.extend((entity, at, name, start, until) for until, start, name in held)
            if len(out) > _OUT_ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
                out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)


def eligible_offers(pairs: DataFrame, windows: DataFrame, frames: Frames = Frames()) -> DataFrame:
    """Received items open at each conversion instant: start_t <= t <= end_t.

    A sweep over the merged timeline of an entity's spans and conversions. No
    pair of a conversion and a closed span is ever made. Where a history is cut,
    each span enters the ranges it touches. Rows without entity match nothing.
    """
    spans = windows.filter(F.col(ENTITY).isNotNull() & F.col(ITEM).isNotNull() & F.col("end_t").isNotNull() & F.col("start_t").isNotNull())
    starts = frames.covered(spans, "start_t", "end_t").select(ENTITY, CELL, F.col("start_t").alias(TIME), F.lit(0).alias("kind"), ITEM, F.col("end_t").cast("double").alias("end_t"))
    asked = frames.placed(pairs.filter(F.col(ENTITY).isNotNull() & F.col(TIME).isNotNull())).select(
        ENTITY, CELL, TIME, F.lit(1).alias("kind"), F.lit(None).cast("string").alias(ITEM), F.lit(None).cast("double").alias("end_t"))
    line = starts.unionByName(asked).repartition(ENTITY, CELL).sortWithinPartitions(ENTITY, CELL, TIME, "kind")
    return line.mapInArrow(_open_spans, f"{ENTITY} string, {TIME} double, {ITEM} string, start_t double, end_t double")


def attach_views(candidates: DataFrame, viewed: DataFrame, frames: Frames = Frames(), within_window: bool = False) -> DataFrame:
    """Latest view of the same item at or before the conversion.

    An as-of join as one running maximum: views and candidates of a pair lie on
    one timeline, views first at equal times. Earlier views cannot win the
    ranking, so only the closest is kept.
    """
    timeline = candidates.withColumn("__kind", F.lit(1)).unionByName(
        viewed.select(ENTITY, ITEM, F.col("t_view").alias(TIME), F.lit(0).alias("__kind")), allowMissingColumns=True
    )
    seen = frames.earlier(
        frames.gather(timeline, ENTITY), [ENTITY, ITEM], [TIME, "__kind", "start_t"],
        {"t_view": latest(F.when(F.col("__kind") == 0, F.col(TIME)))},
    ).filter("__kind = 1").drop("__kind")
    if within_window:
        seen = seen.withColumn("t_view", F.when(F.col("t_view") >= F.col("start_t"), F.col("t_view")))
    return seen.withColumns({
        "has_view": F.col("t_view").isNotNull().cast("int"),
        "dview": F.col(TIME) - F.col("t_view"),
    })


def rank_candidates(candidates: DataFrame) -> DataFrame:
    """Order candidates of an instant: viewed, closest view, latest received, item id."""
    w = Window.partitionBy(ENTITY, TIME).orderBy(
        F.desc("has_view"), F.asc_nulls_last("dview"), F.desc("start_t"), F.asc(ITEM)
    )
    return candidates.withColumn("rank_elig", F.row_number().over(w))


def detect_ambiguity(ranked: DataFrame) -> DataFrame:
    """Count candidates that share view state, view distance and start; more than one is ambiguous.

    A window on the ranking's own partitioning takes the place of a self join.
    """
    distance = F.coalesce("dview", F.lit(NEVER_VIEWED))
    w = Window.partitionBy(ENTITY, TIME, "has_view", distance, "start_t")
    return ranked.withColumn("n_same_score", F.count(F.lit(1)).over(w)).withColumn(
        "ambiguous", (F.col("n_same_score") > 1).cast("int")
    )


CARRIED, RECEIVED, VIEWED, COMPLETED, PURCHASED = range(5)


class _State:
    """What an entity's timeline has shown so far: per item its open span, its latest view and the latest span the view fell into."""

    def __init__(self) -> None:
        self.spans: dict[str, tuple[float, float]] = {}
        self.views: dict[str, tuple[float, float | None]] = {}

    def candidate(self, item: str, at: float, within: bool) -> tuple[int, float, float] | None:
        """(no view, distance of the view, minus start) of the item's best open span; lower is better."""
        start, days = self.spans[item]
        if at > start + days:
            return None
        view, viewed_start = self.views.get(item, (None, None))
        if view is None:
            return 1, NEVER_VIEWED, -start
        if not within:
            return 0, at - view, -start
        # Of the spans that hold the view the latest is the best; it is still open if its end is not passed.
        if viewed_start is not None and at <= viewed_start + days:
            return 0, at - view, -viewed_start
        return 1, NEVER_VIEWED, -start

    def winner(self, at: float, within: bool) -> tuple[str, float] | None:
        """The item and start of the best candidate, if no other has the same view and start."""
        best, name, same, closed = None, "", 0, []
        for item in self.spans:
            found = self.candidate(item, at, within)
            if found is None:
                closed.append(item)
            elif best is None or found < best:
                best, name, same = found, item, 1
            elif found == best:
                name, same = min(name, item), same + 1
        for item in closed:
            del self.spans[item]
        return (name, -best[2]) if same == 1 else None


def _winners(within: bool):
    names, types = [ENTITY, TIME, ITEM, "start_t"], [pa.string(), pa.float64(), pa.string(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owner, state, instant, happened = None, _State(), None, set()

        def settled() -> list[tuple]:
            if COMPLETED in happened and PURCHASED in happened:
                won = state.winner(instant, within)
                if won:
                    return [(owner[0], instant, *won)]
            return []

        for batch in batches:
            out = []
            columns = (batch.column(c).to_pylist() for c in (ENTITY, CELL, TIME, "kind", ITEM, "duration", "start_t", "t_view", "seen_start"))
            for entity, cell, at, kind, item, days, start, view, seen_start in zip(*columns):
                if (entity, cell) != owner:
                    out += settled()
                    owner, state, instant, happened = (entity, cell), _State(), at, set()
                elif at != instant:
                    out += settled()
                    instant, happened = at, set()
                happened.add(kind)
                if kind == CARRIED:
                    if days is not None and start is not None:
                        state.spans[item] = (start, days)
                    if view is not None:
                        state.views[item] = (view, seen_start)
                elif kind == RECEIVED:
                    state.spans[item] = (at, days)
                elif kind == VIEWED:
                    state.views[item] = (at, state.spans[item][0] if item in state.spans else None)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
        if out := settled():
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
    return run


def _carried_state(line: DataFrame, frames: Frames) -> DataFrame:
    """For the ranges of cut entities what the ranges before leave of each item: its latest span and view. A row a range and item."""
    own = frames.only_cut(line.filter(F.col("kind").isin(RECEIVED, VIEWED)))
    received_at = latest(F.when(F.col("kind") == RECEIVED, F.col(TIME)))
    own = frames.earlier(own, [ENTITY, ITEM], [TIME, "kind"], {"last": received_at}, frame=(Window.unboundedPreceding, 0))
    totals = frames.placed(own).groupBy(ENTITY, ITEM, CELL).agg(
        F.max(F.when(F.col("kind") == RECEIVED, F.col(TIME))).alias("start_t"),
        F.max(F.when(F.col("kind") == VIEWED, F.struct(F.col(TIME), F.col("last")))).alias("view"))
    grid = frames.every_cell(totals.select(ENTITY, ITEM).distinct()).join(totals, [ENTITY, ITEM, CELL], "left")
    before = Window.partitionBy(ENTITY, ITEM).orderBy(CELL).rowsBetween(*EARLIER)
    held = grid.select(ENTITY, ITEM, CELL, F.max("start_t").over(before).alias("start_t"), F.max("view").over(before).alias("view"))
    return held.filter("start_t IS NOT NULL OR view IS NOT NULL").select(
        ENTITY, ITEM, CELL, F.lit(float("-inf")).alias(TIME), F.lit(CARRIED).alias("kind"), "start_t", F.col(f"view.{TIME}").alias("t_view"), F.col("view.last").alias("seen_start"))


def attributed_conversions(
    log: DataFrame,
    items: DataFrame,
    spec: EventSpec = DEFAULT,
    frames: Frames = Frames(),
    exclude_types: list[str] | None = None,
    view_within_window: bool = False,
) -> DataFrame:
    """One row per conversion with a clear winner: (entity, t, item, start_t).

    One sweep over each entity's timeline. Of an item only its latest open span
    and its latest view matter, so the state is a few numbers for each open item
    and no pair of conversion and span is made. A view belongs to the latest
    span at or before it. Where a history is cut, each range begins with the
    state that the ranges before leave. Rows without entity or time earn nothing.
    """
    kinds = {spec.received: RECEIVED, spec.viewed: VIEWED, spec.completed: COMPLETED, spec.purchase: PURCHASED}
    kind = reduce(lambda c, k: c.when(F.col(EVENT) == k[0], F.lit(k[1])), list(kinds.items())[1:], F.when(F.col(EVENT) == spec.received, F.lit(RECEIVED)))
    known = log.filter(F.col(ENTITY).isNotNull() & F.col(TIME).isNotNull()).select(ENTITY, ITEM, TIME, kind.alias("kind")).filter(
        "kind IS NOT NULL").filter(~F.col("kind").isin(RECEIVED, VIEWED) | F.col(ITEM).isNotNull())
    columns = ["duration", "offer_type"] if exclude_types else ["duration"]
    timed = with_items(known, items, columns).withColumn("duration", F.col("duration").cast("double"))
    if exclude_types:
        timed = timed.withColumn("duration", F.when(~F.col("offer_type").isin(exclude_types), F.col("duration"))).drop("offer_type")
    # A received item without a span can't be redeemed.
    line = frames.placed(timed.filter((F.col("kind") != RECEIVED) | F.col("duration").isNotNull()))
    if frames.cut:
        state = with_items(_carried_state(line.drop(CELL, "duration"), frames), items, ["duration"]).withColumn("duration", F.col("duration").cast("double"))
        line = line.unionByName(state, allowMissingColumns=True)
    else:
        line = line.withColumns({c: F.lit(None).cast("double") for c in ("start_t", "t_view", "seen_start")})
    swept = line.repartition(ENTITY, CELL).sortWithinPartitions(ENTITY, CELL, TIME, "kind")
    return swept.mapInArrow(_winners(view_within_window), f"{ENTITY} string, {TIME} double, {ITEM} string, start_t double")


def label_pairs(conversions: DataFrame) -> DataFrame:
    """Conversions earned by each (entity, item)."""
    counts = conversions.groupBy(ENTITY, ITEM).agg(F.count(F.lit(1)).alias(MATCHES))
    return counts.withColumn(TARGET, (F.col(MATCHES) > 0).cast("int"))


def audience_with_target(audience: DataFrame, labels: DataFrame) -> DataFrame:
    """Audience with its label; pairs that never converted get 0."""
    return audience.join(labels, [ENTITY, ITEM], "left").na.fill({MATCHES: 0, TARGET: 0})


# The sentences printed for each (target, matches) combination.
NO_CONVERSION = "Recebeu oferta mas não converteu"
ONE_CONVERSION = "1 conversão vinculada à oferta"
REPEATED = "{} conversões para a mesma oferta"
OTHER_CASE = "Outro caso"


def explain_matches(labelled: DataFrame) -> DataFrame:
    """Pairs per (target, matches) with a sentence, most frequent first."""
    hit, n = F.col(TARGET) == 1, F.col(MATCHES)
    text = F.when((F.col(TARGET) == 0) & (n == 0), F.lit(NO_CONVERSION)).when(hit & (n == 1), F.lit(ONE_CONVERSION))
    for k in range(2, 6):
        text = text.when(hit & (n == k), F.lit(REPEATED.format(k)))
    counts = labelled.groupBy(TARGET, MATCHES).count()
    return counts.withColumn("significado", text.otherwise(F.lit(OTHER_CASE))).orderBy(F.desc("count"))
