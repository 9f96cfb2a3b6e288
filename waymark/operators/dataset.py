"""Assembly of the books, dataset profiles and splits."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark.operators.attribution import attributed_conversions, audience_with_target, label_pairs
from waymark.operators.books import (
    POINT_IN_TIME, REFERENCE, anchor_history, book_communication, book_interaction, book_offer, book_pair, book_profile,
    book_purchases, book_recency, instances, wide_books,
)
from waymark.operators.events import audience, catalogue
from waymark.operators.frames import RANGE_ROWS, Frames, time_cuts
from waymark.session import written
from waymark.spec import BOOK_KEYS, DEFAULT, ENTITY, ITEM, KEY, TARGET, TIME, EventSpec


class Campaign:
    """A campaign's log, catalogue and entities, and the tables derived from them.

    Everything stays lazy. ``stage=True`` writes the log and the attributed
    conversions, which most books read, once to the shared folder. Histories of
    more than ``hot_rows`` rows are cut into ranges of time, at least
    ``slice_days`` apart.
    """

    def __init__(
        self,
        raw: DataFrame,
        items: DataFrame,
        entities: DataFrame,
        spec: EventSpec = DEFAULT,
        mode: str = REFERENCE,
        hot_rows: int = RANGE_ROWS,
        slice_days: float = 0.0,
        stage: bool = False,
    ):
        if mode not in (REFERENCE, POINT_IN_TIME):
            raise ValueError(f"unknown mode {mode}")
        self.raw, self.entities, self.spec, self.mode = raw, entities, spec, mode
        self.hot_rows, self.slice_days, self.stage = hot_rows, slice_days, stage
        self.items = catalogue(items)

    @cached_property
    def log(self) -> DataFrame:
        log = self.spec.log(self.raw)
        return written(log, "log") if self.stage else log

    @cached_property
    def frames(self) -> Frames:
        times = self.raw.select(F.col(self.spec.entity).cast("string").alias(ENTITY), F.col(self.spec.time).cast("double").alias(TIME))
        return Frames(time_cuts(times, ENTITY, TIME, self.hot_rows, self.slice_days))

    @cached_property
    def _conversions(self) -> DataFrame:
        earned = attributed_conversions(self.log, self.items, self.spec, self.frames)
        return written(earned, "conversions") if self.stage else earned

    @cached_property
    def _instances(self) -> DataFrame:
        return instances(self.log, self.items, self._conversions, self.spec, self.frames, self.mode)

    @cached_property
    def _history(self) -> DataFrame:
        return anchor_history(self.log, self.items, self._conversions, self.spec, self.frames, self.mode)

    def conversions(self) -> DataFrame:
        return self._conversions

    def labelled_audience(self) -> DataFrame:
        return audience_with_target(audience(self.raw, self.spec), label_pairs(self.conversions()))

    def instances(self) -> DataFrame:
        return self._instances

    def history(self) -> DataFrame:
        return self._history

    def plain_history(self) -> DataFrame:
        """The history without what conversions tell, for books that do not ask."""
        return anchor_history(self.log, self.items, None, self.spec, self.frames, self.mode)

    def profile(self) -> DataFrame:
        return book_profile(self.plain_history(), self.entities, self.mode)

    def purchases(self) -> DataFrame:
        return book_purchases(self.plain_history(), self.log, self.spec, self.mode)

    def interaction(self) -> DataFrame:
        return book_interaction(self._history, self._instances, self.frames, self.mode)

    def offer(self) -> DataFrame:
        return book_offer(self.log, self.items, self.spec)

    def recency(self) -> DataFrame:
        return book_recency(self.history())

    def communication(self) -> DataFrame:
        return book_communication(self.plain_history(), self.mode)

    def pair(self) -> DataFrame:
        return book_pair(self._instances, self._conversions, self.frames, self.mode)

    def book_full(self) -> DataFrame:
        """All seven books on one row per pair.

        The books share two passes: one over the history, one over the
        received items. Joining seven separate books would repeat them. A
        feature name that two books use gets the second book's name in front.
        """
        return wide_books(
            self._history, self._instances, self._conversions, self.log, self.items, self.entities, self.spec, self.frames, self.mode
        )

    def modelling_base(self) -> DataFrame:
        """The labelled audience with every feature."""
        # Joined on the pair itself: two pairs can share a text key.
        label = self.labelled_audience().select(KEY, F.col(ENTITY).alias("__entity"), F.col(ITEM).alias("__item"), TARGET)
        books = self.book_full().drop(KEY)
        both = label.join(books, label["__entity"].eqNullSafe(books[ENTITY]) & label["__item"].eqNullSafe(books[ITEM]), "left")
        return both.drop("__entity", "__item")


def join_books(books: dict[str, DataFrame]) -> DataFrame:
    """Left join books onto the first one, on entity and item where they have these, else on their common key."""
    (_, out), *rest = books.items()
    taken = set(out.columns)
    for name, book in rest:
        features = [c for c in book.columns if c not in BOOK_KEYS]
        renamed = [F.col(c).alias(f"{name}__{c}" if c in taken else c) for c in features]
        if not {ENTITY, ITEM} <= set(book.columns) & set(out.columns):  # tables of a single key
            out = out.join(book.select(KEY, *renamed), KEY, "left")
            taken = set(out.columns)
            continue
        other = book.select(F.col(ENTITY).alias("__entity"), F.col(ITEM).alias("__item"), *renamed)
        out = out.join(other, out[ENTITY].eqNullSafe(other["__entity"]) & out[ITEM].eqNullSafe(other["__item"]), "left").drop("__entity", "__item")
        taken = set(out.columns)
    return out


# ---- dataset profiles and splits ----------------------------------------------------------

def dataset_profile(df: DataFrame, id_column: str, target: str, per: str = "rows") -> DataFrame:
    """Rows, columns, distinct ids, class counts and class rates in percent.

    ``per`` names the denominator of the rates: the labelled rows, or the
    distinct ids as the older variant of the profile has it.
    """
    if per not in ("rows", "ids"):
        raise ValueError("per must be 'rows' or 'ids'")
    row = df.agg(
        F.count(F.lit(1)).alias("linhas"), F.count_distinct(id_column).alias("ids_unicos"),
        F.count_if(F.col(target) == 0).alias("nao_convertidos"), F.count_if(F.col(target) == 1).alias("convertidos"),
    )
    whole = F.col("nao_convertidos") + F.col("convertidos") if per == "rows" else F.col("ids_unicos")
    return row.select(
        "linhas", F.lit(len(df.columns)).alias("colunas"), "ids_unicos", "nao_convertidos", "convertidos",
        F.bround(F.try_divide("convertidos", whole) * 100, 2).alias("taxa_percentual"),
        F.bround(F.try_divide("nao_convertidos", whole) * 100, 2).alias("taxa_nao_convertidos"),
    )


def period_volume(df: DataFrame, period: str) -> DataFrame:
    return df.groupBy(period).agg(F.count(F.lit(1)).alias("volume")).orderBy(period)


def split_by_period(df: DataFrame, cut: int, period: str = "safra") -> tuple[DataFrame, DataFrame]:
    """Training rows before the cut period and out-of-time rows from it on."""
    when = F.col(period).cast("int")
    return df.filter(when < cut), df.filter(when >= cut)


def split_volume(df: DataFrame, cut: int, period: str = "safra", names: tuple[str, str] = ("Treino", "Teste OOT")) -> DataFrame:
    """Rows per side of the split and period, in one aggregate."""
    side = F.when(F.col(period).cast("int") < cut, F.lit(names[0])).otherwise(F.lit(names[1]))
    return df.filter(F.col(period).isNotNull()).groupBy(side.alias("conjunto"), period).agg(F.count(F.lit(1)).alias("registros"))


HASH_STEP, HASH_LENGTH = 5, 30


def _mark(id_column: str, seed: int) -> Column:
    return F.md5(F.concat_ws("#", F.col(id_column).cast("string"), F.lit(str(seed))))


def hash_cuts(df: DataFrame, mark: Column, target: str, ranks: Callable[[int], list[int]]) -> dict[object, list[str]]:
    """For each class hash prefixes that cut its rows after the wanted ranks (``ranks`` of its number of rows), all found together.

    A cut is found by counting hash prefixes, five more digits at a time under
    those that hold a wanted rank. At most 1,048,576 counts exist for each of
    these in a step, and one row for each cut reaches the driver. An empty
    prefix cuts before the first row. Rows of one hash are never parted.
    """
    slim = df.filter(F.col(target).isNotNull()).select(F.col(target).alias("c"), mark.alias("h"))
    sizes = {r["c"]: r["count"] for r in slim.groupBy("c").count().collect()}
    cuts: dict[object, list[str]] = {c: [""] * len(ranks(n)) for c, n in sizes.items()}
    wanted = [(c, i, "", rank) for c, n in sizes.items() for i, rank in enumerate(ranks(n)) if rank > 0]
    schema = T.StructType([slim.schema["c"], *T._parse_datatype_string("i int, under string, rank long").fields])
    order = Window.partitionBy("c", "under").orderBy("p").rowsBetween(Window.unboundedPreceding, 0)
    for length in range(HASH_STEP, HASH_LENGTH + 1, HASH_STEP):
        if not wanted:
            break
        asked = F.broadcast(df.sparkSession.createDataFrame(wanted, schema))
        under = F.substring("h", 1, length - HASH_STEP)
        rows = slim.withColumn("under", under).join(F.broadcast(asked.select("c", "under").distinct()), ["c", "under"], "left_semi")
        counts = rows.groupBy("c", "under", F.substring("h", 1, length).alias("p")).agg(F.count(F.lit(1)).alias("n"))
        at = counts.withColumn("to", F.sum("n").over(order)).join(asked, ["c", "under"]).filter("to >= rank AND to - n < rank")
        wanted = []
        for r in at.collect():
            if r["rank"] == r["to"] or length == HASH_LENGTH:
                cuts[r["c"]][r["i"]] = r["p"]
            else:
                wanted.append((r["c"], r["i"], r["p"], r["rank"] - (r["to"] - r["n"])))
    return cuts


def _up_to(mark: Column, prefix: str) -> Column:
    return F.substring(mark, 1, len(prefix)) <= F.lit(prefix) if prefix else F.lit(False)


def stratified_split(df: DataFrame, id_column: str, target: str, test_share: float = 0.3, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Split at random with the same class shares, decided by a hash of the id.

    Each class sends its smallest ceil(share x n) hashes to the test side. The
    split itself is a filter: no row moves.
    """
    mark = _mark(id_column, seed)
    cuts = hash_cuts(df, mark, target, lambda n: [math.ceil(n * test_share)])
    if not cuts:
        return df, df.limit(0)
    chosen = reduce(lambda a, b: a | b, [(F.col(target) == F.lit(c)) & _up_to(mark, at[0]) for c, at in cuts.items()])
    is_test = F.coalesce(chosen, F.lit(False))
    return df.filter(~is_test), df.filter(is_test)


def stratified_folds(df: DataFrame, id_column: str, target: str, folds: int = 5, seed: int = 42, name: str = "fold") -> DataFrame:
    """Add a fold number, decided by a hash of the id; a class's numbers of rows in any two folds differ by at most one.

    No row moves. Rows of one id share a fold, so repeated ids may unbalance
    them. Rows without a class are dealt by the hash alone.
    """
    mark = _mark(id_column, seed)
    cuts = hash_cuts(df, mark, target, lambda n: [n * i // folds for i in range(1, folds)])
    number = F.pmod(F.xxhash64(F.col(id_column).cast("string"), F.lit(seed)), F.lit(folds)).cast("int")
    for c, prefixes in cuts.items():
        beyond = reduce(lambda a, b: a + b, [(~_up_to(mark, p)).cast("int") for p in prefixes], F.lit(0))
        number = F.when(F.col(target) == F.lit(c), beyond).otherwise(number)
    return df.withColumn(name, number)


def column_types(df: DataFrame) -> DataFrame:
    """Number of columns of each type."""
    return df.sparkSession.createDataFrame(sorted(Counter(t for _, t in df.dtypes).items()), "tipo string, colunas long")
