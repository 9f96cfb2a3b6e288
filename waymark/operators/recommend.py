"""Every offer for every row, the best one, and what it could recover."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.operators.frames import most_recent
from waymark.session import pinned
from waymark.spec import ANCHOR_TIME, ENTITY, ITEM, ITEM_COLUMNS, TARGET

SCORE = "score_modelo"
NUMBER_BUCKETS = 1024


def numbered(items: DataFrame) -> tuple[DataFrame, int]:
    """The catalogue with numbers 1..n in ``__n``, and n.

    Numbers count within hash buckets and add the sizes of earlier buckets, so
    a large catalogue is numbered without a single-task sort.
    """
    spread = items.withColumn("__b", F.pmod(F.xxhash64(ITEM), F.lit(NUMBER_BUCKETS)))
    sizes = spread.groupBy("__b").agg(F.count(F.lit(1)).alias("__size"))
    before = Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    # At most 1,024 buckets: their offsets fit one task.
    offsets = sizes.select("__b", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__from"))
    own = Window.partitionBy("__b").orderBy(ITEM)
    out = spread.withColumn("__n", F.row_number().over(own)).join(F.broadcast(offsets), "__b").withColumn("__n", F.col("__n") + F.col("__from"))
    return out.drop("__b", "__from"), items.count()


def expand_scenarios(base: DataFrame, items: DataFrame, item_columns: list[str] | None = None, add_id: bool = True) -> DataFrame:
    """Each row once per catalogue item, with only the item's columns replaced.

    Rows repeat in place and meet the numbered catalogue by an equality join:
    broadcast while the catalogue is small, shuffled by item beyond that.
    """
    item_columns = item_columns or [ITEM, *ITEM_COLUMNS]
    missing = [c for c in item_columns if c not in items.columns]
    if missing:
        raise ValueError(f"the catalogue lacks columns {missing}")
    catalogue, n = numbered(items.select(*item_columns, *[c for c in items.columns if c not in item_columns and c not in base.columns]))
    few, _ = pinned(catalogue)
    kept = base.drop(*item_columns).withColumn("__n", F.explode(F.sequence(F.lit(1), F.lit(n))))
    wide = kept.join(few, "__n")
    order = [c for c in base.columns if c in wide.columns] + [c for c in wide.columns if c not in base.columns and c != "__n"]
    out = wide.select(*order)
    return out.withColumn("ID_cenario", F.concat_ws("_", ENTITY, ITEM)) if add_id else out


def with_score(df: DataFrame, score: Column, name: str = SCORE) -> DataFrame:
    return df.withColumn(name, score)


def best_offer(scored: DataFrame, score: str = SCORE, time: str = ANCHOR_TIME) -> DataFrame:
    """The highest-scored item of each entity and time; equal scores go to the smallest item id.

    Candidates are limited in each task before the shuffle, so an expansion
    sends one row per task and (entity, time).
    """
    return most_recent(scored.select(ENTITY, ITEM, score, time), [ENTITY, time], [F.desc(score), F.asc(ITEM)])


def item_classes(items: DataFrame) -> DataFrame:
    """One row for each set of equal attributes in the catalogue, under the smallest item id that has them."""
    attributes = [c for c in items.columns if c != ITEM]
    return items.groupBy(*attributes).agg(F.min(ITEM).alias(ITEM)).select(*items.columns)


def best_item(
    base: DataFrame, items: DataFrame, score: Column, item_columns: list[str] | None = None, reads_id: bool = False, name: str = SCORE,
) -> DataFrame:
    """The best item of each row's entity and time, without the product of rows and items.

    A score that sees an item's attributes but not its id is the same for all
    items of equal attributes, and equal scores go to the smallest id; so the
    classes of the catalogue stand for it, and rows grow with the number of
    different attributes only. A score that ``reads_id`` gets the full product.
    """
    catalogue = items if reads_id else item_classes(items)
    return best_offer(with_score(expand_scenarios(base, catalogue, item_columns, add_id=False), score, name), name)


def offer_ranking(best: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """How often each item is the best one, with its catalogue columns; counted before the join."""
    counts = best.groupBy(ITEM).agg(F.count(F.lit(1)).alias("qtd"))
    return counts.join(items, ITEM, "left").orderBy(F.desc("qtd"), ITEM).limit(k)


def offer_switching(best: DataFrame, k: int = 5) -> DataFrame:
    """Entities with the most different best items."""
    return best.groupBy(ENTITY).agg(F.count_distinct(ITEM).alias("ofertas")).orderBy(F.desc("ofertas"), ENTITY).limit(k)


def entity_recommendations(best: DataFrame, entity_id: str) -> DataFrame:
    return best.filter(F.col(ENTITY) == entity_id)


def compare_offers(actual: DataFrame, best: DataFrame, score: str = SCORE, target: str = TARGET, time: str = ANCHOR_TIME) -> DataFrame:
    """Scored actual items beside the proposed ones of the same entity and time."""
    a = actual.select(ENTITY, time, F.col(ITEM).alias("offer_id_original"), F.col(score).alias("score_modelo_original"), F.col(target).alias("target_sucesso_real"))
    b = best.select(ENTITY, time, F.col(ITEM).alias("offer_id_proposta"), F.col(score).alias("score_modelo_proposta"))
    return a.join(b, [ENTITY, time], "left").select(
        "offer_id_original", "score_modelo_original", "offer_id_proposta", "score_modelo_proposta", "target_sucesso_real", time
    )


def missed_opportunities(comparison: DataFrame) -> DataFrame:
    """Rows that did not convert although another item was proposed; a missing proposal differs from any item."""
    other = ~F.col("offer_id_proposta").eqNullSafe(F.col("offer_id_original"))
    return comparison.filter((F.col("target_sucesso_real") == 0) & other)


def simulated_conversion(missed: DataFrame, cut: float = 0.44) -> DataFrame:
    """1 where the proposal's score reaches the cut."""
    return missed.withColumn("target_sucesso_modelo", F.when(F.col("score_modelo_proposta") >= cut, 1).otherwise(0))


def uplift_summary(comparison: DataFrame, cut: float = 0.44, precision: float = 0.78) -> DataFrame:
    """Unconverted rows, evaluated proposals, simulated and expected conversions and the recovery rate, in one pass."""
    failed = F.col("target_sucesso_real") == 0
    other = ~F.col("offer_id_proposta").eqNullSafe(F.col("offer_id_original"))
    row = comparison.agg(
        F.count_if(failed).alias("casos_sem_conversao"), F.count_if(failed & other).alias("casos_avaliados"),
        F.count_if(failed & other & (F.col("score_modelo_proposta") >= cut)).alias("convertidos_simulados"),
    )
    expected = F.bround(F.col("convertidos_simulados") * F.lit(precision), 0).cast("long")
    return row.withColumn("casos_convertidos", expected).withColumn(
        "taxa_repescagem", F.bround(F.try_divide(F.col("casos_convertidos") * 100.0, "casos_sem_conversao"), 1)
    )
