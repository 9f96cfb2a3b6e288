"""Event log operators: enrichment, audience, per-event views, funnel and profiles of the log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.functions.columns import pair_key, year_of
from waymark.session import SALTS, looked_up, pinned
from waymark.spec import DEFAULT, ENTITY, ENTITY_COLUMNS, EVENT, ITEM, ITEM_COLUMNS, KEY, TIME, EventSpec


def catalogue(items: DataFrame) -> DataFrame:
    """The item table, fixed and marked for broadcast if a check finds it small enough."""
    return pinned(items)[0]


def with_items(df: DataFrame, items: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Left join the item catalogue; ``catalogue`` prepares it for a broadcast.

    Most events name no item. Should the catalogue be too large to broadcast,
    a salt keeps their rows from meeting in one task.
    """
    columns = ITEM_COLUMNS if columns is None else columns
    spread = F.when(F.col(ITEM).isNull(), F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)).cast("int")).otherwise(0)
    side = items.select(ITEM, *columns, F.lit(0).alias("__salt"))
    return df.withColumn("__salt", spread).join(side, [ITEM, "__salt"], "left").drop("__salt")


def with_entities(df: DataFrame, entities: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Left join the entity table on its key; an entity may hold any share of the rows."""
    columns = ENTITY_COLUMNS if columns is None else columns
    return looked_up(df, entities.select(F.col("profile_id").alias(ENTITY), *columns), ENTITY)


def enrich(log: DataFrame, items: DataFrame, entities: DataFrame) -> DataFrame:
    """Every event with its item's and entity's columns and the pair key."""
    wide = with_entities(looked_up(log, items.select(ITEM, *ITEM_COLUMNS), ITEM), entities)
    return wide.withColumn(KEY, pair_key())


def received(log: DataFrame, spec: EventSpec = DEFAULT) -> DataFrame:
    return log.filter((F.col(EVENT) == spec.received) & F.col(ITEM).isNotNull())


def audience(raw: DataFrame, spec: EventSpec = DEFAULT) -> DataFrame:
    """Distinct (ID, entity, item) that received an item; reads no other event."""
    return (
        raw.filter((F.lower(spec.event) == spec.received) & F.col(spec.item).isNotNull())
        .select(F.col(spec.entity).cast("string").alias(ENTITY), F.col(spec.item).cast("string").alias(ITEM))
        .dropDuplicates()
        .select(pair_key().alias(KEY), ENTITY, ITEM)
    )


def received_windows(log: DataFrame, items: DataFrame, spec: EventSpec = DEFAULT, columns: list[str] | None = None) -> DataFrame:
    """One row per received item with the time span in which it can be redeemed."""
    columns = ["duration"] if columns is None else columns
    wide = with_items(received(log, spec).select(ENTITY, ITEM, F.col(TIME).alias("start_t")), items, columns)
    return wide.withColumn("end_t", F.col("start_t") + F.col("duration").cast("double"))


def views(log: DataFrame, spec: EventSpec = DEFAULT) -> DataFrame:
    return log.filter(F.col(EVENT) == spec.viewed).select(ENTITY, ITEM, F.col(TIME).alias("t_view"))


def purchases(log: DataFrame, spec: EventSpec = DEFAULT) -> DataFrame:
    return log.filter(F.col(EVENT) == spec.purchase).select(ENTITY, F.col(TIME).alias("t_tx"))


def completions(log: DataFrame, spec: EventSpec = DEFAULT) -> DataFrame:
    return log.filter(F.col(EVENT) == spec.completed).select(ENTITY, F.col(TIME).alias("t_cmplt"))


def split_events(log: DataFrame, spec: EventSpec = DEFAULT) -> dict[str, DataFrame]:
    """Purchases, completions and views as separate narrow tables."""
    return {"purchases": purchases(log, spec), "completions": completions(log, spec), "views": views(log, spec)}


def conversion_pairs(log: DataFrame, spec: EventSpec = DEFAULT) -> DataFrame:
    """Instants at which an entity both purchased and completed.

    One aggregate with map-side counts instead of a join of the two event
    kinds; the log holds each of them once per instant.
    """
    return (
        log.filter(F.col(EVENT).isin(spec.completed, spec.purchase))
        .groupBy(ENTITY, TIME)
        .agg(
            F.count_if(F.col(EVENT) == spec.completed).alias("n_completed"),
            F.count_if(F.col(EVENT) == spec.purchase).alias("n_purchase"),
        )
        .filter("n_completed > 0 AND n_purchase > 0")
        .select(ENTITY, TIME)
    )


def funnel(log: DataFrame, items: DataFrame) -> DataFrame:
    """Events by name and item type, with each name's share of all events."""
    typed = with_items(log.groupBy(EVENT, ITEM).agg(F.count(F.lit(1)).alias("n")), items, ["offer_type"])
    return typed.groupBy(EVENT, "offer_type").agg(F.sum("n").alias("total"))


def funnel_rates(log: DataFrame, spec: EventSpec = DEFAULT) -> DataFrame:
    """Viewed and completed events per received item, and completed per purchase."""
    counts = log.agg(
        F.count_if(F.col(EVENT) == spec.received).alias("received"),
        F.count_if(F.col(EVENT) == spec.viewed).alias("viewed"),
        F.count_if(F.col(EVENT) == spec.completed).alias("completed"),
        F.count_if(F.col(EVENT) == spec.purchase).alias("purchases"),
    )
    return counts.select(
        "*",
        F.try_divide("viewed", "received").alias("viewed_rate"),
        F.try_divide("completed", "received").alias("completed_rate"),
        F.try_divide("completed", "purchases").alias("purchase_rate"),
    )


def entity_journey(log: DataFrame, entity_id: str) -> DataFrame:
    """All events of one entity in time order."""
    return log.filter(F.col(ENTITY) == entity_id).orderBy(TIME, EVENT, ITEM)


def registration_cohorts(entities: DataFrame) -> DataFrame:
    """Entities per year of registration."""
    return entities.groupBy(year_of(F.col("registered_on")).alias("safra")).count().orderBy("safra")


def age_distribution(entities: DataFrame) -> DataFrame:
    return entities.groupBy("age").count().orderBy("age")
