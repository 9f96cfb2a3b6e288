"""Names and schemas shared by every operator."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column names of the tables the operators exchange.
ENTITY, ITEM, EVENT, TIME = "cliente_id", "offer_id", "event", "t"
KEY, ANCHOR_TIME = "ID", "time_since_test_start"
TARGET, MATCHES = "target_sucesso", "qtd_matches"
CHANNELS = ["web", "email", "mobile", "social"]
ITEM_COLUMNS = ["offer_type", "discount_value", "min_value", "duration", *CHANNELS]
ENTITY_COLUMNS = ["registered_on", "age", "gender", "credit_card_limit"]
BOOK_KEYS = [KEY, ENTITY, ITEM, ANCHOR_TIME]

OFFERS_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("offer_type", T.StringType()),
    T.StructField("discount_value", T.IntegerType()),
    T.StructField("min_value", T.IntegerType()),
    T.StructField("duration", T.DoubleType()),
    T.StructField("channels", T.ArrayType(T.StringType())),
])

PROFILE_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("registered_on", T.IntegerType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("gender", T.StringType()),
    T.StructField("credit_card_limit", T.DoubleType()),
])

EVENTS_SCHEMA = T.StructType([
    T.StructField("account_id", T.StringType()),
    T.StructField("event", T.StringType()),
    T.StructField("time_since_test_start", T.DoubleType()),
    T.StructField("value", T.MapType(T.StringType(), T.StringType())),
])


@dataclass(frozen=True)
class EventSpec:
    """Where a raw event table keeps its entity, item, event name and time, and what events are called."""

    entity: str = "profile_id"
    item: str = "offer_id"
    event: str = "event"
    time: str = "time_since_test_start"
    received: str = "offer received"
    viewed: str = "offer viewed"
    completed: str = "offer completed"
    purchase: str = "transaction"

    def __post_init__(self) -> None:
        # The log holds event names in lower case, so a spec may spell them as it likes.
        for name in ("received", "viewed", "completed", "purchase"):
            object.__setattr__(self, name, getattr(self, name).lower())

    def log(self, raw: DataFrame) -> DataFrame:
        """The narrow event log: one row per distinct (entity, item, event, time).

        Only these four columns are read. Removing copies here, before any
        enrichment, keeps dimension columns out of the shuffle, and the partial
        aggregate drops copies of a row before they leave their task.
        """
        return raw.select(
            F.col(self.entity).cast("string").alias(ENTITY),
            F.col(self.item).cast("string").alias(ITEM),
            F.lower(self.event).alias(EVENT),
            F.col(self.time).cast("double").alias(TIME),
        ).dropDuplicates()


DEFAULT = EventSpec()
