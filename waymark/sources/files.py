"""Readers and writers of the campaign tables and fitted artefacts."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark.spec import CHANNELS, EVENTS_SCHEMA, OFFERS_SCHEMA, PROFILE_SCHEMA


def channel_flags(offers: DataFrame) -> DataFrame:
    """Turn the channel array into one 0/1 column per channel."""
    return offers.withColumns({c: F.array_contains("channels", c).cast("int") for c in CHANNELS})


def read_offers_json(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Offer catalogue with channel flags and ``offer_id``.

    ``multi_line`` reads one JSON array per file; line-delimited files, which
    Spark can split, are the default.
    """
    raw = spark.read.schema(OFFERS_SCHEMA).option("multiLine", multi_line).json(path)
    return channel_flags(raw).withColumnRenamed("id", "offer_id").select(
        "offer_id", "offer_type", "discount_value", "min_value", "duration", *CHANNELS
    )


def read_profile_json(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    raw = spark.read.schema(PROFILE_SCHEMA).option("multiLine", multi_line).json(path)
    return raw.select(F.col("id").alias("profile_id"), "registered_on", "age", "gender", "credit_card_limit")


def read_transactions_json(
    spark: SparkSession, path: str, multi_line: bool = False, item_keys: tuple[str, ...] = ("offer id",), extras: tuple[str, ...] = (),
) -> DataFrame:
    """Event log; the item id is the first of ``item_keys`` found in ``value``, ``extras`` keep further keys."""
    raw = spark.read.schema(EVENTS_SCHEMA).option("multiLine", multi_line).json(path)
    item = F.coalesce(*[F.col("value").getItem(k) for k in item_keys])
    return raw.select(
        F.col("account_id").alias("profile_id"), item.alias("offer_id"), "event", "time_since_test_start",
        *[F.col("value").getItem(k).alias(k.replace(" ", "_")) for k in extras],
    )


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def read_columns(spark: SparkSession, path: str, fmt: str = "parquet") -> list[str]:
    """Column names of a stored table; reads metadata or a header line only."""
    return spark.read.format(fmt).option("header", True).load(path).columns


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV files with a header, written by the executors; one file only for small results."""
    (df.coalesce(1) if single_file else df).write.mode("overwrite").option("header", True).csv(path)


def write_table(df: DataFrame, path: str) -> None:
    """Parquet, the form in which stages should pass tables on."""
    df.write.mode("overwrite").parquet(path)


def save_json(spark: SparkSession, value: dict, path: str) -> None:
    """Store a small fitted artefact wherever Spark can write."""
    text = json.dumps(value, ensure_ascii=False)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load_json(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()[0])


def save_schema(df: DataFrame, path: str) -> None:
    """Store the column names and types of a table."""
    save_json(df.sparkSession, json.loads(df.schema.json()), path)


def load_schema(spark: SparkSession, path: str) -> T.StructType:
    return T.StructType.fromJson(load_json(spark, path))


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in floating columns becomes null."""
    floating = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floating})


def from_pandas(spark: SparkSession, pdf: pd.DataFrame, schema: T.StructType | str | None = None) -> DataFrame:
    """Small local frame to Spark, for tests and notebooks."""
    return nan_to_null(spark.createDataFrame(pdf, schema))


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)


