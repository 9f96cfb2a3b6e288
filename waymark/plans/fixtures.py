"""Campaign tables derived from the given tables, in Spark and as SQL for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def offers(spark: SparkSession) -> DataFrame:
    """Ten offers that cover every type, duration, discount and channel case."""
    j = F.col("id") % 5

    def pick(*values):
        return F.element_at(F.array(*[F.lit(v) for v in values]), (j + 1).cast("int"))

    return spark.range(10).select(
        F.concat(F.lit("o0"), F.col("id").cast("string")).alias("offer_id"),
        pick("bogo", "discount", "bogo", "discount", "informational").alias("offer_type"),
        pick(20, 10, 5, 2, 0).alias("discount_value"),
        pick(20, 10, 7, 5, 0).alias("min_value"),
        pick(4, 7, 5, 10, 3).alias("duration"),
        (F.col("id") % 2 == 0).cast("int").alias("web"),
        (F.col("id") % 2 == 1).cast("int").alias("email"),
        (F.col("id") % 3 > 0).cast("int").alias("mobile"),
        (F.col("id") % 4 < 2).cast("int").alias("social"),
    )


OFFERS_SQL = """fx_offers AS (
  SELECT 'o0' || CAST(i AS VARCHAR) AS offer_id,
    CASE i % 5 WHEN 0 THEN 'bogo' WHEN 1 THEN 'discount' WHEN 2 THEN 'bogo' WHEN 3 THEN 'discount' ELSE 'informational' END AS offer_type,
    CAST(CASE i % 5 WHEN 0 THEN 20 WHEN 1 THEN 10 WHEN 2 THEN 5 WHEN 3 THEN 2 ELSE 0 END AS INTEGER) AS discount_value,
    CAST(CASE i % 5 WHEN 0 THEN 20 WHEN 1 THEN 10 WHEN 2 THEN 7 WHEN 3 THEN 5 ELSE 0 END AS INTEGER) AS min_value,
    CAST(CASE i % 5 WHEN 0 THEN 4 WHEN 1 THEN 7 WHEN 2 THEN 5 WHEN 3 THEN 10 ELSE 3 END AS INTEGER) AS duration,
    CAST(i % 2 = 0 AS INTEGER) AS web, CAST(i % 2 = 1 AS INTEGER) AS email,
    CAST(i % 3 > 0 AS INTEGER) AS mobile, CAST(i % 4 < 2 AS INTEGER) AS social
  FROM range(10) r(i))"""


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        k.cast("string").alias("profile_id"),
        F.when(k % 8 == 0, 118).otherwise((18 + k % 70).cast("int")).cast("int").alias("age"),
        F.when(k % 4 == 1, "F").when(k % 4 == 2, "M").when(k % 4 == 3, "O").alias("gender"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("credit_card_limit"),
        (20130101 + (k % 6) * 10000).cast("int").alias("registered_on"),
    )


PROFILE_SQL = """fx_profile AS (
  SELECT CAST(c_custkey AS VARCHAR) AS profile_id,
    CAST(CASE WHEN c_custkey % 8 = 0 THEN 118 ELSE 18 + c_custkey % 70 END AS INTEGER) AS age,
    CASE c_custkey % 4 WHEN 1 THEN 'F' WHEN 2 THEN 'M' WHEN 3 THEN 'O' END AS gender,
    CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS credit_card_limit,
    CAST(20130101 + (c_custkey % 6) * 10000 AS INTEGER) AS registered_on
  FROM customer)"""


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Campaign events with quarter-day times. Errors are events that the spec does not know."""
    kind = F.col("event_type")
    name = (
        F.when(kind == "signup", "offer received").when(kind == "view", "offer viewed")
        .when(kind == "purchase", "transaction").when(kind == "click", "offer completed").when(kind == "error", "client error")
    )
    k = F.get_json_object("props", "$.k").cast("int")
    seconds = F.timestamp_diff("SECOND", F.lit("2024-01-01").cast("timestamp_ntz"), F.col("ts"))
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("profile_id"),
        name.alias("event"),
        F.when(kind.isin("signup", "view"), F.concat(F.lit("o0"), (k % 10).cast("string"))).alias("offer_id"),
        (F.floor(seconds / 21600) * 0.25).cast("double").alias("time_since_test_start"),
    )


TRANSACTIONS_SQL = """fx_transactions AS (
  SELECT CAST(user_id AS VARCHAR) AS profile_id,
    CASE event_type WHEN 'signup' THEN 'offer received' WHEN 'view' THEN 'offer viewed'
      WHEN 'purchase' THEN 'transaction' WHEN 'click' THEN 'offer completed' WHEN 'error' THEN 'client error' END AS event,
    CASE WHEN event_type IN ('signup', 'view')
      THEN 'o0' || CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 10 AS VARCHAR) END AS offer_id,
    CAST(floor(date_diff('second', TIMESTAMP '2024-01-01', ts) / 21600) * 0.25 AS DOUBLE) AS time_since_test_start
  FROM events)"""


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scored table: two labels, two complementary scores, a period and a dataset name."""
    order, line, part, qty = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_quantity")
    score = (qty * 20 + (order * 31 + line) % 20) / 1020.0
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", order, line, part, "l_suppkey").alias("id"),
        F.year("l_shipdate").alias("safra"),
        (qty + (order * 13 + line * 7 + part) % 50 > 60).cast("int").alias("y"),
        score.alias("score_1"),
        (1 - score).alias("score_0"),
        (qty / 50).alias("score_tied"),
        F.when(order % 10 < 7, "Treino").otherwise("Teste").alias("dataset"),
    )


SCORED_SQL = """fx_scored AS (
  SELECT concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR)) AS id,
    CAST(year(l_shipdate) AS INTEGER) AS safra,
    CAST(l_quantity + (l_orderkey * 13 + l_linenumber * 7 + l_partkey) % 50 > 60 AS INTEGER) AS y,
    (l_quantity * 20 + (l_orderkey * 31 + l_linenumber) % 20) / 1020.0::DOUBLE AS score_1,
    1 - (l_quantity * 20 + (l_orderkey * 31 + l_linenumber) % 20) / 1020.0::DOUBLE AS score_0,
    l_quantity / 50 AS score_tied,
    CASE WHEN l_orderkey % 10 < 7 THEN 'Treino' ELSE 'Teste' END AS dataset
  FROM lineitem)"""


LOG_SQL = """ev AS (
  SELECT DISTINCT profile_id AS cliente_id, offer_id, lower(event) AS event, time_since_test_start AS t
  FROM fx_transactions)"""


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as a modelling table: numbers, texts, a 0/1 flag, nulls, a period and a label."""
    key, part, supp, line = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", key, line, part, supp).alias("id"),
        F.col("l_quantity").alias("qty"),
        F.col("l_extendedprice").alias("price"),
        F.when(part % 7 > 0, F.col("l_tax")).alias("tax"),
        F.when(part % 40 > 0, F.col("l_discount")).alias("disc"),
        line.alias("line"),
        (supp % 2).cast("int").alias("even"),
        F.when(supp % 11 > 0, F.col("l_returnflag")).alias("flag"),
        F.col("l_linestatus").alias("status"),
        F.concat(F.lit("s"), (supp % 97 * (supp % 3)).cast("string")).alias("store"),
        F.year("l_shipdate").alias("safra"),
        (F.col("l_quantity") + (key * 13 + line * 7 + part) % 50 > 60).cast("int").alias("y"),
    )


MIXED_SQL = """m AS (
  SELECT concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR)) AS id,
    l_quantity AS qty, l_extendedprice AS price, CASE WHEN l_partkey % 7 > 0 THEN l_tax END AS tax,
    CASE WHEN l_partkey % 40 > 0 THEN l_discount END AS disc, l_linenumber AS line, CAST(l_suppkey % 2 AS INTEGER) AS even,
    CASE WHEN l_suppkey % 11 > 0 THEN l_returnflag END AS flag, l_linestatus AS status,
    's' || CAST(l_suppkey % 97 * (l_suppkey % 3) AS VARCHAR) AS store, CAST(year(l_shipdate) AS INTEGER) AS safra,
    CAST(l_quantity + (l_orderkey * 13 + l_linenumber * 7 + l_partkey) % 50 > 60 AS INTEGER) AS y
  FROM lineitem)"""


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An offer catalogue that grows with the part table, with channels as an array."""
    k = F.col("p_partkey")
    every = F.array(F.lit("web"), F.lit("email"), F.lit("mobile"), F.lit("social"))
    kept = F.filter(every, lambda c, i: (k + i) % 3 > 0)
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("p"), k.cast("string")).alias("id"),
        F.when(k % 3 == 0, "bogo").when(k % 3 == 1, "discount").otherwise("informational").alias("offer_type"),
        (F.col("p_size") % 11).cast("int").alias("discount_value"), (F.col("p_size") % 21).cast("int").alias("min_value"),
        (3 + k % 8).cast("double").alias("duration"), kept.alias("channels"),
    )


CATALOGUE_SQL = """cat AS (
  SELECT 'p' || CAST(p_partkey AS VARCHAR) AS id, CASE p_partkey % 3 WHEN 0 THEN 'bogo' WHEN 1 THEN 'discount' ELSE 'informational' END AS offer_type,
    CAST(p_size % 11 AS INTEGER) AS discount_value, CAST(p_size % 21 AS INTEGER) AS min_value, CAST(3 + p_partkey % 8 AS DOUBLE) AS duration,
    CAST(p_partkey % 3 > 0 AS INTEGER) AS web, CAST((p_partkey + 1) % 3 > 0 AS INTEGER) AS email,
    CAST((p_partkey + 2) % 3 > 0 AS INTEGER) AS mobile, CAST((p_partkey + 3) % 3 > 0 AS INTEGER) AS social
  FROM part)"""
