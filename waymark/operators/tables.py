"""Small general-purpose table operators: projections by rule, counts, profiles and set votes."""

from __future__ import annotations

from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark.functions.columns import nan_to_null
from waymark.session import pinned, written

#: Levels that may become columns.
MAX_LEVELS = 10_000
INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def columns_of(df: DataFrame, kind: str) -> list[str]:
    """Names of the numeric, integer, text or boolean columns."""
    tests = {
        "numeric": lambda t: isinstance(t, T.NumericType), "integer": lambda t: isinstance(t, INTEGERS),
        "text": lambda t: isinstance(t, T.StringType), "boolean": lambda t: isinstance(t, T.BooleanType),
    }
    return [f.name for f in df.schema if tests[kind](f.dataType)]


def without(columns: list[str], dropped: list[str]) -> list[str]:
    """Columns that survive a drop list, in their order."""
    gone = set(dropped)
    return [c for c in columns if c not in gone]


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the schema's columns in its order: extras dropped, missing ones null."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema
    ])


def merge_rare(df: DataFrame, column: str, min_freq: int, other: str = "OTHER") -> DataFrame:
    """Replace levels with fewer than ``min_freq`` rows; nulls stay null.

    Only the frequent levels are joined back, by broadcast while they are few,
    so that a level with many rows does not gather in one task.
    """
    levels = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("__level")).count()
    frequent, _ = pinned(levels.filter(F.col("count") >= min_freq))
    joined = df.join(frequent, F.col(column) == F.col("__level"), "left")
    level = F.when(F.col(column).isNull(), F.lit(None)).when(F.col("__level").isNull(), F.lit(other)).otherwise(F.col(column))
    return joined.withColumn(column, level).drop("__level", "count")


def table_profile(df: DataFrame, id_column: str) -> DataFrame:
    """Rows, columns and distinct ids in one pass."""
    return df.agg(F.count(F.lit(1)).alias("linhas"), F.count_distinct(id_column).alias("ids_distintos")).select(
        "linhas", F.lit(len(df.columns)).alias("colunas"), "ids_distintos"
    )


def count_by(df: DataFrame, *keys: str, name: str = "count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def top_counts(df: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The k most frequent key combinations; equal counts by key."""
    return count_by(df, *keys).orderBy(F.desc("count"), *keys).limit(k)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, null included, and their share of all rows."""
    rows = df.select(F.count(F.lit(1))).scalar()
    counts = count_by(df, column, name="n")
    return counts.withColumn("share", F.col("n") / rows)


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles: one row per column with any value. Two passes."""
    from waymark.operators.ordered import column_quantile_table, column_sketches, sketch_shares

    probs = [0.25, 0.5, 0.75]
    shares, measures = sketch_shares(probs), {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    found = column_sketches(df, columns, shares, measures)
    rows = [(c, found[c]["n"], *[found[c][m] for m in measures]) for c in columns if found[c]["n"]]
    basics = df.sparkSession.createDataFrame(rows, "variavel string, count long, mean double, std double, min double, max double")
    quart = column_quantile_table(df, columns, {c: probs for c in columns}, shares, found).groupBy("variavel").agg(*[
        F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(n) for p, n in [(0.25, "p25"), (0.5, "p50"), (0.75, "p75")]
    ])
    return basics.join(quart, "variavel").select("variavel", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def level_counts(df: DataFrame, columns: list[str], keys: list[str] | None = None) -> DataFrame:
    """Rows per (column, level, keys) as text, all columns in one pass; null is a level."""
    keys = keys or []
    long = df.select(*keys, *[F.col(c).cast("string").alias(c) for c in columns]).unpivot(keys, columns, "variavel", "nivel")
    return long.groupBy("variavel", "nivel", *keys).agg(F.count(F.lit(1)).alias("n"))


def describe_text(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, distinct levels, most frequent level and its count; equal counts by level."""
    best = F.min(F.struct(-F.col("n"), F.col("nivel")))
    return level_counts(df, columns).filter(F.col("nivel").isNotNull()).groupBy("variavel").agg(
        F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"), best.alias("b")
    ).select("variavel", "count", "unique", F.col("b.nivel").alias("top"), (-F.col("b.col1")).alias("freq"))


def by_target(df: DataFrame, columns: list[str], target: str) -> DataFrame:
    """Mean, median, deviation and extremes of each column per class, as <column>_<statistic>.

    Medians come from exact distributed ranks, everything else from one aggregate.
    """
    from waymark.operators.ordered import column_values, prob_list, quantiles

    floats = {c for c, kind in df.dtypes if kind in ("double", "float")}
    stats = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    basics = df.groupBy(target).agg(*[f(nan_to_null(F.col(c).cast("double")) if c in floats else F.col(c)).alias(f"{c}_{n}") for c in columns for n, f in stats.items()])
    rows = column_values(df, columns, [F.col(target)])
    medians = quantiles(rows, ["variavel", target], "value", prob_list([0.5])).groupBy(target).agg(*[
        F.max(F.when(F.col("variavel") == c, F.col("quantile"))).alias(f"{c}_median") for c in columns
    ])
    return basics.join(medians, target)


def contingency(df: DataFrame, row: str, column: str, levels: list) -> DataFrame:
    """Rows per level of ``row`` for each given level of ``column``."""
    return df.filter(F.col(row).isNotNull()).groupBy(row).agg(*[
        F.count_if(F.col(column) == v).alias(f"{column}_{v}") for v in levels
    ])


def crossed_rate(df: DataFrame, row: str, column: str, target: str, min_freq: int = 50) -> DataFrame:
    """Mean of the target per pair of levels, null where the pair is too rare.

    The pairs are aggregated and written before the pivot, which then only
    rearranges them. Each level of ``column`` becomes a column; more than 10,000
    are an error.
    """
    pairs = df.filter(F.col(row).isNotNull() & F.col(column).isNotNull()).groupBy(row, column).agg(
        F.avg(target).alias("mean"), F.count(target).alias("count")
    )
    pairs = written(pairs, "pairs")
    levels = [r[0] for r in pairs.select(column).distinct().orderBy(column).limit(MAX_LEVELS + 1).collect()]
    if len(levels) > MAX_LEVELS:
        raise ValueError(f"{column} has more than {MAX_LEVELS} levels")
    return pairs.groupBy(row).pivot(column, levels).agg(F.max(F.when(F.col("count") >= min_freq, F.col("mean"))))


def period_rates(df: DataFrame, period: str, target: str, names: tuple[str, str, str, str]) -> DataFrame:
    """Labelled rows, positives, negatives and rate per period."""
    n, pos, neg, rate = names
    seen = nan_to_null(F.col(target)) if dict(df.dtypes)[target] in ("double", "float") else F.col(target)
    counts = df.groupBy(F.col(period).cast("string").alias(period)).agg(F.count(seen).alias(n), F.sum(seen).alias(pos))
    return counts.withColumn(neg, F.col(n) - F.col(pos)).withColumn(rate, F.try_divide(pos, n))


def best_row(df: DataFrame, keys: list[str], score: str, tie: str) -> DataFrame:
    """The row with the highest score per key; equal scores go to the smallest ``tie``."""
    from waymark.operators.frames import most_recent

    return most_recent(df, keys, [F.desc(score), F.asc(tie)])


def null_share(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Null rows and their share per column, from one aggregate over all columns."""
    columns = columns or df.columns
    row = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count_if(is_missing(df, c)).alias(c) for c in columns])
    return row.unpivot(["__n"], columns, "variavel", "nulos").select(
        "variavel", F.col("__n").alias("linhas"), "nulos", F.try_divide("nulos", "__n").alias("share")
    )


def is_missing(df: DataFrame, column: str) -> Column:
    """Null, or NaN in a floating column."""
    missing = F.col(column).isNull()
    return missing | F.isnan(column) if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)) else missing


def modal_share(df: DataFrame, columns: list[str]) -> DataFrame:
    """Share of the most frequent value per column, null counted as a value."""
    return level_counts(df, columns).groupBy("variavel").agg((F.max("n") / F.sum("n")).alias("frac_modal"))


def dtype_histogram(df: DataFrame) -> dict[str, int]:
    """Number of columns of each type; needs no job."""
    return dict(Counter(t for _, t in df.dtypes))


def union_named(tables: dict[str, DataFrame], name: str = "nome_dataframe") -> DataFrame:
    """Tables below each other with a column that names them."""
    return reduce(DataFrame.unionByName, [df.withColumn(name, F.lit(n)) for n, df in tables.items()])


def vote(votes: DataFrame, rule: str, methods: int) -> DataFrame:
    """Combine selectors' choices (method, feature): intersection, union or at least two votes."""
    needed = {"intersection": methods, "union": 1, "voting": 2}
    if rule not in needed:
        raise ValueError(f"rule must be one of {sorted(needed)}")
    counts = votes.groupBy("feature").agg(F.count_distinct("method").alias("votes"))
    return counts.filter(F.col("votes") >= needed[rule])


def running_share(df: DataFrame, keys: list[str], order: str, measures: list[str]) -> DataFrame:
    """Running totals over the few ordered bands of each key."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({f"{m}_acumulado": F.sum(m).over(w) for m in measures})
