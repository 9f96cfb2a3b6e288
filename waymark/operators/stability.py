"""Population stability, two-sample distance and bin stability over periods."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.operators.ordered import bin_of, column_quantiles, distinct_edges, equal_bin_of, equal_edges, running
# Fixed value: share given to an empty bin.
EMPTY_SHARE = 0.0001


def reference_edges(reference: DataFrame, columns: list[str], bins: int = 10) -> dict[str, list[float]]:
    """Equal-width edges between each column's smallest and largest reference value, in one pass."""
    ends = reference.agg(*[
        f(F.nanvl(F.col(c).cast("double"), F.lit(None))).alias(f"{c}:{f.__name__}") for c in columns for f in (F.min, F.max)
    ]).first()
    return {
        c: equal_edges(ends[f"{c}:min"], ends[f"{c}:max"], bins) for c in columns if ends[f"{c}:min"] is not None
    }


def binned_counts(df: DataFrame, edges: dict[str, list[float]], keys: list[str] | None = None) -> DataFrame:
    """Rows per (keys, variable, bin); values outside the edges are left out.

    Bins are computed column by column in the row, so that only bin numbers
    are stacked and counted before the shuffle.
    """
    keys = keys or []
    numbers = df.select(*keys, *[
        equal_bin_of(F.nanvl(F.col(c).cast("double"), F.lit(None)), e).alias(c) for c, e in edges.items()
    ])
    long = numbers.unpivot(keys, list(edges), "variavel", "bin").filter(F.col("bin").isNotNull())
    return long.groupBy(*keys, "variavel", "bin").agg(F.count(F.lit(1)).alias("n"))


def edge_table(df: DataFrame, edges: dict[str, list[float]]) -> DataFrame:
    """One row per (variable, bin) with its ends: the frame that gives empty bins their row."""
    rows = [(c, i + 1, e[i], e[i + 1]) for c, e in edges.items() for i in range(len(e) - 1)]
    return F.broadcast(df.sparkSession.createDataFrame(rows, "variavel string, bin int, de double, ate double"))


def _share(n: str, over: list[str]) -> Column:
    share = F.try_divide(F.coalesce(n, F.lit(0)), F.sum(F.coalesce(n, F.lit(0))).over(Window.partitionBy(*over)))
    return F.when(share == 0, F.lit(EMPTY_SHARE)).otherwise(share)


def psi_table(reference: DataFrame, current: DataFrame, columns: list[str], bins: int = 10) -> DataFrame:
    """Share of each bin in both tables and its PSI term."""
    edges = reference_edges(reference, columns, bins)
    both = binned_counts(reference.select(*columns, F.lit("ref").alias("__side")).unionByName(
        current.select(*columns, F.lit("cur").alias("__side"))), edges, ["__side"])
    sides = both.groupBy("variavel", "bin").agg(
        F.sum(F.when(F.col("__side") == "ref", F.col("n")).otherwise(0)).alias("ref"),
        F.sum(F.when(F.col("__side") == "cur", F.col("n")).otherwise(0)).alias("cur"),
    )
    # From here on: columns x bins rows.
    full = edge_table(reference, edges).join(sides, ["variavel", "bin"], "left")
    r, c = F.col("Ref_Proporção"), F.col("Atual_Proporção")
    return full.withColumns(
        {"Ref_Proporção": _share("ref", ["variavel"]), "Atual_Proporção": _share("cur", ["variavel"])}
    ).select(
        "variavel", F.col("bin").alias("ordem"),
        F.concat_ws(" - ", F.bround("de", 2).cast("string"), F.bround("ate", 2).cast("string")).alias("faixa"),
        r, c, ((r - c) * F.ln(r / c)).alias("PSI_Bin"),
    )


def psi(reference: DataFrame, current: DataFrame, columns: list[str], bins: int = 10) -> DataFrame:
    """Total PSI per variable."""
    return psi_table(reference, current, columns, bins).groupBy("variavel").agg(F.sum("PSI_Bin").alias("psi"))


def psi_by_period(train: DataFrame, test: DataFrame, column: str, period: str = "safra", bins: int = 10, first: str = "Safras Treino") -> DataFrame:
    """PSI of each test period against all of train, after a row 0 for train itself."""
    edges = reference_edges(train, [column], bins)
    ref = edge_table(train, edges).join(binned_counts(train, edges), ["variavel", "bin"], "left").select(
        "bin", _share("n", ["variavel"]).alias("r")
    )
    counts = binned_counts(test, edges, [period])
    # Periods x bins rows: an empty bin of a period needs its row too.
    grid = counts.select(period).distinct().withColumn("bin", F.explode(F.sequence(F.lit(1), F.lit(bins))))
    shares = grid.join(counts, [period, "bin"], "left").withColumn("c", _share("n", [period])).join(F.broadcast(ref), "bin")
    each = shares.groupBy(F.col(period).cast("string").alias(period)).agg(
        F.sum((F.col("r") - F.col("c")) * F.ln(F.col("r") / F.col("c"))).alias("PSI")
    )
    start = train.sparkSession.createDataFrame([(first, 0.0)], each.schema)
    return start.unionByName(each)


def ks_two_samples(reference: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    """Largest distance of the two empirical distributions per variable, with its asymptotic p-value."""
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(*[F.col(c).cast("double").alias(c) for c in columns], F.lit(name).alias("__side"))

    long = side(reference, "a").unionByName(side(current, "b")).unpivot(["__side"], columns, "variavel", "value")
    counts = long.filter(F.col("value").isNotNull() & ~F.isnan("value")).groupBy("variavel", "value").agg(
        F.count_if(F.col("__side") == "a").alias("a"), F.count_if(F.col("__side") == "b").alias("b")
    )
    curve = running(counts, ["variavel"], "value", ["a", "b"])
    stat = curve.groupBy("variavel").agg(
        F.max(F.abs(F.try_divide("a_to", "a_sum") - F.try_divide("b_to", "b_sum"))).alias("ks_stat"),
        F.max("a_sum").alias("n_a"), F.max("b_sum").alias("n_b"),
    )
    return stat.withColumn("p_value", ks_p_value(F.col("ks_stat"), F.col("n_a"), F.col("n_b")))


def ks_p_value(distance: Column, n_a: Column, n_b: Column) -> Column:
    """Kolmogorov's limiting series; a distance of 0 has p-value 1."""
    x2 = distance * distance * (n_a * n_b / (n_a + n_b))
    terms = F.transform(F.sequence(F.lit(1), F.lit(100)), lambda k: F.pow(F.lit(-1.0), k - 1) * F.exp(-2.0 * k * k * x2))
    series = 2 * F.aggregate(terms, F.lit(0.0), lambda acc, v: acc + v)
    # The alternating series converges only away from 0, where the p-value is 1 to all digits.
    return F.when(x2 < 0.04, F.lit(1.0)).otherwise(F.least(F.greatest(series, F.lit(0.0)), F.lit(1.0)))


# Severity texts and the PSI limit between them.
MODERATE, SIGNIFICANT, SEVERE_PSI = "Mudança Moderada", "Mudança Significativa", 0.25


def monitor(reference: DataFrame, current: DataFrame, columns: list[str], psi_limit: float = 0.1, p_limit: float = 0.05) -> tuple[DataFrame, DataFrame]:
    """Variables whose PSI reaches the limit, and variables whose two-sample p-value falls below it."""
    moderate = (F.col("psi") >= 0.1) & (F.col("psi") < SEVERE_PSI)
    shifted = psi(reference, current, columns).filter(F.col("psi") >= psi_limit).withColumn(
        "alerta", F.when(moderate, F.lit(MODERATE)).otherwise(F.lit(SIGNIFICANT))
    )
    apart = ks_two_samples(reference, current, columns).filter(F.col("p_value") < p_limit).select(
        "variavel", "ks_stat", "p_value", F.lit(SIGNIFICANT).alias("alerta")
    )
    return shifted, apart


def bin_shares(df: DataFrame, columns: list[str], period: str, n_bins: int = 10) -> tuple[DataFrame, dict[str, list[float]]]:
    """Share of each quantile bin of each variable per period, and the bins' edges."""
    probs = [i / n_bins for i in range(n_bins + 1)]
    edges = {c: distinct_edges(v) for c, v in column_quantiles(df, columns, probs).items()}
    edges = {c: e for c, e in edges.items() if len(e) > 1}
    numbers = df.select(F.col(period).cast("string").alias(period), *[
        bin_of(F.nanvl(F.col(c).cast("double"), F.lit(None)), e).alias(c) for c, e in edges.items()
    ])
    counts = numbers.unpivot([period], list(edges), "variavel", "bin").filter(F.col("bin").isNotNull()).groupBy(
        "variavel", period, "bin").agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("variavel", period)
    return counts.select("variavel", period, "bin", (F.col("n") / F.sum("n").over(whole)).alias("share")), edges


def bin_groups(shares: DataFrame, period: str, n_clusters: int = 4, seed: int = 42) -> DataFrame:
    """Bins of each variable that move alike over the periods, named Bin_1, Bin_2, ...

    All variables are clustered in one job: a group is one variable's bins,
    a few rows with a share for each period.
    """
    def clustered(rows: pd.DataFrame) -> pd.DataFrame:
        wide = rows.pivot_table(index="bin", columns=period, values="share", fill_value=0.0).sort_index()
        return pd.DataFrame({"variavel": rows["variavel"].iloc[0], "bin": wide.index, "grupo": [f"Bin_{g + 1}" for g in nearest_groups(wide.to_numpy(), n_clusters, seed)]})

    return shares.groupBy("variavel").applyInPandas(clustered, "variavel string, bin int, grupo string")


def nearest_groups(points: np.ndarray, k: int, seed: int, rounds: int = 100) -> list[int]:
    """K-means of a few points: the group of each, numbered by their first points. Starts are far apart; ``seed`` picks the first."""
    start = np.random.default_rng(seed).integers(len(points))
    centres = [points[start]]
    while len(centres) < k:
        far = np.min([((points - c) ** 2).sum(axis=1) for c in centres], axis=0)
        if far.max() == 0:
            break  # fewer different points than groups
        centres.append(points[far.argmax()])
    centre, group = np.array(centres), None
    for _ in range(rounds):
        found = ((points[:, None] - centre[None]) ** 2).sum(axis=2).argmin(axis=1)
        if group is not None and (found == group).all():
            break
        group = found
        centre = np.array([points[group == g].mean(axis=0) if (group == g).any() else c for g, c in enumerate(centre)])
    order = list(dict.fromkeys(group.tolist()))
    return [order.index(g) for g in group.tolist()]
