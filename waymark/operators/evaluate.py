"""Evaluation of scored tables: curves, threshold metrics, bands and lift.

Everything is computed from one reduction: rows and positives per (keys,
score). Scores with equal values always count together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.functions.columns import unit_clip
from waymark.operators.ordered import ALL, banded, keyed, running


def require_columns(df: DataFrame, columns: list[str], name: str = "scored table") -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{name} lacks columns {missing}")


def score_counts(
    df: DataFrame, score: str, target: str, keys: list[str] | None = None, clip: bool = False, other: str | None = None,
) -> DataFrame:
    """Rows, positives and negatives per distinct score; rows without score or label are left out."""
    keys = keys or []
    require_columns(df, [score, target, *keys, *([other] if other else [])])
    value = F.expr(f"try_cast(`{score}` AS double)")
    value = unit_clip(value) if clip else value
    extra = [F.min(other).alias("other_min"), F.max(other).alias("other_max")] if other else []
    slim = df.select(*keys, F.nanvl(value, F.lit(None)).alias("score"), F.col(target).cast("int").alias("y"), *([other] if other else []))
    return slim.filter(F.col("score").isNotNull() & F.col("y").isNotNull()).groupBy(*keys, "score").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") == 0).alias("neg"), *extra
    )


def _curve(df: DataFrame, score: str, target: str, keys: list[str] | None, clip: bool = True) -> tuple[DataFrame, list[str]]:
    counts, keys = keyed(score_counts(df, score, target, keys, clip), keys or [])
    return running(counts, keys, "score", ["pos", "neg"]), keys


def _drop_all(df: DataFrame) -> DataFrame:
    return df.drop(ALL)


def _at_or_above(m: str) -> Column:
    return F.col(f"{m}_sum") - F.col(f"{m}_to") + F.col(m)


def roc_curve(df: DataFrame, score: str, target: str, keys: list[str] | None = None) -> DataFrame:
    """False and true positive rate of every threshold."""
    curve, _ = _curve(df, score, target, keys)
    return _drop_all(curve).select(
        *(keys or []), F.col("score").alias("threshold"),
        F.try_divide(_at_or_above("neg"), "neg_sum").alias("fpr"), F.try_divide(_at_or_above("pos"), "pos_sum").alias("tpr"),
    )


def _auc() -> Column:
    """Share of (positive, negative) pairs ranked right, ties as one half."""
    below = F.col("neg_to") - F.col("neg") * 0.5
    return F.try_divide(F.sum(F.col("pos") * below), F.max("pos_sum").cast("double") * F.max("neg_sum"))


def roc_auc(df: DataFrame, score: str, target: str, keys: list[str] | None = None) -> DataFrame:
    """Exact area under the ROC curve and Gini."""
    curve, used = _curve(df, score, target, keys)
    return _drop_all(curve.groupBy(*used).agg(_auc().alias("auc")).withColumn("gini", 2 * F.col("auc") - 1))


def gini_and_ks(df: DataFrame, score: str, target: str, keys: list[str] | None = None) -> DataFrame:
    """Gini and largest distance of the classes, from one curve."""
    curve, used = _curve(df, score, target, keys)
    ks = F.abs(F.col("pos_to") / F.greatest("pos_sum", F.lit(1)) - F.col("neg_to") / F.greatest("neg_sum", F.lit(1)))
    return _drop_all(curve.groupBy(*used).agg(_auc().alias("auc"), F.max(ks).alias("ks")).select(*used, (2 * F.col("auc") - 1).alias("gini"), "ks"))


def pr_curve(df: DataFrame, score: str, target: str, keys: list[str] | None = None) -> DataFrame:
    """Precision and recall of every threshold."""
    curve, _ = _curve(df, score, target, keys, clip=False)
    hits, alarms = _at_or_above("pos"), _at_or_above("pos") + _at_or_above("neg")
    return _drop_all(curve).select(
        *(keys or []), F.col("score").alias("threshold"),
        F.try_divide(hits, alarms).alias("precision"), F.try_divide(hits, "pos_sum").alias("recall"),
    )


def pr_area(df: DataFrame, score: str, target: str, keys: list[str] | None = None) -> DataFrame:
    """Area under the precision-recall curve by trapezoids, from recall 0 at precision 1."""
    curve, used = _curve(df, score, target, keys, clip=False)
    hits, alarms = _at_or_above("pos"), _at_or_above("pos") + _at_or_above("neg")
    before_hits, before_alarms = hits - F.col("pos"), alarms - F.col("pos") - F.col("neg")
    precision = hits / alarms
    before = F.when(before_alarms > 0, F.try_divide(before_hits, before_alarms)).otherwise(F.lit(1.0))
    slice_area = F.col("pos") / F.col("pos_sum") * (precision + before) / 2
    return _drop_all(curve.groupBy(*used).agg(F.sum(slice_area).alias("pr_auc")))


def ks_curve(df: DataFrame, score: str, target: str, keys: list[str] | None = None, clip: bool = True) -> DataFrame:
    """Cumulative share of each class at or below every score, and their distance."""
    curve, _ = _curve(df, score, target, keys, clip)
    pos = F.col("pos_to") / F.greatest("pos_sum", F.lit(1))
    neg = F.col("neg_to") / F.greatest("neg_sum", F.lit(1))
    return _drop_all(curve).select(
        *(keys or []), "score", pos.alias("pos_acum"), neg.alias("neg_acum"), F.abs(pos - neg).alias("ks"),
    )


def _best_ks(curve: DataFrame, keys: list[str], highest_score: bool) -> DataFrame:
    """Largest distance and the score that has it; equal distances go to the lowest or highest score."""
    side = F.col("score") if highest_score else -F.col("score")
    best = curve.groupBy(*keys).agg(F.max(F.struct("ks", side.alias("side"), "score")).alias("best"))
    return best.select(*keys, F.col("best.ks").alias("ks"), F.col("best.score").alias("score"))


def best_threshold(df: DataFrame, score: str, target: str, keys: list[str] | None = None) -> DataFrame:
    """The score at which the classes are furthest apart."""
    curve, used = keyed(ks_curve(df, score, target, keys), keys or [])
    return _drop_all(_best_ks(curve, used, highest_score=False))


def threshold_metrics(df: DataFrame, score: str, target: str, cut: float = 0.5, dataset: str | None = None, digits: int | None = None) -> DataFrame:
    """Accuracy, precision, recall, F1, AUC, KS, Gini and confusion counts per dataset at a cut."""
    curve, used = _curve(df, score, target, [dataset] if dataset else [], clip=False)
    above = F.col("score") >= F.lit(cut)
    ks = F.abs(F.try_divide("pos_to", "pos_sum") - F.try_divide("neg_to", "neg_sum"))
    sums = curve.groupBy(*used).agg(
        F.sum(F.when(above, F.col("pos")).otherwise(0)).alias("TP"), F.sum(F.when(above, F.col("neg")).otherwise(0)).alias("FP"),
        F.sum(F.when(above, 0).otherwise(F.col("neg"))).alias("TN"), F.sum(F.when(above, 0).otherwise(F.col("pos"))).alias("FN"),
        _auc().alias("AUC"), F.max(ks).alias("KS MAX"),
    )
    tp, fp, tn, fn = (F.col(c) for c in ["TP", "FP", "TN", "FN"])
    precision = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(0.0)
    recall = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(0.0)
    doubles = {
        "Acurácia": (tp + tn) / (tp + fp + tn + fn), "Precisão": precision, "Recall": recall,
        "F1-score": F.when(2 * tp + fp + fn > 0, 2 * tp / (2 * tp + fp + fn)).otherwise(0.0),
        "AUC": F.col("AUC"), "KS MAX": F.col("KS MAX"), "GINI": 2 * F.col("AUC") - 1,
    }
    shown = [(c if digits is None else F.bround(c, digits)).alias(n) for n, c in doubles.items()]
    names = [F.col(dataset).alias("Nome da Base")] if dataset else []
    return sums.select(*names, *shown, "TP", "FP", "TN", "FN")


def confusion_matrix(df: DataFrame, score: str, target: str, cut: float = 0.5, dataset: str | None = None, percent: bool = False) -> DataFrame:
    """Rows per actual and predicted class, as counts or percent of the dataset."""
    keys = [dataset] if dataset else []
    cells = df.filter(F.col(target).isNotNull()).select(
        *keys, F.col(target).cast("int").alias("y"),
        F.when(F.col(score) >= cut, 1).otherwise(0).alias("pred"),
    ).groupBy(*keys, "y", "pred").agg(F.count(F.lit(1)).alias("n"))
    if not percent:
        return cells
    # At most four rows per dataset remain.
    return cells.withColumn("n", F.col("n") / F.sum("n").over(Window.partitionBy(*keys)) * 100)


def _bands(df: DataFrame, score: str, target: str, n_bins: int, dataset: str | None, other: str | None = None) -> tuple[DataFrame, list[str]]:
    counts, keys = keyed(score_counts(df, score, target, [dataset] if dataset else [], other=other), [dataset] if dataset else [])
    extra = [F.min("other_min").alias("score_0 min"), F.max("other_max").alias("score_0 max")] if other else []
    bands = banded(counts, keys, "score", n_bins).groupBy(*keys, "quantil").agg(
        F.sum("n").alias("total_casos"), F.sum("pos").alias("total_mau"), *extra
    )
    return bands, keys


def decile_rates(df: DataFrame, score: str, target: str, n_bins: int = 10, dataset: str | None = None) -> DataFrame:
    """Event rate per score quantile beside the overall rate."""
    bands, keys = _bands(df, score, target, n_bins, dataset)
    whole = Window.partitionBy(*keys)
    overall = F.bround(F.sum("total_mau").over(whole) / F.sum("total_casos").over(whole), 4)
    return _drop_all(bands.select(
        *keys, (F.col("quantil") - 1).alias("grupo"), (F.col("total_mau") / F.col("total_casos")).alias("taxa"), overall.alias("taxa_media"),
    ))


def lift(df: DataFrame, score: str, target: str, n_bins: int = 10, dataset: str | None = None) -> DataFrame:
    """Event rate per score quantile over the overall rate."""
    bands, keys = _bands(df, score, target, n_bins, dataset)
    whole = Window.partitionBy(*keys)
    rate, overall = F.col("total_mau") / F.col("total_casos"), F.sum("total_mau").over(whole) / F.sum("total_casos").over(whole)
    return _drop_all(bands.select(
        *keys, F.col("quantil").alias("bin"), F.col("total_casos").alias("total"), F.col("total_mau").alias("positivos"),
        rate.alias("taxa_positivos"), F.try_divide(rate, overall).alias("lift"),
    ))


def _cumulative(bands: DataFrame, keys: list[str]) -> DataFrame:
    """Running and whole totals over the few bands of each dataset."""
    to_here = Window.partitionBy(*keys).orderBy("quantil").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*keys)
    return bands.withColumn("total_bom", F.col("total_casos") - F.col("total_mau")).withColumns({
        "maus_acumulados": F.sum("total_mau").over(to_here), "bons_acumulados": F.sum("total_bom").over(to_here),
        "__maus": F.sum("total_mau").over(whole), "__bons": F.sum("total_bom").over(whole),
    })


def gain_table(df: DataFrame, score: str, target: str, n_bins: int = 10, dataset: str | None = None) -> DataFrame:
    """Cases, events, cumulative gain and cumulative lift per score quantile."""
    bands, keys = _bands(df, score, target, n_bins, dataset)
    gain = F.col("maus_acumulados") / F.col("__maus") * 100
    return _drop_all(_cumulative(bands, keys).select(
        *keys, "quantil", "total_casos", "total_mau", "total_bom", "maus_acumulados",
        (F.col("total_mau") / F.col("__maus") * 100).alias("percentual_eventos"), gain.alias("gain"),
        (gain / (F.col("quantil") / n_bins * 100)).alias("cumulative_lift"),
    ))


def evaluation_table(df: DataFrame, score: str = "score_1", other: str = "score_0", target: str = "y", n_bins: int = 10, dataset: str | None = None) -> DataFrame:
    """Score range, cases, cumulative events and KS per score quantile."""
    bands, keys = _bands(df, score, target, n_bins, dataset, other)
    share = F.col("maus_acumulados") / F.col("__maus") * 100
    names = [F.col(dataset).alias("nome_dataframe")] if dataset else []
    return _cumulative(bands, keys).select(
        *names, "quantil", "score_0 min", "score_0 max", "total_casos", "total_mau", "total_bom", "maus_acumulados",
        share.alias("% maus acumulados"), F.abs(share - F.col("bons_acumulados") / F.col("__bons") * 100).alias("KS"),
    )


def ks_by_period(df: DataFrame, score: str = "score_1", target: str = "y", period: str = "safra", dataset: str | None = None) -> DataFrame:
    """Rows, KS in percent and its score per period; 0 and null where a class is missing."""
    keys = [*([dataset] if dataset else []), period]
    curve, _ = _curve(df, score, target, keys, clip=False)
    two = (F.col("pos_sum") > 0) & (F.col("neg_sum") > 0)
    distance = F.abs(F.try_divide(_at_or_above("pos"), "pos_sum") - F.try_divide(_at_or_above("neg"), "neg_sum"))
    best = curve.withColumns({"ks": F.when(two, distance), "at": F.when(two, F.col("score"))}).groupBy(*keys).agg(
        F.sum(F.col("pos") + F.col("neg")).alias("contagem_de_linhas"), F.max(F.struct("ks", "at")).alias("best")
    )
    return best.select(
        *keys, "contagem_de_linhas", (F.coalesce("best.ks", F.lit(0.0)) * 100).alias("ks_max"), F.col("best.at").alias("ponto_ks")
    )
