"""Model evaluation and stability on the scored table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waymark.operators import evaluate as V
from waymark.operators import stability as L
from waymark.plans import fixtures as fx
from waymark.plans.campaign_queries import rounded
from waymark.plans.registry import query

# Rows and classes per distinct score, with running and whole totals, for a score column and a grouping.
def curve_sql(score: str = "score_1", key: str = "dataset", name: str = "curva") -> str:
    return f"""{name} AS (
  SELECT *, sum(pos) OVER (PARTITION BY {key} ORDER BY s) AS pos_to, sum(neg) OVER (PARTITION BY {key} ORDER BY s) AS neg_to,
    sum(pos) OVER (PARTITION BY {key}) AS p, sum(neg) OVER (PARTITION BY {key}) AS q
  FROM (SELECT {key}, {score} AS s, sum(y) AS pos, sum(1 - y) AS neg FROM fx_scored GROUP BY {key}, {score}))"""


def bands_sql(n: int = 10, score: str = "score_1") -> str:
    """Quantile bands per dataset with merged edges."""
    return f"""limites AS (
  SELECT dataset, list_sort(list_distinct(quantile_cont({score}, {[i / n for i in range(n + 1)]}))) AS e FROM fx_scored GROUP BY dataset
), faixas AS (
  SELECT f.*, greatest(len(list_filter(e, lambda x: x < {score})), 1) AS quantil FROM fx_scored f JOIN limites USING (dataset)
), por_faixa AS (
  SELECT dataset, quantil, count(*) AS casos, sum(y) AS maus, count(*) - sum(y) AS bons, min(score_0) AS s_min, max(score_0) AS s_max
  FROM faixas GROUP BY dataset, quantil
), resumo AS (
  SELECT *, sum(maus) OVER (PARTITION BY dataset ORDER BY quantil) AS maus_to, sum(bons) OVER (PARTITION BY dataset ORDER BY quantil) AS bons_to,
    sum(maus) OVER (PARTITION BY dataset) AS todos_maus, sum(bons) OVER (PARTITION BY dataset) AS todos_bons,
    sum(casos) OVER (PARTITION BY dataset) AS todos
  FROM por_faixa)"""


CURVE = fx.with_(fx.SCORED_SQL, curve_sql())
TIED = fx.with_(fx.SCORED_SQL, curve_sql("score_tied"))
BANDS = fx.with_(fx.SCORED_SQL, bands_sql())
AUC_SQL = "sum(pos * (neg_to - neg * 0.5)) / (max(p) * max(q))"


@query("v1_roc_curve", CURVE + """SELECT dataset, round(s, 6) AS threshold, round((q - neg_to + neg) / q, 6) AS fpr,
  round((p - pos_to + pos) / p, 6) AS tpr FROM curva""")
def v1(spark, sf):
    return rounded(V.roc_curve(fx.scored(spark, sf), "score_1", "y", ["dataset"]))


def _auc_sql(score: str) -> str:
    return fx.with_(fx.SCORED_SQL, curve_sql(score)) + f"SELECT dataset, round({AUC_SQL}, 6) AS auc, round(2 * {AUC_SQL} - 1, 6) AS gini FROM curva GROUP BY dataset"


@query("v1_roc_auc", _auc_sql("score_1"))
def v1_auc(spark, sf):
    return rounded(V.roc_auc(fx.scored(spark, sf), "score_1", "y", ["dataset"]))


@query("v1_roc_auc_tied_scores", _auc_sql("score_tied"))
def v1_tied(spark, sf):
    return rounded(V.roc_auc(fx.scored(spark, sf), "score_tied", "y", ["dataset"]))


@query("v2_pr_curve", CURVE + """SELECT dataset, round(s, 6) AS threshold,
  round((p - pos_to + pos) / (p - pos_to + pos + q - neg_to + neg), 6) AS precision, round((p - pos_to + pos) / p, 6) AS recall FROM curva""")
def v2(spark, sf):
    return rounded(V.pr_curve(fx.scored(spark, sf), "score_1", "y", ["dataset"]))


@query("v2_pr_area", CURVE + """, pontos AS (
  SELECT dataset, s, (p - pos_to + pos) / (p - pos_to + pos + q - neg_to + neg) AS prec, (p - pos_to + pos) / p AS rec FROM curva
  UNION ALL SELECT DISTINCT dataset, 9.0, 1.0, 0.0 FROM curva
), passos AS (
  SELECT dataset, (rec - lag(rec) OVER w) * (prec + lag(prec) OVER w) / 2 AS area FROM pontos WINDOW w AS (PARTITION BY dataset ORDER BY s DESC))
SELECT dataset, round(sum(area), 6) AS pr_auc FROM passos GROUP BY dataset""")
def v2_area(spark, sf):
    return rounded(V.pr_area(fx.scored(spark, sf), "score_1", "y", ["dataset"]))


@query("v3_ks_curve", fx.with_(fx.SCORED_SQL, curve_sql(key="1", name="curva").replace("SELECT 1,", "SELECT").replace("GROUP BY 1, score_1", "GROUP BY score_1")) + """
SELECT round(s, 6) AS score, round(pos_to / p, 6) AS pos_acum, round(neg_to / q, 6) AS neg_acum, round(abs(pos_to / p - neg_to / q), 6) AS ks FROM curva""")
def v3(spark, sf):
    return rounded(V.ks_curve(fx.scored(spark, sf), "score_1", "y"))


@query("v4_ks_curve_by_dataset", CURVE + """
SELECT dataset, round(s, 6) AS score, round(pos_to / p, 6) AS pos_acum, round(neg_to / q, 6) AS neg_acum,
  round(abs(pos_to / p - neg_to / q), 6) AS ks FROM curva""")
def v4(spark, sf):
    return rounded(V.ks_curve(fx.scored(spark, sf), "score_1", "y", ["dataset"], clip=False))


def metrics_sql(cut: float, digits: int) -> str:
    return f"""SELECT dataset AS "Nome da Base", round((tp + tn) / (tp + fp + tn + fn), {digits}) AS "Acurácia",
  round(tp / (tp + fp), {digits}) AS "Precisão", round(tp / (tp + fn), {digits}) AS "Recall", round(2 * tp / (2 * tp + fp + fn), {digits}) AS "F1-score",
  round(auc, {digits}) AS "AUC", round(ks, {digits}) AS "KS MAX", round(2 * auc - 1, {digits}) AS "GINI",
  CAST(tp AS BIGINT) AS "TP", CAST(fp AS BIGINT) AS "FP", CAST(tn AS BIGINT) AS "TN", CAST(fn AS BIGINT) AS "FN"
FROM (SELECT dataset, sum(pos) FILTER (s >= {cut}) AS tp, sum(neg) FILTER (s >= {cut}) AS fp, sum(neg) FILTER (s < {cut}) AS tn,
  sum(pos) FILTER (s < {cut}) AS fn, {AUC_SQL} AS auc, max(abs(pos_to / p - neg_to / q)) AS ks FROM curva GROUP BY dataset)"""


@query("v5_threshold_metrics", CURVE + metrics_sql(0.44, 6))
def v5(spark, sf):
    return rounded(V.threshold_metrics(fx.scored(spark, sf), "score_1", "y", 0.44, "dataset"))


@query("v6_metrics_many_bases", CURVE + metrics_sql(0.5, 4))
def v6(spark, sf):
    return V.threshold_metrics(fx.scored(spark, sf), "score_1", "y", 0.5, "dataset", digits=4)


@query("v7_confusion_matrix", fx.with_(fx.SCORED_SQL) + """
SELECT dataset, y, CAST(score_1 >= 0.5 AS INTEGER) AS pred, count(*) AS n FROM fx_scored GROUP BY ALL""")
def v7(spark, sf):
    return V.confusion_matrix(fx.scored(spark, sf), "score_1", "y", 0.5, "dataset")


@query("v7_confusion_matrix_percent", fx.with_(fx.SCORED_SQL) + """
SELECT dataset, y, CAST(score_1 >= 0.5 AS INTEGER) AS pred, round(count(*) / sum(count(*)) OVER (PARTITION BY dataset) * 100, 6) AS n
FROM fx_scored GROUP BY dataset, y, pred""")
def v7_percent(spark, sf):
    return rounded(V.confusion_matrix(fx.scored(spark, sf), "score_1", "y", 0.5, "dataset", percent=True))


@query("v8_decile_rates", BANDS + """SELECT dataset, CAST(quantil - 1 AS INTEGER) AS grupo, round(maus / casos, 6) AS taxa,
  round_even(sum(maus) OVER (PARTITION BY dataset) / todos, 4) AS taxa_media FROM resumo""")
def v8(spark, sf):
    return rounded(V.decile_rates(fx.scored(spark, sf), "score_1", "y", 10, "dataset"))


@query("v9_lift", BANDS + """SELECT dataset, CAST(quantil AS INTEGER) AS bin, casos AS total, CAST(maus AS BIGINT) AS positivos,
  round(maus / casos, 6) AS taxa_positivos, round((maus / casos) / (todos_maus / todos), 6) AS lift FROM resumo""")
def v9(spark, sf):
    return rounded(V.lift(fx.scored(spark, sf), "score_1", "y", 10, "dataset"))


@query("v9_lift_tied_scores", fx.with_(fx.SCORED_SQL, bands_sql(60, "score_tied")) + """
SELECT dataset, CAST(quantil AS INTEGER) AS bin, casos AS total, CAST(maus AS BIGINT) AS positivos,
  round(maus / casos, 6) AS taxa_positivos, round((maus / casos) / (todos_maus / todos), 6) AS lift FROM resumo""")
def v9_tied(spark, sf):
    return rounded(V.lift(fx.scored(spark, sf), "score_tied", "y", 60, "dataset"))


@query("v10_gain_table", BANDS + """SELECT dataset, CAST(quantil AS INTEGER) AS quantil, casos AS total_casos, CAST(maus AS BIGINT) AS total_mau,
  CAST(bons AS BIGINT) AS total_bom, CAST(maus_to AS BIGINT) AS maus_acumulados, round(maus / todos_maus * 100, 6) AS percentual_eventos,
  round(maus_to / todos_maus * 100, 6) AS gain, round(maus_to / todos_maus * 100 / (quantil / 10 * 100), 6) AS cumulative_lift FROM resumo""")
def v10(spark, sf):
    return rounded(V.gain_table(fx.scored(spark, sf), "score_1", "y", 10, "dataset"))


@query("v11_evaluation_table", BANDS + """SELECT dataset AS nome_dataframe, CAST(quantil AS INTEGER) AS quantil, round(s_min, 6) AS "score_0 min",
  round(s_max, 6) AS "score_0 max", casos AS total_casos, CAST(maus AS BIGINT) AS total_mau, CAST(bons AS BIGINT) AS total_bom,
  CAST(maus_to AS BIGINT) AS maus_acumulados, round(maus_to / todos_maus * 100, 6) AS "% maus acumulados",
  round(abs(maus_to / todos_maus * 100 - bons_to / todos_bons * 100), 6) AS "KS" FROM resumo""")
def v11(spark, sf):
    return rounded(V.evaluation_table(fx.scored(spark, sf), dataset="dataset"))


def period_sql(key: str) -> str:
    return fx.with_(fx.SCORED_SQL, curve_sql(key=key)) + f"""
SELECT {key}, CAST(sum(pos + neg) AS BIGINT) AS contagem_de_linhas, round(max(d) * 100, 6) AS ks_max, round(max(s) FILTER (d = top), 6) AS ponto_ks
FROM (SELECT *, max(d) OVER (PARTITION BY {key}) AS top FROM (SELECT *, abs((p - pos_to + pos) / p - (q - neg_to + neg) / q) AS d FROM curva))
GROUP BY {key}"""


@query("v12_ks_by_period", period_sql("safra"))
def v12(spark, sf):
    return rounded(V.ks_by_period(fx.scored(spark, sf)))


@query("v13_ks_by_period_multi", period_sql("dataset, safra"))
def v13(spark, sf):
    return rounded(V.ks_by_period(fx.scored(spark, sf), dataset="dataset"))


@query("v14_best_threshold", CURVE + """SELECT dataset, round(top, 6) AS ks, round(min(s), 6) AS score
FROM (SELECT *, abs(pos_to / p - neg_to / q) AS d, max(abs(pos_to / p - neg_to / q)) OVER (PARTITION BY dataset) AS top FROM curva)
WHERE d = top GROUP BY dataset, top""")
def v14(spark, sf):
    return rounded(V.best_threshold(fx.scored(spark, sf), "score_1", "y", ["dataset"]))


# ---- stability ----------------------------------------------------------------------------

DRIFT = ["qty", "price"]


def drift(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Reference: the first three years shipped; current: later years, with larger quantities from 1999 on."""
    df = fx.table(spark, sf, "lineitem").select(
        (F.col("l_quantity") + F.when(F.year("l_shipdate") >= 1999, F.col("l_linenumber")).otherwise(0)).alias("qty"),
        F.col("l_extendedprice").alias("price"), F.year("l_shipdate").alias("safra"),
    )
    return df.filter("safra < 1998"), df.filter("safra >= 1998")


DRIFT_SQL = """base AS (
  SELECT l_quantity + CASE WHEN year(l_shipdate) >= 1999 THEN l_linenumber ELSE 0 END AS qty, l_extendedprice AS price,
    CAST(year(l_shipdate) AS INTEGER) AS safra FROM lineitem
), ambos AS (
  SELECT 'qty' AS variavel, qty AS x, safra FROM base UNION ALL SELECT 'price', price, safra FROM base
), ends AS (
  SELECT variavel, min(x) AS lo, max(x) AS hi FROM ambos WHERE safra < 1998 GROUP BY variavel
), grade AS (
  SELECT variavel, i AS ordem, CASE WHEN i = 1 THEN lo ELSE lo + (i - 1) * ((hi - lo) / 10) END AS de,
    CASE WHEN i = 10 THEN hi ELSE lo + i * ((hi - lo) / 10) END AS ate FROM ends, range(1, 11) r(i)
), contagem AS (
  SELECT g.variavel, g.ordem, g.de, g.ate, a.safra, count(*) AS n FROM grade g JOIN ambos a ON a.variavel = g.variavel
    AND a.x >= g.de AND (a.x < g.ate OR (g.ordem = 10 AND a.x = g.ate)) GROUP BY ALL
), lados AS (
  SELECT g.variavel, g.ordem, g.de, g.ate, coalesce(sum(n) FILTER (safra < 1998), 0) AS r, coalesce(sum(n) FILTER (safra >= 1998), 0) AS c
  FROM grade g LEFT JOIN contagem USING (variavel, ordem) GROUP BY g.variavel, g.ordem, g.de, g.ate
), partes AS (
  SELECT variavel, ordem, de, ate, CASE WHEN r = 0 THEN 0.0001 ELSE r / sum(r) OVER (PARTITION BY variavel) END AS r,
    CASE WHEN c = 0 THEN 0.0001 ELSE c / sum(c) OVER (PARTITION BY variavel) END AS c FROM lados)"""


@query("l1_psi_table", fx.with_(DRIFT_SQL) + """
SELECT variavel, CAST(ordem AS INTEGER) AS ordem, CAST(round_even(de, 2) AS VARCHAR) || ' - ' || CAST(round_even(ate, 2) AS VARCHAR) AS faixa, round(r, 6) AS "Ref_Proporção", round(c, 6) AS "Atual_Proporção", round((r - c) * ln(r / c), 6) AS "PSI_Bin" FROM partes""")
def l1(spark, sf):
    return rounded(L.psi_table(*drift(spark, sf), DRIFT))


@query("l2_psi_total", fx.with_(DRIFT_SQL) + "SELECT variavel, round(sum((r - c) * ln(r / c)), 6) AS psi FROM partes GROUP BY variavel")
def l2(spark, sf):
    return rounded(L.psi(*drift(spark, sf), DRIFT))


@query("l3_psi_by_period", fx.with_(DRIFT_SQL) + """
SELECT 'Safras Treino' AS safra, 0.0::DOUBLE AS "PSI" UNION ALL
SELECT CAST(safra AS VARCHAR), round(sum((r - c) * ln(r / c)), 6) FROM (
  SELECT s.safra, p.r, CASE WHEN coalesce(n, 0) = 0 THEN 0.0001 ELSE n / sum(n) OVER (PARTITION BY s.safra) END AS c
  FROM (SELECT DISTINCT safra FROM base WHERE safra >= 1998) s CROSS JOIN (SELECT * FROM partes WHERE variavel = 'qty') p
  LEFT JOIN (SELECT * FROM contagem WHERE variavel = 'qty') k ON k.safra = s.safra AND k.ordem = p.ordem)
GROUP BY safra""")
def l3(spark, sf):
    return rounded(L.psi_by_period(*drift(spark, sf), "qty"))


KS2_SQL = """soma AS (
  SELECT variavel, x, count(*) FILTER (safra < 1998) AS a, count(*) FILTER (safra >= 1998) AS b FROM ambos GROUP BY variavel, x
), passo AS (
  SELECT variavel, sum(a) OVER w / sum(a) OVER (PARTITION BY variavel) AS fa, sum(b) OVER w / sum(b) OVER (PARTITION BY variavel) AS fb,
    sum(a) OVER (PARTITION BY variavel) AS na, sum(b) OVER (PARTITION BY variavel) AS nb
  FROM soma WINDOW w AS (PARTITION BY variavel ORDER BY x)
), ks2 AS (
  SELECT variavel, max(abs(fa - fb)) AS d, CAST(max(na) AS BIGINT) AS n_a, CAST(max(nb) AS BIGINT) AS n_b FROM passo GROUP BY variavel
), ks2p AS (
  SELECT *, CASE WHEN z < 0.04 THEN 1.0 ELSE least(greatest(2 * list_sum(list_transform(range(1, 101),
    lambda k: pow(-1.0, k - 1) * exp(-2.0 * k * k * z))), 0.0), 1.0) END AS p
  FROM (SELECT *, d * d * (n_a::DOUBLE * n_b / (n_a + n_b)) AS z FROM ks2))"""


@query("l4_ks_two_samples", fx.with_(DRIFT_SQL, KS2_SQL) + "SELECT variavel, round(d, 6) AS ks_stat, n_a, n_b, round(p, 6) AS p_value FROM ks2p")
def l4(spark, sf):
    return rounded(L.ks_two_samples(*drift(spark, sf), DRIFT))


@query("l5_monitor", fx.with_(DRIFT_SQL, KS2_SQL) + """
SELECT 'psi' AS teste, variavel, round(v, 6) AS valor, CASE WHEN v >= 0.1 AND v < 0.25 THEN 'Mudança Moderada' ELSE 'Mudança Significativa' END AS alerta
FROM (SELECT variavel, sum((r - c) * ln(r / c)) AS v FROM partes GROUP BY variavel) WHERE v >= 0.001
UNION ALL SELECT 'ks', variavel, round(d, 6), 'Mudança Significativa' FROM ks2p WHERE p < 0.05""")
def l5(spark, sf):
    shifted, apart = L.monitor(*drift(spark, sf), DRIFT, psi_limit=0.001)
    return rounded(shifted.select(F.lit("psi").alias("teste"), "variavel", F.col("psi").alias("valor"), "alerta").unionByName(
        apart.select(F.lit("ks").alias("teste"), "variavel", F.col("ks_stat").alias("valor"), "alerta")))


def stability_input(spark: SparkSession, sf: str) -> DataFrame:
    return fx.table(spark, sf, "lineitem").select(
        F.col("l_quantity").alias("qty"), F.col("l_extendedprice").alias("price"), F.year("l_shipdate").alias("safra"))


@query("l6_bin_shares", fx.with_("""linhas AS (
  SELECT 'qty' AS variavel, l_quantity AS x, CAST(year(l_shipdate) AS VARCHAR) AS safra FROM lineitem
  UNION ALL SELECT 'price', l_extendedprice, CAST(year(l_shipdate) AS VARCHAR) FROM lineitem
), lim AS (
  SELECT variavel, list_sort(list_distinct(quantile_cont(x, [0, 0.2, 0.4, 0.6, 0.8, 1]))) AS e FROM linhas GROUP BY variavel
), cnt AS (
  SELECT variavel, safra, greatest(len(list_filter(e, lambda v: v < x)), 1) AS bin, count(*) AS n FROM linhas JOIN lim USING (variavel) GROUP BY ALL)""") + """
SELECT variavel, safra, CAST(bin AS INTEGER) AS bin, round(n / sum(n) OVER (PARTITION BY variavel, safra), 6) AS share FROM cnt""")
def l6(spark, sf):
    return rounded(L.bin_shares(stability_input(spark, sf), ["qty", "price"], "safra", 5)[0])


@query("l6_bin_groups", fx.with_("""linhas AS (
  SELECT 'qty' AS variavel, l_quantity AS x FROM lineitem UNION ALL SELECT 'price', l_extendedprice FROM lineitem
), lim AS (
  SELECT variavel, list_sort(list_distinct(quantile_cont(x, [0, 0.125, 0.25, 0.375, 0.5, 0.625, 0.75, 0.875, 1]))) AS e FROM linhas GROUP BY variavel)""") + """
SELECT DISTINCT variavel, CAST(greatest(len(list_filter(e, lambda v: v < x)), 1) AS INTEGER) AS bin, TRUE AS named, 4::BIGINT AS groups FROM linhas JOIN lim USING (variavel)""")
def l6_groups(spark, sf):
    shares, _ = L.bin_shares(stability_input(spark, sf), ["qty", "price"], "safra", 8)
    found = L.bin_groups(shares, "safra")
    groups = F.size(F.collect_set("grupo").over(Window.partitionBy("variavel"))).cast("long")
    return found.select("variavel", "bin", F.col("grupo").rlike("^Bin_[1-4]$").alias("named"), groups.alias("groups"))
