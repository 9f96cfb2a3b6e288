"""Scenarios, best offers and uplift on the labelled audience."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.operators import recommend as R
from waymark.plans import fixtures as fx
from waymark.plans.campaign_queries import BOOKS, LABEL_SQL, OFFER_BOOK_SQL, campaign, rounded
from waymark.plans.registry import query
from waymark.spec import ANCHOR_TIME, ENTITY, ITEM, ITEM_COLUMNS, KEY, TARGET

SCORE_SQL = "((length(ID) * 7 + CAST(substr({o}.offer_id, 2) AS INTEGER) * 13 + CAST(b.time_since_test_start AS INTEGER) * 5) % 97) / 97.0::DOUBLE"
BASE_SQL = """b AS (
  SELECT k.ID, k.cliente_id, k.offer_id, CAST(floor(k.time_since_test_start) AS INTEGER) AS time_since_test_start, k.offer_type, k.discount_value, k.min_value,
    k.duration, k.web, k.email, k.mobile, k.social, p.target_sucesso FROM book_oferta k JOIN publico_com_target p ON p.ID = k.ID
), atual AS (SELECT b.*, """ + SCORE_SQL.format(o="b") + """ AS score_modelo FROM b
), cen AS (
  SELECT b.ID, b.cliente_id, o.offer_id, b.time_since_test_start, o.offer_type, o.discount_value, o.min_value, o.duration, o.web, o.email, o.mobile, o.social,
    b.target_sucesso, b.cliente_id || '_' || o.offer_id AS ID_cenario, """ + SCORE_SQL.format(o="o") + """ AS score_modelo FROM b CROSS JOIN fx_offers o
), melhor AS (
  SELECT cliente_id, offer_id, score_modelo, time_since_test_start FROM cen
  QUALIFY row_number() OVER (PARTITION BY cliente_id, time_since_test_start ORDER BY score_modelo DESC, offer_id) = 1
), comp AS (
  SELECT a.offer_id AS offer_id_original, a.score_modelo AS score_modelo_original, m.offer_id AS offer_id_proposta, m.score_modelo AS score_modelo_proposta,
    a.target_sucesso AS target_sucesso_real, a.time_since_test_start FROM atual a LEFT JOIN melhor m USING (cliente_id, time_since_test_start))"""
SQL = fx.with_(*BOOKS, OFFER_BOOK_SQL, LABEL_SQL, BASE_SQL)


def stand_in_score():
    """A deterministic score in place of a model's, so that SQL can follow."""
    number = F.substring(ITEM, 2, 9).cast("int")
    return ((F.length(KEY) * 7 + number * 13 + F.col(ANCHOR_TIME) * 5) % 97) / 97.0


def base(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    c = campaign(spark, sf, stage=True)
    labels = c.labelled_audience().select(ENTITY, ITEM, TARGET)
    rows = c.offer().join(labels, [ENTITY, ITEM]).withColumn(ANCHOR_TIME, F.floor(ANCHOR_TIME).cast("int"))
    return rows.select(KEY, ENTITY, ITEM, ANCHOR_TIME, *ITEM_COLUMNS, TARGET), c.items


def scenarios(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame]:
    rows, items = base(spark, sf)
    return R.with_score(R.expand_scenarios(rows, items), stand_in_score()), rows, items


def best(spark, sf) -> DataFrame:
    return R.best_offer(scenarios(spark, sf)[0])


def comparison(spark, sf) -> DataFrame:
    wide, rows, _ = scenarios(spark, sf)
    return R.compare_offers(R.with_score(rows, stand_in_score()), R.best_offer(wide))


@query("r1_expand_scenarios", SQL + "SELECT * EXCLUDE (score_modelo) FROM cen")
def r1(spark, sf):
    return R.expand_scenarios(*base(spark, sf))


@query("j14_every_row_every_item", SQL + "SELECT ID, offer_id, offer_type, duration FROM cen")
def j14(spark, sf):
    return R.expand_scenarios(*base(spark, sf)).select(KEY, ITEM, "offer_type", "duration")


@query("r2_score_scenarios", SQL + "SELECT ID, offer_id, round(score_modelo, 6) AS score_modelo FROM cen")
def r2(spark, sf):
    return rounded(scenarios(spark, sf)[0].select(KEY, ITEM, "score_modelo"))


@query("r3_best_offer", SQL + "SELECT cliente_id, offer_id, round(score_modelo, 6) AS score_modelo, time_since_test_start FROM melhor")
def r3(spark, sf):
    return rounded(best(spark, sf))


# Offers of equal type, discount, minimum and duration stand for each other; the SQL takes the full product.
@query("r3_best_item_by_classes", SQL + """, todos AS (
  SELECT b.cliente_id, b.time_since_test_start, o.offer_id, (length(b.ID) * 7 + o.discount_value * 3 + o.duration * 11 + b.time_since_test_start * 5) % 97 / 97.0::DOUBLE AS s FROM b CROSS JOIN fx_offers o)
SELECT cliente_id, offer_id, round(s, 6) AS score_modelo, time_since_test_start FROM todos QUALIFY row_number() OVER (PARTITION BY cliente_id, time_since_test_start ORDER BY s DESC, offer_id) = 1""")
def r3_classes(spark, sf):
    rows, items = base(spark, sf)
    columns = [ITEM, "offer_type", "discount_value", "min_value", "duration"]
    score = (F.length(KEY) * 7 + F.col("discount_value") * 3 + F.col("duration") * 11 + F.col(ANCHOR_TIME) * 5) % 97 / 97.0
    return rounded(R.best_item(rows, items.select(*columns), score, columns))


@query("r4_offer_ranking", SQL + "SELECT offer_id, qtd, o.* EXCLUDE (offer_id) FROM (SELECT offer_id, count(*) AS qtd FROM melhor GROUP BY 1) LEFT JOIN fx_offers o USING (offer_id) ORDER BY qtd DESC, offer_id LIMIT 10")
def r4(spark, sf):
    wide, _, items = scenarios(spark, sf)
    return R.offer_ranking(R.best_offer(wide), items)


@query("r5_offer_switching", SQL + "SELECT cliente_id, count(DISTINCT offer_id) AS ofertas FROM melhor GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5")
def r5(spark, sf):
    return R.offer_switching(best(spark, sf))


@query("r6_entity_recommendations", SQL + "SELECT cliente_id, offer_id, round(score_modelo, 6) AS score_modelo, time_since_test_start FROM melhor WHERE cliente_id = '7'")
def r6(spark, sf):
    return rounded(R.entity_recommendations(best(spark, sf), "7"))


COMPARED = "offer_id_original, round(score_modelo_original, 6) AS score_modelo_original, offer_id_proposta, round(score_modelo_proposta, 6) AS score_modelo_proposta, target_sucesso_real, time_since_test_start"


@query("r7_compare_offers", SQL + f"SELECT {COMPARED} FROM comp")
def r7(spark, sf):
    return rounded(comparison(spark, sf))


@query("j15_actual_beside_proposed", SQL + "SELECT offer_id_original, offer_id_proposta, time_since_test_start, count(*) AS n FROM comp GROUP BY ALL")
def j15(spark, sf):
    return comparison(spark, sf).groupBy("offer_id_original", "offer_id_proposta", ANCHOR_TIME).agg(F.count(F.lit(1)).alias("n"))


@query("r8_missed_opportunities", SQL + f"SELECT {COMPARED} FROM comp WHERE target_sucesso_real = 0 AND offer_id_proposta IS DISTINCT FROM offer_id_original")
def r8(spark, sf):
    return rounded(R.missed_opportunities(comparison(spark, sf)))


@query("r9_simulated_conversion", SQL + f"SELECT {COMPARED}, CAST(score_modelo_proposta >= 0.44 AS INTEGER) AS target_sucesso_modelo FROM comp WHERE target_sucesso_real = 0 AND offer_id_proposta IS DISTINCT FROM offer_id_original")
def r9(spark, sf):
    return rounded(R.simulated_conversion(R.missed_opportunities(comparison(spark, sf))))


@query("r10_uplift_summary", SQL + """SELECT a AS casos_sem_conversao, b AS casos_avaliados, c AS convertidos_simulados, CAST(round_even(c * 0.78, 0) AS BIGINT) AS casos_convertidos,
  round_even(100.0 * CAST(round_even(c * 0.78, 0) AS BIGINT) / a, 1) AS taxa_repescagem
FROM (SELECT count(*) FILTER (target_sucesso_real = 0) AS a, count(*) FILTER (target_sucesso_real = 0 AND offer_id_proposta IS DISTINCT FROM offer_id_original) AS b,
  count(*) FILTER (target_sucesso_real = 0 AND offer_id_proposta IS DISTINCT FROM offer_id_original AND score_modelo_proposta >= 0.44) AS c FROM comp)""")
def r10(spark, sf):
    return R.uplift_summary(comparison(spark, sf))
