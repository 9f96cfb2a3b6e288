"""Attribution, labels and feature books."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.operators import attribution as A
from waymark.operators import books as B
from waymark.operators import events as E
from waymark.operators.dataset import Campaign
from waymark.plans import fixtures as fx
from waymark.plans.registry import query
from waymark.spec import CHANNELS, ENTITY, ITEM, TIME

BASE = (fx.OFFERS_SQL, fx.PROFILE_SQL, fx.TRANSACTIONS_SQL, fx.LOG_SQL)

RECV_SQL = """recv AS (
  SELECT e.cliente_id, e.offer_id, e.t AS start_t, e.t + o.duration AS end_t, o.* EXCLUDE (offer_id)
  FROM ev e LEFT JOIN fx_offers o ON e.offer_id = o.offer_id WHERE e.event = 'offer received')"""
PAIRS_SQL = """pairs AS (
  SELECT c.cliente_id, c.t FROM ev c JOIN ev x ON c.cliente_id = x.cliente_id AND c.t = x.t
  WHERE c.event = 'offer completed' AND x.event = 'transaction')"""
ELIG_SQL = """elig AS (
  SELECT p.cliente_id, p.t, o.offer_id, o.start_t, o.end_t FROM pairs p
  JOIN recv o ON p.cliente_id = o.cliente_id AND p.t BETWEEN o.start_t AND o.end_t)"""
# All earlier views of each candidate are ranked here; the operators keep only the closest.
RANKED_SQL = """ranked AS (
  SELECT e.*, v.t AS t_view, CAST(v.t IS NOT NULL AS INTEGER) AS has_view, e.t - v.t AS dview
  FROM elig e LEFT JOIN ev v ON v.event = 'offer viewed' AND v.cliente_id = e.cliente_id AND v.offer_id = e.offer_id AND v.t <= e.t
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY cliente_id, t
      ORDER BY has_view DESC, dview ASC NULLS LAST, start_t DESC, offer_id) AS rank_elig,
    count(*) OVER (PARTITION BY cliente_id, t, has_view, coalesce(dview, 1e9), start_t) AS n_same_score
  FROM ranked
), conv AS (
  SELECT cliente_id, t, offer_id, start_t FROM placed WHERE rank_elig = 1 AND n_same_score = 1)"""
ATTRIBUTION = (*BASE, RECV_SQL, PAIRS_SQL, ELIG_SQL, RANKED_SQL)
LABEL_SQL = """publico AS (
  SELECT DISTINCT concat_ws('_', cliente_id, offer_id) AS ID, cliente_id, offer_id FROM ev WHERE event = 'offer received'
), rotulo AS (
  SELECT cliente_id, offer_id, count(*) AS qtd_matches FROM conv GROUP BY ALL
), publico_com_target AS (
  SELECT p.cliente_id, p.offer_id, p.ID, coalesce(r.qtd_matches, 0) AS qtd_matches,
    CAST(coalesce(r.qtd_matches, 0) > 0 AS INTEGER) AS target_sucesso
  FROM publico p LEFT JOIN rotulo r USING (cliente_id, offer_id))"""
LABELLED = (*ATTRIBUTION, LABEL_SQL)


def campaign(spark: SparkSession, sf_dir: str, **options) -> Campaign:
    return Campaign(fx.transactions(spark, sf_dir), fx.offers(spark), fx.profile(spark, sf_dir), **options)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so that two engines' last bits agree."""
    return df.select(*[
        F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes
    ])


@query("c1_enrich", fx.with_(*BASE) + """
SELECT e.cliente_id, e.offer_id, e.event, e.t, o.* EXCLUDE (offer_id), p.registered_on, p.age, p.gender, p.credit_card_limit,
  concat_ws('_', e.cliente_id, e.offer_id) AS ID
FROM ev e LEFT JOIN fx_offers o ON e.offer_id = o.offer_id LEFT JOIN fx_profile p ON e.cliente_id = p.profile_id""")
def c1(spark, sf):
    c = campaign(spark, sf)
    return E.enrich(c.log, c.items, c.entities)


@query("c1_enrich_hot_entities", fx.with_(*BASE) + """
SELECT e.cliente_id, e.offer_id, e.event, e.t, o.offer_type, p.age, concat_ws('_', e.cliente_id, e.offer_id) AS ID
FROM ev e LEFT JOIN fx_offers o ON e.offer_id = o.offer_id LEFT JOIN fx_profile p ON e.cliente_id = p.profile_id""")
def c1_hot(spark, sf):
    c = campaign(spark, sf, hot_rows=60)
    return E.enrich(c.log, c.items, c.entities).select(ENTITY, ITEM, "event", TIME, "offer_type", "age", "ID")


@query("c2_audience", fx.with_(*LABELLED) + "SELECT ID, cliente_id, offer_id FROM publico")
def c2(spark, sf):
    return E.audience(fx.transactions(spark, sf))


@query("c3_received_windows", fx.with_(*BASE, RECV_SQL) + "SELECT cliente_id, offer_id, start_t, duration, end_t FROM recv")
def c3(spark, sf):
    c = campaign(spark, sf)
    return E.received_windows(c.log, c.items)


@query("c4_split_events", fx.with_(*BASE) + """
SELECT 'purchases' AS part, cliente_id, CAST(NULL AS VARCHAR) AS offer_id, t FROM ev WHERE event = 'transaction'
UNION ALL SELECT 'completions', cliente_id, NULL, t FROM ev WHERE event = 'offer completed'
UNION ALL SELECT 'views', cliente_id, offer_id, t FROM ev WHERE event = 'offer viewed'""")
def c4(spark, sf):
    parts = E.split_events(campaign(spark, sf).log)
    times = {"purchases": "t_tx", "completions": "t_cmplt", "views": "t_view"}
    return reduce(DataFrame.unionByName, [
        df.select(
            F.lit(name).alias("part"), ENTITY,
            (F.col(ITEM) if ITEM in df.columns else F.lit(None).cast("string")).alias(ITEM), F.col(times[name]).alias(TIME),
        )
        for name, df in parts.items()
    ])


@query("c5_conversion_pairs", fx.with_(*BASE, PAIRS_SQL) + "SELECT cliente_id, t FROM pairs")
def c5(spark, sf):
    return E.conversion_pairs(campaign(spark, sf).log)


def _candidates(c: Campaign) -> DataFrame:
    windows = E.received_windows(c.log, c.items).select(ENTITY, ITEM, "start_t", "end_t")
    return A.eligible_offers(E.conversion_pairs(c.log), windows, c.frames)


@query("c6_eligible_offers", fx.with_(*BASE, RECV_SQL, PAIRS_SQL, ELIG_SQL) + "SELECT * FROM elig")
def c6(spark, sf):
    return _candidates(campaign(spark, sf))


def _seen(c: Campaign) -> DataFrame:
    return A.attach_views(_candidates(c), E.views(c.log), c.frames)


@query("c7_attach_views", fx.with_(*BASE, RECV_SQL, PAIRS_SQL, ELIG_SQL) + """
SELECT e.*, m.t_view, CAST(m.t_view IS NOT NULL AS INTEGER) AS has_view, e.t - m.t_view AS dview
FROM elig e LEFT JOIN (
  SELECT e.cliente_id, e.offer_id, e.t, e.start_t, max(v.t) AS t_view
  FROM elig e JOIN ev v ON v.event = 'offer viewed' AND v.cliente_id = e.cliente_id AND v.offer_id = e.offer_id AND v.t <= e.t
  GROUP BY ALL) m USING (cliente_id, offer_id, t, start_t)""")
def c7(spark, sf):
    return _seen(campaign(spark, sf))


@query("c8_rank_candidates", fx.with_(*ATTRIBUTION) + """
SELECT cliente_id, t, offer_id, start_t, has_view, dview, row_number() OVER (PARTITION BY cliente_id, t ORDER BY first_rank) AS rank_elig
FROM (SELECT cliente_id, t, offer_id, start_t, max(has_view) AS has_view, min(dview) AS dview, min(rank_elig) AS first_rank
  FROM placed GROUP BY cliente_id, t, offer_id, start_t)""")
def c8(spark, sf):
    ranked = A.rank_candidates(_seen(campaign(spark, sf)))
    return ranked.select(ENTITY, TIME, ITEM, "start_t", "has_view", "dview", F.col("rank_elig").cast("long").alias("rank_elig"))


@query("c9_detect_ambiguity", fx.with_(*ATTRIBUTION) + """
SELECT cliente_id, t, offer_id, n_same_score, CAST(n_same_score > 1 AS INTEGER) AS ambiguous FROM placed WHERE rank_elig = 1""")
def c9(spark, sf):
    ranked = A.detect_ambiguity(A.rank_candidates(_seen(campaign(spark, sf))))
    return ranked.filter("rank_elig = 1").select(ENTITY, TIME, ITEM, "n_same_score", "ambiguous")


@query("c10_attributed_conversions", fx.with_(*ATTRIBUTION) + "SELECT cliente_id, t, offer_id, start_t FROM conv")
def c10(spark, sf):
    return campaign(spark, sf).conversions()


@query("c10_attributed_conversions_hot_entities", fx.with_(*ATTRIBUTION) + "SELECT cliente_id, t, offer_id, start_t FROM conv")
def c10_hot(spark, sf):
    return campaign(spark, sf, hot_rows=60).conversions()


@query("c10_attributed_conversions_options", fx.with_(*BASE, RECV_SQL, PAIRS_SQL, """elig AS (
  SELECT p.cliente_id, p.t, o.offer_id, o.start_t, o.end_t FROM pairs p
  JOIN recv o ON p.cliente_id = o.cliente_id AND p.t BETWEEN o.start_t AND o.end_t AND o.offer_type <> 'informational')""",
    RANKED_SQL.replace("v.t <= e.t", "v.t BETWEEN e.start_t AND e.t")) + "SELECT cliente_id, t, offer_id, start_t FROM conv")
def c10_options(spark, sf):
    c = campaign(spark, sf)
    return A.attributed_conversions(c.log, c.items, frames=c.frames, exclude_types=["informational"], view_within_window=True)


@query("c11_label_pairs", fx.with_(*LABELLED) + """
SELECT cliente_id, offer_id, qtd_matches, CAST(qtd_matches > 0 AS INTEGER) AS target_sucesso FROM rotulo""")
def c11(spark, sf):
    return A.label_pairs(campaign(spark, sf).conversions())


@query("c12_audience_with_target", fx.with_(*LABELLED) + "SELECT * FROM publico_com_target")
def c12(spark, sf):
    return campaign(spark, sf).labelled_audience()


@query("c13_explain_matches", fx.with_(*LABELLED) + """
SELECT target_sucesso, qtd_matches, count(*) AS count,
  CASE WHEN target_sucesso = 0 AND qtd_matches = 0 THEN 'Recebeu oferta mas não converteu'
    WHEN target_sucesso = 1 AND qtd_matches = 1 THEN '1 conversão vinculada à oferta'
    WHEN target_sucesso = 1 AND qtd_matches BETWEEN 2 AND 5 THEN CAST(qtd_matches AS VARCHAR) || ' conversões para a mesma oferta'
    ELSE 'Outro caso' END AS significado
FROM publico_com_target GROUP BY target_sucesso, qtd_matches""")
def c13(spark, sf):
    return A.explain_matches(campaign(spark, sf).labelled_audience())


@query("c14_funnel", fx.with_(*BASE) + """
SELECT e.event, o.offer_type, count(*) AS total FROM ev e LEFT JOIN fx_offers o ON e.offer_id = o.offer_id GROUP BY ALL""")
def c14(spark, sf):
    c = campaign(spark, sf)
    return E.funnel(c.log, c.items)


@query("c14_funnel_rates", fx.with_(*BASE) + """
SELECT received, viewed, completed, purchases, round(viewed / received, 6) AS viewed_rate,
  round(completed / received, 6) AS completed_rate, round(completed / purchases, 6) AS purchase_rate
FROM (SELECT count(*) FILTER (event = 'offer received') AS received, count(*) FILTER (event = 'offer viewed') AS viewed,
  count(*) FILTER (event = 'offer completed') AS completed, count(*) FILTER (event = 'transaction') AS purchases FROM ev)""")
def c14_rates(spark, sf):
    return rounded(E.funnel_rates(campaign(spark, sf).log))


@query("c15_entity_journey", fx.with_(*BASE) + "SELECT cliente_id, offer_id, event, t FROM ev WHERE cliente_id = '7'")
def c15(spark, sf):
    return E.entity_journey(campaign(spark, sf).log, "7")


@query("c16_registration_cohorts", fx.with_(fx.PROFILE_SQL) + """
SELECT substr(CAST(registered_on AS VARCHAR), 1, 4) AS safra, count(*) AS count FROM fx_profile GROUP BY 1""")
def c16(spark, sf):
    return E.registration_cohorts(fx.profile(spark, sf))


@query("c16_age_distribution", fx.with_(fx.PROFILE_SQL) + "SELECT age, count(*) AS count FROM fx_profile GROUP BY age")
def c16_age(spark, sf):
    return E.age_distribution(fx.profile(spark, sf))


# ---- feature books ------------------------------------------------------------------------

BEFORE = "OVER (PARTITION BY cliente_id ORDER BY t, event, offer_id NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
KEYS = "concat_ws('_', cliente_id, offer_id) AS ID, cliente_id, offer_id, t AS time_since_test_start"
LAST = "QUALIFY row_number() OVER (PARTITION BY cliente_id, offer_id ORDER BY time_since_test_start DESC) = 1"

WIDE_SQL = """wide AS (
  SELECT e.*, o.* EXCLUDE (offer_id), CAST(e.event = 'offer received' AS INTEGER) AS r, CAST(e.event = 'offer viewed' AS INTEGER) AS v,
    CAST(e.event = 'offer completed' AS INTEGER) AS c, CAST(e.event = 'transaction' AS INTEGER) AS x,
    CAST(q.t IS NOT NULL AS INTEGER) AS k
  FROM ev e LEFT JOIN fx_offers o ON e.offer_id = o.offer_id
  LEFT JOIN conv q ON q.cliente_id = e.cliente_id AND q.t = e.t)"""
BOOKS = (*ATTRIBUTION, WIDE_SQL)

PROFILE_BOOK_SQL = f"""book_perfil AS (
  SELECT {KEYS}, nullif(p.age, 118) AS idade, p.gender AS genero, p.credit_card_limit AS limite_credito,
    substr(CAST(p.registered_on AS VARCHAR), 1, 4) AS safra_registro,
    CASE WHEN nr - 1 > 0 THEN nc / (nr - 1) ELSE 0.0 END AS historico_conversao
  FROM (SELECT *, sum(r) {BEFORE} AS nr, sum(c) {BEFORE} AS nc FROM wide) w LEFT JOIN fx_profile p ON p.profile_id = w.cliente_id
  WHERE event = 'offer received' {LAST})"""
PURCHASE_BOOK_SQL = f"""compra_total AS (
  SELECT cliente_id, avg(gap) AS media_tempo_entre_transacoes, count(DISTINCT floor(t)) AS transacoes_distintas_dias
  FROM (SELECT *, t - lag(t) OVER (PARTITION BY cliente_id ORDER BY t) AS gap FROM ev WHERE event = 'transaction') GROUP BY cliente_id
), book_compra AS (
  SELECT {KEYS}, CAST(nx AS BIGINT) AS qtd_transacoes_anteriores, t - lx AS dias_desde_ultima_transacao,
    media_tempo_entre_transacoes, transacoes_distintas_dias
  FROM (SELECT *, sum(x) {BEFORE} AS nx, max(CASE WHEN x = 1 THEN t END) {BEFORE} AS lx FROM wide) w
  LEFT JOIN compra_total USING (cliente_id) WHERE event = 'offer received' {LAST})"""
FIRSTS_SQL = """firsts AS (
  SELECT r.cliente_id, r.offer_id, r.start_t, r.* EXCLUDE (cliente_id, offer_id, start_t),
    (SELECT min(t) FROM ev v WHERE v.event = 'offer viewed' AND v.cliente_id = r.cliente_id AND v.offer_id = r.offer_id) AS first_t_view,
    (SELECT min(t) FROM conv q WHERE q.cliente_id = r.cliente_id AND q.offer_id = r.offer_id) AS first_t_conv_valid
  FROM recv r)"""
INST_BEFORE = "OVER (PARTITION BY cliente_id ORDER BY start_t, offer_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
INTERACTION_BOOK_SQL = f"""medias AS (
  SELECT cliente_id, start_t, avg(first_t_view - start_t) {INST_BEFORE} AS mv, avg(first_t_conv_valid - first_t_view) {INST_BEFORE} AS mc FROM firsts
), ancoras AS (
  SELECT *, sum(r) {BEFORE} AS nr, sum(v) {BEFORE} AS nv FROM wide
), com_medias AS (
  SELECT a.cliente_id, a.offer_id, a.t, any_value(a.nr) AS nr, any_value(a.nv) AS nv, max(m.mv) AS tempo_medio_visualizacao, max(m.mc) AS tempo_medio_conversao
  FROM ancoras a LEFT JOIN medias m ON m.cliente_id = a.cliente_id AND m.start_t < a.t WHERE a.event = 'offer received' GROUP BY a.cliente_id, a.offer_id, a.t
), com_conv AS (
  SELECT a.*, q.n FROM com_medias a LEFT JOIN LATERAL (SELECT count(*) AS n FROM conv q WHERE q.cliente_id = a.cliente_id AND q.t < a.t) q ON true
), book_interacao AS (
  SELECT {KEYS}, CAST(nr AS BIGINT) AS qtd_ofertas_anteriores, CAST(nv AS BIGINT) AS qtd_ofertas_visualizadas, tempo_medio_visualizacao,
    tempo_medio_conversao, n AS qtd_ofertas_completas_validas, CASE WHEN nr > 0 THEN nv / nr ELSE 0.0 END AS taxa_visualizacao,
    CASE WHEN nr > 0 THEN n / nr ELSE 0.0 END AS taxa_conversao
  FROM com_conv {LAST})"""
OFFER_BOOK_SQL = f"""book_oferta AS (
  SELECT {KEYS}, offer_type, discount_value, min_value, duration, web, email, mobile, social
  FROM wide WHERE event = 'offer received' {LAST})"""


def _span(days: int) -> str:
    return f"OVER (PARTITION BY cliente_id ORDER BY CAST(t * 86400 AS BIGINT) RANGE BETWEEN {days * 86400} PRECEDING AND 1 PRECEDING)"


RECENCY_BOOK_SQL = f"""book_recencia AS (
  SELECT {KEYS}, t - lx AS dias_desde_ultima_transacao, t - lr AS dias_desde_ultima_oferta_recebida,
    t - lv AS dias_desde_ultima_oferta_visualizada, t - lk AS dias_desde_ultima_conversao_valida,
    CAST(x7 AS BIGINT) AS qtd_transacoes_7d, CAST(x14 AS BIGINT) AS qtd_transacoes_14d, CAST(r14 AS BIGINT) AS qtd_ofertas_recebidas_14d,
    CAST(v14 AS BIGINT) AS qtd_ofertas_visualizadas_14d, CAST(k14 AS BIGINT) AS qtd_conversoes_validas_14d
  FROM (SELECT *, max(CASE WHEN x = 1 THEN t END) {BEFORE} AS lx, max(CASE WHEN r = 1 THEN t END) {BEFORE} AS lr,
      max(CASE WHEN v = 1 THEN t END) {BEFORE} AS lv, max(CASE WHEN k = 1 THEN t END) {BEFORE} AS lk,
      sum(x) {_span(7)} AS x7, sum(x) {_span(14)} AS x14, sum(r) {_span(14)} AS r14, sum(v) {_span(14)} AS v14, sum(k) {_span(14)} AS k14
    FROM wide) WHERE event = 'offer received' {LAST})"""
COMMUNICATION_BOOK_SQL = f"""canais AS (
  SELECT *, {', '.join(f'sum({c}) {BEFORE} - {c} AS h_{c}' for c in CHANNELS)} FROM wide
), book_comunicacao AS (
  SELECT {KEYS}, web + email + mobile + social AS canais_recebidos_total, {', '.join(f'{c} AS recebeu_{c}' for c in CHANNELS)},
    {' + '.join(f'CAST(h_{c} > 0 AS INTEGER)' for c in CHANNELS)} AS canais_preferidos,
    {', '.join(f'CASE WHEN h_web + h_email + h_mobile + h_social > 0 THEN h_{c} / (h_web + h_email + h_mobile + h_social) ELSE 0.0 END AS {c}_ratio_historico' for c in CHANNELS)}
  FROM canais WHERE event = 'offer received' {LAST})"""
INSTANCES_SQL = """inst AS (
  SELECT *, CAST(first_t_view IS NOT NULL AS INTEGER) AS view_flag, CAST(first_t_conv_valid IS NOT NULL AS INTEGER) AS conv_flag,
    CASE WHEN duration <= 5 THEN 'short' WHEN duration BETWEEN 6 AND 7 THEN 'mid' ELSE 'long' END AS bucket_duracao,
    CASE WHEN discount_value <= 5 THEN 'low' WHEN discount_value <= 10 THEN 'mid' ELSE 'high' END AS bucket_desconto,
    CASE WHEN min_value <= 5 THEN 'low' WHEN min_value <= 10 THEN 'mid' ELSE 'high' END AS bucket_minimo
  FROM firsts)"""


def _same(column: str) -> str:
    return f"OVER (PARTITION BY cliente_id, {column} ORDER BY start_t, offer_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"


def _rate(num: str, den: str) -> str:
    return f"CASE WHEN {den} > 0 THEN {num} / {den} ELSE 0.0 END"


PAIR_BOOK_SQL = f"""contagens AS (
  SELECT *, {', '.join(
      f'count(*) {_same(col)} AS r_{p}, sum(view_flag) {_same(col)} AS v_{p}, sum(conv_flag) {_same(col)} AS c_{p}'
      for p, col in {**B.SAME_KIND, 'tipo': 'offer_type'}.items())},
    {', '.join(f'sum({c}) {INST_BEFORE} AS r_{c}, sum({c} * conv_flag) {INST_BEFORE} AS c_{c}' for c in CHANNELS)},
    max(start_t) {_same('offer_id')} AS last_start
  FROM inst
), taxas AS (
  SELECT *, {', '.join(f"{_rate(f'c_{c}', f'r_{c}')} AS taxa_{c}" for c in CHANNELS)} FROM contagens
), segunda AS (
  SELECT cliente_id, offer_id, t AS t2 FROM conv QUALIFY row_number() OVER (PARTITION BY cliente_id, offer_id ORDER BY t DESC) = 2
), book_cliente_oferta AS (
  SELECT {KEYS.replace('t AS time', 'start_t AS time')}, {_rate('v_tipo', 'r_tipo')} AS taxa_visualizacao_historica_tipo,
    {_rate('c_tipo', 'r_tipo')} AS taxa_conversao_historica_tipo, {_rate('v_oferta', 'r_oferta')} AS taxa_visualizacao_historica_oferta,
    {_rate('c_oferta', 'r_oferta')} AS taxa_conversao_historica_oferta,
    {', '.join(f'taxa_{c} AS taxa_conversao_historica_canal_{c}' for c in CHANNELS)},
    {_rate('(web * taxa_web + email * taxa_email + mobile * taxa_mobile + social * taxa_social)', '(web + email + mobile + social)')} AS afinidade_canais_conv,
    {_rate('c_dur', 'r_dur')} AS taxa_conversao_historica_bucket_duracao, {_rate('c_disc', 'r_disc')} AS taxa_conversao_historica_bucket_desconto,
    {_rate('c_min', 'r_min')} AS taxa_conversao_historica_bucket_minimo, r_oferta AS n_instancias_anteriores_mesma_oferta,
    CAST(c_oferta AS BIGINT) AS n_conversoes_validas_anteriores_mesma, start_t - last_start AS dias_desde_ultima_oferta_mesma,
    start_t - t2 AS dias_desde_ultima_conversao_valida_mesma
  FROM taxas LEFT JOIN segunda USING (cliente_id, offer_id) {LAST})"""


def rounded_sql(source: str, columns: list[str] | None = None) -> str:
    return f"SELECT * REPLACE ({', '.join(f'round({c}, 6) AS {c}' for c in columns)}) FROM {source}" if columns else f"SELECT * FROM {source}"


BOOK_QUERIES = {
    "b1_book_perfil": ("profile", (*BOOKS, PROFILE_BOOK_SQL), "book_perfil", ["historico_conversao"]),
    "b2_book_compra": ("purchases", (*BOOKS, PURCHASE_BOOK_SQL), "book_compra", ["media_tempo_entre_transacoes"]),
    "b3_book_interacao": ("interaction", (*BOOKS, FIRSTS_SQL, INTERACTION_BOOK_SQL), "book_interacao",
                          ["tempo_medio_visualizacao", "tempo_medio_conversao", "taxa_visualizacao", "taxa_conversao"]),
    "b4_book_oferta": ("offer", (*BOOKS, OFFER_BOOK_SQL), "book_oferta", None),
    "b5_book_recencia_freq": ("recency", (*BOOKS, RECENCY_BOOK_SQL), "book_recencia", None),
    "b6_book_comunicacao": ("communication", (*BOOKS, COMMUNICATION_BOOK_SQL), "book_comunicacao",
                            [f"{c}_ratio_historico" for c in CHANNELS]),
    "b7_book_cliente_oferta": ("pair", (*BOOKS, FIRSTS_SQL, INSTANCES_SQL, PAIR_BOOK_SQL), "book_cliente_oferta", [
        "taxa_visualizacao_historica_tipo", "taxa_conversao_historica_tipo", "taxa_visualizacao_historica_oferta",
        "taxa_conversao_historica_oferta", *[f"taxa_conversao_historica_canal_{c}" for c in CHANNELS], "afinidade_canais_conv",
        "taxa_conversao_historica_bucket_duracao", "taxa_conversao_historica_bucket_desconto", "taxa_conversao_historica_bucket_minimo"]),
}


# Books that read the attributed conversions twice write them once.
STAGED = ("interaction", "pair")


def _register_book(name: str, method: str, ctes: tuple, source: str, doubles: list[str] | None) -> None:
    sql = fx.with_(*ctes) + rounded_sql(source, doubles)

    @query(name, sql)
    def ordinary(spark, sf):
        return rounded(getattr(campaign(spark, sf, stage=method in STAGED), method)())

    if method != "offer":
        # The same rows with histories above 60 rows cut into ranges.
        @query(f"{name}_hot_entities", sql)
        def sliced(spark, sf):
            return rounded(getattr(campaign(spark, sf, hot_rows=60, stage=method in STAGED), method)())


for _name, _spec in BOOK_QUERIES.items():
    _register_book(_name, *_spec)


@query("b8_instances", fx.with_(*BOOKS, FIRSTS_SQL, INSTANCES_SQL) + """
SELECT concat_ws('_', cliente_id, offer_id) AS ID, * EXCLUDE (end_t) FROM inst""")
def b8(spark, sf):
    return campaign(spark, sf).instances()


@query("b9_timeline", fx.with_(*BOOKS) + """
SELECT cliente_id, offer_id, event, t, k AS is_conv_valid, r AS is_offer_received, v AS is_offer_viewed,
  c AS is_offer_completed, x AS is_transaction FROM wide""")
def b9(spark, sf):
    c = campaign(spark, sf)
    return B.timeline(c.log, c.conversions(), frames=c.frames)


ALL_BOOKS = (*BOOKS, PROFILE_BOOK_SQL, PURCHASE_BOOK_SQL, FIRSTS_SQL, INTERACTION_BOOK_SQL, OFFER_BOOK_SQL, RECENCY_BOOK_SQL,
             COMMUNICATION_BOOK_SQL, INSTANCES_SQL, PAIR_BOOK_SQL)
ALL_DOUBLES = [d for _, _, _, doubles in BOOK_QUERIES.values() for d in (doubles or [])]
FULL_SQL = """book_full AS (
  SELECT a.*, b.* EXCLUDE (ID, cliente_id, offer_id, time_since_test_start), c.* EXCLUDE (ID, cliente_id, offer_id, time_since_test_start),
    d.* EXCLUDE (ID, cliente_id, offer_id, time_since_test_start),
    e.dias_desde_ultima_transacao AS recencia__dias_desde_ultima_transacao,
    e.* EXCLUDE (ID, cliente_id, offer_id, time_since_test_start, dias_desde_ultima_transacao),
    f.* EXCLUDE (ID, cliente_id, offer_id, time_since_test_start), g.* EXCLUDE (ID, cliente_id, offer_id, time_since_test_start)
  FROM book_perfil a LEFT JOIN book_compra b ON a.ID = b.ID LEFT JOIN book_interacao c ON a.ID = c.ID LEFT JOIN book_oferta d ON a.ID = d.ID
  LEFT JOIN book_recencia e ON a.ID = e.ID LEFT JOIN book_comunicacao f ON a.ID = f.ID LEFT JOIN book_cliente_oferta g ON a.ID = g.ID)"""


@query("b10_book_full", fx.with_(*ALL_BOOKS, FULL_SQL) + rounded_sql("book_full", ALL_DOUBLES))
def b10(spark, sf):
    return rounded(campaign(spark, sf, stage=True).book_full())


@query("b10_book_full_hot_entities", fx.with_(*ALL_BOOKS, FULL_SQL) + rounded_sql("book_full", ALL_DOUBLES))
def b10_hot(spark, sf):
    return rounded(campaign(spark, sf, stage=True, hot_rows=60).book_full())


BASE_SQL = """base AS (
  SELECT p.ID, p.target_sucesso, b.* EXCLUDE (ID) FROM publico_com_target p LEFT JOIN book_full b ON p.ID = b.ID)"""
MODELLING = (*ALL_BOOKS, FULL_SQL, LABEL_SQL, BASE_SQL)


@query("b11_modelling_base", fx.with_(*MODELLING) + rounded_sql("base", ALL_DOUBLES))
def b11(spark, sf):
    return rounded(campaign(spark, sf, stage=True).modelling_base())
