"""Sources, projections, joins, aggregates, windows, sorts and scalar functions, each on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql import functions as F

from waymark.functions import columns as C
from waymark.operators import attribution as A
from waymark.operators import books as K
from waymark.operators import dataset as D
from waymark.operators import events as E
from waymark.operators import prep as M
from waymark.operators import tables as B
from waymark.operators.explore import histograms
from waymark.operators.evaluate import roc_auc, score_counts
from waymark.operators.frames import latest, total
from waymark.operators.ordered import bin_of, column_quantiles, distinct_edges, equal_bin_of, running
from waymark.operators.stability import reference_edges
from waymark.plans import fixtures as fx
from waymark.plans.campaign_queries import ATTRIBUTION, BASE, BOOKS, FIRSTS_SQL, LABELLED, campaign, rounded
from waymark.plans.evaluation_queries import curve_sql
from waymark.plans.registry import query
from waymark.session import scratch_path
from waymark.sources import files as S
from waymark.spec import ENTITY, EVENT, ITEM, TIME

SQL = fx.with_(fx.MIXED_SQL)
LOG = fx.with_(*BASE)


def log(spark: SparkSession, sf: str) -> DataFrame:
    return campaign(spark, sf).log


# ---- sources and sinks: written from the given tables, then read back ----------------------

@query("s1_read_offers_json", fx.with_(fx.CATALOGUE_SQL) + "SELECT * EXCLUDE (id), id AS offer_id FROM cat")
def s1(spark, sf):
    path = scratch_path(spark, "offers-json")
    fx.catalogue(spark, sf).write.json(path)
    return S.read_offers_json(spark, path)


@query("s2_read_profile_json", fx.with_(fx.PROFILE_SQL) + "SELECT profile_id, registered_on, age, gender, credit_card_limit FROM fx_profile")
def s2(spark, sf):
    path = scratch_path(spark, "profile-json")
    fx.profile(spark, sf).withColumnRenamed("profile_id", "id").withColumn("ignored", F.lit(1)).write.json(path)
    return S.read_profile_json(spark, path)


@query("s3_read_transactions_json", fx.with_(fx.TRANSACTIONS_SQL) + "SELECT profile_id, offer_id, event, time_since_test_start FROM fx_transactions")
def s3(spark, sf):
    path = scratch_path(spark, "transactions-json")
    raw = fx.transactions(spark, sf)
    value = F.when(F.col("offer_id").isNotNull(), F.create_map(F.lit("offer id"), F.col("offer_id"))).otherwise(
        F.create_map(F.lit("amount"), F.lit("1.5")))
    raw.select(F.col("profile_id").alias("account_id"), "event", "time_since_test_start", value.alias("value")).write.json(path)
    return S.read_transactions_json(spark, path)


@query("s4_read_csv", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def s4(spark, sf):
    path = scratch_path(spark, "customer-csv")
    S.write_csv(fx.table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal"), path)
    return S.read_csv(spark, path, "c_custkey long, c_name string, c_acctbal double")


@query("s5_read_columns", "SELECT DISTINCT column_name AS coluna FROM (DESCRIBE orders)")
def s5(spark, sf):
    return spark.createDataFrame([(c,) for c in S.read_columns(spark, f"{sf}/orders.parquet")], "coluna string")


@query("s6_write_csv", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def s6(spark, sf):
    path = scratch_path(spark, "status-csv")
    S.write_csv(B.count_by(fx.table(spark, sf, "orders"), "o_orderstatus", name="n"), path, single_file=True)
    return S.read_csv(spark, path, "o_orderstatus string, n long")


@query("s6_write_table", "SELECT o_orderkey, o_totalprice FROM orders")
def s6_table(spark, sf):
    path = scratch_path(spark, "orders-parquet")
    S.write_table(fx.table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), path)
    return spark.read.parquet(path)


@query("s7_save_load_prep", SQL + "SELECT 'tax' AS variavel, round(median(tax), 6) AS mediana FROM m")
def s7(spark, sf):
    path = scratch_path(spark, "prep")
    S.save_json(spark, M.fit_missing(fx.mixed(spark, sf), [M.Rule("tax", "numérica_contínua", "mediana")]), path)
    return rounded(spark.createDataFrame(list(S.load_json(spark, path)["medianas"].items()), "variavel string, mediana double"))


@query("s8_save_load_types", "SELECT column_name AS coluna, column_type AS tipo FROM (DESCRIBE lineitem)")
def s8(spark, sf):
    path = scratch_path(spark, "schema")
    S.save_schema(fx.table(spark, sf, "lineitem"), path)
    # Spark's type names and the SQL names of the same types.
    names = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE"}
    return spark.createDataFrame([(f.name, names[f.dataType.simpleString()]) for f in S.load_schema(spark, path)], "coluna string, tipo string")


@query("s9_preview", "SELECT c_custkey FROM customer ORDER BY c_custkey LIMIT 5")
def s9(spark, sf):
    return S.preview(fx.table(spark, sf, "customer").select("c_custkey").orderBy("c_custkey"), 5)


@query("s10_nan_to_null", "SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS bal FROM customer")
def s10(spark, sf):
    nan = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).otherwise(F.lit(float("nan")))
    return S.nan_to_null(fx.table(spark, sf, "customer").select("c_custkey", nan.alias("bal")))


# ---- projections, filters and predicates ---------------------------------------------------

@query("p1_project", "SELECT l_orderkey, l_quantity FROM lineitem")
def p1(spark, sf):
    return fx.table(spark, sf, "lineitem").select(*["l_orderkey", "l_quantity"])


@query("p2_rename", "SELECT c_custkey AS cliente_id, c_name AS nome FROM customer")
def p2(spark, sf):
    return fx.table(spark, sf, "customer").select("c_custkey", "c_name").withColumnsRenamed({"c_custkey": "cliente_id", "c_name": "nome"})


@query("p3_computed_column", "SELECT l_orderkey, l_linenumber, l_partkey, round(l_extendedprice * (1 - l_discount), 4) AS net, l_quantity > 25 AS big FROM lineitem")
def p3(spark, sf):
    df = fx.table(spark, sf, "lineitem").withColumns({
        "net": F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4), "big": F.col("l_quantity") > 25})
    return df.select("l_orderkey", "l_linenumber", "l_partkey", "net", "big")


@query("p4_drop", "SELECT * EXCLUDE (o_totalprice, o_orderdate) FROM orders")
def p4(spark, sf):
    return fx.table(spark, sf, "orders").drop("o_totalprice", "o_orderdate")


@query("p5_qualified_star", "SELECT c.*, n.n_name FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey")
def p5(spark, sf):
    c, n = fx.table(spark, sf, "customer").alias("l"), fx.table(spark, sf, "nation").alias("r")
    return c.join(n, F.col("l.c_nationkey") == F.col("r.n_nationkey")).select("l.*", "r.n_name")


@query("p6_equality_filter", LOG + "SELECT cliente_id, offer_id, t FROM ev WHERE event = 'offer viewed'")
def p6(spark, sf):
    return log(spark, sf).filter(F.col(EVENT) == "offer viewed").select(ENTITY, ITEM, TIME)


@query("p7_null_filters", fx.with_(fx.PROFILE_SQL) + "SELECT profile_id, gender, credit_card_limit FROM fx_profile WHERE gender IS NULL AND credit_card_limit IS NOT NULL")
def p7(spark, sf):
    df = fx.profile(spark, sf).select("profile_id", "gender", "credit_card_limit")
    return df.filter(F.col("gender").isNull() & F.col("credit_card_limit").isNotNull())


@query("p8_between", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice BETWEEN 1000 AND 50000")
def p8(spark, sf):
    return fx.table(spark, sf, "orders").select("o_orderkey", "o_totalprice").filter(F.col("o_totalprice").between(1000, 50000))


@query("p9_compound", "SELECT o_orderkey FROM orders WHERE (o_orderstatus = 'F' OR o_orderpriority = '1-URGENT') AND NOT o_totalprice > 100000")
def p9(spark, sf):
    urgent = (F.col("o_orderstatus") == "F") | (F.col("o_orderpriority") == "1-URGENT")
    return fx.table(spark, sf, "orders").filter(urgent & ~(F.col("o_totalprice") > 100000)).select("o_orderkey")


@query("p10_threshold", fx.with_(fx.SCORED_SQL) + "SELECT id, CAST(score_1 >= 0.44 AS INTEGER) AS pred FROM fx_scored")
def p10(spark, sf):
    return fx.scored(spark, sf).select("id", C.at_least(F.col("score_1"), 0.44).alias("pred"))


@query("p11_merge_rare", SQL + """, f AS (SELECT store, count(*) AS k FROM m GROUP BY store)
SELECT CASE WHEN k < 700 THEN 'OTHER' ELSE store END AS store, count(*) AS n FROM m JOIN f USING (store) GROUP BY 1""")
def p11(spark, sf):
    return B.count_by(B.merge_rare(fx.mixed(spark, sf).select("store"), "store", 700), "store", name="n")


@query("p12_surviving_columns", SQL + "SELECT id, qty, line, status FROM m")
def p12(spark, sf):
    df = fx.mixed(spark, sf)
    return df.select(*B.without(df.columns, ["price", "tax", "disc", "even", "flag", "store", "safra", "y", "unknown"]))


@query("p13_select_by_type", SQL + "SELECT line, even, safra, y FROM m")
def p13(spark, sf):
    df = fx.mixed(spark, sf)
    return df.select(*B.columns_of(df, "integer"))


@query("p14_align", "SELECT c_name, CAST(NULL AS DOUBLE) AS score, CAST(c_custkey AS VARCHAR) AS c_custkey FROM customer")
def p14(spark, sf):
    schema = T.StructType().add("c_name", "string").add("score", "double").add("c_custkey", "string")
    return B.align(fx.table(spark, sf, "customer"), schema)


# ---- joins --------------------------------------------------------------------------------

@query("j1_enrich_left_joins", LOG + """SELECT e.cliente_id, e.offer_id, e.event, e.t, o.offer_type, o.duration, p.age FROM ev e
LEFT JOIN fx_offers o ON e.offer_id = o.offer_id LEFT JOIN fx_profile p ON e.cliente_id = p.profile_id""")
def j1(spark, sf):
    c = campaign(spark, sf)
    wide = E.with_items(c.log, c.items, ["offer_type", "duration"])
    return E.with_entities(wide, c.entities, ["age"]).select(ENTITY, ITEM, EVENT, TIME, "offer_type", "duration", "age")


@query("j2_join_chain", "SELECT o_orderkey, s.n, s.q, m.p FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n, sum(l_quantity) AS q FROM lineitem GROUP BY 1) s ON o_orderkey = s.l_orderkey "
       "LEFT JOIN (SELECT l_orderkey, max(l_extendedprice) AS p FROM lineitem GROUP BY 1) m ON o_orderkey = m.l_orderkey")
def j2(spark, sf):
    lines = fx.table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "ID")
    a = lines.groupBy("ID").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("q"))
    b = lines.groupBy("ID").agg(F.max("l_extendedprice").alias("p"))
    base = fx.table(spark, sf, "orders").select(F.col("o_orderkey").alias("ID"))
    return D.join_books({"base": base, "a": a, "b": b}).withColumnRenamed("ID", "o_orderkey")


@query("j3_join_on_id", "SELECT c_custkey, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey")
def j3(spark, sf):
    nation = fx.table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return fx.table(spark, sf, "customer").join(nation, "c_nationkey", "left").select("c_custkey", "n_name")


@query("j4_two_key_join_fill", fx.with_(*LABELLED) + "SELECT cliente_id, offer_id, qtd_matches FROM publico_com_target")
def j4(spark, sf):
    return campaign(spark, sf).labelled_audience().select(ENTITY, ITEM, "qtd_matches")


@query("j5_exact_time_join", LOG + """SELECT c.cliente_id, c.t FROM ev c JOIN ev x ON c.cliente_id = x.cliente_id AND c.t = x.t
WHERE c.event = 'offer completed' AND x.event = 'transaction'""")
def j5(spark, sf):
    ev = log(spark, sf)
    done, bought = E.completions(ev), E.purchases(ev)
    return done.withColumnRenamed("t_cmplt", TIME).join(bought.withColumnRenamed("t_tx", TIME), [ENTITY, TIME])


@query("j6_interval_join", fx.with_(*ATTRIBUTION) + "SELECT cliente_id, t, offer_id, start_t FROM elig")
def j6(spark, sf):
    c = campaign(spark, sf)
    windows = E.received_windows(c.log, c.items).select(ENTITY, ITEM, "start_t", "end_t")
    return A.eligible_offers(E.conversion_pairs(c.log), windows, c.frames).select(ENTITY, TIME, ITEM, "start_t")


@query("j7_as_of_join", LOG + """SELECT r.cliente_id, r.offer_id, r.t AS start_t, max(v.t) AS t_view FROM ev r LEFT JOIN ev v ON v.event = 'offer viewed'
AND v.cliente_id = r.cliente_id AND v.offer_id = r.offer_id AND v.t <= r.t WHERE r.event = 'offer received' GROUP BY ALL""")
def j7(spark, sf):
    ev = log(spark, sf)
    anchors = E.received(ev).select(ENTITY, ITEM, TIME, F.col(TIME).alias("start_t"))
    return A.attach_views(anchors, E.views(ev)).select(ENTITY, ITEM, "start_t", "t_view")


@query("j8_latest_earlier_mean", fx.with_(*BOOKS, FIRSTS_SQL, """mv AS (SELECT cliente_id, start_t,
  avg(first_t_view - start_t) OVER (PARTITION BY cliente_id ORDER BY start_t, offer_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS v FROM firsts)""") + """
SELECT f.cliente_id, f.offer_id, f.start_t, round(max(m.v), 6) AS tempo FROM firsts f LEFT JOIN mv m ON m.cliente_id = f.cliente_id AND m.start_t < f.start_t GROUP BY ALL""")
def j8(spark, sf):
    c = campaign(spark, sf)
    times = K.response_times(c.instances(), c.frames)
    return rounded(times.select(ENTITY, ITEM, "start_t", F.col("tempo_medio_visualizacao").alias("tempo")))


@query("j9_conversions_before", fx.with_(*ATTRIBUTION) + """SELECT r.cliente_id, r.offer_id, r.start_t, (SELECT count(*) FROM conv q WHERE q.cliente_id = r.cliente_id AND q.t < r.start_t) AS n FROM recv r""")
def j9(spark, sf):
    return campaign(spark, sf).history().select(ENTITY, ITEM, F.col(TIME).alias("start_t"), F.coalesce("n_converted", F.lit(0)).alias("n"))


@query("j10_tie_counts", fx.with_(*ATTRIBUTION) + "SELECT cliente_id, t, offer_id, n_same_score FROM placed WHERE rank_elig = 1")
def j10(spark, sf):
    c = campaign(spark, sf)
    windows = E.received_windows(c.log, c.items).select(ENTITY, ITEM, "start_t", "end_t")
    seen = A.attach_views(A.eligible_offers(E.conversion_pairs(c.log), windows, c.frames), E.views(c.log), c.frames)
    return A.detect_ambiguity(A.rank_candidates(seen)).filter("rank_elig = 1").select(ENTITY, TIME, ITEM, "n_same_score")


@query("j11_first_view_join", fx.with_(*BOOKS, FIRSTS_SQL) + "SELECT cliente_id, offer_id, start_t, first_t_view, first_t_conv_valid FROM firsts")
def j11(spark, sf):
    return campaign(spark, sf).instances().select(ENTITY, ITEM, "start_t", "first_t_view", "first_t_conv_valid")


@query("j12_flag_join", fx.with_(*BOOKS) + "SELECT cliente_id, t, event, offer_id, k AS is_conv_valid FROM wide")
def j12(spark, sf):
    c = campaign(spark, sf)
    return K.timeline(c.log, c.conversions(), frames=c.frames).select(ENTITY, TIME, EVENT, ITEM, "is_conv_valid")


@query("j13_previous_conversion_join", fx.with_(*BOOKS) + """SELECT r.cliente_id, r.offer_id, r.start_t, (SELECT t FROM conv q WHERE q.cliente_id = r.cliente_id
  AND q.offer_id = r.offer_id ORDER BY t DESC LIMIT 1 OFFSET 1) AS last_t_conv_same_offer FROM recv r""")
def j13(spark, sf):
    c = campaign(spark, sf)
    starts = E.received(c.log).select(ENTITY, ITEM, F.col(TIME).alias("start_t"))
    return starts.join(K.previous_conversion(c.conversions()), [ENTITY, ITEM], "left")


@query("j16_count_then_lookup", LOG + """SELECT offer_id, qtd, offer_type, duration FROM (SELECT offer_id, count(*) AS qtd FROM ev WHERE event = 'offer received' GROUP BY 1)
LEFT JOIN fx_offers USING (offer_id)""")
def j16(spark, sf):
    c = campaign(spark, sf)
    return E.with_items(B.count_by(E.received(c.log), ITEM, name="qtd"), c.items, ["offer_type", "duration"])


# ---- aggregates ---------------------------------------------------------------------------

@query("a1_table_profile", "SELECT count(*) AS linhas, 6 AS colunas, count(DISTINCT o_custkey) AS ids_distintos FROM orders")
def a1(spark, sf):
    return B.table_profile(fx.table(spark, sf, "orders"), "o_custkey")


@query("a2_count_one_key", "SELECT event_type, count(*) AS count FROM events GROUP BY 1")
def a2(spark, sf):
    return B.count_by(fx.table(spark, sf, "events"), "event_type")


@query("a3_count_many_keys", "SELECT l_returnflag, l_linestatus, count(*) AS count FROM lineitem GROUP BY 1, 2")
def a3(spark, sf):
    return B.count_by(fx.table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus")


@query("a4_count_matches", fx.with_(*LABELLED) + "SELECT cliente_id, offer_id, qtd_matches FROM rotulo")
def a4(spark, sf):
    return A.label_pairs(campaign(spark, sf).conversions()).select(ENTITY, ITEM, "qtd_matches")


@query("a5_min_per_pair", LOG + "SELECT cliente_id, offer_id, min(t) AS first_t_view FROM ev WHERE event = 'offer viewed' GROUP BY 1, 2")
def a5(spark, sf):
    return E.views(log(spark, sf)).groupBy(ENTITY, ITEM).agg(F.min("t_view").alias("first_t_view"))


@query("a6_gap_mean_and_days", LOG + """SELECT cliente_id, round(avg(g), 6) AS media_tempo_entre_transacoes, count(DISTINCT floor(t)) AS transacoes_distintas_dias
FROM (SELECT *, t - lag(t) OVER (PARTITION BY cliente_id ORDER BY t) AS g FROM ev WHERE event = 'transaction') GROUP BY 1""")
def a6(spark, sf):
    return rounded(K.purchase_rhythm(log(spark, sf)))


@query("a7_max_per_anchor", LOG + """SELECT a.cliente_id, a.offer_id, a.t, max(b.t) AS last_tx FROM ev a LEFT JOIN ev b ON b.cliente_id = a.cliente_id AND b.event = 'transaction' AND b.t < a.t
WHERE a.event = 'offer received' GROUP BY ALL""")
def a7(spark, sf):
    c = campaign(spark, sf)
    bought = F.when(F.col(EVENT) == "transaction", F.col(TIME))
    line = c.frames.earlier(c.frames.gather(c.log, ENTITY), [ENTITY], K.HISTORY_ORDER, {"last_tx": latest(bought)})
    return E.received(c.frames.tick_start(line, [ENTITY], K.HISTORY_ORDER, {"last_tx": "last_tx"})).select(ENTITY, ITEM, TIME, "last_tx")


@query("a8_count_right_side", "SELECT c_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1")
def a8(spark, sf):
    # Counted before the join: each customer meets one row instead of all of its orders.
    counts = fx.table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("o_orderkey").alias("n"))
    return fx.table(spark, sf, "customer").select("c_custkey").join(counts, "c_custkey", "left").na.fill({"n": 0})


@query("a9_distinct", LOG + "SELECT * FROM ev")
def a9(spark, sf):
    return log(spark, sf)


@query("a10_describe", SQL + "SELECT 'qty' AS variavel, count(qty) AS count, round(avg(qty), 4) AS mean, round(stddev_samp(qty), 4) AS std, min(qty) AS min, "
       "quantile_cont(qty, 0.25) AS p25, quantile_cont(qty, 0.5) AS p50, quantile_cont(qty, 0.75) AS p75, max(qty) AS max FROM m")
def a10(spark, sf):
    return rounded(B.describe(fx.mixed(spark, sf), ["qty"]), 4)


@query("a11_value_counts", SQL + "SELECT flag, count(*) AS n, round(count(*) / (SELECT count(*) FROM m), 6) AS share FROM m GROUP BY flag")
def a11(spark, sf):
    return rounded(B.value_counts(fx.mixed(spark, sf), "flag"))


@query("a12_distinct_per_group", "SELECT l_returnflag, count(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY 1")
def a12(spark, sf):
    return fx.table(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.count_distinct("l_suppkey").alias("n"))


@query("a13_exact_percentiles", "SELECT unnest([0.1, 0.25, 0.5, 0.9])::DOUBLE AS prob, round(unnest(quantile_cont(l_extendedprice, [0.1, 0.25, 0.5, 0.9])), 6) AS q FROM lineitem")
def a13(spark, sf):
    probs = [0.1, 0.25, 0.5, 0.9]
    found = column_quantiles(fx.table(spark, sf, "lineitem"), ["l_extendedprice"], probs)["l_extendedprice"]
    return rounded(spark.createDataFrame(list(zip(probs, found)), "prob double, q double"))


@query("a14_statistics_by_class", SQL + "SELECT y, round(avg(price), 4) AS price_mean, round(median(price), 4) AS price_median, round(stddev_samp(price), 4) AS price_std, "
       "round(min(price), 4) AS price_min, round(max(price), 4) AS price_max FROM m GROUP BY y")
def a14(spark, sf):
    return rounded(B.by_target(fx.mixed(spark, sf), ["price"], "y"), 4)


@query("a15_contingency", SQL + "SELECT store, count(*) FILTER (y = 0) AS y_0, count(*) FILTER (y = 1) AS y_1 FROM m GROUP BY store")
def a15(spark, sf):
    return B.contingency(fx.mixed(spark, sf), "store", "y", [0, 1])


@query("a16_pivoted_mean", SQL + """, g AS (SELECT line, status, avg(y) AS r, count(*) AS n FROM m GROUP BY ALL)
SELECT line, round(max(r) FILTER (status = 'F' AND n >= 4300), 6) AS "F", round(max(r) FILTER (status = 'O' AND n >= 4300), 6) AS "O" FROM g GROUP BY line""")
def a16(spark, sf):
    return rounded(B.crossed_rate(fx.mixed(spark, sf), "line", "status", "y", 4300))


@query("a17_period_rates", SQL + "SELECT CAST(safra AS VARCHAR) AS safra, count(y) AS contagem, sum(y)::BIGINT AS pos, (count(y) - sum(y))::BIGINT AS neg, round(avg(y), 6) AS taxa FROM m GROUP BY 1")
def a17(spark, sf):
    return rounded(B.period_rates(fx.mixed(spark, sf), "safra", "y", ("contagem", "pos", "neg", "taxa")))


@query("a18_best_row", "SELECT l_suppkey, l_orderkey, l_extendedprice FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey) = 1")
def a18(spark, sf):
    return B.best_row(fx.table(spark, sf, "lineitem").select("l_suppkey", "l_orderkey", "l_extendedprice"), ["l_suppkey"], "l_extendedprice", "l_orderkey")


@query("a19_confusion_counts", fx.with_(fx.SCORED_SQL) + """SELECT count(*) FILTER (score_1 >= 0.5 AND y = 1) AS tp, count(*) FILTER (score_1 >= 0.5 AND y = 0) AS fp,
  count(*) FILTER (score_1 < 0.5 AND y = 0) AS tn, count(*) FILTER (score_1 < 0.5 AND y = 1) AS fn FROM fx_scored""")
def a19(spark, sf):
    hit, event = F.col("score_1") >= 0.5, F.col("y") == 1
    return fx.scored(spark, sf).agg(
        F.count_if(hit & event).alias("tp"), F.count_if(hit & ~event).alias("fp"), F.count_if(~hit & ~event).alias("tn"), F.count_if(~hit & event).alias("fn"))


@query("a20_null_share", SQL + "SELECT 'tax' AS variavel, count(*) AS linhas, count(*) - count(tax) AS nulos, round(1 - count(tax) / count(*), 6) AS share FROM m "
       "UNION ALL SELECT 'flag', count(*), count(*) - count(flag), round(1 - count(flag) / count(*), 6) FROM m")
def a20(spark, sf):
    return rounded(B.null_share(fx.mixed(spark, sf), ["tax", "flag"]))


@query("a21_modal_share", SQL + "SELECT 'flag' AS variavel, round(max(n) / sum(n), 6) AS frac_modal FROM (SELECT flag, count(*) AS n FROM m GROUP BY flag)")
def a21(spark, sf):
    return rounded(B.modal_share(fx.mixed(spark, sf), ["flag"]))


@query("a22_type_histogram", "SELECT CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' ELSE 'timestamp_ntz' END AS tipo, "
       "count(*) AS colunas FROM (DESCRIBE lineitem) GROUP BY 1")
def a22(spark, sf):
    return D.column_types(fx.table(spark, sf, "lineitem"))


# ---- windows ------------------------------------------------------------------------------

ORDERED = "PARTITION BY cliente_id ORDER BY t, event, offer_id NULLS FIRST"
ROWS = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"


@query("w1_latest_per_pair", LOG + "SELECT cliente_id, offer_id, max(t) AS time_since_test_start FROM ev WHERE event = 'offer viewed' GROUP BY 1, 2")
def w1(spark, sf):
    df = E.views(log(spark, sf)).select(C.pair_key().alias("ID"), ENTITY, ITEM, F.col("t_view").alias("time_since_test_start"))
    return K.latest_pairs(df).drop("ID")


@query("w2_candidate_rank", fx.with_(*ATTRIBUTION) + "SELECT cliente_id, t, offer_id, start_t FROM placed WHERE rank_elig = 1")
def w2(spark, sf):
    c = campaign(spark, sf)
    windows = E.received_windows(c.log, c.items).select(ENTITY, ITEM, "start_t", "end_t")
    seen = A.attach_views(A.eligible_offers(E.conversion_pairs(c.log), windows, c.frames), E.views(c.log), c.frames)
    return A.rank_candidates(seen).filter("rank_elig = 1").select(ENTITY, TIME, ITEM, "start_t")


def _history(column: str, alias: str):
    def run(spark, sf):
        return campaign(spark, sf).history().select(ENTITY, ITEM, TIME, F.col(column).alias(alias))
    return run


query("w3_running_counts", LOG + f"SELECT cliente_id, offer_id, t, n FROM (SELECT *, CAST(sum(CAST(event = 'offer received' AS INTEGER)) OVER ({ORDERED} {ROWS}) AS BIGINT) AS n FROM ev) "
      "WHERE event = 'offer received'")(_history("n_received", "n"))
query("w4_last_time_seen", LOG + f"SELECT cliente_id, offer_id, t, l FROM (SELECT *, max(CASE WHEN event = 'transaction' THEN t END) OVER ({ORDERED} {ROWS}) AS l FROM ev) "
      "WHERE event = 'offer received'")(_history("last_purchase", "l"))
query("w6_moving_sums", LOG + """SELECT cliente_id, offer_id, t, n FROM (SELECT *, CAST(sum(CAST(event = 'transaction' AS INTEGER)) OVER (PARTITION BY cliente_id
  ORDER BY CAST(t * 86400 AS BIGINT) RANGE BETWEEN 604800 PRECEDING AND 1 PRECEDING) AS BIGINT) AS n FROM ev) WHERE event = 'offer received'""")(_history("qtd_transacoes_7d", "n"))


@query("w5_lag", LOG + "SELECT cliente_id, t, lag(t) OVER (PARTITION BY cliente_id ORDER BY t) AS lag_t FROM ev WHERE event = 'transaction'")
def w5(spark, sf):
    c = campaign(spark, sf)
    # In time order the previous time is the largest earlier one.
    return c.frames.earlier(E.purchases(c.log).withColumnRenamed("t_tx", TIME), [ENTITY], [TIME], {"lag_t": latest(F.col(TIME))})


@query("w7_composite_key_counts", fx.with_(*BOOKS, FIRSTS_SQL) + f"""SELECT cliente_id, offer_id, start_t, count(*) OVER (PARTITION BY cliente_id, offer_type ORDER BY start_t, offer_id {ROWS}) AS rcv_tipo,
  CAST(sum(CAST(first_t_view IS NOT NULL AS INTEGER)) OVER (PARTITION BY cliente_id, offer_type ORDER BY start_t, offer_id {ROWS}) AS BIGINT) AS view_tipo FROM firsts""")
def w7(spark, sf):
    c = campaign(spark, sf)
    return K.composite_counts(c.instances(), c.frames).select(ENTITY, ITEM, "start_t", "rcv_tipo", "view_tipo")


@query("w8_running_mean", fx.with_(*BOOKS, FIRSTS_SQL) + f"""SELECT cliente_id, offer_id, start_t, round(avg(first_t_view - start_t) OVER (PARTITION BY cliente_id ORDER BY start_t, offer_id {ROWS}), 6) AS media FROM firsts""")
def w8(spark, sf):
    c = campaign(spark, sf)
    gap = F.col("first_t_view") - F.col("start_t")
    means = c.frames.earlier(
        c.instances(), [ENTITY], K.INSTANCE_ORDER, {"s": total(gap), "n": total(gap.isNotNull().cast("int"))}, time="start_t")
    return rounded(means.select(ENTITY, ITEM, "start_t", C.rate(F.col("s"), F.col("n"), None).alias("media")))


@query("w9_last_start_same_item", LOG + "SELECT cliente_id, offer_id, t, lag(t) OVER (PARTITION BY cliente_id, offer_id ORDER BY t) AS last_start FROM ev WHERE event = 'offer received'")
def w9(spark, sf):
    c = campaign(spark, sf)
    return c.frames.earlier(E.received(c.log).select(ENTITY, ITEM, TIME), [ENTITY, ITEM], [TIME], {"last_start": latest(F.col(TIME))})


@query("w10_second_latest_conversion", fx.with_(*ATTRIBUTION) + """SELECT cliente_id, offer_id, max(CASE WHEN rn = 2 THEN t END) AS last_t_conv_same_offer
FROM (SELECT *, row_number() OVER (PARTITION BY cliente_id, offer_id ORDER BY t DESC) AS rn FROM conv) GROUP BY 1, 2""")
def w10(spark, sf):
    return K.previous_conversion(campaign(spark, sf).conversions())


@query("w11_cumulative_class_shares", fx.with_(fx.SCORED_SQL, curve_sql()) + "SELECT dataset, round(s, 6) AS score, CAST(pos_to AS BIGINT) AS pos_to, CAST(neg_to AS BIGINT) AS neg_to FROM curva")
def w11(spark, sf):
    counts = score_counts(fx.scored(spark, sf), "score_1", "y", ["dataset"])
    return rounded(running(counts, ["dataset"], "score", ["pos", "neg"]).select("dataset", "score", "pos_to", "neg_to"))


@query("w12_band_totals", SQL + "SELECT status, line, n, CAST(sum(n) OVER (PARTITION BY status ORDER BY line) AS BIGINT) AS n_acumulado FROM (SELECT status, line, count(*) AS n FROM m GROUP BY 1, 2)")
def w12(spark, sf):
    return B.running_share(B.count_by(fx.mixed(spark, sf), "status", "line", name="n"), ["status"], "line", ["n"])


@query("w13_trapezoid_area", fx.with_(fx.SCORED_SQL, curve_sql()) + """, p1 AS (SELECT dataset, s, (q - neg_to + neg) / q AS x, (p - pos_to + pos) / p AS v FROM curva UNION ALL SELECT DISTINCT dataset, 9.0, 0.0, 0.0 FROM curva)
SELECT dataset, round(sum(a), 6) AS auc FROM (SELECT dataset, (x - lag(x) OVER w) * (v + lag(v) OVER w) / 2 AS a FROM p1 WINDOW w AS (PARTITION BY dataset ORDER BY s DESC)) GROUP BY dataset""")
def w13(spark, sf):
    return rounded(roc_auc(fx.scored(spark, sf), "score_1", "y", ["dataset"]).select("dataset", "auc"))


# ---- sorts and limits ---------------------------------------------------------------------

@query("o1_order_by", "SELECT n_name FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY n_name ORDER BY n_name")
def o1(spark, sf):
    used = fx.table(spark, sf, "customer").select(F.col("c_nationkey").alias("n_nationkey")).distinct()
    return fx.table(spark, sf, "nation").join(used, "n_nationkey", "left_semi").select("n_name").orderBy("n_name")


@query("o2_order_by_count", "SELECT o_orderpriority, count(*) AS count FROM orders GROUP BY 1")
def o2(spark, sf):
    return B.count_by(fx.table(spark, sf, "orders"), "o_orderpriority").orderBy(F.desc("count"))


@query("o3_mixed_direction", fx.with_(fx.SCORED_SQL) + "SELECT dataset, safra, max(score_1) AS top FROM fx_scored GROUP BY 1, 2")
def o3(spark, sf):
    return fx.scored(spark, sf).groupBy("dataset", "safra").agg(F.max("score_1").alias("top")).orderBy("dataset", F.desc("safra"))


@query("o4_top_counts", "SELECT o_custkey, count(*) AS count FROM orders GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def o4(spark, sf):
    return B.top_counts(fx.table(spark, sf, "orders"), ["o_custkey"], 10)


@query("o5_order_by_absolute", "SELECT c_custkey, c_acctbal FROM customer ORDER BY abs(c_acctbal) DESC, c_custkey LIMIT 20")
def o5(spark, sf):
    return fx.table(spark, sf, "customer").select("c_custkey", "c_acctbal").orderBy(F.desc(F.abs("c_acctbal")), "c_custkey").limit(20)


@query("o6_limit", "SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 7")
def o6(spark, sf):
    return fx.table(spark, sf, "orders").select("o_orderkey").orderBy("o_orderkey").limit(7)


@query("o7_nulls_last", fx.with_(fx.PROFILE_SQL) + "SELECT profile_id, credit_card_limit FROM fx_profile ORDER BY credit_card_limit ASC NULLS LAST, profile_id")
def o7(spark, sf):
    return fx.profile(spark, sf).select("profile_id", "credit_card_limit").orderBy(F.asc_nulls_last("credit_card_limit"), "profile_id")


# ---- set operations -----------------------------------------------------------------------

@query("u1_union_named", "SELECT 'pedidos' AS nome_dataframe, o_orderstatus AS s, count(*) AS n FROM orders GROUP BY 2 UNION ALL SELECT 'linhas', l_linestatus, count(*) FROM lineitem GROUP BY 2")
def u1(spark, sf):
    return B.union_named({
        "pedidos": B.count_by(fx.table(spark, sf, "orders").withColumnRenamed("o_orderstatus", "s"), "s", name="n"),
        "linhas": B.count_by(fx.table(spark, sf, "lineitem").withColumnRenamed("l_linestatus", "s"), "s", name="n"),
    })


def _vote(rule: str):
    def run(spark, sf):
        flags = fx.table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("method"), F.col("l_orderkey").cast("string").alias("feature"))
        return B.vote(flags, rule, 3)
    return run


VOTES = "SELECT CAST(l_orderkey AS VARCHAR) AS feature, count(DISTINCT l_returnflag) AS votes FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_returnflag) >= "
query("u2_vote_intersection", VOTES + "3")(_vote("intersection"))
query("u2_vote_union", VOTES + "1")(_vote("union"))
query("u2_vote_two", VOTES + "2")(_vote("voting"))


@query("u3_distinct", "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def u3(spark, sf):
    return fx.table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus").distinct()


# ---- scalar functions ---------------------------------------------------------------------

@query("f1_array_contains", fx.with_(fx.CATALOGUE_SQL) + "SELECT id, web, email, mobile, social FROM cat")
def f1(spark, sf):
    return S.channel_flags(fx.catalogue(spark, sf)).select("id", "web", "email", "mobile", "social")


@query("f2_case", "SELECT o_orderkey, CASE WHEN o_totalprice < 1000 THEN 'a' WHEN o_totalprice < 100000 THEN 'b' ELSE 'c' END AS faixa FROM orders")
def f2(spark, sf):
    p = F.col("o_totalprice")
    return fx.table(spark, sf, "orders").select("o_orderkey", F.when(p < 1000, "a").when(p < 100000, "b").otherwise("c").alias("faixa"))


@query("f3_year_text", fx.with_(fx.PROFILE_SQL) + "SELECT profile_id, substr(CAST(registered_on AS VARCHAR), 1, 4) AS ano FROM fx_profile")
def f3(spark, sf):
    return fx.profile(spark, sf).select("profile_id", C.year_of(F.col("registered_on")).alias("ano"))


@query("f4_casts", "SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS s, CAST(c_custkey AS DOUBLE) AS d, CAST(trunc(c_acctbal) AS BIGINT) AS l FROM customer")
def f4(spark, sf):
    k = F.col("c_custkey")
    return fx.table(spark, sf, "customer").select(k, k.cast("string").alias("s"), k.cast("double").alias("d"), F.col("c_acctbal").cast("long").alias("l"))


@query("f5_pair_key", LOG + "SELECT DISTINCT concat_ws('_', cliente_id, offer_id) AS ID FROM ev")
def f5(spark, sf):
    return log(spark, sf).select(C.pair_key().alias("ID")).distinct()


@query("f6_lower", "SELECT c_custkey, lower(c_mktsegment) AS s FROM customer")
def f6(spark, sf):
    return fx.table(spark, sf, "customer").select("c_custkey", F.lower("c_mktsegment").alias("s"))


@query("f7_coalesce", fx.with_(fx.PROFILE_SQL) + "SELECT profile_id, coalesce(credit_card_limit, 1e9) AS v FROM fx_profile")
def f7(spark, sf):
    return fx.profile(spark, sf).select("profile_id", F.coalesce("credit_card_limit", F.lit(1e9)).alias("v"))


@query("f8_array", "SELECT l_orderkey, l_linenumber, l_partkey, [l_quantity, l_discount][1] AS q, len([l_quantity, l_discount, l_tax]) AS n FROM lineitem")
def f8(spark, sf):
    a = F.array("l_quantity", "l_discount", "l_tax")
    return fx.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.element_at(a, 1).alias("q"), F.size(a).cast("long").alias("n"))


@query("f9_floor", LOG + "SELECT cliente_id, event, CAST(floor(t) AS BIGINT) AS dia, count(*) AS n FROM ev GROUP BY 1, 2, 3")
def f9(spark, sf):
    return log(spark, sf).groupBy(ENTITY, EVENT, F.floor(TIME).alias("dia")).agg(F.count(F.lit(1)).alias("n"))


@query("f10_arithmetic", "SELECT l_orderkey, l_linenumber, l_partkey, round(l_extendedprice / nullif(l_quantity - 1, 0), 9) AS r FROM lineitem")
def f10(spark, sf):
    return fx.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.round(F.try_divide("l_extendedprice", F.col("l_quantity") - 1), 9).alias("r"))


@query("f11_guarded_rate", "SELECT l_orderkey, l_linenumber, l_partkey, round(CASE WHEN l_tax > 0 THEN l_discount / l_tax ELSE 0.0 END, 6) AS r FROM lineitem")
def f11(spark, sf):
    return rounded(fx.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", C.rate(F.col("l_discount"), F.col("l_tax")).alias("r")))


@query("f12_flag_sum", "SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_tax > 0 AS INTEGER) + CAST(l_discount > 0.05 AS INTEGER) AS n FROM lineitem")
def f12(spark, sf):
    return fx.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", ((F.col("l_tax") > 0).cast("int") + (F.col("l_discount") > 0.05).cast("int")).alias("n"))


@query("f13_expression_text", fx.with_(fx.CATALOGUE_SQL) + "SELECT id, web + email + mobile + social AS canais FROM cat")
def f13(spark, sf):
    return S.channel_flags(fx.catalogue(spark, sf)).select("id", F.expr("web + email + mobile + social").alias("canais"))


@query("f14_literal", "SELECT c_custkey, 1 AS um, 'x' AS texto FROM customer")
def f14(spark, sf):
    return fx.table(spark, sf, "customer").select("c_custkey", F.lit(1).alias("um"), F.lit("x").alias("texto"))


@query("f15_fill_map", fx.with_(fx.PROFILE_SQL) + "SELECT profile_id, coalesce(gender, 'N') AS gender, coalesce(credit_card_limit, 0) AS credit_card_limit FROM fx_profile")
def f15(spark, sf):
    return fx.profile(spark, sf).select("profile_id", "gender", "credit_card_limit").na.fill({"gender": "N", "credit_card_limit": 0.0})


@query("f16_nested_field", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def f16(spark, sf):
    value = F.create_map(F.lit("offer id"), F.get_json_object("props", "$.k"), F.lit("amount"), F.col("value").cast("string"))
    return fx.table(spark, sf, "events").select("event_id", value.alias("value")).select("event_id", F.col("value").getItem("offer id").cast("int").alias("k"))


@query("f17_numeric_coercion", SQL + "SELECT id, TRY_CAST(store AS DOUBLE) AS a, TRY_CAST(substr(store, 2) AS DOUBLE) AS b FROM m")
def f17(spark, sf):
    return fx.mixed(spark, sf).select("id", F.col("store").try_cast("double").alias("a"), F.substring("store", 2, 9).try_cast("double").alias("b"))


@query("f18_clip", fx.with_(fx.PROFILE_SQL) + "SELECT profile_id, CASE WHEN credit_card_limit IS NOT NULL THEN least(greatest(credit_card_limit / 5000 - 0.5, 0.0), 1.0) END AS v FROM fx_profile")
def f18(spark, sf):
    return fx.profile(spark, sf).select("profile_id", C.unit_clip(F.col("credit_card_limit") / 5000 - 0.5).alias("v"))


@query("f19_log", "SELECT o_orderkey, round(ln(o_totalprice), 6) AS v FROM orders WHERE o_totalprice > 0")
def f19(spark, sf):
    return fx.table(spark, sf, "orders").filter("o_totalprice > 0").select("o_orderkey", F.round(F.ln("o_totalprice"), 6).alias("v"))


@query("f20_abs", "SELECT c_custkey, abs(c_acctbal) AS v FROM customer")
def f20(spark, sf):
    return fx.table(spark, sf, "customer").select("c_custkey", F.abs("c_acctbal").alias("v"))


@query("f21_round_half_even", "SELECT l_orderkey, l_linenumber, l_partkey, round_even(l_quantity / 8, 2) AS v, round_even(l_quantity / 2, 0) AS w FROM lineitem")
def f21(spark, sf):
    return fx.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.bround(F.col("l_quantity") / 8, 2).alias("v"), F.bround(F.col("l_quantity") / 2, 0).alias("w"))


@query("f22_null_flag", fx.with_(fx.PROFILE_SQL) + "SELECT profile_id, CAST(gender IS NULL AS INTEGER) AS gender_missing FROM fx_profile")
def f22(spark, sf):
    return M.missing_flag(fx.profile(spark, sf), "gender").select("profile_id", "gender_missing")


@query("f23_fill_null", fx.with_(fx.PROFILE_SQL) + "SELECT profile_id, coalesce(credit_card_limit, (SELECT median(credit_card_limit) FROM fx_profile)) AS v, coalesce(gender, 'MISSING') AS g FROM fx_profile")
def f23(spark, sf):
    df = fx.profile(spark, sf)
    prep = M.fit_missing(df, [M.Rule("credit_card_limit", "numérica_contínua", "mediana"), M.Rule("gender", "categórica", M.MISSING)])
    return M.apply_missing(df, prep).select("profile_id", F.col("credit_card_limit").alias("v"), F.col("gender").alias("g"))


@query("f24_fixed_buckets", fx.with_(fx.CATALOGUE_SQL) + """SELECT id, CASE WHEN duration <= 5 THEN 'short' WHEN duration BETWEEN 6 AND 7 THEN 'mid' ELSE 'long' END AS d,
  CASE WHEN discount_value <= 5 THEN 'low' WHEN discount_value <= 10 THEN 'mid' ELSE 'high' END AS v FROM cat""")
def f24(spark, sf):
    return fx.catalogue(spark, sf).select("id", C.duration_bucket(F.col("duration")).alias("d"), C.value_bucket(F.col("discount_value")).alias("v"))


@query("f25_quantile_bins", SQL + """, e AS (SELECT list_sort(list_distinct(quantile_cont(qty, [0, 0.2, 0.4, 0.6, 0.8, 1]))) AS e FROM m)
SELECT id, CAST(greatest(len(list_filter(e, lambda v: v < qty)), 1) AS INTEGER) AS bin FROM m, e""")
def f25(spark, sf):
    df = fx.mixed(spark, sf)
    edges = distinct_edges(column_quantiles(df, ["qty"], [i / 5 for i in range(6)])["qty"])
    return df.select("id", bin_of(F.col("qty"), edges).alias("bin"))


@query("f26_equal_width_bins", SQL + ", e AS (SELECT min(price) AS lo, (max(price) - min(price)) / 8 AS w FROM m) SELECT id, CAST(1 + " + " + ".join(
    f"CAST(price >= lo + {i} * w AS INTEGER)" for i in range(1, 8)) + " AS INTEGER) AS bin FROM m, e")
def f26(spark, sf):
    df = fx.mixed(spark, sf)
    return df.select("id", equal_bin_of(F.col("price"), reference_edges(df, ["price"], 8)["price"]).alias("bin"))


@query("f27_bin_label", SQL + ", e AS (SELECT min(qty) AS lo, (max(qty) - min(qty)) / 4 AS w FROM m) SELECT CAST(i AS INTEGER) AS bin, round_even(lo + (i - 1) * w, 2) || ' - ' || round_even(lo + i * w, 2) AS faixa FROM e, range(1, 5) r(i)")
def f27(spark, sf):
    label = F.concat_ws(" - ", F.bround("de", 2).cast("string"), F.bround("ate", 2).cast("string"))
    return histograms(fx.mixed(spark, sf), ["qty"], 4).select("bin", label.alias("faixa"))


@query("f28_period_text", SQL + "SELECT id, CAST(safra AS VARCHAR) AS safra FROM m")
def f28(spark, sf):
    return fx.mixed(spark, sf).select("id", F.col("safra").cast("string").alias("safra"))


# ---- dataset profiles and splits ----------------------------------------------------------

D_SQL = "SELECT count(*) AS linhas, 12 AS colunas, count(DISTINCT store) AS ids_unicos, count(*) FILTER (y = 0) AS nao_convertidos, count(*) FILTER (y = 1) AS convertidos, " \
        "round_even(100 * count(*) FILTER (y = 1) / {den}, 2) AS taxa_percentual, round_even(100 * count(*) FILTER (y = 0) / {den}, 2) AS taxa_nao_convertidos FROM m"


@query("d1_dataset_profile", SQL + D_SQL.format(den="count(*)"))
def d1(spark, sf):
    return D.dataset_profile(fx.mixed(spark, sf), "store", "y")


@query("d1_period_volume", SQL + "SELECT safra, count(*) AS volume FROM m GROUP BY 1")
def d1_volume(spark, sf):
    return D.period_volume(fx.mixed(spark, sf), "safra")


@query("d2_dataset_profile_per_id", SQL + D_SQL.format(den="count(DISTINCT store)"))
def d2(spark, sf):
    return D.dataset_profile(fx.mixed(spark, sf), "store", "y", per="ids")


@query("d3_conversion_rate_by_period", SQL + "SELECT CAST(safra AS VARCHAR) AS safra, count(y) AS contagem, sum(y)::BIGINT AS total_convertidos, (count(y) - sum(y))::BIGINT AS total_nao_convertidos, "
       "round(avg(y), 6) AS conversion_rate FROM m GROUP BY 1")
def d3(spark, sf):
    return rounded(B.period_rates(fx.mixed(spark, sf), "safra", "y", ("contagem", "total_convertidos", "total_nao_convertidos", "conversion_rate")))


@query("d4_bad_rate_by_period", SQL + "SELECT CAST(safra AS VARCHAR) AS safra, count(y) AS contagem, sum(y)::BIGINT AS total_maus, (count(y) - sum(y))::BIGINT AS total_bons, round(avg(y), 6) AS bad_rate FROM m GROUP BY 1")
def d4(spark, sf):
    return rounded(B.period_rates(fx.mixed(spark, sf), "safra", "y", ("contagem", "total_maus", "total_bons", "bad_rate")))


@query("d5_split_by_period", SQL + "SELECT CASE WHEN safra < 1999 THEN 'Treino' ELSE 'Teste OOT' END AS conjunto, id FROM m")
def d5(spark, sf):
    train, test = D.split_by_period(fx.mixed(spark, sf), 1999)
    return B.union_named({"Treino": train.select("id"), "Teste OOT": test.select("id")}, "conjunto")


@query("d5_split_volume", SQL + "SELECT CASE WHEN safra < 1999 THEN 'Treino' ELSE 'Teste OOT' END AS conjunto, safra, count(*) AS registros FROM m GROUP BY 1, 2")
def d5_volume(spark, sf):
    return D.split_volume(fx.mixed(spark, sf), 1999)


@query("d6_stratified_split", SQL + """, h AS (SELECT id, y, md5(id || '#42') AS h FROM m
), r AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY h) AS rn, ceil(count(*) OVER (PARTITION BY y) * 0.3) AS k FROM h
), l AS (SELECT y, max(h) FILTER (rn = k) AS lim FROM r GROUP BY y)
SELECT id, y, CASE WHEN h <= lim THEN 'test' ELSE 'train' END AS side FROM h JOIN l USING (y)""")
def d6(spark, sf):
    train, test = D.stratified_split(fx.mixed(spark, sf), "id", "y")
    return B.union_named({"train": train.select("id", "y"), "test": test.select("id", "y")}, "side")


# With n rows of a class, fold i begins after n * i / k of its hashes, rounded down.
@query("d6_stratified_folds", SQL + """, r AS (SELECT id, y, row_number() OVER (PARTITION BY y ORDER BY md5(id || '#42')) AS rn, count(*) OVER (PARTITION BY y) AS n FROM m)
SELECT id, y, CAST((rn > n // 4)::INT + (rn > n * 2 // 4)::INT + (rn > n * 3 // 4)::INT AS INTEGER) AS fold FROM r""")
def d6_folds(spark, sf):
    return D.stratified_folds(fx.mixed(spark, sf), "id", "y", 4).select("id", "y", "fold")


@query("d7_count_by_period_and_offer", LOG + "SELECT CAST(floor(t) AS BIGINT) AS dia, offer_id, count(*) AS count FROM ev WHERE event = 'offer received' GROUP BY 1, 2")
def d7(spark, sf):
    return B.count_by(E.received(log(spark, sf)).withColumn("dia", F.floor(TIME)), "dia", ITEM)
