"""Training, scoring and selection on the mixed table.

A boosted model of one tree with one split is an aggregate: of all splits the
one of greatest variance reduction, and the mean labels of its two sides. Queries
of training, scoring and a round of selection fit that model, and their SQL
computes its split, scores, KS and Gini from the tables. The other queries
return what SQL can follow of larger models: names, settings and bounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waymark.operators import learn as L
from waymark.plans import fixtures as fx
from waymark.plans.registry import query
from waymark.session import scratch_path

FEATURES = ["qty", "price", "tax", "line", "flag", "status"]


def data(spark: SparkSession, sf: str) -> DataFrame:
    return fx.mixed(spark, sf).select("id", "safra", "y", *FEATURES)


MIXED = fx.with_(fx.MIXED_SQL)


def names_sql(names: list[str], column: str = "nome_variavel", total: bool = True) -> str:
    values = ", ".join(f"('{n}')" for n in names)
    return f"SELECT n AS {column}, TRUE AS bounded{', 1.0::DOUBLE AS total' if total else ''} FROM (VALUES {values}) v(n)"


def shares(found: DataFrame, name: str = "nome_variavel") -> DataFrame:
    """Importances that are shares of one: their names, whether each is a share, and what they sum to."""
    value = F.col("importancia")
    return found.select(name, value.between(0, 1).alias("bounded"), F.bround(F.sum(value).over(Window.partitionBy(F.lit(1))), 6).alias("total"))


STUMP, SPLIT_FEATURES = {"n_estimators": 1, "max_depth": 1}, ["even", "half", "line", "tax"]


def split_data(spark: SparkSession, sf: str) -> DataFrame:
    """Features of few values, so that every cut between two of them is tried."""
    return fx.mixed(spark, sf).withColumn("half", F.floor(F.col("qty") / 2)).select("id", "safra", "y", *SPLIT_FEATURES)


def stump_sql(fitted: str, scored: str, source: str = "m") -> str:
    """CTEs: the rows to fit and to score, each feature's best split, the best of all, and the rows' scores (table ``s``)."""
    values = " UNION ALL ".join(f"SELECT '{f}' AS f, coalesce({f}, -1)::DOUBLE AS v, y, w FROM fit, weight" for f in SPLIT_FEATURES)
    of = "CASE f " + " ".join(f"WHEN '{f}' THEN coalesce({f}, -1)" for f in SPLIT_FEATURES) + " END"
    return f""", d AS (SELECT *, floor(qty / 2) AS half FROM {source}), fit AS (SELECT * FROM d WHERE {fitted}),
    ratio AS (SELECT count(*) FILTER (y = 0) / greatest(count(*) FILTER (y = 1), 1) AS r FROM fit), weight AS (SELECT CASE WHEN r >= 3 THEN r ELSE 1.0 END AS w FROM ratio),
    g AS (SELECT f, v, sum(CASE WHEN y = 1 THEN w ELSE 1 END) AS n, sum(CASE WHEN y = 1 THEN w ELSE -1 END) AS t FROM ({values}) GROUP BY f, v),
    c AS (SELECT f, v, sum(n) OVER o AS nl, sum(t) OVER o AS tl, sum(n) OVER (PARTITION BY f) AS n, sum(t) OVER (PARTITION BY f) AS t FROM g WINDOW o AS (PARTITION BY f ORDER BY v)),
    best AS (SELECT f, v, tl / nl AS low, (t - tl) / (n - nl) AS high FROM c WHERE nl < n ORDER BY tl * tl / nl + (t - tl) * (t - tl) / (n - nl) DESC LIMIT 1),
    s AS (SELECT d.*, 1 / (1 + exp(-2 * CASE WHEN {of} <= v THEN low ELSE high END)) AS score FROM d, best WHERE {scored})"""


#: The test side of the stratified split, and KS and Gini of the scores on it.
SPLIT_SQL = """, h AS (SELECT *, md5(id || '#42') AS h FROM m), p AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY h) <= ceil(count(*) OVER (PARTITION BY y) * 0.3) AS test FROM h)"""
METRICS_SQL = """, k AS (SELECT score, count(*) FILTER (y = 1) AS p, count(*) FILTER (y = 0) AS n FROM s GROUP BY score),
    a AS (SELECT *, sum(p) OVER (ORDER BY score) AS pt, sum(n) OVER (ORDER BY score) AS nt, sum(p) OVER () AS ps, sum(n) OVER () AS ns FROM k),
    e AS (SELECT round(2 * sum(p * (nt - n * 0.5)) / max(ps * ns) - 1, 6) AS gini, round(max(abs(pt / ps - nt / ns)), 6) AS ks FROM a)"""


@query("l7_train_and_save", MIXED + stump_sql("true", "false") + " SELECT n AS nome_variavel, CASE WHEN n = f THEN 1.0 ELSE 0.0 END::DOUBLE AS importancia FROM best, (VALUES "
       + ", ".join(f"('{f}')" for f in SPLIT_FEATURES) + ") x(n)")
def l7(spark, sf):
    found, _, _ = L.train_and_save(split_data(spark, sf), "y", scratch_path(spark, "model"), ["id", "safra"], STUMP)
    return found


@query("l8_load_and_score", MIXED + stump_sql("true", "true") + " SELECT id, safra, y, round(score, 6) AS score FROM s")
def l8(spark, sf):
    path = scratch_path(spark, "model")
    L.train_and_save(split_data(spark, sf), "y", path, ["id", "safra"], STUMP)
    # A column that the new table lacks counts as missing.
    scored = L.load_and_score(split_data(spark, sf).drop("even"), path)
    return scored.select("id", "safra", "y", F.round("score_modelo", 6).alias("score"))


#: The test rows, scored by the share of positives among the training rows of the same value, for each feature.
VALUES_SQL = " UNION ALL ".join(f"SELECT '{f}' AS f, coalesce({f}, -1)::DOUBLE AS v, y FROM d WHERE test" for f in SPLIT_FEATURES)


@query("l9_backward_elimination", MIXED + SPLIT_SQL + stump_sql("NOT test", "test", "p") + f""", ranked AS (
    WITH s AS (SELECT x.y, g.t / g.n AS score FROM ({VALUES_SQL}) x JOIN g ON g.f = x.f AND g.v = x.v WHERE x.f = (SELECT f FROM best))""" + METRICS_SQL + """
    SELECT round(gini, 1) AS gini, round(ks, 1) AS ks FROM e)
    SELECT CAST(5 - i AS INTEGER) AS etapa, CAST(i AS INTEGER) AS qtd_variavel, (SELECT f FROM best) AS variaveis, TRUE AS nested, gini, ks FROM ranked, range(1, 5) r(i)""")
def l9(spark, sf):
    """All rounds with all their trees: SQL follows the feature that stays to the end, and what ranking the test rows by it alone comes to."""
    rounds = L.backward_elimination(split_data(spark, sf).drop("safra"), ["id"], "y")
    names, steps = F.col("variaveis_explicativas"), Window.partitionBy(F.lit(1)).orderBy("etapa")
    before = F.coalesce(F.lag(names).over(steps), F.array(*map(F.lit, [*SPLIT_FEATURES, "all"])))
    nested = (F.size(names) == F.col("qtd_variavel")) & (F.size(F.array_except(names, before)) == 0) & (F.size(F.array_except(before, names)) == 1)
    last = F.min_by(names, "qtd_variavel").over(Window.partitionBy(F.lit(1)))
    return rounds.select(
        "etapa", "qtd_variavel", F.array_join(F.array_sort(F.array_intersect(names, last)), ",").alias("variaveis"), nested.alias("nested"),
        F.round("gini", 1).alias("gini"), F.round("ks", 1).alias("ks"),
    )


@query("l10_selection_round", MIXED + SPLIT_SQL + stump_sql("NOT test", "test", "p") + METRICS_SQL + """, o AS (
    SELECT x, row_number() OVER (ORDER BY x = (SELECT f FROM best) DESC, x) AS place FROM (VALUES """ + ", ".join(f"('{f}')" for f in SPLIT_FEATURES) + """) v(x))
    SELECT (SELECT string_agg(x, ',' ORDER BY x) FROM o WHERE place < 4) AS kept, ks, gini FROM e""")
def l10(spark, sf):
    kept, ks, gini = L.selection_round(split_data(spark, sf), ["id", "safra"], "y", STUMP)
    return spark.createDataFrame([(",".join(sorted(kept)), round(ks, 6), round(gini, 6))], "kept string, ks double, gini double")


# Margins as a model of four trees would store them.
MARGINS = ["(qty - 25) / 64", "(line - 4) / 16.0", "even / 8.0 - 0.0625", "-2 * coalesce(disc, 0)"]


@query("l11_best_iteration", MIXED + f""", t AS (SELECT y, [{', '.join(MARGINS)}] AS parts FROM m),
    x AS (SELECT y, unnest(range(1, 5)) AS trees, parts FROM t), z AS (SELECT trees, y, list_reduce(parts[:trees], lambda a, b: a + b) AS score FROM x),
    k AS (SELECT trees, score, count(*) FILTER (y = 1) AS p, count(*) FILTER (y = 0) AS n FROM z GROUP BY trees, score),
    a AS (SELECT *, sum(p) OVER o AS pt, sum(n) OVER o AS nt, sum(p) OVER (PARTITION BY trees) AS ps, sum(n) OVER (PARTITION BY trees) AS ns FROM k WINDOW o AS (PARTITION BY trees ORDER BY score))
    SELECT CAST(trees AS INTEGER) AS trees, round(2 * sum(p * (nt - n * 0.5)) / max(ps * ns) - 1, 6) AS gini, round(max(abs(pt / ps - nt / ns)), 6) AS ks FROM a GROUP BY trees""")
def l11_best(spark, sf):
    margins = fx.mixed(spark, sf).select("y", F.array(*[F.expr(m).cast("double") for m in MARGINS]).alias("margins"))
    return L.prefix_metrics(margins, "y").select("trees", F.round("gini", 6).alias("gini"), F.round("ks", 6).alias("ks"))


@query("l11_grid_search", "SELECT d AS max_depth, 4.0::DOUBLE AS num_leaves, 0.3::DOUBLE AS learning_rate, TRUE AS bounded FROM (VALUES (2.0::DOUBLE), (3.0::DOUBLE)) v(d)")
def l11(spark, sf):
    options = {"max_depth": [2, 3], "num_leaves": [4], "learning_rate": [0.3]}
    _, history = L.grid_search(data(spark, sf).select("id", "y", "qty", "price"), "y", ["id"], options, folds=2, max_trees=4)
    bounded = F.col("gini_mean").between(-1, 1) & (F.col("gini_std") >= 0) & F.col("best_iter_mean").between(1, 4) & F.col("best_iter_median").between(1, 4)
    return history.select("max_depth", "num_leaves", "learning_rate", bounded.alias("bounded"))


@query("l12_class_weight", MIXED + "SELECT CASE WHEN n / p >= 3 THEN n / p ELSE 1.0 END AS peso FROM (SELECT count(*) FILTER (y = 0) AS n, count(*) FILTER (y = 1) AS p FROM m)")
def l12(spark, sf):
    return spark.createDataFrame([(float(L.class_weight(data(spark, sf), "y")),)], "peso double")


@query("l13_forest_importance", names_sql(FEATURES, "variavel"))
def l13(spark, sf):
    return shares(L.forest_importance(data(spark, sf), FEATURES, "y", "id", trees=5, folds=2)[0], "variavel")


@query("l14_importances", names_sql(["qty", "price", "tax", "line"], total=False))
def l14(spark, sf):
    model = L.train_and_tune(data(spark, sf).drop("flag", "status"), "y", ["id", "safra"], "lr", {"regParam": [0.01]}, folds=2)
    return L.importances(model).select("nome_variavel", (F.abs("importancia") < float("inf")).alias("bounded"))


#: All three methods choose the quantity, if no other number goes with the label as closely.
QTY_VOTES_SQL = "CASE WHEN abs(corr(qty, y)) > greatest(" + ", ".join(f"abs(corr(coalesce({c}, -1), y))" for c in ["price", "tax", "disc", "line", "even"]) + ") THEN 3::BIGINT END AS qty_votes"


@query("l15_select_features", MIXED + f"SELECT TRUE AS chosen, {QTY_VOTES_SQL}, TRUE AS known, TRUE AS bounded FROM m")
def l15(spark, sf):
    table = fx.mixed(spark, sf).drop("safra")
    found = L.select_features(table, "y", ["id"], ["classic", "univariate", "sequential"], "voting")
    features = [c for c in table.columns if c not in ("id", "y")]
    # Three times five votes on nine features: three to seven features have two or more.
    return found.agg(
        F.count("*").between(3, 7).alias("chosen"), F.max(F.when(F.col("feature") == "qty", F.col("votes"))).alias("qty_votes"),
        F.every(F.col("feature").isin(features)).alias("known"), F.every(F.col("votes").between(2, 3)).alias("bounded"),
    )


@query("l16_score_new_base", MIXED + stump_sql("safra < 1999", "safra >= 1999") + " SELECT id, safra, y, round(1 - score, 6) AS score_0, round(score, 6) AS score_1 FROM s")
def l16(spark, sf):
    path = scratch_path(spark, "model")
    train, new = split_data(spark, sf).filter("safra < 1999"), split_data(spark, sf).filter("safra >= 1999")
    L.train_and_save(train, "y", path, ["id", "safra"], STUMP)
    scored = L.score_new_base(train, new, path, ["id", "safra", "y"])
    return scored.select("id", "safra", "y", F.round("score_0", 6).alias("score_0"), F.round("score_1", 6).alias("score_1"))


@query("l17_train_and_tune", names_sql(["qty", "price", "line"]))
def l17(spark, sf):
    few = data(spark, sf).select("id", "y", "qty", "price", "line")
    model = L.train_and_tune(few, "y", ["id"], "gbc", {"maxDepth": [2, 3], "maxIter": [3]}, folds=2)
    return shares(L.importances(model))


@query("l17_train_and_tune_clustering", MIXED + "SELECT TRUE AS numbered, TRUE AS bounded, count(*) > 0 AS fitted FROM m")
def l17_clusters(spark, sf):
    few = data(spark, sf).select("id", "qty", "price")
    model = L.train_and_tune(few, None, ["id"], "kmeans", {"k": [2, 3]}, "clustering", folds=2)
    centres = [(i, float(c[0]), float(c[1])) for i, c in enumerate(model.stages[-1].clusterCenters())]
    ends = few.agg(F.min("qty").alias("q0"), F.max("qty").alias("q1"), F.min("price").alias("p0"), F.max("price").alias("p1"))
    found = spark.createDataFrame([(centres,)], "centres array<struct<cluster:int,qty:double,price:double>>")
    # Centres lie among the rows; both tables are one row.
    held = F.forall("centres", lambda c: c["qty"].between(F.col("q0"), F.col("q1")) & c["price"].between(F.col("p0"), F.col("p1")))
    both = found.withColumn("one", F.lit(1)).join(ends.withColumn("one", F.lit(1)), "one")
    return both.select((F.transform("centres", lambda c: c["cluster"]) == F.sequence(F.lit(0), F.size("centres") - 1)).alias("numbered"), held.alias("bounded"), F.size("centres").isin(2, 3).alias("fitted"))
