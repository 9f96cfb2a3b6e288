"""Preparation and exploratory statistics on the mixed table."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark.operators import explore as E
from waymark.operators import prep as M
from waymark.operators import tables as B
from waymark.plans import fixtures as fx
from waymark.plans.campaign_queries import campaign, rounded
from waymark.plans.registry import ORACLES, query

SQL = fx.with_(fx.MIXED_SQL)
NUMERIC = ["qty", "price", "tax", "disc", "line"]
TEXT = ["flag", "status", "store"]


def unpivot_sql(columns: list[str], name: str = "u", source: str = "m", as_type: str = "DOUBLE", extra: str = "") -> str:
    return f"{name} AS (" + " UNION ALL ".join(
        f"SELECT '{c}' AS variavel, CAST({c} AS {as_type}) AS x{extra} FROM {source}" for c in columns) + ")"


# ---- preparation --------------------------------------------------------------------------

@query("m1_detect_types", SQL + " UNION ALL ".join(
    [f"SELECT '{c}' AS variavel, CASE WHEN count(DISTINCT {c}) <= 30 AND NOT bool_and({c} IN (0, 1)) THEN 'cat' ELSE 'num' END AS tipo FROM m" for c in ["line", "even"]]
    + [f"SELECT DISTINCT '{c}', CASE WHEN typeof({c}) = 'DOUBLE' THEN 'num' ELSE 'cat' END FROM m" for c in ["qty", "price", "tax", "disc", "flag", "status", "store", "safra"]]))
def m1(spark, sf):
    num, cat = M.detect_types(fx.mixed(spark, sf), "y", ["id"], force_cat=["safra"], int_low_card_as_cat=True)
    return spark.createDataFrame([(c, "num") for c in num] + [(c, "cat") for c in cat], "variavel string, tipo string")


@query("m2_apply_types", SQL + """SELECT id, TRY_CAST(store AS BIGINT) AS store, CAST(qty AS BIGINT) AS qty, CAST(line AS DOUBLE) AS line,
  CAST(safra AS VARCHAR) AS safra, TRY_CAST(substr(store, 2) AS BIGINT) AS store_number FROM m""")
def m2(spark, sf):
    df = fx.mixed(spark, sf).withColumn("store_number", F.substring("store", 2, 9))
    types = {"store": "int64", "qty": "int64", "line": "float64", "safra": "category", "store_number": "int64", "absent": "int64"}
    return M.apply_types(df, types).select("id", "store", "qty", "line", "safra", "store_number")


MIXED_PLAN = [
    M.Rule("qty", "numérica_contínua", "mediana"), M.Rule("tax", "numérica_contínua", "mediana"), M.Rule("disc", "proporção", "-1"), M.Rule("line", "inteira", "mediana_int"),
    M.Rule("flag", "categórica", M.MISSING), M.Rule("price", "numérica_contínua", "0"), M.Rule("id", "id", "none", "chave"),
]


@query("m3_missing_plan", SQL + ", " + unpivot_sql(["qty", "price", "tax", "disc", "line", "flag", "id"], as_type="VARCHAR") + """
SELECT variavel, tipo, t AS tratamento_missing, motivo, round(avg(CAST(x IS NULL AS INTEGER)), 6) AS share FROM u
JOIN (VALUES ('qty', 'numérica_contínua', 'mediana', ''), ('tax', 'numérica_contínua', 'mediana', ''), ('disc', 'proporção', '-1', ''), ('line', 'inteira', 'mediana_int', ''),
  ('flag', 'categórica', 'MISSING', ''), ('price', 'numérica_contínua', '0', ''), ('id', 'id', 'none', 'chave')) p(variavel, tipo, t, motivo) USING (variavel) GROUP BY ALL""")
def m3(spark, sf):
    return rounded(M.plan_table(fx.mixed(spark, sf), MIXED_PLAN))


@query("m3_missing_plan_profile", "WITH b AS (" + ORACLES["b1_book_perfil"] + """)
SELECT 'cliente_id' AS variavel, 'id' AS tipo, 'none' AS tratamento_missing, 'chave' AS motivo, round(avg(CAST(cliente_id IS NULL AS INTEGER)), 6) AS share FROM b UNION ALL
SELECT 'offer_id', 'id', 'none', 'chave', round(avg(CAST(offer_id IS NULL AS INTEGER)), 6) FROM b UNION ALL
SELECT 'ID', 'id', 'none', 'chave', round(avg(CAST("ID" IS NULL AS INTEGER)), 6) FROM b UNION ALL
SELECT 'time_since_test_start', 'tempo', 'none', 'marcador temporal', round(avg(CAST(time_since_test_start IS NULL AS INTEGER)), 6) FROM b UNION ALL
SELECT 'idade', 'numérica_contínua', 'mediana', 'ausência informativa (criar flag_miss)', round(avg(CAST(idade IS NULL AS INTEGER)), 6) FROM b UNION ALL
SELECT 'genero', 'categórica', 'MISSING', 'não informado tem significado', round(avg(CAST(genero IS NULL AS INTEGER)), 6) FROM b UNION ALL
SELECT 'limite_credito', 'numérica_contínua', 'mediana', 'distribuição assimétrica', round(avg(CAST(limite_credito IS NULL AS INTEGER)), 6) FROM b UNION ALL
SELECT 'safra_registro', 'categórica', 'MISSING', 'categoria faltante explícita', round(avg(CAST(safra_registro IS NULL AS INTEGER)), 6) FROM b UNION ALL
SELECT 'historico_conversao', 'proporção', '0', 'sem histórico ⇒ 0', round(avg(CAST(historico_conversao IS NULL AS INTEGER)), 6) FROM b""")
def m3_profile(spark, sf):
    return rounded(M.plan_table(campaign(spark, sf).profile(), M.missing_plan()))


@query("m4_fit_missing", SQL + """SELECT 'tax' AS variavel, round(median(tax), 6) AS mediana FROM m UNION ALL SELECT 'qty', round(median(qty), 6) FROM m
UNION ALL SELECT 'line', round_even(median(line), 0) FROM m""")
def m4(spark, sf):
    prep = M.fit_missing(fx.mixed(spark, sf), MIXED_PLAN)
    return rounded(spark.createDataFrame([(c, float(v)) for c, v in {**prep["medianas"], **prep["medianas_int"]}.items()], "variavel string, mediana double"))


@query("m5_apply_missing", SQL + """SELECT id, qty, coalesce(price, 0) AS price, round(coalesce(tax, (SELECT median(tax) FROM m)), 6) AS tax, coalesce(disc, -1) AS disc,
  CAST(line AS BIGINT) AS line, even, coalesce(flag, 'MISSING') AS flag, status, store, safra, y FROM m""")
def m5(spark, sf):
    df = fx.mixed(spark, sf)
    return rounded(M.apply_missing(df, M.fit_missing(df, MIXED_PLAN)))


@query("m6_missing_flag", SQL + "SELECT id, tax, CAST(tax IS NULL AS INTEGER) AS tax_missing FROM m")
def m6(spark, sf):
    return M.missing_flag(fx.mixed(spark, sf), "tax").select("id", "tax", "tax_missing")


@query("m7_drop_sparse", SQL + "SELECT id, qty, price, disc, line, even, flag, status, store, safra, y FROM m")
def m7(spark, sf):
    return M.drop_sparse(fx.mixed(spark, sf), 10)


RULES_SQL = ", " + unpivot_sql(NUMERIC) + """, q AS (
  SELECT variavel, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3, avg(CAST(x IS NULL AS INTEGER)) AS nulos FROM u GROUP BY variavel
), o AS (
  SELECT variavel, bool_or(coalesce(x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1), false)) AS fora, any_value(nulos) AS nulos FROM u JOIN q USING (variavel) GROUP BY variavel
), regra AS (SELECT variavel, CASE WHEN NOT fora AND nulos < 0.05 THEN 'mean' ELSE 'median' END AS regra FROM o)"""


@query("m8_imputation_rules", SQL + RULES_SQL + "SELECT * FROM regra UNION ALL SELECT 'flag', 'Moda' UNION ALL SELECT 'status', 'Moda'")
def m8(spark, sf):
    rules = M.imputation_rules(fx.mixed(spark, sf).select(*NUMERIC, "flag", "status"))
    return spark.createDataFrame(list(rules.items()), "variavel string, regra string")


IMPUTED = """SELECT id, qty, price, round(coalesce(tax, (SELECT median(tax) FROM m)), 6) AS tax,
  round(coalesce(disc, (SELECT avg(disc) FROM m)), 6) AS disc, CAST(line AS DOUBLE) AS line, {flag} AS flag FROM {source}"""


@query("m9_fit_apply_imputation", SQL + IMPUTED.format(source="m", flag="coalesce(flag, (SELECT flag FROM m WHERE flag IS NOT NULL GROUP BY flag ORDER BY count(*) DESC, flag LIMIT 1))"))
def m9(spark, sf):
    df = fx.mixed(spark, sf).select("id", *NUMERIC, "flag")
    rules = {"qty": M.MEDIAN, "price": M.MEAN, "tax": M.MEDIAN, "disc": M.MEAN, "line": M.MEDIAN, "flag": M.MODE}
    return rounded(M.apply_imputation(df, rules, M.fit_imputation(df, rules, with_mode=True)))


@query("m10_apply_imputation_test", SQL + """, tr AS (SELECT * FROM m WHERE safra < 1999), te AS (SELECT * FROM m WHERE safra >= 1999)
SELECT id, qty, price, round(coalesce(tax, (SELECT median(tax) FROM tr)), 6) AS tax, round(coalesce(disc, (SELECT avg(disc) FROM tr)), 6) AS disc, line, flag FROM te""")
def m10(spark, sf):
    df = fx.mixed(spark, sf).select("id", *NUMERIC, "flag", "safra")
    train, test = df.filter("safra < 1999"), df.filter("safra >= 1999").drop("safra")
    rules = {"tax": M.MEDIAN, "disc": M.MEAN, "flag": M.MODE}
    return rounded(M.apply_imputation(test, rules, M.fit_imputation(train.drop("safra"), rules)))


@query("m11_align_for_scoring", SQL + """SELECT CASE WHEN flag IN ('A', 'N') THEN flag END AS flag, qty, CAST(NULL AS DOUBLE) AS absent, id FROM m""")
def m11(spark, sf):
    schema = T.StructType([T.StructField("flag", T.StringType()), T.StructField("qty", T.DoubleType()),
                           T.StructField("absent", T.DoubleType()), T.StructField("id", T.StringType())])
    return M.align_for_scoring(fx.mixed(spark, sf), schema, {"flag": ["A", "N"]})


# ---- exploratory statistics ---------------------------------------------------------------

@query("e1_target_balance", SQL + """SELECT y, count(*) AS count, round_even(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM m), 2) AS "pct_%" FROM m GROUP BY y""")
def e1(spark, sf):
    return E.target_balance(fx.mixed(spark, sf), "y")


ALL_COLUMNS = ["id", "qty", "price", "tax", "disc", "line", "even", "flag", "status", "store", "safra", "y"]
NULLS_SQL = ", " + unpivot_sql(ALL_COLUMNS, as_type="VARCHAR") + ", f AS (SELECT variavel, count(*) AS linhas, count(*) - count(x) AS nulos FROM u GROUP BY variavel)"


@query("e2_missing_summary", SQL + NULLS_SQL + """SELECT variavel, round_even(nulos / linhas * 100, 2) AS "%_missing" FROM f""")
def e2(spark, sf):
    return E.missing_summary(fx.mixed(spark, sf))


@query("e3_missing_table", SQL + NULLS_SQL + "SELECT variavel, linhas AS volumetria, nulos AS total_nulos, round(nulos / linhas * 100, 6) AS perc_nulos FROM f WHERE nulos > 0")
def e3(spark, sf):
    return rounded(E.missing_table(fx.mixed(spark, sf)))


@query("e4_numeric_summary", SQL + ", " + unpivot_sql(NUMERIC) + """SELECT variavel, count(x) AS count, round(avg(x), 4) AS mean, round(stddev_samp(x), 4) AS std, round(min(x), 4) AS min,
  round(quantile_cont(x, 0.25), 4) AS p25, round(quantile_cont(x, 0.5), 4) AS p50, round(quantile_cont(x, 0.75), 4) AS p75, round(max(x), 4) AS max FROM u GROUP BY variavel""")
def e4(spark, sf):
    return rounded(B.describe(fx.mixed(spark, sf), NUMERIC), 4)


@query("e5_text_summary", SQL + ", " + unpivot_sql(TEXT, as_type="VARCHAR") + """, g AS (SELECT variavel, x, count(*) AS n FROM u WHERE x IS NOT NULL GROUP BY ALL)
SELECT variavel, CAST(sum(n) AS BIGINT) AS count, count(*) AS "unique", first(x ORDER BY n DESC, x) AS top, max(n) AS freq FROM g GROUP BY variavel""")
def e5(spark, sf):
    return B.describe_text(fx.mixed(spark, sf), TEXT)


BY_TARGET = ["qty", "tax"]


@query("e6_numeric_by_target", SQL + "SELECT y, " + ", ".join(
    f"round({f}({c}), 6) AS {c}_{n}" for c in BY_TARGET for n, f in
    [("mean", "avg"), ("median", "median"), ("std", "stddev_samp"), ("min", "min"), ("max", "max")]) + " FROM m GROUP BY y")
def e6(spark, sf):
    return rounded(B.by_target(fx.mixed(spark, sf), BY_TARGET, "y"))


CHI_SQL = ", " + unpivot_sql(TEXT + ["even"], as_type="VARCHAR", extra=", y") + """, freq AS (
  SELECT variavel, x, count(*) AS k FROM u WHERE x IS NOT NULL GROUP BY ALL
), tab AS (
  SELECT variavel, CASE WHEN k < 700 THEN 'OTHER' ELSE x END AS nivel, y, count(*) AS n FROM u JOIN freq USING (variavel, x) GROUP BY ALL
), linha AS (SELECT variavel, nivel, sum(n) AS r FROM tab GROUP BY ALL
), coluna AS (SELECT variavel, y, sum(n) AS c FROM tab GROUP BY ALL
), tudo AS (SELECT variavel, sum(n) AS t, count(DISTINCT nivel) - 1 AS dof FROM tab GROUP BY ALL
), esperado AS (
  SELECT l.variavel, t, dof, coalesce(n, 0) AS o, r * c / t AS e FROM linha l JOIN coluna USING (variavel) JOIN tudo USING (variavel)
  LEFT JOIN tab ON tab.variavel = l.variavel AND tab.nivel = l.nivel AND tab.y = coluna.y)"""


@query("e7_chi2_statistic", SQL + CHI_SQL + """SELECT variavel, dof, CAST(t AS BIGINT) AS n, round(sum(CASE WHEN dof = 1 THEN pow(abs(o - e) - least(0.5, abs(o - e)), 2) ELSE pow(o - e, 2) END / e), 6) AS chi2
FROM esperado GROUP BY ALL""")
def e7(spark, sf):
    return rounded(E.chi2_table(fx.mixed(spark, sf), TEXT + ["even"], "y", 700))


# The upper tail of chi-square in closed form: a finite sum for even degrees of freedom; the error function, by its series, and a finite sum for odd ones.
@query("e7_chi2_categorical", SQL + CHI_SQL + """, stat AS (
  SELECT variavel, dof, CAST(t AS BIGINT) AS n, sum(CASE WHEN dof = 1 THEN pow(abs(o - e) - least(0.5, abs(o - e)), 2) ELSE pow(o - e, 2) END / e) AS x FROM esperado GROUP BY ALL
), half AS (SELECT *, greatest(x, 1e-300) / 2 AS h FROM stat)
SELECT variavel, dof, n, round(x, 6) AS chi2, round(CASE WHEN dof % 2 = 0
  THEN exp(-h) * list_sum(list_transform(range(0, dof // 2), lambda j: exp(j * ln(h) - lgamma(j + 1.0))))
  ELSE 1 - 2 / sqrt(pi()) * list_sum(list_transform(range(0, 80), lambda k: (1 - 2 * (k % 2)) * exp((k + 0.5) * ln(h) - lgamma(k + 1.0)) / (2 * k + 1)))
    + exp(-h) * coalesce(list_sum(list_transform(range(1, (dof + 1) // 2), lambda j: exp((j - 0.5) * ln(h) - lgamma(j + 0.5)))), 0) END, 6) AS p_value FROM half""")
def e7_p(spark, sf):
    return rounded(E.chi2_categorical(fx.mixed(spark, sf), TEXT + ["even"], "y", 700))


def corr_sql(columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS var1, '{b}' AS var2, round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) AS corr FROM m"
        for i, a in enumerate(columns) for b in columns[i + 1:])


@query("e8_correlation_pairs", SQL + corr_sql(NUMERIC))
def e8(spark, sf):
    return rounded(E.correlation_pairs(fx.mixed(spark, sf), NUMERIC))


@query("e8_strong_pairs", SQL + f"SELECT * FROM ({corr_sql(['qty', 'price', 'line'])}) WHERE abs(corr) >= 0.002")
def e8_strong(spark, sf):
    return rounded(E.strong_pairs(fx.mixed(spark, sf), ["qty", "price", "line"], limit=0.002))


@query("e8_spearman", SQL + """, r AS (SELECT avg(i) OVER (PARTITION BY qty) AS a, avg(j) OVER (PARTITION BY tax) AS b FROM (
  SELECT qty, tax, row_number() OVER (ORDER BY qty) AS i, row_number() OVER (ORDER BY tax) AS j FROM m WHERE tax IS NOT NULL))
SELECT round(corr(a, b), 6) AS spearman FROM r""")
def e8_spearman(spark, sf):
    return rounded(E.rank_correlation(fx.mixed(spark, sf), "qty", "tax"))


@query("e9_correlation_matrix", SQL + "SELECT variavel, qty, price, line FROM (" + " UNION ALL ".join(
    f"SELECT '{a}' AS variavel, " + ", ".join("1.0::DOUBLE AS " + b if a == b else f"round(corr({min(a, b)}::DOUBLE, {max(a, b)}::DOUBLE), 6) AS {b}" for b in ["qty", "price", "line"]) + " FROM m"
    for a in ["qty", "price", "line"]) + ")")
def e9(spark, sf):
    return rounded(E.correlation_matrix(fx.mixed(spark, sf), ["qty", "price", "line"]))


# With two other columns a and b: VIF = (1 - r_ab^2) / det of the 3 x 3 correlation matrix.
@query("e10_vif", SQL + """, z AS (SELECT qty, price, coalesce(tax, 0) AS tax FROM m),
r AS (SELECT corr(qty, price) AS qp, corr(qty, tax) AS qt, corr(price, tax) AS pt FROM z),
d AS (SELECT *, 1 + 2 * qp * qt * pt - qp * qp - qt * qt - pt * pt AS det FROM r)
SELECT 'qty' AS variavel, round((1 - pt * pt) / det, 6) AS "VIF" FROM d UNION ALL SELECT 'price', round((1 - qt * qt) / det, 6) FROM d
UNION ALL SELECT 'tax', round((1 - qp * qp) / det, 6) FROM d""")
def e10(spark, sf):
    return rounded(E.vif(fx.mixed(spark, sf), ["qty", "price", "tax"]))


def woe_sql(method: str = "quantile") -> str:
    numeric, text = ["qty", "price", "disc", "line"], ["flag", "status"]
    edges = """lim AS (SELECT variavel, least(10, count(DISTINCT x)) AS k, list(x) AS xs FROM u GROUP BY variavel
), lims AS (SELECT variavel, list_sort(list_distinct(list_transform(range(0, k + 1), lambda i: list_aggregate(xs, 'quantile_cont', i / k)))) AS e FROM lim)"""
    # quantile_cont takes constant fractions only, hence one list per number of bins.
    edges = "lims AS (" + " UNION ALL ".join(
        f"SELECT variavel, list_sort(list_distinct(quantile_cont(x, {[i / k for i in range(k + 1)]}))) AS e FROM u GROUP BY variavel HAVING least(10, count(DISTINCT x)) = {k}"
        for k in range(2, 11)) + ")"
    if method != "quantile":
        edges = "lims AS (SELECT variavel, [min(x)] || list_transform(range(1, 10), lambda i: min(x) + i * ((max(x) - min(x)) / 10)) || [max(x)] AS e FROM u GROUP BY variavel)"
    return ", " + unpivot_sql(numeric, extra=", y") + ", " + unpivot_sql(text, "t", as_type="VARCHAR", extra=", y") + f""", {edges}, bins AS (
  SELECT variavel, CAST(greatest(len(list_filter(e, lambda v: v < x)), 1) AS VARCHAR) AS bin, y FROM u JOIN lims USING (variavel) WHERE x IS NOT NULL
  UNION ALL SELECT variavel, x, y FROM t WHERE x IS NOT NULL
), c AS (SELECT variavel, bin, count(*) FILTER (y = 0) AS neg, count(*) FILTER (y = 1) AS pos FROM bins GROUP BY ALL
), w AS (SELECT *, (neg + 1e-6) / (sum(neg) OVER (PARTITION BY variavel) + 1e-6) AS dn, (pos + 1e-6) / (sum(pos) OVER (PARTITION BY variavel) + 1e-6) AS dp FROM c)"""


WOE_COLUMNS = ["qty", "price", "disc", "line", "flag", "status"]


@query("e11_woe_bins", SQL + woe_sql() + """SELECT variavel, bin, neg, pos, neg + pos AS tot, round(dn, 6) AS dist_neg, round(dp, 6) AS dist_pos, round(ln(dp / dn), 6) AS woe,
  round((dp - dn) * ln(dp / dn), 6) AS iv_bin FROM w""")
def e11(spark, sf):
    return rounded(E.woe_bins(fx.mixed(spark, sf), WOE_COLUMNS, "y"))


@query("e11_woe_equal_width", SQL + woe_sql("width") + "SELECT variavel, bin, neg, pos, round(ln(dp / dn), 6) AS woe FROM w")
def e11_width(spark, sf):
    return rounded(E.woe_bins(fx.mixed(spark, sf), WOE_COLUMNS, "y", method="width").select("variavel", "bin", "neg", "pos", "woe"))


@query("e12_information_values", SQL + woe_sql() + """SELECT variavel, round(sum((dp - dn) * ln(dp / dn)), 6) AS "IV" FROM w GROUP BY variavel""")
def e12(spark, sf):
    return rounded(E.information_values(fx.mixed(spark, sf), WOE_COLUMNS, "y"))


# All 512 cuts between ten fine bins; a bin's group is the number of cuts below it.
@query("l6_optimal_bins", SQL + woe_sql() + """, f AS (
  SELECT variavel, CAST(bin AS INTEGER) AS b, neg, pos, row_number() OVER (PARTITION BY variavel ORDER BY CAST(bin AS INTEGER)) - 1 AS i FROM c WHERE variavel IN ('qty', 'price', 'line')
), z AS (SELECT variavel, count(*) AS k, sum(neg) AS tn, sum(pos) AS tp FROM f GROUP BY variavel
), g AS (SELECT variavel, mask, bit_count(mask & ((1 << i) - 1)) AS grupo, min(b) AS primeiro, max(b) AS ultimo, sum(neg) AS neg, sum(pos) AS pos, any_value(tn) AS tn, any_value(tp) AS tp
  FROM f JOIN z USING (variavel), range(512) r(mask) WHERE mask < (1 << (k - 1)) GROUP BY ALL
), w2 AS (SELECT *, ln((pos + 1e-6) / (tp + 1e-6) / ((neg + 1e-6) / (tn + 1e-6))) AS woe, pos * lag(neg + pos) OVER o - lag(pos) OVER o * (neg + pos) AS step FROM g WINDOW o AS (PARTITION BY variavel, mask ORDER BY grupo)
), w3 AS (SELECT *, ((pos + 1e-6) / (tp + 1e-6) - (neg + 1e-6) / (tn + 1e-6)) * woe AS iv_bin FROM w2
), t2 AS (SELECT variavel, mask, sum(iv_bin) AS iv FROM w3 GROUP BY variavel, mask HAVING coalesce(min(step), 1) > 0 OR coalesce(max(step), -1) < 0
), b2 AS (SELECT variavel, mask FROM t2 QUALIFY row_number() OVER (PARTITION BY variavel ORDER BY iv DESC) = 1)
SELECT variavel, CAST(grupo + 1 AS INTEGER) AS grupo, primeiro, ultimo, neg::BIGINT AS neg, pos::BIGINT AS pos, round(woe, 6) AS woe, round(iv_bin, 6) AS iv_bin FROM w3 JOIN b2 USING (variavel, mask)""")
def l6_optimal(spark, sf):
    return rounded(E.optimal_bins(fx.mixed(spark, sf), ["qty", "price", "line"], "y"))


@query("e13_crossed_rate", SQL + """, g AS (SELECT flag, status, avg(y) AS r, count(*) AS n FROM m WHERE flag IS NOT NULL GROUP BY ALL)
SELECT flag, round(max(r) FILTER (status = 'F' AND n >= 50), 6) AS "F", round(max(r) FILTER (status = 'O' AND n >= 50), 6) AS "O" FROM g GROUP BY flag""")
def e13(spark, sf):
    return rounded(B.crossed_rate(fx.mixed(spark, sf), "flag", "status", "y"))


@query("e14_near_constant", SQL + ", " + unpivot_sql(["flag", "even", "disc", "status"], as_type="VARCHAR") + """
SELECT variavel, round_even(max(n) / sum(n), 4) AS frac_modal FROM (SELECT variavel, x, count(*) AS n FROM u GROUP BY ALL) GROUP BY variavel HAVING max(n) / sum(n) >= 0.45""")
def e14(spark, sf):
    return E.near_constant(fx.mixed(spark, sf), ["flag", "even", "disc", "status"], 0.45)


@query("e15_histograms", SQL + ", " + unpivot_sql(NUMERIC) + """, ends AS (SELECT variavel, min(x) AS lo, max(x) AS hi FROM u GROUP BY variavel
), grade AS (SELECT variavel, i AS bin, CASE WHEN i = 1 THEN lo ELSE lo + (i - 1) * ((hi - lo) / 20) END AS de, CASE WHEN i = 20 THEN hi ELSE lo + i * ((hi - lo) / 20) END AS ate
  FROM ends, range(1, 21) r(i))
SELECT g.variavel, CAST(bin AS INTEGER) AS bin, round(de, 6) AS de, round(ate, 6) AS ate, count(x) AS n FROM grade g LEFT JOIN u ON u.variavel = g.variavel AND x >= de AND (x < ate OR (bin = 20 AND x = ate)) GROUP BY ALL""")
def e15(spark, sf):
    return rounded(E.histograms(fx.mixed(spark, sf), NUMERIC))


@query("e16_level_frequencies", SQL + ", " + unpivot_sql(TEXT, as_type="VARCHAR") + "SELECT variavel, x AS nivel, count(*) AS n FROM u WHERE x IS NOT NULL GROUP BY ALL")
def e16(spark, sf):
    return E.level_frequencies(fx.mixed(spark, sf), TEXT)


def dcor_sql(a: str, b: str) -> str:
    return f"""pts AS (SELECT row_number() OVER () AS i, CAST({a} AS DOUBLE) AS x, CAST({b} AS DOUBLE) AS y FROM base),
d AS (SELECT p.i, q.i AS j, abs(p.x - q.x) AS a, abs(p.y - q.y) AS b FROM pts p, pts q),
l AS (SELECT i, avg(a) AS ma, avg(b) AS mb FROM d GROUP BY i), g AS (SELECT avg(ma) AS ga, avg(mb) AS gb FROM l),
c AS (SELECT a - r.ma - s.ma + ga AS a, b - r.mb - s.mb + gb AS b FROM d JOIN l r ON r.i = d.i JOIN l s ON s.i = d.j, g),
v AS (SELECT avg(a * b) AS ab, avg(a * a) AS aa, avg(b * b) AS bb FROM c)
SELECT round(sqrt(greatest(ab, 0)) / sqrt(sqrt(aa) * sqrt(bb)), 6) AS dcor FROM v"""


SUPPLIERS = "WITH base AS (SELECT c_custkey AS k, c_acctbal AS bal, c_acctbal * c_acctbal AS sq, c_nationkey AS nk FROM customer), "


def customers(spark, sf):
    df = fx.table(spark, sf, "customer")
    return df.select(F.col("c_acctbal").alias("bal"), (F.col("c_acctbal") * F.col("c_acctbal")).alias("sq"), F.col("c_nationkey").alias("nk"))


@query("e17_distance_correlation", SUPPLIERS + dcor_sql("bal", "sq"))
def e17(spark, sf):
    return rounded(E.distance_correlation(customers(spark, sf), "bal", "sq"))


@query("e17_distance_correlation_ties", SUPPLIERS + dcor_sql("nk", "bal"))
def e17_ties(spark, sf):
    return rounded(E.distance_correlation(customers(spark, sf), "nk", "bal"))


@query("e18_distance_correlation_matrix", SUPPLIERS + "p1 AS (" + "WITH " + dcor_sql("bal", "sq") + "), p2 AS (WITH " + dcor_sql("nk", "bal") + "), p3 AS (WITH " + dcor_sql("nk", "sq") + """)
SELECT 'bal' AS var1, 'sq' AS var2, dcor FROM p1 UNION ALL SELECT 'sq', 'bal', dcor FROM p1 UNION ALL SELECT 'nk', 'bal', dcor FROM p2 UNION ALL SELECT 'bal', 'nk', dcor FROM p2
UNION ALL SELECT 'nk', 'sq', dcor FROM p3 UNION ALL SELECT 'sq', 'nk', dcor FROM p3 UNION ALL SELECT v, v, 1.0 FROM (VALUES ('bal'), ('sq'), ('nk')) d(v)""")
def e18(spark, sf):
    return rounded(E.distance_correlation_matrix(customers(spark, sf), ["bal", "sq", "nk"]))
