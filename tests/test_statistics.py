"""Evaluation, stability, preparation, exploration, splits and recommendation on small literal tables."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark.operators import dataset as D
from waymark.operators import evaluate as V
from waymark.operators import explore as E
from waymark.operators import prep as M
from waymark.operators import recommend as R
from waymark.operators import stability as L
from waymark.operators import tables as B
from waymark.operators.ordered import bin_of, column_quantiles, column_values, equal_bin_of, equal_edges, prob_list, quantiles
from waymark.sources import files as S


def scored(spark, n=400, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        s = round(rng.random(), 2)
        rows.append((str(i), 2000 + i % 3, int(rng.random() < s), s, 1 - s, "A" if i % 4 else "B"))
    return spark.createDataFrame(rows, "id string, safra int, y int, score_1 double, score_0 double, base string"), rows


def brute_auc(pairs):
    pos, neg = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    return sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))


def test_auc_and_gini_by_counting_pairs(spark):
    df, rows = scored(spark)
    got = {r["base"]: r for r in V.roc_auc(df, "score_1", "y", ["base"]).collect()}
    for base in "AB":
        want = brute_auc([(r[3], r[2]) for r in rows if r[5] == base])
        assert got[base]["auc"] == pytest.approx(want) and got[base]["gini"] == pytest.approx(2 * want - 1)


def test_ks_of_curve_is_two_sample_distance(spark):
    df, _ = scored(spark)
    best = V.best_threshold(df, "score_1", "y").first()
    other = L.ks_two_samples(df.filter("y = 1"), df.filter("y = 0"), ["score_1"]).first()
    assert best["ks"] == pytest.approx(other["ks_stat"]) and other["p_value"] < 1e-3


def test_one_class_has_no_ks(spark):
    df = spark.createDataFrame([(1, 0, 0.2), (1, 0, 0.4), (2, 1, 0.3), (2, 0, 0.1)], "safra int, y int, score_1 double")
    got = {r["safra"]: (r["ks_max"], r["ponto_ks"], r["contagem_de_linhas"]) for r in V.ks_by_period(df).collect()}
    assert got == {1: (0.0, None, 2), 2: (100.0, 0.3, 2)}


def test_null_and_nan_scores_are_left_out(spark):
    df = spark.createDataFrame([(0.1, 0), (0.9, 1), (float("nan"), 1), (None, 0), (1.7, 1)], "s double, y int")
    assert V.roc_auc(df, "s", "y").first()["auc"] == 1.0
    assert V.roc_curve(df, "s", "y").agg(F.max("threshold")).first()[0] == 1.0


def test_bands_hold_every_row_and_gain_ends_at_100(spark):
    df, rows = scored(spark)
    gain = V.gain_table(df, "score_1", "y", 10).orderBy("quantil").collect()
    assert sum(r["total_casos"] for r in gain) == len(rows) and gain[-1]["gain"] == pytest.approx(100)
    assert {"score_0 min", "KS"} <= set(V.evaluation_table(df, dataset="base").columns)


def test_required_columns_are_checked(spark):
    with pytest.raises(ValueError):
        V.roc_auc(spark.range(3), "score", "y")


def test_psi_of_equal_tables_is_zero_and_drops_outside_values(spark):
    df = spark.createDataFrame([(float(i),) for i in range(100)], "x double")
    assert L.psi(df, df, ["x"]).first()["psi"] == 0
    wide = df.unionByName(spark.createDataFrame([(1e6,), (-5.0,)], "x double"))
    assert L.psi(df, wide, ["x"]).first()["psi"] == 0
    table = L.psi_table(df, df.filter("x < 50"), ["x"]).orderBy("ordem").collect()
    assert table[0]["faixa"] == "0.0 - 9.9" and table[-1]["Atual_Proporção"] == 0.0001


def test_bins_at_their_ends(spark):
    df = spark.createDataFrame([(v,) for v in [0.0, 1.0, 2.0, 3.0, 10.0, 10.5, None]], "x double")
    right = [r[0] for r in df.select(bin_of(F.col("x"), [0.0, 1.0, 3.0, 10.0])).collect()]
    left = [r[0] for r in df.select(equal_bin_of(F.col("x"), equal_edges(0.0, 10.0, 10))).collect()]
    assert right == [1, 1, 2, 2, 3, None, None] and left == [1, 2, 3, 4, 10, None, None]


def test_exact_quantiles_match_numpy(spark):
    rng = random.Random(3)
    values = [rng.choice([rng.gauss(0, 100), 5.0, -5.0, 0.0]) for _ in range(777)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    probs = [0, 0.1, 0.25, 0.5, 0.77, 1]
    got = column_quantiles(df, ["x"], probs)["x"]
    assert got == pytest.approx(list(np.quantile(values, probs)))
    grouped = quantiles(column_values(df, ["x"], [F.lit("g").alias("g")]), ["variavel", "g"], "value", prob_list([0.5])).first()
    assert grouped["quantile"] == pytest.approx(float(np.median(values)))


def test_distance_correlation_moves_each_row_a_fixed_number_of_times(spark, monkeypatch):
    """The sum over pairs makes no row for each level of a tree."""
    from waymark.operators import explore

    seen, plain = [], explore.running

    def counted(counts, *others):
        seen.append(counts.count())
        return plain(counts, *others)

    monkeypatch.setattr(explore, "running", counted)
    rng = random.Random(17)
    pts = [(rng.random(), rng.random()) for _ in range(500)]
    explore.distance_correlation(spark.createDataFrame(pts, "x double, y double"), "x", "y").first()
    assert sum(seen) <= 4 * len(pts)


@pytest.mark.parametrize("chunk_rows", [7, 40, 1000])
def test_cross_distances_over_chunks_are_those_of_all_pairs(spark, chunk_rows):
    from waymark.operators.explore import _cross_distances

    rng = random.Random(18)
    pts = sorted({(float(rng.randrange(6)), round(rng.gauss(0, 3), 1)) for _ in range(150)})
    pts = [(x, y, rng.randrange(1, 4)) for x, y in pts]
    want = sum(v * w * abs(a - c) * abs(b - d) for a, b, v in pts for c, d, w in pts)
    table = spark.createDataFrame(pts, "x double, y double, w long")
    assert _cross_distances(table, len(pts), chunk_rows) == pytest.approx(want, rel=1e-12)


def test_distance_correlation_by_all_pairs(spark):
    rng = random.Random(5)
    pts = [(rng.choice([1.0, 2.0, rng.random()]), rng.choice([0.0, rng.random()])) for _ in range(150)]
    got = E.distance_correlation(spark.createDataFrame(pts, "x double, y double"), "x", "y").first()[0]

    def centred(v):
        d = np.abs(np.subtract.outer(v, v))
        return d - d.mean(0) - d.mean(1)[:, None] + d.mean()
    a, b = centred(np.array([p[0] for p in pts])), centred(np.array([p[1] for p in pts]))
    want = math.sqrt((a * b).mean()) / math.sqrt(math.sqrt((a * a).mean()) * math.sqrt((b * b).mean()))
    assert got == pytest.approx(want)
    same = spark.createDataFrame([(1.0, 2.0)] * 5, "x double, y double")
    assert E.distance_correlation(same, "x", "y").first()[0] == 0.0


def test_chi_square_tail(spark):
    cases = [(0.5, 3.841458820694124 / 2, 0.05), (5.0, 18.307038053275146 / 2, 0.05), (1.0, 0.0, 1.0), (1.0, 7.0, math.exp(-7)), (2.0, 0.3, math.exp(-0.3) * 1.3),
             (50.0, 124.34211340400407 / 2, 0.05), (500.0, 1074.67944980338 / 2, 0.05), (3.0, 1e-9, 1.0), (0.5, 400.0, math.erfc(20.0))]
    df = spark.createDataFrame(cases, "a double, x double, p double")
    for r in df.withColumn("got", E.upper_gamma_share(F.col("a"), F.col("x"))).collect():
        assert r["got"] == pytest.approx(r["p"], rel=1e-6), (r["a"], r["x"])


def test_best_cut_equals_enumeration(spark):
    from itertools import combinations
    rng = random.Random(5)

    def plain(counts, eps=1e-6):
        n, best = len(counts), None
        negatives, positives = (sum(c[i] for c in counts) for i in (0, 1))
        for k in range(n):
            for cut in combinations(range(1, n), k):
                ranges = list(zip([0, *cut], [*cut, n]))
                sums = [tuple(sum(c[i] for c in counts[a:b]) for i in (0, 1)) for a, b in ranges]
                steps = [q[1] * (p[0] + p[1]) - p[1] * (q[0] + q[1]) for p, q in zip(sums, sums[1:])]
                if all(s > 0 for s in steps) or all(s < 0 for s in steps):
                    value = sum(((p + eps) / (positives + eps) - (m + eps) / (negatives + eps)) * math.log((p + eps) / (positives + eps) / ((m + eps) / (negatives + eps))) for m, p in sums)
                    best = max(best or (value, ranges), (value, ranges), key=lambda b: b[0])
        return best[0]

    def own(counts, ranges, eps=1e-6):
        negatives, positives = (sum(c[i] for c in counts) for i in (0, 1))
        sums = [tuple(sum(c[i] for c in counts[a:b]) for i in (0, 1)) for a, b in ranges]
        return sum(((p + eps) / (positives + eps) - (m + eps) / (negatives + eps)) * math.log((p + eps) / (positives + eps) / ((m + eps) / (negatives + eps))) for m, p in sums)

    for _ in range(60):
        counts = [(rng.randrange(0, 40), rng.randrange(0, 40)) for _ in range(rng.randrange(1, 9))]
        counts = [(a + 1, b) for a, b in counts]
        assert own(counts, E.best_cut(counts)) == pytest.approx(plain(counts))
    df = spark.createDataFrame([(float(i % 50), float(rng.random() < i % 50 / 60), 1.0) for i in range(3000)], "x double, y double, one double").withColumn("y", F.col("y").cast("int"))
    found = E.optimal_bins(df, ["x", "one"], "y").orderBy("grupo").collect()
    rates = [r["pos"] / (r["pos"] + r["neg"]) for r in found if r["variavel"] == "x"]
    assert rates == sorted(rates) and len(rates) > 4 and sum(r["neg"] + r["pos"] for r in found if r["variavel"] == "x") == 3000


def test_best_item_without_the_product(spark):
    rng = random.Random(2)
    base = spark.createDataFrame([(f"k{i}", f"u{i % 9}", "x", float(i // 9), 0, 0) for i in range(60)], "ID string, cliente_id string, offer_id string, time_since_test_start double, duration int, discount int")
    kinds = [(d, v) for d in (3, 5, 7) for v in (1, None)]
    items = spark.createDataFrame([(f"i{rng.randrange(10**6):06d}", *kinds[i % 6]) for i in range(300)], "offer_id string, duration int, discount int")
    score = F.col("duration") % 5 * 0.25 + F.coalesce(F.col("discount"), F.lit(0)) * 0.0
    columns = ["offer_id", "duration", "discount"]
    full = R.best_offer(R.with_score(R.expand_scenarios(base, items, columns), score))
    assert R.item_classes(items).count() == 6
    assert sorted(R.best_item(base, items, score, columns).collect()) == sorted(full.collect())
    by_id = F.length("offer_id") + F.substring("offer_id", 5, 3).cast("int") / 1000.0
    assert sorted(R.best_item(base, items, by_id, columns, reads_id=True).collect()) == sorted(R.best_offer(R.with_score(R.expand_scenarios(base, items, columns), by_id)).collect())


def test_missing_plan_covers_the_modelling_table(spark):
    plan = M.missing_plan()
    assert len(plan) == 49 and len({r.variavel for r in plan}) == 49 and all(r.tipo and r.motivo for r in plan)


def test_missing_values_of_all_kinds(spark):
    df = spark.createDataFrame([(1.0, None, None), (float("nan"), 2, "x"), (3.0, 4, "y"), (5.0, None, None)], "a double, b int, c string")
    plan = [M.Rule("a", "", "mediana"), M.Rule("b", "", "mediana_int"), M.Rule("c", "", M.MISSING), M.Rule("absent", "", "0")]
    prep = M.fit_missing(df, plan)
    assert prep["medianas"] == {"a": 3.0} and prep["medianas_int"] == {"b": 3}
    assert [tuple(r) for r in M.apply_missing(df, prep).collect()] == [(1.0, 3, "MISSING"), (3.0, 2, "x"), (3.0, 4, "y"), (5.0, 3, "MISSING")]
    empty = spark.createDataFrame([(None,)], "b int")
    assert M.fit_missing(empty, [M.Rule("b", "", "mediana_int")])["medianas_int"] == {"b": 0}


def test_types_that_do_not_fit_become_null(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,)], "a string")
    assert [r[0] for r in M.apply_types(df, {"a": "int64"}).collect()] == [1, None, None]


def test_binary_integers_stay_numeric(spark):
    df = spark.createDataFrame([(i, i % 2, i % 5, "t") for i in range(100)], "id int, flag int, level int, text string")
    assert M.detect_types(df, exclude=["id"], int_low_card_as_cat=True) == (["flag"], ["level", "text"])


def test_stratified_split_is_exact_and_stable(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("id"), (F.col("id") % 4 == 0).cast("int").alias("y"))
    train, test = D.stratified_split(df, "id", "y", 0.3)
    assert {r["y"]: r["count"] for r in test.groupBy("y").count().collect()} == {0: 225, 1: 75}
    assert train.count() == 700 and train.join(test, "id").count() == 0
    again = D.stratified_split(df.repartition(7), "id", "y", 0.3)[1]
    assert {r["id"] for r in again.collect()} == {r["id"] for r in test.collect()}


def test_rare_levels_and_alignment(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    assert sorted(str(r[0]) for r in B.merge_rare(df, "k", 2).collect()) == ["None", "OTHER", "a", "a"]
    out = B.align(df, T.StructType().add("z", "integer").add("k", "string"))
    assert out.columns == ["z", "k"] and out.filter("z IS NULL").count() == 4


def test_recommendation_chain(spark):
    base = spark.createDataFrame([("u1_a", "u1", "a", 1, 5, 0), ("u1_b", "u1", "b", 2, 7, 1), ("u2_a", "u2", "a", 1, 5, 0)],
                                 "ID string, cliente_id string, offer_id string, time_since_test_start int, duration int, target_sucesso int")
    items = spark.createDataFrame([("a", 5), ("b", 7), ("c", 9)], "offer_id string, duration int")
    wide = R.expand_scenarios(base, items, ["offer_id", "duration"])
    assert wide.count() == 9 and wide.columns == [*base.columns, "ID_cenario"]
    best = R.best_offer(R.with_score(wide, F.col("duration") / 10.0))
    assert {r["offer_id"] for r in best.collect()} == {"c"}
    tied = R.best_offer(R.with_score(wide, F.lit(0.5)))
    assert {r["offer_id"] for r in tied.collect()} == {"a"}
    row = R.uplift_summary(R.compare_offers(R.with_score(base, F.lit(0.3)), best)).first()
    assert (row["casos_sem_conversao"], row["casos_avaliados"], row["convertidos_simulados"], row["casos_convertidos"]) == (2, 2, 2, 2)
    with pytest.raises(ValueError):
        R.expand_scenarios(base, items, ["offer_id", "price"])


def test_catalogue_beyond_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(R, "pinned", lambda df: (df, False))
    base = spark.createDataFrame([("k", "u", "x", 1)], "ID string, cliente_id string, offer_id string, time_since_test_start int")
    items = spark.range(50).select(F.concat(F.lit("i"), F.col("id").cast("string")).alias("offer_id"))
    wide = R.expand_scenarios(base, items, ["offer_id"])
    assert wide.select("offer_id").distinct().count() == wide.count() == 50


def test_offer_json_array_and_lines(spark, tmp_path):
    array = '[{"id": "a", "offer_type": "bogo", "discount_value": 1, "min_value": 2, "duration": 5.0, "channels": ["web", "social"]}]'
    (tmp_path / "a.json").write_text(array)
    row = S.read_offers_json(spark, str(tmp_path / "a.json"), multi_line=True).first()
    assert (row["offer_id"], row["web"], row["email"], row["social"], row["duration"]) == ("a", 1, 0, 1, 5.0)
    lines = '{"account_id": "1", "event": "offer viewed", "time_since_test_start": 1.0, "value": {"offer id": "a"}}\n' \
            '{"account_id": "1", "event": "transaction", "time_since_test_start": 1.0, "value": {"amount": "2.5"}}\n' \
            '{"account_id": "1", "event": "offer completed", "time_since_test_start": 1.0, "value": {"offer_id": "b", "reward": "2"}}'
    (tmp_path / "t.json").write_text(lines)
    one = S.read_transactions_json(spark, str(tmp_path / "t.json")).collect()
    assert [r["offer_id"] for r in one] == ["a", None, None]
    both = S.read_transactions_json(spark, str(tmp_path / "t.json"), item_keys=("offer id", "offer_id"), extras=("amount",)).collect()
    assert [(r["offer_id"], r["amount"]) for r in both] == [("a", None), (None, "2.5"), ("b", None)]


def test_pandas_nan_becomes_null(spark):
    import pandas as pd
    out = S.from_pandas(spark, pd.DataFrame({"a": [1.0, float("nan")]}))
    assert out.filter("a IS NULL").count() == 1


@pytest.mark.parametrize("low,step", [(1.7e9, 60.0), (0.99, 1e-6), (1990.0, 0.01), (-5.0, 1e-3)])
def test_narrow_columns_are_spread_over_slices(spark, low, step):
    from waymark.operators.ordered import slice_of, value_limits
    df = spark.range(20_000).select((F.lit(low) + F.col("id") * step).alias("x"))
    limits = value_limits(df, "x")
    sizes = df.groupBy(slice_of(F.col("x"), limits).alias("s")).count().orderBy("s").collect()
    assert max(r["count"] for r in sizes) <= 0.004 * 20_000
    ordered = df.withColumn("s", slice_of(F.col("x"), limits)).groupBy("s").agg(F.min("x").alias("a"), F.max("x").alias("b")).orderBy("s").collect()
    assert all(p["b"] < q["a"] for p, q in zip(ordered, ordered[1:]))


def test_nan_counts_as_missing(spark):
    from waymark.operators.explore import distance_correlation, rank_correlation
    from waymark.operators.tables import by_target, period_rates
    rows = [(1.0, 2.0, 0), (2.0, 1.0, 1), (3.0, 4.0, 0), (4.0, 3.0, 1), (5.0, 5.0, 1)]
    schema = "a double, b double, y int"
    clean, dirty = spark.createDataFrame(rows, schema), spark.createDataFrame(rows + [(float("nan"), 1.0, 1), (2.0, float("nan"), 0)], schema)
    assert rank_correlation(dirty, "a", "b").first()[0] == pytest.approx(rank_correlation(clean, "a", "b").first()[0])
    assert distance_correlation(dirty, "a", "b").first()[0] == pytest.approx(distance_correlation(clean, "a", "b").first()[0])
    assert {r["y"]: r["b_max"] for r in by_target(dirty, ["b"], "y").collect()} == {0: 4.0, 1: 5.0}
    rates = period_rates(dirty.withColumn("p", F.lit("x")), "p", "a", ("n", "pos", "neg", "rate")).first()
    assert (rates["n"], rates["pos"]) == (6, 17.0)


def test_vif_refuses_more_columns_than_it_can_invert(spark):
    from waymark.operators.explore import vif
    df = spark.createDataFrame([(1.0, 2.0, 3.0)], "a double, b double, c double")
    with pytest.raises(ValueError):
        vif(df, ["a", "b", "c"], max_vars=2)


def test_each_column_is_spread_over_its_own_slices(spark):
    """A column of years beside prices up to a million, and one of narrow times: no column falls into a few slices."""
    from waymark.operators import ordered as O
    df = spark.range(30_000).select((1990 + F.col("id") % 400 / 12).alias("year"), (F.pmod(F.xxhash64("id"), F.lit(10**8)) / 100).alias("price"), (1.7e9 + F.col("id") / 64).alias("time"))
    counts = column_values(df, df.columns).groupBy("variavel", "value").agg(F.count(F.lit(1)).alias("n"))
    shares = [i / O.COARSE for i in range(O.COARSE + 1)]
    limits = counts.groupBy("variavel").agg(F.array_sort(F.array_distinct(F.percentile_approx("value", shares, O.SLICE_ACCURACY))).alias("limits"))
    sliced = counts.join(limits, "variavel").withColumn("s", O.slice_in(F.col("value"), F.col("limits")))
    for r in sliced.groupBy("variavel", "s").agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("a"), F.max("value").alias("b")).groupBy("variavel").agg(
            F.max("n").alias("largest"), F.sum("n").alias("all"), F.count(F.lit(1)).alias("slices"), F.sort_array(F.collect_list(F.struct("s", "a", "b"))).alias("parts")).collect():
        assert r["largest"] <= max(0.01 * r["all"], 3) and r["slices"] > 190, r["variavel"]
        assert all(p["b"] < q["a"] for p, q in zip(r["parts"], r["parts"][1:]))
    totals = {(r["variavel"], r["value"]): (r["n_to"], r["n_sum"]) for r in O.running(counts, ["variavel"], "value", ["n"]).collect()}
    for name in df.columns:
        values = sorted(k[1] for k in totals if k[0] == name)
        assert totals[name, values[-1]] == (30_000, 30_000)
        held = np.searchsorted(np.sort([r[0] for r in df.select(name).collect()]), values, side="right")
        assert [totals[name, v][0] for v in values] == held.tolist()


def test_quantiles_outside_their_brackets_are_found_again(spark):
    from waymark.operators import ordered as O
    rng = random.Random(9)
    df = spark.createDataFrame([(rng.gauss(0, 1), rng.random(), k) for k in ("a", "b") for _ in range(3000)], "x double, y double, k string")
    wrong = {("x",): {0.5: (2.0, 3.0), 0.25: (-1.0, 0.0)}, ("y",): {0.9: (-5.0, -4.0)}}
    got = {(r["variavel"], r["prob"]): r["quantile"] for r in O.ranked(O.ColumnRows(df), wrong).collect()}
    rows = df.collect()
    want = {(c, p): float(np.quantile([r[c] for r in rows], p)) for (c,), probs in wrong.items() for p in probs}
    assert got == pytest.approx(want)
    keyed = {r["k"]: r["quantile"] for r in O.quantiles(df, ["k"], "x", [0.3]).collect()}
    assert keyed == pytest.approx({k: float(np.quantile([r["x"] for r in rows if r["k"] == k], 0.3)) for k in "ab"})
    assert O.quantiles(df.limit(0), ["k"], "x", [0.3]).count() == 0
    assert O.column_quantiles(df.select(F.lit(None).cast("double").alias("n")), ["n"], [0.5]) == {"n": [None]}


def test_correlations_of_many_columns_in_two_passes(spark):
    import pandas as pd
    from waymark.operators.explore import MOMENTS, pearson
    rng = np.random.default_rng(6)
    x = rng.normal(size=(400, 300)) + 1e6
    x[:, 1] = 3.5
    x[:, 2] = x[:, 0] * -2 + 1
    x[rng.random(x.shape) < 0.1] = np.nan
    x[:, 5] = np.nan
    frame = pd.DataFrame(x, columns=[f"v{i}" for i in range(300)])
    df = spark.createDataFrame(frame).repartition(3)
    got, want = pearson(df, df.columns), frame.corr().to_numpy().copy()
    want[1, :] = want[:, 1] = np.nan
    np.testing.assert_allclose(got, want, atol=1e-8, equal_nan=True)
    assert len(MOMENTS) == 5 and np.isnan(got[1, 1]) and got[0, 2] == pytest.approx(-1)
    odd = spark.createDataFrame([(1.0, 2.0, float("inf")), (2.0, 1.0, 3.0), (4.0, 5.0, None)], "a double, b double, c double")
    found = {(r["var1"], r["var2"]): r["corr"] for r in E.correlation_pairs(odd, ["a", "b", "c"]).collect()}
    assert found["a", "b"] == pytest.approx(np.corrcoef([1, 2, 4], [2, 1, 5])[0, 1]) and found["a", "c"] is None
    assert E.correlation_pairs(odd.limit(0), ["a", "b"]).first()["corr"] is None
