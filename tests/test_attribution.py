"""Hand-made campaigns: which offer earns a conversion, and what stays undecided."""

import random
import re

import pytest
from pyspark.sql import functions as F

from waymark.operators.attribution import attributed_conversions
from waymark.operators.books import POINT_IN_TIME
from waymark.operators.dataset import Campaign
from waymark.operators.frames import time_cuts

ITEMS = [("a", "bogo", 10, 10, 5, 1, 1, 0, 0), ("b", "discount", 5, 5, 5, 1, 0, 1, 0), ("c", "informational", 0, 0, 3, 0, 1, 0, 1)]
ITEM_SCHEMA = "offer_id string, offer_type string, discount_value int, min_value int, duration int, web int, email int, mobile int, social int"
EVENT_SCHEMA = "profile_id string, event string, offer_id string, time_since_test_start double"
R, V, C, X = "offer received", "offer viewed", "offer completed", "transaction"


def campaign(spark, events, **options):
    raw = spark.createDataFrame([(p, e, o, float(t)) for p, e, o, t in events], EVENT_SCHEMA)
    people = spark.createDataFrame([(p, 20170101, 40, "F", 100.0) for p in sorted({e[0] for e in events if e[0]})],
                                   "profile_id string, registered_on int, age int, gender string, credit_card_limit double")
    return Campaign(raw, spark.createDataFrame(ITEMS, ITEM_SCHEMA), people, **options)


def won(spark, events, **options):
    rows = campaign(spark, events, **options).conversions().collect()
    return sorted((r["cliente_id"], r["t"], r["offer_id"], r["start_t"]) for r in rows)


def bought(p, t):
    return [(p, C, None, t), (p, X, None, t)]


CASES = {
    "second window of a repeated offer": ([("1", R, "a", 0), ("1", R, "a", 10), *bought("1", 12)], [("1", 12.0, "a", 10.0)]),
    "only one of two open offers viewed": ([("1", R, "a", 0), ("1", R, "b", 1), ("1", V, "a", 2), *bought("1", 3)], [("1", 3.0, "a", 0.0)]),
    "latest view wins": ([("1", R, "a", 1), ("1", R, "b", 0), ("1", V, "a", 1), ("1", V, "b", 2), *bought("1", 3)], [("1", 3.0, "b", 0.0)]),
    "unviewed offers: latest received wins": ([("1", R, "a", 1), ("1", R, "b", 0), *bought("1", 3)], [("1", 3.0, "a", 1.0)]),
    "exact tie is dropped": ([("1", R, "a", 1), ("1", R, "b", 1), *bought("1", 3)], []),
    "tie of views is broken by start": ([("1", R, "a", 0), ("1", R, "b", 1), ("1", V, "a", 2), ("1", V, "b", 2), *bought("1", 3)], [("1", 3.0, "b", 1.0)]),
    "both ends of the span count": ([("1", R, "a", 0), *bought("1", 0), *bought("1", 5)], [("1", 0.0, "a", 0.0), ("1", 5.0, "a", 0.0)]),
    "just outside the span": ([("1", R, "a", 1), *bought("1", 0.75), *bought("1", 6.25)], []),
    "completed without purchase": ([("1", R, "a", 0), ("1", C, None, 1)], []),
    "purchase without completion": ([("1", R, "a", 0), ("1", X, None, 1)], []),
    "a view after the conversion does not count": ([("1", R, "a", 1), ("1", R, "b", 0), ("1", V, "b", 4), *bought("1", 3)], [("1", 3.0, "a", 1.0)]),
    "copies of a row count once": ([("1", R, "a", 0), ("1", R, "a", 0), *bought("1", 1), *bought("1", 1)], [("1", 1.0, "a", 0.0)]),
    "informational offers can win": ([("1", R, "c", 0), *bought("1", 1)], [("1", 1.0, "c", 0.0)]),
}


@pytest.fixture(scope="module", params=["plain", "sliced"])
def winners(spark, request):
    """All cases at once, each as an entity of its own."""
    events = [(name, e, o, t) for name, (rows, _) in CASES.items() for _, e, o, t in rows]
    found = won(spark, events, **({"hot_rows": 1} if request.param == "sliced" else {}))
    return {name: [r for r in found if r[0] == name] for name in CASES}


@pytest.mark.parametrize("name", CASES)
def test_winner(winners, name):
    assert winners[name] == [(name, *w[1:]) for w in CASES[name][1]]


def test_large_entities_are_cut_at_their_own_times(spark):
    log = spark.range(1000).select(
        F.when(F.col("id") < 600, "big").when(F.col("id") >= 700, F.col("id").cast("string")).alias("cliente_id"),  # 100 rows have no entity
        (F.col("id") / 10).alias("t"))
    cuts = {r[0]: r[1] for r in time_cuts(log, range_rows=50).collect()}
    assert set(cuts) == {"big", None} and len(cuts["big"]) == 11 and len(cuts[None]) == 1
    assert all(4 * 86400 <= b - a <= 6 * 86400 for a, b in zip(cuts["big"], cuts["big"][1:]))
    assert time_cuts(log, range_rows=1000) is None and time_cuts(log, range_rows=700) is None
    assert len({r[0]: r[1] for r in time_cuts(log, range_rows=50, least_days=30).collect()}["big"]) == 2


def swept(spark, events, hot_rows, **options):
    """Conversions of a log in the ranges that ``hot_rows`` makes."""
    c = campaign(spark, events, hot_rows=hot_rows)
    rows = attributed_conversions(c.log, c.items, frames=c.frames, **options).collect()
    return sorted((r["cliente_id"], r["t"], r["offer_id"], r["start_t"]) for r in rows)


def plain_winners(events, within):
    """Every conversion against every span of its entity."""
    days = {i[0]: i[4] for i in ITEMS}
    rows = set(events)
    out = []
    for p, e, _, t in sorted(rows, key=str):
        if e != C or (p, X, None, t) not in rows or p is None:
            continue
        found = {}
        for q, e2, item, s in rows:
            if q != p or e2 != R or not s <= t <= s + days[item]:
                continue
            views = [v for r, k, i, v in rows if (r, k, i) == (p, V, item) and v <= t and (not within or v >= s)]
            found[item, s] = (not views, t - max(views) if views else 1e9, -s)
        best = sorted((v, k) for k, v in found.items())
        if best and (len(best) == 1 or best[0][0] != best[1][0]):
            out.append((p, float(t), best[0][1][0], float(best[0][1][1])))
    return sorted(set(out))


@pytest.mark.parametrize("within", [False, True])
@pytest.mark.parametrize("hot_rows", [10_000, 15, 4])
def test_sweep_equals_all_pairs(spark, within, hot_rows):
    rng = random.Random(3)
    events = []
    for p in ("1", "2", "3", None):
        for _ in range(120):
            t = rng.randrange(0, 160) * 0.25
            kind = rng.random()
            events += [(p, R, rng.choice("abc"), t)] if kind < 0.3 else [(p, V, rng.choice("abc"), t)] if kind < 0.6 else bought(p, t)
    assert swept(spark, events, hot_rows, view_within_window=within) == plain_winners(events, within)


@pytest.mark.parametrize("hot_rows", [10**6, 20_000])
def test_one_entity_of_many_conversions_and_spans(spark, hot_rows):
    """50,000 conversions and 50,000 spans of one entity: all pairs would be 2.5 thousand million."""
    n = 50_000
    i = F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    base = spark.range(1).select(i.alias("i"))
    at = F.col("i") * 0.0625
    items = F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (F.col("i") % 3 + 1).cast("int"))
    part = lambda name, item, t: base.select(F.lit("1").alias("profile_id"), F.lit(name).alias("event"), item.alias("offer_id"), t.alias("time_since_test_start"))
    none = F.lit(None).cast("string")
    raw = part(R, items, at).unionByName(part(C, none, at + 0.03125)).unionByName(part(X, none, at + 0.03125))
    people = spark.createDataFrame([("1", 20170101, 40, "F", 100.0)], "profile_id string, registered_on int, age int, gender string, credit_card_limit double")
    c = Campaign(raw, spark.createDataFrame(ITEMS, ITEM_SCHEMA), people, hot_rows=hot_rows)
    won = c.conversions()
    # Nothing is viewed, so the item received last, half a tick before, wins each time.
    row = won.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("t") - F.col("start_t") == 0.03125).alias("last")).first()
    assert (row["n"], row["last"]) == (n, n)
    plan = won._jdf.queryExecution().executedPlan().toString()
    # No join on the entity alone.
    assert not re.search(r"(SortMergeJoin|HashJoin) \[cliente_id#\d+\],", plan) and "CartesianProduct" not in plan


def test_a_third_of_all_rows_without_entity(spark):
    """Rows of no entity are one history, cut like any other, and equal to that history under a name."""
    events = mixed_campaign()
    unnamed = [(None if p == "1" else p, e, o, t) for p, e, o, t in events]
    columns = ["n_received", "n_viewed", "n_completed", "n_purchases", "last_purchase", "first_purchase", "n_web", "qtd_transacoes_7d", "qtd_ofertas_recebidas_14d"]

    def histories(rows, hot_rows, mode):
        found = campaign(spark, rows, mode=mode, hot_rows=hot_rows).plain_history().select("cliente_id", "offer_id", "t", *columns).collect()
        return sorted([tuple(r)[1:] for r in found if r["cliente_id"] in (None, "1")], key=str)

    for mode in ("reference", POINT_IN_TIME):
        named = histories(events, 10**6, mode)
        assert named and histories(unnamed, 10**6, mode) == histories(unnamed, 7, mode) == named


def test_first_event_has_no_history(spark):
    row = campaign(spark, [("1", R, "a", 0)]).history().first()
    assert row["n_received"] is None and row["last_purchase"] is None


def test_moving_counts_edges(spark):
    """Exactly seven days before counts; the same instant does not."""
    events = [("1", X, None, 3), ("1", X, None, 2.75), ("1", X, None, 10), ("1", R, "a", 10)]
    for options in ({}, {"hot_rows": 1, "slice_days": 1.0}):
        row = campaign(spark, events, **options).recency().first()
        assert (row["qtd_transacoes_7d"], row["qtd_transacoes_14d"]) == (1, 2)


def mixed_campaign():
    events = []
    for p in ("1", "2", "3"):
        for k in range(60):
            t = (k * 7 + int(p) * 3) % 40 * 0.5
            item = "abc"[(k + int(p)) % 3]
            kind = k % 4
            events += [(p, R, item, t)] if kind == 0 else [(p, V, item, t)] if kind == 1 else bought(p, t) if kind == 2 else [(p, X, None, t)]
    return events


def table(df):
    names = sorted(df.columns)
    return sorted([tuple(None if r[c] is None else round(r[c], 9) if isinstance(r[c], float) else r[c] for c in names) for r in df.collect()], key=str)


@pytest.mark.parametrize("mode, slice_days, hot_rows", [("reference", 0.5, 20), (POINT_IN_TIME, 7.0, 1)])
def test_sliced_histories_give_the_same_books(spark, mode, slice_days, hot_rows):
    events = mixed_campaign() + [("9", R, "a", 1)]
    plain = campaign(spark, events, mode=mode).book_full()
    sliced = campaign(spark, events, mode=mode, hot_rows=hot_rows, slice_days=slice_days).book_full()
    assert table(plain) == table(sliced)


def test_wide_books_equal_the_single_books(spark):
    c = campaign(spark, mixed_campaign())
    full = {r["ID"]: r.asDict() for r in c.book_full().collect()}
    for book in (c.profile(), c.purchases(), c.interaction(), c.offer(), c.communication(), c.pair()):
        for r in book.collect():
            for name, value in r.asDict().items():
                assert full[r["ID"]][name] == value, name
    assert len(full) == 9


def test_fifty_nine_features(spark):
    c = campaign(spark, mixed_campaign())
    assert len(c.book_full().columns) == 59 + 4
    base = c.modelling_base()
    assert base.count() == c.labelled_audience().count() and "target_sucesso" in base.columns


def brute(events):
    """Point-in-time features by looping over everything strictly before each anchor."""
    items = {i[0]: dict(zip(ITEM_SCHEMA.replace(" string", "").replace(" int", "").split(", "), i)) for i in ITEMS}
    rows = sorted(set((p, e, o, float(t)) for p, e, o, t in events), key=str)
    out = {}
    for p, _, o, t in [r for r in rows if r[1] == R]:
        if out.get((p, o), {}).get("t", -1) > t:
            continue
        past = [r for r in rows if r[0] == p and r[3] < t]
        times = {k: [r[3] for r in past if r[1] == k] for k in (R, V, C, X)}
        sent = [r for r in past if r[1] == R]
        channels = {c: sum(items[r[2]][c] for r in sent) for c in ("web", "email", "mobile", "social")}
        tx = times[X]
        out[p, o] = {
            "t": t,
            "historico_conversao": len(times[C]) / len(sent) if sent else 0.0,
            "qtd_transacoes_anteriores": len(tx) if past else None,
            "dias_desde_ultima_transacao": t - max(tx) if tx else None,
            "media_tempo_entre_transacoes": (max(tx) - min(tx)) / (len(tx) - 1) if len(tx) > 1 else None,
            "transacoes_distintas_dias": len({int(v) for v in tx}) if past else None,
            "qtd_ofertas_anteriores": len(sent) if past else None,
            "qtd_ofertas_visualizadas": len(times[V]) if past else None,
            "n_instancias_anteriores_mesma_oferta": len([r for r in sent if r[2] == o]),
            "web_ratio_historico": channels["web"] / sum(channels.values()) if sum(channels.values()) else 0.0,
        }
    return out


def test_point_in_time_looks_strictly_back(spark):
    events = mixed_campaign()
    got = {(r["cliente_id"], r["offer_id"]): r for r in campaign(spark, events, mode=POINT_IN_TIME).book_full().collect()}
    want = brute(events)
    assert set(got) == set(want)
    for key, features in want.items():
        assert got[key]["time_since_test_start"] == features.pop("t")
        for name, value in features.items():
            assert got[key][name] == (pytest.approx(value) if value is not None else None), (key, name)


def test_modes_agree_without_repeats_and_ties(spark):
    """With distinct times and no repeated offer only the off-by-one definitions differ."""
    events = [("1", R, "a", 0), ("1", V, "a", 1), *bought("1", 2), ("1", R, "b", 3), ("1", V, "b", 4), ("1", R, "c", 6)]
    a = {r["ID"]: r for r in campaign(spark, events).book_full().collect()}
    b = {r["ID"]: r for r in campaign(spark, events, mode=POINT_IN_TIME).book_full().collect()}
    for key in a:
        for name in ("qtd_ofertas_anteriores", "qtd_ofertas_visualizadas", "dias_desde_ultima_transacao", "qtd_ofertas_completas_validas",
                     "taxa_visualizacao", "taxa_visualizacao_historica_tipo", "dias_desde_ultima_oferta_recebida"):
            assert a[key][name] == b[key][name], (key, name)
