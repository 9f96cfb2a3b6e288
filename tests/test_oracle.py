"""Registered queries against their SQL on the smallest given tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

SUBSET = [
    "s1_read_offers_json", "s3_read_transactions_json", "s7_save_load_prep", "p11_merge_rare", "p14_align", "j7_as_of_join", "j9_conversions_before",
    "a13_exact_percentiles", "a14_statistics_by_class", "w6_moving_sums", "w7_composite_key_counts", "u2_vote_two", "f25_quantile_bins", "f26_equal_width_bins",
    "c1_enrich", "c7_attach_views", "c8_rank_candidates", "c9_detect_ambiguity", "c10_attributed_conversions", "c10_attributed_conversions_options",
    "c12_audience_with_target", "c13_explain_matches", "b10_book_full", "b11_modelling_base", "d6_stratified_split", "d6_stratified_folds", "m4_fit_missing", "m8_imputation_rules",
    "e4_numeric_summary", "e7_chi2_statistic", "e8_spearman", "e11_woe_bins", "e15_histograms", "e17_distance_correlation", "v1_roc_auc_tied_scores",
    "v2_pr_area", "v5_threshold_metrics", "v9_lift_tied_scores", "v11_evaluation_table", "v13_ks_by_period_multi", "l1_psi_table", "l3_psi_by_period",
    "l4_ks_two_samples", "l6_bin_shares", "l6_bin_groups", "l6_optimal_bins", "l7_train_and_save", "l10_selection_round", "l11_best_iteration", "l11_grid_search", "l16_score_new_base", "m3_missing_plan_profile", "e18_distance_correlation_matrix", "r1_expand_scenarios", "r3_best_item_by_classes", "r7_compare_offers", "r10_uplift_summary",
]


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [tuple(None if isinstance(r[i], float) and math.isnan(r[i]) else r[i] for i in order) for r in data]
    return sorted(columns), sorted(cells, key=str)


@pytest.mark.parametrize("name", SUBSET)
def test_query_equals_sql(spark, duck, sf, name):
    df = entry.queries()[name](spark, sf)
    got = rows(df.columns, df.collect())
    cur = duck.execute(entry.oracle_sql()[name])
    want = rows([d[0] for d in cur.description], cur.fetchall())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    for a, b in zip(got[1], want[1]):
        assert a == pytest.approx(b, abs=2e-6) if all(isinstance(v, (int, float)) for v in a) else a == b


def test_registry_is_consistent():
    queries, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(queries)
    without = sorted(set(queries) - set(oracles))
    assert all(n == "pipeline" or n[:2] == "op" and n[2].isdigit() for n in without)


def test_entry(spark):
    df = entry.entry(spark)
    labelled = df.collect()
    assert (len(labelled), sum(r["target_sucesso"] for r in labelled)) == (113, 18)
