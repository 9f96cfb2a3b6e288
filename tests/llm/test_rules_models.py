"""Line fields, ordinal grades and toxicity against brute force and on held-out rows."""

import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from tests.llm.cases import WEIRD, documents
from waymark.llm import line_rules, ordinal, toxicity
from waymark.llm.text import strings

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counted(text):
    words = WORD.findall(text or "")
    triples = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if triples[tuple(words[i: i + 3])] > 1 for k in range(3)}
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), again, len(covered)


def texts(n=300, seed=3):
    rng = random.Random(seed)
    parts = ["a", "bé", "c ", "\n", "\n\n", " ", "#", "$ ", "x y z ", "\t", "line one\n", "\r\n", "", "€", "LOUD!! ", "\x0b"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(0, 60))) for _ in range(n)] + WEIRD


def test_counts_equal_brute_force():
    column = texts()
    counts, _, _, _ = line_rules.measured(strings(pa.array(column)))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    assert [tuple(int(counts[k][i]) for k in names) for i in range(len(column))] == [counted(t) for t in column]


def test_viterbi_equals_all_paths():
    column = strings(pa.array(texts(80, 4)))
    _, line_text, _, lines = line_rules.measured(column)
    rng = np.random.default_rng(1)
    field = line_rules.LineField(rng.normal(size=len(line_rules.FEATURES)), rng.normal(size=(2, 2)), rng.normal(size=2))
    for i in range(len(column)):
        own = lines[line_text == i][:9]
        gain = own @ field.weights
        value = lambda s: field.first[s[0]] + sum(g * k for g, k in zip(gain, s)) + sum(field.pairs[a, b] for a, b in zip(s, s[1:]))  # noqa: E731, B023
        if len(own):
            best = max(value(s) for s in itertools.product((0, 1), repeat=len(own)))
            assert math.isclose(value(field.states(own).tolist()), best, abs_tol=1e-9)


def test_judge_and_kept_documents_agree(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    field = line_rules.fit_field(docs, labels)
    verdicts = line_rules.judge(docs, field)
    kept = {r.doc_id for r in verdicts.filter("kept").collect()}
    assert {r.doc_id for r in line_rules.kept_documents(docs, field).collect()} == kept
    rated = verdicts.join(labels, "doc_id").filter("not base_failed")
    assert rated.filter("quality = 1 and not kept").count() == 0 and rated.filter("quality = 0 and kept").count() <= 2
    rows = list(enumerate(WEIRD)) + [(None, "words " * 60), (1, None)]
    weird = line_rules.judge(documents(spark, rows), field).collect()
    assert len(weird) == len(rows) and all(r.base_failed and not r.kept for r in weird)


def test_a_field_without_ratings_calls_all_lines_content(spark):
    docs = documents(spark, [(1, "one two three\n#### ####")])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    field = line_rules.fit_field(docs, none)
    assert [r.line_states for r in line_rules.judge(docs, field).collect()] == [[0, 0]]
    assert line_rules.judge(documents(spark, []), field).count() == 0


def test_grades_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    from waymark.llm.queries import ratings
    model = ordinal.fit(docs, ratings(labels.filter("doc_id % 4 <> 1")))
    assert (np.diff(model.thresholds) > 0).all()
    rows = ordinal.grade(docs, model).join(ratings(labels.filter("doc_id % 4 = 1")), "doc_id").collect()
    assert np.mean([(r.grade >= 1) == r.kept for r in rows]) > 0.93
    assert all(r.tail_probabilities[0] >= r.tail_probabilities[1] and math.isclose(sum(r.tail_probabilities), r.expected_grade) for r in rows)


def test_grades_of_odd_rows(spark):
    rows = list(enumerate(WEIRD)) + [(None, "a b"), (1, "again")]
    docs = documents(spark, rows)
    model = ordinal.fit(docs, spark.createDataFrame([], "doc_id long, grade int"))
    out = ordinal.grade(docs, model).collect()
    assert len(out) == len(rows) and all(not r.kept for r in out if not WORD.search(dict(rows).get(r.doc_id) or "") and r.doc_id not in (None, 1))
    assert ordinal.grade(documents(spark, []), model).count() == 0


def test_neighbours_equal_brute_force_cosine():
    rng, size = random.Random(2), 400
    vocabulary = np.sort(np.random.default_rng(0).integers(0, 1 << 62, size).astype(np.uint64))
    weights = np.random.default_rng(1).uniform(0.2, 5, size)

    def vector():
        # Few terms are in most texts, most terms in few.
        places = sorted({min(size - 1, int(size * rng.random() ** 4)) for _ in range(rng.randrange(0, 12))})
        return np.array(places, np.int64), np.array([rng.randrange(1, 4) for _ in places], np.int32)

    examples = [(d, int(rng.random() < 0.3), *vector()) for d in range(900)]
    examples += [(900 + d, 1, *examples[5][2:]) for d in range(40)]  # copies
    index = toxicity.build(vocabulary, weights, examples)
    assert int(index.rows.sum()) == 940 and len(index.ids) > 2 * toxicity.BLOCK
    assert 0 < (index.columns >= 0).sum() < size

    def dense(places, counts):
        v = np.zeros(size)
        v[places] = index.vector(places, counts)
        return v

    entry = {}
    for d, _, places, counts in examples:
        entry.setdefault((places.tobytes(), counts.tobytes()), (d, places, counts))
    by_id = {d: dense(places, counts) for d, places, counts in entry.values()}
    table = np.stack([by_id[d] for d in index.ids.tolist()])
    queries = [e[2:] for e in examples[::9]] + [vector() for _ in range(300)] + [(np.zeros(0, np.int64), np.zeros(0, np.int32))]
    edges = np.append(0, np.cumsum([len(q[0]) for q in queries])).tolist()
    got = list(index.neighbours(edges, np.concatenate([q[0] for q in queries]), np.concatenate([q[1] for q in queries]), 15, index.matrix()))
    assert len(got) == len(queries)
    for query, (near, cosines) in zip(queries, got):
        # Stored weights are single precision, so nearly equal cosines may change places; the cosines themselves may not.
        want = table @ dense(*query)
        order = sorted(np.flatnonzero(want > 0).tolist(), key=lambda i: (-round(want[i], 6), index.ids[i]))
        held = np.cumsum(index.rows[order])
        order = order[: int(np.searchsorted(held, 15)) + 1]
        assert len(near) <= 15 and index.rows[near].sum() >= min(15, index.rows[want > 0].sum())
        m = min(len(near), len(order))
        assert abs(len(near) - len(order)) <= 1 and np.allclose(want[near], cosines, atol=1e-6) and np.allclose(want[order][:m], cosines[:m], atol=1e-6)


def test_weights_of_terms_leave_none_out_and_settle():
    share = np.array([0, 0.3, 0.02, 0.5])  # of toxic texts; the second term tells, the last is in half of all
    clean = np.array([0.001, 0.0, 0.02, 0.5])
    small, large = (toxicity.telling(share * n, clean * 9 * n, n, 9 * n) for n in (100, 1_000_000))
    for weights in (small, large):
        assert (weights >= 0.05).all() and weights.argmax() == 1 and math.isclose(weights[2], 0.05) and math.isclose(weights[3], 0.05)


def test_isotonic_rises_and_keeps_the_mean():
    rng = np.random.default_rng(5)
    x = rng.integers(0, 30, 400) / 30
    y = (rng.random(400) < x).astype(int)
    knots, values = toxicity.isotonic(x, y)
    assert list(values) == sorted(values) and math.isclose(np.interp(x, knots, values).sum(), y.sum(), rel_tol=1e-9)


def test_toxicity_on_held_out_rows(spark):
    import __spark_entry__ as entry
    for sf, recall, precision in (("0.01", 0.7, 0.7), ("0.1", 0.9, 0.9)):
        path = f"/root/testdata/sf{sf}"
        rows = entry.queries()["op4_toxicity"](spark, path).join(spark.read.parquet(f"{path}/labels.parquet"), "doc_id").filter("held_out").collect()
        toxic, called = [r for r in rows if r.toxic], [r for r in rows if r.predicted]
        assert sum(r.predicted for r in toxic) >= recall * len(toxic) and sum(r.toxic for r in called) >= precision * len(called)
        assert all(0 <= r.score <= 1 for r in rows) and sum(bool(r.evidence_ids) for r in rows) > 0.99 * len(rows)


def test_toxicity_of_odd_rows(spark):
    docs = documents(spark, list(enumerate(WEIRD)) + [(None, "x"), (1, "y")])
    none = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert [(r.score, r.evidence_ids) for r in toxicity.score(docs, none).collect()] == [(0.0, [])] * (len(WEIRD) + 2)
    labels = spark.createDataFrame([(d, 1, d % 2) for d in range(9)], "doc_id long, quality int, toxic int")
    some = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    assert len({r.score for r in some if r.doc_id in (0, 2, 3)}) == 1
    assert toxicity.score(documents(spark, []), none).count() == 0
