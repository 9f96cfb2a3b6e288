"""Substring dedup and near duplicates against brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.cases import WEIRD, documents
from waymark.llm import near_dedup, substring
from waymark.llm.text import grams, hashed_words, sliding_min, strings

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def vocabulary(n=300, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(n)]


def test_words_are_hashed_alike_wherever_they_stand():
    column = strings(pa.array(["ab cd  ef", None, "", " cd\tab", "ef", "abcd"]))
    hashes, bounds = hashed_words(column)
    assert bounds.tolist() == [0, 3, 3, 3, 5, 6, 7]
    assert hashes[0] == hashes[4] and hashes[1] == hashes[3] and hashes[2] == hashes[5] and len(set(hashes.tolist())) == 4
    sliced = hashed_words(column.slice(3, 2))[0]
    assert sliced.tolist() == hashes[3:6].tolist()


@pytest.mark.parametrize("size", [1, 2, 3, 7, 25, 26])
def test_grams_and_sliding_min(size):
    values = np.random.default_rng(size).integers(0, 1 << 60, 80).astype(np.uint64)
    twice = grams(np.concatenate([values, values]), size)
    n = 80 - size + 1
    assert (twice[:n] == twice[80: 80 + n]).all() and len(set(twice[:n].tolist())) == n
    assert (sliding_min(values, size) == [values[i: i + size].min() for i in range(n)]).all()


def brute_removed(rows, window):
    first, out = {}, {}
    words = [(d, WORD.findall(t or "")) for d, t in rows]
    for d, w in words:
        if d is not None:
            for i in range(len(w) - window + 1):
                key = tuple(w[i: i + window])
                first[key] = min(first.get(key, d), d)
    for d, w in words:
        gone = set()
        if d is not None:
            for i in range(len(w) - window + 1):
                if first[tuple(w[i: i + window])] < d:
                    gone |= set(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.setdefault(d, []).append((len(w), len(gone), kept))
    return {d: sorted(v) for d, v in out.items()}


@pytest.mark.parametrize("bits", [20, 4])  # a sketch of 16 cells lets nearly all through: same result
def test_substring_dedup_equals_brute_force(spark, bits):
    rng, words = random.Random(3), vocabulary()
    passages = [[rng.choice(words) for _ in range(n)] for n in (50, 51, 60, 90, 140)]
    rows = list(enumerate(WEIRD, 500))
    for d in range(60):
        parts = []
        for _ in range(rng.randrange(1, 4)):
            parts += [rng.choice(words) for _ in range(rng.randrange(0, 60))]
            p = list(rng.choice(passages))
            if rng.random() < 0.4:
                p[rng.randrange(len(p))] = "edited"
            parts += p * rng.choice([1, 1, 2])
        rows.append((d, rng.choice([" ", "\n", "  \t"]).join(parts)))
    rows += [(3, rows[20][1]), (20, rows[20][1]), (None, rows[30][1]), (61, rows[30][1]), (61, rows[30][1]), (62, "w " * 200), (63, "w " * 120)]
    got = {}
    for r in substring.remove_repeats(documents(spark, rows), 50, bits).collect():
        got.setdefault(r.doc_id, []).append((r.n_words, r.n_removed, r.kept_text))
        assert sum(s.end - s.start for s in r.spans) == r.n_removed
    assert {d: sorted(v) for d, v in got.items()} == brute_removed(rows, 50)


def test_substring_dedup_of_an_empty_table(spark):
    assert substring.remove_repeats(documents(spark, []), 50, 10).count() == 0


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def test_banded_alignment_equals_the_full_table():
    rng = random.Random(5)
    for _ in range(1500):
        a = [rng.randrange(4) for _ in range(rng.randrange(0, 24))]
        b = list(a) if rng.random() < 0.7 else [rng.randrange(4) for _ in range(rng.randrange(0, 24))]
        for _ in range(rng.randrange(0, 6)):
            i, kind = rng.randrange(len(b) + 1), rng.random()
            if kind < 0.4:
                b.insert(i, rng.randrange(4))
            elif b and kind < 0.7:
                b.pop(min(i, len(b) - 1))
            elif b:
                b[min(i, len(b) - 1)] = rng.randrange(4)
        most, true = rng.randrange(0, 9), plain_distance(a, b)
        assert near_dedup.banded_distance(a, b, most) == (true if true <= most else None)


def test_sketches_keep_text_order():
    words = np.random.default_rng(2).integers(0, 1 << 60, 40).astype(np.uint64)
    turned = np.concatenate([words[20:], words[:20]])
    same = near_dedup.sketches(words, 1, 3, 64) == near_dedup.sketches(turned, 1, 3, 64)
    assert same.mean() < 0.6  # the same words in another order disagree where minima swap
    assert (near_dedup.sketches(words, 1, 1, 64) == near_dedup.sketches(turned, 1, 1, 64)).all()


def brute_classes(rows, least=0.8):
    texts = {}
    for d, t in rows:
        if d is not None:
            texts.setdefault(d, []).append(WORD.findall(t or ""))
    parent = {d: d for d in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in texts:
        for b in texts:
            if a < b and any(u and v and 1 - plain_distance(u, v) / max(len(u), len(v)) >= least for u in texts[a] for v in texts[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {d: root(d) for d in texts}


def test_near_duplicates_equal_brute_force(spark):
    rng, words = random.Random(8), vocabulary(200, 9)
    rows = list(enumerate(WEIRD, 500)) + [(511, "a b c"), (512, "  "), (None, "a b c")]
    shared = [rng.choice(words) for _ in range(40)]
    for base in range(9):
        text = [rng.choice(words) for _ in range(rng.randrange(30, 90))]
        if base % 3 == 0:
            text = shared + text
        for copy in range(rng.randrange(1, 6)):
            near = list(text)
            for _ in range(copy):
                near[rng.randrange(len(near))] = rng.choice(words)
            rows.append((base * 10 + copy, rng.choice([" ", "\n"]).join(near)))
    rows += [(200, rows[-1][1]), (201, rows[-1][1]), (201, rows[-1][1])]
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(documents(spark, rows)).collect()}
    assert got == brute_classes(rows)


def test_a_large_group_of_near_copies_is_one_class(spark):
    rng, words = random.Random(1), vocabulary(500, 4)
    text = [rng.choice(words) for _ in range(60)]
    rows = []
    for d in range(700):
        near = list(text)
        near[rng.randrange(60)] = f"w{d}"
        near[rng.randrange(60)] = f"v{d}"
        rows.append((d, " ".join(near)))
    docs = documents(spark, rows + [(900, " ".join(rng.choice(words) for _ in range(60)))])
    classes = near_dedup.near_duplicates(docs)
    assert {r.class_id for r in classes.collect()} == {0, 900}
    kept = near_dedup.first_of_each(docs, classes)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [0, 900]


def test_heads_of_a_crowded_bucket_meet_in_blocks(spark):
    rng, words = random.Random(6), vocabulary(400, 7)
    rows = [(d, " ".join(rng.choice(words) for _ in range(40))) for d in range(30)]
    rows += [(d + 100, rows[d][1].replace(" ", " extra ", 2)) for d in range(10)]
    docs = documents(spark, rows)
    heads = spark.createDataFrame([(1, d) for d, _ in rows] + [(2, d) for d, _ in rows[:3]], "value long, doc_id long")
    texts = spark.createDataFrame([(d, len(t.split()), [1, 2]) for d, t in rows], "doc_id long, n_words long, bands array<long>")
    found = {(min(r.a, r.b), max(r.a, r.b)) for r in near_dedup.met_by_heads(heads, texts, docs.select("doc_id", "text"), 0.8, block_rows=7).collect()}
    assert found == {(d, d + 100) for d in range(10)}


def test_members_that_head_nothing_meet(spark):
    """P begins the bucket, A is like P's class and B like Q's, and only A and B are alike across them."""
    rng, words = random.Random(21), vocabulary(3000, 8)
    base = [rng.choice(words) for _ in range(100)]

    def edited(lists):
        out = list(base)
        for name, places in lists:
            for p in places:
                out[p] = f"{name}{p}"
        return " ".join(out)

    texts = {
        0: " ".join(base[:3] + [f"z{i}" for i in range(97)]),  # the bucket's first, like nothing
        1: edited([("p", range(0, 16)), ("a", range(20, 26))]), 2: edited([("a", range(20, 26))]),
        3: edited([("q", range(40, 56)), ("b", range(60, 66))]), 4: edited([("b", range(60, 66))]),
    }
    table = documents(spark, list(texts.items()))
    sizes = spark.createDataFrame([(d, len(t.split()), [1, 2]) for d, t in texts.items()], "doc_id long, n_words long, bands array<long>")
    classes = {1: 1, 2: 1, 3: 3, 4: 3}
    members = spark.createDataFrame([(1, d, 100, c) for d, c in classes.items()], "value long, doc_id long, n_words long, class long")
    for rows in (256, 1):
        found = near_dedup.met_in_buckets(members, sizes, table.select("doc_id", "text"), 0.8, block_rows=rows).collect()
        assert {(min(r.a, r.b), max(r.a, r.b)) for r in found} == {(2, 4)}


def test_buckets_of_the_same_texts_meet_once(spark, monkeypatch):
    """Texts of two classes that share many buckets are copied for their blocks, not for each bucket."""
    def counted(least):
        def run(key, rows):
            return pa.table({"a": pa.array([key[0].as_py()]), "b": pa.array([key[1].as_py()], pa.int64()), "similarity": pa.array([float(rows.num_rows)])})
        return run

    monkeypatch.setattr(near_dedup, "_met", counted)
    docs = documents(spark, [(d, " ".join(f"w{d}x{i}" for i in range(50))) for d in range(40)])
    values = list(range(1, 61))
    members = spark.createDataFrame([(v, d, 50, d % 2) for v in values for d in range(40) if (v + d) % 10], "value long, doc_id long, n_words long, class long")
    texts = spark.createDataFrame([(d, 50, [v if (v + d) % 10 else 0 for v in values]) for d in range(40)], "doc_id long, n_words long, bands array<long>")
    found = near_dedup.met_in_buckets(members, texts, docs.select("doc_id", "text"), 0.8).collect()
    assert 40 <= sum(r.similarity for r in found) <= 40 * 4  # one copy for each of 60 buckets would be 2,160


@pytest.mark.parametrize("block_rows", [256, 3])
def test_links_in_arenas_are_those_of_all_pairs_that_share_a_bucket(spark, block_rows):
    rng, words = random.Random(31), vocabulary(2000, 9)
    rows, base = [], None
    for d in range(60):
        if d % 6 == 0:
            base = [rng.choice(words) for _ in range(rng.choice([20, 30, 40]))]
        near = list(base)
        for place in rng.sample(range(len(near)), rng.randrange(0, 6)):
            near[place] = f"n{d}x{place}"
        rows.append((d, near[: len(near) - rng.randrange(0, 4)]))
    classes = {d: d if d % 3 else 60 for d, _ in rows}
    buckets = {d: sorted(rng.sample(range(1, 25), 4)) for d, _ in rows}
    members = spark.createDataFrame([(v, d, len(t), classes[d]) for d, t in rows for v in buckets[d]], "value long, doc_id long, n_words long, class long")
    texts = spark.createDataFrame([(d, len(t), [v if v in buckets[d] else 0 for v in range(1, 25)]) for d, t in rows], "doc_id long, n_words long, bands array<long>")
    docs = documents(spark, [(d, " ".join(t)) for d, t in rows]).select("doc_id", "text")
    found = [(min(r.a, r.b), max(r.a, r.b)) for r in near_dedup.met_in_buckets(members, texts, docs, 0.8, block_rows=block_rows).collect()]
    want = {
        (a, b) for a, x in rows for b, y in rows
        if a < b and classes[a] != classes[b] and set(buckets[a]) & set(buckets[b]) and 1 - plain_distance(x, y) / max(len(x), len(y)) >= 0.8
    }
    assert len(found) == len(set(found)) and set(found) == want and len(want) > 20


def test_classes_are_those_of_all_pairs_that_share_a_bucket(spark, monkeypatch):
    """One bucket for all texts: classes are those of all-pairs alignment, whoever comes first."""
    monkeypatch.setattr(near_dedup, "_sketched", _one_bucket)
    rng, words = random.Random(22), vocabulary(3000, 8)
    rows = []
    for size in (50, 70):  # chains: the first is like the second, the second like the third
        near = [rng.choice(words) for _ in range(size)]
        for d in range(6):
            rows.append((100 * size + d, " ".join(near)))
            near = list(near)
            for place in range(d * 8, d * 8 + 8):
                near[place] = f"w{d}x{place}"
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(documents(spark, rows)).collect()}
    want = brute_classes(rows)
    assert got == want and set(want.values()) == {5000, 7000}


def _one_bucket(least, size, minima, bands, short):
    def run(batch):
        words, bounds = hashed_words(strings(batch.column("text")))
        n = batch.num_rows
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("digest"), pa.array(np.diff(bounds).astype(np.int64)), pa.array([[7]] * n, pa.list_(pa.int64()))],
                                         names=["doc_id", "digest", "n_words", "bands"])
    return run


def test_shared_words_are_counted():
    rng = random.Random(3)
    texts = [[rng.choice("abcdef") for _ in range(rng.randrange(0, 12))] for _ in range(20)]
    words, bounds = hashed_words(strings(pa.array([" ".join(t) for t in texts])))
    shared = near_dedup._shared(words, bounds)
    for i, a in enumerate(texts):
        assert shared(i).tolist() == [sum(min(a.count(w), b.count(w)) for w in "abcdef") for b in texts]


def test_pairs_near_the_limit_meet(spark):
    rng, words = random.Random(12), vocabulary(3000, 5)
    rows, n = [], 0
    for size, edits in [(5, 1), (10, 1), (10, 2), (30, 6), (41, 8), (60, 12), (65, 13), (200, 20), (200, 30), (200, 40)]:
        for _ in range(12):
            text = [rng.choice(words) for _ in range(size)]
            near = list(text)
            for place in rng.sample(range(size), edits):
                near[place] = f"new{n}x{place}"
            rows += [(2 * n, " ".join(text)), (2 * n + 1, " ".join(near))]
            n += 1
    rows += [(2 * n, "one two three four five"), (2 * n + 1, "one two three more four five")]
    rows += [(2 * n + 2, " ".join(f"v{i}" for i in range(33))), (2 * n + 3, " ".join(f"v{i}" for i in range(41)))]
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(documents(spark, rows)).collect()}
    assert sum(got[2 * i] != got[2 * i + 1] for i in range(n)) <= 1
    assert all(got[2 * i] == got[2 * i + 1] == 2 * i for i in (n, n + 1))


def test_near_duplicates_of_an_empty_table(spark):
    assert near_dedup.near_duplicates(documents(spark, [])).count() == 0


def test_digest_of_kept_text():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")


@pytest.mark.parametrize("kind", ["path", "star", "random", "two stars"])
def test_components_equal_union_find(spark, kind):
    rng = random.Random(4)
    order = list(range(400))
    rng.shuffle(order)
    if kind == "path":
        links = list(zip(order, order[1:]))
    elif kind == "star":
        links = [(order[0], n) for n in order[1:]] + [(7, 7)]
    elif kind == "random":
        links = [(rng.randrange(400), rng.randrange(400)) for _ in range(230)]
    else:
        links = [(order[0], n) for n in order[:200]] + [(order[200], n) for n in order[200:]] + [(order[5], order[300])]
    parent = list(range(400))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    want = {n: root(n) for a, b in links if a != b for n in (a, b)}
    table = spark.createDataFrame(links, "a long, b long")
    assert {r.node: r.label for r in near_dedup.components(table).collect()} == want
    half = len(links) // 2
    grown = near_dedup.widened(near_dedup.components(table.limit(half)), spark.createDataFrame(links[half:], "a long, b long"))
    assert {r.node: r.label for r in grown.collect()} == want
    assert near_dedup.components(table.limit(0)).count() == 0
