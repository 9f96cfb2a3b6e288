"""Merkle manifest, prefix trie and line dedup against plain Python and SQL."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.llm.cases import WEIRD, documents
from tests.llm.test_exact import checked, duck  # noqa: F401
from waymark.llm import line_dedup, merkle, ordering, prefix_trie

LONG = ["word " * 600_000, "x" * 3_000_000, "a long enough line of words\n" * 100_000]


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("name", ["op11_merkle_manifest", "op12_prefix_trie", "op13_line_dedup"])
def test_query_equals_sql(spark, sf, duck, name):  # noqa: F811
    checked(entry.queries()[name](spark, sf).toPandas(), entry.oracle_sql()[name], duck)


# ---- Merkle manifest ----------------------------------------------------------------------

def plain_tree(leaves, fan_out):
    """The top of a tree and each leaf's (left, right) sibling hashes."""
    nodes, paths = [(h, [i]) for i, h in enumerate(leaves)], [[] for _ in leaves]
    while len(nodes) > 1:
        up = []
        for start in range(0, len(nodes), fan_out):
            run = nodes[start: start + fan_out]
            for at, (_, below) in enumerate(run):
                for i in below:
                    paths[i].append(("".join(h for h, _ in run[:at]), "".join(h for h, _ in run[at + 1:])))
            up.append((sha("".join(h for h, _ in run)), [i for _, below in run for i in below]))
        nodes = up
    return nodes[0][0], paths


def plain_manifest(rows, fan_out=8):
    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    groups = defaultdict(list)
    for doc_id, text, lang in rows:
        groups[lang].append((doc_id is not None, doc_id or 0, sha("".join(map(field, (doc_id, "src", lang, 7, text)))), doc_id))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [plain_tree([r[2] for r in sorted(groups[g], key=lambda r: r[:3])], fan_out) for g in order]
    root, above = plain_tree([top for top, _ in trees], fan_out)
    return sorted(((r[3], r[2], top, root, path + above[i]) for i, (g, (top, paths)) in enumerate(zip(order, trees))
                   for r, path in zip(sorted(groups[g], key=lambda r: r[:3]), paths)), key=str)


def tree_table(spark, rows):
    return spark.createDataFrame([(d, t, g, "src", 7, "clash", 1, "x") for d, t, g in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, path string, size int, root string")


@pytest.mark.parametrize("sizes,fan_out", [([1], 8), ([9], 8), ([1, 8, 64, 65, 1], 8), ([140, 3], 2), ([1] * 20, 3), ([600], 8)])
def test_proofs_equal_a_plain_tree(spark, sizes, fan_out):
    langs = [None, "", "é", "z", "A"] + [f"l{i}" for i in range(20)]
    rows = [(100 * g + i, f"text {g} {i}", langs[g]) for g, n in enumerate(sizes) for i in range(n)]
    got = merkle.manifest(tree_table(spark, rows), fan_out=fan_out).select("doc_id", "leaf", "subroot", "root", "path").collect()
    assert sorted(((*r[:4], [tuple(s) for s in r.path]) for r in got), key=str) == plain_manifest(rows, fan_out)


def test_proofs_of_odd_rows(spark):
    rows = [(i, t, None if i % 2 else "en") for i, t in enumerate(WEIRD + LONG)] + [(3, WEIRD[3], None), (3, "other", None), (None, None, "en"), (None, "", "en"), (None, "", "en")]
    proofs = merkle.manifest(tree_table(spark, rows), carried={"tail": F.right("text", F.lit(2))})
    got = proofs.collect()
    assert sorted(((r.doc_id, r.leaf, r.subroot, r.root, [tuple(s) for s in r.path]) for r in got), key=str) == plain_manifest(rows)
    assert {r.tail for r in got if r.doc_id == 5} == {" c"}
    back = proofs.select(merkle.folded(F.col("leaf"), F.col("path")).alias("good"), merkle.folded(F.sha2("leaf", 256), F.col("path")).alias("bad"), "root").collect()
    assert all(r.good == r.root != r.bad for r in back)
    empty = merkle.manifest(tree_table(spark, []), carried={"tail": F.lit(1)})
    assert empty.count() == 0 and empty.columns == proofs.columns


def test_heavy_ancestors_and_many_groups(spark, monkeypatch):
    monkeypatch.setattr(merkle, "HEAVY_SHARE", 4)
    monkeypatch.setattr(ordering, "FEW_KEYS", 5)
    monkeypatch.setattr(ordering, "HEAVY_SHARE", 10)
    rows = [(i, f"t{i}", "hot" if i < 200 else f"l{i}") for i in range(260)]
    got = merkle.manifest(tree_table(spark, rows), fan_out=2).collect()
    assert sorted(((r.doc_id, r.leaf, r.subroot, r.root, [tuple(s) for s in r.path]) for r in got), key=str) == plain_manifest(rows, 2)


# ---- prefix trie --------------------------------------------------------------------------

def plain_trie(rows, base, head):
    stored = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            stored[conv].append((turn is not None, turn or 0, sha(f"{len(role.encode())}:{role}{text}"), role, text))
    turns = {c: [t[3:] for t in sorted(v)] for c, v in stored.items()}
    members = defaultdict(list)
    ends = defaultdict(list)
    for c in sorted(turns):
        built = turns.get(base(c), [])[: head(c)] + turns[c][head(c):]
        for d in range(len(built) + 1):
            members[tuple(built[:d])].append(c)
        ends[tuple(built)].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)

    def below(path):
        yield path
        for child in children[path]:
            yield from below(child)

    out = []
    for path, convs in members.items():
        sub = list(below(path))
        saved = sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in sub if p)
        out.append((convs[0], len(path), members[path[:-1]][0] if path else None, len(convs), len(children[path]), sum(not children[p] for p in sub), saved, sha(",".join(map(str, ends[path])))))
    return sorted(out, key=str)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def built(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, k int, depth string")
    conv = F.col("conv_id")
    return prefix_trie.prefix_trie(df, conv - conv % 5, F.crc32(conv.cast("string")) % 9)


def base_of(c):
    return c - (abs(c) % 5) * (1 if c >= 0 else -1)


def head_of(c):
    return zlib.crc32(str(c).encode()) % 9


@pytest.mark.parametrize("block", [4096, 3])
def test_trie_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(prefix_trie, "BLOCK", block)
    rng, rows = random.Random(block), []
    for c in [*range(0, 60), *range(-7, 0), 10**12, 10**12 + 1]:
        if c % 7 == 3:
            continue  # some bases are absent
        for t in range(rng.choice([1, 2, 5, 9, 12])):
            rows.append((c, t, ["user", "assistant"][t % 2], rng.choice(["a", "b", "é long text", ""]) if t > 1 else "hello"))
    rows += [(60, None, None, None), (60, None, None, None), (61, 3, "user", "same"), (61, 3, "user", "other"), (61, 3, None, "same"), (None, 1, "user", "x"), (62, 0, "user", "y" * 2_000_000)]
    rows += [(63, t, "user", str(t % 2)) for t in range(400)] + [(64, t, "user", str(t % 2)) for t in range(300)]
    got = built(spark, rows).collect()
    assert sorted((tuple(r[c] for c in COLUMNS) for r in got), key=str) == plain_trie(rows, base_of, head_of)


def test_one_conversation_over_many_ranges(spark):
    """A conversation that holds most rows takes its prefix values over range bounds, and a hot node its ids in pieces."""
    rows = [(5, t, "user", f"t{t // 7}") for t in range(900)] + [(c, 0, "user", "hello") for c in range(10, 400)]
    got = built(spark, rows).collect()
    assert sorted((tuple(r[c] for c in COLUMNS) for r in got), key=str) == plain_trie(rows, base_of, head_of)
    ids = list(range(900))
    pieces = [r for b in prefix_trie._pieces(100)([spark.createDataFrame([(1, 2, 3, i) for i in ids], "depth long, f1 long, f2 long, conv_id long").coalesce(1).toArrow().combine_chunks().to_batches()[0]]) for r in b.to_pylist()]
    assert len(pieces) > 50 and ",".join(p["ids"] for p in pieces) == ",".join(map(str, ids))


def test_values_compose():
    rng = np.random.default_rng(1)
    turns = rng.integers(0, 1 << 63, 50).astype(np.uint64)
    base = prefix_trie._BASES[0]

    def value(of):
        held = 0
        for e in of.tolist():
            held = (held * int(base) + e) & ((1 << 64) - 1)
        return held

    for cut in (0, 1, 20, 49, 50):
        whole = prefix_trie._compose(np.array([value(turns[:cut])], np.uint64), np.array([value(turns[cut:])], np.uint64), np.array([50 - cut]), base)
        assert int(whole[0]) == value(turns)


def test_an_unequal_node_stops_the_query(spark):
    row = "conv_id long, depth long, f1 long, f2 long, g1 long, g2 long, r1 long, r2 long, bytes long"
    same = spark.createDataFrame([(1, 1, 7, 7, 0, 0, 5, 5, 1), (2, 1, 7, 7, 0, 0, 5, 5, 1)], row)
    assert prefix_trie._nodes(same).first().n_convs == 2
    with pytest.raises(Exception, match="unequal turns"):
        prefix_trie._nodes(same.withColumn("r2", F.col("conv_id"))).collect()


def test_trie_of_an_empty_table(spark):
    assert built(spark, []).count() == 0
    assert built(spark, [(None, 0, "user", "x")]).count() == 0


# ---- line dedup ---------------------------------------------------------------------------

def plain_lines(rows, least=20, shared_by=3):
    held = defaultdict(set)
    for d, t in rows:
        if d is not None:
            for line in (t or "").split("\n"):
                held[line_dedup.line_key(line.encode()).decode()].add(d)
    out = []
    for d, t in rows:
        lines, kept = (t or "").split("\n"), []
        for line in lines:
            key = line_dedup.line_key(line.encode()).decode()
            docs = held[key]
            if d is None or len(key) < least or len(docs) < shared_by or d == max(docs):
                kept.append(line)
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def cut(spark, rows, **kw):
    docs = documents(spark, rows)
    got = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs, **kw)).collect()
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in got), key=str)


def test_line_dedup_equals_brute_force(spark):
    rng = random.Random(2)
    lines = [f"a shared line, number {i} of them" for i in range(12)] + ["short line", "é" * 19, "é" * 20, "  Padded Line Of Words Here\t", "padded line of words here", "PADDED LINE OF WORDS HERE\r", "É padded line of wOrds", ""]
    rows = [(d, "\n".join(rng.choice(lines) if rng.random() < 0.5 else f"own line {d} {i} and more" for i in range(rng.randrange(0, 12)))) for d in range(80)]
    rows += list(enumerate(WEIRD + LONG, 500)) + [(None, "\n".join(lines)), (7, rows[7][1]), (7, "\n".join(lines)), (9, "\n".join(lines[:5])), (600, LONG[2][:90]), (601, LONG[2][:200])]
    rows += [(d, "everyone has this very line of text\n" + "own text") for d in range(1000, 1300)]
    assert cut(spark, rows) == plain_lines(rows)
    assert cut(spark, rows[:90], least=5, shared_by=2) == plain_lines(rows[:90], 5, 2)


def test_a_line_over_many_ranges_stays_once(spark):
    rows = [(d, "the same line in all documents here\nand a second line of them all") for d in range(900)] + [(d, f"line of document number {d}") for d in range(900, 1000)]
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert cut(spark, rows) == plain_lines(rows)
        assert cut(spark, rows, shared_by=2) == plain_lines(rows, shared_by=2)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_bitmaps_are_small_and_for_changed_documents_only(spark):
    rows = [(d, "one line that many documents hold\n" + "\n".join(f"own {d} {i}" for i in range(4000))) for d in range(4)] + [(9, "nothing shared in this document")]
    bitmaps = {r.doc_id: r for r in line_dedup.keep_bitmaps(documents(spark, rows)).collect()}
    assert set(bitmaps) == {0, 1, 2} and all(r.n_lines == 4001 and r.n_dropped == 1 and len(r.keep) < 100 for r in bitmaps.values())


def test_line_dedup_of_an_empty_table(spark):
    assert cut(spark, []) == []
