"""Near-duplicate documents by Order MinHash, verified by banded alignment.

The k-mers of a text are its runs of three words, and of short texts its words,
each labelled with how often the same run came before. For each of ``bands`` hash functions a sketch takes the
``minima`` least labelled k-mers and keeps them in text order, so two texts agree
on a band when they share those k-mers and have them in one order.

Equal texts are joined first, by their digest. In each bucket of equal band
values the least document meets the others: a bucket of any size costs one pair
a member. Pairs are aligned word by word inside the band of diagonals that the
similarity allows, and what is similar enough becomes a link. Classes are the
connected components. Where a bucket still holds several classes, all its members
of different classes are then aligned with each other, block by block: two texts
of one bucket end in different classes only if they are not similar enough.
Buckets of nearly the same texts meet as one arena, so texts are not copied for each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.llm.text import grams, hashed_words, mapped, mixed, strings
from waymark.session import written

#: Of short texts, the sketch of single words: three in one order, so that few strangers share one.
SHORT_MINIMA, SHORT_BANDS = 3, 40
_SEEDS = np.random.default_rng(4711).integers(0, 1 << 63, (2, 256), dtype=np.uint64) | np.uint64(1)


def _least(hashes: np.ndarray, count: int) -> np.ndarray:
    """The columns of the ``count`` least values of each row, in ascending order of column."""
    rows, n = hashes.shape
    if n <= count:
        return np.broadcast_to(np.arange(n), (rows, n))
    if n > 16 * count:
        # Values below a limit that several times ``count`` of them should pass; sorting these few is enough.
        limit = np.uint64((1 << 64) // n * (6 * count))
        row, column = np.nonzero(hashes < limit)
        found = np.bincount(row, minlength=rows)
        if found.min() >= count:
            order = np.lexsort((hashes[row, column], row))
            first = np.cumsum(found) - found
            return np.sort(column[order][first[:, None] + np.arange(count)], axis=1)
    return np.sort(np.argpartition(hashes, count - 1, axis=1)[:, :count], axis=1)


def sketches(words: np.ndarray, size: int, minima: int, bands: int) -> np.ndarray:
    """The band values of one text of at least one word."""
    kmers = grams(words, min(size, len(words)), 21)
    order = np.argsort(kmers, kind="stable")
    ranked = kmers[order]
    fresh = np.append(True, ranked[1:] != ranked[:-1])
    first = np.flatnonzero(fresh)
    before = np.arange(len(ranked)) - np.repeat(first, np.diff(np.append(first, len(ranked))))
    labelled = np.empty_like(kmers)
    labelled[order] = mixed(ranked ^ mixed(before.astype(np.uint64), 22), 23)
    out = np.empty(bands, dtype=np.uint64)
    step = max(1, (1 << 20) // len(labelled))
    with np.errstate(over="ignore"):
        for at in range(0, bands, step):
            bits = slice(at, min(bands, at + step))
            hashes = (labelled ^ _SEEDS[0, bits, None]) * _SEEDS[1, bits, None]
            chosen = _least(hashes, minima)
            total = np.zeros(hashes.shape[0], dtype=np.uint64)
            for place in range(chosen.shape[1]):  # in text order
                total = mixed(total * np.uint64(0x100000001B3) + labelled[chosen[:, place]], 24)
            out[bits] = mixed(total + np.arange(bits.start, bits.stop, dtype=np.uint64), 25)
    return out


def _both_sketches(words: np.ndarray, least: float, size: int, minima: int, bands: int, short: int) -> np.ndarray:
    """Bands of runs, then of single words; 0 where a text is too short or too long for them. Two similar texts have one kind in common."""
    runs = sketches(words, size, minima, bands) if len(words) >= max(size, int(least * short)) else np.zeros(bands, np.uint64)
    singles = sketches(words, 1, SHORT_MINIMA, SHORT_BANDS) if len(words) <= short else np.zeros(SHORT_BANDS, np.uint64)
    return np.concatenate([runs, singles])


def _sketched(least: float, size: int, minima: int, run_bands: int, short: int):
    bands = run_bands + SHORT_BANDS

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        words, bounds = hashed_words(strings(batch.column("text")))
        full = np.flatnonzero(np.diff(bounds) > 0)
        values = [_both_sketches(words[bounds[i]: bounds[i + 1]], least, size, minima, run_bands, short) for i in full.tolist()]
        flat = np.concatenate(values).view(np.int64) if values else np.zeros(0, np.int64)
        rows = pa.array(full)
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id").take(rows), batch.column("digest").take(rows), pa.array(np.diff(bounds)[full].astype(np.int64)),
            pa.ListArray.from_arrays(pa.array((np.arange(len(full) + 1) * bands).astype(np.int32)), pa.array(flat)),
        ], names=["doc_id", "digest", "n_words", "bands"])
    return run


def banded_distance(a: list, b: list, most: int) -> int | None:
    """Words to insert, delete or replace to turn one list into the other; None if more than ``most``.

    Only cells within ``most`` of the main diagonal are computed. One integer
    holds the vertical differences of a column's cells as bits; the band moves
    down a row with each column. Cells outside count as one more than their
    neighbours, which no best path within the band needs.
    """
    if len(a) < len(b):
        a, b = b, a
    start, end = 0, 0
    while start < len(b) and a[start] == b[start]:
        start += 1
    while end < len(b) - start and a[len(a) - 1 - end] == b[len(b) - 1 - end]:
        end += 1
    a, b = a[start: len(a) - end], b[start: len(b) - end]
    extra = len(a) - len(b)
    if extra > most:
        return None
    if not b:
        return extra
    places: dict = {}
    for i, word in enumerate(a):
        places[word] = places.get(word, 0) | 1 << i
    k = most
    mask, top = (1 << (2 * k + 1)) - 1, 1 << 2 * k
    goal = 1 << (k + extra)
    fewer, more = (1 << (k + 1)) - 1, mask ^ ((1 << (k + 1)) - 1)
    distance = extra
    for j, word in enumerate(b):
        match = places.get(word, 0)
        shift = j - k
        match = (match >> shift if shift >= 0 else match << -shift) & mask
        more, fewer = more >> 1 | top, fewer >> 1
        same = match | fewer
        diagonal = (((same & more) + more) ^ more | same) & mask
        if not diagonal & goal:
            distance += 1
            if distance > most:
                return None
        plus, minus = fewer | mask & ~(diagonal | more), more & diagonal
        plus, minus = plus << 1 | 1, minus << 1
        more, fewer = (minus | ~(diagonal | plus)) & mask, plus & diagonal & mask
    return distance


def edit_similarity(a: np.ndarray, b: np.ndarray, least: float) -> float | None:
    """1 - distance / words of the longer text, or None below ``least``."""
    longer = max(len(a), len(b))
    most = int((1 - least) * longer + 1e-9)
    if abs(len(a) - len(b)) > most:
        return None
    # Words in common, counted: each one missing costs an edit.
    (x, m), (y, n) = np.unique(a, return_counts=True), np.unique(b, return_counts=True)
    _, at, to = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    if longer - np.minimum(m[at], n[to]).sum() > most:
        return None
    one, other = a.tolist(), b.tolist()
    for band in sorted({min(most, 16), most}):
        distance = banded_distance(one, other, band)
        if distance is not None:
            return 1 - distance / longer
    return None


def _aligned(least: float):
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        (a, at), (b, bt) = (hashed_words(strings(batch.column(c))) for c in ("text_a", "text_b"))
        found = [edit_similarity(a[at[i]: at[i + 1]], b[bt[i]: bt[i + 1]], least) for i in range(batch.num_rows)]
        keep = pa.array([f is not None for f in found])
        yield pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b"), pa.array(found, pa.float64())], names=["a", "b", "similarity"]).filter(keep)
    return run


def verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Of pairs (a, b) of document ids those similar enough, with their similarity; ``texts`` has doc_id and text of all of them."""
    first = pairs.join(texts.withColumnRenamed("text", "text_a"), F.col("a") == F.col("doc_id")).drop("doc_id")
    both = first.join(texts.withColumnRenamed("text", "text_b"), F.col("b") == F.col("doc_id")).drop("doc_id")
    found = mapped(both.select("a", "b", "text_a", "text_b"), _aligned(least), "a long, b long, similarity double", "text_a")
    return found.groupBy("a", "b").agg(F.max("similarity").alias("similarity"))


def _flat(hooks: DataFrame) -> DataFrame:
    """(node, label) with every label replaced by the last one its own labels lead to. Chains halve each round."""
    while True:
        up = hooks.filter("node <> label").select(F.col("node").alias("label"), F.col("label").alias("above"))
        if hooks.join(up, "label", "left_semi").isEmpty():
            return hooks
        hooks = written(hooks.join(up, "label", "left").select("node", F.coalesce("above", "label").alias("label")), "hooks")


def _renamed(links: DataFrame, labels: DataFrame) -> DataFrame:
    """Links between the labels of their ends, each once, without those inside one label; an end without label stands for itself."""
    first = labels.select(F.col("node").alias("a"), F.col("label").alias("label_a"))
    second = labels.select(F.col("node").alias("b"), F.col("label").alias("label_b"))
    both = links.join(first, "a", "left").join(second, "b", "left").select(F.coalesce("label_a", "a").alias("a"), F.coalesce("label_b", "b").alias("b"))
    return both.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """Each node of links (a, b) and the least node of its component.

    In each round a node hooks to its least neighbour, the trees that arise are
    shrunk to their roots, and links are renamed by them and made distinct. At
    least half of the nodes that still have links vanish, and with them the
    links inside a tree, so a group of many texts is soon a few links.
    """
    edges = written(links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    labels = None
    while labels is None or not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        hooks = _flat(written(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")), "hooks"))
        if labels is None:
            labels = hooks
        else:
            above = hooks.select(F.col("node").alias("label"), F.col("label").alias("above"))
            labels = written(labels.join(above, "label", "left").select("node", F.coalesce("above", "label").alias("label")), "labels")
        edges = written(_renamed(edges, hooks), "links")
    return labels


def widened(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The components after further links, from those before them."""
    further = components(_renamed(links, labels))
    above = further.select(F.col("node").alias("label"), F.col("label").alias("above"))
    known = labels.join(above, "label", "left").select("node", F.coalesce("above", "label").alias("label"))
    return written(known.unionByName(further.join(labels, "node", "left_anti")), "labels")


def _shared(words: np.ndarray, bounds: np.ndarray):
    """For a text of a batch, how many words it has in common with each text, counted as often as both hold them."""
    of = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((words, of))
    ranked, text = words[order], of[order]
    fresh = np.ones(len(ranked), dtype=bool)
    fresh[1:] = (ranked[1:] != ranked[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(fresh)
    before = np.arange(len(ranked)) - np.repeat(first, np.diff(np.append(first, len(ranked))))
    # The n-th of a text's equal words is a word of its own: at most once in any text.
    _, number = np.unique(mixed(ranked ^ mixed(before.astype(np.uint64), 22), 23), return_inverse=True)
    held = text[np.argsort(number, kind="stable")]
    ends = np.append(0, np.cumsum(np.bincount(number))) if len(number) else np.zeros(1, np.int64)

    def with_each(i: int) -> np.ndarray:
        mine = number[bounds[i]: bounds[i + 1]]
        sizes = ends[mine + 1] - ends[mine]
        at = np.repeat(ends[mine] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        return np.bincount(held[at], minlength=len(bounds) - 1)
    return with_each


def _meet_in(values: np.ndarray, homes: np.ndarray, bounds: np.ndarray, arena: int):
    """For a text of a batch, whether the least bucket it has in common with each text is of this arena. A text's buckets ascend."""
    _, number = np.unique(values, return_inverse=True)
    held = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[np.argsort(number, kind="stable")]
    ends = np.append(0, np.cumsum(np.bincount(number)))

    def with_each(i: int) -> np.ndarray:
        here = np.zeros(len(bounds) - 1, dtype=bool)
        for at in range(bounds[i + 1] - 1, bounds[i] - 1, -1):  # the least bucket comes last and decides
            here[held[ends[number[at]]: ends[number[at] + 1]]] = homes[at] == arena
        return here
    return with_each


def _met(least: float):
    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        arena, _, low, high = (k.as_py() for k in key)
        block, ids = np.array(rows.column("block").to_pylist()), rows.column("doc_id").to_pylist()
        classes, own = rows.column("class").to_numpy(), rows.column("own").to_numpy(zero_copy_only=False)
        values, homes = (rows.column(c).combine_chunks() for c in ("values", "homes"))
        opened = np.append(0, np.cumsum(pc.list_value_length(values).to_numpy()))
        here = _meet_in(values.flatten().to_numpy(), homes.flatten().to_numpy(), opened, arena)
        words, bounds = hashed_words(strings(rows.column("text")))
        sizes, found, shared = np.diff(bounds), [], _shared(words, bounds)
        for i in np.flatnonzero(block == low).tolist():
            longer = np.maximum(sizes, sizes[i])
            most = ((1 - least) * longer + 1e-9).astype(np.int64)
            fits = (block == high) & (classes != classes[i]) & (own | own[i]) & (np.abs(sizes - sizes[i]) <= most)
            if low == high:
                fits[: i + 1] = False
            # Of the arenas that both are in, the one of their least common bucket aligns them.
            others = np.flatnonzero(fits & here(i)) if fits.any() else np.zeros(0, np.int64)
            # Words in common, counted: each one missing costs an edit.
            others = others[longer[others] - shared(i)[others] <= most[others]] if len(others) else others
            for j in others.tolist():
                similarity = edit_similarity(words[bounds[i]: bounds[i + 1]], words[bounds[j]: bounds[j + 1]], least)
                if similarity is not None:
                    found.append((ids[i], ids[j], similarity))
        a, b, similarity = zip(*found) if found else ((), (), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "similarity": pa.array(similarity, pa.float64())})
    return run


def arenas(members: DataFrame, least: float) -> DataFrame:
    """Where each text meets others: doc_id, hall, class, own, n_words, and the buckets open to it there with the arena of each (values, homes).

    Texts that may be similar are of one room of lengths or of two next to each
    other, and meet in the upper one's hall, which is open if it holds several
    classes. Halls of many buckets may hold nearly the same texts; those with the
    same text of least hash share an arena, so halls that are alike mostly do.
    """
    room = F.floor(F.log("n_words") / (1e-6 - math.log(least))).cast("int")  # a little wide, so that rounding parts no two
    members = members.withColumn("room", room)
    rooms = members.groupBy("value", "room").agg(F.min("class").alias("least"), F.max("class").alias("most"), F.min(F.xxhash64("doc_id")).alias("first"))
    halls = rooms.withColumn("hall", F.explode(F.array(F.col("room"), F.col("room") + 1))).groupBy("value", "hall").agg(
        F.min("least").alias("least"), F.max("most").alias("most"), F.max(F.col("hall") == F.col("room")).alias("used"), F.min("first").alias("arena"))
    doors = halls.filter("least <> most AND used").select("value", "hall", "arena", F.explode(F.array(F.col("hall") - 1, F.col("hall"))).alias("room"))
    doors = doors.groupBy("value", "room").agg(F.collect_list(F.struct("hall", "value", "arena")).alias("doors"))  # at most two
    held = members.join(doors, ["value", "room"]).groupBy("doc_id").agg(
        F.min("class").alias("class"), F.max("n_words").alias("n_words"), F.collect_set("room").alias("rooms"), F.flatten(F.collect_list("doors")).alias("doors"))  # at most two a band
    held = held.withColumn("hall", F.explode(F.array_distinct("doors.hall")))
    here = F.sort_array(F.array_distinct(F.transform(F.filter("doors", lambda d: d["hall"] == F.col("hall")), lambda d: F.struct(d["value"], d["arena"]))))
    held = held.select("doc_id", "hall", "class", F.array_contains("rooms", F.col("hall")).alias("own"), "n_words", here.alias("open"))
    return held.select("doc_id", "hall", "class", "own", "n_words", F.col("open.value").alias("values"), F.col("open.arena").alias("homes"))


def met_in_buckets(members: DataFrame, texts: DataFrame, met: DataFrame, least: float, block_rows: int = 256, block_words: int = 2_000_000) -> DataFrame:
    """All links between texts of one bucket and different classes; ``members`` has value, doc_id, n_words and class.

    An arena's texts are dealt into blocks of bounded rows and words, and each pair
    of blocks is one group, so no task gathers a whole bucket and no pair becomes
    a row before it is a link. A text is copied for its arenas, not for each of its buckets. A class that
    fills more than one block has blocks of its own, which do not meet each other. Of ``texts`` nothing is read.
    """
    held = written(arenas(members, least), "halls")
    entered = held.withColumn("arena", F.explode(F.array_distinct("homes")))

    def blocks(n: str, words: str) -> Column:
        return F.greatest(F.ceil(F.col(n) / block_rows), F.ceil(F.col(words) / block_words)).cast("int")

    sizes = entered.groupBy("arena", "hall", "class").agg(F.count("*").alias("n"), F.sum("n_words").alias("words"))
    # Classes of one block share blocks, whose owner is the empty string.
    owners = sizes.withColumn("owner", F.when(blocks("n", "words") > 1, F.col("class").cast("string")).otherwise(""))
    owned = owners.groupBy("arena", "hall", "owner").agg(F.sum("n").alias("n"), F.sum("words").alias("words")).select("arena", "hall", "owner", blocks("n", "words").alias("blocks"))
    layout = owned.groupBy("arena", "hall").agg(F.map_from_entries(F.collect_list(F.struct("owner", "blocks"))).alias("layout"))  # few: owners fill blocks
    dealt = entered.join(layout, ["arena", "hall"]).withColumn("owner", F.when(F.map_contains_key("layout", F.col("class").cast("string")), F.col("class").cast("string")).otherwise(""))

    def named(owner: Column, number: Column) -> Column:
        return F.concat(owner, F.lit(":"), number.cast("string"))

    strangers = F.filter(F.map_entries("layout"), lambda e: (e["key"] == "") | (e["key"] != F.col("owner")))
    facing = F.flatten(F.transform(strangers, lambda e: F.transform(F.sequence(F.lit(0), e["value"] - 1), lambda k: named(e["key"], k))))
    dealt = dealt.withColumn("block", named(F.col("owner"), F.pmod(F.xxhash64("doc_id"), F.element_at("layout", F.col("owner")))))
    dealt = dealt.select("arena", "hall", "doc_id", "class", "own", "values", "homes", "block", facing.alias("facing")).join(met, "doc_id").withColumn("facing", F.explode("facing"))
    met_blocks = dealt.select("arena", "hall", F.least("block", "facing").alias("low"), F.greatest("block", "facing").alias("high"), "block", "doc_id", "class", "own", "values", "homes", "text")
    grouped = met_blocks.groupBy("arena", "hall", "low", "high")
    return grouped.applyInArrow(_met(least), "a long, b long, similarity double").groupBy("a", "b").agg(F.max("similarity").alias("similarity"))


def met_by_heads(heads: DataFrame, texts: DataFrame, met: DataFrame, least: float, block_rows: int = 256, block_words: int = 2_000_000) -> DataFrame:
    """Links between any two texts of one bucket (value, doc_id), each a class of its own."""
    members = heads.join(texts.select("doc_id", "n_words"), "doc_id").withColumn("class", F.col("doc_id"))
    return met_in_buckets(members, texts, met, least, block_rows, block_words)


def _open(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs (a, b) whose ends are of different components."""
    first = labels.select(F.col("node").alias("a"), F.col("label").alias("label_a"))
    second = labels.select(F.col("node").alias("b"), F.col("label").alias("label_b"))
    both = pairs.join(first, "a", "left").join(second, "b", "left")
    return both.filter(F.coalesce("label_a", "a") != F.coalesce("label_b", "b")).select("a", "b")


def _fits(a: str, b: str, least: float) -> Column:
    """Whether two lengths in words allow the similarity at all."""
    return (1 - least) * F.greatest(a, b) + 1e-9 >= F.abs(F.col(a) - F.col(b))


def near_duplicates(docs: DataFrame, least: float = 0.8, size: int = 3, minima: int = 2, bands: int = 72, short: int = 64) -> DataFrame:
    """One row per doc_id with its class: doc_id, class_id (the least doc_id in it), exact_of (the least doc_id of equal text), n_words.

    ``least`` is the edit similarity by words from which two texts are linked.
    In texts of 200 words with a fifth replaced at random, a third of the three-word
    runs is common; such texts meet in some band with a probability of 0.999, and with 0.99 if the replaced
    words stand as far apart as they can. Texts of at most ``short`` words are also sketched by single words.

    Texts of no words and null texts are duplicates of nothing. Rows of one doc_id are one document; where
    their texts differ it is in the least of their classes. Rows with a null
    doc_id can't be named and are left out. Other columns are ignored.
    """
    keyed = docs.filter(F.col("doc_id").isNotNull()).select("doc_id", "text", F.md5("text").alias("digest"))
    sketched = mapped(keyed, _sketched(least, size, minima, bands, short), "doc_id long, digest string, n_words long, bands array<long>")
    # One row for each text; copies share its sketch, so any row's will do.
    texts = written(sketched.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.first("bands").alias("bands")), "texts")

    entries = texts.select("doc_id", "n_words", F.explode("bands").alias("value")).filter("value <> 0")
    leaders = entries.groupBy("value").agg(F.min(F.struct("doc_id", "n_words")).alias("first"), F.count("*").alias("n")).filter("n > 1")
    buckets = written(entries.join(leaders, "value").select("value", "doc_id", "n_words", F.col("first.doc_id").alias("first_id"), F.col("first.n_words").alias("first_words")), "buckets")
    met = written(keyed.select("doc_id", "text").join(buckets.select("doc_id").distinct(), "doc_id", "left_semi"), "met")

    stars = buckets.filter(F.col("doc_id") != F.col("first_id")).filter(_fits("n_words", "first_words", least)).select(F.col("first_id").alias("a"), F.col("doc_id").alias("b")).distinct()
    stars = written(stars, "pairs")
    # Each text first tries the least text it shares a bucket with; only pairs that are still of two classes are aligned after that.
    tries = stars.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    labels = components(verified(tries, met, least))
    labels = widened(labels, verified(_open(stars.join(tries, ["a", "b"], "left_anti"), labels), met, least))

    placed = buckets.join(labels, F.col("doc_id") == F.col("node"), "left").withColumn("class", F.coalesce("label", "doc_id"))
    # Each bucket's first text has met all others; of these any two that are still of different classes meet.
    others = placed.filter(F.col("doc_id") != F.col("first_id")).select("value", "doc_id", "n_words", "class")
    more = written(met_in_buckets(others, texts, met, least), "met-links")
    labels = widened(labels, more)

    firsts = texts.select("digest", F.col("doc_id").alias("exact_of"), "n_words")
    named = keyed.select("doc_id", "digest").join(firsts, "digest", "left").withColumn("exact_of", F.coalesce("exact_of", "doc_id"))
    return (
        named.join(labels, F.col("exact_of") == F.col("node"), "left")
        .groupBy("doc_id").agg(F.min(F.coalesce("label", "exact_of")).alias("class_id"), F.min("exact_of").alias("exact_of"), F.coalesce(F.max("n_words"), F.lit(0)).alias("n_words"))
    )


def first_of_each(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stand for their class, one of each, with all their columns; rows with a null doc_id stay."""
    kept = classes.filter("doc_id = class_id").select("doc_id")
    named = docs.filter(F.col("doc_id").isNotNull()).join(kept, "doc_id", "left_semi")
    copy = F.row_number().over(Window.partitionBy("doc_id").orderBy("text"))
    once = named.select(F.struct("*").alias("row"), copy.alias("copy")).filter("copy = 1").select("row.*")
    return once.select(*docs.columns).unionByName(docs.filter(F.col("doc_id").isNull()))
