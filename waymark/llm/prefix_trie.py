"""The trie of conversation prefixes, by fingerprints that compose.

A conversation may be rebuilt from the head of another one and its own later
turns. No rebuilt text is made. The fingerprint of a turn sequence is an element
of a monoid: a turn is the map x -> x * BASE + h (mod 2**64, h from its digest),
a sequence the composition of its turns' maps, kept as (power of BASE, value) in
two lanes of independent digest bits. From the prefix values of each stored
conversation follow those of every rebuilt one: a head's value is stored, and
head with suffix is head * BASE**n + (value to here - value before * BASE**n).

1. Turns are sorted over ranges of (conversation, turn) and their maps composed
   within each range; a conversation over several ranges takes the product of
   the ranges before. Only digests, lengths and numbers are moved.
2. Each rebuilt turn becomes a row (conversation, depth, fingerprint, the
   fingerprint before it, reference to its stored turn). Rows of equal depth and
   fingerprint are a node. The reference is the other half of the digest; a node
   whose rows differ in it, or in the fingerprint before, stops the query, as
   does a reference that two stored turns of different role or text share. By
   induction over depth all members of a node then have equal turns.
3. A node's smallest member carries its value. A member's values lie at the end
   of its path, so sums over a subtree are sums over members less a running
   total along the smallest one: no walk over the levels.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.llm.ordering import join_keys
from waymark.llm.text import bounded_broadcast
from waymark.session import written

_BASES = (np.uint64(0xD1342543DE82EF95), np.uint64(0x2545F4914F6CDD1D))
#: Turns of one conversation that one task joins or totals at a time.
BLOCK = 4096
NODE = ["depth", "f1", "f2"]
EMPTY = hashlib.sha256(b"").hexdigest()


def _long(half: Column) -> Column:
    return F.conv(half, 16, -10).cast("long")


def stored_turns(turns: DataFrame) -> DataFrame:
    """Each turn without its text: conv_id, turn, two lanes (e1, e2) and a reference (r1, r2) from its digest, bytes of its text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = turns.filter(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), digest.alias("d"), F.octet_length(text).cast("long").alias("bytes"))
    return rows.select("conv_id", "turn", "bytes", *[_long(F.substring("d", 1 + 16 * i, 16)).alias(n) for i, n in enumerate(("e1", "e2", "r1", "r2"))])


def check_references(turns: DataFrame, stored: DataFrame) -> None:
    """Raises if two turns of different role or text have one reference. Texts are compared where a reference repeats."""
    repeated = bounded_broadcast(written(stored.groupBy("r1", "r2").count().filter("count > 1").select("r1", "r2"), "repeated-references"))
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = turns.filter(F.col("conv_id").isNotNull()).select(role.alias("role"), text.alias("text"), _long(F.substring(digest, 33, 16)).alias("r1"), _long(F.substring(digest, 49, 16)).alias("r2"))
    contents = rows.join(repeated, ["r1", "r2"], "left_semi").distinct()
    if contents.groupBy("r1", "r2").count().filter("count > 1").limit(1).count():
        raise ValueError("two different turns have one reference")


def _powers(base: np.uint64, n: np.ndarray) -> np.ndarray:
    return np.power(base, n.astype(np.uint64))


def _compose(p: np.ndarray, suffix: np.ndarray, n: np.ndarray, base: np.uint64) -> np.ndarray:
    """The value of a sequence ``p`` followed by one of ``n`` turns of value ``suffix``."""
    return p * _powers(base, n) + suffix


def _u(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Composes the maps of a sorted range, from the start of the range or of the conversation: values with (p) and before (g) each turn."""
    number, conv, held, at = TaskContext.get().partitionId(), None, (0, 0), 0
    mask, (b1, b2) = (1 << 64) - 1, [int(b) for b in _BASES]
    for batch in batches:
        places, before, after = [], [], []
        for c, e1, e2 in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "e1", "e2"))):
            if c != conv:
                conv, held, at = c, (0, 0), 0
            at += 1
            places.append(at)
            before.append(held)
            held = ((held[0] * b1 + e1) & mask, (held[1] * b2 + e2) & mask)
            after.append(held)
        lanes = [np.array(pairs, np.uint64).reshape(-1, 2)[:, i].copy().view(np.int64) for pairs in (after, before) for i in (0, 1)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), pa.array([number] * len(places), pa.int32()), pa.array(places, pa.int64()), *map(pa.array, lanes), *[batch.column(c) for c in ("r1", "r2", "bytes")]],
            names=_names(PREFIX))


def _shifted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Puts the turns of earlier ranges (n0 of value q) before those of a range."""
    for b in batches:
        k, lanes = _u(b, "k"), []
        for lane, n in (("p", k), ("g", k - np.uint64(1))):
            lanes += [_compose(_u(b, f"q{i}"), _u(b, f"{lane}{i}"), n, base).view(np.int64) for i, base in enumerate(_BASES, 1)]
        yield pa.RecordBatch.from_arrays(
            [b.column("conv_id"), b.column("slice"), pa.array((_u(b, "n0") + k).view(np.int64)), *map(pa.array, lanes), *[b.column(c) for c in ("r1", "r2", "bytes")]], names=_names(PREFIX))


def _carried(prefixes: DataFrame) -> DataFrame:
    """Prefix values from the start of each conversation, where one lies over several ranges."""
    parts = prefixes.groupBy("conv_id", "slice").agg(F.max("k").alias("n"), F.max_by(F.struct("p1", "p2"), "k").alias("p"))
    several = parts.groupBy("conv_id").agg(F.collect_list(F.struct("slice", "n", "p")).alias("parts")).filter(F.size("parts") > 1)
    starts = []
    # Ranges share a conversation only with their neighbours, so all these parts together are fewer than twice the ranges.
    for r in several.collect():
        n, value = 0, [np.zeros(1, np.uint64)] * 2
        for part in sorted(r["parts"], key=lambda x: x["slice"]):
            if n:
                starts.append((r["conv_id"], part["slice"], n, *[int(v.view(np.int64)[0]) for v in value]))
            own = np.array(part["p"], np.int64).view(np.uint64)
            value = [_compose(v, own[i], np.array([part["n"]]), _BASES[i]) for i, v in enumerate(value)]
            n += part["n"]
    if not starts:
        return prefixes
    shift = prefixes.sparkSession.createDataFrame(starts, "conv_id long, slice int, n0 long, q1 long, q2 long")
    joined = prefixes.join(F.broadcast(shift), ["conv_id", "slice"], "left").na.fill(0, ["n0", "q1", "q2"])
    return joined.mapInArrow(_shifted, PREFIX)


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Own turns after ``own_head`` (of value s), put behind a head of ``head`` turns (of value h)."""
    for b in batches:
        n, lanes = _u(b, "k") - _u(b, "own_head"), []
        for lane, m in (("p", n), ("g", n - np.uint64(1))):
            for i, base in enumerate(_BASES, 1):
                power = _powers(base, m)
                lanes.append((_u(b, f"h{i}") * power + _u(b, f"{lane}{i}") - _u(b, f"s{i}") * power).view(np.int64))
        yield pa.RecordBatch.from_arrays([b.column("conv_id"), pa.array((_u(b, "head") + n).view(np.int64)), *map(pa.array, lanes), *[b.column(c) for c in ("r1", "r2", "bytes", "length")]], names=_names(PATHS))


PREFIX = "conv_id long, slice int, k long, p1 long, p2 long, g1 long, g2 long, r1 long, r2 long, bytes long"
PATHS = "conv_id long, depth long, f1 long, f2 long, g1 long, g2 long, r1 long, r2 long, bytes long, length long"


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def rebuilt_paths(prefixes: DataFrame, base: Column, head: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """A row for each turn of each rebuilt conversation, and one at depth 0; and a row (conv_id, length) for each conversation.

    ``base`` and ``head`` are expressions over conv_id: whose first turns come first, and how many (``most`` at most). A base
    should serve a bounded number of conversations.
    """
    zero = F.lit(0).cast("long")
    numbered = prefixes.withColumn("own_head", head.cast("long"))
    convs = numbered.groupBy("conv_id").agg(
        F.max("k").alias("n"), F.max("own_head").alias("own_head"),
        *[F.coalesce(F.max(F.when(F.col("k") == F.col("own_head"), F.col(f"p{i}"))), zero).alias(f"s{i}") for i in (1, 2)]).withColumn("base", base.cast("long"))
    element = F.struct("k", "p1", "p2", "g1", "g2", "r1", "r2", "bytes")
    heads = prefixes.filter(F.col("k") <= most).groupBy(F.col("conv_id").alias("base")).agg(F.array_sort(F.collect_list(element)).alias("turns"))
    joined = convs.join(heads, "base", "left").withColumn("turns", F.slice(F.coalesce("turns", F.array().cast(heads.schema["turns"].dataType)), F.lit(1), F.col("own_head").cast("int")))
    plans = written(joined.select(
        "conv_id", "own_head", "s1", "s2", "turns", F.size("turns").cast("long").alias("head"),
        *[F.when(F.size("turns") > 0, F.element_at("turns", -1)[f"p{i}"]).otherwise(zero).alias(f"h{i}") for i in (1, 2)],
        (F.size("turns") + F.greatest(F.col("n") - F.col("own_head"), zero)).alias("length")), "rebuilt")

    root = plans.select("conv_id", *[zero.alias(c) for c in _names(PATHS)[1:-1]], "length")
    first = plans.select("conv_id", "length", F.explode("turns").alias("t")).select("conv_id", *[F.col(f"t.{c}") for c in ("k", "p1", "p2", "g1", "g2", "r1", "r2", "bytes")], "length")
    # A conversation meets its rows range by range, so one of very many turns is not one task's.
    ranges = prefixes.select("conv_id", "slice").groupBy("conv_id", "slice").agg(F.count(F.lit(1)).alias("rows")).drop("rows")
    wanted = plans.drop("turns").join(ranges, "conv_id")
    own = prefixes.join(wanted, ["conv_id", "slice"]).filter("k > own_head").mapInArrow(_suffixes, PATHS)
    return written(root.union(first.select("conv_id", "k", "p1", "p2", "g1", "g2", "r1", "r2", "bytes", "length")).toDF(*_names(PATHS)).unionByName(own), "paths"), plans.select("conv_id", "length")


def _nodes(paths: DataFrame) -> DataFrame:
    """One row a node, whose members' last turns and ways there are found equal."""
    both = [c for c in ("g1", "g2", "r1", "r2")]
    grouped = paths.groupBy(*NODE).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("bytes").alias("bytes"),
                                       *[F.min(c).alias(c) for c in both], *[F.max(c).alias(f"max_{c}") for c in both])
    equal = F.lit(True)
    for c in both:
        equal = equal & (F.col(c) == F.col(f"max_{c}"))
    checked = F.when(equal, F.col("conv_id")).otherwise(F.raise_error(F.lit("unequal turns under one fingerprint")).cast("long"))
    return grouped.select(*NODE, checked.alias("conv_id"), "n_convs", "bytes", "g1", "g2")


def _pieces(limit: int):
    """Sorted (node, conv_id) rows as texts of comma-joined ids, each of one node and about ``limit`` bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids, size = None, [], 0

        def piece() -> tuple:
            return (*node, ids[0], ",".join(map(str, ids)))

        for batch in batches:
            out = []
            for *key, conv in zip(*(batch.column(c).to_pylist() for c in [*NODE, "conv_id"])):
                if ids and (key != node or size >= limit):
                    out.append(piece())
                    ids, size = [], 0
                node = key
                ids.append(conv)
                size += 12
            if out:
                yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*out))), names=[*NODE, "low", "ids"])
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in piece()], names=[*NODE, "low", "ids"])
    return run


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The SHA-256 of each node's pieces, which follow each other in order."""
    node, held = None, None
    for batch in batches:
        out = []
        for *key, ids in zip(*(batch.column(c).to_pylist() for c in [*NODE, "ids"])):
            if key != node:
                if held is not None:
                    out.append((*node, held.hexdigest()))
                node, held = key, hashlib.sha256(ids.encode())
            else:
                held.update(b"," + ids.encode())
        if out:
            yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*out))), names=[*NODE, "ends_sha256"])
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*node, held.hexdigest())], names=[*NODE, "ends_sha256"])


def _end_digests(paths: DataFrame) -> DataFrame:
    """SHA-256 of the ids that end at a node. The hash goes over them in order, so a node's ids meet in one task: as a stream of long texts, not as rows."""
    ends = paths.filter("depth = length").select(*NODE, "conv_id")
    pieces = ends.repartitionByRange(*NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id").mapInArrow(_pieces(1 << 16), "depth long, f1 long, f2 long, low long, ids string")
    return pieces.repartition(*NODE).sortWithinPartitions(*NODE, "low").mapInArrow(_ends, "depth long, f1 long, f2 long, ends_sha256 string")


def _running(nodes: DataFrame) -> DataFrame:
    """Adds ``before``: what the smallest member's nodes above this one carry, over blocks of depths."""
    block = F.floor(F.col("depth") / BLOCK).cast("long")
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    blocks = nodes.withColumn("block", block)
    sums = blocks.groupBy("conv_id", "block").agg(F.sum("value").alias("value")).select("conv_id", "block", F.coalesce(F.sum("value").over(earlier), F.lit(0)).alias("carry"))
    return blocks.withColumn("before", F.coalesce(F.sum("value").over(within), F.lit(0))).join(sums, ["conv_id", "block"]).withColumn("before", F.col("before") + F.col("carry")).drop("carry", "block")


def prefix_trie(turns: DataFrame, base: Column, head: Column, most: int = 8) -> DataFrame:
    """The nodes of the trie of rebuilt conversations.

    Each conv_id is rebuilt as the first ``head`` turns of conversation ``base``
    (both expressions over conv_id), then its own turns after its first
    ``head``. Returns, per distinct prefix: conv_id (smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens (bytes of the
    turns that a subtree's members share) and ends_sha256.

    Turns go by ``turn``, null first; of equal ones that of lower digest comes
    first, and repeated rows are turns of their own. Null roles and texts are
    empty. Rows without a conv_id are left out; a conversation without turns
    after rebuilding is a member of the root. Long texts are hashed where they
    lie. An empty table gives no rows. Other columns are ignored.
    """
    stored = written(stored_turns(turns), "stored-turns")
    check_references(turns, stored)
    # Digests as unsigned numbers, so that their order is that of their text.
    order = ["conv_id", F.asc_nulls_first("turn"), F.col("e1").bitwiseXOR(F.lit(-(1 << 63))), "e2", "r1", "r2"]
    scanned = stored.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_prefixes, PREFIX)
    prefixes = _carried(written(scanned, "prefixes"))
    paths, lengths = rebuilt_paths(prefixes, base, head, most)

    nodes = written(_nodes(paths), "nodes")
    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("g1").alias("f1"), F.col("g2").alias("f2")).agg(F.count(F.lit(1)).alias("n_children"))
    valued = written(nodes.join(children, NODE, "left").na.fill(0, ["n_children"]).withColumn("value", (F.col("n_convs") - 1) * F.col("bytes")), "valued-nodes")

    # What a conversation brings to each node it is a member of.
    brought = valued.groupBy("conv_id").agg(F.sum("value").alias("value"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf"))
    per_block = lengths.join(brought, "conv_id").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("length") / BLOCK).cast("long")))).drop("length")
    members = paths.select(*NODE, "conv_id", F.floor(F.col("depth") / BLOCK).cast("long").alias("block")).join(per_block, ["conv_id", "block"])
    sums = members.groupBy(*NODE).agg(F.sum("value").alias("brought"), F.sum("leaf").alias("n_leaves"))

    parents = written(valued.filter("n_children > 0").select((F.col("depth") + 1).alias("depth"), F.col("f1").alias("g1"), F.col("f2").alias("g2"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("weight")), "parents")
    below = join_keys(valued.filter("depth > 0").select(*NODE, "g1", "g2"), parents, ["depth", "g1", "g2"], "weight").select(*NODE, "parent_conv_id")
    out = _running(valued).join(sums, NODE, "left").join(below, NODE, "left").join(_end_digests(paths), NODE, "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.coalesce("n_leaves", F.lit(0)).alias("n_leaves"),
                      (F.coalesce("brought", F.lit(0)) - F.col("before")).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"))
