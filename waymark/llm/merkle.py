"""A Merkle tree over a table, with a proof for every row by pointer jumping.

Rows are leaves. The leaves of a group (a language, say) ascend by id; runs of
``fan_out`` neighbours are hashed together until one node is left, the group's
subroot. The subroots, in order of their groups, are hashed to the root alike.

Proofs: each node below the root starts with a pointer to its parent and a
segment, the hashes of its run to its left and right. In each round a node
takes over its ancestor's pointer and appends its ancestor's segments, so the
distance doubles and a tree of h levels takes log2(h) rounds. Leaves don't
travel with their segments: a run of leaves is one row with its parent's id, and
takes the parent's finished path in the last join.

In the joins on an ancestor, those with over a thousandth of all descendants
are broadcast (fewer than a thousand nodes); a shuffle deals the others evenly.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.llm.ordering import join_keys, numbered
from waymark.session import pinned, written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
HEAVY_SHARE = 1_000
PATH = "array<struct<left:string,right:string>>"


def digest_of(*fields: Column) -> Column:
    """Hex SHA-256 over fields: ``-`` for null, else the length in bytes, a colon and the value."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def _joined(nodes: Column) -> Column:
    return F.array_join(F.transform(nodes, lambda n: n["hash"]), "")


def _segment(run: Column, at: Column) -> Column:
    """The hashes of a run to the left and right of its entry ``at`` (from 0)."""
    return F.struct(_joined(F.slice(run, F.lit(1), at)).alias("left"), _joined(F.slice(run, at + 2, F.size(run))).alias("right"))


def folded(leaf: Column, path: Column) -> Column:
    """The hash that a leaf and the segments above it give."""
    return F.aggregate(path, leaf, lambda held, step: F.sha2(F.concat(step["left"], held, step["right"]), 256))


def proof_digest(path: Column) -> Column:
    """SHA-256 over all sibling hashes of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def _id(tree: Column, level: int, place: Column) -> Column:
    return F.concat_ws("/", tree, F.lit(str(level)), place)


def _runs(nodes: DataFrame, fan_out: int, *carried: str) -> DataFrame:
    """One row for each ``fan_out`` neighbours of a tree: their entries in order, and their common hash."""
    entry = F.struct("place", "hash", *carried)
    grouped = nodes.groupBy("tree", "size", F.expr(f"place div {fan_out}").alias("up_place")).agg(F.array_sort(F.collect_list(entry)).alias("run"))
    return grouped.withColumn("up_hash", F.when(F.col("size") == 1, F.col("run")[0]["hash"]).otherwise(F.sha2(_joined(F.col("run")), 256)))


def _level_up(runs: DataFrame, fan_out: int) -> DataFrame:
    return runs.select("tree", F.expr(f"(size + {fan_out - 1}) div {fan_out}").alias("size"), F.col("up_place").alias("place"), F.col("up_hash").alias("hash"))


def _climb(nodes: DataFrame, level: int, largest: int, fan_out: int, top: Column, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Hash trees up to one node each: links (id, up, path) of the nodes from ``level`` on, and the tops (tree, hash)."""
    links, tops = [], []
    while True:
        tops.append(nodes.filter("size = 1").select("tree", "hash"))
        if largest == 1:
            return links, reduce(DataFrame.unionByName, tops)
        runs = written(_runs(nodes.filter("size > 1"), fan_out), f"{name}-{level}")
        up = F.when(F.col("size") <= fan_out, top).otherwise(_id(F.col("tree"), level + 1, F.col("up_place")))
        at = (F.col("entry.place") - F.col("up_place") * fan_out).cast("int")
        entries = runs.select("tree", "size", "up_place", "run", F.explode("run").alias("entry"))
        links.append(entries.select(_id(F.col("tree"), level, F.col("entry.place")).alias("id"), up.alias("up"), F.array(_segment(F.col("run"), at)).alias("path")))
        nodes, level, largest = _level_up(runs, fan_out), level + 1, -(-largest // fan_out)


def _jumped(links: DataFrame, depth: int) -> DataFrame:
    """For each node the segments from it to the root: (id, path). ``depth`` is the greatest distance to the root."""
    nodes = written(links, "links")
    while depth > 1:
        climbing = nodes.filter(F.col("up").isNotNull())
        ancestors = nodes.select(F.col("id").alias("up"), F.col("up").alias("__up"), F.col("path").alias("__path"))
        limit = max(nodes.count() // HEAVY_SHARE, HEAVY_SHARE)
        heavy, _ = pinned(climbing.groupBy("up").count().filter(F.col("count") > limit).select("up"))
        near = climbing.join(F.broadcast(ancestors.join(heavy, "up", "left_semi")), "up")
        far = climbing.join(heavy, "up", "left_anti").join(ancestors, "up")
        moved = near.unionByName(far).select("id", F.col("__up").alias("up"), F.concat("path", "__path").alias("path"))
        nodes, depth = written(moved.unionByName(nodes.filter(F.col("up").isNull())), "jumped"), -(-depth // 2)
    return nodes.select("id", "path")


def _height(n: int, fan_out: int) -> int:
    levels = 0
    while n > 1:
        n, levels = -(-n // fan_out), levels + 1
    return levels


def manifest(docs: DataFrame, carried: dict[str, Column] | None = None, fields: tuple[str, ...] = FIELDS, group: str = "lang", order: str = "doc_id", fan_out: int = 8) -> DataFrame:
    """Each row's leaf, subroot, root and path.

    Returns ``order``, the ``carried`` expressions over a row, leaf, subroot,
    root and path (left and right sibling hashes of each level, leaf first).

    Null fields count as ``-``, so null and empty differ. A null group is a
    group of its own, the first; null ids come first in it. Rows of equal ids
    follow each other by leaf hash; repeated rows are leaves of their own. Texts
    of any length are hashed whole where they lie; only hashes move. An empty
    table has no leaves and gives no rows. Columns not named are ignored.
    """
    spark, carried = docs.sparkSession, carried or {}
    leaf = digest_of(*[F.col(f) for f in fields])
    leaves = written(docs.select(F.col(group).cast("string").alias("group"), F.col(order).alias("order"), leaf.alias("hash"), *[c.alias(f"own_{n}") for n, c in carried.items()]), "leaves")
    ordered = numbered(leaves, ["group", "order", "hash"], "ordered-leaves")
    counts = written(ordered.groupBy("group").agg(F.min("number").alias("first"), F.count(F.lit(1)).alias("size")), "groups")
    groups = written(numbered(counts, ["group"], "ordered-groups").withColumn("tree", F.col("number").cast("string")).select("group", "first", "size", "tree"), "trees")
    n_groups, largest = groups.agg(F.count(F.lit(1)), F.max("size")).first()
    own = [f"own_{n}" for n in carried]
    if not n_groups:
        return leaves.select(F.col("order").alias(order), *[F.col(c).alias(c[4:]) for c in own], F.col("hash").alias("leaf"), F.col("hash").alias("subroot"), F.col("hash").alias("root"), F.lit(None).cast(PATH).alias("path"))

    placed = join_keys(ordered, groups, ["group"], "size").withColumn("place", F.col("number") - F.col("first"))
    runs = written(_runs(placed, fan_out, "order", *own), "runs")
    in_groups, tops = _climb(_level_up(runs, fan_out), 1, -(-largest // fan_out), fan_out, _id(F.lit("root"), 0, F.col("tree")), "nodes")
    subroots = written(tops.select(F.lit("root").alias("tree"), F.lit(n_groups).alias("size"), F.col("tree").cast("long").alias("place"), "hash"), "subroots")
    above, root = _climb(subroots, 0, n_groups, fan_out, F.lit(None).cast("string"), "top")
    root_hash = root.first()["hash"]
    links = in_groups + above
    if n_groups == 1:  # the only subroot is the root
        links = [part.withColumn("up", F.when(F.col("up") != "root/0/0", F.col("up"))) for part in links]
    depth = _height(-(-largest // fan_out), fan_out) + _height(n_groups, fan_out)
    first_up = F.when(F.col("size") <= fan_out, _id(F.lit("root"), 0, F.col("tree"))).otherwise(_id(F.col("tree"), 1, F.col("up_place")))
    keyed = runs.withColumn("id", first_up)
    if links:
        paths = _jumped(reduce(DataFrame.unionByName, links), depth)
        keyed = keyed.join(paths, "id", "left")
    else:
        keyed = keyed.withColumn("path", F.lit(None).cast(PATH))
    nothing = F.array().cast(PATH)
    entry = keyed.select("size", "up_place", "run", F.coalesce("path", nothing).alias("path"), F.explode("run").alias("entry"))
    at = (F.col("entry.place") - F.col("up_place") * fan_out).cast("int")
    first = F.when(F.col("size") > 1, F.array(_segment(F.col("run"), at))).otherwise(nothing)
    levels = F.size(F.filter(F.lit([fan_out ** i for i in range(_height(largest, fan_out) + 1)]), lambda p: p < F.col("size")))
    out = entry.select("size", F.col("entry.order").alias(order), *[F.col(f"entry.{c}").alias(c[4:]) for c in own], F.col("entry.hash").alias("leaf"), F.concat(first, "path").alias("path"))
    subroot = folded(F.col("leaf"), F.slice("path", F.lit(1), levels))
    return out.select(order, *carried, "leaf", subroot.alias("subroot"), F.lit(root_hash).alias("root"), "path")
