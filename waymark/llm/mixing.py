"""Mixing sources to target weights: a budget runs down a tree of domains, languages and sources.

Each node shares its budget among its children by their weights. A child that
can't use its share leaves the rest to its siblings, by their weights, and only
what all siblings together can't use is left to the level above; that is the
same as sharing at every level against the supply below each child. Shares are
whole tokens and follow from integers alone.

A leaf with a budget of several times its tokens reads whole epochs and, in a
last one, a prefix of a seeded order. The order is a hash of the id. Its first
digits cut a leaf into slices; totals by slice tell where the prefix ends, and
only the slice it ends in is sorted. So a leaf's selection is two values, the
whole epochs and the last hash, and texts are never shuffled.

Everything here is DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.llm.text import WORD, bounded_broadcast
from waymark.session import written

LEVELS = ("domain", "lang", "source")
#: Hexadecimal digits of the order's hash that number a slice.
SLICE_DIGITS = 3

Weights = Mapping[str, Mapping[str, int]]


def word_count(text: Column) -> Column:
    """Words stand for tokens, as no tokenizer runs here; null counts none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def source_domain(source: Column) -> Column:
    """One of four domains, for tables that name none."""
    digit = F.call_function("instr", F.lit("0123456789abcdef"), F.substring(F.md5(source), 1, 1))
    return F.concat(F.lit("domain"), F.floor((digit - 1) / 4).cast("string"))


def shared(children: DataFrame, parents: Sequence[str], name: str) -> DataFrame:
    """Adds ``granted`` to children (parents, name, weight, supply, budget): the parent's budget by weight, never above supply.

    Children are served in order of supply by weight. As long as a child's
    supply is below its part of what is left, it gets its supply; from the
    first that isn't, all get their parts, rounded down. One row is one node of
    the tree, not a document.
    """
    order = Window.partitionBy(*parents).orderBy(F.col("supply") / F.col("weight"), name)
    served = F.coalesce(F.sum("supply").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    among = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    exact = lambda c: c.cast("decimal(38,0)")
    first = Window.partitionBy(*parents).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (
        children.withColumn("place", F.row_number().over(order)).withColumn("rest", F.col("budget") - served).withColumn("among", among)
        .withColumn("short", exact(F.col("supply")) * exact(F.col("among")) <= exact(F.col("rest")) * exact(F.col("weight")))
        .withColumn("stop", F.min(F.when(~F.col("short"), F.struct("place", "rest", "among"))).over(first))
        .withColumn("granted", F.when(F.col("stop").isNull() | (F.col("place") < F.col("stop.place")), F.col("supply"))
                    .otherwise(F.expr("cast(cast(stop.rest as decimal(19,0)) * cast(weight as decimal(19,0)) as decimal(38,0)) div stop.among").cast("long")))
        .drop("place", "rest", "among", "short", "stop")
    )


def _weight(level: str, weights: Weights) -> Column:
    out = F.lit(1)
    for name, weight in sorted(weights.get(level, {}).items()):
        out = F.when(F.col(level) == name, F.lit(int(weight))).otherwise(out)
    return out.cast("long")


def leaf_budgets(leaves: DataFrame, weights: Weights, percent: int, max_epochs: int) -> DataFrame:
    """Adds ``granted`` to leaves (domain, lang, source, tokens): whole tokens of ``percent`` of all tokens, at most ``max_epochs`` times its own.

    A name without a weight weighs 1; one of weight 0, and all below it, gets nothing.
    """
    open_leaves = leaves.filter(reduce(lambda a, b: a & b, (_weight(level, weights) > 0 for level in LEVELS)))
    total = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0] * percent // 100
    nodes = open_leaves.withColumn("supply", F.col("tokens") * max_epochs)
    held = None
    for depth, level in enumerate(LEVELS):
        path, parents = list(LEVELS[: depth + 1]), list(LEVELS[:depth])
        children = nodes.groupBy(*path).agg(F.sum("supply").alias("supply")).withColumn("weight", _weight(level, weights))
        children = children.join(held, parents) if parents else children.withColumn("budget", F.lit(total).cast("long")).withColumn("root", F.lit(0))
        held = shared(children, parents or ["root"], level).select(*path, F.col("granted").alias("budget"))
    return leaves.join(held.withColumnRenamed("budget", "granted"), list(LEVELS), "left").fillna(0, ["granted"])


def _hash(seed: int, epoch: Column, doc_id: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), doc_id.cast("string")))


def selection(narrow: DataFrame, weights: Weights, percent: int, max_epochs: int, seed: int) -> DataFrame:
    """Of each leaf (domain, lang, source): tokens, granted, whole epochs and the last hash taken in the epoch after them.

    ``narrow`` has doc_id, the levels and n_tokens. Rows of equal hash, such as
    rows of one doc_id, go in or out together. A null ``cutoff`` takes none.
    """
    totals = written(narrow.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens")), "totals")
    leaves = written(leaf_budgets(totals, weights, percent, max_epochs), "leaves")
    plan = leaves.withColumn("epochs", F.expr("if(tokens > 0, granted div tokens, 0)")).withColumn("rest", F.expr("granted - epochs * tokens"))
    small = bounded_broadcast(plan)
    placed = narrow.join(small, list(LEVELS)).withColumn("hash", _hash(seed, F.col("epochs"), F.col("doc_id"))).withColumn("slice", F.substring("hash", 1, SLICE_DIGITS))
    slices = placed.groupBy(*LEVELS, "slice", "rest").agg(F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(Window.partitionBy(*LEVELS).orderBy("slice")) - F.col("n")
    stops = (
        slices.withColumn("carried", before).filter("carried <= rest and carried + n > rest")
        .select(*LEVELS, F.col("slice").alias("stop"), "carried")
    )
    stops = written(stops, "stops")
    near = bounded_broadcast(stops)
    last = (
        placed.join(near, list(LEVELS)).filter("slice = stop")
        .withColumn("reached", F.col("carried") + F.sum("n_tokens").over(Window.partitionBy(*LEVELS).orderBy("hash")))
        .filter("reached <= rest").groupBy(*LEVELS).agg(F.max("hash").alias("last"))
    )
    # No hash equals the digits of a slice, so without a document in the slice the prefix ends before it.
    cut = stops.join(last, list(LEVELS), "left").select(*LEVELS, F.coalesce("last", "stop").alias("cutoff"))
    return plan.join(cut, list(LEVELS), "left").select(*LEVELS, "tokens", "granted", "epochs", F.when(F.col("rest") > 0, F.col("cutoff")).alias("cutoff"))


def mix(docs: DataFrame, weights: Weights, percent: int = 50, max_epochs: int = 2, seed: int = 7, domain: Column | None = None) -> DataFrame:
    """The rows of ``docs``, each once for every epoch that takes it, in a column ``document`` (all its columns) beside epoch, the levels and n_tokens.

    A null domain, language or source counts as the empty name; a null id is
    hashed as the empty text. Texts without words go along with whole epochs and
    with a prefix that passes them; a leaf without words takes none. An empty
    table gives none. Leaves are few: up to 10,000 are broadcast, more are joined.
    """
    name = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    keyed = docs.select(
        F.struct("*").alias("document"), F.col("doc_id").alias("doc_id"), name(F.col("lang")).alias("lang"), name(F.col("source")).alias("source"),
        name(source_domain(F.col("source")) if domain is None else domain).alias("domain"), word_count(F.col("text")).alias("n_tokens"),
    )
    narrow = written(keyed.select("doc_id", *LEVELS, "n_tokens"), "narrow")
    chosen = bounded_broadcast(written(selection(narrow, weights, percent, max_epochs, seed), "selection"))
    joined = keyed.join(chosen, list(LEVELS)).withColumn("hash", _hash(seed, F.col("epochs"), F.col("doc_id")))
    whole = F.when(F.col("epochs") > 0, F.sequence(F.lit(0).cast("long"), F.col("epochs") - 1)).otherwise(F.array().cast("array<long>"))
    part = F.when(F.col("hash") <= F.col("cutoff"), F.array("epochs")).otherwise(F.array().cast("array<long>"))
    return joined.select("document", F.explode(F.concat(whole, part)).alias("epoch"), *LEVELS, "n_tokens")
