"""Exact top-k inner products by MaxScore.

The terms of a query are the dimensions of its vector. In a shard, dimension d
adds to a score between the least and the greatest product of the query's and
any vector's d-th number; the width of that range is the term's bound. Terms
are sorted by bound. Those at the lower end whose bounds together can't lift a
vector that has the least of everything else over the k-th best score so far
are non-essential: the others' columns are traversed for a run of vectors, and
only vectors that can still reach that score are probed for the rest, in order
of bound, as long as they can.

Queries stand in blocks and vectors in shards; each task meets one block with
one shard, and its best k a query are merged. All numbers are whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.session import written

_RUN = 4096
_LAST = np.iinfo(np.int64).max


def matrix(lists: pa.ChunkedArray, width: int) -> np.ndarray:
    """Whole-number vectors as rows, filled up with zeros, as doubles while these stay exact."""
    column = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width), dtype=np.int64)
    out[np.repeat(np.arange(len(column)), sizes), np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def best(query: np.ndarray, columns: np.ndarray, low: np.ndarray, high: np.ndarray, ids: np.ndarray, copies: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and scores of vectors that hold the query's best k rows, ties to smaller ids; ``copies`` rows stand behind each position."""
    least, most = np.minimum(query * low, query * high), np.maximum(query * low, query * high)
    bounds = most - least
    terms = np.argsort(-bounds, kind="stable")
    # The most that the terms from place t on can add.
    onward = np.append(np.cumsum(most[terms][::-1])[::-1], 0)
    held, scores, floor = np.zeros(0, np.int64), np.zeros(0, columns.dtype), None
    n = columns.shape[1]
    for start in range(0, n, _RUN):
        end = min(n, start + _RUN)
        place = len(terms)
        if floor is not None:
            base = least.sum()
            # Essential terms: the shortest head whose tail can't reach the floor alone.
            tail = np.append(np.cumsum(bounds[terms][::-1])[::-1], 0)
            place = int(np.argmax(base + tail < floor)) if (base + tail < floor).any() else len(terms)
        sums = np.zeros(end - start, columns.dtype)
        for d in terms[:place].tolist():
            sums += query[d] * columns[d, start:end]
        if place < len(terms):
            left = np.flatnonzero(sums + onward[place] >= floor)
            sums = sums[left]
            while place < len(terms) and len(left):
                for d in terms[place: place + 4].tolist():
                    sums = sums + query[d] * columns[d, start + left]
                place = min(place + 4, len(terms))
                open_ = sums + onward[place] >= floor
                left, sums = left[open_], sums[open_]
        else:
            left = np.arange(end - start)
        left, sums = left[copies[start + left] > 0], sums[copies[start + left] > 0]
        held, scores = np.append(held, start + left), np.append(scores, sums)
        if len(held):
            order = np.lexsort((ids[held], -scores))
            enough = np.searchsorted(np.cumsum(np.minimum(copies[held[order]], k)), k) + 1
            held, scores = held[order[:enough]], scores[order[:enough]]
            if np.minimum(copies[held], k).sum() >= k:
                floor = scores[-1]
    return held, scores


def _cell(k: int):
    def run(key: tuple[pa.Scalar, ...], vectors: pa.Table, queries: pa.Table) -> pa.Table:
        rows = {name: [] for name in ("query_key", "vec_id", "score", "copies")}
        if vectors.num_rows and queries.num_rows:
            width = max(int(np.diff(t.column("numbers").combine_chunks().offsets.to_numpy()).max()) for t in (vectors, queries))
            v, q = matrix(vectors.column("numbers"), width), matrix(queries.column("numbers"), width)
            greatest = lambda m: max(abs(int(m.min())), abs(int(m.max()))) if m.size else 0
            exact = np.float64 if 4 * max(1, width) * greatest(v) * greatest(q) < 1 << 53 else object
            columns = np.ascontiguousarray(v.T).astype(exact)
            low, high = (columns.min(axis=1), columns.max(axis=1)) if width else (np.zeros(0), np.zeros(0))
            ids = vectors.column("vec_id").fill_null(_LAST).to_numpy()
            copies, keys = vectors.column("copies").to_numpy(), vectors.column("key").to_numpy()
            order = np.argsort(keys)
            for row, query_key in zip(q.astype(exact), queries.column("key").to_pylist()):
                others = copies
                at = int(np.searchsorted(keys[order], query_key))
                if at < len(keys) and keys[order[at]] == query_key:  # the query's own row is among them
                    others = copies.copy()
                    others[order[at]] -= 1
                held, scores = best(row, columns, low, high, ids, others, k)
                rows["query_key"] += [query_key] * len(held)
                rows["vec_id"] += [None if i == _LAST else i for i in ids[held].tolist()]
                rows["score"] += [int(s) for s in scores]
                rows["copies"] += np.minimum(others[held], k).tolist()
        return pa.table({name: pa.array(values, pa.int64()) for name, values in rows.items()})
    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, shard_rows: int = 16_384, block_rows: int = 1024) -> DataFrame:
    """For each query row its k best other rows: query_id, rank (from 1), vec_id, score; ties to smaller vec_id, null last.

    ``vectors`` has vec_id and numbers (array<long>); null arrays and arrays
    with nulls take no part. ``is_query`` is a condition on these. Shorter
    vectors count as filled up with zeros. Equal rows are searched once: each
    is a candidate for its copies, and each copy of a query gets its own ranks.
    An inner product beyond a long is an error. Empty tables give no rows.
    """
    counted = vectors.select("vec_id", "numbers").filter("numbers is not null and forall(numbers, x -> x is not null)").groupBy("vec_id", "numbers").agg(F.count("*").alias("copies"))
    # Keys are given once, then read back, so a repeated task finds the same ones.
    rows = written(counted.withColumn("key", F.monotonically_increasing_id()), "vectors")
    queries = rows.filter(is_query)
    shards, blocks = max(1, -(-rows.count() // shard_rows)), max(1, -(-queries.count() // block_rows))
    part = lambda n: F.pmod(F.xxhash64("key"), F.lit(n)).cast("int")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.withColumn("shard", part(shards)).withColumn("block", spread(blocks))
    right = queries.withColumn("block", part(blocks)).withColumn("shard", spread(shards))
    found = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInArrow(_cell(k), "query_key long, vec_id long, score long, copies long")
    each = found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    ranked = each.withColumn("rank", F.row_number().over(Window.partitionBy("query_key").orderBy(F.desc("score"), F.asc_nulls_last("vec_id")))).filter(F.col("rank") <= k)
    asked = queries.select(F.col("key").alias("query_key"), F.col("vec_id").alias("query_id"), F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("asked"))
    return ranked.join(asked, "query_key").select("query_id", "rank", "vec_id", "score")


def whole_numbers(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component; null for a vector with a component that is null or not finite."""
    fit = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(fit, F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long")))
