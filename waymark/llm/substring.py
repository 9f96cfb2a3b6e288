"""Substring dedup: a count-min prefilter, then an exact grouping of what it lets through.

A window is ``window`` consecutive words of one document. Every window is
counted under its anchor, the least hash of the half-window word runs in it:
equal windows have equal anchors, so an anchor's document count is never below
a window's, and there are about a dozen windows to an anchor.

1. Each partition sketches the anchors of its documents, each once a document.
   Partition sketches hold two bits a cell (one, two or more), and merge by
   bit operations. Merging gives a bitmap of ``2 * 2**sketch_bits`` bits,
   whatever the input: 8 MiB by default, the only thing that reaches the
   driver and is broadcast.
2. Windows whose estimate is below two are in no other document. The rest are
   written as runs (consecutive windows under one anchor) and grouped exactly:
   whole runs first, by the hashes of all their windows; then, only under
   anchors with several different runs, window by window.

A fuller sketch lets more through and changes no result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.text import batches_of, bounded_batches, grams, hashed_words, mapped, mixed, sliding_min, strings
from waymark.session import written

_BLOCK_BITS = 17


def _runs(batch: pa.RecordBatch, window: int):
    """Runs of windows under one anchor: (row, first word, windows, anchor, hash of the windows), and all window hashes."""
    words, bounds = hashed_words(strings(batch.column("text")))
    size = window // 2
    hashes = grams(words, window, 3)
    anchors = sliding_min(grams(words, size, 1), window - size + 1)
    row = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
    whole = row[: len(hashes)] == row[window - 1: window - 1 + len(hashes)]
    at = np.flatnonzero(whole)
    anchors, hashes, row = anchors[at], hashes[at], row[at]
    fresh = np.ones(len(at), dtype=bool)
    fresh[1:] = (anchors[1:] != anchors[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(fresh)
    return row[first], (at - bounds[row])[first], first, np.diff(np.append(first, len(at))), anchors[first], hashes


def _cells(anchors: np.ndarray, bits: int) -> list[np.ndarray]:
    return [(mixed(anchors, seed) >> np.uint64(64 - bits)).astype(np.int64) for seed in (11, 12)]


def _sketch(window: int, bits: int):
    block = 1 << min(bits, _BLOCK_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((2, 1 << bits), dtype=np.uint8)

        def add(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            row, _, _, _, anchors, _ = _runs(batch, window)
            order = np.lexsort((row, anchors))
            anchors, row = anchors[order], row[order]
            once = np.ones(len(anchors), dtype=bool)
            once[1:] = (anchors[1:] != anchors[:-1]) | (row[1:] != row[:-1])
            for level, cells in zip(held, _cells(anchors[once], bits)):
                cells, counts = np.unique(cells, return_counts=True)
                level[cells] = np.minimum(level[cells] + np.minimum(counts, 2), 2)
            return iter(())

        for _ in batches_of(add)(batches):
            pass
        for level in range(2):
            for start in range(0, 1 << bits, block):
                part = held[level, start: start + block]
                if part.any():
                    yield pa.RecordBatch.from_pydict({
                        "block": pa.array([(level << 40) | start], pa.int64()), "part": pa.array([zlib.crc32(part.tobytes()) % 32], pa.int32()),
                        "one": [zlib.compress(np.packbits(part >= 1).tobytes(), 1)], "two": [zlib.compress(np.packbits(part >= 2).tobytes(), 1)],
                    })
    return run


def _merge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    one = two = None
    for batch in batches:
        for a, b in zip(batch.column("one"), batch.column("two")):
            a, b = (np.frombuffer(zlib.decompress(x.as_py()), np.uint8) for x in (a, b))
            one, two = (a, b) if one is None else (one | a, two | b | (one & a))
    yield pa.RecordBatch.from_pydict({"block": pa.array([key[0].as_py()], pa.int64()), "part": pa.array([0], pa.int32()), "one": [zlib.compress(one.tobytes(), 1)], "two": [zlib.compress(two.tobytes(), 1)]})


def repeated_cells(docs: DataFrame, window: int = 50, sketch_bits: int = 25) -> np.ndarray:
    """The merged sketch: for each of two hashes, a bitmap of the cells that count two documents or more."""
    schema = "block long, part int, one binary, two binary"
    bounded_batches(docs.sparkSession)
    local = docs.select("text").mapInArrow(_sketch(window, sketch_bits), schema)
    merged = local.groupBy("block", "part").applyInArrow(_merge, schema).groupBy("block").applyInArrow(_merge, schema)
    bitmap = np.zeros((2, (1 << sketch_bits) // 8), dtype=np.uint8)
    for r in merged.select("block", "two").toLocalIterator():
        level, start = r["block"] >> 40, (r["block"] & ((1 << 40) - 1)) // 8
        bits = np.frombuffer(zlib.decompress(r["two"]), np.uint8)
        bitmap[level, start: start + len(bits)] = bits
    return bitmap


def _candidate_runs(bitmap, window: int, bits: int, single: bool):
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        row, start, first, count, anchors, hashes = _runs(batch, window)
        seen = np.ones(len(row), dtype=bool)
        for level, cells in zip(bitmap.value, _cells(anchors, bits)):
            seen &= (level[cells >> 3] >> (7 - (cells & 7)).astype(np.uint8) & 1).astype(bool)
        keep = np.flatnonzero(seen)
        if not len(keep):
            return
        count = count[keep]
        ends = np.cumsum(count)
        place = np.arange(ends[-1]) - np.repeat(ends - count, count)
        flat = hashes[np.repeat(first[keep], count) + place]
        with np.errstate(over="ignore"):
            whole = mixed(np.add.reduceat(mixed(flat, 5) * mixed(place.astype(np.uint64), 6), ends - count) + count.astype(np.uint64))
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id").take(pa.array(row[keep])), "text_key": batch.column("text_key").take(pa.array(row[keep])), "start": pa.array(start[keep].astype(np.int32)),
            "n": pa.array(count.astype(np.int32)), "anchor": pa.array(anchors[keep].view(np.int64)), "whole": pa.array(whole.view(np.int64)),
        } | ({"windows": pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(flat.view(np.int64)))} if single else {}))
    return run


def _cut(window: int):
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out = []
        for text, runs in zip(batch.column("text").to_pylist(), batch.column("runs").to_pylist()):
            words = (text or "").encode().split()
            if not runs:
                out.append((len(words), 0, [], b" ".join(words)))
                continue
            edge = np.zeros(len(words) + 1, dtype=np.int32)
            for r in runs:
                edge[r["start"]] += 1
                edge[r["start"] + r["n"] + window - 1] -= 1
            gone = np.cumsum(edge)[:-1] > 0
            turns = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])).astype(np.int8))).tolist()
            kept = b" ".join(w for w, g in zip(words, gone.tolist()) if not g)
            out.append((len(words), int(gone.sum()), [{"start": a, "end": b} for a, b in zip(turns[::2], turns[1::2])], kept))
        counts, removed, spans, kept = zip(*out)
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()),
            pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array([k.decode() for k in kept], pa.string()),
        ], names=["doc_id", "n_words", "n_removed", "spans", "kept_text"])
    return run


def remove_repeats(docs: DataFrame, window: int = 50, sketch_bits: int = 25) -> DataFrame:
    """Each document without the words of windows that also start in a document of smaller ``doc_id``.

    Returns doc_id, n_words, n_removed, spans (word ranges removed, end
    exclusive) and kept_text (the words left, joined by one space).

    Null, empty and short texts have no window: nothing goes. Rows of one
    doc_id never remove each other's words. A row with a null doc_id is smaller
    than none and greater than none: it keeps its words and removes none.
    Repeats within one document stay. Other columns are ignored.
    """
    spark = docs.sparkSession
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    bitmap = spark.sparkContext.broadcast(repeated_cells(docs, window, sketch_bits))
    named = keyed.filter(F.col("doc_id").isNotNull())
    schema = "doc_id long, text_key long, start int, n int, anchor long, whole long"
    runs = written(mapped(named, _candidate_runs(bitmap, window, sketch_bits, False), schema), "runs")

    firsts = runs.groupBy("anchor", "whole").agg(F.min("doc_id").alias("first_doc"))
    later = runs.join(firsts, ["anchor", "whole"]).filter("doc_id > first_doc").select("doc_id", "text_key", "start", "n")
    # Of equal runs only the first document's needs a look at single windows, and only under anchors of several runs.
    several = firsts.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor")
    heads = firsts.join(several, "anchor", "left_semi").withColumnRenamed("first_doc", "doc_id")
    # Texts are hashed a second time: window hashes of all runs would fill the disks.
    opened = written(mapped(named, _candidate_runs(bitmap, window, sketch_bits, True), schema + ", windows array<long>").join(heads, ["anchor", "whole", "doc_id"]), "windows")
    single = opened.select("doc_id", "text_key", "start", "anchor", F.posexplode("windows").alias("at", "hash"))
    lows = single.groupBy("anchor", "hash").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).filter("low < high").drop("high")
    placed = single.select("anchor", "hash", "doc_id", "text_key", (F.col("start") + F.col("at")).alias("start"))
    parts = placed.join(lows, ["anchor", "hash"]).filter("doc_id > low").select("doc_id", "text_key", "start", F.lit(1).alias("n"))

    gone = later.unionByName(parts).groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("start", "n")).alias("runs"))
    joined = keyed.join(gone, ["doc_id", "text_key"], "left").select("doc_id", "text", "runs")
    return mapped(joined, _cut(window), "doc_id long, n_words long, n_removed long, spans array<struct<start:long,end:long>>, kept_text string")
