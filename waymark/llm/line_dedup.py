"""Line dedup: lines that several documents share stay in one of them.

1. Each text gives one row for each of its different lines: 128 bits of hash, the
   document and the places of the line in it. Texts don't move.
2. The rows are dealt by ranges of the hash and sorted by hash, document (the one
   that keeps its lines first) and first place. A task streams its range: the
   first document of a hash keeps its lines, the others drop theirs once there
   are enough of them; rows of fewer documents than that wait.
   A hash of very many documents goes over several ranges. Its rows in each
   range get the number of their document there; the counts of the ranges
   before, one row a range, say later which ones they are.
3. The places of a document are gathered into a bitmap of the lines to keep,
   packed and compressed. That is the operator's result; ``apply_bitmaps``
   cuts the texts by it.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waymark.llm.text import bounded_batches, mapped, strings
from waymark.session import written

LINES = "high long, low long, doc_id long, text_key long, n_lines int, first int, places array<int>"
MARKED = "high long, low long, doc_id long, text_key long, n_lines int, places array<int>, slice int, edge boolean, nth int"


def line_key(line: bytes) -> bytes:
    """A line without white space at its ends, A-Z in lower case."""
    return line.strip(b" \t\n\x0b\x0c\r").lower()


def _lines(least: int):
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        texts = strings(batch.column("text")).cast(pa.large_binary()).to_pylist()
        for text, doc, key in zip(texts, batch.column("doc_id").to_pylist(), batch.column("text_key").to_pylist()):
            places: dict[bytes, list[int]] = {}
            lines = text.split(b"\n")
            for at, line in enumerate(lines):
                line = line_key(line)
                if len(line) >= least and (line.isascii() or len(line.decode(errors="replace")) >= least):
                    places.setdefault(hashlib.blake2b(line, digest_size=16).digest(), []).append(at)
            out.extend((digest, doc, key, len(lines), held) for digest, held in places.items())
        if not out:
            return
        digests, docs, keys, sizes, held = zip(*out)
        halves = np.frombuffer(b"".join(digests), dtype=">i8").astype(np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_pydict({
            "high": halves[:, 0], "low": halves[:, 1], "doc_id": pa.array(docs, pa.int64()), "text_key": pa.array(keys, pa.int64()), "n_lines": pa.array(sizes, pa.int32()),
            "first": pa.array([p[0] for p in held], pa.int32()), "places": pa.array(held, pa.list_(pa.int32())),
        })
    return run


class _Group:
    """The rows of one hash as they pass by: how many documents so far, the first and the last of them, and rows that wait for more."""

    def __init__(self, key: tuple | None = None, edge: bool = True):
        self.key, self.edge, self.documents, self.first, self.last, self.waiting = key, edge, 0, None, None, []


def _marked(shared_by: int):
    """Streams a sorted range and marks rows with the number of their document under their hash.

    Out come the rows of hashes with ``shared_by`` documents, and all rows of the range's first and last hash (``edge``), which
    other ranges may hold too. If the last one has its documents already, two rows without places stand for its first and last.
    """
    types = [pa.int64()] * 4 + [pa.int32(), pa.list_(pa.int32()), pa.int32(), pa.bool_(), pa.int32()]
    names = ["high", "low", "doc_id", "text_key", "n_lines", "places", "slice", "edge", "nth"]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, group, begun, passed = TaskContext.get().partitionId(), _Group(), False, None
        for batch in batches:
            out = []
            columns = [batch.column(c).to_pylist() for c in names[:6]]
            for high, low, doc, text_key, n_lines, places in zip(*columns):
                if (high, low) != group.key:
                    group, begun, passed = _Group((high, low), not begun), True, None
                if passed == (doc, text_key):
                    continue  # a repeated row of the table
                passed = (doc, text_key)
                if doc != group.last:
                    group.first = doc if group.first is None else group.first
                    group.last, group.documents = doc, group.documents + 1
                group.waiting.append((high, low, doc, text_key, n_lines, places, number, group.edge, group.documents))
                if group.edge or group.documents >= shared_by:
                    out += group.waiting
                    group.waiting = []
            if out:
                yield batch_of(out)
        if group.waiting:
            yield batch_of([(*row[:7], True, row[8]) for row in group.waiting])
        elif begun and not group.edge:
            yield batch_of([(*group.key, doc, None, None, None, number, True, nth) for doc, nth in ((group.first, 1), (group.last, group.documents))])
    return run


def _dropped(marked: DataFrame, shared_by: int) -> DataFrame:
    """The marked rows whose lines go."""
    inner = marked.filter("NOT edge AND nth > 1")
    # At most two hashes a range, so these are as few as there are shuffle partitions.
    ends = marked.filter("edge").groupBy("high", "low", "slice").agg(F.max("nth").alias("n"), F.max("doc_id").alias("top"), F.min("doc_id").alias("bottom"))
    order = Window.partitionBy("high", "low").orderBy("slice")
    # A document whose rows lie on both sides of a bound counts once.
    shared = F.coalesce((F.lag("bottom").over(order) == F.col("top")).cast("int"), F.lit(0))
    own = ends.withColumn("shared", shared).withColumn("own", F.col("n") - F.col("shared"))
    sums = own.select("high", "low", "slice", "shared", F.sum("own").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("to_here"), "own",
                      F.sum("own").over(Window.partitionBy("high", "low")).alias("total"))
    before = F.broadcast(sums.filter(F.col("total") >= shared_by).select("high", "low", "slice", (F.col("to_here") - F.col("own") - F.col("shared")).alias("earlier")))
    outer = marked.filter("edge AND places IS NOT NULL").join(before, ["high", "low", "slice"]).filter("earlier + nth > 1").drop("earlier")
    return inner.unionByName(outer)


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        packed, dropped = [], []
        for n_lines, lists in zip(batch.column("n_lines").to_pylist(), batch.column("gone").to_pylist()):
            keep = np.ones(n_lines, dtype=bool)
            for places in lists:
                keep[places] = False
            packed.append(zlib.compress(np.packbits(keep).tobytes(), 1))
            dropped.append(n_lines - int(keep.sum()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_key"), batch.column("n_lines").cast(pa.int64()), pa.array(dropped, pa.int64()), pa.array(packed, pa.binary())],
            names=["doc_id", "text_key", "n_lines", "n_dropped", "keep"])


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))


def keep_bitmaps(docs: DataFrame, least: int = 20, shared_by: int = 3) -> DataFrame:
    """Which lines of which documents stay, where lines of at least ``least`` code points that ``shared_by`` documents hold stay only in the largest ``doc_id``.

    Returns doc_id, text_key (hash of the text), n_lines, n_dropped and keep (a
    zlib-compressed bitmap, a bit a line) for the documents that lose lines; in
    all others every line stays.

    A null or empty text is one empty line. Lines are compared without white
    space at their ends and with A-Z in lower case; a line that repeats within
    its document counts once, and goes or stays in all its places. Rows of one
    doc_id are one document; repeated rows get equal bitmaps. A row with a null
    doc_id is no document: it keeps its lines and counts for none. A very long
    text or line is one row of hashes, and a long list of places. Other columns
    are ignored.
    """
    bounded_batches(docs.sparkSession)
    lines = written(mapped(_keyed(docs).filter(F.col("doc_id").isNotNull()), _lines(least), LINES), "lines")
    order = [F.col("high"), F.col("low"), F.col("doc_id").desc(), F.col("text_key"), F.col("first")]
    ranges = lines.repartitionByRange(*order).sortWithinPartitions(*order).drop("first")
    marked = written(ranges.mapInArrow(_marked(shared_by), MARKED), "marked-lines")
    gone = _dropped(marked, shared_by).groupBy("doc_id", "text_key").agg(F.max("n_lines").alias("n_lines"), F.collect_list("places").alias("gone"))
    return gone.mapInArrow(_bitmaps, "doc_id long, text_key long, n_lines long, n_dropped long, keep binary")


def _cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    sizes, dropped, kept = [], [], []
    for text, packed in zip(strings(batch.column("text")).cast(pa.large_binary()).to_pylist(), batch.column("keep").to_pylist()):
        lines = text.split(b"\n")
        n = len(lines)
        if packed is not None:
            bits = np.unpackbits(np.frombuffer(zlib.decompress(packed), np.uint8), count=n)
            lines = [line for line, stays in zip(lines, bits.tolist()) if stays]
            text = b"\n".join(lines)
        sizes.append(n)
        dropped.append(n - len(lines))
        kept.append(text)
    yield pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
        names=["doc_id", "n_lines", "n_dropped", "kept_text"])


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """Every document with what its bitmap keeps: doc_id, n_lines, n_dropped, kept_text (the lines left, joined by a line feed)."""
    joined = _keyed(docs).join(bitmaps.select("doc_id", "text_key", "keep"), ["doc_id", "text_key"], "left").select("doc_id", "text", "keep")
    return mapped(joined, _cut, "doc_id long, n_lines long, n_dropped long, kept_text string")
