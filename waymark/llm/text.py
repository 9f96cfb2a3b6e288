"""Words, hashes and batches that several text operators share.

A word is a run of characters other than space and the controls 9 to 13; as
these are single bytes in UTF-8, words are cut on bytes. Hashes are computed
over whole Arrow batches, never word by word.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The word pattern as Java's and DuckDB's regular expressions write it.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text that one numpy pass takes; longer texts are taken alone.
CHUNK_BYTES = 1 << 20

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE = np.random.default_rng(20251).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Let no Arrow batch hold more than a few megabytes of ordinary texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_POWERS = np.ones(1, dtype=np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        steps = np.full(2 * n, _STEP, dtype=np.uint64)
        steps[0] = 1
        with np.errstate(over="ignore"):
            _POWERS = np.multiply.accumulate(steps)
    return _POWERS


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a string column that hold about ``limit`` bytes each."""
    sizes = np.diff(text_offsets(column))
    start, held = 0, 0
    for row, size in enumerate(sizes.tolist()):
        if held and held + size > limit:
            yield start, row
            start, held = row, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def strings(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """One plain string array without nulls (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    return column.fill_null("") if column.null_count else column


def text_offsets(column: pa.Array) -> np.ndarray:
    return np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset: column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array and each text's first byte in them (one entry more than texts)."""
    offsets = text_offsets(column)
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8)[offsets[0]: offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def word_starts(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which bytes belong to words, and the first byte of each word. Words end where texts end."""
    word = ~SPACE[raw]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    firsts = offsets[:-1][np.diff(offsets) > 0]
    begins[firsts] = word[firsts]
    return word, np.flatnonzero(begins)


def hashed_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of a string array, and each text's first word in them (one entry more than texts)."""
    raw, offsets = bytes_of(column)
    word, starts = word_starts(raw, offsets)
    return run_hashes(raw, word, starts) if len(starts) else np.zeros(0, np.uint64), np.searchsorted(starts, offsets)


def run_hashes(raw: np.ndarray, inside: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Hashes of the runs of bytes that begin at ``starts`` and hold the bytes marked ``inside``; no run is empty."""
    letters = raw[inside]
    at = (np.cumsum(inside) - 1)[starts]
    sizes = np.diff(np.append(at, len(letters)))
    place = np.arange(len(letters)) - np.repeat(at, sizes)
    with np.errstate(over="ignore"):
        return mixed(np.add.reduceat(_BYTE[letters] * _powers(int(sizes.max()))[place], at))


def grams(words: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """Hashes of each run of ``size`` consecutive entries of a hash array (across text bounds too)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    base, length, total = int(mixed(np.array([seed + 77], np.uint64))[0]) | 1, 1, mixed(words, seed)
    # Horner by doubling: the hash of 2m entries from two hashes of m.
    parts, covered, out = size, 0, None
    with np.errstate(over="ignore"):
        while parts:
            if parts & 1:
                piece = total[covered: covered + n]
                out = piece.copy() if out is None else out * np.uint64(pow(base, length, 1 << 64)) + piece
                covered += length
            parts >>= 1
            if parts:
                total = total[:-length] * np.uint64(pow(base, length, 1 << 64)) + total[length:] if len(total) > length else total[:0]
                length *= 2
        return mixed(out, seed + 1)


def sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    """The least of each ``size`` consecutive entries."""
    n = len(values) - size + 1
    if n <= 0:
        return values[:0]
    width, low = 1, values
    while width * 2 <= size:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    return np.minimum(low[:n], low[size - width: size - width + n])


def batches_of(fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], column: str = "text"):
    """A mapInArrow function that hands ``fn`` slices of about CHUNK_BYTES of ``column``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                for start, end in chunks(strings(batch.column(column))):
                    yield from fn(batch.slice(start, end - start))
    return run


def mapped(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str, column: str = "text") -> DataFrame:
    bounded_batches(df.sparkSession)
    return df.mapInArrow(batches_of(fn, column), schema)


def bounded_broadcast(df: DataFrame, max_rows: int = 10_000) -> DataFrame:
    """``df`` marked for broadcast if it holds few rows, else as it is; meant for tables that were written and are cheap to count."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def least_hashed(rows: DataFrame, n: int, *columns: str) -> DataFrame:
    """The ``n`` rows of least hash of ``columns``: a sample that a repeated task draws alike.

    Of a large table only rows whose hash is low enough for about ``2 n`` of them are compared, so no task gathers ``n`` of every partition.
    """
    key = F.pmod(F.xxhash64(*columns), F.lit(1 << 32))
    total = rows.count()
    if total > 4 * n:
        rows = rows.filter(key < (1 << 32) * 2 * n // total)
    return rows.orderBy(key, *columns).limit(n)


def labelled_texts(docs: DataFrame, labels: DataFrame, column: str, n: int) -> DataFrame:
    """One row (doc_id, text, ``column``) for each of at most ``n`` labelled ids; of several texts of an id the least. ``labels`` has one row an id."""
    chosen = F.broadcast(least_hashed(labels, n, "doc_id"))  # at most n pairs of numbers
    return docs.select("doc_id", "text").join(chosen, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first(column).alias(column))
