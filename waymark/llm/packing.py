"""Packing: minimum bin slack over remaining lengths.

A task tokenizes its documents, cuts full windows off long ones and pools what
remains. From the pool it fills one window at a time: the longest remaining
length is set, and a subset-sum program over the multiset of the others, kept as
the bits of one integer, finds the fullest window; backtracking gives how many
of each length it takes, and the same choice is repeated while the pool can
meet it. Lengths with which no window fills to the last token wait for more
documents. If too many wait, and at the end of a partition, the fullest windows
are taken all the same and their slack is filled by cutting another piece; what
is left in the end is less than a window and cut at powers of two, so no
sequence needs padding.

Nothing is shuffled. A task holds at most ``pool`` remainders.
"""

from __future__ import annotations

import re
import struct
import zlib
from bisect import bisect_left
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.text import chunks, strings, bounded_batches

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_WIDTH = 4  # bytes of an id
#: Byte-level vocabularies name printable bytes by themselves and the others by the characters from 256 on.
_UNPRINTED = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
_BYTE_NAMES = {b: 256 + i for i, b in enumerate(_UNPRINTED)}


class WordIds:
    """Token ids of texts, each distinct word tokenized once while it is remembered.

    White space ends a word for tokenizers that drop it, so a text's ids are
    its words' ids in a row. Words of printable ASCII and Latin letters need
    no normalizing but lower case; they are cut where the tokenizer cuts them,
    and their parts, with and without a comma or capital the same, go to its
    model directly. At most ``remembered`` words, and as many parts, are kept.
    """

    SIMPLE = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
    #: Where the tokenizer cuts lower-cased simple words (fixed by its file): endings after an apostrophe, letters, single digits, other signs.
    PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")

    def __init__(self, path: str, end_id: int, remembered: int = 1_000_000) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.simple, self.cut = self.tokenizer.model, self.SIMPLE.fullmatch, self.PARTS.findall
        self.end = end_id.to_bytes(_WIDTH, "little")
        self.remembered = remembered
        self.known: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def learn(self, words: list[bytes]) -> None:
        if len(self.parts) > self.remembered:
            self.parts.clear()
        other = []
        for word in words:
            text = word.decode()
            # Words that may hold a special token are left to the tokenizer as they are.
            if self.simple(text) and "<|" not in text:
                self.known[word] = b"".join([self.parts.get(p) or self.part(p) for p in self.cut(text.lower())])
            else:
                other.append(word)
        self.known.update(zip(other, self.encoded([w.decode() for w in other])))

    def part(self, text: str) -> bytes:
        """The ids of a part, which the model sees as the characters that stand for its bytes."""
        ids = [t.id for t in self.model.tokenize(text.encode().decode("latin-1").translate(_BYTE_NAMES))]
        self.parts[text] = found = struct.pack(f"<{len(ids)}I", *ids)
        return found

    def encoded(self, words: list[str]) -> Iterator[bytes]:
        """The ids of words without white space, by the whole tokenizer."""
        import numpy as np

        for at in range(0, len(words), 256):
            part = words[at: at + 256]
            encoded = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            ids = np.array(encoded.ids, dtype="<u4")
            places = np.fromiter((a for a, _ in encoded.offsets), dtype=np.int64, count=len(ids))
            starts = np.cumsum([0] + [len(w) + 1 for w in part])
            cuts = np.searchsorted(places, starts).tolist()
            raw = ids.tobytes()
            yield from (raw[_WIDTH * a: _WIDTH * b] for a, b in zip(cuts, cuts[1:]))

    def __call__(self, texts: list[str]) -> list[bytes]:
        """The ids of each text and the end id, as little-endian bytes."""
        split = [t.encode().split() for t in texts]
        fresh = list(set().union(*split).difference(self.known))
        if len(self.known) + len(fresh) > self.remembered:
            self.known.clear()
            fresh = list(set().union(*split))
        self.learn(fresh)
        find = self.known.__getitem__
        return [b"".join(map(find, words)) + self.end for words in split]


def fullest(counts: dict[int, int], lengths: list[int], room: int) -> dict[int, int]:
    """The multiset of lengths, within their counts, of the greatest sum that is at most ``room``.

    ``lengths`` lists the counted lengths in ascending order. Longer lengths are
    tried first; the program stops as soon as the room is filled exactly.
    """
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for i in range(bisect_left(lengths, room + 1) - 1, -1, -1):
        length, left, size = lengths[i], counts[lengths[i]], 1
        while left and not reach >> room:
            take = min(size, left)  # in ones, twos, fours, ... of the same length
            wider = reach | (reach << (length * take)) & mask
            if wider != reach:
                steps.append((length, take, reach))
                reach = wider
            left -= take
            size *= 2
        if reach >> room:
            break
    total, chosen = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            total -= length * take
            chosen[length] = chosen.get(length, 0) + take
    return chosen


class Packer:
    """Fills windows from pooled remainders. A piece is (doc number, start, ids, tokens of its document)."""

    def __init__(self, window: int, first_sequence: int, emit: Callable) -> None:
        self.window, self.next, self.emit = window, first_sequence, emit
        self.waiting: dict[int, list] = {}
        self.held = 0

    def sequence(self, pieces: list) -> None:
        offset = 0
        for doc, start, ids, tokens in pieces:
            n = len(ids) // _WIDTH
            self.emit((doc, start, n, zlib.crc32(ids), tokens, self.next, offset))
            offset += n
        self.next += 1

    def add(self, doc, ids: bytes) -> None:
        tokens, step, start = len(ids) // _WIDTH, self.window, 0
        while tokens - start >= step:
            self.sequence([(doc, start, ids[_WIDTH * start: _WIDTH * (start + step)], tokens)])
            start += step
        if start < tokens:
            self.waiting.setdefault(tokens - start, []).append((doc, start, ids[_WIDTH * start:], tokens))
            self.held += 1

    def fill(self, keep: int) -> None:
        """Fill whole windows until at most ``keep`` pieces wait or no window can be filled exactly."""
        counts = {n: len(p) for n, p in self.waiting.items()}
        lengths = sorted(counts)
        blocked: list[int] = []
        while self.held > keep and lengths:
            longest = lengths[-1]
            counts[longest] -= 1
            chosen = fullest(counts, lengths, self.window - longest)
            counts[longest] += 1
            if longest + sum(n * k for n, k in chosen.items()) < self.window:
                blocked.append(lengths.pop())  # waits for other lengths
                continue
            chosen[longest] = chosen.get(longest, 0) + 1
            for _ in range(min(counts[n] // k for n, k in chosen.items())):
                pieces = [self.waiting[n].pop() for n, k in sorted(chosen.items(), reverse=True) for _ in range(k)]
                self.held -= len(pieces)
                self.sequence(pieces)
                for n, k in chosen.items():
                    counts[n] -= k
            for n in chosen:
                if not counts[n]:
                    lengths.remove(n)
                    del self.waiting[n], counts[n]

    def cut(self, keep: int) -> None:
        """Take the fullest windows until at most ``keep`` pieces or less than a window wait; a cut piece fills each one's slack."""
        left = sum(n * len(p) for n, p in self.waiting.items())
        while self.held > keep and left >= self.window:
            counts = {n: len(p) for n, p in self.waiting.items()}
            lengths = sorted(counts)
            longest = lengths[-1]
            counts[longest] -= 1
            chosen = fullest(counts, lengths, self.window - longest)
            pieces = [self.take(longest), *[self.take(n) for n, k in sorted(chosen.items(), reverse=True) for _ in range(k)]]
            slack = self.window - sum(len(p[2]) // _WIDTH for p in pieces)
            while slack:
                lengths = sorted(self.waiting)
                doc, start, ids, tokens = self.take(lengths[min(bisect_left(lengths, slack), len(lengths) - 1)])
                n = min(slack, len(ids) // _WIDTH)
                pieces.append((doc, start, ids[: _WIDTH * n], tokens))
                slack -= n
                if len(ids) > _WIDTH * n:
                    self.waiting.setdefault(len(ids) // _WIDTH - n, []).append((doc, start + n, ids[_WIDTH * n:], tokens))
                    self.held += 1
            self.sequence(pieces)
            left -= self.window

    def take(self, length: int) -> tuple:
        """One waiting piece of a length."""
        held = self.waiting[length]
        piece = held.pop()
        if not held:
            del self.waiting[length]
        self.held -= 1
        return piece

    def finish(self) -> None:
        """Fill what can be filled, then cut; the last tokens, less than a window, go into sequences of powers of two."""
        self.fill(0)
        self.cut(0)
        rest = [p for n in sorted(self.waiting, reverse=True) for p in self.waiting[n]]
        left = sum(len(p[2]) // _WIDTH for p in rest)
        self.waiting, self.held = {}, 0
        while left:
            room = self.window if left >= self.window else 1 << (left.bit_length() - 1)
            left -= room
            pieces = []
            while room:
                doc, start, ids, tokens = rest.pop()
                n = min(room, len(ids) // _WIDTH)
                pieces.append((doc, start, ids[: _WIDTH * n], tokens))
                if len(ids) > _WIDTH * n:
                    rest.append((doc, start + n, ids[_WIDTH * n:], tokens))
                room -= n
            self.sequence(pieces)


def _packed(path: str, window: int, end_id: int, pool: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        encode = WordIds(path, end_id)
        packer = Packer(window, TaskContext.get().partitionId() << 40, out.append)

        def flushed() -> pa.RecordBatch:
            columns = list(zip(*out)) or [()] * 7
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

        for batch in batches:
            texts = strings(batch.column("text"))
            for a, b in chunks(texts):
                for doc, ids in zip(batch.column("doc_id").slice(a, b - a).to_pylist(), encode(texts.slice(a, b - a).to_pylist())):
                    packer.add(doc, ids)
                if packer.held > pool:
                    packer.fill(pool // 2)
                    packer.cut(pool)
                yield flushed()
        packer.finish()
        yield flushed()
    return run


def pack(docs: DataFrame, tokenizer_path: str, window: int = 2048, end_id: int = 1, pool: int = 8192) -> DataFrame:
    """One row for each piece of each document: where it lies in which sequence.

    A document is its text's ids and ``end_id``; pieces of it cover it without
    gap or overlap. Every sequence is full or of a power of two. Sequence ids
    hold the partition number, so they are distinct but not consecutive.

    A null or empty text is ``end_id`` alone. Repeated rows are packed each; a
    null doc_id passes through. Other columns are ignored. The tokenizer must
    drop white space and be readable at ``tokenizer_path`` on every executor.
    """
    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_packed(tokenizer_path, window, end_id, pool), SCHEMA)
