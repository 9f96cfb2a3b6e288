"""Toxicity by nearest labelled examples under TF-IDF cosine, found in a block-max inverted index.

Terms are words in lower case and, of words longer than six bytes, their first
six. Every term of the labelled examples is indexed. A term weighs by its
inverse document frequency, counted over all documents, and by how surely it
tells toxic from clean examples; terms that say nothing about the label keep a
small weight, so none is left out.

Examples of equal vectors are one entry. Entries stand in blocks; each term
keeps its greatest weight in each block where it occurs. Terms of at least
one in ``DENSE`` entries stand in most blocks; their part of the cosine is one
matrix product for a batch of texts. Its greatest value in a block and the
weights of the other terms there give the block's bound. A query visits blocks
from the highest bound down, until no bound reaches the last neighbour it
needs, so the neighbours are exact. Votes weigh by distance and are calibrated
on examples that are not in the index.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.llm.text import bounded_batches, bytes_of, chunks, grams, hashed_words, labelled_texts, mapped, mixed, run_hashes, strings
from waymark.session import written

STEM_BYTES = 6
BLOCK = 64
#: Terms of at least one in so many entries are kept as whole columns.
DENSE = 32

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def terms_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Term hashes of a string array and the text each belongs to."""
    raw, offsets = bytes_of(column)
    letter = _LETTER[raw]
    begins = letter.copy()
    begins[1:] &= ~letter[:-1]
    firsts = offsets[:-1][np.diff(offsets) > 0]
    begins[firsts] = letter[firsts]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    text = np.searchsorted(offsets, starts, side="right") - 1
    at = (np.cumsum(letter) - 1)[starts]
    sizes = np.diff(np.append(at, int(letter.sum())))
    lower = _LOWER[raw]
    whole = run_hashes(lower, letter, starts)
    near = np.zeros(len(raw), dtype=bool)
    near[letter] = np.arange(int(letter.sum())) - np.repeat(at, sizes) < STEM_BYTES
    long_ = sizes > STEM_BYTES
    stems = mixed(run_hashes(lower, near, starts)[long_], 31)
    return np.concatenate([whole, stems]), np.concatenate([text, text[long_]])


def _counts(column: pa.Array, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, place in the sorted vocabulary and count of each known term of each text."""
    terms, text = terms_of(column)
    place = np.minimum(np.searchsorted(vocabulary, terms), max(0, len(vocabulary) - 1))
    known = vocabulary[place] == terms if len(vocabulary) else np.zeros(len(terms), bool)
    pairs, counts = np.unique(text[known] * np.int64(max(1, len(vocabulary))) + place[known], return_counts=True)
    return pairs // max(1, len(vocabulary)), pairs % max(1, len(vocabulary)), counts


def _ranges(first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    sizes = end - first
    return np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


@dataclass(frozen=True)
class Index:
    vocabulary: np.ndarray  # sorted term hashes
    weights: np.ndarray  # of each term
    ids: np.ndarray  # the least doc_id of each entry
    rows: np.ndarray  # examples behind each entry
    toxic: np.ndarray  # toxic ones among them
    cells: np.ndarray  # for each term, its first cell: a block where it occurs (one entry more than terms)
    blocks: np.ndarray  # of each cell
    tops: np.ndarray  # greatest weight in each cell
    starts: np.ndarray  # for each cell, its first posting (one entry more than cells)
    entries: np.ndarray  # of each posting
    values: np.ndarray
    columns: np.ndarray  # the column of each term of at least one in DENSE entries, else -1
    knots: tuple = ((), ())  # raw votes and calibrated scores

    def vector(self, places: np.ndarray, counts: np.ndarray) -> np.ndarray:
        weights = (1 + np.log(counts)) * self.weights[places]
        return weights / np.sqrt((weights**2).sum()) if len(weights) else weights

    def matrix(self) -> np.ndarray:
        """Weights of the terms that have a column: columns x entries, in whole blocks."""
        out = np.zeros((int(self.columns.max(initial=-1)) + 1, -(-len(self.ids) // BLOCK) * BLOCK))
        for term in np.flatnonzero(self.columns >= 0).tolist():
            a, b = self.starts[self.cells[term: term + 2]]
            out[self.columns[term], self.entries[a:b]] = self.values[a:b]
        return out

    def neighbours(self, edges: list[int], places: np.ndarray, counts: np.ndarray, k: int, matrix: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each text its nearest entries that share a term and their cosines.

        Text i holds the terms from ``edges[i]`` to ``edges[i + 1]``. Entries come highest cosine first,
        ties to smaller ids, until they stand for ``k`` examples.
        """
        weights = np.concatenate([self.vector(places[a:b], counts[a:b]) for a, b in zip(edges, edges[1:])] or [np.zeros(0)])
        column = self.columns[places]
        for low in range(0, len(edges) - 1, 256):
            some = edges[low: low + 257]
            inner = np.flatnonzero(column[some[0]: some[-1]] >= 0) + some[0]
            dense = np.zeros((len(some) - 1, len(matrix)))
            dense[np.searchsorted(some, inner, side="right") - 1, column[inner]] = weights[inner]
            shares = (dense @ matrix).reshape(len(some) - 1, -1, BLOCK)
            tops = shares.max(axis=2, initial=0.0)
            for i, (a, b) in enumerate(zip(some, some[1:])):
                rest = column[a:b] < 0
                yield self._nearest(places[a:b][rest], weights[a:b][rest], shares[i], tops[i], k)

    def _nearest(self, places: np.ndarray, weights: np.ndarray, shares: np.ndarray, tops: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        first, end = self.cells[places], self.cells[places + 1]
        cells, weights = _ranges(first, end), np.repeat(weights, end - first)
        block = self.blocks[cells]
        bounds = tops + np.bincount(block, weights * self.tops[cells], minlength=len(tops))
        order = np.argsort(-bounds, kind="stable")
        order = order[bounds[order] > 0]
        near, cosines = np.zeros(0, np.int64), np.zeros(0)
        # The best blocks first; once they hold enough, all that can still matter at once.
        done, step, enough = 0, 4, False
        while done < len(order):
            if enough:
                step = int((bounds[order[done:]] >= cosines[-1] - 1e-9).sum())
                if not step:
                    break
            chosen = order[done: done + step]
            place = np.full(len(tops), -1)
            place[chosen] = np.arange(0, len(chosen) * BLOCK, BLOCK)
            base = place[block]
            take = np.flatnonzero(base >= 0)
            part = cells[take]
            first = self.starts[part]
            sizes = self.starts[part + 1] - first
            posting = _ranges(first, first + sizes)
            at = self.entries[posting] % BLOCK + np.repeat(base[take], sizes)
            sums = np.bincount(at, np.repeat(weights[take], sizes) * self.values[posting], minlength=len(chosen) * BLOCK) + shares[chosen].ravel()
            hit = np.flatnonzero(sums > (max(0.0, cosines[-1] - 1e-12) if enough else 0.0))
            near, cosines = np.append(near, chosen[hit // BLOCK] * BLOCK + hit % BLOCK), np.append(cosines, np.round(sums[hit], 12))
            best = np.lexsort((self.ids[near], -cosines))
            held = np.cumsum(self.rows[near[best]])
            best = best[: int(np.searchsorted(held, k)) + 1]
            near, cosines = near[best], cosines[best]
            done, step, enough = done + step, 2 * step, len(held) > 0 and held[-1] >= k
        return near, np.minimum(1.0, cosines)

    def vote(self, near: np.ndarray, cosines: np.ndarray) -> float:
        """The weighted share of toxic examples; a hundredth of a right angle off counts half as much as no distance.

        Without a neighbour it is the share of toxic examples in all.
        """
        if not len(near):
            return float(self.toxic.sum() / max(1, self.rows.sum()))
        # An entry of very many examples says no more than its share of them.
        weight = np.minimum(self.rows[near], 50) / (0.01 + np.maximum(0.0, 1 - cosines))
        return float((weight * self.toxic[near] / self.rows[near]).sum() / weight.sum())

    def calibrated(self, raw: float) -> float:
        x, y = self.knots
        return 0.98 * float(np.interp(raw, x, y)) + 0.02 * raw if len(x) else raw


def build(vocabulary: np.ndarray, weights: np.ndarray, examples: list[tuple[int, int, np.ndarray, np.ndarray]]) -> Index:
    """An index of examples (doc_id, toxic, places, counts)."""
    held: dict = {}
    for doc_id, toxic, places, counts in sorted(examples, key=lambda e: e[0]):
        entry = held.setdefault((places.tobytes(), counts.tobytes()), [doc_id, 0, 0, places, counts])
        entry[1] += 1
        entry[2] += toxic
    # Entries whose weightiest terms agree stand together, which keeps block bounds tight.
    leading = lambda e: e[3][np.argsort(-(1 + np.log(e[4])) * weights[e[3]], kind="stable")[:8]].tolist()
    rows = sorted(held.values(), key=lambda e: (leading(e), e[0]))
    column = lambda i: np.array([e[i] for e in rows], np.int64)
    none = np.zeros(0, np.int64)
    shell = Index(vocabulary, weights, column(0), column(1), column(2), *[none] * 7)
    term = np.concatenate([e[3] for e in rows] or [none])
    entry = np.repeat(np.arange(len(rows)), [len(e[3]) for e in rows])
    value = np.concatenate([shell.vector(e[3], e[4]) for e in rows] or [np.zeros(0)])
    order = np.lexsort((entry, term))
    term, entry, value = term[order], entry[order], value[order].astype(np.float32)
    new = np.ones(len(term), dtype=bool)
    new[1:] = (term[1:] != term[:-1]) | (entry[1:] // BLOCK != entry[:-1] // BLOCK)
    starts = np.flatnonzero(new)
    tops = np.maximum.reduceat(value, starts) if len(starts) else value
    cells = np.searchsorted(term[starts], np.arange(len(vocabulary) + 1))
    common = np.bincount(term, minlength=len(vocabulary)) * DENSE >= max(1, len(rows))
    return replace(
        shell, columns=np.where(common, np.cumsum(common) - 1, -1), cells=cells, blocks=(entry[starts] // BLOCK).astype(np.int32), tops=tops, starts=np.append(starts, len(term)).astype(np.int32), entries=entry.astype(np.int32), values=value)


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[tuple, tuple]:
    """Knots of the best rising steps through (x, y), by pooling neighbours that fall."""
    blocks: list[list[float]] = []
    values, group = np.unique(x, return_inverse=True)
    for value, label, n in zip(values.tolist(), np.bincount(group, weights=y).tolist(), np.bincount(group).tolist()):
        blocks.append([value, value, label, n])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][3] >= blocks[-1][2] * blocks[-2][3]:
            last = blocks.pop()
            blocks[-1] = [blocks[-1][0], last[1], blocks[-1][2] + last[2], blocks[-1][3] + last[3]]
    knots = [(v, b[2] / b[3]) for b in blocks for v in dict.fromkeys((b[0], b[1]))]
    return tuple(k for k, _ in knots), tuple(v for _, v in knots)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def _family(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The least five-word run of each text: near copies mostly share it."""
    words, bounds = hashed_words(strings(batch.column("text")))
    runs = grams(words, 5, 41)
    least = [int(runs[a: max(a + 1, b - 4)].min().view(np.int64)) if b - a >= 5 else hash((0, *words[a:b].tolist())) for a, b in zip(bounds[:-1], bounds[1:])]
    yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(least, pa.int64())], names=["doc_id", "family"])


def _term_lists(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    terms, text = terms_of(strings(batch.column("text")))
    order = np.lexsort((terms, text))
    terms, text = terms[order], text[order]
    new = np.ones(len(terms), dtype=bool)
    new[1:] = (terms[1:] != terms[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    edges = np.searchsorted(text[first], np.arange(batch.num_rows + 1)).astype(np.int32)
    lists = lambda v: pa.ListArray.from_arrays(pa.array(edges), pa.array(v))
    counts = np.diff(np.append(first, len(terms)))
    yield pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), batch.column("toxic").cast(pa.int32()), lists(terms[first].view(np.int64)), lists(counts.astype(np.int32))], names=["doc_id", "toxic", "terms", "counts"])


def _frequencies(vocabulary: np.ndarray):
    """Documents that hold each term of the vocabulary: one row a term and task, and one of place -1 for all documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, total = np.zeros(len(vocabulary), np.int64), 0
        for batch in batches:
            texts = strings(batch.column("text"))
            for start, end in chunks(texts):
                _, place, _ = _counts(texts.slice(start, end - start), vocabulary)
                seen += np.bincount(place, minlength=len(vocabulary))
            total += batch.num_rows
        place = np.flatnonzero(seen)
        for a in range(0, len(place), 100_000):
            yield pa.RecordBatch.from_pydict({"place": pa.array(place[a: a + 100_000].astype(np.int32)), "n": pa.array(seen[place[a: a + 100_000]])})
        yield pa.RecordBatch.from_pydict({"place": pa.array([-1], pa.int32()), "n": pa.array([total], pa.int64())})
    return run


def telling(toxic_with: np.ndarray, clean_with: np.ndarray, toxic: int, clean: int, errors: float = 3.0, floor: float = 0.05) -> np.ndarray:
    """A weight for how surely terms go with the label: the log odds ratio's size less ``errors`` standard errors, at least 0, plus ``floor``.

    It tends to the ratio itself as examples grow in number, so it doesn't depend on how many there are.
    """
    a, b, c, d = toxic_with + 0.5, toxic - toxic_with + 0.5, clean_with + 0.5, clean - clean_with + 0.5
    return floor + np.maximum(0.0, np.abs(np.log(a * d / (b * c))) - errors * np.sqrt(1 / a + 1 / b + 1 / c + 1 / d))


def fit(docs: DataFrame, labels: DataFrame, train_documents: int = 4_000, k: int = 15) -> Index:
    """The index of at most ``train_documents`` labelled texts, those of least id hash, with all their terms.

    Three quarters of them are indexed and the rest calibrate. Of near copies
    one text counts in the weights of terms. The texts of a sample this size
    come to the driver as counts of terms, never as texts.
    """
    labelled = labels.filter("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sample = written(labelled_texts(docs, labelled, "toxic", train_documents), "labelled")
    families = dict(mapped(sample.select("doc_id", "text"), _family, "doc_id long, family long").toPandas().sort_values("doc_id", ascending=False)[["family", "doc_id"]].itertuples(index=False))
    table = mapped(sample, _term_lists, "doc_id long, toxic int, terms array<long>, counts array<int>").toArrow().sort_by("doc_id")
    ids, toxic = table["doc_id"].to_numpy(), table["toxic"].to_numpy().astype(np.int64)
    terms, counts = (table[c].combine_chunks() for c in ("terms", "counts"))
    sizes = np.array(terms.value_lengths(), np.int64)
    vocabulary, place = np.unique(terms.flatten().to_numpy().view(np.uint64), return_inverse=True)
    one = np.isin(ids, list(families.values()))
    owner = np.repeat(np.arange(len(ids)), sizes)
    with_ = [np.bincount(place[(one & (toxic == v))[owner]], minlength=len(vocabulary)) for v in (1, 0)]
    weights = telling(*with_, int((one & (toxic == 1)).sum()), int((one & (toxic == 0)).sum()))
    bounded_batches(docs.sparkSession)
    counted = docs.select("text").mapInArrow(_frequencies(vocabulary), "place int, n long").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    at, n = counted["place"].to_numpy(), counted["n"].to_numpy()
    df = np.zeros(len(vocabulary))
    df[at[at >= 0]] = n[at >= 0]
    weights *= 1 + np.log((n[at < 0].sum() + 1) / (df + 1))
    edges, flat = np.append(0, np.cumsum(sizes)).tolist(), counts.flatten().to_numpy()
    examples = [(d, t, place[a:b], flat[a:b]) for d, t, a, b in zip(ids.tolist(), toxic.tolist(), edges, edges[1:])]
    tuning = examples[3::4]
    index = build(vocabulary, weights, [e for i, e in enumerate(examples) if i % 4 != 3])
    if 0 < sum(e[1] for e in tuning) < len(tuning):
        held = np.append(0, np.cumsum([len(e[2]) for e in tuning])).tolist()
        raw = [index.vote(*n) for n in index.neighbours(held, np.concatenate([e[2] for e in tuning]), np.concatenate([e[3] for e in tuning]), k, index.matrix())]
        index = replace(index, knots=isotonic(np.array(raw), np.array([e[1] for e in tuning])))
    return index


def _scored(index: Index, k: int, evidence: int):
    made: list[np.ndarray] = []  # the matrix is cheaper to make in each task than to send

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        text, place, count = _counts(strings(batch.column("text")), index.vocabulary)
        edges = np.searchsorted(text, np.arange(batch.num_rows + 1)).tolist()
        scores, ids, cosines = [], [], []
        if not made:
            made.append(index.matrix())
        for near, cosine in index.neighbours(edges, place, count, k, made[0]):
            scores.append(index.calibrated(index.vote(near, cosine)))
            ids.append(index.ids[near[:evidence]].tolist())
            cosines.append(cosine[:evidence].tolist())
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), pa.array(scores, pa.float64()), pa.array(ids, pa.list_(pa.int64())), pa.array(cosines, pa.list_(pa.float64())),
        ], names=["doc_id", "score", "evidence_ids", "evidence_cosines"])
    return run


def score(docs: DataFrame, index: Index, k: int = 15, evidence: int = 5) -> DataFrame:
    """A score from 0 to 1 for each row: doc_id, score, evidence_ids, evidence_cosines (the nearest examples).

    Null and empty texts, and texts without any term of an example, have no
    evidence and score by the share of toxic examples. Without labelled
    examples every score is 0. Repeated rows are scored alike, each for itself;
    very long texts are scored whole. A null doc_id passes through. Other
    columns are ignored.
    """
    schema = "doc_id long, score double, evidence_ids array<long>, evidence_cosines array<double>"
    return mapped(docs.select("doc_id", "text"), _scored(index, k, evidence), schema)
