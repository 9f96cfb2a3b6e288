"""Quality rules: a linear-chain conditional random field marks each line as content or boilerplate.

A line is described by yes-or-no features of its own characters and words. The
field has one weight a feature, a weight for each pair of neighbouring states
and one for each first state; Viterbi decoding gives the likeliest states of
all lines together. A text is kept if enough of its characters are content and
two plain rules hold.

The field is fitted on at most ``train_documents`` rated texts, those of least
id hash. Lines of a text rated 0 count as boilerplate, and so do lines equal to
an earlier line of their text; all others count as content.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.text import bytes_of, grams, labelled_texts, mapped, mixed, run_hashes, strings, word_starts

SYMBOLS = b"#*$%&|<>"
FEATURES = (
    "any line", "one word", "two to four words", "five to nine words", "ten words or more",
    "a symbol", "symbols over 2 %", "symbols over 10 %", "exclamation marks over 4 %", "capitals over 50 %", "digits over 20 %",
    "under 80 % of words differ", "under 50 % of words differ", "equals an earlier line", "ends a sentence", "words over 12 characters",
)

_CODE_POINT = (np.arange(256) & 0xC0) != 0x80
_SYMBOL = np.isin(np.arange(256), np.frombuffer(SYMBOLS, np.uint8))
_UPPER = np.isin(np.arange(256), np.arange(65, 91))
_DIGIT = np.isin(np.arange(256), np.arange(48, 58))
_CLOSING = np.isin(np.arange(256), np.frombuffer(b".!?:;\"')", np.uint8))


@dataclass(frozen=True)
class LineField:
    """``weights``: of each feature for boilerplate; ``pairs[a, b]``: of state b after a; ``first``: of the first state. State 1 is boilerplate."""

    weights: np.ndarray
    pairs: np.ndarray
    first: np.ndarray

    def states(self, lines: np.ndarray) -> np.ndarray:
        """The likeliest states of the lines of one text; of equal paths the one with content later on."""
        gain = lines @ self.weights
        (c, b), (cc, cb, bc, bb), back = self.first.tolist(), self.pairs.ravel().tolist(), []
        for g in gain.tolist():
            if not back:
                back.append((0, 0))
                b += g
                continue
            from_c, from_b = cc + c >= bc + b, cb + c >= bb + b
            back.append((0 if from_c else 1, 0 if from_b else 1))
            c, b = (cc + c if from_c else bc + b), (cb + c if from_b else bb + b) + g
        out = np.zeros(len(lines), dtype=np.int8)
        state = 0 if c >= b else 1
        for i in range(len(lines) - 1, -1, -1):
            out[i] = state
            state = back[i][state]
        return out


def _total(flags: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Marked entries before each edge."""
    return np.append(0, np.cumsum(flags, dtype=np.int64))[edges]


def measured(column: pa.Array) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Counts by text; of all lines that hold a word: text number, characters and features."""
    raw, offsets = bytes_of(column)
    inside, starts = word_starts(raw, offsets)
    words, bounds = run_hashes(raw, inside, starts) if len(starts) else np.zeros(0, np.uint64), np.searchsorted(starts, offsets)
    texts = len(column)
    counts = {"n_words": np.diff(bounds), "word_chars": np.diff(_total(inside & _CODE_POINT[raw], offsets)), "n_symbols": np.diff(_total(_SYMBOL[raw], offsets))}

    text_of = np.repeat(np.arange(texts), np.diff(bounds))
    covered = np.zeros(len(words), dtype=bool)
    triples = grams(words, 3)
    if len(triples):
        at = np.flatnonzero(text_of[:-2] == text_of[2:])
        _, group, times = np.unique(mixed(triples[at]) ^ mixed(text_of[at].astype(np.uint64), 9), return_inverse=True, return_counts=True)
        at = at[times[group] > 1]
        for k in range(3):
            covered[at + k] = True
    counts["n_repeat_words"] = np.diff(_total(covered, bounds))

    # Lines: the stretches between line feeds and text ends.
    cut = np.union1d(np.flatnonzero(raw == 10) + 1, offsets)
    begin, end = cut[:-1], cut[1:].copy()
    end -= raw[end - 1] == 10 if len(end) else 0
    held = np.diff(np.stack([_total(inside, begin), _total(inside, end)]), axis=0)[0] > 0
    begin, end = begin[held], end[held]
    line_text = np.searchsorted(offsets, begin, side="right") - 1
    own = np.zeros(len(raw), dtype=bool)
    if len(begin):
        edge = np.zeros(len(raw) + 1, dtype=np.int8)
        edge[begin] += 1
        edge[end] -= 1
        own = np.cumsum(edge[:-1], dtype=np.int8) > 0
        hashes = run_hashes(raw, own, begin)
        keys = mixed(hashes) ^ mixed(line_text.astype(np.uint64), 10)
        _, seen = np.unique(keys, return_index=True)
        again = np.ones(len(begin), dtype=bool)
        again[seen] = False
    else:
        again = np.zeros(0, dtype=bool)
    counts["n_dup_lines"] = np.bincount(line_text[again], minlength=texts)

    span = lambda flags: _total(flags, end) - _total(flags, begin)
    chars, solid = span(_CODE_POINT[raw]), np.maximum(1, span(inside & _CODE_POINT[raw]))
    n_words = distinct = np.zeros(len(begin), np.int64)
    if len(begin):
        word_line = np.searchsorted(begin, starts, side="right") - 1
        n_words = np.bincount(word_line, minlength=len(begin))
        _, once = np.unique(mixed(words) ^ mixed(word_line.astype(np.uint64), 12), return_index=True)
        distinct = np.bincount(word_line[once], minlength=len(begin))
    last = np.zeros(len(begin), dtype=bool)
    if len(begin):
        solid_at = np.flatnonzero(inside)
        last = _CLOSING[raw[solid_at[_total(inside, end) - 1]]]
    symbols, n = span(_SYMBOL[raw]), np.maximum(1, n_words)
    lines = np.stack([
        np.ones(len(begin), bool), n_words <= 1, (n_words >= 2) & (n_words <= 4), (n_words >= 5) & (n_words <= 9), n_words >= 10,
        symbols > 0, symbols > 0.02 * solid, symbols > 0.1 * solid, span(raw == 33) > 0.04 * solid, span(_UPPER[raw]) > 0.5 * solid, span(_DIGIT[raw]) > 0.2 * solid,
        distinct < 0.8 * n, distinct < 0.5 * n, again, last, solid > 12 * n,
    ], axis=1) if len(begin) else np.zeros((0, len(FEATURES)), bool)
    return counts, line_text, chars, lines


def _sampled(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    _, line_text, _, lines = measured(strings(batch.column("text")))
    bits = (lines.astype(np.int64) << np.arange(lines.shape[1])).sum(axis=1).astype(np.int32)
    edges = np.searchsorted(line_text, np.arange(batch.num_rows + 1)).astype(np.int32)
    yield pa.RecordBatch.from_arrays([batch.column("quality").cast(pa.int32()), pa.ListArray.from_arrays(pa.array(edges), pa.array(bits))], names=["quality", "lines"])


def fit_field(docs: DataFrame, labels: DataFrame, train_documents: int = 4000, train_lines: int = 400, rounds: int = 150, penalty: float = 1e-3) -> LineField:
    """Fit by gradient ascent on the likelihood of the weakly labelled lines.

    At most ``train_documents`` rated texts take part, and of these only those
    of at most ``train_lines`` lines, so at most their product of numbers
    reaches the driver. Without both ratings the field calls every line content.
    """
    rated = labels.filter("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    sample = mapped(labelled_texts(docs, rated, "quality", train_documents).select("text", "quality"), _sampled, "quality int, lines array<int>")
    rows = sample.filter(F.size("lines").between(1, train_lines)).toArrow()
    n = len(FEATURES)
    quality = rows.column("quality").to_numpy()
    if len(set(quality.tolist())) < 2:
        return LineField(np.zeros(n) - np.eye(1, n)[0], np.zeros((2, 2)), np.zeros(2))
    texts = sorted(zip(quality.tolist(), rows.column("lines").to_pylist()), key=lambda x: (-len(x[1]), x))
    longest = len(texts[0][1])
    x = np.zeros((len(texts), longest, n))
    mask = np.zeros((len(texts), longest), dtype=bool)
    for i, (_, bits) in enumerate(texts):
        x[i, : len(bits)] = (np.array(bits)[:, None] >> np.arange(n)) & 1
        mask[i, : len(bits)] = True
    y = (((np.array([q for q, _ in texts]) == 0)[:, None] | (x[:, :, FEATURES.index("equals an earlier line")] > 0)) & mask).astype(np.int64)
    weight = np.full(len(texts), 1.0)
    return _ascend(x, y, mask, weight, rounds, penalty)


def _ascend(x, y, mask, weight, rounds, penalty) -> LineField:
    texts, longest, n = x.shape
    live = mask.sum(axis=0)  # texts are ordered by length, so the first live[t] have a line t
    w, pairs, first = np.zeros(n), np.zeros((2, 2)), np.zeros(2)
    state = [np.zeros(n + 6), np.zeros(n + 6)]
    total = float((weight[:, None] * mask).sum())
    known = np.concatenate([
        np.einsum("i,it,itn->n", weight, y * mask, x),
        [sum(float((weight[: live[t]] * ((y[: live[t], t - 1] == a) & (y[: live[t], t] == b))).sum()) for t in range(1, longest)) for a in (0, 1) for b in (0, 1)],
        [float(weight[y[:, 0] == a].sum()) for a in (0, 1)],
    ])
    for step in range(1, rounds + 1):
        gain = np.stack([np.zeros((texts, longest)), x @ w], axis=2)
        ahead = np.zeros((texts, longest, 2))
        ahead[:, 0] = first + gain[:, 0]
        for t in range(1, longest):
            k = live[t]
            ahead[:k, t] = np.logaddexp(ahead[:k, t - 1, :1] + pairs[0], ahead[:k, t - 1, 1:] + pairs[1]) + gain[:k, t]
        behind = np.zeros((texts, longest, 2))
        expected = np.zeros((2, 2))
        lengths = mask.sum(axis=1)
        norm = np.logaddexp(*ahead[np.arange(texts), lengths - 1].T)
        for t in range(longest - 1, 0, -1):
            k = live[t]
            later = behind[:k, t] + gain[:k, t]
            joint = ahead[:k, t - 1, :, None] + pairs + later[:, None, :]
            expected += np.einsum("i,iab->ab", weight[:k], np.exp(joint - norm[:k, None, None]))
            behind[:k, t - 1] = np.logaddexp(pairs[:, 0] + later[:, :1], pairs[:, 1] + later[:, 1:])
        odds = np.exp(ahead + behind - norm[:, None, None]) * (mask * weight[:, None])[:, :, None]
        slope = known - np.concatenate([np.einsum("it,itn->n", odds[:, :, 1], x), expected.ravel(), odds[:, 0].sum(axis=0)])
        at = np.concatenate([w, pairs.ravel(), first])
        slope = slope / total - penalty * at
        for held, new, rate in ((0, slope, 0.9), (1, slope**2, 0.99)):
            state[held] = rate * state[held] + (1 - rate) * new
        at = at + 0.1 * (state[0] / (1 - 0.9**step)) / (np.sqrt(state[1] / (1 - 0.99**step)) + 1e-8)
        w, pairs, first = at[:n], at[n: n + 4].reshape(2, 2), at[n + 4:]
    return LineField(w, pairs, first)


def _judged(field: LineField, min_words: int, content_share: float):
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        counts, line_text, chars, lines = measured(strings(batch.column("text")))
        edges = np.searchsorted(line_text, np.arange(batch.num_rows + 1))
        states, share = [], np.zeros(batch.num_rows)
        for i, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
            marks = field.states(lines[a:b])
            states.append(marks.tolist())
            share[i] = chars[a:b][marks == 0].sum() / chars[a:b].sum() if b > a else 0.0
        failed = (counts["n_words"] < min_words) | (100 * counts["n_repeat_words"] > 50 * counts["n_words"])
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), *(pa.array(counts[k].astype(np.int64)) for k in names), pa.array(failed), pa.array(share),
            pa.array(~failed & (share >= content_share)), pa.array(states, pa.list_(pa.int8())),
        ], names=["doc_id", *names, "base_failed", "content_share", "kept", "line_states"])
    return run


def judge(docs: DataFrame, field: LineField, min_words: int = 50, content_share: float = 0.5) -> DataFrame:
    """Counts, the content share by characters and the verdict for each row, by one narrow pass.

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, content_share, kept and line_states (1 for
    boilerplate, by line that holds a word).

    A null or empty text has no words and fails the base rules. A null doc_id
    passes through. Repeated rows are judged each. Other columns are ignored.
    """
    return mapped(docs.select("doc_id", "text"), _judged(field, min_words, content_share), (
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, content_share double, kept boolean, line_states array<tinyint>"
    ))


def kept_documents(docs: DataFrame, field: LineField, min_words: int = 50, content_share: float = 0.5) -> DataFrame:
    """The rows that ``judge`` keeps, with all their columns, in one narrow pass."""
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for verdict in _judged(field, min_words, content_share)(pa.RecordBatch.from_arrays([pa.nulls(batch.num_rows, pa.int64()), batch.column("text")], names=["doc_id", "text"])):
            yield batch.filter(verdict.column("kept"))
    return mapped(docs, run, docs.schema)
