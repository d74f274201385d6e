"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are taken from whole texts inside tasks.  The trees are grown on the driver from at most
``max_rows`` labelled rows (the first ones in a fixed hash order of doc_id, a documented bound), on
per-feature histograms of quantile bins, and flattened into parallel arrays; scoring walks all rows
of a chunk through a tree level by level with numpy.

Labels are learnt only outside the held-out fold (``text.held_out``).  Defined results: null text
counts as empty; an empty text has statistics of zeros and gets the score of its leaf; repeated
rows are scored one by one; null ids are kept and not held out; conflicting labels of one id count as
their maximum; an empty table gives no rows; without labels of both classes every score is the
smoothed base rate; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import BLANKS, Chunk, byte_set, chunks, covered, held_out, inside_row, mix, split_words, window_hashes, word_hashes

MAX_ROWS = 12_000
FEATURES = ("log_words", "word_length", "upper", "digits", "symbols", "marks", "blanks", "high_bytes", "upper_words",
            "marked_words", "distinct_words", "repeat_pairs", "repeat_windows", "repeat_lines", "adjacent_equal", "line_words")
_UPPER, _LOWER, _DIGITS = bytes(range(65, 91)), bytes(range(97, 123)), bytes(range(48, 58))
_SYMBOLS, _MARKS = b"#*$%&|<>=+~^@\\/_{}[]", b"!?.,;:\"'()-"


def _repeated(words, hashes: np.ndarray, width: int, rows: int) -> np.ndarray:
    """Share of a row's words that lie in a window of ``width`` words found twice or more in the row."""
    starts = np.flatnonzero(inside_row(words, width))
    keys = window_hashes(hashes, width)[starts] + mix(words.row[starts].astype(np.uint64) + np.uint64(1))
    _, which, times = np.unique(keys, return_inverse=True, return_counts=True)
    again = covered(starts[times[which] > 1], width, len(words.row))
    return np.bincount(words.row[again], minlength=rows)


def statistics(chunk: Chunk) -> np.ndarray:
    """FEATURES of each row of a chunk, one row each."""
    words = split_words(chunk)
    hashes = word_hashes(chunk.data, words.start, words.end)
    n, size = np.maximum(words.counts, 1), np.maximum(np.diff(chunk.offsets), 1)
    share = {name: chunk.row_sums(byte_set(members)[chunk.data]) / size
             for name, members in (("upper", _UPPER), ("digits", _DIGITS), ("symbols", _SYMBOLS), ("marks", _MARKS), ("blanks", BLANKS))}
    per_word = lambda mask: np.bincount(words.row[mask], minlength=chunk.rows) / n
    last = chunk.data[words.end - 1] if len(words.end) else np.zeros(0, np.uint8)
    lower = np.concatenate([[0], np.cumsum(byte_set(_LOWER)[chunk.data])])
    upper = np.concatenate([[0], np.cumsum(byte_set(_UPPER)[chunk.data])])
    shouted = (upper[words.end] > upper[words.start]) & (lower[words.end] == lower[words.start]) & (words.end - words.start > 1)
    _, once = np.unique(hashes + mix(words.row.astype(np.uint64) + np.uint64(1)), return_index=True)
    equal = np.zeros(len(hashes), dtype=bool)
    if len(hashes) > 1:
        equal[1:] = (hashes[1:] == hashes[:-1]) & (words.row[1:] == words.row[:-1])
    repeat_lines, lines = np.zeros(chunk.rows), np.ones(chunk.rows)
    for i in range(chunk.rows):
        full = [x for x in chunk.text(i).split(b"\n") if x and not x.isspace()]
        repeat_lines[i], lines[i] = (len(full) - len(set(full))) / max(len(full), 1), max(len(full), 1)
    return np.stack([
        np.log1p(words.counts), (np.bincount(words.row, weights=words.end - words.start, minlength=chunk.rows) / n),
        share["upper"], share["digits"], share["symbols"], share["marks"], share["blanks"],
        chunk.row_sums(chunk.data >= 128) / size, per_word(shouted),
        per_word(byte_set(_SYMBOLS + b"!?")[last]), np.bincount(words.row[once], minlength=chunk.rows) / n,
        _repeated(words, hashes, 2, chunk.rows) / n, _repeated(words, hashes, 8, chunk.rows) / n, repeat_lines,
        per_word(equal), np.log1p(words.counts / lines),
    ], axis=1).astype(np.float64)


@dataclass
class Forest:
    """Complete binary trees of one depth, node k's children at 2k + 1 and 2k + 2; one row of arrays a tree."""

    base: float
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray

    def logits(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows, inner = np.arange(len(x)), self.feature.shape[1]
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(len(x), dtype=np.int64)
            while len(node) and node[0] < inner:
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            out += leaf[node - inner]
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.logits(x), -30, 30)))


def grow(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, bins: int = 64, rate: float = 0.15,
         ridge: float = 2.0, least: int = 8) -> Forest:
    """Boost depth-wise trees on logistic loss; splits are searched in per-node gradient histograms."""
    inner, width = 2 ** depth - 1, x.shape[1] if x.ndim == 2 else len(FEATURES)
    rate0 = (y.sum() + 1.0) / (len(y) + 2.0)
    forest = Forest(float(np.log(rate0 / (1 - rate0))), np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    if len(y) == 0 or y.min() == y.max():
        return forest
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    margin, grown = np.full(len(y), forest.base), []
    for _ in range(trees):
        p = 1.0 / (1.0 + np.exp(-margin))
        gradient, hessian = p - y, p * (1 - p)
        feature, cut, leaf = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(inner + 1)
        node = np.zeros(len(y), dtype=np.int64)
        for level in range(depth):
            first, many = 2 ** level - 1, 2 ** level
            best = np.full(many, 1e-6)
            split = np.full((many, 2), -1, dtype=np.int64)
            at = node - first
            for f in range(width):
                cell = at * bins + binned[:, f]
                g, h, c = (np.bincount(cell, weights=w, minlength=many * bins).reshape(many, bins).cumsum(axis=1) for w in (gradient, hessian, np.ones(len(y))))
                g_all, h_all, c_all = g[:, -1:], h[:, -1:], c[:, -1:]
                gain = g ** 2 / (h + ridge) + (g_all - g) ** 2 / (h_all - h + ridge) - g_all ** 2 / (h_all + ridge)
                gain[(c < least) | (c_all - c < least)] = 0
                gain[:, len(edges[f]):] = 0
                top = gain.argmax(axis=1)
                better = gain[np.arange(many), top] > best
                best[better] = gain[np.arange(many), top][better]
                split[better] = np.stack([np.full(many, f), top], axis=1)[better]
            for k in np.flatnonzero(split[:, 0] >= 0):
                feature[first + k], cut[first + k] = split[k, 0], edges[split[k, 0]][split[k, 1]]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > cut[node])
        spot = node - inner
        leaf = -rate * np.bincount(spot, weights=gradient, minlength=inner + 1) / (np.bincount(spot, weights=hessian, minlength=inner + 1) + ridge)
        margin += leaf[spot]
        grown.append((feature, cut, leaf))
    return Forest(forest.base, *(np.stack(part) for part in zip(*grown)))


def sample_labels(labels: DataFrame, column: str, max_rows: int) -> DataFrame:
    """At most ``max_rows`` learnable (doc_id, y): the first in hash order of doc_id, one row an id."""
    return (labels.filter(F.col(column).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
            .groupBy("doc_id").agg(F.max(column).cast("int").alias("y"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))


def fit(docs: DataFrame, labels: DataFrame, column: str = "quality", max_rows: int = MAX_ROWS) -> Forest:
    """Take statistics of the sampled rows on the executors; only those numbers reach the driver."""

    def measure(batches):
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                rows = [pa.array(r) for r in statistics(chunk)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(chunk.first, chunk.rows), pa.array([r.to_pylist() for r in rows], pa.list_(pa.float64()))], ["y", "x"])

    chosen = docs.select("doc_id", "text").join(F.broadcast(sample_labels(labels, column, max_rows)), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))  # one row an id
    rows = chosen.select("y", "text").mapInArrow(measure, "y int, x array<double>").collect()
    rows = sorted((r.y, tuple(r.x)) for r in rows)  # one order, however the tasks ended
    x, y = np.array([r[1] for r in rows], dtype=np.float64), np.array([r[0] for r in rows], dtype=np.float64)
    return grow(x.reshape(len(rows), len(FEATURES)), y)


def score(docs: DataFrame, forest: Forest, cut: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""

    def rate(batches):
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(chunk.first, chunk.rows), pa.array(forest.scores(statistics(chunk)))], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = docs.select("doc_id", "text").mapInArrow(rate, f"doc_id {kind}, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))
