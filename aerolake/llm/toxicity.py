"""Toxicity: counterfactual-regularised linear classifier over hashed word and word-prefix features.

Texts that mention an identity group get a counterfactual twin in which the term is swapped for
another of its list; training penalises the squared change of the logit between twins, so that a
neutral mention doesn't move the score however the labels happen to correlate with it.

The model is fitted on at most ``max_rows`` labelled rows outside the held-out fold (the first ones
in a fixed hash order of doc_id, a documented bound); features are taken on the executors and only
hashed counts reach the driver.  Scoring covers every whole text.

Defined results: null text counts as empty; an empty text gets the score of the bias; repeated rows
are scored one by one; null ids are kept and not held out; an empty table gives no rows; without
labels of both classes every score is the smoothed base rate; other columns are ignored.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quality_trees import sample_labels
from .text import Chunk, chunks, held_out, split_words, tidy, word_hashes

MAX_ROWS = 8_000
BUCKETS = 1 << 18
PREFIXES = (4, 5)
#: Neutral group mentions by list; a term is swapped for the others of its own list.
IDENTITY = (
    ("women", "men", "girls", "boys"), ("woman", "man", "girl", "boy"), ("female", "male", "transgender", "nonbinary"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic", "protestant", "sikh"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics", "protestants", "sikhs"),
    ("black", "white", "asian", "african", "european", "latino", "hispanic", "arab", "mexican", "american", "chinese", "indian"),
    ("gay", "lesbian", "bisexual", "straight", "heterosexual", "homosexual", "queer"),
    ("immigrants", "refugees", "citizens", "natives", "foreigners"), ("old", "young", "elderly", "teenage"),
    ("disabled", "blind", "deaf", "autistic"), ("femmes", "hommes"), ("musulmans", "chrétiens", "juifs"), ("mujeres", "hombres"),
    ("musulmanes", "cristianos", "judíos"), ("frauen", "männer"), ("muslime", "christen", "juden"),
)

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
#: Everything in ASCII but letters and digits parts words.
_BREAKS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def buckets_of(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Buckets of each word: of the whole word, then of its prefixes (one row each)."""
    out = [word_hashes(data, start, end)]
    for k, size in enumerate(PREFIXES, 1):
        out.append(word_hashes(data, start, np.minimum(start + size, end)) + np.uint64(k * 0x9E3779B97F4A7C15 % 2 ** 64))
    return (np.stack(out) % np.uint64(BUCKETS)).astype(np.int32)


def term_buckets(terms: list[str]) -> np.ndarray:
    data = np.frombuffer(" ".join(terms).encode(), dtype=np.uint8)
    sizes = np.array([len(t.encode()) for t in terms])
    start = np.cumsum(sizes + 1) - sizes - 1
    return buckets_of(data, start, start + sizes)


def row_features(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, count), sorted, of every feature of a chunk."""
    folded = Chunk(chunk.first, _FOLD[chunk.data], chunk.offsets)
    words = split_words(folded, _BREAKS)
    b = buckets_of(folded.data, words.start, words.end)
    keys, counts = np.unique(np.tile(words.row, len(b)) * BUCKETS + b.ravel(), return_counts=True)
    return keys // BUCKETS, keys % BUCKETS, counts


@dataclass
class Linear:
    bias: float
    weights: np.ndarray  # by bucket, zero where a feature wasn't chosen

    def scores(self, chunk: Chunk) -> np.ndarray:
        folded = Chunk(chunk.first, _FOLD[chunk.data], chunk.offsets)
        words = split_words(folded, _BREAKS)
        logit = np.full(chunk.rows, self.bias)
        b = buckets_of(folded.data, words.start, words.end)
        used = self.weights[b] != 0
        keys, counts = np.unique((words.row[None, :] * BUCKETS + b)[used], return_counts=True)
        np.add.at(logit, keys // BUCKETS, self.weights[keys % BUCKETS] * np.log1p(counts))
        return 1.0 / (1.0 + np.exp(-np.clip(logit, -30, 30)))


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], fairness: float = 5.0, ridge: float = 1e-4, features: int = 4096,
          steps: int = 400, z_least: float = 3.0) -> Linear:
    """Full-batch Adam on logistic loss + ridge + fairness * mean squared counterfactual logit change.

    ``rows``: label, buckets and counts of each text.
    """
    y = np.array([r[0] for r in rows], dtype=np.float64)
    rate = (y.sum() + 1.0) / (len(y) + 2.0)
    model = Linear(float(np.log(rate / (1 - rate))), np.zeros(BUCKETS))
    if len(y) == 0 or y.min() == y.max():
        return model
    has = [np.bincount(np.concatenate([r[1] for r in rows if r[0] == k]), minlength=BUCKETS) for k in (0, 1)]
    share = [(h + 0.5) / (n + 1.0) for h, n in zip(has, (len(y) - y.sum(), y.sum()))]
    both = (has[0] + has[1] + 0.5) / (len(y) + 1.0)
    z = (share[1] - share[0]) / np.sqrt(both * (1 - both).clip(1e-9) * (1 / (len(y) - y.sum()) + 1 / y.sum()))
    z[has[0] + has[1] < 2] = 0
    chosen = np.argsort(-np.abs(z), kind="stable")[:features]
    chosen = np.sort(chosen[np.abs(z[chosen]) >= z_least])
    slot = np.full(BUCKETS, -1, dtype=np.int64)
    slot[chosen] = np.arange(len(chosen))

    def sparse(parts):
        """Entries (row, slot, value) of log counts, chosen features only."""
        row = np.repeat(np.arange(len(parts)), [len(b) for b, _ in parts]) if parts else np.zeros(0, np.int64)
        b = np.concatenate([b for b, _ in parts]).astype(np.int64) if parts else row
        c = np.concatenate([c for _, c in parts]).astype(np.float64) if parts else row.astype(float)
        keep = slot[b] >= 0
        return row[keep], slot[b[keep]], c[keep]

    row, col, count = sparse([(b, c) for _, b, c in rows])
    value = np.log1p(count)
    twins = counterfactuals([(b, c) for _, b, c in rows])
    t_row, t_col, change = sparse(twins)
    n_twins = max(len(twins), 1)
    w, bias, m, v = np.zeros(len(chosen)), model.bias, np.zeros(len(chosen) + 1), np.zeros(len(chosen) + 1)
    for step in range(1, steps + 1):
        logit = bias + np.bincount(row, weights=w[col] * value, minlength=len(y))
        error = (1.0 / (1.0 + np.exp(-np.clip(logit, -30, 30))) - y) / len(y)
        moved = np.bincount(t_row, weights=w[t_col] * change, minlength=n_twins)
        grad = np.bincount(col, weights=error[row] * value, minlength=len(w)) + ridge * w
        grad += 2 * fairness * np.bincount(t_col, weights=moved[t_row] * change, minlength=len(w)) / n_twins
        grad = np.append(grad, error.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad ** 2
        delta = 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
        w, bias = w - delta[:-1], bias - delta[-1]
    model.bias, model.weights[chosen] = float(bias), w
    return model


def counterfactuals(rows: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Change of the log counts for each text and each swap of a group term it has for another of the list."""
    out = []
    for terms in IDENTITY:
        b = term_buckets(list(terms))
        for buckets, counts in rows:
            at = np.minimum(np.searchsorted(buckets, b[0]), max(len(buckets) - 1, 0))
            for i in np.flatnonzero(buckets[at] == b[0]) if len(buckets) else ():
                times = counts[at[i]]
                for j in range(len(terms)):
                    if j != i:
                        touched = np.unique(np.concatenate([b[:, i], b[:, j]]))
                        spot = np.minimum(np.searchsorted(buckets, touched), len(buckets) - 1)
                        before = np.where(buckets[spot] == touched, counts[spot], 0)
                        after = before - times * np.isin(touched, b[:, i]) + times * np.isin(touched, b[:, j])
                        out.append((touched, np.log1p(np.maximum(after, 0)) - np.log1p(before)))
    return out


def fit(docs: DataFrame, labels: DataFrame, column: str = "toxic", max_rows: int = MAX_ROWS, fairness: float = 5.0) -> Linear:
    def measure(batches):
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                row, bucket, count = row_features(chunk)
                first = np.searchsorted(row, np.arange(chunk.rows + 1))
                lists = [pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(x, pa.int32())) for x in (bucket, count)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(chunk.first, chunk.rows), *lists], ["y", "b", "c"])

    chosen = docs.select("doc_id", "text").join(F.broadcast(sample_labels(labels, column, max_rows)), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))  # one row an id
    found = chosen.select("y", "text").mapInArrow(tidy(measure), "y int, b array<int>, c array<int>").toArrow()  # max_rows at most
    rows = []
    for batch in found.to_batches():
        b, c = batch.column(1), batch.column(2)
        for i, y in enumerate(batch.column(0).to_pylist()):
            rows.append((y, b[i].values.to_numpy(), c[i].values.to_numpy()))
    rows.sort(key=lambda r: (r[0], len(r[1]), zlib.crc32(r[1].tobytes()), zlib.crc32(r[2].tobytes())))  # one order, however the tasks ended
    return train(rows, fairness)


def score(docs: DataFrame, model: Linear, cut: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""

    def rate(batches):
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(chunk.first, chunk.rows), pa.array(model.scores(chunk))], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = docs.select("doc_id", "text").mapInArrow(tidy(rate), f"doc_id {kind}, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))


def drop(docs: DataFrame, model: Linear, cut: float = 0.5) -> DataFrame:
    """The rows whose score is below ``cut``, with all their columns."""

    def keep(batches):
        for batch in batches:
            for chunk in chunks(batch.column(0)):
                yield batch.slice(chunk.first, chunk.rows).filter(pa.array(model.scores(chunk) < cut))

    first = docs.select("text", *[c for c in docs.columns if c != "text"])
    return first.mapInArrow(tidy(keep), first.schema).select(*docs.columns)
