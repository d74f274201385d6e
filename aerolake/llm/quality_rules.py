"""Quality rules with a hashed n-gram likelihood ratio.

Two multinomials over hashed word uni- and bigrams are counted in Spark: one over every document
(raw corpus), one over trusted documents (label quality = 1).  A document's verdict is the mean
log ratio of its n-grams, log p_trusted - log p_raw, against a fixed threshold; plain rules on
length and repetition come first.

Raw counts cover all documents, trusted counts all documents with a trusted label.  A sketch of the trusted ids keeps nearly all other
texts from travelling; the rest go through a sort-merge join by id (the same plan at every size), after which each task
adds up its own rows.

Defined results: null text counts as empty; an empty text has score 0.0 and fails the length rule;
repeated rows are judged one by one; null ids are kept and returned; an empty table gives no rows;
other columns, whatever their names, are ignored.  Without trusted rows the ratio is 0 everywhere.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sketch import part, present
from .text import BLANKS, Chunk, Words, byte_set, chunks, covered, inside_row, mix, split_words, window_hashes, word_hashes

BUCKETS = 1 << 16
THRESHOLD = -0.05
MIN_WORDS = 20
REPEAT_WINDOW = 8
MAX_REPEAT_PCT = 30
SYMBOLS = b"#*$%&|<>"


def gram_buckets(words: Words, hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every unigram and bigram of a chunk."""
    pair = inside_row(words, 2)
    two = window_hashes(hashes, 2)[pair]
    rows = np.concatenate([words.row, words.row[:len(pair)][pair]])
    return rows, (np.concatenate([mix(hashes), mix(two)]) % np.uint64(buckets)).astype(np.int64)


def gram_counts(docs: DataFrame, buckets: int) -> DataFrame:
    """bucket, n over all rows; each task adds up its own rows before the shuffle."""

    def count(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for chunk in chunks(batch.column(0)):
                words = split_words(chunk)
                hashes = word_hashes(chunk.data, words.start, words.end)
                total += np.bincount(gram_buckets(words, hashes, buckets)[1], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], ["bucket", "n"])

    return docs.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def trusted_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text of every row whose doc_id has a label of quality 1."""
    ids = labels.filter("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()
    likely = part(docs.select("text", "doc_id", F.xxhash64("doc_id").alias("key")), "key", present(ids.select(F.xxhash64("doc_id"))), True)
    return likely.join(ids.hint("merge"), "doc_id", "left_semi").select("text")


def log_ratios(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """log p_trusted - log p_raw per bucket, both smoothed by one raw-shaped pseudo count per bucket."""
    both = [np.zeros(buckets), np.zeros(buckets)]
    for out, frame in zip(both, (docs, trusted_texts(docs, labels))):
        for bucket, n in gram_counts(frame, buckets).collect():  # at most one row per bucket
            out[bucket] = n
    raw, good = both
    if not good.sum():
        return np.zeros(buckets)
    p_raw = (raw + 1.0) / (raw.sum() + buckets)
    p_good = (good + buckets * p_raw) / (good.sum() + buckets)
    return np.log(p_good) - np.log(p_raw)


def measure(chunk: Chunk, ratios: np.ndarray) -> dict[str, np.ndarray]:
    """Base figures and the length-normalised ratio of each row of a chunk."""
    words = split_words(chunk)
    hashes = word_hashes(chunk.data, words.start, words.end)
    n = len(words.start)
    lead = (chunk.data & 0xC0) != 0x80
    blank = byte_set(BLANKS)[chunk.data]
    inside = inside_row(words, REPEAT_WINDOW)
    starts = np.flatnonzero(inside)
    keys = window_hashes(hashes, REPEAT_WINDOW)[starts] + mix(words.row[starts].astype(np.uint64) + np.uint64(1))
    _, which, times = np.unique(keys, return_inverse=True, return_counts=True)
    again = covered(starts[times[which] > 1], REPEAT_WINDOW, n)
    duplicates = np.zeros(chunk.rows, dtype=np.int64)
    for i in range(chunk.rows):
        lines = [x for x in chunk.text(i).split(b"\n") if x and not x.isspace()]
        duplicates[i] = len(lines) - len(set(lines))
    rows, buckets = gram_buckets(words, hashes, len(ratios))
    grams = np.bincount(rows, minlength=chunk.rows)
    score = np.bincount(rows, weights=ratios[buckets], minlength=chunk.rows) / np.maximum(grams, 1)
    return {
        "n_words": words.counts.astype(np.int64),
        "word_chars": chunk.row_sums(lead & ~blank),
        "n_symbols": chunk.row_sums(byte_set(SYMBOLS)[chunk.data]),
        "n_dup_lines": duplicates,
        "n_repeat_words": np.bincount(words.row[again], minlength=chunk.rows).astype(np.int64),
        "score": score,
    }


def judge(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: base figures, base_failed, score and kept."""
    ratios = log_ratios(docs, labels, buckets)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def score(batches):
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                figures = measure(chunk, ratios)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(chunk.first, chunk.rows), *(pa.array(figures[x]) for x in [*names, "score"])],
                    ["doc_id", *names, "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = docs.select("doc_id", "text").mapInArrow(score, f"doc_id {kind}, {', '.join(f'{x} long' for x in names)}, score double")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
