"""Substring deduplication: windows of ``WINDOW`` words that also start in a document with a smaller id are removed.

Every window of every text gets a Rabin-Karp hash.  To count them without shuffling each one, a task groups
consecutive windows that share a minimiser (the least hash of the ``GRAM``-word pieces inside the window) into a
run; equal windows have equal minimisers, so a run whose minimiser no other document has cannot
hold a repeated window.  Spark counts runs as wholes first: equal runs are equal window for window, and
all but the smallest document's are repeated entirely.  Where a minimiser has several different runs, the
hashes of the single windows are counted too, of one run of each kind.  Repeated windows merge into
maximal removal intervals of each text.

Rows are told apart by (doc_id, hash of the text), so one text may stand under an id several times.
Defined results: null text counts as empty; texts below one window lose nothing; copies under one doc_id lose nothing
to each other; a null doc_id is smaller than none and larger than none: such rows are kept whole and remove nothing
elsewhere; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sketch import part, present
from .text import Chunk, checkpointed, chunks, inside_row, signed, split_words, tidy, window_hashes, word_hashes, written

WINDOW = 50
GRAM = 8
REMOVAL = "array<struct<first:int,after:int>>"


def runs_of(chunk: Chunk, window: int = WINDOW, gram: int = GRAM) -> dict[str, np.ndarray]:
    """Runs of windows with one minimiser: row, minimiser, hash of the run's words, first and last window (word numbers in the row)."""
    words = split_words(chunk)
    hashes = word_hashes(chunk.data, words.start, words.end)
    valid = inside_row(words, window)
    n = len(valid)
    if not valid.any():
        none = np.zeros(0, dtype=np.int64)
        return {"row": none, "minimiser": none, "run": none, "first": none, "last": none}
    grams = window_hashes(hashes, gram)
    span = window - gram + 1
    least, where = grams[:n].copy(), np.zeros(n, dtype=np.int64)  # leftmost least gram of each window
    for k in range(1, span):
        less = grams[k:k + n] < least
        least[less], where[less] = grams[k:k + n][less], k
    place = where + np.arange(n)
    begins = valid.copy()
    begins[1:] &= ~valid[:-1] | (place[1:] != place[:-1]) | (words.row[1:n] != words.row[:n - 1])
    stops = valid.copy()
    stops[:-1] &= ~valid[1:] | begins[1:]
    first, last = np.flatnonzero(begins), np.flatnonzero(stops)
    single = window_hashes(hashes, window)
    # a run's words are those of its windows: hash the sequence of window hashes, by position
    length = last - first + 1
    ahead = np.cumsum(length) - length
    inner = np.arange(int(length.sum())) - np.repeat(ahead, length)
    powers = np.cumprod(np.full(int(length.max()), 0xD1342543DE82EF95, dtype=np.uint64))
    run = np.add.reduceat(single[np.repeat(first, length) + inner] * powers[inner], ahead) + length.astype(np.uint64)
    row = words.row[first]
    base = words.first[row]
    return {"row": row, "minimiser": signed(least[first]), "run": signed(run), "first": first - base, "last": last - base}


def fresh(batch: pa.RecordBatch, seen: set[tuple]) -> list[bool]:
    """Which rows are the first of their (doc_id, copy), the first two columns, that this task meets."""
    out = []
    for key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
        out.append(key not in seen)
        seen.add(key)
    return out


def run_table(docs: DataFrame, window: int) -> DataFrame:
    """doc_id, copy (hash of the text), minimiser, run, first, last for every run of every text; a task names a repeated row's once."""

    def run(batches):
        seen: set[tuple] = set()
        for batch in batches:
            batch = batch.filter(pa.array(fresh(batch, seen), pa.bool_()))
            for chunk in chunks(batch.column(2)):
                found = runs_of(chunk, window)
                at = pa.array(found["row"] + chunk.first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), pa.array(found["minimiser"]), pa.array(found["run"]),
                     pa.array(found["first"], pa.int32()), pa.array(found["last"], pa.int32())], ["doc_id", "copy", "minimiser", "run", "first", "last"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "copy", "text").mapInArrow(tidy(run), f"doc_id {kind}, copy long, minimiser long, run long, first int, last int")


def single_windows(docs: DataFrame, window: int) -> DataFrame:
    """window hash, doc_id, copy, at for the windows in each row's ``spans`` (array of first, last), once for repeated rows of a task."""

    def run(batches):
        seen: set[tuple] = set()
        for batch in batches:
            batch = batch.filter(pa.array(fresh(batch, seen), pa.bool_()))
            spans = batch.column(3)
            for chunk in chunks(batch.column(2)):
                words = split_words(chunk)
                hashes = window_hashes(word_hashes(chunk.data, words.start, words.end), window)
                row, at = [], []
                for i in range(chunk.rows):
                    for s in spans[chunk.first + i].as_py():
                        at.append(np.arange(s["first"], s["last"] + 1))
                        row.append(np.full(len(at[-1]), i))
                row, at = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (row, at))
                take = pa.array(row + chunk.first)
                yield pa.RecordBatch.from_arrays([pa.array(signed(hashes[words.first[row] + at])), batch.column(0).take(take), batch.column(1).take(take),
                                                  pa.array(at, pa.int32())], ["hash", "doc_id", "copy", "at"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "copy", "text", "spans").mapInArrow(tidy(run), f"hash long, doc_id {kind}, copy long, at int")


def per_row(spans: DataFrame) -> DataFrame:
    """All (first, last) of a text as one array: no longer than the text."""
    return spans.groupBy("doc_id", "copy").agg(F.collect_set(F.struct("first", "last")).alias("spans"))


def repeated(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, copy, first, last: spans of window starts whose windows also start in a document with a smaller id.

    ``docs`` has doc_id, copy and text; rows without doc_id take no part.
    """
    runs = written(run_table(docs.filter("doc_id IS NOT NULL"), window))
    kinds = runs.groupBy("minimiser", "run").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last_owner"))
    several = kinds.groupBy("minimiser").agg(F.count("*").alias("kinds"), F.min("owner").alias("low"), F.max("last_owner").alias("high")).filter("low < high")
    # one row per kind of run that matters: it stands in two documents, or its minimiser has other runs elsewhere
    shared = checkpointed(kinds.join(several, "minimiser").select("minimiser", "run", "owner", "last_owner", (F.col("kinds") > 1).alias("mixed")))
    found = checkpointed(runs.join(shared, ["minimiser", "run"]).filter("doc_id > owner OR mixed")
                         .select("doc_id", "copy", "first", "last", (F.col("doc_id") > F.col("owner")).alias("whole")))
    open_runs = per_row(found.filter("NOT whole"))
    some = part(docs, "copy", present(found.filter("NOT whole").select("copy").distinct()), True)  # other texts needn't be shuffled
    windows = checkpointed(single_windows(some.join(open_runs, ["doc_id", "copy"]), window))
    first_owner = checkpointed(windows.groupBy("hash").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last_owner")).filter("owner < last_owner").select("hash", "owner"))
    single = windows.join(first_owner, "hash").filter("doc_id > owner").select("doc_id", "copy", F.col("at").alias("first"), F.col("at").alias("last"))
    return found.filter("whole").select("doc_id", "copy", "first", "last").unionAll(single)


def intervals(spans: DataFrame, window: int) -> DataFrame:
    """doc_id, copy, removal: the spans of each text (as of ``per_row``) merged into maximal intervals of words, (first word, word after the last)."""

    def run(batches):
        for batch in batches:
            lists, found = batch.column(2), batch.column(2).flatten()
            row = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
            first, after = (found.field(k).to_numpy().astype(np.int64) + more for k, more in ((0, 0), (1, window)))
            order = np.lexsort((first, row))
            row, first, after = row[order], first[order], after[order]
            reach = np.maximum.accumulate(after + (row << 40)) - (row << 40)  # of the row's spans so far
            new = np.ones(len(row), dtype=bool)
            new[1:] = (row[1:] != row[:-1]) | (first[1:] > reach[:-1])
            last = np.append(np.flatnonzero(new)[1:], len(row)) - 1 if len(row) else np.zeros(0, np.int64)
            merged = pa.StructArray.from_arrays([pa.array(first[new], pa.int32()), pa.array(reach[last], pa.int32())], ["first", "after"])
            border = np.searchsorted(row[new], np.arange(batch.num_rows + 1))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.ListArray.from_arrays(pa.array(border, pa.int32()), merged)], ["doc_id", "copy", "removal"])

    kind = spans.schema["doc_id"].dataType.simpleString()
    return spans.select("doc_id", "copy", "spans").mapInArrow(tidy(run), f"doc_id {kind}, copy long, removal {REMOVAL}")


def remove(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, text and removal: the maximal removed intervals of words, as (first word, word after the last)."""
    rows = docs.select("doc_id", "text").withColumn("copy", F.xxhash64("text"))
    gone = checkpointed(intervals(per_row(repeated(rows, window)), window))
    touched = present(gone.select("copy").distinct())
    nothing = F.array().cast(REMOVAL)
    some = part(rows, "copy", touched, True).join(gone, ["doc_id", "copy"], "left").select("doc_id", "text", F.coalesce("removal", nothing).alias("removal"))
    return some.unionAll(part(rows, "copy", touched, False).select("doc_id", "text", nothing.alias("removal")))


def digest(removed: DataFrame) -> DataFrame:
    """The checked columns: word counts and the hash of the kept words."""

    def run(batches):
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            for text, removal in zip(batch.column(1), batch.column(2)):
                words = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
                left, at = [], 0
                for r in removal.as_py():
                    left += words[at:r["first"]]
                    at = r["after"]
                left += words[at:]
                n_words.append(len(words))
                n_removed.append(len(words) - len(left))
                kept.append(hashlib.sha256(b" ".join(left)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words), pa.array(n_removed), pa.array(kept)], ["doc_id", "n_words", "n_removed", "kept_sha256"])

    return removed.mapInArrow(tidy(run), f"doc_id {removed.schema['doc_id'].dataType.simpleString()}, n_words long, n_removed long, kept_sha256 string")
