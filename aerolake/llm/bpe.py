"""Byte-level BPE: encoding by ranked merges and decoding by concatenation.

Pre-tokens come from the JVM's regular expressions; a text with characters that the JVM's Unicode tables
don't know yet is split in its task by the same pattern instead.  The distinct pre-tokens of the whole corpus are
counted in Spark, and the most frequent ones (``max_words`` at most, of at most ``FOLD_BYTES`` bytes) are encoded once by
Spark higher-order functions: a fold over the array of byte pieces that joins the best-ranked neighbours,
looking ranks up in a literal map (split by crc32 into small maps, as Spark searches a map from front to end).  Tasks
then map every pre-token of every text through that table; the remaining rare or long pre-tokens are folded by
the same ranks where they occur: all rare words of some texts at once, a merge of each at a time, and long ones with a heap, so
that a word of a million letters is no trouble.

Defined results: null text counts as empty and has no ids; repeated rows are encoded one by one; null ids
are kept; ids outside the vocabulary fail in ``decode``; an empty table gives no rows; other
columns, whatever their names, are ignored.
"""

from __future__ import annotations

import base64
import gc
import heapq
import json
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import mix, spare_driver, tidy, written

MAX_WORDS = 1 << 17
RANK_MAPS = 1 << 13
CACHE_WORDS = 1 << 16
#: The fold by higher-order functions takes a step per byte and looks at all pairs in each.
FOLD_BYTES = 32
NO_RANK = 2 ** 31 - 1


def load_ranks(path: str) -> dict[bytes, int]:
    """Piece -> rank of a file with a base64 piece and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in (x.split() for x in lines if x.strip())}


def pre_tokens(docs: DataFrame, pattern: str) -> DataFrame:
    """``docs`` with column ``words``: all matches of the pattern, with Unicode meaning of its classes; null where ``newer`` has the text,
    as it holds characters that the JVM takes for unassigned."""
    known = docs.withColumn("newer", F.when(F.regexp_like(F.col("text"), F.lit(r"\p{Cn}")), F.col("text")))
    found = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit("(?U)" + pattern), F.lit(0))
    return known.withColumn("words", F.when(F.col("newer").isNull(), found))


def rank_literal(ranks: dict[bytes, int]) -> Column:
    """A foldable array of RANK_MAPS maps from a piece in hexadecimal to its rank; a piece lies in map crc32 % RANK_MAPS."""
    maps: list[dict] = [{} for _ in range(RANK_MAPS)]
    for piece, rank in ranks.items():
        maps[zlib.crc32(piece) % RANK_MAPS][piece.hex().upper()] = rank
    return F.from_json(F.lit(json.dumps(maps)), "array<map<string,int>>")


def bind(value: Column, body) -> Column:
    """body(value), evaluating ``value`` once; a literal stands once in the plan."""
    return F.element_at(F.transform(F.array(value), body), 1)


def fold_merges(word: Column, ranks: Column) -> Column:
    """Array of ids of one pre-token, by higher-order functions only."""
    data = word.cast("binary")

    def fold(maps: Column) -> Column:
        def rank(piece: Column) -> Column:
            return F.coalesce(F.element_at(F.element_at(maps, (F.crc32(piece) % RANK_MAPS + 1).cast("int")), F.hex(piece)), F.lit(NO_RANK))

        def merge(parts: Column, found: Column) -> Column:
            best = F.array_min(found)
            at = F.array_position(found, best).cast("int")
            joined = F.concat(F.element_at(parts, at), F.element_at(parts, at + 1))
            rest = F.slice(parts, at + 2, F.greatest(F.size(parts) - at - 1, F.lit(0)))
            return F.when(best == NO_RANK, parts).otherwise(F.concat(F.slice(parts, F.lit(1), at - 1), F.array(joined), rest))

        def step(parts: Column, _) -> Column:
            pairs = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda i: rank(F.concat(F.element_at(parts, i), F.element_at(parts, i + 1))))
            return F.when(F.size(parts) < 2, parts).otherwise(bind(pairs, lambda found: merge(parts, found)))

        length = F.octet_length(data)
        single = F.transform(F.sequence(F.lit(1), length), lambda i: F.substring(data, i, F.lit(1)))
        folded = F.aggregate(F.sequence(F.lit(1), length), single, step)
        return bind(rank(data), lambda whole: F.when(whole != NO_RANK, F.array(whole)).otherwise(F.transform(folded, rank)))

    return bind(ranks, fold)


def fold_rare(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token, best-ranked and then leftmost neighbours first; a heap keeps long ones affordable."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    parts = [piece[i:i + 1] for i in range(len(piece))]
    after = list(range(1, len(parts))) + [-1]
    before = list(range(-1, len(parts) - 1))
    heap = [(r, i, 2) for i in range(len(parts) - 1) if (r := ranks.get(piece[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, size = heapq.heappop(heap)
        j = after[i] if parts[i] else -1
        if j < 0 or len(parts[i]) + len(parts[j]) != size:
            continue  # one of the two has been joined since
        parts[i], parts[j] = parts[i] + parts[j], b""
        after[i] = after[j]
        if after[i] >= 0:
            before[after[i]] = i
        for a, b in ((before[i], i), (i, after[i])):
            if a >= 0 and b >= 0 and (r := ranks.get(both := parts[a] + parts[b])) is not None:
                heapq.heappush(heap, (r, a, len(both)))
    return [ranks[p] for p in parts if p]


@dataclass
class Merges:
    """Merges as an open-addressed table from two neighbours' ids to the id of their join, which is its rank.

    ``first`` has the id of each single byte; bytes that the vocabulary lacks have ids from ``known`` on.  ``odd`` has the
    pieces that merges don't lead to.
    """

    first: np.ndarray
    known: int
    keys: np.ndarray
    joined: np.ndarray
    odd: dict[bytes, int]

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys.astype(np.uint64)) & np.uint64(len(self.keys) - 1)).astype(np.int64)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NO_RANK where it has none or either id is negative."""
        keys = np.where((left < 0) | (right < 0), -1, left.astype(np.int64) << 32 | right)
        out = np.full(len(keys), NO_RANK, dtype=np.int32)
        asked = np.flatnonzero(keys >= 0)
        slot = self._slots(keys[asked])
        while len(asked):
            there = self.keys[slot]
            same = there == keys[asked]
            out[asked[same]] = self.joined[slot[same]]
            on = ~same & (there >= 0)
            asked, slot = asked[on], (slot[on] + 1) & (len(self.keys) - 1)
        return out


def merges_of(ranks: dict[bytes, int]) -> Merges:
    """The merges that ``ranks`` allow: every way to cut a piece into two pieces."""
    known = max(ranks.values(), default=-1) + 1
    ids = {bytes([b]): known + b for b in range(256)} | ranks
    pairs = [(ids[piece[:cut]] << 32 | ids[piece[cut:]], rank) for piece, rank in ranks.items() for cut in range(1, len(piece))
             if piece[:cut] in ids and piece[cut:] in ids]
    size = 1 << max(4, (2 * len(pairs)).bit_length())
    keys, joined = np.full(size, -1, dtype=np.int64), np.zeros(size, dtype=np.int32)
    out = Merges(np.array([ids[bytes([b])] for b in range(256)], dtype=np.int32), known, keys, joined, {})
    key, rank = (np.array(x, dtype=np.int64) for x in zip(*pairs)) if pairs else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    slot, left = out._slots(key), np.arange(len(key))
    while len(left):  # one of those that want a free slot gets it, the others go on
        free = np.flatnonzero(keys[slot[left]] < 0)
        _, one = np.unique(slot[left[free]], return_index=True)
        won = left[free[one]]
        keys[slot[won]], joined[slot[won]] = key[won], rank[won]
        left = np.setdiff1d(left, won, assume_unique=True)
        slot[left] = (slot[left] + 1) & (size - 1)
    pieces = [p for p in ranks if 1 < len(p) <= FOLD_BYTES]
    out.odd = {p: ranks[p] for p, found in zip(pieces, fold_many(pieces, out)) if len(found) != 4}
    return out


def fold_many(words: list[bytes], merges: Merges) -> list[bytes]:
    """Ids (32 bits each, as bytes) of pre-tokens of moderate length: the best-ranked and then leftmost pair of every word is joined at a time."""
    out: list[bytes] = [b""] * len(words)
    length = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(length, kind="stable")
    lo = int(np.searchsorted(length[order], 1))
    while lo < len(order):  # words of similar length, some thousands together
        hi = min(lo + (1 << 13), int(np.searchsorted(length[order], max(8, 2 * length[order[lo]]), side="right")))
        here = order[lo:hi]
        lo = hi
        n, width = length[here], int(length[here[-1]])
        column = np.arange(width)
        ids = np.full((len(here), width), -1, dtype=np.int32)
        ids[column < n[:, None]] = merges.first[np.frombuffer(b"".join([words[i] for i in here]), dtype=np.uint8)]
        rank = np.full((len(here), width), NO_RANK, dtype=np.int32)
        if width > 1:
            rank[:, :-1] = merges.look_up(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(here), width - 1)
        while len(here):
            at = rank.argmin(axis=1)
            best = rank[np.arange(len(here)), at]
            done = best == NO_RANK
            if done.any():
                for i, row, k in zip(here[done].tolist(), ids[done], (ids[done] >= 0).sum(axis=1).tolist()):
                    out[i] = row[:k].tobytes()
                here, ids, rank, at, best = (x[~done] for x in (here, ids, rank, at, best))
            row, after = np.arange(len(here)), column > at[:, None]
            for cells, none in ((ids, -1), (rank, NO_RANK)):  # what follows the pair moves up
                moved = np.full_like(cells, none)
                moved[:, :-1] = cells[:, 1:]
                np.copyto(cells, moved, where=after)
            ids[row, at] = best
            rank[row, at] = merges.look_up(best, np.where(at + 1 < width, ids[row, np.minimum(at + 1, width - 1)], -1))
            inner = np.flatnonzero(at > 0)
            rank[inner, at[inner] - 1] = merges.look_up(ids[inner, at[inner] - 1], best[inner])
    for i, word in enumerate(words):
        if word in merges.odd:
            out[i] = np.int32(merges.odd[word]).tobytes()
    return out


def fold_words(words: list[bytes], ranks: dict[bytes, int], merges: Merges) -> list[bytes]:
    """Ids of pre-tokens of any length, as bytes."""
    folded = fold_many([w for w in words if len(w) <= FOLD_BYTES], merges)
    if (np.frombuffer(b"".join(folded), dtype=np.int32) >= merges.known).any():
        raise KeyError("a byte that the vocabulary lacks")
    short = iter(folded)
    return [next(short) if len(w) <= FOLD_BYTES else np.array(fold_rare(w, ranks), dtype=np.int32).tobytes() for w in words]


def frequent_words(docs: DataFrame, pattern: str, max_words: int) -> DataFrame:
    """The most frequent distinct pre-tokens of the corpus, at most ``max_words``, of at most FOLD_BYTES bytes.

    A histogram of counts (eight classes an octave) gives the count from which all words fit; no task sorts them.
    """
    words = pre_tokens(docs.select("text"), pattern).select(F.explode("words").alias("word")).filter(F.octet_length("word") <= FOLD_BYTES)
    counts = written(words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).withColumn("class", F.floor(8 * F.log2("n")).cast("int")))
    total, cut = 0, None
    for r in counts.groupBy("class").agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("class")).collect():  # some 500 rows at most
        total += r.words
        if total > max_words:
            break
        cut = r["class"]
    return counts.filter(F.lit(cut is not None) & (F.col("class") >= (cut or 0))).select("word")


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, max_words: int = MAX_WORDS) -> DataFrame:
    """doc_id and ids (array of int) of every row."""
    words, run = encoding(docs, ranks, pattern, max_words)
    return words.mapInArrow(tidy(run), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def encode_and_decode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, max_words: int = MAX_WORDS) -> DataFrame:
    """``decode(encode(docs))`` with both in one Python worker a task: ids needn't leave it to be decoded, and an executor holds half the workers."""
    words, run = encoding(docs, ranks, pattern, max_words)
    back = decoding(ranks)
    return words.mapInArrow(tidy(lambda batches: back(run(batches))), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>, bytes binary")


def encoding(docs: DataFrame, ranks: dict[bytes, int], pattern: str, max_words: int):
    """The pre-tokens of every row, and the function for mapInArrow that makes them ids."""
    spread = frequent_words(docs, pattern, max_words).repartition(docs.sparkSession.sparkContext.defaultParallelism)
    known = spread.select("word", fold_merges(F.col("word"), rank_literal(ranks)).alias("ids")).toArrow()  # max_words rows at most
    spare_driver(docs.sparkSession)  # of the plan with the literal
    merges = merges_of(ranks)

    def run(batches):
        gc.disable()  # the words' ids hold no cycles
        try:
            yield from encoded(batches)
        finally:
            gc.enable()

    def encoded(batches):
        # ids of a word are kept as bytes, a fifth of a list's memory
        ids = known.column("ids").combine_chunks()
        border, flat = ids.offsets.to_numpy().tolist(), ids.values.to_numpy()
        table = {w: flat[x:y].tobytes() for w, x, y in zip(known.column("word").to_pylist(), border, border[1:])}
        rare: dict[str, bytes] = {}
        for batch in batches:
            row = 0
            lists = batch.column(1)
            if lists.null_count:
                split = [regex.findall(pattern, batch.column(2)[i].as_py()) if not lists[i].is_valid else lists[i].as_py() for i in range(len(lists))]
                lists = pa.array(split, pa.list_(pa.string()))
            first = lists.offsets.to_numpy()
            while row < len(lists):  # a quarter of a million pre-tokens at a time
                stop = max(row + 1, int(np.searchsorted(first, first[row] + (1 << 18), side="right")) - 1)
                coded = pc.dictionary_encode(lists.values[int(first[row]):int(first[stop])]) if first[stop] > first[row] else None
                words = coded.dictionary.to_pylist() if coded is not None else []
                ids = [table.get(w) or rare.get(w) for w in words]
                new = [i for i, found in enumerate(ids) if found is None]
                if len(rare) + len(new) > CACHE_WORDS:
                    rare.clear()
                for i, found in zip(new, fold_words([words[i].encode("utf-8", "surrogatepass") for i in new], ranks, merges)):
                    ids[i] = found
                    if len(rare) < CACHE_WORDS:
                        rare[words[i]] = found
                size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
                flat = np.frombuffer(b"".join(ids), dtype=np.int32)
                which = coded.indices.to_numpy() if coded is not None else np.zeros(0, np.int64)
                ahead = np.cumsum(size) - size
                each = size[which]
                total = np.concatenate([[0], np.cumsum(each)])
                out = flat[np.repeat(ahead[which] - total[:-1], each) + np.arange(total[-1])]
                cuts = total[first[row:stop + 1] - first[row]]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, stop - row), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(out))], ["doc_id", "ids"])
                row = stop

    return pre_tokens(docs.select("doc_id", "text"), pattern).select("doc_id", "words", "newer"), run


def decode(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """The encoded rows with column ``bytes``: the binary pieces of their ids, concatenated."""
    return encoded.mapInArrow(tidy(decoding(ranks)), f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, ids array<int>, bytes binary")


def decoding(ranks: dict[bytes, int]):
    """The function for mapInArrow that adds the pieces of ids."""
    by_rank = {rank: piece for piece, rank in ranks.items()}
    pieces = pa.array([by_rank.get(i) for i in range(max(by_rank, default=-1) + 1)], pa.large_binary())

    def run(batches):
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("ids"))
            flat = pieces.take(lists.flatten())
            if flat.null_count:
                raise ValueError("ids outside the vocabulary")
            _, where, data = flat.buffers()
            ends = np.frombuffer(where, np.int64)[flat.offset:flat.offset + len(flat) + 1] if len(flat) else np.zeros(1, np.int64)
            rows = ends[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
            whole = pa.Array.from_buffers(pa.large_binary(), len(lists), [None, pa.py_buffer(rows), data if data is not None else pa.py_buffer(b"")])
            yield pa.RecordBatch.from_arrays([*batch.columns, whole.cast(pa.binary())], [*batch.schema.names, "bytes"])

    return run


def digest(decoded: DataFrame, *also: str) -> DataFrame:
    """The checked columns: number of ids, hash of the decimal ids and hash of the decoded bytes; then those of ``also``."""
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"), *also)
