"""Cross-tokenizer alignment: token groups between common byte ends, and links of overlapping tokens.

Two tokenizers cut the same bytes (a blank and the text).  A dictionary from each token end to its index is made on both
sides; the ends in both dictionaries, sorted, slice both id lists into groups, and the overlapping pairs of each slice are its links.

A text is taken in units: it is cut before a blank that follows a visible character, where both tokenizers end a token
whatever stands around it (the first one's pattern has no other token with a blank in it, and the second one's vocabulary no piece
with a blank after another character; a vocabulary that has such pieces gets whole texts as units).
A unit is tokenised and aligned once per task (a bounded memory of units), and a text is the sequence of its units.

How many documents hold an id pair linked is counted per block of documents, summed in Spark, and looked up again
by the blocks' dictionaries of pairs (``blocks``): no table of pairs is broadcast.  The count of a pair and
whether it is the best of its first id travel as one number.

Defined results: null and empty texts, and texts whose tokens' bytes differ from blank plus text, have no tokens: zeros and
an empty ``groups_sha256``; repeated rows are documents of their own; null ids are kept; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import gc
import hashlib
import json
import os
import re
from array import array
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import BLOCK_BYTES, Numbers, int_list, look_up, packed, unpacked
from .text import chunks, word_hashes, written

#: Units that a task remembers.
CACHE_UNITS = 1 << 19
#: Added to the count of a pair that is the best of its first id; a pair's code is its first id, shifted by 32 bits, and its second.
BEST = 1 << 62


def byte_of_letter() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: visible Latin-1 for themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Tokenizers:
    """Both tokenizers, made from the contents of their files in each worker that needs them."""

    def __init__(self, byte_level: bytes, pieces: bytes) -> None:
        self.files = byte_level, pieces
        self.ready = None

    def __getstate__(self):
        return {"files": self.files, "ready": None}

    def load(self):
        if self.ready is None:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            import sentencepiece
            import tokenizers

            first = tokenizers.Tokenizer.from_str(self.files[0].decode())
            first.encode_special_tokens = True
            second = sentencepiece.SentencePieceProcessor(model_proto=self.files[1])
            letters = byte_of_letter()
            own = {i: bytes(letters[c] for c in p) for p, i in json.loads(self.files[0])["model"]["vocab"].items()}
            own = [own.get(i, b"") for i in range(max(own, default=0) + 1)]
            names = [second.id_to_piece(i) for i in range(second.get_piece_size())]
            spelt = [bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
            self.splits = not any(re.search("[^▁]▁", p) for p in names)
            self.ready = first, second, own, spelt
        return self.ready

    def both(self, units: list[bytes]) -> list[tuple[list[int], list[int], list[int], list[int]] | None]:
        """Ids and token ends of both tokenizers for each unit, a blank and some text; None where bytes are not kept."""
        first, second, own, spelt = self.load()
        texts = [u.decode("utf-8", "replace") for u in units]
        one = first.encode_batch_fast(texts, add_special_tokens=False)
        two = second.encode([t[1:] for t in texts], num_threads=1)
        out = []
        for unit, e, b in zip(units, one, two):
            a = e.ids
            b = b or [second.piece_to_id("▁")]  # a last blank alone: the library adds none to an empty text
            x, y = [own[i] for i in a], [spelt[i] for i in b]
            if b"".join(x) != unit or b"".join(y) != unit:
                out.append(None)
                continue
            out.append((a, b, [*accumulate(map(len, x))], [*accumulate(map(len, y))]))
        return out


def align(a_ids: list[int], b_ids: list[int], a_ends: list[int], b_ends: list[int]) -> tuple[list[tuple[int, int, int, int]], list[tuple[int, int]]]:
    """Groups (slices lo:hi of both lists) between common ends, and all index pairs of tokens whose bytes overlap."""
    in_a, in_b = dict(zip(a_ends, range(1, len(a_ids) + 1))), dict(zip(b_ends, range(1, len(b_ids) + 1)))
    groups, links, lo, low = [], [], 0, 0
    for end in sorted(in_a.keys() & in_b.keys()):
        hi, high = in_a[end], in_b[end]
        groups.append((lo, hi, low, high))
        i, j = lo, low
        while i < hi and j < high:  # inside a group exactly one of the two moves on, as no other end is common
            links.append((i, j))
            x, y = a_ends[i], b_ends[j]
            i, j = i + (x <= y), j + (y <= x)
        lo, low = hi, high
    return groups, links


def spelled(a_ids: list[int], b_ids: list[int], groups: list[tuple[int, int, int, int]]) -> str:
    return ";".join([f"{a_ids[lo]}|{b_ids[low]}" if hi - lo == high - low == 1 else
                     f"{','.join(map(str, a_ids[lo:hi]))}|{','.join(map(str, b_ids[low:high]))}" for lo, hi, low, high in groups])


def unit_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of the units of a chunk: its rows' starts, and blanks after visible ASCII or letters of two bytes from U+00C0 on."""
    if not len(data):
        return np.zeros(0, dtype=np.int64)
    visible = (data > 0x20) & (data < 0x7F)
    pair = np.zeros(len(data), dtype=bool)
    pair[1:] = (data[:-1] >= 0xC3) & (data[:-1] < 0xE0) & (data[1:] >= 0x80) & (data[1:] < 0xC0)
    cut = np.zeros(len(data), dtype=bool)
    cut[1:] = (data[1:] == 0x20) & (visible | pair)[:-1]
    cut[offsets[:-1][offsets[:-1] < len(data)]] = True
    return np.flatnonzero(cut)


def aligned_blocks(docs: DataFrame, tokenizers: Tokenizers, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per block: its documents' figures, links as positions in the dictionary ``keys`` of pair codes, and the
    number of the block's documents that hold each pair."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        gc.disable()  # a unit's numbers hold no cycles, and walking through all remembered ones took a third of the time
        try:
            yield from blocks(batches)
        finally:
            gc.enable()

    def blocks(batches):
        numbers, memory = Numbers(), {}
        ids, figures, shas, rows, codes, times, size, first = [], [], [], [], [], [], 0, 0

        def close():
            nonlocal size, first
            row, code, many = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (rows, codes, times))
            keys, pos = np.unique(code, return_inverse=True)
            holders = np.bincount(pos, minlength=len(keys))
            numbers_of = np.concatenate(figures) if figures else np.zeros((0, 4), np.int64)
            per_row = np.bincount(row, minlength=first)
            out = pa.RecordBatch.from_arrays(
                [pa.array([numbers.take()]), pa.ListArray.from_arrays(pa.array([0, first], pa.int32()), pa.concat_arrays(ids)),
                 *(int_list(numbers_of[:, k]) for k in range(4)), pa.array([list(chain.from_iterable(shas))], pa.list_(pa.string())),
                 int_list(keys), int_list(holders), packed(per_row), packed(pos), packed(many)],
                ["block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "keys", "holders", "per_row", "pos", "many"])
            for x in (ids, figures, shas, rows, codes, times):
                x.clear()
            size = first = 0
            return out

        for batch in batches:
            text = pc.fill_null(batch.column(1).cast(pa.large_string()), "")
            empty = pc.equal(pc.binary_length(text), 0).to_numpy(zero_copy_only=False)
            for chunk in chunks(pc.binary_join_element_wise(pa.scalar("", pa.large_string()), text, pa.scalar(" ", pa.large_string()))):
                tokenizers.load()
                start = unit_starts(chunk.data, chunk.offsets) if tokenizers.splits else chunk.offsets[:-1].copy()
                end = np.append(start[1:], len(chunk.data))
                row = np.searchsorted(chunk.offsets, start, side="right") - 1
                hashes, one, which = np.unique(word_hashes(chunk.data, start, end), return_index=True, return_inverse=True)
                names = hashes.tolist()
                fresh = [i for i, h in enumerate(names) if h not in memory]
                if len(memory) + len(fresh) > CACHE_UNITS:
                    memory.clear()
                    fresh = list(range(len(names)))
                units = [chunk.data[start[one[i]]:end[one[i]]].tobytes() for i in fresh]
                for i, found in zip(fresh, tokenizers.both(units)):
                    if found is None:
                        memory[names[i]] = None
                        continue
                    groups, links = align(*found)
                    a, b = found[:2]
                    memory[names[i]] = (len(a), len(b), len(groups), len(links)), spelled(a, b, groups), array("q", [a[x] << 32 | b[y] for x, y in links])
                known = [memory[h] for h in names]
                kept = np.fromiter((k is not None for k in known), bool, len(known))
                good = np.ones(chunk.rows, dtype=bool)
                good[row[~kept[which]]] = False
                good &= ~empty[chunk.first:chunk.first + chunk.rows]
                of_unit = np.array([k[0] if k else (0, 0, 0, 0) for k in known], dtype=np.int64).reshape(-1, 4)
                total = np.zeros((chunk.rows, 4), dtype=np.int64)
                for k in range(4):
                    total[:, k] = np.bincount(row, weights=of_unit[which, k], minlength=chunk.rows)
                total[~good] = 0
                border, order = np.searchsorted(row, np.arange(chunk.rows + 1)).tolist(), which.tolist()
                of_name = [k[1] if k else "" for k in known].__getitem__
                shas.append([hashlib.sha256(";".join(map(of_name, order[border[i]:border[i + 1]])).encode()).hexdigest() if good[i] else ""
                             for i in range(chunk.rows)])
                # distinct units of each document, then distinct pairs of each document
                there = good[row]
                both, n_units = np.unique(row[there] * max(1, len(known)) + which[there], return_counts=True)
                doc, unit = both // max(1, len(known)), both % max(1, len(known))
                length = of_unit[:, 3]
                ahead = np.cumsum(length) - length
                flat = np.fromiter(chain.from_iterable(k[2] for k in known if k), np.int64, int(length.sum()))
                each = length[unit]
                before = np.cumsum(each) - each
                spot = np.repeat(ahead[unit] - before, each) + np.arange(int(each.sum()))
                pair, pair_of = np.unique(flat, return_inverse=True)
                key, back = np.unique(np.repeat(doc, each) * max(1, len(pair)) + pair_of[spot], return_inverse=True)
                rows.append(first + key // max(1, len(pair)))
                codes.append(pair[key % max(1, len(pair))] if len(pair) else np.zeros(0, np.int64))
                times.append(np.bincount(back, weights=np.repeat(n_units, each), minlength=len(key)).astype(np.int64))
                ids.append(batch.column(0).slice(chunk.first, chunk.rows))
                figures.append(total)
                first += chunk.rows
                size += len(chunk.data)
                if size >= block_bytes:
                    yield close()
        if first:
            yield close()

    return docs.select("doc_id", "text").mapInArrow(
        run, f"block long, doc_id array<{kind}>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, groups_sha256 array<string>, "
             "keys array<long>, holders array<long>, per_row binary, pos binary, many binary")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """key (pair code) and mark: the number of documents that hold the pair linked, plus BEST if none of its first id's is higher."""
    each = blocks.select(F.explode(F.arrays_zip("keys", "holders")).alias("x")).select(F.col("x.keys").alias("key"), F.col("x.holders").alias("n"))
    counts = written(each.groupBy("key").agg(F.sum("n").alias("n")))
    first = F.shiftright("key", 32).alias("a")
    top = counts.groupBy(first).agg(F.max("n").alias("top"))
    return counts.withColumn("a", first).join(top, "a").select("key", (F.col("n") + F.when(F.col("n") == F.col("top"), F.lit(BEST)).otherwise(F.lit(0))).alias("mark"))


def figures(docs: DataFrame, tokenizers: Tokenizers, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row."""
    kind = docs.schema["doc_id"].dataType
    blocks = written(aligned_blocks(docs, tokenizers, block_bytes))

    def settle(block: pa.Table, marks: np.ndarray) -> pa.Table:
        per_row, pos, many = (unpacked(block.column(c).combine_chunks()) for c in ("per_row", "pos", "many"))
        row = np.repeat(np.arange(len(per_row)), per_row)
        mark, n_best, count_sum = marks[pos], np.zeros(len(per_row), np.int64), np.zeros(len(per_row), np.int64)
        np.add.at(n_best, row, many * (mark >= BEST))
        np.add.at(count_sum, row, many * (mark & (BEST - 1)))
        plain = {c: block.column(c).combine_chunks().flatten() for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")}
        sha = plain.pop("groups_sha256")
        return pa.table({**plain, "n_best": n_best, "count_sum": count_sum, "groups_sha256": sha})

    return look_up(blocks, pair_counts(blocks), "mark", settle,
                   f"doc_id {kind.simpleString()}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def load(byte_level_path: str, pieces_path: str) -> Tokenizers:
    """Tokenizers of the two vocabulary files; their contents travel to the executors (some 2 MB)."""
    with open(byte_level_path, "rb") as a, open(pieces_path, "rb") as b:
        return Tokenizers(a.read(), b.read())
