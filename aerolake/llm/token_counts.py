"""Unigram token counts by dynamic programming along a trie of pre-tokens.

Pre-tokens are the blank-parted words of a text with a leading word mark.  A task gathers the distinct
pre-tokens of a chunk and walks them as a trie (their sorted order is the depth-first walk): the
forward score and token count of a prefix stand on a stack and are worked out once for all words
below it; what stands at a word's last node is its count.  Texts then add up the counts of their words.

Pieces come from a public vocabulary file; its pieces are ranked, not weighted, so their log probability
is set by rank (Zipf's law).  A character without a piece costs its UTF-8 bytes' pieces.  Equal
scores go to fewer tokens.  A task remembers at most ``CACHE_WORDS`` words; that bounds memory, not the result.

Defined results: null text counts as empty and has 0 tokens; repeated rows are counted one by one; null
ids are kept; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .text import chunks, split_words, word_hashes

MARK = "▁"
CACHE_WORDS = 1 << 18
CHUNK = 1 << 21


def load_pieces(path: str) -> tuple[dict[str, float], float]:
    """Log probability of each ordinary piece by its rank in the file, and that of a byte piece (below all others)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
    weight = math.log(sum(1.0 / (r + 1) for r in range(len(pieces) + 256)))
    return {p: -math.log(r + 1) - weight for r, p in enumerate(pieces)}, -math.log(len(pieces) + 256) - weight


def endings(pieces: dict[str, float]) -> dict[str, list[int]]:
    """Lengths of the pieces that end in each character, so that a node looks up no more than these."""
    out: dict[str, set[int]] = {}
    for p in pieces:
        out.setdefault(p[-1], set()).add(len(p))
    return {c: sorted(sizes) for c, sizes in out.items()}


def walk(words: list[str], pieces: dict[str, float], byte_score: float, ends: dict[str, list[int]]) -> list[int]:
    """Token count of each of the sorted ``words``; scores of a shared prefix are worked out once."""
    score, count, out, last = [0.0], [0], [], ""
    for word in words:
        keep = 0
        for a, b in zip(last, word):
            if a != b:
                break
            keep += 1
        del score[keep + 1:], count[keep + 1:]
        for j in range(keep + 1, len(word) + 1):
            c = word[j - 1]
            sizes = ends.get(c, ())
            best, least = -math.inf, 0
            if not sizes or sizes[0] != 1:
                n = len(c.encode("utf-8", "surrogatepass"))
                best, least = score[j - 1] + n * byte_score, count[j - 1] + n
            for size in sizes:
                if size > j:
                    break
                p = pieces.get(word[j - size:j])
                if p is not None:
                    total, n = score[j - size] + p, count[j - size] + 1
                    if total > best or total == best and n < least:
                        best, least = total, n
            score.append(best)
            count.append(least)
        out.append(count[-1])
        last = word
    return out


def count_tokens(docs: DataFrame, pieces: dict[str, float], byte_score: float) -> DataFrame:
    """doc_id, n_words and n_tokens of every row."""
    ends = endings(pieces)

    def run(batches):
        known: dict[bytes, int] = {}
        for batch in batches:
            for chunk in chunks(batch.column(1), CHUNK):
                words = split_words(chunk)
                hashes = word_hashes(chunk.data, words.start, words.end)
                _, where, which = np.unique(hashes, return_index=True, return_inverse=True)
                data = chunk.data.tobytes()
                distinct = [data[s:e] for s, e in zip(words.start[where].tolist(), words.end[where].tolist())]
                if len(known) + len(distinct) > CACHE_WORDS:
                    known.clear()
                fresh = sorted((MARK + w.decode("utf-8", "surrogatepass"), w) for w in distinct if w not in known)
                for (_, w), n in zip(fresh, walk([m for m, _ in fresh], pieces, byte_score, ends)):
                    known[w] = n
                each = np.array([known[w] for w in distinct], dtype=np.int64)[which] if distinct else np.zeros(0, np.int64)
                total = np.concatenate([[0], np.cumsum(each)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(chunk.first, chunk.rows), pa.array(words.counts.astype(np.int64)),
                     pa.array(total[words.first[1:]] - total[words.first[:-1]])], ["doc_id", "n_words", "n_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_words long, n_tokens long")
