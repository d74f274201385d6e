"""Benchmark decontamination: pigeonhole edit matching of test items inside whole documents.

An item of m characters may differ by k = floor(rate * m) edits.  Cut into k + 1 pieces, at least one
piece stands unchanged in any such passage, so exact piece hits (one Aho-Corasick pass over a document)
find every candidate place; Myers' bit-parallel distance over the place decides.

Texts are compared in lower case with ASCII punctuation and blanks as single spaces; ends are offsets in
that form.  Items are the stated query set: they are worked through in blocks of about ``BLOCK_CHARS``
characters, each block against all documents, so that no task holds more than one block.

Defined results: null, empty or blank items match nothing; items with equal text count as the one with the smallest
id; null or empty documents match nothing; repeated rows are matched one by one; null doc_ids are returned;
an empty table on either side gives no rows; other columns are ignored by ``find`` and kept by ``drop``.
"""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import tidy, written

RATE = 0.06
BLOCK_CHARS = 1 << 20

_TO_BLANK = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def normalise(text: str | None) -> str:
    raw = (text or "").lower().encode("utf-8", "surrogatepass").translate(_TO_BLANK)
    return b" ".join(raw.split()).decode("utf-8", "surrogatepass")


def masks_of(pattern: str) -> dict[str, int]:
    """For each character the bits of its places in the pattern."""
    out: dict[str, int] = {}
    for i, c in enumerate(pattern):
        out[c] = out.get(c, 0) | 1 << i
    return out


def best_end(masks: dict[str, int], m: int, text: str, start: int, stop: int) -> tuple[int, int]:
    """(least edit distance of the pattern to any substring of text[start:stop], first end of such a one)."""
    full, high = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, end = m, start
    for i in range(start, stop):
        eq = masks.get(text[i], 0)
        vertical = eq | minus
        horizontal = (((eq & plus) + plus) ^ plus) | eq
        up = minus | (full & ~(horizontal | plus))
        down = plus & horizontal
        if up & high:
            score += 1
        elif down & high:
            score -= 1
            if score < best:
                best, end = score, i + 1
        up, down = up << 1 & full, down << 1 & full
        plus, minus = down | (full & ~(vertical | up)), up & vertical
    return best, end


class Matcher:
    """Pieces of one block of items; the automaton is built on first use, inside the task."""

    def __init__(self, items: list[tuple[int, str]], rate: float = RATE, alone: bool = True):
        self.alone = alone
        self.items = [(i, t, int(rate * len(t))) for i, t in items if t]
        self.automaton = None

    def build(self):
        import ahocorasick

        places: dict[str, list[tuple[int, int]]] = {}
        for at, (_, text, k) in enumerate(self.items):
            cuts = [j * len(text) // (k + 1) for j in range(k + 2)]
            for a, b in zip(cuts, cuts[1:]):
                places.setdefault(text[a:b], []).append((at, a))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()
        self.masks: dict[int, dict[str, int]] = {}

    def hits(self, text: str) -> dict[int, tuple[int, int]]:
        """item place -> (distance, end) of its best passage; ``text`` is normalised."""
        if self.automaton is None:
            self.build()
        found: dict[int, tuple[int, int]] = {}
        seen: dict[int, dict[int, int]] = {}  # of each item the places looked at, one at most in each stretch of k + 1
        if not self.items or not text:
            return found
        for last, (size, where) in self.automaton.iter(text):
            for at, offset in where:
                _, item, k = self.items[at]
                begin = last + 1 - size - offset
                if found.get(at, (1,))[0] == 0:
                    continue
                places, stretch = seen.setdefault(at, {}), begin // (k + 1)
                if any(abs(begin - places.get(x, begin + k + 1)) <= k for x in (stretch - 1, stretch, stretch + 1)):
                    continue  # this place was covered, with k characters to spare on either side
                if text.startswith(item, max(begin, 0)) and begin >= 0:
                    found[at] = (0, begin + len(item))
                    continue
                places[stretch] = begin
                masks = self.masks.get(at)
                if masks is None:
                    masks = self.masks[at] = masks_of(item)
                distance, end = best_end(masks, len(item), text, max(0, begin - 2 * k), min(len(text), begin + len(item) + 2 * k))
                if distance <= k and (at not in found or (distance, end) < found[at]):
                    found[at] = (distance, end)
        return found


def blocks(benchmark: DataFrame, rate: float = RATE, block_chars: int = BLOCK_CHARS):
    """Matchers over the distinct items, one block after the other; a block is bounded, not their number."""
    items = benchmark.filter("text IS NOT NULL AND item_id IS NOT NULL").groupBy("text").agg(F.min("item_id").alias("item_id"))
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = total // block_chars + 1
    for part in range(parts):
        rows = items.filter(F.pmod(F.xxhash64("text"), F.lit(parts)) == part).collect()
        yield Matcher(sorted((r.item_id, normalise(r.text)) for r in rows), rate, parts == 1)


def find(docs: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """doc_id, item_id, distance, end: the best passage of each item in each document that holds it."""
    kinds = [frame.schema[c].dataType.simpleString() for frame, c in ((docs, "doc_id"), (benchmark, "item_id"))]
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, distance int, end long"

    def search(matcher: Matcher):
        def run(batches):
            for batch in batches:
                rows, out = [], []
                for i, text in enumerate(batch.column(1)):
                    for at, (distance, end) in sorted(matcher.hits(normalise(text.as_py())).items()):
                        rows.append(i)
                        out.append((matcher.items[at][0], distance, end))
                items, distances, ends = (list(x) for x in zip(*out)) if out else ([], [], [])
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(items, pa.int64()),
                                                  pa.array(distances, pa.int32()), pa.array(ends, pa.int64())], ["doc_id", "item_id", "distance", "end"])
        return docs.select("doc_id", "text").mapInArrow(tidy(run), schema)

    first, *others = (search(m) if m.alone else written(search(m)) for m in blocks(benchmark, rate))
    return reduce(DataFrame.unionAll, others, first)


def drop(docs: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """The documents that hold no item."""
    order = docs.columns
    first = docs.select("text", *[c for c in order if c != "text"])

    def keep(matcher: Matcher):
        def run(batches):
            for batch in batches:
                yield batch.filter(pa.array([not matcher.hits(normalise(x.as_py())) for x in batch.column(0)], pa.bool_()))
        return run

    for matcher in blocks(benchmark, rate):
        if matcher.items:
            first = first.mapInArrow(tidy(keep(matcher)), first.schema)
    return first.select(*order)
