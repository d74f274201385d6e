"""Language-model scoring by online logistic context mixing.

A text is its lower-cased words and one end token.  A token is coded by binary decisions alone: first the bits of its count class (the bit
length of its count in the training documents, 0 if it is unknown), then the eight bits of each of its letters (UTF-8 bytes) and of a
blank; the end token is a blank without letters.  Every decision is predicted by several hashed contexts:

* class bits: no context, the class before, the two classes before, the word before, length and last letter of the word before;
* letter bits of known tokens: class and all letters before, class and two letters before, four letters before, the word before and all letters before;
* letter bits of unknown tokens: place in the word, and the one to four letters before.

Each predictor keeps how often a context and a node of the code tree saw 0 and 1 in a table of ``SLOTS`` places (``KNOWN_SLOTS`` for letters of
known tokens).  The predictors' logits are combined by weights; a gate (place of the bit) picks the weight set.  Weights, and a map that corrects
the mixed logit by gate and height, start alike for each text and are refined along it by the gradient of the coding cost,
after every ``STEP`` tokens, those of known tokens' letters after every ``LETTER_STEP`` letters; all texts of a block advance together in numpy.

What Spark gathers: exact counts of every distinct training token (a table that grows with the corpus; it is joined to the blocks'
dictionaries, never broadcast) and the bit counts of all training documents.  For the latter a token's own occurrence is left out of its
count, so that a word seen once teaches what unknown words look like.  Tables of bit counts have a fixed size and are all that is broadcast.

Tokens are told apart by 64-bit hashes.  Defined results: null and empty texts are the end token alone; repeated rows are counted and scored
one by one; null ids are kept and count as training rows; without training rows all bits cost one bit and
``base_score`` is that of its formula; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import BLOCK_BYTES, Numbers, bucketed, int_list, packed, unpacked, with_answers
from .text import BYTE_CODES, Chunk, chunks, held_out, mix, signed, slices, split_words, tidy, word_hashes, written

PREDICTORS = 5
SLOTS = 1 << 16
STEP = 32
WEIGHT, RATE, MAP_RATE, HEIGHTS = 0.25, 0.6, 0.3, 12
LETTER_GATES = 4
#: Letters of known tokens: contexts, places of each one's table, letters of a text between refinements, letters held at once.
KNOWN, KNOWN_SLOTS, LETTER_STEP, GROUP = 4, 1 << 18, 128, 1 << 19
#: Bytes of text from which a block is closed when texts are scored: words that return in a block are hashed, looked up and joined once.
TEXT_BYTES = 14 << 20
#: Letters that are expanded at once; bounds memory for very long unknown words.
LETTERS = 1 << 17
#: Symbols of texts that advance together, at most; what is held of them fits a core's cache.
CELLS = 1 << 13
#: Letters of a block's most frequent tokens whose inputs are held for the whole block.
HEAD = 1 << 18
PARTS, KNOWN_PARTS = 2 * PREDICTORS, KNOWN * KNOWN_SLOTS // SLOTS
END = np.uint64(0x5EED)
FOLD = 1

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_SALT = mix(np.arange(1, 2 * PREDICTORS + 1, dtype=np.uint64) * _GOLD).reshape(2, PREDICTORS)
_KNOWN_SALT = mix(np.arange(101, 101 + KNOWN, dtype=np.uint64) * _GOLD)
_KNOWN_SHIFT = np.uint64(65 - KNOWN_SLOTS.bit_length())
_SPREAD = 40503


def tokens_of(chunk: Chunk):
    """Hashes of the words of a chunk with an end token after each row's, tokens per row, and the words' places (empty for ends)."""
    folded = _FOLD[chunk.data]
    words = split_words(Chunk(chunk.first, folded, chunk.offsets))
    per_row = words.counts + 1
    total = int(per_row.sum())
    ends = np.cumsum(per_row) - 1
    word = np.ones(total, dtype=bool)
    word[ends] = False
    hashes, start, end = np.full(total, END), np.zeros(total, np.int64), np.zeros(total, np.int64)
    hashes[word], start[word], end[word] = word_hashes(folded, words.start, words.end), words.start, words.end
    return folded, hashes, per_row, start, end


def distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes, and which of them each one is."""
    found = pa.array(signed(hashes)).dictionary_encode()
    return found.dictionary.to_numpy().view(np.uint64), found.indices.to_numpy()


def training_counts(docs: DataFrame) -> DataFrame:
    """key (token hash), n over the training documents; each task adds up what fits in its memory."""

    def run(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def added():
            key, back = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
            n = np.zeros(len(key), dtype=np.int64)
            np.add.at(n, back, np.concatenate([h[1] for h in held]))
            held.clear()
            return key, n

        def out(key, n):
            return pa.RecordBatch.from_arrays([pa.array(signed(key)), pa.array(n)], ["key", "n"])

        for batch in batches:
            for chunk in chunks(batch.column(0)):
                held.append(np.unique(tokens_of(chunk)[1], return_counts=True))
                if sum(len(h[0]) for h in held) > 1 << 21:
                    both = added()
                    if len(both[0]) > 1 << 20:
                        yield out(*both)
                    else:
                        held.append(both)
        if held:
            yield out(*added())

    training = docs.filter(~held_out(F.col("doc_id"), FOLD)).select("text")
    return training.mapInArrow(tidy(run), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def token_blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per block: its documents, their tokens as positions in the dictionary ``keys``, and the dictionary's spellings."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        numbers = Numbers()
        ids, train, per_row, which, spelt, size = [], [], [], [], [], 0

        def close():
            nonlocal size
            # tokens are told apart and spellings cut per chunk, so that only each chunk's distinct tokens meet here
            keys, back = distinct(np.concatenate([s[0] for s in spelt]))
            ahead = np.cumsum([0, *(len(s[0]) for s in spelt)])
            pos = np.concatenate([back[x + w] for x, w in zip(ahead, which)])
            order = np.argsort(-np.bincount(pos), kind="stable")  # frequent tokens get small numbers
            rank = np.empty_like(order)
            rank[order] = np.arange(len(order))
            keys, pos = keys[order], rank[pos]
            first = np.empty(len(order), dtype=np.int64)
            first[back] = np.arange(len(back))
            words = pa.concat_arrays([s[1] for s in spelt]).take(pa.array(first[order]))
            where = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1]
            letters = words.buffers()[2].to_pybytes()[where[0]:where[-1]] if words.buffers()[2] is not None else b""
            counts = np.concatenate(per_row)
            out = pa.RecordBatch.from_arrays(
                [pa.array([numbers.take()]), pa.ListArray.from_arrays(pa.array([0, len(counts)], pa.int32()), pa.concat_arrays(ids)),
                 pa.ListArray.from_arrays(pa.array([0, len(counts)], pa.int32()), pa.concat_arrays(train)),
                 packed(counts), packed(pos), int_list(signed(keys)), packed(np.diff(where)), pa.array([letters], pa.binary())],
                ["block", "doc_id", "train", "per_row", "pos", "keys", "lengths", "letters"])
            for x in (ids, train, per_row, which, spelt):
                x.clear()
            size = 0
            return out

        for batch in batches:
            for chunk in chunks(batch.column(2)):
                folded, key, counts, start, end = tokens_of(chunk)
                own, each = distinct(key)
                one = np.empty(len(own), dtype=np.int64)
                one[each] = np.arange(len(key))
                spelt.append((own, slices(folded, start[one], end[one], pa.binary())))
                ids.append(batch.column(0).slice(chunk.first, chunk.rows))
                train.append(batch.column(1).slice(chunk.first, chunk.rows))
                per_row.append(counts)
                which.append(each)
                size += len(folded) + chunk.rows
                if size >= block_bytes:
                    yield close()
        if which:
            yield close()

    rows = docs.select("doc_id", (~held_out(F.col("doc_id"), FOLD)).alias("train"), "text")
    return rows.mapInArrow(tidy(run), f"block long, doc_id array<{kind}>, train array<boolean>, per_row binary, pos binary, keys array<long>, lengths binary, letters binary")


def classes_of(count: np.ndarray) -> np.ndarray:
    """Bit length of each count."""
    return np.where(count > 0, np.frexp(np.maximum(count, 1).astype(np.float64))[1], 0).astype(np.int64)


class Block:
    """A block's tokens as numpy arrays."""

    def __init__(self, columns: dict[str, pa.Array]) -> None:
        self.per_row, self.pos, self.lengths = (unpacked(columns[c]) for c in ("per_row", "pos", "lengths"))
        self.keys = columns["keys"].flatten().to_numpy()
        self.known = np.zeros(len(self.keys), dtype=np.int64)
        found = columns["known"].flatten().to_numpy()
        self.known[:len(found)] = found
        self.letters = np.frombuffer(columns["letters"][0].as_buffer(), dtype=np.uint8)
        self.at = np.cumsum(self.lengths) - self.lengths
        self.first = np.cumsum(self.per_row) - self.per_row
        self.begins = np.zeros(len(self.pos), dtype=bool)
        self.begins[self.first] = True
        self.last = np.zeros(len(self.lengths), dtype=np.int64)
        full = self.lengths > 0
        self.last[full] = self.letters[self.at[full] + self.lengths[full] - 1]

    def before(self, values: np.ndarray, start: int) -> np.ndarray:
        out = np.empty_like(values)
        out[1:] = values[:-1]
        out[self.first] = start
        return out

    def places(self, symbol: np.ndarray) -> np.ndarray:
        """(token, predictor): where the table places of the token's class bits begin, given the tokens' classes."""
        def before(k: int, contexts: np.ndarray, which: np.ndarray, start: int) -> np.ndarray:
            at = places_of(np.append(contexts, start), k)  # hashed once a context, not once a token
            return self.before(at[which], at[-1])

        two = symbol << 8 | self.before(symbol, 255)
        shape = np.minimum(self.lengths, 15) * 256 + self.last
        return np.stack([np.full(len(symbol), places_of(np.zeros(1, np.int64), 0)[0]), before(1, np.arange(256), symbol, 255), before(2, np.arange(1 << 16), two, 255 << 8 | 255),
                         before(3, self.keys, self.pos, 0), before(4, shape, self.pos, 1 << 14)]).T

    def spelled(self, tokens: np.ndarray):
        """Pieces of (index into ``tokens``, letter with a blank at the end, place in the word, predictor places) of these dictionary positions."""
        size = self.lengths[tokens] + 1
        lo = 0
        while lo < len(tokens):
            hi = max(lo + 1, int(np.searchsorted(np.cumsum(size[lo:]), LETTERS, side="right")) + lo)
            each = size[lo:hi]
            ahead = np.cumsum(each) - each
            place = np.arange(int(each.sum())) - np.repeat(ahead, each)
            who = np.repeat(np.arange(lo, hi), each)
            blank = place == self.lengths[tokens[who]]
            letter = np.full(len(place), 0x20, dtype=np.int64)
            letter[~blank] = self.letters[self.at[tokens[who[~blank]]] + place[~blank]]
            contexts, history = [np.minimum(place, 7)], np.zeros(len(place), dtype=np.int64)
            for back in range(1, PREDICTORS):
                earlier = np.zeros(len(place), dtype=np.int64)
                earlier[back:] = letter[:-back] if back < len(letter) else 0
                history = history * 256 + np.where(place >= back, earlier, 0)
                contexts.append(history)
            for x in range(0, len(place), LETTERS):
                y = slice(x, x + LETTERS)
                yield who[y], letter[y], place[y], np.stack(
                    [(mix(c[y].view(np.uint64) + s) >> np.uint64(48)).astype(np.int32) for c, s in zip(contexts, _SALT[1])], axis=1)
            lo = hi

    def spelling(self, classes: np.ndarray) -> Spelling:
        """Letters of the whole dictionary, given the class of each of its tokens; contexts inside a word are hashed here, once a distinct token."""
        size = self.lengths + 1
        start = np.concatenate([[0], np.cumsum(size)])
        letters, prefix = np.empty(start[-1], dtype=np.uint8), np.empty(start[-1], dtype=np.uint64)
        inside = np.empty((KNOWN - 1, start[-1]), dtype=np.int32)
        for lo, hi in pieces(size, LETTERS):
            length, each, first = self.lengths[lo:hi], size[lo:hi], start[lo:hi] - start[lo]
            place = np.arange(int(each.sum())) - np.repeat(first, each)
            letter = np.full(len(place), 0x20, dtype=np.uint8)
            letter[place < np.repeat(length, each)] = self.letters[self.at[lo]:self.at[hi - 1] + length[-1]]
            terms = BYTE_CODES[letter] * np.cumprod(np.full(int(each.max()), _GOLD, dtype=np.uint64))[place]
            before = np.cumsum(terms) - terms
            before -= np.repeat(before[first], each)
            history = np.zeros(len(place), dtype=np.uint64)
            contexts = [before + np.repeat(mix(classes[lo:hi].astype(np.uint64) + _GOLD), each)]
            for back in range(1, 5):
                earlier = np.zeros(len(place), dtype=np.uint64)
                earlier[back:] = letter[:-back] if back < len(letter) else 0
                history = history * np.uint64(256) + np.where(place >= back, earlier, 0)
                if back == 2:
                    contexts.append(history * np.uint64(64) + np.repeat(classes[lo:hi].astype(np.uint64), each))
            contexts.append(history)
            here = slice(start[lo], start[hi])
            letters[here], prefix[here] = letter, before
            for k, c in enumerate(contexts):
                inside[k, here] = known_places(c, k)
        return Spelling(start, letters, prefix, inside)

    def letters_of(self, tokens: np.ndarray, classes: np.ndarray, spelling: Spelling | None = None, head: int = 0) -> Letters:
        """Letters of these tokens of the texts, given the class of each dictionary position; those of the first ``head`` positions come first, used or not."""
        spelling = spelling or self.spelling(classes)
        used = np.zeros(len(self.keys), dtype=bool)
        used[self.pos[tokens]] = True
        own = np.flatnonzero(used[head:]) + head
        inner, begin = spelling.letters_of(own)
        start = spelling.start[:-1].copy()
        start[own] = begin + start[head] if head < len(start) else begin
        inner = np.concatenate([np.arange(spelling.start[head]), inner])
        at, across = self.occurrences(tokens, start, spelling.prefix[inner])
        return Letters(at, spelling.letter[inner], [p[inner] for p in spelling.inside], across)

    def occurrences(self, tokens: np.ndarray, start: np.ndarray, prefix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per letter of these tokens of the texts, one after the other: its place among letters of which those of each dictionary position begin
        at ``start``, and the table place for the word before, given a hash of the letters before each of those letters."""
        pos = self.pos[tokens]
        size, start = self.lengths[pos] + 1, start[pos]
        word = mix(np.where(self.begins[tokens], 0, self.keys[self.pos[tokens - 1]]).view(np.uint64)) + _KNOWN_SALT[KNOWN - 1]
        total, done = int(size.sum()), 0
        at, across = np.empty(total, dtype=np.int64), np.empty(total, dtype=np.int32)
        for lo, hi in pieces(size, LETTERS >> 2):  # what is held of a piece fits a core's cache
            each = size[lo:hi]
            end = np.cumsum(each)
            here = slice(done, done + int(end[-1]))
            np.add(np.repeat(start[lo:hi] - end + each, each), np.arange(end[-1]), out=at[here])
            hashes = prefix.take(at[here])
            hashes += np.repeat(word[lo:hi], each)
            across[here] = mix(hashes) >> _KNOWN_SHIFT
            done = here.stop
        return at, across


@dataclass
class Spelling:
    """Letters of a dictionary's tokens, a blank after each token: those of token i are ``start[i]:start[i + 1]``.  Per letter a hash of the
    letters before it in its token, and table places for contexts inside a word."""

    start: np.ndarray
    letter: np.ndarray
    prefix: np.ndarray
    inside: np.ndarray

    def letters_of(self, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the letters of these dictionary positions, one after the other, and where each position's begin among them."""
        size = self.start[pos + 1] - self.start[pos]
        begin = np.cumsum(size) - size
        return np.repeat(self.start[pos] - begin, size) + np.arange(int(size.sum())), begin


@dataclass
class Letters:
    """Letters and blanks of the distinct tokens of a choice of tokens, and table places for contexts inside a word; per letter of the tokens
    one after the other ``at``, its place among those, and the table place for the word before."""

    at: np.ndarray
    letter: np.ndarray
    inside: list[np.ndarray]
    across: np.ndarray


def places_of(context: np.ndarray, k: int) -> np.ndarray:
    return (mix(context.astype(np.int64).view(np.uint64) + _SALT[0, k]) >> np.uint64(48)).astype(np.int32)


def known_places(context: np.ndarray, k: int) -> np.ndarray:
    return (mix(context + _KNOWN_SALT[k]) >> _KNOWN_SHIFT).astype(np.int32)


def pieces(size: np.ndarray, limit: int):
    """Ranges of consecutive items with ``limit`` in sum, or of one item."""
    total, lo = np.cumsum(size), 0
    while lo < len(size):
        hi = max(lo + 1, int(np.searchsorted(total, limit + (total[lo - 1] if lo else 0), side="right")))
        yield lo, hi
        lo = hi


def nodes(symbol: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(symbol, bit): offset of the node of a code tree before each bit, and the bit."""
    depth = np.arange(bits)
    node = (1 << depth) | (symbol[:, None] >> (bits - depth))
    return (node * _SPREAD).astype(np.int32), ((symbol[:, None] >> (bits - 1 - depth)) & 1).astype(bool)


def bit_steps(bits: int) -> np.ndarray:
    """(bit, symbol): offset of slot and bit."""
    node, bit = nodes(np.arange(1 << bits), bits)
    return (node.astype(np.int64) * 2 + bit).T.copy()


def count_bits(total: np.ndarray, steps: np.ndarray, places: np.ndarray, symbol: np.ndarray, times: np.ndarray | None = None) -> None:
    """Adds to one predictor's (slot and bit) the bits of these symbols, each one time or so many; equal symbols at equal places are added together."""
    if not len(places):
        return
    key = places << 8 | symbol
    if times is None:
        key.sort()
    else:
        times = key.astype(np.int64) << 32 | times
        times.sort()
        key = times >> 32
    heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    n = np.diff(heads, append=len(key)) if times is None else np.add.reduceat(times & 0xFFFFFFFF, heads)
    key = key[heads].astype(np.int64)
    symbol, twice, mask = key & 255, key >> 8 << 1, len(total) - 1
    for step in steps:
        np.add.at(total, (twice + step.take(symbol)) & mask, n)


def count_letters(total: np.ndarray, block: Block, tokens: np.ndarray, classes: np.ndarray) -> None:
    """Adds to (predictor, slot and bit) the letter bits of these known tokens; those inside a word are counted once a distinct token, times its occurrences."""
    steps, spelling, times = bit_steps(8), block.spelling(classes), np.bincount(block.pos[tokens], minlength=len(block.keys))
    own = np.flatnonzero(times)
    for lo, hi in pieces(block.lengths[own] + 1, GROUP):
        at, _ = spelling.letters_of(own[lo:hi])
        letter, often = spelling.letter[at], np.repeat(times[own[lo:hi]], block.lengths[own[lo:hi]] + 1)
        for k, place in enumerate(spelling.inside):
            count_bits(total[k], steps, place[at], letter, often)
    for lo, hi in pieces(block.lengths[block.pos[tokens]] + 1, GROUP):
        at, across = block.occurrences(tokens[lo:hi], spelling.start, spelling.prefix)
        count_bits(total[-1], steps, across, spelling.letter[at])


def planes(counts: np.ndarray) -> bytes:
    """64-bit counts, all their lowest bytes first, as that compresses well."""
    return np.ascontiguousarray(counts, dtype="<i8").view(np.uint8).reshape(-1, 8).T.tobytes()


def from_planes(data) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(8, -1).T).view("<i8").ravel()


def bit_counts(blocks: DataFrame, bits: int) -> np.ndarray:
    """(kind, predictor, slot, bit) of class bits and of unknown tokens' letter bits."""
    return all_counts(blocks, bits)[0]


def all_counts(blocks: DataFrame, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(kind, predictor, slot, bit) of class bits and unknown tokens' letter bits, (predictor, slot, bit) of known tokens' letter bits: how often the
    training documents saw each bit; a token's own occurrence is left out of its count."""

    class_steps, letter_steps = bit_steps(bits), bit_steps(8)

    def add_classes(total: np.ndarray, block: Block, train: np.ndarray, symbol: np.ndarray) -> None:
        places = block.places(symbol).T
        for x in range(0, len(symbol), GROUP):
            use = np.flatnonzero(train[x:x + GROUP]) + x
            for k in range(PREDICTORS):
                count_bits(total[0, k], class_steps, places[k, use], symbol[use])
        for _, letter, _, where in block.spelled(block.pos[train & (symbol == 0)]):
            for k in range(PREDICTORS):
                count_bits(total[1, k], letter_steps, where[:, k], letter)

    def add(total: np.ndarray, known: np.ndarray, row: pa.RecordBatch) -> None:
        block = Block({c: row.column(k) for k, c in enumerate(row.schema.names)})
        train = np.repeat(row.column(row.schema.get_field_index("train")).flatten().to_numpy(zero_copy_only=False), block.per_row)
        classes = classes_of(np.maximum(block.known - 1, 0))
        symbol = classes[block.pos]
        add_classes(total, block, train, symbol)
        count_letters(known, block, np.flatnonzero(train & (symbol > 0)), classes)

    def count(batches):
        total, known = np.zeros((2, PREDICTORS, 2 * SLOTS), dtype=np.int64), np.zeros((KNOWN, 2 * KNOWN_SLOTS), dtype=np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                add(total, known, batch.slice(i, 1))
        if total.any():
            rows = [*total.reshape(PARTS, -1), *known.reshape(KNOWN_PARTS, -1)]
            for x in range(0, len(rows), 8):
                some = rows[x:x + 8]
                yield pa.RecordBatch.from_arrays([pa.array(range(x, x + len(some)), pa.int32()), pa.array([planes(r) for r in some], pa.binary())], ["part", "counts"])

    def merge(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
                total[part] = total.get(part, 0) + from_planes(counts.as_buffer())
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([planes(x) for x in total.values()], pa.binary())], ["part", "counts"])

    shape, out = "part int, counts binary", np.zeros((PARTS + KNOWN_PARTS, 2 * SLOTS), dtype=np.int64)
    for part, counts in blocks.drop("doc_id").mapInArrow(tidy(count), shape).repartition("part").mapInArrow(tidy(merge), shape).collect():  # PARTS + KNOWN_PARTS rows of 1 MB
        out[part] = from_planes(counts)
    return out[:PARTS].reshape(2, PREDICTORS, SLOTS, 2), out[PARTS:].reshape(KNOWN, KNOWN_SLOTS, 2)


def logits_of(counts: np.ndarray) -> np.ndarray:
    return np.log((counts[..., 1] + 0.4) / (counts[..., 0] + 0.4)).astype(np.float32)


class Weights:
    """Weights and maps of some texts for the bits of one kind of symbol; ``code`` gives the cost of symbols and refines them by it."""

    def __init__(self, texts: int, width: int, bits: int, parts: list[int]) -> None:
        self.bits = bits
        self.own = [np.tile(np.eye(bits, dtype=np.float32), (k, 1)) for k in parts]  # an input weighs in its own bit alone
        self.start = [np.tile(WEIGHT * own, (texts, 1, 1)) for own in self.own]
        self.cell = ((np.arange(texts)[:, None, None] * bits + np.arange(bits)) * HEIGHTS + np.zeros((1, width, 1), dtype=np.int64)).astype(np.int32)
        self.against = np.where(nodes(np.arange(1 << bits), bits)[1], np.float32(-1), np.float32(1))

    def renew(self, texts: int) -> None:
        """Starts with other texts."""
        self.weights = [start[:texts].copy() for start in self.start]
        self.shift = np.zeros((texts, self.bits, HEIGHTS), dtype=np.float32)

    def code(self, n: np.ndarray, symbol: np.ndarray, inputs: list[np.ndarray]) -> np.ndarray:
        """Negative logarithm of the probability of the first n[i] symbols of row i, which is text i's, n falling; symbol: (text, symbol), inputs of
        each part of the predictors: (text, symbol, predictor and bit)."""
        rows, width = symbol.shape
        shift = self.shift[:rows]
        logit = np.matmul(inputs[0], self.weights[0][:rows])
        for x, weights in zip(inputs[1:], self.weights[1:]):
            logit += np.matmul(x, weights[:rows])
        height = logit * np.float32(1.5)
        height += np.float32(HEIGHTS / 2)
        np.maximum(height, 0, out=height)
        np.minimum(height, HEIGHTS - 1, out=height)
        cell = height.astype(np.int32)
        cell += self.cell[:rows, :width]
        cell = cell.astype(np.int64)
        logit += shift.ravel().take(cell)
        np.maximum(logit, -14, out=logit)
        np.minimum(logit, 14, out=logit)
        against = self.against.take(symbol, axis=0)
        logit *= against
        z = np.exp(logit, out=logit)
        odds = np.add(z, np.float32(1), out=height)
        error = np.divide(z, odds, out=z)
        error *= against
        full = int(np.searchsorted(-n, -width, side="right"))
        if full < rows:
            left = np.arange(width) >= n[full:, None]
            odds[full:][left] = 1
            error[full:][left] = 0
        odds = odds.reshape(rows, -1)
        part = odds.shape[1] // 4  # one logarithm of four factors, each e^14 + 1 at most
        many = odds[:, :part] * odds[:, part:2 * part]
        many *= odds[:, 2 * part:3 * part]
        many *= odds[:, 3 * part:4 * part]
        cost = np.log(many).sum(axis=1) + np.log(odds[:, 4 * part:]).sum(axis=1)
        rate = np.float32(1) / n.astype(np.float32)[:, None, None]
        for x, own, weights in zip(inputs, self.own, self.weights):
            slope = np.matmul(x.transpose(0, 2, 1), error)
            slope *= own
            slope *= np.float32(RATE) * rate
            weights[:rows] -= slope
        shift -= MAP_RATE * rate * np.bincount(cell.ravel(), weights=error.ravel(), minlength=shift.size).reshape(shift.shape)
        return cost


class Inputs:
    """Looks up the logits of all bits of symbols."""

    def __init__(self, logits: np.ndarray, bits: int) -> None:
        self.logits, self.node, self.mask = logits, nodes(np.arange(1 << bits), bits)[0].astype(np.int64), logits.shape[1] - 1

    def of(self, k: int, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Logits of predictor k, bits as the last axis, given where its places begin."""
        spot = self.node.take(symbol, axis=0)
        spot += place[..., None]
        spot &= self.mask
        return self.logits[k].take(spot, mode="clip")

    def table(self, out: np.ndarray, symbol: np.ndarray, places: list[np.ndarray]) -> None:
        """Fills the rows of ``out`` with the logits of (predictor, bit) of the first predictors."""
        bits = self.node.shape[1]
        for lo in range(0, len(out), CELLS):
            some = slice(lo, lo + CELLS)
            for k, place in enumerate(places):
                out[some, k * bits:(k + 1) * bits] = self.of(k, symbol[some], place[some])


def together(length: np.ndarray, step: int, cells: int = CELLS):
    """(texts, n, at) of texts in order of falling length that advance by ``step`` symbols: some rows at a time, whose first n symbols from ``at`` on are theirs."""
    rows = max(1, cells // step)
    for lo in range(0, len(length), rows):
        mine = length[lo:lo + rows]
        for at in range(0, int(mine[0]), step):
            active = int(np.searchsorted(-mine, -at, side="left"))
            yield slice(lo, lo + active), np.minimum(mine[:active] - at, step), at


class Model:
    """Logits of all table places and what else a task needs to score a block."""

    def __init__(self, counts: np.ndarray, bits: int, total: int, distinct: int, class_totals: dict[int, int], letters: np.ndarray | None = None) -> None:
        if max(class_totals, default=0) >= 1 << bits:
            raise ValueError("more classes than bits tell apart")
        self.logits, self.letters = logits_of(counts), None if letters is None else logits_of(letters)
        self.bits, self.total, self.distinct = bits, total, distinct

    def costs(self, block: Block) -> np.ndarray:
        """Natural logarithm of the probability of each text's class bits and letters of unknown tokens."""
        symbol = classes_of(block.known)[block.pos]
        places = block.places(symbol).T
        order = np.argsort(-block.per_row, kind="stable")
        length, first = block.per_row[order], block.first[order]
        out, model, inputs = np.zeros(len(order)), Weights(min(len(order), CELLS // STEP), STEP, self.bits, [3, 1, 1]), Inputs(self.logits[0], self.bits)
        # the first three contexts are made of two classes: their inputs are looked up once for all tokens with these classes
        one = block.before(symbol, 255)
        found, which = distinct(((one << 8 | block.before(one, 255)) << 8 | symbol).view(np.uint64))
        any_of = np.empty(len(found), dtype=np.int64)
        any_of[which] = np.arange(len(symbol))
        table = np.empty((len(found), 3 * self.bits), dtype=np.float32)
        inputs.table(table, symbol[any_of], [p[any_of] for p in places[:3]])
        for texts, n, at in together(length, STEP):
            if at == 0:
                model.renew(len(n))
            token = np.minimum(first[texts, None] + at + np.arange(n[0]), len(symbol) - 1)
            said = symbol.take(token)
            out[texts] -= model.code(n, said, [table.take(which.take(token), axis=0), *(inputs.of(k, said, places[k].take(token)) for k in (3, 4))])
        back = np.empty_like(out)
        back[order] = out
        return back + self.unknown_costs(block, symbol)

    def unknown_costs(self, block: Block, symbol: np.ndarray) -> np.ndarray:
        """The same of the letters of unknown tokens; their weights are refined after ``STEP`` tokens of any kind."""
        texts = len(block.per_row)
        weights = np.full((texts, LETTER_GATES, PREDICTORS), WEIGHT, dtype=np.float32)
        shift = np.zeros((texts, LETTER_GATES, HEIGHTS), dtype=np.float32)
        out = np.zeros(texts)
        unknown = np.flatnonzero(symbol == 0)
        text = np.searchsorted(block.first, unknown, side="right") - 1
        step = (unknown - block.first[text]) // STEP
        order = np.argsort(step, kind="stable")
        for some in np.split(order, np.flatnonzero(np.diff(step[order])) + 1) if len(order) else ():
            rows, who = np.unique(text[some], return_inverse=True)
            size = len(rows) * LETTER_GATES
            slope, fix, seen = np.zeros((size, PREDICTORS)), np.zeros(size * HEIGHTS), np.zeros(size)
            for which, letter, place, where in block.spelled(block.pos[unknown[some]]):
                node, bit = nodes(letter, 8)
                mine, gate = who[which], np.minimum(place, LETTER_GATES - 1)
                x = np.stack([self.logits[1, k][(where[:, k, None] + node) & (SLOTS - 1)] for k in range(PREDICTORS)])
                logit = np.einsum("kab,ak->ab", x, weights[rows[mine], gate])
                height = np.clip(logit * 1.5 + HEIGHTS / 2, 0, HEIGHTS - 1).astype(np.int64)
                logit = np.clip(logit + shift[rows[mine, None], gate[:, None], height], -14, 14)
                sign = np.where(bit, np.float32(1), np.float32(-1))
                cost = np.log1p(np.exp(-sign * logit))
                out -= np.bincount(rows[mine], weights=cost.sum(axis=1), minlength=texts)
                error = sign * -np.expm1(-cost)
                cell = mine * LETTER_GATES + gate
                for k in range(PREDICTORS):
                    slope[:, k] += np.bincount(cell, weights=np.einsum("ab,ab->a", error, x[k]), minlength=size)
                fix += np.bincount((cell[:, None] * HEIGHTS + height).ravel(), weights=error.ravel(), minlength=size * HEIGHTS)
                seen += 8 * np.bincount(cell, minlength=size)
            seen = np.maximum(seen, 1).reshape(-1, LETTER_GATES, 1)
            weights[rows] += RATE * slope.reshape(-1, LETTER_GATES, PREDICTORS) / seen
            shift[rows] += MAP_RATE * fix.reshape(-1, LETTER_GATES, HEIGHTS) / seen
        return out

    def letter_costs(self, block: Block) -> np.ndarray:
        """Natural logarithm of the probability of the letters of each text's known tokens, given their classes."""
        classes = classes_of(block.known)
        known = classes[block.pos] > 0
        size = np.add.reduceat(np.where(known, block.lengths[block.pos] + 1, 0), block.first)
        order = np.argsort(-size, kind="stable")
        out, spelling = np.zeros(len(size)), block.spelling(classes)
        model, inputs = Weights(min(len(size), CELLS // LETTER_STEP), LETTER_STEP, 8, [KNOWN - 1, 1]), Inputs(self.letters, 8)
        # inputs from inside a word are looked up once a distinct token of a group, those of the most frequent tokens once a block
        often = int(np.count_nonzero(np.bincount(block.pos, minlength=len(block.keys)) > 2))
        head = min(often, int(np.searchsorted(spelling.start, HEAD, side="right")) - 1)
        top = int(spelling.start[head])
        table, row = np.empty((top, 8 * (KNOWN - 1)), dtype=np.float32), np.empty((CELLS, 8 * (KNOWN - 1)), dtype=np.float32)
        inputs.table(table, spelling.letter[:top], [p[:top] for p in spelling.inside])
        for lo, hi in pieces(size[order], GROUP):
            texts = order[lo:hi]
            length = block.per_row[texts]
            token = np.repeat(block.first[texts] - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))
            found = block.letters_of(token[known[token]], classes, spelling, head)
            if len(found.letter) > len(table):
                table = np.concatenate([table[:top], np.empty((len(found.letter) - top, table.shape[1]), dtype=np.float32)])
            inputs.table(table[top:len(found.letter)], found.letter[top:], [p[top:] for p in found.inside])
            first, cost = np.cumsum(size[texts]) - size[texts], np.zeros(len(texts))
            ahead = [np.lib.stride_tricks.sliding_window_view(np.pad(x, (0, LETTER_STEP)), LETTER_STEP) for x in (found.at, found.across)]
            for some, n, at in together(size[texts], LETTER_STEP):
                if at == 0:
                    model.renew(len(n))
                own, across = (x[first[some] + at, :n[0]] for x in ahead)
                x, said = table.take(own, axis=0, out=row[:own.size].reshape(*own.shape, -1), mode="clip"), found.letter.take(own)
                cost[some] += model.code(n, said, [x, inputs.of(KNOWN - 1, said, across)])
            out[texts] = -cost
        return out

    def rates(self, block: Block) -> dict[str, np.ndarray]:
        count = block.known.astype(np.float64)
        row = np.repeat(np.arange(len(block.per_row)), block.per_row)

        def summed(of_token: np.ndarray) -> np.ndarray:
            return np.bincount(row, weights=of_token[block.pos], minlength=len(block.per_row))

        base = np.log10((count + 0.5) / (self.total + 0.5 * (self.distinct + 1)))
        score = (self.costs(block) + self.letter_costs(block)) / np.log(10)
        size = summed(block.lengths + 1.0)
        return {"n_tokens": block.per_row, "n_known": summed(block.known > 0).astype(np.int64), "train_tokens": np.full(len(size), self.total),
                "base_score": summed(base), "score": score, "bits_per_byte": -score * np.log2(10) / size}


def score(docs: DataFrame, block_bytes: int = TEXT_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte of every row."""
    counts = written(training_counts(docs))
    summary = counts.groupBy(F.length(F.bin("n")).alias("class")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("distinct")).collect()  # 63 rows at most
    bits = max(1, max((r["class"] for r in summary), default=0).bit_length())
    blocks = with_answers(bucketed(token_blocks(docs, block_bytes)), counts, "n")
    counted, letters = all_counts(blocks, bits)
    model = Model(counted, bits, sum(r.n for r in summary), sum(r.distinct for r in summary), {r["class"]: r.n for r in summary}, letters)
    names = ["doc_id", "train", "per_row", "pos", "keys", "lengths", "letters", "known"]

    def rate(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                columns = dict(zip(names, batch.slice(i, 1).columns))
                found = model.rates(Block(columns))
                held = pc.invert(columns["train"].flatten())
                yield pa.RecordBatch.from_arrays([columns["doc_id"].flatten(), held, *(pa.array(x) for x in found.values())], ["doc_id", "held_out", *found])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return blocks.select(*names).mapInArrow(
        tidy(rate), f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double")
