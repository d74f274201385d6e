"""Exact n-gram Jaccard join with set-relation skipping.

A text's set is its distinct shingles of ``SHINGLE`` words (A-Z lower-cased); fewer words make one shingle.
Two texts link when 100 * |intersection| >= percent * |union|.

1. Equal sets become one node (a 64-bit hash of the set), so copies cost nothing further.
2. Shingles have one global order: rarer first, by a count sketch of fixed size over all rows, then by hash.
   Two linked sets share a shingle within the first |x| - ceil(percent * |x|) + 1 of each (prefix filter);
   these prefixes make the inverted index.
3. Each index list is led by one of its sets, picked by one of ``LEADERS`` hash orders, so that a family of
   similar sets shares a few leaders.  A leader's answers are computed exactly for its whole list (as far as
   the bounds on size and position allow any link).
4. In each list the answers of any two sets are derived from their overlaps
   with the leader, which bound theirs from both sides; lists are walked by blocks in order of size, and a block is skipped
   when its sizes or positions rule out every link.  Only pairs that the bounds leave open are computed.
   Before whole sets are fetched for a pair, their parity bitmaps (one to two bits a shingle) give a floor of
   the sets' difference; most pairs that merely share a passage end there.
5. 3 and 4 give every link of two different sets: the number of links of each row, and the components.
   ``one_of_each`` needs the components alone; only there, sets that the leaders' answers already connect are not
   compared any further, and a list of one component is skipped.

Sets are told apart by 64-bit hashes of shingles and of sets.  Defined results: null, empty and blank texts have the
empty set and link with nothing, not even each other; copies of a row link; null doc_ids are kept and don't name
a component unless all its rows lack an id; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .sketch import COUNTERS, among, part, present, sketch
from .text import Chunk, checkpointed, chunks, inside_row, mix, signed, split_words, tidy, window_hashes, word_hashes

SHINGLE = 5
PERCENT = 80
#: Leaders that a large family of similar sets gets; lists pick them by hash.
LEADERS = 32
BLOCK = 128

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def sets_of(chunk: Chunk, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shingle hashes by row, ascending and distinct; border of each row among them; node hash of each row)."""
    folded = Chunk(chunk.first, _FOLD[chunk.data], chunk.offsets)
    words = split_words(folded)
    hashes = word_hashes(folded.data, words.start, words.end)
    inside = inside_row(words, size)
    at = np.flatnonzero(inside)
    row, value = [words.row[at]], [window_hashes(hashes, size)[at]]
    for k in range(1, size):  # texts of fewer words are one shingle
        few = np.flatnonzero(words.counts == k)
        if len(few):
            row.append(few)
            value.append(mix(window_hashes(hashes, k)[words.first[few]] + np.uint64(k)))
    row, value = np.concatenate(row), np.concatenate(value)
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    row, value = row[new], value[new]
    first = np.searchsorted(row, np.arange(chunk.rows + 1))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(value + np.uint64(1)))])
    return value, first, signed(mix(total[first[1:]] - total[first[:-1]] + np.diff(first).astype(np.uint64)))


def parity_bits(value: np.ndarray, first: np.ndarray) -> list[bytes]:
    """Per row a bitmap, as long as the least power of two (64 at least) of its number of shingles: parity of the shingles at each bit."""
    n = np.diff(first)
    width = 64 << np.ceil(np.log2(np.maximum(n, 64) / 64)).astype(np.int64)
    base = np.cumsum(width) - width
    spot = (mix(value + np.uint64(2)) & np.repeat(width - 1, n).astype(np.uint64)).astype(np.int64) + np.repeat(base, n)
    packed = np.packbits((np.bincount(spot, minlength=int(width.sum())) & 1).astype(np.uint8), bitorder="little").tobytes()
    return [packed[s // 8:(s + w) // 8] for s, w in zip(base.tolist(), width.tolist())]


def least_difference(x: bytes, y: bytes) -> int:
    """Floor of the size of the symmetric difference of two sets, from their parity bitmaps."""
    if len(x) > len(y):
        x, y = y, x
    small, large, size = int.from_bytes(x, "little"), int.from_bytes(y, "little"), 4 * len(y)
    while size >= 8 * len(x):
        large = large >> size ^ large & (1 << size) - 1
        size //= 2
    return (small ^ large).bit_count()


def rows_with_nodes(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, copy, n_shingles, node, bits of every row."""

    def run(batches):
        for batch in batches:
            for chunk in chunks(batch.column(2)):
                value, first, node = sets_of(chunk, size)
                rows = batch.slice(chunk.first, chunk.rows)
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns[:2], pa.array(np.diff(first).astype(np.int64)), pa.array(node), pa.array(parity_bits(value, first), pa.binary())],
                    ["doc_id", "copy", "n_shingles", "node", "bits"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.xxhash64("text").alias("copy"), "text").mapInArrow(tidy(run), f"doc_id {kind}, copy long, n_shingles long, node long, bits binary")


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    return n - (percent * n + 99) // 100 + 1


def postings(docs: DataFrame, counts: np.ndarray, size: int, percent: int) -> DataFrame:
    """shingle, node, n, place for the prefix of every node; a task names a node once, however many copies it has."""

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            for chunk in chunks(batch.column(0)):
                value, first, node = sets_of(chunk, size)
                n = np.diff(first)
                fresh = np.zeros(chunk.rows, dtype=bool)
                for i, x in enumerate(node.tolist()):
                    if n[i] and x not in seen:
                        seen.add(x)
                        fresh[i] = True
                row = np.repeat(np.arange(chunk.rows), n)
                order = np.lexsort((value, counts[(value % np.uint64(COUNTERS)).astype(np.int64)], row))
                place = np.arange(len(value)) - np.repeat(first[:-1], n)
                use = fresh[row] & (place < np.repeat(prefix_length(n, percent), n))
                yield pa.RecordBatch.from_arrays([pa.array(signed(value[order][use])), pa.array(node[row[use]]), pa.array(n[row[use]], pa.int32()), pa.array(place[use], pa.int32())],
                                                 ["shingle", "node", "n", "place"])

    return docs.select("text").mapInArrow(tidy(run), "shingle long, node long, n int, place int")


def whole_lists(batches, key: int):
    """Columns of complete lists, as numpy arrays, from batches sorted by column ``key``; several lists at a time."""
    held: list[list[np.ndarray]] = []
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if not batch.num_rows:
            continue
        keys = columns[key]
        border = int(np.searchsorted(keys, keys[-1]))
        if held and (border > 0 or held[0][key][0] != keys[0]):
            full = [np.concatenate([h[i] for h in held] + [columns[i][:border]]) for i in range(len(columns))]
            held = []
            yield full
        elif border > 0:
            yield [c[:border] for c in columns]
        held.append([c[border:] for c in columns])
    if held:
        yield [np.concatenate([h[i] for h in held]) for i in range(len(held[0]))]


def index_lists(found: DataFrame) -> DataFrame:
    """Lists of two nodes or more, each row with its list's leader: lead, lead_n, lead_place."""

    def run(batches):
        for shingle, n, node, place in whole_lists(batches, 0):
            new = np.ones(len(node), dtype=bool)
            new[1:] = (shingle[1:] != shingle[:-1]) | (node[1:] != node[:-1])  # tasks may repeat a node
            shingle, n, node, place = shingle[new], n[new], node[new], place[new]
            begin = np.flatnonzero(np.concatenate([[True], shingle[1:] != shingle[:-1]]))
            length = np.diff(np.append(begin, len(shingle)))
            use = np.repeat(length > 1, length)
            if use.any():
                order = mix(node.view(np.uint64) + mix(shingle.view(np.uint64) % np.uint64(LEADERS)))
                least = np.lexsort((order, np.repeat(np.arange(len(begin)), length)))[begin]
                lead = np.repeat(least, length)[use]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (shingle[use], node[use], n[use], place[use], node[lead], n[lead], place[lead])],
                    ["shingle", "node", "n", "place", "lead", "lead_n", "lead_place"])

    ordered = found.select("shingle", "n", "node", "place").repartition("shingle").sortWithinPartitions("shingle", "n", "node")
    return ordered.mapInArrow(tidy(run), "shingle long, node long, n int, place int, lead long, lead_n int, lead_place int")


def set_table(docs: DataFrame, needed: DataFrame, size: int) -> DataFrame:
    """node and its sorted shingles (binary) for each node of ``needed``.

    A sketch of the needed nodes spares most others the way; those that slip through are dropped by the join.
    """
    wanted = present(needed)

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            for chunk in chunks(batch.column(0)):
                value, first, node = sets_of(chunk, size)
                out = []
                for i in np.flatnonzero(among(wanted, (node.view(np.uint64) % np.uint64(COUNTERS)).astype(np.int64))).tolist():
                    if first[i + 1] > first[i] and int(node[i]) not in seen:
                        seen.add(int(node[i]))
                        out.append(i)
                yield pa.RecordBatch.from_arrays([pa.array(node[out]), pa.array([value[first[i]:first[i + 1]].tobytes() for i in out], pa.binary())], ["node", "shingles"])

    some = docs.select("text").mapInArrow(tidy(run), "node long, shingles binary")
    return some.join(needed, "node", "left_semi").dropDuplicates(["node"])


def survivors(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that sizes and bitmaps don't rule out; ``nodes`` has node, n_shingles and bits."""

    def run(batches):
        for batch in batches:
            total = batch.column(2).to_numpy() + batch.column(4).to_numpy()
            x, y = batch.column(3).to_pylist(), batch.column(5).to_pylist()
            floor = np.fromiter(map(least_difference, x, y), np.int64, batch.num_rows)
            yield batch.filter(pa.array((100 + percent) * floor <= (100 - percent) * total)).select([0, 1])

    one, two = (nodes.select(F.col("node").alias(x), F.col("n_shingles").alias(f"{x}_n"), F.col("bits").alias(f"{x}_bits")) for x in "ab")
    return pairs.join(one, "a").join(two, "b").select("a", "b", "a_n", "a_bits", "b_n", "b_bits").mapInArrow(tidy(run), "a long, b long")


def overlaps(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """a, b, a_n, b_n, overlap, counted exactly, of each pair that may link."""
    pairs = checkpointed(survivors(pairs, nodes, percent))
    needed = pairs.select(F.col("a").alias("node")).unionAll(pairs.select(F.col("b").alias("node"))).distinct()
    sets = checkpointed(set_table(docs, needed, size))

    def run(batches):
        for batch in batches:
            a, b = batch.column(2), batch.column(3)
            out = np.zeros((batch.num_rows, 3), dtype=np.int64)
            for i in range(batch.num_rows):
                x, y = np.frombuffer(a[i].as_buffer(), dtype=np.uint64), np.frombuffer(b[i].as_buffer(), dtype=np.uint64)
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                out[i] = len(x), len(y), np.count_nonzero(y[at] == x)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *(pa.array(out[:, k]) for k in range(3))], ["a", "b", "a_n", "b_n", "overlap"])

    one, two = (sets.select(F.col("node").alias(x), F.col("shingles").alias(f"{x}_set")) for x in "ab")
    return pairs.join(two, "b").join(one, "a").select("a", "b", "a_set", "b_set").mapInArrow(tidy(run), "a long, b long, a_n long, b_n long, overlap long")


def linked(a_n, b_n, overlap, percent: int):
    return (100 + percent) * overlap >= percent * (a_n + b_n)


def list_pairs(length: np.ndarray, begin: np.ndarray, n: np.ndarray, left: np.ndarray, percent: int):
    """Index pairs inside lists sorted by size: short lists of one length at once, long ones by blocks, skipping blocks
    whose sizes or positions rule out every link."""
    for size in np.unique(length[length <= BLOCK]):
        if size > 1:
            at = begin[length == size]
            i, j = np.triu_indices(size, 1)
            for k in range(0, len(at), max(1, BLOCK * BLOCK // len(i))):
                some = at[k:k + max(1, BLOCK * BLOCK // len(i)), None]
                yield (some + i).ravel(), (some + j).ravel()
    for lo, size in zip(begin[length > BLOCK].tolist(), length[length > BLOCK].tolist()):
        for x in range(lo, lo + size, BLOCK):
            i = np.arange(x, min(x + BLOCK, lo + size))
            for y in range(x, lo + size, BLOCK):
                j = np.arange(y, min(y + BLOCK, lo + size))
                if 100 * n[i].max() < percent * n[j].min():
                    break  # later blocks hold larger sets only
                if linked(n[i].min(), n[j].min(), min(left[i].max(), left[j].max()), percent):
                    one, two = np.repeat(i, len(j)), np.tile(j, len(i))
                    yield one[one < two], two[one < two]


def list_links(index: DataFrame, percent: int, every: bool) -> DataFrame:
    """a, b, sure, bridge for the pairs of lists that may link; without ``every`` only those of different components.

    ``index`` has shingle, n, place, node, component, lead_n, with_lead (overlap with the list's leader, -1 if not
    computed) and bits.  sure: the overlaps with the leader prove the link.  bridge: the components differ.
    """

    def run(batches):
        for shingle, *columns, bits in whole_lists(batches, 0):
            n, place, node, component, lead_n, with_lead = (c.astype(np.int64) for c in columns)
            left = n - place
            begin = np.flatnonzero(np.concatenate([[True], shingle[1:] != shingle[:-1]]))
            for i, j in list_pairs(np.diff(np.append(begin, len(n))), begin, n, left, percent):
                use = linked(n[i], n[j], np.minimum(left[i], left[j]), percent)
                if not every:
                    use &= component[i] != component[j]
                i, j = i[use], j[use]
                u, v = with_lead[i], with_lead[j]
                known = (u >= 0) & (v >= 0)
                most = np.minimum(u, v) + np.minimum(n[i] - u, n[j] - v)
                sure = known & linked(n[i], n[j], u + v - lead_n[i], percent)
                open_ = np.flatnonzero(~sure & (~known | linked(n[i], n[j], most, percent)))
                floor = np.fromiter(map(least_difference, bits[i[open_]], bits[j[open_]]), np.int64, len(open_))
                use = sure.copy()
                use[open_] = (100 + percent) * floor <= (100 - percent) * (n[i] + n[j])[open_]
                if use.any():
                    i, j = i[use], j[use]
                    one, two = node[i], node[j]
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(one, two)), pa.array(np.maximum(one, two)), pa.array(sure[use]), pa.array(component[i] != component[j])],
                                                     ["a", "b", "sure", "bridge"])

    ordered = index.select("shingle", "n", "place", "node", "component", "lead_n", "with_lead", "bits").repartition("shingle").sortWithinPartitions("shingle", "n", "node")
    return ordered.mapInArrow(tidy(run), "a long, b long, sure boolean, bridge boolean").groupBy("a", "b").agg(F.max("sure").alias("sure"), F.first("bridge").alias("bridge"))


def links(docs: DataFrame, rows: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """a, b (a < b): all links of distinct nodes, each once; ``rows`` as of ``rows_with_nodes``."""
    return node_links(docs, rows, size, percent, every=True).select("a", "b")


def node_links(docs: DataFrame, rows: DataFrame, size: int, percent: int, every: bool) -> DataFrame:
    """a, b (a < b), bridge: links of distinct nodes, each once.  Those with bridge connect all that is connected; without
    ``every`` the others are left out."""
    counts = sketch(docs.select("text"), lambda batch: (sets_of(c, size)[0] for c in chunks(batch.column(0))))
    index = checkpointed(index_lists(postings(docs, counts, size, percent)))
    del counts
    nodes = checkpointed(rows.join(index.select("node").distinct(), "node", "left_semi").select("node", "n_shingles", "bits").dropDuplicates(["node"]))
    most = F.least(F.col("n") - F.col("place"), F.col("lead_n") - F.col("lead_place"))
    stars = checkpointed(index.filter((F.col("node") != F.col("lead")) & linked(F.col("n"), F.col("lead_n"), most, percent))
                         .select(F.col("lead").alias("a"), F.col("node").alias("b")).distinct())
    star = checkpointed(overlaps(stars, nodes, docs, size, percent))
    first = star.filter(linked(F.col("a_n"), F.col("b_n"), F.col("overlap"), percent)).select("a", "b")
    label = connected_components(first)
    rest = index.join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))
    if not every:
        mixed = rest.groupBy("shingle").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select("shingle")
        rest = rest.join(mixed, "shingle", "left_semi")
    answers = star.select(F.col("a").alias("lead"), F.col("b").alias("node"), "overlap")
    rest = rest.join(answers, ["lead", "node"], "left").withColumn(
        "with_lead", F.when(F.col("lead") == F.col("node"), F.col("n")).otherwise(F.coalesce("overlap", F.lit(-1))))
    pairs = checkpointed(list_links(rest.join(nodes.select("node", "bits"), "node"), percent, every))
    done = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    fresh = checkpointed(pairs.filter("NOT sure").join(done, ["a", "b"], "left_anti").select("a", "b", "bridge"))
    second = overlaps(fresh.select("a", "b"), nodes, docs, size, percent).filter(linked(F.col("a_n"), F.col("b_n"), F.col("overlap"), percent)).select("a", "b")
    starred = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.lit(True).alias("bridge"))
    found = starred.unionAll(pairs.filter("sure").select("a", "b", "bridge")).unionAll(second.join(fresh, ["a", "b"]).select("a", "b", "bridge"))
    return checkpointed(found.groupBy("a", "b").agg(F.max("bridge").alias("bridge")))


def classes(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, every: bool = True) -> DataFrame:
    """doc_id, copy (hash of the text), n_shingles, component (a node) of every row, written out; with ``every`` also
    n_links, the number of other rows that the row links with, copies included."""
    rows = checkpointed(rows_with_nodes(docs.select("doc_id", "text"), size))
    found = node_links(docs, rows, size, percent, every)
    placed = rows.join(connected_components(found.filter("bridge")), "node", "left")
    columns = ["doc_id", "copy", "n_shingles", F.coalesce("component", "node").alias("component")]
    if every:
        copies = checkpointed(rows.filter("n_shingles > 0").groupBy("node").agg(F.count(F.lit(1)).alias("copies")))
        ends = found.select("a", "b").unionAll(found.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = ends.join(copies.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.sum("copies").alias("near"))
        total = copies.join(near, "node", "left").select("node", (F.col("copies") - 1 + F.coalesce("near", F.lit(0))).alias("n_links"))
        placed = placed.join(total, "node", "left")
        columns.append(F.coalesce("n_links", F.lit(0)).alias("n_links"))
    return checkpointed(placed.select(*columns))


def named(placed: DataFrame, *more: str) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id that links lead to) of the rows of ``classes``, and the columns ``more``."""
    low = checkpointed(placed.filter("n_shingles > 0").groupBy("component").agg(F.min("doc_id").alias("low")))
    empty = F.col("n_shingles") == 0
    return placed.join(low, "component", "left").select(
        "doc_id", "n_shingles", F.when(empty, F.col("doc_id")).otherwise(F.col("low")).alias("component_id"), *more)


def counted(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links (other rows it links with) of every row."""
    return named(classes(docs, size, percent), "n_links")


def join(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id of every row: membership in the classes that the links between representatives connect."""
    return named(classes(docs, size, percent, every=False))


def one_of_each(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row, with all its columns, of each component: the smallest doc_id, nulls last; texts without words all stay."""
    has_words = F.coalesce(F.regexp_like("text", F.lit(r"[^\x20\x09-\x0D]")), F.lit(False))
    placed = classes(docs.filter(has_words), size, percent, every=False)
    kept = placed.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "copy")).alias("k"))
    own = F.col("doc_id").eqNullSafe(F.col("k.doc_id")) & (F.col("copy") == F.col("k.copy"))
    keys = placed.join(kept, "component").groupBy("doc_id", "copy").agg(F.count(F.lit(1)).alias("rows"), F.max(own).alias("stays"))
    # rows that go, or stand there several times; a sketch of them spares all other texts the way
    touched = checkpointed(keys.filter("rows > 1 OR NOT stays").select(F.xxhash64("doc_id", "copy").alias("key"), "stays"))
    wanted = present(touched.select("key"))
    rows = docs.filter(has_words).select(F.struct(*docs.columns).alias("row"), F.xxhash64("doc_id", F.xxhash64("text")).alias("key"))
    some = part(rows, "key", wanted, True)
    once = some.join(touched.filter("stays"), "key", "left_semi").dropDuplicates(["key"])
    stay = reduce(DataFrame.unionAll, [x.select("row") for x in (part(rows, "key", wanted, False), some.join(touched, "key", "left_anti"), once)])
    return stay.select("row.*").unionAll(docs.filter(~has_words))
