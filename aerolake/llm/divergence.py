"""Source divergence audit: integer chi-square divergences between the term profiles of sources of one language.

A term is a run of letters and non-ASCII characters, only A-Z lower-cased.  A language keeps the terms that stand in at
least ``MIN_DOCS`` of its documents.  Each (lang, source) group, and each language, gives each of the V kept terms the
share p = 1 + floor(SCALE * (count + 1) / (N + V)); the divergence of p from q is the sum of floor((p - q)^2 / q).

Three-dimensional cube partitioning: groups of a language are dealt over group blocks, its terms over term blocks, and a
task owns whole (group block, group block, term block) cells.  Slices of the counts are replicated to the cells that need them,
a cell computes the partial divergences of all its ordered pairs of groups in numpy, and Spark sums the partials along the
term axis.  Terms that none of a cell's groups uses are one weighted column.  A cell holds about
``GROUPS`` * 2 by ``TERMS`` counts however large the corpus is: the numbers of blocks follow from the numbers of groups and terms.

Counts are added up per chunk of text and again per task before they are shuffled, so a source or a term that holds a third of all rows
arrives as few rows.  All arithmetic is on 64-bit integers; a scaled quotient is taken by long division in steps
of 1000, so that counts up to 9 * 10^15 stay exact.

Defined results: null text, lang and source count as ''; every row is a document, repeated rows as well; a group
without kept terms has count 0 for each; without kept terms all pair values are 0; equal values are ranked by the item's UTF-8 bytes;
a source alone in its language has no pair rows; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .text import byte_set, chunks, mix, slices, split_words, word_hashes, written

MIN_DOCS = 3
SCALE_STEPS, STEP = 3, 1000  # SCALE = STEP ** SCALE_STEPS
TOP = 200
#: Groups in a group block and terms in a term block, on average.
GROUPS, TERMS = 16, 4096
BREAKS = byte_set(bytes([*range(0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def scaled(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """floor(10^9 * part / whole) for part <= whole, exact."""
    out, rest = np.zeros_like(part), part
    for _ in range(SCALE_STEPS):
        out, rest = out * STEP + rest * STEP // whole, rest * STEP % whole
    return out


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10^9 * (count + 1) / (total + kept)) in the JVM's long arithmetic, by the same long division."""
    rest, whole, out = count + 1, total + kept, F.lit(0).cast("long")
    for _ in range(SCALE_STEPS):
        out, rest = out * STEP + F.call_function("div", rest * STEP, whole), rest * STEP % whole
    return out + 1


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs (rows that have it), added up per chunk."""

    def run(batches):
        for batch in batches:
            lang, source = (pc.dictionary_encode(c) for c in batch.columns[:2])
            group = lang.indices.to_numpy().astype(np.int64) * max(1, len(source.dictionary)) + source.indices.to_numpy()
            for chunk in chunks(batch.column(2), 4 << 20):
                words = split_words(chunk, BREAKS)
                if not len(words.start):
                    continue
                folded = _FOLD[chunk.data]
                hashes = word_hashes(folded, words.start, words.end)
                _, at, n = np.unique(hashes + mix(words.row.astype(np.uint64) + np.uint64(1)), return_index=True, return_counts=True)
                mine = group[chunk.first + words.row[at]]
                _, one, which = np.unique(mix(hashes[at]) + mix(mine.astype(np.uint64) + np.uint64(1)), return_index=True, return_inverse=True)
                total = np.zeros(len(one), dtype=np.int64)
                np.add.at(total, which, n)
                spot = at[one]
                rows = chunk.first + words.row[spot]
                yield pa.RecordBatch.from_arrays(
                    [pc.take(batch.column(0), pa.array(rows)), pc.take(batch.column(1), pa.array(rows)),
                     slices(folded, words.start[spot], words.end[spot], pa.string()), pa.array(total), pa.array(np.bincount(which, minlength=len(one)))],
                    ["lang", "source", "term", "n", "docs"])

    partial = docs.select("lang", "source", "text").mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def cell(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Partial divergences (source from item) of the ordered pairs of groups that meet in one cell.

    Rows without a term name a group with its total, rows without a source give the number of kept terms of the block.
    """
    block_a, block_b = key[1].as_py(), key[2].as_py()
    source, term, n = table.column("source"), table.column("term"), table.column("n").to_numpy()
    no_term, no_source = pc.is_null(term).to_numpy(), pc.is_null(source).to_numpy()
    heads = np.flatnonzero(no_term & ~no_source)
    names = pc.take(source, pa.array(heads)).to_pylist()
    place = {s: i for i, s in enumerate(names)}
    total, block = n[heads], table.column("block").to_numpy()[heads]
    v = int(table.column("v")[0].as_py())
    data = np.flatnonzero(~no_term)
    coded = pc.dictionary_encode(pc.take(term, pa.array(data))).combine_chunks()
    p = np.zeros((len(names), len(coded.dictionary) + 1), dtype=np.int64)
    who = pc.dictionary_encode(pc.take(source, pa.array(data))).combine_chunks()
    to = np.array([place[s] for s in who.dictionary.to_pylist()], dtype=np.int64)
    if len(data):
        p[to[who.indices.to_numpy()], coded.indices.to_numpy()] = n[data]
    weight = np.ones(p.shape[1], dtype=np.int64)
    weight[-1] = n[no_source].sum() - len(coded.dictionary)
    if v:
        p = 1 + scaled(p + 1, (total + v)[:, None])
    else:
        p += 1  # no kept terms: all weights are 0
    out: list[tuple] = []
    for first, second in {(block_a, block_b), (block_b, block_a)}:
        others = np.flatnonzero(block == second)
        for g in np.flatnonzero(block == first):
            gap = p[g] - p[others]
            value = (gap * gap // p[others] * weight).sum(axis=1)
            out += [(names[g], names[h], int(x)) for h, x in zip(others, value) if h != g]
    lang = [key[0].as_py()] * len(out)
    return pa.table([pa.array(lang, pa.string()), *(pa.array([o[k] for o in out], kind) for k, kind in enumerate((pa.string(), pa.string(), pa.int64())))],
                    ["lang", "source", "item", "value"])


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, groups: int = GROUPS, terms: int = TERMS) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank."""
    docs = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    counts = written(term_counts(docs))
    kept_terms = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).filter(F.col("docs") >= min_docs)
    kept_terms = written(kept_terms.select("lang", "term", "lang_n"))
    kept = counts.select("lang", "source", "term", "n").join(kept_terms, ["lang", "term"])
    found = docs.select("lang", "source").distinct()
    blocks = found.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / groups).cast("long").alias("group_blocks"))
    langs = kept_terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_total"))
    sizes = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    zero = F.lit(0).cast("long")
    profile = written(
        found.join(sizes, ["lang", "source"], "left").join(blocks, "lang").join(langs, "lang", "left").select(
            "lang", "source", "group_blocks", *(F.coalesce(F.col(c), zero).alias(c) for c in ("total", "v", "lang_total")))
        .withColumn("term_blocks", F.greatest(F.lit(1).cast("long"), F.ceil(F.col("v") / terms).cast("long")))
        .withColumn("block", F.pmod(F.xxhash64("source"), "group_blocks")))
    counted = written(kept.join(profile, ["lang", "source"]))

    a, b = F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b")
    every_block = F.explode(F.sequence(zero, F.col("group_blocks") - 1)).alias("other")
    every_terms = F.explode(F.sequence(zero, F.col("term_blocks") - 1)).alias("k")
    no_term, no_source = F.lit(None).cast("string").alias("term"), F.lit(None).cast("string").alias("source")
    data = counted.select("lang", "block", F.pmod(F.xxhash64("term"), "term_blocks").alias("k"), "source", "term", "n", "v", every_block).select(
        "lang", a, b, "k", "block", "source", "term", "n", "v")
    heads = profile.select("*", every_block).select("*", every_terms).select(
        "lang", a, b, "k", "block", "source", no_term, F.col("total").alias("n"), "v")
    grid = profile.select("lang", "group_blocks", "term_blocks", "v").distinct()
    in_block = (kept_terms.join(grid.select("lang", "term_blocks"), "lang")
                .groupBy("lang", F.pmod(F.xxhash64("term"), "term_blocks").alias("k")).agg(F.count(F.lit(1)).alias("n")))
    pairs_of_blocks = grid.select("lang", "v", "group_blocks", every_block).select(
        "lang", "v", F.col("other").alias("a"), F.explode(F.sequence(F.col("other"), F.col("group_blocks") - 1)).alias("b"))
    amounts = in_block.join(pairs_of_blocks, "lang").select(
        "lang", "a", "b", "k", zero.alias("block"), no_source, no_term, "n", "v")
    cells = data.unionAll(heads).unionAll(amounts).groupBy("lang", "a", "b", "k")
    partial = cells.applyInArrow(cell, "lang string, source string, item string, value long")
    pair = partial.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))

    own, all_ = share(F.col("n"), F.col("total"), F.col("v")), share(F.col("lang_n"), F.col("lang_total"), F.col("v"))
    scored = counted.select("lang", "source", F.col("term").alias("item"), own.alias("p"), all_.alias("q")).filter("p > q")
    scored = scored.select("lang", "source", "item", F.expr("(p - q) * (p - q) div q").alias("value"))
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    ranked = [frame.withColumn("rank", place).filter(limit).select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
              for part, frame, limit in (("pair", pair, F.lit(True)), ("term", scored, F.col("rank") <= top))]
    return ranked[0].unionAll(ranked[1])
