import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from aerolake.llm import mixing


def tokens(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + [None]


def trains(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 5 != 1


def texts(n):
    rng = random.Random(6)
    words = ["The", "the", "né", "漢字", "a", "of", "and"] * 5 + ["".join(rng.choice("abcdeé.") for _ in range(rng.randint(1, 9))) for _ in range(150)]
    return [" ".join(rng.choice(words) for _ in range(rng.randint(0, 120))) for _ in range(n)]


@pytest.mark.parametrize("block", [mixing.BLOCK_BYTES, 3000])
def test_base_columns_equal_brute_force(table, odd_rows, block):
    rows = [*enumerate(texts(80)), *((None if i is None else i + 1000, t) for i, t in odd_rows)]
    count = Counter(w for i, t in rows if trains(i) for w in tokens(t))
    total, distinct = sum(count.values()), len(count)
    got = sorted((tuple(r) for r in mixing.score(table(rows), block).collect()), key=str)
    want = []
    for i, t in rows:
        mine = tokens(t)
        want.append((i, not trains(i), len(mine), sum(count[w] > 0 for w in mine), total,
                     sum(math.log10((count[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in mine)))
    assert sorted((g[:5] for g in got), key=str) == sorted((w[:5] for w in want), key=str)
    by = {}
    for w in want:
        by.setdefault(w[:5], []).append(w[5])
    for g in got:
        assert any(abs(g[5] - x) <= 1e-9 * max(1, abs(x)) for x in by[g[:5]])
        assert g[6] < 0 and math.isfinite(g[6]) and g[7] > 0


def plain_costs(model, block):
    """Natural log probability of each text's bits, decision by decision and text by text."""
    symbol = mixing.classes_of(block.known)[block.pos]
    places, out = block.places(symbol), []
    for first, n in zip(block.first, block.per_row):
        gates = model.bits + mixing.LETTER_GATES
        w, shift, total = np.full((gates, 5), mixing.WEIGHT), np.zeros((gates, mixing.HEIGHTS)), 0.0
        for step in range(0, n, mixing.STEP):
            events = []
            for t in range(first + step, first + min(step + mixing.STEP, n)):
                for b in range(model.bits):
                    node = (1 << b) | (int(symbol[t]) >> (model.bits - b))
                    events.append((b, 0, places[t], node, int(symbol[t]) >> (model.bits - 1 - b) & 1))
                if symbol[t] == 0:
                    for _, letter, place, where in block.spelled(block.pos[t:t + 1]):
                        for i in range(len(letter)):
                            for b in range(8):
                                node = (1 << b) | (int(letter[i]) >> (8 - b))
                                events.append((model.bits + min(int(place[i]), mixing.LETTER_GATES - 1), 1, where[i], node, int(letter[i]) >> (7 - b) & 1))
            slope, fix, seen = np.zeros_like(w), np.zeros_like(shift), np.zeros(gates)
            for gate, kind, place, node, bit in events:
                x = np.array([model.logits[kind, k][(int(place[k]) + node * 40503) % mixing.SLOTS] for k in range(5)])
                logit = float(w[gate] @ x)
                height = int(min(max(logit * 1.5 + mixing.HEIGHTS / 2, 0), mixing.HEIGHTS - 1))
                p = 1 / (1 + math.exp(-min(max(logit + shift[gate, height], -14), 14)))
                total += math.log(p if bit else 1 - p)
                slope[gate] += (bit - p) * x
                fix[gate, height] += bit - p
                seen[gate] += 1
            w += mixing.RATE * slope / np.maximum(seen, 1)[:, None]
            shift += mixing.MAP_RATE * fix / np.maximum(seen, 1)[:, None]
        out.append(total)
    return np.array(out)


def test_costs_equal_plain_mixing(table):
    rows = list(enumerate(texts(40) + ["", "x" * 300, "a b"]))
    docs = table(rows)
    counts = mixing.training_counts(docs)
    blocks = mixing.with_answers(mixing.bucketed(mixing.token_blocks(docs)), counts, "n")
    row = blocks.toArrow().combine_chunks()
    model = mixing.Model(mixing.bit_counts(blocks, 4), 4, 10, 5, {1: 3, 2: 9})
    block = mixing.Block({c: row.column(c).combine_chunks() for c in row.column_names})
    assert (mixing.classes_of(block.known) == [int(x).bit_length() for x in block.known]).all()
    assert np.allclose(model.costs(block), plain_costs(model, block), rtol=2e-3, atol=2e-2)


def test_bits_are_counted_without_a_tokens_own_occurrence(table):
    ids = [i for i in range(100) if trains(i)][:3]
    docs = table([(ids[0], "aa bb"), (ids[1], "bb"), (ids[2], None)])
    blocks = mixing.with_answers(mixing.bucketed(mixing.token_blocks(docs)), mixing.training_counts(docs), "n")
    counts = mixing.bit_counts(blocks, 2)
    assert counts[0, 0].sum() == 6 * 2  # aa, bb, bb and three ends, two bits each
    assert counts[1, 0].sum() == 3 * 8  # aa alone is unknown without itself: two letters and a blank


def test_probabilities_of_next_tokens_add_up_to_one_at_most(table):
    """All texts of one token: known words and spelled ones together have no more than probability one."""
    letters = ["a", "b", "c"]
    train = [i for i in range(200) if trains(i)][:60]
    rows = [(i, random.Random(i).choice(["a", "b", "a", "cc"])) for i in train]
    held = [i for i in range(100_000, 101_000) if not trains(i)]
    tests = [x + y for x in ["", *letters] for y in letters]
    scored = {r.doc_id: 10 ** r.score for r in mixing.score(table(rows + list(zip(held, tests)))).collect()}
    assert 0 < sum(scored[i] for i, _ in zip(held, tests)) <= 1


def test_known_text_costs_less_than_noise(table):
    rows = list(enumerate(texts(200)))
    rng = random.Random(2)
    held = [i for i in range(1000, 1100) if not trains(i)][:2]
    noise = " ".join("".join(rng.choice("qxzjkw") for _ in range(6)) for _ in range(60))
    got = {r.doc_id: r.bits_per_byte for r in mixing.score(table([*rows, (held[0], rows[0][1] + rows[1][1]), (held[1], noise)])).collect()}
    assert got[held[0]] < 0.6 * got[held[1]]


def test_no_training_rows_and_empty_table(table):
    held = [i for i in range(100) if not trains(i)][0]
    r = mixing.score(table([(held, "a b")])).first()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (True, 3, 0, 0, 0.0) and r.score < 0
    assert mixing.score(table([])).count() == 0


def test_packed_numbers_round_trip():
    from aerolake.llm.blocks import packed, unpacked

    x = np.array([0, 1, 2 ** 31 - 1, 77_777])
    assert (unpacked(packed(x)) == x).all() and len(unpacked(packed([]))) == 0
    assert unpacked(pa.chunked_array([packed(x)]).combine_chunks()).tolist() == x.tolist()


def plain_letter_costs(model, block):
    """Natural log probability of the letters of each text's known tokens, bit by bit; classes and letters are looked up per token."""
    classes, out = mixing.classes_of(block.known), []
    for first, n in zip(block.first, block.per_row):
        tokens = np.array([t for t in range(first, first + n) if classes[block.pos[t]] > 0], dtype=np.int64)
        w, shift, total, stream = np.full((8, mixing.KNOWN), mixing.WEIGHT), np.zeros((8, mixing.HEIGHTS)), 0.0, []
        for t in tokens:
            one = block.letters_of(np.array([t]), classes)
            at, size = block.at[block.pos[t]], block.lengths[block.pos[t]]
            assert one.letter[one.at].tobytes() == block.letters[at:at + size].tobytes() + b" "
            stream += [(int(x), [int(p[i]) for p in one.inside] + [int(one.across[i])]) for i, x in enumerate(one.letter)]
        for step in range(0, len(stream), mixing.LETTER_STEP):
            some = stream[step:step + mixing.LETTER_STEP]
            slope, fix = np.zeros_like(w), np.zeros_like(shift)
            for letter, places in some:
                for b in range(8):
                    node, bit = (1 << b) | letter >> (8 - b), letter >> (7 - b) & 1
                    x = np.array([model.letters[k, (p + node * 40503) % mixing.KNOWN_SLOTS] for k, p in enumerate(places)])
                    logit = float(w[b] @ x)
                    height = int(min(max(logit * 1.5 + mixing.HEIGHTS / 2, 0), mixing.HEIGHTS - 1))
                    p = 1 / (1 + math.exp(-min(max(logit + shift[b, height], -14), 14)))
                    total += math.log(p if bit else 1 - p)
                    slope[b] += (bit - p) * x
                    fix[b, height] += bit - p
            w += mixing.RATE * slope / len(some)
            shift += mixing.MAP_RATE * fix / len(some)
        out.append(total)
    return np.array(out)


def test_letters_of_known_tokens_equal_plain_mixing(table):
    docs = table(list(enumerate(texts(12) + ["", "x" * 300, "a b", None])))
    blocks = mixing.with_answers(mixing.bucketed(mixing.token_blocks(docs)), mixing.training_counts(docs), "n")
    row = blocks.toArrow().combine_chunks()
    counts, letters = mixing.all_counts(blocks, 4)
    model = mixing.Model(counts, 4, 10, 5, {}, letters)
    block = mixing.Block({c: row.column(c).combine_chunks() for c in row.column_names})
    assert np.allclose(model.letter_costs(block), plain_letter_costs(model, block), rtol=2e-3, atol=2e-2)


def test_letter_bits_are_counted_without_a_tokens_own_occurrence(table):
    ids = [i for i in range(100) if trains(i)][:3]
    docs = table([(ids[0], "aa bb"), (ids[1], "bb"), (ids[2], None)])
    blocks = mixing.with_answers(mixing.bucketed(mixing.token_blocks(docs)), mixing.training_counts(docs), "n")
    assert (mixing.all_counts(blocks, 2)[1].sum(axis=(1, 2)) == (2 * 3 + 3) * 8).all()  # bb twice and three ends, each with a blank


def test_known_tokens_of_one_class_are_told_apart_by_contexts(table):
    """a and b are equally frequent; a comes after x, b after y."""
    train = [i for i in range(200) if trains(i)][:60]
    held = [i for i in range(1000, 1100) if not trains(i)][:4]
    tests = ["x a", "x b", "y a", "y b"]
    scored = {r.doc_id: r.score for r in mixing.score(table([(i, "x a" if k % 2 else "y b") for k, i in enumerate(train)] + list(zip(held, tests)))).collect()}
    good, bad, also_bad, also_good = (scored[i] for i in held)
    assert min(good, also_good) > max(bad, also_bad) + 0.3
    assert max(scored[i] for i in held) < 0


def test_counts_in_planes_round_trip():
    x = np.array([0, 1, 255, 2 ** 40 + 3])
    assert (mixing.from_planes(mixing.planes(x)) == x).all()


def test_contexts_are_hashed_once_a_block_and_not_once_a_token(table, monkeypatch):
    docs = table([(1, "aa bb " * 100_000), (2, "bb cc")])
    blocks = mixing.with_answers(mixing.bucketed(mixing.token_blocks(docs)), mixing.training_counts(docs), "n")
    row = blocks.toArrow().combine_chunks()
    block = mixing.Block({c: row.column(c).combine_chunks() for c in row.column_names})
    hashed, mix = [], mixing.mix
    monkeypatch.setattr(mixing, "mix", lambda x: (hashed.append(len(x)), mix(x))[1])
    block.places(mixing.classes_of(block.known)[block.pos])
    assert len(block.pos) > 200_000 and sum(hashed) < 100_000


@pytest.mark.parametrize("weighted", [False, True])
def test_equal_symbols_at_equal_places_are_counted_together(weighted):
    rng = np.random.default_rng(3)
    places, symbol = rng.integers(0, mixing.KNOWN_SLOTS, 50).astype(np.int32)[rng.integers(0, 50, 900)], rng.integers(0, 256, 900) >> rng.integers(0, 8, 900)
    times = rng.integers(1, 1 << 20, 900) if weighted else np.ones(900, dtype=np.int64)
    got, want = np.zeros((2, 2 * mixing.KNOWN_SLOTS), dtype=np.int64)
    mixing.count_bits(got, mixing.bit_steps(8), places, symbol, times if weighted else None)
    mixing.count_bits(got, mixing.bit_steps(8), places[:0], symbol[:0], times[:0] if weighted else None)
    for place, s, n in zip(places, symbol, times):
        for d in range(8):
            node = (1 << d) | int(s) >> (8 - d)
            want[((int(place) + node * 40503) % mixing.KNOWN_SLOTS) * 2 + (int(s) >> (7 - d) & 1)] += n
    assert (got == want).all()


def test_costs_do_not_depend_on_groups_heads_or_batches(table, monkeypatch):
    docs = table(list(enumerate(texts(60) + ["", "x" * 3000, "a b", None])))
    blocks = mixing.with_answers(mixing.bucketed(mixing.token_blocks(docs)), mixing.training_counts(docs), "n")
    row = blocks.toArrow().combine_chunks()
    counts, letters = mixing.all_counts(blocks, 4)
    model = mixing.Model(counts, 4, 10, 5, {}, letters)
    block = mixing.Block({c: row.column(c).combine_chunks() for c in row.column_names})
    want = model.costs(block), model.letter_costs(block)
    for group, head, cells, pieces in [(1, 0, 128, 1 << 17), (500, 40, 1 << 13, 64), (1 << 19, 1 << 18, 256, 1)]:
        monkeypatch.setattr(mixing, "GROUP", group)
        monkeypatch.setattr(mixing, "HEAD", head)
        monkeypatch.setattr(mixing, "CELLS", cells)
        monkeypatch.setattr(mixing, "LETTERS", pieces)
        monkeypatch.setattr(mixing.together, "__defaults__", (cells,))
        assert np.allclose(model.costs(block), want[0], rtol=1e-4) and np.allclose(model.letter_costs(block), want[1], rtol=1e-4)
