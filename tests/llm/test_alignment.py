import bisect
import hashlib
import random
from collections import Counter

import public_tokenizers as P
import pytest
import sentencepiece
import tokenizers

from aerolake.llm import alignment


@pytest.fixture(scope="module")
def both():
    return alignment.load(P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def whole():
    """Groups and links of a whole text by the libraries, without units, dictionaries or Spark; None without tokens."""
    a_side = tokenizers.Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    piece = {i: p for p, i in a_side.get_vocab().items()}
    letters = alignment.byte_of_letter()

    def run(text):
        if not text:
            return None
        a, b = a_side.encode(" " + text, add_special_tokens=False).ids, b_side.encode(text)
        x = [bytes(letters[c] for c in piece[i]) for i in a]
        y = [bytes([int(b_side.id_to_piece(i)[3:5], 16)]) if b_side.is_byte(i) else b_side.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not b"".join(x) == b"".join(y) == (" " + text).encode():
            return None
        ends_x, ends_y = [0], [0]
        for t in x:
            ends_x.append(ends_x[-1] + len(t))
        for t in y:
            ends_y.append(ends_y[-1] + len(t))
        common = sorted(set(ends_x) & set(ends_y))
        groups = []
        for lo, hi in zip(common, common[1:]):
            one, two = (v[bisect.bisect_left(e, lo):bisect.bisect_left(e, hi)] for v, e in ((a, ends_x), (b, ends_y)))
            groups.append(",".join(map(str, one)) + "|" + ",".join(map(str, two)))
        links, j = [], 0
        for i in range(len(a)):
            while ends_y[j + 1] <= ends_x[i]:
                j += 1
            k = j
            while k < len(b) and ends_y[k] < ends_x[i + 1]:
                links.append((a[i], b[k]))
                k += 1
        return len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()

    return run


def expected(rows, whole):
    found = [(i, whole(t)) for i, t in rows]
    count = Counter(p for _, f in found if f for p in set(f[3]))
    top = {}
    for (a, _), n in count.items():
        top[a] = max(top.get(a, 0), n)
    return [(i, 0, 0, 0, 0, 0, 0, "") if f is None else
            (i, f[0], f[1], f[2], len(f[3]), sum(count[p] == top[p[0]] for p in f[3]), sum(count[p] for p in f[3]), f[4]) for i, f in found]


def texts():
    rng = random.Random(8)
    bits = ["the", " ", "  ", "\n", "\t", "né", "漢字", " ", " ", "\x85", "▁", "<s>", "<|endoftext|>", "<0x41>", "'s", "12", "!", "\U0001f600", "Straße", ".", "ing", "é ", "\x00", "ﬁ"]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(0, 25))) for _ in range(300)]


@pytest.mark.parametrize("block", [alignment.BLOCK_BYTES, 2000])
def test_equals_whole_texts(table, odd_rows, both, whole, block):
    rows = [*enumerate(texts()), *((None if i is None else i + 1000, t) for i, t in odd_rows), (5000, "same text"), (5001, "same text")]
    got = [tuple(r) for r in alignment.figures(table(rows), both, block).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()]
    assert sorted(got, key=str) == sorted(expected(rows, whole), key=str)


def test_little_memory_changes_nothing(table, both, whole, monkeypatch):
    monkeypatch.setattr(alignment, "CACHE_UNITS", 5)
    rows = list(enumerate(texts()[:60]))
    got = [tuple(r) for r in alignment.figures(table(rows), both, 500).collect()]
    assert sorted(r[:5] for r in got) == sorted(r[:5] for r in expected(rows, whole))


def test_vocabulary_with_blanks_inside_takes_whole_texts(table, both, whole):
    alike = alignment.Tokenizers(*both.files)
    alike.load()
    assert alike.splits
    alike.splits = False
    rows = list(enumerate(texts()[:40]))
    assert alike.both([b" a b"])[0][:2] == both.both([b" a b"])[0][:2]
    got = alignment.figures(table(rows), both).select("n_a").collect()
    assert sum(r.n_a for r in got) == sum(e[1] for e in expected(rows, whole))


def test_empty_and_wordless_tables(table, both):
    assert alignment.figures(table([]), both).count() == 0
    assert [tuple(r) for r in alignment.figures(table([(1, None), (2, "")]), both).collect()] == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]
