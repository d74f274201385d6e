import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from aerolake.llm import bpe


@pytest.fixture(scope="module")
def ranks():
    return bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts(n):
    rng = random.Random(3)
    letters = [chr(rng.choice([rng.randint(32, 126), rng.randint(0x80, 0x2FF), rng.randint(0x370, 0x1FFF), rng.randint(0x3000, 0xD7FF), rng.randint(0x1F300, 0x1F6FF)])) for _ in range(2000)]
    letters += list(" \n\t\r\x0b\x0c\x85\xa0 　\x1c\x1f'  st") * 60
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(n)] + ["'s 'S 're don't I'LL x\n\n\n y", "tokens repeat tokens repeat"]


@pytest.mark.parametrize("max_words", [1, 300])
def test_ids_and_round_trip(table, odd_rows, ranks, library, max_words):
    rows = [*enumerate(texts(300)), *((None if i is None else i + 1000, t) for i, t in odd_rows)]
    encoded = bpe.encode(table(rows), ranks, public_tokenizers.PATTERN, max_words)
    got = sorted((tuple(r) for r in bpe.digest(bpe.decode(encoded, ranks)).collect()), key=str)
    want = []
    for i, t in rows:
        ids = library.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)


def test_characters_newer_than_the_jvm(table, ranks, library):
    text = "\U00031350\U00031351's x"  # letters since Unicode 15
    assert bpe.encode(table([(1, text)]), ranks, public_tokenizers.PATTERN).first().ids == library.encode_ordinary(text)


def test_both_folds_agree(spark, ranks):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdeé ñ12!\U0001f600") for _ in range(rng.randint(1, 24))) for _ in range(300)]
    df = spark.createDataFrame([(w,) for w in words], "word string")
    got = df.select("word", bpe.fold_merges(df.word, bpe.rank_literal(ranks)).alias("ids")).collect()
    assert all(r.ids == bpe.fold_rare(r.word.encode(), ranks) for r in got)


def test_many_words_fold_like_one(ranks):
    rng = random.Random(4)
    words = [rng.randbytes(rng.randint(1, 40)) for _ in range(3000)] + [bytes(rng.choice(b"aab \xc3\xa9") for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    words += list(ranks)[::7]
    merges = bpe.merges_of(ranks)
    got = [list(memoryview(ids).cast("i")) for ids in bpe.fold_words(words, ranks, merges)]
    assert got == [bpe.fold_rare(w, ranks) for w in words]
    assert bpe.fold_words([], ranks, merges) == []


def test_pieces_that_merges_miss_and_unknown_bytes():
    """b"cab" can't be reached: b"ab" is joined before b"ca"; bytes other than a, b, c have no id."""
    few = {b"a": 0, b"b": 1, b"c": 2, b"ab": 3, b"ca": 4, b"abab": 5, b"xyz": 6, b"zz": 7}
    merges = bpe.merges_of(few)
    words = [b"cab", b"abab", b"ababab", b"ccaab", b"xyz", b"azza", b"zzz"[:2]]
    assert [list(memoryview(ids).cast("i")) for ids in bpe.fold_words(words, few, merges)] == [bpe.fold_rare(w, few) for w in words]
    with pytest.raises(KeyError):
        bpe.fold_words([b"azb"], few, merges)


def test_long_word_folds_in_time(ranks, library):
    word = "ab1"[:2] * 20_000
    assert bpe.fold_rare(word.encode(), ranks) == library.encode_ordinary(word)


def test_empty_table(table, ranks):
    assert bpe.digest(bpe.decode(bpe.encode(table([]), ranks, public_tokenizers.PATTERN), ranks)).count() == 0


def test_production_path_takes_very_long_words(table, ranks, library):
    """Few distinct words, so that all of them are frequent; the long ones must not enter the fold by functions."""
    rows = [(1, "x" * 70_000), (2, "ab" * 500_000), (3, None), (4, "plain words, plain words"), (4, "plain words, plain words"), (5, "é" * 16 + " " + "é" * 17)]
    got = {r.doc_id: r.ids for r in bpe.encode(table(rows), ranks, public_tokenizers.PATTERN).collect()}
    assert got == {i: library.encode_ordinary(t or "") for i, t in rows}


def test_cut_of_frequent_words_keeps_within_the_bound(table):
    rows = [(i, " ".join(f"w{j}" for j in range(i))) for i in range(60)]
    for most in (1, 5, 20, 1000):
        assert bpe.frequent_words(table(rows), public_tokenizers.PATTERN, most).count() <= most
    assert bpe.frequent_words(table(rows), public_tokenizers.PATTERN, 1000).count() == 2 + 59


def test_unknown_ids_fail(spark, ranks):
    for ids in ([1, 60_000], [-1]):
        with pytest.raises(Exception):
            bpe.decode(spark.createDataFrame([(1, ids)], "doc_id long, ids array<int>"), ranks).collect()


def test_one_worker_encodes_and_decodes(table, odd_rows, ranks):
    docs = table([*odd_rows, *enumerate(texts(40)), (5, "\U00031350\U00031351's x")])
    both = bpe.encode_and_decode(docs, ranks, public_tokenizers.PATTERN, 50)
    assert both._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    apart = bpe.decode(bpe.encode(docs, ranks, public_tokenizers.PATTERN, 50), ranks)
    assert sorted(map(tuple, both.collect()), key=str) == sorted(map(tuple, apart.collect()), key=str)
    assert bpe.encode_and_decode(table([]), ranks, public_tokenizers.PATTERN).count() == 0
