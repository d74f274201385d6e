"""Toxicity, quality classifier and quality rules: held-out accuracy, edge cases, brute force where there is one."""

import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from aerolake.llm import quality_rules, quality_trees, toxicity
from aerolake.llm.text import chunks, covered, split_words, table as read, window_hashes, word_hashes

SF = "/root/testdata/sf0.01"


def chunk_of(texts):
    return next(iter(chunks(pa.array(texts))))


def test_words_and_hashes():
    texts = ["a b\tc", None, "", " x\x0b y ", "é　漢 b"]
    chunk = chunk_of(texts)
    words = split_words(chunk)
    got = [[chunk.data[s:e].tobytes() for s, e in zip(words.start[a:b], words.end[a:b])] for a, b in zip(words.first, words.first[1:])]
    assert got == [(t or "").encode().split() for t in texts]
    hashes = word_hashes(chunk.data, words.start, words.end, block=3)
    assert (hashes == word_hashes(chunk.data, words.start, words.end)).all()
    named = dict(zip(hashes.tolist(), (w for g in got for w in g)))
    assert len(named) == len({w for g in got for w in g})
    many = np.array([1, 2, 3, 1, 2, 3, 1], dtype=np.uint64)
    for width in range(1, 8):
        h = window_hashes(many, width)
        assert [[h[i] == h[j] for i in range(len(h))] for j in range(len(h))] == [
            [(many[i:i + width] == many[j:j + width]).all() for i in range(len(h))] for j in range(len(h))]
    assert covered(np.array([1, 4]), 2, 5).tolist() == [False, True, True, False, True]


@pytest.mark.parametrize("op, column, cut", [(toxicity, "toxic", 0.5), (quality_trees, "quality", 0.3)])
def test_held_out_accuracy(spark, op, column, cut):
    docs, labels = read(spark, SF, "documents"), read(spark, SF, "labels")
    rows = op.score(docs, op.fit(docs, labels)).collect()
    y = {r.doc_id: r[column] for r in labels.collect()}
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= cut) for r in rows)
    right = [r.predicted == y[r.doc_id] for r in rows if r.held_out and r.doc_id in y]
    assert len(right) > 40 and np.mean(right) > 0.95


@pytest.mark.parametrize("op, column", [(toxicity, "toxic"), (quality_trees, "quality")])
def test_odd_rows_and_no_labels(spark, table, odd_rows, op, column):
    df = table(odd_rows)
    labels = spark.createDataFrame([(1, 1, "z"), (1, 0, "z"), (2, None, "z"), (None, 1, "z")], f"doc_id long, {column} int, text string")
    for some in (labels, labels.limit(0)):
        model = op.fit(df, some)
        got = op.score(df, model).collect()
        assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in odd_rows)
        assert all(0 <= r.score <= 1 for r in got) and all(not r.held_out for r in got if r.doc_id is None)
        assert op.score(table([]), model).count() == 0


def test_labels_of_the_held_out_fold_are_not_learnt(spark):
    labels = spark.createDataFrame([(i, 1) for i in range(200)], "doc_id long, toxic int")
    ids = {r.doc_id for r in quality_trees.sample_labels(labels, "toxic", 1000).collect()}
    assert ids == {i for i in range(200) if zlib.crc32(str(i).encode()) % 5}
    assert quality_trees.sample_labels(labels, "toxic", 7).count() == 7


def features(text):
    row, bucket, count = toxicity.row_features(chunk_of([text]))
    return bucket.astype(np.int32), count.astype(np.int32)


def test_counterfactual_penalty_closes_the_gap():
    """Toxic examples mention one group more often; its neutral mention must not score higher for that."""
    rng = random.Random(4)
    noise = [f"word{i}" for i in range(60)]
    rows = []
    for i in range(600):
        y = i % 2
        group = "muslim" if rng.random() < (0.8 if y else 0.2) else "christian"
        rows.append((y, *features(" ".join(rng.sample(noise, 8) + [group] + (["idiot"] if y and rng.random() < 0.7 else [])))))
    gaps = {}
    for fairness in (0.0, 20.0):
        model = toxicity.train(rows, fairness=fairness)
        s = model.scores(chunk_of([f"the {g} man reads word1" for g in ("muslim", "christian")] + ["you idiot"]))
        gaps[fairness] = abs(s[0] - s[1])
        assert s[2] > 0.9
    assert gaps[0.0] > 0.3 and gaps[20.0] < 0.05


def test_counterfactuals_change_the_right_counts():
    (touched, change), = [c for c in toxicity.counterfactuals([features("femmes femmes et")]) if len(c[0])]
    b = toxicity.term_buckets(["femmes", "hommes"])
    moved = dict(zip(touched.tolist(), change.tolist()))
    assert moved[int(b[0, 0])] == pytest.approx(-np.log(3)) and moved[int(b[0, 1])] == pytest.approx(np.log(3))


def test_forest_walk_equals_row_by_row():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, len(quality_trees.FEATURES)))
    y = (x[:, 0] + x[:, 1] ** 2 > 0.5).astype(float)
    forest = quality_trees.grow(x, y, trees=20)
    inner = forest.feature.shape[1]
    for row, logit in zip(x[:50], forest.logits(x[:50])):
        total = forest.base
        for feature, cut, leaf in zip(forest.feature, forest.cut, forest.leaf):
            k = 0
            while k < inner:
                k = 2 * k + 1 + int(row[feature[k]] > cut[k])
            total += leaf[k - inner]
        assert total == pytest.approx(logit)
    assert ((forest.scores(x) > 0.5) == (y == 1)).mean() > 0.95


def base_figures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines, seen, again = (text or "").split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    windows = {}
    for k in range(len(words) - 7):
        windows.setdefault(tuple(words[k:k + 8]), []).append(k)
    hit = {j for at in windows.values() if len(at) > 1 for k in at for j in range(k, k + 8)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), again, len(hit))


def test_quality_rule_base(spark, table, odd_rows):
    rng = random.Random(6)
    rows = [(i, "".join(rng.choice(["a ", "b ", "ab ", "a b c d e f g h ", "x\n", "\n", "a b c d e f g h\n", "é# ", " | "]) for _ in range(rng.randint(0, 80)))) for i in range(150)]
    rows += [(None if i is None else i + 1000, t) for i, t in odd_rows]
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)], "doc_id long, quality int")
    got = quality_rules.judge(table(rows), labels).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert sorted(((r.doc_id, *(r[c] for c in names)) for r in got), key=str) == sorted(((i, *base_figures(t)) for i, t in rows), key=str)
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert r.kept == (not r.base_failed and r.score >= quality_rules.THRESHOLD)
    assert all(r.score == 0 for r in quality_rules.judge(table(rows), labels.limit(0)).collect())
    assert quality_rules.judge(table([]), labels).count() == 0


def test_ratio_against_plain_counting(spark, table):
    rows = [(1, "a b a"), (2, "b c"), (3, None)]
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    buckets = 64
    ratios = quality_rules.log_ratios(table(rows), labels, buckets)

    def grams(text):
        chunk = chunk_of([text])
        words = split_words(chunk)
        return quality_rules.gram_buckets(words, word_hashes(chunk.data, words.start, words.end), buckets)[1]

    raw = np.bincount(np.concatenate([grams("a b a"), grams("b c")]), minlength=buckets)
    good = np.bincount(grams("a b a"), minlength=buckets)
    p = (raw + 1) / (raw.sum() + buckets)
    assert np.allclose(ratios, np.log((good + buckets * p) / (good.sum() + buckets)) - np.log(p))


def test_every_trusted_document_counts(spark):
    docs = spark.range(30_000).selectExpr("id AS doc_id", "concat('w', pmod(hash(id), 90), ' v', pmod(id, 7)) AS text")
    labels = docs.selectExpr("doc_id", "1 AS quality")
    buckets = 64
    raw = np.zeros(buckets)
    for bucket, n in quality_rules.gram_counts(docs, buckets).collect():
        raw[bucket] = n
    p = (raw + 1) / (raw.sum() + buckets)
    assert np.allclose(quality_rules.log_ratios(docs, labels, buckets), np.log((raw + buckets * p) / (raw.sum() + buckets)) - np.log(p))


def test_quality_rules_keep_clean_documents(spark):
    docs, labels = read(spark, SF, "documents"), read(spark, SF, "labels")
    y = {r.doc_id: r.quality for r in labels.collect()}
    rows = [r for r in quality_rules.judge(docs, labels).collect() if r.doc_id in y and not r.base_failed]
    assert np.mean([r.kept for r in rows if y[r.doc_id] == 1]) > 0.98
    assert np.mean([r.kept for r in rows if y[r.doc_id] == 0]) < 0.1


def test_score_and_verdict_of_each_document(spark, table):
    """Scores by plain counting of every document's uni- and bigrams."""
    rng = __import__("random").Random(3)
    words = [f"w{i}" for i in range(60)] + ["é", "#x"]
    rows = [(i, " ".join(rng.choice(words[:30] if i % 3 else words) for _ in range(rng.randint(0, 60)))) for i in range(90)] + [(200, None), (7, "again " * 30)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(0, 80)] + [(None, 1)], "doc_id long, quality int")
    trusted = {i for i in range(80) if i % 3}
    grams = {}
    for k, (_, text) in enumerate(rows):
        chunk = chunk_of([text])
        split = split_words(chunk)
        grams[k] = quality_rules.gram_buckets(split, word_hashes(chunk.data, split.start, split.end), quality_rules.BUCKETS)[1].tolist()
    raw, good = {}, {}
    for k, (i, _) in enumerate(rows):
        for b in grams[k]:
            raw[b] = raw.get(b, 0) + 1
            good[b] = good.get(b, 0) + (i in trusted)
    n_raw, n_good, size = sum(raw.values()), sum(good.values()), quality_rules.BUCKETS
    want = []
    for k, (i, text) in enumerate(rows):
        score = 0.0
        for b in grams[k]:
            p = (raw[b] + 1) / (n_raw + size)
            score += np.log((good[b] + size * p) / (n_good + size)) - np.log(p)
        score /= max(1, len(grams[k]))
        n, _, _, _, again = base_figures(text)
        want.append((i, round(score, 9), not (n < 20 or 100 * again > 30 * n) and score >= quality_rules.THRESHOLD))
    got = [(r.doc_id, round(r.score, 9), r.kept) for r in quality_rules.judge(table(rows), labels).collect()]
    assert [g[0] for g in sorted(got)] == [w[0] for w in sorted(want)]
    for g, w in zip(sorted(got), sorted(want)):
        assert abs(g[1] - w[1]) < 1e-6 and (g[2] == w[2] or abs(w[1] - quality_rules.THRESHOLD) < 1e-6)


@pytest.mark.parametrize("op", [toxicity, quality_trees])
def test_an_id_on_many_rows_is_one_row_of_the_fit(spark, op):
    docs = read(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    labels = read(spark, "/root/testdata/sf0.001", "labels")
    one = labels.filter("crc32(cast(cast(doc_id as string) as binary)) % 5 <> 0").join(docs, "doc_id").select("doc_id", "text").limit(1)
    many = docs.unionAll(one.crossJoin(spark.range(20_000)).select("doc_id", "text"))
    plain = {r.doc_id: r.score for r in op.score(docs, op.fit(docs, labels)).collect()}
    assert {r.doc_id: r.score for r in op.score(docs, op.fit(many, labels)).collect()} == pytest.approx(plain)


def test_word_hashes_equal_their_polynomials():
    from aerolake.llm.text import BYTE_CODES, mix

    words = [b"a", b"the", b"x" * 40_000, b"\xff\x00z", b"the"]
    data = np.frombuffer(b" ".join(words), dtype=np.uint8)
    start = np.cumsum([0, *(len(w) + 1 for w in words[:-1])])
    end = start + [len(w) for w in words]
    want = [(sum(int(BYTE_CODES[c]) * pow(0x9E3779B97F4A7C15, i + 1, 1 << 64) for i, c in enumerate(w)) + len(w)) % 2 ** 64 for w in words]
    assert word_hashes(data, start, end).tolist() == word_hashes(data, start, end, block=5).tolist() == mix(np.array(want, dtype=np.uint64)).tolist()
