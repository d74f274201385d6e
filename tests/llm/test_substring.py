import hashlib
import random
import re

import pytest

from aerolake.llm import substring


def brute(rows, w):
    owner, out = {}, []
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    for i, x in split:
        for k in range(len(x) - w + 1 if i is not None else 0):
            key = tuple(x[k:k + w])
            owner[key] = min(owner.get(key, i), i)
    for i, x in split:
        gone = set()
        for k in range(len(x) - w + 1 if i is not None else 0):
            if owner[tuple(x[k:k + w])] < i:
                gone |= set(range(k, k + w))
        left = " ".join(y for k, y in enumerate(x) if k not in gone)
        out.append((i, len(x), len(gone), hashlib.sha256(left.encode()).hexdigest()))
    return sorted(out, key=str)


def passages(seed, n):
    rng = random.Random(seed)
    shared = [[rng.choice("abcdefgh") for _ in range(rng.randint(10, 60))] for _ in range(6)]
    for i in range(n):
        x = []
        for _ in range(rng.randint(0, 5)):
            x += rng.choice(shared)[rng.randint(0, 5):] if rng.random() < 0.5 else [rng.choice("abcdefghijk") for _ in range(rng.randint(1, 30))]
        yield (i // 2 if i % 41 == 0 else i, " ".join(x) if i % 31 else None)


@pytest.mark.parametrize("window", [10, 13])
def test_against_brute_force(table, odd_rows, window):
    rows = [*passages(window, 200), *odd_rows, (7, "a " * 300), (900, "a " * 300), (901, "b " + "a " * 100)]
    got = substring.digest(substring.remove(table(rows), window)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, window)


def test_intervals_are_maximal(table):
    text = " ".join(f"w{i}" for i in range(60))
    rows = {r.doc_id: r.removal for r in substring.remove(table([(1, text), (2, "x " + text + " y"), (3, text[:100])]), 50).collect()}
    assert rows[1] == [] and rows[3] == []
    assert [(r["first"], r["after"]) for r in rows[2]] == [(1, 61)]


def test_empty_table(table):
    assert substring.digest(substring.remove(table([]))).count() == 0


def test_very_many_copies_of_a_row(table):
    """Copies under one id and under many: work follows the rows, not the pairs of them."""
    words = [f"w{i % 97}x{i % 13}" for i in range(300)]
    text, near = " ".join(words), " ".join([*words[:150], "other", *words[151:]])
    rows = [(5, text)] * 6000 + [(i, text) for i in range(100, 4100)] + [(7, near)] * 2000
    got = {}
    for r in substring.digest(substring.remove(table(rows))).collect():
        got.setdefault(r.doc_id, set()).add((r.n_words, r.n_removed))
    assert got.pop(5) == {(300, 0)} and got.pop(7) == {(300, 299)}
    assert all(v == {(300, 300)} for v in got.values()) and len(got) == 4000


def test_a_task_of_the_result_holds_two_python_workers(table):
    """One that picks rows by text, one that digests; an executor's memory is shared by the workers of all its tasks."""
    plan = substring.digest(substring.remove(table([(1, "a " * 60), (2, "a " * 60)])))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 3  # both parts of the rows, and the digests of their union


def test_intervals_equal_masks(spark):
    rng = random.Random(3)
    rows = [(i % 50, i, [(a, a + rng.randint(0, 8)) for a in rng.sample(range(60), rng.randint(1, 9))]) for i in range(300)]
    spans = spark.createDataFrame(rows, "doc_id long, copy long, spans array<struct<first:int,last:int>>").repartition(3)
    got = {r.copy: [tuple(x) for x in r.removal] for r in substring.intervals(spans, 5).collect()}
    for _, copy, mine in rows:
        gone = {k for a, b in mine for k in range(a, b + 5)}
        assert got[copy] == list(zip(sorted(k for k in gone if k - 1 not in gone), sorted(k + 1 for k in gone if k + 1 not in gone)))
