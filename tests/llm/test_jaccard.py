import random
import re

import pytest

from aerolake.llm import jaccard
from aerolake.llm.components import connected_components


def sets_of(rows):
    for _, t in rows:
        x = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        yield {tuple(x[k:k + 5]) for k in range(len(x) - 4)} if len(x) >= 5 else ({tuple(x)} if x else set())


def brute(rows):
    sets, parent = list(sets_of(rows)), list(range(len(rows)))

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                parent[root(a)] = root(b)
    low = {}
    for a, (i, _) in enumerate(rows):
        if i is not None:
            low[root(a)] = min(low.get(root(a), i), i)
    return sorted([(i, len(sets[a]), low.get(root(a)) if sets[a] else i) for a, (i, _) in enumerate(rows)], key=str)


def variants(seed, n, letters="abcdefghijkl"):
    rng = random.Random(seed)
    base = [[rng.choice(letters) for _ in range(rng.randint(3, 60))] for _ in range(max(2, n // 25))]
    for i in range(n):
        x = list(rng.choice(base))
        for _ in range(rng.choice([0, 1, 1, 2, 3, 6])):
            k = rng.randrange(len(x))
            x[k:k + 1] = rng.choice([[], [f"z{rng.randint(0, 9)}"], [x[k], "Q"]])
            x = x or ["a"]
        yield (i // 2 if i % 41 == 0 else i, " ".join(x) if i % 31 else rng.choice([None, "", " \n"]))


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(table, odd_rows, seed):
    rows = [*variants(seed, 300), *odd_rows]
    assert sorted((tuple(r) for r in jaccard.join(table(rows)).collect()), key=str) == brute(rows)


def test_chains_and_many_variants(table):
    """One family whose neighbours link while its ends don't, and lists that only leaders' bounds can settle."""
    words = [f"w{i}" for i in range(160)]
    rows = [(i, " ".join(words[i * 2:i * 2 + 100])) for i in range(30)] + [(100 + i, " ".join(words[:60] + [f"v{i}"] + words[60:90])) for i in range(40)]
    assert sorted((tuple(r) for r in jaccard.join(table(rows)).collect()), key=str) == brute(rows)


def all_links(rows):
    sets = list(sets_of(rows))
    return [(a, b) for a in range(len(rows)) for b in range(a) if 100 * len(sets[a] & sets[b]) >= 80 * max(1, len(sets[a] | sets[b]))]


@pytest.mark.parametrize("block", [2, 128])
def test_every_link_counts(table, odd_rows, monkeypatch, block):
    """A family of near copies under few leaders, copies of rows, and chains: links inside a component count as well."""
    monkeypatch.setattr(jaccard, "BLOCK", block)
    words = [f"w{i}" for i in range(120)]
    family = [" ".join(words[:i] + [f"v{i}"] + words[i + 1:]) for i in range(0, 120, 4)]
    texts = [*family, *family[:3], *(" ".join(words[i:i + 90]) for i in range(0, 30, 2)), *(t for _, t in variants(7, 100)), *(t for _, t in odd_rows)]
    rows = list(enumerate(texts))
    expected = [0] * len(rows)
    for a, b in all_links(rows):
        expected[a] += 1
        expected[b] += 1
    got = jaccard.counted(table(rows))
    assert got.columns == ["doc_id", "n_shingles", "component_id", "n_links"]
    assert {r.doc_id: r.n_links for r in got.collect()} == dict(enumerate(expected))
    nodes = jaccard.rows_with_nodes(table(rows).select("doc_id", "text"), jaccard.SHINGLE)
    node = {r.doc_id: r.node for r in nodes.collect()}
    pairs = [(r.a, r.b) for r in jaccard.links(table(rows), nodes).collect()]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {(min(node[a], node[b]), max(node[a], node[b])) for a, b in all_links(rows) if node[a] != node[b]}


def test_small_blocks_give_the_same(table, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 2)
    rows = list(variants(5, 150, "abc"))
    assert sorted((tuple(r) for r in jaccard.join(table(rows)).collect()), key=str) == brute(rows)


def test_one_of_each(table, odd_rows):
    rows = [*enumerate(t for _, t in variants(3, 120)), *((i if i is None else i + 1000, t) for i, t in odd_rows)]
    stay = jaccard.one_of_each(table(rows))
    assert stay.columns == table(rows).columns
    kept = [(r.doc_id, r.text) for r in stay.collect()]
    sets = list(sets_of(rows))
    assert sorted(str(i) for i, t in kept if next(sets_of([(i, t)]))) == sorted(str(c) for c in {c for i, n, c in brute(rows) if n})
    assert len([1 for i, t in kept if not next(sets_of([(i, t)]))]) == sum(not s for s in sets)


def test_empty_table(table):
    assert jaccard.join(table([])).count() == 0
    assert jaccard.one_of_each(table([])).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 64)] + [(100, 102), (102, 101), (200, 200)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(65)}, 100: 100, 101: 100, 102: 100, 200: 200}
