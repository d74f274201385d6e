import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest

import __spark_entry__
from aerolake.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, value long, rank int, block long"


def brute(rows, min_docs, top):
    groups, docs = defaultdict(Counter), defaultdict(lambda: defaultdict(int))
    for text, lang, source in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        groups[lang or "", source or ""].update(words)
        for w in set(words):
            docs[lang or ""][w] += 1
    out = []
    for lang in {g[0] for g in groups}:
        kept = {w for w, n in docs[lang].items() if n >= min_docs}
        mine = {s: Counter({w: n for w, n in c.items() if w in kept}) for (x, s), c in groups.items() if x == lang}
        whole = sum(mine.values(), Counter())

        def shares(c):
            return {w: 1 + 10 ** 9 * (c[w] + 1) // (sum(c.values()) + len(kept)) for w in kept}

        p, q = {s: shares(c) for s, c in mine.items()}, shares(whole)
        for s in mine:
            pairs = [(sum((p[s][w] - p[o][w]) ** 2 // p[o][w] for w in kept), o) for o in mine if o != s]
            terms = [((p[s][w] - q[w]) ** 2 // q[w], w) for w in kept if mine[s][w] and p[s][w] > q[w]]
            for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(found[:limit])]
    return sorted(out)


def some_rows():
    rng = random.Random(4)
    words = ["the", "The", "né", "漢字", "a", "b1c", "x-y", "\x85", "Straße"] + [f"w{chr(97 + i)}" for i in range(20)]
    rows = [(" ".join(rng.choice(words) for _ in range(rng.randint(0, 30))), rng.choice(["en", "de", None, ""]), rng.choice(["s0", "s0", "s0", "s1", "é", None])) for _ in range(80)]
    return rows + [(None, "en", "none"), ("", "xx", "alone"), ("one two", "yy", "a"), ("one two", "yy", "b"), ("z" * 70_000, "en", "s1"), ("the " * 30_000, "en", "s2")] + [("copy of a row", "en", "s3")] * 4


@pytest.mark.parametrize("groups, terms", [(16, 4096), (2, 5)])
def test_equals_brute_force(spark, groups, terms):
    rows = some_rows()
    docs = spark.createDataFrame([(i, *r, 1, 2, 3) for i, r in enumerate(rows)], SCHEMA)
    got = sorted(tuple(r) for r in divergence.audit(docs, top=7, groups=groups, terms=terms).collect())
    assert got == brute(rows, 3, 7)


def test_scaled_shares_stay_exact():
    import numpy as np

    rng = random.Random(1)
    for _ in range(200):
        whole = rng.randint(1, 9 * 10 ** 15)
        part = rng.randint(0, whole)
        assert divergence.scaled(np.array([part]), np.array([whole]))[0] == 10 ** 9 * part // whole


def test_empty_table(spark):
    assert divergence.audit(spark.createDataFrame([], SCHEMA)).count() == 0


def test_oracle(spark):
    folder = "/root/testdata/sf0.001"
    duckdb_ = duckdb.connect()
    duckdb_.sql(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    want = duckdb_.sql(__spark_entry__.oracle_sql()["op11_source_divergence"]).fetchall()
    frame = __spark_entry__.queries()["op11_source_divergence"](spark, folder)
    assert frame.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, frame.collect())) == sorted(want)
