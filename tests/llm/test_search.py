"""Benchmark decontamination, archive revisits and token counts against brute force."""

import random

import duckdb
import public_tokenizers
from pyspark.sql import functions as F

from aerolake.llm import decontaminate, queries, token_counts, warc


def edit(p, t):
    """Least edits between p and a substring of t, and the first end of such a one."""
    before, best = list(range(len(p) + 1)), (len(p), 0)
    for i, c in enumerate(t, 1):
        now = [0]
        for j in range(1, len(p) + 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (p[j - 1] != c)))
        before, best = now, min(best, (now[-1], i))
    return best


def test_myers_distance():
    rng = random.Random(5)
    for _ in range(150):
        p, t = ("".join(rng.choice("abc ") for _ in range(rng.randint(1, n))) for n in (90, 160))
        assert decontaminate.best_end(decontaminate.masks_of(p), len(p), t, 0, len(t)) == edit(p, t)


def test_matches_against_brute_force(spark, table, odd_rows):
    rng = random.Random(8)
    pool = ["thon", "the", "er", "ing", "xa"]
    items = [(i, " ".join(rng.choice(pool) for _ in range(rng.randint(8, 20)))) for i in range(8)] + [(20, None), (21, " ."), (22, "")]
    items.append((30, items[0][1]))
    rows = []
    for i in range(120):
        text = list(" ".join(rng.choice(pool) for _ in range(20)) + " " + rng.choice(items[:8])[1].upper() + ", " + "ende")
        for _ in range(rng.randint(0, 6)):
            k = rng.randrange(len(text))
            text[k] = rng.choice(["", "x", "th", text[k]])
        rows.append((i, "".join(text)))
    rows += [(None if i is None else i + 1000, t) for i, t in odd_rows]
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(0))
    df = table(rows)
    want = {(i, j): edit(q, n)[0] for i, t in rows for j, p in items[:8]
            if len(q := decontaminate.normalise(p)) and edit(q, n := decontaminate.normalise(t[:500] if t else t))[0] <= int(0.1 * len(q))}
    found = decontaminate.find(df, benchmark, 0.1).collect()
    assert {(r.doc_id, r.item_id): r.distance for r in found} == want and len(found) == len(want) > 80
    kept = decontaminate.drop(df, benchmark, 0.1)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, _ in rows if i not in {k for k, _ in want})
    assert sum(len(m.items) for m in decontaminate.blocks(benchmark, 0.1, block_chars=100)) == 8
    assert decontaminate.find(table([]), benchmark).count() == 0
    assert decontaminate.find(df, benchmark.limit(0)).count() == 0
    assert decontaminate.drop(df, benchmark.limit(0)).count() == len(rows)


def test_canonical_urls(spark):
    same = ["http://www.A.com:80/x/?b=2&a=1&utm_source=q#f", "https://a.com/x?a=1&b=2", "HTTPS://a.com:443/x/?ref=z&b=2&a=1"]
    rows = spark.createDataFrame([(u,) for u in [*same, None, ""]], "url string").select(warc.canonical(F.col("url"))).collect()
    assert [r[0] for r in rows] == ["a.com/x?a=1&b=2"] * 3 + [None, ""]


def brute_resolve(records):
    for rid, url, ts, kind, digest, headers in records:
        if kind != "revisit":
            continue
        earlier = [r for r in records if r[3] == "response" and r[1] == url is not None and None not in (ts, r[2]) and r[2] < ts]
        if not earlier:
            yield rid, None, "unresolved", None
            continue
        source = max(earlier, key=lambda r: (r[2], r[0]))
        h, s = headers or {}, source[5] or {}
        pairs = [((h.get("etag") or "").removeprefix("W/") or None, (s.get("etag") or "").removeprefix("W/") or None),
                 (h.get("last-modified"), s.get("last-modified")), (digest, source[4])]
        known = [a == b for a, b in pairs if a is not None and b is not None]
        status = ("resolved" if known[0] else "changed") if known else "unverified"
        merged = {**s, **{k: v for k, v in h.items() if k in warc.PERMITTED}}
        yield rid, source[0] if status == "resolved" else None, status, sorted(merged.items()) if status == "resolved" else None


def test_revisits_against_brute_force(spark):
    rng = random.Random(2)
    records = []
    for i in range(500):
        headers = {k: v for k, v in (("etag", rng.choice(['"1"', 'W/"1"', '"2"', None])), ("last-modified", rng.choice(["a", "b", None])),
                                     ("date", str(i)), ("content-type", "t" if rng.random() < 0.5 else None), ("vary", rng.choice(["x", None]))) if v is not None}
        records.append((i, rng.choice(["hot.com/"[:-1], "hot.com", "b.com/p", "c.com", None]), rng.choice([rng.randint(0, 60), rng.randint(0, 60), None]),
                        rng.choice(["response", "revisit", "revisit", "metadata"]), rng.choice(["d1", "d2", None]), rng.choice([headers, headers, None])))
    df = spark.createDataFrame(records, "record_id long, url string, ts long, kind string, digest string, headers map<string,string>").withColumn("slot", F.lit("clash"))
    for slots in (1, 7):
        got = [(r.revisit_id, r.response_id, r.status, r.headers and [(e["key"], e["value"]) for e in r.headers]) for r in warc.resolve(df, slots).collect()]
        assert sorted(got) == sorted(brute_resolve(records))
    assert warc.resolve(df.limit(0)).count() == 0


def test_revisit_query_against_oracle(spark):
    sf = "/root/testdata/sf0.001"
    got = queries.op4_warc_revisits(spark, sf)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{sf}/pages.parquet')")
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({queries.ORACLES['op4_warc_revisits']})").fetchall()
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def best_count(word, pieces, byte_score):
    """Plain dynamic programming over one word: least tokens among the best-scoring segmentations."""
    best = [(0.0, 0)] + [None] * len(word)
    for j in range(1, len(word) + 1):
        found = []
        for i in range(j):
            if word[i:j] in pieces:
                found.append((best[i][0] + pieces[word[i:j]], best[i][1] + 1))
        if word[j - 1] not in pieces:
            n = len(word[j - 1].encode())
            found.append((best[j - 1][0] + n * byte_score, best[j - 1][1] + n))
        best[j] = max(found, key=lambda x: (x[0], -x[1]))
    return best[-1][1]


def test_token_counts_against_plain_programming(table, odd_rows):
    pieces, byte_score = token_counts.load_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    rng = random.Random(3)
    rows = [(i, " ".join("".join(rng.choice("theanonrsé漢ñ1#") for _ in range(rng.randint(1, 14))) for _ in range(rng.randint(0, 60)))) for i in range(40)]
    rows += [(None if i is None else i + 1000, t) for i, t in odd_rows if not t or len(t) < 1000]
    got = sorted((tuple(r) for r in token_counts.count_tokens(table(rows), pieces, byte_score).collect()), key=str)
    split = [(i, [w.decode() for w in (t or "").encode().split()]) for i, t in rows]
    assert got == sorted(((i, len(x), sum(best_count(token_counts.MARK + w, pieces, byte_score) for w in x)) for i, x in split), key=str)
    assert token_counts.count_tokens(table([(1, "x" * 50_000 + " y")]), pieces, byte_score).first().n_words == 2
    assert token_counts.count_tokens(table([]), pieces, byte_score).count() == 0


def test_full_cache_changes_nothing(table, monkeypatch):
    pieces, byte_score = token_counts.load_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    df = table([(i, f"some words {i} and more words {i * i}") for i in range(50)])
    want = sorted(map(tuple, token_counts.count_tokens(df, pieces, byte_score).collect()))
    monkeypatch.setattr(token_counts, "CACHE_WORDS", 3)
    monkeypatch.setattr(token_counts, "CHUNK", 64)
    assert sorted(map(tuple, token_counts.count_tokens(df, pieces, byte_score).collect())) == want


def test_a_very_long_text_of_one_letter():
    item = "a" * 128 + "b"
    matcher = decontaminate.Matcher([(1, item)])
    assert matcher.hits("a" * 200_000) == {0: (1, 128)}
    assert decontaminate.Matcher([(1, "ab" * 60)]).hits("a" * 1_000_000) == {}
