"""Registered queries of the training-data operators and, where SQL can say them, their oracles."""

from __future__ import annotations

import public_tokenizers

from . import alignment, bpe, decontaminate, divergence, jaccard, mixing, quality_rules, quality_trees, secrets, substring, token_counts, toxicity, warc
from .text import table


def op1_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op2_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return quality_trees.score(docs, quality_trees.fit(docs, table(spark, sf_dir, "labels")))


def op3_secret_scan(spark, sf_dir):
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents")))


def op4_warc_revisits(spark, sf_dir):
    return warc.digest_columns(warc.resolve(warc.records_of(table(spark, sf_dir, "pages").select("page_id", "url", "html"))))


def op5_decontamination(spark, sf_dir):
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_substring_dedup(spark, sf_dir):
    return substring.digest(substring.remove(table(spark, sf_dir, "documents")))


def op7_byte_bpe(spark, sf_dir):
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.digest(bpe.encode_and_decode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN))


def op8_quality_rules(spark, sf_dir):
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_jaccard_join(spark, sf_dir):
    return jaccard.join(table(spark, sf_dir, "documents"))


def op9_jaccard_links(spark, sf_dir):
    return jaccard.counted(table(spark, sf_dir, "documents"))


def op10_token_counts(spark, sf_dir):
    pieces, byte_score = token_counts.load_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), pieces, byte_score)


def op11_source_divergence(spark, sf_dir):
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_token_alignment(spark, sf_dir):
    both = alignment.load(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return alignment.figures(table(spark, sf_dir, "documents"), both)


def op13_lm_scoring(spark, sf_dir):
    return mixing.score(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_secret_scan": op3_secret_scan,
    "op4_warc_revisits": op4_warc_revisits,
    "op5_decontamination": op5_decontamination,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_quality_rules": op8_quality_rules,
    "op9_jaccard_join": op9_jaccard_join,
    "op9_jaccard_links": op9_jaccard_links,
    "op10_token_counts": op10_token_counts,
    "op11_source_divergence": op11_source_divergence,
    "op12_token_alignment": op12_token_alignment,
    "op13_lm_scoring": op13_lm_scoring,
}
ORACLES: dict[str, str] = {
    "op4_warc_revisits": r"""
        WITH p AS (SELECT page_id, url, sha1(html) AS digest, length(html) AS size, page_id % 28 AS d FROM pages),
        spelt AS (SELECT *, 'HTTPS://WWW.' || regexp_replace(regexp_replace(url, '^https?://(www[.])?', ''), '#.*$', '')
                            || CASE WHEN contains(url, '?') THEN '&utm_medium=x' ELSE '?utm_medium=x' END || '#part' AS other FROM p),
        revisits AS (
            SELECT page_id * 4 AS id, url, page_id - 10000000 AS ts, NULL AS tag, 'day ' || d AS modified, 0 AS step FROM p WHERE page_id % 5 = 0
            UNION ALL SELECT page_id * 4 + 2, other, page_id + 10000000, '"' || digest[1:12] || '"', NULL, 2 FROM spelt
            UNION ALL SELECT page_id * 4 + 3, url, page_id + 20000000, CASE WHEN page_id % 7 = 0 THEN '"other"' ELSE '"' || digest[1:12] || '"' END, NULL, 3 FROM p),
        parts AS (
            SELECT id, page_id, ts, regexp_replace(regexp_replace(url, '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare
            FROM (SELECT id, CAST(NULL AS BIGINT) AS page_id, ts, url FROM revisits UNION ALL SELECT page_id * 4 + 1, page_id, page_id, url FROM p)),
        placed AS (
            SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(bare, '^[^/?]*')), '^www[.]', ''), ':(80|443)$', '')
                || regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1), '/+$', '')
                || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END AS canonical_url
            FROM (SELECT *, list_sort(list_filter(string_split(regexp_extract(bare, '^[^?]*[?](.*)$', 1), '&'),
                    lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|ref|fbclid|gclid)(=|$)'))) AS kept FROM parts)),
        matched AS (
            SELECT v.id, v.ts, v.canonical_url, s.id AS response_id, s.page_id,
                row_number() OVER (PARTITION BY v.id ORDER BY s.ts DESC NULLS LAST, s.id DESC) AS place
            FROM (SELECT * FROM placed WHERE page_id IS NULL) v
            LEFT JOIN (SELECT * FROM placed WHERE page_id IS NOT NULL) s ON s.canonical_url = v.canonical_url AND s.ts < v.ts),
        judged AS (
            SELECT m.id, m.canonical_url, m.response_id, p.digest, p.size, p.d, r.step, r.tag,
                CASE WHEN m.response_id IS NULL THEN 'unresolved'
                     WHEN coalesce(r.tag = '"' || p.digest[1:12] || '"', r.modified = 'day ' || p.d) THEN 'resolved' ELSE 'changed' END AS status
            FROM matched m JOIN revisits r ON r.id = m.id LEFT JOIN p ON p.page_id = m.page_id WHERE m.place = 1)
        SELECT id AS revisit_id, canonical_url, CASE WHEN status = 'resolved' THEN response_id END AS response_id, status,
            CASE WHEN status = 'resolved' THEN digest END AS digest,
            CASE WHEN status = 'resolved' THEN
                'cache-control=' || CASE step WHEN 3 THEN 'no-store' ELSE 'max-age=60' END || ';content-length=' || size || ';content-type=text/html;date=visit ' || step
                || ';etag=' || coalesce(CASE WHEN step = 2 THEN 'W/' || tag ELSE tag END, '"' || digest[1:12] || '"')
                || CASE WHEN step = 2 THEN ';expires=never' ELSE '' END || ';last-modified=day ' || d END AS headers
        FROM judged""",
    "op6_substring_dedup": r"""
        WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS x FROM documents),
        windows AS (SELECT doc_id, i, array_to_string(x[i:i + 49], ' ') AS k FROM (SELECT doc_id, x, unnest(generate_series(1, len(x) - 49)) AS i FROM w)),
        owners AS (SELECT k, min(doc_id) AS owner FROM windows GROUP BY k),
        repeated AS (SELECT doc_id, i FROM windows JOIN owners USING (k) WHERE owner < doc_id),
        gone AS (SELECT DISTINCT doc_id, i + d AS p FROM repeated, range(50) r(d)),
        placed AS (SELECT doc_id, unnest(range(1, len(x) + 1)) AS p, unnest(x) AS word FROM w),
        kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS words FROM placed ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
        SELECT w.doc_id, CAST(len(x) AS BIGINT) AS n_words, CAST(len(x) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(words, '')) AS kept_sha256
        FROM w LEFT JOIN kept USING (doc_id)""",
    "op9_jaccard_join": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS x
            FROM documents),
        shingles AS (SELECT DISTINCT doc_id, array_to_string(x[i:i + 4], ' ') AS g
                     FROM (SELECT doc_id, x, unnest(generate_series(1, greatest(len(x) - 4, 1))) AS i FROM w WHERE len(x) > 0)),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM shingles a JOIN shingles b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
        links AS (SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * o >= 80 * (p.n + q.n - o)),
        reach(doc_id, low) AS (SELECT doc_id, doc_id FROM documents UNION SELECT b, low FROM reach JOIN links ON a = reach.doc_id)
        SELECT w.doc_id, coalesce(max(n), 0) AS n_shingles, min(low) AS component_id
        FROM w LEFT JOIN sizes USING (doc_id) JOIN reach USING (doc_id) GROUP BY w.doc_id""",
    "op11_source_divergence": r"""
        WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
        w AS (SELECT r, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
        t AS (SELECT lang, term, count(*) AS lang_n FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
        c AS (SELECT lang, source, term, count(*) AS n, any_value(lang_n) AS lang_n FROM w JOIN t USING (lang, term) GROUP BY lang, source, term),
        g AS (SELECT lang, source, CAST(coalesce(sum(n), 0) AS BIGINT) AS total FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN c USING (lang, source) GROUP BY lang, source),
        l AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM t GROUP BY lang),
        p AS (SELECT g.lang, g.source, t.term, coalesce(n, 0) AS n, 1 + 1000000000::HUGEINT * (coalesce(n, 0) + 1) // (total + v) AS p,
                     1 + 1000000000::HUGEINT * (t.lang_n + 1) // (lang_total + v) AS q
              FROM g JOIN l ON l.lang = g.lang JOIN t ON t.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = t.term),
        pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0) AS value
                  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
                  LEFT JOIN (SELECT x.lang, x.source, y.source AS item, CAST(sum((x.p - y.p) * (x.p - y.p) // y.p) AS BIGINT) AS value
                             FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY x.lang, x.source, y.source) s
                  ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
        ranked AS (
            SELECT lang, source, 'pair' AS part, item, value FROM pairs
            UNION ALL SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // q AS BIGINT) FROM p WHERE n > 0 AND p > q),
        placed AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank FROM ranked)
        SELECT lang, source, part, item, value, rank FROM placed WHERE part = 'pair' OR rank <= 200""",
}
