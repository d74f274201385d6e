import hashlib

import corpus_pipeline
import public_tokenizers
import tiktoken

import __spark_entry__
from aerolake.llm import bpe, jaccard, toxicity
from aerolake.llm.text import table

SF = "/root/testdata/sf0.001"


def test_stages_follow_one_another(spark):
    docs = table(spark, SF, "documents")
    columns, seen = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if k < 4:
            assert out.columns == columns, name
            assert {r.doc_id for r in out.collect()} <= seen.keys()
        docs = out if k in (3, 4) else out.cache()
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs.collect())
    for r in rows:
        text = library.decode(list(r.ids))
        assert hashlib.sha256(text.encode()).hexdigest() == r.decoded_sha256 and r.n_tokens == len(r.ids)
        assert text == seen[r.doc_id] or "[SECRET]" in text


def test_each_stage_decides_on_its_own_input(spark):
    docs = table(spark, SF, "documents")
    scores = toxicity.score(docs, toxicity.fit(docs, table(spark, SF, "labels"))).collect()
    assert {r.doc_id for r in corpus_pipeline.drop_toxic(spark, docs, SF).collect()} == {r.doc_id for r in scores if not r.predicted}
    groups = jaccard.join(docs).collect()
    assert {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()} == {r.component_id for r in groups}


def test_entry_lists_every_operator():
    names = __spark_entry__.queries()
    assert "pipeline" in names and {n.split("_")[0] for n in names if n.startswith("op") and n[2].isdigit()} == {f"op{n}" for n in range(1, 14)}


def test_whoever_calls_a_stage_gets_short_plan_texts(spark):
    """The driver keeps a text of every plan; the setting must hold inside a stage and be undone after it."""
    key, found = "spark.sql.maxPlanStringLength", []
    before = spark.conf.get(key)
    corpus_pipeline.spared(lambda spark, docs, sf_dir: found.append(spark.conf.get(key)))(spark, None, SF)
    assert found == ["65536"] and spark.conf.get(key) == before
    assert all(hasattr(stage, "__wrapped__") for _, stage in corpus_pipeline.STAGES)
