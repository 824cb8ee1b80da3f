"""The pipeline against its stages' operators, stage by stage."""

import os

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from cartwheel.llm import minhash, quality, secrets, toxicity
from cartwheel.llm.scratch import stage, table, tokenizer_path

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="given tables not present")


def test_queries_are_registered():
    names = set(entry.queries())
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and [n for n, _ in corpus_pipeline.STAGES][:1] == ["quality_rules"]


def test_each_stage_takes_effect(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    outputs = {}
    for name, step in corpus_pipeline.STAGES:
        outputs[name] = docs, (out := stage(step(spark, docs, SF), f"test_{name}"))
        docs = out
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    for name in list(outputs)[:-1]:
        assert outputs[name][1].columns == columns

    before, after = outputs["quality_rules"]
    assert ids(after) == ids(quality.score(before).where("kept")) and len(ids(after)) < before.count()

    before, after = outputs["drop_toxic"]
    labels = table(spark, SF, "labels")
    assert ids(after) == ids(toxicity.score(before, labels).where("predicted = 0"))

    before, after = outputs["drop_near_duplicates"]
    assert ids(after) == ids(minhash.near_duplicates(before).where("kept"))

    before, after = outputs["redact_secrets"]
    found = {r.doc_id: r for r in secrets.scan(before).collect()}
    texts = {r.doc_id: r for r in before.collect()}
    for r in after.collect():
        if found[r.doc_id].spans:
            assert "[secret]" in r.text and r.n_chars == len(r.text)
        else:
            assert r == texts[r.doc_id]

    before, after = outputs["pack_sequences"]
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    want = {r.doc_id: len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for r in before.collect()}
    got = {}
    for r in after.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == want


def test_last_stage_holds_the_token_ids(spark):
    from tokenizers import Tokenizer

    docs = table(spark, SF, "documents").where("doc_id < 40")
    tokenizer = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    want = {r.doc_id: tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1] for r in docs.collect()}
    got = {}
    for r in corpus_pipeline.pack_sequences(spark, docs, SF).orderBy("start").collect():
        got.setdefault(r.doc_id, []).extend(np.frombuffer(r.ids, dtype="<u4").tolist())
    assert got == want
