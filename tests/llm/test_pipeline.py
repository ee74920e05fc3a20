import corpus_pipeline
import numpy as np
import pytest
from helpers import DOCS, awkward, clashing, empty, words
from pyspark.sql import functions as F
from test_minhash import brute as components
from test_packing_and_tokens import check, whole
from test_quality import brute as measured

from lakecensus.llm import mixing, quality
from lakecensus.llm.common import staged, table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def outputs(spark):
    """(input rows, output rows) of every stage, run over sf0.001."""
    out, docs = {}, table(spark, SF, "documents")
    for name, stage in corpus_pipeline.STAGES:
        done = staged(stage(spark, docs, SF), f"test-{name}")
        out[name] = (docs, done)
        docs = done
    return out


def test_stages_and_columns(outputs):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "quality_rules", "near_dedup", "source_mixing", "packing"]
    for name in list(outputs)[:-1]:
        assert outputs[name][0].schema.simpleString() == outputs[name][1].schema.simpleString()


def test_filters_by_brute_force(outputs):
    docs, out = outputs["language_id"]
    gone = {r["doc_id"] for r in docs.collect()} - {r["doc_id"] for r in out.collect()}
    lettered = {r["doc_id"] for r in docs.collect() if any(c.isalpha() for c in r["text"] or "")}
    assert len(gone & lettered) <= 0.01 * docs.count()
    docs, out = outputs["quality_rules"]
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(
        r["doc_id"] for r in docs.collect() if not measured(r["text"])[1] & quality.policy_mask("clean-1"))
    docs, out = outputs["near_dedup"]
    want = components([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(d for d, (_, c) in want.items() if d == c)


def test_mix_meets_its_targets(outputs):
    docs, out = outputs["source_mixing"]
    size = {}
    for r in docs.collect():
        size[r["source"]] = size.get(r["source"], 0) + len(words(r["text"]))
    names = sorted(size, key=lambda s: (s is None, s or ""))
    target = mixing.targets([size[s] for s in names], [1 + i % 3 for i in range(len(names))])
    got = dict.fromkeys(names, 0)
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in out.collect():
        got[r["source"]] += len(words(r["text"]))
        assert r["text"] in text[r["doc_id"]]
    for s, t in zip(names, target):
        assert abs(got[s] - t) <= max(100, 0.05 * t)


def test_packed_ids_are_those_of_the_mix(outputs):
    docs, out = outputs["packing"]
    total = sum(len(whole(r["text"])) + 1 for r in docs.collect())
    rows = out.collect()
    assert sum(r["length"] for r in rows) == total and max(r["sequence_id"] for r in rows) == (total - 1) // 4096


def test_run_returns_the_last_stage(spark, outputs):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == outputs["packing"][1].columns
    assert got.agg(F.sum("length")).first()[0] == outputs["packing"][1].agg(F.sum("length")).first()[0]


def test_every_stage_takes_awkward_and_empty_tables(spark):
    for start in (awkward(spark), clashing(awkward(spark)), empty(spark)):
        docs = start
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = staged(stage(spark, docs, SF), f"test-{name}")
            assert docs.columns == start.columns and docs.schema.simpleString() == start.schema.simpleString()
            # columns named like the operators' own keep their values
            own = [c for c in docs.columns if c not in DOCS.fieldNames()]
            assert all(r[c] == f"x-{c}" for r in docs.select(own).collect() for c in own)
        packed = stage_of("packing")(spark, docs, SF)
        assert np.sum([r["length"] for r in packed.collect()]) == sum(len(whole(r["text"])) + 1 for r in docs.collect())


def stage_of(name):
    return dict(corpus_pipeline.STAGES)[name]


def test_check_helper_is_used_on_packed_documents(spark):
    from lakecensus.llm import packing
    from lakecensus.llm.queries import tokenizer_path

    docs = awkward(spark).where("doc_id < 4")
    check(docs, packing.pack(docs, tokenizer_path(), 16), 16)
