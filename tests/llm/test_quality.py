from collections import Counter

from helpers import awkward, clashing, empty, rows, words
from pyspark.sql import functions as F

from lakecensus.llm import quality
from lakecensus.llm.common import table


def brute(text):
    t, ws = text or "", words(text)
    wins = [tuple(ws[i:i + 5]) for i in range(len(ws) - 4)]
    seen = Counter(wins)
    repeat = {i + k for i, w in enumerate(wins) if seen[w] > 1 for k in range(5)}
    lines = [x for x in t.split("\n") if words(x)]
    m = {"n_words": len(ws), "word_chars": sum(map(len, ws)), "n_symbols": sum(c in "#*$%&|<>" for c in t),
         "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(repeat),
         "n_upper": sum("A" <= c <= "Z" for c in t)}
    fails = [m["n_words"] < 10, 100 * m["n_repeat_words"] > 20 * m["n_words"], 10 * m["n_symbols"] > m["n_words"],
             2 * m["n_dup_lines"] > m["n_lines"],
             m["word_chars"] < 2 * m["n_words"] or m["word_chars"] > 12 * m["n_words"],
             10 * m["n_upper"] > 4 * m["word_chars"]]
    return m, sum(1 << i for i, f in enumerate(fails) if f)


def test_ledger_by_brute_force(spark):
    for docs in (awkward(spark), clashing(awkward(spark)), table(spark, "/root/testdata/sf0.001", "documents")):
        for r in quality.ledger(docs).collect():
            m, mask = brute(r["text"])
            assert r["_m"].asDict() == m and r["_fail_mask"] == mask, r["doc_id"]


def test_empty_texts_fail_one_rule_only():
    assert brute(None)[1] == brute(" \n")[1] == quality.bit("few_words")


def test_policies_and_kept_documents(spark):
    docs = clashing(awkward(spark))
    for policy in quality.POLICIES:
        want = sorted((r["doc_id"] or 0, r["text"]) for r in docs.collect()
                      if not brute(r["text"])[1] & quality.policy_mask(policy))
        kept = quality.kept_documents(docs, policy)
        assert kept.columns == docs.columns
        assert sorted((r["doc_id"] or 0, r["text"]) for r in kept.collect()) == want
    assert quality.kept_documents(empty(spark)).count() == 0 and rows(quality.ledger(empty(spark))) == []


def test_the_filter_reads_each_text_once(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    plan = quality.kept_documents(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") <= 2


def test_ablations(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    masks = [brute(r["text"])[1] & quality.policy_mask("clean-1") for r in docs.collect()]
    got = {r["rule"]: r for r in quality.ablations(quality.ledger(docs), "clean-1").collect()}
    assert set(got) == set(quality.POLICIES["clean-1"])
    for rule, r in got.items():
        b = quality.bit(rule)
        assert r["fails"] == sum(bool(m & b) for m in masks)
        assert r["fails_alone"] == sum(m == b for m in masks)
        assert r["rejected"] == sum(m != 0 for m in masks)


def test_clean_documents_stay(spark):
    sf = "/root/testdata/sf0.01"
    labels = table(spark, sf, "labels").where("quality = 1")
    book = quality.ledger(table(spark, sf, "documents")).join(labels, "doc_id").where("_m.n_words >= 10")
    lost = book.where(~quality.passes(F.col("_fail_mask"), "clean-1")).count()
    assert lost <= 0.01 * book.count()
