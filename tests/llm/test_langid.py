import zlib

import numpy as np
from helpers import awkward, clashing, empty, rows
from pyspark.sql import functions as F

from lakecensus.llm import langid
from lakecensus.llm.common import table
from lakecensus.llm.queries import op5_language_id


def grams(text):
    out, last = [], " "
    for c in text:
        c = c.lower()[0] if c.isalpha() else " "
        if c != " " or last != " " or not out:
            out.append(c)
        last = c
    return {(n, tuple(out[i:i + n])) for n in langid.GRAMS for i in range(len(out) - n + 1) if n > 1 or out[i] != " "}


def test_presence_counts_distinct_grams(monkeypatch):
    texts = ["The cat, the CAT.", "", "123", "é ñ", "a", "x" * 500, "the  cat"]
    flags = langid.presence(texts)
    assert flags.shape == (len(texts), langid.DIM)
    for t, f in zip(texts, flags):
        want = len(grams(t)) if any(c.isalpha() for c in t) else 0
        assert want - 1 <= f.sum() <= want  # two grams may share a bit
    monkeypatch.setattr(langid, "_SPAN", 3)
    assert (langid.presence(texts) == flags).all()
    assert (langid.presence(texts[::-1])[::-1] == flags).all()  # a row doesn't depend on its neighbours


def test_kernel_model_equals_its_plain_form():
    texts = ["the cat sat on the mat", "la casa de la mesa", "the dog and the moon", "el perro y la luna"] * 3
    labels = ["en", "es", "en", "es"] * 3
    flags = langid.presence(texts)
    names, matrix = langid.fit(flags, labels, landmarks=4, ridge=0.1)
    x = flags.astype(float) / np.linalg.norm(flags.astype(float), axis=1, keepdims=True)
    k_mm, k_nm = x[:4] @ x[:4].T, x @ x[:4].T
    aims = np.array([[1.0 if lab == n else -1.0 for n in names] for lab in labels])
    # kernel ridge regression in the span of the landmarks
    a = np.linalg.solve(k_nm.T @ k_nm + 0.1 * len(texts) * k_mm, k_nm.T @ aims)
    assert np.allclose(langid._products(flags, matrix), k_nm @ a, atol=1e-3)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in op5_language_id(spark, sf).collect()}
    docs = table(spark, sf, "documents").collect()
    assert len(got) == len(docs)
    held = [r for r in docs if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert {r["doc_id"] for r in held} == {d for d, r in got.items() if r["held_out"]}
    right = sum(got[r["doc_id"]]["lang_pred"] == r["lang"] for r in held)
    assert right / len(held) > 0.97 and all(0 <= r["score"] <= 1 for r in got.values())


def test_awkward_rows(spark):
    docs = awkward(spark)
    learn = langid.may_learn()
    out = langid.predict(docs, langid.train(docs, learn)).select("doc_id", "_lang.lang", "_lang.score")
    by = {r["doc_id"]: r for r in out.collect()}
    assert all((by[d]["lang"], by[d]["score"]) == ("und", 0.0) for d in (5, 6, 7, 10, 15))
    assert all(by[d]["lang"] in ("en", "fr") for d in (1, 3, 8, 11, 13, 14))
    other = langid.predict(clashing(docs), langid.train(clashing(docs), learn)).select("doc_id", "_lang.lang", "_lang.score")
    assert rows(other) == rows(out)
    kept = langid.accepted_documents(docs)
    assert kept.columns == docs.columns and not {5, 6, 7, 10, 15} & {r["doc_id"] for r in kept.collect()}


def test_without_labels_everything_is_unknown(spark):
    docs = awkward(spark).withColumn("lang", F.lit(None).cast("string"))
    assert langid.train(docs, langid.may_learn()) is None
    assert langid.accepted_documents(docs).count() == 0 and langid.accepted_documents(empty(spark)).count() == 0


def test_the_sample_is_bounded_and_even(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "concat('some text ', id) as text",
                                        "if(id % 30 = 0, 'es', 'en') as lang")
    got = langid.sample(docs, F.lit(True), "doc_id", "text", "lang", 120).groupBy("lang").count().collect()
    assert dict(got) == {"en": 60, "es": 60}


def test_accepted_documents_are_in_a_learned_language(spark):
    sf = "/root/testdata/sf0.01"
    docs = table(spark, sf, "documents")
    clean = [r["text"] for r in docs.where("n_chars > 3000").orderBy("doc_id").limit(20).collect()]
    scripts = [(0x430, 0x44F), (0x3B1, 0x3C9), (0x4E00, 0x9FA5), (0x627, 0x64A), (0x3041, 0x3096)]
    rng, new = np.random.default_rng(7), []
    for n in (1, 2, 5, 20, 100, 300, 3000):
        for a, b in scripts:
            new.append((" ".join("".join(map(chr, rng.integers(a, b, 6))) for _ in range(n)), False))
        new += [(" ".join(t.split(" ")[:n]), True) for t in clean if n > 2]
    extra = spark.createDataFrame([(10**9 + i, t) for i, (t, _) in enumerate(new)], "doc_id long, text string")
    both = docs.unionByName(extra, allowMissingColumns=True)  # without a label, so not learned from
    kept = {r["doc_id"] for r in langid.accepted_documents(both).select("doc_id").collect()}
    assert not [t[:40] for i, (t, good) in enumerate(new) if not good and 10**9 + i in kept]
    assert not [t[:40] for i, (t, good) in enumerate(new) if good and 10**9 + i not in kept]
    gone = {r["doc_id"] for r in docs.collect() if any(c.isalpha() for c in r["text"] or "")} - kept
    assert len(gone) <= 0.002 * docs.count()  # two languages in one text

    spanish = F.col("lang") == "es"  # a language that isn't learned
    taught = docs.withColumn("lang", F.when(~spanish, F.col("lang")))
    left = langid.accepted_documents(taught.withColumn("was", F.col("doc_id"))).join(
        docs.where(spanish & (F.col("n_chars") > 500)).select(F.col("doc_id").alias("was")), "was").count()
    assert left <= 0.1 * docs.where(spanish & (F.col("n_chars") > 500)).count()
