import zlib

import numpy as np
from frames import awkward_docs, empty_docs, words
from pyspark.sql import functions as F

from tripmart.llm import quality
from tripmart.llm.quality import (
    FORMS,
    Vocabulary,
    WordVectors,
    fit_quality,
    keep_quality,
    score_quality,
    vocabulary,
    word_form,
    word_key,
)

LABELS = "doc_id long, quality int"


def corpus(spark, n=400):
    """Plain texts and texts in capitals with marks between, labelled 1 and 0."""
    docs, labels = [], []
    for k in range(n):
        good = k % 4 != 0
        found = words(k % 50, 40 + k % 30)
        docs.append((k, " ".join(found) if good else "!! ".join(w.upper() for w in found), "x"))
        labels.append((k, int(good)))
    return spark.createDataFrame(docs, "doc_id long, text string, score string"), labels


def remainder(k):
    return zlib.crc32(str(k).encode()) % 5


def test_held_out_rows_are_told_apart(spark):
    docs, labels = corpus(spark)
    model = fit_quality(docs, spark.createDataFrame(labels, LABELS))
    score = {r.doc_id: r.score for r in score_quality(docs, model).collect()}
    held = [(score[k], q) for k, q in labels if remainder(k) == 0]
    assert all(0 <= s <= 1 and (s >= 0.3) == bool(q) for s, q in held)
    kept = keep_quality(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {k for k, s in score.items() if s >= 0.3}


def test_held_out_labels_teach_nothing(spark):
    docs, labels = corpus(spark, 200)
    other = [(k, 1 - q if remainder(k) == 0 else q) for k, q in labels]
    scores = [
        score_quality(docs, fit_quality(docs, spark.createDataFrame(x, LABELS))).orderBy("doc_id").collect()
        for x in (labels, other)
    ]
    assert scores[0] == scores[1]


def test_awkward_rows(spark):
    docs, labels = corpus(spark, 100)
    rows = awkward_docs(spark)
    odd = [(None, 1), (5, None), (10_000, 0), (1, 0), (1, 1)]
    model = fit_quality(docs, spark.createDataFrame([*labels, *odd], LABELS))
    got = score_quality(rows, model).collect()
    assert len(got) == rows.count() and all(0 <= r.score <= 1 for r in got)
    assert score_quality(empty_docs(spark), model).collect() == []
    none = fit_quality(empty_docs(spark), spark.createDataFrame([], LABELS))
    assert {r.score for r in score_quality(rows, none).collect()} == {0.5}
    one = fit_quality(docs, spark.createDataFrame([(k, 1) for k, _ in labels], LABELS))
    assert {round(r.score, 2) for r in score_quality(rows, one).collect()} == {0.99}


def vectors_of(found, seed=1):
    known = Vocabulary(np.sort(np.array([word_key(w) for w in found], dtype=np.int64)))
    unit = np.random.default_rng(seed).normal(size=(len(known), 32)).astype(np.float32)
    return WordVectors(known, unit, np.full(len(known), 0.5, np.float32))


def test_long_and_short_texts_are_pooled_alike():
    found = words(3, 500)
    vectors = vectors_of(found[:100])
    short, long = vectors.pooled([" ".join(found), " ".join(found * 200)])
    assert np.allclose(short[:32], long[:32], atol=1e-4)
    codes = vectors.words.codes(" ".join(found * 200))  # in parts as at once
    unit = vectors.unit[np.maximum(codes, 0)].astype(float)
    unit[codes < 0] = quality._own_vectors(codes[codes < 0])
    assert np.allclose(long[32:], (unit[1:] * unit[:-1]).sum(axis=0) / len(codes), atol=1e-4)


def test_vocabulary_is_every_word_of_the_share(spark):
    texts = ["a a a b", "b c __ c", None, "", "d!! a"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    for share, want in ((0.2, "a"), (0.15, ["a", "b", "c"]), (1 / 1000, ["a", "b", "c", "d", "__", "!!"])):
        got = vocabulary(docs, least_share=share)
        assert list(got.keys) == sorted(word_key(w) for w in want)
    assert len(vocabulary(docs.limit(0)).keys) == 0


def test_rare_words_have_a_form_and_a_vector_of_their_own():
    vectors = vectors_of(["the"])
    codes = vectors.words.codes("the House Mouse HOUSE 12345 !!!!! a1b the")
    forms = quality._rows(codes).tolist()
    assert forms[0] == forms[-1] == FORMS and forms[1] == forms[2] == word_form("House")
    assert len(set(forms[2:-1])) == 5 and all(f < FORMS for f in forms[1:-1])
    own = quality._own_vectors(codes[codes < 0])
    assert len({tuple(v) for v in own}) == 6 and np.allclose((own**2).sum(axis=1), 1)
    assert len({word_form("x" * n) for n in (1, 2, 4, 8, 16, 32)}) == 6 and word_form("x" * 32) == word_form("x" * 10**6)


def test_clashing_columns(spark):
    docs, labels = corpus(spark, 60)
    odd = docs.selectExpr("doc_id", "text", "'y' as n", "1 as key", "'z' as label", "true as held", "0 as code")
    other = spark.createDataFrame([(k, q, "w", 0) for k, q in labels], "doc_id long, quality int, text string, n int")
    model = fit_quality(odd, other)
    assert score_quality(odd, model).columns == ["doc_id", "score"]
    assert keep_quality(odd, model).columns == odd.columns


def test_id_remainder(spark):
    from tripmart.llm.quality import id_remainder

    got = spark.range(50).select("id", id_remainder(F.col("id")).alias("r")).collect()
    assert all(r.r == remainder(r.id) for r in got)
