import zlib

import numpy as np
import pytest

from claimloom.llm import language_id, queries


def test_codewords():
    for n in (2, 3, 4, 5, 9, 40):
        code = language_id.codewords(n)
        assert len(np.unique(code, axis=0)) == n and not (np.abs(code.sum(axis=0)) == n).any()
        if 2 < n <= 5:
            assert code.shape[1] == 2 ** (n - 1) - 1
    assert language_id.codewords(0).shape == (0, 1) and language_id.codewords(1).shape == (1, 1)


def test_ngrams_need_a_letter():
    for text in ("", "12 34 !?", " \n", "🙂"):
        assert language_id.ngrams(text) is None
    assert language_id.ngrams("Ab").sum() == 4 + 3 + 2
    assert (language_id.ngrams("a--b") == language_id.ngrams("A b")).all()
    long = "word " * 300_000
    assert language_id.ngrams(long).sum() == pytest.approx(3 * len(long), rel=1e-3)


def test_a_wrong_bit_is_corrected():
    model = language_id.Model(["a", "b", "c", "d"], language_id.codewords(4), None, np.ones(7))
    for i in range(4):
        for bit in range(7):
            outputs = 4 * model.code[i].copy()
            outputs[bit] *= -1
            assert model.losses(outputs).argmin() == i


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = queries.op9_language_id(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(lang[r.doc_id] == r.lang_pred for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)
    kept = language_id.keep_identified(docs).count()
    assert kept >= 0.995 * len(lang)


def test_learns_only_from_allowed_rows(spark):
    """Languages that only held-out rows have are not learned."""
    ids = list(range(60))
    rows = [(i, "aaa bbb ccc" if i % 2 else "xxx yyy zzz", "held" if zlib.crc32(str(i).encode()) % 3 == 1 else "ab" if i % 2 else "xy") for i in ids]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r.doc_id: r for r in language_id.identify(docs).collect()}
    assert {r.lang_pred for r in found.values()} == {"ab", "xy"}
    assert all(found[i].lang_pred == ("ab" if i % 2 else "xy") for i in ids)


def test_odd_rows(spark, odd, empty):
    rows = language_id.identify(odd).collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert (r.lang_pred == "und") == (r.score == 0.0)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[3].lang_pred == by_id[4].lang_pred == by_id[5].lang_pred == "und"
    assert language_id.identify(empty).count() == 0
    assert language_id.keep_identified(odd).columns == odd.columns
    unlabelled = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [r.lang_pred for r in language_id.identify(unlabelled).collect()] == ["und"]
    one = spark.createDataFrame([(i, "some text", "en") for i in range(9)], "doc_id long, text string, lang string")
    assert {(r.lang_pred, r.score) for r in language_id.identify(one).collect()} == {("en", 1.0)}


def test_labels_alike_and_tables_without_labels_keep_their_texts(spark, small):
    """Three spellings of one label share its texts; without a label nothing is judged."""
    from pyspark.sql import functions as F

    texts = small.filter(F.length("text") > 200).select("doc_id", "text", "lang")
    spelled = F.concat("lang", F.element_at(F.array(*map(F.lit, ("", "-a", "-b"))), (F.hash("doc_id") % 3 + 3) % 3 + 1))
    total = texts.count()
    one = texts.filter("lang = 'en'")
    assert language_id.keep_identified(one.withColumn("lang", spelled)).count() >= 0.95 * one.count()
    assert language_id.keep_identified(texts.withColumn("lang", F.lit(None).cast("string"))).count() == total


def test_a_dirty_label_column_is_learned_in_part(spark, small):
    """Of very many labels only the most frequent are learned, all others' rows are judged by these."""
    from pyspark.sql import functions as F

    dirty = small.select("doc_id", "text", F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("x"), "doc_id")).otherwise(F.col("lang")).alias("lang"))
    model = language_id.fit(dirty, languages=4)
    assert model.languages == sorted(r.lang for r in small.select("lang").distinct().collect())


def _plain_prediction(model, text):
    """Bits and decoding written out: loss of each codeword, weighted by bit, and its softmax share."""
    import math

    counts = language_id.ngrams(text) if text else None
    if counts is None:
        return "und", 0.0
    total = counts.sum() + language_id.PRIOR
    bits = [
        language_id.GAIN * sum(counts[b] * model.weights[b, k] for b in np.flatnonzero(counts)) / total
        for k in range(model.code.shape[1])
    ]
    losses = [
        sum(w * math.log1p(math.exp(-c * o)) for w, c, o in zip(model.bit_weights, word, bits, strict=True))
        for word in model.code
    ]
    shares = [math.exp(min(losses) - x) for x in losses]
    best = min(range(len(losses)), key=lambda i: losses[i])
    return model.languages[best], shares[best] / sum(shares)


def test_decoding_against_a_plain_version(spark, small):
    model = language_id.fit(small)
    texts = {r.doc_id: r.text for r in small.collect()}
    for r in language_id.identify(small).collect():
        lang, score = _plain_prediction(model, texts[r.doc_id])
        assert r.lang_pred == lang and r.score == pytest.approx(score, abs=1e-9)
