import re
from collections import Counter

import corpus_pipeline
import public_tokenizers
import sentencepiece
from test_simhash import _classes, _fingerprint

from claimloom.llm import common, language_id, mixing, secret_scan

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLDER = "/root/testdata/sf0.001"


def _stage(spark, k, docs):
    out = corpus_pipeline.STAGES[k][1](spark, docs, FOLDER)
    return common.stored(out, f"test-{k}")


def test_stages_against_plain_versions(spark, small):
    """Each stage on its own input, compared with a version without Spark."""
    docs, inputs = small, []
    for k in range(5):
        inputs.append(docs)
        docs = _stage(spark, k, docs)
        assert k == 4 or docs.columns == small.columns
    rows = [{r.doc_id: r for r in df.collect()} for df in inputs]

    model = language_id.fit(small)
    assert set(rows[1]) == {i for i, r in rows[0].items() if not model.predict(r.text)[2]}
    assert len(rows[1]) >= 0.99 * len(rows[0])

    prints = {i: _fingerprint(r.text) for i, r in rows[1].items()}
    classes, least = _classes(prints.values()), {}
    for i, p in prints.items():
        least[classes[p]] = min(i, least.get(classes[p], i))
    assert set(rows[2]) == set(least.values())
    assert all(rows[2][i] == rows[1][i] for i in rows[2])

    assert set(rows[3]) == set(rows[2])
    for i, r in rows[3].items():
        before = rows[2][i].text
        spans = [s for s in secret_scan.base_spans(before)]
        assert not secret_scan.base_spans(r.text)
        assert (r.text == before) == (not spans) or "[SECRET]" in r.text
        assert r.n_chars == len(r.text)

    copies = {r.doc_id: r.copies for r in mixing.mix(inputs[3]).collect()}
    assert Counter(r.doc_id for r in inputs[4].select("doc_id").collect()) == Counter(
        {i: n for i, n in copies.items() if n}
    )
    library = sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path("piece_bpe_32k.model")
    )
    coded = docs.collect()
    assert len(coded) == sum(copies.values())
    for r in coded:
        assert r.ids == library.encode(rows[4][r.doc_id].text) and r.round_trip
        assert r.n_tokens == len(r.ids)


def test_stages_take_odd_and_empty_rows(spark, odd, empty):
    five = ["doc_id", "text", "lang", "source", "n_chars"]
    for docs in (odd.select(five), empty.select(five)):
        for k in range(5):
            out = _stage(spark, k, docs)
            assert k == 4 or out.columns == five
            assert out.count() <= 3 * docs.count()


def test_run(spark):
    assert corpus_pipeline.run(spark, FOLDER).count() > 0
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
