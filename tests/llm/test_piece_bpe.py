import hashlib
import random

import public_tokenizers
import sentencepiece
from helpers_llm import texts_of

from claimloom.llm import piece_bpe, queries

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)


def _texts():
    draw = random.Random(3)
    letters = "abcdeth  ▁  \n\t0123éü门梦国的🙂́ßﬁ①<>xX=-_/\x00\xa0]^\\["
    texts = ["".join(draw.choices(letters, k=draw.randint(0, 300))) for _ in range(800)]
    texts += [" " * n for n in range(0, 150, 7)] + ["a" * 300, "ab" * 400, "the" * 500, "▁" * 50 + "x"]
    return texts + ["x" * 5000, "http://" + "q7Zk" * 300, "<s> </s> <unk> <0x41>", "﻿hi", "\r\n", "a  b ", " a"]


def test_encodes_and_decodes_like_the_library(monkeypatch):
    texts = _texts()
    expected = LIBRARY.encode(texts)
    words = piece_bpe.Vocabulary(PATH)
    assert words.encode(texts) == expected
    assert [words.decode(i) for i in expected] == [LIBRARY.decode(i) for i in expected]
    # The same ids from rounds alone, from the queue alone, and when words are forgotten.
    for name, value in (("LONG", 1 << 30), ("LONG", 0), ("CACHE", 0)):
        monkeypatch.setattr(piece_bpe, name, value)
        other = piece_bpe.Vocabulary(PATH)
        assert [other.encode([t])[0] for t in texts[:150]] == expected[:150]
        monkeypatch.undo()


def test_decodes_any_ids():
    draw = random.Random(4)
    words = piece_bpe.Vocabulary(PATH)
    for _ in range(4000):
        ids = [draw.randrange(1, 32000) if draw.random() < 0.6 else draw.randrange(1, 260) for _ in range(draw.randint(0, 10))]
        assert words.decode(ids) == LIBRARY.decode(ids), ids


def test_normalisation_is_the_identity():
    for c in range(0x110000):
        if not 0xD800 <= c < 0xE000 and c != 32:
            assert LIBRARY.normalize(chr(c)) == "▁" + chr(c)


def test_odd_rows(odd, empty):
    coded = piece_bpe.decode(piece_bpe.encode(odd, PATH), PATH)
    rows = coded.collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert r.ids == LIBRARY.encode(r.text or "") and r.decoded == LIBRARY.decode(r.ids)
    assert piece_bpe.digest(piece_bpe.decode(piece_bpe.encode(empty, PATH), PATH)).count() == 0


def test_query(spark, small):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    expected = set()
    for doc_id, text in texts_of(small):
        ids = LIBRARY.encode(text or "")
        expected.add((doc_id, len(ids), sha(",".join(map(str, ids))), sha(LIBRARY.decode(ids))))
    assert set(map(tuple, queries.op8_sentencepiece(spark, "/root/testdata/sf0.001").collect())) == expected
