import random

import numpy as np

from claimloom.llm import common


def test_word_hashes_tell_words_apart(monkeypatch):
    """One hash a word, the same wherever the word stands, none shared by two words."""
    draw = random.Random(1)
    letters = "abcé\x1c\x85門 \t\n\r\x0b\x0c"
    of = {}
    texts = ["".join(draw.choices(letters, k=draw.randint(0, 80))).encode() for _ in range(3000)]
    for text in [*texts, b"", b" ", b"x" * 5000, b" ".join(b"w%d" % i for i in range(50_000))]:
        hashes = common.word_hashes(text).tolist()
        words = text.split()
        assert len(hashes) == len(words)
        for word, value in zip(words, hashes, strict=True):
            assert of.setdefault(word, value) == value
    assert len(set(of.values())) == len(of) > 50_000
    cut = [*texts[:500], b"x" * 50, b"x" * 50 + b" y " + b"z" * 40 + b"\n"]
    whole = [common.word_hashes(text).tolist() for text in cut]
    monkeypatch.setattr(common, "PIECE", 16)
    assert [common.word_hashes(text).tolist() for text in cut] == whole


def test_high_bits_are_even():
    hashes = common.word_hashes(b" ".join(b"%d" % i for i in range(100_000)))
    counts = np.bincount((hashes >> np.uint64(56)).astype(int), minlength=256)
    assert counts.min() > 250 and counts.max() < 550
