import hashlib
import random
import re
from collections import Counter

import numpy as np

from claimloom.llm import common, fingerprints, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _likeness(a, b):
    """Share of equal shingles of five words."""
    sets = []
    for text in (a, b):
        w = WORD.findall(text)
        sets.append({" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    both = sets[0] | sets[1]
    return len(sets[0] & sets[1]) / len(both) if both else 1.0


def _check(docs, found):
    rows = [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]
    rows.sort(key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    expected, errors = Counter(), []
    prints = {}
    near = {}
    for r in found:
        near.setdefault((r.doc_id, r.n_chars, r.edited_sha256), r)
    for (doc_id, text), (_, following) in zip(rows, rows[1:] + rows[:1], strict=True):
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        key = (doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest())
        expected[key] += 1
        r = near[key]
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
        assert prints.setdefault(changed, r.edited_fingerprint) == r.edited_fingerprint
        errors += [r.near_edited - _likeness(text, changed), r.near_next - _likeness(text, following)]
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in found) == expected
    assert np.abs(errors).max(initial=0) < 0.2 and np.sqrt(np.mean(np.square(errors or [0]))) < 0.05


def test_odd_rows(odd, empty, spark):
    _check(odd, fingerprints.with_next(odd).collect())
    assert fingerprints.with_next(empty).count() == 0
    one = spark.createDataFrame([(7, "a b c d e f")], "doc_id long, text string")
    _check(one, fingerprints.with_next(one).collect())
    unnamed = spark.createDataFrame([(None, "a b c"), (None, "d e f g")], "doc_id long, text string")
    _check(unnamed, fingerprints.with_next(unnamed).collect())


def test_many_ranges_large_and_negative_ids(spark):
    draw = random.Random(2)
    ids = [draw.randint(-(1 << 62), 1 << 62) for _ in range(300)]
    rows = [(i, " ".join(draw.choices("abcdefgh", k=draw.randint(0, 60)))) for i in ids]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        _check(docs, fingerprints.with_next(docs).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")


def test_estimates_have_no_bias():
    draw = random.Random(6)
    for share in (0.2, 0.5, 0.9):
        errors = []
        for trial in range(60):
            n = draw.choice([30, 400, 3000])
            a = [f"{trial}a{i}" for i in range(n)]
            b = a[: int(n * share)] + [f"{trial}b{i}" for i in range(int(n * share), n)]
            x, y = (fingerprints.sketch(common.word_hashes(" ".join(w).encode())) for w in (a, b))
            errors.append(fingerprints.likeness(x, y) - _likeness(" ".join(a), " ".join(b)))
        assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_slices_of_a_long_text_do_not_matter(monkeypatch):
    words = np.random.default_rng(1).integers(0, 1 << 63, 5000).astype(np.uint64)
    whole = fingerprints.sketch(words)
    monkeypatch.setattr(fingerprints, "SLICE", 77)
    assert (fingerprints.sketch(words) == whole).all()


def test_query(spark, small):
    _check(small, queries.op10_fingerprints(spark, "/root/testdata/sf0.001").collect())
