import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from claimloom.llm import fm_index, queries, substring_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _expected(rows, window):
    """Count every window of every row, remove the words of those seen twice."""
    words = [WORD.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (doc_id, _), w in zip(rows, words, strict=True):
        keep = [True] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                keep[i : i + window] = [False] * window
        kept = " ".join(x for x, k in zip(w, keep, strict=True) if k)
        out.append((doc_id, len(w), keep.count(False), hashlib.sha256(kept.encode()).hexdigest()))
    return Counter(out)


def _found(docs, **more):
    rows, _ = substring_dedup.dedup_substrings(docs, **more)
    return Counter(map(tuple, rows.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()))


def _rows(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def test_odd_rows(odd, empty):
    assert _found(odd) == _expected(_rows(odd), 35)
    assert _found(odd, window=5, gram=2) == _expected(_rows(odd), 5)
    assert _found(empty) == Counter()


@pytest.mark.parametrize(("window", "gram", "letters"), [(8, 3, 2), (6, 6, 30), (35, 12, 400), (7, 1, 5)])
def test_random_overlaps(spark, window, gram, letters):
    """Passages shared in whole and in part, periodic texts, shifted copies."""
    draw = random.Random(window)
    word = lambda: f"v{draw.randrange(letters)}"
    passages = [[word() for _ in range(draw.randint(window - 1, 3 * window))] for _ in range(12)]
    rows = []
    for i in range(60):
        text = [word() for _ in range(draw.randint(0, 2 * window))]
        for _ in range(draw.randint(0, 3)):
            p = draw.choice(passages)
            at = draw.randrange(len(p))
            text += p[draw.choice((0, at)) :] + [word() for _ in range(draw.randint(0, 20))]
        if i % 17 == 0:
            text = (["a", "b", "c"][: 1 + i % 3] * 3 * window)[: 3 * window]
        rows.append((i, draw.choice((" ", "\n", " \t")).join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert _found(docs, window=window, gram=gram) == _expected(rows, window)
    # Chunks: minimizers that repeat much are larger than a shard.
    assert _found(docs, window=window, gram=gram, shard_words=150 * window) == _expected(rows, window)


def test_hot_passage_in_chunks(spark):
    """A third of the rows hold one passage in contexts of their own."""
    draw = random.Random(1)
    passage = [f"p{i}" for i in range(50)]
    rows = []
    for i in range(240):
        own = [f"d{i}w{j}" for j in range(draw.randint(0, 50))]
        tail = [f"d{i}t{j % 30}" for j in range(draw.randint(0, 50))]
        rows.append((i, " ".join(own + (passage if i % 3 == 0 else []) + tail)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = _expected(rows, 35)
    assert sum(n for _, _, n, _ in expected) == 80 * 50
    assert _found(docs, shard_words=1500) == expected


def test_index_counts_and_reach():
    draw = random.Random(9)
    for trial in range(25):
        symbols = draw.choice([2, 5, 90])
        segments = [[draw.randint(1, symbols) for _ in range(draw.randint(1, 12))] for _ in range(30)]
        text = np.array([x for s in segments for x in (*s, 0)])
        index = fm_index.FmIndex(text, max(map(len, segments)), symbols)
        joined = [tuple(s) for s in segments]
        ends = np.cumsum([len(s) + 1 for s in segments]) - 2
        begins = ends - [len(s) - 1 for s in segments]
        for need in (1, 2, 3):
            reach = index.reach(text, begins, ends, need)
            for s, b, e, r in zip(joined, begins, ends, reach, strict=True):
                count = lambda part: sum(
                    t[i : i + len(part)] == part for t in joined for i in range(len(t) - len(part) + 1)
                )
                place = next((k for k in range(len(s)) if count(s[k:]) >= need), len(s))
                assert r == b + place, trial


def test_query_on_all_rows(spark, small):
    got = Counter(map(tuple, queries.op7_substring_dedup(spark, "/root/testdata/sf0.001").collect()))
    assert got == _expected(_rows(small), 35)
