import re
from collections import Counter

import numpy as np
import pytest
from helpers_llm import texts_of
from pyspark.sql import functions as F

from claimloom.llm import mixing, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _targets(sizes, weights=(1, 2, 3), most=3):
    """Filling up by rounds: share by weight, cut, share what was cut."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, free = dict.fromkeys(names, 0.0), float(sum(sizes.values())), set(names)
    for _ in range(1000):
        total = sum(weight[s] for s in free)
        if left < 1e-9 or not total:
            break
        share, left = {s: left * weight[s] / total for s in free}, 0.0
        for s, x in share.items():
            target[s] += x
            over = target[s] - most * sizes[s]
            if over >= 0:
                left += over
                target[s] = float(most * sizes[s])
                free.discard(s)
    return target


def _check(docs, rows):
    texts = {d: t for d, t in texts_of(docs)}
    assert len(rows) == docs.count()
    sizes = Counter()
    for r in rows:
        assert r["size"] == len(WORD.findall(texts[r.doc_id] or "")) or r.doc_id is None
        assert 0 <= r.copies <= 3
        sizes[r.source] += r["size"]
    expected = _targets(sizes)
    taken = Counter()
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(expected[r.source], rel=1e-9, abs=1e-6)
        taken[r.source] += r.copies * r["size"]
    return {s: (taken[s], expected[s]) for s in sizes}


def test_odd_rows(odd, empty):
    _check(odd, mixing.mix(odd).collect())
    assert mixing.mix(empty).count() == 0 and mixing.repeat(empty).count() == 0
    blank = odd.withColumn("text", F.lit(None).cast("string"))
    assert {r.copies for r in mixing.mix(blank).collect()} == {0}


def test_query_comes_near_targets_and_repeats(spark, small):
    runs = [queries.op6_mix(spark, "/root/testdata/sf0.001").collect() for _ in range(2)]
    assert sorted(map(tuple, runs[0])) == sorted(map(tuple, runs[1]))
    # 200 documents in 20 sources: ten a source, some of thousands of words.
    near = _check(small, runs[0])
    total = sum(t for _, t in near.values())
    assert sum(abs(a - t) for a, t in near.values()) < 0.1 * total


def test_reduction_tree_and_a_hot_source(spark, monkeypatch):
    draw = np.random.default_rng(1)
    rows = [(i, "w " * int(draw.integers(1, 60)), "hot" if i % 3 else f"s{i % 4}") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 50)
    monkeypatch.setattr(mixing, "FAN_IN", 3)
    near = _check(docs, mixing.mix(docs).collect())
    assert all(abs(a - t) <= 30 for a, t in near.values())


def test_rounding_keeps_sums_and_expectations():
    draw = np.random.default_rng(2)
    size, p = draw.integers(1, 50, 40).astype(float), draw.random(40)
    mean = np.zeros(40)
    for _ in range(4000):
        rounded, held = mixing._settle(size, p, draw.random(40))
        assert abs((rounded * size).sum() - (p * size).sum()) < 1e-6
        assert all(min(abs(x), abs(x - 1)) < 1e-9 for i, x in enumerate(rounded) if i != held)
        mean += rounded / 4000
    assert np.abs(mean - p).max() < 0.05


def test_repeat(odd):
    out = mixing.repeat(odd)
    assert out.columns == odd.columns
    copies = Counter()
    for r in mixing.mix(odd).collect():
        copies[r.source] += r.copies * r["size"]
    words = Counter()
    for r in out.collect():
        words[r.source] += len(WORD.findall(r.text or ""))
    assert {s: n for s, n in words.items() if n} == {s: n for s, n in copies.items() if n}


def _plain_pivotal(size, p, draw):
    """Pairs in order, mass moved from one to the other until one of them is whole."""
    p, open_one = list(p), None
    for i in range(len(p)):
        if not 0 < p[i] < 1:
            continue
        if open_one is None:
            open_one = i
            continue
        k = open_one
        # Words that may go from i to k, and from k to i.
        gain = min((1 - p[k]) * size[k], p[i] * size[i])
        loss = min(p[k] * size[k], (1 - p[i]) * size[i])
        moved = gain if draw[i] < loss / (gain + loss) else -loss
        p[k], p[i] = p[k] + moved / size[k], p[i] - moved / size[i]
        for j in (k, i):
            p[j] = round(p[j]) if abs(p[j] - round(p[j])) < 1e-9 else p[j]
        open_one = next((j for j in (k, i) if 0 < p[j] < 1), None)
    return p, -1 if open_one is None else open_one


def test_rounding_against_a_plain_version():
    draw = np.random.default_rng(6)
    for _ in range(200):
        n = int(draw.integers(1, 30))
        size, p, u = draw.integers(1, 50, n).astype(float), draw.random(n), draw.random(n)
        p[draw.random(n) < 0.2] = draw.choice([0.0, 1.0])
        got, held = mixing._settle(size, p, u)
        expected, open_one = _plain_pivotal(size, p, u)
        assert np.allclose(got, expected, atol=1e-9) and held == open_one
