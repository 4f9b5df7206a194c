import random
import re

import xxhash
from helpers_llm import texts_of

from claimloom.llm import components, queries, simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _fingerprint(text, n=3):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _classes(prints, most=2):
    """Component of each fingerprint by comparing all pairs."""
    prints = sorted(set(prints))
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(prints):
        for b in prints[:i]:
            if (a ^ b).bit_count() <= most:
                root[find(a)] = find(b)
    return {p: find(p) for p in prints}


def _expected(rows):
    prints = [(d, _fingerprint(t)) for d, t in rows]
    classes = _classes(p for _, p in prints)
    least = {}
    for d, p in prints:
        if d is not None:
            least[classes[p]] = min(d, least.get(classes[p], d))
    return sorted(((d, p, least.get(classes[p])) for d, p in prints), key=repr)


def _found(df):
    return sorted(((r.doc_id, r.bits % (1 << 64), r.component_id) for r in df.collect()), key=repr)


def test_same_as_all_pairs(odd, small, empty):
    for docs in (odd, small):
        assert _found(simhash.near_duplicates(docs)) == _expected(texts_of(docs))
    assert simhash.near_duplicates(empty).count() == 0


def test_links_lose_no_component(spark):
    """Dense neighbourhoods: every point of several balls, chains of flips, far points."""
    draw = random.Random(4)
    prints = set()
    for _ in range(12):
        a = draw.getrandbits(64)
        prints.add(a)
        prints |= {a ^ (1 << b) for b in draw.sample(range(64), 40)}
        for _ in range(25):
            a ^= (1 << draw.randrange(64)) | (1 << draw.randrange(64))
            prints.add(a)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    bits = spark.createDataFrame([(p,) for p in signed], "bits long")
    found = {r.node % (1 << 64): r.root for r in components.components(simhash.links(bits)).collect()}
    classes = _classes(prints)
    same = {}
    for p, c in classes.items():
        same.setdefault(c, set()).add(found.get(p, p))
    assert all(len(roots) == 1 for roots in same.values())
    assert len({next(iter(r)) for r in same.values()}) == len(same)


def test_components_of_a_long_path(spark):
    path = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(500, 500)], "a long, b long")
    assert {r.root for r in components.components(path).collect()} == {0}
    assert components.components(path.limit(0)).count() == 0


def test_keep_one(odd, empty):
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    rows = [tuple(r)[:2] for r in kept.collect()]
    expected = _expected(texts_of(odd))
    components_kept = [_classes(p for _, p, _ in expected)[_fingerprint(t)] for _, t in rows]
    assert len(components_kept) == len(set(components_kept)) == len(set(_classes(p for _, p, _ in expected).values()))
    assert simhash.keep_one(empty).count() == 0


def test_query(spark, small):
    rows = queries.op4_simhash(spark, "/root/testdata/sf0.001").collect()
    expected = [(d, f"{p:016x}", c) for d, p, c in _expected(texts_of(small))]
    assert sorted(map(tuple, rows)) == sorted(expected)


def test_keep_one_of_each_component_where_ids_clash(spark):
    """One doc_id on two unrelated texts: each group of near-duplicates keeps one of its own."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(5, a), (5, b), (9, b), (3, c), (7, c), (5, c), (None, b), (8, a)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted((r.doc_id, r.text) for r in simhash.keep_one(docs).collect())
    assert kept == [(3, c), (5, a), (5, b)]
