import random
import zlib
from collections import Counter, defaultdict

from claimloom.llm import queries, sharding


def _plain_best_fit(sizes, capacity):
    """Every size into the bin with the least sufficient room, searched from end to end."""
    room, out = [], []
    for size in sizes:
        fits = [(r, i) for i, r in enumerate(room) if r >= size]
        if fits:
            i = min(fits)[1]
        else:
            i = len(room)
            room.append(capacity)
        room[i] -= size
        out.append(i)
    return out


def test_tree_packs_like_a_full_search():
    draw = random.Random(1)
    for _ in range(30):
        sizes = sorted((draw.randint(1, 60) for _ in range(draw.randint(0, 200))), reverse=True)
        bins, n = sharding.best_fit(sizes, 100)
        plain = _plain_best_fit(sizes, 100)
        loads = lambda b: sorted(Counter({i: 0 for i in b} | {}).keys()) and sorted(
            sum(s for s, x in zip(sizes, b, strict=True) if x == i) for i in set(b)
        )
        assert loads(bins) == loads(plain) and n == len(set(plain))


def test_near_equal_with_giants():
    sizes = sorted([10_000, 9_000] + [random.Random(2).randint(1, 50) for _ in range(3000)], reverse=True)
    shards = sharding.near_equal(sizes, 8)
    loads = Counter()
    for s, i in zip(sizes, shards, strict=True):
        loads[i] += s
    rest = [v for v in loads.values() if v not in (10_000, 9_000)]
    assert len(loads) == 8 and max(rest) - min(rest) <= 200
    assert sharding.near_equal([], 8) == [] and len(sharding.near_equal([5, 5], 8)) == 2


def _check(docs, rows):
    texts = sorted(((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()), key=repr)
    assert len(rows) == len(texts)
    sized = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in texts)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == sized
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    of = {d: t or "" for d, t in texts}
    homes = defaultdict(set)
    for r in rows:
        if r.doc_id is not None:
            homes[of[r.doc_id]].add(r.shard)
    assert all(len(h) == 1 for h in homes.values())


def test_odd_rows(odd, empty):
    _check(odd, sharding.shard_by_bytes(odd).collect())
    assert sharding.shard_by_bytes(empty).count() == 0


def test_query(spark, small):
    rows = queries.op3_shards(spark, "/root/testdata/sf0.001").collect()
    _check(small, rows)
    loads = Counter()
    for r in rows:
        loads[r.shard] += r["size"]
    assert set(loads) == set(range(8)) and max(loads.values()) < 1.1 * min(loads.values())
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}


def test_hot_group(spark):
    """A third of all rows are one text."""
    rows = [(i, "hot" if i % 3 == 0 else f"text {i}" * (i % 7)) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    _check(docs, sharding.shard_by_bytes(docs).collect())
