import numpy as np
from pyspark.sql import functions as F

from claimloom.llm import queries, topk


def _expected(rows, k=5, scale=256.0):
    good = [
        (i, [int(np.floor(scale * x)) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = set()
    for q, v in good:
        if q % 50 == 0:
            best = {}
            for i, w in good:
                if i != q:
                    best[i] = max(best.get(i, -(1 << 63)), sum(a * b for a, b in zip(v, w, strict=False)))
            ranked = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
            out |= {(q, r + 1, i, s) for r, (i, s) in enumerate(ranked)}
    return out


def _found(df):
    rows = [tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def _search(spark, rows, **more):
    df = spark.createDataFrame(
        [(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, qb int, id long"
    )
    return _found(topk.top_k(df, F.col("vec_id") % 50 == 0, **more))


def test_odd_vectors(spark):
    rows = [
        (0, [1.0, 2.0]), (50, [1.0, 2.0, 3.0]), (1, [0.5, -1.0]), (2, [0.5, -1.0]), (3, None), (4, [1.0, None]),
        (5, [float("nan"), 1.0]), (6, [float("inf")]), (7, []), (8, [1.0]), (9, [1.0]), (9, [2.0]), (9, [1.0]), (None, [9.0]),
        (100, []), (-50, [-1.0, 0.25]), (10, [0.001, -0.001]),
    ]
    assert _search(spark, rows) == _expected(rows)
    assert _search(spark, [(0, [1.0])]) == set() and _search(spark, []) == set()
    assert _search(spark, [(1, [1.0]), (2, [1.0])]) == set()


def test_large_components(spark):
    rows = [(i, [1e12 * (i % 7), -3e9, 1.0]) for i in range(60)]
    low, high = -(1 << 63), (1 << 63) - 1
    # Scores are cut to a long before they are ranked.
    rows32 = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    expected = set()
    ints = [(i, [int(np.floor(256.0 * x)) for x in v]) for i, v in rows32]
    for q, v in ints:
        if q % 50 == 0:
            scored = [(min(high, max(low, sum(a * b for a, b in zip(v, w, strict=True)))), i) for i, w in ints if i != q]
            expected |= {(q, r + 1, i, s) for r, (s, i) in enumerate(sorted(scored, key=lambda x: (-x[0], x[1]))[:5])}
    assert _search(spark, rows) == expected


def test_many_blocks_ties_and_a_common_vector(spark, monkeypatch):
    draw = np.random.default_rng(3)
    rows = [(int(i), draw.normal(0, 0.1, 40).astype("float32").astype(float).tolist()) for i in range(700)]
    rows = [(i, rows[0][1] if i % 3 == 0 else v) for i, v in rows]
    monkeypatch.setattr(topk, "QUERY_BLOCK", 5)
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 150)
    assert _search(spark, rows) == _expected(rows)


def test_bounds_drop_candidates_but_no_result():
    draw = np.random.default_rng(5)
    vectors = np.floor(256 * draw.normal(0, 1, (64, 9000)) * draw.exponential(1, 9000))
    ids = draw.permutation(9000)
    got = topk.search_block(ids[:30], vectors[:, :30], ids, vectors, 5)
    expected = []
    for q in range(30):
        scores = vectors.T @ vectors[:, q]
        order = [j for j in np.lexsort((ids, -scores)) if j != q][:5]
        expected += [(int(ids[q]), int(ids[j]), int(scores[j])) for j in order]
    assert got == expected


def test_query(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()
    expected = _expected([(r.vec_id, r.embedding) for r in rows])
    assert _found(queries.op5_top_k(spark, "/root/testdata/sf0.001")) == expected


def test_grid_follows_bytes_and_cores():
    """A cell's vectors fit a bound whatever their width, and small tables use all tasks."""
    for n, asking, width in ((0, 0, 0), (5, 1, 3), (51282, 1026, 64), (10**7, 2 * 10**5, 64), (10**7, 2 * 10**5, 1536), (10**6, 10, 10**6)):
        q, c = topk.grid(n, asking, width, 12)
        per_cell = -(-asking // q) + -(-n // c)
        assert q >= 1 and c >= 1
        assert per_cell * width * 8 <= 1.3 * topk.CELL_BYTES or per_cell <= 2
    assert topk.grid(51282, 1026, 64, 12) == (1, 4) and topk.grid(100, 2, 64, 12) == (1, 1)


def test_wide_vectors(spark, monkeypatch):
    """Many cells by bytes alone."""
    monkeypatch.setattr(topk, "CELL_BYTES", 8 * 30 * 40)
    draw = np.random.default_rng(8)
    rows = [(int(i), draw.normal(0, 0.1, 30).astype("float32").astype(float).tolist()) for i in range(200)]
    assert _search(spark, rows) == _expected(rows)
