import numpy as np
import pytest

from claimloom.llm import queries, whitening

FOLDER = "/root/testdata/sf0.001"


def _expected(rows, components=8):
    """{vec_id: (deviation, whitened)} without Spark, shares of variance, exact sums."""
    good = [(i, v) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    sizes = [len(v) for _, v in good]
    size = max(set(sizes), key=lambda s: (sizes.count(s), s))
    good = [(i, [int(np.floor(1024 * x)) + 100000 for x in v]) for i, v in good if len(v) == size]
    n, sums = len(good), [sum(c) for c in zip(*(x for _, x in good), strict=True)]
    x = np.array([v for _, v in good], float) - np.array(sums) / n
    values, axes = np.linalg.eigh(x.T @ x / n)
    values, axes = values[::-1], axes[:, ::-1]
    k = min(components, int((values > values[0] * size * 2.3e-16).sum()))
    y = x @ axes[:, :k] / np.sqrt(values[:k])
    away = [sum((n * a - s) ** 2 for a, s in zip(v, sums, strict=True)) for _, v in good]
    return n, [(i, d, row) for (i, _), d, row in zip(good, away, y, strict=True)], values[:k] / values.sum()


def _check(found, rows):
    n, expected, share = _expected(rows)
    k = len(share)
    assert len(found) == n * k and {r.n for r in found} == {n}
    assert max(abs(r.explained / share[r.component - 1] - 1) for r in found) < 1e-9
    assert len({r.identity_error for r in found}) == 1 and found[0].identity_error < 1e-9
    got = sorted((r.vec_id is None, r.vec_id or 0, r.deviation, r.component, abs(r.whitened)) for r in found)
    wanted = sorted(
        (i is None, i or 0, d, c + 1, abs(y)) for i, d, row in expected for c, y in enumerate(row)
    )
    assert [g[:4] for g in got] == [w[:4] for w in wanted]
    assert np.allclose([g[4] for g in got], [w[4] for w in wanted], atol=1e-7)


def test_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    found = queries.op12_whitening(spark, FOLDER).collect()
    _check(found, rows)
    # Signs are those of one matrix for all rows.
    y = np.zeros((len(rows), 8))
    place = {i: k for k, (i, _) in enumerate(rows)}
    for r in found:
        y[place[r.vec_id], r.component - 1] = r.whitened
    assert np.abs(y.T @ y / len(rows) - np.eye(8)).max() < 1e-9


def _frame(spark, rows):
    return spark.createDataFrame(
        [(i, v, 1, 2, "x") for i, v in rows], "vec_id long, embedding array<float>, block int, n long, y string"
    )


def test_odd_vectors(spark):
    draw = np.random.default_rng(2)
    rows = [(int(i), draw.normal(0, 1, 3).astype("float32").tolist()) for i in range(40)]
    rows += [(3, rows[3][1]), (None, rows[4][1]), (None, None), (50, None), (51, [1.0, None, 2.0]), (52, []),
             (53, [float("nan"), 0.0, 0.0]), (54, [float("inf"), 0.0, 0.0]), (55, [1.0]), (56, [1.0, 2.0, 3.0, 4.0])]
    found = whitening.whitened_rows(_frame(spark, rows)).collect()
    assert {r.component for r in found} == {1, 2, 3}
    _check(found, rows)


def test_no_variance(spark):
    for rows in ([], [(1, [0.5, 2.0])], [(1, [0.5]), (2, [0.5])], [(1, []), (2, [])], [(1, None)]):
        out = whitening.whitened_rows(_frame(spark, rows))
        assert out.collect() == []
        assert out.columns == [
            "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"
        ]


def test_constant_dimension_is_left_out(spark):
    rows = [(i, [float(i), 7.0, float(i % 3)]) for i in range(12)]
    found = whitening.whitened_rows(_frame(spark, rows)).collect()
    assert {r.component for r in found} == {1, 2}
    _check(found, rows)


def test_many_blocks_and_panels(spark):
    draw = np.random.default_rng(4)
    mixed = draw.normal(0, 1, (300, 12)) @ draw.normal(0, 1, (12, 12))
    rows = [(int(i), v.astype("float32").tolist()) for i, v in enumerate(mixed)]
    docs = _frame(spark, rows).repartition(3)
    _check(whitening.whitened_rows(docs, block_bytes=8 * 12 * 16, panel_blocks=4).collect(), rows)


def test_deviation_is_exact_or_null():
    x = np.array([[3_000_000_000, 1], [0, 0]], np.int64)
    assert whitening.deviation(x, 2, [3_000_000_000, 1]) == [9 * 10**18 + 1, 9 * 10**18 + 1]
    assert whitening.deviation(x * 2, 2, [6_000_000_000, 2]) == [None, None]


def test_huge_entries_do_not_fail(spark):
    rows = [(1, [1e38, 0.0]), (2, [-1e38, 1.0]), (3, [0.0, 2.0])]
    found = whitening.whitened_rows(_frame(spark, rows)).collect()
    assert all(np.isfinite(r.whitened) for r in found) and {r.deviation for r in found if r.vec_id < 3} == {None}


def test_too_many_dimensions_are_refused(spark, monkeypatch):
    monkeypatch.setattr(whitening, "DIMENSIONS", 2)
    with pytest.raises(ValueError, match="3 entries"):
        whitening.whitened_rows(_frame(spark, [(1, [1.0, 2.0, 3.0])]))
