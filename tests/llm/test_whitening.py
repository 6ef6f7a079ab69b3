"""Whitening against exact fractions and plain linear algebra."""

import os
from fractions import Fraction
from math import floor

import numpy as np
import pytest

from tillwise.llm import queries, whitening

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def brute(rows, scale=64, offset=1_000_000, components=16):
    """Per row: id and deviation; and n, eigenvalues, eigenvectors, means."""
    whole = [(i, [floor(scale * c) + offset for c in v]) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in whole})
    n, d = len(fit), len(fit[0])
    total = [sum(x[k] for x in fit) for k in range(d)]
    centred = [[n * x[k] - total[k] for k in range(d)] for x in fit]
    cov = np.array([[float(Fraction(sum(r[i] * r[j] for r in centred), n**3)) for j in range(d)] for i in range(d)])
    value, turn = np.linalg.eigh(cov)
    deviation = [(i, sum((n * c - s) ** 2 for c, s in zip(x, total))) for i, x in whole]
    mean = [Fraction(s, n) for s in total]
    flat = [(i, [float(c - m) for c, m in zip(x, mean)]) for i, x in whole]
    return n, deviation, flat, value[::-1], turn[:, ::-1], np.trace(cov)


def check(got, rows, k):
    n, deviation, flat, value, turn, trace = brute(rows)
    assert len(got) == len(flat) * k
    by = {}
    for r in got:
        by.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, []).append(r)
        assert r.n == n and r.identity_error <= 1e-9
        assert r.explained == pytest.approx(value[r.component - 1] / trace, rel=1e-9)
    assert sorted(map(str, by)) == sorted({str(x) for x in deviation})
    project = turn[:, :k] / np.sqrt(value[:k])
    for c in range(1, k + 1):
        want = {}
        for i, x in flat:
            want.setdefault(i, set()).add(float(np.array(x) @ project[:, c - 1]))
        mine = {}
        for (i, _), parts in by.items():
            mine.setdefault(i, set()).update(r.whitened for r in parts[c])
        close = [all(np.allclose(sorted(s * w for w in want[i]), sorted(mine[i]), atol=1e-7) for i in want) for s in (1, -1)]
        assert any(close), c


def table(spark, rows, kind="float"):
    df = spark.createDataFrame([(i, v, 3) for i, v in rows], f"vec_id long, embedding array<{kind}>, label int")
    return df.selectExpr("*", "'x' AS id", "1 AS n", "2 AS component", "3 AS v", "4 AS i", "5 AS deviation")


def spread(n, d, seed=1):
    rng = np.random.default_rng(seed)
    return [(int(k), (rng.normal(size=d) * rng.uniform(0.2, 3, d) + rng.normal()).tolist()) for k in range(n)]


def test_rows_that_repeat_or_take_no_part(spark):
    rows = spread(60, 4) + [(None, [1.0, 2.0, 3.0, 4.0]), (7, [0.5, 0.25, 0.0, -0.0]), (7, [0.5, 0.25, 0.0, -0.0])]
    rows += [(100, None), (101, []), (102, [1.0, None, 2.0, 3.0]), (103, [float("nan")] * 4), (104, [float("inf"), 0.0, 0.0, 0.0])]
    check(whitening.whiten(table(spark, rows, "double")).collect(), rows, 4)


def test_far_mean_and_few_components(spark):
    rows = [(i, [x + 5e8 for x in v]) for i, v in spread(50, 6)]
    check(whitening.whiten(table(spark, rows, "double"), components=3).collect(), rows, 3)


def test_huge_entries_stay_exact(spark):
    rows = [(i, [c * 2**44 for c in v]) for i, v in spread(9, 2)]
    for r in whitening.whiten(table(spark, rows, "double")).collect():
        assert r.identity_error < 1e-6 and r.deviation is None


def test_no_variance(spark):
    assert whitening.whiten(table(spark, [])).collect() == []
    assert whitening.whiten(table(spark, [(1, None)])).collect() == []
    assert whitening.whiten(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    flat = [(i, [float(i), 2.0]) for i in range(5)]
    got = whitening.whiten(table(spark, flat)).collect()
    assert {r.component for r in got} == {1} and {r.explained for r in got} == {1.0} and len(got) == 5
    with pytest.raises(ValueError, match="lengths"):
        whitening.whiten(table(spark, [(1, [1.0]), (2, [1.0, 2.0])])).collect()


def test_polarised_sums():
    y = np.random.default_rng(2).integers(-1000, 1000, (30, 5))
    s = whitening.polarised(y)
    for i in range(5):
        assert s[i, i] == (y[:, i] ** 2).sum()
        for j in range(i + 1, 5):
            assert s[i, j] == ((y[:, i] + y[:, j]) ** 2).sum()
    big = y.astype("int64") << 50
    assert whitening.polarised(big)[0, 1] == s[0, 1] << 100


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    check(queries.QUERIES["op11_whitening"](spark, SF).collect(), rows, 16)
