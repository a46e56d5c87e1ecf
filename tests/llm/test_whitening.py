"""Whitening against a dense eigensolver and exact integers; odd rows and empty tables."""

import numpy as np
import pytest

SCHEMA = "vec_id long, embedding array<float>, x string, component int"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, "x", 9) for i, v in vectors], SCHEMA)


def usable(v):
    return v is not None and len(v) > 0 and all(c is not None and np.isfinite(c) for c in v)


def check(spark, vectors, components=16, most=16):
    """Whitened rows of ``vectors`` equal the dense solution, up to the sign of a component."""
    from quantspark.llm.whitening import whitened_rows
    got = whitened_rows(table(spark, vectors), components=components).collect()
    kept = [(i, [int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v]) for i, v in vectors if usable(v)]
    fit = [list(x) for x in {tuple(x) for _, x in kept}]
    n, d = len(fit), len(fit[0])
    sums = [sum(x[j] for x in fit) for j in range(d)]
    centred = np.array([[(n * x[j] - sums[j]) / n for j in range(d)] for x in fit])
    _, singular, qt = np.linalg.svd(centred, full_matrices=False)
    values, q = singular**2 / n, qt.T
    k = min(components, d, int((values > 1e-12 * values[0]).sum()))
    assert k == most
    rows = {}
    for r in got:
        rows.setdefault((r["vec_id"], r["component"], r["deviation"]), []).append(r)
    assert sum(map(len, rows.values())) == len(kept) * k
    sign = {}
    for i, x in kept:
        dev = [n * x[j] - sums[j] for j in range(d)]
        for c in range(1, k + 1):
            want = float(np.array(dev) / n @ q[:, c - 1] / np.sqrt(values[c - 1]))
            for r in rows[(i, c, sum(e * e for e in dev))]:
                assert r["n"] == n
                assert r["explained"] == pytest.approx(values[c - 1] / values.sum(), rel=1e-9)
                assert r["identity_error"] <= 1e-8
                if c not in sign and abs(want) > 1e-3:
                    sign[c] = np.sign(want * r["whitened"])
                assert r["whitened"] * sign.get(c, 1) == pytest.approx(want, abs=1e-6)


def test_equals_dense_solution(spark):
    """Wide vectors: the block is smaller than the dimension, so the filter works; repeats and odd vectors mixed in."""
    rng = np.random.default_rng(5)
    base = rng.standard_normal((300, 80)) * np.linspace(3, 0.3, 80) + 5
    vectors = [(i, [float(c) for c in v]) for i, v in enumerate(base)]
    vectors += [(1000, vectors[4][1]), (1001, vectors[4][1]), (4, vectors[9][1]), (None, vectors[7][1]),
                (1002, None), (1003, []), (1004, [None] * 80), (1005, [float("nan")] + [0.0] * 79),
                (1006, [float("inf")] + [0.0] * 79)]
    check(spark, vectors)


def test_one_strong_direction_and_far_offset(spark):
    rng = np.random.default_rng(6)
    base = rng.standard_normal((200, 70)) * 0.5 + rng.standard_normal((200, 1)) * 400 + 3000
    check(spark, [(i, [float(c) for c in v]) for i, v in enumerate(base)], components=4, most=4)


def test_low_rank(spark):
    rng = np.random.default_rng(7)
    a = rng.integers(-5, 6, (60, 3)).astype(float)
    base = np.zeros((60, 60))
    base[:, :3] = a
    check(spark, [(i, [float(c) for c in v]) for i, v in enumerate(base)], most=3)


def test_no_variance_and_no_rows(spark):
    from quantspark.llm.whitening import whitened_rows
    same = [(i, [1.0, 2.0]) for i in range(3)]
    for vectors in (same, [], [(1, None)]):
        out = whitened_rows(table(spark, vectors))
        assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
        assert out.collect() == []


def test_lengths_must_agree(spark):
    from quantspark.llm.whitening import whitened_rows
    with pytest.raises(Exception, match="length"):
        whitened_rows(table(spark, [(1, [1.0]), (2, [1.0, 2.0])])).collect()


def test_given_table(spark):
    import __spark_entry__ as entry
    out = entry.queries()["op12_whiten"](spark, "/root/testdata/sf0.01").collect()
    assert len(out) == 500 * 16 and max(r["identity_error"] for r in out) <= 1e-4
