"""Property checks against NumPy on random inputs (few examples: each runs Spark jobs)."""

from __future__ import annotations

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cadenza.operators import distribution as D
from cadenza.operators.quantiles import percentiles_long

_SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

groups = st.lists(
    st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.one_of(st.none(), st.integers(-50, 50).map(float), st.floats(-1e3, 1e3))),
    min_size=1,
    max_size=120,
)


@_SETTINGS
@given(rows=groups, buckets=st.sampled_from([2, 4, 16]))
def test_bucketed_percentiles_equal_numpy(spark, rows, buckets):
    df = spark.createDataFrame(rows, "g int, v double")
    probs = [0.0, 0.25, 0.5, 0.999, 1.0]
    got = {(r.g, r.p): r.value for r in percentiles_long(df, ["g"], ["v"], probs, buckets=buckets).collect()}
    for g in {g for g, _ in rows}:
        vals = np.array([v for gg, v in rows if gg == g and v is not None])
        for p in probs:
            if len(vals) == 0:
                assert (g, p) not in got
            else:
                assert np.isclose(got[(g, p)], np.quantile(vals, p), rtol=1e-9, atol=1e-9)


@_SETTINGS
@given(values=st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=200), bins=st.integers(1, 12))
def test_equal_width_histogram_equals_numpy(spark, values, bins):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r["count"] for r in D.equal_width_histogram(df, "x", bins).orderBy("bin").collect()]
    if min(values) == max(values):
        assert got[0] == len(values) and sum(got) == len(values)
    else:
        want, _ = np.histogram(values, bins=bins)
        assert sum(got) == len(values)
        # Bin edges are computed the same way up to rounding of the edge itself.
        assert np.abs(np.array(got) - want).sum() <= 2


def test_kernel_density_equals_numpy(spark):
    rng = np.random.default_rng(2)
    xs = np.round(rng.normal(10, 3, 300), 1)
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    got = {r.point: r.density for r in D.kernel_density(df, "x", 20).collect()}
    h = xs.std(ddof=1) * len(xs) ** -0.2
    grid = np.linspace(xs.min(), xs.max(), 20)
    want = np.exp(-0.5 * ((grid[:, None] - xs[None, :]) / h) ** 2).sum(axis=1) / (len(xs) * h * np.sqrt(2 * np.pi))
    assert np.allclose([got[i] for i in range(20)], want, rtol=1e-9)


def test_binned_mutual_information_equals_numpy(spark):
    from cadenza.operators.association import mutual_information_binned

    rng = np.random.default_rng(4)
    x = rng.integers(0, 20, 500).astype(float)
    y = x + rng.integers(0, 5, 500)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    got = mutual_information_binned(df, "y", ["x"], bins=5).first().mutual_information

    def bins(v):
        return np.minimum(np.floor((v - v.min()) / (v.max() - v.min()) * 5), 4).astype(int)

    joint = np.zeros((5, 5))
    for a, b in zip(bins(x), bins(y)):
        joint[a, b] += 1
    p = joint / joint.sum()
    px, py = p.sum(axis=1, keepdims=True), p.sum(axis=0, keepdims=True)
    nz = p > 0
    want = (p[nz] * np.log(p[nz] / (px @ py)[nz])).sum()
    assert np.isclose(got, want, rtol=1e-9)


def test_corr_matrix_is_symmetric_with_unit_diagonal(spark):
    from cadenza.operators.association import corr_matrix

    rng = np.random.default_rng(6)
    rows = [(float(a), float(b), float(c)) for a, b, c in rng.normal(size=(200, 3))]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    m = {(r.left, r.right): r.correlation for r in corr_matrix(df, ["a", "b", "c"]).collect()}
    for i in "abc":
        assert np.isclose(m[(i, i)], 1.0)
        for j in "abc":
            assert np.isclose(m[(i, j)], m[(j, i)])
    assert np.isclose(m[("a", "b")], np.corrcoef(np.array(rows).T)[0, 1])
