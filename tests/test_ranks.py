import numpy as np
import pandas as pd
import pytest

from schoolzones.operators import ranks


@pytest.fixture(scope="module")
def skewed():
    """A key with most rows, many equal values, whole-number weights."""
    rng = np.random.default_rng(3)
    n = 1500
    return pd.DataFrame(
        {
            "k": rng.choice(list("abcd"), n, p=[0.7, 0.2, 0.08, 0.02]),
            "v": rng.integers(0, 60, n).astype(float),
            "w": rng.integers(0, 5, n).astype(float),
            "id": np.arange(n),
        }
    )


def test_running_sum(spark, skewed):
    out = ranks.running_sum(spark.createDataFrame(skewed), ["k"], ["v", "id"], "w", "upto", "total", block_rows=len(skewed) // 7).toPandas()
    out = out.sort_values(["k", "v", "id"])
    assert (out.groupby("k").w.cumsum() == out.upto).all() and len(out) == len(skewed)
    assert (out.groupby("k").w.transform("sum") == out.total).all()


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [x for x in plan.splitlines() if "Exchange " in x and "BroadcastExchange" not in x]


@pytest.mark.parametrize("block_rows", [3, 100, 10_000])
def test_running_sum_of_any_rows(spark, skewed, block_rows):
    """NULL keys, weights and orders, a text in the order, ties, columns with the operator's names; keys or none."""
    rng = np.random.default_rng(9)
    rows = [
        (None if k == "d" else k, None if v == 3 else float(v), f"é{i % 17}" if i % 5 else None, i, None if w == 0 or v < 9 else int(w), 1, 2)
        for i, (k, v, w) in enumerate(zip(skewed.k, skewed.v, skewed.w))
    ]
    df = spark.createDataFrame([rows[i] for i in rng.permutation(len(rows))], "k string, v double, t string, id int, w long, _n int, upto int")
    first = lambda r: tuple((x is not None, x) for x in (r[1], r[2], r[3]))
    for keys in (["k"], []):
        out = ranks.running_sum(df, keys, ["v", "t", "id"], "w", "sum", "total", block_rows)
        assert out.columns == [*df.columns, "sum", "total"] and len(exchanges(out)) == 1
        got = {r.id: (r["sum"], r.total) for r in out.collect()}
        groups = {}
        for r in sorted(rows, key=lambda r: tuple((a, b if a else 0) for a, b in first(r))):
            groups.setdefault(r[0] if keys else 0, []).append(r)
        assert len(got) == len(rows)
        for g in groups.values():
            total, upto = sum(r[4] or 0 for r in g), None
            for r in g:
                upto = upto if r[4] is None else (upto or 0) + r[4]
                assert got[r[3]] == (upto, total)


def test_blocks_are_bounded(spark):
    df = spark.range(20_000).selectExpr("if(id % 10 < 9, 'hot', cast(id as string)) as k", "id", "1L as w")
    bounds = ranks._blocks(df, ["k"], ["id"], 500).collect()
    (hot,) = bounds
    cuts = [b["_o0"] for b in hot["_bounds"]]
    assert hot["_k_k"] == "hot" and len(cuts) <= 36 and cuts == sorted(cuts)
    sizes = np.diff([0, *cuts, 20_000])
    assert sizes.max() < 4 * 500


def test_quantiles(spark, skewed):
    shares = [0, 0.1, 0.25, 0.5, 0.9, 1]
    df = spark.createDataFrame(skewed)
    out = {r.k: r.q for r in ranks.quantiles(df, ["k"], "v", shares).collect()}
    for k, g in skewed.groupby("k"):
        assert out[k] == pytest.approx(list(g.v.quantile(shares)))
    assert ranks.quantiles(df, [], "v", [0.5]).first().q == [skewed.v.median()]


@pytest.mark.parametrize(
    "values",
    [
        [0, 0, 0, 1, 2, 3], [1, 1, 1], [5.0], [1, 2, 3, 4, 5, 6, 7, 8, 9, 10], [1, 1, 2, 2, 2, 9, 9, 9, 9, 9, 9],
        [0.1, None, 0.7, 0.30000000000000004, 0.3, None],
    ],
)
def test_quantile_bins_like_pandas(spark, values):
    expected = pd.qcut(pd.Series(values, dtype=float), 5, labels=False, duplicates="drop")
    df = spark.createDataFrame([(i, None if v is None else float(v)) for i, v in enumerate(values)], "i int, v double")
    out = {r.i: r.b for r in ranks.quantile_bins(df, "v", 5, "b").collect()}
    assert [out[i] for i in range(len(values))] == [None if pd.isna(x) else int(x) for x in expected]


def reference_median(g):
    g = g.sort_values(["v", "id"])
    upto, half = g.w.cumsum(), g.w.sum() / 2
    low, high = g[upto <= half], g[upto > half]
    if low.empty or high.empty:
        return None
    a, b = upto[upto <= half].iloc[-1], upto[upto > half].iloc[0]
    return low.v.iloc[-1] + (half - a) / (b - a) * (high.v.iloc[0] - low.v.iloc[-1])


def test_weighted_median(spark, skewed):
    rng = np.random.default_rng(5)
    data = pd.concat([skewed, skewed.assign(k=[f"s{i}" for i in rng.integers(0, 200, len(skewed))])])
    out = {r.k: r.m for r in ranks.weighted_median(spark.createDataFrame(data), "k", "v", "w", "id", "m").collect()}
    for k, g in data.groupby("k"):
        expected = reference_median(g)
        assert out[k] == (None if expected is None else pytest.approx(expected)), k


def test_weighted_median_edges(spark):
    rows = [
        ("single", 5.0, 1.0, 1), ("first", 1.0, 9.0, 1), ("first", 2.0, 1.0, 2), ("half", 10.0, 2.0, 1),
        ("half", 20.0, 2.0, 2), ("tie", 3.0, 1.0, 1), ("tie", 3.0, 1.0, 2), ("tie", 3.0, 5.0, 3), ("zero", 1.0, 0.0, 1),
    ]
    df = spark.createDataFrame(rows, "k string, v double, w double, id int")
    out = {r.k: r.m for r in ranks.weighted_median(df, "k", "v", "w", "id", "m").collect()}
    assert out == {"single": None, "first": None, "half": 10.0, "tie": 3.0, "zero": None}


def test_first_per_key_puts_null_last(spark):
    rows = [(1, None, "a"), (1, 2.0, "c"), (1, 2.0, "b"), (2, None, "z")]
    df = spark.createDataFrame(rows, "k int, d double, id string")
    out = ranks.first_per_key(df, ["k"], ["d", "id"])
    assert out.columns == df.columns
    assert sorted(map(tuple, out.collect())) == [(1, 2.0, "b"), (2, None, "z")]


def test_density(spark, skewed):
    out = ranks.density(spark.createDataFrame(skewed), ["k"], "v", 0.2, 100).toPandas()
    for k, g in skewed.groupby("k"):
        x = np.linspace(g.v.min(), g.v.max(), 100)
        h = 0.2 * g.v.std()
        d = np.exp(-0.5 * ((x[:, None] - g.v.values[None]) / h) ** 2).sum(1)
        got = out[out.k == k].sort_values("grid_no")
        assert got.grid_x.values == pytest.approx(x) and got.density.values == pytest.approx(d / d.max())


@pytest.mark.parametrize("kind", ["normal", "outlier", "two points", "ties", "far", "tiny"])
def test_density_is_within_its_bound(spark, kind):
    rng = np.random.default_rng(4)
    v = {
        "normal": rng.normal(3, 2, 700),
        "outlier": np.concatenate((rng.normal(0, 1, 400), [1e5, -3e4])),  # kernels much narrower than the grid
        "two points": np.array([1.0, 2.0]),
        "ties": np.repeat(rng.integers(0, 5, 9), 50).astype(float),
        "far": 1e9 + rng.normal(0, 1, 300),
        "tiny": rng.gamma(0.3, 1e-7, 300),
    }[kind]
    df = spark.createDataFrame([("a", float(x)) for x in v] + [("b", 1.0), (None, 5.0), (None, 6.0), ("a", None)], "k string, v double")
    out = ranks.density(df, ["k"], "v", 0.2, 100).toPandas()
    assert set(out.k) == {"a", "b"}
    got = out[out.k == "a"].sort_values("grid_no")
    x, h = np.linspace(v.min(), v.max(), 100), 0.2 * v.std(ddof=1)
    d = np.exp(-0.5 * ((x[:, None] - v[None]) / h) ** 2).sum(1)
    off = 1e-8 if kind == "far" else 1e-12  # the values themselves have few digits left
    assert len(got) == 100 and np.abs(got.density.values - d / d.max()).max() < off


def test_density_of_one_value(spark):
    df = spark.createDataFrame([("a", 4.0), ("a", 4.0), ("b", 1.0)], "k string, v double")
    assert sorted(map(tuple, ranks.density(df, ["k"], "v", 0.2, 100).collect())) == [("a", 0, 4.0, 1.0), ("b", 0, 1.0, 1.0)]
