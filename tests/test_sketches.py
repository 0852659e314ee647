import numpy as np
import pytest

from schoolzones.operators import sketches
from schoolzones.session import scratch_path
from schoolzones.sources import versions


@pytest.fixture(scope="module")
def rows(spark):
    """Three days; a key with very many ids, a small one, one without values."""
    rng = np.random.default_rng(5)
    n = 60_000
    data = [("big", f"2024-03-0{i % 3 + 1}", int(a), float(v)) for i, (a, v) in enumerate(zip(rng.integers(0, 40_000, n), rng.gamma(2, 3, n)))]
    data += [("small", "2024-03-01", i % 7, float(i)) for i in range(50)]
    data += [("none", "2024-03-02", None, None), ("none", "2024-03-02", None, float("nan"))]
    return spark.createDataFrame(data, "k string, d string, id long, v double").cache()


def stored(rows, path, where="true"):
    return sketches.store(sketches.daily(rows.filter(where), ["k"], "d", "id", "v"), path)


def test_estimates_are_within_their_bounds(spark, rows):
    path = scratch_path(spark, "sketches")
    stored(rows, path, "d < '2024-03-03'")
    stored(rows, path, "d = '2024-03-03'")
    both = sketches.between(spark, path, "2024-03-01", "2024-03-03")
    exact = {r["k"]: r["n"] for r in rows.groupBy("k").agg({"id": "count"}).withColumnRenamed("count(id)", "n").collect()}
    pandas = rows.toPandas()
    got = {r["k"]: r["ids"] for r in sketches.distinct_counts(both, ["k"], "ids").collect()}
    for k, g in pandas.groupby("k"):
        assert got[k] == pytest.approx(g.id.nunique(), rel=4 * sketches.DISTINCT_ERROR)
    shares = [0.0, 0.1, 0.5, 0.99, 1.0]
    q = {r["k"]: r["q"] for r in sketches.quantiles(both, ["k"], shares).collect()}
    assert q["none"] is None and exact["small"] == 50
    for k in ("big", "small"):
        v = np.sort(pandas[pandas.k == k].v.values)
        for share, x in zip(shares, q[k]):
            low, high = np.searchsorted(v, x, "left") / len(v), np.searchsorted(v, x, "right") / len(v)
            assert low - 2 * sketches.RANK_ERROR <= share + 1 / len(v) and high + 2 * sketches.RANK_ERROR >= share


def test_a_day_that_comes_again_replaces_itself_only(spark, rows):
    path = scratch_path(spark, "sketches")
    first = stored(rows, path)
    second = stored(rows, path, "d = '2024-03-02'")
    kept = {x for x in first.folders if "2024-03-02" not in x}
    assert kept < set(second.folders) and len(second.folders) == 3
    n = {r["day"].isoformat(): r["n"] for r in versions.read(spark, path).groupBy("day").sum("n").withColumnRenamed("sum(n)", "n").collect()}
    assert n == {f"2024-03-0{i}": (20_050 if i == 1 else 20_002 if i == 2 else 20_000) for i in (1, 2, 3)}
    one = sketches.between(spark, path, "2024-03-01", "2024-03-01")
    assert sketches.distinct_counts(one.filter("k = 'small'"), ["k"], "ids").first()["ids"] == 7
