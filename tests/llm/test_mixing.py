import math
from collections import Counter, defaultdict

import pytest

from schoolzones.llm import mixing
from schoolzones.llm.mixing import Target

#: Tokens of each document, by source.
SIZES = {"big": [9] * 400, "mid": [3, 8, 1] * 30, "small": [5, 2] * 9, None: [4] * 10, "blank": [0] * 3}


@pytest.fixture
def corpus(spark):
    rows, i = [], 0
    for source, sizes in SIZES.items():
        for n in sizes:
            rows.append((i, "t " * n if n else (None, "", " ")[i % 3], source))
            i += 1
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def totals():
    return {s: sum(v) for s, v in SIZES.items()}


def weights(a):
    t = {s: n / sum(totals().values()) for s, n in totals().items()}
    z = sum(p**a for p in t.values() if p)
    return {s: p**a / z if p else 0.0 for s, p in t.items()}


def solve(ok):
    """The least exponent in [0, 1] for which ``ok`` holds, by halving."""
    low, high = 0.0, 1.0
    if ok(low):
        return low
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (low, mid) if ok(mid) else (mid, high)
    return high


def check(rows, a, budget=None):
    w, t = weights(a), totals()
    budget = budget or max(t[s] / w[s] for s in t if t[s])
    passed = defaultdict(list)
    for r in rows:
        passed[r["source"]].append(r)
    for s, sizes in SIZES.items():
        want, n = round(w[s] * budget), t[s]
        if not n:
            assert sorted(r["epoch"] for r in passed[s]) == [0] * len(sizes)
            continue
        by_epoch = Counter(r["epoch"] for r in passed[s])
        full = want // n
        assert all(by_epoch[e] == len(sizes) for e in range(full))
        assert set(by_epoch) <= set(range(full + 1))
        got = sum(r["n_tokens"] for r in passed[s])
        assert want <= got < want + max(sizes) or want == got, s
        at = 0  # the token positions are a gapless pass through the blocks
        for r in sorted(passed[s], key=lambda r: (r["token_at"], r["n_tokens"])):
            assert r["token_at"] == at
            at += r["n_tokens"]
        blocks = [(r["epoch"], r["block"]) for r in sorted(passed[s], key=lambda r: (r["token_at"], r["n_tokens"]))]
        assert len([1 for x, y in zip(blocks, blocks[1:]) if x != y]) == len(set(blocks)) - 1


@pytest.mark.parametrize("limit", [1.0, 2.0, 3.5, 1000.0])
def test_repetition_limit(corpus, limit):
    t = totals()

    def most(a):
        w = weights(a)
        budget = max(t[s] / w[s] for s in t if t[s])
        return max(w[s] * budget / t[s] for s in t if t[s])

    a = solve(lambda x: most(x) <= limit * (1 + 1e-12))
    rows = mixing.mix(corpus, Target(repetition=limit)).collect()
    check(rows, a)
    assert {r["doc_id"] for r in rows} == set(range(sum(map(len, SIZES.values()))))  # no document is dropped


def test_entropy(corpus):
    def entropy(a):
        return -sum(w * math.log(w) for w in weights(a).values() if w)

    goal = 1.1
    a = solve(lambda x: entropy(x) <= goal)
    assert entropy(a) == pytest.approx(goal)
    check(mixing.mix(corpus, Target(entropy=goal)).collect(), a)
    low = mixing.mix(corpus, Target(entropy=0.01)).collect()  # out of reach: the shares as they are
    check(low, 1.0)


def test_budget_and_order(corpus):
    rows = mixing.mix(corpus, Target(repetition=2.0, tokens=900)).collect()
    n = sum(totals().values())
    a = solve(lambda x: max(weights(x)[s] * 900 / totals()[s] for s in SIZES if totals()[s]) <= 2.0)
    check(rows, a, 900)
    assert n > 900
    half = Counter()
    for r in rows:
        if r["mix_at"] < 0.5:
            half[r["source"]] += r["n_tokens"]
    assert half["big"] / sum(half.values()) == pytest.approx(weights(a)["big"], abs=0.05)


def test_epochs_are_permutations_and_keyed(corpus):
    key = lambda rows, e: [r["doc_id"] for r in sorted(rows, key=lambda r: r["token_at"]) if r["epoch"] == e]
    rows = [r for r in mixing.mix(corpus, Target(repetition=3.0)).collect() if r["source"] == "small"]
    assert sorted(key(rows, 0)) == sorted(key(rows, 1)) and key(rows, 0) != key(rows, 1)
    again = [r for r in mixing.mix(corpus, Target(repetition=3.0)).collect() if r["source"] == "small"]
    assert key(rows, 0) == key(again, 0)
    other = [r for r in mixing.mix(corpus, Target(repetition=3.0), seed=99).collect() if r["source"] == "small"]
    assert key(rows, 0) != key(other, 0)


def test_stage(documents):
    df = documents(["a b c", "a b c", None, "", "x y"], ids=[1, 1, 2, None, 3], sources=["s", "s", "t", None, "u"])
    out = mixing.repeat_rows(df, Target(repetition=1.0))
    assert out.columns == df.columns
    assert sorted(map(str, out.collect())) == sorted(map(str, df.collect()))
    assert mixing.repeat_rows(df.limit(0)).count() == 0 and mixing.mix(df.limit(0)).count() == 0


def test_rows_that_share_a_doc_id_are_counted_one_by_one(documents):
    """doc_id 1 is in two sources, a row is there twice, ids are missing, and columns have the operator's names."""
    big = [f"s{i} a b c d e f g h" for i in range(40)]
    values = ["one two three", "other text here", "same row", "same row", "no id", "no id either"] + big
    ids = [1, 1, 2, 2, None, None] + list(range(100, 140))
    df = documents(values, ids, ["t", "u", "t", "t", "t", "u"] + ["s"] * 40)
    df = df.withColumnRenamed("fp", "_copies").withColumnRenamed("quality", "mine").withColumnRenamed("lang", "n_passes")
    target = Target(repetition=3.0)
    out = mixing.repeat_rows(df, target)
    assert out.columns == df.columns
    got = Counter((r["doc_id"], r["source"], r["text"]) for r in out.collect())
    want = Counter()
    for r in mixing.mix(df, target).collect():
        want[r["doc_id"], r["source"], r["n_tokens"]] += r["n_rows"]
    by_size = Counter()
    for (i, s, t), n in got.items():
        by_size[i, s, len(t.split()) * (2 if t == "same row" else 1)] += n
    assert by_size == want
    assert {k[2] for k in got} == set(values) and got[2, "t", "same row"] % 2 == 0
    assert max(got.values()) <= 6 and sum(n > 1 for n in got.values()) >= 5
