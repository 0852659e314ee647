import random
import re

import pytest
import xxhash

from schoolzones.llm import simhash_dedup
from schoolzones.llm.components import connected

WORD = re.compile("[^\x20\x09-\x0d]+")


def fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def least_reachable(nodes, linked):
    """Label of every node: the least node of its component."""
    label = {n: n for n in nodes}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        label[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute(ids, texts):
    prints = [fingerprint(t) for t in texts]
    near = [
        (i, j)
        for i in range(len(ids))
        for j in range(i)
        if bin(prints[i] ^ prints[j]).count("1") <= 2
    ]
    label = least_reachable(range(len(ids)), near)
    least = {}
    for i, root in label.items():
        least[root] = min(least.get(root, ids[i]), ids[i])
    return [(ids[i], f"{prints[i]:016x}", least[label[i]]) for i in range(len(ids))]


def test_components_equal_brute_force(documents, texts):
    values = texts(150, words=5000, longest=300)
    rnd = random.Random(3)
    for t in values[5:60] + [values[4]] * 40:  # near copies; of a long text, closer ones
        words = t.split()
        words[rnd.randrange(len(words))] = "changed"
        values.append(" ".join(words).upper())
    ids = rnd.sample(range(10_000), len(values))
    got = sorted(map(tuple, simhash_dedup.components(documents(values, ids)).collect()))
    want = sorted(brute(ids, values))
    assert got == want
    assert sum(a != c for a, _, c in want) > 20


@pytest.mark.parametrize("seed", [1, 2])
def test_links_join_all_within_two_bits(spark, seed):
    rnd = random.Random(seed)
    points = set()
    for _ in range(30):
        x = rnd.getrandbits(64)
        for _ in range(8):
            points.add(x)
            for _ in range(rnd.randint(1, 3)):
                x ^= 1 << rnd.randrange(64)
    points |= {0, 1, 1 << 63, (1 << 64) - 1}
    signed = {p - (1 << 64) if p >> 63 else p for p in points}
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    roots = {r["node"]: r["root"] for r in connected(simhash_dedup.links(df)).collect()}
    mask = (1 << 64) - 1
    near = [(a, b) for a in signed for b in signed if a < b and bin((a ^ b) & mask).count("1") <= 2]
    assert {p: roots.get(p, p) for p in signed} == least_reachable(signed, near)


def test_long_chain_and_hub(spark):
    edges = [(i, i + 1) for i in range(120)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5), (None, 3)]
    df = spark.createDataFrame(edges, "u long, v long")
    got = {r["node"]: r["root"] for r in connected(df).collect()}
    assert got == {i: 0 for i in range(121)} | {1000 + i: 1000 for i in range(300)}


def test_odd_rows(documents):
    long = " ".join(f"w{i}" for i in range(50_000))
    df = documents([None, "", long, long, "one", "one", "ONE"], ids=[4, 3, 9, 9, 8, None, None])
    got = sorted(map(tuple, simhash_dedup.components(df).collect()), key=str)
    assert [(a, c) for a, _, c in got] == [(3, 3), (4, 3), (8, 8), (9, 9), (9, 9), (None, 8), (None, 8)]
    kept = simhash_dedup.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["3", "8", "9"]
    assert simhash_dedup.components(df.limit(0)).count() == 0


def test_one_row_of_each_component_by_row(documents, texts):
    """Unrelated texts that share a doc_id, copies without any, repeated rows, columns with the operator's names."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(80)) for x in "abc")
    values = [a, b, b + " ", a, a, c, c, c, b, "own text " * 5, "own text " * 5]
    ids = [1, 1, 2, 1, None, None, None, None, None, 7, 7]
    df = documents(values, ids).withColumnRenamed("quality", "row").withColumnRenamed("fp", "found")
    df = df.withColumnRenamed("lang", "_first_id").withColumnRenamed("n_words", "_row_of_id")
    kept = simhash_dedup.keep_one(df)
    assert kept.columns == df.columns
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    assert got == sorted([(1, a), (1, b), (None, c), (7, "own text " * 5)], key=str)
    assert all(r["_row_of_id"] == 7 and r["row"] == 1.5 for r in kept.collect())
    more = texts(120, words=4000, longest=200)
    rows = simhash_dedup.keep_one(documents(more)).collect()
    assert {r["doc_id"] for r in rows} == {c for _, _, c in brute(list(range(120)), more)} and len(rows) == len({r["doc_id"] for r in rows})
    assert simhash_dedup.keep_one(df.limit(0)).count() == 0
