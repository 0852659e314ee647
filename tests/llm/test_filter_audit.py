import random
import re
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from schoolzones.llm import filter_audit

WORD = re.compile("[^\x20\x09-\x0d]+")


def standard(text):
    words = WORD.findall(text)
    out = set()
    if len(words) < 100:
        out.add("A")
    if 100 * len(set(words)) < 80 * len(words):
        out.add("B")
    if 100 * len(re.findall("[A-Z]", text)) > 10 * len(text):
        out.add("C")
    if re.search(r"[#$%&*|]", text):
        out.add("D")
    return out


def brute(rows, labels, fails_of, names, copies):
    """Every order, step by step, over sets of row numbers."""
    fails = {x: set() for x in names}
    for i, (doc, text, _) in enumerate(rows):
        for x in fails_of(text or ""):
            fails[x].add(i)
        if copies and doc is not None and any(d is not None and d < doc and (t or "") == (text or "") for d, t, _ in rows):
            fails[copies].add(i)
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    out = []
    for part in {p or "" for _, _, p in rows}:
        mine = {i for i, r in enumerate(rows) if (r[2] or "") == part}
        shapley, report = dict.fromkeys(names, 0), []
        for order in permutations(names):
            alive, gone = set(mine), set()
            for step, x in enumerate(order, 1):
                failing = fails[x] & mine
                removed = failing & alive
                redundant = failing & gone
                alive, gone = alive - removed, gone | removed
                only = sum(all(i not in fails[y] for y in names if y != x) for i in failing)
                lost = [sum(rows[i][0] in s for i in removed) for s in (good, toxic)]
                shapley[x] += len(removed)
                report.append((part, "".join(order), step, len(alive), len(removed), len(redundant), only, *lost, x))
        out += [(*r[:-1], shapley[r[-1]]) for r in report]
    return sorted(out)


def docs_of(spark, rows):
    schema = "doc_id long, text string, lang string, digest string, part string, row int, good string, bit int, before int"
    return spark.createDataFrame([(*r, "x", "p", 1, "g", 2, 3) for r in rows], schema)


def labels_of(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.fixture
def rows(texts):
    rnd = random.Random(5)
    values = texts(80, words=90, longest=260)
    values += [values[9]] * 3 + ["UPPER CASE " * 60, "a | b " * 70, " ".join(f"w{i}" for i in range(150)), "", None]
    ids = list(range(len(values)))
    rnd.shuffle(ids)
    out = [(i, t, rnd.choice(["en", "de", None, ""])) for i, t in zip(ids, values)]
    return out + [out[3], (out[4][0], "other text", "fr"), (None, values[9], "en"), (None, values[9], "en"), (10**12, values[9], "xx")]


@pytest.fixture
def labels(rows):
    rnd = random.Random(6)
    some = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for i, _, _ in rows if rnd.random() < 0.6]
    return some + some[:3] + [(some[4][0], 1, 1), (None, 1, 1), (-5, 1, 1)]


def test_equals_brute_force(spark, rows, labels):
    docs = docs_of(spark, rows).withColumn("text", F.coalesce("text", F.lit("")))
    docs = docs.withColumn("words", filter_audit.words_of(F.col("text")))
    filters = filter_audit.standard_filters(F.col("text"), F.col("words"))
    got = filter_audit.audit(docs, labels_of(spark, labels), filters, "E")
    want = brute(rows, labels, standard, "ABCDE", "E")
    assert sorted(map(tuple, got.collect())) == want
    assert any(r[5] and r[6] and r[7] and r[8] for r in want)


def test_other_filters_and_no_copies(spark, rows, labels):
    filters = {"L": F.length("text") > 300, "N": F.col("text").isNull()}
    got = filter_audit.audit(docs_of(spark, rows), labels_of(spark, labels), filters, part="lang")
    # a condition that is null fails nothing
    fails = lambda t: {"L"} if len(t) > 300 else set()
    want = brute(rows, labels, fails, "LN", None)
    null = {p: sum(t is None and (q or "") == p for _, t, q in rows) for p in ("", "en", "de", "fr", "xx")}
    rows_of = [r for r in map(tuple, got.collect()) if not (r[1][r[2] - 1] == "N" and null[r[0]]) and not null[r[0]]]
    assert sorted(rows_of) == [r for r in want if not null[r[0]]]


def test_empty_tables(spark, rows, labels):
    docs, tagged = docs_of(spark, rows), labels_of(spark, labels)
    filters = {"A": F.length("text") > 300}
    assert filter_audit.audit(docs.limit(0), tagged, filters, "E").count() == 0
    got = filter_audit.audit(docs, tagged.limit(0), filters, "E").agg(F.sum("good_lost"), F.sum("toxic_lost")).first()
    assert tuple(got) == (0, 0)
    nothing = filter_audit.audit(docs, tagged, {"A": F.lit(False)}).collect()
    assert all(r["removed"] == 0 and r["kept"] > 0 for r in nothing) and len(nothing) == 5


def test_orders_are_bounded(spark, rows, labels):
    with pytest.raises(ValueError):
        filter_audit.audit(docs_of(spark, rows), labels_of(spark, labels), {f"f{i}": F.lit(True) for i in range(8)})
