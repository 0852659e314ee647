import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from schoolzones.llm import resampling, span_crc
from schoolzones.llm.resampling import Spec

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def features(text, n):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    return words, [" ".join(words[i : i + k]) for k in range(1, n + 1) for i in range(len(words) - k + 1)]


def brute(rows, target, spec=Spec()):
    """(doc_id, n_words, n_features, weight, score, rank) per row."""
    bucket = lambda f: zlib.crc32(f.encode()) % spec.buckets
    found = [features(t, spec.longest) for _, t in rows]
    s = Counter(bucket(f) for _, fs in found for f in fs)
    t = Counter(bucket(f) for text in target for f in features(text, spec.longest)[1])
    ss, tt = s.total() + spec.buckets, t.total() + spec.buckets
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * ss / ((s[b] + 1) * tt)))
    out = []
    for (doc, _), (words, fs) in zip(rows, found):
        weight = sum(gain(bucket(f)) for f in fs) // len(fs) if fs else 0
        score = None
        if doc is not None:
            h = int(hashlib.sha256(f"{spec.key}:{doc}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc, len(words), len(fs), weight, score, None])
    eligible = [r for r in out if r[1] >= spec.min_words]
    drawn = sorted((r for r in eligible if r[4] is not None), key=lambda r: (-r[4], r[0]))
    for i, r in enumerate(drawn[: len(eligible) * spec.percent // 100], 1):
        r[5] = i
    return sorted(map(tuple, out), key=str)


def listed(df):
    return sorted(map(tuple, df.collect()), key=str)


ODD = ["ÀB c7-D_e'f\x00g\x7fh ﬁ Ⅷ 東京 x\U0001f600y", "A" * 70_000 + " b", "...---...", "é" * 3000, "a-" * 5000]
TARGET = ["w1 w2 w3 w4 w4", "w5 Ünï7 w8", None, "", "w1 w1 w1 unseen words"]


def target_of(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "item_id long, text string")


@pytest.mark.parametrize("spec", [Spec(), Spec(longest=3, buckets=97, percent=37, min_words=5, key="k")])
def test_equals_brute_force(spark, documents, texts, spec):
    values = texts(150) + ODD
    docs = documents(values)
    got = listed(resampling.resample(docs, target_of(spark, TARGET), spec=spec))
    want = brute(list(enumerate(values)), TARGET, spec)
    assert got == want
    assert sum(r[5] is not None for r in want) > 5


def test_repeated_and_null_ids(spark, documents, texts):
    values = texts(90)
    ids = [i % 60 if i % 7 else None for i in range(90)]
    spec = Spec(percent=50)
    got = listed(resampling.resample(documents(values, ids), target_of(spark, TARGET), spec=spec))
    want = brute(list(zip(ids, values)), TARGET, spec)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert sorted(r[5] for r in got if r[5]) == sorted(r[5] for r in want if r[5])


def test_empty_tables(spark, documents):
    docs, target = documents(["w1 w2 " * 30] * 20), target_of(spark, TARGET)
    assert resampling.resample(docs.limit(0), target).count() == 0
    got = listed(resampling.resample(docs, target.limit(0)))
    assert got == brute([(i, "w1 w2 " * 30) for i in range(20)], [])
    assert resampling.resample(documents(["few words", None]), target).where("rank is not null").count() == 0


def test_drawn_rows_keep_their_columns(spark, documents, texts):
    docs = documents(texts(100)).withColumnRenamed("quality", "rank").withColumnRenamed("fp", "drawn")
    rows = resampling.drawn(docs, target_of(spark, TARGET))
    ids = {r[0] for r in resampling.resample(docs, target_of(spark, TARGET)).where("rank is not null").collect()}
    assert rows.columns == docs.columns and {r["doc_id"] for r in rows.collect()} == ids and ids


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=2000), st.lists(st.tuples(st.integers(0, 2000), st.integers(0, 2000)), max_size=20))
def test_span_crc_equals_zlib(data, spans):
    spans = [(a, b) for a, b in spans if a <= b <= len(data)]
    raw = np.frombuffer(data, np.uint8)
    starts = np.array([a for a, _ in spans], np.int64)
    sizes = np.array([b - a for a, b in spans], np.int64)
    assert span_crc.crc32(raw, starts, sizes).tolist() == [zlib.crc32(data[a:b]) for a, b in spans]


def test_long_spans_and_many():
    rnd = random.Random(3)
    data = rnd.randbytes(3_300_000)
    sizes = [0, 1, 63, 64, 65, 128, 129, 1 << 20, (1 << 20) + 1, (2 << 20) + 64, 3_000_000] + [rnd.randint(0, 90) for _ in range(60_000)]
    starts = [rnd.randint(0, len(data) - n) for n in sizes]
    got = span_crc.crc32(np.frombuffer(data, np.uint8), np.array(starts), np.array(sizes))
    assert got.tolist() == [zlib.crc32(data[a : a + n]) for a, n in zip(starts, sizes)]
