import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest

from schoolzones.llm import substring_dedup

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(ids, texts):
    words = [WORD.findall(t or "") for t in texts]
    least = {}
    for i, w in zip(ids, words):
        for a in range(len(w) - 49):
            if i is not None:
                key = tuple(w[a : a + 50])
                least[key] = min(least.get(key, i), i)
    out = []
    for i, w in zip(ids, words):
        gone = {
            a + j
            for a in range(len(w) - 49)
            if i is not None and least[tuple(w[a : a + 50])] < i
            for j in range(50)
        }
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("group_bytes", [substring_dedup.GROUP_BYTES, 2000, 0])
def test_equals_brute_force(documents, texts, group_bytes):
    values = texts(140, longest=160)
    values += [" ".join(["la"] * n) for n in (49, 50, 51, 200)]  # windows within windows
    values.append(" ".join(values[10:14]))
    values += [" ".join(f"p{k % period}" for k in range(300)) for period in (2, 7, 50, 51, 60) for _ in range(2)]
    ids = [(i * 37) % 1009 for i in range(len(values))]
    got = substring_dedup.remove_repeats(documents(values, ids), group_bytes=group_bytes).collect()
    want = brute(ids, values)
    assert sorted(map(tuple, got), key=str) == want
    assert sum(0 < r[2] < r[1] for r in want) > 10


def test_odd_rows(documents):
    text = " ".join(f"w{i}" for i in range(70))
    other = "before " + text
    values, ids = [text, text, other, text, None, "", text], [5, 5, 7, None, 1, 2, 7]
    got = substring_dedup.remove_repeats(documents(values, ids)).collect()
    assert sorted(map(tuple, got), key=str) == brute(ids, values)
    assert substring_dedup.remove_repeats(documents(["x"]).limit(0)).count() == 0


def test_batches_cut_between_groups(documents, texts, monkeypatch):
    monkeypatch.setattr(substring_dedup, "BATCH_BYTES", 2000)
    values = texts(60)
    got = substring_dedup.remove_repeats(documents(values)).collect()
    assert sorted(map(tuple, got), key=str) == brute(list(range(60)), values)


def test_overlapping_windows_are_one_row():
    at = np.array([0, 5, 9, 13, 100, 151, 202, 252, 3, 4])
    h1 = np.array([1] * 8 + [2] * 2)
    first, last = substring_dedup.overlapping(h1, np.where(at == 4, 1, 0), at)
    assert list(zip(at[first].tolist(), at[last].tolist())) == [
        (0, 5), (9, 13), (100, 100), (151, 151), (202, 252), (3, 3), (4, 4),
    ]
    covered = {w for a, b in zip(at[first], at[last]) for w in range(a, b + 50)}
    assert covered == {w for a in at for w in range(a, a + 50)}


def test_texts_of_one_word(documents):
    """Groups are bounded in bytes: long texts of one word take few rows and no tree."""
    values = [" ".join([word] * (20_000 + i)) for i in range(60) for word in ("la", "do re")]
    got = substring_dedup.remove_repeats(documents(values)).collect()
    assert sorted((r["doc_id"], r["n_words"] - r["n_removed"]) for r in got) == [
        (i, len(v.split()) if i < 2 else 0) for i, v in enumerate(values)
    ]
    batch = documents(values[:2]).selectExpr("doc_id", "doc_id as text_key", "text").toPandas()
    grams = [substring_dedup.routes(substring_dedup.stable_codes(v.encode().split()), np.zeros(len(v.split())))[2] for v in values[:2]]
    batch["heavy"] = [g.tolist() for g in grams]
    rows = sum(b.num_rows for b in substring_dedup._cut_windows([pa.RecordBatch.from_pandas(batch)]))
    assert rows == 3
