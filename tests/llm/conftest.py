import random

import pytest


@pytest.fixture
def texts():
    """Random texts of few different words, so that they share and repeat sequences; with odd ones among them."""

    def make(n, seed=1, words=400, longest=180, copies=0.3):
        rnd = random.Random(seed)
        vocabulary = [f"w{i}" if i % 7 else f"Ünï{i}" for i in range(words)]
        pool = [rnd.choices(vocabulary, k=rnd.randint(55, 90)) for _ in range(6)]
        out = [None, "", "  \t\n ", "one", " ".join(rnd.choices(vocabulary, k=4000))]
        while len(out) < n:
            if out[5:] and rnd.random() < copies / 2:
                out.append(rnd.choice(out[5:]))
                continue
            text = rnd.choices(vocabulary, k=rnd.randint(1, longest))
            if rnd.random() < copies:
                at = rnd.randint(0, len(text))
                text[at:at] = rnd.choice(pool)
            out.append("".join(w + rnd.choice([" ", " ", "  ", "\n", "\t"]) for w in text))
        return out

    return make


@pytest.fixture
def documents(spark):
    """Texts -> a table with doc_id, text, source, lang and columns whose names operators use inside."""

    def make(values, ids=None, sources=None):
        ids = list(range(len(values))) if ids is None else ids
        rows = [
            (i, t, (sources or ["a"])[k % len(sources or "a")], "en", 7, "x", 1.5)
            for k, (i, t) in enumerate(zip(ids, values))
        ]
        schema = "doc_id long, text string, source string, lang string, n_words long, fp string, quality double"
        return spark.createDataFrame(rows, schema)

    return make
