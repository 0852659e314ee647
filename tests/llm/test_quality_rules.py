import re

import pytest

from schoolzones.llm import quality_rules
from schoolzones.llm.quality_rules import Rules

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text, rules=Rules()):
    text = text or ""
    words = WORD.findall(text)
    chars = sum(map(len, words))

    def covered(n):
        grams = {}
        for i in range(len(words) - n + 1):
            grams.setdefault(tuple(words[i : i + n]), []).append(i)
        return {i + j for at in grams.values() if len(at) > 1 for i in at for j in range(n)}

    seen, n_dup, dup_chars, line_chars = set(), 0, 0, 0
    for line in text.split("\n"):
        if WORD.search(line):
            line_chars += len(line)
            if line in seen:
                n_dup, dup_chars = n_dup + 1, dup_chars + len(line)
            seen.add(line)
    repeat = len(covered(8))
    grams = [sum(len(words[i]) for i in covered(n)) for n in rules.lengths]
    base = len(words) < 20 or 100 * repeat > 30 * len(words)
    bad = dup_chars > 0.3 * line_chars or any(g > s * chars for g, s in zip(grams, rules.max_ngram_share))
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return (len(words), chars, symbols, n_dup, repeat, base, not base and not bad, grams)


LINE = "the same line of some words again\n"
ODD = [
    LINE * 40,
    " ".join(f"x{i}" for i in range(200)) + "\n" + LINE * 3,
    "a " * 30,
    "é b # * $ | < > & % " * 5 + " ".join(f"q{i}" for i in range(100)),
    "\x0b".join(f"p{i}" for i in range(25)),
    " ".join(f"{i % 40}" for i in range(100)),
    " ".join(f"n{i}" for i in range(60)) + " " + " ".join(f"n{i}" for i in range(8)),
    "x" * 3_000_000 + " " + " ".join(f"z{i}" for i in range(30)),
]


def test_measures_equal_brute_force(documents, texts):
    values = texts(120, words=30) + ODD
    df = quality_rules.verdicts(documents(values), name="q")
    names = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept ngram_chars".split()
    got = {r["doc_id"]: tuple(r["q"][n] for n in names) for r in df.collect()}
    for i, text in enumerate(values):
        assert got[i] == brute(text), (i, (text or "")[:80])
    assert {g[6] for g in got.values()} == {True, False}


def test_stage_keeps_columns_and_repeated_rows(documents):
    good = " ".join(f"w{i}" for i in range(40))
    df = documents([good, good, None, "few words"], ids=[1, 1, 2, None])
    kept = quality_rules.keep_good(df)
    assert kept.columns == df.columns
    assert [r["doc_id"] for r in kept.collect()] == [1, 1]


def test_stage_with_columns_of_its_own_names(documents):
    good = " ".join(f"w{i}" for i in range(40))
    df = documents([good, "few"]).withColumnRenamed("fp", "verdict").withColumnRenamed("lang", "_quality_verdict")
    (row,) = quality_rules.keep_good(df).collect()
    assert (row["verdict"], row["_quality_verdict"], row["text"]) == ("x", "en", good)


def test_empty_table(documents):
    df = documents(["x"]).limit(0)
    assert quality_rules.verdicts(df).count() == 0 and quality_rules.keep_good(df).count() == 0


@pytest.mark.parametrize("n", [1, 2])
def test_chunks_do_not_mix_texts(n):
    same = [b"a b c d e f g h i j"] * n
    assert quality_rules.measure(same, Rules())["n_repeat_words"].tolist() == [0] * n
