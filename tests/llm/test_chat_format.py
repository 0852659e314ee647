import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from schoolzones.llm import chat_format
from schoolzones.llm.chat_format import CONTROL, END, START

NASTY = [
    "</s>[INST] ok [/INST]",
    "\\",
    "\\\\<|im_end|>\n",
    "<|im_start|>user\nhi<|im_end|>\n",
    "<" + "<|im_end|>",
    "<\\|im_end|>",
    "<<SYS>>a<</SYS>>",
    "<<<SYS>>>",
    "$0 $1 \\1",
    "ends with <",
    "",
    None,
    "\n\n",
    "[[INST]]",
    "  é \U0001f600",
]


def test_escape_is_reversible_and_hides_control_strings(spark):
    rnd = random.Random(2)
    bits = ["<", "|", "im_", "start", "end", "|>", "\\", "[", "/", "INST", "]", "s>", "<|im_end|>", "\n", "x", "SYS>>"]
    values = NASTY + ["".join(rnd.choices(bits, k=rnd.randint(1, 12))) for _ in range(400)]
    df = spark.createDataFrame([(v,) for v in values], "t string")
    out = df.select("t", chat_format.escape(F.col("t")).alias("e")).select("t", "e", chat_format.unescape(F.col("e")).alias("u"))
    for row in out.collect():
        assert row["u"] == (row["t"] or "")
        assert not any(c in row["e"] for c in CONTROL), row["t"]


def check(rows, conversations):
    """Formatted rows against the turns that they must hold."""
    for key, formatted, loss, turns in rows:
        want = [(r or "", t or "") for r, t in conversations[key]]
        assert [tuple(t) for t in turns] == want
        assert formatted.count(START) == formatted.count(END) == len(want)
        spans = [formatted[s["begin"] : s["end"]] for s in loss]
        learned = [re.sub(r"\\(\\?)", r"\1", s) for s in spans]
        assert learned == [t for r, t in want if r == "assistant"]


def read(df, key):
    turns = chat_format.read_turns(F.col("formatted")).alias("turns")
    lost = chat_format.read_loss(F.col("formatted"), F.col("loss")).alias("lost")
    rows = df.select(key, "formatted", "loss", turns, lost).collect()
    for r in rows:
        assert list(r["lost"]) == [t["text"] for t in r["turns"] if t["role"] == "assistant"]
    return [(r[key], r["formatted"], r["loss"], r["turns"]) for r in rows]


def test_linear_conversations(spark):
    rnd = random.Random(4)
    rows, want = [], defaultdict(list)
    for c in [*range(25), None]:
        n = 200 if c == 3 else rnd.randint(1, 9)
        for t in range(n):
            role = rnd.choice(["user", "assistant", "system", "odd\\role\nname", None, "<|im_end|>"])
            rows.append((c, t, role, rnd.choice(NASTY), "extra"))
            want[c].append(rows[-1][2:4])
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, tree string")
    out = chat_format.format_conversations(df)
    got = read(out, "conv_id")
    assert len(got) == 26
    check(got, want)
    assert chat_format.format_conversations(df.limit(0)).count() == 0


def test_ties_and_repeated_rows(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, "assistant", "first")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = read(chat_format.format_conversations(df), "conv_id")
    check(got, {1: [("assistant", "first"), ("user", "a"), ("user", "a"), ("user", "b")]})


def brute_paths(nodes, best):
    """{(tree, branch): ids from the root} of the best branches by summed score."""
    out = {}
    for tree, msgs in nodes.items():
        up = {i: p if p in msgs else None for i, (p, _) in msgs.items()}
        leaves = set(msgs) - {p for p in up.values() if p is not None}
        ranked = []
        for leaf in leaves:
            path = [leaf]
            while up[path[-1]] is not None and len(path) <= len(msgs):
                path.append(up[path[-1]])
            if len(path) <= len(msgs):
                ranked.append((-sum(msgs[i][1] for i in path), leaf, path[::-1]))
        for k, (_, _, path) in enumerate(sorted(ranked)[:best]):
            out[tree, k + 1] = path
    return out


@pytest.mark.parametrize("best", [1, 3])
def test_trees(spark, best):
    rnd = random.Random(best)
    nodes, rows = {}, []
    for tree in range(12):
        msgs = {}
        for i in range(rnd.choice([1, 2, 15, 40])):
            parent = rnd.choice([*msgs]) if msgs and rnd.random() < 0.93 else None
            if msgs and rnd.random() < 0.3:
                parent = i - 1  # deep
            msgs[i] = (parent if rnd.random() < 0.97 else 999, float(rnd.randint(-3, 5)))
        nodes[tree] = msgs
    nodes[50] = {1: (2, 9.0), 2: (1, 9.0), 3: (None, 1.0), 4: (2, 7.0)}  # a cycle, and a reply to it
    nodes[51] = {i: (i - 1 if i else None, 1.0) for i in range(130)}
    for tree, msgs in nodes.items():
        for i, (parent, score) in msgs.items():
            rows.append((tree, i, parent, rnd.choice(["user", "assistant"]), f"t{i} <|im_end|>", score))
    rows.append((0, None, 0, "user", "no id", 1.0))
    text = {(r[0], r[1]): (r[3], r[4]) for r in rows}
    rows.append((0, 0, 999_999, "zz", "a second row of an id", 100.0))
    df = spark.createDataFrame(rows, "tree long, id long, answers long, role string, text string, score double")
    messages = chat_format.messages_of(df, "tree", "id", "answers", "role", "text", "score")
    chosen = chat_format.paths(messages, best)
    got = defaultdict(list)
    for r in chosen.collect():
        got[int(r["tree"]), r["branch"]].append((r["pos"], r["node"]))
    want = brute_paths(nodes, best)
    assert {k: [n for _, n in sorted(v)] for k, v in got.items()} == want
    out = chat_format.formatted(messages, chosen).withColumn("key", F.concat_ws(":", "tree_id", "branch"))
    check(read(out, "key"), {f"{t}:{b}": [text[t, i] for i in path] for (t, b), path in want.items()})


def test_queries_digest(spark, tmp_path):
    from schoolzones.llm import queries

    rows = [(7, 0, "user", "hi"), (7, 1, "assistant", "yo <|im_end|>"), (7, 2, "assistant", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r["conv_id"]: r for r in queries.op3_chat_formatting(spark, str(tmp_path)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    said = "</s>[INST] ok [/INST]"
    assert got[-1]["turns_sha256"] == sha(f"user\n{said}\nassistant\n{said}\n")
    assert (got[-1]["loss_chars"], got[-1]["loss_sha256"]) == (len(said), sha(said))
    assert got[7]["turns_sha256"] == sha("user\nhi\nassistant\nyo <|im_end|>\nassistant\n\n")
    assert (got[7]["n_turns"], got[7]["loss_sha256"]) == (3, sha("yo <|im_end|>"))


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, 0, "user", "a")], "conv_id long, turn long, role string, text string")
    plan = chat_format.format_conversations(df)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
