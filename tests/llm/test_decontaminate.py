import random
import re


from schoolzones.llm import decontaminate

TOKEN = re.compile(r"(?:\d+(?:[.,]\d+)*|[^\W\d_][^\W\d_']*(?:'[^\W\d_]*)*)[.!?]?")


def canon(text):
    raw = TOKEN.findall(text or "")
    keys, before = [], "."
    for r in raw:
        w = r.rstrip(".!?")
        low = w.lower()
        if w[0].isdigit():
            keys.append(1)
        elif w != low and len(w) > 1 and w[1:] == low[1:] and before[-1] not in ".!?":
            keys.append(3)
        elif before[0].isdigit() and low in decontaminate.UNITS:
            keys.append(2)
        else:
            keys.append(low)
        before = r
    return [r.rstrip(".!?").lower() for r in raw], keys


def window(raw, keys, a):
    w = tuple(keys[a : a + 5])
    return tuple(raw[a : a + 5]) if sum(isinstance(k, int) for k in w) > 3 else w


def brute(docs, items):
    """Pairs (doc, item): enough templates shared, and a one-to-one renaming on the most frequent shift."""
    out = set()
    for i, question in items:
        raw, keys = canon(question)
        at = {}
        for few in (True, False):  # windows of nearly only placeholders count where there are no others
            for a in range(len(keys) - 4):
                if (sum(isinstance(k, int) for k in keys[a : a + 5]) <= 3) == few and (few or not light):
                    at.setdefault(window(raw, keys, a), a)
            light = bool(at)
        for d, text in docs:
            raw2, keys2 = canon(text)
            shifts, met = {}, set()
            for a in range(len(keys2) - 4):
                w = window(raw2, keys2, a)
                if w in at:
                    met.add(w)
                    shifts.setdefault(a - at[w], set()).add(w)
            if not at or len(met) < 0.8 * len(at):
                continue
            s = max(shifts, key=lambda x: (len(shifts[x]), -x))
            slots = {
                (k, raw[p], raw2[p + s])
                for p, k in enumerate(keys)
                if isinstance(k, int) and 0 <= p + s < len(keys2) and keys2[p + s] == k
            }
            if len({x[:2] for x in slots}) == len(slots) == len({(k, y) for k, _, y in slots}):
                out.add((d, i))
    return out


QUESTION = (
    "A shop sold 24 boxes to Maria and 36 boxes to Peter in one week. Each box weighs 3 kg and costs 12 dollars. "
    "How many boxes did Maria and Peter buy together, and how much did they pay for all of them?"
)
OTHER = QUESTION.replace("24", "51").replace("36", "8").replace("Maria", "Aisha").replace("Peter", "Tomas")


def test_equals_brute_force(spark, documents):
    rnd = random.Random(5)
    words = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)] + "Anna Paul 12 7 kg 3.5".split()
    say = lambda n: " ".join(rnd.choice(words) + rnd.choice(["", "", "", ".", ","]) for _ in range(n))
    items = [(i, say(rnd.randint(3, 50))) for i in range(25)] + [(100, QUESTION)]
    items += [(101, "12 kg 7 mm 3.5 m 24 mg 8 s"), (102, "1 2 3 4 5 6"), (103, "1 2 3 4 5 and then 7 kg of it")]
    docs = []
    for k in range(120):
        text = say(rnd.randint(0, 120))
        if k % 3 == 0:
            text = f"{text} {rnd.choice(items)[1]} {say(10)}"
        elif k % 7 == 0:  # most of an item
            part = rnd.choice(items)[1].split()
            text += " " + " ".join(part[: int(len(part) * rnd.uniform(0.5, 1))])
        docs.append(text)
    docs += [OTHER, QUESTION.replace("24", "36"), QUESTION.upper(), "x " + QUESTION * 3]
    docs += ["a list: 12 kg, 7 mm, 3.5 m, 24 mg, 8 s.", "13 kg 7 mm 3.5 m 24 mg 8 s", "0 1 2 3 4 5 6", "6 5 4 3 2 1"]
    docs += ["1 2 3 4 5 and then 7 kg of it", "9 8 7 6 5 and then 1 kg of it", "9 8 7 6 5 and then 5 kg of it"]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute(list(enumerate(docs)), items)
    for limit in (1_000_000, 0):  # broadcast and shuffled
        got = decontaminate.contaminated(documents(docs), bench, max_broadcast=limit).collect()
        assert {(r["doc_id"], r["item_id"]) for r in got} == want
        assert len(got) == len(want) > 35


def test_reparameterised_questions(spark, documents):
    bench = spark.createDataFrame([(1, QUESTION)], "item_id long, text string")
    inconsistent = QUESTION.replace("36", "24")  # two values became one
    mixed = OTHER.replace("did Aisha", "did Maria")  # one value became two
    docs = documents([OTHER, inconsistent, mixed, "nothing of it " * 30])
    rows = decontaminate.contaminated(docs, bench).collect()
    assert [(r["doc_id"], r["item_id"]) for r in rows] == [(0, 1)]
    assert rows[0]["n_slots"] == 10


def test_odd_rows(spark, documents):
    bench = spark.createDataFrame(
        [(1, QUESTION), (1, QUESTION), (2, None), (3, ""), (None, QUESTION), (4, "too short")],
        "item_id long, text string",
    )
    long = "w " * 100_000 + QUESTION
    docs = documents([QUESTION, QUESTION, None, "", long, QUESTION, "!" * 100_000], ids=[1, 1, 2, 3, 4, None, 5])
    got = decontaminate.contaminated(docs, bench).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in got) == [(1, 1), (4, 1)]
    left = decontaminate.without_leaks(docs, bench)
    assert left.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in left.collect()) == ["2", "3", "5", "None"]
    assert decontaminate.contaminated(docs.limit(0), bench).count() == 0
    assert decontaminate.without_leaks(docs, bench.limit(0)).count() == 7



def test_no_python_in_the_plan(spark, documents):
    bench = spark.createDataFrame([(1, QUESTION)], "item_id long, text string")
    plan = decontaminate.contaminated(documents([QUESTION]), bench)
    text = plan._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", text)


def test_exact_item_behind_an_inconsistent_copy(spark, documents):
    bench = spark.createDataFrame([(1, QUESTION)], "item_id long, text string")
    other = QUESTION.replace("36", "24")  # two values became one: not the item
    docs = documents([f"{other} Then. {QUESTION}", f"{other} Then. {other}", f"{other} Then. {other} So. {OTHER} End. {other}"])
    rows = decontaminate.contaminated(docs, bench).collect()
    assert sorted((r["doc_id"], r["item_id"], r["n_slots"]) for r in rows) == [(0, 1, 10), (2, 1, 10)]
    assert [r["doc_id"] for r in decontaminate.without_leaks(docs, bench).collect()] == [1]


def test_stage_with_columns_of_its_own_names(spark, documents):
    item = "a question of nine words that is asked here"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    df = documents([f"before {item} after", "something else", None], ids=[1, 2, None])
    df = df.withColumnRenamed("fp", "leak").withColumnRenamed("lang", "_leak").withColumnRenamed("quality", "row")
    out = decontaminate.without_leaks(df, bench)
    assert out.columns == df.columns and sorted(str(r["doc_id"]) for r in out.collect()) == ["2", "None"]


def test_items_of_placeholders_are_found_by_their_values(spark, documents):
    bench = spark.createDataFrame([(1, "12 kg 7 mm 3.5 m 24 mg"), (2, "Anna 4 5 6 7 8")], "item_id long, text string")
    docs = ["weights are 12 kg, 7 mm, 3.5 m, 24 mg today", "13 kg 7 mm 3.5 m 24 mg", "1 2 3 4 5 6 7 8 9", "Anna 4 5 6 7 8"]
    got = decontaminate.contaminated(documents(docs), bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(0, 1), (3, 2)}
