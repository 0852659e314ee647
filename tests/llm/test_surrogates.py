import re
from collections import defaultdict

import pytest

from schoolzones.llm import surrogates
from schoolzones.llm.surrogates import detect, luhn, surrogate, written

TEXTS = [
    "Write to Ann.Lee@mail5.example.com or ann.lee@MAIL5.example.com, not bob@mail5.example.com.",
    "Call +1 (743) 555-3824 or +1 743-555-3824, else 0171 555 9999. Card 4111 1111 1111 1111 / 4111111111111111.",
    "Card 4111111111111112 fails. From 152.143.123.131 and 10.0.0.7; ssn 123-45-6789.",
    'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" and password: Hunter2-Secret!',
    "Mrs. Anna Schmidt met Mr. John Smith. Later Mr. SMITH and Dr. Anna Weber spoke; Frau Schmidt left.",
    "Herr Müller, Señora García; Mr. Иван Петров and Mr. Петров.",
    "version 1.2.3.4.5 on 2024-01-02, 3.14 and 1234567 are none; nor Mr. nobody or a@b.",
    "nothing here",
    "",
    None,
]


def test_detection():
    kinds = lambda t: [(k, t[b:e]) for b, e, k, _ in detect(t)]
    assert [k for k, _ in kinds(TEXTS[0])] == ["email"] * 3
    assert kinds(TEXTS[1]) == [
        ("phone", "+1 (743) 555-3824"),
        ("phone", "+1 743-555-3824"),
        ("phone", "0171 555 9999"),
        ("card", "4111 1111 1111 1111"),
        ("card", "4111111111111111"),
    ]
    assert [k for k, _ in kinds(TEXTS[2])] == ["card", "ip", "ip", "ssn"]
    assert [k for k, _ in kinds(TEXTS[3])] == ["secret", "secret"]
    assert kinds(TEXTS[4]) == [
        ("given_f", "Anna"),
        ("surname", "Schmidt"),
        ("given_m", "John"),
        ("surname", "Smith"),
        ("surname", "SMITH"),
        ("given_f", "Anna"),
        ("surname", "Weber"),
        ("surname", "Schmidt"),
    ]
    assert all(detect(t) == [] for t in TEXTS[6:])


def test_surrogates_have_the_form():
    new = lambda kind, key: surrogate(kind, key, 0, "k")
    assert luhn(new("card", "4111111111111111")) and new("card", "4111111111111111")[0] == "4"
    assert not luhn(new("card", "4111111111111112"))
    assert re.fullmatch("[0-9a-f]{40}", new("secret", "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"))
    assert re.fullmatch("[A-Z][a-z]{5}[0-9]-[A-Z][a-z]{5}", new("secret", "Hunter2-Secret"))
    assert re.fullmatch(r"[a-z]{3}\.[a-z]{3}@[a-z]{4}\d\.[a-z]{7}\.com", new("email", "ann.lee@mail5.example.com"))
    assert new("email", "a@x.org").split("@")[1] == new("email", "b@x.org").split("@")[1]
    assert new("ip", "10.0.0.7").startswith("10.") and new("ip", "192.168.3.4").startswith("192.168.")
    assert all(0 <= int(x) < 256 for x in new("ip", "152.143.123.131").split("."))
    assert new("phone", "17435553824")[0] == "1" and len(new("phone", "17435553824")) == 11
    assert new("given_f", "anna")[-1] == "a" and new("given_m", "john")[-1] not in "aeiou"
    assert re.fullmatch("[а-я]+", new("surname", "петров"))
    assert written("+1 (743) 555-3824", "phone", "12345678901") == "+1 (234) 567-8901"
    assert written("SMITH", "surname", "bado") == "BADO" and written("Smith", "surname", "bado") == "Bado"
    assert surrogate("surname", "x", 0, "k") != surrogate("surname", "x", 0, "other")


def test_table(documents):
    df = documents(TEXTS + [TEXTS[0]], ids=[*range(len(TEXTS)), None])
    out = surrogates.pseudonymized(df, "key")
    assert out.columns == ["doc_id", "n_found", "text"]
    rows = {r["doc_id"]: r for r in out.collect()}
    assert len(rows) == len(TEXTS) + 1 and out.count() == len(TEXTS) + 1
    for i, t in enumerate(TEXTS):
        assert rows[i]["n_found"] == len(detect(t))
        if not detect(t):
            assert rows[i]["text"] == t
    assert rows[None]["text"] == rows[0]["text"]
    # The text around stays; equal entities get one surrogate, different ones different ones.
    of, back = defaultdict(set), defaultdict(set)
    for i, t in enumerate(TEXTS):
        at, shift = 0, 0
        for b, e, kind, key in detect(t):
            rest = t[e:] if (n := detect(t)[-1][:2] == (b, e)) else t[e : [x[0] for x in detect(t) if x[0] >= e][0]]
            begin = b + shift
            assert rows[i]["text"][at + shift : begin] == t[at:b]
            end = rows[i]["text"].index(rest, begin + 1) if rest and not n else len(rows[i]["text"]) - len(t[e:])
            value = rows[i]["text"][begin:end]
            plain = re.sub(r"\D", "", value) if kind in ("phone", "card", "ssn") else value if kind == "secret" else value.lower()
            of[kind, key].add(plain)
            back[kind, plain].add(key)
            at, shift = e, end - e
    assert all(len(v) == 1 for v in of.values()) and all(len(v) == 1 for v in back.values())
    assert not {(k, *v) for (k, _), v in of.items()} & set(of)
    assert surrogates.pseudonymized(df.limit(0), "key").count() == 0


def test_collisions_are_drawn_again(spark, monkeypatch):
    """With few values for the entities, all still differ and none is an entity."""

    def narrow(kind, key, attempt, secret):
        return str(hash((key, attempt, secret)) % 211)

    entities = spark.createDataFrame([("k", str(i)) for i in range(25)] + [("other", "3")], "kind string, entity string")
    source = surrogates.assign.__globals__
    monkeypatch.setitem(source, "surrogate", narrow)
    try:
        got = [tuple(r) for r in surrogates.assign(entities, "s").collect()]
    finally:
        monkeypatch.undo()
    new = [n for k, _, n in got if k == "k"]
    assert len(got) == 26 and len(set(new)) == 25
    assert not set(new) & {str(i) for i in range(25)}


@pytest.mark.parametrize("n", [200_000])
def test_long_text(documents, n):
    long = "word " * n + "a@b.example " + "x" * n
    row = surrogates.pseudonymized(documents([long]), "key").first()
    assert row["n_found"] == 1 and len(row["text"]) == len(long) and "a@b.example" not in row["text"]


NAMES = [
    ("Mr. John Ronald Reuel Tolkien wrote.", "John:given_m Ronald:given_m Reuel:given_m Tolkien:surname"),
    ("Mr. Juan de la Cruz and Frau von der Leyen", "Juan:given_m Cruz:surname Leyen:surname"),
    ("Monsieur Valéry Giscard d'Estaing; Mr. Harun al-Rashid", "Valéry:given_m Giscard:given_m Estaing:surname Harun:given_m Rashid:surname"),
    ("Mr. J. R. R. Tolkien, Mr. J.R.R. Tolkien and Mr. John F. Kennedy", "Tolkien:surname Tolkien:surname John:given_m Kennedy:surname"),
    ("Dr. Anna Weber came. WEBER said that Anna went; Weber's and Webers weber", "Anna:given_f Weber:surname WEBER:surname Anna:given_f Weber:surname Weber:surname"),
    ("Weber? Who is Dr. Weber of de Weber-Haus", "Weber:surname Weber:surname Weber:surname"),
    ("Mr. Paul Smith met Mr. Peter Paul. Paul Smith left Paul.", "Paul:given_m Smith:surname Peter:given_m Paul:surname Paul:given_m Smith:surname Paul:surname"),
    ("Mr. John Smith Jr. de novo", "John:given_m Smith:surname"),
]


@pytest.mark.parametrize("text,want", NAMES)
def test_whole_names_and_untitled_mentions(text, want):
    assert " ".join(f"{text[b:e]}:{k}" for b, e, k, _ in detect(text)) == want


def test_no_name_is_left(documents):
    text = "Dr. Anna Weber met Mr. John Ronald Reuel Tolkien. Weber said: Tolkien and Anna stay. " * 300
    row = surrogates.pseudonymized(documents([text, "Weber alone"], ids=[1, 2]), "key").where("doc_id = 1").first()
    assert row["n_found"] == 300 * 9
    words = row["text"].split()
    assert not {"Anna", "Weber", "John", "Ronald", "Reuel", "Tolkien"} & set(re.findall(r"\w+", row["text"]))
    assert words[2] == words[9] and words[1] == words[13] and words[8] == words[11] + "."


def test_domains_are_entities_and_nothing_runs_out(spark):
    """All one-letter domains of a top level, 900 of three letters, and more names than short surrogates."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    hosts = [*letters, *(a + b + c for a in letters for b in letters[:7] for c in letters[:5])][:926]
    rows = [("email", f"{who}@{h}.com") for h in hosts for who in ("ann", "bob")]
    rows += [("surname", f"x{i}") for i in range(3000)]
    entities = spark.createDataFrame(rows, "kind string, entity string")
    got = {(r["kind"], r["entity"]): r["new"] for r in surrogates.assign(entities, "a key for each release").collect()}
    assert set(got) == set(rows) and len(set(got.values())) == len(rows)
    old = {e for _, e in rows}
    assert not old & set(got.values())
    new_domain = {h: got["email", f"ann@{h}.com"].split("@")[1] for h in hosts}
    assert all(got["email", f"bob@{h}.com"].split("@")[1] == new_domain[h] for h in hosts)
    assert len(set(new_domain.values())) == len(hosts) and not {f"{h}.com" for h in hosts} & set(new_domain.values())
    drawn = [surrogates.surrogate("given_f", "anna", a, "s") for a in (0, 60, 120)]
    assert len(drawn[0]) < len(drawn[1]) < len(drawn[2])
