"""Personal data replaced by surrogates.

Found are e-mail addresses, phone numbers, card numbers, IPv4 addresses, social security numbers, secrets assigned to a
name (token, key, password), and person names after a title, to their last word, with the particles between. Where a name
was found, its words are also found without a title anywhere in the same text (written with a capital; a final s may
follow); initials before a name and particles stay as they are. Each is reduced to a key (letters in lower case, digits
only), so mentions written differently are one entity; a name is an entity per given name or surname, so that "Mr. Smith"
stays the "John Smith" of before. A surrogate is drawn from a keyed hash of the key and has its shape: digits for digits,
letters for letters of the same script, hexadecimal for hexadecimal, a card that passes the Luhn test if the card did,
an address that is private if it was, a phone
number of the same country code, a name of the same gender. It is written in the form of the mention (separators, case).

Collisions are checked over the entities of the whole table, in Spark: no two entities of a type may get one surrogate,
and no surrogate may be an entity that occurs. The least entity keeps its surrogate, the others draw again until all
differ; after some rounds names, domains and the part before an @ also grow, so that they can't run out. Domains are
entities of their own: no two have one surrogate, none is one that occurs, and addresses that share one still do. So equal
mentions stay equal and different ones different, everywhere.

A null text stays null; texts without a find are unchanged. Rows are handled one by one, so repeated rows, equal or null
doc_ids give equal results. Only the named columns are read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .native import row_key
from .store import stored

#: Titles and the gender they tell, and some given names by gender.
MALE_TITLES = "Mr Herr Monsieur Señor Sr Sir Don".split()
FEMALE_TITLES = "Mrs Ms Miss Frau Madame Mme Mlle Señora Sra Lady Doña".split()
OTHER_TITLES = "Dr Prof Professor Mx".split()
FEMALE = set("mary anna emma maria laura sarah julia lisa sophie marie claire lucia elena carmen jane susan linda karen".split())
MALE = set("john james robert michael david peter paul thomas hans klaus pierre jean luis carlos juan jose mark george".split())

#: What may stand between the words of a name in small letters, and what may follow it.
PARTICLES = set(
    "de la las los del della dalla dell dall di da do das dos d du des le l van von vom der den het t ter ten te zu zum "
    "zur af av y e i al el ad ibn bin bint ben ap".split()
)
SUFFIXES = set("Jr Jnr Snr II III IV".split())

_TITLES = MALE_TITLES + FEMALE_TITLES + OTHER_TITLES
_EMAIL = re.compile(r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)+")
_SECRET = re.compile(
    r"(?i)\b(?:api[_-]?key|access[_-]?key|secret|token|passwd|password|pwd)\b\s*[:=]\s*[\"']?(?P<v>[A-Za-z0-9_\-+/=.]{8,})"
)
_NUMBERS = [
    ("ip", re.compile(r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)")),
    ("ssn", re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])")),
    ("card", re.compile(r"(?<!\d)(?:\d{4}[ -]?){3}\d{1,7}(?!\d)")),
    ("phone", re.compile(r"(?<![\d+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]\d{3,4}(?!\d)")),
    ("phone", re.compile(r"(?<![\d+])\+\d{8,15}(?!\d)")),
]
_TITLE = re.compile(r"\b(?P<t>" + "|".join(_TITLES) + r")\b\.?(?=[ \t])")
_NEXT = re.compile(r"(?:[ \t]+['’]?|(?<=\.)|(?<=['’]))(?P<v>[^\W\d_]+(?:[-'’][^\W\d_]+)*)")
_PART = re.compile(r"[^\W\d_]+")

Find = tuple[int, int, str, str]  # begin, end, type, key


def _words(text: str, at: int) -> Iterator[re.Match]:
    """The parts of the name that begins at ``at``, with the particles that lead to one of them."""
    waiting: list[re.Match] = []
    while word := _NEXT.match(text, at):
        if word["v"] in _TITLES or word["v"] in SUFFIXES:
            return
        parts = list(_PART.finditer(text, *word.span("v")))
        at = word.end()
        first = next((i for i, p in enumerate(parts) if p.group()[0].isupper()), len(parts))
        if any(p.group() not in PARTICLES for p in parts[:first]):
            return
        waiting += parts
        if first < len(parts):
            yield from waiting
            waiting = []
            if len(word["v"]) == 1 and text[at : at + 1] == "." and (then := _NEXT.match(text, at + 1)):
                # An initial, if a name goes on after it; it may also end a sentence.
                if then["v"][0].isupper() or then["v"] in PARTICLES:
                    at += 1


def _names(text: str) -> Iterator[Find]:
    if not any(t in text for t in _TITLES):
        return
    kinds: dict[str, dict[str, str]] = {"given": {}, "surname": {}}
    for m in _TITLE.finditer(text):
        parts = list(_words(text, m.end()))
        family = False  # after a particle, all is surname
        for i, p in enumerate(parts):
            word, last = p.group(), i == len(parts) - 1
            low = word.lower()
            if not word[0].isupper():
                family = True
                continue
            if len(word) == 1 and not last and text[p.end()] == ".":
                continue
            if last or family:
                kind = "surname"
            else:
                female = m["t"] in FEMALE_TITLES or m["t"] not in MALE_TITLES and low in FEMALE
                male = m["t"] in MALE_TITLES or m["t"] not in FEMALE_TITLES and low in MALE
                kind = "given_f" if female else "given_m" if male else "given"
            if len(word) > 1 and low not in PARTICLES:
                kinds["surname" if kind == "surname" else "given"].setdefault(low, kind)
            yield p.start(), p.end(), kind, low
    if kinds["given"] or kinds["surname"]:
        yield from _untitled(text, **kinds)


def _untitled(text: str, given: dict[str, str], surname: dict[str, str]) -> Iterator[Find]:
    """Every mention of the names (in small letters, with their types) that a text has after titles."""

    def known(p: re.Match) -> str | None:
        low = p.group().lower()
        if not p.group()[0].isupper():
            return None
        for key in (low, low[:-1]) if low.endswith("s") else (low,):
            if key in given or key in surname:
                return key

    before: tuple[re.Match, str] | None = None
    for p in [*_PART.finditer(text), None]:
        if before:
            q, key = before
            # What can be both is a given name if another name follows.
            first = key not in surname or p is not None and known(p) and text[q.end() : p.start()].strip(" \t") == ""
            yield q.start(), q.start() + len(key), given[key] if key in given and first else surname[key], key
        before = (p, key) if p is not None and (key := known(p)) else None


def detect(text: str | None) -> list[Find]:
    """What a text holds, in order, without overlaps (the earlier kind of the list above wins)."""
    if not text:
        return []
    found: list[Find] = []
    if "@" in text:
        found += [(*m.span(), "email", m.group().lower()) for m in _EMAIL.finditer(text)]
    if "=" in text or ":" in text:
        found += [(*m.span("v"), "secret", m["v"]) for m in _SECRET.finditer(text)]
    if re.search(r"\d", text):
        for kind, pattern in _NUMBERS:
            keep = (lambda s: s) if kind == "ip" else (lambda s: re.sub(r"\D", "", s))
            found += [(*m.span(), kind, keep(m.group())) for m in pattern.finditer(text)]
    found += _names(text)
    out: list[Find] = []
    for f in found:
        at = bisect_left(out, f[:2])
        if (at == 0 or out[at - 1][1] <= f[0]) and (at == len(out) or f[1] <= out[at][0]):
            out.insert(at, f)
    return out


class _Draw:
    """A stream of numbers that a key and a seed determine."""

    def __init__(self, secret: str, *what: str):
        self.seed = hashlib.blake2b("\x1f".join(what).encode("utf-8", "surrogatepass"), key=secret.encode()[:64]).digest()
        self.pool, self.round = int.from_bytes(self.seed, "big"), 0

    def below(self, n: int) -> int:
        if self.pool < 1 << 64:
            self.round += 1
            self.pool = int.from_bytes(hashlib.blake2b(self.seed + self.round.to_bytes(4, "big")).digest(), "big")
        self.pool, x = divmod(self.pool, n)
        return x


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


_SCRIPTS = {
    "LATIN": ("bdfgklmnprstvz", "aeiou"),
    "CYRILLIC": ("бвгдзклмнпрст", "аеиоу"),
    "GREEK": ("βγδζκλμνπρστ", "αειου"),
}


def _letter(c: str, draw: _Draw) -> str:
    """Another letter of the same script and case."""
    low = c.lower()
    for letters in ("abcdefghijklmnopqrstuvwxyz", "абвгдежзийклмнопрстуфхцчшщыэюя", "αβγδεζηθικλμνξοπρστυφχψω"):
        if low in letters:
            x = letters[draw.below(len(letters))]
            return x.upper() if c != low else x
    if unicodedata.category(c) == "Lo" or not "a" <= unicodedata.normalize("NFD", low)[0] <= "z":
        return chr(ord(c) // 16 * 16 + draw.below(16)) if unicodedata.category(c) == "Lo" else c
    x = "abcdefghijklmnopqrstuvwxyz"[draw.below(26)]
    return x.upper() if c != low else x


def _shape(key: str, draw: _Draw) -> str:
    return "".join(str(draw.below(10)) if c in "0123456789" else _letter(c, draw) if c.isalpha() else c for c in key)


#: After so many rounds, surrogates whose length is free grow by a letter or syllable, so that none runs out of values.
_GROWS = 12


def surrogate(kind: str, key: str, attempt: int, secret: str, domain: str | None = None) -> str:
    """The surrogate's key for an entity's key; ``domain`` is the surrogate of an address's domain, else its first draw."""
    draw = _Draw(secret, kind, key, str(attempt))
    more = "a" * (attempt // _GROWS)
    if kind == "email":
        local, _, known = key.partition("@")
        return f"{_shape(local + more, draw)}@{domain or surrogate('domain', known, 0, secret)}"
    if kind == "domain":
        host, _, top = key.rpartition(".")
        return f"{_shape(host + more, draw)}.{top}"
    if kind == "ip":
        parts = key.split(".")
        inner = 2 if parts[:2] == ["192", "168"] else 1 if parts[0] in ("10", "127") else 0
        first = parts[:inner] or [str(x if (x := 1 + draw.below(221)) < 10 else x + 1 + (x > 125))]
        return ".".join([*first, *(str(draw.below(256)) for _ in parts[len(first) : 3]), str(1 + draw.below(254))])
    if kind == "secret":
        digits = "0123456789abcdef"
        if re.fullmatch("[0-9a-f]+", key):
            return "".join(digits[draw.below(16)] for _ in key)
        if re.fullmatch("[0-9A-F]+", key):
            return "".join(digits[draw.below(16)] for _ in key).upper()
        return _shape(key, draw)
    if kind == "card":
        out = key[0] + "".join(str(draw.below(10)) for _ in key[1:])
        if luhn(key):
            out = next(x for d in "0123456789" if luhn(x := out[:-1] + d))
        elif luhn(out):
            out = out[:-1] + str((int(out[-1]) + 1) % 10)
        return out
    if kind in ("phone", "ssn"):
        code = key[:-10] if kind == "phone" else ""  # the country's
        rest = "".join(str(draw.below(10)) for _ in key[len(code) + 1 :])
        return code + ("0" if key[len(code)] == "0" else str(2 + draw.below(8))) + rest
    script = next((s for s in _SCRIPTS if unicodedata.name(key[0], "").startswith(s)), None)
    if script is None:
        return _shape(key, draw)
    hard, soft = _SCRIPTS[script]
    syllables = "".join(hard[draw.below(len(hard))] + soft[draw.below(len(soft))] for _ in range(2 + draw.below(2) + len(more)))
    ending = {"given_f": soft[0], "given_m": hard[draw.below(len(hard))]}.get(kind, hard[draw.below(len(hard))])
    return syllables[:-1] + ending if kind == "given_f" else syllables + ending


def written(mention: str, kind: str, new: str) -> str:
    """A surrogate in the form of a mention."""
    if kind in ("phone", "ssn", "card"):
        digits = iter(new)
        return "".join(next(digits) if c in "0123456789" else c for c in mention)
    if kind == "email":
        return new.upper() if mention.isupper() else new
    if kind in ("secret", "ip"):
        return new
    return new.upper() if len(mention) > 1 and mention.isupper() else new.capitalize()


_FINDS = "array<struct<begin: int, end: int, kind: string, entity: string>>"


def _detect_all(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in batches:
        yield pd.Series([[dict(zip(("begin", "end", "kind", "entity"), f)) for f in detect(t)] for t in batch], dtype=object)


def _replace_all(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for texts, finds in batches:
        out = []
        for text, of in zip(texts, finds):
            parts, at = [], 0
            for f in sorted(of, key=lambda f: f["begin"]):
                parts += [text[at : f["begin"]], written(text[f["begin"] : f["end"]], f["kind"], f["new"])]
                at = f["end"]
            out.append("".join([*parts, text[at:]]))
        yield pd.Series(out, dtype=object)


def assign(entities: DataFrame, secret: str) -> DataFrame:
    """``entities`` (kind, entity), different -> (kind, entity, new) with all ``new`` of a kind different and no entity.

    Domains of addresses are entities too and are settled first; an address takes its domain's surrogate.
    """
    domain = F.substring_index("entity", "@", -1)
    emails = F.col("kind") == "email"
    domains = entities.where(emails).select(F.lit("domain").alias("kind"), domain.alias("entity")).distinct()
    settled = stored(_settled(domains.withColumn("host", F.lit(None).cast("string")), secret), "domains")
    hosts = settled.select(F.col("entity").alias("domain"), F.col("new").alias("host"))
    placed = entities.select("kind", "entity", F.when(emails, domain).alias("domain")).join(hosts, "domain", "left")
    return _settled(placed.select("kind", "entity", "host"), secret)


def _settled(entities: DataFrame, secret: str) -> DataFrame:
    """Each round settles all that neither collide with each other, nor with a surrogate settled before, nor with an entity."""

    def draw(kinds: pd.Series, keys: pd.Series, hosts: pd.Series, attempts: pd.Series) -> pd.Series:
        rows = zip(kinds, keys, attempts, hosts)
        return pd.Series([surrogate(k, e, a, secret, *([h] if h else [])) for k, e, a, h in rows], dtype=object)

    make = F.pandas_udf(draw, "string")
    taken = entities.select("kind", F.col("entity").alias("new"))
    settled, open_, attempt = None, entities.select("kind", "entity", "host"), 0
    while True:
        drawn = stored(open_.withColumn("new", make("kind", "entity", "host", F.lit(attempt))), "drawn")
        used = taken if settled is None else taken.union(settled.select("kind", "new"))
        first = drawn.groupBy("kind", "new").agg(F.min("entity").alias("entity"))
        good = first.join(used, ["kind", "new"], "left_anti").select("kind", "entity", "new")
        good = stored(good, "settled")
        settled = good if settled is None else settled.union(good)
        open_ = stored(drawn.join(good, ["kind", "entity"], "left_anti").select("kind", "entity", "host"), "open")
        if open_.isEmpty():
            return settled
        attempt += 1
        if attempt > 200:
            raise ValueError("some kind has more entities than its shape has values")


def pseudonymized(docs: DataFrame, secret: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_found, text) of every row, with all finds replaced."""
    find = F.pandas_udf(_detect_all, _FINDS)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    marked = rows.withColumn("finds", find("text"))
    having = stored(
        marked.where(F.size("finds") > 0).select(row_key(F.col("doc_id"), F.col("text")).alias("key"), "doc_id", "text", "finds"),
        "finds",
    )
    mentions = having.dropDuplicates(["key"]).select("key", F.explode("finds").alias("f")).select("key", "f.*")
    entities = stored(mentions.select("kind", "entity").distinct(), "entities")
    named = stored(assign(entities, secret), "surrogates")
    renewed = (
        mentions.join(named, ["kind", "entity"])
        .groupBy("key")
        .agg(F.collect_list(F.struct("begin", "end", "kind", "new")).alias("finds"))
    )
    replace = F.pandas_udf(_replace_all, "string")
    changed = having.drop("finds").join(renewed, "key").select(
        "doc_id", F.size("finds").cast("long").alias("n_found"), replace("text", "finds").alias("text")
    )
    clean = marked.where(F.size("finds") == 0).select("doc_id", F.lit(0).cast("long").alias("n_found"), "text")
    return changed.union(clean)
