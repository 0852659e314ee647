"""Benchmark decontamination by template canonicalisation.

Texts become word sequences in which numbers, names and units are typed placeholders, so a question with other values
has the template of the original. Five-word template windows of the benchmark meet those of the documents in a hash
join. A document that holds at least 0.8 of an item's windows is a candidate; it is reported if the
values filled into the placeholders are a consistent renaming of the item's (equal values stay equal, different ones
stay different) on the best alignment, or on any other that by itself has 0.8 of the windows.

All main work is Spark's own functions. The benchmark side of the join is broadcast only if its windows, counted
first, are at most ``max_broadcast``; a larger benchmark is joined by shuffle.

A window with more than ``MAX_PLACEHOLDERS`` placeholders says too little by its template; it is known by its values. Such
windows count for items that have no others (a list of measures, say), which are found where the values are the same.

Null and empty texts have no windows. Items with under five words can't be found. Rows without doc_id can't be named and are not reported; repeated rows and rows that share a doc_id are
judged one by one and reported once, with the best of them. Only the named columns are read. Empty tables give an empty
result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .native import let, unused
from .store import stored

#: Words that count as a unit after a number.
UNITS = """
mm cm m km in inch inches ft foot feet yd yard yards mile miles mg g kg gram grams kilogram kilograms t ton tons lb lbs
oz pound pounds ounce ounces ml cl l liter liters litre litres gallon gallons s sec second seconds min minute minutes h
hr hrs hour hours day days week weeks month months year years mph kmh hz khz mhz ghz w kw mw v kv a ma j kj cal kcal pa
kpa bar k c f degree degrees percent dollar dollars euro euros cent cents usd eur gbp yen
""".split()

WINDOW = 5
MIN_SHARE = 0.8
#: A window with more placeholders than this is known by its values.
MAX_PLACEHOLDERS = 3

# A number or a word, with one closing mark, which tells where a sentence ends.
_TOKEN = r"(?:\p{N}+(?:[.,]\p{N}+)*|\p{L}[\p{L}\p{M}']*)[.!?]?"
_NUMBER, _UNIT, _NAME = "\u0001", "\u0002", "\u0003"


def tokens(text: Column) -> Column:
    """The words and numbers of a text, as written."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(_TOKEN), F.lit(0))


def _is_number(word: Column) -> Column:
    return (word >= "0") & (word < ":")


def template(words: Column) -> Column:
    """Tokens -> lower-case words and placeholders; a name is a capitalised word inside a sentence."""

    def one(all_: Column):
        def key(raw: Column, i: Column) -> Column:
            word = F.rtrim(raw, F.lit(".!?"))
            low = F.lower(word)
            before = F.when(i > 0, F.get(all_, i - 1)).otherwise(F.lit("."))
            inside = ~F.substring(before, -1, 1).isin(".", "!", "?")
            capital = (F.length(word) > 1) & (F.substring(word, 2, 1 << 20) == F.substring(low, 2, 1 << 20))
            return (
                F.when(_is_number(word), _NUMBER)
                .when((word != low) & capital & inside, _NAME)
                .when(_is_number(before) & low.isin(UNITS), _UNIT)
                .otherwise(low)
            )

        return F.transform(all_, key)

    return let(words, one)


def _is_slot(key: Column) -> Column:
    return key.isin(_NUMBER, _UNIT, _NAME)


def _value(raw: Column) -> Column:
    return F.lower(F.rtrim(raw, F.lit(".!?")))


def _slots_at(flags: Column, start: Column) -> Column:
    """Placeholders of the window from place ``start``; ``flags``: 1 for each placeholder, else 0."""
    return sum((F.get(flags, start + k) for k in range(1, WINDOW)), F.get(flags, start))


def _starts(keys: Column) -> Column:
    """The first places of all windows, from 0."""
    all_ = F.sequence(F.lit(0), F.size(keys) - WINDOW)
    return F.when(F.size(keys) >= WINDOW, all_).otherwise(F.array().cast("array<int>"))


def _flags(keys: Column) -> Column:
    return F.transform(keys, lambda key: (key <= _NAME).cast("int"))  # words begin with a letter


def template_windows(raw: Column, keys: Column) -> Column:
    """The hash of every window of five: of its template, or of its values where that is nearly all placeholders."""

    def run(raw: Column, keys: Column, flags: Column) -> Column:
        def one(i: Column) -> Column:
            by_value = F.xxhash64(F.transform(F.slice(raw, i + 1, WINDOW), _value))
            by_template = F.xxhash64(F.slice(keys, i + 1, WINDOW))
            return F.when(_slots_at(flags, i) > MAX_PLACEHOLDERS, by_value).otherwise(by_template)

        return F.transform(_starts(keys), one)

    return let(raw, lambda r: let(keys, lambda k: let(_flags(k), lambda f: run(r, k, f))))


def benchmark_windows(benchmark: DataFrame, item_id: str, text: str) -> DataFrame:
    """(item_id, h, wpos): every different window of an item that counts, at its first place."""
    words = benchmark.where(F.col(item_id).isNotNull()).select(F.col(item_id).alias("item_id"), tokens(F.col(text)).alias("raw"))
    words = words.select("item_id", "raw", template(F.col("raw")).alias("keys"))
    slots = let(_flags(F.col("keys")), lambda f: F.transform(_starts(F.col("keys")), lambda i: _slots_at(f, i)))
    found = words.select("item_id", slots.alias("slots"), template_windows(F.col("raw"), F.col("keys")).alias("h"))
    return (
        found.select("item_id", F.array_min("slots").alias("least"), F.posexplode(F.arrays_zip("slots", "h")).alias("wpos", "of"))
        .where((F.col("of.slots") <= MAX_PLACEHOLDERS) | (F.col("least") > MAX_PLACEHOLDERS))
        .groupBy("item_id", F.col("of.h").alias("h"))
        .agg(F.min("wpos").alias("wpos"))
    )


def candidates(docs: DataFrame, items: DataFrame, max_broadcast: int) -> DataFrame:
    """(doc_id, item_id) that share enough window templates. ``items``: from benchmark_windows."""
    wanted = items.groupBy("item_id").agg(F.count("*").alias("of"))
    by_hash = items.select("h", "item_id")
    if items.count() <= max_broadcast:
        by_hash = F.broadcast(by_hash)
    hashes = F.array_distinct(let(tokens(F.col("text")), lambda raw: template_windows(raw, template(raw))))
    met = docs.select("doc_id", F.explode(hashes).alias("h")).join(by_hash, "h")
    return (
        met.distinct()
        .groupBy("doc_id", "item_id")
        .agg(F.count("*").alias("n"))
        .join(wanted, "item_id")
        .where(F.col("n") >= F.col("of") * MIN_SHARE)
        .select("doc_id", "item_id", F.col("of").alias("n_windows"))
    )


def _consistent(values: Column) -> Column:
    """``values``: (type, item's value, document's value); a one-to-one renaming within each type."""

    def run(v: Column) -> Column:
        pairs = F.array_distinct(v)
        left = F.array_distinct(F.transform(v, lambda x: F.struct(x.kind, x.item)))
        right = F.array_distinct(F.transform(v, lambda x: F.struct(x.kind, x.doc)))
        return (F.size(pairs) == F.size(left)) & (F.size(pairs) == F.size(right))

    return let(values, run)


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    max_broadcast: int = 1_000_000,
) -> DataFrame:
    """(doc_id, item_id, n_windows, n_matched, n_slots): the documents that hold an item, or one made from it."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).where("doc_id is not null")
    items = stored(benchmark_windows(benchmark, item_id, item_text), "benchmark-windows")
    found = stored(candidates(docs, items, max_broadcast), "leaks")

    words = docs.join(found, "doc_id").select(
        "doc_id", "item_id", "n_windows", F.xxhash64("text").alias("row"), tokens(F.col("text")).alias("raw")
    )
    words = words.select("*", template(F.col("raw")).alias("keys"))
    hashes = template_windows(F.col("raw"), F.col("keys"))
    again = words.select("doc_id", "item_id", "row", F.posexplode(hashes).alias("pos", "h"))
    aligned = (
        again.join(items, ["item_id", "h"])
        .groupBy("doc_id", "row", "item_id", (F.col("pos") - F.col("wpos")).alias("shift"))
        .agg(F.countDistinct("h").alias("n"), F.collect_set("h").alias("hs"))
        .groupBy("doc_id", "row", "item_id")
        .agg(
            F.size(F.array_distinct(F.flatten(F.collect_list("hs")))).alias("n_matched"),
            F.max(F.struct("n", (-F.col("shift")).alias("less"))).alias("best"),
            F.collect_list(F.struct("n", (-F.col("shift")).alias("less"))).alias("shifts"),
        )
    )
    enough = lambda x: x.n >= F.col("n_windows") * MIN_SHARE
    # The best alignment first, then the others that have enough windows of their own.
    others = F.reverse(F.array_sort(F.filter("shifts", lambda x: enough(x) & (x != F.col("best")))))
    shifts = F.transform(F.concat(F.array("best"), others), lambda x: -x.less)
    source = benchmark.select(F.col(item_id).alias("item_id"), tokens(F.col(item_text)).alias("item_raw")).where(
        "item_id is not null"
    )
    source = source.select("*", template(F.col("item_raw")).alias("item_keys"))

    def slots(row: Column) -> Column:
        place = F.sequence(F.lit(0), F.size(row.item_keys) - 1)
        same = lambda i: (F.get(row.keys, i + row["shift"]) == F.get(row.item_keys, i)) & _is_slot(
            F.get(row.item_keys, i)
        )
        return F.transform(
            F.filter(place, same),
            lambda i: F.struct(
                F.get(row.item_keys, i).alias("kind"),
                _value(F.get(row.item_raw, i)).alias("item"),
                _value(F.get(row.raw, i + row["shift"])).alias("doc"),
            ),
        )

    whole = F.transform("shifts", lambda at: F.struct("raw", "keys", "item_raw", "item_keys", at.alias("shift")))
    consistent = F.filter(F.transform(whole, slots), _consistent)
    return (
        words.dropDuplicates(["doc_id", "row", "item_id"])
        .join(aligned, ["doc_id", "row", "item_id"])
        .where(F.col("n_matched") >= F.col("n_windows") * MIN_SHARE)
        .withColumn("shifts", shifts)
        .join(source, "item_id")
        .select("doc_id", "item_id", "n_windows", "n_matched", F.get(consistent, 0).alias("slots"))
        .where("slots is not null")
        .groupBy("doc_id", "item_id")
        .agg(
            F.max("n_windows").cast("long").alias("n_windows"),
            F.max("n_matched").cast("long").alias("n_matched"),
            F.max(F.size("slots")).cast("long").alias("n_slots"),
        )
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows of reported documents; rows without doc_id stay. Further columns may have any name."""
    leak = unused("leak", docs)
    leaks = stored(contaminated(docs, benchmark).select(F.col("doc_id").alias(leak)).distinct(), "leaked")
    return docs.join(leaks, F.col("doc_id") == F.col(leak), "left_anti")
