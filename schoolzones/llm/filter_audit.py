"""How filters interact: what each removes, alone and behind any others, in every order.

A filter is a named condition under which a row fails. Every filter's failing rows are stored as a table of row ids of
its own. What filter f removes behind a prefix S of other filters is f's table left-anti those of S, whatever the order
within S; what S had removed already (redundant) is f's table left-semi those of S. So two joins over the id tables, in
which each failing row stands once for each of the 2^(n-1) sets before its filter, give the numbers of all n! orders.
The tables are dealt out by row id once, and the sets are made after that, so they never travel. Survivors are the part's
rows less all removals so far. Texts are read once; rows that fail nothing take no part in the joins.

``copies`` is a filter too: rows with a text that also has a smaller doc_id, anywhere in the table. Texts meet by their
SHA-256; a group's least doc_id is a partial minimum, and the join back to it is left to Spark's skew handling.

A null text counts as empty, a null part as the empty string. Rows that share a doc_id are rows of their own (ids are
made, not read), with the labels of that doc_id; if a doc_id has several label rows, one of them with the value is
enough. A row without doc_id has no labels and neither is a copy nor makes one. An empty table gives no rows. Further
columns may have any name.
"""

from __future__ import annotations

from collections.abc import Mapping
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import new_path, stored
from .text import WORD

#: The report has n! * n rows a part.
MOST_FILTERS = 7


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def standard_filters(text: Column, words: Column) -> dict[str, Column]:
    """Short texts, texts of few different words, of many capitals, and with symbols of code or tables.

    ``words`` should be a stored or selected column, so that it is made once.
    """
    n_words, n_chars = F.size(words), F.length(text)
    n_capitals = n_chars - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {
        "A": n_words < 100,
        "B": F.size(F.array_distinct(words)) * 100 < n_words * 80,
        "C": n_capitals * 100 > n_chars * 10,
        "D": text.rlike(r"[#$%&*|]"),
    }


def _labels(labels: DataFrame, doc_id: str) -> DataFrame:
    is_one = lambda c: F.coalesce(F.max(F.col(c) == 1), F.lit(False))
    return labels.groupBy(F.col(doc_id).alias("label_id")).agg(
        is_one("quality").alias("good"), is_one("toxic").alias("toxic")
    )


def measured_rows(
    docs: DataFrame, labels: DataFrame, filters: Mapping[str, Column], doc_id: str = "doc_id", text: str = "text", part: str = "lang"
) -> DataFrame:
    """One narrow row (row, doc_id, part, good, toxic, digest, failing) for each of ``docs``; ``failing`` are names."""
    failing = F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in filters.items()]))
    narrow = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256)).alias("digest"),
        failing.cast("array<string>").alias("failing"),
    )
    joined = narrow.join(_labels(labels, doc_id), F.col("doc_id") == F.col("label_id"), "left")
    known = [F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")]
    return joined.select(F.monotonically_increasing_id().alias("row"), "doc_id", "part", *known, "digest", "failing")


def _copies(rows: DataFrame) -> DataFrame:
    """The rows whose text a smaller doc_id has too."""
    least = (
        rows.groupBy("digest")
        .agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
        .where("n > 1")
        .select(F.col("digest").alias("of"), "least")
    )
    least = stored(least, "least-ids")  # so that both sides are dealt out anew, and large groups can be split
    return rows.join(least, (F.col("digest") == F.col("of")) & (F.col("doc_id") > F.col("least")))


def failing_ids(rows: DataFrame, copies: str | None = None) -> DataFrame:
    """The id tables (filter, row, part, good, toxic), one folder for each filter."""
    spark = rows.sparkSession
    ids = ["row", "part", "good", "toxic"]
    failed = rows.select(F.explode("failing").alias("filter"), *ids)
    if copies:
        failed = failed.union(_copies(rows).select(F.lit(copies), *ids))
    path = new_path(spark, "failing")
    failed.write.partitionBy("filter").parquet(path)
    schema = "row long, part string, good boolean, toxic boolean, filter string"
    return spark.read.schema(schema).parquet(path)


def _numbers(rows: DataFrame, *more: Column) -> DataFrame:
    return rows.groupBy("part", "bit", "before").agg(F.count("*").alias("n"), *more)


def interactions(rows: DataFrame, ids: DataFrame, names: list[str]) -> DataFrame:
    """(part, filter, before, removed, good_lost, toxic_lost, redundant) for each set ``before``, as bits, of the others."""
    n = len(names)
    spark = rows.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = F.create_map(*[x for i, name in enumerate(names) for x in (F.lit(name), F.lit(1 << i))])
    tables = ids.withColumn("bit", bits[F.col("filter")]).drop("filter").repartition(tasks, "row")
    sets = F.filter(F.sequence(F.lit(0), F.lit((1 << n) - 1)), lambda s: s.bitwiseAND(F.col("bit")) == 0)
    standing = tables.withColumn("before", F.explode(sets))
    other = ids.select(F.col("row").alias("o_row"), bits[F.col("filter")].alias("o_bit")).repartition(tasks, "o_row")
    earlier = (F.col("row") == F.col("o_row")) & (F.col("before").bitwiseAND(F.col("o_bit")) != 0)

    def lost(c: str) -> Column:
        return F.sum(F.col(c).cast("long")).alias(f"{c}_lost")

    removed = _numbers(standing.join(other, earlier, "left_anti"), lost("good"), lost("toxic"))
    redundant = _numbers(standing.join(other, earlier, "left_semi"))
    long = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    zero = F.lit(0).cast("long")
    cells = rows.groupBy("part").agg(F.count("*").alias("total"))
    pairs = [(1 << i, s) for i in range(n) for s in range(1 << n) if not s >> i & 1]
    cells = cells.withColumn(
        "cell", F.explode(F.array(*[F.struct(F.lit(b).alias("bit"), F.lit(s).alias("before")) for b, s in pairs]))
    ).select("part", "total", "cell.*")
    key = ["part", "bit", "before"]
    counted = (
        cells.select(*key, "total", *[zero.alias(c) for c in ("removed", "good_lost", "toxic_lost", "redundant")])
        .union(removed.select(*key, zero, "n", "good_lost", "toxic_lost", zero))
        .union(redundant.select(*key, zero, zero, zero, zero, "n"))
    )
    return counted.groupBy(*key).agg(
        *[long(c).alias(c) for c in ("total", "removed", "good_lost", "toxic_lost", "redundant")]
    )


def _orders(names: list[str]) -> list[tuple[str, int, int, int]]:
    """(order, step, bit of its filter, bits of those before it)."""
    out, between = [], "" if all(len(x) == 1 for x in names) else " "
    for order in permutations(range(len(names))):
        text, before = between.join(names[i] for i in order), 0
        for step, i in enumerate(order, 1):
            out.append((text, step, 1 << i, before))
            before |= 1 << i
    return out


def audit(
    docs: DataFrame,
    labels: DataFrame,
    filters: Mapping[str, Column],
    copies: str | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    part: str = "lang",
) -> DataFrame:
    """One row per part, order of the filters and step, zeros included.

    ``filters`` are conditions over ``docs``; ``copies`` names one more filter, for repeated texts. ``shapley`` is what
    the step's filter removes, summed over all orders; divided by their number it is its Shapley value.
    """
    spark = docs.sparkSession
    names = [*filters, *([copies] if copies else [])]
    if not 0 < len(names) <= MOST_FILTERS:
        raise ValueError(f"1 to {MOST_FILTERS} filters, not {len(names)}: all orders are reported")
    rows = stored(measured_rows(docs, labels, filters, doc_id, text, part), "audit-rows")
    numbers = stored(interactions(rows, failing_ids(rows, copies), names), "interactions")

    n = len(names)
    everything = (1 << n) - 1
    size_before = F.bit_count("before")
    orders_with = F.element_at(
        F.array(*[F.lit(factorial(k) * factorial(n - 1 - k)) for k in range(n)]), (size_before + 1).cast("int")
    )
    alone = F.col("before") == F.lit(everything).bitwiseXOR(F.col("bit"))
    per_filter = numbers.groupBy("part", "bit").agg(
        F.sum(F.when(alone, F.col("removed"))).alias("unique_fails"),
        F.sum(F.col("removed") * orders_with).alias("shapley"),
    )
    steps = spark.createDataFrame(_orders(names), "filter_order string, step int, bit int, before int")
    so_far = Window.partitionBy("part", "filter_order").orderBy("step")
    report = numbers.join(per_filter, ["part", "bit"]).join(F.broadcast(steps), ["bit", "before"])  # n! * n steps
    return report.select(
        "part",
        "filter_order",
        "step",
        (F.col("total") - F.sum("removed").over(so_far)).alias("kept"),
        *("removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"),
    )
