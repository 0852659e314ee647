"""Near-duplicates by SimHash, found by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most 2 bits have a common variant at most 1 bit from each. So every distinct
fingerprint emits itself and its 64 one-bit changes, and rows meet by variant. All that meet at one variant lie within
2 bits of each other, and which they are fits in a 64-bit mask (the bit each one changed), so a bucket is one `bit_or`
with partial sums instead of a list, and its links are a star, not all pairs. Equal fingerprints are merged before.

Nulls and texts without a word have fingerprint zero, like any other. A row without doc_id takes part and gets the
component's least doc_id (null if no row of it has one). Repeated rows and equal doc_ids are linked as any two rows.
An empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import connected
from .native import row_key, unused
from .store import stored
from .text import encoded

SEED = 42


def _fingerprint(text: str | None, shingle: int) -> int:
    words = encoded(text).lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_digest
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
    hashes = b"".join([digest(g, SEED) for g in grams])  # big-endian
    bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(n, 8), axis=1)
    ones = bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n).view(">u8")[0].astype(np.uint64).view(np.int64))


def fingerprint(text: Column, shingle: int = 3) -> Column:
    """The 64-bit fingerprint as a (signed) long; bytes.lower() and bytes.split() know ASCII only, as intended."""

    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([_fingerprint(t, shingle) for t in batch], dtype="int64")

    return run(text)


def links(points: DataFrame) -> DataFrame:
    """``points`` (fp, distinct) -> (u, v): a star over all fingerprints that share a variant, checked bit by bit."""
    zero = F.lit(0).cast("long")
    one_bit = [F.lit(1 << i if i < 63 else -(1 << 63)).cast("long") for i in range(64)]
    change = F.explode(F.array(zero, *one_bit)).alias("change")
    met = (
        points.select("fp", change)
        .select(F.col("fp").bitwiseXOR(F.col("change")).alias("variant"), "change")
        .groupBy("variant")
        .agg(F.bit_or("change").alias("changes"), F.max(F.col("change") == 0).alias("itself"))
        .where(F.bit_count("changes") + F.col("itself").cast("int") > 1)
    )
    changed = F.filter(
        F.array(*one_bit), lambda bit: F.col("changes").bitwiseAND(bit) != 0
    )
    members = F.transform(
        F.concat(F.when(F.col("itself"), F.array(zero)).otherwise(F.array().cast("array<long>")), changed),
        lambda bit: F.col("variant").bitwiseXOR(bit),
    )
    return (
        met.select(members.alias("fps"))
        .select(F.array_min("fps").alias("v"), F.explode("fps").alias("u"))
        .where((F.col("u") != F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= 2))
    )


def _classes(points: DataFrame) -> DataFrame:
    """(fp, least, root) of each fingerprint in ``points``: its least doc_id, and one name for its component."""
    distinct = points.groupBy("fp").agg(F.min("doc_id").alias("least"))
    # The distinct fingerprints are few bytes but 65 variants each, so they are spread before they fan out.
    parts = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    roots = connected(links(distinct.select("fp").repartition(parts, F.xxhash64("fp"))))
    return stored(
        distinct.join(roots, distinct.fp == roots.node, "left").select(
            "fp", "least", F.coalesce("root", "fp").alias("root")
        ),
        "labels",
    )


def components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``."""
    points = stored(
        docs.select(F.col(doc_id).alias("doc_id"), fingerprint(F.col(text), shingle).alias("fp")), "fingerprints"
    )
    labelled = _classes(points)
    named = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = labelled.join(named, "root").select("fp", "component_id")
    return points.join(by_fp, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """One row of every component, whatever the rows' doc_ids are: that with the smallest one, none last.

    Of rows that share it, the one whose text has the least SHA-256 stays, and of rows that share that too, the least by
    the other columns (any, if their types have no order). Every column passes as it is, whatever its name.
    """
    key = row_key(F.col(doc_id), F.col(text))
    points = stored(
        docs.select(F.col(doc_id).alias("doc_id"), key.alias("key"), fingerprint(F.col(text), shingle).alias("fp")),
        "fingerprints",
    )
    first = F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "key"))
    kept = points.join(_classes(points).select("fp", "root"), "fp").groupBy("root").agg(first.alias("first"))
    row, found = unused("row", docs), unused("found", docs)
    kept = kept.select(F.col("first.key").alias(found))
    keyed = docs.withColumn(row, key)
    met = keyed.join(kept, F.col(row) == F.col(found), "left_semi")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    ordered = not re.search("map<|variant", docs.schema.simpleString())
    one = (F.min if ordered else F.first)(whole)
    return met.groupBy(row).agg(one.alias(found)).select(f"{found}.*")
