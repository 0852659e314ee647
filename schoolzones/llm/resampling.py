"""Importance resampling of documents towards a target distribution, over hashed features.

Features are the runs of 1 to ``longest`` consecutive words, joined by one space; words are runs of digits, a-z after
lower-casing A-Z, and all characters beyond ASCII. A feature falls into the bucket of its CRC-32 modulo ``buckets``
(span_crc.py). A bucket's gain is 1000 times the log ratio of its smoothed share in the target to that in the documents;
a document's weight is the mean gain of its features, rounded down. With Gumbel noise drawn from the key and the
doc_id, the highest scores are a sample without replacement by importance.

Two passes over the texts: counts (each task sends at most one row per bucket), then weights. The gains are ``buckets``
numbers, which is what the driver and the tasks hold. Scores are whole numbers, so there are few of them (at most the
gains' spread plus the noise's 26,100 values): documents are counted per score, and only those that reach the last
drawn score are dealt out by score and numbered. The noise spreads documents, so no score holds many.

A null or empty text, and one without words, has weight 0 and is never eligible. A row without doc_id has no noise:
score null, never drawn. Rows that share a doc_id are judged one by one; equal ones stand in any order. Tables without
rows count as zeros. Only the named columns are read, so further ones can have any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .span_crc import crc32
from .store import stored
from .text import chunks

_IS_WORD = np.zeros(256, bool)
_IS_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


@dataclass(frozen=True)
class Spec:
    """``longest``: words in a feature; ``min_words`` of an eligible document; ``percent`` of these are drawn."""

    longest: int = 1
    buckets: int = 10_000
    min_words: int = 20
    percent: int = 10
    key: str = "2024"


def _features(texts: list[bytes], spec: Spec) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Words per text, and for each feature length the features' texts and buckets."""
    raw = np.frombuffer(b" ".join(texts).lower(), np.uint8)
    word = _IS_WORD[raw]
    before = np.concatenate(([False], word[:-1])) if len(word) else word
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])[:-1]
    text_of = np.searchsorted(begins, np.flatnonzero(word & ~before), "right") - 1
    flat = np.where(word, raw, np.uint8(32))[word | before]  # words with one space after each
    gaps = np.flatnonzero(flat == 32)
    ends = gaps if len(gaps) == len(text_of) else np.append(gaps, len(flat))
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(ends)]
    found = []
    for n in range(1, spec.longest + 1):
        first = np.arange(max(0, len(starts) - n + 1))
        first = first[text_of[first] == text_of[first + n - 1]]
        crc = crc32(flat, starts[first], ends[first + n - 1] - starts[first])
        found.append((text_of[first], (crc % np.uint32(spec.buckets)).astype(np.int64)))
    return np.bincount(text_of, minlength=len(texts)), found


def bucket_counts(df: DataFrame, text: str = "text", spec: Spec = Spec()) -> DataFrame:
    """(bucket, n) of all features of all rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(spec.buckets, np.int64)
        for batch in batches:
            for part in chunks(x.as_py() for x in batch.column(0)):
                for _, buckets in _features(part, spec)[1]:
                    total += np.bincount(buckets, minlength=spec.buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    counted = df.select(F.col(text).cast("string")).mapInArrow(count, "bucket long, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, text: str = "text", target_text: str = "text", spec: Spec = Spec()) -> np.ndarray:
    """The gain of each bucket."""
    sides = bucket_counts(docs, text, spec).withColumn("side", F.lit(0)).union(
        bucket_counts(target, target_text, spec).withColumn("side", F.lit(1))
    )
    counts = np.zeros((2, spec.buckets), np.int64)
    for bucket, n, side in sides.collect():  # at most two rows per bucket
        counts[side, bucket] = n
    all_docs, all_target = (float(x) + spec.buckets for x in counts.sum(1).tolist())
    return np.array(
        [
            math.floor(1000 * math.log((t + 1.0) * all_docs / ((s + 1.0) * all_target)))
            for s, t in zip(*counts.tolist())
        ],
        np.int64,
    )


def weighed(df: DataFrame, gain: np.ndarray, text: str = "text", name: str = "weighed", spec: Spec = Spec()) -> DataFrame:
    """``df`` with a struct column ``name`` of ``n_words``, ``n_features`` and ``weight``."""

    def measure(texts: list[bytes]) -> pd.DataFrame:
        words, found = _features(texts, spec)
        n, total = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        for text_of, buckets in found:
            n += np.bincount(text_of, minlength=len(texts))
            total += np.bincount(text_of, gain[buckets], len(texts)).astype(np.int64)
        return pd.DataFrame({"n_words": words, "n_features": n, "weight": total // np.maximum(n, 1)})

    @F.pandas_udf("n_words long, n_features long, weight long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = [measure(part) for part in chunks(batch)]
            yield pd.concat(parts, ignore_index=True) if parts else measure([])

    return df.withColumn(name, run(F.col(text).cast("string")))


def noise(doc_id: Column, key: str) -> Column:
    """1000 times a standard Gumbel value of the key and the doc_id, rounded down."""
    digest = F.sha2(F.concat(F.lit(f"{key}:"), doc_id.cast("string")), 256)
    drawn = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(drawn)))


def resample(
    docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text", spec: Spec = Spec()
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every row; ``rank`` is null where it isn't drawn."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    gain = gains(rows, target, "text", target_text, spec)
    measured = weighed(rows, gain, "text", "m", spec).select("doc_id", "m.*")
    scored = stored(measured.withColumn("score", F.col("weight") + noise(F.col("doc_id"), spec.key)), "scores")

    eligible = F.col("n_words") >= spec.min_words
    per_score = scored.where(eligible).groupBy("score").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.orderBy(F.desc_nulls_last("score")))  # one row per whole score
    per_score = stored(per_score.select("score", "n", upto.alias("upto")), "per-score")
    n = per_score.agg(F.max("upto")).first()[0] or 0
    wanted = n * spec.percent // 100
    reached = per_score.where(F.col("score").isNotNull() & (F.col("upto") - F.col("n") < wanted))
    last = reached.agg(F.min("score")).first()[0]
    drawable = eligible & (F.col("score") >= last) if last is not None else F.lit(False)
    drawable = F.coalesce(drawable, F.lit(False))

    before = reached.select(F.col("score").alias("s"), (F.col("upto") - F.col("n")).alias("before"))
    tied = F.row_number().over(Window.partitionBy("score").orderBy("doc_id"))
    ranked = scored.where(drawable).withColumn("tied", tied).join(before, F.col("score") == F.col("s"))
    rank = F.col("before") + F.col("tied")
    names = ["doc_id", "n_words", "n_features", "weight", "score"]
    return ranked.select(*names, F.when(rank <= wanted, rank).alias("rank")).union(
        scored.where(~drawable).select(*names, F.lit(None).cast("long").alias("rank"))
    )


def drawn(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", spec: Spec = Spec()) -> DataFrame:
    """The rows of ``docs`` whose doc_id is drawn, with all their columns."""
    ids = resample(docs, target, doc_id, text, spec=spec).where("rank is not null").select("doc_id").distinct()
    found = "_".join(["drawn", *docs.columns])  # a name the table can't have
    ids = ids.withColumnRenamed("doc_id", found)
    return docs.join(ids, docs[doc_id] == ids[found], "left_semi")
