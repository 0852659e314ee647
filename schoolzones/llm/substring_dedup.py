"""Removal of long repeated word sequences by prefix-partitioned suffix trees.

A window (``DEPTH`` consecutive words) that also starts in a document with a smaller id is a repeat; all words it covers
go. Windows are suffixes cut at that depth, and equal windows are the suffixes below one deep internal node of a suffix
tree. The tree is built in memory-sized parts:

* A window is routed by the prefix that ends with its least 10-word gram (by hash), a prefix of variable length. Equal
  windows have equal prefixes, so they meet in one group; neighbouring windows mostly share the gram, so their words
  travel once, as one region.
* Only grams found in two documents can lead to a repeat; the others are leaves and never travel.
* The bytes of each group are summed before anything is cut. Groups of up to ``GROUP_BYTES`` are put together into
  batches of ``BATCH_BYTES``. In a batch, paths grow level by level with doubling length (1, 2, 4 ... words) down to
  ``DEPTH``; the suffixes that still share a node there are repeats. This takes about 40 times the batch's bytes.
* A group of more bytes gets a longer prefix, the whole window: then each group is a single node, and its least document
  is a minimum with partial sums, of any size. Equal windows of one document that overlap are one row, so a text of one
  repeated word, or of a few in turn, is as many rows as it has different windows.

Documents with equal words are merged beforehand (all but the least are repeats as a whole), so thousands of copies cost
as much as one. Words are compared as bytes in the trees, by 128-bit hash in the longest prefixes.

A null text has no words and keeps none. Rows without doc_id neither lose words nor cause a loss. Rows that share a
doc_id are judged one by one and never against each other; repeated rows get equal results. Texts below ``DEPTH`` words
are unchanged. An empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import stored
from .text import Words, scrambled, chunks, encoded, stable_codes

DEPTH = 50
GRAM = 10
#: Bytes of one prefix's regions that go into one tree.
GROUP_BYTES = 1 << 20
BATCH_BYTES = 8 << 20
_STEP = np.uint64(0xD6E8FEB86659FD93)


def _grams(codes: np.ndarray, n: int, step: np.uint64 = _STEP) -> np.ndarray:
    """Hashes of all runs of ``n`` words."""
    if len(codes) < n:
        return np.zeros(0, np.uint64)
    rolled = codes[: len(codes) - n + 1].copy()
    for j in range(1, n):
        rolled = rolled * step + codes[j : len(codes) - n + 1 + j]
    return scrambled(rolled)


def routes(codes: np.ndarray, text_of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with the same least gram: (first window, number of windows, gram), in order of the words."""
    if len(codes) < DEPTH:
        return (np.zeros(0, np.int64),) * 3
    least, span, wanted = _grams(codes, GRAM), 1, DEPTH - GRAM + 1
    while span < wanted:  # a sliding minimum whose span doubles
        more = min(span, wanted - span)
        least = np.minimum(least[:-more], least[more:])
        span += more
    starts = np.flatnonzero(text_of[: len(least)] == text_of[DEPTH - 1 :])
    gram = least[starts].view(np.int64)
    new = np.ones(len(starts), bool)
    new[1:] = (gram[1:] != gram[:-1]) | (np.diff(starts) != 1)
    first = np.flatnonzero(new)
    return starts[first], np.diff(np.append(first, len(starts))), gram[first]


_SIGNATURE = "n_words long, digest string, grams array<long>, sizes array<long>"


def _signature(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for part in chunks(batch):
            words = Words(part)
            ends = np.cumsum(words.count)
            starts = ends - words.count
            first, n, gram = routes(stable_codes(words.words), words.text_of)
            length = np.fromiter(map(len, words.words), np.int64, len(words.words)) + 1
            places = np.concatenate(([0], np.cumsum(length)))
            sizes = places[first + n + DEPTH - 1] - places[first] if len(first) else np.zeros(0, np.int64)
            cuts = np.searchsorted(first, ends)
            begins = np.searchsorted(first, starts)
            for a, b, i, j in zip(starts.tolist(), ends.tolist(), begins.tolist(), cuts.tolist()):
                digest = hashlib.sha256(b" ".join(words.words[a:b])).hexdigest()
                out.append((b - a, digest, gram[i:j], sizes[i:j]))
        yield pd.DataFrame(out, columns=["n_words", "digest", "grams", "sizes"])


_REGION = "gram long, doc_id long, text_key long, at long, n long, words binary"
_WINDOW = "h1 long, h2 long, doc_id long, text_key long, begin long, end long"
_SPAN = "doc_id long, text_key long, begin long, end long"


def _rows(columns: list, schema: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, schema)], [n for n, _ in schema])


def _cut_regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each text, the regions whose gram is in ``light``."""
    kinds = [(x.split()[0], pa.binary() if "binary" in x else pa.int64()) for x in _REGION.split(", ")]
    for batch in batches:
        held, size = [[] for _ in kinds], 0
        for doc_id, key, text, light in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text_key", "text", "light"))):
            words = encoded(text).split()
            first, n, gram = routes(stable_codes(words), np.zeros(len(words), np.int8))
            use = np.isin(gram, np.array(light, np.int64))
            for a, k, g in zip(first[use].tolist(), n[use].tolist(), gram[use].tolist()):
                region = b" ".join(words[a : a + k + DEPTH - 1])
                size += len(region)
                for column, value in zip(held, (g, doc_id, key, a, k, region)):
                    column.append(value)
                if size > BATCH_BYTES:
                    yield _rows(held, kinds)
                    held, size = [[] for _ in kinds], 0
        yield _rows(held, kinds)


def overlapping(h1: np.ndarray, h2: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal windows of a document, each no further than its length and as far from the one before as that from its own
    before, as one: the numbers of the first and last of each such row, in order of the hashes and places."""
    order = np.lexsort((at, h2, h1))
    h1, h2, at = h1[order], h2[order], at[order]
    step = np.diff(at, prepend=at[:1])
    step[1:][(h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1]) | (step[1:] > DEPTH)] = 0  # 0: not a window of the row before
    new = step == 0
    new[1:] |= (step[1:] != step[:-1]) & (step[:-1] != 0)
    first = np.flatnonzero(new)
    return order[first], order[np.append(first[1:], len(order)) - 1]


def _cut_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each text, the windows whose gram is in ``heavy``, as two hashes of all their words and the words covered."""
    kinds = [(x.split()[0], pa.int64()) for x in _WINDOW.split(", ")]
    for batch in batches:
        for doc_id, key, text, heavy in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text_key", "text", "heavy"))):
            words = encoded(text).split()
            codes = stable_codes(words)
            first, n, gram = routes(codes, np.zeros(len(words), np.int8))
            use = np.isin(gram, np.array(heavy, np.int64))
            first, n = first[use], n[use]
            at = np.repeat(first - np.concatenate(([0], np.cumsum(n)[:-1])).astype(np.int64), n) + np.arange(n.sum())
            if len(at):
                h1, h2 = _grams(codes, DEPTH), _grams(scrambled(codes), DEPTH, np.uint64(0xA0761D6478BD642F))
                h1, h2 = h1[at].view(np.int64), h2[at].view(np.int64)
                a, b = overlapping(h1, h2, at)
                same = [np.full(len(a), doc_id), np.full(len(a), key)]
                yield _rows([h1[a], h2[a], *same, at[a], at[b] + DEPTH], kinds)


def deep_nodes(codes: np.ndarray, left: np.ndarray, depth: int) -> np.ndarray:
    """For each suffix, the number of the node ``depth`` words below the root that it passes; -1 if it ends above.

    ``codes``: the words of all strings one after the other; ``left``: words up to the end of the string, from each place.
    """
    node, have = pd.factorize(codes)[0], 1
    while have < depth:
        step = min(have, depth - have)
        whole = np.flatnonzero(left >= have + step)
        paths = node[whole] * np.int64(len(codes) + 1) + node[whole + step]
        node = np.full(len(codes), -1)
        node[whole] = pd.factorize(paths)[0]
        have += step
    return node


def _spans(table: pa.Table) -> pa.RecordBatch:
    """The repeats found in one batch of whole groups."""
    texts = table.column("words").to_pylist()
    words = [t.split() for t in texts]
    size = np.fromiter(map(len, words), np.int64, len(words))
    column = lambda name: table.column(name).to_numpy()
    n, doc_id = column("n"), column("doc_id")
    codes = pa.array([w for ws in words for w in ws], pa.binary()).dictionary_encode().indices.to_numpy()
    base = np.cumsum(size) - size
    left = np.repeat(base + size, size) - np.arange(len(codes))
    node = deep_nodes(codes.astype(np.int64), left, DEPTH)
    region = np.repeat(np.arange(len(n)), n)
    offset = np.arange(len(region)) - np.repeat(np.cumsum(n) - n, n)
    node = node[base[region] + offset]
    doc = doc_id[region]
    least = np.full(node.max() + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, node, doc)
    hit = np.flatnonzero(doc > least[node])  # below a deep node that a smaller document also reaches
    new = np.ones(len(hit), bool)
    new[1:] = (np.diff(hit) != 1) | (region[hit[1:]] != region[hit[:-1]])
    ends = np.append(np.flatnonzero(new)[1:], len(hit)) - 1 if len(hit) else np.zeros(0, np.int64)
    begins = hit[new]
    at = column("at")[region[begins]]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(doc[begins], pa.int64()),
            pa.array(column("text_key")[region[begins]], pa.int64()),
            pa.array(at + offset[begins], pa.int64()),
            pa.array(at + offset[hit[ends]] + DEPTH, pa.int64()),
        ],
        ["doc_id", "text_key", "begin", "end"],
    )


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches sorted by gram -> spans; whole groups are put together up to BATCH_BYTES."""
    held, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.nbytes
        if size < BATCH_BYTES:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        grams = table.column("gram").to_numpy()
        cut = int(np.searchsorted(grams, grams[-1]))  # the last group may go on
        if cut:
            yield _spans(table.slice(0, cut))
        held = table.slice(cut).combine_chunks().to_batches()
        size = sum(b.nbytes for b in held)
    if held:
        yield _spans(pa.Table.from_batches(held).combine_chunks())


def _kept(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for texts, spans in batches:
        out = []
        for text, of in zip(texts, spans):
            words = np.array(encoded(text).split(), object)
            keep = np.ones(len(words), bool)
            for span in of:
                keep[span["begin"] : span["end"]] = False
            out.append((int((~keep).sum()), hashlib.sha256(b" ".join(words[keep])).hexdigest()))
        yield pd.DataFrame(out, columns=["n_removed", "kept_sha256"])


def _text_key(digest: Column) -> Column:
    return F.xxhash64(digest)


class Repeats:
    """The repeats of a table: ``marked`` (a row per document), ``texts`` (documents that may hold one) and ``spans``."""

    def __init__(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", group_bytes: int = GROUP_BYTES):
        docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
        sign = F.pandas_udf(_signature, _SIGNATURE)
        signed = stored(docs.select("doc_id", sign("text").alias("s")).select("doc_id", "s.*"), "signatures")
        least = signed.groupBy("digest").agg(F.min("doc_id").alias("least"))
        self.marked = stored(
            signed.select("doc_id", "n_words", "digest").join(least, "digest").withColumn("text_key", _text_key(F.col("digest"))),
            "marked",
        )
        firsts = least.where("least is not null").select("digest", F.col("least").alias("doc_id"))
        found = (
            signed.dropDuplicates(["doc_id", "digest"])
            .join(firsts, ["digest", "doc_id"])
            .select("doc_id", _text_key(F.col("digest")).alias("text_key"), F.explode(F.arrays_zip("grams", "sizes")).alias("of"))
            .select("doc_id", "text_key", F.col("of.grams").alias("gram"), F.col("of.sizes").alias("size"))
        )
        found = stored(found, "grams")
        shared = (
            found.groupBy("gram")
            .agg(F.sum("size").alias("bytes"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
            .where("lo < hi")
            .select("gram", (F.col("bytes") > group_bytes).alias("is_heavy"))
        )
        grams_of = (
            found.join(shared, "gram")
            .groupBy("doc_id", "text_key")
            .agg(
                F.collect_set(F.when(~F.col("is_heavy"), F.col("gram"))).alias("light"),
                F.collect_set(F.when(F.col("is_heavy"), F.col("gram"))).alias("heavy"),
            )
        )
        self.texts = stored(self._with_text(docs, grams_of), "texts")
        regions = self.texts.select("doc_id", "text_key", "text", "light").mapInArrow(_cut_regions, _REGION)
        light = regions.repartition("gram").sortWithinPartitions("gram").mapInArrow(_trees, _SPAN)
        heavy = stored(
            self.texts.where(F.size("heavy") > 0)
            .select("doc_id", "text_key", "text", "heavy")
            .mapInArrow(_cut_windows, _WINDOW),
            "windows",
        )
        nodes = heavy.groupBy("h1", "h2").agg(F.min("doc_id").alias("least"))
        deep = heavy.join(nodes, ["h1", "h2"]).where("doc_id > least")
        self.spans = light.union(deep.select("doc_id", "text_key", "begin", "end"))

    @staticmethod
    def _with_text(docs: DataFrame, grams_of: DataFrame) -> DataFrame:
        """The documents with shared grams, each once; rows of that doc_id with other words drop out by their digest."""

        @F.pandas_udf("string")
        def digest(texts: pd.Series) -> pd.Series:
            return texts.map(lambda t: hashlib.sha256(b" ".join(encoded(t).split())).hexdigest())

        joined = docs.join(grams_of, "doc_id").where(_text_key(digest("text")) == F.col("text_key"))
        return joined.select("doc_id", "text_key", "text", "light", "heavy").dropDuplicates(["doc_id", "text_key"])


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", group_bytes: int = GROUP_BYTES) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row: what is left without words of an earlier document."""
    found = Repeats(docs, doc_id, text, group_bytes)
    spans = found.spans.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    kept = F.pandas_udf(_kept, "n_removed long, kept_sha256 string")
    changed = (
        found.texts.join(spans, ["doc_id", "text_key"])
        .select("doc_id", "text_key", kept("text", "spans").alias("k"))
        .select("doc_id", "text_key", "k.*")
    )
    copy = (F.col("least") < F.col("doc_id")) & (F.col("n_words") >= DEPTH)
    return found.marked.join(changed, ["doc_id", "text_key"], "left").select(
        "doc_id",
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "digest")).alias("kept_sha256"),
    )
