"""Token ids of documents as compressed binary files, and back.

Documents are dealt into ranges of doc_id and sorted, one file per range, so the files in the order of their part
numbers hold all documents in ascending order. A file is a sequence of blocks; a block is

    header    magic ACM2, part, block, entries, ids, vocabulary, words, checksum (little-endian, 32 bits each)
    entries   doc_id (64 bits) of each, then length (32 bits) of each, then flags (8 bits) of each
    payload   16-bit words of the range coder (range_coder.py), which starts anew in each block
    newline

The checksum is the CRC-32 of everything before and after it. Flag 1: the entry goes on with the last document of the
block before; flag 2: doc_id is null. Files are written by Spark's own writer, so a lost executor costs its tasks only,
and read through Spark's reader for whole files.

A null text is an empty one. Rows with equal doc_ids are separate documents, in the order of their texts; null doc_ids
come first. An empty table gives no block and an empty result. Only the named columns are read.

Byte-level tokenizers cut a text in front of every space after something that is not white space, and between ASCII
letters, digits and marks. What lies between two such places has the same ids in every text, so a Python worker has it
encoded once and looks it up from then on, in all its tasks. Other tokenizers get the texts in one piece.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .range_coder import decode, encode
from .store import new_path, stored

MAGIC = b"ACM2"
_HEAD = struct.Struct("<4s6I")
_CHECK = struct.Struct("<I")
BLOCK_IDS = 1 << 21
#: Bytes of text for each file.
PART_BYTES = 32 << 20
#: Bytes of text that are cut and looked up at once.
SLICE_BYTES = 4 << 20
#: Pieces of text, and bytes in them, beyond which a worker forgets those that it met in one slice only.
KEPT, KEPT_BYTES = 1 << 19, 1 << 24

_UNSURE, _SPACE, _WHITE, _OTHER, _LETTER, _MARK, _DIGIT, _REST = range(8)


def _kinds() -> bytes:
    """Of what kind a character is that begins with a byte."""
    out = bytearray(256)
    for b in range(256):
        if b in b"\t\n\v\f\r":
            out[b] = _WHITE
        elif b == 0x20:
            out[b] = _SPACE
        elif b == 0x27:  # "'s" and the like are units
            out[b] = _OTHER
        elif 0x20 < b < 0x7F:
            out[b] = _LETTER if chr(b).isalpha() else _DIGIT if chr(b).isdigit() else _MARK
        elif 0x80 <= b < 0xC0:
            out[b] = _REST
        elif 0xC4 <= b <= 0xC9:  # U+0100 to U+024F are letters
            out[b] = _LETTER
        elif b > 0xC2 and b not in (0xE1, 0xE2, 0xE3):  # those may be white space
            out[b] = _OTHER
    return bytes(out)


def _cuts() -> bytes:
    """Whether a text can be cut between two kinds (8 * the first + the second); 2: if none but the first is white there."""
    out = bytearray(256)
    known = (_OTHER, _LETTER, _MARK, _DIGIT)
    for a in known:
        out[8 * a + _SPACE] = out[8 * a + _WHITE] = 1
        out[8 * _WHITE + a] = 2
        for b in known:
            out[8 * a + b] = a != b and _OTHER not in (a, b)
    return bytes(out)


_KINDS, _CUTS = _kinds(), _cuts()


def _cut(text: np.ndarray) -> np.ndarray:
    """In front of which bytes of UTF-8 a text can be cut."""
    kinds = np.frombuffer(text.tobytes().translate(_KINDS), np.uint8).copy()
    rest = np.flatnonzero(kinds == _REST)
    for _ in range(3):  # the kind of a character goes to its second byte, then to its third and fourth
        kinds[rest] = kinds[rest - 1]
    cut = np.zeros(len(kinds), np.uint8)
    cut[1:] = np.frombuffer(((kinds[:-1] << 3) | kinds[1:]).tobytes().translate(_CUTS), np.uint8)
    after = np.flatnonzero(cut == 2)
    cut[after] = (after > 1) & (kinds[after - 2] >= _OTHER)
    return cut.view(bool)


def _can_be_cut(spec: dict) -> bool:
    """Whether a tokenizer file gives a text the ids of its pieces."""
    pre = spec.get("pre_tokenizer") or {}
    return (
        pre.get("type") == "ByteLevel"
        and pre.get("use_regex", True)
        and not pre.get("add_prefix_space")
        and not any(spec.get(k) for k in ("normalizer", "truncation", "padding"))
        and not spec["model"].get("dropout")
        and not any(
            t.get("lstrip") or t.get("rstrip") or t.get("single_word") or re.search(r"\s", t["content"])
            for t in spec.get("added_tokens") or []
        )
    )


class Encoder:
    """Ids of whole texts by the tokenizers library, which meets equal pieces of them once."""

    def __init__(self, tokenizer: str):
        from tokenizers import Tokenizer

        spec = json.loads(tokenizer)
        self.tokenizer, self.cut = Tokenizer.from_str(tokenizer), _can_be_cut(spec)
        self.added = [t["content"] for t in spec.get("added_tokens") or []]
        self.line_end = self._lists(["\n"])[0]
        self.known, self.again = pa.array([], pa.string()), np.zeros(0, bool)  # pieces, and whether they came again
        self.ids, self.ends = np.zeros(0, np.int32), np.zeros(1, np.int32)  # of all pieces, by their places

    def _forget(self) -> None:
        keep = np.flatnonzero(self.again)
        if self.known.take(pa.array(keep)).nbytes > KEPT_BYTES // 2:
            keep = keep[:0]
        self.ids, self.ends = self._ids_of(keep)
        self.known, self.again = self.known.take(pa.array(keep)), np.zeros(len(keep), bool)

    def _ids_of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of known pieces one after the other, and where those of each end, with 0 in front."""
        begins, sizes = self.ends[numbers], np.diff(self.ends)[numbers]
        ends = np.zeros(len(sizes) + 1, np.int32)
        np.cumsum(sizes, out=ends[1:])
        where = np.repeat(begins - ends[:-1], sizes)
        where += np.arange(len(where), dtype=np.int32)
        return self.ids[where], ends

    def _lists(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _joined(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids and their numbers of pieces without white space but one space in front, which go in lines of 64."""
        lines = pa.ListArray.from_arrays(pa.array([*range(0, len(pieces), 64), len(pieces)], pa.int32()), pieces)
        texts = [text + "\n" for text in pc.binary_join(lines, "\n").to_pylist()]
        found = np.fromiter(chain.from_iterable(self._lists(texts)), np.int32)
        line_ends = found == self.line_end[0]
        at = np.flatnonzero(line_ends)
        # As many as there should be, so none belongs to a piece.
        return (found[~line_ends], np.diff(at, prepend=-1) - 1) if len(at) == len(pieces) else None

    def _learn(self, pieces: pa.Array) -> np.ndarray:
        """The numbers that the pieces get."""
        plain = pc.match_substring_regex(pieces, r"^ ?[^\p{Z}\p{C}]+$").to_numpy(False)
        plain &= self.cut and len(self.line_end) == 1
        order = np.argsort(~plain, kind="stable")
        pieces, ids, sizes = pieces.take(pa.array(order)), [self.ids], []
        for begin, end, joined in ((0, plain.sum(), True), (plain.sum(), len(plain), False)):
            for at in range(begin, end, 16384):
                some = pieces[at : min(at + 16384, end)]
                found = self._joined(some) if joined else None
                if not found:
                    lists = self._lists(some.to_pylist())
                    found = np.fromiter(chain.from_iterable(lists), np.int32), np.array(list(map(len, lists)), np.int32)
                ids.append(found[0])
                sizes.append(found[1])
        numbers = np.empty(len(order), np.int32)
        numbers[order] = np.arange(len(self.known), len(self.known) + len(order))
        self.known, self.again = pa.concat_arrays([self.known, pieces]), np.append(self.again, np.zeros(len(order), bool))
        self.ids = np.concatenate(ids)
        self.ends = np.append(self.ends, self.ends[-1] + np.cumsum(np.concatenate(sizes), dtype=np.int32))
        return numbers

    def _pieces(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The pieces of all texts, and where those of each text end."""
        _, offsets, data = texts.buffers()
        upto = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        first, size = upto[0], upto[-1] - upto[0]
        if not size:
            return self.known[:0], np.zeros(len(texts), np.int64)
        upto, text = upto - first, np.frombuffer(data, np.uint8)[first : first + size]
        cut = _cut(text) if self.cut else np.zeros(size, bool)
        for token in self.added if self.cut else []:
            for row in np.flatnonzero(pc.match_substring(texts, token)):  # they are found before a text is cut
                cut[upto[row] : upto[row + 1]] = False
        cut[upto[upto < size]] = True
        begins = np.flatnonzero(cut)
        places = np.empty(len(begins) + 1, np.int32)  # a slice, or one text, is below 2 GB
        places[:-1], places[-1] = begins, size
        pieces = pa.StringArray.from_buffers(len(begins), pa.py_buffer(places), pa.py_buffer(text))
        return pieces, np.searchsorted(begins, upto[1:])

    def _encode(self, texts: pa.Array) -> list[np.ndarray]:
        if len(self.known) > KEPT or self.known.nbytes > KEPT_BYTES:
            self._forget()
        pieces, upto = self._pieces(texts)
        each = pieces.dictionary_encode()
        # Looked up this way round, as the known ones are many more.
        found = pc.index_in(self.known, each.dictionary)
        met, numbers = np.flatnonzero(found.is_valid()), np.full(len(each.dictionary), -1, np.int32)
        numbers[found.drop_null().to_numpy()] = met
        self.again[met] = True
        new = np.flatnonzero(numbers < 0)
        if len(new):
            numbers[new] = self._learn(each.dictionary.take(pa.array(new)))
        ids, ends = self._ids_of(numbers[each.indices.to_numpy()])
        return np.split(ids, ends[upto][:-1])

    def each(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of every text; so many texts are taken at once as have SLICE_BYTES, or one."""
        upto = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(False), dtype=np.int64)
        begin = 0
        while begin < len(texts):
            before = upto[begin - 1] if begin else 0
            end = max(int(np.searchsorted(upto, before + SLICE_BYTES, side="right")), begin + 1)
            yield from self._encode(texts[begin:end].cast(pa.large_string()).fill_null(""))
            pa.default_memory_pool().release_unused()
            begin = end

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return list(self.each(pa.array(texts, pa.large_string())))


@lru_cache(maxsize=1)
def _encoder(tokenizer: str) -> Encoder:
    """One for all tasks of a Python worker, so that pieces are known to the next."""
    return Encoder(tokenizer)


class Entries:
    """Documents, or pieces of them, that wait for a block."""

    def __init__(self):
        self.doc_ids, self.flags, self.ids, self.total = [], [], [], 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id or 0)
        self.flags.append(2 * (doc_id is None))
        self.ids.append(ids)
        self.total += len(ids)

    def cut(self, most: int) -> Entries:
        """Take the first ``most`` ids out."""
        out = Entries()
        while self.ids and out.total < most:
            piece, room = self.ids[0], most - out.total
            out.doc_ids.append(self.doc_ids[0])
            out.flags.append(self.flags[0])
            out.ids.append(piece[:room])
            out.total += len(piece[:room])
            if len(piece) > room:
                self.ids[0], self.flags[0] = piece[room:], self.flags[0] | 1
            else:
                del self.ids[0], self.flags[0], self.doc_ids[0]
        self.total -= out.total
        return out

    def block(self, part: int, number: int, vocabulary: int) -> bytes:
        words = encode(np.concatenate(self.ids), vocabulary).astype("<u2")
        head = _HEAD.pack(MAGIC, part, number, len(self.ids), self.total, vocabulary, len(words))
        body = b"".join(
            (
                np.array(self.doc_ids, "<i8").tobytes(),
                np.array(list(map(len, self.ids)), "<u4").tobytes(),
                np.array(self.flags, np.uint8).tobytes(),
                words.tobytes(),
            )
        )
        return head + _CHECK.pack(zlib.crc32(body, zlib.crc32(head))) + body


def blocks_in(content: bytes) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(part, doc_ids, lengths, flags, ids) of every block of a file; a damaged block is an error."""
    at = 0
    while at < len(content):
        head = content[at : at + _HEAD.size]
        magic, part, number, m, n, vocabulary, n_words = _HEAD.unpack(head)
        begin = at + _HEAD.size + _CHECK.size
        end = begin + 13 * m + 2 * n_words
        body = content[begin:end]
        (check,) = _CHECK.unpack(content[begin - _CHECK.size : begin])
        if magic != MAGIC or zlib.crc32(body, zlib.crc32(head)) != check:
            raise ValueError(f"damaged block {number} of part {part}")
        words = np.frombuffer(body, "<u2", n_words, 13 * m)
        yield (
            part,
            np.frombuffer(body, "<i8", m),
            np.frombuffer(body, "<u4", m, 8 * m).astype(np.int64),
            np.frombuffer(body, np.uint8, m, 12 * m),
            decode(words, n, vocabulary),
        )
        at = end + 1  # the writer's newline


def write(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = 2,
    doc_id: str = "doc_id",
    text: str = "text",
    part_bytes: int = PART_BYTES,
    block_ids: int = BLOCK_IDS,
) -> None:
    """Encode every whole text with the tokenizer file at ``tokenizer`` and write the block files to ``path``."""
    spark = docs.sparkSession
    shipped = spark.sparkContext.broadcast(Path(tokenizer).read_text())

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = _encoder(shipped.value)
        vocabulary, part, number, waiting = encoder.tokenizer.get_vocab_size(), TaskContext.get().partitionId(), 0, Entries()
        vocabulary = max(vocabulary, end_id + 1)
        for batch in batches:
            ids_of, texts = batch.column(0).to_pylist(), batch.column(1)
            for key, ids in zip(ids_of, encoder.each(texts)):
                waiting.add(key, np.append(ids, np.int32(end_id)))
                while waiting.total >= block_ids:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([waiting.cut(block_ids).block(part, number, vocabulary)], pa.binary())], ["block"]
                    )
                    number += 1
        if waiting.total:
            yield pa.RecordBatch.from_arrays(
                [pa.array([waiting.cut(waiting.total).block(part, number, vocabulary)], pa.binary())], ["block"]
            )
        pa.default_memory_pool().release_unused()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // part_bytes))
    ordered = rows.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    packed = ordered.mapInArrow(pack, "block binary")
    packed.select(F.col("block").cast("string").alias("value")).write.text(path)


def read(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of every document in the files at ``path``.

    ``start`` counts the ids of all documents before it; the last id of a document is the end id.
    """
    schema = "part long, doc_id long, start_in_part long, n_tokens long, ids_crc32 long"
    names = ["part", "doc_id", "start_in_part", "n_tokens", "ids_crc32"]
    if with_ids:
        schema, names = schema + ", ids array<int>", [*names, "ids"]

    def rows_of(content: bytes) -> Iterator[tuple]:
        at, open_ = 0, None
        for part, doc_ids, lengths, flags, ids in blocks_in(content):
            raw, begins = ids.astype("<u4"), np.cumsum(lengths) - lengths
            for key, n, flag, begin in zip(doc_ids.tolist(), lengths.tolist(), flags.tolist(), begins.tolist()):
                piece = raw[begin : begin + n]
                if flag & 1:
                    open_[3] += n
                    open_[4] = zlib.crc32(piece.tobytes(), open_[4])
                    open_[5].append(piece)
                else:
                    if open_:
                        yield open_
                    open_ = [part, None if flag & 2 else key, at, n, zlib.crc32(piece.tobytes()), [piece]]
                at += n
            if open_:  # what a next block may go on with
                open_[5] = [np.concatenate(open_[5])] if with_ids else []
        if open_:
            yield open_

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                held = []
                for row in rows_of(content.as_py()):
                    held.append((*row[:5], *([np.concatenate(row[5]).astype(np.int32)] if with_ids else [])))
                    if len(held) == 4096:
                        yield batch_of(held)
                        held = []
                if held:
                    yield batch_of(held)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64()] * 5 + [pa.list_(pa.int32())] * with_ids
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    found = files.mapInArrow(unpack, schema)
    if not with_ids:
        found = stored(found, "token-counts")  # decoded once; it is summed and then joined
    totals = found.groupBy("part").agg(F.sum("n_tokens").alias("held"))
    before = totals.select(
        F.col("part").alias("p"),
        (F.sum("held").over(Window.orderBy("part")) - F.col("held")).alias("before"),
    )  # one row per file
    out = found.join(before, found.part == before.p)
    return out.select(
        "doc_id", (F.col("before") + F.col("start_in_part")).alias("start"), *[c for c in names if c not in names[:3]]
    )


def encoded(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write ``docs`` to a new folder and read it back."""
    path = new_path(docs.sparkSession, "token-files")
    write(docs, path, tokenizer, end_id)
    return read(docs.sparkSession, path)
