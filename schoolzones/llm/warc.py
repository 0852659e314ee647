"""WARC archives: a writer, and a salvage reader that goes on after damage.

Writing. Each row becomes a record. Of rows with equal payloads of at least ``min_revisit`` bytes, that with the least key
is the response and the others revisit it: they carry digest and HTTP head only, and name its record. Rows meet by the
payload's SHA-256; the least key is a partial minimum, and the join back to it is left to Spark's skew handling. A record
is a gzip member of its own (a larger one several, of less than 16 MiB each) or, without gzip, plain. Spark's text writer
stores them, so a lost executor costs its tasks only. Its line separator is a byte that each blob ends with anyway (the
high byte of the last member's length, or the blank lines after a record), so the files hold nothing but WARC data. A
file has a few blobs and so a bounded size, whatever the partitions are.

Reading. At each position stands either a gzip member or a version line. A member is checked by its own CRC-32, a record
by its named fields, its length, the blank lines after it, and the digests it declares. After a failed check the reader
looks for the next valid member that has a version line, or the next version line with a valid record, goes on there,
and logs the bytes between as a quarantined gap. Inside a valid member that holds several records the same is done over
the unpacked bytes. A record may span members. Every byte of a file is in a record or in a gap. A valid record that lies
inside the payload of a damaged one is found too. A file is one task's, and is held whole, packed.

A null payload is an empty one, a null address is left out, line breaks in it are escaped. A null key is an empty name
in the record's id and comes back as null; it is a response only if no equal payload has a key. Rows that share the least
key are all responses, and repeated rows stay. An empty table gives no records. Further columns may have any name.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import stored

#: Fixed values of the format.
MAGIC = b"\x1f\x8b\x08"
VERSION = re.compile(rb"WARC/\d+\.\d+\r?\n")
END = b"\r\n\r\n"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: A record's named fields have at most so many bytes.
HEAD_BYTES = 1 << 20
#: Bytes that one member packs, under 2**24, so that the last byte of its length is 0.
MEMBER_BYTES = (1 << 24) - 1
#: Packed bytes of a blob, and blobs of a file.
BLOB_BYTES, FILE_BLOBS = 8 << 20, 4

SCHEMA = (
    "kind string, file string, start long, end long, inner_start long, inner_end long, reason string, type string, "
    "record_id string, refers_to string, target_uri string, date string, payload_bytes long, payload_digest string"
)


# ---- writing


def _id(key: Column) -> Column:
    return F.concat(F.lit("<urn:row:"), F.coalesce(key.cast("string"), F.lit("")), F.lit(">"))


def key_of(record_id: str, kind: str = "long") -> Column:
    """The key in a record id of this writer; null if it has none."""
    return F.nullif(F.regexp_extract(record_id, "^<urn:row:(.*)>$", 1), F.lit("")).try_cast(kind)


def _with_first(rows: DataFrame, min_revisit: int) -> DataFrame:
    """``rows`` with the least key of those with an equal payload; null where no two are equal."""
    long = F.col("n") >= min_revisit
    first = (
        rows.where(long)
        .groupBy("digest")
        .agg(F.min("key").alias("first"), F.count("*").alias("rows"))
        .where("rows > 1")
        .select(F.col("digest").alias("of"), "first")
    )
    first = stored(first, "first-keys")  # so that both sides are dealt out anew, and large groups can be split
    # short payloads, which may all be equal, have nothing to meet
    alone = F.concat(F.lit("-"), F.xxhash64("key", "url").cast("string"))
    return rows.join(first, F.when(long, F.col("digest")).otherwise(alone) == F.col("of"), "left")


def records_of(
    df: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", date: str = "1970-01-01T00:00:00Z", min_revisit: int = 100
) -> DataFrame:
    """One column ``record``: the whole WARC record of each row, without the blank lines after it."""
    text = F.coalesce(F.col(payload).cast("string"), F.lit(""))
    rows = df.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"), text.alias("payload"))
    rows = rows.withColumn("n", F.octet_length("payload")).withColumn("digest", F.sha2("payload", 256))
    rows = _with_first(rows, min_revisit)
    again = F.coalesce(~F.col("first").eqNullSafe(F.col("key")) & F.col("first").isNotNull(), F.lit(False))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    place = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"),
        line("Content-Length", F.col("n").cast("string")),
        F.lit("\r\n"),
    )
    body = F.when(again, F.lit("")).otherwise(F.col("payload"))
    rows = rows.select("*", again.alias("again"), http.alias("http"), body.alias("body"))
    record = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(F.col("again"), F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", _id(F.col("key"))),
        line("WARC-Date", F.lit(date)),
        F.coalesce(line("WARC-Target-URI", place), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(
            F.col("again"),
            F.concat(line("WARC-Profile", F.lit(SAME_PAYLOAD)), line("WARC-Refers-To", _id(F.col("first")))),
        ).otherwise(F.lit("")),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        line("Content-Length", (F.octet_length("http") + F.octet_length("body")).cast("string")),
        F.lit("\r\n"),
        F.col("http"),
        F.col("body"),
    )
    return rows.select(record.alias("record"))


def members(record: bytes, most: int = MEMBER_BYTES) -> bytes:
    """A whole record (with the blank lines after it) as gzip members; none but the first begins like a version line."""
    out, at = [], 0
    while at < len(record):
        end = min(at + most, len(record))
        while end < len(record) and record.startswith(b"WARC/", end):
            end -= 1
        out.append(_packed(record[at:end]))
        at = end
    return b"".join(out)


def _packed(piece: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(piece) + packer.flush()


def write(df: DataFrame, path: str, packed: bool = True, blob_bytes: int = BLOB_BYTES, **columns) -> None:
    """Write the rows of ``df`` as archives to the folder ``path``; ``columns`` as for ``records_of``."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0
        for batch in batches:
            for record in batch.column(0):
                whole = record.as_py().encode("utf-8", "surrogatepass") + END
                held.append(members(whole) if packed else whole)
                total += len(held[-1])
                if total >= blob_bytes:
                    yield blob(held)
                    held, total = [], 0
        if held:
            yield blob(held)

    end = b"\0" if packed else END

    def blob(held: list[bytes]) -> pa.RecordBatch:
        whole = b"".join(held)
        return pa.RecordBatch.from_arrays([pa.array([whole[: -len(end)]], pa.binary())], ["blob"])

    blobs = records_of(df, **columns).mapInArrow(pack, "blob binary")
    out = blobs.select(F.col("blob").cast("string").alias("value")).write
    out.option("lineSep", end.decode()).option("maxRecordsPerFile", FILE_BLOBS).text(path)


# ---- reading


class Damaged(Exception):
    """A failed check. ``resume``: where to look on, if the record's bounds can be trusted."""

    def __init__(self, reason: str, resume: int = 0):
        super().__init__(reason)
        self.reason, self.resume = reason, resume


class CutShort(Damaged):
    """What is there so far is right, but it ends too early."""


@dataclass
class Record:
    start: int
    end: int
    fields: dict[str, str]
    block: memoryview


@dataclass
class Gap:
    """Bytes of the file that belong to no valid record; ``inner``: the unpacked bytes meant, where members are valid."""

    start: int
    end: int
    reason: str
    inner: tuple[int, int] | None = None


def _fields(data, at: int) -> tuple[dict[str, str], int]:
    """The named fields after the version line at ``at``, by lower-case name, and where the block begins."""
    first = VERSION.match(data, at)
    if not first:
        rest = bytes(data[at : at + 16])
        part = len(rest) < 12 and (rest.startswith(b"WARC/") or b"WARC/".startswith(rest))
        raise (CutShort if part else Damaged)("no version line")
    stop = data.find(END, at, at + HEAD_BYTES)
    if stop < 0:
        raise (CutShort if len(data) < at + HEAD_BYTES else Damaged)("fields without end")
    fields: dict[str, str] = {}
    name = None
    for line in bytes(data[first.end() : stop]).decode("utf-8", "replace").split("\r\n"):
        if line[:1] in (" ", "\t") and name:
            fields[name] += " " + line.strip()
            continue
        name, colon, value = line.partition(":")
        name = name.strip().lower()
        if not colon or not name:
            raise Damaged("bad field")
        fields[name] = value.strip()
    if not all(fields.get(x) for x in ("warc-type", "warc-record-id")) or not re.fullmatch(
        r"[0-9]{1,18}", fields.get("content-length", "")
    ):
        raise Damaged("missing field")
    return fields, stop + len(END)


def payload_at(fields: dict[str, str], block) -> int:
    """Where in the block the payload begins: after the HTTP head, if it has one."""
    if fields.get("content-type", "").lower().startswith("application/http"):
        head = bytes(block[:HEAD_BYTES]).find(END)
        return head + len(END) if head >= 0 else len(block)
    return 0


def http_field(block, name: str) -> str | None:
    head = bytes(block[: payload_at({"content-type": "application/http"}, block)])
    found = re.search(rb"(?im)^" + re.escape(name.encode()) + rb":[ \t]*([^\r\n]*)", head)
    return found[1].decode("latin-1").strip() if found else None


def _agrees(declared: str | None, content) -> bool:
    """Whether a declared digest (algorithm:value in base 16 or 32) is that of the content; unknown ones aren't checked."""
    algorithm, _, value = (declared or "").partition(":")
    algorithm = algorithm.lower().replace("-", "")
    if algorithm not in ("md5", "sha1", "sha256", "sha512") or not value:
        return True
    digest = hashlib.new(algorithm, content).digest()
    return value.lower() == digest.hex() or value.upper().rstrip("=") == base64.b32encode(digest).decode().rstrip("=")


def _record(data, at: int) -> Record:
    """The record whose version line is at ``at``, with all checks done."""
    fields, begin = _fields(data, at)
    stop = begin + int(fields["content-length"])
    if stop + len(END) > len(data):
        raise CutShort("cut short")
    if data[stop : stop + len(END)] != END:
        raise Damaged("wrong length")
    end = stop + len(END)
    # the next record begins where this one ends, so its bounds are right even if its content isn't
    resume = end if end == len(data) or VERSION.match(data, end) else 0
    with memoryview(data) as whole:
        block = bytes(whole[begin:stop])
    if not _agrees(fields.get("warc-block-digest"), block):
        raise Damaged("wrong block digest", resume)
    if fields["warc-type"] != "revisit" and "warc-truncated" not in fields:
        payload = memoryview(block)[payload_at(fields, block) :]
        declared = fields.get("warc-payload-digest")
        if not _agrees(declared, payload) and "chunked" not in (http_field(block, "Transfer-Encoding") or "").lower():
            raise Damaged("wrong payload digest", resume)
    return Record(at, end, fields, memoryview(block))


def _member(data: bytes, at: int) -> tuple[int, bytes]:
    """The end and the unpacked content of the gzip member at ``at``; its checksum is right."""
    unpacker, out, fed, size = zlib.decompressobj(31), [], at, 1 << 12
    try:
        while not unpacker.eof:
            if fed >= len(data):
                raise Damaged("member cut short")
            out.append(unpacker.decompress(data[fed : fed + size]))
            fed, size = fed + size, min(2 * size, 1 << 20)
    except zlib.error:
        raise Damaged("bad member") from None
    return min(fed, len(data)) - len(unpacker.unused_data), b"".join(out)


def _next_line(data, at: int) -> int:
    found = VERSION.search(data, at)
    return found.start() if found else len(data)


def _starts_record(content) -> bool:
    try:
        return bool(_fields(content, 0))
    except Damaged:
        return False


class Salvage:
    """The records and gaps of one file, in order; ``at`` is where it stands."""

    def __init__(self, data: bytes):
        self.data, self.at, self._magic = data, 0, -1

    def __iter__(self) -> Iterator[Record | Gap]:
        data, gap = self.data, None
        while self.at < len(data):
            start = self.at
            try:
                found = self._members() if data.startswith(MAGIC, start) else iter((self._line(),))
                first = next(found)
            except Damaged as e:
                gap = gap or (start, e.reason)
                self.at = self._candidate(max(start + 1, e.resume))
                continue
            if gap:
                yield Gap(gap[0], start, gap[1])
                gap = None
            yield first
            yield from found
        if gap:
            yield Gap(gap[0], len(data), gap[1])

    def _candidate(self, at: int) -> int:
        """Where the next member or version line may begin."""
        if self._magic < at:
            found = self.data.find(MAGIC, at)
            self._magic = found if found >= 0 else len(self.data)
        line = VERSION.search(self.data, at, self._magic)
        return line.start() if line else self._magic

    def _line(self) -> Record:
        record = _record(self.data, self.at)
        self.at = record.end
        return record

    def _members(self) -> Iterator[Record | Gap]:
        """What the members from ``at`` on hold, until one ends where a record does, or a record can't be finished.

        Places in the yielded records are the file's: of the members that hold the record.
        """
        end, content = _member(self.data, self.at)
        if _next_line(content, 0) == len(content):
            raise Damaged("member without version line")
        self._held = [(0, self.at, end)]  # place in the unpacked bytes, and the member's place in the file
        unpacked, at = bytearray(content), 0
        while at < len(unpacked):
            try:
                record = _record(unpacked, at)
            except CutShort as e:
                more = self._more(end)
                if more:
                    del unpacked[:at]
                    held = [(p - at, s, e) for p, s, e in self._held] + [(len(unpacked), end, more[0])]
                    while held[1][0] <= 0:
                        del held[0]
                    self._held = held
                    end, at = more[0], 0
                    unpacked += more[1]
                    continue
                after = _next_line(unpacked, at + 1)
                yield self._gap(at, after, e.reason)
                at = after
            except Damaged as e:
                after = e.resume or _next_line(unpacked, at + 1)
                yield self._gap(at, after, e.reason)
                at = after
            else:
                at = record.end
                first, last, _ = self._span(record.start, record.end)
                yield Record(first, last, record.fields, record.block)
        self.at = end

    def _more(self, at: int) -> tuple[int, bytes] | None:
        """The member at ``at``, if it goes on with a record, which one that begins a record itself doesn't."""
        try:
            found = _member(self.data, at) if self.data.startswith(MAGIC, at) else None
        except Damaged:
            return None
        return None if found and _starts_record(found[1]) else found

    def _span(self, start: int, end: int) -> tuple[int, int, int]:
        """The file's bytes that hold these unpacked ones, and where the first member's content begins."""
        places = [p for p, _, _ in self._held]
        first, last = bisect_right(places, start) - 1, bisect_left(places, end) - 1
        return self._held[first][1], self._held[last][2], places[first]

    def _gap(self, start: int, end: int, reason: str) -> Gap:
        first, last, begin = self._span(start, end)
        return Gap(first, last, reason, (start - begin, end - begin))


def _row(file: str, x: Record | Gap, with_payload: bool) -> tuple:
    more = (None,) * with_payload
    if isinstance(x, Gap):
        return ("gap", file, x.start, x.end, *(x.inner or (None, None)), x.reason, *[None] * 7, *more)
    f, begin = x.fields, payload_at(x.fields, x.block)
    payload = x.block[begin:]
    size, digest = len(payload), None
    if f["warc-type"] == "revisit":  # its payload is the other record's
        length = http_field(x.block, "Content-Length") or ""
        size = int(length) if re.fullmatch("[0-9]{1,18}", length) else None
        algorithm, _, value = f.get("warc-payload-digest", "").partition(":")
        digest = value.lower() if algorithm.lower() == "sha256" and len(value) == 64 else None
    else:
        digest = hashlib.sha256(payload).hexdigest()
        more = (bytes(payload),) * with_payload
    names = ("warc-type", "warc-record-id", "warc-refers-to", "warc-target-uri", "warc-date")
    return ("record", file, x.start, x.end, None, None, None, *map(f.get, names), size, digest, *more)


def read(spark: SparkSession, path: str, with_payload: bool = True, pattern: str = "*") -> DataFrame:
    """Records and gaps of all archives at ``path``, packed or not, as rows of SCHEMA, with ``payload`` if wanted."""
    schema = SCHEMA + ", payload binary" * with_payload
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    types = [kinds[x.split()[1]] for x in schema.split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0), batch.column(1)):
                held, total = [], 0
                for x in Salvage(content.as_py()):
                    held.append(_row(file.as_py(), x, with_payload))
                    total += 256 + (len(x.block) if with_payload and isinstance(x, Record) else 0)
                    if total >= 4 << 20:
                        yield batch_of(held)
                        held, total = [], 0
                if held:
                    yield batch_of(held)

    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return files.select("path", "content").mapInArrow(unpack, schema)


def records(read_rows: DataFrame) -> DataFrame:
    """The valid records."""
    return read_rows.where("kind = 'record'").drop("kind", "inner_start", "inner_end", "reason")


def quarantined(read_rows: DataFrame) -> DataFrame:
    """The log of gaps: bytes ``start`` to ``end`` of the file, and of what they unpack to, where that could be read."""
    return read_rows.where("kind = 'gap'").select("file", "start", "end", "inner_start", "inner_end", "reason")
