import base64
import gzip
import hashlib
import random
import re
from pathlib import Path

import pytest

from schoolzones.llm import warc
from schoolzones.llm.warc import Gap, Record, Salvage

SCHEMA = "page_id long, url string, html string, n int, digest string, first string, key string, payload int, kind string"
LONG = "<p>the same long text, more than a hundred bytes of it, so that it is stored once and revisited after that é</p>"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "d", "f", "k", 2, "x") for r in rows], SCHEMA)


def brute(rows):
    """(key, bytes, digest, type, refers_to) per row."""
    raw = [(k, (h or "").encode()) for k, _, h in rows]
    least = {}
    for k, p in raw:
        if k is not None:
            least[p] = min(least.get(p, k), k)
    out = []
    for k, p in raw:
        again = len(p) >= 100 and p in least and least[p] != k and sum(q == p for _, q in raw) > 1
        digest = hashlib.sha256(p).hexdigest()
        out.append((k, len(p), digest, "revisit" if again else "response", least[p] if again else None))
    return sorted(out, key=str)


def listed(df):
    read = df.select(
        warc.key_of("record_id").alias("k"), "payload_bytes", "payload_digest", "type", warc.key_of("refers_to").alias("r")
    )
    return sorted(map(tuple, read.collect()), key=str)


ROWS = [
    (5, "http://a/5", LONG),
    (3, "http://a/3", LONG),
    (9, None, LONG),
    (None, "http://a/null", LONG),
    (3, "http://a/3", LONG),
    (1, "http://a/1\r\nWARC-Type: x", None),
    (2, "", ""),
    (4, "u", "short"),
    (6, "u", "short"),
    (7, "u", "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 1\r\n\r\nx\r\n\r\n\x1f\x00 é\U0001f600\r\n\r\n" + "y" * 100),
    (None, None, None),
    (None, "only", "z" * 200),
    (None, "only too", "z" * 200),
    *((100 + i, f"http://b/{i}", f"<html>{i % 40} " + "text of a page " * (i % 40) + "</html>") for i in range(120)),
]


@pytest.mark.parametrize("packed", [True, False])
@pytest.mark.parametrize("blob_bytes", [1 << 9, 1 << 23])
def test_round_trip(spark, tmp_path, packed, blob_bytes):
    path = f"{tmp_path}/w"
    warc.write(table(spark, ROWS), path, packed, blob_bytes)
    read = warc.read(spark, path, pattern="part-*")
    assert listed(warc.records(read)) == brute(ROWS)
    assert warc.quarantined(read).count() == 0
    texts = {r["record_id"]: bytes(r["payload"]).decode() for r in read.where("type = 'response'").collect()}
    for k, _, h in ROWS:
        if k is not None and f"<urn:row:{k}>" in texts:
            assert texts[f"<urn:row:{k}>"] == (h or "")
    for file in Path(path).glob("part-*"):
        raw = file.read_bytes()
        whole = gzip.decompress(raw) if packed else raw  # a common reader takes the file as it is
        assert whole.startswith(b"WARC/1.1\r\n") and whole.endswith(warc.END)


def test_empty_table(spark, tmp_path):
    warc.write(table(spark, ROWS).limit(0), f"{tmp_path}/w")
    assert warc.read(spark, f"{tmp_path}/w").count() == 0


def a_record(i, payload, digest="sha256", head=b"HTTP/1.1 200 OK\r\nX: y\r\n\r\n"):
    raw = hashlib.new(digest, payload).digest()
    value = base64.b32encode(raw).decode() if digest == "sha1" else raw.hex()
    block = head + payload
    fields = [
        "WARC/1.0", "WARC-Type: response", f"WARC-Record-ID: <urn:row:{i}>", f"WARC-Payload-Digest: {digest}:{value}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", "",
    ]
    return "\r\n".join(fields).encode() + block + warc.END


def payloads(n, seed):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        text = bytes(rnd.choices(b"abcdef <>\r\n\x00\x1f\x8b\x08", k=rnd.randint(0, 400))) + b"%d" % i
        out.append(text + rnd.choice([b"", b"\r\n\r\nWARC/1.0\r\n", b"WARC/1.1\r\nWARC-Type: q\r\n\r\n", gzip.compress(text, mtime=0)]))
    return out


def found(data):
    """What the reader yields, after a check that places are in order and every byte is in a record or gap."""
    items, at = list(Salvage(bytes(data))), 0
    for x in items:
        assert x.start <= at and x.end > x.start and x.end >= at
        at = x.end
    assert at == len(data)
    return items


def ids(items):
    return [i for i, _ in pairs(items)]


def pairs(items):
    """(number, payload) of each record; -1 where damage hit the id, which nothing checks."""
    out = []
    for x in items:
        if isinstance(x, Record):
            number = re.fullmatch("<urn:row:([0-9]+)>", x.fields["warc-record-id"])
            out.append((int(number[1]) if number else -1, bytes(x.block[warc.payload_at(x.fields, x.block) :])))
    return out


def archive(kind, contents):
    """The bytes, and where each record's bytes begin."""
    records = [a_record(i, p, ("sha256", "sha1", "md5")[i % 3]) for i, p in enumerate(contents)]
    if kind == "plain":
        parts = records
    elif kind == "members":
        parts = [gzip.compress(r, mtime=0) for r in records]
    elif kind == "pieces":
        parts = [warc.members(r, 100) for r in records]
    else:  # mixed
        parts = [r if i % 3 else gzip.compress(r, mtime=0) for i, r in enumerate(records)]
    starts = [0]
    for p in parts:
        starts.append(starts[-1] + len(p))
    return b"".join(parts), starts


@pytest.mark.parametrize("kind", ["plain", "members", "pieces", "mixed"])
def test_undamaged(kind):
    contents = payloads(60, 1)
    items = found(archive(kind, contents)[0])
    assert ids(items) == list(range(60)) and len(items) == 60
    assert [p for _, p in pairs(items)] == contents


@pytest.mark.parametrize("kind", ["plain", "members", "pieces", "mixed"])
@pytest.mark.parametrize("seed", range(25))
def test_untouched_records_survive_damage(kind, seed):
    rnd = random.Random(seed)
    contents = payloads(30, seed)
    data, starts = archive(kind, contents)
    touched, out, at = set(), bytearray(), 0
    for place in sorted(rnd.sample(range(len(data)), rnd.randint(1, 4))):
        if place < at:
            continue
        out += data[at:place]
        size = rnd.choice([1, 1, 30, 700])
        how = rnd.choice(["flip", "cut", "put", "zero"])
        end = place if how == "put" else min(place + size, len(data))
        if how == "flip":
            out += bytes(b ^ (1 << rnd.randrange(8)) for b in data[place:end])
        elif how == "put":
            out += rnd.randbytes(size)
        elif how == "zero":
            out += bytes(end - place)
        touched |= {i for i in range(30) if starts[i] < max(end, place + 1) and starts[i + 1] > place}
        at = end
    out += data[at:]
    items = found(out)
    untouched = [(i, contents[i]) for i in range(30) if i not in touched]
    assert [x for x in pairs(items) if x in untouched] == untouched


def test_one_member_with_many_records_and_a_bad_one():
    records = [a_record(i, b"text %d" % i) for i in range(5)]
    records[2] = records[2].replace(b"text 2", b"TEXT 2")
    records[3] = records[3].replace(b"Content-Length: ", b"Content-Length: 9")
    items = found(gzip.compress(b"".join(records)))
    assert ids(items) == [0, 1, 4]
    gaps = [x for x in items if isinstance(x, Gap)]
    size = [len(r) for r in records]
    assert [g.inner for g in gaps] == [(sum(size[:2]), sum(size[:3])), (sum(size[:3]), sum(size[:4]))]
    assert gaps[0].reason == "wrong payload digest"


def test_records_that_members_cut_anywhere():
    records = [a_record(i, b"text %d " % i * 50) for i in range(20)]
    whole = b"".join(records)
    parts = [gzip.compress(whole[i : i + 333]) for i in range(0, len(whole), 333)]
    assert ids(found(b"".join(parts))) == list(range(20))
    parts[7] = parts[7][:-3] + b"???"
    got = ids(found(b"".join(parts)))
    hit = {i for i in range(20) if sum(map(len, records[:i])) < 8 * 333 and sum(map(len, records[: i + 1])) > 7 * 333}
    assert set(range(20)) - hit <= set(got)


def test_lying_length_hides_nothing():
    records = [a_record(i, b"x" * 50) for i in range(4)]
    records[1] = records[1].replace(b"Content-Length: ", b"Content-Length: 99")
    for data in (b"".join(records), b"".join(map(gzip.compress, records))):
        assert ids(found(data)) == [0, 2, 3]


def test_no_archive_at_all():
    for data in (b"", b"WARC", b"\x1f\x8b\x08", b"nothing" * 1000, gzip.compress(b"no record"), bytes(5000)):
        items = found(data)
        assert not ids(items) and len(items) == (1 if data else 0)


def test_damaged_file_in_a_folder(spark, tmp_path):
    path = tmp_path / "w"
    rows = [(i, f"http://b/{i}", f"<html>{i} " + "text of a page " * i + "</html>") for i in range(200)]
    warc.write(table(spark, rows).coalesce(1), str(path))
    (file,) = path.glob("part-*")
    raw = bytearray(file.read_bytes())
    places = {r["start"]: (r["end"], r["record_id"]) for r in warc.records(warc.read(spark, str(path), False, "part-*")).collect()}
    starts = sorted(places)
    hit = starts[70]
    raw[hit + 40 : hit + 60] = b"\xff" * 20
    del raw[starts[150] + 5 :]
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "x.warc.gz").write_bytes(raw)
    read = warc.read(spark, f"{tmp_path}/d", False)
    assert {r["record_id"] for r in warc.records(read).collect()} == {places[s][1] for s in starts[:150] if s != hit}
    log = sorted((r["start"], r["end"]) for r in warc.quarantined(read).collect())
    assert log == [(hit, places[hit][0]), (starts[150], len(raw))]
