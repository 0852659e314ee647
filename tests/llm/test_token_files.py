import json
import random
import zlib
from pathlib import Path

import numpy as np
import pytest

from schoolzones.llm import range_coder, token_files
from schoolzones.llm.range_coder import decode, encode

public_tokenizers = pytest.importorskip("public_tokenizers")


def path():
    return public_tokenizers.path("byte_bpe_50k.json")


def brute(ids, texts, end_id=2):
    from tokenizers import Tokenizer

    encoder = Tokenizer.from_file(path())
    out, at = [], 0
    for key, text in sorted(zip(ids, texts), key=lambda x: (x[0] is not None, x[0], x[1] is not None, x[1])):
        found = [*encoder.encode(text or "", add_special_tokens=False).ids, end_id]
        raw = b"".join(x.to_bytes(4, "little") for x in found)
        out.append((key, at, len(found), zlib.crc32(raw), found))
        at += len(found)
    return out


@pytest.mark.parametrize("n", [0, 1, 2, 511, 512, 513, 1024, 1025, 40_001])
@pytest.mark.parametrize("kind", ["even", "skewed", "constant", "cycle", "largest"])
def test_coder_round_trip(n, kind):
    rnd, v = np.random.default_rng(n), 50_257
    ids = {
        "even": rnd.integers(0, v, n),
        "skewed": np.minimum((rnd.pareto(1.0, n) * 5).astype(np.int64), v - 1),
        "constant": np.full(n, 7),
        "cycle": np.arange(n) % 13,
        "largest": np.full(n, v - 1) - rnd.integers(0, 2, n),
    }[kind]
    words = encode(ids, v)
    assert words.dtype == np.uint16
    assert (decode(words, n, v) == ids).all()
    if n > 40_000 and kind in ("constant", "cycle"):  # the predictors learn
        assert len(words) * 16 < n


def test_small_vocabulary():
    ids = np.random.default_rng(1).integers(0, 3, 5000)
    assert (decode(encode(ids, 3), 5000, 3) == ids).all()


def test_counts_are_halved(monkeypatch):
    monkeypatch.setattr(range_coder, "_MOST_COUNTED", 5000)
    ids = np.minimum((np.random.default_rng(2).pareto(1.0, 60_000) * 5).astype(np.int64), 299)
    assert (decode(encode(ids, 300), len(ids), 300) == ids).all()


def test_carries_go_on():
    # Ids at the end of the vocabulary keep the coders near the top, where carries run over several words.
    ids = np.full(300_000, 49)
    ids[np.random.default_rng(5).integers(0, len(ids), 3000)] = 3
    assert (decode(encode(ids, 50), len(ids), 50) == ids).all()


@pytest.mark.parametrize("part_bytes,block_ids", [(1 << 20, 1 << 20), (3000, 700)])
def test_files_equal_the_tokenizer(spark, documents, texts, part_bytes, block_ids, tmp_path):
    values = texts(60) + ["<|endoftext|> # \u0000 \U0001f600", None, "", "#"]
    ids = [(i * 31) % 997 for i in range(len(values) - 4)] + [None, None, 5000, 5000]
    values, ids = values + [values[4], values[4], values[7]], ids + [6000] * 3  # repeated rows
    folder = str(tmp_path / "files")
    token_files.write(documents(values, ids), folder, path(), part_bytes=part_bytes, block_ids=block_ids)
    got = token_files.read(spark, folder, with_ids=True)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32", "ids"]
    rows = sorted(map(tuple, got.collect()), key=lambda r: r[1])
    assert rows == brute(ids, values)
    plain = token_files.read(spark, folder).collect()
    assert sorted(map(tuple, plain), key=lambda r: r[1]) == [r[:4] for r in rows]


def whole(texts, spec=None):
    from tokenizers import Tokenizer

    encoder = Tokenizer.from_str(spec) if spec else Tokenizer.from_file(path())
    return [encoder.encode(t, add_special_tokens=False).ids for t in texts]


def test_pieces_have_the_ids_of_the_whole_text(monkeypatch):
    rnd = random.Random(3)
    some = [*"   \n\t\x1c\x85\u00a0\u2028\u3000\u200ba7#\u00e9\u4e2d'", "b's", " don't", "<|endoftext|>", "\U0001f600"]
    values = ["", " ", "a  b", "a \n b ", *["".join(rnd.choices(some, k=rnd.randint(0, 14))) for _ in range(20_000)]]
    encoder = token_files.Encoder(Path(path()).read_text())
    assert encoder.cut
    assert [x.tolist() for x in encoder.encode(values)] == whole(values)
    assert encoder.encode([]) == []
    monkeypatch.setattr(token_files, "KEPT", 50)  # pieces are forgotten again and again
    got = [x.tolist() for at in range(0, 2000, 100) for x in encoder.encode(values[at : at + 100])]
    assert got == whole(values[:2000])


def test_the_tokenizer_meets_equal_pieces_once():
    encoder, met = token_files.Encoder(Path(path()).read_text()), []
    lists = encoder._lists
    encoder._lists = lambda texts: met.extend(texts) or lists(texts)
    values = ["one word after one word", "word after word " * 500, "one"]
    for _ in range(3):
        assert [x.tolist() for x in encoder.encode(values)] == whole(values)
    assert len(met) == len(set(met)) <= 8


def test_marks_digits_and_lines_are_cut_off():
    encoder, met = token_files.Encoder(Path(path()).read_text()), []
    lists = encoder._lists
    encoder._lists = lambda texts: met.extend(texts) or lists(texts)
    values = ["a word, a word; (word)\nword.\nword 5 word5 word### word", "word\n", "word's"]
    assert [x.tolist() for x in encoder.encode(values)] == whole(values)
    pieces = [p for text in met for p in text.removesuffix("\n").split("\n")]
    assert pieces.count(" word") == pieces.count("word") == 1
    assert not {" word,", " word;", " word###", "word)\nword.\nword"} & {*met, *pieces}


def test_cuts_change_no_id():
    rnd = random.Random(7)
    some = [
        *"abZ09.,!#_'|<>  \n\n\t\r\v\f", "'s", "'ll", "<|endoftext|>", "<|", "endoftext", "\x00", "\x1c", "\x7f", "\x85",
        *"\u00a0\u00d7\u00f7\u00df\u00e9\u00c0\u0101\u024f\u0250\u0301\u0660\u1680\u180e\u2003\u2014\u2028\u202f\u3000\u4e2d\u00b2\u0e01\U0001f600\U00010400",
    ]
    values = ["".join(rnd.choices(some, k=rnd.randint(0, 12))) for _ in range(30_000)]
    encoder = token_files.Encoder(Path(path()).read_text())
    assert [x.tolist() for x in encoder.encode(values)] == whole(values)


def test_what_comes_again_is_kept(monkeypatch):
    monkeypatch.setattr(token_files, "KEPT", 4)
    encoder = token_files.Encoder(Path(path()).read_text())
    for values in (["one two"], ["one three four five"], ["one six"], ["one two six"], [" ", "", "x" * 500]):
        assert [x.tolist() for x in encoder.encode(values)] == whole(values)
    assert "one" in encoder.known.to_pylist() and " three" not in encoder.known.to_pylist()
    monkeypatch.setattr(token_files, "KEPT_BYTES", 8)
    for values in (["one two"], ["one two three"], ["one", "two"]):
        assert [x.tolist() for x in encoder.encode(values)] == whole(values)
    spec = Path(path()).read_text()
    assert token_files._encoder(spec) is token_files._encoder(spec)  # for all tasks of a worker


@pytest.mark.parametrize(
    "change",
    [
        {"normalizer": {"type": "Lowercase"}},
        {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True, "trim_offsets": True, "use_regex": True}},
        {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}},
        {"truncation": {"direction": "Right", "max_length": 3, "strategy": "LongestFirst", "stride": 0}},
    ],
)
def test_other_tokenizers_get_whole_texts(change):
    spec = json.dumps(json.loads(Path(path()).read_text()) | change)
    values = ["One word after one WORD", "", " the end of the text"]
    encoder = token_files.Encoder(spec)
    assert not encoder.cut
    assert [x.tolist() for x in encoder.encode(values)] == whole(values, spec)


def test_damage_is_an_error(spark, documents, tmp_path):
    folder = str(tmp_path / "files")
    token_files.write(documents(["some words here"]), folder, path())
    (content,) = [r["content"] for r in spark.read.format("binaryFile").load(folder + "/part-*").collect()]
    assert [b[0] for b in token_files.blocks_in(bytes(content))] == [0]
    for at in (4, 30, len(content) - 3):
        bad = bytearray(content)
        bad[at] ^= 1
        with pytest.raises(ValueError, match="damaged"):
            list(token_files.blocks_in(bytes(bad)))


def test_empty_table(documents):
    out = token_files.encoded(documents(["x"]).limit(0), path())
    assert out.count() == 0
