"""The pipeline against plain Python, stage by stage, and the registration of the queries."""

import os
from collections import Counter

import pytest
from test_decontaminate import brute as leaks
from test_quality_rules import brute as quality
from test_simhash_dedup import brute as near_copies
from test_token_files import brute as token_rows

import __spark_entry__ as driver
import corpus_pipeline
from schoolzones.llm import mixing, queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


def test_every_stage_equals_plain_python(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r["doc_id"]: r for r in docs.collect()}
        copies = Counter(r["doc_id"] for r in docs.collect())
        path = f"{tmp_path}/{k}"
        stage(spark, docs, FOLDER).write.parquet(path)
        docs = spark.read.parquet(path)
        rows = docs.collect()
        if name == "token-ID / binary output":
            expanded = [i for i, n in copies.items() for _ in range(n)]
            want = token_rows(expanded, [before[i]["text"] for i in expanded])
            assert sorted(map(tuple, rows), key=lambda r: r[1]) == [w[:4] for w in want]
            break
        assert docs.columns == columns
        assert all(r == before[r["doc_id"]] for r in rows)
        got = Counter(r["doc_id"] for r in rows)
        if name == "quality rules":
            want = {i for i, r in before.items() if quality(r["text"])[6]}
        elif name == "SimHash near-dedup":
            ids = sorted(before)
            want = {c for _, _, c in near_copies(ids, [before[i]["text"] for i in ids])}
        elif name == "benchmark decontamination":
            want = set(before) - {d for d, _ in leaks([(i, r["text"]) for i, r in before.items()], items)}
        else:
            passes = Counter(r["doc_id"] for r in mixing.mix(spark.createDataFrame(list(before.values()))).collect())
            assert got == passes and set(got) == set(before) and max(got.values()) == 2
            continue
        assert got == Counter(want)
        assert k != 0 or 0 < len(want) < len(before)


def test_run_is_all_stages(spark):
    out = corpus_pipeline.run(spark, FOLDER)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    rows = sorted(out.collect(), key=lambda r: r["start"])
    assert rows[0]["start"] == 0
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(rows, rows[1:]))


def test_registered(spark):
    names = [n for n in driver.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert {"pipeline", *queries.QUERIES} <= set(driver.queries())
    assert set(queries.ORACLE) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_check(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "conversations", "benchmark", "pages", "labels"):
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    result = con.execute(queries.ORACLE[name])
    names = [c[0] for c in result.description]
    df = queries.QUERIES[name](spark, FOLDER)
    assert sorted(df.columns) == sorted(names)
    got = sorted(map(str, map(tuple, df.select(*names).collect())))
    assert got == sorted(map(str, result.fetchall()))
