import os
import threading

import pytest

from schoolzones.session import scratch_path
from schoolzones.sources import versions


@pytest.fixture
def path(spark):
    return scratch_path(spark, "versioned")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def table(spark, *pairs):
    return spark.createDataFrame(pairs, "k long, v string")


def test_versions_stay_as_they_were(spark, path):
    versions.create(table(spark, (1, "a"), (2, "b")), path)
    first = versions.read(spark, path)
    versions.replace(spark.range(3), path)
    versions.replace(versions.read(spark, path).where("id > 0"), path)  # reads what it replaces
    assert rows(first) == [(1, "a"), (2, "b")] and rows(versions.read(spark, path)) == [(1,), (2,)]
    assert rows(versions.read(spark, path, 1)) == [(0,), (1,), (2,)]
    assert versions.versions(spark, path) == [0, 1, 2]
    with pytest.raises(FileExistsError):
        versions.create(spark.range(3), path)
    with pytest.raises(versions.NoSuchVersion):
        versions.read(spark, path, 7)


def test_no_table(spark, path):
    with pytest.raises(versions.NoSuchVersion):
        versions.read(spark, path)
    with pytest.raises(versions.NoSuchVersion):
        versions.update(table(spark, (1, "x")), path, "k")
    assert versions.versions(spark, path) == []


@pytest.mark.parametrize("write", ["replace", "insert", "update"])
def test_a_job_that_ends_before_its_manifest_changes_nothing(spark, path, monkeypatch, write):
    versions.create(table(spark, (1, "a")), path)

    def ended(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m, pytest.raises(KeyboardInterrupt):
        m.setattr(versions, "_put_once", ended)
        new = table(spark, (1, "new"), (5, "new"))
        {"replace": lambda: versions.replace(new, path), "insert": lambda: versions.insert_absent(new, path, "k"),
         "update": lambda: versions.update(new, path, "k")}[write]()
    assert rows(versions.read(spark, path)) == [(1, "a")] and versions.versions(spark, path) == [0]
    assert versions.remove_unused(spark, path) == []  # too young: its manifest may still come
    assert len(versions.remove_unused(spark, path, older_than_hours=0)) == 1
    assert rows(versions.read(spark, path)) == [(1, "a")]


def test_insert_absent(spark, path):
    versions.insert_absent(table(spark, (1, "z"), (1, "a"), (None, "n")), path, "k")
    versions.insert_absent(table(spark, (1, "other"), (2, "b"), (None, "m")), path, "k")
    assert rows(versions.read(spark, path)) == [(1, "a"), (2, "b"), (None, "n")]
    before = versions.version(spark, path)
    assert versions.insert_absent(table(spark, (2, "c")), path, "k") == before  # nothing new, no version
    assert len(before.folders) == 2
    with pytest.raises(ValueError):
        versions.insert_absent(spark.range(2).withColumnRenamed("id", "k"), path, "k")


def test_update(spark, path):
    versions.create(table(spark, (1, "a"), (2, "b"), (3, "c")), path)
    metrics = spark.createDataFrame([(1, None, 0.5), (2, "x", 1.5), (9, "y", 2.5)], "k long, v string, share double")
    versions.update(metrics, path, "k")
    assert rows(versions.read(spark, path)) == [(1, None, 0.5), (2, "x", 1.5), (3, "c", None)]
    assert versions.read(spark, path, 0).columns == ["k", "v"]


def race(monkeypatch, *jobs):
    """Run the jobs in threads; all have read the first version before one puts its manifest."""
    meet, put, once = threading.Barrier(len(jobs)), versions._put_once, threading.local()

    def late(*args):
        if not getattr(once, "met", False):
            once.met = True
            meet.wait(60)
        return put(*args)

    monkeypatch.setattr(versions, "_put_once", late)
    failed = []

    def run(job):
        try:
            job()
        except BaseException as e:
            failed.append(e)

    threads = [threading.Thread(target=run, args=(j,)) for j in jobs]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not failed


def test_writers_that_meet_lose_no_key(spark, path, monkeypatch):
    versions.create(table(spark, (0, "first")), path)
    jobs = [
        lambda i=i: versions.insert_absent(table(spark, *[(k, f"w{i}") for k in range(i * 3, i * 3 + 6)]), path, "k")
        for i in range(4)
    ]
    race(monkeypatch, *jobs)
    got = rows(versions.read(spark, path))
    assert sorted(k for k, _ in got) == list(range(15)) and (0, "first") in got
    assert 2 < len(versions.versions(spark, path)) <= 5


def test_insert_after_a_replacement_that_took_the_key_away(spark, path, monkeypatch):
    versions.create(table(spark, (1, "a"), (2, "b")), path)
    put, first = versions._put_once, []

    def beaten(*args):
        if not first:
            first.append(1)
            versions.replace(table(spark, (2, "b2")), path)
        return put(*args)

    monkeypatch.setattr(versions, "_put_once", beaten)
    versions.insert_absent(table(spark, (1, "mine"), (2, "no"), (3, "c")), path, "k")
    assert rows(versions.read(spark, path)) == [(1, "mine"), (2, "b2"), (3, "c")]


def test_update_and_insert_that_meet(spark, path, monkeypatch):
    versions.create(table(spark, (1, "a"), (2, "b")), path)
    race(
        monkeypatch,
        lambda: versions.update(table(spark, (1, "new")), path, "k"),
        lambda: versions.insert_absent(table(spark, (2, "no"), (3, "c")), path, "k"),
    )
    assert rows(versions.read(spark, path)) == [(1, "new"), (2, "b"), (3, "c")]


def test_given_up(spark, path, monkeypatch):
    versions.create(table(spark, (1, "a")), path)
    monkeypatch.setattr(versions, "_commit", lambda *_: False)
    with pytest.raises(versions.Conflict):
        versions.replace(table(spark, (2, "b")), path)


def test_old_versions_go(spark, path):
    for i in range(4):
        versions.replace(table(spark, (i, "x")), path)
    assert len(versions.remove_unused(spark, path, keep=2, older_than_hours=0)) == 2
    assert versions.versions(spark, path) == [2, 3] and rows(versions.read(spark, path, 2)) == [(2, "x")]


def test_a_manifest_is_put_once(spark, tmp_path):
    path = f"file://{tmp_path}/m.json"
    assert versions._put_once(spark, path, "one") and not versions._put_once(spark, path, "two")
    assert (tmp_path / "m.json").read_text() == "one" and not [x for x in os.listdir(tmp_path) if x.endswith("draft")]
    for name, want in (("a", True), ("b", False)):  # the way of other file systems
        versions._write_text(spark, f"{tmp_path}/{name}", name)
        assert versions._rename(spark, f"{tmp_path}/{name}", f"{tmp_path}/target") is want
    assert (tmp_path / "target").read_text() == "a"


def test_empty_table(spark, path):
    versions.create(table(spark, (1, "a")).limit(0), path)
    assert versions.read(spark, path).count() == 0
    versions.insert_absent(table(spark, (1, "b")), path, "k")
    assert rows(versions.read(spark, path)) == [(1, "b")]
