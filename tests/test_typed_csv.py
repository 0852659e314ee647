import datetime as dt

import pytest

from schoolzones.sources import typed_csv

LINES = """id,code,share,flag,day,at,text,empty,late
1,007,0.5,True,2024-01-31,2024-01-31 10:00:00,"a, b",,1
2,12,NA,false,2024-02-29,2024-02-01T00:00,c,,2
3,,1e3,TRUE,,,d""e,NaN,x3
4,5
5,6,.5,true,2023-12-01,2023-12-01,f,,4
6,-7,-1.,false,2024-02-30,nan,g,,5
7,8,9,true,2024-01-01,null,h,,6,one too many
"""


@pytest.fixture
def path(tmp_path):
    (tmp_path / "a.csv").write_text(LINES)
    return str(tmp_path / "a.csv")


def test_types_rows_and_quarantine(spark, path):
    found = typed_csv.scan(spark, path, tolerance=0.25)
    assert found.types == {
        "id": "long", "code": "long", "share": "double", "flag": "boolean", "day": "date", "at": "timestamp",
        "text": "string", "empty": "string", "late": "long",
    }
    rows = sorted(map(tuple, found.rows.collect()))
    assert rows == [
        (1, 7, 0.5, True, dt.date(2024, 1, 31), dt.datetime(2024, 1, 31, 10), "a, b", None, 1),
        (2, 12, None, False, dt.date(2024, 2, 29), dt.datetime(2024, 2, 1), "c", None, 2),
        (5, 6, 0.5, True, dt.date(2023, 12, 1), dt.datetime(2023, 12, 1), "f", None, 4),
    ]
    bad = sorted((r["reason"], r["column"], r["record"].split(",")[0]) for r in found.quarantined.collect() if r["column"])
    assert bad == [("value", "day", "6"), ("value", "late", "3")]
    broken = [r["record"] for r in found.quarantined.filter("reason = 'fields'").collect()]
    assert sorted(broken) == ["4,5", "7,8,9,true,2024-01-01,null,h,,6,one too many"]


def test_without_tolerance_the_type_gives_way(spark, path):
    found = typed_csv.scan(spark, path)
    assert (found.types["day"], found.types["late"], found.types["share"]) == ("string", "string", "double")
    assert found.rows.count() == 5 and found.quarantined.count() == 2


def test_profiles_add_up(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,v\n1,2\n3,4\n")
    (tmp_path / "b.csv").write_text("k,v,w\n1,2.5,true\nx,,false\n")
    raw = [typed_csv.read_text(spark, str(tmp_path / n)) for n in ("a.csv", "b.csv")]
    parts = [typed_csv.profile(r) for r in raw]
    assert typed_csv.types(parts[0]) == {"k": "long", "v": "long"}
    kinds = typed_csv.types(typed_csv.merged(parts))
    assert kinds == {"k": "string", "v": "double", "w": "boolean"}
    rows = typed_csv.typed(raw[0], kinds).rows.unionByName(typed_csv.typed(raw[1], kinds).rows)
    assert sorted(map(tuple, rows.collect()), key=str) == [("1", 2.0, None), ("1", 2.5, True), ("3", 4.0, None), ("x", None, False)]


def test_no_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,v\n")
    found = typed_csv.scan(spark, str(tmp_path / "a.csv"))
    assert found.types == {"k": "string", "v": "string"} and found.rows.count() == 0 and found.quarantined.count() == 0
