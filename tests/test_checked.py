"""Scans that infer types and keep what does not fit."""

import random

import pytest

from liftspark.sources import checked as C


def test_lattice():
    kinds = ["boolean", "bigint", "double", "date", "timestamp", "string"]
    for a in kinds:
        assert C.wider(a, a) == a and C.wider(a, "string") == "string"
        for b in kinds:
            assert C.wider(a, b) == C.wider(b, a)
            for c in kinds:
                assert C.wider(C.wider(a, b), c) == C.wider(a, C.wider(b, c))
    assert C.wider("bigint", "double") == "double" and C.wider("date", "timestamp") == "timestamp" and C.wider("bigint", "date") == "string"


def write(tmp_path, lines, header="a,b,c,d,e,f"):
    (tmp_path / "in").mkdir()
    for i in range(2):
        (tmp_path / "in" / f"{i}.csv").write_text("\n".join([header, *lines[i::2]]) + "\n")
    return str(tmp_path / "in")


def test_rows_and_rejects_are_all_lines(spark, tmp_path):
    lines = [f"{i},{i}.5,2020-01-0{i % 9 + 1},true,t{i},2020-01-01 0{i % 9}:00:00" for i in range(400)]
    lines[7] = "7,x,2020-01-01,true,t7,2020-01-01 00:00:00"
    lines[8] = "8,1.0,2020-01-01"
    lines[9] = "9,1.0,2020-01-01,true,t9,2020-01-01 00:00:00,more"
    lines[10] = "ten,1.0,never,true,t10,2020-01-01 00:00:00"
    lines[11] = ",,,,,"  # nulls fit every type
    found = C.read_checked(spark, write(tmp_path, lines))
    assert found.types == {"a": "bigint", "b": "double", "c": "date", "d": "boolean", "e": "string", "f": "timestamp"}
    assert [t for _, t in found.rows.dtypes] == list(found.types.values())
    rejects = {r.line: r.reason for r in found.rejects.collect()}
    assert rejects == {
        lines[7]: "b is no double", lines[8]: "number of fields", lines[9]: "number of fields", lines[10]: "a is no bigint, c is no date",
    }
    assert found.rows.select("a").count() == found.rows.count() == 396 and found.rows.filter("a is null").count() == 1


@pytest.mark.parametrize("share", [0.01, 0.2])
def test_columns_widen_with_all_lines(spark, tmp_path, share):
    """What a sample takes for whole numbers or dates is widened if enough of all lines say so."""
    r = random.Random(1)
    lines = []
    for i in range(4000):
        odd = r.random() < share
        lines.append(f"{i + 0.5 if odd else i},{'2020-01-01 10:00:00' if odd else '2020-01-01'},{'word' if odd else i},1,1,1")
    found = C.read_checked(spark, write(tmp_path, lines), sample=0.001, least=0, tolerance=0.05)
    rows, rejects = found.rows.count(), found.rejects.count()
    assert rows + rejects == 4000
    if share > 0.05:
        assert (found.types["a"], found.types["c"]) == ("double", "string") and rejects == 0
    else:
        assert found.types["c"] in ("bigint", "string") and rejects <= 4000 * 0.05


def test_given_types_and_nothing(spark, tmp_path):
    path = write(tmp_path, ["1,2,3,4,5,6"] * 3 + ["x,2,3,4,5,6"])
    found = C.read_checked(spark, path, types={"a": "string", "b": "double"})
    assert found.types["a"] == "string" and found.types["b"] == "double" and found.types["f"] == "bigint"
    assert found.rows.count() == 4 and found.rejects.isEmpty()
    other = tmp_path / "other"
    other.mkdir()
    empty = C.read_checked(spark, write(other, []))
    assert empty.rows.isEmpty() and empty.rejects.isEmpty() and set(empty.types.values()) == {"string"}
