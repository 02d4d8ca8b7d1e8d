"""Files of one prefix in a folder shared with other loads."""

import os

import pytest

from loadbay.sinks import shared
from loadbay.sources import files as src


def data(folder):
    return sorted(f for f in os.listdir(folder) if not f.startswith((".", "_")))


def test_what_is_cleared():
    names = ["a", "a-0.txt", "a-1.txt", "a.gz", "ab-0.txt", "b"]
    new = ["a-0.txt", "a-5.txt"]
    assert shared.to_clear(names, new, "a", 0) == shared.to_clear(names, new, "a", 2) == {"a-0.txt"}
    assert shared.to_clear(names, new, "a", 3) == {"a", "a-0.txt", "a-1.txt", "a.gz"}
    assert shared.to_clear(names, new, "a", 4) == set(names)
    assert shared.to_clear(names, new, "a", "truncate") == set(names) - {"b"}
    assert shared.to_clear(names, new, "a", "append") == shared.to_clear(names, ["c"], "a", 1) == set()
    for policy in (1, "nonconflict"):
        with pytest.raises(FileExistsError):
            shared.to_clear(names, new, "a", policy)
    assert shared.to_clear(names, ["z"], "z", "nonconflict") == set()


def test_names():
    assert shared.names_for([".txt"], "p") == ["p.txt"]
    assert shared.names_for([".txt"] * 2, "p") == ["p-0.txt", "p-1.txt"]
    assert shared.names_for([".txt"], "p", ["p.txt"]) == ["p-0.txt"]
    assert shared.names_for([".gz"] * 2, "p", ["p-9.txt", "p-10.txt", "q-50.txt"]) == ["p-11.gz", "p-12.gz"]


def test_loads_side_by_side(spark, tmp_dir):
    rows = spark.range(100).selectExpr("cast(id as string) id")
    one = shared.write_shared(rows, tmp_dir, "one", file_count=3)
    assert one == ["one-0.txt", "one-1.txt", "one-2.txt"]
    assert shared.write_shared(rows, tmp_dir, "two", file_count=1, compression="gzip") == ["two.txt.gz"]
    assert data(tmp_dir) == one + ["two.txt.gz"]
    assert shared.write_shared(rows.limit(5), tmp_dir, "one", file_count=2) == one[:2]
    assert data(tmp_dir) == one[:2] + ["two.txt.gz"]
    assert src.read_delimited(spark, f"{tmp_dir}/one-*", num_fields=1).count() == 5
    more = shared.write_shared(rows.limit(7), tmp_dir, "one", write_mode="append", file_count=2)
    assert more == ["one-2.txt", "one-3.txt"]
    assert src.read_delimited(spark, f"{tmp_dir}/one-*", num_fields=1).count() == 12
    for refused in ({"write_mode": "nonConflict"}, {"del_mode": 1}):
        with pytest.raises(FileExistsError):
            shared.write_shared(rows, tmp_dir, "one", file_count=2, **refused)
    assert data(tmp_dir) == one[:2] + more + ["two.txt.gz"]
    assert shared.write_shared(rows.limit(0), tmp_dir, "one", write_mode="truncate") == ["one.txt"]
    assert data(tmp_dir) == ["one.txt", "two.txt.gz"]
    assert shared.write_shared(rows, tmp_dir, "last", del_mode=4, file_count=1) == ["last.txt"]
    assert os.listdir(tmp_dir).count("last.txt") == 1 and data(tmp_dir) == ["last.txt"]
    assert not [f for f in os.listdir(tmp_dir) if f.startswith("_")]


def test_failed_load_and_wrong_parameters(spark, tmp_dir):
    rows = spark.range(10).selectExpr("cast(id as string) id")
    shared.write_shared(rows, tmp_dir, "p", file_count=2)
    with pytest.raises(Exception):
        shared.write_shared(spark.range(10).selectExpr("raise_error('no') id"), tmp_dir, "p")
    assert data(tmp_dir) == ["p-0.txt", "p-1.txt"] and not [f for f in os.listdir(tmp_dir) if f.startswith("_")]
    for wrong in ({"write_mode": "x"}, {"del_mode": 9}):
        with pytest.raises(ValueError):
            shared.write_shared(rows, tmp_dir, "p", **wrong)
    with pytest.raises(ValueError):
        shared.write_shared(rows, tmp_dir, "_p")
