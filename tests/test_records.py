"""Quarter files with quoted line breaks, against pandas and plain cutting."""

import random

import pandas as pd
import pytest

from tranche.sources import files
from tranche.sources.records import begins_inside, field_names, open_after, records, split_states


@pytest.fixture
def small_splits(spark):
    """Splits of a few dozen bytes, so that records cross many of them."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "160")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_open_after():
    assert not open_after('a,b"c,d', False) and not open_after('"a","b""c"', False)
    assert open_after('a,"b', False) and open_after("still, inside", True) and open_after('say ""hi""', True)
    assert not open_after('end",next', True) and open_after('end","next', True) and not open_after('" tail, "x" y', True)
    assert open_after('x,"', False) and not open_after('x,""', False) and open_after('x,"""', False)


def test_header_names():
    assert field_names('id,"loan, amount", term ,id,id') == ["id", "loan, amount", "term", "id.1", "id.2"]


def test_line_breaks_inside_quotes(spark, tmp_path):
    (tmp_path / "2016Q1.csv").write_text('id,loan_amnt,term,desc\n1,1000, 36 months,plain\n2,2000, 60 months,"two\nlines, here"\n'
                                         '3,3000, 36 months,"say ""hi""\n\nlast"\n4,4\n\n5,5000, 36 months,5" pipe\n')
    where = f"file:{tmp_path}"
    rows = {r["id"]: r for r in files.load_quarters(spark, where, ["2016Q1"]).collect()}
    assert {i: r["desc"] for i, r in rows.items()} == {1: "plain", 2: "two\nlines, here", 3: 'say "hi"\n\nlast', 5: '5" pipe'}
    assert rows[2]["term"] == 60 and rows[3]["loan_amnt"] == 3000.0
    assert [r["_corrupt_record"] for r in files.malformed_rows(spark, where, ["2016Q1"]).collect()] == ["4,4"]


def test_header_with_quotes_and_windows_line_ends(spark, tmp_path):
    (tmp_path / "2016Q2.csv").write_bytes('﻿id,"desc","loan, amnt"\r\n1,"a\r\nb",3\r\n2,c,4\r\n'.encode())
    got = sorted((r["id"], r["desc"], r["loan, amnt"]) for r in files.load_quarters(spark, f"file:{tmp_path}", ["2016Q2"]).collect())
    assert got == [(1, "a\r\nb", "3"), (2, "c", "4")]


def _random_file(rng, rows):
    alphabet = ["a", "b ", ",", "\n", '"', "\n\n", "x" * 30, "é", "", "\r\n"]
    frame = pd.DataFrame({"id": range(rows), "desc": ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 9))) + "." for _ in range(rows)],
                          "title": [rng.choice(["plain", 'q"uote', "two\nlines", "z" * 90]) for _ in range(rows)]})
    return frame


@pytest.mark.parametrize("seed", [1])
def test_records_across_splits_equal_pandas(spark, tmp_path, small_splits, seed):
    rng = random.Random(seed)
    for q in ("2016Q1", "2016Q2"):
        _random_file(rng, 60).to_csv(tmp_path / f"{q}.csv", index=False)
    paths = [str(tmp_path / f"{q}.csv") for q in ("2016Q1", "2016Q2")]
    lines = spark.read.text(paths, lineSep="\n").selectExpr("_metadata.file_path AS file", "_metadata.file_block_start AS start", "value")
    states = split_states(lines)
    assert states.count() > 20 and len(begins_inside(states)) > 3
    got = sorted((r["data_quarter"], r["id"], r["desc"], r["title"]) for r in files.load_quarters(spark, f"file:{tmp_path}", ["2016Q1", "2016Q2"]).collect())
    want = [(q, *r) for q, p in zip(("2016Q1", "2016Q2"), paths) for r in pd.read_csv(p, keep_default_na=False, dtype={"desc": str}).itertuples(index=False)]
    assert got == sorted(want)
    assert files.malformed_rows(spark, f"file:{tmp_path}", ["2016Q1", "2016Q2"]).count() == 0


def test_a_field_of_many_splits_and_one_that_never_closes(spark, tmp_path, small_splits):
    long = "\n".join(f"line {i}" for i in range(80))
    (tmp_path / "2016Q1.csv").write_text(f'id,desc\n1,"{long}"\n2,b\n3,"open\nto the end\n')
    got = sorted(r["record"] for r in records(spark, [str(tmp_path / "2016Q1.csv")]).collect())
    assert got == sorted([f'1,"{long}"', "2,b", '3,"open\nto the end'])


def test_empty_files(spark, tmp_path):
    (tmp_path / "2016Q1.csv").write_text("id,desc\n")
    (tmp_path / "2016Q2.csv").write_text("")
    assert files.load_quarters(spark, f"file:{tmp_path}", ["2016Q1", "2016Q2"]).collect() == []
    with pytest.raises(ValueError, match="no header"):
        files.load_quarters(spark, f"file:{tmp_path}", ["2016Q2"])
