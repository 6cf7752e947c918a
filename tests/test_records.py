"""Records of files that are cut into many splits."""

import csv
import io
import json
import random
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidyforge.sources import records
from tidyforge.sources.load import SOURCE_ORDER, csv_records, json_kind, load, read_csv, read_json
from tidyforge.sources.records import cut_records, json_array_rule


@pytest.fixture
def splits(spark):
    """File splits of few bytes."""
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = [spark.conf.get(n) for n in names]
    for name, value in zip(names, (1500, 1)):
        spark.conf.set(name, str(value))
    yield
    for name, value in zip(names, before):
        spark.conf.set(name, value)


TEXTS = ["plain", 'say "so"', "a,b", "two\nlines", "\n\n\n", 'q"\n"', "", "c\r\nd", "  x ", "é\n\"ü\"",
         "long\n" * 40, '"', ",", "}{][", "last,\n"]


def written(rows, ending="\n"):
    out = io.StringIO()
    csv.writer(out, lineterminator=ending).writerows(rows)
    return out.getvalue()


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_csv_records_of_many_splits(spark, tmp_path, splits, ending):
    pick = random.Random(5)
    rows = [(str(i), pick.choice(TEXTS), pick.choice(TEXTS) + "x") for i in range(300)]
    for part in (0, 1):
        (tmp_path / f"{part}.csv").write_bytes(
            written([("i", "t", "u"), *rows[part * 150:part * 150 + 150]], ending).encode())
    lines = spark.read.text(str(tmp_path))
    assert lines.rdd.getNumPartitions() > 6
    df = load(spark, str(tmp_path), format="csv", source_order=True, na_tokens=[])
    assert df.dtypes[:3] == [("i", "bigint"), ("t", "string"), ("u", "string")]
    got = [tuple(r)[:3] for r in df.orderBy(SOURCE_ORDER).collect()]
    assert got == [(int(i), t or None, u) for i, t, u in rows]
    typed = load(spark, str(tmp_path), format="csv", schema="i int, t string, u string", na_tokens=[])
    assert typed.dtypes == [("i", "int"), ("t", "string"), ("u", "string")]
    assert sorted(map(tuple, typed.collect()), key=str) == sorted(got, key=str)


def test_csv_of_backslash_quotes_and_no_header(spark, tmp_path, splits):
    (tmp_path / "b.csv").write_text('1;"a \\" b\nc"\n2;"d"\n3;"\\\\"\n')
    df = read_csv(spark, str(tmp_path / "b.csv"), header=False, escape="\\", sep=";")
    assert sorted(map(tuple, df.collect())) == [(1, 'a " b\nc'), (2, "d"), (3, "\\")]


def test_csv_errors_are_told(spark, tmp_path):
    cases = {"open": 'a,b\n1,"x\n2,y\n', "wide": 'a,b\n1,"x\ny"\n2,y,z\n'}
    for name, text in cases.items():
        (tmp_path / f"{name}.csv").write_text(text)
        with pytest.raises(ValueError, match="open" if name == "open" else "fields"):
            load(spark, str(tmp_path / f"{name}.csv"))
    (tmp_path / "two").mkdir()
    for i, head in enumerate(["a,b", "a,c"]):
        (tmp_path / "two" / f"{i}.csv").write_text(head + '\n1,"x\ny"\n')
    with pytest.raises(ValueError, match="different headers"):
        read_csv(spark, str(tmp_path / "two"))
    with pytest.raises(ValueError, match="does not have the schema's columns"):
        read_csv(spark, str(tmp_path / "two" / "0.csv"), schema="a int, z string")


def test_csv_rows_like_the_header_are_kept(spark, tmp_path):
    (tmp_path / "h.csv").write_text("id,n\n1,2\nid,n\n3,4\n")
    assert sorted(map(tuple, load(spark, str(tmp_path / "h.csv")).collect())) == [
        ("1", "2"), ("3", "4"), ("id", "n")]


def test_csv_header_of_two_lines_and_blank_lines(spark, tmp_path, splits):
    (tmp_path / "h.csv").write_text('\n"a\nb",c\n\n1,"x\ny"\n\n')
    df = load(spark, str(tmp_path / "h.csv"))
    assert df.columns == ["a\nb", "c"] and [tuple(r) for r in df.collect()] == [(1, "x\ny")]


def test_csv_without_open_quotes_needs_no_python(spark, tmp_path):
    (tmp_path / "p.csv").write_text('a,b\n1,"x"\n2,y\n')
    assert "Python" not in load(spark, str(tmp_path / "p.csv"))._jdf.queryExecution().toString()


def nested(pick, deep=2):
    kinds = [1, 2.5, True, None, "t", 'q"\\}{', "é,", "][\\", {"x": 1}, [1, {"y": "}"}], {}]
    out = {f"k{i}": pick.choice(kinds) for i in range(pick.randint(0, 4))}
    if deep:
        out["inner"] = nested(pick, deep - 1)
    return out


@pytest.mark.parametrize("indent", [None, 2])
def test_array_records_of_many_splits(spark, tmp_path, splits, indent):
    pick = random.Random(8)
    held = [[{"id": 1000 * f + i, "r": nested(pick)} for i in range(80)] for f in range(2)]
    for f, own in enumerate(held):
        (tmp_path / f"{f}.json").write_text(json.dumps(own, indent=indent, ensure_ascii=False))
    got, ends = cut_records(spark, str(tmp_path), json_array_rule())
    assert {(r["state"], r["depth"]) for r in ends.collect()} == {(0, -1)}
    df = load(spark, str(tmp_path), format="json", schema="id int, r variant", source_order=True)
    rows = df.orderBy(SOURCE_ORDER).selectExpr("id", "to_json(r) AS r").collect()
    assert [(r["id"], json.loads(r["r"])) for r in rows] == [
        (x["id"], x["r"]) for own in held for x in own]


def test_arrays_that_are_no_records(spark, tmp_path):
    for name, text in {"cut": '[{"a": 1}, {"a": ', "numbers": "[1, 2]", "lists": '[[{"a": 1}]]',
                       "mixed": '[{"a": 1}, 3, {"a": 2}]'}.items():
        (tmp_path / f"{name}.json").write_text(text)
        with pytest.raises(ValueError):
            load(spark, str(tmp_path / f"{name}.json"))
    (tmp_path / "none.json").write_text("[]")
    assert load(spark, str(tmp_path / "none.json"), schema="a int").count() == 0
    (tmp_path / "empty.json").write_text('[{}, {"a": 1}, { }]')
    assert load(spark, str(tmp_path / "empty.json"), schema="a int").count() == 3


@pytest.mark.parametrize("indent", [None, 1])
def test_object_of_columns_of_many_splits(spark, tmp_path, splits, indent):
    n = 90
    frame = pd.DataFrame({"a": range(n), "b": [f'x"{i}, }}{{' for i in range(n)],
                          "c,\"q": [None if i % 3 else i / 2 for i in range(n)],
                          "d": [["l", {"m": 1}] for _ in range(n)]})
    text = frame.to_json()
    (tmp_path / "c.json").write_text(json.dumps(json.loads(text), indent=indent))
    assert json_kind(spark, str(tmp_path / "c.json")) == "columns"
    df = load(spark, str(tmp_path / "c.json"), source_order=True)
    assert dict(df.dtypes)["a"] == "bigint" and dict(df.dtypes)["b"] == "string"
    back = pd.read_json(io.StringIO(text))
    got = df.orderBy(SOURCE_ORDER).selectExpr("a", "b", '`c,"q` AS c', "to_json(d) AS d").collect()
    assert [r["a"] for r in got] == back["a"].tolist()
    assert [r["b"] for r in got] == back["b"].tolist()
    assert [r["c"] for r in got] == [None if pd.isna(v) else v for v in back['c,"q']]
    assert [json.loads(r["d"])[0] for r in got] == ["l"] * n


def test_columns_with_different_labels(spark, tmp_path, splits):
    cells = {"a": {"x": 1, "y": 2}, "none": {}, "b": {"y": "p", "z": "q"}, "n": {"x": {"k": {"l": 1}}}}
    (tmp_path / "c.json").write_text(json.dumps(cells))
    df = read_json(spark, str(tmp_path / "c.json"), schema="a int, b string, n struct<k:struct<l:int>>",
                   source_order=True)
    got = [(r["a"], r["b"], r["n"] and r["n"]["k"]["l"]) for r in df.orderBy(SOURCE_ORDER).collect()]
    assert got == [(1, None, 1), (2, "p", None), (None, "q", None)]


def test_kinds_are_told_by_the_head(spark, tmp_path):
    for text, kind in {'{"a": 1}\n{"a": 2}': "lines", '{"a": {"b": 1}}\n{"a": {"b": 2}}': "lines",
                       '{"a": 1}': "lines", '{\n"a": 1}': "object", ' [ ]': "records", "": "lines",
                       '{"a": {"0": 1}, "b": {"0": 2}}': "columns", '{"a": {"0": 1}, "b": 2}': "lines",
                       '\n{"a":\n{"0": 1}}\n': "columns", '{"a": 1,\n"b": {"c": 2}}': "object"}.items():
        (tmp_path / "k.json").write_text(text)
        assert json_kind(spark, str(tmp_path / "k.json")) == kind, text
    (tmp_path / "k.json").write_text('{"a": {"b": 1}}')
    assert load(spark, str(tmp_path / "k.json"), orient="lines").first()["a"]["b"] == 1
    with pytest.raises(ValueError, match="orientation"):
        load(spark, str(tmp_path / "k.json"), orient="index")


def test_open_records_may_span_chunks(spark, tmp_path, splits):
    """A record longer than several splits, between short ones."""
    rows = [("1", "a\nb"), ("2", "line\n" * 500), ("3", "c")]
    (tmp_path / "l.csv").write_text(written([("i", "t"), *rows]))
    raw = csv_records(spark, str(tmp_path / "l.csv"), {"header": True, "escape": '"', "mode": "FAILFAST"})
    assert [(r["i"], r["t"]) for r in raw.orderBy(SOURCE_ORDER).collect()] == rows
    assert records.PLACE == ["file", "block", "chunk", "n"]


@pytest.mark.parametrize("broadcast", [10 << 20, -1])
def test_records_of_one_file_do_not_meet_in_one_task(spark, tmp_path, splits, monkeypatch, broadcast):
    """Neither the first record nor the pieces of open ones bring all text of a file together."""
    rows = [(str(i), "two\nlines" * (i % 40)) for i in range(400)]
    (tmp_path / "o.csv").write_text(written([("i", "t"), *rows]))
    plans = []

    def kept(df, name="stage", write=records.materialize):
        if "text" in df.columns:
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(records, "materialize", kept)
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled"]
    before = [spark.conf.get(n) for n in names]
    for name, value in zip(names, (broadcast, "false")):
        spark.conf.set(name, str(value))
    try:
        raw = csv_records(spark, str(tmp_path / "o.csv"), {"header": True, "escape": '"', "mode": "FAILFAST"})
        plans.append(raw._jdf.queryExecution().executedPlan().toString())
        tasks = [r["n"] for r in raw.groupBy(F.spark_partition_id()).agg(F.count("i").alias("n")).collect()]
        got = [(r["i"], r["t"]) for r in raw.orderBy(SOURCE_ORDER).collect()]
    finally:
        for name, value in zip(names, before):
            spark.conf.set(name, value)
    assert got == [(i, t or None) for i, t in rows]
    assert len(tasks) > 2 and max(tasks) < 300
    assert not [p for p in plans if re.search(r"hashpartitioning\(file#\d+, \d+\)", p)]
