"""Reading, decoding, finding and writing."""

import json
import os

import pandas as pd
import pytest

from tidyforge.operators.dedupe import deduplicate
from tidyforge.sources.decode import decode_content, decode_files
from tidyforge.sources.discover import auto_prepare_merges, directory_crawler, find_files
from tidyforge.sources.html import extract_html_tables, table_rows
from tidyforge.sources.load import (SOURCE_ORDER, infer_types, is_sql, jdbc_reader, load, load_data,
                                    read_csv)
from tidyforge.sources.save import save_output, saved

CSV = 'id,n,x,flag,day,t,none\n1,1,1.5,True,2024-01-01,"a ""q"", b",\n2,NA,,False,2024-01-02,N/A,\n' \
      '3, 7 ,1e3,true,x,NaN,null\n'


@pytest.fixture
def csv(tmp_path):
    path = tmp_path / "in.CSV"
    path.write_text(CSV)
    return str(path)


def test_csv_types_follow_the_values(spark, csv):
    df = load(spark, csv)
    assert dict(df.dtypes) == {"id": "bigint", "n": "bigint", "x": "double", "flag": "boolean",
                               "day": "string", "t": "string", "none": "double"}
    got = [tuple(r) for r in df.orderBy("id").collect()]
    assert got == [(1, 1, 1.5, True, "2024-01-01", 'a "q", b', None),
                   (2, None, None, False, "2024-01-02", None, None),
                   (3, 7, 1000.0, True, "x", None, None)]


def test_csv_with_schema_reads_tokens_without_inference(spark, csv):
    df = load(spark, csv, schema="id int, n double, x double, flag string, day string, t string, none string")
    assert dict(df.dtypes)["n"] == "double" and df.where("n is null").count() == 1
    assert dict(read_csv(spark, csv, infer=False).dtypes)["id"] == "string"


def test_inference_of_big_and_mixed_numbers(spark):
    df = spark.createDataFrame([("1", "1", "0x1"), ("99999999999999999999", "2.0", "1")],
                               "a string, b string, c string")
    assert [t for _, t in infer_types(df, [""]).dtypes] == ["double", "double", "string"]


def test_json_shapes(spark, tmp_path, rows):
    records = [{"a": 1, "b": "x"}, {"a": 2, "b": None}]
    shapes = {"a": json.dumps(records, indent=1), "b": json.dumps(records),
              "l": "\n\n".join(map(json.dumps, records)), "c": "\n  " + json.dumps(records)}
    for name, text in shapes.items():
        (tmp_path / f"{name}.json").write_text(text)
        path = str(tmp_path / f"{name}.json")
        assert rows(load(spark, path), "a", "b") == [(1, "x"), (2, None)]
        assert rows(load(spark, path, lines=name == "l", schema="a bigint, b string")) == [
            (1, "x"), (2, None)]
        with pytest.raises(ValueError):
            load(spark, path, lines=name != "l")
    (tmp_path / "one.json").write_text(json.dumps(records[0], indent=2))
    assert rows(load(spark, str(tmp_path / "one.json")), "a", "b") == [(1, "x")]
    with pytest.raises(ValueError):
        load(spark, str(tmp_path / "[al].json"))
    assert "Python" not in load(spark, str(tmp_path / "l.json"))._jdf.queryExecution().toString()


def test_json_file_as_merge_input(spark, tmp_path):
    from tidyforge.plans.prepare import merge_datasets
    (tmp_path / "m.json").write_text('{"k": 1, "v": "A"}\n{"k": 1, "v": "B"}\n{"k": 3, "v": "C"}')
    base = spark.createDataFrame([(1,), (2,)], "k int")
    out = merge_datasets(base, [{"file": str(tmp_path / "m.json"), "on": ["k"]}])
    assert sorted(map(tuple, out.collect())) == [("1", "a"), ("2", None)]


def test_csv_keeps_records_whole(spark, tmp_path, rows):
    path = str(tmp_path / "q.csv")
    with open(path, "w", newline="") as out:
        out.write('i,t\n1,"line one\nline ""two"""\n2,"  x  "\n')
    want = [(1, 'line one\nline "two"'), (2, "  x  ")]
    assert rows(load(spark, path)) == want
    assert rows(load(spark, path, schema="i bigint, t string")) == want
    for name, text in (("wide", "a,b\n1,2\n3,4,5\n"), ("short", "a,b\n1,2\n3\n")):
        (tmp_path / f"{name}.csv").write_text(text)
        with pytest.raises(ValueError, match="fields"):
            load(spark, str(tmp_path / f"{name}.csv"))
    (tmp_path / "bad.csv").write_text("a,b\n1,2\nabc,4\n4.7,NA\n")
    with pytest.raises(ValueError, match="'a': 2"):
        load(spark, str(tmp_path / "bad.csv"), schema="a bigint, b bigint")


def test_csv_round_trip_of_dirty_text(spark, tmp_path, rows):
    texts = ["  x  ", "a\nb", 'say "hi", then', "c\r\nd", "back\\slash", "\ttab\t", "plain"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    save_output(df, str(tmp_path / "dirty"))
    back = load(spark, str(tmp_path / "dirty.csv"))
    assert [t for _, t in rows(back)] == texts


def test_decoded_formats(spark, tmp_path, rows):
    pdf = pd.DataFrame({"a": [1.0, 2.0, None], "t": ["x", "y", "z"]})
    for name in ("one", "two"):
        pdf.to_stata(str(tmp_path / f"{name}.dta"), write_index=False)
        pdf.to_feather(str(tmp_path / f"{name}.feather"))
    want = [(None, "z"), (1.0, "x"), (2.0, "y")]
    for ending in ("dta", "feather"):
        assert rows(load(spark, str(tmp_path / f"one.{ending}"))) == want
        both = decode_files(spark, str(tmp_path / f"*.{ending}"), ending, "a double, t string")
        assert both.count() == 6
    assert rows(decode_files(spark, str(tmp_path / "one.dta"), "dta", "t string"))[0] == ("x",)


def test_own_decoder_and_bad_schema(spark):
    files = spark.createDataFrame([("p1", b"1,2"), ("p2", b"3")], "path string, content binary")

    def numbers(data):
        yield pd.DataFrame({"v": [int(x) for x in data.read().split(b",")]})

    assert sorted(r["v"] for r in decode_content(files, numbers).collect()) == [1, 2, 3]
    with pytest.raises(FileNotFoundError):
        decode_content(files.where("false"), numbers)


def test_sas_transport_bytes(spark, monkeypatch):
    """Text of SAS files arrives as bytes and is repaired by the scrubber."""
    from tidyforge.operators.clean import clean_text
    files = spark.createDataFrame([("p", b"")], "path string, content binary")

    def sas_like(data):
        yield pd.DataFrame({"t": [b" Ab ", b"\xff"], "n": [1.0, 2.0]})

    out = clean_text(decode_content(files, sas_like, "t binary, n double")).orderBy("n").collect()
    assert [r["t"] for r in out] == ["ab", None]


def test_sql_source(spark, csv, rows):
    assert is_sql("  SELECT 1") and is_sql("with x as (select 1) select * from x")
    assert not is_sql("selection.csv")
    out = load(spark, "select id, double('NaN') as v from t where id > 1", views={"t": csv})
    assert rows(out) == [(2, None), (3, None)]


def test_jdbc_options(spark, monkeypatch):
    seen = {}
    from pyspark.sql import DataFrameReader
    real = DataFrameReader.option
    monkeypatch.setattr(DataFrameReader, "option",
                        lambda self, k, v: (seen.__setitem__(k, v), real(self, k, v))[1])
    jdbc_reader(spark, "select 1", "jdbc:x:y", user="u")
    assert seen == {"url": "jdbc:x:y", "query": "select 1"}
    jdbc_reader(spark, "select 1", "jdbc:x:y", partitionColumn="id", numPartitions=4)
    assert seen["dbtable"] == "(select 1) q"


def test_missing_and_unsupported(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        load(spark, str(tmp_path / "absent.csv"))
    with pytest.raises(FileNotFoundError):
        load(spark, str(tmp_path / "absent.dta"))
    for name in ("x.pkl", "x.rds", "noending"):
        with pytest.raises(ValueError):
            load(spark, str(tmp_path / name))


def test_nan_becomes_null_on_load(spark, tmp_path):
    path = str(tmp_path / "n.parquet")
    pd.DataFrame({"v": [1.0, float("nan")]}).to_parquet(path)
    assert load_data(spark, path).where("v is null").count() == 1


def test_first_row_of_the_file_wins(spark, tmp_path, rows):
    path = str(tmp_path / "o.csv")
    with open(path, "w") as out:
        out.write("k,v\n" + "".join(f"{i % 50},{9999 - i}\n" for i in range(4000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4KB")
    try:
        df = load(spark, path, source_order=True)
        assert df.rdd.getNumPartitions() > 3
        first = deduplicate(df, ["k"], "first", [SOURCE_ORDER]).drop(SOURCE_ORDER)
        last = deduplicate(df, ["k"], "last", [SOURCE_ORDER]).drop(SOURCE_ORDER)
        assert {(r["k"], r["v"]) for r in first.collect()} == {(i, 9999 - i) for i in range(50)}
        assert {(r["k"], r["v"]) for r in last.collect()} == {(i % 50, 9999 - i) for i in range(3950, 4000)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_discovery(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    for name in ("Phys1.csv", "sub/phy2.csv", "sub/msur.CSV", "sub/other.csv", "sub/phy.txt"):
        (tmp_path / name).write_text("a\n1\n")
    root = str(tmp_path)
    names = lambda *a: sorted(r["name"] for r in find_files(spark, root, *a).collect())
    assert names(".csv", "phy|msur") == ["Phys1.csv", "phy2.csv"]
    assert names(".csv") == ["Phys1.csv", "other.csv", "phy2.csv"] and len(names()) == 5
    assert find_files(spark, root + "/absent", ".csv").count() == 0
    assert [os.path.basename(p) for p in directory_crawler(spark, root, ".txt")] == ["phy.txt"]
    rules = auto_prepare_merges(spark, root, ".csv", ["k"], exclude=[root + "/./Phys1.csv"])
    assert [os.path.basename(r["file"]) for r in rules] == ["other.csv", "phy2.csv"]
    assert rules[0]["on"] == ["k"] and rules[0]["how"] == "left" and rules[0]["collapse_duplicates"]
    assert "ReadSchema" not in str(find_files(spark, root)._jdf.queryExecution()) or \
        "content" not in str(find_files(spark, root)._jdf.queryExecution().executedPlan())


def test_only_the_very_file_is_left_out(spark, tmp_path, monkeypatch):
    for name in ("visits.csv", "old_visits.csv", "_labs.csv", ".h.csv"):
        (tmp_path / name).write_text("k\n1\n")
    monkeypatch.chdir(tmp_path)
    for primary in (f"{tmp_path}/visits.csv", f"file://{tmp_path}/visits.csv"):
        rules = auto_prepare_merges(spark, str(tmp_path), ".csv", ["k"], exclude=[primary])
        assert [os.path.basename(r["file"]) for r in rules] == [".h.csv", "_labs.csv", "old_visits.csv"]
    for hidden in ("_labs.csv", ".h.csv"):
        with pytest.raises(ValueError, match="starts with"):
            load(spark, str(tmp_path / hidden))


def test_relative_paths_are_qualified(spark):
    from tidyforge.sources.discover import qualified
    assert qualified(spark, "./visits.csv") == qualified(spark, "visits.csv")
    assert qualified(spark, "visits.csv").endswith("/visits.csv")


def test_table_folders_count_as_one_file(spark, tmp_path):
    root = str(tmp_path / "in.csv")
    spark.range(9).repartition(3).write.csv(root + "/sub/t.csv", header=True)
    (tmp_path / "in.csv" / "x[1].csv").write_text("id\n1\n")
    found = find_files(spark, "file://" + root, ".csv").orderBy("name").collect()
    assert [r["name"] for r in found] == ["t.csv", "x[1].csv"] and found[0]["length"] > 20
    assert load(spark, found[0]["path"]).count() == 9


def test_html_tables(spark):
    page = ("<p>x</p><table><thead><tr><th>a<th>b</tr></thead><tr><td> 1 &amp; 2 </td><td>z<br>y</td>"
            "</tr></table><TABLE><tr><td>outer<table><tr><td>inner</td></tr></table></td></tr></TABLE>"
            "<table><tr><td>open")
    assert table_rows(page) == [(0, 0, ["a", "b"]), (0, 1, ["1 & 2", "zy"]), (2, 0, ["inner"]),
                                (1, 0, ["outer"]), (3, 0, ["open"])]
    df = spark.createDataFrame([(7, page), (8, "<p>none</p>"), (9, None)], "pid long, html string")
    out = extract_html_tables(df, "pid", "html")
    assert out.count() == 5 and out.select("page").distinct().collect() == [(7,)]


def test_html_spans(spark):
    page = ("<table><tr><th rowspan=2>a<th colspan=2>b<tr><td>c<td>d<tr><td>e<td colspan=x>f<td>g"
            "<tr><td colspan='3'>h</table>")
    assert [cells for _, _, cells in table_rows(page)] == [
        ["a", "b", "b"], ["a", "c", "d"], ["e", "f", "g"], ["h", "h", "h"]]


def test_html_files(spark, tmp_path):
    (tmp_path / "a.html").write_text("<table><tr><td>1<td>2</table>")
    row = load(spark, str(tmp_path / "a.html")).first()
    assert row["page"].endswith("a.html") and row["cells"] == ["1", "2"]


def test_csv_sink(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, 'a "b", c'), (2, None)], "i int, `t.x [1]` string")
    path = str(tmp_path / "out")
    assert save_output(df, path) is df
    back = load(spark, path + ".csv")
    assert back.columns == ["i", "t.x [1]"] and rows(back) == [(1, 'a "b", c'), (2, None)]
    save_output(df, path + ".parquet", format="parquet")
    assert spark.read.parquet(path + ".parquet").count() == 2


def test_single_csv_file_of_many_parts(spark, tmp_path, rows):
    """Parts are written by their tasks and put together in the order of the rows."""
    path = str(tmp_path / "one.csv")
    df = spark.range(0, 500, 1, 7).selectExpr("id AS i", "concat('a\nb, ', id) AS t")
    save_output(df, path, single_file=True)
    assert os.path.isfile(path)
    back = pd.read_csv(path)
    assert back["i"].tolist() == list(range(500)) and back["t"][3] == "a\nb, 3"
    assert saved(spark, path).count() == 500
    save_output(df.where("i < 2"), path, single_file=True, header=False)
    with open(path) as text:
        assert text.read() == '0,"a\nb, 0"\n1,"a\nb, 1"\n'
    with pytest.raises(FileExistsError):
        save_output(df, path, single_file=True, mode="error")
    save_output(df.where("i < 0"), path, single_file=True)
    with open(path) as text:
        assert text.read() == "i,t\n"
    with pytest.raises(ValueError):
        save_output(df, path, single_file=True, format="parquet")
