"""Records of several lines: cut in parallel as Python's reader cuts them one by one."""

import collections
import csv
import random

import pytest
from pyspark.sql import functions as F, types as T

from ledgerloom.sources import readers, records, sinks

FIELDS = T.StructType([T.StructField(c, T.StringType()) for c in ("id", "a", "b")])


@pytest.fixture
def small_blocks(spark):
    """Blocks of 600 bytes, so that one file is read by many tasks."""
    names = {"spark.sql.files.maxPartitionBytes": "600", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
@pytest.mark.parametrize("quoting", [csv.QUOTE_ALL, csv.QUOTE_MINIMAL])
@pytest.mark.parametrize("encoding", ["UTF-8", "windows-1252"])
def test_records_agree_with_a_reader_of_one_pass(spark, tmp_path, small_blocks, ending, quoting, encoding):
    rnd = random.Random(f"{ending} {quoting} {encoding}")
    parts = ["a", "b", '"', "\n", "\r\n", ",", ";", "é", " ", "–", "x" * 40]
    rows = [("id", "a", "b"), *((str(i), *("".join(rnd.choice(parts) for _ in range(rnd.choice([0, 1, 3, 12, 5 if rnd.random() < 0.9 else 200]))) for _ in "ab")) for i in range(60))]
    for name in ("one.csv", "two.csv"):
        with open(tmp_path / name, "w", newline="", encoding=encoding) as f:
            csv.writer(f, delimiter=";", lineterminator=ending, quoting=quoting).writerows(rows)
    assert records.lines_of(spark, str(tmp_path), encoding).rdd.getNumPartitions() > 4
    out = records.read_records(spark, str(tmp_path), ";", encoding, FIELDS).collect()
    assert collections.Counter((r.id, r.a or "", r.b or "", r[records.FILE]) for r in out) == collections.Counter((*r, n) for r in rows[1:] for n in ("one.csv", "two.csv"))


def test_quotes_that_open_nothing(spark, tmp_path, small_blocks):
    text = 'id,a,b\n1,5" pipe,x\n2,"two\nlines",6"\n\n3,"a ""x"" b",""\n4,"",""""\n5,say ""hi"",z\n6,"open,\nto the\nend'
    (tmp_path / "q.csv").write_text(text)
    out = {r.id: (r.a, r.b) for r in readers.read_delimited(spark, str(tmp_path / "q.csv")).collect()}
    assert out["1"] == ('5" pipe', "x") and out["2"] == ("two\nlines", '6"') and out["3"][0] == 'a "x" b' and out["4"][1] == '"' and set(out) == {"1", "2", "3", "4", "5", "6"}
    for line, ends in (('a,"b', True), ('a,b"', False), ('"a","b', True), ('"a ""b"', False), ('"""', True), ('""', False), ('a,"""b', True)):
        assert spark.range(1).select(records.ends_inside(F.lit(line), ",")).first()[0] == ends == records.after(line, False, ",")
    assert [records.after(x, True, ",") for x in ('x"', '""', '",a', '","', 'x",y,"z"', '"""')] == [False, True, False, True, False, False]


def test_a_record_over_many_blocks(spark, tmp_path, small_blocks):
    long = "\n".join(f"line {i}, of one \"\"record\"\"" for i in range(200))
    (tmp_path / "long.csv").write_text(f'"id\nnumber",a,b\n1,"{long}",x\n2,y,"z\n"\n')
    df = readers.read_delimited(spark, str(tmp_path / "long.csv"))
    assert df.columns == ["id\nnumber", "a", "b"]
    assert {r[0]: (r.a, r.b) for r in df.collect()} == {"1": (long.replace('""', '"'), "x"), "2": ("y", "z\n")}


def test_many_and_tolerant(spark, tmp_path, small_blocks):
    df = spark.createDataFrame([(1, 'a "b"\nc;d'), (2, None), (3, "plain")], "id int, t string")
    sinks.write_csv(df.coalesce(1), str(tmp_path / "w"), keep_breaks=True)
    (tmp_path / "x.csv").write_text("id,u\n4,v\n")
    both = readers.read_many(spark, [str(tmp_path / "w"), str(tmp_path / "x.csv")])
    assert {(r.id, r.t, r.u) for r in both.collect()} == {("1", 'a "b"\nc;d', None), ("2", None, None), ("3", "plain", None), ("4", None, "v")}
    assert {r.file_name for r in both.filter("id = 4").collect()} == {"x.csv"}
    (tmp_path / "bad.csv").write_text('id,t\n1,"a\nb"\nx,"c\nd"\n2,e\n')
    good, bad = readers.read_tolerant(spark, str(tmp_path / "bad.csv"), readers.identifier_schema(["id", "t"], {"id": "int"}))
    assert {tuple(r) for r in good.collect()} == {(1, "a\nb"), (2, "e")} and [r[-1] for r in bad.collect()] == ['x,"c\nd"']
