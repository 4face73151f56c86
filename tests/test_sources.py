"""Readers, writers and saved steps on small files."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.plans import steps
from ledgerloom.sources import readers, sinks

TEXT = "cpf{0}nome{0}email{0}qualidade_lead\n00123456789{0}José Ção{0}a@b.com{0}alta\n00987654321{0}Ana{0}c@d.com{0}baixa\n"


@pytest.mark.parametrize("sep", [",", ";", "|", "\t"])
@pytest.mark.parametrize("encoding", ["utf-8", "iso-8859-1", "cp1252"])
def test_separators_and_encodings(spark, tmp_path, sep, encoding):
    path = tmp_path / "leads.csv"
    path.write_bytes(TEXT.replace("nome", "nomé").format(sep).encode(encoding))
    df = readers.read_delimited(spark, str(path))
    assert df.columns == ["cpf", "nomé", "email", "qualidade_lead"]
    assert [r.cpf for r in df.orderBy("cpf").collect()] == ["00123456789", "00987654321"] and "José Ção" in {r["nomé"] for r in df.collect()}


def test_files_that_are_no_tables(spark, tmp_path):
    for name, text in (("one", "a\nb\n"), ("empty", ""), ("prose", "nothing to see here\nat all\n")):
        (tmp_path / name).write_text(text)
        with pytest.raises(ValueError):
            readers.read_delimited(spark, str(tmp_path / name))
    (tmp_path / "head").write_text("a,b\n")
    assert readers.read_delimited(spark, str(tmp_path / "head")).count() == 0


def test_many_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,nome\n1,x\n2,\n")
    (tmp_path / "b.csv").write_text("id;valor\n3;9\n")
    df = readers.read_many(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")])
    assert {(r.id, r.nome, r.valor, r.file_name) for r in df.collect()} == {("1", "x", None, "a.csv"), ("2", None, None, "a.csv"), ("3", None, "9", "b.csv")}
    stats = {r.file_name: (r.rows, r.columns, r.missing) for r in readers.file_stats(df).collect()}
    assert stats == {"a.csv": (2, 2, 3), "b.csv": (1, 2, 1)}
    assert readers.identifier_schema(["CPF", "n"], {"CPF": "int", "n": "int"}).simpleString() == "struct<CPF:string,n:int>"


def test_tolerant_json_and_registry(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("id,n\n1,2\nx,3\n4,5\n")
    good, bad = readers.read_tolerant(spark, str(tmp_path / "bad.csv"), readers.identifier_schema(["id", "n"], {"id": "int", "n": "int"}))
    assert good.count() == 2 and [r[-1] for r in bad.collect()] == ["x,3"]
    (tmp_path / "a.json").write_text('[{"id": 1, "nome": "a"}, {"id": 2, "nome": "b"}]')
    (tmp_path / "b.jsonl").write_text('{"id": 1}\nnot json\n{"id": 2}\n')
    assert readers.read_any(spark, str(tmp_path / "a.json")).count() == 2
    assert readers.read_any(spark, str(tmp_path / "b.jsonl"), schema="id int").count() == 2
    readers.register_source("pipe", lambda spark, path: spark.read.csv(path, sep="|", header=True))
    (tmp_path / "c.pipe").write_text("a|b\n1|2\n")
    assert readers.read_any(spark, str(tmp_path / "c.pipe")).first().b == "2"
    with pytest.raises(ValueError):
        readers.read_any(spark, "x.unknown")
    assert readers.strip_templates(spark.createDataFrame([("a {{field:1-2}} b",)], "t string")).first().t == "a  b"
    assert readers.profile_sample(spark.range(100), n=10, above=50).count() < 60 and readers.preview(spark.range(9), 3).count() == 3


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(1, "linha\num; dois", 1.5), (2, None, 2.5)], "id int, t string, x double")
    sinks.write_csv(df, str(tmp_path / "c"), quote_all=True)
    back = spark.read.csv(str(tmp_path / "c"), sep=";", header=True)
    assert {r.t for r in back.collect()} == {"linha um; dois", None}
    sinks.write_json(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2
    sinks.export_bundle(df, str(tmp_path / "b"), "s", "2024-01-01")
    assert spark.read.parquet(str(tmp_path / "b/profile")).count() == 3 and spark.read.parquet(str(tmp_path / "b/statistics")).count() == 2
    assert readers.read_parquet(spark, str(tmp_path / "b/data"), ["id"]).columns == ["id"]


def test_saved_steps(spark, tmp_path):
    spec = [{"name": "f", "type": "filter", "config": {"condition": "x > 1"}}, {"name": "a", "type": "aggregate", "config": {"by": ["g"], "measures": {"n": "count(*)"}}}, {"name": "s", "type": "sort", "config": {"by": ["-n", "g"]}}]
    steps.save_steps(spark, str(tmp_path), "mine", spec)
    assert steps.load_steps(spark, str(tmp_path), "mine") == spec and [r.name for r in steps.list_steps(spark, str(tmp_path)).collect()] == ["mine"]
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("b", 4)], "g string, x int")
    assert [tuple(r) for r in steps.run_steps(df, spec).collect()] == [("b", 2), ("a", 1)]
    with pytest.raises(ValueError):
        steps.run_steps(df, [{"type": "nope"}])
    scored = steps.run_steps(df, [{"type": "lead_scoring", "config": {"scoring_rules": [{"name": "s", "max_score": 5, "criteria": [["g", "equals", "a", 9]]}]}}])
    assert scored.agg(F.sum("total_score")).first()[0] == 10.0


def test_tables_of_a_database(spark):
    """S10 and K6 against a database in memory, which a local session's tasks share with the driver."""
    from ledgerloom.sources import readers, sinks

    url, driver = "jdbc:derby:memory:ledgerloom;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    df = spark.createDataFrame([(i, f"n{i}") for i in range(50)], "id int, name string")
    sinks.append_jdbc(df, url, "leads", driver)
    sinks.append_jdbc(df.filter("id < 3"), url, "leads", driver)
    whole = readers.read_jdbc(spark, url, table="leads", **driver)
    assert whole.count() == 53
    parts = readers.read_jdbc(spark, url, table="leads", partition=("id", 0, 50, 4), **driver)
    assert parts.rdd.getNumPartitions() == 4 and sorted(map(tuple, parts.collect())) == sorted(map(tuple, whole.collect()))
    own = readers.read_jdbc(spark, url, table="leads", parallel=('"id"', 4), **driver)
    assert own.rdd.getNumPartitions() == 4 and sorted(map(tuple, own.collect())) == sorted(map(tuple, whole.collect()))
    none = readers.read_jdbc(spark, url, query='select "id" from leads where "id" < 0', parallel=('"id"', 4), **driver)
    assert none.count() == 0
    asked = readers.read_jdbc(spark, url, query='select "id" from leads where "id" >= 40', limit=5, **driver)
    assert asked.count() == 5 and all(r[0] >= 40 for r in asked.collect())


def test_a_cluster_needs_a_shared_folder(spark):
    from types import SimpleNamespace

    import pytest

    from ledgerloom.sources.folders import work_folder

    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_folder(cluster, "x")
