"""Golden tables of the relational operators."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.validate import contact_features
from ledgerloom.operators import aggregates, dedup, joins, ml, monitoring, quality, restructure, schema, scoring


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_minimal_export(spark):
    df = spark.createDataFrame([("00123456789", "Example One", "old@example.com", "2024-01-01"), ("00123456789", "Example One", "new@example.com", "2024-02-01"), ("00987654321", "Example Two", "two@example.com", "2024-01-15")], "cpf string, nome string, email string, data_cadastro string")
    out = contact_features(dedup.dedup_latest(df)).select("cpf", "email", "data_quality_score")
    assert rows(out, "cpf") == [("00123456789", "new@example.com", 2), ("00987654321", "two@example.com", 2)]


def test_latest_by_key_and_quirks(spark):
    score = spark.createDataFrame([("1", "a", 5, 0), ("1", "b", 9, 1), (None, "c", 1, 2)], "cpf string, email string, data_quality_score int, pos int")
    assert rows(dedup.dedup_latest(score, tie=["pos"]).select("cpf", "email")) == [("1", "a")]
    dates = spark.createDataFrame([("1", "not a date", 0), ("1", "2020-01-01", 1), ("2", None, 2)], "CNPJ string, data string, pos int")
    assert rows(dedup.dedup_latest(dates, tie=["pos"]).select("CNPJ", "pos"), "pos") == [("1", 1), ("2", 2)]
    assert dedup.dedup_latest(score, tie=["pos"], keep_null=True).count() == 2
    no_key = spark.createDataFrame([(1,), (1,)], "x int")
    assert dedup.dedup_latest(no_key).count() == 2


def test_complete_then_newest(spark):
    df = spark.createDataFrame([("1", "a", None, 0), ("1", "a", "x", 1), (None, "q", None, 2), (None, "r", None, 3)], "cpf string, email string, cargo string, pos int")
    assert rows(dedup.dedup_complete(df, tie=["pos"]).select("pos"), "pos") == [(1,), (2,), (3,)]


def test_entities(spark):
    df = spark.createDataFrame([(1, "11.222.333/0001-81", "https://www.acme.com/x", "Acme"), (2, "11222333000181", None, "ACME SA"), (3, None, "http://acme.com", "Acme"), (4, None, None, "Ácme"), (5, None, None, None)], "id int, cnpj string, site string, nome string")
    keys = {r.id: r.fingerprint for r in df.withColumn("fingerprint", dedup.fingerprint(df, "company")).collect()}
    assert keys[1] == keys[2] == "cnpj:11222333000181" and keys[3] == "site:acme.com" and keys[4] == "name:acme" and keys[5].startswith("row:")
    assert dedup.resolve_entities(df, "company", "2024-01-01", tie=["id"]).count() == 4


def test_upserts(spark):
    t = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, x string, y int")
    n = spark.createDataFrame([(2, None, 9), (3, "c", 3)], "k int, x string, y int")
    assert rows(joins.upsert(t, n, "k"), "k") == [(1, "a", 1), (2, None, 9), (3, "c", 3)]
    assert rows(joins.upsert(t, n, "k", ["y"]), "k") == [(1, "a", 1), (2, "b", 9), (3, "c", 3)]
    assert rows(joins.upsert_coalesce(t, n, "k"), "k") == [(1, "a", 1), (2, "b", 9), (3, "c", 3)]
    assert rows(joins.insert_absent(t, n.unionByName(n), ["k"]), "k") == [(1, "a", 1), (2, "b", 2), (3, "c", 3)]
    summary, samples = joins.reconcile(t, n, "k")
    assert rows(summary) == [(1, 1, 1)] and rows(samples, "k") == [(1, "missing"), (3, "extra")]


def test_company_summary_does_not_multiply(spark):
    c = spark.createDataFrame([(1,), (2,)], "company_id int")
    k = spark.createDataFrame([(1,), (1,)], "company_id int")
    v = spark.createDataFrame([(1, 5.0, dt.date(2020, 1, 1)), (1, 7.0, dt.date(2021, 1, 1))], "company_id int, valuation double, date date")
    p = spark.createDataFrame([(1, 10.0), (1, 10.0)], "company_id int, amount double")
    out = joins.company_summary(c, k, v, p)
    assert rows(out.select("company_id", "n_contacts", "n_valuations", "latest_valuation", "total_paid"), "company_id") == [(1, 2, 2, 7.0, 20.0), (2, 0, 0, None, 0.0)]


def test_schema(spark):
    df = spark.createDataFrame([("1", "Ana", "z")], "`#` string, `Nome completo` string, `Cor favorita` string")
    out = schema.map_schema(df)
    assert out.select("id_unico", "nome_completo", "extra_cor_favorita", "cpf").first() == ("1", "Ana", "z", None)
    assert schema.normalise_names(spark.createDataFrame([(1, 2, 3)], "`E-mail!` int, `Ação` int, `e mail` int")).columns == ["e_mail", "acao", "e_mail_2"]
    renamed, report = schema.rename_map(df, {"#": "id", "zzz": "q"})
    assert renamed.columns[0] == "id" and {r.source: r.mapped for r in report.collect()}["zzz"] is False
    assert schema.drop_empty_rows(spark.createDataFrame([(None, " "), ("a", None)], "a string, b string"), True).count() == 1
    big = spark.createDataFrame([(1.5, 1e300), (None, 2.0)], "a double, b double")
    assert dict(schema.downcast(big).dtypes) == {"a": "float", "b": "double"}
    assert schema.ensure_columns(df, ["x", "#"]).first()["x"] == ""


def test_documents(spark):
    doc = '{"id": "9", "valuations.a.date": "25/12/2020", "valuations.a.amount": "R$ 1.000,50", "valuations.a.paid": "true", "valuations.b.date": "2020-01-01", "other": "x"}'
    df = spark.createDataFrame([("9", None, doc), ("8", "m@x.com", "{}")], "id string, email string, doc string")
    out = restructure.project_payments(df)
    assert [(r.valuation_id, str(r.payment_amount), r.payment_status, r.customer_email) for r in out.orderBy("valuation_id").collect()] == [("a", "1000.50", True, "9"), ("b", "0.00", False, "9")]
    flat = spark.createDataFrame([("1", "acme ltda", "100,5", "true")], "id string, `overview.company` string, `financials.currentDebt` string, privacy string")
    r = restructure.project_valuations(flat).first()
    assert (r.company_name, float(r.current_debt), r.privacy_accepted, r.city) == ("Acme Ltda", 100.5, True, None)
    nested = spark.createDataFrame([("1", 1700000000000, (("acme", "SP"), "x"), {"a": "1"})], "id string, timestamp long, overview struct<a: struct<company: string, state: string>, state: string>, scorecard map<string,string>")
    n = restructure.project_nested_valuations(nested).first()
    assert n.method == "CRM" and n.state == "x" and n.company is None
    assert restructure.flatten(nested).columns == ["id", "timestamp", "overview_a_company", "overview_a_state", "overview_state", "scorecard"]
    arr = spark.createDataFrame([(1, [("a", 1), ("b", 2)]), (2, [])], "id int, rs array<struct<n: string, v: int>>")
    assert rows(restructure.explode_records(arr, "rs", ["id"]), "id", "v") == [(1, "a", 1), (1, "b", 2), (2, None, None)]
    one = spark.createDataFrame([("a, b,c",), ("short,x",), ("1,2,3,4",)], "line string")
    assert rows(restructure.explode_single_column(one, "line", ["p", "q", "r", "s"]), "p") == [("1", "2", "3", "4"), ("a", "b", "c", None)]
    crm = spark.createDataFrame([("7", "Empreendedor", "25/12/2020", "10,00", "Sim, pretende", "5,00", None), ("8", "x", None, "1", None, None, None)], "ID string, `Tipo de Valuation` string, `Data de Valuation` string, Resultado_Valuation string, Pretende_Captar string, MRR string, Faturamento_LTM string")
    values, snaps = restructure.project_financials(crm)
    assert [(r.valuation_type, r.fundraising_interest) for r in values.collect()] == [("sense", True)] and [float(r.arr) for r in snaps.collect()] == [60.0]


def test_misc_documents_and_contacts(spark):
    links = spark.createDataFrame([("1", "u", "A@B.com", "PAID", "10,50", "2020-01-01")], "id string, url string, email string, status string, amount string, createdAt string")
    assert float(restructure.project_misc(links, "links").first().amount) == 10.5
    talks = spark.createDataFrame([("1", "n", "e", "2020-01-01", True, ["q", "r"])], "id string, name string, email string, createdAt string, consent boolean, questions array<string>")
    assert restructure.project_misc(talks, "interactions").first().n_questions == 2
    crm = spark.createDataFrame([("1", "acme", "Ana LIMA", "ana@x.com", "11987654321"), ("2", "b", "c", None, None)], "ID string, `Nome da Startup` string, `Nome do Respondente` string, Email string, Telefone string")
    assert rows(restructure.project_contacts(crm).select("full_name", "phone")) == [("Ana Lima", "(11) 98765-4321")]
    assert restructure.project_companies(crm, "2024-01-01").count() == 2
    both = restructure.all_valuations(spark.createDataFrame([("1", 5, "2020-01-01"), ("1", 5, "2020-01-01")], "valuation_id string, v int, valued_at string"), spark.createDataFrame([("2", 5, "2021-01-01")], "valuation_id string, v int, valued_at string"))
    assert rows(both.select("valuation_id")) == [("2",)]


def test_counts_and_bins(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), (None, 3.0), ("b", 4.0)], "s string, x double")
    assert rows(aggregates.value_counts(df, "s").select("value", "n")) == [("a", 2), ("b", 1), (None, 1)]
    assert [r.band for r in aggregates.cut_equal(df, "x", ["lo", "hi"]).orderBy("x").collect()] == ["lo", "lo", "hi", "hi"]
    assert aggregates.cut_equal(spark.createDataFrame([(1.0,)], "x double"), "x", ["a", "b"]).first().band == "a"
    same = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-01")], "k int, d string")
    assert aggregates.assert_load(same, "k", "d", "2024-01-01").count() == 2
    with pytest.raises(ValueError, match="other days"):
        aggregates.assert_load(same, "k", "d", "2024-01-02")
    with pytest.raises(ValueError, match="repeat"):
        aggregates.assert_load(same.unionByName(same), "k", "d", "2024-01-01")
    none = df.limit(0)
    assert aggregates.value_counts(none, "s").count() == 0 and aggregates.describe_numeric(none, ["x"]).first().n == 0
    assert rows(aggregates.filled_distinct(spark.createDataFrame([(None,), (0,), (1,)], "x int")), "x") == [(0,), (1,)]


def test_imputation_limits(spark):
    df = spark.createDataFrame([(1.0, "a", None, None)] * 3 + [(None, None, "z", None)] + [(3.0, "a", None, None)] * 6, "x double, s string, rare string, empty string")
    out = aggregates.impute(df)
    assert out.filter("x is null or s is null").count() == 0 and out.filter("rare is null").count() == 9 and out.filter("empty is null").count() == 10


def test_scores(spark):
    lead = spark.createDataFrame([("1", 6000.0, "a@empresa.com", "CEO", "Tecnologia", "São Paulo", dt.datetime(2024, 5, 30), "Site"), ("2", None, None, None, None, None, None, None)], "id string, valor_estimado double, email string, cargo string, segmento string, regiao string, data_cadastro timestamp, fonte string")
    out = {r.id: (r.score, r.status) for r in scoring.score_rules(lead, as_of="2024-06-01 00:00:00").collect()}
    assert out["1"] == (pytest.approx(100 + 45 + 72 + 52.5 + 20 + 25 * 5 / 7 * 1.2 + 15, abs=0.01), "qualificado") and out["2"] == (0.0, "frio")
    bands = spark.createDataFrame([(0,), (30,), (31,), (85,), (100,)], "s int")
    assert [r.score_band for r in scoring.score_bands(bands, "s").orderBy("s").collect()] == [None, "Cold", "Cool", "Hot", "Premium"]
    rules = scoring.add_rule(scoring.RULES, scoring.ScoringRule("Valor Alto", "valor_estimado", ">", 1, 1))
    assert len(rules) == len(scoring.RULES) and rules[-1].points == 1
    quality_of = scoring.lead_quality(spark.createDataFrame([("Ana", "a@b.com", None)], "nome_completo string, email string, submit_date date"), "2024-06-01").first()
    assert quality_of.score_recencia == pytest.approx(1 / (1 + 999 / 30)) and quality_of.completude_criticos == 0.5


def test_insights_and_advice(spark):
    df = spark.createDataFrame([(False, 10, 5, dt.date(2024, 3, 1), "A")] * 3 + [(True, 80, 1, dt.date(2024, 1, 1), "B")], "ok boolean, e int, r int, d date, s string")
    found = scoring.insights(df, "ok", "e", "r", "d", "s")
    assert {r.insight: r.value for r in found.collect()} == {"invalid_email": 0.75, "low_engagement": 0.75, "large_accounts": 3.0, "peak_month": 3.0, "concentration": 0.75}
    roi = spark.createDataFrame([(1.0,)], "ltv_cac double")
    share, bands = spark.createDataFrame([("A", 0.5)], "s string, share double"), spark.createDataFrame([(3, 0, 0)], "high int, medium int, low int")
    assert {r.area for r in scoring.recommendations(roi, share, bands, found).collect()} == {"roi", "segments", "conversion", "quality"}


def test_profiles_and_drift(spark):
    df = spark.createDataFrame([(1, "a@b.com", None), (2, "c@d.com", "x")], "id int, mail string, note string")
    p = quality.profile(df, "s", "2024-01-01")
    facts = {r.column: (r.nullable, r.n_distinct, r.pattern) for r in p.collect()}
    assert facts == {"id": (False, 2, None), "mail": (False, 2, "email"), "note": (True, 1, None)}
    assert quality.diff_profiles(p, p).count() == 0
    assert quality.drift_report(quality.diff_profiles(p, p)).first() == (0, 0.0, False, "none")
    later = quality.profile(df.drop("note"), "s", "2024-02-01")
    history = p.unionByName(later).unionByName(quality.profile(df, "s2", "2024-03-01"))
    assert {r.column for r in quality.latest_profile(history, "s").collect()} == {"id", "mail"}
    assert [r.changed for r in quality.drift_history(history, "s", 400, "2024-06-01").orderBy("run_ts").collect()] == [False, True]
    assert quality.profile(df, "s", "2024-01-01", approximate=False).count() == 3


def test_monitoring(spark):
    runs = [(dt.datetime(2024, 1, d), "p", 100, 10.0, 50.0, 0.99) for d in range(1, 21)] + [(dt.datetime(2024, 1, 25), "p", 100, 99.0, 2000.0, 0.5)]
    m = spark.createDataFrame(runs, "timestamp timestamp, pipeline_name string, records_processed long, processing_time_seconds double, memory_usage_mb double, success_rate double").withColumn("latency_ms", F.lit(1.0))
    found = monitoring.metric_anomalies(m, monitoring.metric_baseline(m))
    assert {(r.metric, r.severity, r.action) for r in found.collect()} == {("processing_time_seconds", "critical", "tune queries and resources"), ("memory_usage_mb", "critical", "look for leaks"), ("success_rate", "critical", "look into failed runs")}
    kinds = sorted(r.alert_type for r in monitoring.alerts(m, found).collect())
    assert kinds == ["anomaly_detected"] * 3 + ["critical_error_rate", "memory_spike"]
    flagged = monitoring.run_anomalies(m, ["processing_time_seconds", "memory_usage_mb"], 0.05).filter("is_anomaly = 1")
    assert [r.timestamp.day for r in flagged.collect()] == [25]
    done = monitoring.run_metrics(m, "job", 0.0, 2.0, "success_rate < 0.8").first()
    assert (done.records_processed, done.error_count, done.throughput_records_per_sec) == (21, 1, 10.5)


def test_quality_reports(spark):
    df = spark.createDataFrame([("1", "a", None), ("1", "a", "x"), (None, "b", "y"), (None, " ", None)], "k string, v string, w string")
    assert quality.duplicate_report(df, ["k"]).first() == (4, 4, 100.0, 2)
    assert rows(quality.duplicate_examples(df, ["k"]).select("n")) == [(2,), (2,)]
    assert {r.column: r.filled for r in aggregates.completeness(df).collect()} == {"k": 2, "v": 3, "w": 2}
    empty = df.limit(0)
    assert quality.duplicate_report(empty, ["k"]).first() == (0, 0, 0.0, 0) and aggregates.completeness(empty).first().percent == 0.0


def test_models(spark, tmp_path):
    data = [(i, float(i % 50), "x" if i % 50 > 25 else "y", "Alta" if i % 50 > 25 else "Baixa") for i in range(300)]
    df = spark.createDataFrame(data, "id int, a double, s string, label string")
    model, facts = ml.train_lead_model(df, "label", "id", trees=5, depth=3)
    assert facts["auc"] > 0.95
    ml.save_model(model, str(tmp_path / "m"))
    again = ml.predict(df, ml.load_model(str(tmp_path / "m")), facts["numbers"], facts["texts"])
    assert again.filter("(qualidade_predita = 'Alta') <> (label = 'Alta')").count() <= 15 and again.filter("confianca_predicao not between 0 and 1").count() == 0
    unseen = spark.createDataFrame([(1, 3.0, None, None), (2, 40.0, "never seen", None)], df.schema)
    assert ml.predict(unseen, model, facts["numbers"], facts["texts"]).count() == 2
    few = ml.impute_model(spark.createDataFrame([(1.0, 2.0), (None, 5.0), (3.0, 1.0)], "t double, a double"), "t", ["a"])
    assert few.filter("t is null").count() == 0


def test_percentiles_are_exact(spark, monkeypatch):
    import random

    import numpy as np
    from pyspark.sql import functions as F

    from ledgerloom.operators import aggregates

    rnd = random.Random(3)
    rows = [(rnd.choice([rnd.gauss(0, 1), rnd.lognormvariate(0, 4), 7.0, None]), i % 5 if i % 3 else None, None) for i in range(4000)]
    df = spark.createDataFrame(rows, "x double, y int, z double").repartition(4)
    for accuracy in (10_000, 200):  # with the second, most rows are outside the brackets
        monkeypatch.setattr(aggregates, "ACCURACY", accuracy)
        got = {r["column"]: r["q"] for r in aggregates.percentiles(df, {c: F.col(c) for c in "xyz"}, [0.0, 0.1, 0.5, 0.9, 1.0]).collect()}
        assert set(got) == {"x", "y"}
        for c, k in (("x", 0), ("y", 1)):
            assert np.allclose(got[c], np.quantile([r[k] for r in rows if r[k] is not None], [0.0, 0.1, 0.5, 0.9, 1.0]), rtol=1e-12)


def test_rows_without_date_or_tie_are_kept_by_their_hash(spark):
    from ledgerloom.operators.dedup import dedup_latest

    df = spark.createDataFrame([("1", f"v{i}") for i in range(40)], "cpf string, v string")
    assert len({dedup_latest(df.repartition(n)).first().v for n in (1, 3, 7)}) == 1
