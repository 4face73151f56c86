"""Ties, grouped percentiles, nested structures, isolation forests, kernel machines and united profiles."""

import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import aggregates, dedup, forests, ml, monitoring, quality, restructure

SF = "/root/testdata/sf0.001"


def test_ties_do_not_depend_on_the_order_of_rows(spark):
    rows = [("11122233344", "2024-01-01", None, "p", 1.0), ("11122233344", "2024-01-01", "p", None, 1.0), ("5", "2024-01-01", "a", "b", 1.0), ("5", "2024-01-01", "b", "a", 1.0)] + [("6", "2024-01-01", f"x{i}", "y", 1.0) for i in range(30)]
    schema = "cpf string, data string, email string, nome string, valor double"
    jobs = {
        "W1": lambda d: dedup.dedup_latest(d, "cpf", "data"), "W2": lambda d: dedup.dedup_complete(d, "cpf", "data"), "W3": lambda d: dedup.dedup_best(d, "cpf", "data", "valor"),
        "W4": lambda d: dedup.resolve_entities(d.drop("email").withColumnRenamed("cpf", "telefone"), "contact", "2024-06-01", "data"), "W5": lambda d: dedup.dedup_group_best(d, ["cpf"]),
        "W6": lambda d: dedup.dedup_last(d, ["cpf"], ["data"]), "W8": lambda d: dedup.dedup_ignore_dates(d.withColumn("data", F.to_date("data")).withColumn("hora", F.col("nome")).drop("nome", "email"), "data"),
    }
    for name, job in jobs.items():
        found = set()
        for seed in range(3):
            shuffled = list(rows)
            random.Random(seed).shuffle(shuffled)
            out = job(spark.createDataFrame(shuffled, schema).repartition(1 + seed))
            found.add(tuple(sorted(map(repr, out.collect()))))
        assert len(found) == 1, name
    both = spark.createDataFrame([(1, None, "p"), (1, "p", None)], "k int, a string, b string")
    assert both.select(dedup.row_hash(both)).distinct().count() == 2


def test_grouped_percentiles(spark, monkeypatch):
    monkeypatch.setattr(aggregates, "ACCURACY", 200)  # so that small groups have brackets too
    rnd = np.random.default_rng(4)
    rows = [("hot", float(x)) for x in rnd.normal(0, 1, 6000)] + [("ties", float(x)) for x in rnd.integers(0, 3, 3000)] + [(None, float(x)) for x in rnd.exponential(9, 1500)] + [("one", 5.0), ("two", 1.0), ("two", 4.0), ("none", None)]
    rows += [("wide", float(x)) for x in range(7000)] + [("nan", x) for x in [math.nan, 1.0, 2.0]]
    p = [0.0, 0.25, 0.5, 0.9, 1.0]
    out = {r.g: (r.n, r.q) for r in aggregates.grouped_percentiles(spark.createDataFrame(rows, "g string, v double").repartition(7), ["g"], "v", p).collect()}
    assert set(out) == {"hot", "ties", None, "one", "two", "wide", "nan"}
    for g, (n, q) in out.items():
        own = sorted(v for k, v in rows if k == g)
        assert n == len(own)
        if g != "nan":
            assert q == pytest.approx(np.quantile(own, p).tolist(), rel=1e-12, abs=1e-12), g
    assert aggregates.grouped_percentiles(spark.createDataFrame([], "g string, v double"), ["g"], "v", p).count() == 0


def test_percentiles_of_columns(spark, monkeypatch):
    monkeypatch.setattr(aggregates, "ACCURACY", 100)
    rnd = np.random.default_rng(5)
    rows = [(float(a), int(b), None, float(c) if c < 1 else math.nan if c > 2 else math.inf) for a, b, c in zip(rnd.normal(0, 9, 20_000), rnd.integers(0, 4, 20_000), rnd.exponential(1, 20_000), strict=True)]
    df = spark.createDataFrame(rows, "a double, b int, c double, d double").repartition(6)
    p = [0.0, 0.1, 0.5, 0.75, 1.0]
    out = {r.column: r.q for r in aggregates.percentiles(df, {c: F.col(c) for c in "abcd"}, p).collect()}
    assert set(out) == {"a", "b", "d"}
    for c, k in (("a", 0), ("b", 1)):
        assert out[c] == pytest.approx(np.quantile([r[k] for r in rows], p).tolist(), rel=1e-12)
    own = sorted((r[3] for r in rows), key=lambda v: (math.isnan(v), v))
    assert out["d"][:2] == pytest.approx([own[0], own[1999] + 0.9 * (own[2000] - own[1999])]) and math.isnan(out["d"][4])


def test_no_group_of_the_baseline_is_held_in_one_task(spark):
    rows = [("hot", i, float(i % 977)) for i in range(9000)] + [(f"p{i % 40}", i, float(i)) for i in range(18000)]
    metrics = spark.createDataFrame(rows, "pipeline_name string, error_count long, latency_ms double")
    out = {(r.pipeline_name, r.metric): r for r in monitoring.metric_baseline(metrics).collect()}
    assert len(out) == 82
    for (name, metric), r in out.items():
        own = [x[1 if metric == "error_count" else 2] for x in rows if x[0] == name]
        assert (r.q25, r.q75) == pytest.approx(tuple(np.quantile(own, [0.25, 0.75]))) and r.mean == pytest.approx(np.mean(own))
    plan = monitoring.metric_baseline(metrics)._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile(" not in plan


def walked(value, depth, path=""):
    """(path, type) of everything inside, by recursion."""
    if not depth or not isinstance(value, (dict, list)):
        return []
    out = []
    for key, x in value.items() if isinstance(value, dict) else enumerate(value):
        here = f"{path}[]" if isinstance(value, list) else f"{path}.{key}" if path else key
        kind = "null" if x is None else {bool: "boolean", int: "integer", float: "number", str: "string", dict: "object", list: "array"}[type(x)]
        out += [(here, kind), *walked(x, depth - 1, here)]
    return out


@pytest.mark.parametrize("depth", [1, 3, 6])
def test_structure_of_nested_documents(spark, depth):
    docs = [{"a": {"b": [{"c": 1}, {"c": "x", "d": [[1.5], []]}]}, "e": None}, {"a": [1, 2.5, True, {"b": {}}], "é f": False}, [{"z": 1}], 7, {}, {"a": {"b": {"c": {"d": {"e": {"f": 1}}}}}}]
    rows = [(json.dumps(d),) for d in docs] + [(None,), ("no json {",), ("",)]
    out = {(r.path, r.type): r.n for r in restructure.json_structure(spark.createDataFrame(rows, "doc string"), "doc", depth).collect()}
    want = {}
    for d in docs:
        for x in walked(d, depth):
            want[x] = want.get(x, 0) + 1
    assert out == want


def test_structure_reads_documents_once(spark):
    out = restructure.json_structure(spark.createDataFrame([('{"a": [1]}',)], "doc string"), "doc", 6)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1


def test_structure_counts_each_node_once(spark):
    docs = [{}, [], [[]], {"a": {}, "b": [{}, [], None, {"c": [[], [{}]]}]}, [None, [None, {"x": [1, [2, {"y": []}]]}]], {"": {"": 1}, "z": [1e300, 1.0, -1, "{", "[", "null", "true", ""]}]
    out = {(r.path, r.type): r.n for r in restructure.json_structure(spark.createDataFrame([(json.dumps(d),) for d in docs], "doc string"), "doc", 8).collect()}
    want = {}
    for d in docs:
        for x in walked(d, 8):
            want[x] = want.get(x, 0) + 1
    assert out == want


def test_structure_of_a_long_array_is_linear_work(spark):
    doc = json.dumps({"a": [{"b": i, "c": "x" * (i % 5)} for i in range(100_000)]})
    out = {(r.path, r.type): r.n for r in restructure.json_structure(spark.createDataFrame([(doc,)], "doc string"), "doc", 4).collect()}
    assert out == {("a", "array"): 1, ("a[]", "object"): 100_000, ("a[].b", "integer"): 100_000, ("a[].c", "string"): 100_000}


def test_flattened_names_are_unlike(spark):
    df = spark.range(1).select(F.struct(F.lit(1).alias("b")).alias("a"), F.lit(2).alias("a_b"), F.struct(F.lit(3).alias("B_2")).alias("A"))
    out = restructure.flatten(spark.createDataFrame(df.collect(), "a struct<b int>, a_b int, x struct<b int>"))
    assert out.columns == ["a_b", "a_b_2", "x_b"] and tuple(out.first()) == (1, 2, 3)


def test_unpivoting_takes_linear_work(spark):
    import time

    def doc(n):
        return json.dumps({f"valuations.id{i:06d}.{f}": f"{f}{i}" for i in range(n) for f in ("date", "amount") if (i + len(f)) % 3} | {"name": "x", "valuations.id000001.other": "no", "valuations..date": "no"})

    def run(n):
        df = spark.createDataFrame([(1, doc(n))], "id int, doc string")
        began = time.perf_counter()
        out = {r.entry_id: (r.date, r.amount) for r in restructure.unpivot_keys(df, "doc", "valuations", ["date", "amount"]).collect()}
        return out, time.perf_counter() - began

    small, _ = run(50)
    assert small == {f"id{i:06d}": (f"date{i}" if (i + 4) % 3 else None, f"amount{i}" if (i + 6) % 3 else None) for i in range(50)}
    _, few = run(5_000)
    out, many = run(50_000)
    assert len(out) == 50_000 and many < 30 * few + 5


def walk(tree, x):
    """A tree's path for one row, node by node."""
    feature, threshold, length = tree
    node = 0
    while node < len(feature):
        node = 2 * node + (1 if x[feature[node]] < threshold[node] else 2)
    return length[node - len(feature)]


def test_isolation_forest(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.gauss(0, 1), rnd.gauss(5, 2), None if i % 50 == 0 else float(i % 7)) for i in range(3000)] + [(10_000 + i, 30.0 + i, -40.0 - i, 90.0) for i in range(5)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double")
    forest = forests.fit_forest(df, ["a", "b", "c"], trees=60, sample=128)
    out = forests.isolation_scores(df, forest).collect()
    for r in out:
        x = [forest.fill[k] if v is None else v for k, v in enumerate((r.a, r.b, r.c))]
        path = sum(walk(t, x) for t in zip(forest.feature, forest.threshold, forest.length, strict=True)) / 60
        assert r.path_length == pytest.approx(path) and r.anomaly_score == pytest.approx(2 ** (-path / forests.mean_path(128)))
    assert {r.id for r in sorted(out, key=lambda r: -r.anomaly_score)[:5]} == {10_000 + i for i in range(5)}
    again = forests.fit_forest(df.repartition(5), ["a", "b", "c"], trees=60, sample=128)
    assert (again.threshold == forest.threshold).all() and (again.length == forest.length).all()
    flagged = forests.flag_isolated(df, ["a", "b", "c"], share=0.01, trees=60, sample=128)
    assert flagged.filter("is_anomaly").count() <= 31 and flagged.filter("is_anomaly and id >= 10000").count() == 5
    alike = spark.createDataFrame([(1, 2.0)] * 9, "id int, a double")
    assert forests.isolation_scores(alike, forests.fit_forest(alike, ["a"])).select("anomaly_score").distinct().count() == 1
    assert forests.isolation_scores(alike.limit(0), forests.fit_forest(alike.limit(0), ["a"])).count() == 0


def test_leaves_know_what_they_hide():
    x = np.random.default_rng(1).normal(size=(64, 2))
    feature, threshold, length = forests.grow(x, 6, np.random.default_rng(2))

    def check(node, level, rows):
        own = [walk((feature, threshold, length), x[r]) for r in rows]
        if node >= len(feature) or np.isinf(threshold[node]):
            assert all(v == pytest.approx(level + forests.mean_path(len(rows))) for v in own)
            return
        left = x[rows, feature[node]] < threshold[node]
        assert 0 < left.sum() < len(rows)
        check(2 * node + 1, level + 1, rows[left])
        check(2 * node + 2, level + 1, rows[~left])

    check(0, 0, np.arange(64))


def test_kernel_machine_tells_a_ring_from_its_centre(spark, tmp_path):
    rnd = random.Random(6)
    rows = []
    for i in range(600):
        r, t = (rnd.uniform(2, 3) if i % 2 else rnd.uniform(0, 1)), rnd.uniform(0, 2 * math.pi)
        rows.append((i, r * math.cos(t), r * math.sin(t), float(i % 2)))
    df = spark.createDataFrame(rows, "id int, x double, y double, label double")
    train, test = df.filter("id < 450"), df.filter("id >= 450")
    model = ml.kernel_machine(["x", "y"]).fit(train)
    assert ml.auc(model.transform(test)) > 0.97
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LinearSVC
    from pyspark.ml.feature import VectorAssembler

    linear = Pipeline(stages=[VectorAssembler(inputCols=["x", "y"], outputCol="features"), LinearSVC(maxIter=50)]).fit(train)
    assert ml.auc(linear.transform(test)) < 0.75
    w, b = model.stages[2].weights()
    scaled = model.stages[1].transform(model.stages[0].transform(test))
    made = model.stages[2].transform(scaled).first()
    assert made["features"].toArray() == pytest.approx(np.sqrt(2 / len(b)) * np.cos(w @ made["_scaled"].toArray() + b))
    model.stages[2].write().overwrite().save(str(tmp_path / "f"))
    assert (forests.FourierFeatures.load(str(tmp_path / "f")).weights()[0] == w).all()


def test_united_profiles_equal_the_whole(spark):
    df = spark.read.parquet(f"{SF}/lineitem.parquet").select("l_shipdate", "l_quantity", "l_returnflag", F.when(F.col("l_linenumber") > 1, F.col("l_tax")).alias("l_tax"), F.lit(None).cast("double").alias("empty"))
    parts = quality.partial_profiles(df, "lineitem", F.date_format("l_shipdate", "yyyy-MM"))
    united = {r.column: r for r in quality.united_profile(parts).collect()}
    whole = {r.column: r for r in quality.profile(df, "lineitem", "2024-06-01", approximate=False).collect()}
    assert set(united) == set(whole)
    for c, r in united.items():
        w = whole[c]
        assert (r.dtype, r.nullable, r.rows, r.nulls, r.min_value, r.max_value) == (w.dtype, w.nullable, w.rows, w.nulls, w.min_value, w.max_value)
        assert r.mean_length == w.mean_length and abs(r.n_distinct - w.n_distinct) <= 1 + quality.SKETCH_ERROR * w.n_distinct
    some = quality.united_profile(parts.filter("load between '1995-01' and '1995-06'"))
    assert {r.rows for r in some.collect()} == {df.filter("l_shipdate >= '1995-01-01' and l_shipdate < '1995-07-01'").count()}
    assert united["empty"].median is None and abs(united["l_quantity"].median - 25) <= 3


def test_metrics_are_observed_while_a_job_writes(spark, tmp_path):
    build = lambda session: session.range(1000).withColumn("even", F.col("id") % 2 == 0)
    done = monitoring.write_measured(spark, build, str(tmp_path / "out"), "job", "even").first()
    assert (done.pipeline_name, done.records_processed, done.error_count, done.success_rate) == ("job", 1000, 500, 0.5)
    assert done.throughput_records_per_sec > 0 and spark.read.parquet(str(tmp_path / "out")).count() == 1000
    empty = monitoring.write_measured(spark, lambda session: build(session).limit(0), str(tmp_path / "none"), "job", "even").first()
    assert (empty.records_processed, empty.success_rate) == (0, 1.0)
    df = spark.createDataFrame([(i, float(i % 7), float(i % 2)) for i in range(200)], "id int, x double, label double")
    model, _ = ml.train_forest(df, "label", "id", ["x"], 3)  # a session that was observed itself could not
    assert model.transform(ml.prepared(df, ["x"], [])).count() == 200
