"""Models whose work must not depend on how a table lies in files."""

import random
import threading

import pytest

from ledgerloom.operators import ml


@pytest.fixture(scope="module")
def noisy(spark):
    """A thousand rows, one partition: the target is a, the other columns are noise."""
    rnd = random.Random(3)
    return spark.createDataFrame([(i, *[rnd.uniform(0, 100) for _ in range(6)]) for i in range(1000)], "id long, a double, b double, c double, d double, e double, f double").coalesce(1)


def test_regressions_choose_among_all_columns(noisy):
    _, facts = ml.train_ltv(noisy, "a", "id", list("abcdef"), trees=10)
    assert facts["mae"] < 2.5  # a tree of depth 5 cuts the range into 32 parts


class Stop(Exception):
    pass


def fits(name, df):
    y = df.withColumn("y", df.a > 50).withColumn("q", (df.a > 50).cast("int").cast("string"))
    calls = {
        "train_lead_model": lambda: ml.train_lead_model(y, "q", "id", ["a", "b"], []),
        "train_forest": lambda: ml.train_forest(y, "y", "id", ["a", "b"], 3),
        "train_ltv": lambda: ml.train_ltv(y, "a", "id", ["b", "c"], 3),
        "compare_models": lambda: ml.compare_models(y, "y", "id", ["a", "b"]),
        "tune": lambda: ml.tune(y, "y", ["a", "b"], parallelism=1),
        "select_features": lambda: ml.select_features(y, "y", "id", ["a", "b"], 1),
        "impute_model": lambda: ml.impute_model(y, "a", ["b", "c"]),
    }
    return calls[name]()


@pytest.mark.parametrize("name", ["train_lead_model", "train_forest", "train_ltv", "compare_models", "tune", "select_features", "impute_model"])
def test_no_partition_holds_the_training_data(noisy, monkeypatch, name):
    seen = []

    def record(self, dataset, params=None):
        seen.extend(dataset.rdd.glom().map(len).collect())
        raise Stop

    monkeypatch.setattr(ml, "ROWS", 100, raising=False)
    monkeypatch.setattr(ml.Pipeline, "fit", record)
    with pytest.raises(Stop):
        fits(name, noisy)
    assert 600 < sum(seen) <= 1000 and max(seen) < 200


def test_fits_do_not_depend_on_how_a_table_lies(noisy, monkeypatch):
    monkeypatch.setattr(ml, "ROWS", 100, raising=False)
    one, two = (fits("train_forest", df)[1] for df in (noisy, noisy.repartition(7)))
    assert one == two


def test_rows_alike_in_the_columns_are_spread(spark, monkeypatch):
    monkeypatch.setattr(ml, "ROWS", 100, raising=False)
    df = spark.range(1000).selectExpr("id", "1.0D as x")
    with ml.dealt(df, "x", by=df.columns) as kept:
        assert max(kept.rdd.glom().map(len).collect()) < 200


class Fitted:
    def transform(self, df):
        return df


@pytest.mark.parametrize(("cells", "parts"), [(1_000_000, 1), (600, 3), (1, 8)])
def test_linear_models_on_few_columns_take_few_large_tasks(noisy, monkeypatch, cells, parts):
    seen = {}

    def record(self, dataset, params=None):
        seen[type(self.getStages()[-1]).__name__, len(self.getStages())] = dataset.rdd.glom().map(len).collect()
        return Fitted()

    monkeypatch.setattr(ml, "ROWS", 100)
    monkeypatch.setattr(ml, "CELLS", cells, raising=False)
    monkeypatch.setattr(ml.Pipeline, "fit", record)
    monkeypatch.setattr(ml, "auc", lambda predicted: 1.0)
    ml.compare_models(noisy.filter("id < 800").withColumn("y", noisy.a > 50), "y", "id", ["a", "b"])
    assert len({sum(n) for n in seen.values()}) == 1
    assert {k: len(n) for k, n in seen.items()} == {("RandomForestClassifier", 3): 8, ("GBTClassifier", 3): 8, ("LogisticRegression", 3): parts, ("LinearSVC", 3): parts, ("LinearSVC", 4): 8}


def test_linear_models_are_fitted_side_by_side(noisy, monkeypatch):
    met = threading.Barrier(3, timeout=20)

    def record(self, dataset, params=None):
        if isinstance(self.getStages()[-1], (ml.LogisticRegression, ml.LinearSVC)):
            met.wait()
        return Fitted()

    monkeypatch.setattr(ml.Pipeline, "fit", record)
    monkeypatch.setattr(ml, "auc", lambda predicted: 1.0)
    assert set(ml.compare_models(noisy.withColumn("y", noisy.a > 50), "y", "id", ["a", "b"])[2]) == {"random_forest", "boosted_trees", "logistic", "linear_svm", "rbf_svm"}
