"""Models on tables with MLlib."""

from __future__ import annotations

import contextlib
import math
from collections.abc import Iterator
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import FeatureHasher, StandardScaler, UnivariateFeatureSelector, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, functions as F

from .aggregates import numeric, percentiles
from .forests import FourierFeatures

#: Texts that mean a good lead.
POSITIVE = ("alta", "sim", "1", "high")
#: Rows of a partition of training data. A forest of 100 trees keeps 1 to 2 kB a row, so a task reads some tens of MB of them.
ROWS = 25_000
#: Numbers in a partition of a linear model on few columns, 8 bytes each. It takes a hundred short jobs or more to fit one, so
#: that tasks of ROWS rows would spend their time on being started.
CELLS = 1_000_000


@contextlib.contextmanager
def dealt(df: DataFrame, *cols: str, by: list[str] | None = None) -> Iterator[DataFrame]:
    """These columns of all rows, kept while a model is fitted, in partitions of about ROWS rows each: a file may come as one
    partition, however large it is. Rows are dealt by the hash of these columns, or of those `by` that hashes take (so that rows
    alike in few columns are spread), and put in order, so fits don't depend on how the table lies."""
    own = [F.col(f"`{c}`") for c in dict.fromkeys(cols)]
    placed = set(by or cols)
    place = F.xxhash64(*[F.col(f"`{c}`") for c, t in df.dtypes if c in placed and "map<" not in t and t != "variant"])
    parts = max(1, math.ceil(df.count() / ROWS))
    data = df.select(*own, place.alias("_place")).repartition(parts, "_place").sortWithinPartitions(*own).drop("_place").persist()
    try:
        yield data
    finally:
        data.unpersist()


def label_of(col: str):
    return F.lower(F.trim(F.col(f"`{col}`").cast("string"))).isin(*POSITIVE).cast("double")


def split(df: DataFrame, key: str, label: str, test: float = 0.2, small: int = 10) -> tuple[DataFrame, DataFrame]:
    """By a hash of key and label, so that reruns agree and both labels are cut alike; under `small` rows both are all."""
    if df.limit(small).count() < small:
        return df, df
    place = F.pmod(F.xxhash64(F.col(key), F.col(label)), F.lit(1000)) / 1000.0
    return df.filter(place >= test), df.filter(place < test)


def encode(df: DataFrame, cols: list[str]) -> DataFrame:
    """Texts upper and trimmed, blanks DESCONHECIDO."""
    return df.withColumns({c: F.coalesce(F.nullif(F.upper(F.trim(F.col(f"`{c}`").cast("string"))), F.lit("")), F.lit("DESCONHECIDO")) for c in cols})


def feature_stages(df: DataFrame, numbers: list[str], texts: list[str]) -> list:
    """Scaled numbers and texts, all in `features`. Texts are hashed to 256 places, of any number of values alike, so that
    no size of a table changes how they are encoded."""
    stages, parts = [], []
    if numbers:
        stages += [VectorAssembler(inputCols=numbers, outputCol="_numbers", handleInvalid="keep"), StandardScaler(inputCol="_numbers", outputCol="_scaled", withMean=False)]
        parts.append("_scaled")
    if texts:
        stages.append(FeatureHasher(inputCols=texts, outputCol="_hashed", numFeatures=256))
        parts.append("_hashed")
    return [*stages, VectorAssembler(inputCols=parts, outputCol="features", handleInvalid="keep")]


def prepared(df: DataFrame, numbers: list[str], texts: list[str]) -> DataFrame:
    """Numbers as doubles without nulls, texts by encode()."""
    return encode(df.withColumns({c: F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) for c in numbers}), texts)


def with_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced class weights."""
    one = df.agg(F.count("*").alias("_n"), F.sum(label).alias("_p"))  # one row
    weight = F.when(F.col(label) == 1, F.col("_n") / (2 * F.greatest(F.col("_p"), F.lit(1.0)))).otherwise(F.col("_n") / (2 * F.greatest(F.col("_n") - F.col("_p"), F.lit(1.0))))
    return df.crossJoin(F.broadcast(one)).withColumn("_weight", weight).drop("_n", "_p")


def auc(predicted: DataFrame, label: str = "label") -> float:
    return BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction").evaluate(predicted)


def train_lead_model(df: DataFrame, target: str, key: str, numbers: list[str] | None = None, texts: list[str] | None = None, trees: int = 100, depth: int = 5) -> tuple[PipelineModel, dict]:
    """M1: a balanced random forest on scaled numbers and encoded texts; AUC on a held-out part."""
    numbers = numbers if numbers is not None else [c for c in numeric(df) if c not in (target, key)]
    texts = texts if texts is not None else [c for c, t in df.dtypes if t == "string" and c not in (target, key)]
    data = with_weights(prepared(df.withColumn("label", label_of(target)), numbers, texts), "label")
    forest = RandomForestClassifier(labelCol="label", featuresCol="features", weightCol="_weight", numTrees=trees, maxDepth=depth, seed=42)
    with dealt(data, key, *numbers, *texts, "label", "_weight") as kept:
        train, test = split(kept, key, "label")
        model = Pipeline(stages=[*feature_stages(train, numbers, texts), forest]).fit(train)
        return model, {"auc": auc(model.transform(test)), "numbers": numbers, "texts": texts}


def save_model(model: PipelineModel, path: str) -> None:
    """M2."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def predict(df: DataFrame, model: PipelineModel, numbers: list[str], texts: list[str]) -> DataFrame:
    """M3: qualidade_predita (Alta or Baixa) and confianca_predicao, the probability of Alta."""
    out = model.transform(prepared(df, numbers, texts))
    p = vector_to_array("probability")[1]
    return out.withColumns({"qualidade_predita": F.when(p >= 0.5, "Alta").otherwise("Baixa"), "confianca_predicao": p}).select(*df.columns, "qualidade_predita", "confianca_predicao")


def train_forest(df: DataFrame, label: str, key: str, numbers: list[str], trees: int, depth: int = 5) -> tuple[PipelineModel, dict]:
    data = prepared(df, numbers, []).withColumn("label", F.col(label).cast("double"))
    stages = [VectorAssembler(inputCols=numbers, outputCol="features"), RandomForestClassifier(labelCol="label", numTrees=trees, maxDepth=depth, seed=42)]
    named = {"precision": "precisionByLabel", "recall": "recallByLabel", "f1": "f1"}
    with dealt(data, key, *numbers, "label") as kept:
        train, test = split(kept, key, "label")
        model = Pipeline(stages=stages).fit(train)
        out = model.transform(test)
        metrics = {n: MulticlassClassificationEvaluator(labelCol="label", metricName=m, metricLabel=1.0).evaluate(out) for n, m in named.items()}
        return model, metrics | {"auc": auc(out), "importance": dict(zip(numbers, model.stages[-1].featureImportances.toArray().tolist(), strict=True))}


def train_conversion(df: DataFrame, label: str, key: str, numbers: list[str]) -> tuple[PipelineModel, dict]:
    """M4: 100 trees of depth 5; precision, recall, F1, AUC and importances."""
    return train_forest(df, label, key, numbers, 100)


def train_churn(df: DataFrame, label: str, key: str, numbers: list[str]) -> tuple[PipelineModel, dict]:
    """M6: 50 trees."""
    return train_forest(df, label, key, numbers, 50)


def train_ltv(df: DataFrame, target: str, key: str, numbers: list[str], trees: int = 50, depth: int = 5) -> tuple[PipelineModel, dict]:
    """M5: a forest of regressions; MAE, MAPE over values that aren't 0, and quartiles of the predictions. Every split chooses
    among all columns, as the reference's regressor does: of a third of a few columns it would often see noise alone."""
    data = prepared(df, numbers, []).withColumn("label", F.col(target).cast("double")).filter("label is not null")
    stages = [VectorAssembler(inputCols=numbers, outputCol="features"), RandomForestRegressor(labelCol="label", numTrees=trees, maxDepth=depth, featureSubsetStrategy="all", seed=42)]
    with dealt(data, key, *numbers, "label") as kept:
        train, test = split(kept, key, "label")
        model = Pipeline(stages=stages).fit(train)
        out = model.transform(test)
        facts = out.agg(F.avg(F.when(F.col("label") != 0, F.abs((F.col("label") - F.col("prediction")) / F.col("label")))).alias("mape"), F.percentile("prediction", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q")).first()
        return model, {"mae": RegressionEvaluator(metricName="mae").evaluate(out), "mape": facts["mape"], "quartiles": facts["q"]}


def segment(df: DataFrame, numbers: list[str], k: int = 5) -> tuple[DataFrame, DataFrame]:
    """M7: k-means on scaled numbers: the table with its segment, and the segments' sizes, means and names (by the first
    number: above 1.2 times the mean premium, under 0.8 times basic, else standard)."""
    data = prepared(df, numbers, [])
    stages = [VectorAssembler(inputCols=numbers, outputCol="_numbers"), StandardScaler(inputCol="_numbers", outputCol="features", withMean=True), KMeans(k=k, seed=42, predictionCol="segment")]
    out = Pipeline(stages=stages).fit(data).transform(data).select(*df.columns, "segment")
    means = out.groupBy("segment").agg(F.count("*").alias("n"), *[F.avg(c).alias(f"mean_{c}") for c in numbers])
    overall = out.agg(F.avg(numbers[0]).alias("_m"))  # one row
    name = F.when(F.col(f"mean_{numbers[0]}") > 1.2 * F.col("_m"), "premium").when(F.col(f"mean_{numbers[0]}") < 0.8 * F.col("_m"), "basic").otherwise("standard")
    return out, means.crossJoin(F.broadcast(overall)).withColumn("name", name).drop("_m")


def compare_models(df: DataFrame, label: str, key: str, numbers: list[str]) -> tuple[str, PipelineModel, dict[str, float]]:
    """M8: random forest, boosted trees, logistic regression, and support vector machines, linear and with a Gaussian kernel (of
    one over the number of columns), by random Fourier features; the best AUC wins. Forests fill the cluster one by one; the
    others are fitted side by side, since the short jobs of one leave most of it idle."""
    data = prepared(df, numbers, []).withColumn("label", F.col(label).cast("double"))
    stages = [VectorAssembler(inputCols=numbers, outputCol="_numbers"), StandardScaler(inputCol="_numbers", outputCol="features", withMean=True)]
    own = lambda m: Pipeline(stages=[*stages, m])
    forests = {"random_forest": own(RandomForestClassifier(numTrees=50, seed=42)), "boosted_trees": own(GBTClassifier(maxIter=10, seed=42))}
    with dealt(data, key, *numbers, "label") as kept:
        train, test = split(kept, key, "label")
        few = train.coalesce(math.ceil(train.rdd.getNumPartitions() / max(1, CELLS // (ROWS * len(numbers)))))
        others = {"logistic": (own(LogisticRegression(maxIter=50)), few), "linear_svm": (own(LinearSVC(maxIter=50)), few), "rbf_svm": (kernel_machine(numbers), train)}
        fitted = {n: m.fit(train) for n, m in forests.items()}
        with ThreadPool(len(others)) as pool:
            fit = inheritable_thread_target(df.sparkSession)(lambda m: m[0].fit(m[1]))
            fitted |= zip(others, pool.map(fit, others.values(), 1), strict=True)
        scores = {n: auc(m.transform(test)) for n, m in fitted.items()}
    best = max(scores, key=scores.get)
    return best, fitted[best], scores


def kernel_machine(numbers: list[str], features: int = 200, gamma: float | None = None) -> Pipeline:
    """Scaled numbers, their random Fourier features, and a linear support vector machine on these."""
    fourier = FourierFeatures(inputCol="_scaled", outputCol="features", width=len(numbers), features=features, gamma=gamma or 1.0 / len(numbers))
    return Pipeline(stages=[VectorAssembler(inputCols=numbers, outputCol="_numbers"), StandardScaler(inputCol="_numbers", outputCol="_scaled", withMean=True), fourier, LinearSVC(maxIter=50)])


def tune(df: DataFrame, label: str, numbers: list[str], grid: dict[str, list] | None = None, folds: int = 3, parallelism: int = 2) -> tuple[PipelineModel, list[float]]:
    """M9: a grid of forest settings by cross-validated AUC."""
    data = prepared(df, numbers, []).withColumn("label", F.col(label).cast("double"))
    forest = RandomForestClassifier(seed=42)
    build = ParamGridBuilder()
    for name, values in (grid or {"numTrees": [20, 50], "maxDepth": [3, 5]}).items():
        build = build.addGrid(getattr(forest, name), values)
    own = Pipeline(stages=[VectorAssembler(inputCols=numbers, outputCol="features"), forest])
    search = CrossValidator(estimator=own, estimatorParamMaps=build.build(), evaluator=BinaryClassificationEvaluator(), numFolds=folds, parallelism=parallelism, seed=42)
    with dealt(data, *numbers, "label", by=data.columns) as kept:
        found = search.fit(kept)
    return found.bestModel, list(found.avgMetrics)


def flag_outliers(df: DataFrame, cols: list[str], share: float = 0.1, name: str = "outlier", distance: str = "outlier_distance") -> DataFrame:
    """The share of rows farthest from the mean in standard scores; `forests.flag_isolated` takes an isolation forest. Nulls and
    columns without spread add nothing."""
    facts = df.agg(*[f(F.col(c).cast("double")).alias(f"_{n}{i}") for i, c in enumerate(cols) for n, f in (("m", F.avg), ("s", F.stddev_pop))])  # one row
    parts = [F.coalesce(F.when(F.col(f"_s{i}") > 0, F.pow((F.col(c) - F.col(f"_m{i}")) / F.col(f"_s{i}"), F.lit(2))), F.lit(0.0)) for i, c in enumerate(cols)]
    out = df.crossJoin(F.broadcast(facts)).withColumn(distance, F.sqrt(sum(parts, F.lit(0.0)))).drop(*facts.columns)
    limit = percentiles(out, {"d": F.col(distance)}, [1 - share]).agg(F.max(F.col("q")[0]).alias("_limit"))  # one row
    return out.crossJoin(F.broadcast(limit)).withColumn(name, (F.col(distance) > F.col("_limit")).cast("int")).drop("_limit")


def impute_model(df: DataFrame, target: str, numbers: list[str], least: int = 10) -> DataFrame:
    """Null targets from a small forest on the other numbers; the median when under `least` rows have a target."""
    data = prepared(df, numbers, [])
    known = df.filter(F.col(target).isNotNull())
    if known.limit(least).count() < least:
        one = percentiles(df, {"v": F.col(target)}, [0.5]).agg(F.max(F.col("q")[0]).alias("_v"))  # one row
        return df.crossJoin(F.broadcast(one)).withColumn(target, F.coalesce(F.col(target).cast("double"), "_v")).drop("_v")
    stages = [VectorAssembler(inputCols=numbers, outputCol="features"), RandomForestRegressor(labelCol=target, numTrees=10, maxDepth=3, featureSubsetStrategy="all", seed=42)]
    with dealt(data.filter(F.col(target).isNotNull()).withColumn(target, F.col(target).cast("double")), *numbers, target, by=df.columns) as kept:
        model = Pipeline(stages=stages).fit(kept)
    keep = df.columns
    raw = [F.col(f"`{c}`").alias(f"_raw_{c}") for c in numbers]
    out = model.transform(prepared(df.select("*", *raw), numbers, []))
    return out.withColumn(target, F.coalesce(F.col(target).cast("double"), "prediction")).withColumns({c: F.col(f"_raw_{c}") for c in numbers if c != target}).select(*keep)


def analyse_leads(df: DataFrame, models: dict[str, PipelineModel], numbers: list[str]) -> DataFrame:
    """<name>_score of each model (probability, or prediction of a regression) and <name>_band at 0.3, 0.6, 0.8; persona."""
    out = prepared(df, numbers, [])
    for name, model in models.items():
        scored = model.transform(out)
        value = vector_to_array("probability")[1] if "probability" in scored.columns else F.col("prediction")
        extra = [c for c in scored.columns if c not in out.columns]
        out = scored.withColumn(f"{name}_score", value).drop(*extra)
        x = F.col(f"{name}_score")
        out = out.withColumn(f"{name}_band", F.when(x > 0.8, "very high").when(x > 0.6, "high").when(x > 0.3, "medium").otherwise("low"))
    first = next(iter(models))
    return out.withColumn("persona", F.when(F.col(f"{first}_score") > 0.7, "champion").when(F.col(f"{first}_score") > 0.4, "prospect").otherwise("observer"))


def select_features(df: DataFrame, label: str, key: str, numbers: list[str], k: int = 13) -> tuple[PipelineModel, list[str], float]:
    """The k numbers that tell the label best on the training part; the model is then fitted on both parts."""
    data = prepared(df, numbers, []).withColumn("label", F.col(label).cast("double"))
    assembled = VectorAssembler(inputCols=numbers, outputCol="all_features")
    chooser = UnivariateFeatureSelector(featuresCol="all_features", outputCol="features", labelCol="label", selectionMode="numTopFeatures")
    chooser = chooser.setFeatureType("continuous").setLabelType("categorical").setSelectionThreshold(min(k, len(numbers)))
    with dealt(data, key, *numbers, "label") as kept:
        train, valid = split(kept, key, "label")
        picked = chooser.fit(assembled.transform(train))
        names = [numbers[i] for i in sorted(picked.selectedFeatures)]
        stages = [VectorAssembler(inputCols=names, outputCol="features"), RandomForestClassifier(numTrees=50, seed=42)]
        score = auc(Pipeline(stages=stages).fit(train).transform(valid))
        return Pipeline(stages=stages).fit(train.unionByName(valid)), names, score
