"""Models (M4 to M9, M12 to M14) on customers whose targets follow from their numbers: what a fitted model must have found is
said in SQL. Labels are derived from the whole table; z is noise."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import ml
from .base import query, table

NUMBERS = ["x", "y", "z"]
BOTH = "x > 2000 and y > 30"


def numbered(spark, sf_dir) -> DataFrame:
    """Customers with x (their balance), y (0 to 100) and z (noise), from their keys."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(key, F.col("c_acctbal").cast("double").alias("x"), (F.pmod(key * 7919, F.lit(1000)) / 10.0).alias("y"), F.pmod(key * 104729, F.lit(997)).cast("double").alias("z"))


def one_row(df: DataFrame, **facts: bool) -> DataFrame:
    return df.agg(F.count("*").alias("n"), *[F.lit(bool(v)).alias(k) for k, v in facts.items()])


@query("select count(*) as n, true as tells_labels, true as leaves_noise from customer")
def held_conversion(spark, sf_dir):
    """M4."""
    df = numbered(spark, sf_dir).withColumn("label", F.expr(BOTH))
    _, facts = ml.train_conversion(df, "label", "c_custkey", NUMBERS)
    return one_row(df, tells_labels=facts["auc"] > 0.95 and facts["f1"] > 0.9, leaves_noise=facts["importance"]["z"] < 0.1 < min(facts["importance"]["x"], facts["importance"]["y"]))


@query("select count(*) as n, true as precise, true as complete from customer")
def held_churn(spark, sf_dir):
    """M6."""
    df = numbered(spark, sf_dir).withColumn("label", F.col("y") < 40)
    _, facts = ml.train_churn(df, "label", "c_custkey", NUMBERS)
    return one_row(df, precise=facts["precision"] > 0.95, complete=facts["recall"] > 0.95)


@query("select count(*) as n, true as near, true as ordered from customer")
def held_ltv(spark, sf_dir):
    """M5: the mean error is under a fourth of the spread."""
    df = numbered(spark, sf_dir).withColumn("worth", 20000 + 3 * F.col("x") + 100 * F.col("y"))
    _, facts = ml.train_ltv(df, "worth", "c_custkey", NUMBERS, trees=20)
    spread = df.agg(F.stddev_pop("worth")).first()[0]
    return one_row(df, near=facts["mae"] < spread / 4, ordered=facts["quartiles"] == sorted(facts["quartiles"]) and facts["quartiles"][0] < facts["quartiles"][2])


@query("select c_custkey % 3 as planted, count(*) as n, 1::bigint as segments, 3::bigint as all_segments from customer group by 1")
def held_segments(spark, sf_dir):
    """M7: three clouds far apart are the three segments."""
    g = F.col("c_custkey") % 3
    df = numbered(spark, sf_dir).select("c_custkey", g.alias("planted"), (g * 1000 + F.col("x") / 1000).alias("a"), (g * -500 + F.col("y") / 100).alias("b"))
    out, _ = ml.segment(df, ["a", "b"], 3)
    groups = out.groupBy("planted", "segment").agg(F.count("*").alias("n"))  # at most nine rows
    total = groups.agg(F.countDistinct("segment").alias("all_segments"))
    return groups.groupBy("planted").agg(F.sum("n").alias("n"), F.count("*").alias("segments")).crossJoin(F.broadcast(total))


@query("select count(*) as n, true as best_tells_labels, true as kernel_beats_linear from customer")
def held_comparison(spark, sf_dir):
    """M8: a label inside of a ring, which no straight line tells."""
    df = numbered(spark, sf_dir).withColumns({"u": (F.col("x") - 4500) / 5500, "v": (F.col("y") - 50) / 50}).withColumn("label", F.expr("u * u + v * v < 0.5"))
    _, _, scores = ml.compare_models(df, "label", "c_custkey", ["u", "v"])
    return one_row(df, best_tells_labels=max(scores.values()) > 0.95, kernel_beats_linear=scores["rbf_svm"] > scores["linear_svm"] + 0.2)


@query("select count(*) as n, true as tells_labels from customer")
def held_tuning(spark, sf_dir):
    """M9."""
    df = numbered(spark, sf_dir).withColumn("label", F.expr(BOTH))
    _, areas = ml.tune(df, "label", NUMBERS, {"numTrees": [5, 20], "maxDepth": [2, 5]})
    return one_row(df, tells_labels=max(areas) > 0.95 and len(areas) == 4)


@query("select count(*) as n, count(*) filter (where c_custkey % 10 <> 0) as kept, true as near from customer")
def held_imputation(spark, sf_dir):
    """A tenth of the values is taken away, and found again from another column to a tenth of their range."""
    df = numbered(spark, sf_dir).withColumn("truth", 5 + 2 * F.col("y"))
    out = ml.impute_model(df.withColumn("t", F.when(F.col("c_custkey") % 10 != 0, F.col("truth"))), "t", ["y", "z"])
    gone = F.col("c_custkey") % 10 == 0
    error = F.avg(F.when(gone, F.abs(F.col("t") - F.col("truth"))))
    return out.agg(F.count("t").alias("n"), F.count_if(~gone & (F.col("t") == F.col("truth"))).alias("kept"), F.coalesce(error < 20, F.lit(False)).alias("near"))


@query("select count(*) as n, count(*) filter (where x > 3000 and y > 40) as sure, count(*) filter (where x > 3000 and y > 40) as high, count(*) filter (where x < 1000 or y < 20) as off, count(*) filter (where x < 1000 or y < 20) as low from (select c_acctbal as x, (c_custkey * 7919) % 1000 / 10.0 as y from customer)")
def held_analysis(spark, sf_dir):
    """Scores of a fitted model, in bands: customers well inside of the label are in the upper ones, those well outside in
    the lower ones."""
    df = numbered(spark, sf_dir).withColumn("label", F.expr(BOTH))
    model, _ = ml.train_conversion(df, "label", "c_custkey", NUMBERS)
    out = ml.analyse_leads(df, {"conversion": model}, NUMBERS)
    inside, outside, up = F.expr("x > 3000 and y > 40"), F.expr("x < 1000 or y < 20"), F.col("conversion_band").isin("high", "very high")
    return out.agg(F.count("*").alias("n"), F.count_if(inside).alias("sure"), F.count_if(inside & up).alias("high"), F.count_if(outside).alias("off"), F.count_if(outside & ~up).alias("low"))


@query("select count(*) as n, 'x,y' as chosen, true as tells_labels from customer")
def held_features(spark, sf_dir):
    """Of five columns the two that the label rests on."""
    df = numbered(spark, sf_dir).withColumns({"w": F.pmod(F.col("c_custkey") * 15485863, F.lit(1009)).cast("double"), "label": F.expr(BOTH)})
    _, names, score = ml.select_features(df, "label", "c_custkey", ["z", "x", "w", "y"], 2)
    return one_row(df, tells_labels=score > 0.95).withColumn("chosen", F.lit(",".join(sorted(names))))
