"""Counts, indicators, statistics and bins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import Window as W

from ..functions.validate import is_blank
from ..sources.folders import work_folder


def numeric(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if t in ("tinyint", "smallint", "int", "bigint", "float", "double") or t.startswith("decimal")]


#: Quantile summaries of this accuracy bracket a percentile; what lies inside the bracket is counted exactly. Size of a sketch
#: of a whole column: its ranks are within 0.0001 of the rows, a quarter of what brackets allow for (at most some MB).
ACCURACY, SKETCH = 10_000, 65_000


def percentiles(df: DataFrame, values: dict[str, Column], probabilities: list[float]) -> DataFrame:
    """Exact percentiles (linear between neighbours) of whole columns: a row for each name in `values`, with `q`, an array
    in the order of `probabilities`; columns without values have no row.

    A mergeable summary brackets each percentile; one pass counts what lies below the bracket, and only the distinct
    values inside it, a thousandth of the rows or so, are put in order. So no task holds a column.
    """
    names = list(values)
    cells = df.select(*[x.cast("double").alias(f"x{k}") for k, x in enumerate(values.values())])
    margin = 4.0 / ACCURACY
    ends = F.array(*[F.lit(min(1.0, max(0.0, p + d))) for p in probabilities for d in (-margin, margin)])
    known = lambda k: F.when(F.isnan(f"x{k}"), F.lit(float("inf"))).otherwise(F.col(f"x{k}"))  # sketches pass over nan
    sketch = lambda k: F.when(F.count(f"x{k}") > 0, F.kll_sketch_get_quantile_double(F.kll_sketch_agg_double(known(k), SKETCH), ends))
    marks = cells.agg(*[f for k in range(len(names)) for f in (F.count(f"x{k}").alias(f"n{k}"), sketch(k).alias(f"m{k}"))]).first()  # one row
    every = [(k, i) for k in range(len(names)) for i in range(len(probabilities))]
    # summaries depend on the order in which they are merged, so brackets are fixed before they are used twice
    open_below = {(k, i): marks[f"n{k}"] <= ACCURACY or probabilities[i] <= margin for k, i in every}
    open_above = {(k, i): marks[f"n{k}"] <= ACCURACY or probabilities[i] >= 1 - margin for k, i in every}
    low = {(k, i): float("-inf") if open_below[k, i] else marks[f"m{k}"][2 * i] for k, i in every}
    high = {(k, i): float("nan") if open_above[k, i] or marks[f"m{k}"][2 * i + 1] == float("inf") else marks[f"m{k}"][2 * i + 1] for k, i in every}  # nan is above all
    below = cells.agg(*[F.count_if(F.col(f"x{k}") < F.lit(low[k, i])).alias(f"b{k}_{i}") for k, i in every])  # one row
    facts = below.select(F.inline(F.array(*[F.struct(F.lit(names[k]).alias("column"), F.lit(i).alias("i"), F.lit((marks[f"n{k}"] - 1) * probabilities[i]).alias("rank"), F.col(f"b{k}_{i}").alias("below")) for k, i in every])))
    hit = lambda k, i: (F.col(f"x{k}") >= F.lit(low[k, i])) & (F.col(f"x{k}") <= F.lit(high[k, i]))
    inside = cells.select(F.inline(F.array(*[F.when(hit(k, i), F.struct(F.lit(names[k]).alias("column"), F.lit(i).alias("i"), F.col(f"x{k}").alias("value"))) for k, i in every]))).filter("value is not null")
    counted = inside.groupBy("column", "i", "value").agg(F.count("*").alias("times")).join(F.broadcast(facts), ["column", "i"])
    ordered = counted.withColumn("upto", F.sum("times").over(W.partitionBy("column", "i").orderBy("value")) + F.col("below"))
    at = lambda r: F.min(F.when(F.col("upto") > r, F.col("value")))
    found = ordered.groupBy("column", "i", "rank").agg(at(F.floor("rank")).alias("a"), at(F.ceil("rank")).alias("b"), F.min(F.col("upto") - F.col("times")).alias("before"))
    sure = F.when((F.col("before") <= F.floor("rank")) & F.col("b").isNotNull(), F.lit(True)).otherwise(F.raise_error(F.lit("a percentile is outside its bracket")).cast("boolean"))
    mixed = F.when(F.col("a") == F.col("b"), F.col("a")).otherwise((F.ceil("rank") - F.col("rank")) * F.col("a") + (F.col("rank") - F.floor("rank")) * F.col("b"))
    return found.groupBy("column").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", F.when(sure, mixed).alias("v")))), lambda s: s["v"]).alias("q"))


#: Parts of a bracket that are counted before any is put in order.
PARTS = 64


def grouped_percentiles(df: DataFrame, keys: list[str], value: str, probabilities: list[float]) -> DataFrame:
    """Exact percentiles (linear between neighbours) of each group: its keys, n and `q`, an array in the order of
    `probabilities`. A null key is a group; nulls of the value don't count; groups without values have no row.

    Mergeable summaries bracket each percentile of each group; one pass counts what lies below the bracket (one cell, summed
    before it is shuffled) and the values inside. The bracket is cut into parts that are counted, and only the values of the
    part with the rank are put in order: some hundred-thousandths of a large group. Values are dealt by themselves, not by
    group, so a group with most of the rows is spread like others. Values in brackets are written to the shared folder.
    """
    own = [F.col(f"`{k}`") for k in keys]
    rows = df.select(*own, F.col(f"`{value}`").cast("double").alias("_x")).filter("_x is not null")
    margin = 4.0 / ACCURACY
    ends = F.array(*[F.lit(min(1.0, max(0.0, p + d))) for p in probabilities for d in (-margin, margin)])
    marks = rows.groupBy(*own).agg(F.count("_x").alias("_n"), F.percentile_approx("_x", ends, ACCURACY).alias("_m"))

    def bracket(i: int, p: float) -> Column:
        whole = F.col("_n") <= ACCURACY
        low = F.when(whole | F.lit(p <= margin), F.lit(float("-inf"))).otherwise(F.col("_m")[2 * i])
        high = F.when(whole | F.lit(p >= 1 - margin), F.lit(float("nan"))).otherwise(F.col("_m")[2 * i + 1])  # nan is above all
        return F.struct(F.lit(i).alias("_i"), ((F.col("_n") - 1) * p).alias("_rank"), low.alias("low"), high.alias("high"))

    brackets = marks.select(*own, F.array(*[bracket(i, p) for i, p in enumerate(probabilities)]).alias("_b"), "_n")

    def beside(left: DataFrame, right: DataFrame, names: list[str]) -> DataFrame:
        """An inner join in which null keys meet."""
        renamed = right.withColumnsRenamed({n: f"_right_{n}" for n in names})
        on = F.lit(True)
        for n in names:
            on = on & left[f"`{n}`"].eqNullSafe(renamed[f"`_right_{n}`"])
        return left.join(renamed, on).drop(*[f"_right_{n}" for n in names])

    hit = F.transform("_b", lambda b: F.when(F.col("_x") <= b["high"], F.struct(b["_i"].alias("_i"), b["_rank"].alias("_rank"), F.when(F.col("_x") >= b["low"], F.col("_x")).alias("_cell"))))
    place = [*keys, "_i"]
    cells = beside(rows, brackets, keys).select(*own, "_n", F.inline(F.filter(hit, lambda h: h.isNotNull()))).groupBy(*own, "_n", "_i", "_rank", "_cell").agg(F.count("*").alias("_times"))
    cuts = cells.groupBy(*own, "_i").agg(F.percentile_approx("_cell", F.array(*[F.lit(k / PARTS) for k in range(1, PARTS)]), 16 * PARTS).alias("_cuts"))
    # what lies below is part -1, before all others
    part = F.when(F.col("_cell").isNull(), -1).otherwise(F.size(F.filter("_cuts", lambda c: c < F.col("_cell"))))
    # summaries depend on the order in which they are merged: what they gave is written, and then read twice
    beside(cells, cuts, place).withColumn("_part", part).drop("_cuts").write.parquet(path := work_folder(df.sparkSession, "percentiles"))
    dealt = df.sparkSession.read.parquet(path)
    group = W.partitionBy(*own, "_i")
    counts = dealt.groupBy(*own, "_i", "_part").agg(F.sum("_times").alias("_t"), F.max("_rank").alias("_r")).withColumn("_s", F.sum("_t").over(group))  # at most PARTS + 1 rows a group
    upto = F.sum("_t").over(group.orderBy("_part"))
    sure = F.when((F.col("_s") > F.ceil("_r")) & ((F.col("_part") >= 0) | (F.col("_upto") <= F.floor("_r"))), F.col("_upto") - F.col("_t")).otherwise(F.raise_error(F.lit("a percentile is outside its bracket")).cast("long"))
    chosen = counts.withColumn("_upto", upto).withColumn("_before", sure).filter((F.col("_before") <= F.ceil("_r")) & (F.col("_upto") > F.floor("_r")))
    inside = beside(dealt.select(*own, "_n", "_i", "_rank", "_cell", "_times", "_part"), chosen.select(*own, "_i", "_part", "_before"), [*place, "_part"])
    ordered = inside.withColumn("_upto", F.sum("_times").over(group.orderBy("_cell")) + F.min("_before").over(group))
    at = lambda r: F.min(F.when(F.col("_upto") > r, F.col("_cell")))
    found = ordered.groupBy(*own, "_n", "_i", "_rank").agg(at(F.floor("_rank")).alias("_a"), at(F.ceil("_rank")).alias("_e"))
    mixed = F.when(F.col("_a") == F.col("_e"), F.col("_a")).otherwise((F.ceil("_rank") - F.col("_rank")) * F.col("_a") + (F.col("_rank") - F.floor("_rank")) * F.col("_e"))
    return found.groupBy(*own, F.col("_n").alias("n")).agg(F.transform(F.array_sort(F.collect_list(F.struct("_i", mixed.alias("v")))), lambda s: s["v"]).alias("q"))


def distinct_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, n_distinct) by hashes of 8 bytes: cells are cut down to distinct hashes before they are shuffled."""
    own = lambda c, t: F.col(f"`{c}`") if "<" not in t and t != "variant" else F.to_json(F.struct(F.col(f"`{c}`")))
    kinds = dict(df.dtypes)
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.when(F.col(f"`{c}`").isNotNull(), F.xxhash64(own(c, kinds[c]))).alias("h")) for c in cols])
    return df.select(F.inline(cells)).filter("h is not null").distinct().groupBy("column").agg(F.count("*").alias("n_distinct"))


def value_counts(df: DataFrame, col: str, k: int | None = None) -> DataFrame:
    """G1: value, n and percent of all rows, most frequent first, ties by value; null is a value."""
    counts = df.groupBy(F.col(f"`{col}`").alias("value")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))  # one row
    out = counts.crossJoin(F.broadcast(total)).select("value", "n", (F.col("n") * 100.0 / F.col("total")).alias("percent"))
    out = out.orderBy(F.desc("n"), F.col("value").asc_nulls_last())
    return out.limit(k) if k else out


def kpis(df: DataFrame, converted: str | Column, value: str, key: str) -> DataFrame:
    """One row: rows, distinct keys, converted rows, their rate, sum and mean of the value."""
    won = F.expr(converted) if isinstance(converted, str) else converted
    return df.agg(
        F.count("*").alias("total"), F.countDistinct(key).alias("n_keys"), F.count_if(won).alias("converted"),
        (F.count_if(won) / F.nullif(F.count("*"), F.lit(0))).alias("conversion_rate"), F.sum(value).alias("total_value"), F.avg(value).alias("mean_value"),
    )


def group_kpis(df: DataFrame, keys: list[str], measures: list[str], converted: str | None = None) -> DataFrame:
    """Count, mean and sum of each measure, and the rate of a condition, by group."""
    out = [F.count("*").alias("n")] + [f(m).alias(f"{n}_{m}") for m in measures for n, f in (("mean", F.avg), ("sum", F.sum))]
    if converted:
        out.append((F.count_if(F.expr(converted)) / F.count("*")).alias("rate"))
    return df.groupBy(*keys).agg(*out)


def funnel(df: DataFrame, stage: str, order: list[str]) -> DataFrame:
    """Rows of each stage in the given order, zeros included, with their share of the first stage."""
    stages = df.sparkSession.range(1).select(F.posexplode(F.array(*map(F.lit, order))).alias("position", "stage"))
    counts = df.groupBy(F.col(f"`{stage}`").alias("stage")).agg(F.count("*").alias("n"))
    out = stages.join(counts, "stage", "left").fillna(0, ["n"])
    first = F.max(F.when(F.col("position") == 0, F.col("n"))).over(W.partitionBy())  # one row a stage
    return out.withColumn("share_of_first", F.when(first > 0, F.col("n") / first)).orderBy("position")


def describe_numeric(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """A row for each column: n, mean, std, min, q25, median, q75, max, all exact."""
    cols = cols or numeric(df)
    own = []
    for i, c in enumerate(cols):
        x = F.col(f"`{c}`").cast("double")
        own.append(F.struct(F.lit(c).alias("column"), F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max")).alias(f"s{i}"))
    facts = df.agg(*own).select(F.inline(F.array(*[F.col(f"s{i}") for i in range(len(cols))])))
    q = percentiles(df, {c: F.col(f"`{c}`") for c in cols}, [0.25, 0.5, 0.75])
    return facts.join(F.broadcast(q), "column", "left").select("column", "n", "mean", "std", "min", F.col("q")[0].alias("q25"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q75"), "max")


def describe_categorical(df: DataFrame, cols: list[str], max_card: int = 50) -> DataFrame:
    """(column, value, n) of text columns with at most max_card values."""
    long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in cols]))).filter("value is not null")
    counts = long.groupBy("column", "value").agg(F.count("*").alias("n"))
    few = counts.groupBy("column").agg(F.count("*").alias("card")).filter(F.col("card") <= max_card)
    return counts.join(few, "column", "left_semi")


def money_report(df: DataFrame, cols: list[str]) -> DataFrame:
    """A row for each money column: valid, min, max, mean, median, total."""
    own = [F.struct(F.lit(c).alias("column"), F.count(F.col(c)).alias("valid"), F.min(F.col(c).cast("double")).alias("min"), F.max(F.col(c).cast("double")).alias("max"), F.avg(F.col(c).cast("double")).alias("mean"), F.sum(F.col(c).cast("double")).alias("total")).alias(f"s{i}") for i, c in enumerate(cols)]
    facts = df.agg(*own).select(F.inline(F.array(*[F.col(f"s{i}") for i in range(len(cols))])))
    q = percentiles(df, {c: F.col(c) for c in cols}, [0.5])
    return facts.join(F.broadcast(q), "column", "left").select("column", "valid", "min", "max", "mean", F.col("q")[0].alias("median"), "total")


def by_year(df: DataFrame, date: str) -> DataFrame:
    """Rows of each year with the first and last date."""
    return df.filter(F.col(date).isNotNull()).groupBy(F.year(date).alias("year")).agg(F.count("*").alias("n"), F.min(date).alias("first"), F.max(date).alias("last"))


def cohorts(df: DataFrame, date: str, engagement: str, converted: str, k: int = 6) -> DataFrame:
    """The last k months: size, mean engagement and conversion rate."""
    month = F.date_trunc("month", F.col(date)).cast("date").alias("month")
    return df.filter(F.col(date).isNotNull()).groupBy(month).agg(F.count("*").alias("size"), F.avg(engagement).alias("mean_engagement"), (F.count_if(F.expr(converted)) / F.count("*")).alias("conversion")).orderBy(F.desc("month")).limit(k)


def roi(df: DataFrame, investment: float, value: str, converted: str) -> DataFrame:
    """One row: customers, CAC, mean LTV, LTV / CAC, projected revenue, ROI percent, months to pay back."""
    won = F.expr(converted)
    one = df.agg(F.count_if(won).alias("customers"), F.avg(F.when(won, F.col(value))).alias("mean_ltv"), F.coalesce(F.sum(F.when(won, F.col(value))), F.lit(0.0)).alias("projected_revenue"))
    cac = F.lit(float(investment)) / F.nullif(F.col("customers"), F.lit(0))
    return one.select(
        "customers", cac.alias("cac"), "mean_ltv", (F.col("mean_ltv") / F.nullif(cac, F.lit(0.0))).alias("ltv_cac"), "projected_revenue",
        ((F.col("projected_revenue") - investment) * 100.0 / investment).alias("roi_percent"), (F.lit(12.0 * investment) / F.nullif(F.col("projected_revenue"), F.lit(0.0))).alias("payback_months"),
    )


def dedup_stats(df: DataFrame, key: str) -> DataFrame:
    """One row: rows with a key, keys, groups of more than one row, largest and mean group, rows that would go."""
    sizes = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    return sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count("*").alias("n_keys"), F.count_if(F.col("n") > 1).alias("duplicate_groups"), F.max("n").alias("max_group"), F.avg("n").alias("mean_group"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("removed"))


def field_presence(df: DataFrame, paths: dict[str, list[str]]) -> DataFrame:
    """Name -> expressions of a field (flat, nested); (field, present, min, mean, max) of the first that is there."""
    own = []
    for i, (name, exprs) in enumerate(paths.items()):
        x = F.coalesce(*[F.expr(e).try_cast("double") for e in exprs])
        own.append(F.struct(F.lit(name).alias("field"), F.count(x).alias("present"), F.min(x).alias("min"), F.avg(x).alias("mean"), F.max(x).alias("max")).alias(f"s{i}"))
    return df.agg(*own).select(F.inline(F.array(*[F.col(f"s{i}") for i in range(len(own))])))


def payment_totals(payments: DataFrame, key: str = "id", paid: str = "paid", amount: str = "amount") -> DataFrame:
    """Per document from rows of dynamic keys: whether any is paid, how many, and the sum of all amounts."""
    return payments.groupBy(key).agg(F.coalesce(F.max(F.col(paid).cast("boolean")), F.lit(False)).alias("any_paid"), F.count_if(F.col(paid).cast("boolean")).alias("n_paid"), F.coalesce(F.sum(F.col(amount).try_cast("double")), F.lit(0.0)).alias("total_amount"))


def impute(df: DataFrame, skip_above: float = 0.8, median_below: float = 0.3) -> DataFrame:
    """Nulls of text become the mode (the least of equally frequent values), of numbers the median when under 30 %
    are null; above 80 % nothing. Only the few filled-in values come to the driver."""
    numbers, texts = numeric(df), [c for c, t in df.dtypes if t == "string"]
    facts = df.agg(F.count("*").alias("_n"), *[F.count(F.col(f"`{c}`")).alias(f"n_{c}") for c in numbers + texts]).first()
    missing = {c: 1 - facts[f"n_{c}"] / facts["_n"] if facts["_n"] else 0.0 for c in numbers + texts}
    wanted = [c for c, share in missing.items() if 0 < share <= skip_above and (c in texts or share < median_below)]
    fill: dict = {}
    if own := [c for c in wanted if c in numbers]:
        fill |= {r["column"]: r["q"][0] for r in percentiles(df, {c: F.col(f"`{c}`") for c in own}, [0.5]).collect()}  # a row a column
    if own := [c for c in wanted if c in texts]:
        counts = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("value")) for c in own]))).filter("value is not null").groupBy("column", "value").agg(F.count("*").alias("n"))
        fill |= {r["column"]: r["m"]["value"] for r in counts.groupBy("column").agg(F.min(F.struct((-F.col("n")).alias("n"), "value")).alias("m")).collect()}  # a row a column
    kinds = dict(df.dtypes)
    return df.withColumns({c: F.coalesce(F.col(f"`{c}`"), F.lit(v).cast(kinds[c])) for c, v in fill.items()})


def flag_above_percentile(df: DataFrame, col: str, p: float, name: str = "flag") -> DataFrame:
    """1 where the value is above the exact percentile (linear between neighbours)."""
    limit = percentiles(df, {col: F.col(col)}, [p]).agg(F.max(F.col("q")[0]).alias("_limit"))  # one row
    return df.crossJoin(F.broadcast(limit)).withColumn(name, (F.col(col) > F.col("_limit")).cast("int")).drop("_limit")


def cut_equal(df: DataFrame, col: str, labels: list[str], name: str = "band") -> DataFrame:
    """Labels of equally wide bins over the values' range, closed on the right; the least value is in the first."""
    ends = df.agg(F.min(col).cast("double").alias("_lo"), F.max(col).cast("double").alias("_hi"))  # one row
    width = (F.col("_hi") - F.col("_lo")) / len(labels)
    place = F.when(width > 0, F.ceil((F.col(col) - F.col("_lo")) / width)).otherwise(1).cast("int")
    picked = F.element_at(F.array(*map(F.lit, labels)), F.greatest(F.lit(1), F.least(F.lit(len(labels)), place)))
    return df.crossJoin(F.broadcast(ends)).withColumn(name, F.when(F.col(col).isNotNull(), picked)).drop("_lo", "_hi")


def assert_load(df: DataFrame, key: str, date: str, day) -> DataFrame:
    """Raises unless the key is unique, nothing is null and all dates are on the one day; else `df`. One pass."""
    facts = df.agg(F.count("*").alias("n"), F.countDistinct(key).alias("k"), F.count_if(reduce(Column.__or__, (F.col(f"`{c}`").isNull() for c in df.columns))).alias("nulls"), F.count_if(F.to_date(date) != F.lit(day).cast("date")).alias("other")).first()
    wrong = [m for m, bad in (("keys repeat", facts["k"] != facts["n"] and not facts["nulls"]), ("values are null", facts["nulls"]), ("dates are of other days", facts["other"])) if bad]
    if wrong:
        raise ValueError("; ".join(wrong))
    return df


def data_dictionary(df: DataFrame, descriptions: dict[str, str] | None = None, exact: bool = False) -> DataFrame:
    """A row for each column: type, rows, non_null, nulls, completeness, distinct values (approximate in one pass, or
    exact) and the least and greatest as examples."""
    own = []
    for i, (c, t) in enumerate(df.dtypes):
        x = F.col(f"`{c}`")
        text = x.cast("string")
        distinct = F.lit(0).cast("long") if exact else F.approx_count_distinct(text)
        own.append(F.struct(F.lit(c).alias("column"), F.lit(t).alias("type"), F.count("*").alias("rows"), F.count(x).alias("non_null"), (F.count("*") - F.count(x)).alias("nulls"), (F.count(x) * 100.0 / F.count("*")).alias("completeness"), distinct.alias("n_distinct"), F.array_compact(F.array(F.min(text), F.max(text))).alias("examples"), F.lit((descriptions or {}).get(c)).cast("string").alias("description")).alias(f"s{i}"))
    out = df.agg(*own).select(F.inline(F.array(*[F.col(f"s{i}") for i in range(len(own))])))
    if not exact:
        return out
    counts = distinct_counts(df, df.columns)  # a row a column
    return out.drop("n_distinct").join(F.broadcast(counts), "column", "left").fillna(0, ["n_distinct"]).select(*out.columns)


def change_counts(before: DataFrame, after: DataFrame, key: str, cols: list[str] | None = None) -> DataFrame:
    """A row for each column: blank cells before and after, and cells changed, over rows with the same key."""
    cols = cols or [c for c in before.columns if c != key and c in after.columns]
    both = before.alias("a").join(after.alias("b"), key)
    blank = lambda x: x.isNull() | (F.trim(x.cast("string")) == "")
    own = [F.struct(F.lit(c).alias("column"), F.count_if(blank(F.col(f"a.{c}"))).alias("blank_before"), F.count_if(blank(F.col(f"b.{c}"))).alias("blank_after"), F.count_if(~F.col(f"a.{c}").cast("string").eqNullSafe(F.col(f"b.{c}").cast("string"))).alias("changed")).alias(f"s{i}") for i, c in enumerate(cols)]
    return both.agg(*own).select(F.inline(F.array(*[F.col(f"s{i}") for i in range(len(cols))])))


def zscore(df: DataFrame, cols: list[str]) -> DataFrame:
    """<col>_z; nulls and columns without spread give 0."""
    facts = df.agg(*[f(F.col(c).cast("double")).alias(f"_{n}{i}") for i, c in enumerate(cols) for n, f in (("m", F.avg), ("s", F.stddev))])  # one row
    out = df.crossJoin(F.broadcast(facts))
    return out.withColumns({f"{c}_z": F.coalesce(F.when(F.col(f"_s{i}") > 0, (F.col(c) - F.col(f"_m{i}")) / F.col(f"_s{i}")), F.lit(0.0)) for i, c in enumerate(cols)}).drop(*facts.columns)


def filled_distinct(df: DataFrame) -> DataFrame:
    """Nulls of numbers become 0, then distinct rows."""
    return df.fillna(0).distinct()


# --- T: order and top rows --------------------------------------------------------------------------------------------


def rank_leads(df: DataFrame, score: str, probability: str, value: str, churn: str, key: str, k: int = 20) -> DataFrame:
    """The k rows with the best 0.4 score / 100 + 0.3 probability + 0.2 value / greatest value + 0.1 (1 - churn)."""
    most = df.agg(F.max(F.col(value).cast("double")).alias("_most"))  # one row
    rank = 0.4 * F.col(score) / 100 + 0.3 * F.col(probability) + F.coalesce(0.2 * F.col(value) / F.nullif(F.col("_most"), F.lit(0.0)), F.lit(0.0)) + 0.1 * (1 - F.col(churn))
    return df.crossJoin(F.broadcast(most)).withColumn("ranking", rank).drop("_most").orderBy(F.desc("ranking"), key).limit(k)


def top_conversions(df: DataFrame, probability: str, key: str, k: int = 10) -> DataFrame:
    """T2."""
    return df.orderBy(F.col(probability).desc_nulls_last(), key).limit(k)


def probability_bands(df: DataFrame, probability: str) -> DataFrame:
    """One row: high over 0.7, medium from 0.4, low below."""
    p = F.col(probability)
    return df.agg(F.count_if(p > 0.7).alias("high"), F.count_if((p >= 0.4) & (p <= 0.7)).alias("medium"), F.count_if(p < 0.4).alias("low"))


def top_actions(df: DataFrame, score: str, key: str, k: int = 20) -> DataFrame:
    """The k rows with an action and the best scores."""
    return df.filter(F.col("action").isNotNull()).orderBy(F.desc(score), key).limit(k)


def sort_submissions(df: DataFrame, date: str, key: str) -> DataFrame:
    """T4."""
    return df.orderBy(F.col(date).asc_nulls_last(), key)


def list_leads(df: DataFrame, status: str | None, score: str, key: str, limit: int = 100, offset: int = 0) -> DataFrame:
    """T5: a page of one status, best scores first."""
    rows = df if status is None else df.filter(F.col("status") == status)
    return rows.orderBy(F.desc(score), key).offset(offset).limit(limit)


def nlargest(df: DataFrame, n: int, col: str, key: str) -> DataFrame:
    """T6."""
    return df.orderBy(F.col(col).desc_nulls_last(), key).limit(n)


def completeness(df: DataFrame, cols: list[str] | None = None, blank_is_missing: bool = True) -> DataFrame:
    """A row for each column: filled, total and percent; one pass."""
    cols = cols or df.columns
    own = [F.struct(F.lit(c).alias("column"), F.count_if(~is_blank(c) if blank_is_missing else F.col(f"`{c}`").isNotNull()).alias("filled"), F.count("*").alias("total")).alias(f"s{i}") for i, c in enumerate(cols)]
    long = df.agg(*own).select(F.inline(F.array(*[F.col(f"s{i}") for i in range(len(cols))])))
    return long.withColumn("percent", F.when(F.col("total") > 0, F.col("filled") * 100.0 / F.col("total")).otherwise(0.0))
