"""Data quality reports, profiles and schema drift."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import Window as W

from ..functions.validate import is_blank, is_email, is_phone
from .aggregates import completeness, describe_numeric, distinct_counts, numeric


def duplicate_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that more than one row has (nulls are equal), with their rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def duplicate_report(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: rows, rows in groups of duplicates, their percentage and the number of groups."""
    sizes = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return sizes.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("duplicate_rows"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))) * 100.0 / F.nullif(F.sum("n"), F.lit(0)), F.lit(0.0)).alias("duplicate_percent"), F.count_if(F.col("n") > 1).alias("groups"),
    )


def duplicate_examples(df: DataFrame, keys: list[str], k: int = 10) -> DataFrame:
    """Up to k keys with most rows."""
    return duplicate_groups(df, keys).orderBy(F.desc("n"), *keys).limit(k)


def both_present(fields: list[str]) -> Column:
    return reduce(Column.__and__, (~is_blank(f) for f in fields))


def consistency(df: DataFrame, rules: dict[str, list[str]]) -> DataFrame:
    """Rule -> fields that must not all be filled; (rule, violations, rate in percent)."""
    own = [F.struct(F.lit(n).alias("rule"), F.count_if(both_present(f)).alias("violations"), F.count("*").alias("rows")).alias(f"s{i}") for i, (n, f) in enumerate(rules.items())]
    long = df.agg(*own).select(F.inline(F.array(*[F.col(f"s{i}") for i in range(len(own))])))
    return long.select("rule", "violations", F.when(F.col("rows") > 0, F.col("violations") * 100.0 / F.col("rows")).otherwise(0.0).alias("rate"))


def quality_report(df: DataFrame, keys: list[str], required: list[str], rules: dict[str, list[str]]) -> DataFrame:
    """One row: duplicate, completeness and consistency scores (0 to 100) and their mean."""
    dup = duplicate_report(df, keys).select((100 - F.col("duplicate_percent")).alias("duplicate_score"))
    full = df.agg(F.count("*").alias("n"), *[F.count_if(~is_blank(c)).alias(f"c{i}") for i, c in enumerate(required)], *[F.count_if(both_present(f)).alias(f"r{i}") for i, f in enumerate(rules.values())])
    n = F.nullif(F.col("n"), F.lit(0))
    mean = sum((F.col(f"c{i}") for i in range(len(required))), F.lit(0)) * 100.0 / n / len(required)
    bad = sum((F.col(f"r{i}") for i in range(len(rules))), F.lit(0)) * 100.0 / n
    one = dup.crossJoin(F.broadcast(full.select(F.coalesce(mean, F.lit(0.0)).alias("completeness_score"), (100 - F.coalesce(bad, F.lit(0.0))).alias("consistency_score"))))
    return one.withColumn("overall_score", (F.col("duplicate_score") + F.col("completeness_score") + F.col("consistency_score")) / 3)


def quality_score(df: DataFrame, valid_cols: list[str], cols: list[str] | None = None) -> DataFrame:
    """One row: 60 % completeness of all cells + 40 % mean share of valid flags, two decimals, 0 to 100."""
    cols = cols or [c for c in df.columns if c not in valid_cols]
    filled = sum((F.count(F.col(f"`{c}`")) for c in cols), F.lit(0)) / (F.nullif(F.count("*"), F.lit(0)) * len(cols))
    valid = sum((F.avg(F.col(v).cast("int").cast("double")) for v in valid_cols), F.lit(0.0)) / max(1, len(valid_cols))
    return df.agg(F.round(((filled * 0.6 + valid * 0.4) if valid_cols else filled) * 100, 2).alias("quality_score"))


def entity_metrics(tables: dict[str, DataFrame], critical: dict[str, list[str]], key: str, email: str | None = None, phone: str | None = None) -> DataFrame:
    """A row for each entity: total, complete, duplicates, invalid_email, missing_phone, completeness and status
    (excelente from 90, bom from 70, regular from 50, else crítico)."""
    rows = []
    for name, df in tables.items():
        own = critical[name]
        mail = F.count_if(~is_blank(email) & ~is_email(email)) if email and email in df.columns else F.lit(0).cast("long")
        tel = F.count_if(is_blank(phone)) if phone and phone in df.columns else F.lit(0).cast("long")
        rows.append(df.agg(F.count("*").alias("total"), F.count_if(both_present(own)).alias("complete"), (F.count(key) - F.countDistinct(key)).alias("duplicates"), mail.alias("invalid_email"), tel.alias("missing_phone")).select(F.lit(name).alias("entity"), "*"))
    out = reduce(DataFrame.unionByName, rows).withColumn("completeness", F.col("complete") * 100.0 / F.nullif(F.col("total"), F.lit(0)))
    c = F.col("completeness")
    return out.withColumn("status", F.when(c >= 90, "excelente").when(c >= 70, "bom").when(c >= 50, "regular").otherwise("crítico"))


#: Patterns of texts, in order.
PATTERNS = {
    "email": r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$", "phone": r"^\+?[\d\s\-\(\)]{10,}$", "cpf": r"^\d{3}\.\d{3}\.\d{3}-\d{2}$|^\d{11}$",
    "cnpj": r"^\d{2}\.\d{3}\.\d{3}/\d{4}-\d{2}$|^\d{14}$", "cep": r"^\d{5}-?\d{3}$", "date_br": r"^\d{1,2}/\d{1,2}/\d{4}$", "numeric": r"^\d+$", "decimal": r"^\d+[.,]\d+$",
}


def pattern_of(text: Column, share: float = 0.7) -> Column:
    """An aggregate: the first pattern that over `share` of the values that are there have."""
    out = F
    for name, pattern in PATTERNS.items():
        out = out.when(F.avg(F.when(text.isNotNull(), text.rlike(pattern).cast("double"))) > share, name)
    return out.otherwise(F.lit(None).cast("string"))


def detect_patterns(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, pattern) over all values, not a sample."""
    return df.agg(*[F.struct(F.lit(c).alias("column"), pattern_of(F.col(f"`{c}`").cast("string")).alias("pattern")).alias(f"s{i}") for i, c in enumerate(cols)]).select(F.inline(F.array(*[F.col(f"s{i}") for i in range(len(cols))])))


def profile(df: DataFrame, source: str, run_ts, approximate: bool = True) -> DataFrame:
    """A row for each column: type, nullable, rows, nulls, distinct, least and greatest value, mean length, pattern;
    with the schema's hash and the table's quality score. One pass with approximate distinct counts, or exact ones."""
    own, numbers = [], set(numeric(df))
    for i, (c, t) in enumerate(df.dtypes):
        x = F.col(f"`{c}`")
        text = x.cast("string")
        own.append(F.struct(
            F.lit(c).alias("column"), F.lit(t).alias("dtype"), (F.count(x) < F.count("*")).alias("nullable"), F.count("*").alias("rows"), (F.count("*") - F.count(x)).alias("nulls"), (F.approx_count_distinct(text) if approximate else F.lit(0).cast("long")).alias("n_distinct"),
            (F.min(x.cast("double")) if c in numbers else F.lit(None).cast("double")).alias("min_value"), (F.max(x.cast("double")) if c in numbers else F.lit(None).cast("double")).alias("max_value"),
            (F.avg(F.length(x)) if t == "string" else F.lit(None).cast("double")).alias("mean_length"), (pattern_of(x) if t == "string" else F.lit(None).cast("string")).alias("pattern"),
        ).alias(f"s{i}"))
    rows = df.agg(*own).select(F.array(*[F.col(f"s{i}") for i in range(len(own))]).alias("cols"))
    if not approximate:
        counts = distinct_counts(df, df.columns).agg(F.map_from_entries(F.collect_list(F.struct("column", "n_distinct"))).alias("exact"))  # one row
        rows = rows.crossJoin(F.broadcast(counts)).select(F.transform("cols", lambda s: s.withField("n_distinct", F.coalesce(F.col("exact")[s["column"]], F.lit(0).cast("long")))).alias("cols"))
    spec = F.array_join(F.array_sort(F.transform("cols", lambda s: F.concat_ws(":", s["column"], s["dtype"], s["nullable"].cast("string")))), ",")
    cells = F.aggregate("cols", F.lit(0.0), lambda a, s: a + s["nulls"]) / F.nullif(F.aggregate("cols", F.lit(0.0), lambda a, s: a + s["rows"]), F.lit(0.0))
    ids = F.filter("cols", lambda s: (F.lower(s["column"]).contains("id") | (s["n_distinct"] == s["rows"])) & (s["rows"] > 0))
    unique = F.aggregate(ids, F.lit(0.0), lambda a, s: a + s["n_distinct"] / s["rows"]) / F.nullif(F.size(ids), F.lit(0))
    fits = F.when(F.exists("cols", lambda s: s["pattern"].isNotNull()), F.lit(0.9))
    factors = F.array_compact(F.array(1 - cells, F.lit(1.0), unique, fits))
    score = F.aggregate(factors, F.lit(0.0), lambda a, f: a + f) / F.size(factors)
    return rows.select(F.lit(source).alias("source"), F.lit(run_ts).cast("timestamp").alias("run_ts"), F.md5(spec).alias("schema_hash"), score.alias("quality_score"), F.inline("cols"))


#: Precision of the sketches: 2 ** 14 registers (0.8 % of a count), rank errors of 0.7 %.
HLL_BITS, KLL_SIZE, SKETCH_ERROR = 14, 400, 0.03


def partial_profiles(df: DataFrame, source: str, load: Column) -> DataFrame:
    """What each load adds to a profile: a row for each load and column, with counts, ends and mergeable sketches, to be
    kept. One pass; of a load only sketches of bounded size are held."""
    own, numbers = [], set(numeric(df))
    for i, (c, t) in enumerate(df.dtypes):
        x = F.col(f"`{c}`")
        number = x.cast("double")
        own.append(F.struct(
            F.lit(c).alias("column"), F.lit(t).alias("dtype"), F.count("*").alias("rows"), (F.count("*") - F.count(x)).alias("nulls"),
            (F.min(number) if c in numbers else F.lit(None).cast("double")).alias("min_value"), (F.max(number) if c in numbers else F.lit(None).cast("double")).alias("max_value"),
            (F.sum(F.length(x)) if t == "string" else F.lit(None).cast("long")).cast("long").alias("total_length"), F.hll_sketch_agg(x.cast("string"), HLL_BITS).alias("distinct_sketch"),
            (F.kll_sketch_agg_double(number, KLL_SIZE) if c in numbers else F.lit(None).cast("binary")).alias("value_sketch"),
        ).alias(f"s{i}"))
    return df.groupBy(load.alias("load")).agg(*own).select(F.lit(source).alias("source"), "load", F.inline(F.array(*[F.col(f"s{i}") for i in range(len(own))])))


def united_profile(partial: DataFrame) -> DataFrame:
    """The profile of all loads together (a window of days, say), from what is kept of them, without their data: rows,
    nulls, least and greatest value and mean length are exact; distinct values and quartiles are estimates."""
    one = partial.groupBy("source", "column").agg(
        F.max("dtype").alias("dtype"), F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("n_distinct"),
        F.min("min_value").alias("min_value"), F.max("max_value").alias("max_value"), (F.sum("total_length") / F.nullif(F.sum("rows") - F.sum("nulls"), F.lit(0))).alias("mean_length"),
        F.kll_merge_agg_double("value_sketch", KLL_SIZE).alias("_values"),
    )
    known = F.col("min_value").isNotNull()
    quartiles = [F.when(known, F.kll_sketch_get_quantile_double("_values", F.lit(p))).alias(n) for n, p in (("q25", 0.25), ("median", 0.5), ("q75", 0.75))]
    return one.select("source", "column", "dtype", (F.col("nulls") > 0).alias("nullable"), "rows", "nulls", "n_distinct", "min_value", "max_value", "mean_length", *quartiles)


#: Changes of type that are harmless, and that break; all others are of medium impact.
WIDER = [("int", "bigint"), ("int", "double"), ("bigint", "double"), ("int", "float"), ("float", "double"), ("date", "timestamp")]
BREAKING = [("double", "int"), ("double", "bigint"), ("float", "int"), ("string", "timestamp"), ("string", "date"), ("string", "int"), ("string", "bigint"), ("string", "double")]


def diff_profiles(old: DataFrame, new: DataFrame) -> DataFrame:
    """D3: (change_type, column, old_value, new_value, impact, auto_fixable) between two profiles."""
    a, b = old.select("column", F.struct("dtype", "nullable", "n_distinct").alias("o")), new.select("column", F.struct("dtype", "nullable", "n_distinct").alias("n"))
    both = a.join(b, "column", "full")
    pair = F.concat_ws(">", "o.dtype", "n.dtype")
    wider, breaking = pair.isin(*[f"{x}>{y}" for x, y in WIDER]), pair.isin(*[f"{x}>{y}" for x, y in BREAKING])
    here = F.col("o").isNotNull() & F.col("n").isNotNull()
    ratio = F.col("n.n_distinct") / F.col("o.n_distinct")
    change = lambda on, kind, was, now, impact, fix: F.when(on, F.struct(F.lit(kind).alias("change_type"), was.cast("string").alias("old_value"), now.cast("string").alias("new_value"), impact.alias("impact"), fix.alias("auto_fixable")))
    none = F.lit(None)
    found = F.array_compact(F.array(
        change(F.col("n").isNull(), "removed", F.col("o.dtype"), none, F.lit("high"), F.lit(False)),
        change(F.col("o").isNull(), "added", none, F.col("n.dtype"), F.when(F.col("n.nullable"), "medium").otherwise("high"), F.lit(True)),
        change(here & (F.col("o.dtype") != F.col("n.dtype")), "type_changed", F.col("o.dtype"), F.col("n.dtype"), F.when(wider, "low").when(breaking, "critical").otherwise("medium"), wider),
        change(here & (F.col("o.nullable") != F.col("n.nullable")), "nullability_changed", F.col("o.nullable"), F.col("n.nullable"), F.when(F.col("n.nullable"), "low").otherwise("high"), F.col("n.nullable")),
        change(here & (F.col("o.n_distinct") > 0) & (F.col("n.n_distinct") > 0) & ((ratio < 0.5) | (ratio > 2)), "cardinality_changed", F.col("o.n_distinct"), F.col("n.n_distinct"), F.lit("medium"), F.lit(True)),
    ))
    return both.select("column", F.inline(found))


def drift_report(changes: DataFrame) -> DataFrame:
    """One row: changes, drift_score (mean of 0.1, 0.3, 0.7, 1.0 by impact; 0 without changes), breaking and advice."""
    weight = F.when(F.col("impact") == "low", 0.1).when(F.col("impact") == "medium", 0.3).when(F.col("impact") == "high", 0.7).otherwise(1.0)
    one = changes.agg(F.count("*").alias("changes"), F.coalesce(F.avg(weight), F.lit(0.0)).alias("drift_score"), F.coalesce(F.max(F.col("impact").isin("high", "critical")), F.lit(False)).alias("breaking"))
    s = F.col("drift_score")
    return one.withColumn("recommendation", F.when(s == 0, "none").when(s < 0.3, "monitor").when(s < 0.7, "review pipelines").otherwise("stop and fix"))


def latest_profile(history: DataFrame, source: str) -> DataFrame:
    """The last run's profile of exactly this source."""
    own = history.filter(F.col("source") == source)
    last = own.agg(F.max("run_ts").alias("run_ts"))  # one row
    return own.join(F.broadcast(last), "run_ts", "left_semi")


def drift_history(history: DataFrame, source: str, days: int, as_of) -> DataFrame:
    """Runs of the source in the last days: columns, rows, hash, quality, and whether the hash is new against the run before."""
    own = history.filter((F.col("source") == source) & (F.col("run_ts") > F.lit(as_of).cast("timestamp") - F.make_dt_interval(days=F.lit(days))))
    runs = own.groupBy("source", "run_ts").agg(F.count("*").alias("columns"), F.max("rows").alias("rows"), F.first("schema_hash").alias("schema_hash"), F.first("quality_score").alias("quality_score"))
    return runs.withColumn("changed", F.coalesce(F.col("schema_hash") != F.lag("schema_hash").over(W.partitionBy("source").orderBy("run_ts")), F.lit(False)))


def run_report(df: DataFrame, source: str, run_ts) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The profile, number statistics, and one row: rows, fully repeated rows, missing cells and their percentage."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    rows = df.agg(F.count("*").alias("rows"), sum((F.count("*") - F.count(c) for c in cols), F.lit(0)).alias("missing"))
    kept = df.distinct().agg(F.count("*").alias("kept"))
    one = rows.crossJoin(F.broadcast(kept)).select("rows", (F.col("rows") - F.col("kept")).alias("duplicates"), "missing", (F.col("missing") * 100.0 / F.nullif(F.col("rows") * len(cols), F.lit(0))).alias("missing_percent"))
    return profile(df, source, run_ts), describe_numeric(df), one


def missing_phone(df: DataFrame, phone: str) -> DataFrame:
    """Rows with a phone that isn't one."""
    return df.filter(~is_blank(phone) & ~is_phone(phone))


__all__ = [n for n, v in list(globals().items()) if callable(v) and getattr(v, "__module__", "") == __name__] + ["completeness"]
