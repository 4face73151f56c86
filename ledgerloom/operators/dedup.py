"""Deduplication and ranking by windows.

Rows have no order of their own in Spark, so each job takes the columns that break ties; where they don't, a hash of the
whole row does, which tells nulls apart, so reruns agree. Rows with a null key have no identity: they go, or stay apart from
the window, so that no task gathers them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import Window as W

from ..functions.standardise import blank_to_null, folded, match_key, money, parsed_date
from ..functions.validate import digits, is_blank


def first_per(df: DataFrame, keys: list[str | Column], order: list[Column], keep_null: bool = False) -> DataFrame:
    """The first row of each key; ties by the hash of the row. Rows with a null key go, or are all kept."""
    keys = [F.col(f"`{k}`") if isinstance(k, str) else k for k in keys]
    whole = F.lit(True)
    for k in keys:
        whole = whole & k.isNotNull()
    ranked = df.filter(whole).withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy(*order, row_hash(df)))).filter("_n = 1").drop("_n")
    return ranked.unionByName(df.filter(~whole)) if keep_null else ranked


def identifier_column(df: DataFrame) -> str | None:
    """The first column named for CPF, else for CNPJ."""
    return next((c for part in ("CPF", "CNPJ") for c in df.columns if part in c.upper()), None)


def date_column(df: DataFrame) -> str | None:
    """The first column named for a date that isn't a number."""
    number = {"tinyint", "smallint", "int", "bigint", "float", "double"}
    named = next(((c, t) for c, t in df.dtypes if "DATE" in c.upper() or "DATA" in c.upper()), None)
    return named[0] if named and named[1] not in number and not named[1].startswith("decimal") else None


def as_time(df: DataFrame, col: str) -> Column:
    return parsed_date(col) if dict(df.dtypes)[col] == "string" else F.col(f"`{col}`").cast("timestamp")


def dedup_latest(df: DataFrame, key: str | None = None, date: str | None = None, tie: list[str] | None = None, keep_null: bool = False) -> DataFrame:
    """The newest row of each identifier; dates that can't be read last. Without an identifier all rows stay."""
    key, date = key or identifier_column(df), date or date_column(df)
    if key is None:
        return df
    order = ([as_time(df, date).desc_nulls_last()] if date else []) + [F.col(f"`{t}`") for t in tie or []]
    return first_per(df, [key], order, keep_null)


def row_hash(df: DataFrame) -> Column:
    """A hash of the whole row that tells nulls apart (xxhash64 itself passes over them); nested columns count by their JSON
    text."""
    cols = []
    for c, t in df.dtypes:
        own = F.to_json(F.struct(F.col(f"`{c}`")), {"ignoreNullFields": "false"}) if "<" in t or t == "variant" else F.col(f"`{c}`")
        cols += [own, own.isNull()]
    return F.xxhash64(*cols)


def filled(cols: list[str]) -> Column:
    return sum((F.col(f"`{c}`").isNotNull().cast("int") for c in cols), F.lit(0))


def dedup_complete(df: DataFrame, key: str | None = None, date: str | None = None, tie: list[str] | None = None) -> DataFrame:
    """The most complete row of each CPF, else e-mail; then the newest. Rows without the key stay."""
    key = key or next((c for c in ("cpf", "email") if c in df.columns), None)
    if key is None:
        return df
    order = [filled(df.columns).desc()] + ([as_time(df, date).desc_nulls_last()] if date else []) + [F.col(f"`{t}`") for t in tie or []]
    return first_per(df, [key], order, keep_null=True)


def composite_score(df: DataFrame, date: str, value: str, cols: list[str] | None = None) -> Column:
    """Completeness * 1e6 + yyyymmdd * 10 + value / 1e6, with 0 for a missing date or value."""
    day = F.coalesce(F.date_format(as_time(df, date), "yyyyMMdd").cast("double"), F.lit(0.0))
    kind = dict(df.dtypes)[value]
    amount = money(value) if kind == "string" else F.col(f"`{value}`")
    share = sum(((~is_blank(c)).cast("int") for c in cols or df.columns), F.lit(0)) / F.lit(float(len(cols or df.columns)))
    return share * 1e6 + day * 10 + F.coalesce(amount.cast("double"), F.lit(0.0)) / 1e6


def dedup_best(df: DataFrame, key: str, date: str, value: str, tie: list[str] | None = None, cols: list[str] | None = None) -> DataFrame:
    """The row of each key with the best composite score."""
    return first_per(df, [key], [composite_score(df, date, value, cols).desc(), *(F.col(f"`{t}`") for t in tie or [])])


def fingerprint(df: DataFrame, kind: str) -> Column:
    """Company: CNPJ, domain of the site, name; contact: e-mail, phone, name with company; else the hash of the row."""
    has = lambda c: c in df.columns
    filled_digits = lambda c, n: F.when(F.length(digits(c)) >= n, digits(c))
    keys = []
    if kind == "company":
        keys += [F.concat(F.lit("cnpj:"), filled_digits("cnpj", 14))] if has("cnpj") else []
        if has("site"):
            host = F.regexp_extract(F.lower(F.trim(F.col("site"))), r"^(?:[a-z]+://)?(?:www\.)?([^/:?#\s]+\.[^/:?#\s]+)", 1)
            keys.append(F.when(host != "", F.concat(F.lit("site:"), host)))
        keys += [F.when(~is_blank("nome"), F.concat(F.lit("name:"), match_key("nome")))] if has("nome") else []
    else:
        keys += [F.when(~is_blank("email"), F.concat(F.lit("mail:"), F.lower(F.trim(F.col("email")))))] if has("email") else []
        keys += [F.concat(F.lit("phone:"), filled_digits("telefone", 8))] if has("telefone") else []
        if has("nome"):
            company = match_key("empresa") if has("empresa") else F.lit("")
            keys.append(F.when(~is_blank("nome"), F.concat(F.lit("name:"), match_key("nome"), F.lit("|"), F.coalesce(company, F.lit("")))))
    return F.coalesce(*keys, F.concat(F.lit("row:"), F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))))


def resolve_entities(df: DataFrame, kind: str, as_of, date: str | None = None, value: str | None = None, tie: list[str] | None = None) -> DataFrame:
    """The best row of each fingerprint: filled fields + max(0, 1000 - days of age) + min(value / 1e6, 100)."""
    score = sum(((~is_blank(c)).cast("double") for c in df.columns), F.lit(0.0))
    if date:
        score = score + F.coalesce(F.greatest(F.lit(0), 1000 - F.datediff(F.lit(as_of).cast("date"), as_time(df, date))), F.lit(0))
    if value:
        score = score + F.coalesce(F.least(F.col(f"`{value}`").cast("double") / 1e6, F.lit(100.0)), F.lit(0.0))
    out = df.withColumns({"fingerprint": fingerprint(df, kind), "entity_score": score})
    return first_per(out, ["fingerprint"], [F.col("entity_score").desc(), *(F.col(f"`{t}`") for t in tie or [])])


def dedup_group_best(df: DataFrame, keys: list[str], cols: list[str] | None = None, tie: list[str] | None = None) -> DataFrame:
    """The row of each group with most filled columns."""
    return first_per(df, keys, [filled(cols or df.columns).desc(), *(F.col(f"`{t}`") for t in tie or [])], keep_null=True)


def dedup_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key."""
    return first_per(df, keys, [F.col(f"`{o}`").desc() for o in order], keep_null=True)


def dedup_hash(df: DataFrame, cols: list[str], order: list[str], fold: bool = True) -> DataFrame:
    """The first row of each MD5 of the normalised fields (accents folded, or lower and trimmed)."""
    parts = [F.coalesce(F.trim(folded(c) if fold else F.lower(F.col(f"`{c}`"))), F.lit("")) for c in cols]
    return first_per(df.withColumn("dedup_key", F.md5(F.concat_ws("|", *parts))), ["dedup_key"], [F.col(f"`{o}`") for o in order])


def dedup_ignore_dates(df: DataFrame, date: str, tie: list[str] | None = None) -> DataFrame:
    """Of rows alike but for dates and times, the newest."""
    same = [c for c, t in df.dtypes if t not in ("date", "timestamp", "timestamp_ntz") and not any(p in c.lower() for p in ("date", "data", "hora", "time")) and c != date and c not in (tie or [])]
    order = [as_time(df, date).desc_nulls_last(), *(F.col(f"`{t}`") for t in tie or [])]
    key = F.xxhash64(*[F.col(f"`{c}`") for c in same])
    return df.withColumn("_n", F.row_number().over(W.partitionBy(key, *[F.col(f"`{c}`") for c in same]).orderBy(*order, row_hash(df)))).filter("_n = 1").drop("_n")


def dedup_exact_then_id(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Distinct rows, then the first of each key."""
    return first_per(df.distinct(), [key], [F.col(f"`{o}`") for o in order], keep_null=True)


def merge_snapshots(df: DataFrame, key: str, order: str = "file_name", pos: str | None = None) -> DataFrame:
    """The first record of each key in file order."""
    return first_per(df, [key], [F.col(f"`{c}`") for c in (order, pos) if c])


def latest_snapshot(df: DataFrame, dataset: str, file: str = "file_name") -> DataFrame:
    """The rows of the last file of each dataset."""
    last = df.groupBy(dataset).agg(F.max(file).alias(file))
    return df.join(last, [dataset, file], "left_semi")


def union_contacts(crm: DataFrame, external: DataFrame, renames: dict[str, str], email: str = "email") -> DataFrame:
    """Both systems under one set of names, then the first of each e-mail, the first system's before the other's."""
    both = crm.withColumn("_from", F.lit(0)).unionByName(external.withColumnsRenamed(renames).withColumn("_from", F.lit(1)), allowMissingColumns=True)
    both = both.withColumn(email, blank_to_null(F.lower(F.col(email))))
    rest = [F.col(f"`{c}`") for c in both.columns if c not in ("_from", email)]
    return first_per(both, [email], [F.col("_from"), *rest], keep_null=True).drop("_from")


def run_dashboard(metrics: DataFrame, pipeline: str, as_of, hours: int = 24, last: int = 50) -> tuple[DataFrame, DataFrame]:
    """The newest runs of a pipeline within the window, newest first, and one row that sums them up."""
    own = metrics.filter((F.col("pipeline_name") == pipeline) & (F.col("timestamp") > F.lit(as_of).cast("timestamp") - F.make_dt_interval(hours=F.lit(hours))) & (F.col("timestamp") <= F.lit(as_of).cast("timestamp")))
    summary = own.agg(
        F.count("*").alias("runs"), F.sum("records_processed").alias("records"), F.avg("success_rate").alias("success_rate"), F.avg("processing_time_seconds").alias("seconds"),
        F.sum("error_count").alias("errors"), F.avg("data_quality_score").alias("quality"), F.max("timestamp").alias("last_run"),
    )
    return own.orderBy(F.col("timestamp").desc()).limit(last), summary
