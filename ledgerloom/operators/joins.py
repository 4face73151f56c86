"""Lookups, reconciliation and set-based upserts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from ..functions.validate import digits, is_cnpj
from ..sources import versions


def attach_company(df: DataFrame, company_map: DataFrame, how: str = "left", name: str = "company_name", company_id: str = "company_id") -> DataFrame:
    """Each row's surrogate key by company name; company_map has one row a name, also of names that were merged."""
    return df.join(company_map.select(name, company_id).dropDuplicates([name]), name, how)


def enrich_registry(df: DataFrame, registry: DataFrame, key: str = "cnpj", size: str = "porte", default: str = "N/A") -> DataFrame:
    """cnpj_valid and porte_empresa from a registry table by the digits of the key."""
    table = registry.select(digits(key).alias("_key"), F.col(size).alias("_size")).filter("_key != ''").dropDuplicates(["_key"])
    out = df.withColumn("_key", digits(key)).join(table, "_key", "left")
    return out.withColumns({"cnpj_valid": (is_cnpj(key) & F.col("_size").isNotNull()).cast("int"), "porte_empresa": F.coalesce("_size", F.lit(default))}).drop("_key", "_size")


def join_predictions(df: DataFrame, preds: DataFrame, key: str) -> DataFrame:
    """J3."""
    return df.join(preds, key, "left")


def company_summary(companies: DataFrame, contacts: DataFrame, valuations: DataFrame, payments: DataFrame, key: str = "company_id", amount: str = "amount", valued: str = "valuation", at: str = "date") -> DataFrame:
    """Contacts, valuations, latest valuation and payments of each company. Each child is summed before the join."""
    a = contacts.groupBy(key).agg(F.count("*").alias("n_contacts"))
    b = valuations.groupBy(key).agg(F.count("*").alias("n_valuations"), F.max_by(valued, at).alias("latest_valuation"), F.max(at).alias("latest_date"))
    c = payments.groupBy(key).agg(F.count("*").alias("n_payments"), F.sum(amount).alias("total_paid"))
    return companies.join(a, key, "left").join(b, key, "left").join(c, key, "left").fillna(0, ["n_contacts", "n_valuations", "n_payments"]).fillna(0, ["total_paid"])


def reconcile(left: DataFrame, right: DataFrame, key: str, samples: int = 10) -> tuple[DataFrame, DataFrame]:
    """Counts of keys in both, only left and only right; and the first keys of either difference."""
    a, b = left.select(key).na.drop().distinct(), right.select(key).na.drop().distinct()
    sides = a.withColumn("in_left", F.lit(1)).join(b.withColumn("in_right", F.lit(1)), key, "full")
    side = F.when(F.col("in_right").isNull(), "missing").when(F.col("in_left").isNull(), "extra").otherwise("matched")
    sided = sides.select(key, side.alias("side"))
    summary = sided.agg(*[F.count_if(F.col("side") == s).alias(s) for s in ("matched", "missing", "extra")])
    lists = [sided.filter(F.col("side") == s).orderBy(key).limit(samples) for s in ("missing", "extra")]
    return summary, lists[0].unionByName(lists[1])


def existing(df: DataFrame, target: DataFrame, keys: list[str], present: bool = True) -> DataFrame:
    """The rows whose keys the target has, or has not."""
    return df.join(target.select(*keys).distinct(), keys, "left_semi" if present else "left_anti")


def complete_dim(agg: DataFrame, dim: DataFrame, key: str, fill: float | int = 0) -> DataFrame:
    """Values without rows appear, filled."""
    return dim.join(agg, key, "left").fillna(fill)


def prefer_source(primary: DataFrame, fallback: DataFrame, keys: list[str]) -> DataFrame:
    """The fallback's rows only for keys that the primary lacks."""
    return primary.unionByName(existing(fallback, primary, keys, False), allowMissingColumns=True)


def upsert(target: DataFrame, source: DataFrame, key: str, update_cols: Iterable[str] | None = None) -> DataFrame:
    """K7: new rows inserted, the chosen columns of existing ones overwritten. The source has one row a key."""
    cols = [c for c in target.columns if c != key]
    update = set(cols if update_cols is None else update_cols)
    t, s = target.withColumn("_t", F.lit(True)).alias("t"), source.withColumn("_s", F.lit(True)).alias("s")
    out = [F.coalesce(f"t.{key}", f"s.{key}").alias(key)]
    for c in cols:
        if c not in source.columns:
            out.append(F.col(f"t.{c}").alias(c))
        else:
            take = F.col("_s").isNotNull() if c in update else F.col("_t").isNull()
            out.append(F.when(take, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
    return t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), "full").select(*out)


def upsert_coalesce(target: DataFrame, source: DataFrame, key: str, cols: Iterable[str] | None = None) -> DataFrame:
    """K8: incoming values that are not null win, others are kept."""
    cols = [c for c in target.columns if c != key] if cols is None else list(cols)
    t, s = target.alias("t"), source.alias("s")
    out = [F.coalesce(f"t.{key}", f"s.{key}").alias(key)] + [(F.coalesce(f"s.{c}", f"t.{c}") if c in cols and c in source.columns else F.coalesce(f"t.{c}", f"s.{c}") if c in source.columns else F.col(f"t.{c}")).alias(c) for c in target.columns if c != key]
    return t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), "full").select(*out)


def upsert_table(rows: DataFrame, path: str, key: str, update_cols: Iterable[str] | None = None, **settings) -> versions.Version:
    """K7 on a table in versions: only the parts that the new rows have keys of are read and written."""
    return versions.merge(rows.sparkSession, path, rows, key, lambda old, new: upsert(old, new, key, update_cols), **settings)


def upsert_table_coalesce(rows: DataFrame, path: str, key: str, cols: Iterable[str] | None = None, **settings) -> versions.Version:
    """K8 on a table in versions."""
    return versions.merge(rows.sparkSession, path, rows, key, lambda old, new: upsert_coalesce(old, new, key, cols), **settings)


def insert_absent(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """K9: source rows whose composite key the target lacks are added, one a key."""
    return target.unionByName(existing(source.dropDuplicates(keys), target, keys, False).select(*target.columns))


def link(target: DataFrame, pairs: DataFrame) -> DataFrame:
    """Link rows, those that are there already ignored."""
    return insert_absent(target, pairs.select(*target.columns), target.columns)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of each table, in one job."""
    counts = [t.agg(F.count("*").alias("rows")).select(F.lit(n).alias("table"), "rows") for n, t in tables.items()]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionAll(c)
    return out
