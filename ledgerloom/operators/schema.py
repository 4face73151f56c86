"""Names and shapes of tables."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import dims
from ..functions.validate import is_blank


def clean_name(name: str) -> str:
    """Without accents and punctuation, in lower case, with underscores for blanks."""
    text = re.sub(r"[^\w\s-]", "", dims.fold(name.strip()))
    return re.sub(r"[\s-]+", "_", text).strip("_") or "column"


def normalise_names(df: DataFrame) -> DataFrame:
    """P1; names that come out equal get numbers."""
    seen: dict[str, int] = {}
    names = []
    for c in df.columns:
        n = clean_name(c)
        seen[n] = seen.get(n, 0) + 1
        names.append(n if seen[n] == 1 else f"{n}_{seen[n]}")
    return df.toDF(*names)


def map_schema(df: DataFrame, synonyms: dict[str, list[str]] | None = None, prefix: str = "extra_") -> DataFrame:
    """Columns by their standard names; unmapped ones under a prefix; absent ones null. A column serves one name, and
    an exact synonym goes before a contained one."""
    synonyms = dims.SYNONYMS if synonyms is None else synonyms
    free, found = {c: c.strip().lower() for c in df.columns}, {}
    for exact in (True, False):
        for standard, words in synonyms.items():
            if standard not in found:
                hit = next((c for c, low in free.items() if low == standard or any(low == w if exact else len(w) > 3 and w in low for w in words)), None)
                if hit is not None:
                    found[standard] = hit
                    del free[hit]
    kept = [F.col(f"`{found[s]}`").alias(s) if s in found else F.lit(None).cast("string").alias(s) for s in synonyms]
    return df.select(*kept, *[F.col(f"`{c}`").alias(prefix + clean_name(c)) for c in free])


def rename_map(df: DataFrame, names: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """The table under mapped names, and a report (source, target, mapped) with a row for each column and absent source."""
    rows = [(c, names.get(c, c), c in names) for c in df.columns] + [(s, t, False) for s, t in names.items() if s not in df.columns]
    spark = df.sparkSession
    return df.withColumnsRenamed({s: t for s, t in names.items() if s in df.columns}), spark.createDataFrame(rows, "source string, target string, mapped boolean")


def ensure_columns(df: DataFrame, cols: Iterable[str], default: str = "") -> DataFrame:
    """Absent columns and null values become the default text."""
    return df.withColumns({c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(default)) if c in df.columns else F.lit(default) for c in cols})


def drop_null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.na.drop(subset=keys)


def drop_empty_rows(df: DataFrame, blank_is_missing: bool = False) -> DataFrame:
    """P5: without rows that hold nothing."""
    if not blank_is_missing:
        return df.na.drop("all")
    return df.filter(reduce(Column.__or__, (~is_blank(c) for c in df.columns)))


def where_contains(df: DataFrame, col: str, text: str) -> DataFrame:
    return df.filter(F.lower(F.col(f"`{col}`")).contains(text.lower()))


def where_state(df: DataFrame, col: str, state: str) -> DataFrame:
    """Texts that end in the state's code."""
    return df.filter(F.upper(F.trim(F.col(f"`{col}`"))).rlike(rf"(?:^|[\s/,\-]){state.upper()}$"))


def where_filled(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.filter(reduce(Column.__and__, (~is_blank(c) for c in cols)))


def where_equals(df: DataFrame, col: str, value) -> DataFrame:
    return df.filter(F.col(f"`{col}`") == F.lit(value))


def conditional(df: DataFrame, name: str, condition: str | Column, yes, no) -> DataFrame:
    """A column that is one of two values."""
    condition = F.expr(condition) if isinstance(condition, str) else condition
    return df.withColumn(name, F.when(condition, yes).otherwise(no))


def categorise(df: DataFrame, col: str, mapping: dict[str, str], name: str | None = None, default: str | None = None) -> DataFrame:
    """Through a fixed dictionary."""
    table = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return df.withColumn(name or f"{col}_category", F.coalesce(table[F.col(f"`{col}`").cast("string")], F.lit(default).cast("string")))


def add_lineage(df: DataFrame, source: str, as_of, version: str = "1.0.0") -> DataFrame:
    """P8."""
    return df.withColumns({"fonte_dados": F.lit(source), "data_processamento": F.lit(as_of).cast("timestamp"), "versao_processamento": F.lit(version)})


def union_tables(tables: Iterable[DataFrame]) -> DataFrame:
    """By name, absent columns null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def project_tables(sources: dict[str, DataFrame], mapping: dict[str, tuple[str, dict[str, str], str | None]]) -> dict[str, DataFrame]:
    """Target -> (source, {column: name}, name that must be filled). Distinct rows."""
    out = {}
    for target, (source, names, needed) in mapping.items():
        table = sources[source].select(*[F.col(f"`{c}`").alias(n) for c, n in names.items() if c in sources[source].columns])
        out[target] = (where_filled(table, [needed]) if needed else table).distinct()
    return out


def downcast(df: DataFrame) -> DataFrame:
    """Doubles whose values all lie within a float's range become floats; one pass over the table."""
    doubles = [c for c, t in df.dtypes if t == "double"]
    if not doubles:
        return df
    most = df.agg(*[F.max(F.abs(F.col(f"`{c}`"))).alias(c) for c in doubles]).first()
    return df.withColumns({c: F.col(f"`{c}`").cast("float") for c in doubles if most[c] is None or most[c] <= 3.4028234663852886e38})


def column_presence(columns: DataFrame, file: str = "file", column: str = "column") -> DataFrame:
    """(file, column) rows -> column, files that have it, in_all, and the spellings of its folded name."""
    total = columns.select(F.countDistinct(file).alias("n_files"))
    key = F.regexp_replace(F.lower(F.translate(F.col(column), *dims.accent_table())), "[^a-z0-9]", "")
    variants = columns.select(key.alias("_key"), F.col(column).alias("_name")).distinct().groupBy("_key").agg(F.count("*").alias("n_variants"))
    each = columns.groupBy(F.col(column).alias("column")).agg(F.countDistinct(file).alias("files"), F.first(key).alias("_key"))
    return each.join(variants, "_key").crossJoin(F.broadcast(total)).select("column", "files", (F.col("files") == F.col("n_files")).alias("in_all"), "n_variants")
