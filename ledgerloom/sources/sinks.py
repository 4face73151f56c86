"""Writers (K1 to K6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.aggregates import describe_numeric, numeric
from ..operators.quality import profile, quality_score


def write_csv(df: DataFrame, path: str, sep: str = ";", quote_all: bool = False, mode: str = "overwrite", keep_breaks: bool = False) -> None:
    """K1, K2: line breaks in texts become blanks, unless they are kept in quotes; quotes in fields are doubled; every field is
    quoted if asked."""
    texts = {} if keep_breaks else {c: F.regexp_replace(F.col(f"`{c}`"), r"[\r\n]+", " ") for c, t in df.dtypes if t == "string"}
    df.withColumns(texts).write.mode(mode).option("header", True).option("sep", sep).option("quoteAll", quote_all).option("escape", '"').csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """K3."""
    writer = df.write.mode(mode).option("compression", "snappy")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K4."""
    df.write.mode(mode).json(path)


def export_bundle(df: DataFrame, path: str, source: str, run_ts, valid_cols: list[str] | None = None) -> None:
    """K5: data, profile, statistics and score under one folder."""
    write_parquet(df, f"{path}/data")
    write_parquet(profile(df, source, run_ts), f"{path}/profile")
    if numeric(df):
        write_parquet(describe_numeric(df), f"{path}/statistics")
    write_parquet(quality_score(df, valid_cols or []), f"{path}/score")


def append_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None) -> None:
    """K6."""
    df.write.jdbc(url, table, mode="append", properties=properties or {})
