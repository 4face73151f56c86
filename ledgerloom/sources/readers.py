"""Readers (S1 to S4, S6, S7, S10, S14 to S16) and the registry of them (Z3)."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .records import FILE, charset, read_records

SEPARATORS = (",", ";", "|", "\t")
ENCODINGS = ("UTF-8", "windows-1252", "ISO-8859-1")
CORRUPT = "_corrupt_record"


def identifier_schema(columns: Iterable[str], types: dict[str, str] | None = None) -> T.StructType:
    """All text, so that leading zeros of CPF and CNPJ stay; others may be given a type, identifiers may not."""
    fixed = {c: t for c, t in (types or {}).items() if "CPF" not in c.upper() and "CNPJ" not in c.upper()}
    return T.StructType([T.StructField(c, T._parse_datatype_string(fixed.get(c, "string"))) for c in columns])


def header_of(spark: SparkSession, path: str, sep: str, encoding: str) -> list[str]:
    """Column names of the first record, which may go over several lines; no more is read."""
    first = spark.read.csv(path, encoding=charset(encoding), sep=sep, header=False, multiLine=True, quote='"', escape='"').limit(1).first()
    return [str(c if c is not None else f"column{i}").lstrip("﻿").strip() for i, c in enumerate(first)] if first else []


def may_be(spark: SparkSession, path: str, encoding: str) -> bool:
    """UTF-8 only if all lines decode; the first that doesn't ends the scan."""
    return encoding.upper() != "UTF-8" or spark.read.text(path).filter(~F.is_valid_utf8("value")).isEmpty()


def read_delimited(spark: SparkSession, path: str, seps: Iterable[str] = SEPARATORS, encodings: Iterable[str] = ENCODINGS, types: dict[str, str] | None = None, file_name: bool = False) -> DataFrame:
    """The first separator and encoding that give more than one column; else an error. Everything is text unless
    a type is given. Quoted fields may hold separators, doubled quotes and line breaks; files are read by many tasks all the
    same. For separators only header records are probed; for UTF-8 all lines are read, and once more for open quotes, before
    the data is used. file_name: a column of that name as well."""
    for encoding in encodings:
        if not may_be(spark, path, encoding):
            continue
        for sep in seps:
            names = header_of(spark, path, sep, encoding)
            if len(names) > 1:
                df = read_records(spark, path, sep, encoding, identifier_schema(names, types))
                return df.withColumnRenamed(FILE, "file_name") if file_name else df.drop(FILE)
    raise ValueError(f"no separator gives more than one column: {path}")


def read_many(spark: SparkSession, paths: Iterable[str], seps: Iterable[str] = SEPARATORS, encodings: Iterable[str] = ENCODINGS) -> DataFrame:
    """S3: exports with differing columns, by name, each row with its file. Paths may be globs of files alike."""
    tables = [read_delimited(spark, p, seps, encodings, file_name=True) for p in paths]
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def read_tolerant(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",", header: bool = True, encoding: str = "UTF-8") -> tuple[DataFrame, DataFrame]:
    """Records that fit the schema, and those that don't, with their text. Records are cut as by read_delimited()."""
    full = T.StructType([*schema, T.StructField(CORRUPT, T.StringType())])
    rows = read_records(spark, path, sep, encoding, full, header, CORRUPT).drop(FILE)
    # Spark reads the line only beside other columns, so the filter has all of them
    read = F.xxhash64(*[F.col(f"`{c}`") for c in schema.names]) >= F.lit(-(1 << 63))
    return rows.filter(F.col(CORRUPT).isNull() & read).drop(CORRUPT), rows.filter(F.col(CORRUPT).isNotNull() & read)


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """From any path that Spark reads."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None, multi_line: bool = False) -> DataFrame:
    """An array of objects (multi_line) or a line each; lines that can't be read go."""
    reader = spark.read.option("multiLine", multi_line).option("mode", "DROPMALFORMED")
    return (reader.schema(schema) if schema else reader).json(path)


def read_jdbc(
    spark: SparkSession, url: str, table: str | None = None, query: str | None = None, partition: tuple[str, int, int, int] | None = None, limit: int | None = None, offset: int | None = None,
    parallel: tuple[str, int] | None = None, **options: str,
) -> DataFrame:
    """A table or query. parallel: a whole-number column and the number of parallel reads; its ends are asked of the
    database first. partition: column, lower and upper bound and number of reads, where they are known."""
    source = table if table else f"({query}) q"
    if parallel and not partition:
        column, n = parallel
        low, high = spark.read.format("jdbc").options(url=url, **options).option("dbtable", f"(select min({column}) a, max({column}) b from {source}) ends").load().first()
        partition = None if low is None else (column.strip('"'), int(low), int(high) + 1, n)
    reader = spark.read.format("jdbc").options(url=url, **options).option("dbtable", source)
    if partition:
        reader = reader.options(partitionColumn=partition[0], lowerBound=partition[1], upperBound=partition[2], numPartitions=partition[3])
    df = reader.load()
    df = df.offset(offset) if offset else df
    return df.limit(limit) if limit else df


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    return df.limit(n)


def profile_sample(df: DataFrame, n: int = 500_000, above: int = 1_000_000, seed: int = 42) -> DataFrame:
    """All rows, or of larger tables a random part of about n rows."""
    rows = df.count()
    return df if rows <= above else df.sample(n / rows, seed)


def file_stats(df: DataFrame, file: str = "file_name") -> DataFrame:
    """Per file: rows, columns that hold anything, missing cells."""
    cols = [c for c in df.columns if c != file]
    filled = [F.count(F.col(f"`{c}`")) for c in cols]
    return df.groupBy(file).agg(F.count("*").alias("rows"), sum(((x > 0).cast("int") for x in filled), F.lit(0)).alias("columns"), sum((F.count("*") - x for x in filled), F.lit(0)).alias("missing"))


def strip_templates(df: DataFrame) -> DataFrame:
    """Without {{field:...}} in texts."""
    return df.withColumns({c: F.trim(F.regexp_replace(F.col(f"`{c}`"), r"\{\{[^}]*\}\}", "")) for c, t in df.dtypes if t == "string"})


#: Z3: readers by extension, each from (spark, path, options).
READERS: dict[str, Callable[..., DataFrame]] = {
    "csv": read_delimited, "txt": read_delimited, "tsv": read_delimited, "parquet": read_parquet,
    "json": lambda spark, path, **o: read_json(spark, path, multi_line=True, **o), "jsonl": read_json,
    "orc": lambda spark, path, **o: spark.read.options(**o).orc(path),
}


def register_source(extension: str, reader: Callable[..., DataFrame]) -> None:
    READERS[extension.lower().lstrip(".")] = reader


def read_any(spark: SparkSession, path: str, kind: str | None = None, **options) -> DataFrame:
    """By kind, or by the path's extension."""
    kind = (kind or path.rstrip("/").rsplit(".", 1)[-1]).lower()
    if kind not in READERS:
        raise ValueError(f"no reader for {kind}")
    return READERS[kind](spark, path, **options)
