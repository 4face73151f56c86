"""Delimited records that may go over several lines, read in parallel.

A quoted field may hold line breaks, separators and doubled quotes. Whether a line break ends a record depends on all quotes
before it, but what a stretch of lines does to "inside a quoted field or not" is a function of two states, and functions can
be put together in any grouping. So each block of a file (what one task reads) gives its function, a scan over the blocks of
a file gives the state that each begins in, and then all blocks are cut into records at once. A record that crosses blocks is
put together from its pieces. Where no line ends inside a field, Spark's own reader does it all.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

#: What Latin-1 has as control characters and Windows 1252 as letters and marks.
LATIN, WINDOWS = zip(*((chr(b), bytes([b]).decode("cp1252")) for b in range(0x80, 0xA0) if bytes([b]).decode("cp1252", "ignore")), strict=True)
#: Blocks whose states are broadcast (100 bytes or so each): 256 TB in blocks of 128 MB.
MOST_BLOCKS = 2_000_000
#: The column with the name of a record's file.
FILE = "_file_name"


def charset(encoding: str) -> str:
    """Windows 1252 is read as Latin-1, and its own characters are put in after that."""
    return "ISO-8859-1" if encoding == "windows-1252" else encoding


def windows_letters(text: Column) -> Column:
    return F.translate(text, "".join(LATIN), "".join(WINDOWS))


def lines_of(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    """line, file and block (its first byte), in the order of each block; carriage returns stay."""
    rows = spark.read.option("lineSep", "\n").text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    line = F.col("value") if encoding.upper() == "UTF-8" else F.decode(F.col("value").cast("binary"), charset(encoding))
    return rows.select((windows_letters(line) if encoding == "windows-1252" else line).alias("line"), "file", "block")


def ends_inside(line: Column, sep: str) -> Column:
    """Whether a line that begins outside of a quoted field ends inside of one. A quote opens a field only at its start;
    doubled quotes don't count."""
    parts = F.split(F.replace(line, F.lit('""'), F.lit("")), F.lit('"'))

    def step(state: Column, part: Column) -> Column:
        opens = F.endswith(part, F.lit(sep)) | (state["first"] & (part == ""))
        return F.struct((~state["inside"] & opens).alias("inside"), F.lit(False).alias("first"))

    start = F.struct(F.lit(False).alias("inside"), F.lit(True).alias("first"))
    walked = F.aggregate(F.slice(parts, 1, F.size(parts) - 1), start, step, lambda state: state["inside"])
    return F.when(F.contains(line, F.lit('"')), walked).otherwise(F.lit(False))


def after(line: str, inside: bool, sep: str) -> bool:
    """ends_inside() of one line, from either state."""
    parts = line.replace('""', "").split('"')
    for k, part in enumerate(parts[:-1]):
        inside = not inside and (part.endswith(sep) or (k == 0 and not part))
    return inside


def block_states(lines: DataFrame, sep: str) -> DataFrame:
    """file, block, inside (the state that the block begins in) and owner (the block where the record open there began)."""

    def functions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[list] = []
        for batch in batches:
            files, blocks = batch.column(1), batch.column(2)
            quoted = pc.fill_null(pc.match_substring(batch.column(0), '"'), False)
            # a row where the block changes, and the lines with quotes: all others change nothing
            change = [0, *(i for i in range(1, batch.num_rows) if blocks[i].as_py() != blocks[i - 1].as_py() or files[i].as_py() != files[i - 1].as_py())] if pc.count_distinct(blocks).as_py() > 1 or pc.count_distinct(files).as_py() > 1 else [0]
            hits = set(pc.indices_nonzero(quoted).to_pylist())
            for i in sorted(hits | set(change)) if batch.num_rows else []:
                where = (files[i].as_py(), blocks[i].as_py())
                if not out or tuple(out[-1][:2]) != where:
                    out.append([*where, False, True, False, False])  # ends from either state, and whether a record ends on the way
                if i in hits:
                    row, line = out[-1], batch.column(0)[i].as_py()
                    row[2:4] = after(line, row[2], sep), after(line, row[3], sep)
                own = out[-1]
                own[4], own[5] = own[4] or not own[2], own[5] or not own[3]
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate((pa.string(), pa.int64(), *(pa.bool_(),) * 4))], ["file", "block", "from_out", "from_in", "ends_out", "ends_in"])

    def scan(group: pd.DataFrame) -> pd.DataFrame:  # a row a block of one file
        inside, owner, rows = False, -1, []
        for r in group.sort_values("block").itertuples():
            rows.append((r.file, r.block, inside, owner))
            ended = r.ends_in if inside else True
            inside_after = r.from_in if inside else r.from_out
            owner = (r.block if ended else owner) if inside_after else -1
            inside = inside_after
        return pd.DataFrame(rows, columns=["file", "block", "inside", "owner"])

    found = lines.mapInArrow(functions, "file string, block long, from_out boolean, from_in boolean, ends_out boolean, ends_in boolean")
    return found.groupBy("file").applyInPandas(scan, "file string, block long, inside boolean, owner long")


def records_of(lines: DataFrame, states: DataFrame, sep: str) -> DataFrame:
    """file, first (whether it is the first record of its file) and record (without the line break that ends it)."""
    schema = "file string, owner long, block long, whole boolean, first boolean, record string"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, owner, inside, first, held = None, -1, False, False, []
        rows: list[tuple] = []

        def out() -> pa.RecordBatch:
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.string())
            batch = pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["file", "owner", "block", "whole", "first", "record"])
            rows.clear()
            return batch

        for batch in batches:
            for line, file, block, begins, began in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (file, block) != where:
                    if held:
                        rows.append((*where[:1], owner, where[1], False, first, "\n".join(held)))
                    where, owner, inside, first, held = (file, block), began if begins else block, begins, block == 0, []
                if not inside and '"' not in line:  # most lines
                    if line.strip():
                        rows.append((file, block, block, True, first, line))
                        first = False
                    continue
                held.append(line)
                if '"' in line:
                    inside = after(line, inside, sep)
                if not inside:
                    rows.append((file, owner, block, owner == block, first, "\n".join(held)))
                    first, held, owner = False, [], block
            if rows:
                yield out()
        if held:
            rows.append((where[0], owner, where[1], False, first, "\n".join(held)))
        yield out()

    number = states.count()
    if number > MOST_BLOCKS:
        raise ValueError(f"{number} blocks: read fewer files at a time, or in larger blocks")
    pieces = lines.join(F.broadcast(states), ["file", "block"]).select("line", "file", "block", "inside", "owner").mapInArrow(cut, schema)
    crossing = pieces.filter("not whole").groupBy("file", "owner").agg(F.max("first").alias("first"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "record"))), lambda x: x["record"]), "\n").alias("record"))
    every = pieces.filter("whole").select("file", "first", "record").unionByName(crossing.select("file", "first", "record"))
    return every.withColumn("record", F.regexp_replace("record", "\r$", ""))


def parse_records(records: DataFrame, schema: T.StructType, sep: str, corrupt: str | None = None) -> DataFrame:
    """The fields of each record, and the name of its file."""
    options = {"sep": sep, "quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE", "lineSep": "\n", "maxCharsPerColumn": "-1"}
    if corrupt:
        options["columnNameOfCorruptRecord"] = corrupt
    fields = F.from_csv("record", ddl(schema), options)
    return records.select(F.element_at(F.split("file", "/"), -1).alias(FILE), fields.alias("fields")).select("fields.*", FILE)


def ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema)


def read_records(spark: SparkSession, path: str, sep: str, encoding: str, schema: T.StructType, header: bool = True, corrupt: str | None = None) -> DataFrame:
    """All records of a file or folder, and the name of each one's file. Blank lines are left out; an opening quote that
    nothing closes takes the rest of its file."""
    lines = lines_of(spark, path, encoding)
    if lines.filter(ends_inside(F.col("line"), sep)).isEmpty():
        options = {"columnNameOfCorruptRecord": corrupt} if corrupt else {}
        df = spark.read.csv(path, sep=sep, encoding=charset(encoding), header=header, schema=schema, enforceSchema=True, multiLine=False, quote='"', escape='"', maxCharsPerColumn=-1, **options)
        names = [f.name for f in schema]
        df = df.select(*[F.col(f"`{c}`") for c in names], F.col("_metadata.file_name").alias(FILE))
        if encoding == "windows-1252":
            df = df.withColumns({c: windows_letters(F.col(f"`{c}`")) for c, t in df.dtypes if t == "string" and c != FILE})
        return df
    records = records_of(lines, block_states(lines, sep), sep)
    return parse_records(records.filter("not first") if header else records, schema, sep, corrupt)
