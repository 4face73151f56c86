"""Shared folder, staged tables and Arrow batch helpers of the training-data operators."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: A batch of texts is worked on in slices of about this many characters, so that memory in a task is bounded.
SLICE_CHARS = 1_500_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster shares (spark.checkpoint.dir). Only where it is unset, as in tests, a folder of our own."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):  # other machines would not see a folder of this one
            raise RuntimeError("set spark.checkpoint.dir to a folder that the whole cluster shares")
        base = tempfile.mkdtemp(prefix="spark-ledgerloom-")
        atexit.register(shutil.rmtree, base, True)
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; it is deleted when the application ends."""
    path = f"{shared_dir(spark)}/ledgerloom/{name}-{uuid.uuid4().hex}"
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """df, written once to the shared folder and read back: later steps survive the loss of any executor."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession, path: str) -> None:
    """Deletes a folder that new_folder() gave."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


@contextlib.contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """While a job runs inside, Arrow batches to Python hold at most so many rows: whole texts are held twice on the way."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, min(rows, int(before)) if int(before) > 0 else rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_CHARS) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Slices of the batches with their texts, each of about `limit` characters; a longer text is alone in its slice."""
    for batch in batches:
        if (at := batch.schema.get_field_index(column)) < 0:
            raise KeyError(f"no column {column}, or more than one, in {batch.schema.names}")
        texts = batch.column(at)
        sizes = [x or 0 for x in pc.binary_length(texts).to_pylist()]
        begin, total = 0, 0
        for i, n in enumerate(sizes):
            if i > begin and total + n > limit:
                yield batch.slice(begin, i - begin), texts.slice(begin, i - begin).to_pylist()
                begin, total = i, 0
            total += n
        if begin < len(sizes):
            yield batch.slice(begin), texts.slice(begin).to_pylist()


def free_name(df: DataFrame, name: str) -> str:
    """`name`, or with underscores before it while the table has such a column (Spark's names ignore case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def unclash(df: DataFrame, names) -> tuple[DataFrame, dict[str, str]]:
    """df with an underscore before those of its columns that would clash with `names`; and new name -> old name."""
    names, moved = {n.lower() for n in names}, {}
    for c in df.columns:
        if c.lower() in names:
            to = "_" + c
            while to.lower() in names or to.lower() in {x.lower() for x in df.columns} | {x.lower() for x in moved}:
                to = "_" + to
            moved[to] = c
    return df.withColumnsRenamed({old: new for new, old in moved.items()}), moved


class WordMemory:
    """What a worker has worked out for words, bounded by bytes, in two generations: a word found in the old one goes to
    the new one, and when that is full it becomes the old one. So frequent words stay, and rare ones go. Words of more
    than `longest` characters are not kept. No result depends on what is kept."""

    def __init__(self, limit: int = 128 << 20, longest: int = 64):
        self.limit, self.longest, self.size = limit // 2, longest, 0
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def lookup(self, words: list[str], make: Callable[[list[str]], list[bytes]]) -> list[bytes]:
        """Of each of some distinct words its bytes; `make` works them out for a list of words."""
        out = list(map(self.new.get, words))
        gaps = [i for i, x in enumerate(out) if x is None]
        if not gaps:
            return out
        asked = [words[i] for i in gaps]
        found = list(map(self.old.get, asked))
        missing = [k for k, x in enumerate(found) if x is None]
        for k, value in zip(missing, make([asked[k] for k in missing]) if missing else [], strict=True):
            found[k] = value
        for i, value in zip(gaps, found, strict=True):
            out[i] = value
        kept = {w: x for w, x in zip(asked, found, strict=True) if len(w) <= self.longest}
        self.new.update(kept)
        self.size += sum(map(len, kept)) + sum(map(len, kept.values())) + 250 * len(kept)  # two objects, wide letters and their place in the table
        if self.size > self.limit:
            self.old, self.new, self.size = self.new, {}, 0
        return out


def column_after(moved: dict[str, str], name: str) -> str:
    """The name that a column of the caller's table has after unclash() gave `moved`."""
    return next((new for new, old in moved.items() if old.lower() == name.lower()), name)
