"""Tables in versions: parts by the key's hash, and a log that says which files a version has.

A merge reads and writes only the parts that new rows have keys of, into a fresh folder, and then puts one manifest into the
log, by a rename that fails where another writer was first; it then merges again, over the other's version. Readers see the
last whole version, so a merge that dies leaves the one before. The manifest says as well which batch of which source came
last: a batch that is run again changes nothing, and a source that is new continues the table.

target/log/<number>.json: schema, parts (folder and rows of each), last batch of each source. target/data/<folder>/part=<part>.
A part is named by the lowest bits of the hash, `depth-value`; one that grows goes on as two or more parts of greater depth.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

#: Rows of a part; versions that can be read; merges tried where others are first; slots up to this number are broadcast.
PART_ROWS, KEPT, TRIES, BROADCAST_SLOTS = 2_000_000, 2, 5, 1 << 20


@dataclass(frozen=True)
class Version:
    """What a manifest holds. parts: name -> [folder or "", rows]; batches: source -> number of its last batch."""

    number: int
    schema: str
    key: str
    parts: dict[str, list] = field(default_factory=dict)
    batches: dict[str, int] = field(default_factory=dict)

    @property
    def fields(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))


class Log:
    """The manifests of a table, in any file system that Spark knows."""

    def __init__(self, spark: SparkSession, target: str):
        self.spark, self.target = spark, target.rstrip("/")
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.path = self.jvm.org.apache.hadoop.fs.Path
        self.files = self.path(self.target).getFileSystem(self.conf)

    def numbers(self) -> list[int]:
        folder = self.path(f"{self.target}/log")
        if not self.files.exists(folder):
            return []
        names = [x.getPath().getName() for x in self.files.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith((".", "_")))

    def read(self, number: int | None = None) -> Version | None:
        """A version, or the last; None where the table has none yet."""
        numbers = self.numbers()
        if number is None and not numbers:
            return None
        number = numbers[-1] if number is None else number
        if number not in numbers:
            raise ValueError(f"no version {number} in {self.target}; there are {numbers}")
        return Version(**json.loads(self.spark.read.text(f"{self.target}/log/{number:012d}.json", wholetext=True).first()[0]))

    def publish(self, version: Version) -> bool:
        """Puts a version into the log, whole or not at all; False where its number is taken."""
        own, to = self.path(f"{self.target}/log/.{uuid.uuid4().hex}"), self.path(f"{self.target}/log/{version.number:012d}.json")
        out = self.files.create(own, True)
        out.write(bytearray(json.dumps(asdict(version)).encode()))
        out.close()
        renames = self.jvm.org.apache.hadoop.fs.Options.Rename
        none = self.spark.sparkContext._gateway.new_array(renames, 0)
        try:
            self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(own.toUri(), self.conf).rename(self.files.makeQualified(own), self.files.makeQualified(to), none)
        except Exception:
            if not self.files.exists(to):
                raise
            self.files.delete(own, False)
            return False
        return True

    def delete(self, name: str) -> None:
        self.files.delete(self.path(f"{self.target}/{name}"), True)

    def forget(self, keep: int = KEPT) -> None:
        """Deletes older manifests, and the folders of parts that only they name."""
        numbers = self.numbers()
        places = lambda v: {f"data/{folder}/part={name}" for name, (folder, _) in v.parts.items() if folder}
        held = set().union(*(places(self.read(n)) for n in numbers[-keep:]))
        for n in numbers[:-keep]:
            for place in places(self.read(n)) - held:
                self.delete(place)
            self.delete(f"log/{n:012d}.json")


def slot(key: str, depth: int) -> Column:
    return F.xxhash64(F.col(f"`{key}`")).bitwiseAND(F.lit((1 << depth) - 1))


def placed(spark: SparkSession, rows: DataFrame, key: str, parts: list[str]) -> DataFrame:
    """rows with the name of their part."""
    split = [(name, *map(int, name.split("-"))) for name in parts]
    depth = max(d for _, d, _ in split)
    own = spark.createDataFrame(split, "_part string, depth int, value long")
    slots = own.select("_part", F.explode(F.sequence(F.col("value"), F.lit((1 << depth) - 1), F.expr("cast(shiftleft(1L, depth) as bigint)"))).alias("_slot"))
    hint = F.broadcast if 1 << depth <= BROADCAST_SLOTS else (lambda x: x)
    return rows.withColumn("_slot", slot(key, depth)).join(hint(slots), "_slot").drop("_slot")


def deeper(name: str, rows: int, part_rows: int) -> list[str]:
    """The parts that a part of so many rows goes on as."""
    depth, value = map(int, name.split("-"))
    more = max(0, math.ceil(math.log2(max(1, rows) / part_rows)))
    return [f"{depth + more}-{value + (i << depth)}" for i in range(1 << more)]


def read_parts(spark: SparkSession, target: str, version: Version, names: list[str] | None = None) -> DataFrame:
    paths = [f"{target.rstrip('/')}/data/{folder}/part={name}" for name, (folder, _) in version.parts.items() if folder and (names is None or name in names)]
    return spark.read.schema(version.fields).parquet(*paths) if paths else spark.createDataFrame([], version.fields)


def read_version(spark: SparkSession, target: str, number: int | None = None) -> DataFrame:
    """The rows of the last version, or of one that is still kept."""
    version = Log(spark, target).read(number)
    if version is None:
        raise ValueError(f"no version in {target}")
    return read_parts(spark, target, version)


def merge(
    spark: SparkSession, target: str, rows: DataFrame, key: str, combine: Callable[[DataFrame, DataFrame], DataFrame], source: str | None = None, batch: int = 0, part_rows: int = PART_ROWS, keep: int = KEPT,
) -> Version:
    """A new version: combine(rows of the table, new rows) of the parts that the new rows have keys of; other parts stay as they
    are. combine gives one row a key, with the table's columns. Rows with a null key could not be found again: they are left out.

    source and batch: a batch that this source, or a later one of it, has already brought is left out. A table takes its
    columns from the first rows; later ones need them all.
    """
    log, rows = Log(spark, target), rows.filter(F.col(f"`{key}`").isNotNull())
    for _ in range(TRIES):
        now = log.read() or Version(-1, rows.schema.json(), key, {"0-0": ["", 0]})
        if now.key != key:
            raise ValueError(f"the table's key is {now.key}, not {key}")
        if source is not None and now.batches.get(source, -1) >= batch:
            return now
        columns = now.fields.names
        fresh = rows.select(*[F.col(f"`{c}`") for c in columns])
        counts = placed(spark, fresh, key, list(now.parts)).groupBy("_part").agg(F.approx_count_distinct(F.col(f"`{key}`")).alias("n")).collect()  # a row a part
        touched = {r["_part"]: r.n for r in counts}
        goes_on = [x for name, n in touched.items() for x in deeper(name, now.parts[name][1] + n, part_rows)]
        folder, parts = uuid.uuid4().hex, {k: v for k, v in now.parts.items() if k not in touched} | {k: ["", 0] for k in goes_on}
        if goes_on:
            new = combine(read_parts(spark, target, now, list(touched)), fresh).select(*[F.col(f"`{c}`") for c in columns])
            placed(spark, new, key, goes_on).withColumnRenamed("_part", "part").repartition(len(goes_on), "part").write.partitionBy("part").parquet(f"{target.rstrip('/')}/data/{folder}")
            written = spark.read.schema(T.StructType([*now.fields, T.StructField("part", T.StringType())])).parquet(f"{target.rstrip('/')}/data/{folder}")
            parts |= {r.part: [folder, r["count"]] for r in written.groupBy("part").count().collect()}  # a row a part
        version = replace(now, number=now.number + 1, parts=parts, batches=now.batches | ({source: batch} if source is not None else {}))
        if log.publish(version):
            log.forget(keep)
            return version
        log.delete(f"data/{folder}")
    raise RuntimeError(f"{TRIES} merges into {target} found another writer's version before theirs")
