"""Sharding by a two-pass external shuffle.

Pass 1 scatters the rows by seeded hashes: highest random weight gives the shard, so the key and the number of shards
alone decide it and one more shard only takes rows into itself; a second seeded hash gives one of the shard's
memory-sized buckets. Equal rows that together would fill a good part of a bucket are counted first, and each copy's
number goes into its bucket's hash, so that they scatter like others. Pass 2 shuffles each bucket by Fisher and Yates
with a seed of its own and writes it. A shard is its buckets in order; slots are gapless from 0.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql import Window as W

from .shared import column_after, free_name, new_folder, staged, unclash

#: Bytes of text that one bucket holds on average; a bucket is shuffled in the memory of one task.
BUCKET_BYTES = 8 << 20
#: Equal rows of more than this part of a bucket's bytes scatter by number; copies that one row is drawn to at a time.
HOT_PART, COPIES = 0.125, 4096
#: Bytes of the buckets that one task shuffles, one bucket after the other.
TASK_BYTES = 32 << 20
#: A table of bucket counts up to this number of rows (24 bytes each) is broadcast; a larger one is joined by shuffle.
BROADCAST_BUCKETS = 500_000
SEED = 20240229
OWN = ("shard", "bucket", "pos", "slot", "_before")


def shard_of(key: Column, n_shards: int, seed: int = SEED) -> Column:
    """Highest random weight: the shard whose hash with the key is greatest. A null key has hashes of its own."""
    known = F.coalesce(key.cast("string"), F.lit("\x00null"))
    weights = F.transform(F.sequence(F.lit(0), F.lit(n_shards - 1)), lambda i: F.struct(F.xxhash64(known, i, F.lit(seed)).alias("h"), i.alias("i")))
    return F.array_max(weights)["i"]


def row_hash(df: DataFrame, *extra) -> Column:
    """A hash of `extra` and the whole row that tells nulls and signs of zero apart, which xxhash64 itself doesn't; nested
    columns count by their JSON text."""
    cols = []
    for f in df.schema:
        c, kind = F.col(f"`{f.name}`"), f.dataType.typeName()
        if kind in ("array", "struct", "map", "variant"):
            c = F.to_json(F.struct(c), {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})
        elif kind in ("float", "double"):
            c = c.cast("string")
        cols += [c, c.isNull()]
    return F.xxhash64(*map(F.lit, extra), *cols)


def scattered(docs: DataFrame, order: str, n_shards: int, key: str, text: str, seed: int, bucket_bytes: int) -> DataFrame:
    """`docs` with shard, bucket and `order` (the hash of the row, which equal rows share), dealt by shard and bucket.

    A shard has as many buckets as its own bytes ask for, so a key with a large part of all rows gets many. Equal rows (of
    one 128-bit hash) can stand for each other: of those that are many, one row and their number stay, and the copies are
    drawn from it again, each with a number of its own. So buckets don't depend on where the copies lay.
    """
    size = F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)) + 64
    shard = shard_of(F.col(f"`{key}`"), n_shards, seed).cast("int")
    counts = docs.groupBy(row_hash(docs, seed).alias("one"), row_hash(docs, ~seed).alias("two"), shard.alias("of")).agg(F.count("*").alias("times"), F.sum(size.cast("long")).alias("bytes"))
    counts = staged(counts, "counts")
    held = {r["of"]: r["bytes"] for r in counts.groupBy("of").agg(F.sum("bytes").alias("bytes")).collect()}  # a row a shard
    total, per_shard = sum(held.values()), {k: max(1, -(-n // bucket_bytes)) for k, n in held.items()}
    n_buckets = sum(per_shard.values())
    # at most 8 such rows a bucket on average
    several = F.array(*[F.lit(per_shard.get(k, 1)) for k in range(n_shards)])
    hot = counts.filter((F.col("times") > 1) & (F.col("bytes") > HOT_PART * bucket_bytes)) if n_buckets > len(per_shard) else counts.limit(0)
    hashed = docs.withColumn(order, row_hash(docs, seed)).withColumn("shard", shard)
    bucket = lambda *number: F.pmod(F.xxhash64(F.lit(seed + 1), F.col(order), *number), several[F.col("shard")].cast("long")).cast("int")
    if n_hot := hot.count():
        hint = F.broadcast if n_hot <= BROADCAST_BUCKETS else (lambda x: x)
        other, times, start, number = (free_name(hashed, n) for n in ("_other", "_times", "_start", "_number"))
        known = hot.select(F.col("one").alias("_one"), F.col("two").alias("_two"), F.col("times").alias(times))
        same = (F.col(order) == F.col("_one")) & (F.col(other) == F.col("_two"))
        marked = hashed.withColumn(other, row_hash(docs, ~seed))
        plain = marked.join(hint(known), same, "left_anti").withColumn("bucket", bucket()).drop(other)
        whole = F.struct(*[F.col(f"`{c}`") for c in hashed.columns])
        single = marked.join(hint(known), same).groupBy(other, order, times).agg(F.first(whole).alias("_row"))
        drawn = single.select("_row", times, F.explode(F.sequence(F.lit(0).cast("long"), F.col(times) - 1, F.lit(COPIES).cast("long"))).alias(start)).repartition(F.col(f"_row.`{order}`"), start)
        copies = drawn.select("_row.*", F.explode(F.sequence(F.col(start), F.least(F.col(start) + COPIES, F.col(times)) - 1)).alias(number))
        out = plain.unionByName(copies.withColumn("bucket", bucket(F.col(number))).drop(number))
    else:
        out = hashed.withColumn("bucket", bucket())
    # so many partitions that a task's buckets are bounded in bytes
    return out.repartition(min(max(1, n_buckets), max(1, -(-total // TASK_BYTES), docs.sparkSession.sparkContext.defaultParallelism * 2)), "shard", "bucket")


def write_shards(docs: DataFrame, path: str, n_shards: int = 40, key: str = "doc_id", text: str = "text", seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> None:
    """Writes all rows of `docs` to path/shard=K/ in shuffled order, with columns bucket and pos beside their own.

    Rows with a null key or null text are sharded like others; repeated rows stay; an empty table gives no files.
    Columns of `docs` named shard, bucket or pos are kept under a leading underscore.
    """
    docs, moved = unclash(docs, [*OWN, "_one", "_two", "_row"])
    key, text = column_after(moved, key), column_after(moved, text)
    order, schema = free_name(docs, "_order"), T.StructType([*docs.schema, T.StructField("shard", T.IntegerType()), T.StructField("bucket", T.IntegerType()), T.StructField("pos", T.LongType())])

    def fisher_yates(pdf: pd.DataFrame) -> pd.DataFrame:
        # rows come in any order: the hash of the whole row gives the order that the seeded shuffle starts from
        pdf = pdf.sort_values(order, kind="stable")
        rng = np.random.Generator(np.random.PCG64([seed, int(pdf["shard"].iloc[0]), int(pdf["bucket"].iloc[0])]))
        picks = np.arange(len(pdf))
        swaps = rng.integers(0, np.arange(len(pdf), 0, -1)) if len(pdf) else picks
        for i, j in enumerate(swaps.tolist()):  # position i takes one of the rows not yet placed
            picks[i], picks[i + j] = picks[i + j], picks[i]
        return pdf.iloc[picks].assign(pos=np.arange(len(pdf)))[[f.name for f in schema]]

    dealt = scattered(docs, order, n_shards, key, text, seed, bucket_bytes)
    dealt.groupBy("shard", "bucket").applyInPandas(fisher_yates, schema).write.partitionBy("shard").parquet(path)


def read_shards(spark, path: str, schema: T.StructType) -> DataFrame:
    """The rows of written shards with shard and slot: a bucket's rows follow those of the shard's buckets before it."""
    rows = spark.read.schema(schema).parquet(path)
    counts = rows.groupBy("shard", "bucket").count()
    before = counts.select("shard", "bucket", (F.sum("count").over(W.partitionBy("shard").orderBy("bucket")) - F.col("count")).alias("_before"))
    before = staged(before, "offsets")
    hint = F.broadcast if before.count() <= BROADCAST_BUCKETS else (lambda x: x)
    return rows.join(hint(before), ["shard", "bucket"]).withColumn("slot", F.col("_before") + F.col("pos")).drop("_before")


def shard(docs: DataFrame, n_shards: int = 40, key: str = "doc_id", text: str = "text", seed: int = SEED, bucket_bytes: int = BUCKET_BYTES, path: str | None = None) -> DataFrame:
    """write_shards() to `path` (or a fresh folder in the shared one), then read_shards().

    A text of any length is one row of one bucket. Buckets hold about bucket_bytes. Rows are spread over the buckets of
    their shard by the hash of the whole row, so rows with a null key too; repeated rows by that hash, and where they
    are many also by their number. Reruns agree, whatever the partitions.
    """
    path = path or new_folder(docs.sparkSession, "shards")
    write_shards(docs, path, n_shards, key, text, seed, bucket_bytes)
    schema = T.StructType([*unclash(docs, [*OWN, "_one", "_two", "_row"])[0].schema, *(T.StructField(n, t) for n, t in (("bucket", T.IntegerType()), ("pos", T.LongType()), ("shard", T.IntegerType())))])
    return read_shards(docs.sparkSession, path, schema)
