"""Target-distribution importance resampling by hashed n-gram features.

Texts are lower-cased (A-Z) and cut into words by the tokenizers library: an untrained Split by a regular expression, which
returns words with their offsets. Windows of words, as pairs of offsets, are the features; a feature's bucket is the CRC-32
of its bytes. Histograms of all documents and of the target give each bucket a gain (log ratio of smoothed shares); a
document's weight is the mean gain of its features, and Gumbel noise from a hash of its key makes the highest scores a draw
without replacement.

Texts are read once: buckets of features (2 or 4 bytes each) go to the shared folder. Histograms are sums of one array a
task. The draw's threshold comes from counts of scores, and only drawn rows are ordered, by ranges, so no task ranks all.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from .shared import column_after, small_batches, staged, text_slices, unclash

#: ASCII letters and digits of lower-cased text, and everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Buckets are an array in a task and a table on the driver: at most so many.
MOST_BUCKETS = 1 << 20


def features(texts: list[str], low: int, high: int) -> tuple[list[str], np.ndarray, np.ndarray]:
    """All runs of `low` to `high` words of lower-cased texts, end to end; how many each text has; and its words."""
    from tokenizers import Regex, pre_tokenizers

    split = pre_tokenizers.Split(Regex(WORD), "removed", invert=True)
    out: list[str] = []
    counts, n_words = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        words = split.pre_tokenize_str(text)
        n_words[i], before = len(words), len(out)
        if low == 1:
            out += [w for w, _ in words]
        for n in range(max(2, low), min(high, len(words)) + 1):
            # a window is the text between its first word's begin and its last word's end, where single spaces part its words
            near = [0, *np.cumsum([b[0] - a[1] == 1 and text[a[1]] == " " for (_, a), (_, b) in zip(words, words[1:], strict=False)]).tolist()]
            for k in range(len(words) - n + 1):
                if near[k + n - 1] - near[k] == n - 1:
                    out.append(text[words[k][1][0] : words[k + n - 1][1][1]])
                else:
                    out.append(" ".join(w for w, _ in words[k : k + n]))
        counts[i] = len(out) - before
    return out, counts, n_words


def bucketed(docs: DataFrame, key: str, text: str, low: int, high: int, buckets: int) -> DataFrame:
    """key, part, row (its place, so that like rows can be told apart), n_words, n_features and buckets (binary)."""
    kind = docs.schema[key].dataType
    schema = T.StructType([T.StructField(key, kind), *T._parse_datatype_string("part int, row long, n_words long, n_features long, buckets binary")])
    code = "<u2" if buckets <= 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row = TaskContext.get().partitionId(), 0
        for batch, texts in text_slices(batches):
            lowered = pc.ascii_lower(pa.array([t or "" for t in texts], pa.large_string())).to_pylist()
            found, counts, words = features(lowered, low, high)
            coded = pa.array(found, pa.large_string()).dictionary_encode()
            known = np.fromiter((zlib.crc32(x.encode()) % buckets for x in coded.dictionary.to_pylist()), code, len(coded.dictionary))
            data = known[coded.indices.to_numpy(zero_copy_only=False)].tobytes()
            ends = (np.cumsum(counts) * np.dtype(code).itemsize).tolist()
            own = [data[a:b] for a, b in zip([0, *ends], ends, strict=False)]
            n = len(texts)
            arrays = [batch.column(0), pa.array([part] * n, pa.int32()), pa.array(range(row, row + n), pa.int64()), pa.array(words), pa.array(counts), pa.array(own, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, schema.names)
            row += n

    with small_batches(docs.sparkSession):
        return staged(docs.select(F.col(f"`{key}`"), F.col(f"`{text}`").alias("text")).mapInArrow(run, schema), "buckets")


def histogram(rows: DataFrame, buckets: int) -> list[int]:
    """How many features fall in each bucket: one array a task, summed. `buckets` rows come to the driver."""
    code = "<u2" if buckets <= 1 << 16 else "<u4"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for x in batch.column(0):
                total += np.bincount(np.frombuffer(x.as_py(), code), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], ["bucket", "n"])

    out = [0] * buckets
    for r in rows.select("buckets").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(source: list[int], target: list[int]) -> list[int]:
    """Thousandths of the log ratio of each bucket's smoothed shares in the target and in all documents, rounded down."""
    n, big, small = len(source), float(sum(source)), float(sum(target))
    return [math.floor(1000 * math.log(((t + 1.0) * (big + n)) / ((s + 1.0) * (small + n)))) for s, t in zip(source, target, strict=True)]


def ranked(rows: DataFrame, order: list) -> DataFrame:
    """rows with rank: 1, 2, 3... in a total order, by sorted ranges and the counts of those before."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = T.StructType([*rows.schema, *T._parse_datatype_string("range int, place long")])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, place = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([own] * n, pa.int32()), pa.array(range(place + 1, place + n + 1), pa.int64())], schema.names)
            place += n

    placed = staged(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(number, schema), "ranked")
    before, total = {}, 0
    for r in sorted(placed.groupBy("range").agg(F.max("place").alias("n")).collect(), key=lambda r: r["range"]):  # a row a range
        before[r["range"]], total = total, total + r.n
    if not before:
        return placed.withColumn("rank", F.col("place")).drop("range", "place")
    offsets = F.create_map(*[F.lit(x).cast(t) for k, v in before.items() for x, t in ((k, "int"), (v, "long"))])
    return placed.withColumn("rank", F.col("place") + offsets[F.col("range")]).drop("range", "place")


def resample(
    docs: DataFrame, target: DataFrame, words: tuple[int, int] = (1, 1), buckets: int = 10_000, percent: int = 10, least: int = 20, seed: int = 2024, key: str = "doc_id", text: str = "text", target_text: str = "text",
) -> DataFrame:
    """Each document's key, n_features, weight, score and rank; rank is null where it isn't drawn.

    Of the documents with `least` words or more, `percent` of a hundred (rounded down) are drawn: highest scores, ties to
    the smaller key. A null or empty text has no features and weight 0; a null key comes after all others, with the hash of
    an empty one. Repeated rows each count and are each drawn or not; rows that share a key and a score are ordered by
    their other results, and those that share these as well by where they were read, which changes no result. Texts of any length are whole. An empty
    table gives no rows; an empty target gives gains from the documents alone. Other columns are dropped.
    """
    if not 0 < buckets <= MOST_BUCKETS:
        raise ValueError(f"from 1 to {MOST_BUCKETS} buckets")
    spark, low, high = docs.sparkSession, *words
    docs, moved = unclash(docs, ("part", "row", "n_words", "n_features", "buckets", "text", "weight", "score", "rank", "h"))
    own_key, own_text = column_after(moved, key), column_after(moved, text)
    rows = bucketed(docs, own_key, own_text, low, high, buckets)
    aim = target.select(F.lit(0).alias("key"), F.col(f"`{target_text}`").alias("words_of"))
    gain = gains(histogram(rows, buckets), histogram(bucketed(aim, "key", "words_of", low, high, buckets), buckets))
    shared, code = spark.sparkContext.broadcast(np.array(gain, np.int64)), "<u2" if buckets <= 1 << 16 else "<u4"

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [np.frombuffer(x, code) for x in batch.column(batch.num_columns - 1).to_pylist()]
            weights = [int(shared.value[x].sum()) // len(x) if len(x) else 0 for x in own]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(weights, pa.int64())], [*batch.schema.names[:-1], "weight"])

    weighed = rows.mapInArrow(weigh, T.StructType([*rows.schema[:-1], T.StructField("weight", T.LongType())]))
    name = F.col(f"`{own_key}`")
    hashed = F.conv(F.substring(F.sha2(F.encode(F.concat(F.lit(f"{seed}:"), F.coalesce(name.cast("string"), F.lit(""))), "UTF-8"), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.ln(-F.ln((hashed + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")
    scored = staged(weighed.withColumn("score", F.col("weight") + noise), "scored")
    counts = scored.filter(F.col("n_words") >= least).groupBy("score").count()
    # scores are whole thousandths of bounded logarithms, so there are at most some hundred thousand of them
    by_score = sorted(map(tuple, counts.collect()), reverse=True)
    draw, above, threshold = sum(n for _, n in by_score) * percent // 100, 0, None
    for score, n in by_score:
        if above >= draw:
            break
        above, threshold = above + n, score
    drawn = F.lit(False) if threshold is None else (F.col("n_words") >= least) & (F.col("score") >= threshold)
    order = [F.col("score").desc(), name.asc_nulls_last(), F.col("n_features"), F.col("weight"), F.col("part"), F.col("row")]
    top = ranked(scored.filter(drawn), order)
    columns = [name.alias(key), "n_features", "weight", "score"]
    rank = F.when(F.col("rank") <= draw, F.col("rank"))
    return top.select(*columns, rank.alias("rank")).unionByName(scored.filter(~drawn).select(*columns, F.lit(None).cast("long").alias("rank")))
