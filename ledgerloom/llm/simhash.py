"""Near-duplicates by SimHash, compared exactly tile by tile.

Distinct fingerprints are dealt into tiles by the population counts of equal parts of their bits. Two fingerprints
within the radius have counts whose differences sum to at most the radius, so pairs of tiles whose counts differ by
more are skipped; all others are compared in full, by exclusive or and bit counts. A pair of tiles sends on only links
that span its groups, and components are found on those links.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from .shared import column_after, drop_staged, free_name, new_folder, staged, text_slices, unclash

#: Fingerprints of a tile (128 KB: what travels for each pair of tiles), and of them those that are compared at a time.
TILE, ROWS = 16384, 64
#: Shingles whose bits are counted at a time.
STEP = 1 << 16


def fingerprint(text: str, words: int = 3, seed: int = 42) -> int:
    """A bit is set if more than half of the hashes of the word shingles have it. No words: 0."""
    own = text.encode().lower().split()  # bytes: only A-Z change, and only space and \\t to \\r split
    if not own:
        return 0
    shingles = own if words == 1 else [b" ".join(own)] if len(own) < words else list(map(b" ".join, zip(*(own[i:] for i in range(words)))))
    digest = xxhash.xxh64_intdigest
    total = np.zeros(64, np.int64)
    for at in range(0, len(shingles), STEP):
        part = np.array([digest(s, seed) for s in shingles[at : at + STEP]], "<u8")
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(shingles), bitorder="little").tobytes(), "little")


def with_fingerprints(docs: DataFrame, text: str = "text", words: int = 3, name: str = "fp") -> DataFrame:
    """The columns of `docs` but the text, and the fingerprint as a long (its 64 bits). A null text has fingerprint 0."""
    kept = [c for c in docs.columns if c != text]
    source = docs.select(*[F.col(f"`{c}`") for c in (*kept, text)])
    schema = T.StructType([*source.select(*[F.col(f"`{c}`") for c in kept]).schema, T.StructField(name, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches, text):
            found = np.array([fingerprint(t or "", words) for t in texts], "<u8").astype("<i8", casting="unsafe") if texts else np.zeros(0, "<i8")
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.int64())], [*kept, name])

    return source.mapInArrow(run, schema)


def parts_for(n: int) -> int:
    """Into how many parts the 64 bits go for n fingerprints, so that tiles are well filled and few pairs of tiles meet."""
    return 1 if n < 20_000 else 2 if n < 4_000_000 else 4


def steps(parts: int, radius: int) -> list[list[int]]:
    """Differences of population counts whose sizes sum to at most the radius, one of each pair of opposites, and zero."""
    found = [d for d in itertools.product(range(-radius, radius + 1), repeat=parts) if sum(map(abs, d)) <= radius]
    return [list(d) for d in found if d >= (0,) * parts]


def spanning(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """For two tiles, each linked fingerprint with the least one (as signed) that links of these tiles lead to. Links are
    thinned as they are found, so that a dense group takes no square of memory."""
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for at in range(0, len(a), ROWS):
        i, j = np.nonzero(np.bitwise_count(a[at : at + ROWS, None] ^ b[None, :]) <= radius)
        x, y = a[i + at].view(np.int64), b[j].view(np.int64)
        if (x != y).any():
            x, y = thinned(x, y)
            left.append(x)
            right.append(y)
    return thinned(np.concatenate(left), np.concatenate(right))


def thinned(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of links between longs, those of each node to the least node of its group."""
    apart = a != b
    nodes, ends = np.unique(np.concatenate([a[apart], b[apart]]), return_inverse=True)
    left, right = ends[: apart.sum()], ends[apart.sum() :]
    label = np.arange(len(nodes))
    while True:
        new = label.copy()
        np.minimum.at(new, left, label[right])
        np.minimum.at(new, right, label[left])
        new = new[new]
        if (new == label).all():
            break
        label = new
    off = label != np.arange(len(nodes))
    return nodes[off], nodes[label[off]]


def near_links(prints: DataFrame, radius: int = 3, tile: int = TILE) -> DataFrame:
    """Links (a, b) between the distinct longs in column fp of `prints` that span the groups within the radius.

    `prints` should be a stored table. No pair within the radius is missed; links inside a group come thinned.
    """
    spark = prints.sparkSession
    parts = parts_for(prints.count())
    width = 64 // parts
    count = F.array(*[F.bit_count(F.shiftrightunsigned("fp", i * width).bitwiseAND(F.lit(-1 if width == 64 else (1 << width) - 1))) for i in range(parts)])
    counted = prints.select("fp", count.alias("counts"))
    # at most (64 / parts + 1) ** parts rows: 65, 1,089 or 83,521
    classes = counted.groupBy("counts").agg(F.ceil(F.count("*") / tile).cast("int").alias("tiles"))
    dealt = counted.join(F.broadcast(classes), "counts").withColumn("tile", F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int"))
    tiles = staged(dealt.groupBy("counts", "tile").agg(F.collect_list("fp").alias("fps")), "tiles")
    known = tiles.groupBy("counts").agg((F.max("tile") + 1).alias("tiles"))
    step = F.explode(F.array(*[F.array(*map(F.lit, d)) for d in steps(parts, radius)]))
    sent = (
        tiles.select("counts", "tile", "fps", step.alias("step"))
        .select(F.col("counts").alias("from_counts"), F.col("tile").alias("from_tile"), F.col("fps").alias("others"), F.zip_with("counts", "step", lambda x, y: x + y).alias("counts"))
        .join(F.broadcast(known), "counts")
        .withColumn("tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .filter((F.col("from_counts") != F.col("counts")) | (F.col("from_tile") <= F.col("tile")))
        .select("counts", "tile", "others")
    )

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [spanning(np.asarray(x, np.int64).view(np.uint64), np.asarray(y, np.int64).view(np.uint64), radius) for x, y in zip(pdf["others"], pdf["fps"], strict=True)]
            if found:
                yield pd.DataFrame({"a": np.concatenate([x for x, _ in found]), "b": np.concatenate([y for _, y in found])})

    slots = spark.sparkContext.defaultParallelism
    pairs = sent.join(tiles, ["counts", "tile"]).select("others", "fps").repartition(max(slots * 2, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return pairs.mapInPandas(compare, "a long, b long").distinct()


def components(links: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, root): each end of a link with the least node of its component. links: (a, b), longs, undirected.

    Large-star and small-star steps by turns, each written to the shared folder, until nothing changes.
    """
    spark = links.sparkSession

    def large(e: DataFrame) -> DataFrame:  # each larger neighbour of a node is linked to the least of its neighbours and itself
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()

    def small(e: DataFrame) -> DataFrame:  # a node and its smaller neighbours are linked to the least of them
        down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        rest = down.join(least, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return rest.unionByName(least.select("a", F.col("m").alias("b"))).distinct()

    def store(e: DataFrame) -> tuple[DataFrame, str, tuple]:
        path = new_folder(spark, "links")
        e.write.parquet(path)
        e = spark.read.schema("a long, b long").parquet(path)
        return e, path, tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges, path, sign = store(links)
    for _ in range(rounds):
        if not sign[0]:
            break
        new, new_path, new_sign = store(small(large(edges)))
        done = new_sign == sign
        drop_staged(spark, path)
        edges, path, sign = new, new_path, new_sign
        if done:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


OUT = ("fp", "root", "fingerprint", "component_id")


def grouped(docs: DataFrame, key: str, text: str, radius: int, words: int) -> DataFrame:
    """The columns of `docs` but the text, with fp, root (the least fingerprint of the component) and component_id."""
    prints = staged(with_fingerprints(docs, text, words), "fingerprints")
    each = staged(prints.groupBy("fp").agg(F.min(f"`{key}`").alias("least")), "distinct")
    roots = components(near_links(each, radius))
    rooted = each.join(roots, each["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(rooted.join(named, "root").select("fp", "root", "component_id"), "fp", "left")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = 3, words: int = 3) -> DataFrame:
    """`docs` but its text, with fingerprint (16 hexadecimal digits) and component_id: the smallest key reachable over
    links of `radius` or fewer differing bits, its own included.

    Texts without words have fingerprint zero and link like any other; so do null texts. Rows with a null key take part;
    only where no row of a component has a key is its component_id null. Repeated rows share one fingerprint. Columns of
    `docs` named like the new ones get an underscore before them; if the key or the text is one of those, it is still the
    one that is read. No rows give no rows.
    """
    docs, moved = unclash(docs, [*OUT, "least"])
    key, text = column_after(moved, key), column_after(moved, text)
    return grouped(docs, key, text, radius, words).withColumn("fingerprint", F.lower(F.lpad(F.hex("fp"), 16, "0"))).drop("fp", "root")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = 3, words: int = 3) -> DataFrame:
    """The columns of `docs` for one document of each group: the one with the smallest key. Of a group's rows that repeat
    that key one stays, as does one of a group without any key. Groups that share a key have one row each."""
    narrow = docs.select(F.col(f"`{key}`").alias("own_key"), F.xxhash64(F.col(f"`{text}`")).alias("own_hash"), F.col(f"`{text}`").alias("own_text"))
    return keep_first(docs, staged(grouped(narrow, "own_key", "own_text", radius, words), "groups"), key, text)


#: Rows that go, and rows that are there more than once, are broadcast up to this number (32 bytes each).
BROADCAST_ROWS = 500_000


def keep_first(docs: DataFrame, found: DataFrame, key: str, text: str) -> DataFrame:
    """keep_one() by a stored table of groups: own_key, own_hash (of the text), root and component_id of each row.

    A text has one root, so a key and a hash belong to one group. What goes, or is repeated, is mostly the small part: it
    is sent to the texts, and only repeated rows are shuffled. Where it is not, the texts are joined with what stays.
    """
    same = lambda a, b: a["own_key"].eqNullSafe(b["own_key"]) & (a["own_hash"] == b["own_hash"])
    pairs = found.groupBy("own_key", "own_hash").agg(F.count("*").alias("times"), F.first("root").alias("root"), F.first("component_id").alias("component_id"))
    wins = pairs.filter(F.col("own_key").eqNullSafe(F.col("component_id"))).groupBy("root").agg(F.min(F.struct("own_hash", "own_key")).alias("w")).select("w.own_key", "w.own_hash", F.lit(True).alias("stays"))
    marked = staged(pairs.join(wins, same(pairs, wins), "left").select(pairs["own_key"].alias("own_key"), pairs["own_hash"].alias("own_hash"), "times", F.coalesce("stays", F.lit(False)).alias("stays")), "marked")
    columns, names = [F.col(f"`{c}`") for c in docs.columns], {n: free_name(docs, f"_{n}") for n in ("own_key", "own_hash", "times", "stays", "hash")}
    hashed = docs.withColumn(names["hash"], F.xxhash64(F.col(f"`{text}`")))
    met = F.col(f"`{key}`").eqNullSafe(F.col(names["own_key"])) & (F.col(names["hash"]) == F.col(names["own_hash"]))
    special = marked.filter("times > 1 or not stays").withColumnsRenamed({n: names[n] for n in ("own_key", "own_hash", "times", "stays")})
    if special.count() > BROADCAST_ROWS:
        kept = marked.filter("stays").withColumnsRenamed({n: names[n] for n in ("own_key", "own_hash", "times", "stays")})
        return hashed.join(kept, met).dropDuplicates([names["own_key"], names["own_hash"]]).select(*columns)
    single = hashed.join(F.broadcast(special), met, "left_anti").select(*columns)
    repeated = hashed.join(F.broadcast(special.filter(F.col(names["stays"]))), met).dropDuplicates([names["own_key"], names["own_hash"]])
    return single.unionByName(repeated.select(*columns))
