"""Near copies by the shared part of their word shingles: five words, Jaccard similarity 0.8 or more, links followed on.

Distinct sets of shingles get a SimHash of 256 bits. Sets are dealt into tiles by classes of their size: a pair at the
least similarity is in one class or in neighbouring ones, and only those tiles meet, but for pairs whose population counts
differ beyond the radius. Sketches within the radius make
candidate groups (thinned links, so that a large group costs no square of rows); inside each group, cut into blocks of
bounded size, all pairs of sets are compared exactly, and only pairs at the least similarity are linked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from .shared import staged, text_slices
from .simhash import components, keep_first, thinned

WORDS = 5
#: The least similarity, as a fraction in whole numbers.
LEAST = (4, 5)
#: Radius of the sketches (256 bits), and of their first 64 bits, which are compared before the rest.
RADIUS, FIRST_RADIUS = 64, 24
#: Sizes of a class of sizes differ by less than this ratio, which is over 5 / 4.
RATIO = 1.26
#: What a tile has of each set; columns of a tile; most bands of a class, each of which meets each.
NAMES, TILED, BANDS = ("set_id", "n", "w0", "w1", "w2", "w3"), ("tile", "low", "high", "own"), 32
#: Sketches of a tile; sets and shingles of a block.
TILE, BLOCK, BLOCK_SHINGLES = 8192, 512, 1 << 19
#: A table of members up to this number of rows is broadcast.
BROADCAST_MEMBERS = 200_000
#: Odd factors that make further hash words of one.
FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
STEP = 1 << 14


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; of a text with fewer words the one of all its words. No words: none."""
    own = text.encode().lower().split()
    if not own:
        return np.zeros(0, np.uint64)
    parts = [b" ".join(own)] if len(own) < words else map(b" ".join, zip(*(own[i:] for i in range(words))))
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(s, 42) for s in parts], np.uint64))


def sketch(hashes: np.ndarray) -> np.ndarray:
    """SimHash of a set in four words: a bit is set if more than half of the hashes have it."""
    total = np.zeros(256, np.int64)
    for at in range(0, len(hashes), STEP):
        part = hashes[at : at + STEP]
        more = [part * np.uint64(f) for f in FACTORS]
        mixed = np.stack([part, *((x ^ (x >> np.uint64(31))) * np.uint64(FACTORS[0]) ^ (x >> np.uint64(17)) for x in more)], axis=1)
        total += np.unpackbits(mixed.astype("<u8").view(np.uint8).reshape(-1, 32), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(2 * total > len(hashes), bitorder="little").view("<u8")


def with_sketches(docs: DataFrame, text: str) -> DataFrame:
    """The columns of `docs` but the text, and of its set of shingles: set_id (a hash of it), n (its size), w0 to w3."""
    kept = [c for c in docs.columns if c != text]
    source = docs.select(*[F.col(f"`{c}`") for c in (*kept, text)])
    schema = T.StructType([*source.select(*[F.col(f"`{c}`") for c in kept]).schema, *T._parse_datatype_string("set_id long, n long, w0 long, w1 long, w2 long, w3 long")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches, text):
            rows = np.zeros((len(texts), 6), np.uint64)
            for i, t in enumerate(texts):
                found = shingles(t or "")
                rows[i, 0], rows[i, 1], rows[i, 2:] = xxhash.xxh64_intdigest(found.tobytes(), 42), len(found), sketch(found)
            columns = [pa.array(np.ascontiguousarray(rows[:, k]).view(np.int64), pa.int64()) for k in range(6)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], schema.names)

    return source.mapInArrow(run, schema)


def close(a: dict[str, np.ndarray], b: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Links between set_ids of two tiles whose sizes allow the least similarity and whose sketches are within the radius,
    thinned as they are found, so that a dense group takes no square of memory."""
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for at in range(0, len(a["n"]), 64):
        i, j = np.nonzero(np.bitwise_count(a["w0"][at : at + 64, None] ^ b["w0"][None, :]) <= FIRST_RADIUS)
        i += at
        x, y = a["n"][i], b["n"][j]
        able = LEAST[1] * np.minimum(x, y) >= LEAST[0] * np.maximum(x, y)
        i, j = i[able], j[able]
        near = sum(np.bitwise_count(a[w][i] ^ b[w][j]).astype(np.int64) for w in ("w0", "w1", "w2", "w3")) <= RADIUS
        x, y = a["set_id"][i[near]], b["set_id"][j[near]]
        if (x != y).any():
            x, y = thinned(x, y)
            left.append(x)
            right.append(y)
    return thinned(np.concatenate(left), np.concatenate(right))


def candidate_links(sets: DataFrame, tile: int = TILE) -> DataFrame:
    """Links (a, b) between set_ids that span the groups of sketches within the radius. sets: a stored table.

    The tiles of a class lie in at most BANDS bands. What meets are bands, those of a class with each other and with those
    of the next class, so a tile travels a bounded number of times, however many tiles there are.
    """
    kept = sets.filter("n > 0").withColumn("class", F.floor(F.log("n") / float(np.log(RATIO))).cast("int"))
    # a class for each 26 % of size: about 100 for any text that fits in memory
    classes = kept.groupBy("class").agg(F.ceil(F.count("*") / tile).cast("int").alias("tiles"))
    dealt = kept.join(F.broadcast(classes), "class").withColumn("tile", F.pmod(F.xxhash64("set_id"), F.col("tiles")).cast("int"))

    def pack(group: pa.Table) -> pa.Table:
        words = {n: group.column(n).to_numpy() for n in NAMES}
        counts = np.bitwise_count(words["w0"].view(np.uint64))
        own = np.stack([words[n].view(np.int64) for n in NAMES]).tobytes()
        one = {"class": group.column("class").slice(0, 1), "tile": group.column("tile").slice(0, 1)}
        return pa.table(one | {"low": pa.array([int(counts.min())], pa.int32()), "high": pa.array([int(counts.max())], pa.int32()), "own": pa.array([own], pa.binary())})

    tiles = staged(dealt.groupBy("class", "tile").applyInArrow(pack, "class int, tile int, low int, high int, own binary"), "tiles")
    bands = F.broadcast(classes.select("class", F.least("tiles", F.lit(BANDS)).alias("bands")))
    placed = tiles.join(bands, "class").withColumn("band", F.pmod("tile", "bands"))
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    mine = [F.col("class").alias("a"), F.col("class").alias("b")]
    inside = placed.withColumn("other", every(F.col("bands"))).select(*mine, F.least("band", "other").alias("p"), F.greatest("band", "other").alias("q"), (F.col("band") > F.col("other")).alias("right"), *TILED)
    up = placed.join(bands.select((F.col("class") - 1).alias("class"), F.col("bands").alias("others")), "class").withColumn("other", every(F.col("others")))
    down = placed.join(bands.select((F.col("class") + 1).alias("class"), F.col("bands").alias("others")), "class").withColumn("other", every(F.col("others")))
    lefts = up.select(F.col("class").alias("a"), (F.col("class") + 1).alias("b"), F.col("band").alias("p"), F.col("other").alias("q"), F.lit(False).alias("right"), *TILED)
    rights = down.select((F.col("class") - 1).alias("a"), F.col("class").alias("b"), F.col("other").alias("p"), F.col("band").alias("q"), F.lit(True).alias("right"), *TILED)

    def compare(group: pa.Table) -> pa.Table:
        a, b, p, q = (group.column(n)[0].as_py() for n in "abpq")
        held: dict[bool, list] = {False: [], True: []}
        for right, number, low, high, own in zip(*(group.column(n).to_pylist() for n in ("right", *TILED)), strict=True):
            # numpy counts the bits of absolute values, so words go without sign
            rows = dict(zip(NAMES, np.frombuffer(own, np.int64).reshape(len(NAMES), -1), strict=True))
            held[right].append((number, low, high, {n: x.view(np.uint64) if n[0] == "w" else x for n, x in rows.items()}))
        alone = a == b and p == q
        left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i, low, high, x in held[False]:
            for j, other_low, other_high, y in held[False] if alone else held[True]:
                if (alone and j < i) or low - other_high > FIRST_RADIUS or other_low - high > FIRST_RADIUS:
                    continue
                found = close(x, y)
                left.append(found[0])
                right.append(found[1])
        x, y = thinned(np.concatenate(left), np.concatenate(right))
        return pa.table({"a": pa.array(x, pa.int64()), "b": pa.array(y, pa.int64())})

    return inside.unionByName(lefts).unionByName(rights).groupBy("a", "b", "p", "q").applyInArrow(compare, "a long, b long").distinct()


def alike(ids: np.ndarray, blocks: np.ndarray, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of pairs with at least the least similarity: inside one block, or if there are two, between them."""
    n = np.array([len(s) for s in sets], np.int64)
    codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
    begin = np.concatenate([[0], np.cumsum(n)])
    single = blocks.min() == blocks.max()
    left, right = [], []
    has = np.zeros(int(codes.max()) + 1, bool)
    for i in np.flatnonzero(blocks == blocks.min()):
        own = codes[begin[i] : begin[i + 1]]
        has[own] = True
        both = np.add.reduceat(has[codes], begin[:-1], dtype=np.int64)
        has[own] = False
        j = np.flatnonzero(LEAST[1] * both >= LEAST[0] * (n + n[i] - both))
        j = j[(j > i) if single else (blocks[j] != blocks[i])]
        left.append(np.full(len(j), ids[i]))
        right.append(ids[j])
    return np.concatenate(left), np.concatenate(right)


def confirmed_links(members: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) that span the groups of sets alike. members: a stored table (set_id, n, root) of candidate groups;
    texts: (set_id, text), one of each set at least."""
    spark = members.sparkSession
    shape = members.groupBy("root").agg(F.ceil(F.greatest(F.count("*") / BLOCK, F.count("*") * F.max("n") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    placed = staged(members.join(shape, "root").select("set_id", "root", "blocks", F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int").alias("block")), "members")
    hint = F.broadcast if placed.count() <= BROADCAST_MEMBERS else (lambda x: x)
    source = texts.join(hint(placed), "set_id").select("set_id", "root", "blocks", "block", "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, own in text_slices(batches):
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array([shingles(t or "").tobytes() for t in own], pa.binary())], ["set_id", "root", "blocks", "block", "shingles"])

    hashed = staged(source.mapInArrow(cut, "set_id long, root long, blocks int, block int, shingles binary").dropDuplicates(["set_id"]), "shingles")
    sent = hashed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = sent.groupBy("root", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")).agg(F.collect_list(F.struct("set_id", "block", "shingles")).alias("own"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own in batch.column(0):
                ids, blocks, sets = own.values.flatten()
                parts = [np.frombuffer(x.as_buffer(), np.uint64) for x in sets]
                left, right = thinned(*alike(ids.to_numpy(), blocks.to_numpy(), parts))
                yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    return met.select("own").mapInArrow(compare, "a long, b long").distinct()


def grouped(docs: DataFrame, key: str, text: str) -> DataFrame:
    """The columns of `docs` but the text, with root (the least set_id of the group) and component_id (its least key)."""
    prints = staged(with_sketches(docs.withColumn("set_text", F.col(f"`{text}`")).drop(text), "set_text"), "sketches")
    words = ["w0", "w1", "w2", "w3"]
    each = staged(prints.groupBy("set_id").agg(F.min(f"`{key}`").alias("least"), F.first("n").alias("n"), *[F.first(w).alias(w) for w in words]), "sets")
    near = staged(components(candidate_links(each.select("set_id", "n", *words))), "near")
    inside = near.unionByName(near.select(F.col("root").alias("node"), "root")).distinct().withColumnRenamed("node", "set_id")
    members = staged(inside.join(each.select("set_id", "n"), "set_id"), "inside")
    # one text of each set, found by its hash, which the narrow table has
    hashes = members.select("set_id").join(prints.select("set_id", "own_hash"), "set_id").groupBy("set_id").agg(F.min("own_hash").alias("own_hash"))
    hashes = staged(hashes, "hashes")
    hint = F.broadcast if hashes.count() <= BROADCAST_MEMBERS else (lambda x: x)
    texts = docs.select("own_hash", F.col(f"`{text}`").alias("text")).join(hint(hashes), "own_hash").select("set_id", "text")
    roots = components(confirmed_links(members, texts))
    rooted = each.join(roots, each["set_id"] == roots["node"], "left").select("set_id", "least", F.coalesce("root", "set_id").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.drop("n", *words).join(rooted.join(named, "root").select("set_id", "root", "component_id"), "set_id", "left")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The columns of `docs` for one document of each group of near copies, as in simhash.keep_one(). Texts without words
    are copies of each other, and so are null texts. Texts of any length are compared whole; columns of `docs` may have any
    names; an empty table gives no rows."""
    narrow = docs.select(F.col(f"`{key}`").alias("own_key"), F.xxhash64(F.col(f"`{text}`")).alias("own_hash"), F.col(f"`{text}`").alias("own_text"))
    return keep_first(docs, staged(grouped(narrow, "own_key", "own_text"), "groups"), key, text)
