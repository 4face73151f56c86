"""Exact top-k search over a bit-sliced index.

Vectors are quantised to integers and cut into blocks. A block keeps, for each component, one bitmap per binary digit
of (value - least value in the block). A query adds the bitmaps with weights: each set digit of a query component adds
the component's slices at that place, by carry-save adders over bitmaps. What comes out are the slices of all scores of
the block. The best rows are found from the most significant slice down; rows that tie at the boundary are taken in
order of their ids. Groups of blocks meet groups of queries, so that blocks and queries travel a bounded number of times,
and each pair of a block and a group of queries sends on k rows a query.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import Window as W

from .shared import staged

#: Rows of one block of the index, and queries that meet a block at a time.
BLOCK_ROWS, QUERY_ROWS = 8192, 512
#: Most tasks that pairs of groups of blocks and groups of queries are dealt to.
MOST_TASKS = 4096


def pack(bits: np.ndarray) -> np.ndarray:
    """Booleans along the last axis as little-endian words of 64."""
    pad = -bits.shape[-1] % 64
    if pad:
        bits = np.concatenate([bits, np.zeros((*bits.shape[:-1], pad), bool)], axis=-1)
    return np.ascontiguousarray(np.packbits(bits, axis=-1, bitorder="little")).view("<u8")


def slice_block(ids: np.ndarray, copies: np.ndarray, values: np.ndarray) -> dict:
    """The index of one block: rows in order of id, least values, widths in digits and the slices."""
    low = values.min(axis=0) if len(values) else np.zeros(values.shape[1], np.int64)
    shifted = values.view(np.uint64) - low.view(np.uint64)  # right for any two longs, since it wraps
    widths = [int(x).bit_length() for x in shifted.max(axis=0)]
    slices = [pack((shifted[:, d][None, :] >> np.arange(w, dtype=np.uint64)[:, None]) & np.uint64(1) != 0) if w else np.zeros((0, -(-len(ids) // 64)), np.uint64) for d, w in enumerate(widths)]
    return {"ids": ids, "copies": copies, "low": low, "widths": widths, "slices": np.concatenate(slices) if slices else np.zeros((0, -(-len(ids) // 64)), np.uint64), "rows": hashes(values)}


def hashes(values: np.ndarray) -> np.ndarray:
    """A number for each row of integers, by which a query finds its own row."""
    mix = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 62, values.shape[1], dtype=np.int64) | 1
    with np.errstate(over="ignore"):
        return (values * mix).sum(axis=1, dtype=np.int64)


def add_slices(columns: list[list[np.ndarray]], words: int) -> np.ndarray:
    """Carry-save addition: columns[w] holds bitmaps of weight 2**w; gives the slices of the sums, least first."""
    out, w = [], 0
    while w < len(columns):
        level = columns[w]
        stack = np.concatenate(level) if level else np.zeros((0, words), np.uint64)
        carries = []
        while len(stack) > 1:
            n = len(stack) // 3 * 3
            if n:
                a, b, c = stack[0:n:3], stack[1:n:3], stack[2:n:3]
                odd = a ^ b
                carries.append((a & b) | (odd & c))
                stack = np.concatenate([odd ^ c, stack[n:]])
            else:
                carries.append((stack[0] & stack[1])[None])
                stack = (stack[0] ^ stack[1])[None]
        out.append(stack[0] if len(stack) else np.zeros(words, np.uint64))
        if carries:
            if w + 1 == len(columns):
                columns.append([])
            columns[w + 1].extend(carries)
        w += 1
    return np.array(out).reshape(len(out), words)


def best(slices: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k rows with the greatest sums among `rows` (a bitmap); ties at the boundary by position."""
    sure, maybe = np.zeros_like(rows), rows
    for s in slices[::-1]:
        more = maybe & s
        n = int(np.bitwise_count(sure).sum() + np.bitwise_count(more).sum())
        if n > k:
            maybe = more
        else:
            sure, maybe = sure | more, maybe & ~s
            if n == k:
                maybe = np.zeros_like(rows)
                break
    places = lambda x: np.flatnonzero(np.unpackbits(x.view(np.uint8), bitorder="little"))
    first = places(sure)
    return np.concatenate([first, places(maybe)[: k - len(first)]])


def search_block(block: dict, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, copies and scores of the block's k best rows for one query, without one copy of the query's own row."""
    n, words = len(block["ids"]), -(-len(block["ids"]) // 64)
    width, columns, constant = min(len(query), len(block["widths"])), [], 0
    starts = np.concatenate([[0], np.cumsum(block["widths"])]).astype(int)
    for d in range(width):
        q, w = int(query[d]), block["widths"][d]
        constant += q * int(block["low"][d])
        if not q or not w:
            continue
        part = block["slices"][starts[d] : starts[d + 1]]
        if q < 0:  # q * x = |q| * (2**w - 1 - x) - |q| * (2**w - 1)
            part, constant = ~part, constant + q * ((1 << w) - 1)
        for place in range(abs(q).bit_length()):
            if abs(q) >> place & 1:
                while len(columns) < place + w:
                    columns.append([])
                for digit in range(w):
                    columns[place + digit].append(part[digit : digit + 1])
    slices = add_slices(columns, words)
    copies = block["copies"].copy()
    own = np.flatnonzero(block["ids"] == query_id)
    own = own[block["rows"][own] == hashes(query[None, : len(block["low"])] if len(query) >= len(block["low"]) else np.pad(query, (0, len(block["low"]) - len(query)))[None])[0]] if len(own) else own
    copies[own[:1]] -= 1
    at = best(slices, pack(copies > 0), k)
    digits = (slices.astype(np.uint64, copy=False)[:, at // 64] >> (at % 64).astype(np.uint64)) & np.uint64(1)
    if len(slices) < 62 and abs(constant) < 1 << 62:
        scores = (digits.astype(np.int64) << np.arange(len(slices))[:, None]).sum(axis=0) + constant
    else:  # whole numbers of any size; a score that no long holds is an error
        scores = np.array([constant + sum(int(b) << w for w, b in enumerate(column)) for column in digits.T], np.int64)
    return block["ids"][at], copies[at], scores


def matrix(vectors: list[np.ndarray]) -> np.ndarray:
    """Integer rows as a matrix; shorter ones end in zeros."""
    out = np.zeros((len(vectors), max(map(len, vectors), default=0)), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def quantised(vectors: DataFrame, key: str, vector: str, scale: float) -> DataFrame:
    """Distinct rows (id, q, copies) of valid vectors: none of id, vector and components null or non-finite. A component
    that no long holds after scaling is an error."""
    scaled = lambda v: v.cast("double") * F.lit(float(scale))
    whole = lambda v: F.when(F.abs(scaled(v)) < F.lit(float(1 << 62)), F.floor(scaled(v))).otherwise(F.raise_error(F.lit("a scaled component is beyond 2 to the 62nd")).cast("long"))
    finite = F.forall(F.col(f"`{vector}`"), lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < F.lit(float("inf"))))
    valid = vectors.filter(F.col(f"`{key}`").isNotNull() & F.col(f"`{vector}`").isNotNull() & F.coalesce(finite, F.lit(False)))
    return valid.select(F.col(f"`{key}`").cast("long").alias("id"), F.transform(F.col(f"`{vector}`"), whole).alias("q")).groupBy("id", "q").agg(F.count("*").alias("copies"))


def build_index(rows: DataFrame, n_blocks: int) -> DataFrame:
    """One row per block: its number and its pickled slices. Rows are dealt by the hash of id and vector."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", kind="stable")
        block = slice_block(pdf["id"].to_numpy(np.int64), pdf["copies"].to_numpy(np.int64), matrix(list(pdf["q"])))
        return pd.DataFrame({"block": [int(pdf["block"].iloc[0])], "data": [pickle.dumps(block, 5)]})

    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id", "q"), F.lit(n_blocks)).cast("int"))
    return dealt.groupBy("block").applyInPandas(build, "block int, data binary")


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, key: str = "vec_id", vector: str = "embedding", scale: float = 256.0, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """For each row whose id is divisible by `every`: its k best other rows by inner product of floor(scale * x).

    Gives query_id, rank (from 1), vec_id and score, ties to the smaller id. Rows whose id or vector is null, or with
    null or non-finite components, take no part; components beyond 2**62 after scaling, and best scores that no long
    holds, are errors. Shorter vectors count as ending in zeros. A repeated row
    is a candidate as often as it is there, and its query is answered as often; a query's own row is one of its copies.
    Empty tables give no rows.
    """
    rows = staged(quantised(vectors, key, vector, scale), "quantised")
    n = rows.count()
    queries = rows.filter(F.col("id") % every == 0)
    n_blocks, n_query_blocks = max(1, -(-n // block_rows)), max(1, -(-queries.count() // query_rows))
    index = staged(build_index(rows, n_blocks), "index")

    def gather(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.iloc[sorted(range(len(pdf)), key=lambda i: (pdf["id"].iloc[i], tuple(pdf["q"].iloc[i])))]  # a lost task numbers them alike
        data = (pdf["id"].to_numpy(np.int64), pdf["copies"].to_numpy(np.int64), [np.asarray(q, np.int64) for q in pdf["q"]])
        return pd.DataFrame({"queries": [int(pdf["queries"].iloc[0])], "asked": [pickle.dumps(data, 5)]})

    asked = queries.withColumn("queries", F.pmod(F.xxhash64("q", "id", F.lit(1)), F.lit(n_query_blocks)).cast("int")).groupBy("queries").applyInPandas(gather, "queries int, asked binary")

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for number, data, questions in zip(pdf["queries"], pdf["data"], pdf["asked"], strict=True):
                block, (ids, copies, vecs) = pickle.loads(data), pickle.loads(questions)
                found = [(i, *search_block(block, int(ids[i]), vecs[i], k)) for i in range(len(ids))]
                yield pd.DataFrame({
                    "queries": np.int32(number),
                    "query": np.concatenate([np.full(len(x[1]), x[0], np.int32) for x in found]),
                    "query_id": np.concatenate([np.full(len(x[1]), ids[x[0]], np.int64) for x in found]),
                    "times": np.concatenate([np.full(len(x[1]), copies[x[0]], np.int64) for x in found]),
                    "vec_id": np.concatenate([x[1] for x in found]), "copies": np.concatenate([x[2] for x in found]), "score": np.concatenate([x[3] for x in found]),
                })

    # every block of rows meets every block of queries: groups of blocks by groups of queries, so many of each that what
    # travels is least (blocks are sent `bands` times, queries `strips` times)
    tasks = min(MOST_TASKS, n_blocks * n_query_blocks, max(4 * vectors.sparkSession.sparkContext.defaultParallelism, n_blocks))
    bands = min(n_query_blocks, max(1, round((tasks / every) ** 0.5), -(-tasks // n_blocks)))
    strips = min(n_blocks, -(-tasks // bands))
    left = index.withColumn("strip", F.col("block") % strips).withColumn("band", F.explode(F.sequence(F.lit(0), F.lit(bands - 1))))
    right = asked.withColumn("band", F.col("queries") % bands).withColumn("strip", F.explode(F.sequence(F.lit(0), F.lit(strips - 1))))
    slots = strips * bands
    pairs = left.repartition(slots, "strip", "band").join(right.repartition(slots, "strip", "band"), ["strip", "band"]).select("queries", "data", "asked")
    found = pairs.mapInPandas(search, "queries int, query int, query_id long, times long, vec_id long, copies long, score long")
    order = W.partitionBy("queries", "query").orderBy(F.desc("score"), "vec_id")
    kept = found.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k).drop("n")
    each = kept.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(k)).cast("int"))))
    ranked = each.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.withColumn("time", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).select("query_id", "rank", "vec_id", "score")
