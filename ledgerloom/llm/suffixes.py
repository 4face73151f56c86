"""Removal of repeated byte strings by a common-prefix-aware distributed merge sort of suffixes.

Which suffixes are sorted. Every string of LENGTH bytes has one 24-byte substring of least hash (the leftmost such), its
anchor. Neighbouring strings that share an anchor are a block; equal strings lie at the same place of their anchors, so it
is enough to sort the blocks: from the anchor to the block's end, then what lies before the anchor. A first exchange of
32-bit fingerprints of anchors leaves out those that occur once.

Sorting. The texts are cut into runs of bounded size. Each task sorts the suffixes of a run, keeps equal ones once with the
least document of the run, and sends them front-coded (length of the prefix shared with the one before, and the rest), cut
at splitters. A range's pieces meet in a loser tree: suffixes are compared only beyond the prefix that both share with the
last winner, so no byte of a known prefix is looked at again. What comes out in order shows equal suffixes (all of the block
repeats), and blocks with one anchor and unlike surroundings, whose strings are then compared one by one.

Scale. Runs are written once to a bucketed table, so texts are not shuffled when they meet what is known of them. Of groups of
one anchor that cross a splitter, or are large, the unlike strings of each part go through another exchange; so no anchor,
however frequent, stays in one task.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .shared import column_after, new_folder, small_batches, staged, text_slices, unclash

#: Bytes of a repeated string; of an anchor; anchors of a string.
LENGTH, ANCHOR = 50, 24
SPAN = LENGTH - ANCHOR + 1
#: Bytes of a sorted suffix: from the anchor, before it, and how many of each.
WIDTH = LENGTH + SPAN - 1 + 2
#: Bytes of text of a run; of text behind a range of suffixes; anchors behind a range of fingerprints.
RUN_BYTES, RANGE_BYTES, PRINTS = 8 << 20, 8 << 20, 1 << 20
#: Splitters come from at most so many runs, and so many suffixes of each: 5 MB at most.
SAMPLED_RUNS, SAMPLES = 64, 1000
#: Least ranges, so that all cores have some; blocks of one anchor that are compared in place.
LEAST_RANGES, LARGE = 48, 5000
#: Spark takes so many buckets and no more; beyond 3 TB of text they hold more runs each, one after the other.
MOST_BUCKETS = 100_000
CHUNK = 1 << 18
_C = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)]


def anchor_hash(at: np.ndarray | slice, words: np.ndarray) -> np.ndarray:
    """The hash of the 24 bytes at some places; words: the eight bytes from each place on."""
    if isinstance(at, slice):
        x, y, z = words[at.start : at.stop], words[at.start + 8 : at.stop + 8], words[at.start + 16 : at.stop + 16]
    else:
        x, y, z = words[at], words[at + 8], words[at + 16]
    h = x * _C[0]
    h += y * _C[1]
    h ^= h >> np.uint64(31)
    h += z * _C[2]
    h ^= h >> np.uint64(29)
    h *= _C[3]
    h ^= h >> np.uint64(32)
    return h


def blocks(data: bytes, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of documents end to end, by blocks: first and last string's start, the anchor's place and its hash."""
    n = len(data) - LENGTH + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    padded = np.frombuffer(data + bytes(8), np.uint8)
    words = np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))  # overlapping: the eight bytes from each place on
    low = np.uint64((1 << 20) - 1)
    where = np.empty(n, np.int64)
    for begin in range(0, n, CHUNK):
        m = min(CHUNK, n - begin)
        key = anchor_hash(slice(begin, begin + m + SPAN - 1), words)
        key &= ~low
        key |= np.arange(len(key), dtype=np.uint64)
        span = 1
        while span * 2 <= SPAN:
            key = np.minimum(key[:-span], key[span:])
            span *= 2
        if span < SPAN:
            key = np.minimum(key[: span - SPAN], key[SPAN - span :])
        where[begin : begin + m] = (key & low).astype(np.int64) + begin
    ends = np.cumsum(sizes)
    inside = np.zeros(n + 1, np.int8)  # strings that lie in one document
    starts, stops = ends - sizes, ends - LENGTH + 1
    real = stops > starts
    np.add.at(inside, starts[real], 1)
    np.add.at(inside, stops[real], -1)
    inside = np.cumsum(inside[:n], dtype=np.int8).astype(bool)
    where[~inside] = -1
    first = np.flatnonzero(np.diff(where, prepend=-2))
    last = np.append(first[1:], n) - 1
    real = where[first] >= 0
    first, last = first[real], last[real]
    anchors = where[first]
    return first, last, anchors, anchor_hash(anchors, words)


def fingerprints(hashes: np.ndarray, ranges: int) -> np.ndarray:
    """The range of each anchor's hash in the upper, 32 bits of it in the lower half."""
    return (((hashes >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32) << np.uint64(32)) | (hashes & np.uint64(0xFFFFFFFF))


def suffix_rows(data: bytes, first: np.ndarray, last: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """A row of WIDTH bytes for each block: from the anchor to the block's end and zeros, what is before it and zeros, both lengths."""
    raw = np.frombuffer(data + bytes(LENGTH + SPAN), np.uint8)
    right, left = last + LENGTH - anchors, anchors - first
    out = np.zeros((len(first), WIDTH), np.uint8)
    out[:, :LENGTH] = np.lib.stride_tricks.sliding_window_view(raw, LENGTH)[anchors]
    out[:, :LENGTH][np.arange(LENGTH) >= right[:, None]] = 0
    out[:, LENGTH:-2] = np.lib.stride_tricks.sliding_window_view(raw, SPAN - 1)[first]
    out[:, LENGTH:-2][np.arange(SPAN - 1) >= left[:, None]] = 0
    out[:, -2], out[:, -1] = right, left
    return out


def shared_prefixes(rows: np.ndarray) -> np.ndarray:
    """How many bytes each row shares with the one before it (0 for the first)."""
    out = np.zeros(len(rows), np.int64)
    for at in range(1, len(rows), 65536):
        unlike = rows[at : at + 65536] != rows[at - 1 : min(at + 65536, len(rows)) - 1]
        out[at : at + 65536] = np.where(unlike.any(1), unlike.argmax(1), rows.shape[1])
    return out


def sorted_run(data: bytes, sizes: np.ndarray, docs: np.ndarray, repeated: np.ndarray, ranges: int):
    """The unlike suffixes of a run whose anchors repeat: their rows in order, prefixes shared with the one before, least
    document; and how many places each has, the places, and whether another document of the run is before theirs."""
    first, last, anchors, hashes = blocks(data, sizes)
    _, which = np.unique(fingerprints(hashes, ranges), return_inverse=True)
    keep = repeated[which] if len(which) else np.zeros(0, bool)
    first, last, anchors = first[keep], last[keep], anchors[keep]
    rows = suffix_rows(data, first, last, anchors)
    doc = docs[np.searchsorted(np.cumsum(sizes), first, "right")]
    order = np.argsort(rows.view(f"V{WIDTH}").ravel(), kind="stable")
    rows, first, doc = rows[order], first[order], doc[order]
    shared = shared_prefixes(rows)
    heads = np.flatnonzero(shared < WIDTH)
    least = np.minimum.reduceat(doc, heads) if len(heads) else doc
    times = np.diff(np.append(heads, len(rows)))
    return rows[heads], shared[heads], least, times, first, doc > np.repeat(least, times)


def pack(*arrays: np.ndarray) -> bytes:
    return zlib.compress(struct.pack(f"<{len(arrays)}Q", *(x.nbytes for x in arrays)) + b"".join(x.tobytes() for x in arrays), 1)


def unpack(payload: bytes, *kinds: str) -> list[np.ndarray]:
    data, out, at = zlib.decompress(payload), [], 8 * len(kinds)
    for size, kind in zip(struct.unpack_from(f"<{len(kinds)}Q", data), kinds, strict=True):
        out.append(np.frombuffer(data[at : at + size], kind))
        at += size
    return out


def front_coded(rows: np.ndarray, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of shared prefixes, and the rests end to end."""
    shared = shared.copy()
    shared[:1] = 0
    return shared.astype(np.uint8), rows[np.arange(WIDTH) >= shared[:, None]]


def suffixes_of(shared: list[int], rests: bytes) -> Iterator[bytes]:
    """Front-coded suffixes again."""
    last, at = b"", 0
    for n in shared:
        last = last[:n] + rests[at : (at := at + WIDTH - n)]
        yield last


def merged(runs: list[tuple[list[int], Iterator[bytes]]]) -> Iterator[tuple[int, int, int, bytes]]:
    """A loser tree over sorted runs: (bytes shared with the suffix before, run, number in its run, suffix), in order.

    Each suffix in the tree knows how much it shares with the suffix that beat it. That of a path's losers is the last
    winner, of which the next suffix of its run knows the same by front coding. The longer prefix wins; only where both
    are equal, bytes are compared, from there on.
    """
    k = 1 << max(0, len(runs) - 1).bit_length()
    nexts = [s.__next__ for _, s in runs]
    shared = [x for x, _ in runs]
    count = [len(x) for x in shared]
    current: list[bytes] = [s() for s in nexts] + [b""] * (k - len(runs))
    number, prefix = [0] * k, [0] * len(runs) + [-1] * (k - len(runs))
    loser = [0] * k
    winners = [0] * k + list(range(k))

    for node in range(k - 1, 0, -1):
        s, o = winners[2 * node], winners[2 * node + 1]
        if prefix[s] < 0 or (prefix[o] >= 0 and current[o] < current[s]):
            s, o = o, s
        winners[node], loser[node] = s, o
        if prefix[o] >= 0:
            x, y, h = current[s], current[o], 0
            while h < WIDTH and x[h] == y[h]:
                h += 1
            prefix[o] = h
    s = winners[1]
    h = prefix[s]
    while h >= 0:
        yield h, s, number[s], current[s]
        at = number[s] = number[s] + 1
        if at < count[s]:
            h, current[s] = shared[s][at], nexts[s]()
        else:
            h = -1
        node = (s + k) >> 1
        while node:
            o = loser[node]
            other = prefix[o]
            if h < other:
                loser[node], prefix[s], s, h = s, h, o, other
            elif h == other and h >= 0:
                x, y = current[s], current[o]
                if x == y:
                    prefix[o] = WIDTH
                else:
                    c = h
                    while x[c] == y[c]:
                        c += 1
                    if x[c] < y[c]:
                        prefix[o] = c
                    else:
                        loser[node], prefix[s], s = s, c, o
            node >>= 1


def strings_of(row: bytes) -> list[bytes]:
    """The strings of LENGTH bytes of a block, in order."""
    right, left = row[-2], row[-1]
    whole = row[LENGTH : LENGTH + left] + row[:right]
    return [whole[i : i + LENGTH] for i in range(left + right - LENGTH + 1)]


FLAGS = "run long, places binary, masks binary"
MERGED = f"{FLAGS}, string binary, least long, holders binary"


def merge_range(q: int, runs: list[int], payloads: list[bytes], splitters: list[bytes], large: int) -> Iterator[dict]:
    """What repeats in a range. Rows with places and masks: of a block that starts there, bit i stands for its i-th string, and
    another document before this one has it. Rows with a string: blocks that must meet those of other ranges."""
    pieces = [unpack(p, "u1", "u1", "<i8", "<u4", "<u4", "u1") for p in payloads]
    bounds = {s[:ANCHOR] for s in splitters[max(0, q - 1) : q + 1]}
    masks = [np.zeros(len(p[0]), np.uint32) for p in pieces]
    full = [np.zeros(len(p[0]), np.uint32) for p in pieces]
    least = [p[2].tolist() for p in pieces]
    offsets = [np.cumsum(p[3]) - p[3] for p in pieces]
    ahead: list[dict] = []

    def close(group: list[tuple[bytes, int, list[tuple[int, int]]]]) -> None:
        if not group:
            return
        crossing = group[0][0][:ANCHOR] in bounds
        cut = [strings_of(row) for row, _, _ in group] if len(group) > 1 or crossing else [[]]
        lows: dict[bytes, int] = {}
        for (_, low, _), strings in zip(group, cut, strict=True):
            for x in strings:
                if lows.get(x, low) >= low:
                    lows[x] = low
        firsts: dict[bytes, list[bytes]] = {}  # who has a string first, as far as this part of the group knows
        for (row, low, held), strings in zip(group, cut, strict=True):
            every, bits = (1 << (row[-1] + row[-2] - LENGTH + 1)) - 1, 0
            for k, x in enumerate(strings):
                if lows[x] < low:
                    bits |= 1 << k
                elif crossing:
                    for run, at in held:
                        if least[run][at] == low:
                            own = pieces[run][4][offsets[run][at] : offsets[run][at] + pieces[run][3][at]]
                            firsts.setdefault(x, []).append(struct.pack("<qII", runs[run], k, len(own)) + own.tobytes())
            for run, at in held:
                full[run][at], masks[run][at] = every, every if least[run][at] > low else bits
        ahead.extend({"string": x, "least": lows[x], "holders": b"".join(own)} for x, own in firsts.items())

    group: list[tuple[bytes, int, list[tuple[int, int]]]] = []
    for shared, run, at, row in merged([(p[0].tolist(), suffixes_of(p[0].tolist(), p[1].tobytes())) for p in pieces]):
        low = least[run][at]
        if shared >= WIDTH and group:
            _, known, held = group[-1]
            held.append((run, at))
            if low < known:
                group[-1] = (row, low, held)
        else:
            if shared < ANCHOR:
                close(group)
                group = []
            group.append((row, low, [(run, at)]))
            if len(group) > large and len(group) % large == 1:  # so many blocks of one anchor go on by parts
                bounds.add(row[:ANCHOR])
                close(group)
                group = []
        if len(ahead) >= 2000:
            yield from ahead
            ahead.clear()
    close(group)
    yield from ahead
    for run, piece, mask, every in zip(runs, pieces, masks, full, strict=True):
        own = np.where(piece[5] != 0, np.repeat(every, piece[3]), np.repeat(mask, piece[3]))
        hit = own != 0
        if hit.any():
            yield {"run": run, "places": piece[4][hit].tobytes(), "masks": own[hit].astype("<u4").tobytes()}


def covered(n: int, places: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """Which of n bytes lie in a string that the masks name."""
    change = np.zeros(n + 1, np.int64)
    for bit in range(SPAN):
        on = places[masks >> np.uint32(bit) & np.uint32(1) != 0].astype(np.int64) + bit
        np.add.at(change, on, 1)
        np.add.at(change, on + LENGTH, -1)
    return np.cumsum(change[:n]) > 0


def write_runs(docs: DataFrame, path: str, buckets: int, run_bytes: int) -> DataFrame:
    """Documents (key long, text) in runs: run, docs (keys), sizes and data, written as a table with buckets by run."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        run, part = 0, TaskContext.get().partitionId()
        keys, held, total = [], [], 0

        def out() -> pa.RecordBatch:
            sizes = np.fromiter(map(len, held), np.int64, len(held))
            arrays = [pa.array([(part << 32) + run], pa.int64()), *(pa.array([x], pa.binary()) for x in (np.array(keys, "<i8").tobytes(), sizes.tobytes(), b"".join(held)))]
            return pa.RecordBatch.from_arrays(arrays, ["run", "docs", "sizes", "data"])

        for batch, texts in text_slices(batches):
            for key, text in zip(batch.column(0).to_pylist(), texts, strict=True):
                raw = text.encode()
                if held and total + len(raw) > run_bytes:
                    yield out()
                    run, keys, held, total = run + 1, [], [], 0
                keys.append(key)
                held.append(raw)
                total += len(raw)
        if held:
            yield out()

    name = f"ledgerloom_runs_{uuid.uuid4().hex}"
    spark = docs.sparkSession
    with small_batches(spark):
        docs.mapInArrow(build, "run long, docs binary, sizes binary, data binary").write.bucketBy(buckets, "run").option("path", path).option("compression", "zstd").format("parquet").saveAsTable(name)
    runs = spark.table(name)
    spark.sql(f"drop table {name}")  # its files stay: the name was only needed for the buckets
    return runs


def beside(runs: DataFrame, rows: DataFrame, buckets: int, *columns: str) -> DataFrame:
    """Runs with all their `rows` as an array; runs stay in their buckets, only the rows are shuffled."""
    gathered = rows.repartition(buckets, "run").groupBy("run").agg(F.collect_list(F.struct(*columns)).alias("own"))
    return runs.join(gathered.hint("shuffle_hash"), "run", "left")


def read_run(batch: pa.RecordBatch, i: int) -> tuple[int, np.ndarray, np.ndarray, bytes, list[dict]]:
    at = batch.schema.get_field_index
    docs, sizes, data = (batch.column(at(n))[i].as_py() for n in ("docs", "sizes", "data"))
    own = at("own")
    return batch.column(at("run"))[i].as_py(), np.frombuffer(docs, "<i8"), np.frombuffer(sizes, "<i8"), data, (batch.column(own)[i].as_py() or []) if own >= 0 else []


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", run_bytes: int = RUN_BYTES, range_bytes: int = RANGE_BYTES, large: int = LARGE) -> DataFrame:
    """Documents without the bytes that a string of LENGTH bytes covers which also starts in a document of a smaller key:
    doc_id, n_bytes, n_removed, n_spans (maximal removed stretches), kept (binary: what is left), spans (binary: begin and
    end of each stretch, as unsigned 64-bit integers).

    `key` is an integer column. A null text is empty. Texts of fewer bytes, and documents with a null key, which is smaller
    than none and has none smaller, stay whole; empty tables give no rows. Repeated rows and rows that share a key count as
    one document to each other and get a row each. Texts of any length are taken whole, one run for a longer one. Other columns are dropped,
    whatever their names. The result is written to the shared folder.
    """
    spark = docs.sparkSession
    docs, moved = unclash(docs, ("doc", "run"))
    key, text = column_after(moved, key), column_after(moved, text)
    plain = docs.select(F.col(f"`{key}`").cast("long").alias("doc"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    taken = F.col("doc").isNotNull() & (F.octet_length("text") >= LENGTH)
    total = int(plain.filter(taken).agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0])
    raw = F.encode("text", "UTF-8")
    short = plain.filter(~taken).select(F.col("doc").alias("doc_id"), F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), raw.alias("kept"), F.lit(b"").alias("spans"))
    if not total:
        return short
    buckets = min(MOST_BUCKETS, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // (4 * run_bytes))))
    runs = write_runs(plain.filter(taken), new_folder(spark, "runs"), buckets, run_bytes)
    ranges = max(LEAST_RANGES, -(-total // (14 * PRINTS)))

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                run, _, sizes, data, _ = read_run(batch, i)
                own, times = np.unique(fingerprints(blocks(data, sizes)[3], ranges), return_counts=True)
                cut = np.searchsorted(own >> np.uint64(32), np.arange(ranges + 1))
                used = np.flatnonzero(np.diff(cut))
                parts = [slice(cut[q], cut[q + 1]) for q in used]
                yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([run] * len(used), pa.int64()), pa.array([own[p].astype("<u4").tobytes() for p in parts], pa.binary()), pa.array([np.packbits(times[p] > 1).tobytes() for p in parts], pa.binary())], ["q", "run", "prints", "often"])

    def common(group: pa.Table) -> pa.Table:
        own = [np.frombuffer(x, "<u4") for x in group.column("prints").to_pylist()]
        often = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(o)) for x, o in zip(group.column("often").to_pylist(), own, strict=True)]
        _, which = np.unique(np.concatenate(own), return_inverse=True)
        hit = np.bincount(which, weights=1.0 + np.concatenate(often))[which] > 1
        ends = np.cumsum([len(o) for o in own])
        bits = [np.packbits(hit[e - len(o) : e]).tobytes() for o, e in zip(own, ends, strict=True)]
        return pa.table({"run": group.column("run"), "q": group.column("q"), "bits": pa.array(bits, pa.binary()), "n": pa.array([len(o) for o in own], pa.int32())})

    with small_batches(spark, 100):
        bits = staged(runs.mapInArrow(prints, "q int, run long, prints binary, often binary").groupBy("q").applyInArrow(common, "run long, q int, bits binary, n int"), "anchors")

        def repeated(own: list[dict]) -> np.ndarray:
            own = sorted(own, key=lambda x: x["q"])
            return np.concatenate([np.unpackbits(np.frombuffer(x["bits"], np.uint8), count=x["n"]) for x in own] or [np.zeros(0, np.uint8)]).astype(bool)

        def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    _, keys, sizes, data, own = read_run(batch, i)
                    rows = sorted_run(data, sizes, keys, repeated(own), ranges)[0]
                    some = rows[np.unique(np.linspace(0, len(rows) - 1, min(SAMPLES, len(rows))).astype(np.int64))] if len(rows) else rows
                    yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in some], pa.binary())], ["suffix"])

        number = runs.select("run").count()
        some = runs.filter(F.pmod(F.xxhash64("run"), F.lit(max(8, -(-number // SAMPLED_RUNS)))) == 0) if number > 16 else runs.filter(F.pmod("run", F.lit(4)) == 0)
        known = sorted(r.suffix for r in beside(some, bits, buckets, "q", "bits", "n").mapInArrow(sample, "suffix binary").collect())
        wanted = max(LEAST_RANGES, -(-total // range_bytes))
        splitters = sorted({known[i * len(known) // wanted] for i in range(1, wanted)}) if known else []

        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    run, keys, sizes, data, own = read_run(batch, i)
                    rows, shared, least, times, places, later = sorted_run(data, sizes, keys, repeated(own), ranges)
                    flat = rows.tobytes()
                    at = lambda i, flat=flat: flat[i * WIDTH : (i + 1) * WIDTH]
                    cut, first = [0], 0
                    for s in splitters:
                        cut.append(first := bisect_left(range(len(rows)), s, first, key=at))
                    cut.append(len(rows))
                    ends = np.append(0, np.cumsum(times))
                    out = []
                    for q, (a, b) in enumerate(zip(cut, cut[1:], strict=False)):
                        if a < b:
                            some = slice(ends[a], ends[b])
                            out.append((q, pack(*front_coded(rows[a:b], shared[a:b]), least[a:b], times[a:b].astype("<u4"), places[some].astype("<u4"), later[some].astype("u1"))))
                    yield pa.RecordBatch.from_arrays([pa.array([q for q, _ in out], pa.int32()), pa.array([run] * len(out), pa.int64()), pa.array([p for _, p in out], pa.binary())], ["q", "run", "piece"])

        def merge(group: pa.Table) -> pa.Table:
            runs_of, pieces = group.column("run").to_pylist(), group.column("piece").to_pylist()
            return pa.Table.from_pylist(list(merge_range(group.column("q")[0].as_py(), runs_of, pieces, splitters, large)), schema=kinds)

        kinds = pa.schema([("run", pa.int64()), *((n, pa.binary()) for n in ("places", "masks", "string")), ("least", pa.int64()), ("holders", pa.binary())])
        sent = beside(runs, bits, buckets, "q", "bits", "n").mapInArrow(send, "q int, run long, piece binary")
        found = staged(sent.groupBy("q").applyInArrow(merge, MERGED), "repeats")

        def hold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = []
                for holders in batch.column("holders").to_pylist():
                    at = 0
                    while at < len(holders):
                        run, bit, n = struct.unpack_from("<qII", holders, at)
                        out.append((run, holders[at + 16 : at + 16 + 4 * n], np.full(n, 1 << bit, "<u4").tobytes()))
                        at += 16 + 4 * n
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate((pa.int64(), pa.binary(), pa.binary()))], ["run", "places", "masks"])

        strings = found.filter("string is not null")
        lower = strings.groupBy("string").agg(F.min("least").alias("low"))
        crossing = strings.join(lower, "string").filter("low < least").select("holders").mapInArrow(hold, FLAGS)
        flags = found.filter("run is not null").select("run", "places", "masks").unionByName(crossing)

        def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    _, keys, sizes, data, own = read_run(batch, i)
                    gone = covered(len(data), np.frombuffer(b"".join(x["places"] for x in own), "<u4"), np.frombuffer(b"".join(x["masks"] for x in own), "<u4"))
                    raw, end, rows = np.frombuffer(data, np.uint8), 0, []
                    for key, size in zip(keys.tolist(), sizes.tolist(), strict=True):
                        mine = gone[end : end + size]
                        edges = np.flatnonzero(np.diff(mine.astype(np.int8), prepend=0, append=0)) if mine.any() else np.zeros(0, np.int64)
                        kept = raw[end : end + size][~mine].tobytes() if len(edges) else data[end : end + size]
                        rows.append((key, size, size - len(kept), len(edges) // 2, kept, edges.astype("<u8").tobytes()))
                        end += size
                    for a in range(0, len(rows), 1000):
                        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows[a : a + 1000]], pa.int64() if k < 4 else pa.binary()) for k in range(6)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "spans"])

        applied = beside(runs, flags, buckets, "places", "masks").mapInArrow(cut_out, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, spans binary")
    return applied.unionByName(short)

