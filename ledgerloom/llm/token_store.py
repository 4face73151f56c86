"""A content-addressed store of token ids.

Documents become id streams; a rolling hash over the ids cuts each into chunks, so equal passages give equal chunks
wherever they stand. A chunk is stored once, under the hash of its bytes. Each document has a recipe, the list of its
chunks, with a Merkle root over them; recipes lie in ascending order of their keys, in parts of bounded size, and each part
has a row with the Merkle root over its documents (key, number of ids and root); the manifest has the root over the parts.
Reading rebuilds and compares all of them, so a chunk, a recipe, a part's row or a file that is lost or changed is an error.

Folders: store/kind=chunk (key, payload), index/kind=doc and index/kind=part (recipes in order, and their parts), manifest.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql import Window as W

from .shared import WordMemory, drop_staged, small_batches, text_slices
from .token_counts import byte_letters

#: Least, usual and most ids of a chunk; ids under the rolling hash; chunk hashes that a task keeps to send each once.
LEAST, USUAL, MOST, WINDOW, MEMORY = 128, 512, 4096, 16, 200_000
#: Documents of a part; parts up to this number (40 bytes each) are broadcast.
PART, BROADCAST_PARTS = 65_536, 500_000


def digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


class Merkle:
    """The root over hashes that come one by one: neighbours are hashed in pairs, level by level; a last odd one goes up
    as it is. Only one hash a level is held."""

    def __init__(self) -> None:
        self.stack: list[tuple[int, bytes]] = []  # levels, falling, and the hashes of whole subtrees

    def add(self, leaf: bytes) -> None:
        level, own = 0, hashlib.blake2b(b"\0" + leaf, digest_size=32).digest()
        while self.stack and self.stack[-1][0] == level:
            level, own = level + 1, hashlib.blake2b(b"\1" + self.stack.pop()[1] + own, digest_size=32).digest()
        self.stack.append((level, own))

    def root(self) -> bytes:
        if not self.stack:
            return b"\0" * 32
        *rest, (_, own) = self.stack
        for _, left in reversed(rest):
            own = hashlib.blake2b(b"\1" + left + own, digest_size=32).digest()
        return own


def merkle(leaves: list[bytes]) -> bytes:
    tree = Merkle()
    for x in leaves:
        tree.add(x)
    return tree.root()


#: Settings of a vocabulary file under which words between ASCII blanks don't act on each other.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLIT = {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True}
BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False}
#: A run of Latin letters that no normal form changes and that have one lower-case letter each, between ASCII marks: under
#: SPLIT the three are words of their own. (Not İ; not the apostrophe, which SPLIT may take with the letters behind it.)
PLAIN = re.compile(r"""([!-&(-/:-@\[-`{-~]*)([A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u012F\u0131-\u017F]+)([!-&(-/:-@\[-`{-~]*)""")
#: Words that the library encodes at a time; characters of a slice of texts.
AT_ONCE, SLICE = 2000, 2_000_000


def separates_words(spec: dict) -> bool:
    """Whether the settings in a vocabulary file are those under which each word between ASCII blanks can be encoded alone."""
    split = spec.get("pre_tokenizer") or {}
    steps = split.get("pretokenizers") or []
    model, added = spec["model"], spec.get("added_tokens") or []
    return (
        spec.get("normalizer") == NORMALIZER and split.get("type") == "Sequence" and len(steps) == 2 and steps[0] == SPLIT
        and {k: v for k, v in steps[1].items() if k != "trim_offsets"} == BYTE_LEVEL
        and model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
        and not any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] or len(t["content"].split()) != 1 for t in added)
        and not spec.get("truncation") and not spec.get("padding")
    )


class Encoder:
    """Ids of whole texts as the tokenizers library gives them. Where the vocabulary's settings keep words between blanks
    apart, distinct words of a slice are encoded once each and remembered."""

    def __init__(self, file: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        spec = json.loads(file)
        self.library, self.by_word, self.memory = Tokenizer.from_str(file), separates_words(spec), WordMemory()
        self.kind = "<u4" if self.library.get_vocab_size() > 1 << 16 else "<u2"
        self.runs = functools.lru_cache(maxsize=4096)(self.alone)
        self.packs = [struct.Struct(f"<{n}{'I' if self.kind == '<u4' else 'H'}") for n in range(24)]
        self.letters = {b: c for c, b in byte_letters().items()}
        added = [t["content"] for t in spec.get("added_tokens") or []]
        self.special, self.lettered = re.compile("|".join(map(re.escape, added)) or "(?!)"), any(t.isalpha() for t in added)
        self.case_counts = "|".join([r"\p{M}", *("(?i:" + re.sub(r"([^A-Za-z0-9])", r"\\\1", t) + ")" for t in added)])

    def alone(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the texts end to end, and where each text begins, and the end."""
        if not self.by_word:
            own = [np.array(x.ids, self.kind) for t in texts for x in self.library.encode_batch_fast([t], add_special_tokens=False)]
            return np.concatenate(own or [np.zeros(0, self.kind)]), np.cumsum([0, *map(len, own)])
        whole = pa.array(texts, pa.large_string())
        # A-Z go to lower case before the normal form, but where a combining mark or a special token stands in the text
        whole = pc.if_else(pc.match_substring_regex(whole, self.case_counts), whole, pc.ascii_lower(whole))
        words = pc.ascii_split_whitespace(whole)
        coded = words.values.dictionary_encode()
        known = self.memory.lookup(coded.dictionary.to_numpy(zero_copy_only=False).tolist(), self.learn)
        flat, sizes = np.frombuffer(b"".join(known), self.kind), np.fromiter(map(len, known), np.int64, len(known)) // np.dtype(self.kind).itemsize
        which = coded.indices.to_numpy()
        times = sizes[which]
        ends = np.concatenate([[0], np.cumsum(times)])
        first = (np.cumsum(sizes) - sizes)[which]
        return flat[np.repeat(first - ends[:-1], times) + np.arange(ends[-1])], ends[words.offsets.to_numpy()]

    def learn(self, words: list[str]) -> list[bytes]:
        """A run of letters goes to the library's model at once, in lower case; marks around it are kept apart; all other
        words go through the library as they are."""
        out: list[bytes] = [b""] * len(words)
        rest, tokenize, packs, peek = [], self.library.model.tokenize, self.packs, self.memory.new.get
        for i, w in enumerate(words):
            before = after = ""
            if not (w.isascii() and w.isalpha()) or self.lettered:
                if (parts := PLAIN.fullmatch(w)) is None or self.special.search(w):
                    rest.append(i)
                    continue
                before, w, after = parts.groups()
            w = w.lower()
            if not (before or after) or (own := peek(w)) is None:
                ids = [t.id for t in tokenize(w if w.isascii() else "".join(map(self.letters.__getitem__, w.encode())))]
                own = packs[len(ids)].pack(*ids) if len(ids) < len(packs) else np.array(ids, self.kind).tobytes()
            out[i] = self.runs(before) + own + self.runs(after) if before or after else own
        for at in range(0, len(rest), AT_ONCE):
            some = rest[at : at + AT_ONCE]
            for i, x in zip(some, self.library.encode_batch_fast([words[i] for i in some], add_special_tokens=False), strict=True):
                out[i] = np.array(x.ids, self.kind).tobytes()
        return out


@functools.lru_cache(maxsize=2)
def _encoder(key: str, file: str) -> Encoder:
    return Encoder(file)


def encoder(file: str) -> Encoder:
    """The encoder of a vocabulary; a worker makes it once."""
    return _encoder(hashlib.sha256(file.encode()).hexdigest(), file)


def gear() -> np.ndarray:
    """A random number for each id, from a fixed seed."""
    return np.random.Generator(np.random.PCG64(11)).integers(0, 1 << 63, 1 << 16, dtype=np.uint64)


def cuts(ids: np.ndarray, starts: np.ndarray, table: np.ndarray) -> list[list[int]]:
    """Where the chunks of each document end. ids: the documents end to end; starts: where each begins, and the end."""
    values = table[ids & 0xFFFF]
    rolled = np.zeros(len(ids), np.uint64)
    for k in range(min(WINDOW, len(ids))):  # the hash of an id and the WINDOW - 1 before it; LEAST keeps cuts clear of the document before
        rolled[k:] += values[: len(ids) - k] << np.uint64(k)
    marks = np.flatnonzero((rolled >> np.uint64(20)) % np.uint64(USUAL - LEAST) == 0) + 1
    out = []
    for begin, end in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        own, at = [], begin
        nearby = marks[np.searchsorted(marks, begin + LEAST) : np.searchsorted(marks, end)].tolist()
        for m in [*nearby, end]:
            if m - at < LEAST and m != end:
                continue
            while m - at > MOST:
                at += MOST
                own.append(at)
            if m > at:
                own.append(m)
                at = m
        out.append(own)
    return out


def shift_tables() -> list[np.ndarray]:
    """For each power of two, what appending so many zero bytes does to the bits of a CRC-32."""
    step = np.array([0xEDB88320, *(1 << i for i in range(31))], np.uint64)  # one zero bit
    out = []
    for k in range(3 + 40):
        if k >= 3:
            out.append(step)
        step = shift_once(step, step)
    return out


def shift_once(crcs: np.ndarray, table: np.ndarray) -> np.ndarray:
    out = np.zeros_like(crcs)
    for bit in range(32):
        out ^= np.where(crcs >> np.uint64(bit) & np.uint64(1) != 0, table[bit], np.uint64(0))
    return out


def shifted(crcs: np.ndarray, sizes: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
    """CRC-32 values moved before as many bytes as `sizes` says: the CRC of a whole is the exclusive or of its parts' so moved."""
    out = crcs.astype(np.uint64)
    for k in range(int(sizes.max(initial=0)).bit_length()):
        on = sizes >> k & 1 != 0
        out[on] = shift_once(out[on], tables[k])
    return out


def write_store(docs: DataFrame, path: str, vocabulary_path: str, end_id: int = 1, key: str = "doc_id", text: str = "text") -> None:
    """Encodes whole texts, appends end_id to each and writes the store to `path`.

    A null or empty text is its end id alone. Rows that repeat a key are kept, in an order that their ids fix; a null
    key comes first. Other columns than key and text are not stored. An empty table gives an empty store, and a single short
    text a store of one chunk. A text of any length is encoded whole, in one task.
    """
    spark = docs.sparkSession
    with open(vocabulary_path, encoding="utf-8") as f:
        file = spark.sparkContext.broadcast(f.read())  # the file of one vocabulary: well under 10 MB
    kind = docs.schema[key].dataType
    own = "kind string, key binary, payload binary, n long, root binary, chunks binary, sizes binary"
    schema = T.StructType([T.StructField("doc", kind), *T._parse_datatype_string(own)])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, table, sent = encoder(file.value), gear(), set()
        for batch, texts in text_slices(batches, "text", SLICE):
            bare, bounds = coder.encode_all([t or "" for t in texts])
            ids = np.insert(bare, bounds[1:], end_id)
            starts, width, data = bounds + np.arange(len(bounds)), ids.itemsize, ids.tobytes()
            ends = cuts(ids.astype(np.int64), starts, table)
            recipes, fresh = [], []
            for begin, own_ends in zip(starts[:-1].tolist(), ends, strict=True):
                at, names, sizes = begin, [], []
                for e in own_ends:
                    name = digest(payload := data[at * width : e * width])
                    if name not in sent:
                        if len(sent) >= MEMORY:
                            sent.clear()
                        sent.add(name)
                        fresh.append((name, payload, e - at))
                    names.append(name)
                    sizes.append(e - at)
                    at = e
                recipes.append((at - begin, merkle(names), b"".join(names), np.array(sizes, "<u4").tobytes()))
            none = lambda k, n: pa.nulls(n, k)
            docs_kind = batch.schema.field("doc").type
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(["doc"] * len(recipes)), pa.array([x[1][:16] for x in recipes], pa.binary()), none(pa.binary(), len(recipes)), pa.array([x[0] for x in recipes], pa.int64()), *(pa.array([x[i] for x in recipes], pa.binary()) for i in (1, 2, 3))], ["doc", "kind", "key", "payload", "n", "root", "chunks", "sizes"])
            if fresh:
                n = len(fresh)
                yield pa.RecordBatch.from_arrays([none(docs_kind, n), pa.array(["chunk"] * n), pa.array([x[0] for x in fresh], pa.binary()), pa.array([x[1] for x in fresh], pa.binary()), pa.array([x[2] for x in fresh], pa.int64()), *(none(pa.binary(), n) for _ in range(3))], ["doc", "kind", "key", "payload", "n", "root", "chunks", "sizes"])

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # rows come in order of kind and key: of equal chunks the first stays
        for batch in batches:
            keep = []
            for what, name in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                keep.append(what != "chunk" or name != last)
                last = name if what == "chunk" else last
            yield batch.filter(pa.array(keep, pa.bool_()))

    rows = docs.select(F.col(f"`{key}`").alias("doc"), F.col(f"`{text}`").alias("text")).mapInArrow(encode, schema)
    # copies of one document share a root: their recipes are dealt by key as well
    deal = F.when(F.col("kind") == "chunk", F.xxhash64("key")).otherwise(F.xxhash64("doc", "key"))
    dealt = rows.withColumn("deal", deal).repartition("deal").sortWithinPartitions("kind", "key").drop("deal")
    with small_batches(spark):
        dealt.mapInArrow(once, schema).write.partitionBy("kind").parquet(f"{path}/store")
    recipes = spark.read.schema(schema).parquet(f"{path}/store").filter("kind = 'doc'").select("doc", "n", "root", "chunks", "sizes")
    indexed = T.StructType([T.StructField("doc", kind), *T._parse_datatype_string("kind string, part long, row long, local_start long, n long, root binary, chunks binary, sizes binary")])

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, base = [f.name for f in indexed], TaskContext.get().partitionId() << 32
        part, row, start, tree = base, 0, 0, Merkle()

        def end(like: pa.RecordBatch) -> pa.RecordBatch:
            one = lambda v, k: pa.array([v], k)
            return pa.RecordBatch.from_arrays([pa.nulls(1, like.column(0).type), pa.array(["part"]), *(one(x, pa.int64()) for x in (part, row, 0, start)), one(tree.root(), pa.binary()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary())], names)

        last = None
        for whole in batches:
            at = 0
            while at < whole.num_rows:
                batch = whole.slice(at, PART - row)
                at, n = at + batch.num_rows, batch.num_rows
                counts = np.array(batch.column(1).to_pylist(), np.int64)
                starts = start + np.cumsum(counts) - counts
                for key, count, root in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                    tree.add(leaf(key, count, root))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(["doc"] * n), pa.array([part] * n, pa.int64()), pa.array(range(row, row + n), pa.int64()), pa.array(starts, pa.int64()), *batch.columns[1:]], names)
                row, start, last = row + n, start + int(counts.sum()), batch
                if row == PART:
                    yield end(batch)
                    part, row, start, tree = part + 1, 0, 0, Merkle()
        if row:
            yield end(last)

    order = [F.col("doc").asc_nulls_first(), F.col("root")]
    recipes.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order).mapInArrow(index, indexed).write.partitionBy("kind").parquet(f"{path}/index")
    drop_staged(spark, f"{path}/store/kind=doc")
    parts = index_rows(spark, path, kind).filter("kind = 'part'").select("part", "row", "n", "root")
    spark.createDataFrame([over_parts(parts)], MANIFEST).coalesce(1).write.parquet(f"{path}/manifest")


MANIFEST = "parts long, documents long, ids long, root binary"


def leaf(key: object, n: int, root: bytes) -> bytes:
    """What a document is in its part's tree."""
    return f"{key!r} {n} ".encode() + root


def over_parts(parts: DataFrame) -> tuple[int, int, int, bytes]:
    """The manifest's row: a row for each 65,536 documents comes to the driver."""
    tree, number, documents, ids = Merkle(), 0, 0, 0
    for part, rows, n, root in sorted(map(tuple, parts.collect())):
        tree.add(f"{part} {rows} {n} ".encode() + bytes(root))
        number, documents, ids = number + 1, documents + rows, ids + n
    return number, documents, ids, tree.root()


def index_rows(spark, path: str, kind: T.DataType) -> DataFrame:
    own = T.StructType([T.StructField("doc", kind), *T._parse_datatype_string("part long, row long, local_start long, n long, root binary, chunks binary, sizes binary, kind string")])
    return spark.read.schema(own).parquet(f"{path}/index")


def read_index(spark, path: str, kind: T.DataType) -> tuple[DataFrame, DataFrame]:
    """Recipes (doc, part, row, start, n, root, chunks, sizes) and parts (part, rows, n, root, first). Each part's tree is
    built again from its recipes; a part that is not the one that was written, or doesn't stand in the manifest, is an error."""
    rows = index_rows(spark, path, kind)
    parts = rows.filter("kind = 'part'").select("part", F.col("row").alias("rows"), "n", "root")
    found, written = over_parts(parts), spark.read.schema(MANIFEST).parquet(f"{path}/manifest").collect()
    if [found] != [(r.parts, r.documents, r.ids, bytes(r.root)) for r in written]:
        raise ValueError("the parts of the index don't match the manifest")

    def rebuilt(group: pa.Table) -> pa.Table:  # at most PART rows
        tree, number, total = Merkle(), 0, 0
        for row, key, n, root in sorted(zip(*(group.column(c).to_pylist() for c in ("row", "doc", "n", "root")), strict=True), key=lambda x: x[0]):
            if row != number:
                break
            tree.add(leaf(key, n, root))
            number, total = number + 1, total + n
        return pa.table({"part": group.column("part").slice(0, 1), "own_rows": pa.array([number], pa.int64()), "own_n": pa.array([total], pa.int64()), "own_root": pa.array([tree.root()], pa.binary())})

    again = rows.filter("kind = 'doc'").select("part", "row", "doc", "n", "root").groupBy("part").applyInArrow(rebuilt, "part long, own_rows long, own_n long, own_root binary")
    same = (F.col("rows") == F.col("own_rows")) & (F.col("n") == F.col("own_n")) & (F.col("root") == F.col("own_root"))
    sound = F.when(same, F.col("n")).otherwise(F.raise_error(F.concat(F.lit("the recipes of a part don't match its root: "), "part")).cast("long"))
    parts = parts.join(again, "part", "left").select("part", "rows", sound.alias("n"), "root")
    parts = parts.withColumn("first", F.sum("n").over(W.orderBy("part")) - F.col("n"))  # one row for many documents
    hint = F.broadcast if found[0] <= BROADCAST_PARTS else (lambda x: x)
    docs = rows.filter("kind = 'doc'").drop("kind").join(hint(parts.select("part", "first")), "part")
    return docs.withColumn("start", F.col("first") + F.col("local_start")).drop("first", "local_start"), parts


def references(docs: DataFrame, width: int) -> DataFrame:
    """A row for each chunk of each document: doc, part, row, start, n, chunk (its number), of (chunks), key and behind
    (bytes of 4 an id that follow it). A recipe whose root doesn't match its chunks is an error."""
    kind = docs.schema["doc"].dataType
    schema = T.StructType([T.StructField("doc", kind), *T._parse_datatype_string("part long, row long, start long, n long, chunk int, of int, key binary, behind long")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                batch = whole.slice(at, 2000)
                names, behind, times = [], [], []
                for root, chunks, sizes in zip(*(batch.column(i).to_pylist() for i in (5, 6, 7)), strict=True):
                    own = [chunks[i : i + 16] for i in range(0, len(chunks), 16)]
                    if merkle(own) != root:
                        raise ValueError("a recipe's root doesn't match its chunks")
                    sized = np.frombuffer(sizes, "<u4").astype(np.int64) * width
                    names += own
                    behind.append(sized.sum() - np.cumsum(sized))
                    times.append(len(own))
                take = pa.array(np.repeat(np.arange(batch.num_rows), times))
                number = np.concatenate([np.arange(t) for t in times]) if times else np.zeros(0)
                yield pa.RecordBatch.from_arrays([*(batch.column(i).take(take) for i in range(5)), pa.array(number, pa.int32()), pa.array(np.repeat(times, times), pa.int32()), pa.array(names, pa.binary()), pa.array(np.concatenate(behind) if behind else [], pa.int64())], [f.name for f in schema])

    return docs.select("doc", "part", "row", "start", "n", "root", "chunks", "sizes").mapInArrow(run, schema)


def stored_chunks(spark, path: str) -> DataFrame:
    return spark.read.schema("key binary, payload binary, kind string").parquet(f"{path}/store").filter("kind = 'chunk'").select("key", "payload")


def read_digests(spark, path: str, vocabulary_path: str, kind: T.DataType | None = None) -> DataFrame:
    """Per document from the files: doc, start (ids of all before it), n_tokens and ids_crc32 (of its ids as little-endian
    unsigned 32-bit integers). Every stored chunk is read and its hash checked; a document's CRC is put together from
    its chunks', so chunks needn't travel. What is damaged or missing is an error: a chunk, a recipe, a part."""
    with open(vocabulary_path, encoding="utf-8") as f:
        code = encoder(f.read()).kind
    docs, _ = read_index(spark, path, kind or T.LongType())

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, crcs, sizes = batch.column(0).to_pylist(), [], []
            for name, payload in zip(keys, batch.column(1), strict=True):
                data = payload.as_py()
                if digest(data) != name:
                    raise ValueError("a chunk doesn't match its hash")
                crcs.append(zlib.crc32(np.frombuffer(data, code).astype("<u4").tobytes()))
                sizes.append(len(data) // np.dtype(code).itemsize)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(crcs, pa.int64()), pa.array(sizes, pa.int64())], ["key", "crc", "ids"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = shift_tables()
        for batch in batches:
            moved = shifted(np.array(batch.column("crc").to_pylist(), np.int64), np.array(batch.column("behind").to_pylist(), np.int64), tables)
            at = batch.schema.get_field_index("crc")
            yield batch.set_column(at, "crc", pa.array(moved.astype(np.int64), pa.int64()))

    chunks = stored_chunks(spark, path).mapInArrow(check, "key binary, crc long, ids long")
    refs = references(docs, 4).join(chunks, "key", "left").drop("key")
    refs = refs.withColumn("crc", F.coalesce("crc", F.raise_error(F.lit("a chunk is missing")).cast("long")))
    placed = refs.mapInArrow(place, refs.schema)
    whole = placed.groupBy("part", "row", "doc", "start", "n").agg(F.bit_xor("crc").alias("ids_crc32"), F.sum("ids").alias("ids"))
    sound = F.when(F.col("ids") == F.col("n"), F.col("n")).otherwise(F.raise_error(F.lit("chunks don't add up to their document")).cast("long"))
    return whole.select("doc", "start", sound.alias("n_tokens"), "ids_crc32")


def read_documents(spark, path: str, vocabulary_path: str, kind: T.DataType | None = None) -> DataFrame:
    """Per document from the files: doc, start and ids (array). Chunks are checked and put together again."""
    with open(vocabulary_path, encoding="utf-8") as f:
        code = encoder(f.read()).kind
    docs, _ = read_index(spark, path, kind or T.LongType())
    parts = references(docs, 4).join(stored_chunks(spark, path), "key", "left")
    rows = parts.groupBy("part", "row", "doc", "start").agg(F.sort_array(F.collect_list(F.struct("chunk", "key", "payload"))).alias("chunks"))
    schema = T.StructType([T.StructField("doc", docs.schema["doc"].dataType), *T._parse_datatype_string("start long, ids array<int>")])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 200):
                batch = whole.slice(at, 200)
                ids = []
                for chunks in batch.column(2).to_pylist():
                    if any(c["payload"] is None or digest(c["payload"]) != c["key"] for c in chunks):
                        raise ValueError("a chunk is missing or doesn't match its hash")
                    ids.append(np.frombuffer(b"".join(c["payload"] for c in chunks), code).astype(np.int32))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ids, pa.list_(pa.int32()))], ["doc", "start", "ids"])

    return rows.select("doc", "start", "chunks").mapInArrow(join, schema)
