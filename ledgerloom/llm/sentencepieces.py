"""SentencePiece encoding that keeps offsets, and decoding.

The normaliser of the model is run here: at each place the longest prefix that the compiled character map knows is
replaced, and every normalised byte keeps the place in the source that it came from. What comes out is given to the
library's processor of the same model, whose own normaliser is switched off, and which cuts it into pieces; their
lengths in normalised bytes, laid over the alignment, give each piece its source bytes.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from .shared import WordMemory, column_after, text_slices, unclash

MARK = "▁".encode()
#: A word with the marks before it.
WORD = re.compile("▁+[^▁]*")
#: Fixed value: a normaliser that changes nothing, as it stands in a model (field 3: name, no map, no prefix, no squeezing, no escaping).
#: Behind the model's own it takes the place of each of its fields.
SWITCHED_OFF = b"\x1a\x12" + b"\x0a\x08identity" + b"\x12\x00" + b"\x18\x00" + b"\x20\x00" + b"\x28\x00"


def fields(data: bytes) -> Iterator[tuple[int, bytes | int]]:
    """Field numbers and values of a protocol buffer message."""

    def number(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            value, shift, at = value | (byte & 127) << shift, shift + 7, at + 1
            if byte < 128:
                return value, at

    at = 0
    while at < len(data):
        tag, at = number(at)
        if tag & 7 == 0:
            value, at = number(at)
        else:
            size, at = number(at) if tag & 7 == 2 else ({1: 8, 5: 4}[tag & 7], at)
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


class CharMap:
    """A compiled character map: a double-array trie of source strings, and the strings that they become."""

    def __init__(self, compiled: bytes):
        size = int.from_bytes(compiled[:4], "little")
        self.units = np.frombuffer(compiled[4 : 4 + size], "<u4").tolist()
        self.texts = compiled[4 + size :]
        root = self.offset(self.units[0]) if self.units else 0
        self.first = {b for b in range(1, 256) if (root ^ b) < len(self.units) and self.label(self.units[root ^ b]) == b}

        # letters and marks of one or two bytes that stay as they are before another of them, or before a single blank that
        # stays: no key begins with one of them and the first byte of the other
        stays = [x for x in map(str.encode, [*map(chr, range(33, 127)), *map(chr, range(0xC0, 0x800))]) if self.longest(x, 0) in ((0, b""), (len(x), x))]
        heads = {x[:1] for x in stays if x[0] not in (0xCC, 0xCD)}  # those two lead combining marks
        stays = [x for x in stays if x[:1] in heads and not any(self.reaches(x + h) for h in heads)]
        inner = b" " if self.longest(b" ", 0) in ((0, b""), (1, b" ")) and not any(self.reaches(x + b" ") for x in stays) and not any(self.reaches(b" " + h) for h in heads) else b""
        groups: dict[bytes, list[bytes]] = {}
        for x in stays:
            groups.setdefault(x[:-1], []).append(b"\\x%02x" % x[-1])
        some = b"|".join(b"%s[%s]%s" % (b"\\x%02x" % h[0] if h else b"", b"".join(own), b"" if h else b"+") for h, own in groups.items())
        self.run = re.compile(b"(?:%s)+(?: (?:%s)+)*(?=%s)" % (some, some, some + (b"| " if inner else b"")) if inner else b"(?:%s)+(?=%s)" % (some, some)) if stays else re.compile(b"(?!)")

    def reaches(self, front: bytes) -> bool:
        """Whether some key begins with these bytes."""
        node = self.offset(self.units[0]) if self.units else 0
        for b in front:
            node ^= b
            if node >= len(self.units) or self.label(unit := self.units[node]) != b:
                return False
            node ^= self.offset(unit)
        return bool(self.units)

    @staticmethod
    def offset(unit: int) -> int:
        return unit >> 10 << ((unit & 1 << 9) >> 6)

    @staticmethod
    def label(unit: int) -> int:
        return unit & (1 << 31 | 255)

    def longest(self, data: bytes, at: int) -> tuple[int, bytes]:
        """Bytes of the longest known prefix of data[at:], and what they become; 0 if none is known."""
        if at >= len(data) or data[at] not in self.first:
            return 0, b""
        node, length, value, i = self.offset(self.units[0]), 0, 0, at
        while i < len(data) and data[i]:
            node ^= data[i]
            if node >= len(self.units) or self.label(unit := self.units[node]) != data[i]:
                break
            node ^= self.offset(unit)
            i += 1
            if unit >> 8 & 1:
                length, value = i - at, self.units[node] & (1 << 31) - 1
        return length, self.texts[value : self.texts.index(b"\0", value)] if length else b""


@dataclass
class Normaliser:
    """The normaliser that a model carries."""

    charmap: CharMap | None = None
    dummy_prefix: bool = True
    squeeze: bool = True
    escape: bool = True
    suffix: bool = False

    @classmethod
    def of(cls, model: bytes) -> Normaliser:
        out = cls()
        for field, value in fields(model):
            if field == 2:
                out.suffix = any(n == 24 and v for n, v in fields(value))
            if field == 3:
                for n, v in fields(value):
                    if n == 2 and v:
                        out.charmap = CharMap(v)
                    elif n in (3, 4, 5):
                        setattr(out, {3: "dummy_prefix", 4: "squeeze", 5: "escape"}[n], bool(v))
        return out

    def __call__(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """The normalised bytes, and for each of them and for the end its place in `data` (well-formed UTF-8)."""
        if self.charmap is None and not self.squeeze:
            return self.plain(data)
        space = MARK if self.escape else b" "
        out, places, at = bytearray(), [], 0
        parts: list[tuple[int, int, bytes]] = []  # source place, its bytes, what they become
        run, runs = (self.charmap.run, set()) if self.charmap else (None, set())
        while at < len(data):
            if run and (own := run.match(data, at)):
                parts.append((at, own.end() - at, own[0]))
                runs.add(at)
                at = own.end()
            n, to = self.charmap.longest(data, at) if self.charmap else (0, b"")
            if not n:
                n = 1 if data[at] < 0x80 else 2 if data[at] < 0xE0 else 3 if data[at] < 0xF0 else 4
                to = data[at : at + n]
            parts.append((at, n, to))
            at += n
        begin, end = 0, len(data)
        if self.squeeze:
            while parts and not parts[0][2].strip(b" "):
                begin = parts[0][0] + parts[0][1]
                parts.pop(0)
        if not parts:
            return b"", np.array([len(data)], np.int64)

        def put(to: bytes, place: int) -> None:
            out.extend(to)
            places.extend([place] * len(to))

        if self.dummy_prefix and not self.suffix:
            put(space, begin)
        blank = self.squeeze
        for place, _, to in parts:
            if place in runs:
                if to.isascii() and b" " not in to:
                    places.extend(range(place, place + len(to)))
                else:
                    own = np.frombuffer(to, np.uint8)
                    begins = np.maximum.accumulate(np.where(own & 0xC0 == 0x80, 0, np.arange(place, place + len(to))))  # a letter's bytes have one place
                    places.extend(np.repeat(begins, np.where(own == 0x20, len(space), 1)).tolist())
                out.extend(to.replace(b" ", space))
                blank = False
                continue
            if self.squeeze and blank:
                to = to.lstrip(b" ")
            if to:
                put(to.replace(b" ", space), place)
                blank = to.endswith(b" ")
        if self.squeeze:
            while out.endswith(space):
                del out[-len(space) :]
                end = places[-len(space)]
                del places[-len(space) :]
        if self.dummy_prefix and self.suffix:
            put(space, end)
        places.append(end)
        return bytes(out), np.array(places, np.int64)

    def plain(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """As above for an empty map without squeezing, where each byte stays and a blank may become a mark."""
        if not data:
            return b"", np.zeros(1, np.int64)
        space = MARK if self.escape else b" "
        source = np.frombuffer(data, np.uint8)
        places = np.repeat(np.arange(len(source)), np.where(source == 0x20, len(space), 1))
        front, back = (space, b"") if self.dummy_prefix and not self.suffix else (b"", space if self.dummy_prefix else b"")
        ends = [np.zeros(len(front), np.int64), places, np.full(len(back) + 1, len(source))]
        return front + data.replace(b" ", space) + back, np.concatenate(ends)


class Codec:
    """A model's normaliser, the library's encoder of normalised text, its decoder, and the bytes of each piece."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.encoder = sentencepiece.SentencePieceProcessor(model_proto=model + SWITCHED_OFF)
        self.normaliser, self.memory = Normaliser.of(model), WordMemory()
        kinds = [dict(fields(value)).get(3, 1) for field, value in fields(model) if field == 1]
        if 4 in kinds:
            raise ValueError("models with symbols of the user are not supported: their normaliser leaves those as they are")
        pieces = [self.library.id_to_piece(i) for i in range(len(kinds))]
        self.bytes_of = np.array([0 if k == 3 else 1 if k == 6 else len(p.encode()) for k, p in zip(kinds, pieces, strict=True)], np.int64)
        self.unknown = self.library.unk_id()
        spec = dict(fields(dict(fields(model)).get(2, b"")))
        # no piece has a mark behind another character, so merges never cross a word's start and words can be encoded one by one
        self.by_word = spec.get(3) == 2 and self.normaliser.escape and not self.normaliser.suffix and not any(re.search("[^▁]▁", p) for p in pieces) and self.library.piece_to_id("▁") != self.unknown

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Of each text the ids with begin and end ids, and their spans: first and last (exclusive) source byte of each id."""
        normal = [self.normaliser(t.encode()) for t in texts]
        words = [self.words(data.decode()) for data, _ in normal]
        distinct = list(set().union(*words))
        known = dict(zip(distinct, self.memory.lookup(distinct, self.learn), strict=True))
        edges = (np.array([x], "<u4").tobytes() for x in (self.library.bos_id(), self.library.eos_id()))
        first, last = edges
        ids = [np.frombuffer(first + b"".join(map(known.__getitem__, own)) + last, "<u4") for own in words]
        return ids, [self.spans(x, own, places) for x, own, (_, places) in zip(ids, words, normal, strict=True)]

    def words(self, normal: str) -> list[str]:
        """The parts of a normalised text that are encoded one by one: what stands before the first mark, and words with their marks."""
        if not self.by_word:
            return [normal] if normal else []
        own = WORD.findall(normal)
        return own if not normal or normal.startswith("▁") else [normal[: len(normal) - sum(map(len, own))], *own]

    def learn(self, words: list[str]) -> list[bytes]:
        return [np.array(ids, "<u4").tobytes() for ids in self.encoder.encode(words, num_threads=1)]

    def spans(self, ids: np.ndarray, words: list[str], places: np.ndarray) -> np.ndarray:
        """The pieces' lengths in normalised bytes, laid over the places in the source that those bytes came from."""
        sizes = self.bytes_of[ids]
        if (ids[1:-1] == self.unknown).any():  # an unknown piece is as long as what it stands for
            pieces = [p for w in words for p in self.encoder.encode(w, out_type=str)]
            sizes[1:-1] = [self.bytes_of[i] if i != self.unknown else len(p.encode()) for i, p in zip(ids[1:-1].tolist(), pieces, strict=True)]
        ends = np.cumsum(sizes)
        if ends[-1] != len(places) - 1:
            raise ValueError(f"pieces have {ends[-1]} normalised bytes, the text has {len(places) - 1}")
        return np.stack([places[ends - sizes], places[ends]], axis=1)


@functools.lru_cache(maxsize=2)
def codec(digest: str, model: bytes) -> Codec:
    return Codec(model)


def piece_codec(model: bytes) -> Codec:
    """The codec of a model; a worker makes it once."""
    return codec(hashlib.sha256(model).hexdigest(), model)


OUT = ("ids", "spans", "decoded")


def with_map(model: bytes, rule: str) -> bytes:
    """A model with the compiled character map of one of the library's rules (nfkc, nmt_nfkc, ...) in place of its own."""
    import sentencepiece

    return model + sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto()


def encode_pieces(docs: DataFrame, model_path: str, text: str = "text", rule: str | None = None) -> DataFrame:
    """`docs` with ids (little-endian unsigned 32-bit integers, begin and end ids included), spans (two such integers
    an id: source bytes) and decoded (the library's decoding of the ids), row by row.

    A null or empty text has the two outer ids alone. Columns of `docs` named like the new ones get an underscore
    before them; if `text` is one of those, it is still the one that is read. `rule` puts a character map of
    the library's in place of the model's. Texts of any length are encoded whole, repeated rows get a
    row each, and an empty table gives no rows. The model's bytes go to the executors with the job, so they need not hold the file.
    """
    with open(model_path, "rb") as f:
        own_model = f.read() if rule is None else with_map(f.read(), rule)
    model = docs.sparkSession.sparkContext.broadcast(own_model)  # the file of one vocabulary: well under 10 MB
    docs, moved = unclash(docs, OUT)
    text = column_after(moved, text)
    schema = T.StructType([*docs.schema, *T._parse_datatype_string("ids binary, spans binary, decoded string")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = piece_codec(model.value)
        for batch, texts in text_slices(batches, text):
            ids, spans = own.encode([t or "" for t in texts])
            decoded = own.library.decode([x.tolist() for x in ids], num_threads=1)
            columns = [pa.array([x.tobytes() for x in ids], pa.binary()), pa.array([x.astype("<u4").tobytes() for x in spans], pa.binary()), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *OUT])

    return docs.mapInArrow(run, schema)
