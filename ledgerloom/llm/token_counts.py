"""Token counts at every prefix of a text, by dynamic programming over prefixes.

A byte-pair encoding is right exactly when every two neighbours stay as they are when encoded together. So each prefix
has one last token: the one that ends it, fits behind the last token of the prefix before it, and is itself encoded as
one token. Its count is one more than the count of that shorter prefix. The table is made once for each distinct word
of the pre-tokeniser and laid end to end for a text, so any prefix's count, and the longest prefix within a budget, are
read from it without encoding again.
"""

from __future__ import annotations

import functools
import hashlib
import json
import struct
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, types as T

from .shared import WordMemory, column_after, text_slices, unclash

#: Fixed value: the pattern that splits text before the merges of byte-level vocabularies.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Blanks of two or more characters before something else: the last one leaves them when the next character comes.
GAP = regex.compile(r"\s{2,}(?=\S)")
BLANKS = regex.compile(r"\s\s")
#: Pairs of tokens that a worker keeps the fit of, before it starts anew.
PAIRS = 400_000


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable Latin-1 for itself, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class PrefixCounter:
    """Tables of one byte-level vocabulary, given as the text of a tokenizers file."""

    def __init__(self, file: str):
        spec, letters = json.loads(file), byte_letters()
        raw = lambda s: bytes(letters[c] for c in s)
        specials = [x["content"] for x in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(specials, key=len, reverse=True)))) if specials else None
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.rank = {(raw(a), raw(b)): i for i, (a, b) in enumerate(merges)}
        self.split: dict[bytes, tuple[bytes, bytes]] = {}
        self.spines: dict[tuple[bytes, bool], tuple[list[bytes], list[int]]] = {}
        self.tokens = {bytes([b]) for b in range(256)} & {raw(t) for t in spec["model"]["vocab"] if t not in specials}
        for a, b in self.rank:  # in order of rank, so that both parts are known before
            if a not in self.tokens or b not in self.tokens or a + b in self.split:
                raise ValueError(f"merge {a!r} {b!r} is not one of a trained vocabulary: a part comes later or the whole twice")
            if not self.crosses(a, b):
                self.split[a + b] = a, b
                self.tokens.add(a + b)
        self.finder = ahocorasick.Automaton()
        for t in self.tokens:
            self.finder.add_word(t.decode("latin-1"), len(t))
        self.finder.make_automaton()
        self.words = regex.compile(WORDS)
        self.fits: dict[tuple[bytes, bytes], bool] = {}
        self.tables, self.pieces = WordMemory(64 << 20), WordMemory(64 << 20)  # of words, and of what stands between blanks

    def spine(self, token: bytes, left: bool) -> tuple[list[bytes], list[int]]:
        """The pieces at one end of a token as it grows from a byte to the whole, and the rank that ends each but the last."""
        known = self.spines.get((token, left))
        if known is None:
            if len(token) == 1:
                known = [token], []
            else:
                parts = self.split[token]
                pieces, ranks = self.spine(parts[0 if left else 1], left)
                known = [*pieces, token], [*ranks, self.rank[parts]]
            self.spines[token, left] = known
        return known

    def crosses(self, a: bytes, b: bytes) -> bool:
        """Whether, before both tokens are whole, a merge joins the pieces on the two sides of their border.

        The piece at the border on either side lasts until the rank of the merge that takes it into a larger one; the
        border falls if a merge over it comes before that. Of equal ranks the left one is first.
        """
        (left, left_ranks), (right, right_ranks) = self.spine(a, False), self.spine(b, True)
        never, i, j = len(self.rank), 0, 0
        while True:
            ends, begins = left_ranks[i] if i < len(left_ranks) else never, right_ranks[j] if j < len(right_ranks) else never
            if ends == begins == never:
                return False
            over = self.rank.get((left[i], right[j]), never)
            if over < ends and over <= begins and over < never:
                return True
            if ends <= begins:
                i += 1
            else:
                j += 1

    def pair_fits(self, a: bytes, b: bytes) -> bool:
        """Whether the two tokens stay as they are when encoded together."""
        known = self.fits.get((a, b))
        if known is None:
            if len(self.fits) > PAIRS:
                self.fits.clear()
            known = self.fits[a, b] = (a, b) not in self.rank and not self.crosses(a, b)
        return known

    def counts(self, word: bytes) -> list[int]:
        """Tokens of each prefix of a word, by bytes, from the empty one on."""
        count, last, fits = [0] * (len(word) + 1), [b""] * (len(word) + 1), self.fits
        for end, size in self.finder.iter(word.decode("latin-1")):
            end += 1
            if last[end]:
                continue
            begin, token = end - size, word[end - size : end]
            if begin:
                before = last[begin]
                fit = fits.get((before, token))
                if not (self.pair_fits(before, token) if fit is None else fit):
                    continue
            count[end], last[end] = count[begin] + 1, token
        return count

    def table(self, word: str) -> bytes:
        """Growth of the count with each character of a word, as 16-bit integers."""
        data = word.encode()
        counts = self.counts(data)
        if len(word) == len(data):
            at = counts
        else:
            at = [0] + [counts[i] for i in range(1, len(data) + 1) if i == len(data) or data[i] & 0xC0 != 0x80]
        if word in ("'re", "'ve", "'ll"):  # until it is whole, its mark and its letter are words of their own
            at = [0, at[1], at[1] + self.counts(data[1:2])[1], at[3]]
        return struct.pack(f"<{len(at) - 1}h", *map(int.__sub__, at[1:], at))

    def ordinary(self, text: str) -> np.ndarray:
        """Growth of the count with each character of a text without special tokens."""
        if not BLANKS.search(text):  # each single blank begins a word, so what stands between blanks is looked up as one
            first, *rest = text.split(" ")
            distinct = list(set(rest))
            known = dict(zip(distinct, self.pieces.lookup(distinct, lambda new: self.by_words([" " + p for p in new])), strict=True))
            return np.frombuffer(self.by_words([first])[0] + b"".join(map(known.__getitem__, rest)), "<i2")
        out = np.frombuffer(self.by_words([text])[0], "<i2").copy()
        for gap in GAP.finditer(text):
            # a prefix that ends in the blanks has them as one word; its last blank is taken back after that
            counts = self.counts(gap[0].encode())
            more = counts[-1] - counts[len(gap[0][:-1].encode())] - int(out[gap.end() - 1])
            out[gap.end() - 1] += more
            out[gap.end()] -= more
        return out

    def by_words(self, texts: list[str]) -> list[bytes]:
        """Of each text the tables of its words, end to end."""
        words = list(map(self.words.findall, texts))
        distinct = list(set().union(*words))
        known = dict(zip(distinct, self.tables.lookup(distinct, lambda new: list(map(self.table, new))), strict=True))
        return [b"".join(map(known.__getitem__, own)) for own in words]

    def growth(self, text: str) -> np.ndarray:
        """Growth of the count with each character: cumulative sums are the counts of the prefixes."""
        if self.special is None or not (found := list(self.special.finditer(text))):
            return self.ordinary(text)
        parts, at = [], 0
        for hit in found:
            before, own = self.ordinary(text[at : hit.start()]), self.ordinary(text[at : hit.end()])
            # while the special string is not whole, its characters count as ordinary text
            inside = own[hit.start() - at :].astype(np.int64)
            inside[0] += int(own[: hit.start() - at].sum()) - int(before.sum())
            inside[-1] = 1 - int(inside[:-1].sum())
            parts += [before.astype(np.int64), inside]
            at = hit.end()
        return np.concatenate([*parts, self.ordinary(text[at:])])


@functools.lru_cache(maxsize=2)
def _counter(digest: str, file: str) -> PrefixCounter:
    return PrefixCounter(file)


def prefix_counter(file: str) -> PrefixCounter:
    """The tables of a vocabulary; a worker makes them once and keeps them."""
    return _counter(hashlib.sha256(file.encode()).hexdigest(), file)


def prefix_counts(stored: bytes) -> np.ndarray:
    """Tokens of every prefix, from the empty one to the whole text, from a stored table."""
    return np.concatenate([[0], np.cumsum(np.frombuffer(stored, "<i2"), dtype=np.int64)])


def longest_prefix(stored: bytes, budget: int) -> int:
    """Characters of the longest prefix of at most `budget` tokens."""
    return int(np.flatnonzero(prefix_counts(stored) <= budget)[-1])


OUT = ("n_bytes", "n_tokens", "fits", "prefix_growth")


def count_tokens(docs: DataFrame, vocabulary_path: str, budget: int = 512, text: str = "text") -> DataFrame:
    """`docs` with n_bytes (UTF-8), n_tokens, fits (characters of the longest prefix within the budget) and
    prefix_growth (the table: growth of the count with each character, 16-bit little-endian).

    A null text counts as empty. Special strings inside a text count as the library's default has it, one token each.
    Columns of `docs` named like the new ones get an underscore before them; if `text` is one of those, it is still the
    one that is read. Texts of any length are counted whole; repeated rows get a row each; an empty table gives no rows.
    """
    with open(vocabulary_path, encoding="utf-8") as f:
        file = docs.sparkSession.sparkContext.broadcast(f.read())  # the file of one vocabulary: well under 10 MB
    docs, moved = unclash(docs, OUT)
    text = column_after(moved, text)
    schema = T.StructType([*docs.schema, *T._parse_datatype_string("n_bytes long, n_tokens long, fits long, prefix_growth binary")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = prefix_counter(file.value)
        for batch, texts in text_slices(batches, text):
            whole = [t or "" for t in texts]
            tables = [counter.growth(t) for t in whole]
            totals = [int(x.sum(dtype=np.int64)) for x in tables]
            stored = [x.astype("<i2").tobytes() for x in tables]
            fits = [len(t) if n <= budget and not (x < 0).any() else longest_prefix(s, budget) for t, n, x, s in zip(whole, totals, tables, stored, strict=True)]
            columns = [pa.array([len(t.encode()) for t in whole], pa.int64()), pa.array(totals, pa.int64()), pa.array(fits, pa.int64()), pa.array(stored, pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *OUT])

    return docs.mapInArrow(run, schema)
