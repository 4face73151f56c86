"""Maximal periodic runs of words, found by recompression.

A run is a stretch of words with a smallest period that repeats at least four times, and that no neighbour extends. For each
period p every p-th word is compared with the next such word; a run covers three matching neighbours on this harmonic grid,
so few candidates are left. How far a candidate goes to either side is asked of a run-length grammar: recompression names
blocks of one symbol and then pairs (first symbol from one random half of the alphabet, second from the other), by turns,
until little is left. Equal stretches get equal names but at their ends, so an extension climbs while names agree, and
then goes down to the first words that differ. Names only ever stand for equal words, so answers are exact.

All documents of a slice share one grammar, with a symbol of its own between two; only documents with candidates enter it.
Everything is arrays of one slice; nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from .shared import column_after, text_slices, unclash

#: Least repeats and words of a run; rounds of compression; queries that are answered together.
REPEATS, LEAST, ROUNDS, TOGETHER = 4, 6, 64, 1 << 17
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


class Grammar:
    """A run-length grammar of a sequence whose first and last symbols occur once. Symbols of all levels stand in one table,
    level after level, so that the neighbour of a symbol is the row before or after it."""

    def __init__(self, sequence: np.ndarray):
        seq, sizes = sequence.astype(np.int64), np.ones(len(sequence), np.int64)
        fresh, offset = int(seq.max()) + 1, 0
        names, lengths, firsts, lasts, parents, bases, times = [seq], [sizes], [np.full(len(seq), -1)], [np.full(len(seq), -1)], [], [np.full(len(seq), -1)], [np.zeros(len(seq), np.int64)]

        def level(new: np.ndarray, heads: np.ndarray, base: np.ndarray, repeats: np.ndarray) -> None:
            nonlocal seq, sizes, offset
            stops = np.append(heads[1:], len(seq))
            up = np.zeros(len(seq), np.int64)
            up[heads] = 1
            parents.append(np.cumsum(up) - 1 + offset + len(seq))
            sizes = np.add.reduceat(sizes, heads)
            firsts.append(heads + offset)
            lasts.append(stops - 1 + offset)
            offset += len(seq)
            seq = new
            names.append(seq)
            lengths.append(sizes)
            bases.append(base)
            times.append(repeats)

        for number in range(ROUNDS):
            if len(seq) <= 4:
                break
            heads = np.flatnonzero(np.diff(seq, prepend=-1))
            if len(heads) < len(seq):  # blocks
                repeats, new = np.diff(np.append(heads, len(seq))), seq[heads].copy()
                many = repeats > 1
                codes, known = pd.factorize(new[many] * (len(seq) + 1) + repeats[many])
                base = new.copy()
                new[many] = fresh + codes
                fresh += len(known)
                level(new, heads, base, repeats)
            half = (seq.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(number)) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(63) != 0
            joined = ~half[:-1] & half[1:]
            if joined.any():  # pairs
                keep = np.append(True, ~joined)
                heads = np.flatnonzero(keep)
                new, first = seq[heads].copy(), np.append(joined, False)[heads]
                codes, known = pd.factorize(seq[:-1][joined] * fresh + seq[1:][joined])
                new[first] = fresh + codes
                fresh += len(known)
                level(new, heads, np.full(len(heads), -1), np.zeros(len(heads), np.int64))
        parents.append(np.full(len(seq), -1))
        self.name, self.length, self.first, self.last, self.parent, self.base, self.times = map(np.concatenate, (names, lengths, firsts, lasts, parents, bases, times))

    def common(self, left: np.ndarray, right: np.ndarray, step: int) -> np.ndarray:
        """How many words agree from two places on: forward (step 1), or backward (-1), the places included."""
        name, length, parent, base, times = self.name, self.length, self.parent, self.base, self.times
        edge = self.first if step > 0 else self.last
        out, todo = np.zeros(len(left), np.int64), np.arange(len(left))
        a, b = left.astype(np.int64), right.astype(np.int64)
        down = np.zeros(len(left), bool)
        while len(todo):
            p, q = parent[a], parent[b]
            climb = ~down & (p >= 0) & (q >= 0)
            climb &= (edge[p] == a) & (edge[q] == b) & (name[p] == name[q])
            same = ~climb & (name[a] == name[b])
            out[todo[same]] += length[a[same]]
            unlike = ~climb & ~same
            down |= unlike
            ends = unlike & (edge[a] < 0) | unlike & (edge[b] < 0)
            deeper = unlike & ~ends
            # blocks of one symbol agree as far as the shorter goes
            both = deeper & (base[a] >= 0) & (base[a] == base[b])
            skip = np.where(both, np.minimum(times[a], times[b]), 0)
            out[todo[both]] += skip[both] * length[edge[a[both]]]
            a, b = np.where(climb, p, np.where(same, a + step, np.where(deeper, edge[a] + step * skip, a))), np.where(climb, q, np.where(same, b + step, np.where(deeper, edge[b] + step * skip, b)))
            go = ~ends
            todo, a, b, down = todo[go], a[go], b[go], down[go]
        return out


def candidates(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and periods on harmonic grids. Documents lie end to end, longest first, each behind a symbol of its own."""
    places, periods = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    longest = int(sizes[0]) if len(sizes) else 0
    fits = np.searchsorted(-sizes, -REPEATS * np.arange(longest // REPEATS + 2), "right")  # documents of 4 p words or more
    for p in range(1, longest // REPEATS + 1):
        last = min(fits[p], fits[1]) - 1
        grid = words[: starts[last] + sizes[last] : p]
        same = grid[1:] == grid[:-1]
        three = np.flatnonzero(same[:-2] & same[1:-1] & same[2:])
        if not len(three):
            continue
        fresh = np.flatnonzero(np.diff(three, prepend=-9) > 1)
        group = np.repeat(three[fresh], np.diff(np.append(fresh, len(three))))
        ends = np.append(np.diff(three) > 1, True)
        chosen = three[((three - group) % 3 == 0) | ends] + 1
        places.append(chosen * p)
        periods.append(np.full(len(chosen), p))
    return np.concatenate(places), np.concatenate(periods)


def find_runs(words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of documents end to end (word numbers, sizes): document, start, length and period of each run, in that order."""
    none = (np.zeros(0, np.int64),) * 4
    begins = np.cumsum(sizes) - sizes
    order = np.argsort(-sizes, kind="stable")
    order = order[sizes[order] >= LEAST]
    if not len(order):
        return none

    def laid_out(which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The documents longest first, a symbol of its own before each and one at the end; and where each starts."""
        n, top = sizes[which], int(words.max()) + 1
        starts = np.cumsum(n + 1) - n
        out = np.empty(int(n.sum()) + len(n) + 1, np.int64)
        marks = np.append(starts - 1, len(out) - 1)
        out[marks] = top + np.arange(len(marks))
        rest = np.ones(len(out), bool)
        rest[marks] = False
        out[rest] = words[np.repeat(begins[which] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        return out, starts

    whole, starts = laid_out(order)
    at, period = candidates(whole, starts, sizes[order])
    inside = np.searchsorted(starts, at, "right") - 1
    fit = (inside >= 0) & (period * REPEATS <= sizes[order][np.maximum(inside, 0)])
    at, period, inside = at[fit], period[fit], inside[fit]
    if not len(at):
        return none
    used = np.unique(inside)
    small, moved = laid_out(order[used])
    number = np.searchsorted(used, inside)
    at = at - starts[inside] + moved[number]
    grammar = Grammar(small)
    found = []
    for k in range(0, len(at), TOGETHER):
        i, p = at[k : k + TOGETHER], period[k : k + TOGETHER]
        start = i + 1 - grammar.common(i, i + p, -1)
        found.append(np.stack([start, i + p + grammar.common(i, i + p, 1) - start]))
    start, length = np.concatenate(found, axis=1)
    real = length >= np.maximum(LEAST, REPEATS * period)
    doc, start, length, period = order[used][number][real], (start - moved[number])[real], length[real], period[real]
    by = np.lexsort((period, length, start, doc))
    doc, start, length, period = doc[by], start[by], length[by], period[by]
    if len(doc):  # one stretch has its smallest period first; the others are multiples of it
        new = np.append(True, (np.diff(doc) != 0) | (np.diff(start) != 0) | (np.diff(length) != 0))
        doc, start, length, period = doc[new], start[new], length[new], period[new]
    by = np.lexsort((period, start, doc))
    return doc[by], start[by], length[by], period[by]


def runs_of_words(docs: DataFrame, key: str = "doc_id", text: str = "text", arrange: Callable[[object, int], np.ndarray] | None = None) -> DataFrame:
    """key, n_words, runs (start, length and period, by start and period) and collapsed: the words without those that a run
    covers after its first period, joined by blanks.

    Words are what lies between ASCII blanks. `arrange(key, n)` may give the numbers of the words to take instead of a
    text's n words. A null or empty text has no words, no runs and an empty collapsed text. A null key is kept; repeated rows
    and keys each get a row. A text of any length is taken whole, in one task. An empty table gives no rows. Other columns are dropped, whatever
    their names.
    """
    docs, moved = unclash(docs, ("text",) if text.lower() != "text" and key.lower() != "text" else ())
    key_column, text_column = column_after(moved, key), column_after(moved, text)
    schema = T.StructType([T.StructField("own_key", docs.schema[key_column].dataType), *T._parse_datatype_string(f"n_words long, runs {RUNS}, collapsed string")])
    pairs = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches):
            cut = pc.ascii_split_whitespace(pa.array([t or "" for t in texts], pa.large_string()))
            full = np.asarray(pc.not_equal(cut.values, ""))
            ends = np.append(0, np.cumsum(full))[cut.offsets.to_numpy()]
            coded = cut.values.filter(pa.array(full)).dictionary_encode()
            words, sizes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.diff(ends)
            if arrange is not None:
                for i, (k, n) in enumerate(zip(batch.column(0).to_pylist(), sizes.tolist(), strict=True)):
                    if n and (take := arrange(k, n)) is not None:
                        words[ends[i] : ends[i] + n] = words[ends[i] + take]
            doc, start, length, period = find_runs(words, sizes)
            first = ends[:-1][doc] + start
            change = np.zeros(len(words) + 1, np.int64)
            np.add.at(change, first + period, 1)
            np.add.at(change, first + length, -1)
            kept = np.cumsum(change[:-1]) == 0
            left = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(kept))[ends].astype(np.int32)), coded.dictionary.take(pa.array(words[kept])))
            each = pa.array(np.searchsorted(doc, np.arange(len(texts) + 1)).astype(np.int32))
            found = pa.ListArray.from_arrays(each, pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], ["start", "length", "period"]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), found.cast(pairs), pc.binary_join(left, pa.scalar(" ", pa.large_string())).cast(pa.string())], schema.names)

    rows = docs.select(F.col(f"`{key_column}`").alias("own_key"), F.col(f"`{text_column}`").alias("text"))
    return rows.mapInArrow(run, schema).withColumnRenamed("own_key", key)
