"""Removal of repeated strings against brute force: odd texts, ties, repeated rows, periodic texts, small runs and ranges."""

import collections
import random

import numpy as np
import pytest

from ledgerloom.llm import queries, suffixes


def brute(rows, n=50):
    """Every string of every document, and the least document that has it."""
    first, out = {}, []
    for k, t in rows:
        raw = (t or "").encode()
        if k is not None:
            for i in range(len(raw) - n + 1):
                w = raw[i : i + n]
                first[w] = min(first.get(w, k), k)
    for k, t in rows:
        raw = (t or "").encode()
        gone = [False] * len(raw)
        if k is not None:
            for i in range(len(raw) - n + 1):
                if first[raw[i : i + n]] < k:
                    gone[i : i + n] = [True] * n
        spans = [i for i, g in enumerate(gone) if g != (gone[i - 1] if i else False)] + ([len(raw)] if gone and gone[-1] else [])
        out.append((k, len(raw), sum(gone), len(spans) // 2, bytes(x for x, g in zip(raw, gone, strict=True) if not g), tuple(spans)))
    return out


def collected(df):
    return collections.Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept), tuple(np.frombuffer(bytes(r.spans), "<u8").tolist())) for r in df.collect())


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(12)
    word = lambda: "".join(rnd.choice("abcdefghé") for _ in range(rnd.randint(1, 7)))
    vocab = [word() for _ in range(300)]
    text = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    out = [(i * 2, text(rnd.randint(1, 120))) for i in range(120)]
    passage = text(20)
    for i in range(60):  # one passage in many documents, and pieces of two others put together
        a, b = rnd.choice(out)[1], rnd.choice(out)[1]
        x, y = rnd.randrange(len(a) + 1), rnd.randrange(len(b) + 1)
        out.append((rnd.randrange(-50, 400), a[x : x + rnd.randrange(30, 120)] + rnd.choice(["#", passage, ""]) + b[y : y + rnd.randrange(30, 120)]))
    for i in range(40):  # one anchor with many unlike surroundings
        out.append((1000 + i, text(3) + passage[:26] + text(6)))
    out += [(None, out[3][1]), (None, None), (500, None), (501, ""), (502, "a" * 3000), (503, "a" * 200), (504, "ab" * 1000), (499, "ab" * 400 + "a" * 60), out[7], out[7], (-4, "\x00" * 70), (-3, "\x00" * 55), (-6, "b" * 49), (-7, "b" * 50), (-8, "b" * 51)]
    return out + [(900, text(9000)), (7, out[5][1])]


@pytest.mark.parametrize("settings", [{}, {"run_bytes": 20_000, "range_bytes": 600}, {"run_bytes": 6_000, "range_bytes": 2_000, "large": 3}])
def test_repeats_go(spark, rows, settings):
    df = spark.createDataFrame([(k, t, k, t, "x") for k, t in rows], "doc_id long, text string, doc long, kept string, RUN string").repartition(5)
    assert collected(suffixes.remove_repeats(df, **settings)) == collections.Counter(brute(rows))


def test_tables_without_repeats(spark):
    df = spark.createDataFrame([(1, None), (2, "short"), (3, "ß" * 25), (None, "x" * 90)], "doc_id int, text string")
    assert collected(suffixes.remove_repeats(df)) == collections.Counter(brute([tuple(r) for r in df.collect()]))
    assert suffixes.remove_repeats(df.limit(0)).count() == 0
    one = spark.createDataFrame([(5, "x" * 90)], "number long, body string")
    assert [(r.n_removed, r.n_spans) for r in suffixes.remove_repeats(one, "number", "body").collect()] == [(0, 0)]


def test_query_on_all_documents(spark):
    import hashlib

    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    want = collections.Counter((k, n, gone, spans, hashlib.sha256(kept).hexdigest()) for k, n, gone, spans, kept, _ in brute(rows))
    assert collections.Counter(tuple(r) for r in queries.op12_suffix_dedup(spark, "/root/testdata/sf0.001").collect()) == want


def test_loser_tree():
    rnd = random.Random(4)
    width = suffixes.WIDTH
    for k in (1, 2, 3, 5, 8, 13):
        runs, want = [], []
        for _ in range(k):
            own = sorted({bytes(rnd.choice(b"ab") for _ in range(6)) + bytes(width - 6) for _ in range(rnd.randint(1, 40))})
            rows = np.frombuffer(b"".join(own), np.uint8).reshape(-1, width)
            shared, rests = suffixes.front_coded(rows, suffixes.shared_prefixes(rows))
            assert list(suffixes.suffixes_of(shared.tolist(), rests.tobytes())) == own
            runs.append((shared.tolist(), suffixes.suffixes_of(shared.tolist(), rests.tobytes())))
            want += own
        out = list(suffixes.merged(runs))
        assert [x[3] for x in out] == sorted(want)
        for (_, _, _, a), (h, _, _, b) in zip(out, out[1:], strict=False):
            assert h == next((i for i in range(width) if a[i] != b[i]), width)
