"""Periodic runs and importance resampling against brute force, on odd tables."""

import collections
import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from ledgerloom.llm import periodic_runs, queries, resampling

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_runs(words):
    """Every period, every stretch; of one stretch the smallest period."""
    n, best = len(words), {}
    for p in range(1, n // 4 + 1):
        i = 0
        while i + p < n:
            start = i
            while i + p < n and words[i] == words[i + p]:
                i += 1
            if i + p - start >= max(6, 4 * p):
                best.setdefault((start, i + p - start), p)
            i += 1
    return sorted((s, length, p) for (s, length), p in best.items())


def brute_digest(doc_id, text):
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    gone = {i for s, length, p in runs for i in range(s + p, s + length)}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    best = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
    return (doc_id, len(runs), *best, sha("".join(f"{s},{length},{p}\n" for s, length, p in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_runs_of_small_alphabets():
    rnd = random.Random(2)
    for _ in range(150):
        docs = []
        for _ in range(rnd.randint(1, 12)):
            k, d = rnd.randint(1, 4), []
            for _ in range(rnd.randint(0, 6)):
                unit = [rnd.randint(0, k) for _ in range(rnd.randint(1, 7))]
                d += unit * rnd.randint(1, 7) + unit[: rnd.randint(0, len(unit))] if rnd.random() < 0.6 else unit
            docs.append(d)
        words, sizes = np.array([x for d in docs for x in d], np.int64), np.array([len(d) for d in docs])
        got = list(zip(*(x.tolist() for x in periodic_runs.find_runs(words, sizes)), strict=True))
        assert got == sorted(((i, *r) for i, d in enumerate(docs) for r in brute_runs(d)), key=lambda r: (r[0], r[1], r[3]))


def test_grammar_extensions():
    rnd = random.Random(8)
    base = [rnd.randint(0, 2) for _ in range(60)]
    seq = np.array([90, *(base * 3 + [1] * 40 + base[:50] + [0, 1] * 30 + base), 91])
    grammar = periodic_runs.Grammar(seq)
    pairs = [tuple(sorted(rnd.sample(range(1, len(seq) - 1), 2))) for _ in range(500)]
    left, right = (np.array([p[k] for p in pairs]) for k in (0, 1))

    def naive(i, j, step):
        n = 0
        while seq[i] == seq[j]:
            i, j, n = i + step, j + step, n + 1
        return n

    for step in (1, -1):
        assert grammar.common(left, right, step).tolist() == [naive(i, j, step) for i, j in pairs]


def odd_documents(spark):
    rnd = random.Random(9)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").limit(80).collect()]
    rows += [(i, " ".join(["la", "li"][: 1 + i % 2] * 20) + "\n" + " ".join(rnd.choice("ab") for _ in range(60))) for i in range(1000, 1040)]
    rows += [(None, "x y " * 9), (None, None), (2000, None), (2001, ""), (2002, "  \n"), (2003, "w " * 3000), (2004, "a b\tc " * 700 + "a\x1cb"), rows[3], rows[3], (2005, "one two"), (2006, "é\x0bé é\fé é é"), (2007, None)]
    return rows


def test_runs_query(spark, tmp_path):
    rows = odd_documents(spark)
    spark.createDataFrame([(*r, 1, "x", None) for r in rows], "doc_id long, text string, n_words int, runs string, own_key string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    out = queries.op11_periodic_runs(spark, str(tmp_path))
    assert collections.Counter(map(tuple, out.collect())) == collections.Counter(brute_digest(*r) for r in rows)
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    found = periodic_runs.runs_of_words(spark.createDataFrame([("k", "a b a b a b a b c")], "text string, runs string"), "text", "runs").first()
    assert found.text == "k" and [tuple(r) for r in found.runs] == [(0, 8, 2)] and found.collapsed == "a b c"
    assert periodic_runs.runs_of_words(spark.createDataFrame([], "doc_id int, text string")).count() == 0


def brute_resample(rows, target, low=1, high=1, buckets=10_000, percent=10, least=20, seed=2024):
    def grams(text):
        words = TOKEN.findall((text or "").translate(LOWER))
        return len(words), [zlib.crc32(" ".join(words[i : i + n]).encode()) % buckets for n in range(low, high + 1) for i in range(len(words) - n + 1)]

    own = [grams(t) for _, t in rows]
    s, t = collections.Counter(x for _, g in own for x in g), collections.Counter(x for text in target for x in grams(text)[1])
    big, small = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big + buckets) / ((s[b] + 1) * (small + buckets)))) for b in range(buckets)]
    out = []
    for (k, _), (n, g) in zip(rows, own, strict=True):
        weight = sum(gain[x] for x in g) // len(g) if g else 0
        h = int(hashlib.sha256(f"{seed}:{'' if k is None else k}".encode()).hexdigest()[:8], 16)
        out.append([k, len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n])
    fit = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    ranks = collections.defaultdict(list)
    for i, r in enumerate(fit):
        ranks[tuple(r[:4])].append(i + 1 if i < len(fit) * percent // 100 else None)
    return collections.Counter((*r[:4], ranks[tuple(r[:4])].pop() if r[4] >= least else None) for r in out)


@pytest.mark.parametrize("settings", [{}, {"low": 1, "high": 3, "buckets": 500, "percent": 50}, {"low": 2, "high": 2, "buckets": 100_000, "least": 1, "percent": 100}])
def test_resampling(spark, settings):
    rows = odd_documents(spark) + [(7, "Some, text -- of\x00 words" * 9)] * 3
    target = ["la li la", "words of a text", None, ""]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, weight int, part string").repartition(5)
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    own = dict(settings)
    words = (own.pop("low", 1), own.pop("high", 1))
    out = resampling.resample(docs, aim, words=words, **own)
    assert collections.Counter(map(tuple, out.collect())) == brute_resample(rows, target, **settings)


def test_resampling_odd_tables(spark):
    docs = spark.createDataFrame([(1, "a " * 30), (2, "b " * 30)], "doc_id long, text string")
    none = docs.select("text").limit(0)
    assert resampling.resample(docs.limit(0), docs.select("text")).count() == 0
    assert collections.Counter(map(tuple, resampling.resample(docs, none, percent=50).collect())) == brute_resample([(1, "a " * 30), (2, "b " * 30)], [], percent=50)
    with pytest.raises(ValueError):
        resampling.resample(docs, none, buckets=0)


def test_resampling_sql(spark):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    want = con.execute(queries.ORACLES["op13_resampling"]).to_arrow_table().select(["doc_id", "n_features", "weight", "score", "rank"]).to_pylist()
    got = [r.asDict() for r in queries.op13_resampling(spark, SF).collect()]
    key = lambda r: r["doc_id"]
    assert sorted(got, key=key) == sorted(want, key=key)
