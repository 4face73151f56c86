"""Near copies against brute force over the shingles themselves."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import near_copies, simhash


def five_word_sets(text):
    own = (text or "").encode().lower().split()
    return frozenset(tuple(own[i : i + 5]) for i in range(max(1, len(own) - 4))) if own else frozenset()


def brute(rows):
    """Least key of each row's group: linked are equal sets and sets with Jaccard 0.8 or more."""
    sets = [five_word_sets(t) for _, t in rows]
    label = list(range(len(rows)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both, either = len(sets[i] & sets[j]), len(sets[i] | sets[j])
            if sets[i] == sets[j] or 5 * both >= 4 * either > 0:
                label[top(i)] = top(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(top(i), []).append(i)
    return groups


def edited(words, n, dice):
    own = list(words)
    for i in dice.sample(range(len(own)), n):
        own[i] = f"x{dice.random()}"
    return own


def fixture():
    """Texts of 40 to 900 words, each with copies around the least similarity, and a chain of them."""
    dice, rows = random.Random(5), []
    for k in range(60):
        words = [f"w{dice.randrange(3000)}" for _ in range(dice.choice((40, 90, 200, 900)))]
        rows.append(" ".join(words))
        for share in (0.004, 0.012, 0.02, 0.03, 0.05):
            rows.append(" ".join(edited(words, max(1, int(len(words) * share)), dice)))
    words = [f"c{i}" for i in range(300)]
    for _ in range(12):
        rows.append(" ".join(words))
        words = edited(words, 3, dice)
    rows += ["", None, " \t", "one two", "ONE  two", "a b c d e", "a b c d e f"]
    return list(enumerate(rows, 100))


def test_groups_are_those_of_jaccard(spark):
    rows = fixture()
    want = sorted(min(rows[i][0] for i in g) for g in brute(rows).values())
    assert len(want) < len(rows) - 100
    got = near_copies.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got.columns == ["doc_id", "text"] and sorted(r.doc_id for r in got.collect()) == want


def test_blocks_and_tiles_give_the_same(spark, monkeypatch):
    rows = fixture()
    want = sorted(min(rows[i][0] for i in g) for g in brute(rows).values())
    monkeypatch.setattr(near_copies, "BLOCK", 3)
    monkeypatch.setattr(near_copies.candidate_links, "__defaults__", (8,))
    monkeypatch.setattr(near_copies, "BANDS", 3)
    monkeypatch.setattr(near_copies, "BROADCAST_MEMBERS", 0)
    monkeypatch.setattr(simhash, "BROADCAST_ROWS", 0)
    assert sorted(r.doc_id for r in near_copies.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()) == want


def test_stage_follows_the_general_rule(spark):
    import corpus_pipeline

    rows = fixture()
    want = sorted(min(rows[i][0] for i in g) for g in brute(rows).values())
    got = corpus_pipeline.near_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert sorted(r.doc_id for r in got.collect()) == want


def test_empty_table_and_rows_without_key(spark):
    assert near_copies.keep_one(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    text = " ".join(f"w{i}" for i in range(100))
    rows = [(None, text), (None, text + " end"), (None, "other"), (3, "third")]
    got = near_copies.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 3 and {r.doc_id for r in got} == {None, 3}


@pytest.mark.parametrize("limit", [0, 500_000])
def test_repeated_rows_and_keys(spark, monkeypatch, limit):
    monkeypatch.setattr(simhash, "BROADCAST_ROWS", limit)
    texts = [" ".join(f"w{k}x{i}" for i in range(60)) for k in range(4)]
    rows = [(1, texts[0])] * 3 + [(1, texts[1]), (None, texts[1] + " end"), (None, texts[2])] + [(None, texts[2] + " end")] * 2 + [(4, None), (4, None), (5, None), (6, texts[3])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"_hash": F.lit(1), "_stays": F.lit("x")})
    got = sorted(((r.doc_id, r.text) for r in near_copies.keep_one(df).collect()), key=str)
    lone = [x for x in got if x[0] is None]
    assert len(lone) == 1 and lone[0][1].startswith(texts[2])
    assert sorted((x for x in got if x[0] is not None), key=str) == sorted([(1, texts[0]), (1, texts[1]), (4, None), (6, texts[3])], key=str)


def test_near_copies_of_short_and_long_texts_are_found(spark):
    """Pairs of 9 to 400 words at a similarity of 0.8 or more: the radii of the sketches lose none of a thousand."""
    dice, rows, want = random.Random(31), [], 0
    while want < 1000:
        words = [f"v{dice.randrange(10**6)}" for _ in range(dice.choice((9, 12, 20, 29, 60, 150, 400)))]
        other = [*words, *(f"e{dice.random()}" for _ in range(dice.randint(1, max(1, len(words) // 30))))] if len(words) < 30 or dice.random() < 0.3 else edited(words, dice.randint(1, max(1, len(words) // 50)), dice)
        a, b = five_word_sets(" ".join(words)), five_word_sets(" ".join(other))
        if 5 * len(a & b) >= 4 * len(a | b):
            rows += [(2 * want, " ".join(words)), (2 * want + 1, " ".join(other))]
            want += 1
    got = {r.doc_id for r in near_copies.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert not any(k % 2 for k in got) and len(got) == want
