"""Tables in versions: touched parts, splits, merges that die or come second, and versions that are gone."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import joins
from ledgerloom.sources import versions


def rows(spark, pairs):
    return spark.createDataFrame(pairs, "id long, v string")


def content(spark, path, number=None):
    return {r.id: r.v for r in versions.read_version(spark, path, number).collect()}


def test_parts_grow_and_only_touched_ones_change(spark, tmp_path):
    path = str(tmp_path)
    first = joins.upsert_table(rows(spark, [(i, "a") for i in range(300)]), path, "id", part_rows=50)
    assert len(first.parts) >= 6 and sum(n for _, n in first.parts.values()) == 300 and max(n for _, n in first.parts.values()) < 110
    second = joins.upsert_table(rows(spark, [(7, "b"), (1000, "b"), (None, "lost")]), path, "id", part_rows=50)
    changed = {k for k, v in second.parts.items() if first.parts.get(k) != v}
    assert 1 <= len(changed) <= 2 and content(spark, path) == {**{i: "a" for i in range(300)}, 7: "b", 1000: "b"}
    assert content(spark, path, first.number) == {i: "a" for i in range(300)}
    third = joins.upsert_table(rows(spark, [(i, "c") for i in range(0, 3000, 3)]), path, "id", part_rows=50)
    assert len(third.parts) > len(first.parts) and content(spark, path) == {**{i: "a" for i in range(300)}, 7: "b", 1000: "b", **{i: "c" for i in range(0, 3000, 3)}}
    with pytest.raises(ValueError, match="no version 0"):
        content(spark, path, 0)
    named = {f"{f}/part={k}" for n in versions.Log(spark, path).numbers() for k, (f, _) in versions.Log(spark, path).read(n).parts.items() if f}
    assert {f"{p.parent.name}/{p.name}" for p in (tmp_path / "data").glob("*/part=*")} == named


def test_batches_are_known(spark, tmp_path):
    path = str(tmp_path)
    joins.upsert_table_coalesce(rows(spark, [(1, "a")]), path, "id", source="s", batch=4)
    for batch in (3, 4):
        assert joins.upsert_table_coalesce(rows(spark, [(1, "z")]), path, "id", source="s", batch=batch).number == 0
    joins.upsert_table_coalesce(rows(spark, [(1, None), (2, "y")]), path, "id", source="t", batch=0)
    assert joins.upsert_table_coalesce(rows(spark, []), path, "id", source="s", batch=5).batches == {"s": 5, "t": 0}
    assert content(spark, path) == {1: "a", 2: "y"}


def test_a_merge_that_dies(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    joins.upsert_table(rows(spark, [(1, "a"), (2, "a")]), path, "id")

    def die(self, version):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(versions.Log, "publish", die)
        with pytest.raises(RuntimeError, match="killed"):
            joins.upsert_table(rows(spark, [(1, "b")]), path, "id")
    assert content(spark, path) == {1: "a", 2: "a"}
    joins.upsert_table(rows(spark, [(2, "c")]), path, "id")
    assert content(spark, path) == {1: "a", 2: "c"}


def test_another_writer_comes_first(spark, tmp_path, monkeypatch):
    path, publish = str(tmp_path), versions.Log.publish
    joins.upsert_table(rows(spark, [(1, "a")]), path, "id")
    others = [[(1, "other")], [(2, "other")]]

    def late(self, version):
        if others and version.batches.get("mine") == 0:
            joins.upsert_table(rows(spark, others.pop()), path, "id")
        return publish(self, version)

    monkeypatch.setattr(versions.Log, "publish", late)
    assert joins.upsert_table(rows(spark, [(3, "mine")]), path, "id", source="mine").number == 3
    assert content(spark, path) == {1: "other", 2: "other", 3: "mine"}
    with pytest.raises(ValueError, match="key"):
        joins.upsert_table(rows(spark, [(3, "x")]), path, "v")


def test_a_version_is_whole(spark, tmp_path):
    log = versions.Log(spark, str(tmp_path))
    assert log.numbers() == [] and log.read() is None
    one = versions.Version(0, "{}", "id")
    assert log.publish(one) and not log.publish(one) and log.numbers() == [0] and log.read() == one
    with pytest.raises(ValueError):
        versions.read_version(spark, str(tmp_path / "none"))
    names = versions.deeper("1-1", 900, 200)
    assert names == ["4-1", "4-3", "4-5", "4-7", "4-9", "4-11", "4-13", "4-15"]
    put = versions.placed(spark, spark.range(500), "id", ["1-0", *names]).withColumn("h", F.xxhash64("id")).collect()
    assert len(put) == 500 and all(r.h & ((1 << int(r._part.split("-")[0])) - 1) == int(r._part.split("-")[1]) for r in put)
