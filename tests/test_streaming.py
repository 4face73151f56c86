"""Streams drained over files give what the batch gives."""

from pyspark.sql import functions as F

from ledgerloom.queries import base, modelling
from ledgerloom.queries.scores import RULES
from ledgerloom.streaming import streams

SF = "/root/testdata/sf0.001"


def drain(stream, name, mode="append"):
    stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.table(name)


def test_repeats_go_within_the_bound(spark, tmp_path):
    rows = [(1, "2024-01-01 00:00:00"), (1, "2024-01-01 01:00:00"), (2, "2024-01-01 02:00:00")]
    spark.createDataFrame(rows, "event_id int, ts string").withColumn("ts", F.to_timestamp("ts")).write.parquet(str(tmp_path / "e"))
    stream = streams.event_stream(spark, str(tmp_path / "e"), "event_id int, ts timestamp")
    assert sorted(r.event_id for r in drain(stream, "t_events").collect()) == [1, 2]


def test_scores_agree(spark, tmp_path):
    leads = base.leads(spark, SF)
    leads.repartition(3).write.parquet(str(tmp_path / "l"))
    stream = spark.readStream.schema(leads.schema).parquet(str(tmp_path / "l"))
    got = drain(streams.score_stream(stream, RULES, base.AS_OF).select("id", "score"), "t_scores")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, modelling.score_stream(spark, SF).collect()))


def test_windows_agree(spark, tmp_path):
    e = spark.read.parquet(f"{SF}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    e.coalesce(1).write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema(e.schema).parquet(str(tmp_path / "e"))
    got = drain(streams.windowed_metrics(stream, "value", "event_type", "ts", "1 day", "1 day"), "t_windows", "complete")
    want = streams.windowed_metrics(e, "value", "event_type", "ts", "1 day")
    key = lambda df: sorted((r.pipeline, r.start, r.n) for r in df.collect())
    assert key(got) == key(want)


def test_monitor_flags_windows(spark, tmp_path):
    e = spark.read.parquet(f"{SF}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    e.coalesce(1).write.parquet(str(tmp_path / "e"))
    baseline = spark.createDataFrame([("view", 0.0, 0.01)], "pipeline string, mean double, std double")
    stream = spark.readStream.schema(e.schema).parquet(str(tmp_path / "e"))
    got = drain(streams.monitor_stream(stream, baseline, "value", "event_type", "ts", "1 day", "1 hour"), "t_monitor")
    assert got.count() > 0 and {r.severity for r in got.collect()} == {"critical"}


def test_latest_over_batches(spark, tmp_path):
    rows = [(1, "a", "2024-01-01"), (1, "b", "2024-03-01"), (2, "c", "2024-01-01"), (1, "d", "2024-02-01")]
    for i, r in enumerate(rows):
        spark.createDataFrame([r], "cpf int, v string, data string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("cpf int, v string, data string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    streams.latest_stream(stream, "cpf", "data", ["v"], str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    assert sorted((r.cpf, r.v) for r in streams.latest_table(spark, str(tmp_path / "out")).collect()) == [(1, "b"), (2, "c")]
    assert len(list((tmp_path / "out/log").glob("*.json"))) == 2 and len(list((tmp_path / "out/data").glob("*/part=*"))) <= 2


def write_in(spark, rows, path):
    spark.createDataFrame(rows, "cpf int, v string, data string").coalesce(1).write.mode("append").parquet(str(path))


def run_latest(spark, tmp_path, checkpoint, source="in"):
    stream = spark.readStream.schema("cpf int, v string, data string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / source))
    streams.latest_stream(stream, "cpf", "data", ["v"], str(tmp_path / "out"), str(tmp_path / checkpoint), part_rows=2).awaitTermination()
    return {r.cpf: r.v for r in streams.latest_table(spark, str(tmp_path / "out")).collect()}


def test_a_new_checkpoint_continues_the_table(spark, tmp_path):
    write_in(spark, [(i, "old", "2024-01-01") for i in range(9)], tmp_path / "in")
    assert run_latest(spark, tmp_path, "one") == dict.fromkeys(range(9), "old")
    write_in(spark, [(1, "new", "2024-02-01"), (2, "older", "2023-02-01"), (50, "only", "2024-02-01")], tmp_path / "in2")
    want = {**dict.fromkeys(range(9), "old"), 1: "new", 50: "only"}
    assert run_latest(spark, tmp_path, "two", "in2") == want
    assert run_latest(spark, tmp_path, "one") == want and run_latest(spark, tmp_path, "three", "in2") == want


def test_a_batch_that_is_run_again(spark, tmp_path):
    import shutil

    for i in range(3):
        write_in(spark, [(1, f"v{i}", f"2024-01-0{i + 1}"), (i + 10, "x", "2024-01-01")], tmp_path / "in")
    want = run_latest(spark, tmp_path, "check")
    last = max((tmp_path / "check/commits").glob("[0-9]*"), key=lambda p: int(p.name))
    last.unlink()  # as if the stream had died after the merge and before its commit
    (tmp_path / "check/commits" / f".{last.name}.crc").unlink(missing_ok=True)
    before = sorted(p.name for p in (tmp_path / "out/log").glob("*.json"))
    assert run_latest(spark, tmp_path, "check") == want and sorted(p.name for p in (tmp_path / "out/log").glob("*.json")) == before
    shutil.rmtree(tmp_path / "check")
    assert run_latest(spark, tmp_path, "check") == want


def test_retention_of_a_slot():
    """Batches of one slot, without a stream: what is kept, late, repeated and expired."""
    import pandas as pd

    from ledgerloom.streaming.retention import Retention

    class State:
        value = None
        exists = lambda self: self.value is not None
        get = lambda self: self.value

        def update(self, value):
            self.value = value

    slot = Retention(100)
    slot.state = State()

    def batch(*chunks):
        frames = [pd.DataFrame(c, columns=["event_id", "us"]) for c in chunks]
        return [(r.kind, r.event_id, r.ts.value // 1000) for out in slot.handleInputRows((0,), iter(frames), None) for r in out.itertuples()]

    assert batch([(1, 1000), (2, 1010), (1, 1000)], [(2, 1010), (3, 500)]) == [("kept", 1, 1000), ("kept", 2, 1010), ("kept", 3, 500), ("expired", 3, 500)]
    assert batch([(3, 500), (4, 909), (5, 910), (1, 1000)]) == [("late", 3, 500), ("late", 4, 909), ("kept", 5, 910)]
    assert batch([(6, 1105)]) == [("kept", 6, 1105), ("expired", 1, 1000), ("expired", 5, 910)]
    assert batch([(2, 1010), (1, 1000), (7, 1005)]) == [("late", 1, 1000), ("kept", 7, 1005)]
