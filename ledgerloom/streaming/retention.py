"""Events kept for a time, with what repeats, comes late or expires (X1, X2): arbitrary state, in RocksDB."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
OUT = "kind string, event_id long, ts timestamp"


@contextlib.contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Streams that are started inside keep their state in RocksDB: on local disk and in the checkpoint, not in memory."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)


class Retention(StatefulProcessor):
    """One slot of events. Its state is what is alive: ids and times as sorted arrays, and the newest time so far. It is read and
    written once a batch."""

    def __init__(self, keep_us: int):
        self.keep_us = keep_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("alive", "ids binary, times binary, newest long")

    def close(self) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        ids, times, newest, bound = np.zeros(0, np.int64), np.zeros(0, np.int64), None, None
        if self.state.exists():
            own = self.state.get()
            ids, times, newest = np.frombuffer(own[0], np.int64), np.frombuffer(own[1], np.int64), own[2]
            bound = newest - self.keep_us
        for pdf in rows:
            event, at = pdf["event_id"].to_numpy(np.int64), pdf["us"].to_numpy(np.int64)
            late = at < bound if bound is not None else np.zeros(len(at), bool)
            on_time, on_time_at = event[~late], at[~late]
            fresh = ~np.isin(on_time, ids)
            first = np.unique(on_time[fresh], return_index=True)[1]
            new, new_at = on_time[fresh][first], on_time_at[fresh][first]
            ids, times = np.concatenate([ids, new]), np.concatenate([times, new_at])
            newest = max([x for x in (newest, at.max(initial=np.iinfo(np.int64).min)) if x is not None])
            yield self.said("late", event[late], at[late])
            yield self.said("kept", new, new_at)
        gone = times < newest - self.keep_us
        yield self.said("expired", ids[gone], times[gone])
        self.state.update((ids[~gone].tobytes(), times[~gone].tobytes(), int(newest)))

    @staticmethod
    def said(kind: str, ids: np.ndarray, at: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({"kind": np.repeat(kind, len(ids)), "event_id": ids, "ts": pd.to_datetime(at, unit="us")})


def retained(events: DataFrame, key: str, timestamp: str, slot: Column, keep: str = "24 hours") -> DataFrame:
    """A stream of (kind, event_id, ts): kept, once a key, when it first comes; late, of rows older than `keep` before the newest
    row of earlier batches in their slot; expired, when a kept row gets so old. Repeats of what is alive go.

    `slot` deals keys evenly (a hash of the key, say), so no slot is hot; late and expired are judged slot by slot. State is
    bounded by the rows of `keep`. Rows with a null key or time go. Start it inside `rocksdb()`.
    """
    span = pd.Timedelta(keep) // pd.Timedelta("1us")
    rows = events.select(F.col(key).cast("long").alias("event_id"), F.unix_micros(F.col(timestamp).cast("timestamp")).alias("us"), slot.alias("slot")).filter("event_id is not null and us is not null")
    return rows.groupBy("slot").transformWithStateInPandas(Retention(int(span)), outputStructType=OUT, outputMode="Append", timeMode="None")
