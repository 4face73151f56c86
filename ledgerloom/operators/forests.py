"""Isolation forests (M11, D8) and random Fourier features for kernel machines (M8), which MLlib lacks."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, HasSeed, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F

from ..sources.folders import work_folder
from .aggregates import percentiles
from .dedup import row_hash

#: Trees, rows of each tree's sample: what the method's authors found to be enough at any size of table.
TREES, SAMPLE = 100, 256


def mean_path(n: int) -> float:
    """Mean length of an unsuccessful search among n values: what a leaf of n rows still hides."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


@dataclass(frozen=True)
class Forest:
    """Trees as arrays. Nodes of a tree lie level by level (children of i: 2i + 1, 2i + 2), all down to one depth; under a leaf
    every way leads to its length."""

    columns: list[str]
    fill: np.ndarray  # what stands for a null
    sample: int
    feature: np.ndarray
    threshold: np.ndarray
    length: np.ndarray

    def paths(self, x: np.ndarray) -> np.ndarray:
        """The mean path length of each row."""
        x = np.where(np.isnan(x), self.fill, x)
        rows, total = np.arange(len(x)), np.zeros(len(x))
        inner = self.feature.shape[1]
        for feature, threshold, length in zip(self.feature, self.threshold, self.length, strict=True):
            node = np.zeros(len(x), np.int64)
            while len(node) and node[0] < inner:  # all are at one level
                node = 2 * node + 1 + (x[rows, feature[node]] >= threshold[node])
            total += length[node - inner]
        return total / len(self.feature)


def grow(x: np.ndarray, depth: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A tree over a few rows: a random column and a random value between its ends, until rows are alone or alike."""
    inner = (1 << depth) - 1
    feature, threshold, length = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(inner + 1)

    def split(node: int, level: int, rows: np.ndarray) -> None:
        low, high = (x[rows].min(0), x[rows].max(0)) if len(rows) else (np.zeros(x.shape[1]),) * 2
        wide = np.flatnonzero(high > low)
        if level == depth or not len(wide):
            first = (node + 1 << depth - level) - 1 - inner
            length[first : first + (1 << depth - level)] = level + mean_path(len(rows))
            return
        f = int(rng.choice(wide))
        at = rng.uniform(low[f], high[f])
        at = at if at > low[f] else high[f]
        feature[node], threshold[node] = f, at
        left = x[rows, f] < at
        split(2 * node + 1, level + 1, rows[left])
        split(2 * node + 2, level + 1, rows[~left])

    split(0, 0, np.arange(len(x)))
    return feature, threshold, length


def fit_forest(df: DataFrame, cols: list[str], trees: int = TREES, sample: int = SAMPLE, seed: int = 42) -> Forest:
    """Trees on random rows: the trees * sample rows (25,600) with the least seeded hash of the whole row come to the driver, a
    bounded sample whatever the table's size, and are dealt to the trees. Rows that are alike in all columns come together, so
    the table needs its key among them."""
    n = df.count()
    wanted = trees * sample
    draw = F.pmod(F.xxhash64(row_hash(df), F.lit(seed)), F.lit(1 << 40))
    few = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(cols)], draw.alias("_draw"))
    if n > 2 * wanted:  # so that no partition sends more than its share
        few = few.filter(F.col("_draw") < int((1 << 40) * 1.5 * wanted / n))
    rows = np.array([[math.nan if v is None else v for v in r[:-1]] for r in few.orderBy("_draw", *few.columns[:-1]).limit(wanted).collect()], float).reshape(-1, len(cols))
    known = ~np.isnan(rows)
    fill = np.where(known.any(0), np.where(known, rows, 0).sum(0) / np.maximum(known.sum(0), 1), 0.0)
    rows = np.where(known, rows, fill)
    rng = np.random.Generator(np.random.PCG64(seed))
    rows = rows[rng.permutation(len(rows))]
    size = min(sample, len(rows))
    depth = max(1, math.ceil(math.log2(max(2, size))))
    grown = [grow(rows[rng.choice(len(rows), size, replace=False)] if len(rows) < wanted else rows[t * sample : (t + 1) * sample], depth, rng) for t in range(trees)]
    return Forest(list(cols), fill, size, *(np.stack([g[k] for g in grown]) for k in range(3)))


def isolation_scores(df: DataFrame, forest: Forest, score: str = "anomaly_score", path: str = "path_length") -> DataFrame:
    """df with each row's mean path length, and 2 to the minus that length over the mean of random rows: near 1 for a row that
    few cuts set apart, under 0.5 for one among many. Nulls stand for the sample's mean. All rows are scored, in batches of
    arrays: as an expression, a row would walk 800 nodes one by one."""
    shared = df.sparkSession.sparkContext.broadcast(forest)  # some hundred kB, of a size that trees and sample give

    @F.pandas_udf("double")
    def lengths(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in batches:
            columns = columns if isinstance(columns, tuple) else (columns,)  # one column comes alone
            yield pd.Series(shared.value.paths(np.column_stack([c.to_numpy(float, na_value=np.nan) for c in columns])))

    out = df.withColumn(path, lengths(*[F.col(f"`{c}`").cast("double") for c in forest.columns]))
    return out.withColumn(score, F.pow(F.lit(2.0), -F.col(path) / F.lit(mean_path(forest.sample) or 1.0)))


def flag_isolated(df: DataFrame, cols: list[str], share: float = 0.1, name: str = "is_anomaly", score: str = "anomaly_score", **settings) -> DataFrame:
    """Rows with their score, flagged where it is above the (1 - share) percentile of all."""
    isolation_scores(df, fit_forest(df, cols, **settings), score).write.parquet(path := work_folder(df.sparkSession, "scores"))
    out = df.sparkSession.read.parquet(path)  # rows are scored once, and read several times
    limit = percentiles(out, {"s": F.col(score)}, [1 - share]).agg(F.max(F.col("q")[0]).alias("_limit"))  # one row
    return out.crossJoin(F.broadcast(limit)).withColumn(name, F.col(score) > F.col("_limit")).drop("_limit")


class FourierFeatures(Transformer, HasInputCol, HasOutputCol, HasSeed, DefaultParamsReadable, DefaultParamsWritable):
    """Random Fourier features: a linear machine on them is one with the kernel exp(-gamma |x - y|^2), the nearer the more
    features there are."""

    width = Param(Params._dummy(), "width", "numbers of the input", TypeConverters.toInt)
    features = Param(Params._dummy(), "features", "cosines", TypeConverters.toInt)
    gamma = Param(Params._dummy(), "gamma", "of the kernel", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCol: str | None = None, outputCol: str | None = None, width: int = 1, features: int = 200, gamma: float = 1.0, seed: int = 42):
        super().__init__()
        self._setDefault(width=1, features=200, gamma=1.0, seed=42)
        self._set(**self._input_kwargs)

    def weights(self) -> tuple[np.ndarray, np.ndarray]:
        rng = np.random.Generator(np.random.PCG64(self.getOrDefault("seed")))
        shape = (self.getOrDefault("features"), self.getOrDefault("width"))
        return rng.normal(0.0, math.sqrt(2 * self.getOrDefault("gamma")), shape), rng.uniform(0.0, 2 * math.pi, shape[0])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        w, b = self.weights()
        scale = math.sqrt(2.0 / len(b))

        @F.arrow_udf("array<double>")
        def cosines(x: pa.Array) -> pa.Array:
            out = scale * np.cos(x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), w.shape[1]) @ w.T + b)
            return pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * len(b), out.ravel())

        return dataset.withColumn(self.getOutputCol(), array_to_vector(cosines(vector_to_array(F.col(self.getInputCol())))))
