"""Random Fourier features: cos(x W + b) whose inner products approximate the rbf kernel.

Directions and phases are functions of (seed, column, component), so a task
draws the rows of W that its batch needs and nothing is stored or shipped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

N_COMPONENTS = 128


def _uniform(seed: int, counter: np.ndarray) -> np.ndarray:
    """u in (0, 1) per counter: a 64-bit mix of seed and counter, its upper 53 bits."""
    with np.errstate(over="ignore"):
        z = counter.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed * 0x632BE5AB % (1 << 64))
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
    return ((z >> np.uint64(11)).astype(float) + 0.5) / 2.0**53


def directions(columns: np.ndarray, n_components: int, gamma: float, seed: int = 0) -> np.ndarray:
    """Rows of W for the given columns: N(0, 2 gamma), shape (len(columns), n_components)."""
    at = (np.asarray(columns, dtype=np.int64)[:, None] + 1) * (2 * n_components) + np.arange(n_components)
    radius = np.sqrt(-2.0 * np.log(_uniform(seed, at)))
    return math.sqrt(2.0 * gamma) * radius * np.cos(2 * math.pi * _uniform(seed, at + n_components))


def phases(n_components: int, seed: int = 0) -> np.ndarray:
    return 2 * math.pi * _uniform(seed, np.arange(n_components))


def fourier_array(indices: Column, values: Column, gamma: float, n_components: int, seed: int = 0) -> Column:
    """ARRAY<DOUBLE> sqrt(2/D) cos(x W + b) of sparse rows; NULL indices mean a dense row."""
    b, scale = phases(n_components, seed), math.sqrt(2.0 / n_components)

    @F.pandas_udf("array<double>")
    def mapped(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for idx, val in batches:
            out = []
            rows = [np.arange(len(v)) if i is None else np.asarray(i, dtype=np.int64) for i, v in zip(idx, val)]
            used = np.unique(np.concatenate([*rows, np.empty(0, np.int64)]))
            w = directions(used, n_components, gamma, seed)
            for i, v in zip(rows, val):
                out.append(scale * np.cos(np.asarray(v, dtype=float) @ w[np.searchsorted(used, i)] + b))
            yield pd.Series(out, index=idx.index, dtype=object)

    return mapped(indices, values)


class FourierMap(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Pipeline stage that maps a vector column to its random Fourier features; narrow."""

    gamma = Param(Params._dummy(), "gamma", "rbf kernel width", TypeConverters.toFloat)
    components = Param(Params._dummy(), "components", "number of features", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed of directions and phases", TypeConverters.toInt)

    def __init__(self, gamma: float = 1.0, components: int = N_COMPONENTS, seed: int = 0,
                 inputCol: str = "features", outputCol: str = "fourier"):
        super().__init__()
        self._set(gamma=gamma, components=components, seed=seed, inputCol=inputCol, outputCol=outputCol)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        v = F.unwrap_udt(F.col(self.getInputCol()))
        z = fourier_array(v["indices"], v["values"], self.getOrDefault(self.gamma),
                          self.getOrDefault(self.components), self.getOrDefault(self.seed))
        return dataset.withColumn(self.getOutputCol(), array_to_vector(z))
