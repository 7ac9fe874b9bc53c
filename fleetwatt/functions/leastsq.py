"""Least squares for many groups from shuffled sufficient statistics.

Rows never gather by group: each task sums X'X, X'y and y'y of the rows it
already holds, the partial sums are added in two salted steps, and only one
(k+2)-square matrix per group reaches a solver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Salts per group, and groups a task holds before it emits them.
SALTS = 64
FLUSH_AT = 1000

Design = Callable[[pd.DataFrame], Iterable[tuple[tuple, np.ndarray, np.ndarray]]]


def stack_arrays(column: pd.Series) -> np.ndarray:
    """A column of equally long arrays as a matrix; a null entry becomes NaN."""
    return np.stack([np.asarray(a, dtype=float) for a in column])


def moments(df: DataFrame, key: T.StructType, design: Design) -> DataFrame:
    """``key, moment``: the flattened matrix [X y]'[X y] with the row count in its last corner.

    ``design`` turns a batch of rows into ``(key values, X, y)`` parts.
    """
    keys = key.names
    moment = T.StructField("moment", T.ArrayType(T.DoubleType()))
    schema = T.StructType([*key.fields, moment])
    salted = T.StructType([*key.fields, T.StructField("_salt", T.LongType()), moment])

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, np.ndarray] = {}

        def flush() -> pd.DataFrame:
            out = pd.DataFrame([(*k, m.ravel()) for k, m in held.items()], columns=schema.names)
            held.clear()
            return out

        for pdf in batches:
            for name, x, y in design(pdf):
                z = np.column_stack([x, y])
                m = np.zeros((z.shape[1] + 1, z.shape[1] + 1))
                m[:-1, :-1] = z.T @ z
                m[-1, -1] = len(z)
                held[name] = held[name] + m if name in held else m
            if len(held) >= FLUSH_AT:
                yield flush()
        if held:
            yield flush()

    def added(names: list[str]) -> Callable[[tuple, pd.DataFrame], pd.DataFrame]:
        def run(name: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame([(*name, np.sum(np.stack(pdf["moment"].to_list()), axis=0))], columns=names)

        return run

    parts = df.mapInPandas(partial, schema).withColumn("_salt", F.spark_partition_id().cast("long") % SALTS)
    return (
        parts.groupBy(*keys, "_salt")
        .applyInPandas(added(salted.names), salted)
        .groupBy(*keys)
        .applyInPandas(added(schema.names), schema)
    )


def unpack(moment: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, int]:
    """X'X, X'y, y'y and the row count."""
    size = int(round(np.sqrt(len(moment))))
    m = np.asarray(moment, float).reshape(size, size)
    return m[:-2, :-2], m[:-2, -2], float(m[-2, -2]), int(round(m[-1, -1]))


def solve(xtx: np.ndarray, xty: np.ndarray) -> np.ndarray:
    scale = np.sqrt(np.clip(np.diag(xtx), 1e-300, None))
    return np.linalg.lstsq(xtx / np.outer(scale, scale), xty / scale, rcond=1e-12)[0] / scale
