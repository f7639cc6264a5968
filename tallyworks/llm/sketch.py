"""Sketches of fixed size filled by all tasks and merged by Spark: bucket counts and a Bloom filter."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Cells of a sketch that travel as one row; groups that the tasks' sketches are merged in first.
PIECE, GROUPS = 1 << 16, 64
SCHEMA = "piece int, cells binary"


def pieces(cells: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """The parts of a task's sketch that are not empty."""
    for i in range(0, len(cells), PIECE):
        if cells[i:i + PIECE].any():
            yield i // PIECE, cells[i:i + PIECE].tobytes()


def gathered(rows: DataFrame, into: np.dtype, add: Callable[[np.ndarray, np.ndarray], np.ndarray], held: np.dtype) -> DataFrame:
    """One row a piece, cells of type `into`: first merged by piece and task number modulo GROUPS, then by piece.

    A group has one array of every GROUPS-th task, and then at most GROUPS arrays.
    """
    def put(kind: np.dtype) -> Callable[[pd.DataFrame], pd.DataFrame]:
        def work(pdf: pd.DataFrame) -> pd.DataFrame:
            out = np.zeros(PIECE, into)
            for cells in pdf["cells"]:
                part = np.frombuffer(cells, kind)
                out[: len(part)] = add(out[: len(part)], part)
            return pd.DataFrame({"piece": [pdf["piece"].iloc[0]], "cells": [out.tobytes()]})

        return work

    some = rows.select("piece", "cells", (F.spark_partition_id() % GROUPS).alias("task"))
    return some.groupBy("piece", "task").applyInPandas(put(held), SCHEMA).groupBy("piece").applyInPandas(put(into), SCHEMA)


def merged(rows: DataFrame, size: int, into: np.dtype, add: Callable[[np.ndarray, np.ndarray], np.ndarray], held: np.dtype) -> np.ndarray:
    """The sketches of all tasks (rows piece, cells of type `held`) put together; `size` cells come to the driver."""
    out = np.zeros(max(size, PIECE), into)
    for r in gathered(rows, into, add, held).collect():
        out[r["piece"] * PIECE:(r["piece"] + 1) * PIECE] = np.frombuffer(r["cells"], into)[: len(out) - r["piece"] * PIECE]
    return out[:size]


def mix(values: np.ndarray, seed: int) -> np.ndarray:
    """A permutation of 64-bit numbers for each seed."""
    with np.errstate(over="ignore"):
        v = values.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64))
        v = (v ^ (v >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        v = (v ^ (v >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return v ^ (v >> np.uint64(31))


def bloom_places(values: np.ndarray, bits: int, times: int = 3) -> list[np.ndarray]:
    return [mix(values, 101 + i) & np.uint64(bits - 1) for i in range(times)]
