"""Sketches of many tasks are merged in groups of bounded size."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tallyworks.llm import sketch


def test_sketches_are_merged_in_two_steps(spark):
    size, tasks = sketch.PIECE + 10, 150
    arrays = spark.sparkContext.accumulator(0)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(size, np.uint16)
        for b in batches:
            np.add.at(cells, b.column("id").to_numpy(), 1)
        for i, c in sketch.pieces(cells):
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([c], pa.binary())], names=["piece", "cells"])

    def add(a, b):
        arrays.add(1)
        return a + b

    rows = spark.range(0, size, 1, tasks).mapInArrow(fill, sketch.SCHEMA)
    assert (sketch.merged(rows, size, np.int32, add, np.uint16) == 1).all()
    # Every task has an array of the first piece (the last one of both, or of the second); then one of each group.
    assert tasks + sketch.GROUPS <= arrays.value <= tasks + sketch.GROUPS + 4
