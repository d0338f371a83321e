"""User-defined aggregates that are merged, so that a hot key never gathers its rows.

The built-in aggregates do this in generated code and come first. An aggregate that they can't express
is given in Python with four methods; rows are added in the task that reads them, and only buffers are
exchanged.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence
from typing import Any, Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

BUFFER = "buffer"


class MergeableAggregate(Protocol):
    def create(self) -> Any:
        """An empty buffer. Buffers are pickled between tasks."""

    def add(self, buffer: Any, rows: pd.DataFrame) -> Any:
        """The buffer with some rows of one group added."""

    def merge(self, left: Any, right: Any) -> Any:
        """Both buffers in one."""

    def result(self, buffer: Any) -> tuple:
        """The values of the result columns."""


def _groups(batch: pa.RecordBatch, keys: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """For each group of a batch the place of its first row, and for each row its group.

    Keys are compared in Arrow, so null is a key of its own and long integers stay exact.
    """
    code = np.zeros(batch.num_rows, np.int64)
    for key in keys:
        coded = batch.column(key).dictionary_encode()
        own = coded.indices.fill_null(len(coded.dictionary)).to_numpy(zero_copy_only=False)
        _, code = np.unique(code * (len(coded.dictionary) + 1) + own, return_inverse=True)
    _, first, group = np.unique(code, return_index=True, return_inverse=True)
    return first, group


def _comparable(values: tuple) -> tuple:
    """Key values such that NaN equals NaN."""
    return tuple("nan" if isinstance(v, float) and v != v else v for v in values)


def merge_aggregate(
    rows: DataFrame,
    keys: Sequence[str],
    inputs: Sequence[str],
    aggregate: MergeableAggregate,
    schema: str,
    open_groups: int = 100_000,
) -> DataFrame:
    """``keys...`` and the columns of ``schema``: one row for each group.

    First phase: every task adds its rows, batch by batch, and hands on one buffer a group, more only if
    it meets over ``open_groups`` groups. Second phase: the buffers are exchanged by key, sorted, and merged
    as they stream past. A key with a third of all rows so reaches its reducer as one buffer a task.

    Null is a key like any other. No rows give no groups; without keys there is one group. ``add`` never gets an
    empty frame.
    """
    keys, inputs = list(keys), list(inputs)
    given = rows.select(*keys, *inputs)
    key_fields = [f for f in given.schema.fields[: len(keys)]]
    outputs = T._parse_datatype_string(schema).fields
    result_types = [to_arrow_type(f.dataType) for f in outputs]

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buffers: dict[tuple, tuple[tuple, Any]] = {}
        kinds = None
        for batch in batches:
            if not batch.num_rows:
                continue
            kinds = kinds or [batch.schema.field(k).type for k in keys]
            first, group = _groups(batch, keys)
            heads = [batch.column(k).take(pa.array(first)).to_pylist() for k in keys]
            names = list(zip(*heads)) if keys else [()]
            order = np.argsort(group, kind="stable")
            frame = batch.select(inputs).to_pandas().iloc[order]
            cuts = np.searchsorted(group[order], np.arange(len(first) + 1))
            for k, name in enumerate(names):
                at = _comparable(name)
                buffer = buffers[at][1] if at in buffers else aggregate.create()
                buffers[at] = name, aggregate.add(buffer, frame.iloc[cuts[k] : cuts[k + 1]])
            if len(buffers) > open_groups:
                yield packed(buffers, kinds)
                buffers = {}
        if buffers:
            yield packed(buffers, kinds)

    def packed(buffers: dict, kinds: list) -> pa.RecordBatch:
        columns = list(zip(*[name for name, _ in buffers.values()])) if keys else []
        arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds)]
        arrays.append(pa.array([pickle.dumps(b) for _, b in buffers.values()], pa.binary()))
        return pa.RecordBatch.from_arrays(arrays, names=[*keys, BUFFER])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        current, name, buffer, kinds = None, (), None, None
        for batch in batches:
            kinds = kinds or [batch.schema.field(k).type for k in keys]
            heads = [batch.column(k).to_pylist() for k in keys]
            names = zip(*heads) if keys else [()] * batch.num_rows
            for other, data in zip(names, batch.column(BUFFER).to_pylist()):
                part = pickle.loads(data)
                if current is not None and _comparable(other) == current:
                    buffer = aggregate.merge(buffer, part)
                    continue
                if current is not None:
                    done.append((*name, *aggregate.result(buffer)))
                current, name, buffer = _comparable(other), other, part
            if len(done) >= 10_000:
                yield finished(done, kinds)
                done = []
        if current is not None:
            done.append((*name, *aggregate.result(buffer)))
        if done:
            yield finished(done, kinds)

    def finished(done: list[tuple], kinds: list) -> pa.RecordBatch:
        columns = list(zip(*done))
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
        arrays += [pa.array(c, k) for c, k in zip(columns[len(keys) :], result_types)]
        return pa.RecordBatch.from_arrays(arrays, names=[*keys, *[f.name for f in outputs]])

    buffers = given.mapInArrow(start, T.StructType([*key_fields, T.StructField(BUFFER, T.BinaryType())]))
    placed = buffers.repartition(*keys).sortWithinPartitions(*keys) if keys else buffers.coalesce(1)
    return placed.mapInArrow(finish, T.StructType([*key_fields, *outputs]))
