"""Vectors as integers: what the operators on embeddings share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import in_batches

LARGEST = (1 << 31) - 1
FLOATS = ("array<float>", "array<double>")


def integers(df: DataFrame, scale: int, id: str, vector: str, label: Column) -> DataFrame:
    """(vec_id, label, ints, peak) of the rows whose vector has no null and no component that is
    null or not finite: ints holds floor(scale * x) of each component, 32 bits, little-endian,
    peak the largest of them without its sign. A component beyond 32 bits is an error."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(sizes)
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
            keep = bad[ends] == bad[ends - sizes]
            whole = np.repeat(keep, sizes)
            ints = np.floor(scale * values[whole])
            if len(ints) and np.abs(ints).max() > LARGEST:
                raise ValueError(f"a component times {scale} is beyond 32 bits")
            sizes = sizes[keep]
            ends = np.concatenate([[0], np.cumsum(sizes)])
            peak = np.zeros(len(sizes), np.int64)
            some = sizes > 0
            if some.any():
                peak[some] = np.maximum.reduceat(np.abs(ints), ends[:-1][some]).astype(np.int64)
            packed = pa.Array.from_buffers(pa.binary(), len(sizes), [
                None, pa.py_buffer((ends * 4).astype(np.int32).tobytes()),
                pa.py_buffer(ints.astype("<i4").tobytes())])
            chosen = pa.array(keep)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(chosen), batch.column(1).filter(chosen), packed,
                 pa.array(peak)], ["vec_id", "label", "ints", "peak"])

    column = df[vector]
    if df.schema[vector].dataType.simpleString() not in FLOATS:
        column = column.cast("array<double>")
    rows = in_batches(df).select(df[id].alias("vec_id"), label.alias("label"),
                                 column.alias("vector")).where("vector IS NOT NULL")
    kinds = [rows.schema[c].dataType.simpleString() for c in ("vec_id", "label")]
    return rows.mapInArrow(
        of, f"vec_id {kinds[0]}, label {kinds[1]}, ints binary, peak long")


def matrix(ints: pa.Array, width: int) -> np.ndarray:
    """A row per vector, filled up with zeros to `width` components."""
    found = ints.to_pylist()
    if all(len(x) == 4 * width for x in found):
        return np.frombuffer(b"".join(found), "<i4").reshape(len(found), width).astype(np.int64)
    out = np.zeros((len(found), width), np.int64)
    for k, x in enumerate(found):
        out[k, :len(x) // 4] = np.frombuffer(x, "<i4")
    return out


def extent(rows: DataFrame) -> tuple[int, int]:
    """Components of the longest vector, and the largest component without its sign."""
    size, peak = rows.agg(F.max(F.octet_length("ints")), F.max("peak")).first()
    return (size or 0) // 4, peak or 0
