"""Helpers that several corpus operators share.

Conventions of all operators here: a null text counts as an empty one; only the named columns are read, so further
columns of an input never clash with those of a result; a row is never dropped for its size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null becomes b""."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def held_out(doc_id: str, modulus: int, remainder: int = 2):
    """True where crc32 of the id as text leaves `remainder`; an id that is null is never held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Apply `function` to each Arrow batch on its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield function(batch)

    return df.mapInArrow(run, schema)


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable index of each of `n` nodes under the links a[i]-b[i] (one task's links only)."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while True:
            jumped = label[label]
            if np.array_equal(jumped, label):
                break
            label = jumped
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
    return label


_KEPT: dict[str, object] = {}


def per_worker(token: str, make: Callable[[], object]):
    """`make()` once per Python worker and `token`, so tables and memories outlive a task; only the last is kept."""
    if token not in _KEPT:
        _KEPT.clear()
        _KEPT[token] = make()
    return _KEPT[token]
