"""Helpers for operators that read text in Arrow batches inside Spark tasks."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

import isobar

#: Bytes of text handled at once, a longer text alone. The arrays made of them take some
#: hundred times as much, in each Python worker.
CHUNK_BYTES = 1 << 20


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, wherever the driver found it; once a session."""
    context = spark.sparkContext
    if getattr(context, "_isobar_shipped", False):
        return
    root = Path(isobar.__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="isobar-code-")) / "isobar_code.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, file.relative_to(root.parent))
    context.addPyFile(str(target))
    context._isobar_shipped = True


def chunks(batches: Iterable[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose texts take at most ``limit`` bytes, or one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        first = 0
        while first < batch.num_rows:
            before = ends[first - 1] if first else 0
            stop = max(first + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(first, stop - first)
            first = stop


def give_back_memory() -> None:
    """Hand freed memory back to the system; a worker lives on and meets other tasks."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not glibc
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def list_chunks(batches: Iterable[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose lists hold at most ``limit`` elements together, or one row."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.list_value_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        first = 0
        while first < batch.num_rows:
            before = ends[first - 1] if first else 0
            stop = max(first + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(first, stop - first)
            first = stop


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, and where each starts and the last ends; null is empty."""
    plain = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = plain.buffers()
    places = np.frombuffer(offsets, dtype=np.int64)[plain.offset : plain.offset + len(plain) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
    return raw[places[0] : places[-1]], places - places[0]


def lists(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Consecutive runs of ``values`` as a list column; ``ends`` starts with 0."""
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))
