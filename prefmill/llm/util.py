"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import itertools
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefmill.scratch import discard, fresh_dir, shared_dir, stored  # noqa: F401  the operators take them from here

#: Rows that a Python worker turns into Python objects at once.
SLICE_ROWS = 512
#: Text bytes above which a slice is cut shorter than SLICE_ROWS.
SLICE_BYTES = 2 << 20


def file_system(uri: str) -> tuple[Any, str]:
    """(pyarrow file system, path) of a folder. Schemes: file, hdfs, viewfs, s3, gs, abfs (those that pyarrow opens)."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def located(rows: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The rows with file and row number behind their own columns, and the names of these two.

    A table that isn't read straight from Parquet files is stored first.
    """
    plan = rows._jdf.queryExecution().analyzed()
    try:
        if plan.getClass().getSimpleName() != "LogicalRelation":
            raise AnalysisException("no bare relation")
        found = rows.metadataColumn("_metadata")
        rows.select(found["row_index"])
    except AnalysisException:
        rows = stored(rows, "located")
        found = rows.metadataColumn("_metadata")
    names = free_names(rows.columns, ["file", "row"])
    return rows.withColumns({names["file"]: found["file_path"], names["row"]: found["row_index"]}), names


def slices(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that a worker holds a bounded amount of text as objects."""
    for batch in batches:
        n = batch.num_rows
        at = 0
        while at < n:
            size = min(SLICE_ROWS, n - at)
            part = batch.slice(at, size)
            while size > 1 and part.column(text).get_total_buffer_size() and _bytes(part.column(text)) > SLICE_BYTES:
                size = max(1, size // 2)
                part = batch.slice(at, size)
            yield part
            at += size


def _bytes(column: pa.Array) -> int:
    return column.nbytes


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` whose worker gives memory back when its task ends."""
    from prefmill.session import ship

    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from fn(batches)
        finally:
            trim()

    return df.mapInArrow(run, schema)


_tools: dict[tuple, Any] = {}


def tool(kind: Callable[[str], Any], path: str) -> Any:
    """The process's one large tool (an encoder with its caches), built once.

    Workers live longer than a stage; a tool of another kind lets the last one
    go, so a pipeline's worker holds one at a time.
    """
    key = (kind, path)
    if key not in _tools:
        _tools.clear()
        gc.unfreeze()
        gc.collect()
        trim()
        _tools[key] = kind(path)
        # keep the cycle collector away from tables that live as long as the worker
        gc.collect()
        gc.freeze()
        gc.set_threshold(100_000, 50, 1000)
    return _tools[key]


def trim() -> None:
    """Return freed memory to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


def texts_of_columns(id_col: str = "doc_id", text_col: str = "text") -> list[Column]:
    """The two columns that the operators read, null text as the empty text."""
    return [F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")]


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return docs.select(*texts_of_columns(id_col, text_col))


def free_names(taken: list[str], names: list[str]) -> dict[str, str]:
    """Column names for ``names`` that clash with none of ``taken``."""
    low, out = {t.lower() for t in taken}, {}
    for n in names:
        new = n
        while new.lower() in low:
            new = f"_{new}"
        out[n] = new
        low.add(new.lower())
    return out


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """Runs of equal keys in a stream of sorted batches; one run is held at a time."""
    held: list[pa.RecordBatch] = []
    current: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in itertools.pairwise(cuts):
            key = tuple(c[a].item() if hasattr(c[a], "item") else c[a] for c in cols)
            if key != current:
                if held:
                    yield current, pa.Table.from_batches(held)
                held, current = [], key
            held.append(batch.slice(a, b - a))
    if held:
        yield current, pa.Table.from_batches(held)
