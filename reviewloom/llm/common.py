"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from reviewloom.session import scratch_path


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: lost executors recompute nothing before it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows that a function gets at once, whatever the size of Arrow's batches: texts are long.
ROWS_AT_ONCE = 1024
#: What empties the memories that a worker process keeps from task to task; tells whether there was anything.
FORGET: list[Callable[[], bool]] = []


def forget_all() -> None:
    if any([forget() for forget in FORGET]):
        gc.collect()


def map_batches(
    df: DataFrame,
    function: Callable[[Iterator[pa.RecordBatch]], Iterator[dict[str, list]]],
    schema: str,
    remembers: bool = False,
) -> DataFrame:
    """``mapInArrow`` for functions that yield columns as a dict of lists, in the order of ``schema``.

    Worker processes live on after a stage. A task of a function that does not itself use what they
    ``remember`` first frees it.
    """
    parsed = _parse_datatype_string(schema)
    assert isinstance(parsed, StructType)
    arrow = to_arrow_schema(parsed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not remembers:
            forget_all()
        parts = (b.slice(at, ROWS_AT_ONCE) for b in batches for at in range(0, b.num_rows, ROWS_AT_ONCE))
        for columns in function(parts):
            arrays = [c if isinstance(c := columns[f.name], pa.Array) and c.type == f.type else pa.array(c, f.type) for f in arrow]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, parsed)


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """True for the fold that no label is learned from; a NULL id is never in it."""
    id_text = F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")
    return F.coalesce(F.crc32(id_text.cast("binary")) % 4 == 2, F.lit(False))


def attempt_name(prefix: str) -> str:
    """A file name that no other attempt of this task uses; only the attempt that wins is listed."""
    context = TaskContext.get()
    return f"{prefix}-{context.partitionId():05d}-{context.taskAttemptId()}"


def folder(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a shared folder, which is made if it is not there."""
    system, inner = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else os.path.abspath(path))
    system.create_dir(inner, recursive=True)
    return system, inner.rstrip("/")
