"""Record feed export: JSON lines in UTF-8 (Spark's default encoding), one file per task; and text files, one per key."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Ship this module's task-side functions by value, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def export_utf8(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("encoding", "UTF-8").json(path)
    return path


def _storage(uri: str):
    """File system and path of a URI; ``file:/x`` and plain paths are local to the shared mount."""
    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    return pa.fs.FileSystem.from_uri(uri)


def _file_writer(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        folder = f"{path}/{context.partitionId():06d}-{context.taskAttemptId()}"
        fs, place = _storage(folder)
        out, key = None, None
        for b in batches:
            for k, value in zip(b.column(0).to_pylist(), b.column(1)):
                if out is None:
                    fs.create_dir(place, recursive=True)
                if out is None or k != key:
                    if out is not None:
                        out.close()
                    out, key = fs.open_output_stream(f"{place}/part-{k}.txt", compression=None), k
                if value.is_valid:
                    out.write(value.as_buffer())
                out.write(b"\n")
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([folder])], names=["folder"])
    return run


def write_text_files(df: DataFrame, key: str, value: str, path: str) -> list[str]:
    """One file ``part-<key>.txt`` for each key of a task, a line per row; returns the folders, one a task that had rows.

    Files are written by the tasks themselves: Spark's text writer makes a folder for each key and, on a local disk without Hadoop's
    native library, starts a process for the mode of each folder and file.  Only folders of attempts that succeed are returned."""
    fs, place = _storage(path)
    fs.create_dir(place, recursive=True)
    rows = df.select(F.col(key), F.col(value).cast("string")).sortWithinPartitions(key)
    return [r.folder for r in rows.mapInArrow(_file_writer(path), "folder string").collect()]
