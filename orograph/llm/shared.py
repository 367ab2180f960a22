"""The folder that driver and executors share, and results that are kept there."""

from __future__ import annotations

import atexit
import contextlib
import gc
import re
import shutil
import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where that is unset and everything runs in one process, a temporary folder that goes with the driver."""
    context = spark.sparkContext
    if folder := context.getConf().get("spark.checkpoint.dir"):
        return folder
    if not (folder := context.getCheckpointDir()):
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="orograph-")
        atexit.register(shutil.rmtree, folder, True)
        context.setCheckpointDir(folder)
        folder = context.getCheckpointDir()
    return folder


def materialised(df: DataFrame) -> DataFrame:
    """The rows, computed once and read from the shared folder from then on."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> tuple[DataFrame, "Folder"]:
    """The rows, computed once and written to the shared folder as a table; deleting the folder frees the disk at once, and columns take less of it than checkpoints do."""
    folder = Folder(df.sparkSession, name)
    df.write.parquet(folder.uri)
    return df.sparkSession.read.schema(df.schema).parquet(folder.uri), folder


def forget(spark: SparkSession, *folders: "Folder") -> None:
    """Deletes the tables, and lets Spark's cleaner remove the shuffle files of results that nothing refers to any more; else they stay on disk until the driver happens to collect its garbage."""
    for folder in folders:
        folder.delete()
    gc.collect()
    spark.sparkContext._jvm.System.gc()


class Folder:
    """A folder of array files below the shared one: written and read by tasks, each file whole or not at all."""

    def __init__(self, spark: SparkSession, name: str):
        # a path without a scheme lies in the cluster's default store, as it does for checkpoints
        base = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
        whole = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(base).toString()
        self.uri = re.sub("^file:/+", "file:///", f"{whole}/{name}-{uuid.uuid4().hex}")
        atexit.register(self.delete)

    def _fs(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.uri)

    def __getstate__(self):
        return {"uri": self.uri}

    def write(self, name: str, *arrays: np.ndarray) -> None:
        """A task that runs again writes the same file again."""
        fs, path = self._fs()
        fs.create_dir(path, recursive=True)
        own = f"{path}/.{name}-{uuid.uuid4().hex}"
        with fs.open_output_stream(own) as f:
            f.write(np.array([len(arrays), *(len(a) for a in arrays)], "<i8").tobytes())
            for a in arrays:
                f.write(memoryview(np.ascontiguousarray(a)).cast("B") if len(a) else b"")
        fs.move(own, f"{path}/{name}")

    def read(self, name: str, *types: str) -> list[np.ndarray] | None:
        """The arrays of a file, memory-mapped; from a store that can't be mapped they are first copied to the task's own temporary folder. None if there is no such file."""
        from pyarrow import fs as kinds

        fs, path = self._fs()
        file = f"{path}/{name}"
        if fs.get_file_info(file).type == kinds.FileType.NotFound:
            return None
        if not isinstance(fs, kinds.LocalFileSystem):
            with tempfile.NamedTemporaryFile() as own:
                with fs.open_input_stream(file) as f:
                    shutil.copyfileobj(f, own)
                own.flush()
                return self._mapped(own.name, types)  # the mapping outlives the name
        return self._mapped(file, types)

    @staticmethod
    def _mapped(file: str, types: tuple[str, ...]) -> list[np.ndarray]:
        lengths = np.fromfile(file, "<i8", 1 + len(types))[1:].tolist()
        out, at = [], 8 * (1 + len(types))
        for kind, n in zip(types, lengths):
            out.append(np.memmap(file, kind, "r", at, (n,)) if n else np.empty(0, kind))
            at += n * np.dtype(kind).itemsize
        return out

    def delete(self) -> None:
        """By Spark's own access to the store, while there is a session, else by Arrow's."""
        try:
            context = SparkSession.getActiveSession().sparkContext
            path = context._jvm.org.apache.hadoop.fs.Path(self.uri)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
        except Exception:  # noqa: BLE001  the session or its JVM may be gone at the driver's end
            with contextlib.suppress(Exception):
                fs, path = self._fs()
                fs.delete_dir(path)
