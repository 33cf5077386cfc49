"""Files in stores that all nodes reach, opened by the tasks themselves: ranges of bytes in, whole small files out.

Paths are those that Spark lists. Local and mounted folders, S3, Google's store and HDFS (with its native library) are opened
through pyarrow.
"""

from __future__ import annotations

import tempfile
import uuid

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; a folder of this machine only where the setting is unset and Spark is local."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    root = tempfile.mkdtemp(prefix="sparktree-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def located(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path in it."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if path.startswith("/"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def read_range(path: str, offset: int, length: int) -> bytes:
    """Bytes of a file from an offset on; fewer where it ends before."""
    store, at = located(path)
    with store.open_input_file(at) as f:
        size = f.size()
        return f.read_at(max(0, min(length, size - offset)), offset) if offset < size else b""


def write_files(files: DataFrame, folder: str) -> None:
    """Writes each row of files(name, content) into a folder, by the task that has the row.

    A file is written under a temporary name and moved, so a lost task leaves no half of one, and its rerun replaces what it
    left. Of rows with the same name one is kept.
    """

    def run(frames):
        store, at = located(folder)
        store.create_dir(at, recursive=True)
        for held in frames:
            for name, content in zip(held["name"], held["content"]):
                part = f"{at}/.{uuid.uuid4().hex}"
                with store.open_output_stream(part) as out:
                    out.write(bytes(content))
                store.move(part, f"{at}/{name}")
            yield pd.DataFrame({"name": held["name"]})

    files.select("name", "content").mapInPandas(run, "name string").write.format("noop").mode("overwrite").save()
