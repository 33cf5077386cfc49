"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

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


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores behind them until none is a column of df; case doesn't count."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def without(df: DataFrame, *names: str) -> list[str]:
    """The columns of df that aren't called by one of the names, whatever their case."""
    return [c for c in df.columns if c.lower() not in names]


def materialise(df: DataFrame, name: str, codec: str = "uncompressed") -> DataFrame:
    """Writes df as a table in the shared folder and reads it back: lineage is cut, and a lost executor loses nothing.

    Most such tables are hashes and numbers, which compress little, and codecs in native code hold memory outside the
    heap for each of many small tasks; give a codec for tables of text.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def delete(spark: SparkSession, path: str) -> None:
    """Removes a folder of the shared store, through Spark's own file systems."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def put(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small file to the shared store: beside its place first, so that no reader sees half of it."""
    jvm = spark._jvm
    p, beside = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(path + ".new")
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.rename(beside, p)


def release(*tables: DataFrame) -> None:
    """Removes materialised tables whose last reader is done: nothing lazy may still depend on them."""
    for t in tables:
        if path := getattr(t, "_scratch_path", None):
            delete(t.sparkSession, path)
