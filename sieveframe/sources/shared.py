"""Folders every executor can see, and versioned tables in them."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


_stored: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``; where that is unset, under the
    warehouse, which executors share as well."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_intermediate"
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder once and read back: its lineage is cut,
    a lost executor loses nothing, and its true size is known to the optimizer."""
    path = shared_dir(df.sparkSession)
    _stored.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_intermediates(spark: SparkSession) -> None:
    """Delete what ``materialize`` has stored in this process so far. DataFrames
    that read it can no longer be used."""
    while _stored:
        _delete(spark, _stored.pop())


def is_file(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(target) and fs.getFileStatus(target).isFile()


def versions(spark: SparkSession, path: str) -> dict[int, str]:
    """Complete versions under ``path``, in order: number and folder name. A
    version counts once Spark has marked its write as successful."""
    jvm = spark.sparkContext._jvm
    marks = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/v=*/_SUCCESS")
    fs = marks.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = sorted(mark.getPath().getParent().getName() for mark in fs.globStatus(marks) or ())
    return {int(name[2:].split(".")[0]): name for name in names}


def version_name(number: int, writer: str = "") -> str:
    return f"v={number:020d}" + (f".{writer}" if writer else "")


def write_version(df: DataFrame, path: str, number: int, writer: str = "") -> DataFrame:
    """Write one version and read it back. Writing it again replaces it."""
    target = f"{path.rstrip('/')}/{version_name(number, writer)}"
    df.write.mode("overwrite").parquet(target)
    return df.sparkSession.read.schema(df.schema).parquet(target)


def read_versions(spark: SparkSession, path: str, names: Iterable[str]) -> DataFrame:
    return spark.read.parquet(*[f"{path.rstrip('/')}/{name}" for name in names])


def drop_versions(spark: SparkSession, path: str, names: Iterable[str]) -> None:
    """Delete the given versions under ``path``."""
    for name in names:
        _delete(spark, f"{path.rstrip('/')}/{name}")


def _delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
