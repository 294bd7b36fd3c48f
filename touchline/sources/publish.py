"""Versions of a set of tables, and the pointer that names the published one.

A refresh writes everything into a folder of its own below ``versions``. Only when it
is whole and its tests have passed does one small file, ``CURRENT``, name it. The
file is written beside and then renamed over the old one, so a reader sees either
version, never a mixture; a run that fails leaves the published tables as they were.
"""
from __future__ import annotations

import time
import uuid

from pyspark.sql import SparkSession

POINTER = "CURRENT"


def _path(spark: SparkSession, name: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)


def _file_system(spark: SparkSession, name: str):
    return _path(spark, name).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def new_version(root: str) -> str:
    """A fresh folder name below ``root``; later versions sort after earlier ones."""
    return f"{root.rstrip('/')}/versions/{int(time.time() * 1000):015d}-{uuid.uuid4().hex[:8]}"


def current(spark: SparkSession, root: str) -> str | None:
    """The folder of the published version, or None before the first."""
    pointer = f"{root.rstrip('/')}/{POINTER}"
    if not _file_system(spark, pointer).exists(_path(spark, pointer)):
        return None
    return f"{root.rstrip('/')}/versions/{spark.read.text(pointer).first()['value']}"


def publish(spark: SparkSession, root: str, version: str) -> None:
    """Name ``version`` (from :func:`new_version`) as the published one."""
    base, name = root.rstrip("/"), version.rstrip("/").rsplit("/", 1)[1]
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    fs = _file_system(spark, version)
    if not fs.exists(_path(spark, f"{base}/versions/{name}")):
        raise FileNotFoundError(f"no version {name} below {base}")
    beside = _path(spark, f"{base}/.{POINTER}-{uuid.uuid4().hex}")
    out = fs.create(beside)
    out.write(bytearray(f"{name}\n".encode()))
    out.close()
    options = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    kinds = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    kinds[0] = options
    target = fs.makeQualified(_path(spark, f"{base}/{POINTER}"))
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(fs.makeQualified(beside), target, kinds)
