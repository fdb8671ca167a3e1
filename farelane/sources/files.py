"""Small file-system steps on the shared store: markers, listings, first lines (all through the cluster's own file system)."""

from __future__ import annotations

import csv

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return fs.exists(p)


def mark(spark: SparkSession, path: str) -> None:
    """Create an empty file; its presence is the message."""
    p, fs = _fs(spark, path)
    fs.create(p, True).close()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, or everything a glob names; nothing there is no error."""
    p, fs = _fs(spark, path)
    for status in fs.globStatus(p) or []:
        fs.delete(status.getPath(), True)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; a missing folder is empty."""
    p, fs = _fs(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def data_files(spark: SparkSession, paths) -> list[str]:
    """Files behind paths, globs or folders (whose own files only, without hidden ones), sorted."""
    out = []
    for path in [paths] if isinstance(paths, str) else list(paths):
        p, fs = _fs(spark, path)
        for status in fs.globStatus(p) or []:
            found = fs.listStatus(status.getPath()) if status.isDirectory() else [status]
            out += [str(s.getPath()) for s in found if not s.isDirectory() and s.getPath().getName()[0] not in "._" and s.getLen() > 0]
    return sorted(set(out))


def header_of(spark: SparkSession, path: str) -> tuple[str, ...]:
    """Column names in the first line of a CSV file, plain or compressed; only its first block is read."""
    jvm = spark.sparkContext._jvm
    p, fs = _fs(spark, path)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark.sparkContext._jsc.hadoopConfiguration()).getCodec(p)
    stream = fs.open(p)
    try:
        if codec is not None:
            stream = codec.createInputStream(stream)
        line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
    finally:
        stream.close()
    return tuple(x.strip().lstrip("﻿") for x in next(csv.reader([line or ""]), []))
