"""Small files of the shared file system, through Hadoop's API: local folders, HDFS and object stores alike."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.mkdirs(p)


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.delete(p, True)


def _replace(spark: SparkSession, tmp: str, path: str) -> None:
    fs, p = _path(spark, path)
    fs.delete(p, False)
    if not fs.rename(spark._jvm.org.apache.hadoop.fs.Path(tmp), p):
        raise OSError(f"cannot rename to {path}")


def read_text(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    fs, p = _path(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small file whole: under another name first, then renamed."""
    tmp = f"{path}.{uuid.uuid4().hex}.tmp"
    fs, p = _path(spark, tmp)
    stream = fs.create(p, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    _replace(spark, tmp, path)


def join_parts(spark: SparkSession, folder: str, path: str, append: bool = False) -> None:
    """Joins a folder's part files, in order of name, to one file, behind what it holds already where ``append``; removes the folder."""
    tmp = f"{path}.{uuid.uuid4().hex}.tmp"
    fs, p = _path(spark, tmp)
    out = fs.create(p, True)
    copy = spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes
    sources = [path] if append and exists(spark, path) else []
    where, f = _path(spark, folder)
    sources += sorted(s.getPath().toString() for s in where.listStatus(f) if s.getPath().getName().startswith("part-"))
    try:
        for s in sources:
            at, q = _path(spark, s)
            stream = at.open(q)
            try:
                copy(stream, out, 1 << 20, False)
            finally:
                stream.close()
    finally:
        out.close()
    _replace(spark, tmp, path)
    remove(spark, folder)
