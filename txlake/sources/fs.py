"""Folder operations through Hadoop's FileSystem, so that any URI Spark can
read works: local paths, HDFS, object stores."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, uri: str):
    return spark._jvm.org.apache.hadoop.fs.Path(uri)


def _fs(spark: SparkSession, uri: str):
    path = _path(spark, uri)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, uri: str) -> bool:
    fs, path = _fs(spark, uri)
    return fs.exists(path)


def folders(spark: SparkSession, uri: str, depth: int) -> list[str]:
    """Relative names of the folders ``depth`` levels below ``uri``."""
    fs, path = _fs(spark, uri)
    if depth == 0:
        return [""]
    pattern = _path(spark, uri.rstrip("/") + "/*" * depth)
    base = fs.makeQualified(path).toUri().getPath().rstrip("/") + "/"
    names = [
        s.getPath().toUri().getPath()[len(base) :]
        for s in (fs.globStatus(pattern) or [])
        if s.isDirectory()
    ]
    return sorted(n for n in names if not n.split("/")[-1].startswith(("_", ".")))


def files(spark: SparkSession, uri: str) -> list[tuple[str, int, int]]:
    """(name, bytes, modification time in ms) of the files directly in a folder."""
    fs, path = _fs(spark, uri)
    if not fs.exists(path):
        return []
    return sorted(
        (s.getPath().getName(), s.getLen(), s.getModificationTime())
        for s in fs.listStatus(path)
        if s.isFile()
    )


def create_text(spark: SparkSession, uri: str, text: str) -> None:
    """Create a small file; fails if it is there already."""
    fs, path = _fs(spark, uri)
    out = fs.create(path, False)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()


def read_text(spark: SparkSession, uri: str) -> str:
    fs, path = _fs(spark, uri)
    stream = fs.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def delete_folder(spark: SparkSession, uri: str) -> None:
    fs, path = _fs(spark, uri)
    fs.delete(path, True)


def modified(spark: SparkSession, uri: str) -> int:
    """Modification time of a file or folder in milliseconds."""
    fs, path = _fs(spark, uri)
    return fs.getFileStatus(path).getModificationTime()


def size(spark: SparkSession, uri: str) -> int:
    """Bytes in all files below a folder."""
    fs, path = _fs(spark, uri)
    return fs.getContentSummary(path).getLength()
