"""Files that only one writer can create: the commits of loads that may run side by side.

A commit is a small file with a number for a name. Its text is laid down under another
name first and then moved to the number, in one step that fails when the number is taken.
On a local disk that step is a hard link, elsewhere the file system's rename, which must
refuse an existing name, as HDFS does.
"""

from __future__ import annotations

import uuid
from urllib.parse import quote

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class CommitConflict(RuntimeError):
    """Another writer took this commit number first."""


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path in its form."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def names(spark: SparkSession, folder: str) -> list[str]:
    """What lies in a folder, sorted; nothing when it is not there."""
    fs, at = file_system(spark, folder)
    return sorted(status.getPath().getName() for status in fs.listStatus(at)) if fs.exists(at) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, at = file_system(spark, path)
    stream = fs.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    fs, at = file_system(spark, path)
    fs.delete(at, True)


def commit_path(folder: str, number: int) -> str:
    return f"{folder}/{number:012d}.json"


def commit_numbers(spark: SparkSession, folder: str) -> list[int]:
    return [int(name.removesuffix(".json")) for name in names(spark, folder) if name.endswith(".json") and not name.startswith(".")]


def commit(spark: SparkSession, folder: str, number: int, text: str) -> None:
    """Create commit ``number`` of a folder, or raise ``CommitConflict`` when it is there."""
    path, draft = commit_path(folder, number), f"{folder}/.{uuid.uuid4().hex}"
    fs, to = file_system(spark, path)
    drafted = file_system(spark, draft)[1]
    out = fs.create(drafted, True)
    try:
        out.write(bytearray(text, "utf8"))
    finally:
        out.close()
    try:
        if fs.getUri().getScheme() == "file":
            files = spark._jvm.java.nio.file.Files
            files.createLink(fs.pathToFile(to).toPath(), fs.pathToFile(drafted).toPath())
        elif fs.exists(to) or not fs.rename(drafted, to):
            raise CommitConflict(f"{path} is taken")
    except Py4JJavaError as error:
        if "FileAlreadyExists" in str(error.java_exception):
            raise CommitConflict(f"{path} is taken") from None
        raise
    finally:
        fs.delete(drafted, False)


def safe_name(text: str) -> str:
    """A name for one folder level, different for different texts."""
    return quote(text, safe="").replace("%", "+")
