"""Commits: names in a folder of the file system, each of which only one writer can get."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def folder_of(spark: SparkSession, path: str):
    """The path and its file system."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def claim(spark: SparkSession, path: str, name: str, text: str) -> bool:
    """Whether ``name`` in the folder ``path`` now holds ``text``; False if the name is taken.

    A commit is a whole file before it gets its name, and it gets it only where no file has it: by a link on a
    local disk, else by the file system's rename, which has to be atomic.
    """
    jvm = spark._jvm
    folder, files = folder_of(spark, path)
    files.mkdirs(folder)
    own, target = (jvm.org.apache.hadoop.fs.Path(folder, n) for n in (f".{uuid.uuid4().hex}", name))
    out = files.create(own, False)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if files.getUri().getScheme() == "file":
            link, existing = (jvm.java.io.File(p.toUri().getPath()).toPath() for p in (target, own))
            jvm.java.nio.file.Files.createLink(link, existing)
        else:
            kind = jvm.org.apache.hadoop.fs.Options.Rename
            options = spark.sparkContext._gateway.new_array(kind, 1)
            options[0] = kind.NONE
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(folder.toUri(), spark._jsc.hadoopConfiguration())
            context.rename(own, target, options)
        return True
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise
    finally:
        files.delete(own, False)


def claimed(spark: SparkSession, path: str) -> list[str]:
    """The names in the folder, in order."""
    folder, files = folder_of(spark, path)
    if not files.exists(folder):
        return []
    names = (status.getPath().getName() for status in files.listStatus(folder))
    return sorted(name for name in names if not name.startswith("."))


def remove(spark: SparkSession, path: str) -> None:
    folder, files = folder_of(spark, path)
    files.delete(folder, True)
