"""Files that tasks write to and read from the shared folder."""

from __future__ import annotations

import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from zonewright.session import scratch_path


def open_folder(url: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder address (local path, file, s3, hdfs, gs ...)."""
    if "://" not in url and not url.startswith("file:"):
        return pafs.LocalFileSystem(), url
    return pafs.FileSystem.from_uri(url.replace("file:///", "file:/").replace("file:/", "file:///"))


def task_file(url: str, stem: str, suffix: str) -> tuple[pafs.FileSystem, str, str, int]:
    """File system, path, address and number of the file of this task attempt.

    A second attempt writes a file of its own; only the address that the successful attempt
    returns is ever read.
    """
    context = TaskContext.get()
    number = context.partitionId()
    files, path = open_folder(url)
    files.create_dir(path, recursive=True)
    name = f"{stem}-{number:05d}-{context.taskAttemptId()}{suffix}"
    return files, f"{path}/{name}", f"{url}/{name}", number


def output_folder(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, name)


def one_task_each(rows: DataFrame, number: str, count: int) -> DataFrame:
    """A short listing of ``count`` files spread over as many tasks, by its ``number``."""
    return rows.repartitionByRange(max(1, count), number)
