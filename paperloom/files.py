"""Small files on the tables' file system, and numbered commits made by renaming one into place."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class ConcurrentChange(RuntimeError):
    """Another writer replaced what this one has read."""


def hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def file_system(spark: SparkSession, path: str):
    return hadoop_path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def names_in(spark: SparkSession, folder: str) -> list[str]:
    fs = file_system(spark, folder)
    if not fs.exists(hadoop_path(spark, folder)):
        return []
    return sorted(f.getPath().getName() for f in fs.listStatus(hadoop_path(spark, folder)))


def read_json(spark: SparkSession, path: str):
    stream = file_system(spark, path).open(hadoop_path(spark, path))
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def write_json(spark: SparkSession, path: str, value) -> None:
    stream = file_system(spark, path).create(hadoop_path(spark, path), False)
    try:
        stream.write(bytearray(json.dumps(value, sort_keys=True).encode()))
    finally:
        stream.close()


def put_file(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a file unless the target exists; tells whether it did."""
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(hadoop_path(spark, target).toUri(), spark._jsc.hadoopConfiguration())
    if context.util().exists(hadoop_path(spark, target)):
        return False
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.NONE
    try:
        context.rename(hadoop_path(spark, source), hadoop_path(spark, target), options)
    except Exception as error:
        if "FileAlreadyExists" in str(error):
            return False
        raise
    return True


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if it exists."""
    file_system(spark, path).delete(hadoop_path(spark, path), True)


def commit_file(folder: str, number: int) -> str:
    return f"{folder}/{number:012d}.json"


def commit_numbers(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the commits in a folder, oldest first."""
    return [int(n[:-5]) for n in names_in(spark, folder) if n.endswith(".json") and not n.startswith("_")]


def commit_json(spark: SparkSession, folder: str, number: int, value) -> bool:
    """Make a commit unless another writer has taken its number; tells whether it did."""
    temporary = f"{folder}/_{uuid.uuid4().hex}"
    write_json(spark, temporary, value)
    if put_file(spark, temporary, commit_file(folder, number)):
        return True
    remove(spark, temporary)
    return False
