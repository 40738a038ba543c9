"""Path checks through the file systems the session is configured for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there."""
    hadoop_path, file_system = _resolve(spark, path)
    return file_system.exists(hadoop_path)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, so every reader and writer means the same file system."""
    hadoop_path, file_system = _resolve(spark, path)
    return file_system.makeQualified(hadoop_path).toString()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder this package wrote itself."""
    hadoop_path, file_system = _resolve(spark, path)
    file_system.delete(hadoop_path, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder, in order; none if it is not there."""
    hadoop_path, file_system = _resolve(spark, path)
    if not file_system.exists(hadoop_path):
        return []
    return sorted(status.getPath().getName() for status in file_system.listStatus(hadoop_path))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small new file; an error if it is there."""
    hadoop_path, file_system = _resolve(spark, path)
    out = file_system.create(hadoop_path, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    hadoop_path, file_system = _resolve(spark, path)
    stream = file_system.open(hadoop_path)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)).decode()
    finally:
        stream.close()


def rename(spark: SparkSession, path: str, to: str) -> bool:
    """Give a file its final name; False, and nothing done, if that name is taken.

    As a whole or not at all on file systems with atomic renames (HDFS, local). An object store copies and deletes instead:
    readers still see a whole file or none, but two writers at the same instant may both believe they were first.
    """
    source, file_system = _resolve(spark, path)
    target = _resolve(spark, to)[0]
    if file_system.exists(target):
        return False
    return file_system.rename(source, target)


def sizes(spark: SparkSession, path: str, suffix: str) -> dict[str, int]:
    """Bytes of the files directly in a folder, by name, without hidden ones."""
    hadoop_path, file_system = _resolve(spark, path)
    listed = [s for s in file_system.listStatus(hadoop_path) if s.isFile()]
    named = {s.getPath().getName(): s.getLen() for s in listed}
    return {name: size for name, size in named.items() if name.endswith(suffix) and name[0] not in "._"}
