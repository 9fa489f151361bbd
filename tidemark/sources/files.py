"""Small file-system helpers (metadata only) for any file system Spark can reach."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    location = jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), location


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme and host."""
    fs, location = _fs(spark, path)
    return fs.makeQualified(location).toString()


def exists(spark: SparkSession, path: str) -> bool:
    fs, location = _fs(spark, path)
    return fs.exists(location)


def delete(spark: SparkSession, path: str) -> None:
    fs, location = _fs(spark, path)
    fs.delete(location, True)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, location = _fs(spark, path)
    fs.mkdirs(location)


def child_names(spark: SparkSession, path: str) -> list[str]:
    fs, location = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(location))


def move(spark: SparkSession, path: str, target: str) -> bool:
    """Rename a folder in one step; False where the target is there already."""
    fs, location = _fs(spark, path)
    return fs.rename(location, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target))


def move_into(spark: SparkSession, folder: str, target: str, rename) -> list[str]:
    """Rename the data files of ``folder`` into ``target`` (same file system), each in one
    step. ``rename`` maps a running number to the new name."""
    fs, _ = _fs(spark, folder)
    make_folder(spark, target)
    names = []
    data = [name for name in child_names(spark, folder) if name.startswith("part-")]
    path_class = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for number, name in enumerate(data):
        names.append(rename(number))
        if not fs.rename(path_class(f"{folder}/{name}"), path_class(f"{target}/{names[-1]}")):
            raise OSError(f"could not rename {folder}/{name} to {target}/{names[-1]}")
    return names
