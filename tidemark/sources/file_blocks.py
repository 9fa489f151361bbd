"""Names and bytes of files, read on the executors: neither goes through the driver or a shuffle.

A listing is a DataFrame (path, file_length, modified_at). Files are opened with Arrow's file systems, each by
one task and in blocks, so the memory a task needs does not depend on the length of a file. The functions are
sent by value, so executors need no copy of this package.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Kinds of addresses that both Spark and Arrow open, and what Arrow calls them.
SCHEMES = {
    "file": "file", "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss",
}
BLOCK = 4 << 20
TASK_BYTES = 256 << 20
LISTING = "path string, file_length long, modified_at timestamp"


def reachable(path: str) -> bool:
    """Whether Arrow can open a path, given with its scheme."""
    return path.partition(":")[0] in SCHEMES


def _opener():
    """A function from a path to (file system, path in it). One connection for each host."""
    known: dict[str, tuple[arrow_fs.FileSystem, str]] = {}

    def locate(path: str) -> tuple[arrow_fs.FileSystem, str]:
        scheme, _, rest = path.partition(":")
        host, _, name = rest[2:].partition("/") if rest.startswith("//") else ("", "", rest.lstrip("/"))
        root = f"{SCHEMES[scheme]}://{host}/"
        if root not in known:
            known[root] = arrow_fs.FileSystem.from_uri(root)
        system, base = known[root]
        return system, f"{base.rstrip('/')}/{name.lstrip('/')}"

    return locate


def list_folder(spark: SparkSession, folder: str, suffix: str) -> DataFrame:
    """Files right in a folder whose names end in ``suffix``, those without a byte too; names that begin with
    ``.`` or ``_`` are hidden, as they are to Spark. Every action lists anew: write the result to keep it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        locate = _opener()
        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, place = locate(path)
                found = [
                    (f"{path.rstrip('/')}/{info.base_name}", info.size, info.mtime_ns // 1_000_000 * 1000)
                    for info in system.get_file_info(arrow_fs.FileSelector(place))
                    if info.type == arrow_fs.FileType.File and info.base_name.endswith(suffix)
                    and not info.base_name.startswith((".", "_"))
                ]
                for start in range(0, len(found), 10_000):
                    paths, sizes, times = zip(*found[start:start + 10_000], strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(paths), pa.array(sizes, pa.int64()),
                         pa.array(times, pa.int64()).cast(pa.timestamp("us", "UTC"))],
                        ["path", "file_length", "modified_at"])

    return spark.createDataFrame([(folder,)], "path string").mapInArrow(run, LISTING)


def digests(listing: DataFrame) -> DataFrame:
    """(path, file_sha256): SHA-256 of the bytes of each listed file.

    Only names are shuffled, to as many tasks as the bytes ask for."""
    spark = listing.sparkSession
    size = listing.agg(F.sum("file_length")).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, -(-size // TASK_BYTES))
    return listing.select("path").repartition(tasks, "path").mapInArrow(
        digest_paths(BLOCK), "path string, file_sha256 string")


def digest_paths(block: int):
    """Batches of paths to batches of (path, digest)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        locate = _opener()
        for batch in batches:
            paths = batch.column(0).to_pylist()
            found = [_digest(*locate(path), block) for path in paths]
            yield pa.RecordBatch.from_arrays(
                [pa.array(paths, pa.string()), pa.array(found, pa.string())], ["path", "file_sha256"])

    return run


def _digest(system: arrow_fs.FileSystem, place: str, block: int) -> str:
    running = hashlib.sha256()
    with system.open_input_stream(place, compression=None) as stream:
        while piece := stream.read(block):
            running.update(piece)
    return running.hexdigest()
