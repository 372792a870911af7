"""Listing and removing files through Spark."""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from staymart.scratch import scratch_folder, stage

# Files that a task removes, about, in one go.
REMOVED_PER_TASK = 1_000


def list_files(spark: SparkSession, *folders: str) -> DataFrame:
    """(path, length, modificationTime) of the files below folders. No content is read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(list(folders))
        .select("path", "length", "modificationTime")
    )


def relative_to(column: str, pattern: str) -> Column:
    """The part of a path that ``pattern`` matches, up to its end."""
    return F.regexp_extract(F.col(column), f"({pattern})$", 1)


def _file_system(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """File system and path of a full URI, as Spark's listings give them. A path
    without a scheme is refused: Spark may take it for another file system."""
    scheme, colon, rest = uri.partition(":")
    if not colon:
        raise ValueError(f"not a full URI: {uri}")
    if scheme == "file":
        return pyarrow.fs.LocalFileSystem(), path_in(uri)
    if scheme == "s3a":
        uri = f"s3:{rest}"
    return pyarrow.fs.FileSystem.from_uri(uri)


def path_in(uri: str) -> str:
    """The path of a full URI as its file system wants it: with the bucket, if there is
    one, as object stores name files by it."""
    scheme, _, rest = uri.partition(":")
    if scheme == "file":
        return "/" + rest.lstrip("/")
    if scheme in ("s3", "s3a", "gs"):
        return rest.lstrip("/")
    return "/" + rest.lstrip("/").partition("/")[2]


def remove_files(paths: DataFrame, folder: str) -> int:
    """Removes the files in column ``path``, in tasks; returns how many were there.

    The list is written below ``folder`` first: a listing looks at its files again
    when a task repeats it. A file that is gone already is passed over.
    """
    paths = stage(paths.select("path"), folder, "remove")
    paths = paths.repartition(max(1, -(-paths.count() // REMOVED_PER_TASK)))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clients: dict[str, pyarrow.fs.FileSystem] = {}  # one per scheme and host
        for batch in batches:
            gone = []
            for uri in batch.column(0).to_pylist():
                place = "/".join(uri.split("/", 3)[:3])
                if place not in clients:
                    clients[place] = _file_system(uri)[0]
                system, path = clients[place], path_in(uri)
                try:
                    system.delete_file(path)
                    gone.append(uri)
                except FileNotFoundError:
                    pass
            yield pa.RecordBatch.from_arrays([pa.array(gone, pa.string())], names=["path"])

    gone = paths.mapInArrow(remove, "path string").count()
    discard(folder)
    return gone


def remove_folder(uri: str) -> None:
    """Removes a folder of intermediate tables; it need not be there any more."""
    system, path = _file_system(uri)
    try:
        system.delete_dir(path)
    except FileNotFoundError:
        pass


def discard(uri: str) -> None:
    """``remove_folder`` where the work is done already: a failure is told, not raised."""
    try:
        remove_folder(uri)
    except Exception as error:  # whatever the store says, what was done stays done
        warnings.warn(f"intermediate tables are left in {uri}: {error}", stacklevel=2)


def with_scheme(folder: str) -> str:
    """A scratch folder as a full URI; without a scheme it is a local one."""
    return folder if ":" in folder else f"file:{folder}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A folder for intermediate tables that is gone afterwards. Frames that read from
    it must have been used by then."""
    full = with_scheme(scratch_folder(spark))
    try:
        yield full
    finally:
        discard(full)
