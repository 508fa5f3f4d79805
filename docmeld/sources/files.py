"""Incremental file source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docmeld.config import INTAKE_GLOB, MAX_FILES_PER_TRIGGER, parse_bytes

#: Longer than any file has existed.
ANY_AGE = "36500d"
BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def binary_file_stream(
    spark: SparkSession,
    folder: str,
    glob: str = INTAKE_GLOB,
    max_files: int | None = MAX_FILES_PER_TRIGGER,
    max_bytes: int | str | None = None,
    recursive: bool = False,
    max_file_age: str = ANY_AGE,
) -> DataFrame:
    """Files of a folder as they arrive; the checkpoint of the query decides which are new.

    The file source takes one size limit per trigger: ``max_bytes`` (such as ``"10g"``) wins over ``max_files``.
    A file not seen yet is taken whatever its time stamp is, restored ones included. The price is that the driver
    keeps the path of every file ever seen; a ``max_file_age`` such as ``"90d"`` lets it forget paths, and then files
    that are older than the newest one by more than that are never taken.
    """
    reader = spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA).option("pathGlobFilter", glob)
    reader = reader.option("maxFileAge", max_file_age)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", parse_bytes(max_bytes))
    elif max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.load(folder)
