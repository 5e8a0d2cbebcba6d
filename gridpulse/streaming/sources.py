"""Streaming reads of Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def parquet_stream(
    spark: SparkSession, path: str, schema: T.StructType, max_files_per_trigger: int | None = None
) -> DataFrame:
    """A stream over the files of a Parquet table, be it one file or a folder.

    The file source takes folders and patterns only, so the last letter is
    written as a pattern that matches just itself.
    """
    path = path.rstrip("/")
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


#: Rows that a file of a micro-batch holds at least, where it has more than one.
FILE_ROWS = 100_000


def files_per_batch(counts: list[int]) -> int:
    """Into how many files each of several micro-batches can be dealt, so that no file is empty.

    As `max_files_per_trigger` it takes them one by one, as long as all have that many.
    """
    return max(1, min(counts) // FILE_ROWS)


def write_batch(rows: DataFrame, path: str, files: int) -> None:
    """Append a micro-batch to the folder of a stream, in that many files, newer than those before."""
    rows.repartition(files).write.mode("append").parquet(path)
