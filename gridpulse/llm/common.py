"""Column names, stored intermediates and files that the corpus operators share."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import gridpulse
from gridpulse.session import run_dir


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that `df` does not have, made from `names`."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def col(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def stored(df: DataFrame, label: str) -> DataFrame:
    """`df` written once to the shared folder and read back: computed once, lineage cut."""
    path = run_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Applications whose workers have the package.
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the workers this package as a Python file of the application, once."""
    context, home = spark.sparkContext, Path(gridpulse.__file__).parent
    if context.applicationId in _SHIPPED or not home.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="gridpulse-")) / "gridpulse.zip"  # served by the driver
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(home.rglob("*.py")):
            out.write(file, file.relative_to(home.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """`run` over the Arrow batches of each partition, on workers that have this package."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def map_batches(df: DataFrame, each: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """`each` over the Arrow batches of `df`; batches are bounded by rows, never by groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield each(batch)

    return map_arrow(df, run, schema)


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder URI; a bare path is a mounted folder."""
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else "file://" + uri)


def write_file(folder: str, name: str, data: bytes) -> str:
    """Write a file whose name no other attempt of the task takes; returns that name.

    Only files named in the rows that a task returns count, so what a failed or
    repeated attempt leaves behind is never read.
    """
    fs, path = filesystem(folder)
    fs.create_dir(path, recursive=True)
    stem, dot, kind = name.partition(".")
    final = f"{stem}-{uuid.uuid4().hex[:12]}{dot}{kind}"
    with fs.open_output_stream(f"{path}/{final}", compression=None) as out:
        out.write(data)
    return final


def read_range(folder: str, name: str, start: int = 0, length: int | None = None) -> bytes:
    """`length` bytes of a file from `start`; a negative start counts from the end."""
    fs, path = filesystem(folder)
    with fs.open_input_file(f"{path}/{name}") as file:
        size = file.size()
        begin = size + start if start < 0 else start
        return file.read_at(size - begin if length is None else length, begin)


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder in the shared folder, as a URI or path; made on first write."""
    return run_dir(spark, label)
