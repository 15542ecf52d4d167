"""Intermediate tables in the folder that the whole cluster shares."""

from __future__ import annotations

import re
import tempfile
import uuid

import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession

#: Folders that this driver has written and not cleared.
_written: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names.

    Where it is unset, a session whose executors are the driver itself, as in tests, gets one
    of its own; on a cluster that is an error, as executors would not see each other's files.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the whole cluster shares")
        named = f"file://{tempfile.mkdtemp(prefix='tidemark-')}"
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def own_folder(spark: SparkSession, label: str) -> str:
    """A new name in the shared folder, which ``clear`` deletes."""
    path = f"{shared_folder(spark)}/tidemark-{label}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage: whatever executor is lost later, the rows are read
    again from the written files instead of being computed anew, and values that
    depend on how a task saw its input (such as its partition) stay as they are.
    """
    spark = df.sparkSession
    path = own_folder(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written() -> list[str]:
    """The folders so far that have not been cleared."""
    return list(_written)


def clear(paths: list[str] | None = None) -> None:
    """Deletes these intermediate tables, or all so far; results that still read them must have been written or collected."""
    for path in written() if paths is None else paths:
        if path in _written:
            _written.remove(path)
        store, place = pyarrow.fs.FileSystem.from_uri(path)
        if store.get_file_info(place).type != pyarrow.fs.FileType.NotFound:
            store.delete_dir(place)
