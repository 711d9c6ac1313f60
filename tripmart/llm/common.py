"""Helpers that several operators of this package use."""

from __future__ import annotations

import tempfile
import uuid
import weakref
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Tables written by ``settle``, in order.
SETTLED: list[str] = []
#: Where each of them lies.
_PATHS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()
#: Temporary folders of local sessions that name none.
_TEMPORARY: dict[str, str] = {}


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a local session may do without that setting; it gets a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        if context.applicationId not in _TEMPORARY:
            _TEMPORARY[context.applicationId] = tempfile.mkdtemp(prefix="llm-")
        folder = _TEMPORARY[context.applicationId]
    return folder.rstrip("/")


def settle(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """``df`` written to the shared folder and read back.

    The lineage ends there, so a lost executor costs no recomputation of what came
    before, and later reads prune columns.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=codec)
    SETTLED.append(path)
    table = spark.read.schema(df.schema).parquet(path)
    _PATHS[table] = path
    return table


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Delete settled tables that nothing reads any more."""
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def drop(*tables: DataFrame) -> None:
    """Delete tables as ``settle`` returned them; nothing may read them any more."""
    for table in tables:
        remove(table.sparkSession, [_PATHS.pop(table)])


def quoted(column: str) -> str:
    """A column's name as an expression, also with dots or backticks in it."""
    return "`" + column.replace("`", "``") + "`"


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z in lower case and every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def slices(batch: pa.RecordBatch, at: int, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows whose column number ``at`` holds some ``most_bytes``.

    A longer value makes a run of its own; every row comes back once, in order.
    """
    if not batch.num_rows:
        return
    lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(at)), 0)
    begin, held = 0, 0
    for row, size in enumerate(lengths.to_pylist()):
        if held and held + size > most_bytes:
            yield batch.slice(begin, row - begin)
            begin, held = row, 0
        held += size
    yield batch.slice(begin)
