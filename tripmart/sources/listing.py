"""File listings and Parquet footers as DataFrames."""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.contracts import PARTITION_KEYS, RESERVED_COLUMNS, TRIP_FILE_MARK, TRIP_FILE_PATTERN

#: Footers and markers that are opened at the same time.
FILES_AT_ONCE = 32


def list_files(spark: SparkSession, root: str, pattern: str = "*.parquet") -> DataFrame:
    """One row per file below ``root``: (path, length, modified); none if there is no such folder.

    The binary source lists in parallel and opens no file, since its content
    column is not selected.
    """
    reader = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
    )
    try:
        return reader.load(root).select("path", "length", F.col("modificationTime").alias("modified"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string, length bigint, modified timestamp")


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` as listings write it, with the scheme of its storage."""
    system, at = _file_system(spark, path)
    return system.makeQualified(at).toString()


def plain_path(column: str | Column, encoded: bool = False) -> Column:
    """A path with one slash after its scheme, as listings and scans differ in that.

    Scans (``_metadata.file_path``) also encode it as a URL, which ``encoded`` undoes.
    """
    path = F.col(column) if isinstance(column, str) else column
    path = F.regexp_replace(path, "^([a-z0-9]+):/+", "$1:/")
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))) if encoded else path


def list_month_files(spark: SparkSession, root: str) -> DataFrame:
    """Monthly source files by their name: (vehicle_type, year, month, path, root).

    Works for any folder layout.  A month delivered in parts, in several folders or by
    part numbers in the names, has one row for each.  A file that is named like a monthly
    one but does not fit the contract has NULL for type, year and month: it belongs to no
    month, and ``unplaced`` finds it.  Other files are left out.
    """
    name = F.element_at(F.split("path", "/"), -1)
    fits = name.rlike(TRIP_FILE_PATTERN)
    part = [F.when(fits, F.regexp_extract(name, TRIP_FILE_PATTERN, i)) for i in (1, 2, 3)]
    return (
        list_files(spark, root)
        .filter(F.contains(F.lower(name), F.lit(TRIP_FILE_MARK)))
        .select(
            part[0].alias("vehicle_type"),
            part[1].cast("int").alias("year"),
            part[2].cast("int").alias("month"),
            "path",
            F.lit(qualified(spark, root)).alias("root"),
        )
    )


def unplaced(listing: DataFrame) -> DataFrame:
    """Paths of files that look monthly but whose name says no type and month."""
    return listing.filter(F.col("vehicle_type").isNull()).select("path").distinct()


def origin_of(path: Column, root: str | None) -> Column:
    """The path below its listing's root, which tells files of equal names apart.

    It stays the same wherever the root is moved to; without a root it is the whole path.
    """
    return path if root is None else F.substr(path, F.lit(len(_plain(root).rstrip("/")) + 2))


def _plain(path: str) -> str:
    return re.sub("^([a-z0-9]+):/+", r"\1:/", path)


def list_partition_files(
    spark: SparkSession, root: str, keys: Sequence[str] = PARTITION_KEYS
) -> DataFrame:
    """Files of a partitioned table: (keys, path, folder, location).

    ``location`` is the partition folder relative to ``root``; zero-padded and
    plain month folders are both understood.
    """
    values = {"vehicle_type": "([^/]+)", "year": r"(\d+)", "month": r"(\d+)"}
    pattern = "/(" + "/".join(f"{k}={values[k]}" for k in keys) + ")/[^/]+$"
    part = [F.regexp_extract("path", pattern, i) for i in range(1, len(keys) + 2)]
    kinds = ["string" if k == "vehicle_type" else "int" for k in keys]
    return (
        list_files(spark, root)
        .filter(F.col("path").rlike(pattern))
        .select(
            *[p.cast(kind).alias(k) for p, kind, k in zip(part[1:], kinds, keys)],
            "path",
            F.regexp_replace("path", "/[^/]+$", "").alias("folder"),
            part[0].alias("location"),
        )
    )


def _file_system(spark: SparkSession, path: str):
    """Spark's own file system for ``path``, whatever storage that is, and the path in it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    system, at = _file_system(spark, path)
    return system.exists(at)


def delete(spark: SparkSession, path: str) -> None:
    system, at = _file_system(spark, path)
    system.delete(at, True)


def _at_once(work: Callable, items: Iterable) -> list:
    """``work`` on every item, ``FILES_AT_ONCE`` at a time, results in order."""
    with ThreadPoolExecutor(FILES_AT_ONCE) as pool:
        return list(pool.map(work, items))


def _reason(error: Py4JJavaError) -> str:
    return str(error.java_exception.toString()).splitlines()[0][:300]


def _look(spark: SparkSession) -> Callable[[str], tuple[str | None, int | None, str | None]]:
    """A function from a path to (Parquet's schema text, rows, fault) of the file there.

    The footer is opened through Spark's own file systems, so every storage that it lists
    will do.  A file that can be read but is no Parquet file has a fault; a storage that
    does not give the file is an error, because a later run may get it.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader
    source, place = jvm.org.apache.parquet.hadoop.util.HadoopInputFile, jvm.org.apache.hadoop.fs.Path

    def look(path: str):
        try:
            opened = reader.open(source.fromPath(place(path), conf))
        except Py4JJavaError as error:
            try:
                system, at = _file_system(spark, path)
                stream = system.open(at)
                stream.read()
                stream.close()
            except Py4JJavaError as storage:
                raise OSError(f"the storage does not give {path}: {_reason(storage)}") from error
            return None, None, _reason(error)
        try:
            return sys.intern(opened.getFileMetaData().getSchema().toString()), opened.getRecordCount(), None
        finally:
            opened.close()

    return look


def columns_of(spark: SparkSession, path: str) -> tuple[list[str] | None, str | None]:
    """(sorted "name type" list of a Parquet file, None), or (None, why Spark cannot read it)."""
    try:
        fields = spark.read.parquet(path).schema
    except (PySparkException, Py4JJavaError) as error:
        return None, str(error).splitlines()[0][:300]
    return sorted(f"{f.name} {f.dataType.simpleString()}" for f in fields if f.name not in RESERVED_COLUMNS), None


def with_footers(files: DataFrame) -> DataFrame:
    """Add what each file's footer says: ``columns``, ``row_count`` and ``fault``.

    Files with equal ``columns`` can be scanned together, and whether a month has a
    column is taken from here and from nowhere else.  Many footers are opened at once; files
    with one schema in their footers are alike to Spark too, so it is asked about one of
    them.  Only file names and one column list per schema pass the driver.  A file that Spark
    cannot read has NULL in the first two and the reason in ``fault``.
    """
    spark = files.sparkSession
    paths = [r.path for r in files.select("path").distinct().orderBy("path").collect()]
    looked = _at_once(_look(spark), paths)
    first: dict[str, str] = {}
    for path, (schema, _, _) in zip(paths, looked, strict=True):
        if schema is not None:
            first.setdefault(schema, path)
    number = {schema: k for k, schema in enumerate(first)}
    kinds = _at_once(lambda path: columns_of(spark, path), first.values())
    known = spark.createDataFrame(
        [(path, number.get(schema), rows, fault) for path, (schema, rows, fault) in zip(paths, looked, strict=True)],
        "path string, kind int, rows bigint, own_fault string")
    alike = spark.createDataFrame([(k, *c) for k, c in enumerate(kinds)], "kind int, columns array<string>, kind_fault string")
    return (
        files.join(known, "path").join(F.broadcast(alike), "kind", "left")  # one row per schema
        .withColumns({"row_count": F.when(F.col("columns").isNotNull(), F.col("rows")),
                      "fault": F.coalesce("own_fault", "kind_fault")})
        .select(*files.columns, "columns", "row_count", "fault")
    )


def stored_rows(table: DataFrame) -> int | None:
    """Rows in the files behind ``table`` by their footers, without a job; None for other data.

    No more rows than these can come out of filters, projections and groupings of the table.
    """
    spark = table.sparkSession
    paths = table.inputFiles()  # as URLs
    if not paths or not all(p.endswith(".parquet") for p in paths):
        return None
    look, place, uri = _look(spark), spark._jvm.org.apache.hadoop.fs.Path, spark._jvm.java.net.URI
    return sum(rows or 0 for _, rows, _ in _at_once(lambda p: look(place(uri(p)).toString()), paths))


def with_markers(folders: DataFrame, name: str = "_SUCCESS") -> DataFrame:
    """Add ``marker``: the text of the marker file in each ``folder``, NULL without one.

    Spark's own readers pass over files whose name starts with an underscore, so its
    file system is asked, for many folders at once; only folder names and markers reach
    the driver.
    """
    spark = folders.sparkSession
    utils = spark._jvm.org.apache.commons.io.IOUtils

    def text(folder: str) -> tuple[str, str | None]:
        system, at = _file_system(spark, f"{folder}/{name}")
        if not system.exists(at):
            return folder, None
        stream = system.open(at)
        try:
            return folder, utils.toString(stream, "UTF-8")
        finally:
            stream.close()

    names = [r.folder for r in folders.select("folder").distinct().collect()]
    return folders.join(spark.createDataFrame(_at_once(text, names), "folder string, marker string"), "folder")


def rows_per_file(df: DataFrame) -> DataFrame:
    """Row count of every file behind ``df``; no data column is read."""
    return df.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(
        F.count("*").alias("row_count")
    )
