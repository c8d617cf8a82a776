"""Scans of ``cab_type=/year=/month=/day=`` Parquet folders."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.operators.align import align
from tripmill.schemas import SLICE_PARTITIONS, TRIP_COLUMNS, TRIP_SLICE, TargetColumn
from tripmill.sources.files import path_exists

# Tasks used to read file metadata; each one only asks for names and lengths.
LISTING_TASKS = 256
# Tasks that open footers.
FOOTER_TASKS = 64


def _number(part: str | int | None) -> int | None:
    """``"06"``, ``"6"`` and ``6`` all name folder ``month=6``."""
    return None if part is None else int(part)


def slice_filter(
    cab_types: Sequence[str],
    year: str | int,
    month: str | int | None = None,
    day: str | int | None = None,
) -> Column:
    """Predicate on the folder columns only, so that it prunes folders."""
    if day is not None and month is None:
        raise ValueError("a day needs a month")
    keep = F.col("cab_type").isin(*cab_types) & (F.col("year") == _number(year))
    if month is not None:
        keep = keep & (F.col("month") == _number(month))
    if day is not None:
        keep = keep & (F.col("day") == _number(day))
    return keep


def _wanted(
    year: str | int | None, month: str | int | None, day: str | int | None
) -> list[tuple[str, int | None]]:
    if day is not None and month is None:
        raise ValueError("a day needs a month")
    return [("year", _number(year)), ("month", _number(month)), ("day", _number(day))]


def slice_path(
    root: str,
    cab_type: str,
    year: str | int,
    month: str | int | None = None,
    day: str | int | None = None,
) -> str:
    """Folder of a slice, as recorded in the lineage columns.

    Fixed values: the layout of the source, ``cab_type=/year=/month=/day=``.
    """
    named = [("cab_type", cab_type), *((n, v) for n, v in _wanted(year, month, day) if v is not None)]
    return "/".join([root.rstrip("/"), *(f"{name}={value}" for name, value in named), ""])


def slice_folders(
    spark: SparkSession,
    root: str,
    cab_types: Sequence[str],
    year: str | int,
    month: str | int | None = None,
    day: str | int | None = None,
) -> list[str]:
    """Existing folders of a slice: one look-up for each level, nothing is listed.

    Month and day folders may be written with or without a leading zero.
    """
    found = [f"{root.rstrip('/')}/cab_type={cab_type}" for cab_type in cab_types]
    for name, value in _wanted(year, month, day):
        if value is None:
            break
        spelled = dict.fromkeys([str(value), f"{value:02d}"])
        found = [f"{above}/{name}={text}" for above in found for text in spelled]
        found = [folder for folder in found if path_exists(spark, folder)]
    return [folder for folder in found if path_exists(spark, folder)]


def _folder_columns(levels: Sequence[str]) -> list[T.StructField]:
    return [f for f in SLICE_PARTITIONS.fields if f.name in levels]


def read_slices(
    spark: SparkSession,
    root: str,
    cab_types: Sequence[str],
    year: str | int,
    month: str | int | None = None,
    day: str | int | None = None,
    schema: T.StructType | None = TRIP_SLICE,
    levels: Sequence[str] = ("cab_type", "year", "month", "day"),
) -> DataFrame:
    """Several cab types in one pruned scan instead of a union of scans.

    Only the slice's own folders are listed. With a declared schema no footer is
    read while planning, and columns a file lacks come back as NULL; use
    :func:`read_aligned` where files may hold other types or lack required
    columns. ``schema=None`` infers it from the files.
    """
    keep = slice_filter(cab_types, year, month, day)
    folders = slice_folders(spark, root, cab_types, year, month, day)
    if not folders:
        fields = (schema or TRIP_SLICE).fields + _folder_columns(levels)
        return spark.createDataFrame([], T.StructType(fields))
    reader = spark.read.option("basePath", root)
    if schema is not None:
        reader = reader.schema(T.StructType(schema.fields + _folder_columns(levels)))
    return reader.parquet(*folders).where(keep)


def _openable(path: str) -> str:
    """A URI with an authority, which some of Hadoop's paths lack."""
    return re.sub(r"^file:/+", "file:///", path)


def footer_types(files: DataFrame) -> DataFrame:
    """(types, paths): the column ``path`` of Parquet files, grouped by the names and types they hold.

    Tasks read the footers, a file each; only the grouped paths come to the driver, which plans
    the scans.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for path in batch.column("path").to_pylist():
                system, name = pyarrow.fs.FileSystem.from_uri(_openable(path))
                with system.open_input_file(name) as file:
                    schema = pq.read_schema(file)
                found.append(",".join(sorted(f"{f.name}:{f.type}" for f in schema)))
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(found, pa.string())], ["path", "types"])

    typed = files.select("path").repartition(FOOTER_TASKS).mapInArrow(run, "path string, types string")
    return typed.groupBy("types").agg(F.sort_array(F.collect_list("path")).alias("paths"))


def read_aligned(
    spark: SparkSession,
    root: str,
    cab_types: Sequence[str],
    year: str | int,
    month: str | int | None = None,
    day: str | int | None = None,
    spec: Sequence[TargetColumn] = TRIP_COLUMNS,
    lenient: bool = False,
    keep: Column | None = None,
) -> DataFrame:
    """A slice in the target types, whatever types its files hold.

    The footer of every file of the slice is read by tasks, and files of one type are one scan,
    whatever folders they lie in; scans of different types are cast and then united. A file that
    lacks a required column is an error. The source's folder columns come with the result as
    ``folder_day`` (NULL above day level). ``keep`` is a further predicate on the folder columns; no file of
    other folders is opened.
    """
    folders = slice_folders(spark, root, cab_types, year, month, day)
    groups = []
    if folders:
        files = _listed(spark, root, folders)
        files = files if keep is None else files.where(keep)
        groups = footer_types(files.where("length > 0")).orderBy("types").collect()
    scans = []
    for group in groups:
        scan = spark.read.option("basePath", root).parquet(*group["paths"])
        levels = set(scan.columns)
        own = F.make_date("year", "month", "day") if {"year", "month", "day"} <= levels else F.lit(None)
        scans.append(align(scan, spec=spec, lenient=lenient, extra=[own.cast("date").alias("folder_day")]))
    if not scans:
        fields = [T.StructField(c.name, T._parse_datatype_string(c.type)) for c in spec]
        return spark.createDataFrame([], T.StructType([*fields, T.StructField("folder_day", T.DateType())]))
    return reduce(DataFrame.unionByName, scans)


def read_slice(
    spark: SparkSession,
    root: str,
    cab_type: str,
    year: str | int,
    month: str | int | None = None,
    day: str | int | None = None,
    schema: T.StructType | None = TRIP_SLICE,
    levels: Sequence[str] = ("cab_type", "year", "month", "day"),
) -> DataFrame:
    return read_slices(spark, root, [cab_type], year, month, day, schema, levels)


def list_files(
    spark: SparkSession, root: str, folders: Sequence[str] | None = None
) -> DataFrame:
    """Folder columns and length of every Parquet file; no content is read.

    ``folders`` below the root restrict what is listed.
    """
    return _listed(spark, root, folders).drop("path")


def _listed(spark: SparkSession, root: str, folders: Sequence[str] | None) -> DataFrame:
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("basePath", root)
        .load(list(folders) if folders else root)
        .drop("content", "modificationTime")
    )
    # binaryFile plans one task per few files; names and lengths need far fewer
    return files.coalesce(LISTING_TASKS)


def slice_volume(
    spark: SparkSession,
    root: str,
    by: Sequence[str] = ("cab_type", "year", "month"),
    where: Column | None = None,
    folders: Sequence[str] | None = None,
) -> DataFrame:
    """Bytes and number of files of each slice, from file metadata."""
    files = list_files(spark, root, folders)
    if where is not None:
        files = files.where(where)
    return files.groupBy(*by).agg(
        F.sum("length").alias("bytes"), F.count(F.lit(1)).alias("files")
    )


def landed_days(
    spark: SparkSession, root: str, day_column: str = "pickup_date"
) -> DataFrame:
    """Cab types and days that have at least one file in a landed table."""
    files = list_files(spark, root)
    return files.select(
        F.col("cab_type").cast("string").alias("cab_type"),
        F.col(day_column).cast("date").alias("day"),
    ).distinct()
