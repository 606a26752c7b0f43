"""Table versions (B4, B11, B13): a table is a folder of versions, and a version counts once its manifest stands.

``<table>/data/<name>/`` holds the files of one version, in whatever format its writer chose; ``<table>/versions/<number>`` is its manifest
(a line of JSON that names the folder), renamed into place after all files are written.  So a step may read a
table and replace it, readers keep the version they began with, and a run that breaks while it writes leaves the version before.
Of two writers that began with the same version the second to commit gets :class:`Conflict`.

The rename is one of the file system's own (Hadoop's ``FileContext``, which refuses an existing name): atomic on HDFS.  An object store without
such a rename needs writers that take turns.  Nothing is ever deleted here.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


class Conflict(RuntimeError):
    """Another writer committed this version first."""


@dataclass(frozen=True)
class Version:
    number: int
    folder: str       # holds the version's files


def versions(spark: SparkSession, table: str) -> list[Version]:
    """The committed versions, oldest first (a manifest a version: driver work that does not grow with the table)."""
    fs, path = _files(spark, f"{table}/versions")
    if not fs.exists(path):
        return []
    found = []
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        if name.isdigit():
            manifest = json.loads(spark.read.text(status.getPath().toString()).first()[0])
            found.append(Version(int(name), f"{table}/data/{manifest['folder']}"))
    return sorted(found, key=lambda v: v.number)


def current(spark: SparkSession, table: str, number: int | None = None) -> Version | None:
    """The latest committed version, or that of ``number``; None where there is none."""
    found = [v for v in versions(spark, table) if number is None or v.number == number]
    return found[-1] if found else None


@contextmanager
def new_version(spark: SparkSession, table: str, after: int | None = None) -> Iterator[str]:
    """The folder to write the next version to; leaving the block commits it, an exception leaves the table as it was.

    ``after`` is the number of the version that the new one builds on (0: none), by default the latest when the block begins."""
    if after is None:
        after = max((v.number for v in versions(spark, table)), default=0)
    folder = uuid.uuid4().hex
    yield f"{table}/data/{folder}"
    _commit(spark, table, after + 1, {"folder": folder})


def replace_table(df: DataFrame, table: str, partition_by: tuple[str, ...] = (), after: int | None = None) -> Version:
    """``df``, which may be read from ``table`` itself (its version ``after``), as the next version in parquet."""
    with new_version(df.sparkSession, table, after) as folder:
        df.write.partitionBy(*partition_by).parquet(folder)
    return next(v for v in versions(df.sparkSession, table) if v.folder == folder)


def read_version(spark: SparkSession, table: str, number: int | None = None) -> DataFrame:
    """The parquet table as of version ``number`` (default: the latest)."""
    found = current(spark, table, number)
    if found is None:
        raise ValueError(f"{table} has no version" + ("" if number is None else f" {number}"))
    return spark.read.parquet(found.folder)


def _files(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _commit(spark: SparkSession, table: str, number: int, manifest: dict) -> None:
    """The manifest, written aside whole and renamed to its number; a name that is taken means that another writer was first."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs, aside = _files(spark, f"{table}/versions/_{manifest['folder']}")
    out = fs.create(aside, False)
    out.write(bytearray(json.dumps(manifest).encode()))
    out.close()
    place = hadoop.Path(f"{table}/versions/{number}")
    none = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0)      # no option: an existing name is an error
    try:
        hadoop.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(aside, place, none)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in str(e.java_exception):
            raise Conflict(f"version {number} of {table} was committed by another writer") from e
        raise
