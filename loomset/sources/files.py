"""Scans of JSON Lines and JSON files, and where they lie."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomset.functions import one_value
from loomset.sources.arrays import json_texts


def scan_jsonl(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per line: ``row_id``, ``source_file`` and the JSON text ``value``.

    Files are read as text and split by size, so one large file is read by many
    tasks.  Blank lines hold no row.  ``row_id`` is unique within one scan, and
    (``source_file``, ``row_id``) across scans; the text itself, not this id, is what
    a split depends on.
    """
    # Nearly every line starts with a brace, which is cheap to see.
    not_blank = F.col("value").startswith("{") | (
        F.btrim("value", F.lit(" \t\r")) != ""
    )
    lines = spark.read.text(path).where(not_blank)
    return lines.select(
        F.monotonically_increasing_id().alias("row_id"),
        F.col("_metadata.file_path").alias("source_file"),
        "value",
    )


def scan_json_texts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Like :func:`scan_jsonl` for files that each hold one JSON array or object.

    ``value`` is the text of an element of the array, of the object, or of a line where a
    file holds something else.  An array may be of any size: it is read by as many tasks
    as lines would be, and an element that is no JSON, or too large to be read, is a row
    like any other.  An element has to fit into one cell (2 GB).
    """
    return json_texts(spark, path).select(
        F.monotonically_increasing_id().alias("row_id"), F.col("file").alias("source_file"), "value"
    )


def scan_json(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """:func:`scan_json_texts` with ``value`` as VARIANT.

    Where a text can't be one, since it is no JSON, deeper than 2,000 levels or larger
    than a VARIANT (128 MiB), ``value`` is NULL and ``line`` has the text.
    """
    rows = scan_json_texts(spark, path).withColumnRenamed("value", "line")
    read = rows.select("row_id", "source_file", F.inline(F.array(F.struct(one_value(F.col("line")).alias("value"), "line"))))
    return read.withColumn("line", F.when(F.col("value").isNull(), F.col("line")))


def discover_corpus(spark: SparkSession, root: str, name: str) -> str:
    """Path of the file called ``name`` anywhere below ``root``.

    A directory of that name, as Spark writes it, is found as well.  Only listings are
    read, one directory after the other, and only the smallest path is kept.  In the
    result, characters that a path pattern gives a meaning are escaped, so that it can
    be read as it is.
    """
    jvm = spark._jvm
    top = jvm.org.apache.hadoop.fs.Path(root)
    files = top.getFileSystem(spark._jsc.hadoopConfiguration())
    best, folders = None, [top]
    while folders:
        listing = files.listStatusIterator(folders.pop())
        while listing.hasNext():
            status = listing.next()
            path = status.getPath()
            if path.getName() == name:
                best = min(filter(None, (best, path.toString())))
            elif status.isDirectory():
                folders.append(path)
    if best is None:
        raise FileNotFoundError(f"{name} not found below {root}")
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", best)


class RoutedPaths(NamedTuple):
    """Train file and validation file of one specialist."""

    train: str
    eval: str | None


@dataclass(frozen=True)
class SplitRoutes:
    """Which files belong to which specialist.

    ``datasets`` maps a specialist to a dataset name, found as
    ``<name>/<name>.train.jsonl`` and ``<name>/<name>.validation.jsonl``;
    ``corpora`` maps a specialist to a single corpus file without validation
    file; ``default`` is the dataset name used when no specialist is asked for.
    """

    default: str
    datasets: Mapping[str, str] = field(default_factory=dict)
    corpora: Mapping[str, str] = field(default_factory=dict)

    def resolve(self, root: str, specialist: str | None = None) -> RoutedPaths:
        root = root.rstrip("/")
        if specialist in self.corpora:
            return RoutedPaths(f"{root}/{self.corpora[specialist]}", None)
        if specialist and specialist not in self.datasets:
            known = sorted({*self.datasets, *self.corpora})
            raise ValueError(f"no route for {specialist!r}; there are {', '.join(known)}")
        name = self.datasets[specialist] if specialist else self.default
        stem = f"{root}/{name}/{name}"
        return RoutedPaths(f"{stem}.train.jsonl", f"{stem}.validation.jsonl")

    def scan(
        self, spark: SparkSession, root: str, specialist: str | None = None
    ) -> tuple[DataFrame, DataFrame | None]:
        """Scan the routed files; a missing file fails here, not in the job."""
        paths = self.resolve(root, specialist)
        train = scan_jsonl(spark, paths.train)
        return train, scan_jsonl(spark, paths.eval) if paths.eval else None


def route_table(spark: SparkSession, path: str, specialist: str) -> DataFrame:
    """Rows of one specialist of a table partitioned by ``specialist``, ``split``.

    The predicate prunes partitions, so other specialists are not read.  The names of
    the partitions are text as they stand: ``007`` is not ``7``.
    """
    found = spark.read.parquet(path).schema
    named = [
        T.StructField(f.name, T.StringType() if f.name in ("specialist", "split") else f.dataType)
        for f in found.fields
    ]
    table = spark.read.schema(T.StructType(named)).parquet(path)
    rows = table.where(F.col("specialist") == specialist)
    if rows.isEmpty():
        raise ValueError(f"no specialist called {specialist!r} in {path}")
    return rows
