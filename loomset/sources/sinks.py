"""Writing prepared data, and staging it between jobs."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from typing import Any

from pyspark.sql import DataFrame, SparkSession

# The folders that the innermost scratch block owns.
_OWNED: ContextVar[list[str] | None] = ContextVar("loomset_owned", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """Delete, at the end of the block, all folders that the library staged within it.

    Results that are read from such folders have to be written or collected inside the
    block.  It gives the list of folders; what is taken out of it stays.
    """
    owned: list[str] = []
    before = _OWNED.set(owned)
    try:
        yield owned
    finally:
        _OWNED.reset(before)
        for path in owned:
            remove(spark, path)


def write_split_table(df: DataFrame, path: str) -> None:
    """Write Parquet with one directory per ``split``, in a single pass.

    A task keeps one writer open for each of the three splits; without them it would
    have to sort its rows by split first.
    """
    conf, name = df.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(name, "0")
    conf.set(name, "3")
    try:
        df.write.partitionBy("split").parquet(path)
    finally:
        conf.set(name, before)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether something lies at ``path``, in whatever file system it names."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def remove(spark: SparkSession, path: str) -> None:
    """Delete what lies at ``path``."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def read_note(spark: SparkSession, path: str) -> Any:
    """What :func:`write_note` wrote to ``path``, or None where there is nothing."""
    if not exists(spark, path):
        return None
    rows = spark.read.text(path, wholetext=True).collect()
    try:
        return json.loads(rows[0]["value"])
    except (IndexError, ValueError):  # its writer was stopped
        return None


def write_note(spark: SparkSession, path: str, content: Any) -> None:
    """Write a short JSON file, in whatever file system ``path`` names, or replace it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at, True)
    try:
        out.write(bytearray(json.dumps(content, indent=1), "utf-8"))
    finally:
        out.close()


def write_jsonl(df: DataFrame, path: str) -> None:
    """Write JSON Lines; ``path`` becomes a directory of part files."""
    df.write.json(path)


def write_jsonl_pair(
    train: DataFrame, eval_rows: DataFrame | None, root: str, name: str
) -> None:
    """Write ``<name>/<name>.train.jsonl`` and, if given, its validation file."""
    stem = f"{root.rstrip('/')}/{name}/{name}"
    write_jsonl(train, f"{stem}.train.jsonl")
    if eval_rows is not None:
        write_jsonl(eval_rows, f"{stem}.validation.jsonl")


def shared_dir(spark: SparkSession) -> str:
    """A new directory name in the folder set as ``spark.checkpoint.dir``.

    A machine-local folder would be lost with its machine, so it is used only
    where the whole session runs on one machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    path = f"{base.rstrip('/')}/loomset-{uuid.uuid4().hex}"
    owned = _OWNED.get()
    if owned is not None:
        owned.append(path)
    return path


def stage(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet, to a new folder or to ``path``, and read it back.

    Later jobs then read only the columns that they need, and a lost executor
    does not bring back the work before this point.
    """
    path = path or shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
