"""Intermediate tables in the folder that all machines of a cluster share."""

from __future__ import annotations

import contextlib
import functools
import inspect
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_own: list[str] = []
_noted: list[list[str]] = []
_MARK_BITS = 22
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_USED = ("key", "text", "host", "source", "learns")


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset, a temporary folder in local mode and the warehouse on a cluster."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith("local"):
        return spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="spark-"))
    return f"file://{_own[0]}"


def stored(df: DataFrame, tidy: bool = False) -> DataFrame:
    """`df`, written once as a table and read again: later steps neither repeat its work nor depend on executors that held parts of it.

    tidy: the shuffle files of the writing are deleted when it ends.
    """
    path = f"{shared_folder(df.sparkSession)}/voltline-{uuid.uuid4().hex}"
    with tidied(df.sparkSession) if tidy else contextlib.nullcontext():
        df.write.parquet(path)
    for paths in _noted:
        paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def tidied(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of each query that runs within are deleted when it ends."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


@contextlib.contextmanager
def noting(paths: list[str]) -> Iterator[None]:
    """Add the path of every table stored within to `paths`."""
    _noted.append(paths)
    try:
        yield
    finally:
        _noted.remove(paths)


def removed(spark: SparkSession, paths: list[str], but: DataFrame) -> None:
    """Delete stored tables, but those that `but` reads."""
    used = but.inputFiles()
    for path in paths:
        if not any(path.rsplit("/", 1)[1] in f for f in used):
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)

def key_place(column: str = "key") -> Column:
    """A key's place in a table of marks."""
    return F.shiftrightunsigned(F.xxhash64(column), 64 - _MARK_BITS).cast("int")


def key_marks(wanted: DataFrame, column: str = "key") -> np.ndarray:
    """A table of fixed size that is true at the places of all wanted keys, and by chance at those of others."""
    marks = np.zeros(1 << _MARK_BITS, bool)
    marks[wanted.select(key_place(column).alias("p")).distinct().toArrow()["p"].to_numpy()] = True
    return marks


def shields(*added: str) -> Callable:
    """For operators on a table of documents: columns that an operator doesn't use pass through it under names that can't clash.

    Names of its own columns come from its arguments `key`, `text`, `host`, `source` and `learns`; `added`
    are those that it adds, which replace any of the same name.
    """

    def wrap(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        @functools.wraps(operator)
        def shielded(documents: DataFrame, *args, **options) -> DataFrame:
            bound = inspect.signature(operator).bind(documents, *args, **options)
            bound.apply_defaults()
            used = {bound.arguments[n] for n in _USED if n in bound.arguments}
            stem = "_extra"
            while any(c.lower().startswith(stem) for c in documents.columns):
                stem += "_"
            hidden = {c: f"{stem}_{i}" for i, c in enumerate(documents.columns) if c not in used}
            out = operator(documents.withColumnsRenamed(hidden), *args, **options)
            new = {c.lower() for c in added}
            out = out.drop(*[h for c, h in hidden.items() if c.lower() in new])
            return out.withColumnsRenamed({h: c for c, h in hidden.items()})

        return shielded

    return wrap
