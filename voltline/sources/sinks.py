"""Writing: whole-table swap, parts behind a pointer, immutable parts, GeoJSON."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Folder value that Spark's writer gives to NULL.
NULL_PART = "__HIVE_DEFAULT_PARTITION__"


def _path(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def partitions(spark: SparkSession, path: str, column: str) -> set[str]:
    """Values of the first-level partition folders: a listing, no data is read."""
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return set()
    prefix = f"{column}="
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    return {n[len(prefix):] for n in names if n.startswith(prefix)}


def _move(fs, source, target) -> None:
    """Rename, and say so if the file system didn't (it answers with False, not with an error)."""
    if not fs.rename(source, target):
        raise OSError(f"could not move {source} to {target}")


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.delete(p, True)


def recover_table(spark: SparkSession, path: str) -> None:
    """Finish or undo a replacement that broke off: the old table comes back if no new one is in place."""
    fs, target = _path(spark, path)
    parent = target.getParent()
    if not fs.exists(parent):
        return
    for found in fs.listStatus(parent):
        name = found.getPath().getName()
        if name.startswith(f"{target.getName()}__old_"):
            if fs.exists(target):
                fs.delete(found.getPath(), True)
            else:
                _move(fs, found.getPath(), target)
        elif name.startswith(f"{target.getName()}__staging_"):
            fs.delete(found.getPath(), True)


def replace_table(df: DataFrame, path: str, partition_by: list[str] = ()) -> None:
    """Replace a table as a whole, even one that `df` itself reads.

    The new state is written beside the old one and swapped in by renaming, so a
    failed write leaves the old table as it was. What a run that broke off between
    two renames has left is put right by the next one, or by recover_table().
    """
    spark = df.sparkSession
    staging = f"{path.rstrip('/')}__staging_{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(staging) if partition_by else df.write.parquet(staging)
    fs, target = _path(spark, path)
    old = _path(spark, f"{path.rstrip('/')}__old_{uuid.uuid4().hex}")[1]
    if fs.exists(target):
        _move(fs, target, old)
    _move(fs, _path(spark, staging)[1], target)
    recover_table(spark, path)


# --- parts behind a pointer -----------------------------------------------------------
#
# path/month=2024-01/run=...      a part as some run wrote it; a part written anew gets a new folder
# path/_current/000000000007     the newest of these files says which folder is each part's


@dataclass(frozen=True)
class Pointer:
    """The state of a table: which run's folder holds each part. Number 0: nothing was published yet."""

    number: int
    parts: dict[str, str]


def _numbers(spark: SparkSession, path: str) -> list[int]:
    fs, p = _path(spark, f"{path.rstrip('/')}/_current")
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(int(n) for n in names if n.isdigit())


def _pointer_file(path: str, number: int) -> str:
    return f"{path.rstrip('/')}/_current/{number:012d}"


def _load_pointer(spark: SparkSession, path: str, number: int) -> Pointer:
    fs, p = _path(spark, _pointer_file(path, number))
    stream = fs.open(p)
    try:
        return Pointer(number, json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
    finally:
        stream.close()


def pointer(spark: SparkSession, path: str) -> Pointer:
    """The published state of a table; a run that broke off before it published left no trace in it."""
    numbers = _numbers(spark, path)
    return _load_pointer(spark, path, numbers[-1]) if numbers else Pointer(0, {})


def part_folder(path: str, column: str, part: str, run: str) -> str:
    return f"{path.rstrip('/')}/{column}={part}/run={run}"


def write_parts(df: DataFrame, path: str, column: str, parts: set[str], order: list[str] = ()) -> dict[str, str]:
    """Write `df` in folders of a run of its own, beside what the table holds; nothing points to them yet.

    `parts` are those that `df` may hold (not NULL); returns the folders of those that it does hold.
    """
    spark, run = df.sparkSession, uuid.uuid4().hex
    rows = df.withColumn("run", F.concat_ws("-", column, F.lit(run))).sortWithinPartitions(column, "run", *order)
    rows.write.mode("append").partitionBy(column, "run").parquet(path)
    named = {part: f"{part}-{run}" for part in sorted(parts)}
    return {part: name for part, name in named.items() if exists(spark, part_folder(path, column, part, name))}


def publish(spark: SparkSession, path: str, before: Pointer, parts: dict[str, str]) -> Pointer:
    """Make `parts` the state of the table by one rename.

    The rename is refused if another run has published since `before` was read, so of two
    writers one fails and changes nothing.
    """
    after = Pointer(before.number + 1, dict(sorted(parts.items())))
    fs, draft = _path(spark, f"{path.rstrip('/')}/_current/.{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    stream.write(bytearray(json.dumps(after.parts).encode()))
    stream.close()
    target = _path(spark, _pointer_file(path, after.number))[1]
    if fs.exists(target):
        fs.delete(draft, False)
        raise OSError(f"another run has changed {path}")
    _move(fs, draft, target)
    return after


def clean_parts(spark: SparkSession, path: str, column: str, among: set[str] | None = None) -> None:
    """Delete folders that neither the state nor the one before it names (readers may still be on that).

    Looks at the parts `among`, or at all. `_summary` and `_runs` hold folders of the same names.
    """
    numbers = _numbers(spark, path)
    fs, _ = _path(spark, path)
    states = [_load_pointer(spark, path, n).parts for n in numbers[-2:]]
    for n in numbers[:-2]:
        fs.delete(_path(spark, _pointer_file(path, n))[1], False)
    for root in (path.rstrip("/"), *[f"{path.rstrip('/')}/{side}" for side in ("_summary", "_runs")]):
        for part in partitions(spark, root, column) if among is None else among:
            named = {state[part] for state in states if part in state}
            for run in partitions(spark, f"{root}/{column}={part}", "run") - named:
                fs.delete(_path(spark, part_folder(root, column, part, run))[1], True)


def recover_partitions(spark: SparkSession, path: str, column: str = "month") -> None:
    """Clear away what runs that broke off have left. The table needs no recovery: its pointer is as it was."""
    fs, root = _path(spark, path)
    if not fs.exists(root):
        return
    for found in fs.listStatus(root):
        if found.getPath().getName().startswith("_incoming_"):
            fs.delete(found.getPath(), True)
    clean_parts(spark, path, column)


def _refuse_null_part(spark: SparkSession, parts: set[str], staging: str, column: str) -> None:
    if NULL_PART in parts:
        fs, staged = _path(spark, staging)
        fs.delete(staged, True)
        raise ValueError(f"rows without {column} can't be stored")


def write_missing_parts(df: DataFrame, path: str, part: str, order: list[str] = ()) -> list[str]:
    """Write only the parts the target lacks; a part on disk is final. Returns the new parts.

    `part` must be a column; existing parts are excluded by a filter on it, so a
    partitioned source is pruned before it is read. New parts are complete in a
    staging folder before each is moved in place, its files sorted by `order`. Rows without
    a part raise.
    """
    spark = df.sparkSession
    present = partitions(spark, path, part)
    known = F.col(part).cast("string").isin(*sorted(present))
    todo = df.filter(~F.coalesce(known, F.lit(False))) if present else df
    staging = f"{path.rstrip('/')}/_staging_{uuid.uuid4().hex}"
    todo.hint("rebalance", part).sortWithinPartitions(part, *order).write.partitionBy(part).parquet(staging)
    fresh = partitions(spark, staging, part)
    _refuse_null_part(spark, fresh, staging, part)
    fs, staged = _path(spark, staging)
    for value in sorted(fresh):
        _move(fs, _path(spark, f"{staging}/{part}={value}")[1], _path(spark, f"{path}/{part}={value}")[1])
    fs.delete(staged, True)
    return sorted(fresh)


def missing_parts(expected: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Expected parts that the table does not hold yet."""
    return expected.select(*keys).distinct().join(stored.select(*keys).distinct(), keys, "left_anti")


def feature(geometry_json: Column, properties: list[str]) -> Column:
    """One GeoJSON Feature as text; `geometry_json` is a JSON object as text."""
    props = F.to_json(F.struct(*properties), {"ignoreNullFields": "false"})
    return F.concat(
        F.lit('{"type":"Feature","properties":'), props, F.lit(',"geometry":'), F.coalesce(geometry_json, F.lit("null")), F.lit("}")
    )


def write_features(df: DataFrame, path: str, geometry: str, properties: list[str]) -> None:
    """One Feature per line (GeoJSON text sequence), written in parallel."""
    df.select(feature(F.col(geometry), properties).alias("value")).write.mode("overwrite").text(path)


def write_feature_collection(df: DataFrame, path: str, geometry: str, properties: list[str]) -> None:
    """One GeoJSON FeatureCollection file, an empty one for no rows.

    Features are printed in parallel, one per line, every line ending in a comma; the parts are
    then joined by streaming their bytes behind each other (the last without its comma). No row
    is gathered anywhere, and the file appears by one rename.
    """
    spark = df.sparkSession
    staging = f"{path.rstrip('/')}__staging_{uuid.uuid4().hex}"
    df.select(feature(F.col(geometry), properties).alias("value")).write.option("lineSep", ",\n").text(staging)
    fs, parts = _path(spark, staging)
    found = [s for s in fs.listStatus(parts) if s.getPath().getName().startswith("part-") and s.getLen() > 0]
    whole = _path(spark, f"{staging}/_whole")[1]
    copy = spark._jvm.org.apache.commons.io.IOUtils.copyLarge
    out = fs.create(whole, False)
    try:
        out.write(bytearray(b'{"type":"FeatureCollection","features":[\n'))
        for i, part in enumerate(found):
            stream = fs.open(part.getPath())
            try:
                copy(stream, out, 0, part.getLen() - (2 if i == len(found) - 1 else 0))
            finally:
                stream.close()
        out.write(bytearray(b"\n]}\n"))
    finally:
        out.close()
    target = _path(spark, path)[1]
    fs.delete(target, True)
    _move(fs, whole, target)
    fs.delete(parts, True)


def write_bucketed(df: DataFrame, table: str, keys: list[str], buckets: int, path: str | None = None) -> DataFrame:
    """Store `df` as a catalogue table in buckets of `keys`, sorted within; returns the stored table.

    Tables with equally many buckets of a join's keys are joined without a shuffle, as often as
    they are read. `buckets` is the parallelism of such joins: a few hundred MB each.
    """
    spark = df.sparkSession
    # one file per bucket: rows of a bucket meet in one task before they are written
    writer = df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return spark.table(table)
