"""Load whatever has newly landed in a folder, then stop.

Spark's own checkpoint records which files are done, so each run reads only new
ones; the merge is the one the batch loads use, and since it is last-write-wins a
batch that is replayed after a failure changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..plans.incremental import PartitionedTable


def start_landing(
    spark: SparkSession, folder: str, schema: T.StructType, table: PartitionedTable, checkpoint: str,
    parse: Callable[[DataFrame], DataFrame] = lambda df: df, format: str = "parquet", arrival: str | None = None,
    trim: str | None = None, prefer_non_null: list[str] = (), max_files: int | None = None, **options: str,
) -> StreamingQuery:
    """Merge all files that have landed since the last run into `table` (available-now trigger).

    `checkpoint` must lie on storage all executors share. `max_files` bounds one
    micro-batch, so a long backlog is worked off in steps.
    """
    reader = spark.readStream.format(format).schema(schema).options(**options)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def merge(batch: DataFrame, _batch_id: int) -> None:
        table.merge(parse(batch), arrival, trim, prefer_non_null)

    return (
        reader.load(folder)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
