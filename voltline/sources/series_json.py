"""Block-wise JSON series: `{"series": [[epoch_ms, value], ...]}` per file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timeutil import epoch_millis_to_utc
from ..operators.dedup import keep_last


def parse_blocks(blocks: DataFrame) -> DataFrame:
    """`(name, block_ts, series)` -> `(series, ts, value)`.

    NULL values are dropped; a time stamp that two blocks carry keeps the value of
    the later block, and within one block the later point.
    """
    points = blocks.select("name", "block_ts", F.posexplode("series").alias("_pos", "_point"))
    # One sortable number for "later": block start (ms, 13 digits), then position.
    arrival = F.col("block_ts").cast("decimal(19,0)") * F.lit(10**9).cast("decimal(10,0)") + F.col("_pos")
    rows = points.select(
        F.col("name").alias("series"),
        epoch_millis_to_utc(F.get("_point", F.lit(0)).cast("bigint")).alias("ts"),
        F.get("_point", F.lit(1)).alias("value"),
        arrival.alias("_arrival"),
    )
    return keep_last(rows.filter(F.col("value").isNotNull()), ["series", "ts"], "_arrival").drop("_arrival")


def prune_blocks(listing: DataFrame, starts: DataFrame) -> DataFrame:
    """Blocks needed to continue each series (`name`) from its `start_ms`.

    The block that contains the start is the last one beginning at or before it;
    it and all later blocks stay. If no block begins early enough, all stay; a
    series without a start keeps all of its blocks.
    """
    in_reach = F.when(F.col("block_ts") <= F.col("start_ms"), F.col("block_ts"))
    floors = (
        listing.join(starts, "name", "left")
        .groupBy("name")
        .agg(F.coalesce(F.max(in_reach), F.min("block_ts")).alias("_from"))
    )
    return listing.join(floors, "name").filter(F.col("block_ts") >= F.col("_from")).select(*listing.columns)


def read_blocks(spark: SparkSession, root: str, from_block: Column | int | None = None, only: Column | None = None, blocks: DataFrame | None = None) -> DataFrame:
    """Read landed blocks from `root/name=<series>/block_ts=<ms>/*.json`.

    `name` and `block_ts` are partition columns, so `from_block` or any other
    condition `only` on them skips folders without opening them. `blocks` lists the
    wanted ones as `(name, block_ts)` and is joined on them, so that Spark prunes
    folders by it at run time.
    """
    landed = (
        spark.read.schema("series ARRAY<ARRAY<DOUBLE>>, name STRING, block_ts BIGINT")
        .option("multiLine", True)
        .json(root)
    )
    if from_block is not None:
        landed = landed.filter(F.col("block_ts") >= from_block)
    if only is not None:
        landed = landed.filter(only)
    if blocks is not None:
        landed = landed.join(blocks.select("name", "block_ts").distinct(), ["name", "block_ts"], "left_semi")
    return parse_blocks(landed)
