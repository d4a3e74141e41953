"""Text files as rows that remember where they came from.

Every line carries `file` and `pos`, and `pos` grows along the file, so rules such
as "after the header" and "first occurrence wins" hold however Spark splits and
schedules the files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


BOM = "﻿"


def read_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """`(file, pos, value)`, without byte order marks and without empty lines."""
    return (
        spark.read.text(paths)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.struct(F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("row")).alias("pos"),
            F.regexp_replace("value", f"^{BOM}", "").alias("value"),
        )
        .filter(F.trim("value") != "")
    )


def split_fields(line: Column | str, separator: str) -> Column:
    """Fields of a line without quoting; blank trailing fields are kept."""
    return F.split(line, f"\\{separator}" if separator in ".|+*?" else separator, -1)


def header_rows(lines: DataFrame, marker: str, separator: str = ",") -> DataFrame:
    """Per file: position and column names of the first line starting with `marker`."""
    first = (
        lines.filter(F.col("value").startswith(marker))
        .groupBy("file")
        .agg(F.min_by("value", "pos").alias("_line"), F.min("pos").alias("header_pos"))
    )
    names = F.transform(split_fields("_line", separator), lambda c: F.trim(F.regexp_replace(c, "^[# ]+", "")))
    return first.select("file", "header_pos", names.alias("header"))


def body_with_header(lines: DataFrame, marker: str, separator: str = ",") -> DataFrame:
    """Lines after their file's header, split, each with the header's column names.

    One small row per file is joined on the file name. A file without a header
    raises instead of vanishing.
    """
    headers = header_rows(lines, marker, separator)
    joined = lines.join(headers, "file", "left")
    missing = F.raise_error(F.concat(F.lit("no header line in "), F.col("file"))).cast("boolean")
    return joined.filter(F.when(F.col("header").isNull(), missing).otherwise(F.col("pos") > F.col("header_pos"))).select(
        "file", "pos", "header", split_fields("value", separator).alias("fields")
    )


def field(name: str) -> Column:
    """The field under header `name`; NULL if the file has no such column."""
    at = F.array_position("header", name)
    return F.when(at > 0, F.nullif(F.trim(F.get("fields", (at - 1).cast("int"))), F.lit("")))


def files_not_starting_with(lines: DataFrame, prefix: str) -> DataFrame:
    """Files whose first line does not begin with `prefix` (an error page, a changed layout)."""
    firsts = lines.groupBy("file").agg(F.min_by("value", "pos").alias("first_line"))
    return firsts.filter(~F.ltrim("first_line").startswith(prefix))


def require_first_line(lines: DataFrame, prefix: str) -> None:
    """Raise before anything is loaded if a file has an unexpected first line."""
    bad = files_not_starting_with(lines, prefix).limit(3).collect()
    if bad:
        raise ValueError("unexpected content: " + "; ".join(f"{r['file']}: {r['first_line'][:80]!r}" for r in bad))
