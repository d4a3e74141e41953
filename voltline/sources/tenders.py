"""Capacity tender tables: one row per product and delivery day.

Block columns (`00_04` ...) are German wall clock; `delivery_block_hours` turns
them into UTC hours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..functions.timeutil import lenient_date, ntz
from ..functions.values import per_block_to_per_hour
from ..operators.dedup import keep_first, keep_last
from ..operators.reshape import pivot_strict
from .lines import field, read_lines

BERLIN = "Europe/Berlin"
FCR_COLUMNS = [f"negpos_{b}" for b in fixed.BLOCKS]
AFRR_COLUMNS = [f"{direction}_{b}" for direction in ("neg", "pos") for b in fixed.BLOCKS]


def _day() -> Column:
    return lenient_date(F.col("DATE_FROM")).alias("delivery_date")


def _number(column: str) -> Column:
    return F.col(f"`{column}`").try_cast("double")


def fcr_prices(raw: DataFrame) -> DataFrame:
    """Long FCR prices of tender 1 in EUR/MW/h; tables of the old one-day product are empty.

    The table must have one of the known price columns; the newer name goes first.
    """
    column = next((c for c in fixed.FCR_PRICE_COLUMNS if c in raw.columns), None)
    if column is None:
        raise ValueError(f"no known FCR price column among {raw.columns}")
    return _fcr(raw if "file" in raw.columns else raw.withColumn("file", F.lit("")), per_block_to_per_hour(_number(column)))


def _fcr(raw: DataFrame, price: Column) -> DataFrame:
    tender = raw.filter(F.col("TENDER_NUMBER").try_cast("int") == 1)
    with_blocks = tender.filter(F.col("PRODUCTNAME") == "NEGPOS_00_04").select("file").distinct()
    return tender.join(with_blocks, "file", "left_semi").select("file", _day(), F.lower("PRODUCTNAME").alias("block"), price.alias("price"))


def afrr_prices(raw: DataFrame) -> DataFrame:
    """Long aFRR prices in EUR/MW/h, whichever of the two units the table uses."""
    if fixed.AFRR_PRICE_PER_HOUR in raw.columns:
        price = _number(fixed.AFRR_PRICE_PER_HOUR)
    elif fixed.AFRR_PRICE_PER_BLOCK in raw.columns:
        price = per_block_to_per_hour(_number(fixed.AFRR_PRICE_PER_BLOCK))
    else:
        raise ValueError(f"no known aFRR price column among {raw.columns}")
    return _afrr(raw if "file" in raw.columns else raw.withColumn("file", F.lit("")), price)


def _afrr(raw: DataFrame, price: Column) -> DataFrame:
    return raw.select("file", _day(), F.lower("PRODUCT").alias("block"), price.alias("price"))


def block_table(prices: DataFrame, columns: list[str]) -> DataFrame:
    """Day x block table; a duplicate cell within one file raises, a later file wins a whole day."""
    wide = pivot_strict(prices, ["file", "delivery_date"], "block", columns, "price")
    return keep_last(wide, ["delivery_date"], ["file"]).drop("file")


#: Columns of a landed table that can be read; further ones are not looked at.
_MOST_COLUMNS = 64


def _tables(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Rows of CSV tables with different columns, in one scan: file (its name), fields, and the header of their file."""
    names = [f"c{i}" for i in range(_MOST_COLUMNS)]
    cells = F.from_csv("value", F.lit(", ".join(f"{n} STRING" for n in names)))
    parsed = read_lines(spark, paths).select("file", "pos", cells.alias("c")).select("file", "pos", F.array(*[F.col(f"c.{n}") for n in names]).alias("fields"))
    headers = parsed.groupBy("file").agg(F.min_by("fields", "pos").alias("header"), F.min("pos").alias("_first"))
    body = parsed.join(headers, "file").filter(F.col("pos") > F.col("_first"))
    return body.select(F.regexp_extract("file", "[^/]*$", 0).alias("file"), "fields", F.transform("header", lambda h: F.trim(h)).alias("header"))


def _first_of(prices: dict[str, Column], product: str) -> Column:
    """The price under the first column name that the row's table has; a table with none raises."""
    column = F.raise_error(F.concat(F.lit(f"no known {product} price column in "), F.col("file"))).cast("double")
    for name, price in reversed(prices.items()):
        column = F.when(F.array_contains("header", name), price).otherwise(column)
    return column


def read_tenders(spark: SparkSession, paths: list[str], product: str) -> DataFrame:
    """Landed CSV tables of `product` ("FCR" or "aFRR"), whatever columns each has.

    All files are read in one scan; a field's place follows from the header line of its own
    file, which is joined on the file. File names carry the date range and so order them.
    """
    columns = {"FCR": FCR_COLUMNS, "aFRR": AFRR_COLUMNS}[product]
    if not paths:
        return spark.createDataFrame([], ", ".join(["delivery_date DATE", *[f"{c} DOUBLE" for c in columns]]))
    tables = _tables(spark, list(dict.fromkeys(paths)))

    def number(name: str) -> Column:
        return field(name).try_cast("double")

    if product == "FCR":
        price = _first_of({n: per_block_to_per_hour(number(n)) for n in fixed.FCR_PRICE_COLUMNS}, product)
        prices = _fcr(tables.select("file", *[field(n).alias(n) for n in ("DATE_FROM", "TENDER_NUMBER", "PRODUCTNAME")], price.alias("_price")), F.col("_price"))
    else:
        price = _first_of({fixed.AFRR_PRICE_PER_HOUR: number(fixed.AFRR_PRICE_PER_HOUR), fixed.AFRR_PRICE_PER_BLOCK: per_block_to_per_hour(number(fixed.AFRR_PRICE_PER_BLOCK))}, product)
        prices = _afrr(tables.select("file", *[field(n).alias(n) for n in ("DATE_FROM", "PRODUCT")], price.alias("_price")), F.col("_price"))
    return block_table(prices, columns)


def latest_files(listing: DataFrame) -> DataFrame:
    """Monthly result files, each once, by date range: `(file_name, date_range, ...)`."""
    columns = [c for c in listing.columns if c not in ("file_name", "date_range")]
    return keep_first(listing, ["file_name"], ["date_range", *columns]).orderBy("date_range", "file_name")


def delivery_block_hours(prices: DataFrame, zone: str = BERLIN) -> DataFrame:
    """Long block prices -> real UTC hours.

    `block` ends in `_hh_hh`. Block edges are never ambiguous local times, so the
    zone rules apply; on clock-change days a block has 3 or 5 hours.
    """
    edges = F.split(F.regexp_extract("block", r"(\d\d_\d\d)$", 1), "_")
    midnight = F.col("delivery_date").cast("timestamp_ntz")

    def utc(i: int) -> Column:
        local = midnight + F.make_dt_interval(F.lit(0), F.element_at(edges, i).cast("int"))
        return F.convert_timezone(F.lit(zone), F.lit("UTC"), local)

    hours = F.sequence(utc(1), utc(2) - F.expr("INTERVAL 1 HOUR"), F.expr("INTERVAL 1 HOUR"))
    return prices.select("delivery_date", "block", F.explode(hours).alias("ts"), "price")


def in_days(df: DataFrame, first: str, last: str, day: str = "delivery_date") -> DataFrame:
    """Both ends included."""
    return df.filter(F.col(day).between(ntz(first).cast("date"), ntz(last).cast("date")))
