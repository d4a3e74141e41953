"""Nearest of some fixed places, found through a grid of cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Width of the finest cells, in degrees; each level doubles it.
CELL = 0.25
#: At the top level the nine cells around any position hold all positions.
LEVELS = 12
_REACH = CELL * (1 << LEVELS) / 2


def _cell(value: str | Column) -> Column:
    return F.floor((F.col(value) if isinstance(value, str) else value).cast("double") / CELL)


def _at_level(cell: str, level: str) -> Column:
    return F.expr(f"shiftright({cell}, {level})")


def _around(cells: DataFrame) -> DataFrame:
    """Each row nine times, with `_y` and `_x` of its own and the neighbouring cells."""
    steps = F.array(*[F.lit(i) for i in (-1, 0, 1)])
    return (
        cells.withColumn("_dy", F.explode(steps)).withColumn("_dx", F.explode(steps))
        .withColumn("_y", F.col("_y") + F.col("_dy")).withColumn("_x", F.col("_x") + F.col("_dx")).drop("_dy", "_dx")
    )


def nearest_place(
    points: DataFrame, places: DataFrame, place: str, latitude: str, longitude: str, place_latitude: str, place_longitude: str,
) -> DataFrame:
    """All columns of `points`, then `place`: the nearest one by squared degree distance, ties to the smallest.

    Points are never compared with all places. Each cell that holds points looks for the finest
    level at which the nine cells around it hold a place; that place is at most 2.83 cells away,
    so the nearest one is in the nine cells two levels up. Of those only places that can be
    nearest to some point of the cell stay (none is nearer to its far corner than they are to
    its near edge), and the cell's points compare these few. All steps are equi-joins on cell
    numbers; the work in between is per cell that holds points, not per point.

    Points without a position, or further out than 512 degrees, get NULL, as do all if there are
    no places. Places without a position or further out are left out.
    """
    home = places.filter(F.col(place_latitude).between(-_REACH, _REACH) & F.col(place_longitude).between(-_REACH, _REACH)).select(
        F.col(place).alias("_place"), F.col(place_latitude).cast("double").alias("_lat"), F.col(place_longitude).cast("double").alias("_lon"),
        _cell(place_latitude).alias("_y0"), _cell(place_longitude).alias("_x0"), F.explode(F.sequence(F.lit(0), F.lit(LEVELS))).alias("_level"),
    ).withColumn("_y", _at_level("_y0", "_level")).withColumn("_x", _at_level("_x0", "_level"))
    located = F.col(latitude).between(-_REACH, _REACH) & F.col(longitude).between(-_REACH, _REACH)
    own_y, own_x = F.when(located, _cell(latitude)), F.when(located, _cell(longitude))
    cells = points.select(own_y.alias("_y0"), own_x.alias("_x0")).filter("_y0 IS NOT NULL").distinct()
    occupied = _around(home.select("_level", "_y", "_x").distinct()).select("_level", "_y", "_x").distinct()
    levels = cells.withColumn("_level", F.explode(F.sequence(F.lit(0), F.lit(LEVELS))))
    finest = (
        levels.withColumn("_y", _at_level("_y0", "_level")).withColumn("_x", _at_level("_x0", "_level"))
        .join(occupied, ["_level", "_y", "_x"], "left_semi").groupBy("_y0", "_x0").agg(F.least(F.min("_level") + 2, F.lit(LEVELS)).alias("_level"))
    )
    blocks = _around(finest.withColumn("_y", _at_level("_y0", "_level")).withColumn("_x", _at_level("_x0", "_level")))
    near, far = [], []
    for cell, where in (("_y0", "_lat"), ("_x0", "_lon")):
        low = F.col(cell) * CELL
        near.append(F.greatest(low - F.col(where), F.col(where) - low - CELL, F.lit(0.0)))
        far.append(F.greatest(F.abs(F.col(where) - low), F.abs(F.col(where) - low - CELL)))
    pairs = blocks.join(home.select("_level", "_y", "_x", "_place", "_lat", "_lon"), ["_level", "_y", "_x"]).select(
        "_y0", "_x0", "_place", "_lat", "_lon", sum(n * n for n in near).alias("_near"), sum(f * f for f in far).alias("_far"))
    # rounding must not cost a place: the bound is a little wide
    bound = F.min("_far").over(Window.partitionBy("_y0", "_x0")) * (1 + 1e-9) + 1e-12
    rivals = pairs.withColumn("_bound", bound).filter("_near <= _bound").groupBy("_y0", "_x0").agg(
        F.array_sort(F.collect_list(F.struct("_place", "_lat", "_lon"))).alias("_rivals"))

    def distance(r: Column) -> Column:
        north, east = F.col(latitude).cast("double") - r["_lat"], F.col(longitude).cast("double") - r["_lon"]
        return north * north + east * east

    # distances as plain doubles, then the position of the first smallest one: rivals are in order of place
    first = F.array_position("_distances", F.array_min("_distances")).cast("int") - 1
    return (
        points.withColumn("_y0", own_y).withColumn("_x0", own_x).join(rivals, ["_y0", "_x0"], "left")
        .withColumn("_distances", F.transform("_rivals", distance))
        .select(*points.columns, F.get("_rivals", first)["_place"].alias(place))
    )
