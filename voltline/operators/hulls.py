"""Convex hulls of point groups, in stages that never gather a whole group.

Built-in aggregates find each group's extreme points in some directions. They are
vertices of the hull and span a polygon that holds nearly all other points, which are
dropped by built-in expressions. What lies outside is beyond one edge of the polygon, and
the hull between that edge's ends is made of such points alone: every edge is a group of
its own. Only these few points reach Python, which reduces them to chains batch by batch,
then in buckets, then per edge.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Ship the functions below with the job: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Directions of the extreme points: polygons of so many corners hold 97 % of a disk.
DIRECTIONS = 16
_EDGE = "region STRING, edge INT, ax DOUBLE, ay DOUBLE, bx DOUBLE, by DOUBLE, x DOUBLE, y DOUBLE"


def hull_vertices(points: np.ndarray) -> np.ndarray:
    """Vertices counter-clockwise from the lowest x; collinear inner points are left out."""
    points = np.unique(points, axis=0)
    if len(points) <= 2:
        return points

    def half(ordered: list[list[float]]) -> list[list[float]]:
        chain: list[list[float]] = []
        for x, y in ordered:
            while len(chain) > 1:
                (ax, ay), (bx, by) = chain[-2], chain[-1]
                if (bx - ax) * (y - ay) - (by - ay) * (x - ax) > 0:
                    break
                chain.pop()
            chain.append([x, y])
        return chain[:-1]

    ordered = points.tolist()
    return np.array(half(ordered) + half(ordered[::-1]))


def _chains(rows: pd.DataFrame) -> pd.DataFrame:
    """Of each edge's points those on the hull of points and edge; the edge's ends are known anyway."""
    out = []
    for (_, _), some in rows.groupby(["region", "edge"], sort=False):
        ends = some[["ax", "ay", "bx", "by"]].iloc[0].to_numpy(float).reshape(2, 2)
        corners = {tuple(v) for v in hull_vertices(np.vstack([some[["x", "y"]].to_numpy(float), ends])).tolist()} - {tuple(e) for e in ends.tolist()}
        kept = [p in corners for p in zip(some["x"].tolist(), some["y"].tolist(), strict=True)]
        out.append(some[kept].drop_duplicates(["x", "y"]))
    return pd.concat(out) if out else rows


def _batch_chains(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield _chains(batch)


def _final_hull(rows: pd.DataFrame) -> pd.DataFrame:
    """Corners and chains of one region, a few points per edge, as its hull."""
    return _shape(rows["region"].iloc[0], hull_vertices(rows[["x", "y"]].to_numpy(dtype=float)).tolist())


def _number(value: float) -> str:
    return repr(float(value)).removesuffix(".0")


def _shape(region: str, vertices: list[list[float]]) -> pd.DataFrame:
    if len(vertices) == 1:
        kind, ring = "Point", vertices
    elif len(vertices) == 2:
        kind, ring = "LineString", vertices
    else:
        kind, ring = "Polygon", vertices + vertices[:1]
    text = ", ".join(f"{_number(x)} {_number(y)}" for x, y in ring)
    pairs = ",".join(f"[{_number(x)},{_number(y)}]" for x, y in ring)
    wkt = {"Point": f"POINT ({text})", "LineString": f"LINESTRING ({text})", "Polygon": f"POLYGON (({text}))"}[kind]
    coordinates = {"Point": pairs, "LineString": f"[{pairs}]", "Polygon": f"[[{pairs}]]"}[kind]
    return pd.DataFrame(
        {
            "region": [region],
            "vertex_count": [len(vertices)],
            "wkt": [wkt],
            "geojson": [f'{{"type":"{kind}","coordinates":{coordinates}}}'],
        }
    )


def corners(points: DataFrame) -> DataFrame:
    """`(region, corners)`: the extreme points of each region in all directions, counter-clockwise; points: region, x, y."""
    found = []
    for i in range(DIRECTIONS):
        angle = 2 * math.pi * i / DIRECTIONS
        reach = F.col("x") * math.cos(angle) + F.col("y") * math.sin(angle)
        # two aggregates over the same order: both take the same row
        found.append(F.struct(F.max_by("x", reach).alias("x"), F.max_by("y", reach).alias("y")))
    return points.groupBy("region").agg(F.array(*found).alias("corners"))


def outside_corners(points: DataFrame, found: DataFrame) -> DataFrame:
    """Points that are not surely inside the polygon of their region's corners, with the edge each one is beyond (the first, if any)."""
    edges = F.filter(
        F.zip_with(
            F.sequence(F.lit(0), F.lit(DIRECTIONS - 1)), "corners",
            lambda i, a: F.struct(i.alias("edge"), a["x"].alias("ax"), a["y"].alias("ay"), F.get("corners", F.pmod(i + 1, F.lit(DIRECTIONS)))["x"].alias("bx"), F.get("corners", F.pmod(i + 1, F.lit(DIRECTIONS)))["y"].alias("by")),
        ),
        lambda e: (e["ax"] != e["bx"]) | (e["ay"] != e["by"]),
    )
    polygons = found.select("region", edges.alias("_edges"))

    def turn(e: Column) -> Column:
        """Twice the area left of the edge and up to the point; what rounding may have changed counts as outside."""
        u, v = (e["bx"] - e["ax"]) * (F.col("y") - e["ay"]), (e["by"] - e["ay"]) * (F.col("x") - e["ax"])
        return (u - v) - (F.abs(u) + F.abs(v)) * 1e-12

    def on(e: Column) -> Column:
        """Exactly on the edge: no vertex of the hull."""
        u, v = (e["bx"] - e["ax"]) * (F.col("y") - e["ay"]), (e["by"] - e["ay"]) * (F.col("x") - e["ax"])
        return (u == v) & F.col("x").between(F.least(e["ax"], e["bx"]), F.greatest(e["ax"], e["bx"])) & F.col("y").between(F.least(e["ay"], e["by"]), F.greatest(e["ay"], e["by"]))

    beyond = F.filter("_edges", lambda e: turn(e) <= 0)
    return (
        points.join(polygons, "region").withColumn("_beyond", beyond)
        .filter((F.size("_beyond") > 0) & ~F.exists("_edges", on))
        # beyond several edges only by rounding, or by little: the one it is furthest beyond
        .select("region", "x", "y", F.array_sort(F.transform("_beyond", lambda e: F.struct(turn(e).alias("t"), e.alias("e"))))[0]["e"].alias("_edge"))
        .select("region", "_edge.*", "x", "y")
    )


def footprint_hulls(points: DataFrame, region: str, x: str, y: str, capacity: str, fan_in: int = 64) -> DataFrame:
    """Per region: hull (WKT and GeoJSON), vertex count, capacity sum and number of points."""
    located = points.filter(F.col(region).isNotNull() & F.col(x).isNotNull() & F.col(y).isNotNull())
    coordinates = located.select(
        F.col(region).cast("string").alias("region"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")
    )
    found = corners(coordinates)
    partial = outside_corners(coordinates, found).mapInPandas(_batch_chains, _EDGE).withColumn("_bucket", F.spark_partition_id() % fan_in)
    merged = partial.groupBy("region", "edge", "_bucket").applyInPandas(lambda rows: _chains(rows.drop(columns="_bucket")), _EDGE)
    chains = merged.groupBy("region", "edge").applyInPandas(_chains, _EDGE)
    vertices = chains.select("region", "x", "y").unionByName(found.select("region", F.inline("corners")))
    hulls = vertices.groupBy("region").applyInPandas(_final_hull, "region STRING, vertex_count BIGINT, wkt STRING, geojson STRING")
    totals = located.groupBy(F.col(region).cast("string").alias("region")).agg(
        F.sum(capacity).alias("capacity_mw"), F.count("*").alias("unit_count")
    )
    return totals.join(hulls, "region")
