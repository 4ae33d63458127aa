"""Regions as polygons over a grid of cells: which cells a polygon covers, and by how much."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _corners(regions: DataFrame) -> DataFrame:
    ring = F.transform("ring", lambda p: F.struct(p["y"].cast("double").alias("y"), p["x"].cast("double").alias("x")))
    return regions.where(F.size("ring") > 2).select("region", ring.alias("ring"))


def edges(regions: DataFrame) -> DataFrame:
    """region, y1, x1, y2, x2 of each edge of a ring that isn't level; the last corner is tied to the first."""
    pairs = F.transform("ring", lambda p, i: F.struct(p.alias("p"), F.get("ring", (i + 1) % F.size("ring")).alias("q")))
    rows = _corners(regions).select("region", F.explode(pairs).alias("e"))
    return rows.select("region", F.col("e.p.y").alias("y1"), F.col("e.p.x").alias("x1"), F.col("e.q.y").alias("y2"), F.col("e.q.x").alias("x2")).where("y1 <> y2")


def cell_cover(regions: DataFrame, resolution: float) -> DataFrame:
    """region, row and col of each cell that a region's box touches; cell (r, c) spans [r, r+1] x [c, c+1] times `resolution`.

    Rows of cells are dealt out before they are cut into cells, so that one wide region is many tasks' work.
    """
    of = lambda c: F.transform("ring", lambda p: p[c])
    low = lambda c: F.floor(F.array_min(of(c)) / resolution).cast("int")
    high = lambda c: F.greatest(F.ceil(F.array_max(of(c)) / resolution).cast("int") - 1, low(c))
    strips = _corners(regions).select("region", low("x").alias("west"), high("x").alias("east"), F.explode(F.sequence(low("y"), high("y"))).alias("row"))
    return strips.repartition("region", "row").select("region", "row", F.explode(F.sequence("west", "east")).alias("col"))


def cell_weights(regions: DataFrame, resolution: float) -> DataFrame:
    """region, row, col, area and weight of each cell that a region covers in part: the area in it, and its share of the region.

    `regions` has region and ring, an array of (y, x) corners (latitude and longitude, in degrees of a plane), in either
    sense, closed or not, convex or not, but without crossings; a region across longitude 180 is given with longitudes
    beyond it. Rings of fewer than three corners, or without area, give no row. The weights of a region sum to 1.

    By Green's theorem the area within a cell is the sum over edges, each cut to the cell's range of y, of the integral of
    x, held within the cell, by dy. So an edge meets the cells of the rows it crosses, in one join by (region, row).
    """
    r = F.lit(float(resolution))
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    crossed = edges(regions).withColumn("row", F.explode(F.sequence(F.floor(low / r).cast("int"), F.greatest(F.ceil(high / r).cast("int") - 1, F.floor(low / r).cast("int")))))
    both = cell_cover(regions, resolution).join(crossed, ["region", "row"])
    at = lambda y: F.col("x1") + (F.col("x2") - F.col("x1")) * (y - F.col("y1")) / (F.col("y2") - F.col("y1"))
    from_, to = F.greatest(low, F.col("row") * r), F.least(high, (F.col("row") + 1) * r)
    west = F.col("col") * r
    cut = both.select("region", "row", "col", (F.greatest(to - from_, F.lit(0.0)) * F.signum(F.col("y2") - F.col("y1"))).alias("dy"), (at(from_) - west).alias("a"), (at(to) - west).alias("b"))
    # The antiderivative of x held within [0, r]; nearly upright edges take the middle.
    whole = lambda u: F.when(F.col(u) < 0, 0.0).when(F.col(u) > r, r * F.col(u) - r * r / 2).otherwise(F.col(u) * F.col(u) / 2)
    mean = F.when(F.abs(F.col("b") - F.col("a")) < 1e-7 * r, F.greatest(F.lit(0.0), F.least(r, (F.col("a") + F.col("b")) / 2))).otherwise((whole("b") - whole("a")) / F.nullif(F.col("b") - F.col("a"), F.lit(0.0)))
    areas = cut.groupBy("region", "row", "col").agg(F.abs(F.sum(mean * F.col("dy"))).alias("area")).where(F.col("area") > 1e-12 * r * r)
    total = areas.groupBy("region").agg(F.sum("area").alias("total"))
    return areas.join(total, "region").select("region", "row", "col", "area", (F.col("area") / F.col("total")).alias("weight"))
