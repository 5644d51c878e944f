"""Area selection, area joins, and counts per cell over point coordinates.

Coordinates are text in the marts; the operators cast them tolerantly, so a malformed value
drops out of the result instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.functions.values import EXACT_SUM_TYPE, exact_mean, finite, try_double

# The default study area, a rectangle of centre +/- range in degrees.
AREA_LAT = 53.3811
AREA_LNG = -1.4701
AREA_LAT_RANGE = 0.03
AREA_LNG_RANGE = 0.05

# Side of the finest cell of the area join in degrees; each level doubles it, and the last one
# is wider than the globe.
AREA_CELL = 0.01
AREA_LEVELS = 16

# Bits per axis of a place key.
PLACE_BITS = 24
# Masks of the bits kept at each step when a number's bits are spread out to every
# second place.
_SPREAD = [(16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)]


def _number(df: DataFrame, column: str) -> Column:
    """A coordinate column as a finite double or null, whether it is text or already numeric."""
    text = df.schema[column].dataType.typeName() == "string"
    return try_double(column) if text else finite(F.col(column))


def bbox_filter(
    df: DataFrame,
    lat_col: str,
    lon_col: str,
    lat: float = AREA_LAT,
    lng: float = AREA_LNG,
    lat_range: float = AREA_LAT_RANGE,
    lng_range: float = AREA_LNG_RANGE,
) -> DataFrame:
    """Rows whose point lies in the rectangle, edges included. A plain range predicate: a
    narrow stage with no shuffle, and pushed to the scan when the columns are numeric."""
    y, x = _number(df, lat_col), _number(df, lon_col)
    return df.where(y.between(lat - lat_range, lat + lat_range) & x.between(lng - lng_range, lng + lng_range))


def geo_grid(points: DataFrame, lat_col: str = "lat", lon_col: str = "lon", cell: float = 0.01) -> DataFrame:
    """Point counts per square grid cell of ``cell`` degrees, with the mean point of each cell.

    A hash aggregate on the cell indices: partial counts per task, one exchange of partial
    states, so a cell holding most points is no hotter than any other.
    """
    y, x = _number(points, lat_col), _number(points, lon_col)
    size = F.lit(float(cell))
    cells = points.select(
        F.floor(y / size).alias("cell_lat"), F.floor(x / size).alias("cell_lon"), y.alias("_y"), x.alias("_x")
    ).where(F.col("_y").isNotNull() & F.col("_x").isNotNull())
    return cells.groupBy("cell_lat", "cell_lon").agg(
        F.count(F.lit(1)).alias("points"),
        exact_mean(F.col("_y")).alias("center_lat"),
        exact_mean(F.col("_x")).alias("center_lon"),
    )


# --- many areas ---------------------------------------------------------------------------


def _cells(axis: Column, size: Column) -> Column:
    return F.floor(axis / size).cast("long")


def area_cells(areas: DataFrame) -> DataFrame:
    """``areas`` (with lat, lng, lat_range, lng_range: rectangles of centre +/- range) with their
    bounds and one row per grid cell they touch: level, cell_y, cell_x. An area takes the finest
    level whose cells are at least as wide as itself, so it touches at most four. Areas with a
    missing or negative range have no cells."""
    extent = 2 * F.greatest("lat_range", "lng_range")
    level = F.when(extent <= AREA_CELL, 0).otherwise(F.least(F.ceil(F.log2(extent / AREA_CELL)), F.lit(AREA_LEVELS)))
    bounded = (
        areas.where("lat_range >= 0 AND lng_range >= 0 AND lat IS NOT NULL AND lng IS NOT NULL")
        .withColumn("level", level.cast("int"))
        .withColumn("lat_min", F.col("lat") - F.col("lat_range"))
        .withColumn("lat_max", F.col("lat") + F.col("lat_range"))
        .withColumn("lng_min", F.col("lng") - F.col("lng_range"))
        .withColumn("lng_max", F.col("lng") + F.col("lng_range"))
        .withColumn("size", F.lit(AREA_CELL) * F.pow(F.lit(2.0), F.col("level")))
    )
    size = F.col("size")
    return (
        bounded.withColumn("cell_y", F.explode(F.sequence(_cells(F.col("lat_min"), size), _cells(F.col("lat_max"), size))))
        .withColumn("cell_x", F.explode(F.sequence(_cells(F.col("lng_min"), size), _cells(F.col("lng_max"), size))))
        .drop("size")
    )


def areas_join(points: DataFrame, areas: DataFrame, lat_col: str, lon_col: str, name: str = "area") -> DataFrame:
    """Every point with every area (column ``name`` of ``areas``) whose rectangle holds it, edges
    included; areas may overlap.

    A range join as an equi join: areas are dealt to the grid cells of one level each, points to
    their cell of every level in use (at most 17, found by a scalar subquery over the areas), and the
    rectangle is tested on pairs that share a cell. A pair shares one cell only, so none is repeated.
    A cell that holds a third of all points is one key of a shuffled join, which AQE splits; small
    area tables are broadcast by the planner under its size limit."""
    cells = area_cells(areas).select(name, "level", "cell_y", "cell_x", "lat_min", "lat_max", "lng_min", "lng_max")
    levels = cells.agg(F.sort_array(F.collect_set("level")).alias("levels")).scalar()
    size = F.lit(AREA_CELL) * F.pow(F.lit(2.0), F.col("level"))
    kept = points.columns
    placed = (
        points.withColumn("_y", _number(points, lat_col))
        .withColumn("_x", _number(points, lon_col))
        .where("_y IS NOT NULL AND _x IS NOT NULL")
        .withColumn("level", F.explode(levels))
        .withColumn("cell_y", _cells(F.col("_y"), size))
        .withColumn("cell_x", _cells(F.col("_x"), size))
    )
    inside = F.col("_y").between(F.col("lat_min"), F.col("lat_max")) & F.col("_x").between(F.col("lng_min"), F.col("lng_max"))
    return placed.join(cells, ["level", "cell_y", "cell_x"]).where(inside).select(name, *kept)


# --- place keys ---------------------------------------------------------------------------


def _spread(value: Column) -> Column:
    for shift, mask in _SPREAD:
        value = value.bitwiseOR(F.shiftleft(value, shift)).bitwiseAND(F.lit(mask))
    return value


def place_key(lat: Column, lon: Column, bits: int = PLACE_BITS) -> Column:
    """Morton key of a point: the bits of its row and column on a grid of 2**bits by 2**bits cells
    over the globe, taken in turn. Points with a common prefix of 2 * z bits share a cell of zoom z."""
    n = float(1 << bits)
    axis = lambda v, low, span: F.least(F.greatest(F.floor((v - low) / span * n), F.lit(0)), F.lit((1 << bits) - 1)).cast("long")
    return F.shiftleft(_spread(axis(lat, -90.0, 180.0)), 1).bitwiseOR(_spread(axis(lon, -180.0, 360.0)))


def geo_clusters(points: DataFrame, zooms: tuple[int, ...], lat_col: str = "lat", lon_col: str = "lon") -> DataFrame:
    """Points per cell (zoom, cell, points, center_lat, center_lon) at all ``zooms`` in one pass.

    Points are first counted in the cells of the deepest zoom, by partial aggregates; only those
    counts are grouped again, by the key prefixes of every zoom (grouping sets)."""
    deepest = max(zooms)
    y, x = _number(points, lat_col), _number(points, lon_col)
    exact = lambda c: F.sum(F.col(c).try_cast(EXACT_SUM_TYPE))
    finest = (
        points.select(y.alias("_y"), x.alias("_x"))
        .where("_y IS NOT NULL AND _x IS NOT NULL")
        .groupBy(place_key(F.col("_y"), F.col("_x"), deepest).alias("key"))
        .agg(F.count(F.lit(1)).alias("n"), exact("_y").alias("sum_y"), exact("_x").alias("sum_x"))
    )
    names = [f"z{z}" for z in zooms]
    keyed = finest.select("*", *(F.shiftright("key", 2 * (deepest - z)).alias(c) for z, c in zip(zooms, names, strict=True)))
    sets = [[F.col(c)] for c in names]
    zoom = F.coalesce(*(F.when(F.grouping(c) == 0, F.lit(z)) for z, c in zip(zooms, names, strict=True)))
    return (
        keyed.groupingSets(sets, *names)
        .agg(
            zoom.alias("zoom"),
            F.sum("n").alias("points"),
            (F.sum("sum_y").cast("double") / F.sum("n").cast("double")).alias("center_lat"),
            (F.sum("sum_x").cast("double") / F.sum("n").cast("double")).alias("center_lon"),
        )
        .select("zoom", F.coalesce(*names).alias("cell"), "points", "center_lat", "center_lon")
    )
