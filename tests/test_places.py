"""Many areas, place keys, and counts per zoom."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

import __spark_entry__ as E
from blotter.operators import geo
from tests.conftest import SMOKE_DIR

AREAS = "area string, lat double, lng double, lat_range double, lng_range double, level int"


def _expected(points, areas):
    return sorted(
        (name, i)
        for i, y, x in points
        for name, lat, lng, dy, dx in areas
        if y != "north" and None not in (y, x, lat, lng, dy, dx) and min(dy, dx) >= 0 and lat - dy <= float(y) <= lat + dy and lng - dx <= float(x) <= lng + dx
    )


def _joined(spark, points, areas):
    p = spark.createDataFrame([(i, y, x, 7) for i, y, x in points], "id long, y string, x string, cell_y int")
    a = spark.createDataFrame([(*r, 1) for r in areas], AREAS)
    return geo.areas_join(p.drop("cell_y"), a, "y", "x")


def test_areas_of_all_sizes_equal_brute_force(spark):
    rng = random.Random(3)
    points = [(k, f"{rng.uniform(-90, 90):.3f}", f"{rng.uniform(-180, 180):.3f}") for k in range(300)]
    points += [(1000 + k, f"{53 + rng.randrange(100) / 1000}", f"{-1 - rng.randrange(100) / 1000}") for k in range(300)]
    points += [(2000, None, "1"), (2001, "north", "1"), (2002, "0", "0"), (2003, "0", "0"), (2004, "90", "180")]
    areas = [(f"a{k}", 53.05 + rng.uniform(-0.1, 0.1), -1.05 + rng.uniform(-0.1, 0.1), 10 ** rng.uniform(-4, 0), 10 ** rng.uniform(-4, 0)) for k in range(40)]
    areas += [("globe", 0.0, 0.0, 90.0, 180.0), ("north", 45.0, 0.0, 45.0, 180.0), ("dot", 0.0, 0.0, 0.0, 0.0), ("strip", 53.0, 0.0, 0.01, 180.0),
              ("none", None, 0.0, 1.0, 1.0), ("wrong", 0.0, 0.0, -1.0, 1.0), ("edge", 53.5, -1.0, 0.5, 0.001)]
    got = sorted((r["area"], r["id"]) for r in _joined(spark, points, areas).collect())
    assert got == _expected(points, areas) and len(got) > 1000
    assert _joined(spark, points, []).count() == 0
    assert _joined(spark, [], areas).count() == 0


def test_a_cell_with_most_points_is_an_equi_join(spark):
    points = [(k, "53.381", "-1.47") for k in range(3000)] + [(9000, "10", "10")]
    areas = [(f"a{k}", 53.38, -1.47, 0.002 + k / 1000, 0.002) for k in range(20)]
    joined = _joined(spark, points, areas)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert joined.count() == len(_expected(points, areas)) == 3000 * 20


def test_place_keys_interleave_rows_and_columns(spark):
    rng = random.Random(5)
    rows = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(200)] + [(-90.0, -180.0), (90.0, 180.0), (0.0, 0.0)]
    df = spark.createDataFrame(rows, "lat double, lon double")
    got = df.select("lat", "lon", geo.place_key(F.col("lat"), F.col("lon"), 10).alias("k"), geo.place_key(F.col("lat"), F.col("lon"), 6).alias("short")).collect()
    for r in got:
        y, x = (min(int((v - low) / span * 1024), 1023) for v, low, span in ((r["lat"], -90, 180), (r["lon"], -180, 360)))
        want = sum(((y >> b) & 1) << (2 * b + 1) | ((x >> b) & 1) << (2 * b) for b in range(10))
        assert r["k"] == want and r["short"] == want >> 8


def test_counts_per_zoom_add_up(spark):
    rows = E.queries()["geo_clusters"](spark, SMOKE_DIR).collect()
    total = {}
    for r in rows:
        total[r["zoom"]] = total.get(r["zoom"], 0) + r["points"]
    assert set(total) == {8, 10, 12, 14, 16} and len(set(total.values())) == 1
    below = {}
    for r in rows:
        if r["zoom"] > 8:
            key = (r["zoom"] - 2, r["cell"] >> 4)
            below[key] = below.get(key, 0) + r["points"]
    assert below == {(r["zoom"], r["cell"]): r["points"] for r in rows if r["zoom"] < 16}
