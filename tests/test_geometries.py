"""Geometries of all kinds to well-known text and back."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tabletide.functions.geo import geometry_to_wkt, is_geometry, wkt_to_geometry

CASES = [
    ({"type": "Point", "coordinates": [1, -2.5]}, "POINT (1 -2.5)"),
    ({"type": "Point", "coordinates": [1, 2, 3]}, "POINT Z (1 2 3)"),
    ({"type": "LineString", "coordinates": [[1, 2], [3, 4]]}, "LINESTRING (1 2, 3 4)"),
    ({"type": "MultiPoint", "coordinates": [[1, 2], [3, 4]]}, "MULTIPOINT ((1 2), (3 4))"),
    ({"type": "Polygon", "coordinates": [[[0, 0], [4, 0], [4, 4], [0, 0]], [[1, 1], [2, 1], [2, 2], [1, 1]]]}, "POLYGON ((0 0, 4 0, 4 4, 0 0), (1 1, 2 1, 2 2, 1 1))"),
    ({"type": "MultiLineString", "coordinates": [[[1, 2], [3, 4]], [[5, 6], [7, 8]]]}, "MULTILINESTRING ((1 2, 3 4), (5 6, 7 8))"),
    ({"type": "MultiPolygon", "coordinates": [[[[0, 0], [1, 0], [1, 1], [0, 0]]], [[[5, 5], [6, 5], [6, 6], [5, 5]]]]}, "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)), ((5 5, 6 5, 6 6, 5 5)))"),
    ({"type": "GeometryCollection", "geometries": [{"type": "Point", "coordinates": [1, 2]}, {"type": "LineString", "coordinates": [[1, 2], [3, 4]]}]}, "GEOMETRYCOLLECTION (POINT (1 2), LINESTRING (1 2, 3 4))"),
    ({"type": "GeometryCollection", "geometries": []}, "GEOMETRYCOLLECTION EMPTY"),
    ({"type": "LineString", "coordinates": []}, "LINESTRING EMPTY"),
    ({"type": "GeometryCollection", "geometries": [{"type": "LineString", "coordinates": []}, {"type": "MultiPoint", "coordinates": [[1, 2]]}]}, "GEOMETRYCOLLECTION (LINESTRING EMPTY, MULTIPOINT ((1 2)))"),
]


def compact(x):
    return json.dumps(x, separators=(",", ":"))


def test_both_ways(spark):
    df = spark.createDataFrame([(i, json.dumps(g), w) for i, (g, w) in enumerate(CASES)], "i int, g string, w string")
    for r in df.select("i", geometry_to_wkt(F.col("g")).alias("to"), wkt_to_geometry(F.col("w")).alias("back")).collect():
        assert (r["to"], r["back"]) == (CASES[r["i"]][1], compact(CASES[r["i"]][0]))


def test_other_ways_to_write(spark):
    for text, want in ((" point(1   2) ", {"type": "Point", "coordinates": [1, 2]}), ("MULTIPOINT (1 2, 3 4)", {"type": "MultiPoint", "coordinates": [[1, 2], [3, 4]]}), ("Linestring(1 2,3 4)", {"type": "LineString", "coordinates": [[1, 2], [3, 4]]})):
        assert json.loads(spark.range(1).select(wkt_to_geometry(F.lit(text)).alias("x")).first().x) == want
    assert spark.range(1).select(wkt_to_geometry(F.lit(None).cast("string")).alias("x"), geometry_to_wkt(F.lit(None).cast("string")).alias("y")).first() == (None, None)
    assert spark.range(1).select(wkt_to_geometry(F.lit("POINT (1e-3 -2E+4)")).alias("x")).first().x == '{"type":"Point","coordinates":[1e-3,-2E+4]}'


@pytest.mark.parametrize("text", ["POINT (1)", "POINT 1 2", "CIRCLE (1 2)", "LINESTRING ((1 2))", "POLYGON (1 2, 3 4)", "GEOMETRYCOLLECTION (CIRCLE (1 2))", "GEOMETRYCOLLECTION (GEOMETRYCOLLECTION EMPTY)", "", "POINT (1 2) x"])
def test_no_well_known_text(spark, text):
    with pytest.raises(Exception, match="not a geometry"):
        spark.range(1).select(wkt_to_geometry(F.lit(text))).collect()


@pytest.mark.parametrize("value", [{"type": "Point", "coordinates": [[1, 2]]}, {"type": "Feature"}, {"type": "LineString", "coordinates": [[1, 2], [1, 2, 3]]}, {"type": "GeometryCollection", "geometries": [{"type": "GeometryCollection", "geometries": []}]}, [1, 2]])
def test_no_geometry(spark, value):
    with pytest.raises(Exception, match="well-known text"):
        spark.range(1).select(geometry_to_wkt(F.lit(json.dumps(value)))).collect()


def test_generated_shapes(spark):
    """Any nesting comes back as it was."""
    r = random.Random(11)
    number = lambda: r.choice([r.randint(-180, 180), round(r.uniform(-90, 90), 5), 1e-7, 12345678901])

    def nested(depth, size):
        return [number() for _ in range(size)] if depth == 1 else [nested(depth - 1, size) for _ in range(r.randint(1, 4))]

    def simple():
        name, depth = r.choice([("Point", 1), ("MultiPoint", 2), ("LineString", 2), ("MultiLineString", 3), ("Polygon", 3), ("MultiPolygon", 4)])
        return {"type": name, "coordinates": nested(depth, r.choice([2, 3]))}

    shapes = [simple() if r.random() < 0.7 else {"type": "GeometryCollection", "geometries": [simple() for _ in range(r.randint(0, 3))]} for _ in range(400)]
    df = spark.createDataFrame([(i, json.dumps(g)) for i, g in enumerate(shapes)], "i int, g string")
    found = df.select("i", is_geometry(F.col("g")).alias("good"), wkt_to_geometry(geometry_to_wkt(F.col("g"))).alias("back")).collect()
    for x in found:
        assert x.good and json.loads(x.back) == shapes[x.i]


@pytest.mark.parametrize("kind", ["LineString", "Polygon", "GeometryCollection"])
def test_many_positions(spark, kind):
    """No search in a text takes room on the stack for each position, nor for each member."""
    line = [[i, i + 0.5] for i in range(20_000)]
    members = [{"type": "Point", "coordinates": p} for p in line]
    shape = {"type": kind, "geometries": members} if kind == "GeometryCollection" else {"type": kind, "coordinates": [line] if kind == "Polygon" else line}
    found = spark.createDataFrame([(json.dumps(shape),)], "g string").select(is_geometry(F.col("g")).alias("good"), wkt_to_geometry(geometry_to_wkt(F.col("g"))).alias("back")).first()
    assert found.good and found.back == compact(shape)


@pytest.mark.parametrize("name", ["geo_kinds", "geo_points"])
def test_values_are_computed_once(spark, small, name):
    """An expression that stands wherever its value is used grows with each step that uses it several times."""
    from tabletide.queries import QUERIES

    assert len(QUERIES[name](spark, small)._jdf.queryExecution().optimizedPlan().toString()) < 50_000
