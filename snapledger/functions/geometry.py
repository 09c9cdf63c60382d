"""Points and polygons as plain structs, read from GeoJSON text.

A point is ``struct<lon, lat>``. A polygon is ``struct<type, parts>`` where parts
is a list of polygons, each a list of rings, each a list of [lon, lat] positions;
a Polygon has one part, a MultiPolygon any number.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PARTS_SCHEMA = "array<array<array<array<double>>>>"


def _bind(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def make_point(lon: Column, lat: Column) -> Column:
    """NULL when either coordinate is NULL."""
    return F.when(
        lon.isNotNull() & lat.isNotNull(), F.struct(lon.alias("lon"), lat.alias("lat"))
    )


def morton_key(lon: Column, lat: Column) -> Column:
    """Place of a point on a curve that keeps neighbours together: the bits of its longitude
    and latitude in turn, 26 of each, so cells are some ten metres wide. NULL if either is."""

    def scaled(value: Column, half: float) -> Column:
        inside = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (value + half) / (2 * half)))
        return F.floor(inside * ((1 << 26) - 1)).cast("bigint")

    def spread(value: Column) -> Column:
        """A zero after every bit: halves move apart, then the halves of those."""
        for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
            value = _bind(value, lambda x: x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask)))
        return value

    key = F.shiftleft(spread(scaled(lat, 90.0)), 1).bitwiseOR(spread(scaled(lon, 180.0)))
    return F.when(lon.isNotNull() & lat.isNotNull(), key)


def polygon_from_geojson(text: Column, strict: bool = False) -> Column:
    """Parse a Polygon or MultiPolygon geometry. Any other text is NULL or, with
    ``strict``, an error."""
    kind = F.get_json_object(text, "$.type")
    coordinates = F.get_json_object(text, "$.coordinates")
    one_or_more = F.when(
        kind == "Polygon", F.concat(F.lit("["), coordinates, F.lit("]"))
    ).when(kind == "MultiPolygon", coordinates)
    found = F.struct(kind.alias("type"), F.from_json(one_or_more, PARTS_SCHEMA).alias("parts"))
    parsed = _bind(found, lambda g: F.when(_is_complete(g["parts"]), g))
    if not strict:
        return parsed
    message = F.concat(F.lit("no polygon in GeoJSON: "), F.substring(text, 1, 200))
    return F.when(text.isNotNull(), F.coalesce(parsed, F.raise_error(message)))


def _is_complete(parts: Column) -> Column:
    """Coordinates nested to the wrong depth parse to lists holding NULLs."""

    def bad_position(p: Column) -> Column:
        return p.isNull() | (F.size(p) < 2) | p[0].isNull() | p[1].isNull()

    def bad_ring(r: Column) -> Column:
        return r.isNull() | F.exists(r, bad_position)

    def bad_part(rings: Column) -> Column:
        return rings.isNull() | F.exists(rings, bad_ring)

    return parts.isNotNull() & ~F.exists(parts, bad_part)


def _number_text(value: Column) -> Column:
    return F.regexp_replace(value.cast("string"), r"\.0$", "")


def _wrapped(items: Column) -> Column:
    return F.concat(F.lit("("), F.array_join(items, ", "), F.lit(")"))


def polygon_wkt(polygon: Column) -> Column:
    """Well-known text of a polygon struct."""

    def position(p: Column) -> Column:
        return F.concat(_number_text(p[0]), F.lit(" "), _number_text(p[1]))

    def ring(r: Column) -> Column:
        return _wrapped(F.transform(r, position))

    def part(rings: Column) -> Column:
        return _wrapped(F.transform(rings, ring))

    texts = F.transform(polygon["parts"], part)
    return F.when(polygon["type"] == "Polygon", F.concat(F.lit("POLYGON"), texts[0])).when(
        polygon["type"] == "MultiPolygon", F.concat(F.lit("MULTIPOLYGON"), _wrapped(texts))
    )


def polygon_edges(polygon: Column) -> Column:
    """All ring edges as ``array<struct<x1, y1, x2, y2>>``. Every ring is closed
    onto its first position; edges without length are dropped."""

    def edge(a: Column, b: Column) -> Column:
        return F.struct(
            a[0].alias("x1"), a[1].alias("y1"), b[0].alias("x2"), b[1].alias("y2")
        )

    def ring_edges(r: Column) -> Column:
        following = F.concat(F.slice(r, 2, F.size(r)), F.slice(r, 1, 1))
        return F.zip_with(r, following, edge)

    edges = F.flatten(F.transform(F.flatten(polygon["parts"]), ring_edges))
    return F.filter(edges, lambda e: (e["x1"] != e["x2"]) | (e["y1"] != e["y2"]))


def linked_edges(polygon: Column) -> Column:
    """The edges of :func:`polygon_edges`, each with the corner before its start (x0, y0) and
    the one after its end (x3, y3). Corners that repeat the one before them do not count."""

    def same(p: Column, q: Column) -> Column:
        return (p[0] == q[0]) & (p[1] == q[1])

    def corners(r: Column) -> Column:
        return _bind(
            F.filter(r, lambda p, i: (i == 0) | ~same(p, F.get(r, i - 1))),
            lambda c: F.slice(c, 1, F.size(c) - same(F.get(c, F.lit(0)), F.get(c, F.size(c) - 1)).cast("int")),
        )

    def edges(c: Column) -> Column:
        def edge(a: Column, i: Column) -> Column:
            n = F.size(c)
            around = (c[(i + n - 1) % n], a, c[(i + 1) % n], c[(i + 2) % n])
            return F.struct(*[p[k].alias(f"{x}{j}") for j, p in enumerate(around) for k, x in enumerate("xy")])

        return F.transform(c, edge)

    rings = F.filter(F.flatten(polygon["parts"]), lambda r: F.size(r) > 0)
    return F.flatten(F.transform(F.filter(F.transform(rings, corners), lambda c: F.size(c) > 1), edges))


def crosses_ray(edge: Column, x: Column, y: Column) -> Column:
    """Does the ray from (x, y) towards growing x cross the edge? The first test
    is half-open in y, so a shared vertex counts once, and it rules out level edges
    before the division."""
    at_y = (edge["x2"] - edge["x1"]) * (y - edge["y1"]) / F.nullif(
        edge["y2"] - edge["y1"], F.lit(0.0)
    ) + edge["x1"]
    return ((edge["y1"] > y) != (edge["y2"] > y)) & (x < at_y)


def lies_on(edge: Column, x: Column, y: Column) -> Column:
    return (
        x.between(F.least(edge["x1"], edge["x2"]), F.greatest(edge["x1"], edge["x2"]))
        & y.between(F.least(edge["y1"], edge["y2"]), F.greatest(edge["y1"], edge["y2"]))
        & (
            (edge["x2"] - edge["x1"]) * (y - edge["y1"])
            == (edge["y2"] - edge["y1"]) * (x - edge["x1"])
        )
    )


def odd_crossings(edges: Column, x: Column, y: Column) -> Column:
    return F.size(F.filter(edges, lambda e: crosses_ray(e, x, y))) % 2 == 1


def inside_edges(edges: Column, x: Column, y: Column) -> Column:
    """Strictly inside by the even-odd rule: holes and several parts need no
    special treatment, points on an edge are outside. One cheap pass first picks the
    edges at the height of the point."""
    level = F.filter(edges, lambda e: (e["y1"] - y) * (e["y2"] - y) <= 0)
    return _bind(
        level,
        lambda found: odd_crossings(found, x, y) & ~F.exists(found, lambda e: lies_on(e, x, y)),
    )


def point_within(point: Column, polygon: Column) -> Column:
    """Exact test of one point against one polygon; NULL input gives NULL."""
    return F.when(
        point.isNotNull() & polygon.isNotNull(),
        inside_edges(polygon_edges(polygon), point["lon"], point["lat"]),
    )
