"""Geometry given as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridloom.functions.geometry import RINGS_TYPE

# Geometry names of the text format and the class they burn as.
GEOMETRY_NAMES = {
    "POINT": "POINT",
    "MULTIPOINT": "POINT",
    "LINESTRING": "LINE",
    "MULTILINESTRING": "LINE",
    "LINEARRING": "LINE",
    "POLYGON": "POLYGON",
    "MULTIPOLYGON": "POLYGON",
}


# One simple geometry inside a collection, its parentheses at most three deep.
PART = r"([A-Za-z]+\s*(?:[ZzMm]{1,2}\s*)?\((?:[^()]|\((?:[^()]|\([^()]*\))*\))*\))"


def wkt_parts(text: Column) -> Column:
    """Simple geometries of a text: those of a collection, else the text itself.

    Exploded, they are features of one ``fid``; an empty collection has none.
    """
    inside = F.regexp_extract(text, r"(?is)^\s*(?:SRID=\d+;)?\s*GEOMETRYCOLLECTION[^(]*\((.*)\)\s*$", 1)
    collected = F.upper(text).rlike(r"^\s*(SRID=\d+;)?\s*GEOMETRYCOLLECTION")
    return F.when(collected, F.regexp_extract_all(inside, F.lit(PART), F.lit(1))).otherwise(F.array(text))


def wkt_type(text: Column) -> Column:
    """POINT, LINE or POLYGON; null for any other geometry. A leading reference
    system number is passed over."""
    name = F.upper(F.regexp_extract(text, r"^\s*(?:(?i:SRID)=\d+;)?\s*([A-Za-z]+)", 1))
    names = F.create_map(*[F.lit(v) for pair in GEOMETRY_NAMES.items() for v in pair])
    return F.try_element_at(names, name)


def wkt_rings(text: Column) -> Column:
    """Rings of a text geometry; null if a coordinate is not a number.

    Every innermost pair of parentheses is a ring or part. Multi-polygons need
    no nesting, since filling is even-odd over all rings.
    """
    number = lambda words, i: F.get(words, F.lit(i)).try_cast("double")

    def point(pair: Column) -> Column:
        words = F.split(F.regexp_replace(pair, r"^\s+|\s+$", ""), r"\s+")
        return F.struct(number(words, 0).alias("x"), number(words, 1).alias("y"))

    groups = F.regexp_extract_all(text, F.lit(r"\(([^()]+)\)"), F.lit(1))
    rings = F.transform(groups, lambda g: F.transform(F.split(g, ","), point))
    broken = F.exists(F.flatten(rings), lambda p: p["x"].isNull() | p["y"].isNull())
    return F.when(~broken, rings).cast(RINGS_TYPE)
