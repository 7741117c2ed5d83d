"""Small feature tables from Python literals."""

from gridloom.functions.geometry import RINGS_TYPE

SCHEMA = f"fid bigint, layer string, geom_type string, rings {RINGS_TYPE}, value float"


def ring(*points):
    return [{"x": float(x), "y": float(y)} for x, y in points]


def square(x, y, side):
    return ring((x, y), (x + side, y), (x + side, y + side), (x, y + side), (x, y))


def features(spark, rows):
    """Rows ``(fid, rings)`` or ``(fid, rings, geom_type, layer, value)``."""
    full = []
    for r in rows:
        fid, rings = r[0], r[1]
        rest = list(r[2:]) + [None] * (3 - len(r[2:]))
        value = rest[2] if rest[2] is not None else float(fid)
        full.append((fid, rest[1] or "a", rest[0] or "POLYGON", rings, value))
    return spark.createDataFrame(full, SCHEMA)


def on_grid(df, grid):
    from gridloom.operators.grid import on_raster

    return on_raster(df, grid)


def rows_of(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


def exploded_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
