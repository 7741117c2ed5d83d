"""Gridding of geospatial feature and raster tables on Spark."""
