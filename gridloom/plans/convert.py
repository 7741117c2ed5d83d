"""Whole conversions: feature layers or a raster to gridded, chunked datasets."""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.operators import align, encode, grid, rasterize, validity
from gridloom.plans import metadata as M
from gridloom.plans.joins import settle, store
from gridloom.sources import array_store, chunk_store, rasters


DEFAULT_CHUNK = 200


@dataclass
class Gridded:
    """Burned layers: sparse cells (rows counted from the south), their grid
    and the codes of categorical variables."""

    cells: DataFrame
    spec: DataFrame
    variables: list[str]
    codes: DataFrame | None
    tile: int | None = None

    def chunks(self, chunk: int | None = None) -> DataFrame:
        size = chunk or self.tile or DEFAULT_CHUNK
        return align.pack_chunks(self.cells, self.variables, size, placed=size == self.tile)

    def metadata(self, title: str, url: str, wkt: str, resolution: float, day: str | None = None) -> DataFrame:
        labels = grid.axis_labels(self.spec)
        day = day or datetime.date.today().isoformat()
        rows = (
            M.dataset_metadata(labels, title, url, day, resolution)
            .unionByName(M.axis_metadata(labels))
            .unionByName(M.variable_metadata(self.spec, self.variables))
            .unionByName(M.crs_metadata(self.spec, self.variables, wkt))
        )
        return rows if self.codes is None else rows.unionByName(M.encoding_metadata(self.codes))


def grid_features(
    features: DataFrame,
    resolution: float = 0.01,
    variables: list[str] | None = None,
    clean: str = "basic",
    codes: str = "first_seen",
    null_policy: str = "nan",
    geom_types: tuple[str, ...] | None = None,
) -> Gridded:
    """Burn all layers and variables of a feature table in one job.

    ``geom_types`` names the geometry types to burn; by default those present.

    Variables that are unknown or cannot be put on a grid are left out, see
    :func:`gridloom.plans.metadata.variable_status`.
    """
    names = _usable(features, variables)
    spec = settle(grid.grid_spec(grid.layer_bounds(features), resolution))
    encoded, table = encode.encode(features, names, clean, codes, null_policy)
    placed = grid.with_grid(_seen(encoded, names), spec, settled=True)
    cells = rasterize.burn(placed, names, list(geom_types or rasterize.geometry_types(features)))
    return Gridded(_from_south(cells, spec), spec, names, table)


def grid_features_tiled(
    features: DataFrame,
    resolution: float = 0.001,
    tile: int = 2000,
    chunk: int = 500,
    variables: list[str] | None = None,
    clean: str = "strip",
    null_policy: str = "zero",
    geom_types: tuple[str, ...] | None = None,
) -> Gridded:
    """The same for large grids: invalid shapes are dropped, codes
    follow the order of ``tile`` x ``tile`` windows, and cells come out grouped
    in ``chunk`` x ``chunk`` blocks, ready to be packed."""
    names = _usable(features, variables)
    # equal geometries are equally valid; the test of large ones reads them again
    sound = validity.valid_geometries(store(_seen(features, names)))
    spec = settle(grid.grid_spec(grid.layer_bounds(features), resolution))
    text = [v for v, k in encode.variable_kinds(features, names).items() if k == "categorical"]
    table = None
    if text:
        placed = grid.with_grid(features, spec, settled=True)
        table = encode.codes_by_tile(placed, text, tile, clean)
        sound = encode.apply_codes(sound, table, text, clean, settled=True)
    numeric = {
        v: encode.V.to_float32(F.col(v), null_policy) for v in names if v not in text
    }
    placed = grid.with_grid(sound.withColumns(numeric), spec, settled=True)
    types = geom_types or rasterize.geometry_types(features)
    cells = rasterize.swept_tiles(placed, names, chunk, ascending=True, geom_types=tuple(types))
    return Gridded(cells, spec, names, table, tile=chunk)


def _usable(features: DataFrame, variables: list[str] | None) -> list[str]:
    kinds = encode.variable_kinds(features, variables)
    return [v for v, k in kinds.items() if k != "unsupported"]


def _seen(features: DataFrame, names: list[str]) -> DataFrame:
    """What a burn has to look at; bounds and codes are those of all features."""
    return rasterize.last_of_equal(features.select(*[c for c in features.columns if c in encode.KEY_COLUMNS or c in names]))


def _from_south(cells: DataFrame, spec: DataFrame) -> DataFrame:
    sized = grid.join_dimension(cells, spec.select("layer", "ny"), ["layer"], settled=True, spread="row")
    return grid.ascending_rows(sized, F.col("ny")).drop("ny")


def write_dataset(
    gridded: Gridded,
    path: str,
    title: str,
    url: str,
    wkt: str,
    resolution: float,
    chunk: int | None = None,
    day: str | None = None,
) -> None:
    """Chunk tables with consolidated metadata; an existing store is replaced."""
    chunk_store.write_chunks(
        gridded.chunks(chunk), gridded.metadata(title, url, wkt, resolution, day), path
    )


def export_arrays(
    store: str, spec: DataFrame, layer: str, path: str, labels: str = "edges", fill: float = 0.0
) -> None:
    """One layer of a written store as a folder of raw arrays; an export that is
    already there is replaced.

    Category encodings are written whole, as objects beside their array. ``fill``
    is the value of cells that are not stored: 0 for burned layers, NaN for
    rasters.
    """
    spark = spec.sparkSession
    chunks = chunk_store.read_chunks(spark, store, layer)
    first = chunks.select("chunk").first()
    if first is None:
        raise ValueError(f"no chunks of layer {layer!r} in {store}")
    rows = chunk_store.read_metadata(spark, store)
    documents = M.attribute_documents(rows, layer)
    array_store.write_array_store(
        chunks, spec, layer, documents.pop("dataset", {}), path, first["chunk"],
        variable_attributes=documents, axis_attributes=documents, labels=labels, fill=fill,
        encodings=M.encoding_rows(rows, layer),
    )


def grid_raster(
    cells: DataFrame,
    raster: grid.RasterGrid,
    variable: str,
    chunk: int,
    layer: str,
    title: str,
    url: str,
    descriptions: DataFrame | None = None,
    day: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Chunks and metadata of a banded raster, ascending in latitude.

    Each band is packed as a variable ``<variable>_<band>``; values keep their type.
    """
    flipped = grid.ascending_rows(cells, F.lit(int(raster.ny)))
    packed = align.pack_chunks(flipped, ["value"], chunk, ["band"])
    chunks = packed.withColumns(
        {"layer": F.lit(layer), "var": F.concat(F.lit(f"{variable}_"), F.col("band"))}
    ).drop("band")
    spec = cells.sparkSession.range(1).select(F.lit(layer).alias("layer")).withColumns(raster.columns())
    labels = grid.axis_labels(spec, "centers")
    bands = rasters.band_info(cells, descriptions)
    # a raster's bands are few
    names = [f"{variable}_{r['band']}" for r in bands.select("band").orderBy("band").collect()]
    rows = (
        M.dataset_metadata(labels, title, url, day or datetime.date.today().isoformat(), raster.dy)
        .unionByName(M.axis_metadata(labels))
        .unionByName(M.variable_metadata(spec, names))
        .unionByName(M.band_metadata(bands, layer))
    )
    return chunks, rows


def write_raster(
    cells: DataFrame,
    raster: grid.RasterGrid,
    variable: str,
    chunk: int,
    layer: str,
    title: str,
    url: str,
    path: str,
    descriptions: DataFrame | None = None,
    day: str | None = None,
) -> None:
    """A banded raster as a stored dataset; an existing store is replaced."""
    chunks, rows = grid_raster(cells, raster, variable, chunk, layer, title, url, descriptions, day)
    chunk_store.write_chunks(chunks, rows, path)


def read_cells(spark, path: str, layer: str | None = None, variables: list[str] | None = None) -> DataFrame:
    """Cells of a written store."""
    return align.unpack_chunks(chunk_store.read_chunks(spark, path, layer, variables))


__all__ = [
    "Gridded", "grid_features", "grid_features_tiled", "write_dataset", "export_arrays",
    "grid_raster", "write_raster", "read_cells",
]
