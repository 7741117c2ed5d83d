"""Export to the open chunked-array folder layout, version 2.

One folder per array, one raw little-endian object per chunk and JSON metadata,
also consolidated in one file. Executors write chunk objects; the commit on the
driver writes only the JSON files.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from gridloom.operators.grid import SPEC_COLUMNS, latitude_label, longitude_label
from gridloom.plans.joins import settle
from gridloom.sources.folders import Folder

FORMAT_NAME = "gridloom_arrays"

# Fixed values of the layout.
GROUP_FILE, ARRAY_FILE, ATTRS_FILE, ALL_FILE = ".zgroup", ".zarray", ".zattrs", ".zmetadata"
DIMENSIONS_KEY = "_ARRAY_DIMENSIONS"
GROUP_JSON = {"zarr_format": 2}
DTYPES = {"float": "<f4", "double": "<f8", "int": "<i4", "bigint": "<i8", "smallint": "<i2", "tinyint": "|i1"}
ENCODING_FOLDER = "encoding"
ENCODING_CODES = 5_000  # codes in one object


def array_store_source() -> type[DataSource]:
    """Sink for rows ``(array, chunk_key, data)``.

    The classes are made here so that they travel to the workers by value and
    the package need not be installed there.
    """

    @dataclass
    class Written(WriterCommitMessage):
        objects: int

    class ArrayStoreWriter(DataSourceWriter):
        def __init__(self, options: dict):
            self.path = options["path"]
            self.documents = json.loads(options["documents"])

            self.folders = set()

        def _open(self):
            from pyarrow import fs

            return fs.FileSystem.from_uri(self.path.replace("s3a://", "s3://", 1))

        def _put(self, filesystem, root: str, key: str, data: bytes) -> None:
            folder, _, name = f"{root}/{key}".rpartition("/")
            if folder not in self.folders:
                filesystem.create_dir(folder, recursive=True)
                self.folders.add(folder)
            # whole or not there: a second attempt that is killed leaves the first one's object
            renamed = filesystem.type_name == "local"
            part = f"{folder}/.{name}-{uuid.uuid4().hex}" if renamed else f"{root}/{key}"
            with filesystem.open_output_stream(part) as out:
                out.write(data)
            if renamed:
                filesystem.move(part, f"{root}/{key}")

        def write(self, iterator):
            # a task run twice writes the same objects under the same names
            filesystem, root = self._open()
            count = 0
            for row in iterator:
                self._put(filesystem, root, f"{row['array']}/{row['chunk_key']}", bytes(row["data"]))
                count += 1
            return Written(count)

        def commit(self, messages):
            filesystem, root = self._open()
            for key, document in self.documents.items():
                self._put(filesystem, root, key, json.dumps(document, indent=1).encode())
            everything = {"zarr_consolidated_format": 1, "metadata": self.documents}
            self._put(filesystem, root, ALL_FILE, json.dumps(everything, indent=1).encode())

        def abort(self, messages):
            """Objects stay: without the JSON files they are no store."""

    class ArrayStoreSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return FORMAT_NAME

        def schema(self) -> str:
            return "array string, chunk_key string, data binary"

        def writer(self, schema, overwrite):
            return ArrayStoreWriter(dict(self.options))

    return ArrayStoreSource


def _array_json(shape: list[int], chunks: list[int], dtype: str, fill) -> dict:
    return {
        "zarr_format": 2,
        "shape": shape,
        "chunks": chunks,
        "dtype": dtype,
        "compressor": None,
        "fill_value": fill,
        "filters": None,
        "order": "C",
    }


def shared_uri(spark: SparkSession, path: str) -> str:
    """``path`` on the session's default file system, as every executor names it.

    A bare path on a machine's own disk is refused on a cluster: the executors
    would each write to their own. A path that names its file system is taken as it
    is, with one slash or three: folders inside the session's checkpoint folder come
    as ``file:/...``.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    filesystem = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    uri = filesystem.makeQualified(hadoop).toString()
    master = spark.sparkContext.master
    if uri.startswith("file:"):
        if hadoop.toUri().getScheme() is None and master != "local" and not master.startswith("local["):
            raise ValueError(f"{path!r} is on each machine's own disk; name a file system that all executors share")
        uri = "file://" + uri.removeprefix("file:").removeprefix("//")
    return uri


STAGED, REPLACED = ".staged-", ".replaced-"


def _check_target(folder: Folder) -> None:
    """An export may replace an earlier one or an empty folder, nothing else."""
    if folder.names() and not folder.exists(GROUP_FILE):
        raise ValueError(f"{folder.path} is not empty and no array store")


def settle_export(spark: SparkSession, uri: str) -> None:
    """Finish a replacement that broke off between its two renames: the old export
    stands aside, the new one, whole, has not taken its place yet."""
    folder = Folder(spark, uri)
    if folder.exists():
        return
    for name in folder.parent.names():
        if name.startswith(folder.name + REPLACED):
            staged = Folder(spark, f"{uri}{STAGED}{name.rpartition('-')[2]}")
            if staged.exists(ALL_FILE):
                staged.rename_to(uri)
                folder.parent.delete(name)
                return


def _replace_export(spark: SparkSession, staged: str, uri: str, version: str) -> None:
    """Put a finished export in the place of an earlier one."""
    old = Folder(spark, uri)
    if old.exists():
        old.rename_to(f"{uri}{REPLACED}{version}")
    Folder(spark, staged).rename_to(uri)
    Folder(spark, f"{uri}{REPLACED}{version}").delete()


def _encoding_objects(encodings: DataFrame) -> DataFrame:
    """Codes in order, some thousand to an object: one JSON pair to a line."""
    part = F.floor((F.col("code") - 1) / F.lit(ENCODING_CODES)).cast("long").alias("part")
    line = F.to_json(F.struct("code", "category"))
    lines = encodings.select("var", part, "code", line.alias("line")).groupBy("var", "part").agg(
        F.array_sort(F.collect_list(F.struct("code", "line"))).alias("s")
    )
    return lines.select(
        F.col("var").alias("array"),
        F.concat(F.lit(f"{ENCODING_FOLDER}/"), F.col("part").cast("string")).alias("chunk_key"),
        F.encode(F.array_join(F.col("s")["line"], "\n"), "UTF-8").alias("data"),
    )


def read_encoding(spark: SparkSession, path: str, variable: str) -> DataFrame:
    """``code, category`` of a variable of an exported store."""
    folder = f"{shared_uri(spark, path)}/{variable}/{ENCODING_FOLDER}"
    return spark.read.schema("code bigint, category string").json(folder)


def _dense(pos: Column, vals: Column, size: Column, dtype: str, fill: float) -> Column:
    """A chunk's values scattered over a block of ``fill``, as raw little-endian bytes."""

    @F.pandas_udf(T.BinaryType())
    def dense(pos: pd.Series, vals: pd.Series, size: pd.Series) -> pd.Series:
        import numpy as np

        def one(p, v, n):
            block = np.full(n, fill, dtype=dtype)
            block[np.asarray(p)] = np.asarray(v, dtype=dtype)
            return block.tobytes()

        return pd.Series([one(p, v, n) for p, v, n in zip(pos, vals, size)])

    return dense(pos, vals, size)


def _raw_float64(vals: Column) -> Column:
    @F.pandas_udf(T.BinaryType())
    def raw(vals: pd.Series) -> pd.Series:
        import numpy as np

        return pd.Series([np.asarray(v, dtype="<f8").tobytes() for v in vals])

    return raw(vals)


def _axis_chunks(spec: DataFrame, axis: str, size: str, label: Column, chunk: int) -> DataFrame:
    step = F.lit(int(chunk)).cast("long")
    labels = (
        spec.select(*SPEC_COLUMNS, F.explode(F.sequence(F.lit(0).cast("long"), F.col(size) - 1, step)).alias("at"))
        .withColumn("idx", F.explode(F.sequence(F.col("at"), F.least(F.col("at") + step, F.col(size)) - 1)))
        .select(F.floor(F.col("at") / step).alias("k"), "idx", label.alias("label"))
    )
    packed = labels.groupBy("k").agg(F.array_sort(F.collect_list(F.struct("idx", "label"))).alias("s"))
    # the last chunk is padded to full size, as the layout asks
    padded = F.concat(
        F.col("s")["label"], F.array_repeat(F.lit(0.0), F.lit(int(chunk)) - F.size("s"))
    )
    return packed.select(
        F.lit(axis).alias("array"), F.col("k").cast("string").alias("chunk_key"), _raw_float64(padded).alias("data")
    )


def write_array_store(
    chunks: DataFrame,
    spec: DataFrame,
    layer: str,
    attributes: dict,
    path: str,
    chunk: int,
    variable_attributes: dict[str, dict] | None = None,
    axis_attributes: dict[str, dict] | None = None,
    labels: str = "edges",
    fill: float = 0.0,
    encodings: DataFrame | None = None,
) -> None:
    """Write one layer's chunks, ascending in latitude, as a folder of arrays.

    The export is written beside ``path`` and takes its place when it is whole: a
    write that fails leaves an earlier export as it was. (Renames of folders are one
    step on file systems, not on object stores.) Values keep the chunks' type.
    A chunk without cells is not written; readers see ``fill``. ``encodings``
    (``var, code, category``) are written whole by the executors as objects in a
    folder of their variable, which its attributes name.
    """
    spark: SparkSession = chunks.sparkSession
    path, version = shared_uri(spark, path).rstrip("/"), uuid.uuid4().hex
    settle_export(spark, path)
    _check_target(Folder(spark, path))
    staged = f"{path}{STAGED}{version}"
    kind = chunks.schema["vals"].dataType.elementType
    dtype = DTYPES[kind.simpleString()]
    shown = fill if fill == fill else "NaN"
    spark.dataSource.register(array_store_source())
    one = spec.where(F.col("layer") == layer)
    size = one.select("nx", "ny").first()
    nx, ny = int(size["nx"]), int(size["ny"])
    mine = chunks.where(F.col("layer") == layer)
    variables = sorted(r["var"] for r in mine.select("var").distinct().collect())

    documents: dict[str, dict] = {GROUP_FILE: GROUP_JSON, ATTRS_FILE: attributes}
    for axis, n in (("latitude", ny), ("longitude", nx)):
        documents[f"{axis}/{ARRAY_FILE}"] = _array_json([n], [chunk], "<f8", None)
        documents[f"{axis}/{ATTRS_FILE}"] = {
            **(axis_attributes or {}).get(axis, {}), DIMENSIONS_KEY: [axis]
        }
    for v in variables:
        documents[f"{v}/{ARRAY_FILE}"] = _array_json([ny, nx], [chunk, chunk], dtype, shown)
        documents[f"{v}/{ATTRS_FILE}"] = {
            **(variable_attributes or {}).get(v, {}), DIMENSIONS_KEY: ["latitude", "longitude"]
        }

    ascending = F.col("ny") - 1 - F.col("idx")
    lat = latitude_label(ascending, labels)
    objects = (
        mine.select(
            F.col("var").alias("array"),
            F.concat_ws(".", "chunk_row", "chunk_col").alias("chunk_key"),
            _dense(F.col("pos"), F.col("vals"), F.col("chunk") * F.col("chunk"), dtype, fill).alias("data"),
        )
        .unionByName(_axis_chunks(one, "latitude", "ny", lat, chunk))
        .unionByName(_axis_chunks(one, "longitude", "nx", longitude_label(F.col("idx"), labels), chunk))
    )
    if encodings is not None:
        encodings = settle(encodings)
        for r in encodings.select("var").distinct().collect():
            known = documents.setdefault(f"{r['var']}/{ATTRS_FILE}", {})
            known["categorical_encoding"] = f"{r['var']}/{ENCODING_FOLDER}"
        objects = objects.unionByName(_encoding_objects(encodings))
    try:
        (
            objects.write.format(FORMAT_NAME)
            .mode("append")
            .option("path", staged)
            .option("documents", json.dumps(documents))
            .save()
        )
    except BaseException:
        Folder(spark, staged).delete()
        raise
    _replace_export(spark, staged, path, version)
