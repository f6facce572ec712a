"""Parquet snapshots whose column types drift.

One landing writes a price as INT, the next as DOUBLE, a third as text; a joint scan fails
(``CANNOT_MERGE_SCHEMAS``) or, worse, reads by the first file's types.  Here every
folder's own schema is read, equal schemas share one scan, and each column is cast to the
join of its types in a small lattice before the scans are united by name.

Lattice: BOOLEAN, the whole numbers by width, DECIMAL, FLOAT and DOUBLE, DATE and TIMESTAMP
each widen within their kind; a whole number and a floating one meet in DOUBLE if every
value of the whole type is exact there (up to INT), else in DECIMAL(38, 10) beside DECIMAL
and in STRING beside DOUBLE; all else meets in STRING.  So a cast never changes a value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources.files import list_files

_WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 20}


def join_types(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds every value of both."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if a in _WHOLE and b in _WHOLE:
        return max(a, b, key=_WHOLE.index)
    floats = (T.FloatType, T.DoubleType)
    if isinstance(a, floats) and isinstance(b, floats):
        return T.DoubleType()
    for x, y in ((a, b), (b, a)):
        if isinstance(x, floats) and y in _WHOLE[:3]:
            return T.DoubleType()
        if isinstance(x, T.DecimalType) and (y in _WHOLE or isinstance(y, T.DecimalType)):
            y_scale = 0 if y in _WHOLE else y.scale
            y_whole = _DIGITS[y.simpleString()] if y in _WHOLE else y.precision - y.scale
            scale, whole = max(x.scale, y_scale), max(x.precision - x.scale, y_whole)
            return T.DecimalType(scale + whole, scale) if scale + whole <= 38 else T.StringType()
        if isinstance(x, T.DateType) and isinstance(y, (T.TimestampNTZType,)):
            return T.TimestampNTZType()
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return join_schemas([a, b])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(join_types(a.elementType, b.elementType), True)
    return T.StringType()


def join_schemas(schemas: list[T.StructType]) -> T.StructType:
    """Columns of all schemas, by name in the order they first come, with joined types."""
    kinds: dict[str, T.DataType] = {}
    for schema in schemas:
        for f in schema.fields:
            kinds[f.name] = join_types(kinds[f.name], f.dataType) if f.name in kinds else f.dataType
    return T.StructType([T.StructField(n, t) for n, t in kinds.items()])


def folder_schemas(spark: SparkSession, path: str | list[str], glob: str = "*.parquet") -> dict[str, T.StructType]:
    """Schema of every folder (or, where a folder's files differ, file) that holds Parquet files.

    A folder is asked for the merged schema of all its footers, which Spark reads with a
    job; a folder whose files cannot be merged is asked file by file.
    """
    folder = F.regexp_replace("path", "/[^/]*$", "")
    # Spark keeps such a listing on the driver for every scan
    listed = list_files(spark, path, glob).select("path", folder.alias("folder"))
    by_folder = {r["folder"]: r["files"] for r in listed.groupBy("folder").agg(F.sort_array(F.collect_list("path")).alias("files")).collect()}
    out: dict[str, T.StructType] = {}
    for name, files in sorted(by_folder.items()):
        try:  # types that differ are an error here; columns some files lack are not
            out[name] = _plain(spark.read.option("mergeSchema", True).parquet(*files).schema)
        except Exception as exc:
            if "CANNOT_MERGE" not in str(exc) and "Failed merging schema" not in str(exc):
                raise
            out.update({f: _plain(spark.read.parquet(f).schema) for f in files})
    return out


def _plain(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])


def read_drifting(spark: SparkSession, path: str | list[str], glob: str = "*.parquet",
                  file_col: str | None = None) -> DataFrame | None:
    """Parquet files below ``path`` as one frame, whatever types each was written with.

    One scan per distinct schema; columns are joined by name, absent ones null.
    ``file_col`` adds each row's file path.  None when there is no file.
    """
    schemas = folder_schemas(spark, path, glob)
    if not schemas:
        return None
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    for place, schema in schemas.items():
        groups.setdefault(schema.json(), (schema, []))[1].append(place)
    target = join_schemas([schema for schema, _ in groups.values()])
    out = None
    for schema, places in groups.values():
        rows = spark.read.schema(schema).parquet(*places)
        held = {f.name: f.dataType for f in schema.fields}
        cols = [(F.col(f"`{f.name}`") if held.get(f.name) == f.dataType else _cast(f"`{f.name}`", held[f.name], f.dataType)
                 if f.name in held else F.lit(None).cast(f.dataType)).alias(f.name) for f in target.fields]
        part = rows.select(*cols, *([F.col("_metadata.file_path").alias(file_col)] if file_col else []))
        out = part if out is None else out.unionByName(part)
    return out


def _cast(name: str, have: T.DataType, want: T.DataType):
    c = F.col(name)
    if isinstance(want, T.StringType) and isinstance(have, (T.StructType, T.MapType, T.ArrayType)):
        return F.to_json(c)
    return c.cast(want)
