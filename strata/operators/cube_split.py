"""One cube document over many tasks.

A document is one JSON text, and a JSON reader gives it to one task, at most 2 GB of it.  The
bulk of a large cube is its flat ``value`` array, whose cells are separated by commas, and
Spark's text source splits files at any separator.  So the file is read as comma-separated
pieces, by as many tasks as it has splits: pieces of the array are cells, and a cell's
position is its place in its split plus the cells of the splits before (one small count per
split).  The other pieces, put together again, are the document with an empty array; it
is parsed once, as any other, for dimensions, labels and rejects.

A piece is a cell only if no cell holds a comma or quotes one; a document whose array holds
half a quoted text is set aside (``split_text``) and left to the ordinary reader.

A document too large for one writer is landed in parts: a folder whose files, in the order of
their names, make up the text.  A part is cut behind a comma and white space (a line end, as
Spark's text writer leaves); a document cut elsewhere is set aside (``cut_cell``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.operators import jsonstat
from strata.session import scratch_path

OPENS = r'(?s)^(.*(?<!\\)"value"\s*:\s*\[)(.*)$'
QUOTED = r'"(?:[^"\\]|\\.)*"'
MAX_DOCUMENTS = 10_000


def _pieces(spark: SparkSession, path: str | list[str], glob: str | None, parts: bool) -> DataFrame:
    reader = spark.read.option("lineSep", ",").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    file = F.col("_metadata.file_path")
    name = F.substring_index(file, "/", -1)
    folder = F.substring(file, F.lit(1), F.length(file) - F.length(name) - 1)
    return reader.text(path).select(
        (folder if parts else file).alias("path"), (name if parts else F.lit("")).alias("part"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"),
        F.col("value").alias("piece"))


def read_split(spark: SparkSession, path: str | list[str], glob: str | None = None,
               parts: bool = False) -> tuple[DataFrame, DataFrame]:
    """Documents (one per file, with ``parts`` one per folder of files) as ``(parsed, cell_rows)``, for :func:`jsonstat.widen`.

    ``parsed`` is what :func:`jsonstat.parse` gives, with ``path``; ``cell_rows`` has the
    cells of the accepted ones.  Small documents in their many are better read whole
    (:func:`strata.sources.documents.read_documents`); more than ``MAX_DOCUMENTS`` are refused,
    since a few hundred bytes of each are broadcast to the cells.
    """
    pieces = _pieces(spark, path, glob, parts)
    is_open = F.col("piece").rlike(OPENS)
    blocks = _written(pieces.groupBy("path", "part", "block").agg(
        F.max("at").alias("last"), F.max(F.when(F.col("piece").rlike(r"^\s*$"), F.col("at"))).alias("blank"),
        F.min(F.when(is_open, F.col("at"))).alias("open")), "cube-blocks")
    n = blocks.select("path").distinct().count()
    if n > MAX_DOCUMENTS:
        raise ValueError(f"{n} documents: read them whole instead")
    # the white space behind the last comma of a part is no piece of the document
    of_doc = Window.partitionBy("path")
    at_cut = (F.col("block") == F.max("block").over(Window.partitionBy("path", "part"))) & (F.col("part") < F.max("part").over(of_doc))
    blocks = blocks.withColumn("at_cut", at_cut).select(
        "path", "part", "block", F.when(F.col("at_cut") & (F.col("blank") == F.col("last")), F.col("last")).alias("joint"),
        F.min(_place("open")).over(of_doc).alias("start"),
        F.max(F.col("at_cut") & ~F.col("blank").eqNullSafe(F.col("last"))).over(of_doc).alias("cut"))
    blocks = _written(blocks, "cube-starts")
    marked = pieces.join(F.broadcast(blocks.drop("cut")), ["path", "part", "block"])
    marked = marked.filter(F.col("joint").isNull() | (F.col("at") != F.col("joint"))).withColumn("place", _place("at")).drop("joint")
    first = F.col("place") == F.col("start")
    # the piece's part of the array: all of it, but for the one that opens it
    marked = marked.withColumn("cell", F.when(first, F.regexp_extract("piece", OPENS, 2)).otherwise(F.col("piece")))
    bare = F.regexp_replace("cell", QUOTED, "")
    after = F.col("place") >= F.col("start")
    marked = marked.withColumns({"ends": after & bare.contains("]"), "odd": after & bare.contains('"')})
    splits = _written(marked.filter(after).groupBy("path", "part", "block").agg(
        F.min("at").alias("from"), F.count(F.lit(1)).alias("n"), F.min(F.when(F.col("ends"), F.col("at"))).alias("end"),
        F.min(F.when(F.col("odd"), F.col("at"))).alias("odd"),
        F.max(first & F.col("cell").rlike(r"^\s*\]")).alias("empty")), "cube-splits")
    before = Window.partitionBy("path").orderBy("part", "block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    ends = splits.groupBy("path").agg(F.min(_place("end")).alias("end"), F.min(_place("odd")).alias("odd"))
    last = splits.join(ends.select("path", F.col("end").alias("stop")), "path").filter(
        (F.col("part") == F.col("stop.part")) & (F.col("block") == F.col("stop.block")))
    last = last.select("path", F.when(~F.col("empty"), F.col("base") + F.col("stop.at") - F.col("from") + 1)
                       .otherwise(0).alias("n_values"))
    bounds = _written(ends.join(last, "path", "left"), "cube-ends")

    # what is not the array, in order, around an empty array
    around = marked.join(F.broadcast(bounds.select("path", "end")), "path", "left")
    tail = F.regexp_extract("cell", r"(?s)^((?:[^\]\"]|" + QUOTED + r")*)(\].*)$", 2)
    is_end = F.col("place") == F.col("end")
    head_part = F.when(F.col("start").isNull() | (F.col("place") < F.col("start")), F.col("piece")).when(
        first, F.regexp_extract("piece", OPENS, 1))
    tail_part = F.when(is_end, tail).when(F.col("place") > F.col("end"), F.col("piece"))
    listed = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(
        F.when(c.isNotNull(), F.struct("place", c.alias("text"))))), lambda x: x["text"]), ",")
    outside = F.col("start").isNull() | (F.col("place") <= F.col("start")) | (F.col("place") >= F.col("end"))
    headers = around.filter(outside).groupBy("path").agg(F.concat(listed(head_part), listed(tail_part)).alias("body"))
    headers = headers.join(bounds.select("path", "n_values", (F.col("odd") <= F.col("end")).alias("torn")), "path", "left")
    headers = headers.join(blocks.select("path", "cut").distinct(), "path").select(
        "path", "body", "cut", F.coalesce("n_values", F.lit(0)).alias("n_values"),
        F.coalesce("torn", F.lit(False)).alias("torn"))
    parsed = jsonstat.parse(headers, count_col="n_values")
    parsed = _written(parsed.withColumn("reason", F.when(F.col("cut"), F.lit("cut_cell")).when(F.col("torn"), F.lit("split_text"))
                                        .otherwise(F.col("reason"))).drop("cut", "torn"), "cube-parsed")

    about = parsed.filter(F.col("reason").isNull() & (F.col("n_cells") > 0)).select("path", "doc", "ids", "sizes", "strides", "n_cells")
    base = splits.select("path", "part", "block", "base", "from")
    cells = (marked.drop("start").join(F.broadcast(base), ["path", "part", "block"])
             .withColumn("pos", F.col("base") + F.col("at") - F.col("from"))
             .join(F.broadcast(about), "path").filter((F.col("pos") >= 0) & (F.col("pos") < F.col("n_cells"))))
    text = F.trim(F.regexp_replace(F.regexp_replace("cell", r"(?s)\].*$", ""), r"\s+", " "))
    text = F.when(text != "null", F.regexp_replace(text, '^"|"$', ""))
    return parsed, cells.select("path", "doc", "ids", "sizes", "strides", "pos", text.alias("value"))


def unpack_split(spark: SparkSession, path: str | list[str], glob: str | None = None, keep: list[str] | None = None,
                 parts: bool = False) -> DataFrame:
    """Wide rows (as :func:`jsonstat.unpack`) of documents whose arrays are read by many tasks."""
    parsed, cell_rows = read_split(spark, path, glob, parts)
    return jsonstat.widen(parsed, jsonstat.dimension_columns(parsed), keep=keep, cell_rows=cell_rows)


def _place(at: str) -> Column:
    """Where a piece stands in its document; null where ``at`` is."""
    return F.when(F.col(at).isNotNull(), F.struct("part", "block", F.col(at).alias("at")))


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
