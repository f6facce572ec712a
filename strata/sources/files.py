"""File discovery, CSV scans, raw landing and the load manifest."""

from __future__ import annotations

import csv
import io
import re
from urllib.parse import unquote, urlparse

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.names import rename_synonyms
from strata.operators.quality import LANDING_FOLDERS, mark_superseded
from strata.operators.spine import union_by_name

LATIN1 = "ISO-8859-1"

FILE_COLUMNS = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("length", T.LongType()),
    T.StructField("modified", T.TimestampType()),
])


def list_files(spark: SparkSession, path: str | list[str], glob: str = "*.csv") -> DataFrame:
    """Files under ``path`` matching ``glob``: ``(path, length, modified)``.

    Uses the ``binaryFile`` source without selecting ``content``, so no file
    body is read: this is a distributed listing.  A missing path lists
    nothing; zero-length files are skipped by Spark's file scans and so are
    not listed either (they hold no rows).
    """
    try:
        files = (spark.read.format("binaryFile")
                 .option("pathGlobFilter", glob)
                 .option("recursiveFileLookup", "true")
                 .load(path))
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            return spark.createDataFrame([], FILE_COLUMNS)
        raise
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def file_headers(spark: SparkSession, paths: str | list[str], encoding: str = LATIN1, glob: str | None = None) -> DataFrame:
    """Header of each file that has one: ``(path, header)``.

    ``paths`` are files, or with ``glob`` also folders, looked through at any depth.

    The header is the first line with text, read with Spark's own text source
    (any file system and line ending it reads, no length limit): the least line number
    per file over the split that starts it, so one number per file is
    shuffled.  Costs two passes over the bytes and keeps the driver out of it.
    """
    reader = spark.read
    if glob is not None:
        reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    lines = (reader.text(paths)
             .select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_start"),
                     F.decode(F.col("value").cast("binary"), encoding).alias("line"))
             .withColumn("_n", F.monotonically_increasing_id()))
    # least numbers are found without a sort, which the least line by number would take; the
    # second pass picks these lines
    texts = lines.filter((F.col("_start") == 0) & F.col("line").rlike(r"\S"))
    firsts = texts.groupBy("path").agg(F.min("_n").alias("_n"))
    first = lines.join(F.broadcast(firsts.select("_n")), "_n").select("path", F.col("line").alias("header"))
    mark = "\ufeff" if encoding.upper().startswith("UTF") else "\xef\xbb\xbf"
    return first.select("path", F.regexp_replace("header", f"^{mark}", "").alias("header"))


def split_header(line: str, sep: str = ",", quote: str = '"') -> list[str]:
    """Column names of a CSV header line (doubled quotes inside quotes).

    A header that does not end in its own line raises ``ValueError``.
    """
    if line.count(quote) % 2:
        raise ValueError("header spans several lines")
    limit = csv.field_size_limit(max(len(line) + 1, 131_072))
    try:
        return next(csv.reader(io.StringIO(line), delimiter=sep, quotechar=quote, doublequote=True))
    finally:
        csv.field_size_limit(limit)


def safe_names(names: list[str]) -> list[str]:
    """Distinct column names in the way Spark's own header reading makes them: an empty
    name becomes ``_c<i>``, names equal but for case get their position appended."""
    count: dict[str, int] = {}
    for n in names:
        count[n.lower()] = count.get(n.lower(), 0) + 1
    return [f"_c{i}" if not n else f"{n}{i}" if count[n.lower()] > 1 else n for i, n in enumerate(names)]


def read_csv_explicit(spark: SparkSession, path: str | list[str],
                      schema: T.StructType | str | None = None, *, header: bool = True,
                      encoding: str = "UTF-8", infer: bool = False, sep: str = ",",
                      recursive: bool = True) -> DataFrame | None:
    """CSV scan with doubled-quote escaping.

    An explicit ``schema`` saves the inference pass; without one every column
    is a string named from the header (``infer=True`` asks Spark to infer
    types, one extra pass).  ``encoding`` may be ``ISO-8859-1`` for latin-1
    sources.  Returns ``None`` when the path does not exist.
    """
    reader = (spark.read.option("header", header).option("encoding", encoding)
              .option("quote", '"').option("escape", '"').option("sep", sep)
              .option("mode", "PERMISSIVE"))
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", infer)
    try:
        return reader.csv(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            return None
        raise


RECORD = "_corrupt_record"
REJECT_SCHEMA = "path string, reason string, record string"


def read_csv_by_header(spark: SparkSession, path: str | list[str], synonyms: dict[str, str],
                       patterns: dict[str, str] | None = None, *, encoding: str = LATIN1,
                       glob: str = "*.csv", required: list[str] | None = None,
                       canonical: list[str] | None = None,
                       file_col: str | None = "source_file") -> tuple[DataFrame | None, DataFrame]:
    """Read CSV files whose headers differ, joined by column *name*.

    Files are grouped by their header line; each group is one CSV scan with
    an all-string schema taken from that header, renamed to canonical names
    (``synonyms`` exact, ``patterns`` regex), and the groups are unioned by
    name with absent columns null.  The scan count is the number of distinct
    headers, not of files.  A joint scan of all files would bind columns by
    *position* to one file's header, which is wrong when headers differ.

    One job lists the headers; what reaches the driver is one (path, header)
    pair per file, which the CSV reader's file index holds there anyway.

    Returns ``(rows, rejects)``; ``rejects`` is ``(path, reason, record)``.
    Files without any header line, with a header that cannot be split, or
    whose group lacks a ``required`` canonical column are set aside with a
    null ``record``; nothing ends the run.  A header with repeated names is
    noted (``duplicate header``) and read with its names made distinct.  Rows
    with fewer or more fields than the header stay, padded or cut as Spark
    reads them, and are noted with their text.  Every ``canonical`` column
    exists in ``rows`` (null when no file has it).
    """
    listed = [r["path"] for r in list_files(spark, path, glob).select("path").collect()]
    if not listed:
        return None, spark.createDataFrame([], REJECT_SCHEMA)
    heads = {r["path"]: r["header"] for r in file_headers(spark, path, encoding, glob).collect()}
    groups: dict[str | None, list[str]] = {}
    by_place = {_plain(p): h for p, h in heads.items()}
    for p in listed:
        groups.setdefault(by_place.get(_plain(p)), []).append(p)
    folders = _folders_of_one_group(path, groups)
    frames, notes, odd = [], [], []
    for header, paths in sorted(groups.items(), key=lambda kv: kv[0] or ""):
        if header is None:
            notes += [(p, "no header", None) for p in paths]
            continue
        try:
            names = split_header(header)
        except (ValueError, csv.Error) as exc:
            notes += [(p, f"bad header: {exc}", None) for p in paths]
            continue
        if len({n.lower() for n in names}) < len(names):
            notes += [(p, "duplicate header", None) for p in paths]
        schema = T.StructType([T.StructField(n, T.StringType()) for n in safe_names(names)])
        renamed = rename_synonyms(spark.createDataFrame([], schema), synonyms, patterns).columns
        missing = [c for c in (required or []) if c not in renamed]
        if missing:
            notes += [(p, f"missing column {missing[0]}", None) for p in paths]
            continue
        # one listing of the group's files for its rows and its odd rows
        full = T.StructType([*schema.fields, T.StructField(RECORD, T.StringType())])
        read = (spark.read.schema(full).option("header", True).option("encoding", encoding).option("quote", '"')
                .option("escape", '"').option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RECORD)
                .option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
                .csv(sorted({folders.get(p, p) for p in paths})))
        df = rename_synonyms(read.drop(RECORD), synonyms, patterns)
        if file_col:
            df = df.withColumn(file_col, F.col("_metadata.file_path"))
        frames.append(df)
        odd.append(_odd_rows(read, schema))
    rejects = spark.createDataFrame(notes, REJECT_SCHEMA)
    for rows in odd:
        rejects = rejects.unionByName(rows)
    if not frames:
        return None, rejects
    rows = union_by_name(frames)
    for c in canonical or []:
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(None).cast("string"))
    return rows, rejects


def _plain(path: str) -> str:
    """A listed path and a metadata path as one spelling (scheme slashes, percent signs)."""
    uri = urlparse(path)
    return f"{uri.scheme}:{uri.netloc}{unquote(uri.path)}"


def _folders_of_one_group(given: str | list[str], groups: dict[str | None, list[str]]) -> dict[str, str]:
    """File -> its folder, for files whose folder holds files of one header alone.

    A listing costs a task per path, so such a folder is read by its name.  Only below
    given folders: a given file, or a pattern, may leave out others of its folder.
    """
    given = [given] if isinstance(given, str) else given
    bare = lambda p: unquote(urlparse(p).path).rstrip("/")
    listed = {bare(p) for paths in groups.values() for p in paths}
    if any(re.search(r"[*?\[{]", g) or bare(g) in listed for g in given):
        return {}
    held: dict[str, set] = {}  # folder -> headers at any depth below it
    for header, paths in groups.items():
        for p in paths:
            folder = p
            while "/" in folder:
                folder = folder.rsplit("/", 1)[0]
                held.setdefault(folder, set()).add(header)
    own = {p: p.rsplit("/", 1)[0] for paths in groups.values() for p in paths}
    return {p: folder for p, folder in own.items() if len(held[folder]) == 1}


def _odd_rows(read: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows that have fewer or more fields than the header (S8): (path, reason, record)."""
    # every column is referenced, as fields are only counted where all are wanted
    every = F.length(F.concat_ws("", *[F.col(f"`{f.name}`") for f in schema.fields])) >= 0
    rows = read.filter(every).select(F.col("_metadata.file_path").alias("path"), F.col(RECORD).alias("record"))
    bare = F.regexp_replace("record", r'"(?:[^"]|"")*"', "")
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    return rows.filter(F.col("record").isNotNull()).select(
        "path", F.when(fields > len(schema), F.lit("too many fields")).otherwise(F.lit("too few fields")).alias("reason"),
        "record")


def land_raw(df: DataFrame, root: str, partition_by: list[str] | tuple[str, ...] = ("dataset", "year", "month"),
             fmt: str = "csv", encoding: str = "UTF-8", dataset_path: str | None = None) -> None:
    """Append records to a Bronze drop folder.

    Files go to ``root/dataset=/year=/month=/``, or, with ``dataset_path``
    (``cso/house_price_index``), to ``root/<dataset_path>/year=/month=/``, the
    layout the batch jobs read.  ``fmt="csv"`` writes every file with its
    header line; ``fmt="text"`` writes one document per line (``df`` holds one
    string column besides the partition columns).  Bronze is append-only:
    nothing is overwritten.
    """
    if dataset_path is not None:
        root = f"{root.rstrip('/')}/{dataset_path}"
        partition_by = [c for c in partition_by if c != "dataset"]
        df = df.drop("dataset")
    writer = df.write.mode("append").partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", True).option("encoding", encoding).option("quote", '"') \
              .option("escape", '"').csv(root)
    elif fmt == "text":
        writer.text(root)
    else:
        raise ValueError(f"unknown landing format {fmt}")


def load_manifest(spark: SparkSession, root: str, datasets: list[str] | None = None,
                  glob: str = "*", header_lines: int = 1, since=None) -> DataFrame:
    """One row per landed file, plus one per expected dataset without data.

    Columns: ``dataset, status, key, row_count, error``.  ``row_count`` is the
    line count minus the header, from a distributed line count grouped by
    file.  ``key`` is the path relative to ``root``; ``dataset`` is its
    ``dataset=`` folder, or else the folders before the first ``name=value``
    folder (``cso/house_price_index``).  An expected dataset with no
    non-empty file is ``failed`` with error ``no data landed``.  ``since`` (a
    timestamp, or text in the session time zone) limits the manifest to files
    landed at or after it -- one landing run -- and only those files are
    read.
    """
    root = root.rstrip("/")
    listed = list_files(spark, root, glob)
    if since is not None:
        listed = listed.filter(F.col("modified") >= F.lit(since).cast("timestamp"))
    # both sides name a file by its decoded path, whatever spelling Spark gives
    place = lambda c: F.regexp_replace(F.try_url_decode(F.regexp_replace(c, r"\+", "%2B")), r"^([a-z0-9]+):/+", "$1:/")
    plain = F.regexp_replace("path", r"^([a-z0-9]+):/+", "$1:/")
    files = listed.select(plain.alias("path"))
    if since is None:
        source = [root] if not listed.isEmpty() else []
    else:
        source = [r["path"] for r in listed.select("path").collect()]
    counted = spark.createDataFrame([], "path string, lines long")
    if source:
        counted = (spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).text(source)
                   .groupBy(place(F.col("_metadata.file_path")).alias("path"))
                   .agg(F.count(F.lit(1)).alias("lines")))
    per_file = files.join(counted, "path", "left")
    lines = F.coalesce(F.col("lines"), F.lit(0))
    root_dir = urlparse(root).path.rstrip("/") or root
    key = F.substring_index(F.col("path"), root_dir + "/", -1)
    named = F.regexp_extract(key, r"dataset=([^/]+)", 1)
    folders = F.regexp_replace(F.regexp_replace(key, r"(^|/)[^/]*=.*$", ""), r"/?[^/]*\.[^/.]+$", "")
    manifest = per_file.select(
        F.when(named != "", F.try_url_decode(named)).otherwise(folders).alias("dataset"),
        F.when(lines > 0, F.lit("success")).otherwise(F.lit("failed")).alias("status"),
        key.alias("key"),
        F.greatest(lines - F.lit(header_lines), F.lit(0)).cast("bigint").alias("row_count"),
        F.when(lines == 0, F.lit("empty file")).alias("error"),
    )
    if datasets:
        expected = spark.createDataFrame([(d,) for d in datasets], "dataset string")
        absent = (expected.join(manifest.select("dataset").distinct(), "dataset", "left_anti")
                  .select("dataset", F.lit("failed").alias("status"), F.lit(None).cast("string").alias("key"),
                          F.lit(None).cast("bigint").alias("row_count"),
                          F.lit("no data landed").alias("error")))
        manifest = manifest.unionByName(absent)
    return manifest


def manifest_tally(manifest: DataFrame) -> DataFrame:
    """Success / failure count over a manifest: ``(status, n)``."""
    return manifest.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def newest_snapshot_files(spark: SparkSession, path: str | list[str], glob: str = "*",
                          folders: tuple[str, ...] = LANDING_FOLDERS) -> tuple[list[str], list[str]]:
    """Files under ``path`` to read, and those a newer landing replaces.

    Decided from the file listing alone -- no file body is read -- so older
    snapshots are never scanned.  Every file of each dataset's newest landing
    is read; see :func:`strata.operators.quality.mark_superseded`.  Returns
    file paths (metadata: Spark's own file index holds them on the driver).
    """
    rows = mark_superseded(list_files(spark, path, glob).select("path"), "path", folders).collect()
    return (sorted(r["path"] for r in rows if not r["superseded"]), sorted(r["path"] for r in rows if r["superseded"]))
