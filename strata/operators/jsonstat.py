"""JSON-stat 2 cube documents as Spark jobs.

A cube document holds ``id`` (dimension ids), ``size`` (category count per
dimension), ``dimension`` (labels and category order) and one flat
row-major ``value`` array.  The whole unpack runs on executors with
built-in expressions:

* one ``from_json`` per document parses the optional ``result`` envelope,
  an ``error`` reply and the cube itself in a single pass (N1);
* category order is resolved from its three spellings -- a dict
  code -> position, an ordered list, or missing/empty (label keys in
  document order) -- with ``from_json`` on the raw ``index`` text (N2);
* documents that cannot be unpacked are routed to :func:`rejects` with a
  reason instead of failing the job (S8, S9);
* cells and categories are exploded apart, each once: a cell row is narrow
  (position, value, the document's few sizes) and finds its category per
  dimension by stride arithmetic and an equi-join on (document, position), so
  work is linear in cells plus categories, and a cube of any shape spreads
  over tasks by its positions (N4);
* a category's label falls back to its code (N5); of a key that an object repeats the
  last entry counts, so every cell has one row.

Only metadata ever reaches the driver: the distinct (dimension id, label)
pairs used to name the columns of :func:`widen` (N6).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.names import clean_name
from strata.functions.values import to_double
from strata.session import scratch_path

_CATEGORY = T.StructType([
    T.StructField("index", T.StringType()),   # dict, list or absent: kept as text
    T.StructField("label", T.MapType(T.StringType(), T.StringType())),
])
_DIMENSION = T.StructType([
    T.StructField("label", T.StringType()),
    T.StructField("category", _CATEGORY),
])
_CUBE = [
    T.StructField("id", T.ArrayType(T.StringType())),
    T.StructField("size", T.ArrayType(T.IntegerType())),
    T.StructField("dimension", T.MapType(T.StringType(), _DIMENSION)),
    # cells as text: one ".." must not null the whole array; try_cast later
    T.StructField("value", T.ArrayType(T.StringType())),
]
# Envelope and cube parsed together: {"result": {...}} or a bare cube, or an
# error reply {"error": {...}} (its body kept as raw JSON text).
DOCUMENT_SCHEMA = T.StructType(
    [T.StructField("result", T.StructType(_CUBE)), T.StructField("error", T.StringType())]
    + _CUBE)

# Column names a dimension cannot take: the value, and what Silver adds.
RESERVED = ("metric_value", "year", "source_dataset", "ingestion_date")

# Reasons a document is rejected, in the order they are tested.
REJECT_REASONS = (
    "error_reply",        # {"error": ...} reply from the source
    "malformed",          # not JSON, or no id / size / dimension
    "no_values",          # value missing, null, or an object (sparse form)
    "shape_mismatch",     # id and size of different length, bad sizes
    "missing_dimension",  # an id without a dimension entry
    "short_codes",        # fewer category codes than the cells address
)


def _cube_col(field: str) -> Column:
    return F.coalesce(F.col(f"_doc.result.{field}"), F.col(f"_doc.{field}"))


_SPARSE = T.StructType([T.StructField("result", T.StructType([T.StructField("value", T.MapType(T.StringType(), T.StringType()))])),
                        T.StructField("value", T.MapType(T.StringType(), T.StringType()))])


def parse(docs: DataFrame, body_col: str = "body", sparse: bool = False, count_col: str | None = None) -> DataFrame:
    """Parse documents into one row per document with unpack metadata.

    ``docs`` needs a text column ``body_col``; every other column is kept
    (typically ``path``).  Added columns: ``doc`` (hash of the body: equal
    documents have equal categories), ``ids``, ``sizes``, ``codes``
    (category codes per dimension in position order), ``cat_labels``,
    ``dim_labels`` (dimension label, falling back to the id), ``strides``,
    ``n_cells`` (cells to emit: the shorter of the value array and the
    product of sizes), ``value`` and ``reason`` (null when accepted).

    With ``sparse`` a ``value`` that is an object of positions is accepted too (its
    entries are the column ``sparse``), else it is ``no_values``.  ``count_col`` names a
    column with the number of values of documents whose cells are read apart.
    """
    keep = [c for c in docs.columns if c not in (body_col, count_col)]
    # a second parse, of the documents without a value array only
    second = F.from_json("_body", _SPARSE) if sparse else F.lit(None).cast(_SPARSE)
    parsed = docs.select(*keep, F.md5(F.col(body_col).cast("binary")).alias("doc"),
                         F.from_json(F.col(body_col), DOCUMENT_SCHEMA).alias("_doc"), F.col(body_col).alias("_body"),
                         (F.col(count_col) if count_col else F.lit(0)).cast("int").alias("_apart"))
    dense = F.coalesce("_doc.result.value", "_doc.value")
    parsed = parsed.withColumn("_sparse", F.when(dense.isNull(), second) if sparse else second)
    parsed = parsed.withColumn("_sparse", F.coalesce("_sparse.result.value", "_sparse.value"))
    parsed = parsed.select(
        *keep, "doc",
        F.col("_doc.error").alias("_error"),
        F.when(F.col("_doc").isNull(), F.lit(True)).otherwise(F.lit(False)).alias("_null_doc"),
        _cube_col("id").alias("ids"),
        _cube_col("size").alias("sizes"),
        _cube_col("dimension").alias("_dimension"),
        _cube_col("value").alias("value"), F.col("_sparse").alias("sparse"), "_apart",
    )
    # Category order from one of three index spellings.
    # Each index text is read once, and entries are sorted by sort_array, without the
    # comparison in a lambda that array_sort makes of every pair.
    codes = F.expr("""
        transform(ids, d -> transform(array(named_struct(
            'dict', CASE WHEN ltrim(_dimension[d].category.index) LIKE '{%'
                         THEN from_json(_dimension[d].category.index, 'map<string,int>') END,
            'list', CASE WHEN ltrim(_dimension[d].category.index) LIKE '[%'
                         THEN from_json(_dimension[d].category.index, 'array<string>') END)), p -> CASE
          WHEN size(p.dict) > 0
            THEN transform(
                   sort_array(transform(
                     flatten(transform(array(sort_array(transform(
                       map_entries(p.dict),
                       (e, i) -> named_struct('code', e.key, 'at', i, 'pos', e.value)))),
                       a -> filter(a, (e, i) -> i + 1 = size(a) OR get(a, i + 1).code <> e.code))),
                     e -> named_struct('pos', e.pos, 'code', e.code))),
                   e -> e.code)
          WHEN size(p.list) > 0 THEN p.list
          ELSE coalesce(array_distinct(map_keys(_dimension[d].category.label)), array())
        END)[0])""")
    parsed = parsed.select(
        *keep, "doc", "_error", "_null_doc", "ids", "sizes", "_dimension", "value", "sparse", "_apart",
        codes.alias("codes"),
        F.expr("transform(ids, d -> _dimension[d].category.label)").alias("cat_labels"),
        F.expr("transform(ids, d -> coalesce(_dimension[d].label, d))").alias("dim_labels"),
        F.expr("""transform(sizes, (s, i) ->
                    aggregate(slice(sizes, i + 2, greatest(size(sizes), 1)), 1L,
                              (a, x) -> a * cast(x AS BIGINT)))""").alias("strides"),
        F.expr("aggregate(sizes, 1L, (a, x) -> a * cast(x AS BIGINT))").alias("_cells_total"),
    )
    given = F.greatest(F.size("value"), "_apart").cast("bigint")
    parsed = parsed.withColumn("n_cells", F.when(F.col("sparse").isNotNull(), F.col("_cells_total"))
                               .otherwise(F.least(given, F.col("_cells_total"))))
    # A dimension is short when a visited cell addresses a position past its
    # last code.  The highest position visited in dimension i over the first
    # n cells is size-1 after a full cycle, else (n-1) div stride.
    short = F.expr("""
        n_cells > 0 AND exists(sequence(0, size(ids) - 1), i ->
          size(codes[i]) <= CASE
            WHEN n_cells >= strides[i] * sizes[i] THEN sizes[i] - 1
            ELSE (n_cells - 1) div strides[i] END)""")
    bad_shape = F.expr(
        "size(ids) <> size(sizes) OR exists(sizes, s -> s IS NULL OR s < 0) "
        "OR exists(ids, d -> d IS NULL)")
    reason = (
        F.when(F.col("_error").isNotNull(), F.lit("error_reply"))
        .when(F.col("_null_doc") | F.col("ids").isNull() | F.col("sizes").isNull()
              | F.col("_dimension").isNull(), F.lit("malformed"))
        .when(F.col("value").isNull() & F.col("sparse").isNull(), F.lit("no_values"))
        .when(bad_shape, F.lit("shape_mismatch"))
        .when(F.expr("exists(ids, d -> _dimension[d] IS NULL)"), F.lit("missing_dimension"))
        .when(short, F.lit("short_codes"))
    )
    out = ["doc", "ids", "sizes", "codes", "cat_labels", "dim_labels", "strides", "n_cells", "value",
           *(["sparse"] if sparse else [])]
    # Bind the results through a one-row generator.  A later filter on
    # ``reason`` (or any derived column) then stops at the Generate instead
    # of being pushed down with the parse inlined into its condition, which
    # would re-run ``from_json`` on the whole document once per reference.
    return parsed.select(*keep, F.inline(F.array(F.struct(*out, reason.alias("reason")))))


def parsed_once(parsed: DataFrame) -> DataFrame:
    """``parsed`` written to the scratch folder, for uses that read it several times:
    columns, categories and cells would each read and parse all documents again."""
    path = scratch_path(parsed.sparkSession, "parsed")
    parsed.write.parquet(path)
    return parsed.sparkSession.read.schema(parsed.schema).parquet(path)


def rejects(parsed: DataFrame) -> DataFrame:
    """Documents that cannot be unpacked, with their reason."""
    keep = [c for c in parsed.columns if c not in _META_COLS]
    return parsed.filter(F.col("reason").isNotNull()).select(*keep, "reason")


def empty_dimensions(parsed: DataFrame) -> DataFrame:
    """Data-quality rows for dimensions without any category code."""
    keep = [c for c in parsed.columns if c not in _META_COLS]
    return (parsed.filter(F.col("reason").isNull())
            .select(*keep, F.posexplode(F.arrays_zip("ids", "codes")).alias("dim_pos", "d"))
            .filter(F.size("d.codes") == 0)
            .select(*keep, F.col("d.ids").alias("dimension_id")))


_META_COLS = {"doc", "ids", "sizes", "codes", "cat_labels", "dim_labels", "strides",
              "n_cells", "value", "sparse", "reason"}
SPARSE_BLOCK = 4096  # positions listed at a time


def cells(parsed: DataFrame) -> DataFrame:
    """One narrow row per cell of every accepted document.

    Output: the document's own columns, ``doc``, ``ids``, ``sizes``,
    ``strides`` (a few numbers each), ``pos`` (row-major position) and
    ``value`` (raw text).  No category travels with a cell.
    """
    keep = [c for c in parsed.columns if c not in _META_COLS]
    ok = parsed.filter(F.col("reason").isNull() & (F.col("n_cells") > 0))
    own = [*keep, "doc", "ids", "sizes", "strides"]
    dense = ok.select(*own, F.posexplode(F.expr("slice(value, 1, cast(n_cells AS INT))")).alias("pos", "value"))
    if "sparse" not in parsed.columns:
        return dense
    # every position of a sparse cube, a block at a time, meets its entry by an equi-join
    blocks = ok.filter(F.col("sparse").isNotNull()).select(
        *own, "n_cells", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_cells") - 1) / SPARSE_BLOCK))).alias("_b"))
    last = F.least((F.col("_b") + 1) * SPARSE_BLOCK, F.col("n_cells")) - 1
    places = blocks.select(*own, F.explode(F.sequence(F.col("_b") * SPARSE_BLOCK, last)).alias("pos"))
    filled = places.join(sparse_entries(ok).filter("inside").select("doc", "pos", "value"), ["doc", "pos"], "left")
    return dense.withColumn("pos", F.col("pos").cast("long")).unionByName(filled.select(*own, "pos", "value"))


_PLACE = r"^\s*+\+?+[0-9]{1,18}+\s*+$"


def sparse_entries(parsed: DataFrame) -> DataFrame:
    """Entries of sparse values: ``(doc, key, pos, value, inside)``, the last of a repeated
    position; ``inside`` is false for a key that is no position of the cube."""
    rows = parsed.filter(F.col("reason").isNull() & F.col("sparse").isNotNull()).select(
        "doc", "n_cells", F.posexplode("sparse").alias("_at", "key", "value"))
    rows = rows.withColumn("pos", F.when(F.col("key").rlike(_PLACE), F.trim("key").try_cast("bigint")))
    rows = rows.withColumn("inside", F.coalesce(F.col("pos") < F.col("n_cells"), F.lit(False)))
    spot = F.when(F.col("inside"), F.col("pos").cast("string")).otherwise(F.col("key"))
    return (rows.groupBy("doc", "inside", spot.alias("_spot"))
            .agg(F.max_by("key", "_at").alias("key"), F.max("pos").alias("pos"), F.max_by("value", "_at").alias("value"))
            .select("doc", "key", "pos", "value", "inside"))


def dropped_positions(parsed: DataFrame) -> DataFrame:
    """Entries of sparse values that lie outside their cube: the documents' own columns,
    ``key``, ``value``, ``reason``."""
    keep = [c for c in parsed.columns if c not in _META_COLS]
    return (parsed.select(*keep, "doc").join(sparse_entries(parsed).filter(~F.col("inside")), "doc")
            .select(*keep, "key", "value", F.lit("position outside the cube").alias("reason")))


def categories(parsed: DataFrame) -> DataFrame:
    """Category labels of the accepted documents (N5): ``(doc, dim_id, position, label)``.

    Codes and labels are exploded apart and joined, so a dimension of a
    million categories costs a million rows each and no look-up per code.  A key
    that a label object repeats keeps its last label, as JSON objects are read.
    """
    ok = parsed.filter(F.col("reason").isNull() & (F.col("n_cells") > 0)).select("doc", "ids", "codes", "cat_labels")
    per_dim = ok.select("doc", F.inline(F.arrays_zip(
        F.col("ids").alias("dim_id"), F.col("codes").alias("codes"), F.col("cat_labels").alias("labels"))))
    codes = per_dim.select("doc", "dim_id", F.posexplode("codes").alias("position", "code")).distinct()
    labels = (per_dim.select("doc", "dim_id", F.posexplode("labels").alias("at", "code", "label"))
              .groupBy("doc", "dim_id", "code").agg(F.max_by("label", "at").alias("label")))
    return (codes.join(labels, ["doc", "dim_id", "code"], "left")
            .select("doc", "dim_id", "position", F.coalesce("label", "code").alias("label")))


def dimension_columns(parsed: DataFrame) -> list[tuple[str, str]]:
    """(dimension id, column name) pairs over all accepted documents.

    A ``TLIST`` dimension becomes ``period``; any other takes its cleaned
    label.  Ids of one name in different documents share the column (annual
    and monthly time ids, say); ids of one name in the *same* document keep
    apart, the later ones with their id appended.  A label that would take a
    reserved name gets ``_dimension`` appended.  Only the distinct ids and
    labels are collected -- a handful of rows -- never cells.  Order: first
    position in ``id``, then id.
    """
    ok = parsed.filter(F.col("reason").isNull())
    rows = (ok.select(F.posexplode(F.arrays_zip("ids", "dim_labels")).alias("i", "d"))
            .groupBy(F.col("d.ids").alias("id"))
            .agg(F.min("i").alias("i"), F.max("d.dim_labels").alias("label"))
            .orderBy("i", "id").collect())
    named = [(r["id"], column_name(r["id"], r["label"])) for r in rows]
    taken: dict[str, list[str]] = {}
    for dim_id, name in named:
        taken.setdefault(name, []).append(dim_id)
    out, used = [], set(taken)
    for dim_id, name in named:
        before = taken[name][:taken[name].index(dim_id)]
        if before and _meet(ok, dim_id, before):
            name = f"{name}_{clean_name(dim_id)}"
            while name in used:
                name += "_"
            used.add(name)
        out.append((dim_id, name))
    return out


def _meet(parsed: DataFrame, dim_id: str, others: list[str]) -> bool:
    """Whether a document holds ``dim_id`` and one of ``others``."""
    both = F.array_contains("ids", dim_id) & F.arrays_overlap("ids", F.array(*[F.lit(o) for o in others]))
    return not parsed.filter(both).select("doc").isEmpty()


def column_name(dim_id: str, label: str | None) -> str:
    """Column name for a dimension: ``period`` for time, else the clean label."""
    if "TLIST" in dim_id:
        return "period"
    name = clean_name(label if label is not None else dim_id)
    return f"{name}_dimension" if name in RESERVED else name


def widen(parsed: DataFrame, columns: list[tuple[str, str]], value_name: str = "metric_value",
          keep: list[str] | None = None, cell_rows: DataFrame | None = None) -> DataFrame:
    """One row per cell: a column per dimension plus the value as DOUBLE.

    ``cell_rows`` replaces :func:`cells` for documents whose cells are read apart.

    Every dimension is one equi-join of the cells with that dimension's
    categories on (document, position); a column that several ids share takes
    the one the document has.  The categories are written to the scratch
    folder first, so documents are parsed once for them, not per dimension.  JSON-stat's ``".."`` and other non-numbers
    become null.  ``keep`` names document columns, or ``pos``.
    """
    keep = keep or []
    spark = parsed.sparkSession
    cats, path = categories(parsed), scratch_path(spark, "categories")
    cats.write.parquet(path)
    cats = spark.read.schema(cats.schema).parquet(path)

    def position(dim_id: str) -> Column:
        i = F.array_position("ids", dim_id).cast("int") - 1
        stride, size = F.get("strides", i), F.get("sizes", i).cast("bigint")
        return F.when(i >= 0, F.pmod(F.floor(F.col("pos") / stride).cast("bigint"), size))

    places = [position(dim_id).cast("int").alias(f"_p{k}") for k, (dim_id, _) in enumerate(columns)]
    rows = (cells(parsed) if cell_rows is None else cell_rows).select(*[F.col(c).alias(f"_k{k}") for k, c in enumerate(keep)], "doc", "value", *places)
    for k, (dim_id, _) in enumerate(columns):
        own = cats.filter(F.col("dim_id") == dim_id).select(
            F.col("doc"), F.col("position").alias(f"_p{k}"), F.col("label").alias(f"_l{k}"))
        rows = rows.join(own, ["doc", f"_p{k}"], "left")
    by_name: dict[str, list[str]] = {}
    for k, (_, name) in enumerate(columns):
        by_name.setdefault(name, []).append(f"_l{k}")
    return rows.select(*[F.col(f"_k{k}").alias(c) for k, c in enumerate(keep)],
                       *[F.coalesce(*ls).alias(name) for name, ls in by_name.items()],
                       to_double("value").alias(value_name))


def unpack(docs: DataFrame, body_col: str = "body", columns: list[tuple[str, str]] | None = None,
           keep: list[str] | None = None, sparse: bool = False) -> DataFrame:
    """Documents to a wide table: one row per cell, one column per dimension.

    All documents of ``docs`` land in one table (N8); a dimension absent from
    a document is null in its rows.  Pass ``columns`` to skip the small
    discovery job that names the columns.
    """
    parsed = parsed_once(parse(docs, body_col, sparse))
    return widen(parsed, dimension_columns(parsed) if columns is None else columns, keep=keep)
