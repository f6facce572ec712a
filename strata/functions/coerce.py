"""String table to typed table (P10) and the lineage/year columns."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.values import first_year, to_bigint, to_double


# Text of whole and of decimal numbers (possessive: no backtracking).
_DIGITS = r"^\s*+[+-]?+[0-9]++\s*+$"
_DECIMAL = r"^\s*+[+-]?+(?:[0-9]++\.[0-9]*+|\.[0-9]++)(?:[eE][+-]?+[0-9]++)?+\s*+$"
_EXACT_DOUBLE = 15  # whole numbers of so many digits are exact as DOUBLE


def infer_string_types(df: DataFrame, columns: list[str] | None = None) -> dict[str, str]:
    """Decide BIGINT / DECIMAL / DOUBLE / STRING for each string column in one pass.

    The per-value rule, lifted to a column: text without ``.`` is a whole
    number or text, text with ``.`` a decimal number or text.  Blanks are
    ignored; a column of whole numbers is BIGINT, or DECIMAL(38,0) when some
    exceed it; one with decimal numbers is DOUBLE, unless a whole number in it
    would lose digits; anything else (``1e5``, ``nan``, longer numbers, blanks
    alone) stays STRING, so no value ever changes.  A single aggregate job
    returns a few flags per column -- never the data.
    """
    cols = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not cols:
        return {}

    def kind(v):  # 0 blank, 1 to 3 whole number by size, 4 too long, 8 decimal, 16 text
        digits = F.length(F.ltrim(F.regexp_replace(v, r"[+\s-]", ""), F.lit("0")))
        whole = (F.when(digits <= _EXACT_DOUBLE, 1).when(v.try_cast("bigint").isNotNull(), 2)
                 .when(digits <= 38, 3).otherwise(4))
        return (F.when(v.isNull() | (v == ""), 0).when(v.rlike(_DIGITS), whole)
                .when(v.contains("."), F.when(v.rlike(_DECIMAL), 8).otherwise(16)).otherwise(16))

    aggs = []
    for i, c in enumerate(cols):
        k = kind(F.col(c))
        aggs += [F.max(F.when(k < 8, k)).alias(f"w{i}"), F.max(k).alias(f"k{i}")]
    row = df.agg(*aggs).first()
    kinds = {}
    for i, c in enumerate(cols):
        whole, top = row[f"w{i}"] or 0, row[f"k{i}"] or 0
        if top == 8:
            kinds[c] = "double" if whole <= 1 else "string"
        else:
            kinds[c] = {1: "bigint", 2: "bigint", 3: "decimal(38,0)"}.get(top, "string")
    return kinds


def coerce_strings(df: DataFrame, kinds: dict[str, str] | None = None) -> DataFrame:
    """Blank to null and numeric text to numbers, per column (P10)."""
    kinds = kinds if kinds is not None else infer_string_types(df)
    out = []
    for c in df.columns:
        if c not in kinds:
            out.append(F.col(c))
            continue
        blank_null = F.nullif(F.col(c), F.lit(""))
        cast = {"string": lambda x: x, "bigint": to_bigint, "double": to_double,
                "decimal(38,0)": lambda x: F.trim(x).try_cast("decimal(38,0)")}[kinds[c]]
        out.append(cast(blank_null).alias(c))
    return df.select(*out)


def add_lineage(df: DataFrame, dataset: str | None = None, run_date: str | date | None = None,
                **extra) -> DataFrame:
    """Literal lineage columns: ``source_dataset``, ``ingestion_date``, others (P5).

    The run date is a parameter, so reruns of the same input are identical.
    """
    cols = {}
    if dataset is not None:
        cols["source_dataset"] = F.lit(dataset)
    if run_date is not None:
        cols["ingestion_date"] = F.lit(str(run_date))
    for name, value in extra.items():
        cols[name] = F.lit(value)
    return df.withColumns(cols) if cols else df


def ensure_year(df: DataFrame, run_year: int, col: str = "year") -> DataFrame:
    """Year from the first 4-digit run of ``col``, or ``run_year`` if absent."""
    if col in df.columns:
        return df.withColumn(col, first_year(col))
    return df.withColumn(col, F.lit(int(run_year)))


# Per cell: groups of digits may be joined by single underscores, as number literals are.
_CELL_WHOLE = r"^\s*+[+-]?+[0-9]++(?:_[0-9]++)*+\s*+$"
_CELL_DECIMAL = (r"^\s*+[+-]?+(?:[0-9]++(?:_[0-9]++)*+\.(?:[0-9]++(?:_[0-9]++)*+)?+|\.[0-9]++(?:_[0-9]++)*+)"
                 r"(?:[eE][+-]?+[0-9]++(?:_[0-9]++)*+)?+\s*+$")


def coerce_cell(col: Column | str) -> Column:
    """One text cell as a VARIANT of its own type (P10, per cell).

    Blank or null is null; text without ``.`` is a whole number (BIGINT, or DECIMAL up to 38
    digits) if it reads as one; text with ``.`` a DOUBLE if it reads as one; anything
    else stays text.  Whole numbers of more than 38 digits stay text, so no digit is lost.
    """
    c = F.col(f"`{col}`") if isinstance(col, str) else col
    digits = F.trim(F.regexp_replace(c, r"[_\s]", ""))
    variant = lambda x: x.cast(T.VariantType())
    whole = F.coalesce(variant(digits.try_cast("bigint")), variant(digits.try_cast("decimal(38,0)")), variant(c))
    return (F.when(c.isNull() | (c == ""), F.lit(None).cast(T.VariantType()))
            .when(c.rlike(_CELL_WHOLE), whole)
            .when(c.contains(".") & c.rlike(_CELL_DECIMAL), variant(digits.try_cast("double")))
            .otherwise(variant(c)))


def coerce_cells(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """String columns to VARIANT, each cell typed on its own (P10).

    Unlike :func:`coerce_strings` no value of a column depends on its other values, so it
    needs no pass over the column, and a column may hold numbers beside text.  VARIANT cells
    go through Parquet, ``to_json`` (as JSON numbers, strings and nulls) and
    ``try_variant_get`` unchanged.
    """
    cols = columns if columns is not None else [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.select(*[coerce_cell(c).alias(c) if c in cols else F.col(f"`{c}`") for c in df.columns])


def cell_kinds(df: DataFrame, columns: list[str], keep: list[str] = []) -> DataFrame:  # noqa: B006
    """Long form of VARIANT cells: ``keep``, column_name, kind (VOID, BIGINT, DECIMAL, DOUBLE,
    STRING) and the value in the column of its kind."""
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("cell")) for c in columns]))
    kind = F.regexp_extract(F.coalesce(F.schema_of_variant("cell"), F.lit("VOID")), "^[A-Z]+", 0)
    of = lambda k, t: F.when(F.col("kind") == k, F.try_variant_get("cell", "$", t))
    return (df.select(*keep, cells.alias("_c")).select(*keep, "_c.column_name", "_c.cell").withColumn("kind", kind)
            .select(*keep, "column_name", "kind", of("BIGINT", "bigint").alias("whole"), of("DOUBLE", "double").alias("number"),
                    F.coalesce(of("STRING", "string"), of("DECIMAL", "string")).alias("characters")))
