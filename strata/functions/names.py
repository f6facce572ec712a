"""Column-name operators."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

from strata.fixed_values import CUBE_NAME_BLANKS, EXTRACT_CODE_COLUMNS, NAME_DROPPED


def clean_name(name: str, blanks: str = CUBE_NAME_BLANKS, dropped: str = NAME_DROPPED) -> str:
    """A label as a column name: lower case, trimmed, each character of ``blanks`` an
    underscore, those of ``dropped`` gone."""
    table = {**{ord(c): "_" for c in blanks}, **{ord(c): None for c in dropped}}
    return name.strip().lower().translate(table)


def clean_columns(df: DataFrame, blanks: str = CUBE_NAME_BLANKS, dropped: str = NAME_DROPPED) -> DataFrame:
    """Rename every column with :func:`clean_name`."""
    return df.toDF(*[clean_name(c, blanks, dropped) for c in df.columns])


def rename_synonyms(df: DataFrame, synonyms: dict[str, str],
                    patterns: dict[str, str] | None = None) -> DataFrame:
    """Rename columns by an exact synonym map, then by regex patterns.

    Names absent from ``df`` are ignored.  A pattern applies only to columns
    not already renamed and only if its target name is still free.
    """
    mapping = {c: synonyms[c] for c in df.columns if c in synonyms}
    taken = set(mapping.values()) | {c for c in df.columns if c not in mapping}
    for pattern, target in (patterns or {}).items():
        rx = re.compile(pattern)
        for c in df.columns:
            if c not in mapping and target not in taken and rx.match(c):
                mapping[c] = target
                taken.add(target)
    return df.withColumnsRenamed(mapping) if mapping else df


def drop_matching(df: DataFrame, patterns: list[str]) -> DataFrame:
    """``df`` without the columns whose name one of the regular expressions finds."""
    found = re.compile("|".join(f"(?:{p})" for p in patterns)) if patterns else None
    return df.drop(*[c for c in df.columns if found and found.search(c)])


def drop_code_columns(df: DataFrame, patterns: list[str] = EXTRACT_CODE_COLUMNS) -> DataFrame:
    """The label columns of a flat cube extract: code columns go."""
    return drop_matching(df, patterns)
