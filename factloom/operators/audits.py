"""Audits of catalogue columns: descriptions, abbreviations, missing history.

``cols`` is a table of catalogue columns as made by ``factloom.sources.catalog``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Column names that show validity intervals, and names that show overwriting.
VALIDITY_NAMES = ["valid_from", "valid_to", "valid_time_start", "valid_time_end"]
UPDATE_NAMES = ["updated_at", "modified_at", "last_modified"]


def _in_schema(df: DataFrame, schema: str | None) -> DataFrame:
    return df if schema is None else df.filter(F.col("table_schema") == schema)


def audit_descriptions(cols: DataFrame, min_len: int = 20, schema: str | None = None) -> DataFrame:
    """Grade the description of every column as MISSING, TOO_SHORT or OK."""
    text = F.col("comment")
    grade = (
        F.when(text.isNull() | (text == ""), "MISSING")
        .when(F.length(text) < min_len, "TOO_SHORT")
        .otherwise("OK")
    )
    return (
        _in_schema(cols, schema)
        .select(
            "table_name",
            "column_name",
            "data_type",
            text.alias("catalog_description"),
            grade.alias("description_quality"),
        )
        .orderBy("description_quality", "table_name", "column_name")
    )


def audit_abbreviations(
    cols: DataFrame, schema: str | None = None, bracket_pattern: bool = False
) -> DataFrame:
    """Names likely to be abbreviations.

    A short name without an underscore is a possible abbreviation. ``bracket_pattern=True``
    tests for a literal bracketed character instead, which is what the pattern ``%[_]%``
    means to engines without bracket classes.
    """
    name = F.col("column_name")
    spelled_out = name.like("%[_]%") if bracket_pattern else name.contains("_")
    risk = (
        F.when(F.length(name) <= 4, "LIKELY_ABBREVIATION")
        .when(~spelled_out & (F.length(name) <= 8), "POSSIBLE_ABBREVIATION")
        .otherwise("OK")
    )
    return (
        _in_schema(cols, schema)
        .select("table_name", "column_name", F.length(name).alias("name_length"), risk.alias("naming_risk"))
        .orderBy("naming_risk", "table_name", "column_name")
    )


def audit_temporal(cols: DataFrame, tables: DataFrame, schema: str | None = None) -> DataFrame:
    """Does a base table keep history, overwrite it, or show neither?"""
    name = F.col("column_name")
    base = _in_schema(tables, schema).filter(F.col("table_type") == "BASE TABLE")
    # Columns are reduced to one row per table before the join.
    shapes = (
        _in_schema(cols, schema)
        .groupBy("table_schema", "table_name")
        .agg(
            F.max(name.isin(VALIDITY_NAMES)).alias("keeps"),
            F.max(name.isin(UPDATE_NAMES)).alias("overwrites"),
            F.count(name).alias("n"),
        )
    )
    pattern = (
        F.when(F.max("keeps"), "HAS_TEMPORAL_METADATA")
        .when(F.max("overwrites"), "OVERWRITE_PATTERN_ONLY")
        .otherwise("NO_TEMPORAL_METADATA")
    )
    return (
        base.select("table_schema", "table_name")
        .join(shapes, ["table_schema", "table_name"])
        .groupBy("table_name")
        .agg(pattern.alias("temporal_pattern"), F.sum("n").alias("total_columns"))
        .orderBy("temporal_pattern", "table_name")
    )
