"""Glossary references, enrichment, glossary upkeep.

A glossary has canonical_term, definition, calculation, synonyms, excludes,
business_context and status; only active entries are resolved.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factloom.functions.text import term_names
from factloom.functions.time import clock
from factloom.plans.frontier import reach

TERM_COLUMNS = ["canonical_term", "definition", "calculation", "synonyms", "excludes", "business_context"]


def term_references(descriptions: DataFrame) -> DataFrame:
    """Bracketed term references, in order: the other columns, ref_position, term."""
    others = [c for c in descriptions.columns if c != "description"]
    return descriptions.select(*others, F.posexplode(term_names(F.col("description")))).select(
        *others, F.col("pos").alias("ref_position"), F.col("col").alias("term")
    )


def glossary_names(glossary: DataFrame) -> DataFrame:
    """One row per name an active entry answers to; a canonical name beats a synonym, and
    among equal claims the first canonical term in alphabetical order wins."""
    active = glossary.filter(F.col("status") == "active").select(
        F.col("canonical_term"),
        "definition",
        "calculation",
        F.coalesce("synonyms", F.array().cast("array<string>")).alias("synonyms"),
        F.coalesce("excludes", F.array().cast("array<string>")).alias("excludes"),
        "business_context",
    )
    own = active.select(F.col("canonical_term").alias("term"), F.lit(0).alias("_rank"), *TERM_COLUMNS)
    other = active.select(
        F.explode(F.array_distinct("synonyms")).alias("term"), F.lit(1).alias("_rank"), *TERM_COLUMNS
    )
    return (
        own.unionByName(other)
        .groupBy("term")
        .agg(F.min_by(F.struct(*TERM_COLUMNS), F.struct("_rank", "canonical_term")).alias("_entry"))
        .select("term", *[F.col("_entry")[c].alias(c) for c in TERM_COLUMNS])
    )


def resolve_terms(refs: DataFrame, glossary: DataFrame) -> DataFrame:
    """The glossary entry each reference stands for; unresolved references drop out."""
    return refs.join(glossary_names(glossary), "term")


def table_context(descriptions: DataFrame, glossary: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Per table, the map from each term referenced by its columns to the entry.

    With ``columns`` only the descriptions of these are looked at. Built once per table from its distinct references, so a map has at most as many entries
    as the glossary has names, whatever the number of columns or records.
    """
    if columns is not None:
        descriptions = descriptions.filter(F.col("column_name").isin(columns))
    distinct = term_references(descriptions).select("table_name", "term").distinct()
    return (
        resolve_terms(distinct, glossary)
        .groupBy("table_name")
        .agg(F.map_from_entries(F.collect_list(F.struct("term", F.struct(*TERM_COLUMNS)))).alias("semantic_context"))
        .withColumn("total_terms_expanded", F.size("semantic_context"))
    )


def enrich(
    records: DataFrame, descriptions: DataFrame, glossary: DataFrame, key: str = "record_id"
) -> DataFrame:
    """Records with the meaning of every term their columns' descriptions refer to.

    ``records`` has table_name, the key and the data columns; ``descriptions`` has
    table_name, column_name and description. Columns that the records do not have explain
    nothing here, so a projected record tells nothing about what was left out. The context of
    a table is joined to its records. A term written as a synonym and as its canonical name counts twice.
    """
    data = [c for c in records.columns if c not in ("table_name", key)]
    context = table_context(descriptions, glossary, data)
    return records.join(context, "table_name", "left").select(
        "table_name",
        key,
        F.struct(*data).alias("data_values"),
        "semantic_context",
        F.coalesce("total_terms_expanded", F.lit(0)).alias("total_terms_expanded"),
    )


def assemble_text(
    records: DataFrame, descriptions: DataFrame, glossary: DataFrame, key: str = "record_id"
) -> DataFrame:
    """One text per record: its values, then the definitions that its own columns refer to."""
    data = [c for c in records.columns if c not in ("table_name", key)]
    values = [
        F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{c}: "), F.col(c).cast("string"))) for c in data
    ]
    notes = (
        table_context(descriptions, glossary, data)
        .select(
            "table_name",
            F.array_join(
                F.transform(
                    F.array_sort(F.map_entries("semantic_context")),
                    lambda e: F.concat(e["key"], F.lit(" = "), e["value"]["definition"]),
                ),
                "; ",
            ).alias("_notes"),
        )
    )
    return records.join(notes, "table_name", "left").select(
        "table_name", key, F.concat_ws("\n", F.concat_ws(", ", *values), F.col("_notes")).alias("text")
    )


def glossary_upsert(glossary: DataFrame, rows: DataFrame, as_of) -> tuple[DataFrame, DataFrame]:
    """The glossary with new entries added, and the rows refused.

    A canonical term is unique: rows whose term exists already are refused, and of several new
    rows with one term the least is taken and the others are refused, exact repeats too, so
    added and refused rows are together those given. ``reviewed_at`` and ``created_at``
    default to ``as_of``, ``status`` to active.
    """
    now = clock(as_of)
    defaults = {"status": F.lit("active"), "reviewed_at": now, "created_at": now}
    shaped = rows.select(
        *[
            F.coalesce(F.col(c) if c in rows.columns else F.lit(None), defaults.get(c, F.lit(None)))
            .cast(glossary.schema[c].dataType)
            .alias(c)
            for c in glossary.columns
        ]
    )
    rest = [c for c in glossary.columns if c != "canonical_term"]
    known = glossary.select("canonical_term").distinct().withColumn("_known", F.lit(True))
    # Repeats are counted before rows of one term meet.
    counted = shaped.groupBy(*glossary.columns).agg(F.count(F.lit(1)).alias("_n"))
    place = F.row_number().over(Window.partitionBy("canonical_term").orderBy(*rest))
    judged = counted.withColumn("_place", place).join(known, "canonical_term", "left")
    taken = F.col("_known").isNull() & (F.col("_place") == 1)
    times = F.sequence(F.lit(1).cast("long"), F.col("_n") - F.when(taken, 1).otherwise(0))
    refused = judged.filter(~taken | (F.col("_n") > 1)).select(*glossary.columns, F.explode(times).alias("_time"))
    return (
        glossary.unionByName(judged.filter(taken).select(*glossary.columns)),
        refused.select(*glossary.columns),
    )


def glossary_issues(descriptions: DataFrame, glossary: DataFrame) -> DataFrame:
    """Undefined references and ambiguous names: issue, term, occurrences."""
    names = glossary_names(glossary).select("term")
    undefined = (
        term_references(descriptions)
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .join(names, "term", "left_anti")
        .select(F.lit("UNDEFINED_REFERENCE").alias("issue"), "term", "occurrences")
    )
    active = glossary.filter(F.col("status") == "active")
    claims = active.select(F.col("canonical_term").alias("term"), "canonical_term").unionByName(
        active.select(F.explode("synonyms").alias("term"), "canonical_term")
    )
    ambiguous = (
        claims.distinct()
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .filter("occurrences > 1")
        .select(F.lit("AMBIGUOUS_NAME").alias("issue"), "term", "occurrences")
    )
    return undefined.unionByName(ambiguous)


def term_closure(glossary: DataFrame, relation: str = "is_a", max_depth: int | None = None) -> DataFrame:
    """Every ancestor (``is_a``) or part (``has_parts``) of each term with its least depth.

    The walk ends when nothing new is found; a term on a cycle is its own ancestor at the
    cycle's length. With ``max_depth`` it ends there, and ``cut`` marks terms with more beyond.
    """
    links = glossary.select(F.col("canonical_term").alias("_from"), F.explode(relation).alias("_to"))
    # The walk starts one step on, so that a term's way back to itself counts.
    reached = reach(
        links.select(F.col("_from").alias("root"), F.col("_to").alias("node")),
        links,
        None if max_depth is None else max_depth - 1,
    )
    return reached.select(
        F.col("root").alias("canonical_term"),
        F.col("node").alias("related_term"),
        (F.col("depth") + 1).alias("depth"),
        *(["cut"] if max_depth is not None else []),
    )
