"""Confidence and provenance of facts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.functions.confidence import decayed
from factloom.functions.time import clock
from factloom.plans.frontier import reach


def effective_confidence(facts: DataFrame, as_of, keys: list | None = None) -> DataFrame:
    """Confidence of current facts after decay by rate-of-change class."""
    current = facts.filter(F.col("valid_to").isNull())
    if keys is not None:
        current = current.filter(F.col("canonical_id").isin(keys))
    return current.select(
        "canonical_id",
        "legal_name",
        "employee_count",
        "asserted_at",
        F.col("confidence").alias("base_confidence"),
        decayed(
            F.col("confidence"), F.col("rate_of_change_class"), F.col("asserted_at"), clock(as_of)
        ).alias("effective_confidence"),
    )


def field_confidence(
    facts: DataFrame,
    exceptions: DataFrame,
    fields: dict[str, str],
    match_table: str | None = "fact_customer_core",
) -> DataFrame:
    """Confidence of single fields: the field's exception, else the record's value.

    ``fields`` maps a field name to the name of its confidence column. With ``match_table``
    the exceptions of that fact table are used; their key is then unique per field, so all
    fields are looked up in one join. ``match_table=None`` ignores the table name: a fact
    listed under several tables then repeats, once per combination.
    """
    current = facts.filter(F.col("valid_to").isNull())
    wanted = exceptions.filter(F.col("field_name").isin(list(fields)))
    fallback = F.col("record_confidence")
    if match_table is not None:
        per_fact = (
            wanted.filter(F.col("fact_table") == match_table)
            .groupBy(F.col("fact_id").alias("canonical_id"))
            .agg(
                *[
                    F.max(F.when(F.col("field_name") == field, F.col("field_confidence"))).alias(f"_{out}")
                    for field, out in fields.items()
                ]
            )
        )
        joined = current.join(per_fact, "canonical_id", "left")
    else:
        joined = current
        for field, out in fields.items():
            one = wanted.filter(F.col("field_name") == field).select(
                F.col("fact_id").alias("canonical_id"), F.col("field_confidence").alias(f"_{out}")
            )
            joined = joined.join(one, "canonical_id", "left")
    columns = [F.col("canonical_id")]
    for field, out in fields.items():
        columns += [F.col(field), F.coalesce(F.col(f"_{out}"), fallback).alias(out)]
    return joined.select(*columns)


def provenance_chain(prov: DataFrame, fact_ids: DataFrame, max_depth: int | None = None) -> DataFrame:
    """Every provenance record reachable from each fact, with the shortest distance.

    ``fact_ids`` has one column ``fact_id``. All facts are walked together, down to the
    source documents; a record reached by two routes, or again round a cycle, is kept once at
    its least depth. With ``max_depth`` the walk ends there, and ``cut`` marks the records
    whose inputs were left out.
    """
    links = prov.select(F.col("fact_id").alias("_from"), F.explode("input_fact_ids").alias("_to"))
    seeds = fact_ids.select(F.col("fact_id").alias("root"), F.col("fact_id").alias("node"))
    told = ["source_type", "source_document", "transform_name", "derivation_depth"]
    reached = reach(seeds, links, max_depth, prov.select(F.col("fact_id").alias("node"), *told))
    return reached.withColumnsRenamed({"root": "root_fact_id", "node": "fact_id"}).select(
        "root_fact_id",
        "fact_id",
        "depth",
        *told,
        *(["cut"] if max_depth is not None else []),
    )


def unprovenanced_facts(facts: DataFrame, prov: DataFrame, id_col: str = "canonical_id") -> DataFrame:
    """Current facts without a provenance record, without confidence, or both."""
    known = prov.select(F.col("fact_id").alias(id_col)).distinct().withColumn("_known", F.lit(True))
    gaps = {"NO_PROVENANCE": F.col("_known").isNull(), "NO_CONFIDENCE": F.col("confidence").isNull()}
    reason = F.concat_ws("+", *[F.when(test, name) for name, test in gaps.items()])
    return (
        facts.filter(F.col("valid_to").isNull())
        .join(known, id_col, "left")
        .filter(reduce(lambda a, b: a | b, gaps.values()))
        .select(id_col, "valid_from", "confidence", reason.alias("gap"))
    )
