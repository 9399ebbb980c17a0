"""Building a surface from operational tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions.numeric import count_where, percent

# Coded column names of the operational tables and their descriptive names.
SURFACE_NAMES = {
    "tp_cd": "account_type",
    "stat": "account_status",
    "cr_lmt": "credit_limit_usd",
    "adj_bal": "adjusted_balance_usd",
    "flg_prm": "is_premium_account",
    "flg_rev": "is_under_manual_review",
    "src_sys": "source_system",
    "lst_txn_dt": "last_transaction_date",
}


def denormalise(facts: DataFrame, dims: list[tuple[DataFrame, str | list[str]]]) -> DataFrame:
    """Resolve foreign keys by inner equi-joins, in the given order.

    No join is hinted: sides under the session's threshold are broadcast, others shuffled.
    """
    for dim, key in dims:
        facts = facts.join(dim, key)
    return facts


def absent_columns(df: DataFrame, mapping: dict[str, str]) -> list[str]:
    """Columns a mapping expects and the table lacks."""
    return [c for c in mapping if c not in df.columns]


def rename_columns(df: DataFrame, mapping: dict[str, str] | None = None, strict: bool = True) -> DataFrame:
    """Coded names to descriptive ones. ``strict`` raises when a column is absent."""
    mapping = SURFACE_NAMES if mapping is None else mapping
    missing = absent_columns(df, mapping)
    if strict and missing:
        raise ValueError(f"columns to rename are absent: {', '.join(missing)}")
    return df.withColumnsRenamed(mapping)


def _lookup(mapping: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])


def canonicalise(df: DataFrame, vocab: dict[str, dict] | DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Expand coded values to vocabulary terms; unmapped values stay as they are.

    ``vocab`` is a dict field -> {code: term}, or for large vocabularies a table
    (field, code, term) with unique (field, code), joined once per field in ``fields``.
    """
    if isinstance(vocab, dict):
        known = {f: m for f, m in vocab.items() if f in df.columns and m}
        return df.withColumns(
            {f: F.coalesce(F.try_element_at(_lookup(m), F.col(f)), F.col(f)) for f, m in known.items()}
        )
    for field in fields or []:
        terms = vocab.filter(F.col("field") == field).select(F.col("code").alias(field), F.col("term").alias("_t"))
        df = df.join(terms, field, "left").select(
            *[F.coalesce("_t", field).alias(c) if c == field else F.col(c) for c in df.columns]
        )
    return df


def vocab_violations(df: DataFrame, vocab: dict[str, dict]) -> DataFrame:
    """Values that are not terms of the vocabulary, per field; NULLs are not counted."""
    known = {f: m for f, m in vocab.items() if f in df.columns}
    counts = []
    for i, (field, mapping) in enumerate(known.items()):
        counts += [
            F.count(field).alias(f"n{i}"),
            count_where(~F.col(field).isin(list(mapping.values()))).alias(f"v{i}"),
        ]
    rows = [
        F.struct(
            F.lit(field).alias("field"), F.col(f"n{i}").alias("values"), F.col(f"v{i}").alias("violations")
        )
        for i, field in enumerate(known)
    ]
    return (
        df.agg(*counts)
        .select(F.inline(F.array(*rows)))
        .withColumn("violation_pct", percent(F.col("violations"), F.col("values")))
    )
