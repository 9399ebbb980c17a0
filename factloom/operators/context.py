"""Review queues."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.functions.time import clock


def _overdue(df: DataFrame, due_col: str, as_of) -> DataFrame:
    today = clock(as_of).cast("date")
    due = F.col(due_col)
    return df.filter(due.isNotNull() & (due < today)).withColumn("days_overdue", F.datediff(today, due))


def overdue_context(ctx: DataFrame, ownership: DataFrame, as_of) -> DataFrame:
    """Active context records past their review date, with the steward to ask."""
    stewards = ownership.filter(F.col("table_name") == "entity_context").select(
        F.col("column_name").alias("context_type"), "steward_email"
    )
    return (
        _overdue(ctx.filter(F.col("valid_to").isNull()), "review_due", as_of)
        .join(stewards, "context_type", "left")
        .select(
            "entity_id",
            "entity_type",
            "context_type",
            "context_value",
            "assessed_by",
            "assessed_at",
            "review_due",
            "days_overdue",
            "steward_email",
        )
        .orderBy(F.desc("days_overdue"), "context_type", "entity_id")
    )


def overdue_reviews(df: DataFrame, due_col: str, as_of, keep: list[str]) -> DataFrame:
    """The same queue for any table with a review date."""
    return (
        _overdue(df, due_col, as_of)
        .select(*keep, F.col(due_col).alias("review_due"), "days_overdue")
        .orderBy(F.desc("days_overdue"), *keep)
    )
