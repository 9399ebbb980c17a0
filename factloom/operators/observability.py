"""Freshness, alert rules, volume, reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factloom.functions.numeric import count_where, percent, round_exact
from factloom.functions.time import clock, holds_at, hours_between, minutes_between

# Metric, dimension, limit that must not be passed, severity. The action is a
# short code: halt the flow, requeue records, reject records, review, or update a registry.
ALERT_RULES = [
    ("surface_age_over_sla_hours", "Freshness", 0.0, "P1", "halt"),
    ("source_lag_in_cadences", "Freshness", 2.0, "P2", "review"),
    ("index_version_mismatch_pct", "Freshness", 5.0, "P2", "requeue"),
    ("null_rate_over_contract_pct", "Quality", 0.0, "P1", "halt"),
    ("category_shift_pct", "Quality", 5.0, "P2", "review"),
    ("duplicate_rate_rise_points", "Quality", 2.0, "P2", "review"),
    ("vocabulary_violation_pct", "Quality", 0.0, "P1", "reject"),
    ("orphan_relationships", "Lineage", 0.0, "P2", "review"),
    ("pipeline_version_mismatches", "Lineage", 0.0, "P3", "update"),
    ("failed_reembed_pct", "Lineage", 1.0, "P1", "review"),
    ("row_count_drop_pct", "Volume", 5.0, "P1", "halt"),
    ("vertex_count_drop", "Volume", 0.0, "P2", "review"),
    ("document_count_difference", "Volume", 0.0, "P2", "requeue"),
]

# Hours of the update rhythms a lineage row may name.
CADENCE_HOURS = {"hourly": 1.0, "daily": 24.0, "weekly": 168.0, "monthly": 720.0}


def _current(df: DataFrame) -> DataFrame:
    return df.filter(F.col("valid_to").isNull())


def freshness_status(
    df: DataFrame, as_of, table: str = "account_ai_surface", sla_h: int = 30, warn_h: int = 24
) -> DataFrame:
    """Hours since the last update of a table, in true elapsed time."""
    last = _current(df).agg(F.max("updated_at").alias("last_updated"))
    hours = hours_between(clock(as_of), F.col("last_updated"))
    status = (
        F.when(hours > sla_h, "VIOLATION: EXCEEDS_SLA")
        .when(hours > warn_h, "WARNING: APPROACHING_SLA")
        .otherwise("OK")
    )
    return last.select(
        F.lit(table).alias("table_name"),
        "last_updated",
        round_exact(hours, 4).alias("hours_since_update"),
        F.lit(sla_h).alias("freshness_sla_hours"),
        status.alias("freshness_status"),
    )


def freshness_lag(
    df: DataFrame, as_of, table: str = "account_ai_surface", sla_min: int = 1800
) -> DataFrame:
    """Lag of the entities of a surface and the share beyond the limit, in true minutes."""
    lag = minutes_between(clock(as_of), F.col("updated_at"))
    counted = (
        _current(df)
        .select(lag.alias("_lag"))
        .agg(
            F.count(F.lit(1)).alias("total_entities"),
            F.avg("_lag").alias("_mean"),
            F.max("_lag").alias("_max"),
            count_where(F.col("_lag") > sla_min).alias("entities_beyond_sla"),
        )
    )
    return counted.select(
        F.lit(table).alias("surface_table"),
        "total_entities",
        round_exact(F.col("_mean"), 4).alias("mean_lag_minutes"),
        round_exact(F.col("_max"), 4).alias("max_lag_minutes"),
        F.lit(sla_min).alias("sla_minutes"),
        "entities_beyond_sla",
        percent(F.col("entities_beyond_sla"), F.col("total_entities")).alias("pct_beyond_sla"),
    )


def freshness_alert(lag: DataFrame, p2: float = 5.0, p1: float = 20.0) -> DataFrame:
    """Severity of a lag table; P1 also trips the breaker."""
    late = F.col("pct_beyond_sla")
    return lag.select(
        "surface_table",
        "pct_beyond_sla",
        F.when(late > p1, "P1").when(late > p2, "P2").otherwise("OK").alias("severity"),
        F.coalesce(late > p1, F.lit(False)).alias("trip_breaker"),
    )


def alert_rules(spark) -> DataFrame:
    """The rules as a table (metric, dimension, limit, severity, action)."""
    return spark.createDataFrame(
        ALERT_RULES, "metric string, dimension string, limit double, severity string, action string"
    )


def evaluate_alerts(metrics: DataFrame, rules: DataFrame) -> DataFrame:
    """Metric rows (table_name, metric, value, as_of) that pass their limit."""
    return (
        metrics.join(rules, "metric")
        .filter(F.col("value") > F.col("limit"))
        .select("table_name", "metric", "dimension", "value", "limit", "severity", "action", "as_of")
    )


def cadence_breach(tables: DataFrame, lineage: DataFrame, as_of, factor: float = 2.0) -> DataFrame:
    """Sources older than ``factor`` times the rhythm their lineage expects.

    ``tables`` has table_name and last_updated.
    """
    rhythm = F.create_map(*[F.lit(x) for pair in CADENCE_HOURS.items() for x in pair])
    expected = (
        lineage.select(
            F.col("source_table").alias("table_name"),
            F.try_element_at(rhythm, F.lower("expected_update_freq")).alias("_hours"),
        )
        .groupBy("table_name")
        .agg(F.min("_hours").alias("cadence_hours"))
    )
    age = round_exact(hours_between(clock(as_of), F.col("last_updated")), 4)
    return (
        tables.join(expected, "table_name")
        .select("table_name", "last_updated", "cadence_hours", age.alias("age_hours"))
        .filter(F.col("age_hours") > F.col("cadence_hours") * factor)
    )


def index_staleness(
    index: DataFrame, source: DataFrame, key: str, by: str, limit_pct: float = 5.0
) -> DataFrame:
    """Share of indexed records whose version is not the source's, per source table.

    ``index`` has key, ``by`` and source_version; ``source`` has key (unique) and updated_at.
    """
    pairs = index.select(key, by, "source_version").join(source.select(key, "updated_at"), key)
    other = ~F.col("source_version").eqNullSafe(F.col("updated_at"))
    return (
        pairs.groupBy(by)
        .agg(F.count(F.lit(1)).alias("indexed"), count_where(other).alias("mismatched"))
        .withColumn("mismatch_pct", percent(F.col("mismatched"), F.col("indexed")))
        .withColumn("breach", F.col("mismatch_pct") > limit_pct)
    )


def duplicate_rate(df: DataFrame, keys: list[str], at: str, limit_points: float = 2.0) -> DataFrame:
    """Share of surplus rows per week and its rise over the week before.

    Rows are counted per (week, key) first; the window sees one row per week.
    """
    weeks = (
        df.groupBy(F.date_trunc("week", at).cast("date").alias("week"), *keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .groupBy("week")
        .agg(F.sum("_n").alias("rows"), F.count(F.lit(1)).alias("distinct_entities"))
        .withColumn(
            "duplicate_pct", percent(F.col("rows") - F.col("distinct_entities"), F.col("rows"))
        )
    )
    before = F.lag("duplicate_pct").over(Window.partitionBy().orderBy("week"))
    return weeks.withColumn("change_points", F.round(F.col("duplicate_pct") - before, 2)).withColumn(
        "breach", F.coalesce(F.col("change_points") > limit_points, F.lit(False))
    )


def volume_drop(history: DataFrame, at: str = "snapshot_date", limit_pct: float = 5.0) -> DataFrame:
    """Rows per snapshot and the drop against the snapshot before."""
    counts = history.groupBy(at).agg(F.count(F.lit(1)).alias("row_count"))
    before = F.lag("row_count").over(Window.partitionBy().orderBy(at))
    return (
        counts.withColumn("previous_count", before)
        .withColumn(
            "drop_pct", percent(F.col("previous_count") - F.col("row_count"), F.col("previous_count"))
        )
        .withColumn("breach", F.coalesce(F.col("drop_pct") > limit_pct, F.lit(False)))
    )


def vertex_trend(edges: DataFrame, dates: list) -> DataFrame:
    """Number of vertices with a valid edge at each date, and whether it fell.

    Each vertex is reduced to one flag per date before counting.
    """
    ends = edges.select(F.explode(F.array("src", "dst")).alias("vertex"), "valid_from", "valid_to")
    live = [F.max(holds_at(clock(d), F.col("valid_from"), F.col("valid_to"))) for d in dates]
    flags = ends.groupBy("vertex").agg(*[flag.alias(f"d{i}") for i, flag in enumerate(live)])
    counts = flags.agg(*[count_where(F.col(f"d{i}")).alias(f"n{i}") for i in range(len(dates))])
    rows = [
        F.struct(clock(d).cast("date").alias("as_of"), F.col(f"n{i}").alias("vertex_count"))
        for i, d in enumerate(dates)
    ]
    before = F.lag("vertex_count").over(Window.partitionBy().orderBy("as_of"))
    return (
        counts.select(F.inline(F.array(*rows)))
        .withColumn("change", F.col("vertex_count") - before)
        .withColumn("breach", F.coalesce(F.col("change") < 0, F.lit(False)))
    )


def reconcile(source: DataFrame, index: DataFrame, key: str) -> DataFrame:
    """Ids in both, only in the source, or only in the index, with their row counts."""
    left = source.groupBy(key).agg(F.count(F.lit(1)).alias("_s"))
    right = index.groupBy(key).agg(F.count(F.lit(1)).alias("_i"))
    status = (
        F.when(F.col("_i").isNull(), "MISSING_FROM_INDEX")
        .when(F.col("_s").isNull(), "NOT_IN_SOURCE")
        .when(F.col("_s") != F.col("_i"), "COUNT_DIFFERS")
        .otherwise("MATCHED")
    )
    return (
        left.join(right, key, "full_outer")
        .groupBy(status.alias("status"))
        .agg(
            F.count(F.lit(1)).alias("id_count"),
            F.coalesce(F.sum("_s"), F.lit(0)).alias("source_rows"),
            F.coalesce(F.sum("_i"), F.lit(0)).alias("index_rows"),
        )
    )


def reembed_failure_rate(results: DataFrame, by: str, limit_pct: float = 1.0) -> DataFrame:
    """Share of failed re-embeddings. ``results`` has a boolean ``succeeded``."""
    return (
        results.groupBy(by)
        .agg(
            F.count(F.lit(1)).alias("attempts"),
            count_where(~F.coalesce("succeeded", F.lit(False))).alias("failures"),
        )
        .withColumn("failure_pct", percent(F.col("failures"), F.col("attempts")))
        .withColumn("breach", F.col("failure_pct") > limit_pct)
    )


def stale_chunks(index: DataFrame, source: DataFrame) -> DataFrame:
    """Indexed chunks whose source document changed or is gone.

    ``index`` has chunk_id, source_record_id and content_hash; ``source`` has
    source_record_id (unique) and content_hash.
    """
    now = source.select("source_record_id", F.col("content_hash").alias("_hash"), F.lit(True).alias("_there"))
    reason = F.when(F.col("_there").isNull(), "SOURCE_GONE").when(
        ~F.col("_hash").eqNullSafe(F.col("content_hash")), "SOURCE_CHANGED"
    )
    return (
        index.join(now, "source_record_id", "left")
        .select("chunk_id", "source_record_id", reason.alias("reason"))
        .filter(F.col("reason").isNotNull())
    )
