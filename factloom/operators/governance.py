"""Lineage, impact, ownership domains, certification."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.functions.text import joined
from factloom.functions.time import clock, hours_between
from factloom.plans.frontier import expand, settled


def lineage_trace(
    lineage: DataFrame,
    targets: DataFrame | None = None,
    max_depth: int = 10,
    direction: str = "up",
) -> DataFrame:
    """All lineage steps from each target, up to ``max_depth``.

    ``targets`` has target_table and target_column; without it every column in the lineage
    is traced. ``direction='down'`` starts at source columns and follows their use.

    Every path counts: ``paths`` tells by how many a step is reached at that depth, and a cycle
    repeats until the depth limit. ``cut`` marks steps at the limit that go on beyond it. The
    walk carries one row per (root, node), however many paths there are. The lineage grows with
    the catalogue, so it is joined by sorting and never sent to the driver.
    """
    here, there = ("target", "source") if direction == "up" else ("source", "target")
    node = [f"{here}_table", f"{here}_column"]
    away = [f"{there}_table", f"{there}_column"]
    roots = lineage.select(*node) if targets is None else targets.select(*node)
    seed = roots.distinct().select(
        F.col(node[0]).alias("root_table"),
        F.col(node[1]).alias("root_column"),
        *node,
        F.lit(1).cast("long").alias("paths"),
        F.lit(1).alias("depth"),
    )
    links = settled(lineage.groupBy(*node, *away).agg(F.count(F.lit(1)).alias("_k")))

    def step(level: DataFrame, depth: int) -> DataFrame:
        return (
            level.join(links.hint("merge"), node)
            .groupBy(
                "root_table",
                "root_column",
                F.col(away[0]).alias(node[0]),
                F.col(away[1]).alias(node[1]),
            )
            .agg(F.sum(F.col("paths") * F.col("_k")).alias("paths"))
            .withColumn("depth", F.lit(depth))
        )

    walked = expand(seed, step, max_depth)
    onward = links.select(*[F.col(n).alias(a) for n, a in zip(node, away, strict=True)], F.lit(True).alias("_on")).distinct()
    rows = walked.join(lineage.hint("merge"), node).join(onward.hint("merge"), away, "left")
    return rows.select(
        "root_table",
        "root_column",
        "depth",
        F.concat(F.col(away[0]), F.lit("."), F.col(away[1])).alias(f"{there}_field"),
        "transform_type",
        "transform_pipeline",
        F.col("pipeline_version").alias("documented_version"),
        "source_system",
        F.when(F.col("source_system").isNotNull(), "OPERATIONAL SOURCE")
        .otherwise("PIPELINE TRANSFORMATION")
        .alias("node_type"),
        "paths",
        ((F.col("depth") == max_depth) & F.col("_on").isNotNull()).alias("cut"),
    )


def impact(
    manifest: DataFrame, ownership: DataFrame, table: str, column: str, env: str = "prod"
) -> DataFrame:
    """Systems that read a column, with every escalation contact of its table."""
    readers = manifest.filter(
        (F.col("table_name") == table)
        & F.array_contains("columns_accessed", F.lit(column))
        & (F.col("environment") == env)
    )
    contacts = ownership.select("table_name", "escalation_contact").distinct()
    return (
        readers.join(contacts, "table_name")
        .select("system_name", "system_version", "system_owner_team", "escalation_contact")
        .distinct()
        .orderBy("system_name", "system_version", "system_owner_team", "escalation_contact")
    )


def impact_bulk(
    changes: DataFrame, manifest: DataFrame, ownership: DataFrame, env: str = "prod"
) -> DataFrame:
    """L02 for many changes (table_name, column_name): who reads each, and whom to tell."""
    readers = (
        manifest.filter(F.col("environment") == env)
        .select(
            "table_name",
            F.explode("columns_accessed").alias("column_name"),
            "system_name",
            "system_version",
            "system_owner_team",
        )
        .distinct()
    )
    contacts = ownership.select("table_name", "escalation_contact").distinct()
    return (
        changes.select("table_name", "column_name")
        .distinct()
        .join(readers, ["table_name", "column_name"])
        .join(contacts, "table_name")
        .select(
            "table_name",
            "column_name",
            "system_name",
            "system_version",
            "system_owner_team",
            "escalation_contact",
        )
    )


def in_production(df: DataFrame, manifest: DataFrame, column: str = "table_name", env: str = "prod") -> DataFrame:
    """Rows whose table is read by a production system."""
    used = manifest.filter(F.col("environment") == env).select(F.col("table_name").alias(column)).distinct()
    return df.join(used, column, "left_semi")


def succession_health(ownership: DataFrame, manifest: DataFrame, as_of, months: int = 6) -> DataFrame:
    """Is there a successor for each production column, and was that reviewed lately?"""
    limit = F.add_months(clock(as_of).cast("date"), -months)
    status = (
        F.when(F.col("successor_role").isNull(), "NO_SUCCESSION_PLAN")
        .when(F.col("succession_reviewed_at") < limit, "SUCCESSION_PLAN_STALE")
        .otherwise("OK")
    )
    return (
        in_production(ownership, manifest)
        .select(
            "table_name",
            "column_name",
            "steward_role",
            "steward_name",
            "successor_role",
            status.alias("succession_status"),
        )
        .orderBy(F.desc("succession_status"), "table_name", "column_name")
    )


def ownership_fingerprint(ownership: DataFrame, sens: DataFrame, table: str | None = None) -> DataFrame:
    """A digest of who is responsible for a column and under which rules."""
    owned = ownership if table is None else ownership.filter(F.col("table_name") == table)
    rated = sens.select(
        "table_name", "column_name", F.col("classification").alias("sensitivity"), "pii_category"
    )
    parts = [F.col(c) for c in ("producer_team", "steward_role", "sensitivity", "review_frequency")]
    return (
        owned.join(rated, ["table_name", "column_name"])
        .select(
            "table_name",
            "column_name",
            "producer_team",
            "steward_role",
            "sensitivity",
            "pii_category",
            "review_frequency",
            F.md5(joined(parts, "|")).alias("ownership_domain_fingerprint"),
        )
        .orderBy("ownership_domain_fingerprint", "column_name", "table_name")
    )


def ownership_domains(ownership: DataFrame, sens: DataFrame, table: str | None = None) -> DataFrame:
    """Size of each ownership domain. Its members are the rows of the fingerprint table."""
    return (
        ownership_fingerprint(ownership, sens, table)
        .groupBy(
            "ownership_domain_fingerprint", "producer_team", "steward_role", "sensitivity", "review_frequency"
        )
        .agg(
            F.count(F.lit(1)).alias("column_count"),
            F.count_distinct("table_name").alias("table_count"),
        )
    )


def version_mismatch(lineage: DataFrame, deployed: DataFrame) -> DataFrame:
    """Lineage rows documented for another version than the one deployed.

    ``deployed`` has transform_pipeline and deployed_version.
    """
    return (
        lineage.join(deployed, "transform_pipeline")
        .filter(F.col("pipeline_version") != F.col("deployed_version"))
        .select(
            "target_table",
            "target_column",
            "source_table",
            "source_column",
            "transform_pipeline",
            F.col("pipeline_version").alias("documented_version"),
            "deployed_version",
        )
    )


def manifest_compliance(manifest: DataFrame, stats: DataFrame, as_of) -> DataFrame:
    """Does each table meet the staleness and confidence its readers declared?

    ``stats`` has table_name, last_updated and min_confidence. A limit that is not declared
    is met; a table without figures is NO_DATA.
    """
    found = manifest.join(stats, "table_name", "left")
    stale = hours_between(clock(as_of), F.col("last_updated")) > F.col("max_acceptable_staleness_hours")
    weak = F.col("min_confidence") < F.col("min_confidence_threshold")
    yes = lambda test: F.coalesce(test, F.lit(False))
    status = (
        F.when(F.col("last_updated").isNull(), "NO_DATA")
        .when(yes(stale) & yes(weak), "STALE_AND_LOW_CONFIDENCE")
        .when(yes(stale), "STALE")
        .when(yes(weak), "LOW_CONFIDENCE")
        .otherwise("OK")
    )
    return found.select("system_name", "table_name", status.alias("compliance_status"))


def certification_status(props: DataFrame, as_of, warn_days: int = 30) -> DataFrame:
    """Is the readiness certificate of each table in force?

    ``props`` are (table_name, key, value) rows; the keys read are ``ai_ready`` and
    ``ai_ready_valid_until``.
    """
    today = clock(as_of).cast("date")
    wide = props.groupBy("table_name").agg(
        F.max(F.when(F.col("key") == "ai_ready", F.col("value"))).alias("ai_ready"),
        F.max(F.when(F.col("key") == "ai_ready_valid_until", F.col("value"))).alias("_until"),
    )
    until = F.col("_until").try_cast("date")
    left = F.datediff(until, today)
    status = (
        F.when(F.coalesce(F.lower("ai_ready"), F.lit("false")) != "true", "NOT_CERTIFIED")
        .when(until.isNull(), "NO_EXPIRY_DATE")
        .when(left < 0, "EXPIRED")
        .when(left <= warn_days, "EXPIRING_SOON")
        .otherwise("CERTIFIED")
    )
    return wide.select(
        "table_name",
        until.alias("valid_until"),
        left.alias("days_left"),
        status.alias("certification_status"),
    )
