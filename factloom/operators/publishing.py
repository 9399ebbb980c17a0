"""Validate, consult the breaker, publish or keep the last valid surface (Q06)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from factloom.operators.breaker import OPEN, Breaker, BreakerConfig
from factloom.operators.contracts import check_contract
from factloom.sources.surface import (
    current_version,
    publish_version,
    read_current,
    reveal_version,
    stage_version,
)

STATE_SCHEMA = (
    "contract_id string, state string, failure_count bigint, pass_count int, last_failure_micros bigint, "
    "version bigint, passed boolean, published boolean"
)


def _micros(now: dt.datetime) -> int:
    if now.tzinfo is None:
        now = now.replace(tzinfo=dt.timezone.utc)
    return round(now.timestamp() * 1_000_000)


def gated_write(
    df: DataFrame, spec: dict, root: str, now: dt.datetime, config: BreakerConfig | None = None
) -> DataFrame:
    """Q06: one run of the gate. Returns the one-row state it leaves behind.

    The surface is at ``<root>/surface`` and the breaker of the contract at ``<root>/state``;
    both are versioned, so a run that is refused, or lost half-way, leaves the last valid
    surface readable. The rows are computed once: they are staged, the contract is checked
    on the staged files, and the stage is revealed when they pass. Only the rule results and
    the state row come to the driver.
    """
    spark = df.sparkSession
    config = config or BreakerConfig()
    stored = read_current(spark, f"{root}/state")
    last = stored.first() if stored is not None else None
    breaker = (
        Breaker(last["state"], last["failure_count"], last["pass_count"], last["last_failure_micros"])
        if last is not None
        else Breaker()
    )
    version = last["version"] + 1 if last is not None else 1
    surface = f"{root}/surface"
    # A run that was lost after revealing its surface finds it in place and goes on with it.
    revealed = (current_version(spark, surface) or 0) >= version
    staged = read_current(spark, surface) if revealed else stage_version(df, surface, version)
    passed = all(r["passed"] for r in check_contract(staged, spec).collect())
    read = breaker.at_time(_micros(now), config)
    after = read.record(_micros(now), passed, config)
    publish = passed and read.state != OPEN
    if publish and not revealed:
        reveal_version(spark, surface, version)
    row = (spec["id"], after.state, after.failures, after.passes, after.last_failure, version, passed, publish)
    state = spark.createDataFrame([row], STATE_SCHEMA)
    publish_version(state, f"{root}/state", version)
    return state


def current_surface(spark, root: str) -> DataFrame | None:
    """The last valid surface, or None."""
    return read_current(spark, f"{root}/surface")
