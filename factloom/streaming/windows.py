"""Rates measured on a running stream, per window of event time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from factloom.functions.numeric import percent
from factloom.functions.time import MICROS_PER_SECOND
from factloom.plans.sequence import position
from factloom.sources.surface import append_delta, read_deltas
from factloom.streaming.changes import query_id

MOMENT = "_moment"


def watermark(spark: SparkSession, root: str, delay_s: int, without: tuple[str, int] | None = None) -> int | None:
    """The point in time, in microseconds, before which windows are closed; None before the first row.

    It is the greatest time that any batch brought, less the delay. One number per batch is read.
    """
    seen = read_deltas(spark, f"{root}/marks", without)
    last = None if seen is None else seen.agg(F.max("latest")).first()[0]
    return None if last is None else last - delay_s * MICROS_PER_SECOND


def window_stream(
    events: DataFrame,
    root: str,
    checkpoint: str,
    at: str,
    sums: dict[str, Column],
    by: list[str] | None = None,
    width_s: int = 3_600,
    delay_s: int = 7_200,
) -> StreamingQuery:
    """Counts and sums per window of ``width_s`` seconds of event time, over a stream read to its end.

    A window closes when a batch has brought a time ``delay_s`` past its end; that takes effect
    with the next batch, as a watermark does. Rows of closed windows are late: they change no
    window and are kept, whole, beside them. Rows without a time are late too. Each batch
    appends its own share of every window, under the id of the query, so replays have no
    second effect and a new checkpoint goes on. ``read_windows`` and ``read_late`` give the outcome.
    """
    spark = events.sparkSession

    def take(batch: DataFrame, number: int) -> None:
        run = query_id(spark, checkpoint)
        closed = watermark(spark, root, delay_s, (run, number))
        held = batch.persist()
        try:
            micros = position(held, at)
            begin = micros - F.pmod(micros, F.lit(width_s * MICROS_PER_SECOND))
            late = begin.isNull() if closed is None else begin.isNull() | (begin + width_s * MICROS_PER_SECOND <= closed)
            share = (
                held.filter(~late)
                .withColumn(MOMENT, begin)
                .groupBy(MOMENT, *(by or []))
                .agg(F.count(F.lit(1)).alias("rows"), *[F.sum(c).alias(n) for n, c in sums.items()])
            )
            append_delta(share, f"{root}/windows", run, number)
            append_delta(held.filter(late), f"{root}/late", run, number)
            append_delta(held.agg(F.max(micros).alias("latest")), f"{root}/marks", run, number)
        finally:
            held.unpersist()

    return (
        events.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_windows(spark: SparkSession, root: str, sums: list[str], by: list[str] | None = None, width_s: int = 3_600, delay_s: int = 7_200) -> DataFrame | None:
    """(window_start, by, rows, sums, closed) of all windows so far; None before the first batch.

    Starts are free of a zone; of times with one they are in UTC.
    """
    shares = read_deltas(spark, f"{root}/windows")
    if shares is None:
        return None
    mark = watermark(spark, root, delay_s)
    closed = F.lit(False) if mark is None else F.col(MOMENT) + width_s * MICROS_PER_SECOND <= mark
    totals = shares.groupBy(MOMENT, *(by or [])).agg(F.sum("rows").alias("rows"), *[F.sum(n).alias(n) for n in sums])
    start = F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=(F.col(MOMENT) / MICROS_PER_SECOND).cast("decimal(18,6)"))
    return totals.select(start.alias("window_start"), *(by or []), "rows", *sums, closed.alias("closed"))


def read_late(spark: SparkSession, root: str) -> DataFrame | None:
    """The rows that came too late for their window, as they came; None before the first batch."""
    return read_deltas(spark, f"{root}/late")


def failure_rate_stream(results: DataFrame, root: str, checkpoint: str, at: str, by: list[str] | None = None, width_s: int = 3_600, delay_s: int = 7_200) -> StreamingQuery:
    """O13 on the stream: attempts and failures per window; ``results`` has a boolean ``succeeded``."""
    failed = F.when(F.coalesce(F.col("succeeded"), F.lit(False)), 0).otherwise(1)
    return window_stream(results, root, checkpoint, at, {"failures": failed}, by, width_s, delay_s)


def read_failure_rates(spark: SparkSession, root: str, by: list[str] | None = None, width_s: int = 3_600, delay_s: int = 7_200, limit_pct: float = 1.0) -> DataFrame | None:
    """(window_start, by, attempts, failures, failure_pct, breach, closed)."""
    found = read_windows(spark, root, ["failures"], by, width_s, delay_s)
    if found is None:
        return None
    rated = found.withColumn("failure_pct", percent(F.col("failures"), F.col("rows")))
    return rated.select("window_start", *(by or []), F.col("rows").alias("attempts"), "failures", "failure_pct", (F.col("failure_pct") > limit_pct).alias("breach"), "closed")


def freshness_stream(updates: DataFrame, root: str, checkpoint: str, changed_at: str, seen_at: str, sla_min: int = 1_800, by: list[str] | None = None, width_s: int = 3_600, delay_s: int = 7_200) -> StreamingQuery:
    """O02 on the stream: per window of ``seen_at``, how long after their change updates came in."""
    lag = position(updates, seen_at) - position(updates, changed_at)
    late = F.when(lag > sla_min * 60 * MICROS_PER_SECOND, 1).otherwise(0)
    return window_stream(updates, root, checkpoint, seen_at, {"lag_micros": lag, "beyond_sla": late}, by, width_s, delay_s)


def read_freshness(spark: SparkSession, root: str, by: list[str] | None = None, width_s: int = 3_600, delay_s: int = 7_200) -> DataFrame | None:
    """(window_start, by, updates, mean_lag_minutes, beyond_sla, pct_beyond_sla, closed)."""
    found = read_windows(spark, root, ["lag_micros", "beyond_sla"], by, width_s, delay_s)
    if found is None:
        return None
    minutes = F.round(F.col("lag_micros") / (F.col("rows") * 60 * MICROS_PER_SECOND), 4)
    pct = percent(F.col("beyond_sla"), F.col("rows"))
    return found.select("window_start", *(by or []), F.col("rows").alias("updates"), minutes.alias("mean_lag_minutes"), "beyond_sla", pct.alias("pct_beyond_sla"), "closed")
