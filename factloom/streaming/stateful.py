"""Streams that keep a state table: breaker states (ST4) and versioned facts (ST5).

Both append what a batch brought under the id of the query, as ``index_stream`` does: a replayed
batch replaces itself, and a query with a new checkpoint adds to what is there.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from factloom.operators.breaker import BreakerConfig, breaker_states, latest_states
from factloom.operators.temporal import open_ended
from factloom.plans.sequence import ROWS_PER_PIECE, same_keys
from factloom.sources.surface import append_delta, gather, newest, read_deltas
from factloom.streaming.changes import query_id

ARRIVED = "_arrived"


def breaker_stream(
    results: DataFrame,
    root: str,
    checkpoint: str,
    config: BreakerConfig | None = None,
    rows_per_piece: int = ROWS_PER_PIECE,
) -> StreamingQuery:
    """ST4: breaker states over a stream of validation results.

    Each micro-batch goes through the batch operator, starting from the states of the batch
    before, so a contract with very many results is spread over tasks here too. States after
    every result are at ``<root>/states``, the last state of each contract by
    ``read_latest_states``. Results are taken in the order in which batches bring them, so they
    should come in time order from batch to batch.
    """
    spark = results.sparkSession

    def take(batch: DataFrame, number: int) -> None:
        run = query_id(spark, checkpoint)
        # A replay must not start from what it wrote itself.
        before = read_latest_states(spark, root, batch.select("contract_id"), (run, number))
        states = breaker_states(batch, config, before, rows_per_piece)
        out = f"{root}/states/run={run}/batch={number}"
        states.write.mode("overwrite").parquet(out)
        written = spark.read.schema(states.schema).parquet(out)
        append_delta(latest_states(written).withColumn(ARRIVED, F.lit(time.time_ns())), f"{root}/latest", run, number)

    return (
        results.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_latest_states(
    spark: SparkSession, root: str, only: DataFrame | None = None, without: tuple[str, int] | None = None
) -> DataFrame | None:
    """ST4: the state of each contract after the last batch that had results of it; None before the first batch."""
    found = newest(spark, f"{root}/latest", "contract_id", [F.col(ARRIVED)], only, without)
    return None if found is None else found.drop(ARRIVED)


def scd2_stream(changes: DataFrame, root: str, checkpoint: str) -> StreamingQuery:
    """ST5: keep a versioned table in step with a stream of changes.

    A batch only appends its changes; ``read_versions`` puts them in order, late ones in their
    place, and ``read_refused`` lists those that another one stands in the way of.
    """
    spark = changes.sparkSession

    def take(batch: DataFrame, number: int) -> None:
        append_delta(batch.withColumn(ARRIVED, F.lit(time.time_ns())), root, query_id(spark, checkpoint), number)

    return (
        changes.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _first(deltas: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """(keys, ts, _row): per key and start the change that arrived first, of one batch the least."""
    rest = [c for c in deltas.columns if c not in (*keys, ts, ARRIVED)]
    return deltas.groupBy(*keys, ts).agg(F.min(F.struct(ARRIVED, F.struct(*rest).alias("values"))).alias("_row"))


def read_versions(
    spark: SparkSession,
    root: str,
    keys: list[str],
    ts: str = "valid_from",
    end: str = "valid_to",
    rows_per_piece: int = ROWS_PER_PIECE,
) -> DataFrame | None:
    """ST5: the versions of all keys; None before the first batch.

    Of changes with one key and start the first to arrive is the version, of those of one batch
    the least.
    """
    deltas = read_deltas(spark, root)
    if deltas is None:
        return None
    names = [c for c in deltas.columns if c != ARRIVED]
    starts = _first(deltas, keys, ts).select(*[F.col(c) if c in (*keys, ts) else F.col("_row.values")[c].alias(c) for c in names])
    return open_ended(starts, keys, ts, end, rows_per_piece)


def read_refused(spark: SparkSession, root: str, keys: list[str], ts: str = "valid_from") -> DataFrame | None:
    """ST5: the changes that are no version although they say something new, each once.

    ``HELD_START``: an earlier batch brought another change with that key and start. ``SAME_START``:
    the same batch brought a lesser one.
    """
    deltas = read_deltas(spark, root)
    if deltas is None:
        return None
    rest = [c for c in deltas.columns if c not in (*keys, ts, ARRIVED)]
    given = deltas.groupBy(*keys, ts, *rest).agg(F.min(ARRIVED).alias(ARRIVED))
    first = _first(deltas, keys, ts)
    met = given.join(first, same_keys(given, first, [*keys, ts])).filter(~F.struct(*[given[c] for c in rest]).eqNullSafe(F.col("_row.values")))
    reason = F.when(given[ARRIVED] > F.col(f"_row.{ARRIVED}"), "HELD_START").otherwise("SAME_START")
    return met.select(*[given[c] for c in (*keys, ts, *rest)], reason.alias("reason"))


def compact_versions(spark: SparkSession, root: str) -> None:
    """ST5: gather the changes that the batches have appended, repeats once; beside the stream or not."""

    def once(deltas: DataFrame) -> DataFrame:
        return deltas.groupBy(*[c for c in deltas.columns if c != ARRIVED]).agg(F.min(ARRIVED).alias(ARRIVED))

    gather(spark, root, once)
