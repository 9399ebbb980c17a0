"""Change queue to document index (ST1-ST3, IO5)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from factloom.operators.embeddings import reembed_decisions
from factloom.sources.surface import append_delta, compact, newest

MESSAGE_SCHEMA = "struct<table:string,entity_id:string,source_record:string,_bad:string>"
EMPTY_CONTEXT = "map<string,struct<canonical_term:string,definition:string>>"


def version_order(version: Column) -> Column:
    """A version as a number that orders it: its value, or seconds if it is a point in time; else NULL."""
    moment = F.unix_micros(F.try_to_timestamp(version)) / F.lit(1e6)
    return F.coalesce(version.try_cast("double"), moment)


def parse_changes(messages: DataFrame, body: str = "body") -> DataFrame:
    """ST1: queue messages as columns, for a batch or a stream.

    Adds source_table, entity_id, source_version, source_record (JSON text) and ``problem``,
    which is NULL for usable messages.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    parsed = messages.withColumn("_m", F.from_json(F.col(body), MESSAGE_SCHEMA, options))
    version = F.get_json_object("_m.source_record", "$.updated_at")
    problem = (
        F.when(F.col("_m").isNull() | F.col("_m._bad").isNotNull(), "MALFORMED")
        .when(F.col("_m.table").isNull() | F.col("_m.entity_id").isNull(), "NO_KEY")
        .when(F.col("_m.source_record").isNull(), "NO_RECORD")
        .when(version.isNotNull() & version_order(version).isNull(), "BAD_VERSION")
    )
    return parsed.select(
        *messages.columns,
        F.col("_m.table").alias("source_table"),
        F.col("_m.entity_id").alias("entity_id"),
        version.alias("source_version"),
        F.col("_m.source_record").alias("source_record"),
        problem.alias("problem"),
    )


def split_changes(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """ST1: usable messages, and the dead letters with their problem."""
    good = parsed.filter(F.col("problem").isNull()).drop("problem")
    return good, parsed.filter(F.col("problem").isNotNull())


def without_redelivery(stream: DataFrame, ids: list[str], at: str, delay: str = "10 minutes") -> DataFrame:
    """ST1: drop repeated deliveries that arrive within ``delay`` of each other in event time."""
    timed = stream.withColumn("_at", F.col(at).cast("timestamp")).withWatermark("_at", delay)
    return timed.dropDuplicatesWithinWatermark(ids).drop("_at")


def latest_changes(changes: DataFrame, tiebreak: list[str]) -> DataFrame:
    """The newest version of every record in a batch, keyed by ``id`` = table#entity.

    Versions are compared as numbers or points in time, so 10 is newer than 9.
    """
    keyed = changes.withColumn("id", F.concat("source_table", F.lit("#"), "entity_id"))
    rest = [c for c in keyed.columns if c != "id"]
    return (
        keyed.groupBy("id")
        .agg(F.max_by(F.struct(*rest), F.struct(version_order(F.col("source_version")).alias("_at"), "source_version", *tiebreak)).alias("_row"))
        .select("id", *[F.col("_row")[c].alias(c) for c in rest])
    )


def significant_changes(
    docs: DataFrame, index: DataFrame | None, fields: list[str] | None = None, threshold: float = 0.98
) -> DataFrame:
    """ST2: the documents that differ enough from what the index holds.

    ``docs`` has id, the fields and embedding, one row per id; ``index`` is the current
    index, None before the first batch.
    """
    if index is None:
        return docs
    asked = docs.select("id").distinct()
    seen = index.join(asked, "id", "left_semi")
    keep = reembed_decisions(seen, docs, "id", fields or ["text"], threshold).filter("should_reembed")
    return docs.join(keep.select("id"), "id", "left_semi")


def as_documents(changes: DataFrame, indexed_at: Column) -> DataFrame:
    """ST3: the index document of each change; text and embedding are given columns."""
    context = (
        F.col("semantic_context")
        if "semantic_context" in changes.columns
        else F.lit(None).cast(EMPTY_CONTEXT)
    )
    return changes.select(
        F.concat("source_table", F.lit("#"), "entity_id").alias("id"),
        "text",
        "embedding",
        "entity_id",
        F.col("source_table").alias("entity_type"),
        "source_version",
        indexed_at.alias("indexed_at"),
        context.alias("semantic_context"),
        F.col("entity_id").alias("source_record_id"),
        "source_table",
    )


def _newest_first() -> list[Column]:
    return [version_order(F.col("source_version")).alias("_at"), F.col("source_version"), F.col("indexed_at")]


def read_index(spark: SparkSession, index_root: str, only: DataFrame | None = None, without=None) -> DataFrame | None:
    """ST3: the document of each id with the greatest source_version; None before the first batch."""
    return newest(spark, index_root, "id", _newest_first(), only, without)


def compact_index(spark: SparkSession, index_root: str) -> None:
    """ST3: gather what the batches have written; to be run now and then, beside the stream or not."""
    compact(spark, index_root, "id", _newest_first())


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the query when the checkpoint was made."""
    return spark.read.schema("id string").json(f"{checkpoint}/metadata").first()["id"]


def index_stream(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame],
    *,
    body: str = "body",
    tiebreak: list[str] | None = None,
    threshold: float | None = 0.98,
    indexed_at: Callable[[int], Column] | None = None,
) -> StreamingQuery:
    """ST1-ST3: keep an index in step with a change queue until the queue is read to its end.

    ``prepare`` adds ``text`` and ``embedding`` to a batch of parsed changes. The index is at
    ``<root>/index``, dead letters at ``<root>/dead``, and one row of counts per batch at
    ``<root>/outcomes``. A batch writes its own documents only (``read_index`` has the newest of each
    id, ``compact_index`` gathers them). Files carry the id of the query, so a replayed batch
    replaces itself and a query with a new checkpoint adds to what is there. A document without
    an embedding has failed: it goes to the dead letters as NO_EMBEDDING. ``threshold=None``
    indexes every change without the comparison of ST2. ``indexed_at`` maps a batch number to the
    stamp of its documents, by default the time of the batch.
    """
    spark = messages.sparkSession
    stamp = indexed_at or (lambda _: F.current_timestamp())

    def take(batch: DataFrame, number: int) -> None:
        run = query_id(spark, checkpoint)
        own = f"run={run}/batch={number}"
        parsed = parse_changes(batch, body).persist()
        held = [parsed]
        try:
            good, dead = split_changes(parsed)
            changed = prepare(latest_changes(good, tiebreak or [body])).persist()
            held.append(changed)
            lost = changed.filter(F.col("embedding").isNull()).withColumn("problem", F.lit("NO_EMBEDDING"))
            dead.unionByName(lost.select(*dead.columns)).write.mode("overwrite").parquet(f"{root}/dead/{own}")
            docs = as_documents(changed.filter(F.col("embedding").isNotNull()), stamp(number))
            if threshold is not None:
                # A replay must not find what it wrote itself.
                seen = read_index(spark, f"{root}/index", docs, (run, number))
                docs = significant_changes(docs, seen, threshold=threshold)
            append_delta(docs, f"{root}/index", run, number)
            counts = parsed.agg(
                F.count(F.when(F.col("problem").isNull(), 1)).alias("usable"), F.count("problem").alias("unusable")
            )
            n_lost = F.lit(lost.count())
            counts.select((F.col("usable") - n_lost).alias("succeeded"), (F.col("unusable") + n_lost).alias("failed")).write.mode(
                "overwrite"
            ).parquet(f"{root}/outcomes/{own}")
        finally:
            for df in reversed(held):
                df.unpersist()

    return (
        messages.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
