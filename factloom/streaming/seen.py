"""What was last indexed of each document, held by Spark as keyed state (ST2)."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from factloom.sources.surface import append_delta
from factloom.streaming.changes import as_documents, parse_changes, query_id, split_changes, version_order

CARRIED = ["source_table", "entity_id", "source_version", "text", "embedding"]
STATE = "at double, version string, content string, embedding array<double>, touched long"


def significant_rows(docs: DataFrame, threshold: float | None = 0.98, expire_s: int | None = None, timers: bool = False) -> DataFrame:
    """ST2: the documents of a stream that differ enough from what was last let through of them.

    ``docs`` has the columns of CARRIED; the key is table and entity. Of a batch's documents with
    one key the newest version counts, repeats of it by content. It is let through if its key
    is new, or if it is newer than what was seen, its text differs from the last one let
    through, and the cosine of the embeddings is under ``threshold`` (None: any other text).
    Adds ``reason``. State is one row per key: version seen, hash and embedding let through. After
    ``expire_s`` seconds without a document it counts no more, and the next one is new. With
    ``timers`` Spark also takes it out of the state then; that keeps a query running, so it is
    for queries that do not end with their input.
    """
    kept, timed = [*CARRIED, "_at", "_content"], bool(expire_s and timers)
    rows = docs.select(*CARRIED, F.coalesce(version_order(F.col("source_version")), F.lit(float("-inf"))).alias("_at"), F.sha2("text", 256).alias("_content"))
    rows = rows.filter("text IS NOT NULL AND embedding IS NOT NULL")

    def judge(key: tuple, frames: Iterator, state: GroupState) -> Iterator:
        import numpy as np
        import pandas as pd

        if state.hasTimedOut:
            state.remove()
            return
        newest = None
        for frame in frames:  # a key with very many documents comes in several frames
            # Plain values: a table's own sort costs more than all the rest for the one or two rows of a key.
            rows_of = zip(frame["_at"].tolist(), frame["source_version"].tolist(), frame["_content"].tolist())
            ranks = [((at == at, at) if at == at else (False, 0.0), isinstance(v, str), v if isinstance(v, str) else "", x, i) for i, (at, v, x) in enumerate(rows_of)]
            _, _, version, content, i = max(ranks)
            place = (frame["_at"].iat[i], version, content)
            if newest is None or place > newest[0]:
                newest = (place, {c: frame[c].iat[i] for c in CARRIED})
        (at, version, content), document = newest
        vector = np.asarray(document["embedding"], float)
        now = time.time_ns() // 1_000_000
        old = state.get if state.exists else None
        if old is not None and expire_s and now - old[4] > expire_s * 1000:
            old = None
        reason = None
        if old is None:
            reason = "new"
        elif (at, version) < (old[0], old[1]):
            at, version = old[0], old[1]
        elif content != old[2]:
            last = np.asarray(old[3], float)
            length = np.sqrt(vector @ vector) * np.sqrt(last @ last) if len(vector) == len(last) else 0.0
            if threshold is None or not length or vector @ last / length < threshold:
                reason = "content_changed"
        through = (content, vector.tolist()) if reason else (old[2], list(old[3]))
        state.update((float(at), version, *through, now))
        if timed:
            state.setTimeoutDuration(expire_s * 1000)
        if reason:
            yield pd.DataFrame({c: [v] for c, v in {**document, "reason": reason}.items()})

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*CARRIED).schema)
    timeout = GroupStateTimeout.ProcessingTimeTimeout if timed else GroupStateTimeout.NoTimeout
    return rows.select(*kept).groupBy("source_table", "entity_id").applyInPandasWithState(judge, f"{fields}, reason string", STATE, "append", timeout)


def seen_stream(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame],
    *,
    body: str = "body",
    threshold: float | None = 0.98,
    expire_s: int | None = None,
    indexed_at: Callable[[int], Column] | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """ST2 / ST3: add the significant documents of a change queue to the index at ``<root>/index``.

    Unlike ``index_stream`` no batch reads the index: what was last let through is Spark's keyed
    state in the checkpoint, so a batch costs what it brings. ``prepare`` adds ``text`` and
    ``embedding`` row by row. ``read_index`` gives the newest document of each id. Messages that
    cannot be used are not taken; ``index_stream`` or ``split_changes`` lists them. The query ends with
    its input, or goes on with a batch ``every`` interval, such as "1 minute".
    """
    spark = messages.sparkSession
    stamp = indexed_at or (lambda _: F.current_timestamp())

    def take(batch: DataFrame, number: int) -> None:
        append_delta(as_documents(batch.drop("reason"), stamp(number)), f"{root}/index", query_id(spark, checkpoint), number)

    good, _ = split_changes(parse_changes(messages, body))
    return (
        significant_rows(prepare(good), threshold, expire_s, every is not None)
        .writeStream.foreachBatch(take)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**({"processingTime": every} if every else {"availableNow": True}))
        .start()
    )
