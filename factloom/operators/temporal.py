"""Versioned and bi-temporal facts, event stores, as-of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factloom.functions.time import clock, holds_at
from factloom.plans.sequence import ROWS_PER_PIECE, carried_forward, measure, with_neighbour


def as_of(df: DataFrame, date, keys: dict[str, list] | None = None) -> DataFrame:
    """The versions valid at a moment."""
    moment = clock(date)
    found = df.filter(holds_at(moment, F.col("valid_from"), F.col("valid_to")))
    for name, values in (keys or {}).items():
        found = found.filter(F.col(name).isin(values))
    return found


def bt_current(df: DataFrame) -> DataFrame:
    """Valid now and believed now."""
    return df.filter(F.col("valid_to").isNull() & F.col("recorded_to").isNull())


def bt_valid_at(df: DataFrame, date) -> DataFrame:
    """Valid at a date, as believed now."""
    return as_of(df, date).filter(F.col("recorded_to").isNull())


def bt_as_believed(df: DataFrame, valid_at, known_at) -> DataFrame:
    """Valid at one date, as the system believed at another."""
    return as_of(df, valid_at).filter(
        holds_at(clock(known_at), F.col("recorded_from"), F.col("recorded_to"))
    )


def open_ended(
    df: DataFrame, keys: list[str], start: str, end: str, rows_per_piece: int = ROWS_PER_PIECE
) -> DataFrame:
    """Add the end of every version: the start of the next one of the key, else NULL."""
    return with_neighbour(df, keys, [start], {end: start}, rows_per_piece=rows_per_piece)


def apply_versions(
    current: DataFrame,
    changes: DataFrame,
    keys: list[str],
    start: str,
    end: str,
    rows_per_piece: int = ROWS_PER_PIECE,
) -> DataFrame:
    """Merge new versions into a history and add ``_touched`` for rows that are new or re-ended.

    A change at a start already present for the key is a replay and is dropped; of repeats
    inside the batch the least row is kept. Versions of keys named by a change are put in
    order again: an open version, or one that would run past its successor, ends where the
    successor starts. Versions of other keys are passed through without a shuffle of their own.
    """
    changed_keys = changes.select(*keys).distinct()
    given = set(changes.columns)
    added = changes.select(
        *[
            F.col(c) if c in given and c != end else F.lit(None).cast(current.schema[c].dataType).alias(c)
            for c in current.columns
        ]
    )
    affected = current.join(changed_keys, keys, "left_semi").withColumn("_new", F.lit(False))
    rest = [c for c in current.columns if c not in (*keys, start)]
    rows = affected.unionByName(added.withColumn("_new", F.lit(True)))
    # Counted without the join that finds the affected versions; the cuts serve any part of the rows.
    places = current.select(*keys, start).unionByName(changes.select(*keys, start))
    cuts = measure(places, keys, start, rows_per_piece)
    # Per start the row that was there before wins over any change: it sorts first, and rows
    # that follow one with the same start are dropped. Both windows use one shuffle and sort.
    ranked = with_neighbour(rows, keys, [start, "_new", *rest], {"_before": start}, previous=True, cuts=cuts)
    kept = ranked.filter(F.col("_before").isNull() | (F.col("_before") != F.col(start))).drop("_before")
    linked = with_neighbour(kept, keys, [start], {"_next": start}, cuts=cuts)
    new_end = F.least(F.col(end), F.col("_next"))
    merged = linked.withColumn("_touched", F.col("_new") | ~new_end.eqNullSafe(F.col(end))).withColumn(
        end, new_end
    )
    untouched = current.join(changed_keys, keys, "left_anti").withColumn("_touched", F.lit(False))
    return merged.select(*current.columns, "_touched").unionByName(untouched)


def refused_changes(
    current: DataFrame, changes: DataFrame, keys: list[str], start: str = "valid_from", ignore: list[str] | None = None
) -> DataFrame:
    """The changes that ``apply_versions`` does not apply although they say something new.

    ``HELD_START``: the key has a version at that start with other values. ``SAME_START``: another
    change of the batch with the same key and start, the least one, is applied. Exact repeats
    say nothing new and are not listed. Only columns that both sides have, and that are not in
    ``ignore``, are compared.
    """
    values = [c for c in changes.columns if c in current.columns and c not in (*keys, start, *(ignore or []))]
    place = F.row_number().over(Window.partitionBy(*keys, start).orderBy(*values))
    given = changes.select(*keys, start, *values).distinct().withColumn("_place", place)
    held = current.select(*keys, start, F.struct(*values).alias("_held"))
    judged = given.join(held, [*keys, start], "left")
    reason = F.when(F.col("_held").isNull(), F.when(F.col("_place") > 1, "SAME_START")).when(
        F.col("_held") != F.struct(*values), "HELD_START"
    )
    return judged.select(*keys, start, *values, reason.alias("reason")).filter("reason IS NOT NULL")


def scd2_apply(
    current: DataFrame,
    changes: DataFrame,
    keys: list[str],
    ts: str = "valid_from",
    now=None,
    end: str = "valid_to",
    stamp: str | None = "updated_at",
    defaults: dict | None = None,
    rows_per_piece: int = ROWS_PER_PIECE,
) -> DataFrame:
    """Close the open version at the change time and open a new one.

    ``now`` stamps re-ended and new versions; ``defaults`` sets columns of new versions
    whatever the change carries.
    """
    for name, value in (defaults or {}).items():
        changes = changes.withColumn(name, F.lit(value).cast(current.schema[name].dataType))
    merged = apply_versions(current, changes, keys, ts, end, rows_per_piece)
    if stamp and stamp in current.columns and now is not None:
        merged = merged.withColumn(
            stamp, F.when(F.col("_touched"), clock(now)).otherwise(F.col(stamp))
        )
    return merged.select(*current.columns)


def bt_correct(
    df: DataFrame,
    corrections: DataFrame,
    keys: list[str],
    rows_per_piece: int = ROWS_PER_PIECE,
) -> DataFrame:
    """End the belief in a version and append the corrected one with its reason.

    A correction names the version by ``keys`` and ``valid_from`` and carries
    ``recorded_from``, the time from which it is believed.
    """
    return apply_versions(
        df, corrections, [*keys, "valid_from"], "recorded_from", "recorded_to", rows_per_piece
    ).select(*df.columns)


def event_store_issues(events: DataFrame) -> DataFrame:
    """Breaches of the append rules, one row per breach.

    Columns: issue, stream_id, sequence_no, event_id, occurrences. Every test is a grouping
    or a join on the full (stream, sequence) key, so a long stream is spread over all tasks.
    """
    none = lambda kind: F.lit(None).cast(kind)
    long_id = events.schema["stream_id"].dataType
    event_id = events.schema["event_id"].dataType
    duplicate_ids = (
        events.groupBy("event_id")
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .filter("occurrences > 1")
        .select(
            F.lit("DUPLICATE_EVENT_ID").alias("issue"),
            none(long_id).alias("stream_id"),
            none("long").alias("sequence_no"),
            "event_id",
            "occurrences",
        )
    )
    slots = events.groupBy("stream_id", "sequence_no").agg(F.count(F.lit(1)).alias("occurrences"))
    duplicate_slots = slots.filter("occurrences > 1").select(
        F.lit("DUPLICATE_SEQUENCE").alias("issue"),
        "stream_id",
        F.col("sequence_no").cast("long").alias("sequence_no"),
        none(event_id).alias("event_id"),
        "occurrences",
    )
    # A slot with no successor is a gap unless it is the last of its stream.
    lasts = slots.groupBy("stream_id").agg(F.max("sequence_no").alias("_last"))
    followed = slots.select("stream_id", (F.col("sequence_no") - 1).alias("sequence_no"))
    gaps = (
        slots.join(followed, ["stream_id", "sequence_no"], "left_anti")
        .join(lasts, "stream_id")
        .filter(F.col("sequence_no") < F.col("_last"))
        .select(
            F.lit("GAP_AFTER").alias("issue"),
            "stream_id",
            F.col("sequence_no").cast("long").alias("sequence_no"),
            none(event_id).alias("event_id"),
            F.lit(1).cast("long").alias("occurrences"),
        )
    )
    early = events.filter(F.col("recorded_at") < F.col("occurred_at")).select(
        F.lit("RECORDED_BEFORE_OCCURRED").alias("issue"),
        "stream_id",
        F.col("sequence_no").cast("long").alias("sequence_no"),
        "event_id",
        F.lit(1).cast("long").alias("occurrences"),
    )
    return duplicate_ids.unionByName(duplicate_slots).unionByName(gaps).unionByName(early)


def event_state(events: DataFrame, as_of=None, state: list[str] | None = None) -> DataFrame:
    """The latest state of every stream, optionally as recorded up to a moment."""
    state = state or ["event_type", "event_data", "occurred_at"]
    seen = events if as_of is None else events.filter(F.col("recorded_at") <= clock(as_of))
    return (
        seen.groupBy("stream_id")
        .agg(
            F.max("sequence_no").alias("last_sequence_no"),
            F.count(F.lit(1)).alias("event_count"),
            F.max_by(F.struct(*state), "sequence_no").alias("_state"),
        )
        .select(
            "stream_id", "last_sequence_no", "event_count", *[F.col("_state")[c].alias(c) for c in state]
        )
    )


def event_attributes(events: DataFrame, as_of=None, tiebreak: list[str] | None = None) -> DataFrame:
    """(stream_id, attribute, value, sequence_no), the last write of every attribute of a stream.

    ``event_data`` is a JSON object whose keys are attributes; values come as text, nested ones
    as JSON. A later event writes the attributes it names and leaves the others; NULL takes an
    attribute away. Writes with one sequence_no go by ``tiebreak`` (event_id by default), then by
    value. Events whose data is no object write nothing. With ``as_of`` only events recorded
    by then count. Rows are reduced per stream and attribute with partial results, so a
    stream with very many events meets no single task.
    """
    seen = events if as_of is None else events.filter(F.col("recorded_at") <= clock(as_of))
    written = seen.select(
        "stream_id", F.struct("sequence_no", *(tiebreak or ["event_id"])).alias("_at"), F.explode(F.from_json("event_data", "map<string,string>")).alias("attribute", "value")
    )
    last = written.groupBy("stream_id", "attribute").agg(F.max(F.struct("_at", "value")).alias("_w"))
    return last.select("stream_id", "attribute", F.col("_w.value").alias("value"), F.col("_w._at.sequence_no").alias("sequence_no")).filter("value IS NOT NULL")


def event_fold(events: DataFrame, as_of=None, tiebreak: list[str] | None = None) -> DataFrame:
    """(stream_id, last_sequence_no, event_count, state) with the attributes folded over all events.

    ``state`` maps attributes to their last values, by name; it is empty where nothing is written
    or all was taken away. See ``event_attributes``.
    """
    attributes = event_attributes(events, as_of, tiebreak)
    entries = F.array_sort(F.collect_list(F.struct("attribute", "value")))  # as many as a stream has attributes
    states = attributes.groupBy("stream_id").agg(F.map_from_entries(entries).alias("state"))
    counts = event_state(events, as_of, ["event_type"]).drop("event_type")
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    joined = counts.join(states, counts["stream_id"].eqNullSafe(states["stream_id"]), "left")
    return joined.select(counts["stream_id"], "last_sequence_no", "event_count", F.coalesce("state", empty).alias("state"))


def snapshots_to_scd2(
    snapshots: DataFrame,
    keys: list[str],
    attrs: list[str],
    at: str = "snapshot_date",
    rows_per_piece: int = ROWS_PER_PIECE,
    complete: bool = False,
) -> DataFrame:
    """Turn repeated snapshots into versions, one per change of the attributes.

    With ``complete`` every snapshot holds all keys there were: a key that is not in the next
    one ends there, and begins a new version if it comes back.
    """
    rows = snapshots.select(*keys, at, *attrs, F.lit(False).alias("_gone"))
    cuts = measure(snapshots, keys, at, rows_per_piece)
    if complete:
        # One row per snapshot, however many rows a snapshot has.
        days = snapshots.select(at).distinct().withColumn("_day", F.lead(at).over(Window.orderBy(at)))
        followed = with_neighbour(snapshots.select(*keys, at), keys, [at], {"_next": at}, cuts=cuts).join(days, at)
        missing = F.col("_day").isNotNull() & (F.col("_next").isNull() | (F.col("_next") > F.col("_day")))
        gone = followed.filter(missing).select(
            *keys,
            F.col("_day").alias(at),
            *[F.lit(None).cast(snapshots.schema[c].dataType).alias(c) for c in attrs],
            F.lit(True).alias("_gone"),
        )
        rows = rows.unionByName(gone)
    rows = rows.withColumn("_now", F.struct("_gone", *attrs))
    compared = with_neighbour(rows, keys, [at], {"_before": "_now"}, previous=True, cuts=cuts)
    changed = compared.filter(~F.col("_before").eqNullSafe(F.col("_now"))).select(
        *keys, F.col(at).alias("valid_from"), *attrs, "_gone"
    )
    versions = with_neighbour(changed, keys, ["valid_from"], {"valid_to": "valid_from"}, cuts=cuts)
    return versions.filter(~F.col("_gone")).drop("_gone")


def asof_join(
    events: DataFrame,
    facts: DataFrame,
    keys: list[str],
    ts: str,
    tiebreak: list[str],
    take: list[str],
    rows_per_piece: int = ROWS_PER_PIECE,
) -> DataFrame:
    """Attach to each event the fact version valid at its time.

    Facts and events are put on one time line per key and the latest version is carried
    forward, so the cost is linear in both; no event meets more than one version. Events
    without a valid version keep NULLs. The versions of a key must not overlap.
    """
    kept = [c for c in events.columns if c not in keys]
    version = F.struct(F.col("valid_from"), F.col("valid_to"), *[F.col(c) for c in take])
    fact_rows = facts.select(
        *keys,
        F.col("valid_from").alias("_at"),
        F.lit(0).alias("_side"),
        *[F.lit(None).cast(events.schema[c].dataType).alias(f"_e_{c}") for c in kept],
        version.alias("_version"),
    )
    event_rows = events.select(
        *keys,
        F.col(ts).alias("_at"),
        F.lit(1).alias("_side"),
        *[F.col(c).alias(f"_e_{c}") for c in kept],
        F.lit(None).cast(fact_rows.schema["_version"].dataType).alias("_version"),
    )
    line = fact_rows.unionByName(event_rows)
    order = ["_at", "_side", *[f"_e_{c}" for c in tiebreak if c not in (*keys, ts)]]
    carried = carried_forward(line, keys, order, "_version", rows_per_piece=rows_per_piece)
    open_still = F.col("_version.valid_to").isNull() | (F.col("_version.valid_to") > F.col("_at"))
    hit = F.when(open_still, F.col("_version"))
    return carried.filter(F.col("_side") == 1).select(
        *keys,
        *[F.col(f"_e_{c}").alias(c) for c in kept],
        hit["valid_from"].alias("fact_valid_from"),
        *[hit[c].alias(f"fact_{c}") for c in take],
    )
