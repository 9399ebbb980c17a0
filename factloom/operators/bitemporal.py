"""As-of lookups in two times at once, one pair of times per request."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.plans.frontier import written
from factloom.plans.sequence import ROWS_PER_PIECE, carried_forward, position

DAY, SECOND = 86_400_000_000, 1_000_000


def interval_nodes(start: Column, stop: Column, levels: int) -> Column:
    """The dyadic intervals (level, node) that make up [start, stop), at most two a level.

    Node n of level k covers [n 2^k, (n + 1) 2^k). A point lies in one node of each level, so
    exactly one of these nodes holds it if it lies in [start, stop), and else none.
    """

    def at(k: Column) -> Column:
        last = F.call_function("shiftleft", F.lit(1).cast("long"), k) - 1
        low, high = F.call_function("shiftright", start + last, k), F.call_function("shiftright", stop, k)
        left = F.when((low < high) & (low % 2 == 1), F.struct(k.alias("level"), low.alias("node")))
        right = F.when((low < high) & (high % 2 == 1), F.struct(k.alias("level"), (high - 1).alias("node")))
        return F.filter(F.array(left, right), lambda n: n.isNotNull())

    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(levels)), at))


def point_nodes(point: Column, levels: int) -> Column:
    """The node (level, node) of every level that holds a point."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(levels)),
        lambda k: F.struct(k.alias("level"), F.call_function("shiftright", point, k).alias("node")),
    )


def bt_asof(
    requests: DataFrame,
    versions: DataFrame,
    keys: list[str],
    take: list[str],
    tiebreak: list[str],
    valid_at: str = "valid_at",
    known_at: str = "known_at",
    rows_per_piece: int = ROWS_PER_PIECE,
) -> DataFrame:
    """T05 per row: what was believed at each request's ``known_at`` to hold at its ``valid_at``.

    ``versions`` has the keys, valid_from, valid_to, recorded_from, recorded_to (ends may be NULL,
    and are not included), ``take`` and ``tiebreak``. Of the versions recorded then, the one that
    starts last, at or before ``valid_at``, is believed: a later start ends what began before, so
    overlapping versions have a defined answer; equal starts go by recorded_from, then
    ``tiebreak``, the greatest winning. If that one has ended, nothing is. Every request gives one
    row: its columns, version_valid_from, and ``take`` prefixed by ``version_``, NULL without an answer.

    The recorded intervals are cut into dyadic nodes, a request asks the one node of every
    level that holds its ``known_at``, and within a node the latest start is carried forward in
    valid time. So a version gives about as many rows as the recorded time has bits (in days
    or seconds if all times are whole ones), no request meets more than one version per level,
    and there is no range join. Keys whose pairs of version and request are no more than these
    rows would be, and fit one piece, are answered by the pairs. Rows without key, valid_from,
    recorded_from, or a time asked find nothing.
    """
    times = ["recorded_from", "recorded_to"]
    micros = {c: position(versions, c) for c in times}
    whole = lambda unit: F.bool_and((F.coalesce(micros["recorded_from"], F.lit(0)) % unit == 0) & (F.coalesce(micros["recorded_to"], F.lit(0)) % unit == 0))
    span = versions.agg(
        F.min(micros["recorded_from"]).alias("low"),
        F.greatest(F.max(micros["recorded_from"]), F.max(micros["recorded_to"])).alias("high"),
        whole(DAY).alias("days"),
        whole(SECOND).alias("seconds"),
    ).first()
    unit = DAY if span["days"] else SECOND if span["seconds"] else 1
    low = (span["low"] or 0) // unit
    end = ((span["high"] or 0) // unit) - low + 1  # an open interval reaches here, as does every later point
    levels = max(1, end.bit_length())

    def tick(moment: Column) -> Column:
        return F.call_function("div", moment - F.pmod(moment, F.lit(unit)), F.lit(unit)) - low

    def named(df: DataFrame) -> DataFrame:
        return df.dropna(subset=keys)

    numbered = written(requests.withColumn("_request", F.monotonically_increasing_id()))
    asked = tick(position(numbered, known_at))
    order = ["valid_from", "recorded_from", *tiebreak]
    version = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], F.col("valid_to").alias("valid_to"), *[F.col(c).alias(f"t{i}") for i, c in enumerate(take)])
    stop = F.coalesce(tick(micros["recorded_to"]), F.lit(end + 1))
    believed = named(versions).filter(F.col("valid_from").isNotNull() & micros["recorded_from"].isNotNull() & (F.col("recorded_to").isNull() | (micros["recorded_from"] < micros["recorded_to"])))
    known = named(numbered).filter(F.col(valid_at).isNotNull() & (asked >= 0))
    at = F.col(valid_at).cast(versions.schema["valid_from"].dataType)
    pairs = F.col("_v") * F.col("_q")
    few = pairs <= F.least(F.lit(rows_per_piece), (F.col("_v") + F.col("_q")) * F.lit(2 * levels))
    per_key = lambda df, n: df.groupBy(*keys).agg(F.count(F.lit(1)).alias(n))
    counts = written(per_key(believed, "_v").join(per_key(known, "_q"), keys).select(*keys, few.alias("_few")))

    near = believed.select(*keys, F.col("valid_from").alias("_from"), micros["recorded_from"].alias("_low"), micros["recorded_to"].alias("_high"), version.alias("_version"))
    asking = known.join(counts.filter("_few"), keys, "left_semi").select(*keys, "_request", at.alias("_at"), position(numbered, known_at).alias("_known"))
    held = (F.col("_from") <= F.col("_at")) & (F.col("_low") <= F.col("_known")) & (F.col("_high").isNull() | (F.col("_high") > F.col("_known")))
    answers = asking.join(near, keys).filter(held).groupBy(*keys, "_request").agg(F.max("_version").alias("_version")).select("_request", "_version")

    many = counts.filter("NOT _few")
    if not many.isEmpty():
        line = believed.join(many, keys, "left_semi").select(
            *keys,
            F.explode(interval_nodes(tick(micros["recorded_from"]), stop, levels)).alias("_n"),
            F.col("valid_from").alias("_at"),
            F.lit(0).alias("_side"),
            F.lit(None).cast("long").alias("_request"),
            version.alias("_version"),
        )
        questions = known.join(many, keys, "left_semi").select(
            *keys,
            F.explode(point_nodes(F.least(asked, F.lit(end)), levels)).alias("_n"),
            at.alias("_at"),
            F.lit(1).alias("_side"),
            "_request",
            F.lit(None).cast(line.schema["_version"].dataType).alias("_version"),
        )
        rows = line.unionByName(questions).select(*keys, F.col("_n.level").alias("_level"), F.col("_n.node").alias("_node"), "_at", "_side", "_request", "_version")
        carried = carried_forward(rows, [*keys, "_level", "_node"], ["_at", "_side", "_version", "_request"], "_version", rows_per_piece=rows_per_piece)
        answers = answers.unionByName(carried.filter("_side = 1").groupBy("_request").agg(F.max("_version").alias("_version")))
    open_still = F.col("_version.valid_to").isNull() | (F.col("_version.valid_to") > F.col(valid_at))
    hit = F.when(open_still, F.col("_version"))
    return numbered.join(answers, "_request", "left").select(
        *requests.columns,
        hit["o0"].alias("version_valid_from"),
        *[hit[f"t{i}"].alias(f"version_{c}") for i, c in enumerate(take)],
    )
