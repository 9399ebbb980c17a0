"""Ordered work per key that stays parallel when one key holds much of the table.

A plain window partitioned by key sends every row of a key to one task. Here rows are counted
first, when the plan is made: per bucket of keys, by an aggregation that holds a row per bucket
in a task however many keys there are, then per key in buckets with more than ``rows_per_piece``
rows. When no key has more rows than that, the plain window is used.
Otherwise those keys are cut into consecutive pieces along their time line. Windows then run
per (key, piece); what has to cross a cut is one row per piece, so the table that carries it
has at most two rows for every ``rows_per_piece`` input rows. Only the join with full
buckets is hinted. The results are the same for any value of ``rows_per_piece``.

The cuts of a key follow percentiles of its times, so outliers and busy periods do not end
up in one piece; between two percentiles pieces have equal length. They are fixed when the
plan is made, so every evaluation of the plan cuts in the same places. Rows of one key with
the very same time stay together.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factloom.functions.time import MICROS_PER_SECOND, elapsed_micros
from factloom.plans.frontier import written

ROWS_PER_PIECE = 2_000_000
PERCENTILES = 100
#: Keys are counted together by their hash; up to KEY_BUCKETS x rows_per_piece rows few buckets are full.
KEY_BUCKETS = 16_384
PIECE = "_piece"
PIECES = "_pieces"


def position(df: DataFrame, at: str) -> Column:
    """The ordering column as a number that grows with it."""
    kind = df.schema[at].dataType
    if isinstance(kind, T.TimestampNTZType):
        return elapsed_micros(F.col(at), F.lit("1970-01-01").cast("timestamp_ntz"))
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(F.col(at))
    if isinstance(kind, T.DateType):
        return F.unix_date(F.col(at)).cast("long") * 86_400 * MICROS_PER_SECOND
    return F.col(at).cast("double")


def same_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def in_full_buckets(df: DataFrame, keys: list[str], rows_per_piece: int) -> DataFrame | None:
    """The rows whose key may have more than ``rows_per_piece`` rows, or None when no key has.

    A key has at most the rows of its bucket, so the keys of the other buckets need no counts.
    """
    bucket = F.pmod(F.xxhash64(F.lit(0), *keys), F.lit(KEY_BUCKETS)).alias("_bucket")
    counted = df.select(bucket).groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    full = [(r["_bucket"],) for r in counted.filter(F.col("_n") > rows_per_piece).collect()]  # at most KEY_BUCKETS
    if not full:
        return None
    buckets = df.sparkSession.createDataFrame(full, "_bucket long")
    return df.select(*df.columns, bucket).join(F.broadcast(buckets), "_bucket", "left_semi").select(*df.columns)


def hot_keys(df: DataFrame, keys: list[str], at: str, rows_per_piece: int) -> DataFrame:
    """Keys with more than ``rows_per_piece`` rows: (keys, _n, _lo, _hi)."""
    place = position(df, at).cast("double")
    return (
        df.select(*keys, place.alias("_at"))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_lo"), F.max("_at").alias("_hi"))
        .filter(F.col("_n") > rows_per_piece)
    )


def _cut_points(df: DataFrame, hot: DataFrame, keys: list[str], at: str) -> DataFrame:
    """Percentiles of the times of the hot keys."""
    rows = df.select(*keys, position(df, at).cast("double").alias("_at"))
    hundredths = F.array(*[F.lit(i / PERCENTILES) for i in range(1, PERCENTILES)])
    return (
        rows.join(hot, same_keys(rows, hot, keys), "left_semi")
        .groupBy(*keys)
        .agg(F.percentile_approx("_at", hundredths, 10_000).alias("_cuts"))
    )


def _edges(low: Column, high: Column, cuts: Column, wanted: Column) -> tuple[Column, Column]:
    """Rising interval bounds for a key, and the number of equal pieces inside each interval."""
    intervals = F.greatest(F.lit(1), F.least(wanted, F.lit(PERCENTILES))).cast("int")
    places = F.filter(F.sequence(F.lit(1), intervals), lambda i: i < intervals)
    chosen = F.transform(places, lambda i: F.get(cuts, F.floor(i * PERCENTILES / intervals).cast("int") - 1))
    inner = F.when(cuts.isNull(), F.array().cast("array<double>")).otherwise(chosen)
    bounds = F.when(low.isNull() | high.isNull(), F.array(F.lit(0.0), F.lit(1.0))).otherwise(
        F.array_sort(F.array_distinct(F.concat(F.array(low, high + 1.0), inner)))
    )
    return bounds, F.when(low.isNull() | high.isNull(), 1).otherwise(F.ceil(wanted / (F.size(bounds) - 1))).cast("long")


def piece_of(place: Column) -> Column:
    """Piece number of a position, given the ``_bounds`` and ``_sub`` columns of its key."""
    bounds, sub = F.col("_bounds"), F.col("_sub")
    below = F.size(F.filter(bounds, lambda b: b <= place))
    interval = F.greatest(F.lit(1), F.least(below, F.size(bounds) - 1))
    low, high = F.element_at(bounds, interval), F.element_at(bounds, interval + 1)
    part = F.floor((place - low) / (high - low) * sub).cast("long")
    first = F.lit(0).cast("long")
    inside = (interval - 1).cast("long") * sub + F.greatest(first, F.least(part, sub - 1))
    # Rows without a time sort first, so they belong to the first piece.
    return F.when(place.isNull() | bounds.isNull(), first).otherwise(inside)


@dataclass(frozen=True)
class Cuts:
    """Where the hot keys of a table are cut: (keys, _bounds, _sub), or None when no key is hot."""

    hot: DataFrame | None


def measure(df: DataFrame, keys: list[str], at: str, rows_per_piece: int) -> Cuts:
    """Count the rows per key and place the cuts. They also serve any subset of the rows."""
    suspects = in_full_buckets(df, keys, rows_per_piece)
    if suspects is None:
        return Cuts(None)
    lazy = hot_keys(suspects, keys, at, rows_per_piece)
    if lazy.isEmpty():
        return Cuts(None)
    # At most rows(df) / rows_per_piece keys, with at most as many bounds as pieces. Written, so
    # that every evaluation cuts in the same places and the table is known by its own size.
    hot = written(lazy)
    cuts = _cut_points(suspects, hot, keys, at)
    wanted = F.ceil(F.col("_n") / F.lit(rows_per_piece))
    bounds, sub = _edges(F.col("_lo"), F.col("_hi"), F.col("_cuts"), wanted)
    found = hot.join(cuts, same_keys(hot, cuts, keys), "left")
    return Cuts(written(found.select(*[hot[k] for k in keys], bounds.alias("_bounds"), sub.alias("_sub"))))


def in_pieces(df: DataFrame, keys: list[str], at: str, cuts: Cuts) -> DataFrame:
    """Add ``_piece`` (0 for keys that stay whole) and ``_pieces`` (NULL for those keys)."""
    if cuts.hot is None:
        whole = F.lit(0).cast("long").alias(PIECE), F.lit(None).cast("long").alias(PIECES)
        return df.select(*df.columns, *whole)
    rows = df.withColumn("_place", position(df, at).cast("double"))
    joined = rows.join(cuts.hot, same_keys(rows, cuts.hot, keys), "left")
    placed = [piece_of(F.col("_place")).alias(PIECE), F.col("_sub").alias(PIECES)]
    return joined.select(*[rows[c] for c in df.columns], *placed)


def _attach(rows: DataFrame, edges: DataFrame, keys: list[str]) -> DataFrame:
    """Left-join one value per (key, piece); ``edges`` holds only pieces of cut keys."""
    # Rows lie by (key, piece) already, for the window inside it, so this join moves none of them.
    on = same_keys(rows, edges, keys) & (rows[PIECE] == edges[PIECE])
    return rows.join(edges, on, "left").select(*[rows[c] for c in rows.columns], edges["_edge"])


def with_neighbour(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    take: dict[str, str],
    *,
    previous: bool = False,
    rows_per_piece: int = ROWS_PER_PIECE,
    cuts: Cuts | None = None,
) -> DataFrame:
    """Add columns of the next (or previous) row of the same key.

    ``take`` maps new column names to existing ones; ``order`` begins with the time column
    and must be total within a key. ``cuts`` takes the result of an earlier ``measure``.
    """
    cuts = cuts or measure(df, keys, order[0], rows_per_piece)
    shift = F.lag if previous else F.lead
    if cuts.hot is None:
        near = Window.partitionBy(*keys).orderBy(*order)
        return df.select(*df.columns, *[shift(source, 1).over(near).alias(n) for n, source in take.items()])
    rows = in_pieces(df, keys, order[0], cuts)
    payload = F.struct(*[F.col(source).alias(name) for name, source in take.items()])
    inside = shift(payload, 1).over(Window.partitionBy(*keys, PIECE).orderBy(*order))
    place = F.struct(*order)
    outer_row = F.max_by(payload, place) if previous else F.min_by(payload, place)
    borders = rows.filter(F.col(PIECES).isNotNull()).groupBy(*keys, PIECE).agg(outer_row.alias("_own"))
    across = shift("_own", 1).over(Window.partitionBy(*keys).orderBy(PIECE))
    edges = borders.select(*keys, PIECE, across.alias("_edge"))
    found = _attach(rows.withColumn("_inside", inside), edges, keys)
    chosen = F.coalesce(F.col("_inside"), F.col("_edge"))
    return found.select(*df.columns, *[chosen[name].alias(name) for name in take])


def carried_forward(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    value: str,
    *,
    rows_per_piece: int = ROWS_PER_PIECE,
) -> DataFrame:
    """Replace NULLs of ``value`` by the latest earlier non-NULL value of the same key."""
    cuts = measure(df, keys, order[0], rows_per_piece)
    groups = keys if cuts.hot is None else [*keys, PIECE]
    upto_here = Window.partitionBy(*groups).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    if cuts.hot is None:
        return df.withColumn(value, F.last(value, ignorenulls=True).over(upto_here))
    rows = in_pieces(df, keys, order[0], cuts)
    inside = F.last(value, ignorenulls=True).over(upto_here)
    borders = (
        rows.filter(F.col(PIECES).isNotNull())
        .groupBy(*keys, PIECE)
        .agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.struct(*order))).alias("_own"))
    )
    earlier = Window.partitionBy(*keys).orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)
    edges = borders.select(*keys, PIECE, F.last("_own", ignorenulls=True).over(earlier).alias("_edge"))
    found = _attach(rows.withColumn("_inside", inside), edges, keys)
    rest = [c for c in df.columns if c != value]
    return found.select(*rest, F.coalesce("_inside", "_edge").alias(value)).select(*df.columns)


def numbered(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    name: str,
    *,
    rows_per_piece: int = ROWS_PER_PIECE,
) -> DataFrame:
    """Add a 1-based row number per key in the given order."""
    cuts = measure(df, keys, order[0], rows_per_piece)
    if cuts.hot is None:
        number = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        return df.withColumn(name, number.cast("long"))
    rows = in_pieces(df, keys, order[0], cuts)
    inside = F.row_number().over(Window.partitionBy(*keys, PIECE).orderBy(*order))
    borders = (
        rows.filter(F.col(PIECES).isNotNull()).groupBy(*keys, PIECE).agg(F.count(F.lit(1)).alias("_own"))
    )
    earlier = Window.partitionBy(*keys).orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)
    edges = borders.select(*keys, PIECE, F.sum("_own").over(earlier).alias("_edge"))
    found = _attach(rows.withColumn("_inside", inside), edges, keys)
    total = F.col("_inside").cast("long") + F.coalesce("_edge", F.lit(0).cast("long"))
    return found.select(*df.columns, total.alias(name))
