"""Records whose word sets are nearly equal (O09), by prefix filters (Bayardo et al. 2007, Wang et al. 2012).

Tokens are ordered from rare to common. Two sets that share enough tokens share two of the
first few in that order, so only sets with a pair of such tokens in common are compared. Sets
beyond LONG tokens are found by single tokens, as their first ones are rare and pairs many;
sets near that size take part in both. Equal sets are one set. Candidates are checked exactly;
before their tokens are fetched, those go whose sketches prove them too far apart: a short
sketch stands beside each key, a long one is joined to the pairs that are left.

Tokens are ordered where they lie. Any order common to all sets finds all pairs, so rows are
counted per bucket of tokens, and a table of BUCKETS numbers is sent to all tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.functions.numeric import percent
from factloom.plans.frontier import written
from factloom.plans.sizes import bounded_batches

LONG = 200
#: Longs in the sketch of a set.
WORDS = 16
#: Longs in the short sketch of a large set; smaller ones have fewer, powers of two.
BRIEF = 8
#: Buckets of tokens that are counted, a power of two.
BUCKETS = 1 << 18
#: Candidates of a set that are checked first; every further time so many times as many.
ASKED = 8
#: Keys of a set under which it is first held against others.
FEW = 8
#: Hashes of tokens that go to Python at once.
BATCH_BYTES = 16 << 20
#: Between the tokens of a packed set, and what marks it inside a token.
GAP, MARK = "\n", "\\"


def tokens_of(text: Column) -> Column:
    """The distinct words of a text, lower-cased; NULL has none."""
    return F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))


def _keys(size: Column, ordered: Column, threshold: float) -> Column:
    """What sets must share one of to be compared."""
    need = F.ceil(size * threshold - 1e-9).cast("int")
    first = F.slice(ordered, F.lit(1), size - need + 2)
    pairs = F.flatten(F.transform(first, lambda a, i: F.transform(F.slice(first, i + 2, F.size(first)), lambda b: F.xxhash64(a, b))))
    single = F.transform(F.slice(ordered, F.lit(1), size - need + 1), lambda a: F.xxhash64(a))
    none = F.array().cast("array<bigint>")
    by_pair = F.when(size <= LONG, F.array_distinct(pairs)).otherwise(none)
    by_one = F.when(size >= math.floor(LONG * threshold), single).otherwise(none)
    return F.concat(F.transform(by_pair, lambda k: F.struct(F.lit(2).alias("kind"), k.alias("key"))), F.transform(by_one, lambda k: F.struct(F.lit(1).alias("kind"), k.alias("key"))))


def distinct_sets(df: DataFrame, key: str, tokens: str) -> DataFrame:
    """(set_id, tokens, size): each set of tokens once, named by the least key; sets without tokens are left out."""
    rows = df.select(F.col(key).alias("set_id"), F.array_sort(F.array_distinct(tokens)).alias("tokens")).filter(F.size("tokens") > 0)
    return rows.groupBy("tokens").agg(F.min("set_id").alias("set_id")).select("set_id", "tokens", F.size("tokens").alias("size"))


def _sketches(each: DataFrame) -> DataFrame:
    """(set_id, size, sketch) of tokens (set_id, size, token): per bit, whether an odd number of tokens hash to it.

    A token that only one of two sets has changes one bit, so sketches differ in no more bits
    than the sets do in tokens.
    """
    h = F.xxhash64("token")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.call_function("shiftright", h, F.lit(8)), F.lit(64)).cast("int"))
    words = [F.coalesce(F.bit_xor(F.when(F.pmod(h, F.lit(WORDS)) == w, bit)), F.lit(0).cast("long")) for w in range(WORDS)]
    return each.groupBy("set_id", "size").agg(F.array(*words).alias("sketch"))


def _packed(tokens: Column) -> Column:
    """The tokens as one string, a third of the bytes; equal ones stay equal, and others different."""
    odd = F.exists(tokens, lambda t: t.isNull() | t.contains(GAP) | t.contains(MARK))
    told = F.transform(tokens, lambda t: F.coalesce(F.replace(F.replace(t, F.lit(MARK), F.lit(f"{MARK}m")), F.lit(GAP), F.lit(f"{MARK}g")), F.lit(f"{MARK}n")))
    return F.array_join(F.when(odd, told).otherwise(tokens), GAP)


def _counts(hashed: DataFrame) -> np.ndarray:
    """How many tokens of all sets fall to each bucket."""
    bucket = F.col("h").bitwiseAND(F.lit(BUCKETS - 1).cast("long")).alias("bucket")
    found = hashed.select(F.explode("hashes").alias("h")).groupBy(bucket).agg(F.count(F.lit(1)).alias("n")).toPandas()  # BUCKETS rows at most
    counts = np.zeros(BUCKETS, np.int64)
    counts[found["bucket"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    return counts


def _first_tokens(hashed: DataFrame, threshold: float) -> DataFrame:
    """(set_id, size, first, brief): the rarest tokens, of which any near set has one or two, in order, and a short sketch.

    Two tokens of a set with one hash are told apart by their turn, so hashes stand for tokens
    without a pair being lost; what they bring together wrongly is checked later.
    """
    counts = hashed.sparkSession.sparkContext.broadcast(_counts(hashed))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, sizes = batch.column("hashes"), batch.column("size").to_numpy()
            h, n = lists.flatten().to_numpy(zero_copy_only=False), lists.value_lengths().to_numpy()
            row, begin = np.repeat(np.arange(len(n)), n), np.cumsum(n) - n
            order = np.lexsort((h, counts.value[h & (BUCKETS - 1)], row))
            ordered = h[order]
            same = np.flatnonzero((ordered[1:] == ordered[:-1]) & (row[1:] == row[:-1])) + 1
            for k in same:  # hardly ever
                ordered[k] = (int(ordered[k - 1]) + 2**63 + 1) % 2**64 - 2**63
            need = np.ceil(sizes * threshold - 1e-9).astype(np.int64)
            kept = np.minimum(np.maximum(sizes - need + 2, 0), n)
            place = np.arange(len(h)) - np.repeat(begin, n)
            first = ordered[place < np.repeat(kept, n)]
            wide = np.where(sizes <= LONG, 2, np.where(sizes <= 4 * LONG, 4, BRIEF))
            words, start = np.zeros(wide.sum(), np.int64), np.cumsum(wide) - wide
            np.bitwise_xor.at(words, np.repeat(start, n) + (h & np.repeat(wide - 1, n)), np.left_shift(np.int64(1), (h >> 8) & 63))
            lists = [pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(k)), pa.int32()), pa.array(v)) for k, v in ((kept, first), (wide, words))]
            yield pa.RecordBatch.from_arrays([batch.column("set_id"), batch.column("size"), *lists], ["set_id", "size", "first", "brief"])

    kind = hashed.schema["set_id"].dataType.simpleString()
    with bounded_batches(hashed.sparkSession, BATCH_BYTES):
        return written(hashed.mapInArrow(run, f"set_id {kind}, size int, first array<bigint>, brief array<bigint>"))


def near_sets(sets: DataFrame, threshold: float) -> DataFrame:
    """(low, high, overlap, similarity) of all pairs of ``sets`` with a Jaccard similarity of ``threshold`` or more.

    ``threshold`` is over 0.5, so that different sets share two tokens at least. Each pair is
    given once. A set whose token is NULL has no such token.
    """
    _check(threshold)
    sets = _kept(sets.select("set_id", F.col("size").cast("int").alias("size"), _packed(F.col("tokens")).alias("packed")))
    firsts, sketches = _firsts_and_sketches(sets, threshold)
    return _checked(_close(_pairs(_cells(firsts, threshold), threshold), sketches, threshold), sets, threshold)


def _kept(texts: DataFrame) -> DataFrame:
    return written(texts, codec="zstd")


def _check(threshold: float) -> None:
    if not 0.5 < threshold <= 1:
        raise ValueError("a threshold over 0.5, up to 1")


def _brief_apart(even: Column) -> Column:
    """Bits in which the short sketches of a and b differ; if not of one width, folded to two words."""
    def differ(one: list[Column], other: list[Column]) -> Column:
        return sum((F.bit_count(x.bitwiseXOR(y)) for x, y in zip(one, other, strict=True)), F.lit(0))

    def folded(words: list[Column]) -> list[Column]:
        return [reduce(lambda x, y: x.bitwiseXOR(y), words[k::2]) for k in (0, 1)]

    a, b = ([F.col(f"{n}.w{k}") for k in range(BRIEF)] for n in ("a", "b"))
    return F.when(even, differ(a, b)).otherwise(differ(folded(a), folded(b)))


def _tokens(packed: str) -> Column:
    return F.filter(F.split(packed, GAP), lambda t: t != f"{MARK}n")


def _cells(firsts: DataFrame, threshold: float, *more: str, few: int | None = None) -> DataFrame:
    """A row per key of a set, or per key of its ``few`` least ones, which near sets mostly have in common."""
    keys = _keys(F.col("size"), F.col("first"), threshold)
    if few is not None:
        keys = F.slice(F.array_sort(F.transform(keys, lambda k: F.struct(F.xxhash64(k["kind"], k["key"]).alias("key"), k["kind"].alias("kind")))), 1, few)
    # Plain columns, as millions of pairs are held against each other; words that a narrow sketch lacks are 0.
    words = [F.coalesce(F.get("brief", F.lit(k)), F.lit(0).cast("long")).alias(f"w{k}") for k in range(BRIEF)]
    cells = firsts.select("set_id", "size", *more, F.size("brief").alias("wide"), *words, F.inline(keys))
    mark = F.col("wide") * 4 + (F.col("kind") == 1).cast("int") * 2 + (F.col("size") > LONG).cast("int")
    return cells.select("set_id", "size", *more, *[f"w{k}" for k in range(BRIEF)], mark.alias("mark"), F.xxhash64("kind", "key").alias("key"))


def _together(threshold: float) -> Column:
    """Whether cells a and b of one key are of sets that may be near.

    Its tests can't be taken apart and ask the same columns of both sides, so a join of cells
    with themselves reads one exchange twice.
    """
    same = F.col("a.key") == F.col("b.key")
    alike = F.least("a.size", "b.size") >= F.greatest("a.size", "b.size") * threshold - 1e-9
    # Pairs of which both are short are found by pairs of tokens, the others by single ones.
    right_kind = F.shiftright("a.mark", 1).bitwiseAND(F.lit(1)) + F.col("a.mark").bitwiseOR(F.col("b.mark")).bitwiseAND(F.lit(1)) != 1
    even = F.shiftright("a.mark", 2) == F.shiftright("b.mark", 2)
    # Of n tokens in both sets together, no more than this may be in one only.
    return same & alike & right_kind & (_brief_apart(even) <= (F.col("a.size") + F.col("b.size")) * _spare(threshold) + 1e-6)


def _spare(threshold: float) -> float:
    return (1 - threshold) / (1 + threshold)


def _pairs(cells: DataFrame, threshold: float, wanted: Column | None = None) -> DataFrame:
    """(x, y): pairs of sets that meet under a key, each once."""
    a, b = cells.alias("a"), cells.alias("b")
    smaller = (F.col("a.size") < F.col("b.size")) | ((F.col("a.size") == F.col("b.size")) & (F.col("a.set_id") < F.col("b.set_id")))
    test = smaller & _together(threshold)
    met = a.hint("merge").join(b, test if wanted is None else test & wanted)
    return met.select(F.col("a.set_id").alias("x"), F.col("b.set_id").alias("y")).distinct()


def _firsts_and_sketches(sets: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    firsts = _first_tokens(sets.select("set_id", "size", F.transform(_tokens("packed"), lambda t: F.xxhash64(t)).alias("hashes")), threshold)
    return firsts, written(_sketches(sets.select("set_id", "size", F.explode(_tokens("packed")).alias("token"))))


def _close(pairs: DataFrame, sketches: DataFrame, threshold: float) -> DataFrame:
    """The pairs that long sketches do not prove too far apart."""
    x, y = (sketches.select(F.col("set_id").alias(n), F.col("size").alias(f"{n}_size"), F.col("sketch").alias(f"{n}_sketch")) for n in ("x", "y"))
    apart = sum((F.bit_count(F.col("x_sketch")[w].bitwiseXOR(F.col("y_sketch")[w])) for w in range(WORDS)), F.lit(0))
    may = (F.col("x_size") + F.col("y_size")) * _spare(threshold) + 1e-6
    return written(written(pairs).join(x, "x").join(y, "y").filter(apart <= may).select("x", "y"))


def _checked(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """(low, high, overlap, similarity) of the pairs that are near."""
    asked = sets.join(pairs.select(F.explode(F.array("x", "y")).alias("set_id")).distinct(), "set_id", "left_semi")
    x, y = (asked.select(F.col("set_id").alias(n), F.col("size").alias(f"{n}_size"), F.col("packed").alias(f"{n}_packed")) for n in ("x", "y"))
    both = pairs.join(x, "x").join(y, "y")
    shared = F.size(F.array_intersect(F.split("x_packed", GAP), F.split("y_packed", GAP)))
    counted = both.select("x", "y", shared.alias("overlap"), (F.col("x_size") + F.col("y_size") - shared).alias("union"))
    # Whole numbers decide, so that a similarity of exactly the threshold counts.
    near = counted.filter(F.col("overlap") >= F.col("union") * threshold - 1e-9)
    return near.select(F.least("x", "y").alias("low"), F.greatest("x", "y").alias("high"), "overlap", (F.col("overlap") / F.col("union")).alias("similarity"))


def _least(ends: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """(set_id, first_near): the least key of a near set, out of candidates (set_id, _other, first_near).

    Candidates of a set are checked by rising keys, a few, then ASKED times as many, until one is near.
    """
    turn = F.row_number().over(Window.partitionBy("set_id").orderBy("first_near", "_other"))
    waiting, most, found = written(ends.withColumn("_turn", turn)), ASKED, []
    while not waiting.isEmpty():
        now = waiting.filter(F.col("_turn") <= most).withColumns({"low": F.least("set_id", "_other"), "high": F.greatest("set_id", "_other")})
        near = _checked(now.select(F.col("low").alias("x"), F.col("high").alias("y")).distinct(), sets, threshold).select("low", "high")
        found.append(written(now.join(near, ["low", "high"]).groupBy("set_id").agg(F.min("first_near").alias("first_near"))))
        waiting = written(waiting.filter(F.col("_turn") > most).join(found[-1], "set_id", "left_anti"))
        most *= ASKED
    return reduce(lambda a, b: a.unionByName(b), found, waiting.select("set_id", "first_near"))


def _first_near(sets: DataFrame, keys: DataFrame, threshold: float) -> DataFrame:
    """(set_id, first_near): the least key of a near set, of the sets in ``keys`` (set_id, _key).

    First each set is held against the sets of least key under a few of its keys. After that only
    pairs are made that give one of the two a lesser key than it has, so a group of sets that are
    all near each other does not make all its pairs.
    """
    firsts, sketches = _firsts_and_sketches(sets, threshold)
    firsts = firsts.join(keys, "set_id")
    other = keys.select(F.col("set_id").alias("_other"), F.col("_key").alias("first_near"))
    rank = F.row_number().over(Window.partitionBy("key").orderBy("_key", "set_id"))
    ranked = _cells(firsts, threshold, "_key", few=FEW).withColumn("_rank", rank)
    met = ranked.alias("a").hint("merge").join(ranked.filter(F.col("_rank") <= 2).alias("b"), _together(threshold) & (F.col("a.set_id") != F.col("b.set_id")))
    pairs = _close(met.select(F.col("a.set_id").alias("x"), F.col("b.set_id").alias("y")).distinct(), sketches, threshold)
    begun = written(_least(pairs.select(F.col("x").alias("set_id"), F.col("y").alias("_other")).join(other, "_other"), sets, threshold))
    best = begun.select("set_id", F.col("first_near").alias("_best"))
    cells = _cells(firsts.join(best, "set_id", "left"), threshold, "_key", "_best")
    lesser = F.col("a._best").isNull() | F.col("b._best").isNull() | (F.col("b._key") < F.col("a._best")) | (F.col("a._key") < F.col("b._best"))
    pairs = _close(_pairs(cells, threshold, lesser), sketches, threshold)
    ends = pairs.select(F.inline(F.array(*[F.struct(F.col(a).alias("set_id"), F.col(b).alias("_other")) for a, b in (("x", "y"), ("y", "x"))])))
    ends = ends.join(other, "_other").join(best, "set_id", "left").filter(F.col("_best").isNull() | (F.col("first_near") < F.col("_best"))).drop("_best")
    return begun.unionByName(_least(ends, sets, threshold)).groupBy("set_id").agg(F.min("first_near").alias("first_near"))


def near_duplicates(df: DataFrame, key: str, text: str, threshold: float = 0.9) -> DataFrame:
    """(key, first_equal, first_near): per row the least key with the same words, and the least one with nearly the same.

    first_near is NULL if no set of other words is near; rows without words equal each other
    and are near no others. Rows without key are left out.
    """
    _check(threshold)
    rows = df.filter(F.col(key).isNotNull()).select(F.col(key).alias("_key"), F.array_sort(tokens_of(F.col(text))).alias("_t"))
    rows = rows.select("_key", F.size("_t").alias("size"), _packed(F.col("_t")).alias("packed"))
    # Written, so that rows keep their numbers.
    rows = _kept(rows.select("*", F.unhex(F.sha2(F.concat_ws(" ", "size", "packed"), 256)).alias("_h"), F.monotonically_increasing_id().alias("set_id")))
    firsts = written(rows.groupBy("_h").agg(F.min(F.struct("_key", "set_id")).alias("_first"), F.min("size").alias("size")).select("_h", "size", "_first.*"))
    near = _first_near(rows.filter("size > 0").select("set_id", "size", "packed"), firsts.filter("size > 0").select("set_id", "_key"), threshold)
    told = firsts.join(near, "set_id", "left").select("_h", F.col("_key").alias("first_equal"), "first_near")
    return rows.select(F.col("_key").alias(key), "_h").join(told, "_h").select(key, "first_equal", "first_near")


def near_duplicate_rate(df: DataFrame, key: str, text: str, at: str, threshold: float = 0.9, limit_points: float = 2.0) -> DataFrame:
    """Per week the share of rows that repeat, exactly or nearly, a row with a smaller key, and its rise.

    So of a group of near-equal rows all but the first count, in the week in which they come.
    """
    judged = near_duplicates(df, key, text, threshold)
    again = F.coalesce(F.least("first_equal", "first_near") < F.col(key), F.lit(False))
    weeks = (
        df.select(key, F.date_trunc("week", at).cast("date").alias("week"))
        .join(judged.select(key, again.alias("_again")), key)
        .groupBy("week")
        .agg(F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col("_again"), 1)).alias("repeats"))
        .withColumn("duplicate_pct", percent(F.col("repeats"), F.col("rows")))
    )
    before = F.lag("duplicate_pct").over(Window.partitionBy().orderBy("week"))  # a row per week
    return weeks.withColumn("change_points", F.round(F.col("duplicate_pct") - before, 2)).withColumn(
        "breach", F.coalesce(F.col("change_points") > limit_points, F.lit(False))
    )
