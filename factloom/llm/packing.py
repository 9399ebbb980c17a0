"""Packing of token sequences by minimum bin slack (Gupta and Ho 1999).

A document is cut into full windows and one rest. What is left of the corpus is how often
each rest length occurs, a table as long as the window, whatever the size of the corpus.
On it, windows are filled one pattern at a time: the longest rest opens the window, and a
subset-sum over the lengths in stock, held as one bit per reachable sum, finds the multiset
that comes closest to the capacity. A pattern is used as often as the stock allows, so the
number of patterns is bounded by the lengths, not by the documents. Rests then take the
places of their length in order of their rank.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factloom.llm.text import slices, texts_of
from factloom.llm.token_ids import alike, encoder
from factloom.plans.frontier import settled

WINDOW = 1024
END = (0).to_bytes(4, "little")


def fullest(stock: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of lengths in stock with the greatest sum within ``room``, long ones first.

    Bit s of ``reached`` is set when some multiset of the lengths seen so far sums to s. The
    states after each length are kept, and the counts are read back from the last to the first.
    """
    reached, steps, goal = 1, [], 1 << room
    for length in sorted((n for n, left in stock.items() if left and n <= room), reverse=True):
        before, count, share = reached, min(stock[length], room // length), 1
        while count:  # counts 0..n as sums of 1, 2, 4, ... and a rest
            share = min(share, count)
            reached |= (reached << (share * length)) & ((goal << 1) - 1)
            count -= share
            share *= 2
        steps.append((length, before))
        if reached & goal:
            break
    total = reached.bit_length() - 1
    found: dict[int, int] = {}
    for length, before in reversed(steps):
        while not before >> total & 1:
            found[length] = found.get(length, 0) + 1
            total -= length
    return found


def plan(stock: dict[int, int], window: int = WINDOW) -> list[tuple[dict[int, int], int]]:
    """(pattern, times) until the stock is used up; a pattern gives how often each length occurs."""
    left = {n: c for n, c in stock.items() if c}
    out = []
    while left:
        opening = max(left)
        left[opening] -= 1
        pattern = fullest(left, window - opening)
        left[opening] += 1
        pattern[opening] = pattern.get(opening, 0) + 1
        times = min(left[n] // k for n, k in pattern.items())
        for n, k in pattern.items():
            left[n] -= k * times
            if not left[n]:
                del left[n]
        out.append((pattern, times))
    return out


def places(patterns: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, per window, first window, offset) for every use of a length."""
    ranks: dict[int, int] = {}
    rows, first = [], 0
    for pattern, times in patterns:
        offset = 0
        for length, k in sorted(pattern.items(), reverse=True):
            begin = ranks.get(length, 0)
            rows.append((length, begin, begin + k * times, k, first, offset))
            ranks[length] = begin + k * times
            offset += k * length
        first += times
    return rows


def windows_of(docs: DataFrame, path: str, window: int = WINDOW) -> DataFrame:
    """A row per document: its token count, the crc32 of each piece, and its places within its task.

    ``nth`` counts the rests of the same length seen by the task before, ``full_before`` the
    full windows; with the task's number they make ranks that need no sort.
    """

    held = docs.sparkSession.sparkContext.broadcast(alike(path))  # bounded by the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(held.value).encode, TaskContext.get().partitionId()
        seen = [0] * window
        full = 0
        for batch in batches:
            for some in slices(batch):
                counts, checks, nth, before = [], [], [], []
                for ids in encode(some.column("text")):
                    ids += END
                    n = len(ids) // 4
                    counts.append(n)
                    checks.append([zlib.crc32(ids[4 * k : 4 * (k + window)]) for k in range(0, n, window)])
                    nth.append(seen[n % window])
                    before.append(full)
                    seen[n % window] += 1
                    full += n // window
                columns = [pa.array([part] * some.num_rows, pa.int32()), *[pa.array(x, pa.int64()) for x in (counts, nth, before)]]
                yield pa.record_batch(
                    [some.column("doc_id"), *columns, pa.array(checks, pa.list_(pa.int64()))],
                    names=["doc_id", "part", "doc_tokens", "nth", "full_before", "checks"],
                )
        pa.default_memory_pool().release_unused()

    kind = "doc_id long, part int, doc_tokens long, nth long, full_before long, checks array<long>"
    return texts_of(docs).mapInArrow(run, kind)


def pack(docs: DataFrame, path: str, window: int = WINDOW) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) for every piece.

    A document's ids are followed by id 0, so NULL and empty texts have one token. Full
    windows are sequences of their own; rests share windows by plan. Every row of ``docs`` is
    packed, also repeated ones and those with a NULL doc_id. Sequence ids are unique, not
    gapless: full windows are numbered after the shared ones, in a stretch per task.
    """
    rows = settled(windows_of(docs, path, window).withColumn("rest", F.col("doc_tokens") % window))
    per_task = rows.filter("rest > 0").groupBy("part", "rest").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranked = settled(per_task.withColumn("ahead", F.coalesce(F.sum("n").over(earlier), F.lit(0))))
    stock = {r["rest"]: r["n"] for r in ranked.groupBy("rest").agg(F.sum("n").alias("n")).collect()}  # window - 1 rows at most
    patterns = plan(stock, window)
    shared = sum(times for _, times in patterns)
    most = rows.agg(F.max(F.col("full_before") + F.floor(F.col("doc_tokens") / window))).first()[0] or 0

    spark = docs.sparkSession
    use = "rest long, first long, stop long, per long, sequence long, at long"
    uses = spark.createDataFrame(places(patterns), use).groupBy("rest").agg(F.collect_list(F.struct("first", "stop", "per", "sequence", "at")).alias("uses"))
    rank = F.col("nth") + F.col("ahead")
    mine = F.filter("uses", lambda u: (u["first"] <= rank) & (rank < u["stop"]))[0]
    held = F.col("use")
    rests = (
        rows.filter("rest > 0")
        .join(ranked.select("part", "rest", "ahead"), ["part", "rest"])
        .join(F.broadcast(uses), "rest")  # a row per length, fewer than the window holds
        .withColumn("rank", rank)
        .withColumn("use", mine)
        .select(
            "doc_id",
            (F.col("doc_tokens") - F.col("rest")).alias("start"),
            F.col("rest").alias("length"),
            F.element_at("checks", -1).alias("ids_crc32"),
            "doc_tokens",
            (held["sequence"] + F.floor((F.col("rank") - held["first"]) / held["per"])).alias("sequence_id"),
            (held["at"] + (F.col("rank") - held["first"]) % held["per"] * F.col("rest")).alias("offset"),
        )
    )
    whole = F.slice("checks", F.lit(1), F.floor(F.col("doc_tokens") / window).cast("int"))
    full = rows.select("doc_id", "part", "doc_tokens", "full_before", F.posexplode(whole).alias("k", "ids_crc32")).select(
        "doc_id",
        (F.col("k") * window).cast("long").alias("start"),
        F.lit(window).cast("long").alias("length"),
        "ids_crc32",
        "doc_tokens",
        (F.lit(shared) + F.col("part").cast("long") * F.lit(most) + F.col("full_before") + F.col("k")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    return rests.unionByName(full)


def padded(length: int, window: int = WINDOW) -> int:
    """The length a sequence is padded to: a power of two stays, others become a full window."""
    return length if length & (length - 1) == 0 else window
