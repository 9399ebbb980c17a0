"""Exact copies by an exchange of Golomb-coded fingerprints (Sanders, Schlag and Mueller 2013).

Every block of rows sends its sorted distinct fingerprints to the owners of their ranges, as
Golomb-coded gaps. An owner answers each message by a bitmap of the fingerprints that other
blocks sent too. Only the rows behind those, and those that repeat within their block, are
suspects. Their texts alone are shuffled and compared byte by byte; all others have no copy.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.plans.frontier import settled, written

#: Runs of blanks that are not one plain space already.
BLANKS = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"
#: Rows of a block, and fingerprints of an owner in the mean.
BLOCK, OWNED = 1 << 20, 1 << 22
#: Small tables are still dealt to as many owners as the session has shuffle partitions.
LEAST_OWNED = 1 << 13
#: A fingerprint has this many bits more than are needed to number the rows: of the rows
#: without copy, one in 2^SPARE is a suspect by chance.
SPARE = 10
#: Words of 64 flags that are broadcast at once; with more, the texts are read in rounds.
FLAGGED_WORDS = 1 << 20


def normalised(text: Column) -> Column:
    """Every run of blanks (0x20, 0x09 to 0x0D) as one space; NULL as empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), BLANKS, " ")


def coded(values: np.ndarray, span: int) -> bytes:
    """Golomb code of sorted distinct numbers below ``span``, with a power of two as divisor.

    One byte for the power, eight for the length of the unary part, then the quotients of all
    gaps in unary and the remainders in binary.
    """
    gaps = np.diff(values.astype(np.int64), prepend=-1) - 1
    power = max(0, int(0.69 * span / max(1, len(gaps))).bit_length() - 1)
    ends = np.cumsum((gaps >> power) + 1)
    unary = np.zeros(ends[-1] if len(ends) else 0, np.uint8)
    unary[ends - 1] = 1
    quotients = np.packbits(unary).tobytes()
    remainders = np.empty((len(gaps), power), np.uint8)
    for bit in range(power):
        remainders[:, bit] = (gaps >> (power - 1 - bit)) & 1
    return bytes([power]) + len(quotients).to_bytes(8, "little") + quotients + np.packbits(remainders.ravel()).tobytes()


def decoded(code: bytes, count: int) -> np.ndarray:
    """The ``count`` numbers that ``coded`` was given."""
    power, size = code[0], int.from_bytes(code[1:9], "little")
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(code, np.uint8, size, 9)))[:count]
    gaps = np.diff(ends, prepend=-1) - 1
    bits = np.unpackbits(np.frombuffer(code, np.uint8, offset=9 + size), count=count * power).reshape(count, power)
    for bit in range(power):
        gaps = (gaps << 1) | bits[:, bit]
    return np.cumsum(gaps + 1) - 1


def messages(rows: DataFrame, bits: int, owner_bits: int) -> DataFrame:
    """(sender, owner, n, code, places, ranks): what each block of ``rows`` (place, hash) sends to each owner.

    A fingerprint is the first ``bits`` of a hash, its owner the first ``owner_bits``. The code
    goes to the owner; ``places`` are the block's rows with a fingerprint of that owner, and
    ``ranks`` tell which fingerprint of the message is theirs.
    """
    span = 1 << (bits - owner_bits)

    def packed(places: np.ndarray, hashes: np.ndarray) -> pa.RecordBatch:
        prints, which = np.unique(hashes.view(np.uint64) >> np.uint64(64 - bits), return_inverse=True)
        prints = prints.astype(np.int64)
        order = np.argsort(which, kind="stable")
        owners = prints // span
        found, firsts = np.unique(owners, return_index=True)
        stops = [*firsts[1:].tolist(), len(prints)]
        cuts = np.searchsorted(which[order], [*firsts, len(prints)])
        codes = [coded(prints[a:b] - o * span, span) for o, a, b in zip(found.tolist(), firsts.tolist(), stops, strict=True)]
        ranks = which[order] - np.repeat(firsts, np.diff(cuts))
        bounds = pa.array(cuts, pa.int32())
        return pa.record_batch(
            [
                pa.array(np.full(len(found), places.min())),
                pa.array(found),
                pa.array(np.array(stops) - firsts, pa.int64()),
                pa.array(codes, pa.binary()),
                pa.ListArray.from_arrays(bounds, pa.array(places[order])),
                pa.ListArray.from_arrays(bounds, pa.array(ranks.astype(np.int32))),
            ],
            names=["sender", "owner", "n", "code", "places", "ranks"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            held.append([batch.column(c).to_numpy() for c in ("place", "hash")])
            count += batch.num_rows
            if count >= BLOCK:
                yield packed(*map(np.concatenate, zip(*held, strict=True)))
                held, count = [], 0
        if count:
            yield packed(*map(np.concatenate, zip(*held, strict=True)))

    kind = "sender long, owner long, n long, code binary, places array<long>, ranks array<int>"
    return rows.select("place", "hash").mapInArrow(run, kind)


def answer(table: pa.Table) -> pa.Table:
    """An owner's answer to its messages: bit k of a bitmap is set if fingerprint k came from another sender too."""
    lists = [decoded(c, n) for c, n in zip(table["code"].to_pylist(), table["n"].to_pylist(), strict=True)]
    values = np.concatenate(lists)
    order = np.argsort(values, kind="stable")
    same = np.diff(values[order]) == 0
    repeated = np.zeros(len(values), bool)
    repeated[order[1:][same]] = repeated[order[:-1][same]] = True
    parts = np.split(repeated, np.cumsum([len(part) for part in lists])[:-1])
    bitmaps = pa.array([np.packbits(p).tobytes() for p in parts], pa.binary())
    return pa.table([table["sender"], table["owner"], bitmaps], names=["sender", "owner", "bitmap"])


def suspects(sent: DataFrame) -> DataFrame:
    """(place) of every row whose fingerprint is not alone, in its block or among all."""
    replies = sent.select("sender", "owner", "n", "code").groupBy("owner").applyInArrow(answer, "sender long, owner long, bitmap binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                bitmap, places, ranks = (batch.column(c)[row] for c in ("bitmap", "places", "ranks"))
                ranks = ranks.values.to_numpy()
                flags = np.unpackbits(np.frombuffer(bitmap.as_py(), np.uint8), count=int(ranks.max()) + 1)
                flags |= np.bincount(ranks) > 1
                yield pa.record_batch([pa.array(places.values.to_numpy()[flags[ranks] > 0])], names=["place"])

    joined = sent.select("sender", "owner", "places", "ranks").join(replies, ["sender", "owner"])
    return joined.select("bitmap", "places", "ranks").mapInArrow(run, "place long")


def _verified(rows: DataFrame, flags: DataFrame) -> DataFrame:
    """(sha, text, first, n) of the texts of flagged rows, compared byte by byte.

    ``flags`` (word, bits) holds 64 places a row. It is broadcast in shares of about
    FLAGGED_WORDS, so texts of other rows are never shuffled, whatever the number of rows.
    """
    rounds = -(-flags.count() // FLAGGED_WORDS) or 1
    cuts = flags.approxQuantile("word", [k / rounds for k in range(1, rounds)], 0.2 / rounds) if rounds > 1 else []
    first = F.min(F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "place")).alias("first")
    found = []
    for low, high in zip([None, *cuts], [*cuts, None], strict=True):
        share, some = flags, rows
        if low is not None:
            share, some = share.filter(F.col("word") >= int(low)), some.filter(F.col("place") >= int(low) * 64)
        if high is not None:
            share, some = share.filter(F.col("word") < int(high)), some.filter(F.col("place") < int(high) * 64)
        held = some.join(F.broadcast(share), F.shiftright("place", 6) == F.col("word")).filter(F.getbit("bits", F.col("place") % 64) == 1)
        found.append(written(held.groupBy("sha", "text").agg(first, F.count("*").alias("n"))))
    if rounds == 1:
        return found[0]
    every = reduce(DataFrame.unionByName, found)
    return every.groupBy("sha", "text").agg(F.min("first").alias("first"), F.sum("n").alias("n"))


def exact_copies(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per row of ``docs``.

    Texts are equal when they are the same bytes after every run of blanks has become one
    space; NULL counts as empty. Of equal texts one row is kept: the least doc_id, NULLs last,
    then the first row written; so of rows that repeat an id and a text one is kept. keep_id is
    the doc_id of that row, NULL if no row of the group has one. Other columns are not read.
    """
    text = docs.select(docs["doc_id"].cast("long").alias("doc_id"), normalised(docs["text"]).alias("text"))
    rows = written(
        text.select("doc_id", "text", F.unhex(F.sha2("text", 256)).alias("sha"), F.xxhash64("text").alias("hash"), F.monotonically_increasing_id().alias("place"))
    )
    count = rows.count()
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    owners = max(-(-count // OWNED), min(count // LEAST_OWNED, partitions), 1)
    owner_bits = (owners - 1).bit_length()
    bits = max(owner_bits, min(62, count.bit_length() + SPARE))
    # A task reads two narrow columns only, so it takes the files of many.
    sent = settled(messages(rows.select("place", "hash").coalesce(max(partitions, count // BLOCK)), bits, owner_bits))
    flags = written(
        suspects(sent)
        .groupBy(F.shiftright("place", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(place % 64 AS int))")).alias("bits"))
    )
    # Two texts with one SHA-256 are not known to exist; if they did, this would stop rather than merge them.
    alone = F.when(F.count("*") > 1, F.raise_error(F.lit("two texts with one SHA-256"))).otherwise(F.max("n"))
    groups = _verified(rows, flags).filter("n > 1").groupBy("sha").agg(F.min("first").alias("first"), alone.alias("n"))
    return rows.select("doc_id", "sha", "place").join(groups, "sha", "left").select(
        "doc_id",
        F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("place") == F.col("first.place"), F.lit(True)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
