"""Benchmark passages in training texts, found by spaced seeds (Ma, Tromp and Li 2002).

A seed is a fixed mask over neighbouring words; words under a 0 may differ. Both sides are
hashed under every mask and joined on the hash. A hit names a text, an item and how far one
is shifted against the other; along that shift the stretch with most equal words is measured,
of all stretches that hold enough of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.text import slices, texts_of, words_of
from factloom.plans.frontier import settled

#: Fixed masks, six words each. A passage of 13 words with any two words replaced keeps a hit
#: under at least one of them.
MASKS = ("111111", "11011011", "1101100011", "1110010011", "10101010101", "110000110011")
#: A stretch counts from this many equal words (or this share of a shorter item) ...
MIN_WORDS = 10
MIN_SHARE = 0.6
#: ... of which this share must be equal.
MIN_EQUAL = 0.8
#: Bits of the filter of benchmark hashes, as a power of two: its size does not depend on the
#: benchmark. A hash sets two bits, named by its first bits and by those from SECOND on.
FILTER_BITS, SECOND = 24, 20

NOT_WORD = regex.compile(r"[^\p{L}\p{N}]+")


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash per word and where each text's words start; case and punctuation are dropped."""
    words = words_of(texts, lower="utf8")
    bare = [NOT_WORD.sub("", w) for w in words.distinct]
    kept = np.fromiter(map(bool, bare), dtype=bool, count=len(bare))[words.codes]
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in bare], dtype=np.uint64)
    before = np.concatenate([[0], np.cumsum(kept)])
    return hashes[words.codes[kept]], before[words.starts]


def seeds(hashes: np.ndarray, mask: str) -> np.ndarray:
    """The hash of every window under a mask; empty when there are fewer words than the mask is wide."""
    n = len(hashes) - len(mask) + 1
    out = np.full(max(n, 0), xxhash.xxh64_intdigest(mask), dtype=np.uint64)
    if n > 0:
        for k, used in enumerate(mask):
            if used == "1":
                out = (out ^ hashes[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
                out ^= out >> np.uint64(29)
    return out


def hashed_items(bench: DataFrame) -> DataFrame:
    """(item_id, words, seeds): the word hashes of each item and (hash, place) of all its windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                hashes, starts = word_hashes(part.column("text"))
                words, found = [], []
                for a, b in zip(starts[:-1], starts[1:], strict=True):
                    own = [seeds(hashes[a:b], mask).view(np.int64) for mask in MASKS]
                    words.append(hashes[a:b].view(np.int64))
                    found.append([{"hash": h, "place": k} for s in own for k, h in enumerate(s.tolist())])
                kind = pa.list_(pa.struct([("hash", pa.int64()), ("place", pa.int32())]))
                yield pa.record_batch(
                    [part.column("item_id"), pa.array(words, pa.list_(pa.int64())), pa.array(found, kind)],
                    names=["item_id", "words", "seeds"],
                )

    rows = bench.select(bench["item_id"].cast("long").alias("item_id"), bench["text"].cast("string").alias("text"))
    return rows.filter("item_id IS NOT NULL").mapInArrow(
        run, "item_id long, words array<long>, seeds array<struct<hash: long, place: int>>"
    )


def filter_of(seed_rows: DataFrame) -> np.ndarray:
    """The filter's bits in bytes, set by aggregation; at most 2 ** FILTER_BITS / 64 rows come back."""
    first = F.shiftrightunsigned("hash", 64 - FILTER_BITS)
    second = F.shiftrightunsigned("hash", SECOND).bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    words = (
        seed_rows.select(F.explode(F.array(first, second)).alias("at"))
        .select(F.shiftright("at", 6).alias("word"), F.expr("shiftleft(1L, cast(at & 63 as int))").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .collect()
    )
    bits = np.zeros(1 << (FILTER_BITS - 6), dtype=np.int64)
    for row in words:
        bits[row["word"]] = row["bits"]
    return bits.view(np.uint8)


def passing(hashes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Places of the hashes both of whose bits are set; ``bits`` holds one boolean per bit."""
    at = np.flatnonzero(bits[hashes >> np.uint64(64 - FILTER_BITS)])
    second = (hashes[at] >> np.uint64(SECOND)) & np.uint64((1 << FILTER_BITS) - 1)
    return at[bits[second]]


def candidates(docs: DataFrame, bits: np.ndarray) -> DataFrame:
    """(doc_id, words, hits) for texts with at least one window whose hash passes the filter."""
    held = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(held.value, bitorder="little").astype(bool)
        for batch in batches:
            for part in slices(batch):
                hashes, starts = word_hashes(part.column("text"))
                places, found = [], []
                for mask in MASKS:
                    own = seeds(hashes, mask)
                    at = passing(own, bits)
                    row = np.searchsorted(starts, at, side="right") - 1
                    inside = at + len(mask) <= starts[row + 1]  # a window may not reach into the next text
                    places.append(at[inside])
                    found.append(own[at[inside]])
                place, hash_ = np.concatenate(places), np.concatenate(found)
                row = np.searchsorted(starts, place, side="right") - 1
                order = np.argsort(row, kind="stable")
                row, place, hash_ = row[order], place[order], hash_[order].view(np.int64)
                rows, first, count = np.unique(row, return_index=True, return_counts=True)
                hits = [
                    [{"hash": h, "place": p} for h, p in zip(hash_[f : f + n].tolist(), (place[f : f + n] - starts[r]).tolist(), strict=True)]
                    for r, f, n in zip(rows.tolist(), first.tolist(), count.tolist(), strict=True)
                ]
                words = [hashes[starts[r] : starts[r + 1]].view(np.int64) for r in rows.tolist()]
                yield pa.record_batch(
                    [
                        part.column("doc_id").take(pa.array(rows)),
                        pa.array(words, pa.list_(pa.int64())),
                        pa.array(hits, pa.list_(pa.struct([("hash", pa.int64()), ("place", pa.int32())]))),
                    ],
                    names=["doc_id", "words", "hits"],
                )

    rows = texts_of(docs)
    return rows.filter("doc_id IS NOT NULL AND text IS NOT NULL").mapInArrow(
        run, "doc_id long, words array<long>, hits array<struct<hash: long, place: int>>"
    )


def stretch(same: np.ndarray) -> tuple[int, int, int] | None:
    """(begin, n_words, n_equal) of the stretch with most equal words of those with a share of MIN_EQUAL.

    It begins and ends with an equal word; of several with as many equal words the shortest,
    then the first. For the k-th equal word at place p the value k - MIN_EQUAL * p may fall by
    no more than 1 - MIN_EQUAL over a stretch, so per end the first begin is found in the
    running minimum of the values; in hundredths, to compare whole numbers.
    """
    places = np.flatnonzero(same)
    if not len(places):
        return None
    share = round(100 * MIN_EQUAL)
    values = 100 * np.arange(len(places)) - share * places
    begins = np.searchsorted(-np.minimum.accumulate(values), -(values + 100 - share))
    equal = np.arange(len(places)) - begins + 1
    words = places - places[begins] + 1
    end = np.lexsort((words, -equal))[0]
    return int(places[begins[end]]), int(words[end]), int(equal[end])


def stretches(shifts: DataFrame) -> DataFrame:
    """``shifts`` with ``same``, an array of booleans, replaced by s, the (begin, n, equal) of its stretch."""
    rest = [f for f in shifts.schema.fields if f.name != "same"]
    kind = pa.struct([("begin", pa.int32()), ("n", pa.int32()), ("equal", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("same")
            ends = lists.offsets.to_numpy()
            flat = lists.values.to_numpy(zero_copy_only=False)
            found = [stretch(flat[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            held = [s and dict(zip(("begin", "n", "equal"), s, strict=True)) for s in found]
            yield pa.record_batch([*[batch.column(f.name) for f in rest], pa.array(held, kind)], names=[*[f.name for f in rest], "s"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rest)
    return shifts.mapInArrow(run, f"{schema}, s struct<begin: int, n: int, equal: int>")


def contaminated(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """(doc_id, item_id, doc_word, item_word, n_words, n_equal, item_words), one row per text and item.

    The stretch reported has at least MIN_WORDS equal words, or MIN_SHARE of an item that has
    fewer words, and at least MIN_EQUAL of its words are equal; of several the one with most
    equal words, then the earliest. Items of fewer words than the shortest mask prove nothing
    and are never found. Rows with a NULL id or NULL text are not reported; rows that repeat an
    id count as one document. Other columns are not read.
    """
    items = settled(hashed_items(bench))
    item_seeds = items.select("item_id", F.explode("seeds").alias("s")).select("item_id", "s.hash", F.col("s.place").alias("item_place"))
    near = settled(candidates(docs, filter_of(item_seeds)))
    hits = near.select("doc_id", F.explode("hits").alias("h")).select("doc_id", "h.hash", "h.place")
    shifts = (
        hits.join(item_seeds, "hash")
        .select("doc_id", "item_id", (F.col("place") - F.col("item_place")).alias("shift"))
        .distinct()
    )
    own = items.select("item_id", F.col("words").alias("item"))
    pairs = shifts.join(own, "item_id").join(near.select("doc_id", "words"), "doc_id")
    lead = F.greatest(-F.col("shift"), F.lit(0))  # words of the item that lie before the text
    begin = F.greatest(F.col("shift"), F.lit(0))
    size = F.least(F.size("item") - lead, F.size("words") - begin)
    enough = F.least(F.lit(float(MIN_WORDS)), F.col("item_words") * MIN_SHARE)
    aligned = pairs.select(
        "doc_id",
        "item_id",
        F.size("item").alias("item_words"),
        begin.alias("doc_at"),
        lead.alias("item_at"),
        F.zip_with(F.slice("words", begin + 1, size), F.slice("item", lead + 1, size), lambda a, b: a == b).alias("same"),
    ).filter(F.size(F.filter("same", lambda s: s)) >= enough)
    measured = stretches(aligned).select(
        "doc_id",
        "item_id",
        (F.col("doc_at") + F.col("s.begin")).alias("doc_word"),
        (F.col("item_at") + F.col("s.begin")).alias("item_word"),
        F.col("s.n").alias("n_words"),
        F.col("s.equal").alias("n_equal"),
        "item_words",
    )
    found = measured.filter(F.col("n_equal") >= enough)
    best = F.max_by(F.struct("doc_word", "item_word", "n_words", "n_equal", "item_words"), F.struct("n_equal", -F.col("doc_word"), -F.col("item_word")))
    return found.groupBy("doc_id", "item_id").agg(best.alias("b")).select("doc_id", "item_id", "b.*")
