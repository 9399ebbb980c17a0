"""Importance resampling towards a target corpus (Xie et al. 2023), with counts per distinct line.

Newlines separate words, so a text's word runs lie within its lines or cross from one to the
next. Lines repeat much over a corpus: the features of each distinct line are counted once and
multiplied by how often the line occurs; runs that cross lines are added from the texts.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.llm.text import Words, bounded_batches, slices, words_of
from factloom.plans.frontier import settled

BUCKETS = 10_000
#: Runs of 1 to LONGEST words are features.
LONGEST = 1
#: Texts with fewer words are not drawn; of the others this share is, in percent.
MIN_WORDS, PERCENT = 20, 10
SEED = 2024

#: Per byte: A to Z in lower case, a to z and 0 to 9 and all of other scripts as they are, the rest a blank.
_PLAIN = np.array([b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)], np.uint8)
_PLAIN[65:91] += 32


def plain(texts: pa.StringArray) -> pa.StringArray:
    """The same texts, ASCII lower-cased and every other ASCII character a blank; NULL counts as empty."""
    texts = pc.fill_null(texts, "")
    _, offsets, data = texts.buffers()
    if data is None:
        return texts
    return pa.StringArray.from_buffers(len(texts), offsets, pa.py_buffer(_PLAIN[np.frombuffer(data, np.uint8)].tobytes()), offset=texts.offset)


def runs_of(words: Words, longest: int, buckets: int, lines: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of every run of 1 to ``longest`` words.

    With ``lines``, a line number per word, only the runs that reach over more than one line.
    """
    text = words.rows()
    names = [w.encode() for w in words.distinct]
    ids, found = words.codes.astype(np.int64), []
    for size in range(1, longest + 1):
        if size > 1:  # a run is the one shorter by a word, and the word after it
            pairs = ids[: len(text) - size + 1] * len(words.distinct) + words.codes[size - 1 :]
            distinct, ids = np.unique(pairs, return_inverse=True)
            names = [names[p // len(words.distinct)] + b" " + words.distinct[p % len(words.distinct)].encode() for p in distinct.tolist()]
        places = np.array([zlib.crc32(n) % buckets for n in names], np.int64)
        here = text[: len(ids)] == text[len(text) - len(ids) :]
        if lines is not None:
            here &= lines[: len(ids)] != lines[len(text) - len(ids) :]
        found.append((text[: len(ids)][here], places[ids[here]]))
        if len(ids) <= 1:
            break
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _lines(texts: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray]:
    """Lines per text, and all lines as codes of distinct ones."""
    lists = pc.split_pattern(pc.fill_null(texts, ""), "\n")
    return np.diff(lists.offsets.to_numpy()), lists.flatten().dictionary_encode()


def _crossing(texts: pa.Array, longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of the runs of 2 to ``longest`` words that reach over a newline."""
    words = words_of(plain(texts), "no")
    per_text, lines = _lines(texts)
    each = words_of(plain(lines.dictionary), "no")
    counts = np.diff(each.starts)[lines.indices.to_numpy()]
    return runs_of(words, longest, buckets, np.repeat(np.arange(len(counts)), counts))


def bucket_counts(texts: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): the features of all texts of a table (text), counted by bucket; a row per bucket that occurs.

    Each distinct line is taken apart once, in the task that holds it, and counts as often as
    it occurs. Of every task at most a row per bucket is shuffled.
    """
    bounded_batches(texts.sparkSession)

    def summed(batches: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for places, times in batches:
            np.add.at(total, places, times)
        used = np.flatnonzero(total)
        yield pa.record_batch([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each():
            for batch in batches:
                for some in slices(batch, "line"):
                    line, places = runs_of(words_of(plain(some.column("line")), "no"), longest, buckets)
                    yield places, some.column("times").to_numpy()[line]

        yield from summed(each())

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from summed((_crossing(some.column("text"), longest, buckets)[1], 1) for batch in batches for some in slices(batch))

    kind = "bucket long, n long"
    lines = texts.select(F.explode(F.split(texts["text"], "\n")).alias("line")).groupBy("line").agg(F.count("*").alias("times"))
    found = lines.mapInArrow(within, kind)
    if longest > 1:
        found = found.unionByName(texts.select(texts["text"]).mapInArrow(across, kind))
    return found.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Per bucket, floor(1000 ln) of how much more frequent it is in the target, each count raised by one.

    ``corpus`` and ``target`` are bucket counts, so what comes to the driver is bounded by ``buckets``.
    """
    counts = []
    for table in (corpus, target):
        n = [0] * buckets
        for row in table.collect():
            n[row["bucket"]] = row["n"]
        counts.append(n)
    source, wanted = (sum(n) + buckets for n in counts)
    return np.array([math.floor(1000 * math.log((t + 1) * source / ((s + 1) * wanted))) for s, t in zip(*counts, strict=True)], np.int64)


def weights(docs: DataFrame, gain: np.ndarray, longest: int = LONGEST) -> DataFrame:
    """(doc_id, n_words, n_features, weight) per row: the floored mean gain of a text's features, 0 without any.

    Lines that repeat among the texts taken up at once are added up once.
    """
    bounded_batches(docs.sparkSession)
    buckets = len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch):
                texts = some.column("text")
                per_text, lines = _lines(texts)
                words = words_of(plain(lines.dictionary), "no")
                n_lines = len(lines.dictionary)
                line, places = runs_of(words, longest, buckets)
                sums = np.zeros(n_lines, np.int64)
                np.add.at(sums, line, gain[places])
                code, text = lines.indices.to_numpy(), np.repeat(np.arange(len(texts)), per_text)
                total = np.zeros((3, len(texts)), np.int64)
                for k, each in enumerate((np.diff(words.starts), np.bincount(line, minlength=n_lines), sums)):
                    np.add.at(total[k], text, each[code])
                if longest > 1:
                    over, places = _crossing(texts, longest, buckets)
                    np.add.at(total[1], over, 1)
                    np.add.at(total[2], over, gain[places])
                total[2] = np.floor_divide(total[2], np.maximum(total[1], 1))
                yield pa.record_batch([some.column("doc_id"), *map(pa.array, total)], names=["doc_id", "n_words", "n_features", "weight"])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def chance(doc_id: Column, seed: int = SEED) -> Column:
    """floor(-1000 ln(-ln u)) with u from a hash of seed and id, so that the highest sums are a weighted sample."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(F.log(-F.log(u)) * -1000.0)


def resample(docs: DataFrame, target: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) per row of ``docs``; rank is NULL for rows not drawn.

    Features are runs of 1 to ``longest`` words (ASCII letters and digits, lower-cased, and all
    other scripts), counted in ``buckets`` by crc32 over all texts of ``docs`` and of ``target``
    (text). Of the rows with at least ``min_words`` words, ``percent`` per cent are drawn by
    highest score, ties to the smaller doc_id, NULLs last, then in any order. NULL texts count
    as empty; repeated rows each have their draw, rows without id that of an empty id. With an
    empty target, its features are taken to be as frequent as each other. Other columns are
    not read.
    """
    gain = gains(bucket_counts(docs, longest, buckets), bucket_counts(target, longest, buckets), buckets)
    scored = settled(weights(docs, gain, longest).withColumn("score", F.col("weight") + chance(F.col("doc_id"), seed)))
    able = F.col("n_words") >= min_words
    drawn = scored.filter(able).count() * percent // 100
    in_order = scored.filter(able).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    placed = settled(in_order.withColumn("place", F.monotonically_increasing_id()))
    part = F.shiftright("place", 33)
    parts = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))  # a row per partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = settled(parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead")))
    rank = F.col("ahead") + F.col("place") % (1 << 33) + 1
    ranked = placed.join(F.broadcast(ahead), part == F.col("part")).withColumn("rank", F.when(rank <= drawn, rank))
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    return ranked.select(*columns, "rank").unionByName(scored.filter(~able).select(*columns, F.lit(None).cast("long").alias("rank")))
