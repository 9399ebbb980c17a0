"""Periodic runs of words, found by convolution of blocks.

A run of period q and length 4 q or more, with L <= q < 2 L for a power of two L, holds some
block that starts at a multiple of L and is L words long, and that block again q words later.
So at every such scale each block is laid over the 2 L words behind it: the sums of squared
differences of all shifts come from one convolution, by a number-theoretic transform modulo a
prime. A shift whose sum is zero seeds an extension word by word, which also rules out sums
that are zero modulo the prime only. Texts are taken up together, with a word of its own
between two of them.

Blocks that cannot seed a run are left out beforehand: those with a run of up to four words
that does not come again within 2 L words, and those that lie, with the words behind them, in
a run known from a smaller scale, as every further match there is at a multiple of its period.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.text import slices, texts_of, words_of

#: A run has at least this many words, and this many times its period.
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: 15 * 2^27 + 1, so transforms of up to 2^27 words have roots; 31 generates its residues.
PRIME, ROOT = 15 * (1 << 27) + 1, 31
#: Words of windows that are transformed at once.
AT_ONCE = 1 << 19
#: Words that must come again together for a block to be looked at.
TOGETHER = 4
#: Bytes of text taken up together.
TAKEN = 1 << 20


@cache
def _roots(size: int, inverse: bool) -> np.ndarray:
    """The powers 0 to size / 2 - 1 of a root of unity of order ``size``."""
    root = pow(ROOT, (PRIME - 1) // size, PRIME)
    if inverse:
        root = pow(root, PRIME - 2, PRIME)
    powers = np.ones(1, np.uint64)
    while len(powers) < size // 2:
        powers = np.concatenate([powers, powers * np.uint64(pow(root, len(powers), PRIME)) % np.uint64(PRIME)])
    return powers


def transformed(rows: np.ndarray) -> np.ndarray:
    """Number-theoretic transform of every row, its entries in bit-reversed order."""
    count, size = rows.shape
    prime = np.uint64(PRIME)
    half = size // 2
    while half:
        pairs = rows.reshape(count, -1, 2, half)
        a, b = pairs[:, :, 0], pairs[:, :, 1]
        rows = np.stack([(a + b) % prime, (a + prime - b) * _roots(2 * half, False) % prime], axis=2)
        half //= 2
    return rows.reshape(count, size)


def restored(rows: np.ndarray) -> np.ndarray:
    """The rows that ``transformed`` was given."""
    count, size = rows.shape
    prime = np.uint64(PRIME)
    half = 1
    while half < size:
        pairs = rows.reshape(count, -1, 2, half)
        a, b = pairs[:, :, 0], pairs[:, :, 1] * _roots(2 * half, True) % prime
        rows = np.stack([(a + b) % prime, (a + prime - b) % prime], axis=2)
        half *= 2
    return rows.reshape(count, size) * np.uint64(pow(size, PRIME - 2, PRIME)) % prime


def matches(codes: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, distance) of blocks of ``size`` words from ``starts`` whose words come again size to 2 size - 1 words later.

    The squared differences of a block and a window are summed as squares of both less twice
    their product, and the products of all shifts are one cyclic convolution of 2 size numbers:
    of its entries only those that no shift of interest uses are wrapped around.
    """
    prime = np.uint64(PRIME)
    padded = np.concatenate([codes, codes.max(initial=0) + 1 + np.arange(3 * size)]).astype(np.uint64) % prime
    squares = np.concatenate([[0], np.cumsum((padded * padded % prime).astype(np.int64))])
    found = []
    for k in range(0, len(starts), max(1, AT_ONCE // (2 * size))):
        some = starts[k : k + max(1, AT_ONCE // (2 * size))]
        windows = padded[(some + size)[:, None] + np.arange(2 * size)]
        blocks = np.zeros_like(windows)
        blocks[:, :size] = padded[some[:, None] + np.arange(size)][:, ::-1]
        products = restored(transformed(blocks) * transformed(windows) % prime)[:, size - 1 : 2 * size - 1].astype(np.int64)
        at = (some + size)[:, None] + np.arange(size)
        sums = squares[at + size] - squares[at] + (squares[some + size] - squares[some])[:, None]
        row, shift = np.nonzero((sums - 2 * products) % PRIME == 0)
        found.append((some[row], shift + size))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 2


def _agreeing(left: np.ndarray, right: np.ndarray) -> int:
    """How many words agree from the start."""
    size, step, done = min(len(left), len(right)), 32, 0
    while done < size:
        differ = np.flatnonzero(left[done : done + step] != right[done : done + step])
        if len(differ):
            return done + min(int(differ[0]), size - done)
        done, step = done + step, step * 2
    return size


def _extended(codes: np.ndarray, start: int, distance: int) -> tuple[int, int]:
    """The longest stretch around ``start`` in which words ``distance`` apart agree."""
    ahead = _agreeing(codes[start:-distance], codes[start + distance :])
    behind = _agreeing(codes[start - 1 :: -1] if start else codes[:0], codes[start + distance - 1 : distance - 1 : -1] if start else codes[:0])
    return start - behind, start + ahead + distance


def _primes(n: int) -> Iterator[int]:
    k = 2
    while k * k <= n:
        if n % k == 0:
            yield k
            while n % k == 0:
                n //= k
        k += 1
    if n > 1:
        yield n


def _least(codes: np.ndarray, start: int, stop: int, period: int) -> bool:
    """True if no shorter period holds; of a stretch of two periods a shorter one divides it."""
    part = codes[start:stop]
    return not any(np.array_equal(part[: -(period // k)], part[period // k :]) for k in _primes(period))


def _again(codes: np.ndarray) -> np.ndarray:
    """Per place, how far on the same number stands next."""
    order = np.argsort(codes, kind="stable")
    far = np.full(len(codes), len(codes), np.int64)
    same = codes[order[:-1]] == codes[order[1:]]
    far[order[:-1][same]] = np.diff(order)[same]
    return far


def _together(codes: np.ndarray, size: int) -> np.ndarray:
    """Per place, a number for the ``size`` words from there on, equal for equal words."""
    mixed = np.zeros(len(codes) - size + 1, np.uint64)
    for k in range(size):
        mixed = (mixed ^ codes[k : len(codes) - size + 1 + k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return mixed


def runs(codes: np.ndarray, longest: int | None = None) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs in a row of word codes, by start and period.

    A run is as long as its least period holds, LEAST_PERIODS periods and LEAST_WORDS words
    or more. ``longest`` bounds the length a run can have.
    """
    found: list[tuple[int, int, int]] = []
    codes = codes.astype(np.int64)
    longest = min(longest or len(codes), len(codes))
    size, far = 1, None
    while LEAST_PERIODS * size <= longest:
        taken = min(size, TOGETHER)
        if far is None or size <= TOGETHER:
            far = _again(_together(codes, taken))
        # A block is looked at if each of its parts of ``taken`` words comes again before 2 size words.
        starts = np.arange(0, len(codes) - 2 * size + 1, size)
        near = far < 2 * size
        inside = np.concatenate([[0], np.cumsum(near)])
        starts = starts[inside[starts + size - taken + 1] - inside[starts] == size - taken + 1]
        if found and len(starts):  # all of periods below this size
            known_runs = np.array(sorted((start, start + length) for start, length, _ in found))
            ends = np.concatenate([[0], np.maximum.accumulate(known_runs[:, 1])])
            starts = starts[ends[np.searchsorted(known_runs[:, 0], starts, "right")] < starts + 3 * size]
        begin, apart = matches(codes, starts, size)
        order = np.lexsort((begin, apart))
        known = (0, 0)  # distance, and the end of its last stretch
        for start, distance in zip(begin[order].tolist(), apart[order].tolist(), strict=True):
            if known[0] == distance and start + distance + size <= known[1]:
                continue
            if not np.array_equal(codes[start : start + size], codes[start + distance : start + distance + size]):
                continue
            low, high = _extended(codes, start, distance)
            known = (distance, high)
            if high - low >= max(LEAST_WORDS, LEAST_PERIODS * distance) and _least(codes, low, high, distance):
                found.append((low, high - low, distance))
        size *= 2
    return sorted(found, key=lambda r: (r[0], r[2]))


def periodic_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, runs, collapsed), one row per row of ``docs``.

    ``runs`` are (start, length, period) in words, numbered from 0, by start and period;
    ``collapsed`` is the text with one period of each run, its words joined by one space: a
    word goes if any run holds it after its first period. Words stand between blanks (0x20,
    0x09 to 0x0D) and are compared as they are. NULL and blank texts have no words and no
    runs; a NULL doc_id stays NULL; repeated rows stay. Other columns are not read.
    """

    def taken(some: pa.RecordBatch) -> pa.RecordBatch:
        words = words_of(some.column("text"), "no")
        counts = np.diff(words.starts)
        # One code that no word has after each text, so that no run reaches over it.
        text = words.rows()
        codes = np.empty(len(words.codes) + len(counts), np.int64)
        codes[np.arange(len(text)) + text] = words.codes
        ends = words.starts[1:] + np.arange(len(counts))
        codes[ends] = len(words.values) + np.arange(len(counts))
        kept = np.ones(len(words.codes), bool)
        per_text: dict[int, list[dict[str, int]]] = {}
        for start, length, period in runs(codes, int(counts.max(initial=0))):
            row = int(np.searchsorted(ends, start))
            first = start - row
            kept[first + period : first + length] = False
            per_text.setdefault(row, []).append({"start": first - int(words.starts[row]), "length": length, "period": period})
        left = np.concatenate([[0], np.cumsum(kept)])[words.starts]
        values = words.values.take(pa.array(words.codes[kept]))
        collapsed = pc.binary_join(pa.ListArray.from_arrays(pa.array(left, pa.int32()), values), " ")
        kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
        listed = pa.array([per_text.get(k, []) for k in range(len(counts))], kind)
        return pa.record_batch([some.column("doc_id"), pa.array(counts), listed, collapsed], names=["doc_id", "n_words", "runs", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, limit=TAKEN):
                yield taken(some)

    kind = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return texts_of(docs).mapInArrow(run, kind)


def echoed(docs: DataFrame) -> DataFrame:
    """``docs`` as (doc_id, text) in which a tenth of the texts, by crc32 of the id, end in repeated words.

    With h the crc32 of the id as text and g = floor(h / 10): where h % 10 is 0 and there are n
    words, word a + k becomes word a + k % p, for a = g % n and p = 1 + floor((n - a) / (3 + g % 8)).
    Such a text's words are joined by one space; other texts, and those without id, stay as they are.
    """
    h = F.crc32(docs["doc_id"].cast("long").cast("string"))
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"), h.alias("h"))
    rows = rows.withColumn("words", F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))))
    built = rows.withColumn("n", F.size("words")).withColumn("g", F.floor(F.col("h") / 10))
    built = built.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    built = built.withColumn("p", (F.lit(1) + F.floor((F.col("n") - F.col("a")) / (F.lit(3) + F.col("g") % 8))).cast("int"))
    again = F.array_join(F.transform("words", lambda w, i: F.when(i < F.col("a"), w).otherwise(F.get("words", F.col("a") + (i - F.col("a")) % F.col("p")))), " ")
    return built.select("doc_id", F.when(F.col("n") > 0, again).otherwise(F.col("text")).alias("text"))
