"""Near-duplicate texts by 64-bit similarity fingerprints (Charikar 2002), found on a grid.

The fingerprint is embedded as 32 counts, the set bits of its 32 two-bit segments. The
Manhattan distance of two such vectors never exceeds the number of differing bits. The grid
has unit cells over the vector's dimensions, cut into 6 blocks: two vectors within distance
3 differ in at most 3 blocks, so they share the cell of at least one choice of 3 blocks.
Counts are written in unary (0: 00, 1: 01, 2: 11), which makes a cell one mask and the
Manhattan distance one bit count.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.llm.components import components
from factloom.llm.text import slices, texts_of, words_of
from factloom.plans.frontier import settled, written

SEED = 42
WORDS = 3
DISTANCE = 3
BLOCKS = 6
#: Shingles whose bits are counted at once.
AT_ONCE = 1 << 16
LOW_BITS = 0x5555555555555555

#: Bits of the 6 blocks: 6, 6, 5, 5, 5 and 5 dimensions of two bits each.
BLOCK_BITS = [((1 << w) - 1) << sum((12, 12, 10, 10, 10, 10)[:k]) for k, w in enumerate((12, 12, 10, 10, 10, 10))]
CHOICES = list(combinations(range(BLOCKS), BLOCKS - DISTANCE))


def fingerprint_of(words: list[bytes]) -> int:
    """Bits that are set in over half of the shingles' hashes, as an unsigned number."""
    if not words:
        return 0
    ends = np.cumsum([len(w) + 1 for w in words])
    line = b" ".join(words)
    width = min(WORDS, len(words))
    begins = [0, *ends[: len(words) - width].tolist()]
    stops = (ends[width - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, dtype=np.int64)
    for k in range(0, len(begins), AT_ONCE):
        spans = zip(begins[k : k + AT_ONCE], stops[k : k + AT_ONCE], strict=True)
        hashes = np.array([digest(line[a:b], SEED) for a, b in spans], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(begins), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, *more: str) -> DataFrame:
    """(doc_id, fp) per row: the fingerprint of the whole text as a signed long; NULL text as empty.

    ``more`` names columns of longs that are carried along, between the two.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                words = words_of(part.column("text"))
                held = np.array([w.encode() for w in words.distinct], dtype=object)
                found = [
                    fingerprint_of(held[words.codes[a:b]].tolist())
                    for a, b in zip(words.starts[:-1].tolist(), words.starts[1:].tolist(), strict=True)
                ]
                fps = np.array(found, dtype=np.uint64).view(np.int64)
                kept = ["doc_id", *more]
                yield pa.record_batch([*[part.column(c) for c in kept], pa.array(fps)], names=[*kept, "fp"])

    return texts_of(docs, *more).mapInArrow(run, ", ".join(f"{c} long" for c in ("doc_id", *more, "fp")))


def signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def unary(fp: Column) -> Column:
    """The counts of the two-bit segments, each in two bits in unary."""
    above = F.shiftrightunsigned(fp, 1)
    some = fp.bitwiseOR(above).bitwiseAND(F.lit(LOW_BITS))
    all_ = fp.bitwiseAND(above).bitwiseAND(F.lit(LOW_BITS))
    return some.bitwiseOR(F.shiftleft(all_, 1))


def differing(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _cells(distinct: DataFrame) -> DataFrame:
    """A row per fingerprint and choice of blocks: (choice, cell, fp, copies)."""
    masks = [signed(sum(BLOCK_BITS[b] for b in choice)) for choice in CHOICES]
    where = F.array(
        *[
            F.struct(F.lit(k).alias("choice"), F.col("counts").bitwiseAND(F.lit(m).cast("long")).alias("cell"))
            for k, m in enumerate(masks)
        ]
    )
    return (
        distinct.withColumn("counts", unary(F.col("fp")))
        .select("fp", "copies", F.explode(where).alias("at"))
        .select("at.choice", "at.cell", "fp", "copies")
    )


def _first_choice(same: Column) -> Column:
    """The place in CHOICES of the first three blocks in which ``same`` (an XOR) has no bit."""
    out = F.lit(-1)
    for k in reversed(range(len(CHOICES))):
        mask = signed(sum(BLOCK_BITS[b] for b in CHOICES[k]))
        out = F.when(same.bitwiseAND(F.lit(mask).cast("long")) == 0, F.lit(k)).otherwise(out)
    return out


def links(distinct: DataFrame) -> DataFrame:
    """Links (a, b) between fingerprints with the same components as all pairs within 3 bits.

    Two rounds, so that a dense group of near copies does not give all its pairs. First every
    fingerprint of a cell is compared with the cell's most copied, least and greatest one.
    Then those fingerprints of a cell which are not yet in one component are compared with
    each other; a pair that shares several cells is looked at in the first.
    """
    cells = settled(_shared(_cells(distinct)))
    near = differing(F.col("fp"), F.col("other")) <= DISTANCE
    stars = (
        cells.select("fp", F.explode(F.array("most", "least", "greatest")).alias("other"))
        .filter((F.col("fp") != F.col("other")) & near)
        .select(F.col("fp").alias("a"), F.col("other").alias("b"))
        .distinct()
    )
    first = settled(components(stars))
    placed = cells.join(first.withColumnRenamed("node", "fp"), "fp", "left").select(
        "choice", "cell", "fp", F.coalesce("component", "fp").alias("part")
    )
    open_cells = (
        placed.groupBy("choice", "cell")
        .agg(F.min("part").alias("low"), F.max("part").alias("high"))
        .filter("low <> high")
        .select("choice", "cell")
    )
    rest = settled(placed.join(open_cells, ["choice", "cell"]))
    a, b = rest.alias("a"), rest.alias("b")
    apart = F.col("a.fp").bitwiseXOR(F.col("b.fp"))
    counts_apart = unary(F.col("a.fp")).bitwiseXOR(unary(F.col("b.fp")))
    found = a.join(
        b,
        (F.col("a.choice") == F.col("b.choice"))
        & (F.col("a.cell") == F.col("b.cell"))
        & (F.col("a.part") < F.col("b.part"))
        & (F.bit_count(counts_apart) <= DISTANCE)
        & (F.bit_count(apart) <= DISTANCE)
        & (_first_choice(counts_apart) == F.col("a.choice")),
    )
    return first.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(
        found.select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))
    )


def _shared(cells: DataFrame) -> DataFrame:
    """Cells with two fingerprints or more, each row with the cell's chosen three."""
    held = (
        cells.groupBy("choice", "cell")
        .agg(
            F.count("*").alias("n"),
            F.max(F.struct("copies", "fp")).alias("top"),
            F.min("fp").alias("least"),
            F.max("fp").alias("greatest"),
        )
        .filter("n > 1")
        .select("choice", "cell", F.col("top.fp").alias("most"), "least", "greatest")
    )
    return cells.join(held, ["choice", "cell"])


def _named(distinct: DataFrame) -> DataFrame:
    """``distinct`` (fp, copies and others) with ``part``, the least fingerprint of its component."""
    parts = settled(components(links(distinct.select("fp", "copies")))).withColumnRenamed("node", "fp")
    return distinct.join(parts, "fp", "left").withColumn("part", F.coalesce("component", "fp")).drop("component")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id) per row of ``docs``.

    component_id is the least doc_id among all texts reachable over fingerprints that differ
    in 3 bits or less. NULL and blank texts have fingerprint zero and are linked like others.
    Rows with a NULL doc_id get a row and take part, but name no component; a component of
    such rows alone is NULL. Repeated rows stay. Other columns are not read.
    """
    prints = settled(fingerprints(docs))
    distinct = settled(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies")))
    named = _named(distinct)
    least = named.groupBy("part").agg(F.min("first_id").alias("component_id"))
    by_print = named.join(least, "part").select("fp", "component_id")
    return prints.join(by_print, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_per_component(docs: DataFrame) -> DataFrame:
    """One row of each component, with all its columns: the least doc_id, NULLs last, then the first row.

    Rows are told apart by a number written beside them, so rows that repeat an id or have
    none are decided about one by one.
    """
    numbered = written(docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), F.monotonically_increasing_id().alias("row")))
    prints = settled(fingerprints(numbered.select("doc.doc_id", "doc.text", "row"), "row"))
    order = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "row")
    distinct = settled(prints.groupBy("fp").agg(F.min(order).alias("first"), F.count("*").alias("copies")))
    kept = _named(distinct).groupBy("part").agg(F.min("first").alias("first")).select("first.row")
    return numbered.join(kept, "row", "left_semi").select("doc.*")
