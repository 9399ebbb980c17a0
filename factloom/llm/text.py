"""Whole texts as arrays of word codes, one Arrow batch at a time.

Words that repeat in a batch are looked at once: a batch becomes a dictionary of distinct
words and one code per word, and results per word are gathered back by code.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that are taken apart at once.
SLICE_BYTES = 4_000_000
#: Texts are long: what goes to Python at once is bounded by rows and bytes.
BATCH_ROWS, BATCH_BYTES = 2_000, 16 << 20


def in_fold(key: str | Column, folds: int, fold: int) -> Column:
    """True where crc32 of the id as text leaves ``fold``; a row without id is in no fold."""
    key = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.pmod(F.crc32(key.cast("string")), F.lit(folds)) == fold, F.lit(False))


def bounded_batches(spark: SparkSession) -> None:
    """Let no Arrow batch of the session hold more than BATCH_ROWS rows or, about, BATCH_BYTES."""
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{key}"
        now = spark.conf.get(key, None)
        if now is None or not now.lstrip("-").isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))


def texts_of(docs: DataFrame, *more: str) -> DataFrame:
    """(doc_id, text) and columns named by ``more`` of the rows, to be sent to Python in bounded batches."""
    bounded_batches(docs.sparkSession)
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"), *[docs[c] for c in more])


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``limit`` bytes of text; a longer text is a piece of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    begin = held = 0
    for row, size in enumerate(sizes.tolist()):
        if held and held + size > limit:
            yield batch.slice(begin, row - begin)
            begin, held = row, 0
        held += size
    if begin < batch.num_rows:
        yield batch.slice(begin)


@dataclass
class Words:
    """``codes[starts[i]:starts[i + 1]]`` are the words of text i, as places in ``values``."""

    codes: np.ndarray
    starts: np.ndarray
    values: pa.StringArray

    @cached_property
    def distinct(self) -> list[str]:
        return self.values.to_pylist()

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))

    def sums(self, per_word: np.ndarray) -> np.ndarray:
        """Per text, the sum of a number given per distinct word."""
        if not len(self.codes):
            return np.zeros(len(self.starts) - 1)
        return np.bincount(self.rows(), weights=per_word[self.codes], minlength=len(self.starts) - 1)


def words_of(texts: pa.Array, lower: str = "ascii") -> Words:
    """Words between blanks (0x20, 0x09 to 0x0D); NULL counts as empty.

    ``lower``: "ascii" lower-cases A to Z only, "utf8" all letters, "no" none.
    """
    texts = pc.fill_null(texts, "")
    if lower != "no":
        texts = pc.ascii_lower(texts) if lower == "ascii" else pc.utf8_lower(texts)
    lists = pc.ascii_split_whitespace(texts)
    starts = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.flatten().dictionary_encode()
    starts = starts - starts[0]
    codes, empty = flat.indices.to_numpy(), pc.index(flat.dictionary, "").as_py()
    if empty >= 0:
        kept = codes != empty
        before = np.concatenate([[0], np.cumsum(kept)])
        codes, starts = codes[kept], before[starts]
    return Words(codes, starts, flat.dictionary)
