"""Language identification by cross-parsing (Ziv and Merhav 1993) with suffix automata.

A word, set between blanks, is cut greedily into the longest pieces that occur in a
language's learned text; letters unknown to the language are pieces of their own. The
language that needs the fewest pieces, each weighed by the bits that name a place in its
learned text, wins. A piece never reaches into the next word, so a word costs the same
wherever it stands: learned text is kept as its distinct words, and a batch's repeated words
are parsed once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factloom.llm.text import bounded_batches, slices, words_of

#: Learned letters per language, and the documents they are taken from (whole texts, in the
#: order of a hash of their ids). This bounds what is fitted, not what is classified.
LEARN_LETTERS = 30_000
LEARN_DOCS = 64
#: A run of letters beyond this length is parsed in pieces of this length.
PIECE = 64

NOT_LETTERS = regex.compile(r"\P{L}+")


@dataclass
class Automaton:
    """Suffix automaton of a text: ``next[state * width + column]`` is 0 where there is no step.

    The root is state 0; no step leads there. ``columns`` maps letters to 1..width-1.
    """

    columns: dict[str, int]
    sources: np.ndarray
    targets: np.ndarray
    states: int
    bits: float

    def table(self) -> tuple[np.ndarray, np.ndarray, int]:
        """Steps as one dense array, the column of every code point, the width."""
        width = len(self.columns) + 1
        steps = np.zeros(self.states * width, dtype=np.int32)
        steps[self.sources] = self.targets
        column_of = np.zeros(0x110000, dtype=np.int32)
        for letter, column in self.columns.items():
            column_of[ord(letter)] = column
        return steps, column_of, width


def automaton(text: str) -> Automaton:
    """Built letter by letter; a state's suffix link leads to its longest suffix in another class."""
    columns = {letter: k + 1 for k, letter in enumerate(sorted(set(text)))}
    steps: list[dict[str, int]] = [{}]
    link, length, last = [-1], [0], 0
    for letter in text:
        new = len(steps)
        steps.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and letter not in steps[at]:
            steps[at][letter] = new
            at = link[at]
        if at >= 0:
            seen = steps[at][letter]
            if length[seen] != length[at] + 1:
                twin = len(steps)
                steps.append(dict(steps[seen]))
                length.append(length[at] + 1)
                link.append(link[seen])
                while at >= 0 and steps[at].get(letter) == seen:
                    steps[at][letter] = twin
                    at = link[at]
                link[seen] = twin
                seen = twin
            link[new] = seen
        last = new
    width = len(columns) + 1
    arcs = [(s * width + columns[c], t) for s, out in enumerate(steps) for c, t in out.items()]
    sources, targets = (np.array(x, dtype=np.int64) for x in zip(*arcs, strict=True)) if arcs else (np.zeros(0, np.int64),) * 2
    return Automaton(columns, sources, targets.astype(np.int32), len(steps), float(np.log2(len(text) + 2)))


def phrases(words: list[str], steps: np.ndarray, column_of: np.ndarray, width: int) -> np.ndarray:
    """The number of pieces of each word; all words advance together, one letter at a time."""
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    order = np.argsort(-sizes, kind="stable")
    starts = (np.cumsum(sizes) - sizes)[order]
    lengths = sizes[order]
    columns = column_of[np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
    state, pieces = np.zeros(len(words), dtype=np.int64), np.zeros(len(words), dtype=np.int64)
    going = len(words)
    for at in range(int(lengths[0]) if len(words) else 0):
        going = int(np.searchsorted(-lengths[:going], -at))  # words longer than ``at``
        column = columns[starts[:going] + at]
        now = state[:going]
        onward = steps[now * width + column]
        stuck = onward == 0
        again = steps[column]
        pieces[:going] += (stuck & (now > 0)).astype(np.int64) + (stuck & (again == 0))
        state[:going] = np.where(stuck, again, onward)
    pieces += state > 0
    out = np.empty(len(words), dtype=np.int64)
    out[order] = pieces
    return out


def learn_languages(labelled: DataFrame, letters: int = LEARN_LETTERS, docs: int = LEARN_DOCS) -> dict[str, Automaton]:
    """An automaton per non-NULL ``lang`` of the rows given, from a bounded sample of each language.

    Two passes: rows per language are counted, then a share of each language's rows that is
    expected to hold four times ``docs`` is ordered by a hash of (doc_id, text) and the first
    ``docs`` are brought to the driver. Rows with NULL or letterless text teach nothing.
    """
    rows = labelled.filter("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "lang", "text")
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return {}
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, 4 * docs / n))])
    place = F.xxhash64("doc_id", F.lit("language sample"))
    near = rows.filter(F.pmod(place, F.lit(1 << 40)) < share[F.col("lang")] * (1 << 40))
    order = Window.partitionBy("lang").orderBy(place, F.xxhash64("text"))
    picked = near.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= docs)
    learned: dict[str, set[str]] = {k: set() for k in counts}
    room = dict.fromkeys(counts, letters)
    for row in picked.orderBy("lang", "nth").select("lang", "text").toLocalIterator():
        for word in map(letters_of, row["text"].lower().split()):
            if word and word not in learned[row["lang"]] and room[row["lang"]] > 0:
                learned[row["lang"]].add(word)
                room[row["lang"]] -= len(word) + 1
    return {k: automaton(f" {' '.join(sorted(v))} ") for k, v in sorted(learned.items()) if v}


def letters_of(word: str) -> str:
    return NOT_LETTERS.sub("", word)


def identify(docs: DataFrame, models: dict[str, Automaton], lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """Every row of ``docs`` as ``doc`` (a struct of all its columns) with a language and a score.

    score: the share by which the best language's code is shorter than the second's, 0 to 1;
    1 with one language. Text that is NULL or has no letter, or any text when nothing was
    learned: ``und``, score 0. Equal codes: the first language by name. Columns of ``docs``
    cannot clash, as they stay inside ``doc``.
    """
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(models)
    bounded_batches(spark)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"))
    kind = f"doc {rows.schema['doc'].dataType.simpleString()}, {lang} string, {score} double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*held.value, "und"], dtype=object)
        tables = [m.table() for m in held.value.values()]
        bits = [m.bits for m in held.value.values()]
        for batch in batches:
            texts = batch.column("doc").field("text")
            for part in slices(pa.record_batch([batch.column("doc"), texts], names=["doc", "text"])):
                codes, letters = _costs(part.column("text"), tables, bits)
                best = codes.argmin(1) if len(tables) else np.zeros(part.num_rows, dtype=int)
                ranked = np.sort(codes, 1)
                lead = 1 - ranked[:, 0] / np.maximum(ranked[:, 1], 1e-9) if len(tables) > 1 else np.ones(part.num_rows)
                none = (letters == 0) if len(tables) else np.ones(part.num_rows, dtype=bool)
                best[none] = len(tables)
                lead[none] = 0.0
                yield pa.record_batch(
                    [part.column("doc"), pa.array(names[best], pa.string()), pa.array(lead)], names=["doc", lang, score]
                )

    return rows.mapInArrow(run, kind)


def _costs(texts: pa.Array, tables: list, bits: list[float]) -> tuple[np.ndarray, np.ndarray]:
    words = words_of(texts, lower="utf8")
    bare = [letters_of(w) for w in words.distinct]
    owner, pieces = [], []
    for k, word in enumerate(bare):
        for begin in range(0, len(word), PIECE):
            owner.append(k)
            pieces.append(f" {word[begin : begin + PIECE]} ")
    owners = np.array(owner, dtype=np.int64)
    letters = words.sums(np.fromiter(map(len, bare), dtype=float, count=len(bare)))
    codes = [
        words.sums(bit * np.bincount(owners, weights=phrases(pieces, *table), minlength=len(bare)))
        for table, bit in zip(tables, bits, strict=True)
    ]
    return np.stack(codes, 1) if codes else np.zeros((len(texts), 1)), letters
