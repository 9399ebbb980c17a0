"""Toxicity from confirmed toxic and unlabelled texts (Kiryo et al. 2017, non-negative PU learning).

Negatives are not needed: with class prior p the risk on unlabelled texts, less p times the
risk of taking the toxic ones for clean, estimates the risk on clean texts. Where that
estimate falls below zero it is overfitting, and the step goes back on it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.llm.text import bounded_batches, slices, texts_of, words_of
from factloom.plans.frontier import settled

#: Bounds of what is fitted: confirmed toxic texts, unlabelled texts, taken by a hash of their ids.
TOXIC, UNLABELLED = 1_500, 3_000
#: Words and their beginnings of so many letters are hashed to so many places. A place counts
#: once when a text has it, and once more when the text has it OFTEN times.
BEGINNINGS, PLACES, OFTEN = (4, 5, 6, 7), 1 << 20, 3
#: The most telling places are weighed.
WEIGHED = 4_000
STEPS, RATE, DECAY = 300, 0.05, 2e-4
#: A step goes back once the estimated risk on clean texts is below minus this.
SLACK = 0.0
THRESHOLD = 0.7

NOT_LETTERS = regex.compile(r"[^\p{L}\p{N}]+")


@dataclass
class Model:
    weights: np.ndarray  # by place, then by place of what is there often
    bias: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        """Probability of toxic per text."""
        used = (self.weights != 0).reshape(2, PLACES).any(0)
        places, rows, n = word_places(texts, used)
        sums = self.bias + np.bincount(rows, weights=self.weights[places], minlength=n)
        return 1 / (1 + np.exp(-np.clip(sums, -30, 30)))


def word_places(texts: pa.Array, used: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, int]:
    """Distinct (place, text) pairs, ordered by text, of ``used`` places (all by default), and the number of texts.

    Case and punctuation are dropped.
    """
    words = words_of(texts, lower="utf8")
    digest = xxhash.xxh64_intdigest
    owner, place = [], []
    for k, word in enumerate(words.distinct):
        bare = NOT_LETTERS.sub("", word)
        if bare:
            found = [digest(bare) % PLACES, *(digest(bare[:n] + "-") % PLACES for n in BEGINNINGS if len(bare) > n)]
            owner += [k] * len(found)
            place += found
    owners, places = np.array(owner, dtype=np.int64), np.array(place, dtype=np.int64)
    if used is not None:
        owners, places = owners[used[places]], places[used[places]]
    size = np.bincount(owners, minlength=len(words.distinct))
    first = np.cumsum(size) - size
    told = size[words.codes] > 0
    codes, rows = words.codes[told], words.rows()[told]
    many = size[codes]
    token = np.repeat(np.arange(len(codes)), many)
    nth = np.arange(len(token)) - np.repeat(np.cumsum(many) - many, many)
    pair, times = np.unique(rows[token] * 2 * PLACES + places[first[codes[token]] + nth], return_counts=True)
    pair = np.sort(np.concatenate([pair, pair[times >= OFTEN] + PLACES]))
    return pair % (2 * PLACES), pair // (2 * PLACES), len(texts)


def telling(toxic: list[np.ndarray], unlabelled: list[np.ndarray], most: int = WEIGHED) -> np.ndarray:
    """Places whose share of toxic texts differs most from their share of unlabelled ones, in standard errors."""
    n, m = len(toxic), len(unlabelled)
    seen = np.bincount(np.concatenate(toxic), minlength=2 * PLACES)
    met = np.bincount(np.concatenate(unlabelled), minlength=2 * PLACES)
    both = (seen + met + 1) / (n + m + 2)
    apart = np.abs(seen / n - met / m) / np.sqrt(both * (1 - both) * (1 / n + 1 / m))
    apart[(seen + met) < 3] = 0
    best = np.argsort(-apart, kind="stable")[:most]
    return best[apart[best] > 0]


def fit(toxic: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> Model:
    """Weights of the telling words by gradient steps on the non-negative risk with logistic loss.

    Without texts of both kinds nothing is learned and every text gets the prior.
    """
    bias = float(np.log(max(prior, 1e-6) / max(1 - prior, 1e-6)))
    weights = np.zeros(2 * PLACES)
    if not toxic or not unlabelled or not 0 < prior < 1:
        return Model(weights, bias)
    used = telling(toxic, unlabelled)
    column = np.full(2 * PLACES, -1)
    column[used] = np.arange(len(used))

    def table(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, int]:
        columns = column[np.concatenate(texts)]
        rows = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        return columns[columns >= 0], rows[columns >= 0], len(texts)

    sides = table(toxic), table(unlabelled)
    w, b = np.zeros(len(used)), bias
    w_sum, b_sum, last = np.zeros(len(used)), 0.0, STEPS // 3  # steps back and forth average out
    mean, square = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    for t in range(1, STEPS + 1):
        out = [b + np.bincount(r, weights=w[c], minlength=n) for c, r, n in sides]
        slope_pos, slope_neg = (1 / (1 + np.exp(-g)) for g in out)
        clean = np.logaddexp(0, out[1]).mean() - prior * np.logaddexp(0, out[0]).mean()

        def gradient(side: int, slope: np.ndarray) -> np.ndarray:
            c, r, n = sides[side]
            return np.append(np.bincount(c, weights=slope[r], minlength=len(w)), slope.sum()) / n

        as_clean = gradient(1, slope_neg) - prior * gradient(0, slope_pos)
        step = prior * gradient(0, slope_pos - 1) + as_clean if clean >= -SLACK else -as_clean
        step[:-1] += DECAY * w
        mean = 0.9 * mean + 0.1 * step
        square = 0.999 * square + 0.001 * step * step
        move = RATE * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.999**t)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
        if t > STEPS - last:
            w_sum, b_sum = w_sum + w, b_sum + b
    weights[used] = w_sum / last
    return Model(weights, float(b_sum / last))


def train(docs: DataFrame, labels: DataFrame, learns: Column) -> Model:
    """A model from the rows of ``docs`` that ``learns`` selects and the labels of these.

    Confirmed toxic texts are those labelled 1 (a repeated id is toxic if one label says so);
    unlabelled ones are drawn from all, labelled or not, and their labels are not looked at. The class prior is
    the share of toxic among the labelled. One pass over the texts fetches both samples.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"), learns.alias("learns"))
    rows = rows.filter("learns AND text IS NOT NULL AND doc_id IS NOT NULL")
    marked = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["toxic"].cast("int").alias("toxic"))
    marked = marked.filter("toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marked = settled(marked.join(rows.select("doc_id").distinct(), "doc_id"))
    n_marked, n_toxic = marked.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not n_toxic:
        return fit([], [], 0.0)
    n_rows = rows.count()
    place = F.pmod(F.xxhash64("doc_id", F.lit("toxic sample")), F.lit(1 << 40))
    chosen = marked.filter("toxic = 1").filter(place < int(min(1.0, TOXIC / n_toxic) * (1 << 40))).select("doc_id", F.lit(True).alias("toxic"))
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("unlabelled sample")), F.lit(1 << 40)) < int(min(1.0, UNLABELLED / n_rows) * (1 << 40))
    some = rows.withColumn("drawn", drawn).join(F.broadcast(chosen), "doc_id", "left").filter("drawn OR toxic")  # about TOXIC ids

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found, row, n = word_places(part.column("text"))
                cuts = np.searchsorted(row, np.arange(n + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(cuts, pa.array(found.astype(np.int32)))
                yield pa.record_batch([part.column("doc_id"), part.column("drawn"), part.column("toxic"), lists], names=["doc_id", "drawn", "toxic", "places"])

    kind = "doc_id long, drawn boolean, toxic boolean, places array<int>"
    sample = some.select("doc_id", "drawn", "toxic", "text").mapInArrow(places, kind).toArrow().sort_by("doc_id")
    toxic, unlabelled = [], []
    for drawn_, is_toxic, words in zip(*(sample.column(c).combine_chunks() for c in ("drawn", "toxic", "places")), strict=True):
        own = words.values.to_numpy()
        if is_toxic.as_py():
            toxic.append(own)
        if drawn_.as_py():
            unlabelled.append(own)
    return fit(toxic, unlabelled, n_toxic / n_marked)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, predicted) per row: the whole text's probability of being toxic, 1 from THRESHOLD on.

    NULL text counts as empty, which has the bias alone. Rows with NULL or repeated ids stay;
    other columns are not read.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield pa.record_batch([part.column("doc_id"), pa.array(held.value.scores(part.column("text")))], names=["doc_id", "score"])

    rows = texts_of(docs)
    return rows.mapInArrow(run, "doc_id long, score double").withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
