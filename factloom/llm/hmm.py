"""A hidden Markov language model over whole texts.

Latent states follow each other from word to word, and each state emits word classes: the
most frequent words are classes of their own, every other word belongs to a class by its
ending and is drawn from that class by its count. So the model covers every word, its tables
have a fixed size, and counts of all words stay in a distributed table.

Training is Baum and Welch's: expected counts are gathered in every partition over all
training texts, summed by Spark, and turned into the next model. The likelihood of a text is
exact, by the forward recursion with scaling.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.llm.text import Words, bounded_batches, slices, words_of
from factloom.plans.frontier import settled

STATES = 6
#: Words that are classes of their own, classes of endings, words whose counts every task holds.
OWN, ENDINGS, HELD = 16_384, 512, 131_072
ENDING = 2
#: Passes over all training texts, and what the first model is fitted on: texts and rounds.
PASSES, START_DOCS, START_ROUNDS = 2, 400, 8
#: Added to every expected count.
SMOOTH = 0.05
STAY = 0.95
SEED = 11
#: Bytes of text that are run through the recursions side by side.
BYTES = 8_000_000


@dataclass
class Vocabulary:
    """Classes 0..own-1 are words, then the endings, then the end of a text.

    ``top`` are the most frequent words, the first ``own`` of them classes of their own, and
    ``counts`` their counts. ``known`` and ``kinds`` are the training tokens and distinct words of each
    class that is not one word; ``tokens`` and ``words`` those of all, ends included.
    """

    top: pa.StringArray
    counts: np.ndarray
    own: int
    known: np.ndarray
    kinds: np.ndarray
    docs: int
    tokens: int
    words: int

    @property
    def end(self) -> int:
        return self.own + ENDINGS

    def __len__(self) -> int:
        return self.own + ENDINGS + 1

    def look_up(self, values: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Class and count of each word; the count of words that are not held is 0."""
        place = pc.fill_null(pc.index_in(values, value_set=self.top), -1).to_numpy()
        endings = pc.utf8_slice_codeunits(values, -ENDING).dictionary_encode()
        digests = [xxhash.xxh64_intdigest(e, 42) % ENDINGS for e in endings.dictionary.to_pylist()]
        by_ending = self.own + np.array(digests, dtype=np.int64)[endings.indices.to_numpy()]
        counts = np.append(self.counts, 0)[place]
        return np.where((place >= 0) & (place < self.own), place, by_ending), counts


@dataclass
class Model:
    start: np.ndarray
    step: np.ndarray
    emit: np.ndarray  # (classes, states)


@dataclass
class Expected:
    """Expected counts; they add up over texts and partitions."""

    start: np.ndarray
    step: np.ndarray
    emit: np.ndarray

    def model(self) -> Model:
        start, step, emit = self.start + SMOOTH, self.step + SMOOTH, self.emit + SMOOTH
        return Model(start / start.sum(), step / step.sum(1, keepdims=True), emit / emit.sum(0, keepdims=True))


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over all texts given: tokens are lower-cased (A to Z) words between blanks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                words = words_of(part.column("text"))
                seen = np.bincount(words.codes, minlength=len(words.distinct))
                kept = np.flatnonzero(seen)
                yield pa.record_batch([words.values.take(pa.array(kept)), pa.array(seen[kept])], names=["word", "n"])

    return docs.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(counts: DataFrame, n_docs: int) -> Vocabulary:
    """The most frequent words, at most HELD, and what is needed of all others by class.

    The least count of the words held comes from a histogram of counts on a logarithmic scale, so no
    sort of all words is needed; words that share a step of it are held or left together.
    """
    scale = F.floor(F.log2("n") * 64).cast("int")
    steps = sorted(((r["at"], r["words"], r["n"]) for r in counts.groupBy(scale.alias("at")).agg(F.count("*").alias("words"), F.sum("n").alias("n")).collect()), reverse=True)
    total, tokens = sum(s[1] for s in steps), sum(s[2] for s in steps)
    least, held = (steps[0][0] + 1 if steps else 0), 0
    for at, words, _ in steps:
        if held + words > HELD:
            break
        least, held = at, held + words
    top = sorted(((r["word"], r["n"]) for r in counts.filter(scale >= least).collect()), key=lambda r: (-r[1], r[0]))
    own = min(OWN, len(top))
    cut = top[own - 1] if own else ("", 1 << 62)
    other = (F.col("n") < cut[1]) | ((F.col("n") == cut[1]) & (F.col("word") > cut[0]))
    known, kinds = np.zeros(own + ENDINGS + 1), np.zeros(own + ENDINGS + 1)
    ending = F.pmod(F.xxhash64(F.right("word", F.lit(ENDING))), F.lit(ENDINGS))
    for row in counts.filter(other).groupBy(ending.alias("at")).agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect():
        known[own + row["at"]], kinds[own + row["at"]] = row["n"], row["words"]
    words = pa.array([w for w, _ in top], pa.string())
    return Vocabulary(words, np.array([n for _, n in top], dtype=np.int64), own, known, kinds, n_docs, tokens + n_docs, total + (n_docs > 0))


def sequences(words: Words, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes of all texts one after the other, each with its end, where they start, their lengths."""
    class_of = vocab.look_up(words.values)[0].astype(np.int32)
    lengths = np.diff(words.starts) + 1
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    out = np.full(int(lengths.sum()), vocab.end, dtype=np.int32)
    inner = np.ones(len(out), dtype=bool)
    inner[starts + lengths - 1] = False
    out[inner] = class_of[words.codes]
    return out, starts, lengths


class Recursion:
    """The scaled forward recursion over many texts side by side, longest first.

    ``scales[t][i]`` is the probability of text i's token t given those before it, so the
    logarithms add up to the likelihood; nothing can vanish, however long the text. Arrays
    have a row per state and a column per text, so that all work runs along the texts.
    """

    def __init__(self, model: Model, classes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, keep: bool) -> None:
        self.order = np.argsort(-lengths, kind="stable")
        self.classes, self.starts = classes, starts[self.order]
        longest = int(lengths.max()) if len(lengths) else 0
        self.going = np.searchsorted(-lengths[self.order], -np.arange(longest), side="left")
        self.model, self.emit = model, np.ascontiguousarray(model.emit.T)
        self.forward, self.scales = [], []
        onward, held = np.ascontiguousarray(model.step.T), None
        for t, k in enumerate(self.going.tolist()):
            now = self.emitted(t, k)
            now *= model.start[:, None] if held is None else onward @ held[:, :k]
            scale = now.sum(0)
            now /= scale
            held = now
            self.scales.append(scale)
            if keep:
                self.forward.append(held)

    def at(self, t: int, k: int) -> np.ndarray:
        return self.classes[self.starts[:k] + t]

    def emitted(self, t: int, k: int) -> np.ndarray:
        return self.emit.take(self.at(t, k), axis=1)

    def likelihoods(self) -> np.ndarray:
        """log10 of the probability of each text's classes."""
        sums = np.zeros(len(self.order))
        if self.scales:
            place = np.concatenate([self.order[:k] for k in self.going.tolist()])
            sums = np.bincount(place, weights=np.log10(np.concatenate(self.scales)), minlength=len(sums))
        return sums

    def expected(self) -> Expected:
        states, model = len(self.model.start), self.model
        steps = np.zeros((states, states))
        later, n_later = None, 0
        for t in range(len(self.going) - 1, -1, -1):
            k = int(self.going[t])
            next_ = self.emitted(t, k)
            next_ /= self.scales[t]
            if later is not None:
                steps += self.forward[t][:, :n_later] @ later.T
                back = model.step @ later
                next_[:, :n_later] *= back  # texts that end here go on with 1
                self.forward[t][:, :n_later] *= back  # now the probability of each state, given the whole text
            later, n_later = next_, k
        if not self.forward:
            return Expected(np.zeros(states), steps, np.zeros_like(model.emit))
        place = np.concatenate([self.at(t, k) for t, k in enumerate(self.going.tolist())])
        each = np.concatenate(self.forward, axis=1)
        emit = np.stack([np.bincount(place, weights=each[s], minlength=len(model.emit)) for s in range(states)], 1)
        return Expected(self.forward[0].sum(1), steps * model.step, emit)


def first_model(sample: list[np.ndarray], size: int) -> Model:
    """A model fitted on a few texts, its states begun from texts that are unlike each other."""
    if not sample:
        flat = np.full(STATES, 1 / STATES)
        return Model(flat, np.tile(flat, (STATES, 1)), np.full((size, STATES), 1 / size))
    counts = np.stack([np.bincount(s, minlength=size) for s in sample]).astype(np.float32)
    unit = counts / np.maximum(np.linalg.norm(counts, axis=1, keepdims=True), 1e-9)
    centre = unit[np.argsort([-len(s) for s in sample], kind="stable")[:1]]
    while len(centre) < STATES:
        far = int((unit @ centre.T).max(1).argmin())
        centre = np.vstack([centre, unit[far : far + 1]])
    group = (unit @ centre.T).argmax(1)
    chance = np.random.default_rng(SEED)
    emit = np.stack([counts[group == s].sum(0) for s in range(STATES)], 1) + counts.sum(0)[:, None] * 0.1 / STATES
    emit = emit * (0.9 + 0.2 * chance.random(emit.shape)) + SMOOTH
    step = np.full((STATES, STATES), (1 - STAY) / max(STATES - 1, 1))
    np.fill_diagonal(step, STAY)
    model = Model(np.full(STATES, 1 / STATES), step, emit / emit.sum(0))
    lengths = np.array([len(s) for s in sample])
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    for _ in range(START_ROUNDS):
        model = Recursion(model, np.concatenate(sample), starts, lengths, True).expected().model()
    return model


def train(docs: DataFrame, vocab: Vocabulary, vocab_held: Broadcast) -> Model:
    """A model by Baum and Welch from all ``docs``; the first one from a bounded sample of them.

    A partition sends one row per class it met, and one for starts and steps, so what moves is
    bounded by the model's size per partition.
    """
    spark = docs.sparkSession
    share = min(1.0, START_DOCS / max(vocab.docs, 1))
    some = docs.filter(F.pmod(F.xxhash64("doc_id", F.lit("first model")), F.lit(1 << 40)) < int(share * (1 << 40)))

    def classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=BYTES):
                found, starts, lengths = sequences(words_of(part.column("text")), vocab_held.value)
                lists = [found[a : a + n] for a, n in zip(starts, lengths, strict=True)]
                yield pa.record_batch([pa.array(lists, pa.list_(pa.int32()))], names=["classes"])

    sample = sorted((r["classes"] for r in some.select("text").mapInArrow(classes, "classes array<int>").collect()), key=lambda s: (-len(s), s))
    model = first_model([np.array(s, dtype=np.int32) for s in sample], len(vocab))
    del sample
    for _ in range(PASSES if vocab.docs else 0):
        held = spark.sparkContext.broadcast(model)

        def count(batches: Iterator[pa.RecordBatch], held: Broadcast = held) -> Iterator[pa.RecordBatch]:
            total: Expected | None = None
            for batch in batches:
                for part in slices(batch, limit=BYTES):
                    found = sequences(words_of(part.column("text")), vocab_held.value)
                    own = Recursion(held.value, *found, True).expected()
                    if total is None:
                        total = own
                    else:
                        total.start += own.start
                        total.step += own.step
                        total.emit += own.emit
            if total is not None:
                met = np.flatnonzero(total.emit.any(1))
                table = np.vstack([total.emit[met], total.step, total.start])
                place = np.concatenate([met, -1 - np.arange(STATES), [-1 - STATES]])
                yield pa.record_batch([pa.array(place), *[pa.array(table[:, s]) for s in range(STATES)]], names=["place", *NAMES])

        kind = ", ".join(f"{c} double" for c in NAMES)
        sums = docs.select("text").mapInArrow(count, f"place long, {kind}").groupBy("place").agg(*[F.sum(c).alias(c) for c in NAMES])
        rows = sums.collect()  # a row per class and state
        expected = Expected(np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((len(vocab), STATES)))
        for row in rows:
            at, values = row["place"], [row[c] for c in NAMES]
            if at >= 0:
                expected.emit[at] = values
            elif at >= -STATES:
                expected.step[-1 - at] = values
            else:
                expected.start[:] = values
        model = expected.model()
        held.unpersist()
    return model


NAMES = [f"s{k}" for k in range(STATES)]


def score(docs: DataFrame, learns: Column) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score), one row per row of ``docs``.

    ``learns`` says which rows are learned from. Tokens are the words and one end. base_score is
    the sum of log10((c + 1) / (N + V + 1)), score the model's log10 probability: of the classes,
    and of each word within its class, (c + 1) / (class tokens + class words + 1). NULL text is
    empty and has its end alone. With nothing to learn from, both scores follow from N = V = 0 and are 0.
    Rows with NULL or repeated ids stay and are scored each; other columns are not read.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"), learns.alias("learns"))
    taught = rows.filter("learns").select("doc_id", "text")
    n_docs = taught.count()
    counts = settled(word_counts(taught))
    vocab = vocabulary(counts, n_docs)
    vocab_held = spark.sparkContext.broadcast(vocab)
    model = train(taught, vocab, vocab_held)
    held = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A row per text, under a key no word can have, and a row per text and word that is not held.
        vocab, model = vocab_held.value, held.value
        row, first = TaskContext.get().partitionId() << 33, 0
        in_class = np.log10(vocab.known + vocab.kinds + 1)
        for batch in batches:
            for part in slices(batch, limit=BYTES):
                words = words_of(part.column("text"))
                found = sequences(words, vocab)
                likely = Recursion(model, *found, False).likelihoods() if vocab.docs else np.zeros(part.num_rows)
                place, n = vocab.look_up(words.values)
                logs = np.log10(n + 1)
                shared = place >= vocab.own
                likely += words.sums(np.where(shared, logs - in_class[place], 0.0))
                ids = row + first + np.arange(part.num_rows)
                first += part.num_rows
                yield pa.record_batch(
                    [
                        pa.array([f" {i}" for i in ids.tolist()]),
                        pa.array(ids),
                        part.column("doc_id"),
                        pa.array(found[2]),
                        pa.array(words.sums((n > 0).astype(float)).astype(np.int64)),
                        pa.array(words.sums(logs)),
                        pa.array(likely),
                    ],
                    names=FLAT,
                )
                pair, times = np.unique(words.rows() * len(n) + words.codes, return_counts=True)
                open_ = n[pair % max(len(n), 1)] == 0
                pair, times = pair[open_], times[open_]
                none = pa.nulls(len(pair), pa.int64())
                yield pa.record_batch(
                    [
                        words.values.take(pa.array(pair % max(len(n), 1))),
                        pa.array(ids[pair // max(len(n), 1)]),
                        none,
                        pa.array(times),
                        none,
                        pa.nulls(len(pair), pa.float64()),
                        pa.nulls(len(pair), pa.float64()),
                    ],
                    names=FLAT,
                )

    flat = rows.select("doc_id", "text").mapInArrow(run, "word string, row long, doc_id long, n long, known long, logs double, likely double")
    text = F.col("known").isNotNull()  # the row of a text, not of one of its words
    least = int(vocab.counts.min()) if len(vocab.counts) else 1 << 62
    rest = counts.filter(F.col("n") < least).select("word", F.col("n").alias("c"))  # the words that are not held
    joined = flat.join(rest, "word", "left").select(
        "row",
        F.when(text, F.struct("doc_id", "n", "known", "logs", "likely")).alias("text"),
        F.when(~text & F.col("c").isNotNull(), F.col("n")).otherwise(0).alias("known"),
        F.when(~text & F.col("c").isNotNull(), F.col("n") * F.log10(F.col("c") + 1)).otherwise(0.0).alias("logs"),
    )
    sums = joined.groupBy("row").agg(F.max("text").alias("text"), F.sum("known").alias("known"), F.sum("logs").alias("logs"))
    per_token = float(np.log10(vocab.tokens + vocab.words + 1))
    return sums.select(
        F.col("text.doc_id").alias("doc_id"),
        F.col("text.n").alias("n_tokens"),
        (F.col("text.known") + F.col("known") + (1 if n_docs else 0)).alias("n_known"),
        F.lit(vocab.tokens).cast("long").alias("train_tokens"),
        (F.col("text.logs") + F.col("logs") + F.lit(float(np.log10(n_docs + 1))) - F.col("text.n") * per_token).alias("base_score"),
        (F.col("text.likely") + F.col("logs")).alias("score"),
    )


FLAT = ["word", "row", "doc_id", "n", "known", "logs", "likely"]
