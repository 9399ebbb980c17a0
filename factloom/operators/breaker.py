"""Breaker states over series of validation results (Q05) and gated publishing (Q06).

The states of one contract depend on each other in time order. To keep a contract with
very many results parallel, its series is cut into pieces (see ``factloom.plans.sequence``):

1. each piece is summarised alone: for each state it may start in, the state it ends in;
2. the summaries of a contract, one row per piece, are chained to give every piece its start;
3. each piece is replayed from its start.

Contracts below the limit are one piece and only take step 3.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.plans.sequence import PIECE, PIECES, ROWS_PER_PIECE, in_pieces, measure, position, same_keys

CLOSED, OPEN, HALF_OPEN = "closed", "open", "half_open"
MICROS_PER_MINUTE = 60_000_000


@dataclass(frozen=True)
class BreakerConfig:
    failure_threshold: int = 1
    recovery_minutes: int = 60
    passes_to_close: int = 3

    @property
    def recovery_micros(self) -> int:
        return self.recovery_minutes * MICROS_PER_MINUTE


@dataclass(frozen=True)
class Breaker:
    """State after a result. ``last_failure`` is in microseconds, None before any failure."""

    state: str = CLOSED
    failures: int = 0
    passes: int = 0
    last_failure: int | None = None

    def at_time(self, at: int, config: BreakerConfig) -> Breaker:
        """The state when it is read: open turns half-open strictly after the recovery time."""
        waited = self.state == OPEN and self.last_failure is not None
        if waited and at - self.last_failure > config.recovery_micros:
            return replace(self, state=HALF_OPEN, passes=0)
        return self

    def record(self, at: int, ok: bool, config: BreakerConfig) -> Breaker:
        """Take one result into account, the state having been read at its time."""
        if not ok:
            failures = self.failures + 1
            state = OPEN if failures >= config.failure_threshold else self.state
            return replace(self, state=state, failures=failures, last_failure=at)
        if self.state == CLOSED:
            return replace(self, failures=0)
        if self.state == HALF_OPEN:
            passes = self.passes + 1
            return replace(self, passes=passes, state=CLOSED if passes >= config.passes_to_close else HALF_OPEN)
        return self


# In a summary, a pass count that the piece has not set.
KEPT = -1


def _label(breaker: Breaker, config: BreakerConfig) -> tuple:
    """What the further course depends on, apart from the time of the last failure."""
    passes = breaker.passes if breaker.state == HALF_OPEN else KEPT
    return breaker.state, min(breaker.failures, config.failure_threshold), passes


def _starts(config: BreakerConfig) -> list[Breaker]:
    """One representative of every state in which a series can be at a cut, open ones aside."""
    top = config.failure_threshold
    closed = [Breaker(CLOSED, f, KEPT) for f in range(top + 1)]
    half = [Breaker(HALF_OPEN, top, p) for p in range(config.passes_to_close)]
    return closed + half


class _Summary:
    """Where a piece leads from each start, fed with its results one by one.

    From an open start only the time of the last failure matters, and only until the
    piece's first failure. Until then a run of passes either stays blocked or recovers; as
    after ``passes_to_close + 1`` unblocked passes all courses agree, the times of the last
    so many passes before the first failure are enough to follow any open start.
    """

    def __init__(self, config: BreakerConfig) -> None:
        self.config = config
        self.tails: list[int] = []
        self.first_failure: int | None = None
        self.courses = {_label(s, config): s for s in _starts(config)}
        self.resets = dict.fromkeys(self.courses, False)
        self.after: dict[tuple, tuple[Breaker, bool]] = {}

    def feed(self, at: int, ok: bool) -> None:
        config = self.config
        if ok and self.first_failure is None:
            self.tails = [*self.tails, at][-(config.passes_to_close + 1) :]
        if not ok and self.first_failure is None:
            # Courses for series that reach this failure in a given state.
            self.first_failure = at
            reached = [*_starts(config), Breaker(OPEN, config.failure_threshold, KEPT)]
            self.after = {_label(s, config): (s, False) for s in reached}
        for label, breaker in self.courses.items():
            self.courses[label], self.resets[label] = self._step(breaker, self.resets[label], at, ok)
        for label, (breaker, reset) in self.after.items():
            self.after[label] = self._step(breaker, reset, at, ok)

    def _step(self, breaker: Breaker, reset: bool, at: int, ok: bool) -> tuple[Breaker, bool]:
        read = breaker.at_time(at, self.config)
        return read.record(at, ok, self.config), reset or (ok and read.state == CLOSED)

    def rows(self) -> dict:
        def flat(label: tuple, end: Breaker, reset: bool, base: int) -> dict:
            return {
                "from_state": label[0],
                "from_failures": label[1],
                "from_passes": label[2],
                "state": end.state,
                "failures": end.failures if reset else end.failures - base,
                "reset": reset,
                "passes": end.passes,
                "last_failure": end.last_failure,
            }

        return {
            "first_failure": self.first_failure,
            "tails": self.tails,
            "courses": [flat(k, v, self.resets[k], k[1]) for k, v in self.courses.items()],
            "after": [flat(k, v, r, k[1]) for k, (v, r) in self.after.items()],
        }


_COURSE = (
    "array<struct<from_state:string,from_failures:int,from_passes:int,state:string,failures:bigint,"
    "reset:boolean,passes:int,last_failure:bigint>>"
)


def _follow(start: Breaker, summary: dict, config: BreakerConfig) -> Breaker:
    """The state at the end of a summarised piece."""

    def apply(at_point: Breaker, courses: list) -> Breaker:
        wanted = _label(at_point, config)
        for c in courses:
            if (c["from_state"], c["from_failures"], c["from_passes"]) == wanted:
                failures = c["failures"] + (0 if c["reset"] else at_point.failures)
                last = c["last_failure"]
                return Breaker(
                    c["state"],
                    int(failures),
                    at_point.passes if c["passes"] == KEPT else int(c["passes"]),
                    at_point.last_failure if last is None or last != last else int(last),
                )
        raise LookupError(f"no course from {wanted}")

    if start.state != OPEN:
        return apply(start, summary["courses"])
    reached = start
    for at in summary["tails"]:
        reached = reached.at_time(int(at), config).record(int(at), True, config)
    first = summary["first_failure"]
    if first is None or first != first:
        return reached
    return apply(reached.at_time(int(first), config), summary["after"])


def breaker_states(
    results: DataFrame,
    config: BreakerConfig | None = None,
    initial: DataFrame | None = None,
    rows_per_piece: int = ROWS_PER_PIECE,
) -> DataFrame:
    """Q05: the breaker of every contract after each of its results.

    ``results`` has contract_id, run_id, at and ok; equal times go by run_id. ``allowed`` is
    whether the breaker let output through when the result came in, ``state`` the state after
    it was recorded, ``notified`` whether it raised an incident. ``initial`` gives states to start from (contract_id, state, failure_count,
    pass_count, last_failure_micros).
    """
    import pandas as pd

    config = config or BreakerConfig()
    key_type = results.schema["contract_id"].dataType.simpleString()
    run_type = results.schema["run_id"].dataType.simpleString()
    at_micros = position(results, "at").cast("long").alias("_micros")
    series = results.select("contract_id", "run_id", "at", "ok")
    cuts = measure(series, ["contract_id"], "at", rows_per_piece)
    rows = in_pieces(series, ["contract_id"], "at", cuts).select("contract_id", PIECE, PIECES, "run_id", "at", at_micros, "ok")

    def in_order(df: DataFrame) -> DataFrame:
        return df.repartition("contract_id", PIECE).sortWithinPartitions("contract_id", PIECE, "at", "run_id")

    def framed(pieces: list[tuple]) -> pd.DataFrame:
        made = pd.DataFrame([{"contract_id": c, PIECE: p, **summary} for c, p, summary in pieces])
        return made.astype({"first_failure": "Int64"})

    def summarise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, summary = None, None
        for batch in batches:
            out = []
            for c, p, at, ok in zip(batch["contract_id"], batch[PIECE], batch["_micros"], batch["ok"]):
                if (c, p) != current:
                    if current is not None:
                        out.append((*current, summary.rows()))
                    current, summary = (c, p), _Summary(config)
                summary.feed(int(at), bool(ok))
            if out:
                yield framed(out)
        if current is not None:
            yield framed([(*current, summary.rows())])

    summaries = in_order(rows.filter(F.col(PIECES).isNotNull())).mapInPandas(
        summarise,
        f"contract_id {key_type}, {PIECE} bigint, first_failure bigint, tails array<bigint>, "
        f"courses {_COURSE}, after {_COURSE}",
    )
    begin = (
        initial
        if initial is not None
        else results.sparkSession.createDataFrame(
            [],
            f"contract_id {key_type}, state string, failure_count bigint, pass_count int, last_failure_micros bigint",
        )
    ).select(
        "contract_id",
        F.col("state").alias("_state"),
        F.col("failure_count").cast("bigint").alias("_failures"),
        F.col("pass_count").cast("int").alias("_passes"),
        F.col("last_failure_micros").cast("bigint").alias("_last"),
    )

    def known(value) -> int | None:
        return None if value is None or value != value else int(value)

    def started(state, failures, passes, last) -> Breaker:
        if not isinstance(state, str):
            return Breaker()
        return Breaker(state, known(failures) or 0, known(passes) or 0, known(last))

    def chain(pieces: pd.DataFrame) -> pd.DataFrame:
        pieces = pieces.sort_values(PIECE)
        first = pieces.iloc[0]
        breaker = started(first["_state"], first["_failures"], first["_passes"], first["_last"])
        out = []
        for piece in pieces.to_dict("records"):
            out.append(
                (piece["contract_id"], piece[PIECE], breaker.state, breaker.failures, breaker.passes, breaker.last_failure)
            )
            breaker = _follow(breaker, piece, config)
        frame = pd.DataFrame(out, columns=["contract_id", PIECE, "_state", "_failures", "_passes", "_last"])
        return frame.astype({"_last": "Int64"})

    given = ["_state", "_failures", "_passes", "_last"]
    whole = rows.filter(F.col(PIECES).isNull())
    if initial is not None:
        whole = whole.join(begin, "contract_id", "left").select(*rows.columns, *given)
    else:
        whole = whole.select(*rows.columns, *[F.lit(None).cast(begin.schema[g].dataType).alias(g) for g in given])
    if cuts.hot is not None:
        # One summary per piece: the chain of a contract is a short group, and the table of
        # starts has at most two rows per ``rows_per_piece`` results.
        starts = (
            summaries.join(begin, "contract_id", "left")
            .groupBy("contract_id")
            .applyInPandas(
                chain,
                f"contract_id {key_type}, {PIECE} bigint, _state string, _failures bigint, _passes int, _last bigint",
            )
        )
        cut = rows.filter(F.col(PIECES).isNotNull())
        on = same_keys(cut, starts, ["contract_id"]) & (cut[PIECE] == starts[PIECE])
        whole = whole.unionByName(cut.join(starts, on, "left").select(*[cut[c] for c in rows.columns], *given))

    def replay(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, breaker = None, Breaker()
        for batch in batches:
            out = []
            columns = ["contract_id", PIECE, "_micros", "ok", "_state", "_failures", "_passes", "_last"]
            for c, p, at, ok, state, failures, passes, last in zip(*[batch[x] for x in columns]):
                if (c, p) != current:
                    current, breaker = (c, p), started(state, failures, passes, last)
                read = breaker.at_time(int(at), config)
                breaker = read.record(int(at), bool(ok), config)
                told = not ok and breaker.failures >= config.failure_threshold
                out.append(
                    (
                        "pass" if ok else "fail",
                        breaker.state,
                        breaker.failures,
                        breaker.passes,
                        read.state != OPEN,
                        told,
                        breaker.last_failure,
                    )
                )
            if out:
                names = ["result", "state", "failure_count", "pass_count", "allowed", "notified"]
                made = pd.DataFrame(out, columns=[*names, "last_failure_micros"], index=batch.index)
                made["last_failure_micros"] = made["last_failure_micros"].astype("Int64")
                yield pd.concat([batch[["contract_id", "run_id", "at"]], made], axis=1)

    at_type = results.schema["at"].dataType.simpleString()
    return in_order(whole).mapInPandas(
        replay,
        f"contract_id {key_type}, run_id {run_type}, at {at_type}, result string, state string, "
        "failure_count bigint, pass_count int, allowed boolean, notified boolean, last_failure_micros bigint",
    )


def latest_states(states: DataFrame) -> DataFrame:
    """The last state of each contract, in the shape ``initial`` takes."""
    kept = ["state", "failure_count", "pass_count", "last_failure_micros"]
    return (
        states.groupBy("contract_id")
        .agg(F.max_by(F.struct(*kept), F.struct("at", "run_id")).alias("_s"))
        .select("contract_id", *[F.col("_s")[c].alias(c) for c in kept])
    )
