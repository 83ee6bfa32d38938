"""The driver loop of the iterative plans.

Each round is one Catalyst plan over ``edges x state``. The round's scalars (change
count, L1 difference, dead-end mass) are attached with ``observe`` so they arrive with
the same action that writes the new state to the checkpoint folder: one action per
round, a lineage that never grows, and a state any executor can re-read after a loss.
Only these scalars reach the driver, never rows.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation

from graphloom.plans.tables import RunTables


@dataclass
class RoundInfo:
    round: int
    metrics: dict
    seconds: float


@dataclass
class LoopTrace:
    rounds: list[RoundInfo] = field(default_factory=list)
    stop_reason: str = ""

    @property
    def count(self) -> int:
        return len(self.rounds)


@contextmanager
def scoped_setting(spark, key: str, value: str) -> Iterator[None]:
    """``key`` set to ``value`` for a while, then as before."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def loop_partitions(spark, partitions: int):
    """Plan the rounds with ``partitions`` shuffle partitions, then restore the setting.

    The prepared graph chose its partition count from its size; the per-vertex aggregation
    of every round uses the same count, so a small graph does not write hundreds of
    near-empty shuffle blocks per task each round, and a large one has tasks of bounded size.
    """
    return scoped_setting(spark, "spark.sql.shuffle.partitions", str(partitions))


class CheckpointStore:
    """Round states as reliable checkpoints (``DataFrame.checkpoint``).

    Lowest fixed cost per round; old states stay in the checkpoint folder until Spark's
    cleaner removes them (``spark.cleaner.referenceTracking.cleanCheckpoints``).
    """

    kind = "checkpoint"

    def write(self, frame: DataFrame, k: int) -> DataFrame:
        return frame.checkpoint(eager=True)

    def finish(self, k: int) -> None:
        pass


class TableStore:
    """Round states as parquet tables in the session's checkpoint folder.

    Compressed and columnar, and bounded: round ``k`` overwrites the table of round
    ``k - 2`` (two in turn), so at most two states are on disk however many
    rounds run. The state of round ``k - 1`` is never touched while round ``k`` reads it.
    With ``keep_all`` (round history is wanted) every round gets its own. With ``buckets`` the tables are
    bucketed by ``key``, as the prepared vertices and edges are: the next round joins them where they lie.
    """

    kind = "table"

    def __init__(self, spark, keep_all: bool = False, buckets: int = 0, key: str = "id", tables: RunTables | None = None):
        self.tables = tables or RunTables(spark, "state")
        self.base = self.tables.root
        self.keep_all, self.buckets, self.key = keep_all, buckets, key

    def name(self, k: int) -> str:
        return f"round-{k}" if self.keep_all else f"state-{k % 2}"

    def write(self, frame: DataFrame, k: int) -> DataFrame:
        return self.tables.save(frame, self.name(k), self.buckets, (self.key,) if self.buckets else ())

    def finish(self, k: int) -> None:
        """Delete all states but what a result of ``k`` rounds reads."""
        if not self.keep_all:
            self.tables.close(keep=(self.name(k),))


def choose_store(spark, keep_all: bool, store: str = "table", buckets: int = 0):
    """``table``: compressed Parquet, at most two states on disk, at every size;
    ``checkpoint``: Spark's checkpoints, for a caller who asks for them."""
    if store == "table":
        return TableStore(spark, keep_all, buckets)
    if store == "checkpoint":
        return CheckpointStore()
    raise ValueError(f"state store must be table or checkpoint, got {store!r}")


def materialize(frame: DataFrame, metrics: dict[str, Column], name: str,
                store=None, k: int = 0) -> tuple[DataFrame, dict]:
    """Write ``frame`` (to the checkpoint folder) and return it with its observed metrics:
    one action computes the state, writes it and brings back the scalars."""
    obs = Observation(name)
    cols = [c.alias(key) for key, c in metrics.items()]
    done = (store or CheckpointStore()).write(frame.observe(obs, *cols), k)
    return done, dict(obs.get)


def iterate(
    state: DataFrame,
    step: Callable[[DataFrame, int, dict], DataFrame],
    metrics: Callable[[int], dict[str, Column]],
    stop: Callable[[int, dict], str | None],
    name: str = "round",
    keep: Callable[[int, DataFrame], None] | None = None,
    initial_metrics: dict | None = None,
    store=None,
    earlier: list[RoundInfo] | None = None,
    done: Callable[[RoundInfo], None] | None = None,
) -> tuple[DataFrame, LoopTrace]:
    """Run ``step`` until ``stop`` returns a reason.

    step(state, round, previous metrics) -> next state (lazy);
    metrics(round) -> named aggregate columns observed on the next state;
    stop(round, metrics) -> None to go on, else the stop reason;
    keep(round, state) -> optional hook that sees each materialized state;
    store -> where states go (``CheckpointStore`` by default, or ``TableStore``);
    earlier -> rounds that are behind ``state`` already, when a run goes on;
    done(round) -> optional hook after a round's state is written.
    """
    trace = LoopTrace(rounds=list(earlier or []))
    last = dict(trace.rounds[-1].metrics if trace.rounds else initial_metrics or {})
    k = trace.count
    while True:
        k += 1
        t0 = time.perf_counter()
        state, last = materialize(step(state, k, last), metrics(k), f"{name}_{k}", store, k)
        trace.rounds.append(RoundInfo(k, last, time.perf_counter() - t0))
        if done is not None:
            done(trace.rounds[-1])
        if keep is not None:
            keep(k, state)
        reason = stop(k, last)
        if reason:
            trace.stop_reason = reason
            if store is not None:
                store.finish(k)
            return state, trace
