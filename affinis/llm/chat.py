"""Chat formatting with minimum-cost role repair.

A conversation is legal if an automaton of turns accepts it: an optional system turn,
then user and assistant in turn. Dynamic programming over the automaton finds the
cheapest way to make it so: a turn is kept, merged into the one before it, given
another role, or preceded by an empty turn. Its step is a matrix of costs from state to
state, so a conversation is cut into segments of a bounded number of turns: segments
are summed up by their matrices, the states between them are chosen, and each segment
is then traced by itself. Many segments are cut and summed up in the same way, until
a conversation is one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.llm.scratch import Scratch
from affinis.operators.ordering import positions

SEGMENT = 512  # turns in one segment, segments in one of the next level
START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {"system": SYSTEM, "user": USER, "assistant": ASSISTANT}
NAMES = {state: role for role, state in ROLES.items()}
LEGAL = {(START, SYSTEM), (START, USER), (SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
ACCEPTED = (USER, ASSISTANT)
FAR = 1e15


@dataclass(frozen=True)
class Costs:
    merge: float = 1.0
    relabel: float = 2.0
    insert: float = 3.0


@dataclass(frozen=True)
class Step:
    """How a turn of some role leads from one state to another: turns inserted first, then what becomes of it."""

    inserted: tuple[int, ...]
    action: str


class Automaton:
    def __init__(self, costs: Costs = Costs()):
        self.costs = costs
        self.fills = {s: self._fills(s) for s in range(4)}
        self.steps = {role: self._steps(role) for role in (SYSTEM, USER, ASSISTANT, None)}
        self.matrices = {role: np.array([[self.steps[role].get((s, t), (FAR, None))[0] for t in range(4)] for s in range(4)]) for role in self.steps}

    def _fills(self, state: int) -> dict[int, tuple[int, ...]]:
        """The fewest empty turns that lead from ``state`` to each state; the first found of equals."""
        found, todo = {state: ()}, [state]
        for here in todo:
            for after in (SYSTEM, USER, ASSISTANT):
                if (here, after) in LEGAL and after not in found:
                    found[after] = (*found[here], after)
                    todo.append(after)
        return found

    def _steps(self, role: int | None) -> dict[tuple[int, int], tuple[float, Step]]:
        best: dict[tuple[int, int], tuple[float, Step]] = {}
        for state, target in product(range(4), (SYSTEM, USER, ASSISTANT)):
            change = 0.0 if role == target else self.costs.relabel
            offers = []
            for via, inserted in self.fills[state].items():
                if (via, target) in LEGAL:
                    offers.append((len(inserted) * self.costs.insert + change, Step(inserted, "keep" if role == target else "relabel")))
            if state == target:  # joins the turn before it
                offers.append((self.costs.merge + change, Step((), "merge" if role == target else "relabel and merge")))
            if offers:
                best[state, target] = min(offers, key=lambda o: (o[0], len(o[1].inserted)))
        return best

    def ending(self) -> np.ndarray:
        """Cost of ending in each state, with the empty turns that takes."""
        return np.array([min(len(f) * self.costs.insert for t, f in self.fills[s].items() if t in ACCEPTED) for s in range(4)])

    def trace(self, roles: list[int | None], state: int, goal: np.ndarray) -> tuple[list[tuple[int, Step]], float]:
        """The cheapest steps from ``state``, where goal[t] is the cost of what follows in state t; ties to the lower state."""
        ahead = [goal]
        for role in reversed(roles):
            ahead.append((self.matrices[role] + ahead[-1][None, :]).min(1))
        total, steps = float(ahead[-1][state]), []
        for i, role in enumerate(roles):
            rest = self.matrices[role][state] + ahead[len(roles) - 1 - i]
            after = int(np.argmin(rest))
            steps.append((after, self.steps[role][state, after][1]))
            state = after
        return steps, total


def summed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Costs of going through both."""
    return (left[:, :, None] + right[None, :, :]).min(1)


def opened(role: int, text: str) -> str:
    return f"<|{NAMES[role]}|>\n{text}"


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, list[dict]]]:
    """The rows of one key, one after another, from sorted batches."""
    key, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            own = tuple(row[k] for k in keys)
            if rows and own != key:
                yield key, rows
                rows = []
            key = own
            rows.append(row)
    if rows:
        yield key, rows


COSTS = "conv_id long, segment long, costs array<double>"
ENTRIES = "conv_id long, segment long, state int, goal array<double>, last boolean, cost double"


def _summed_up(key: str, matrix):
    """One matrix for all rows of a (conv_id, key), in their order; ``matrix`` gives that of a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for (conv, segment), rows in _runs(batches, ["conv_id", key]):
            whole = np.where(np.eye(4, dtype=bool), 0.0, FAR)
            for row in rows:
                whole = summed(whole, matrix(row))
            out.append((conv, segment, whole.ravel().tolist()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int64()), pa.array([r[2] for r in out], pa.list_(pa.float64()))],
            names=["conv_id", "segment", "costs"],
        )

    return run


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state in which the cheapest repair enters each segment of a part, and the one in which it has to leave it.

    The latter as costs of what follows: nothing in that state, no way on from others, as with equal costs
    a segment's own steps could end in another. Rows hold the same of their part: state, goal, whether it is the conversation's last, and the whole
    cost (null for a part that is the whole conversation).
    """
    for (conv, _), rows in _runs(batches, ["conv_id", "part"]):
        costs = np.array([r["costs"] for r in rows]).reshape(-1, 4, 4)
        ahead = np.empty((len(rows) + 1, 4))
        ahead[-1] = rows[0]["goal"]
        for i in range(len(rows) - 1, -1, -1):
            ahead[i] = (costs[i] + ahead[i + 1][None, :]).min(1)
        state, states = rows[0]["state"], []
        total = float(ahead[0][state]) if rows[0]["cost"] is None else rows[0]["cost"]
        for i in range(len(rows)):
            states.append(state)
            state = int(np.argmin(costs[i][state] + ahead[i + 1]))
        goals = [np.where(np.arange(4) == after, 0.0, FAR).tolist() for after in states[1:]] + [rows[0]["goal"]]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([conv] * len(rows), pa.int64()),
                pa.array([r["segment"] for r in rows], pa.int64()),
                pa.array(states, pa.int32()),
                pa.array(goals, pa.list_(pa.float64())),
                pa.array([rows[0]["last"] and i == len(rows) - 1 for i in range(len(rows))]),
                pa.array([total] * len(rows)),
            ],
            names=["conv_id", "segment", "state", "goal", "last", "cost"],
        )


def _entered(matrices: DataFrame, most: int, machine: Automaton, scratch: Scratch) -> DataFrame:
    """Entries of all segments from their matrices; ``most`` is the largest number of a segment.

    Only SEGMENT of them meet in one list, so there are as many levels as the longest conversation needs.
    """
    if most < SEGMENT:
        ending = F.array(*[F.lit(float(c)) for c in machine.ending()])
        parts = matrices.select(
            "*", F.lit(0).alias("part"), F.lit(START).alias("state"), ending.alias("goal"), F.lit(True).alias("last"), F.lit(None).cast("double").alias("cost")
        )
    else:
        cut = scratch.written(matrices, f"matrices_{most}").withColumn("part", F.floor(F.col("segment") / SEGMENT))
        dealt = cut.repartition("conv_id", "part").sortWithinPartitions("conv_id", "part", "segment")
        wholes = dealt.mapInArrow(_summed_up("part", lambda row: np.array(row["costs"]).reshape(4, 4)), COSTS)
        above = _entered(wholes, most // SEGMENT, machine, scratch).withColumnRenamed("segment", "part")
        parts = cut.join(above, ["conv_id", "part"])
    return parts.repartition("conv_id", "part").sortWithinPartitions("conv_id", "part", "segment").mapInArrow(_entries, ENTRIES)


PIECES = "conv_id long, segment long, place int, turn long, role string, action string, cost double, rendered string"


def _pieces(machine: Automaton, closing: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (conv, segment), rows in _runs(batches, ["conv_id", "segment"]):
            state, goal, last, cost = (rows[0][k] for k in ("state", "goal", "last", "cost"))
            steps, _ = machine.trace([ROLES.get(r["role"]) for r in rows], state, np.array(goal))
            out = []

            def add(turn, role, action, text):
                out.append((conv, segment, len(out), turn, NAMES[role], action, cost, text))

            for row, (after, step) in zip(rows, steps, strict=True):
                text = row["text"] or ""
                for role in step.inserted:
                    add(None, role, "insert", (closing if state else "") + opened(role, ""))
                    state = role
                if step.action.endswith("merge"):
                    add(row["turn"], after, step.action, f"\n{text}")
                else:
                    add(row["turn"], after, step.action, (closing if state else "") + opened(after, text))
                state = after
            if last:
                ends = min((f for t, f in machine.fills[state].items() if t in ACCEPTED), key=len)
                for role in ends:
                    add(None, role, "insert", closing + opened(role, ""))
                out[-1] = (*out[-1][:-1], out[-1][-1] + closing)
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=[c.split()[0] for c in PIECES.split(", ")]
            )

    return run


def repaired(turns: DataFrame, costs: Costs = Costs(), closing: str = "<|end|>\n") -> DataFrame:
    """The pieces of each repaired conversation, one for each turn kept, merged or inserted.

    ``turns`` has conv_id, turn, role and text; other columns are ignored. Returns
    conv_id, segment, place, turn, role, action, cost and rendered: the ``rendered``
    of a conversation in the order of (segment, place) are the formatted text, and
    ``cost`` is that of its whole repair. Turns are taken in the order of ``turn``; those
    of one number go by role (system, user, assistant, then any other) and by a digest of
    the text (repeated rows stay turns of their own); turns without a number come last.
    A role that is null or unknown must be relabelled, a null text is empty, and turns
    with a null ``conv_id`` belong to no conversation and give no rows. An empty table
    gives none either. Segments are cut by position, so a conversation of any length or
    of one repeated number is spread over tasks.
    """
    machine, scratch = Automaton(costs), Scratch(turns.sparkSession, "chat")
    rank = F.coalesce(*[F.when(F.col("role") == role, F.lit(state)) for role, state in ROLES.items()], F.lit(len(NAMES) + 1))
    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").filter("conv_id is not null")
    keyed = rows.select(
        "*",
        F.col("turn").isNull().cast("int").alias("unnumbered"),
        F.coalesce("turn", F.lit(0)).alias("number"),
        F.concat(rank.cast("string"), F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)).alias("tie"),
        F.monotonically_increasing_id().alias("row_at"),
    )
    held = scratch.written(keyed, "turns")  # fixes the numbers of equal rows
    at = positions(held, ["unnumbered", "number", "tie", "row_at"], ["conv_id"])
    cut = at.select("conv_id", "turn", "role", "text", "position", F.floor(F.col("position") / SEGMENT).cast("long").alias("segment"))
    placed = scratch.written(cut, "placed")
    scratch.drop("turns")
    most = placed.agg(F.max("segment")).first()[0] or 0

    def dealt(df: DataFrame) -> DataFrame:
        return df.repartition("conv_id", "segment").sortWithinPartitions("conv_id", "segment", "position")

    roles = dealt(placed.select("conv_id", "segment", "position", "role"))
    matrices = roles.mapInArrow(_summed_up("segment", lambda row: machine.matrices[ROLES.get(row["role"])]), COSTS)
    entries = _entered(matrices, most, machine, scratch)
    return dealt(placed.join(entries, ["conv_id", "segment"])).mapInArrow(_pieces(machine, closing), PIECES)
