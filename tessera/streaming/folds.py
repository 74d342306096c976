"""Rules that carry state from frame to frame, once for whole tables and once as keyed stream state.

A rule sees one frame of a session at a time, with what it knows of each
object, and gives the frame's answers and what is known after it. In a table,
sessions are dealt by key and sorted, and one frame is held at a time; on a
stream the same rule runs on a state store. Rows of a frame count by object; a
stream brings the frames of a session in order, each whole in one batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ARROW = {"long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}


def folded(rows: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str], step: Callable, answers: str) -> DataFrame:
    """``keys, order`` and ``answers`` (names and types) from ``step(state, at, rows)``, which gets a key's rows of equal ``order`` and returns answers and state.

    The state is None where a key begins. Keys may be null. A key's rows come
    sorted through one task, in batches; only the state and one ``order``'s rows are held.
    """
    names, n = [a.split()[0] for a in answers.split(", ")], len(keys)
    kinds = [ARROW[a.split()[1]] for a in answers.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, at, group, state, out, types = None, None, [], None, [], []

        def close() -> None:
            nonlocal state, group
            if group:
                found, state = step(state, at, group)
                out.extend((*key, at, *a) for a in found)
                group = []

        def batch() -> pa.RecordBatch:
            nonlocal out
            done, out = out, []
            values = list(zip(*done, strict=True)) if done else [[] for _ in range(n + 1 + len(names))]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, [*types, *kinds], strict=True)], names=[*keys, order, *names])

        for b in batches:
            types = [b.schema.field(i).type for i in range(n + 1)]
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if key != row[:n] or at != row[n]:
                    close()
                    if key != row[:n]:
                        key, state = row[:n], None
                    at = row[n]
                group.append(row[n + 1 :])
            yield batch()
        if types:
            close()
            yield batch()

    kept = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in (*keys, order))
    dealt = rows.select(*keys, order, *columns).repartition(*keys).sortWithinPartitions(*keys, order, *columns[:1])
    return dealt.mapInArrow(run, f"{kept}, {answers}")


@dataclass(frozen=True)
class RecentOcclusion:
    """Of objects that overlap, the one occluded more recently is suppressed, if the other was occluded before at all.

    A row is an object of a frame: whether nothing of it is seen, whether it
    was taken out by the hot start (it then counts as occluded always), and the
    objects it overlaps. An object that is occluded or suppressed has the frame
    as its last; one that a frame lacks is forgotten.
    """

    reverse: bool = False
    always: int = 100_000

    columns = ("obj", "occluded", "removed", "foes")
    row = "session long, frame long, obj long, occluded boolean, removed boolean, foes array<bigint>"
    answers = "obj long, suppressed boolean, last_occluded long"
    known = "last long"

    def step(self, state: dict[int, tuple] | None, at: int, rows: list[tuple]) -> tuple[list[tuple], dict[int, tuple]]:
        state = state or {}
        last = {obj: state[obj][0] if obj in state else (self.always if removed else -1) for obj, _, removed, _ in rows}
        later = (lambda a, b: a < b) if self.reverse else (lambda a, b: a > b)
        out, now = [], {}
        for obj, occluded, _, foes in rows:
            gone = any(foe in last and last[foe] > -1 and later(last[obj], last[foe]) for foe in foes or () if foe != obj)
            now[obj] = (at if occluded or gone else last[obj],)
            out.append((obj, gone, now[obj][0]))
        return out, now


@dataclass(frozen=True)
class Reconditioning:
    """Stored boxes are renewed on every n-th frame, or when a sure detection has left the box stored for its object.

    A row is an object's detection in a frame: its box, its score, and the
    object's own score. One mismatch, an IoU below ``iou`` at a score of
    ``score`` or more, renews all objects of the frame whose own score is above
    ``sure``. ``age`` counts the object's frames since its box was stored.
    Where all boxes have one ``area``, it is given: read off corners it is
    rounded, and an IoU at the threshold may fall below it.
    """

    every: int = 16
    iou: float = 0.5
    score: float = 0.8
    sure: float = 0.8
    area: float | None = None

    columns = ("obj", "x0", "y0", "x1", "y1", "score", "own_score")
    row = "session long, frame long, obj long, x0 double, y0 double, x1 double, y1 double, score double, own_score double"
    answers = "obj long, mismatched boolean, reconditioned boolean, age long"
    known = "x0 double, y0 double, x1 double, y1 double, age long"

    def step(self, state: dict[int, tuple] | None, at: int, rows: list[tuple]) -> tuple[list[tuple], dict[int, tuple]]:
        now = dict(state or {})
        off = {obj: obj in now and score >= self.score and overlap(now[obj], box, self.area) < self.iou for obj, *box, score, _ in rows}
        due = any(off.values()) or (self.every > 0 and at % self.every == 0)
        out = []
        for obj, *box, _, own in rows:
            new = due and obj in now and own > self.sure
            now[obj] = (*box, 0) if new or obj not in now else (*now[obj][:4], now[obj][4] + 1)
            out.append((obj, off[obj], new, now[obj][4]))
        return out, now


def overlap(a: Sequence[float], b: Sequence[float], area: float | None = None) -> float:
    inter = max(0.0, min(a[2], b[2]) - max(a[0], b[0])) * max(0.0, min(a[3], b[3]) - max(a[1], b[1]))
    both = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) if area is None else 2 * area
    union = both - inter
    return inter / union if union > 0 else 0.0


def rule_table(rows: DataFrame, rule: RecentOcclusion | Reconditioning) -> DataFrame:
    return folded(rows, ["session"], "frame", rule.columns, rule.step, rule.answers)


class FrameProcessor(StatefulProcessor):
    """A rule on keyed state: what is known of each of a session's objects."""

    def __init__(self, rule: RecentOcclusion | Reconditioning):
        self.rule = rule

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.objects = handle.getMapState("objects", "obj long", self.rule.known)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        frames = pd.concat(list(rows)).sort_values(["frame", "obj"])
        state, out = {k[0]: tuple(v) for k, v in self.objects.iterator()}, []
        for at, part in frames.groupby("frame"):
            columns = ([x.tolist() if hasattr(x, "tolist") else x for x in part[c].tolist()] for c in self.rule.columns)
            found, state = self.rule.step(state, int(at), list(zip(*columns, strict=True)))
            out += [(key[0], int(at), *a) for a in found]
        self.objects.clear()
        for obj, value in state.items():
            self.objects.updateValue((obj,), value)
        yield pd.DataFrame(out, columns=["session", "frame", *(a.split()[0] for a in self.rule.answers.split(", "))])

    def close(self) -> None:
        pass


def rule_stream(frames: DataFrame, rule: RecentOcclusion | Reconditioning) -> DataFrame:
    """The rule's answers on a stream of its rows; a restart from the checkpoint goes on with what was known."""
    return frames.groupBy("session").transformWithStateInPandas(FrameProcessor(rule), f"session long, frame long, {rule.answers}", "Append", "None")
