"""Per-session tracker state over frame streams, and its batch twins.

A frame stream has one row per session, frame and object: ``session, frame,
obj, matched``. Frames are ordered integers. The batch forms give the same
rows with windows, for whole tables; the stream keeps one bounded state a
session and emits a frame once later frames can no longer retract it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tessera.streaming.folds import folded


@dataclass(frozen=True)
class HotStart:
    """An object unmatched ``unmatched`` times within the first ``delay`` frames after it appears is removed; output waits ``delay`` frames."""

    delay: int = 4
    unmatched: int = 2
    keep_init: int = 0
    keep_min: int = -4
    keep_max: int = 8


def streaks(rows: DataFrame, keys: list[str], order: str, matched: str) -> DataFrame:
    """Consecutive matches up to each row, 0 on a miss: each miss opens a new island."""
    w = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    island = rows.withColumn("__island", F.sum(F.when(F.col(matched), 0).otherwise(1)).over(w))
    within = W.partitionBy(*keys, "__island").orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    return island.withColumn("streak", F.sum(F.when(F.col(matched), 1).otherwise(0)).over(within)).drop("__island")


def confirmed(rows: DataFrame, keys: list[str], order: str, matched: str, needed: int) -> DataFrame:
    """Once a streak reached ``needed`` the object stays confirmed."""
    w = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    return streaks(rows, keys, order, matched).withColumn("confirmed", F.max("streak").over(w) >= needed)


def hot_start_removed(rows: DataFrame, keys: list[str], order: str, matched: str, rule: HotStart = HotStart()) -> DataFrame:
    """``keys, removed_at``: the frame at which an object's misses in its first ``delay`` frames reach the limit."""
    w = W.partitionBy(*keys)
    born = rows.withColumn("__first", F.min(order).over(w))
    early = born.where(F.col(order) < F.col("__first") + rule.delay)
    misses = F.sum(F.when(F.col(matched), 0).otherwise(1)).over(w.orderBy(order).rowsBetween(W.unboundedPreceding, 0))
    return early.withColumn("__m", misses).where(F.col("__m") >= rule.unmatched).groupBy(*keys).agg(F.min(order).alias("removed_at"))


def hot_start_output(rows: DataFrame, keys: list[str], order: str, matched: str, rule: HotStart = HotStart()) -> DataFrame:
    """Rows shown when a frame is emitted ``delay - 1`` frames late: those of objects removed by then are not."""
    removed = hot_start_removed(rows, keys, order, matched, rule)
    both = rows.join(removed, keys, "left")
    return both.where(F.col("removed_at").isNull() | (F.col("removed_at") > F.col(order) + rule.delay - 1)).drop("removed_at")


def keep_alive(rows: DataFrame, keys: list[str], order: str, matched: str, rule: HotStart = HotStart()) -> DataFrame:
    """The counter, up on a match and down on a miss within its limits, and whether it suppresses. An object's rows pass sorted through one task."""

    def step(keep: int | None, _: int, found: list[tuple]) -> tuple[list[tuple], int]:
        out = []
        for (hit,) in found:
            k = rule.keep_init if keep is None else keep
            keep = min(rule.keep_max, k + 1) if hit else max(rule.keep_min, k - 1)
            out.append((keep, keep <= 0))
        return out, keep

    return folded(rows, keys, order, [matched], step, "keep long, suppressed boolean")


def duplicates(pairs: DataFrame, keys: list[str], order: str, born: DataFrame, limit: int, delay: int) -> DataFrame:
    """Later-born objects that overlapped an earlier one in ``limit`` frames within their first ``delay``: ``pairs`` has obj and other."""
    first = born.select(*keys, F.col("obj"), F.col("first").alias("f1"))
    other = born.select(*keys, F.col("obj").alias("other"), F.col("first").alias("f2"))
    aged = pairs.join(first, [*keys, "obj"]).join(other, [*keys, "other"]).where("f2 > f1").where(F.col(order) < F.col("f2") + delay)
    return aged.groupBy(*keys, "other").agg(F.count_distinct(order).alias("n")).where(F.col("n") >= limit).select(*keys, F.col("other").alias("obj"))


def look_ahead(rows: DataFrame, keys: list[str], order: str, needed: int, last: str) -> DataFrame:
    """Shown on a frame only if confirmed ``needed - 1`` frames on, or at the video's last frame."""
    at = F.least(F.col(order) + needed - 1, F.col(last))
    future = rows.select(*keys, F.col(order).alias("__at"), F.col("confirmed").alias("shown"))
    return rows.withColumn("__at", at).join(future, [*keys, "__at"], "left").withColumn("shown", F.coalesce("shown", F.lit(False))).drop("__at")


def visible(rows: DataFrame, hidden: list[DataFrame], keys: list[str]) -> DataFrame:
    """Rows with an area whose key is in none of the hidden sets."""
    out = rows.where("area > 0")
    for ids in hidden:
        out = out.join(ids.select(*keys).distinct(), keys, "left_anti")
    return out


def propagation(actions: DataFrame, session: str, order: str) -> DataFrame:
    """What each propagation action has to do, from the actions since the one before: full, partial with its ids, or fetch."""
    w = W.partitionBy(session).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    turn = F.sum(F.when(F.col("action") == "propagate", 1).otherwise(0)).over(w)
    grouped = actions.withColumn("turn", F.coalesce(turn, F.lit(0)))
    own = F.col("action") != "propagate"
    g = grouped.groupBy(session, "turn").agg(F.max(F.when(~own, F.col(order))).alias("at"), F.max(own & (F.col("action") == "add")).alias("added"), F.sort_array(F.collect_set(F.when(own & (F.col("action") == "refine"), F.col("obj")))).alias("objs"))
    mode = F.when(F.coalesce("added", F.lit(False)), "full").when(F.size("objs") > 0, "partial").otherwise("fetch")
    return g.where(F.col("at").isNotNull()).select(session, F.col("at").alias(order), mode.alias("mode"), F.when(mode == "partial", F.col("objs")).otherwise(F.array().cast("array<bigint>")).alias("objs"))


FRAME = "session long, frame long, obj long, matched boolean"
SHOWN = "session long, frame long, obj long"


class HotStartProcessor(StatefulProcessor):
    """Holds a session's last ``delay`` frames, emits the oldest when full, and all when the end row (obj -1) comes.

    State a session: the buffered frames, and for each living object its first
    frame and misses. Frames of a session must come in order.
    """

    def __init__(self, rule: HotStart):
        self.rule = rule

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.buffer = handle.getMapState("buffer", "frame long", "objs array<bigint>")
        self.objects = handle.getMapState("objects", "obj long", "first long, misses int, removed_at long")

    def _emit(self, session: int, frame: int, now: int) -> list[tuple[int, int, int]]:
        out = []
        for obj in self.buffer.getValue((frame,))[0]:
            removed = self.objects.getValue((obj,))[2]
            if removed < 0 or removed > now:
                out.append((session, frame, obj))
        self.buffer.removeKey((frame,))
        return out

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:  # noqa: N802
        frames = pd.concat(list(rows)).sort_values(["frame", "obj"])
        out: list[tuple[int, int, int]] = []
        for frame, part in frames.groupby("frame"):
            frame, ended = int(frame), bool((part["obj"] < 0).any())
            part = part[part["obj"] >= 0]
            for obj, matched in zip(part["obj"].tolist(), part["matched"].tolist(), strict=True):
                known = self.objects.getValue((obj,)) if self.objects.containsKey((obj,)) else (frame, 0, -1)
                first, misses, removed = known
                if frame < first + self.rule.delay and not matched:
                    misses += 1
                    if misses >= self.rule.unmatched and removed < 0:
                        removed = frame
                self.objects.updateValue((obj,), (first, misses, removed))
            if len(part):
                self.buffer.updateValue((frame,), (part["obj"].tolist(),))
            held = sorted(k[0] for k in self.buffer.keys())
            for old in held:
                if ended or old <= frame - self.rule.delay + 1:
                    out += self._emit(key[0], old, old + self.rule.delay - 1)
            if ended:
                self.buffer.clear()
                self.objects.clear()
        yield pd.DataFrame(out, columns=["session", "frame", "obj"]).astype("int64")

    def close(self) -> None:
        pass


def hot_start_stream(frames: DataFrame, rule: HotStart = HotStart()) -> DataFrame:
    """The delayed output of a frame stream; restart from its checkpoint resumes the state."""
    return frames.groupBy("session").transformWithStateInPandas(HotStartProcessor(rule), SHOWN, "Append", "None")
