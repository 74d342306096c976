"""Lifecycle of tracking sessions: started, prompted, reset, closed, or given up after a time without requests.

A request is a row ``session, seq, at, action, obj``; requests of a session
count by ``at``, then ``seq``. ``start`` opens a session, or opens it anew;
``add_prompt`` adds a prompt and its object, ``remove_object`` takes an object
out (one that isn't there is no error), ``reset`` leaves an open session
without prompts and objects, ``propagate`` changes nothing; ``close`` succeeds
however often it comes. Any other request to a session that isn't open, and
any unknown action, fails. A session that gets no request for longer than
``ttl`` is given up: a row of its own with action ``expired``, no ``seq`` and
the time at which its time ran out. A null session is a session; a null
``obj`` stands for no object.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

REQUEST = "session long, seq long, at timestamp, action string, obj long"
ANSWER = "session long, seq long, at timestamp, action string, ok boolean, lifetime long, prompts long, objects long"
ACTIONS = ("start", "add_prompt", "remove_object", "propagate", "reset", "close")


def micros(at: str | Column) -> Column:
    return F.unix_micros(at)


def session_answers(requests: DataFrame, ttl: timedelta) -> DataFrame:
    """Each request with its outcome and what the session holds after it, and the sessions given up by the table's last request.

    Windows over a session's requests, in its order; nothing is gathered. What
    counts as open follows from what lies since the last ``start``: a ``close``
    before the request, or a gap above ``ttl``.
    """
    limit = int(ttl.total_seconds() * 1e6)
    running = lambda *keys: W.partitionBy(*keys).orderBy("at", "seq").rowsBetween(W.unboundedPreceding, 0)
    life = ["session", "lifetime"]
    rows = requests.withColumn("lifetime", F.sum(F.when(F.col("action") == "start", 1).otherwise(0)).over(running("session")).cast("long"))
    in_order = W.partitionBy(*life).orderBy("at", "seq")
    gone = (F.lag("action").over(in_order) == "close") | (micros("at") - F.lag(micros("at")).over(in_order) > limit)
    rows = rows.withColumn("gone", F.coalesce(gone, F.lit(False)))
    rows = rows.withColumn("open", (F.col("lifetime") > 0) & ~F.max("gone").over(running(*life)))
    rows = rows.withColumn("next_at", F.lead("at").over(W.partitionBy("session").orderBy("at", "seq")))
    # Objects and prompts since the last start or reset, of open sessions' requests alone.
    rows = rows.withColumn("turn", F.sum(F.when(F.col("open") & (F.col("action") == "reset"), 1).otherwise(0)).over(running(*life)))
    there = F.when(F.col("action") == "add_prompt", 1).when(F.col("action") == "remove_object", 0)
    touches = F.col("open") & F.col("obj").isNotNull() & there.isNotNull()
    before = F.lag(F.when(touches, there)).over(W.partitionBy(*life, "turn", "obj", touches).orderBy("at", "seq"))
    rows = rows.withColumn("more", F.when(touches, there - F.coalesce(before, F.lit(0))).otherwise(0))
    held = F.col("open") & (F.col("action") != "close")
    of_turn = running(*life, "turn")
    rows = rows.withColumn("prompts", F.when(held, F.sum(F.when(F.col("open") & (F.col("action") == "add_prompt"), 1).otherwise(0)).over(of_turn)).otherwise(0).cast("long"))
    rows = rows.withColumn("objects", F.when(held, F.sum("more").over(of_turn)).otherwise(0).cast("long"))
    ok = F.col("action").isin("start", "close") | (F.col("open") & F.col("action").isin(*ACTIONS))
    answers = rows.select("session", "seq", "at", "action", F.coalesce(ok, F.lit(False)).alias("ok"), F.when(F.col("open"), F.col("lifetime")).alias("lifetime"), "prompts", "objects")
    last = F.broadcast(requests.agg(F.max("at").alias("end")))
    given_up = rows.where(F.col("open") & (F.coalesce("action", F.lit("")) != "close")).crossJoin(last).where(micros(F.coalesce("next_at", "end")) - micros("at") > limit)
    nothing = F.lit(0).cast("long")
    expired = given_up.select("session", F.lit(None).cast("long").alias("seq"), F.timestamp_micros(micros("at") + limit).alias("at"), F.lit("expired").alias("action"), F.lit(True).alias("ok"), "lifetime", nothing.alias("prompts"), nothing.alias("objects"))
    return answers.unionByName(expired)


class SessionProcessor(StatefulProcessor):
    """One open session a key: its lifetime, last request and prompts, a map of its objects, and a timer that gives it up."""

    def __init__(self, ttl: timedelta):
        self.ttl = int(ttl.total_seconds() * 1e3)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.session = handle.getValueState("session", "lifetime long, open boolean, last long, prompts long")
        self.objects = handle.getMapState("objects", "obj long", "there boolean")

    def _state(self) -> tuple:
        return self.session.get() if self.session.exists() else (0, False, 0, 0)

    def _expire(self, key: int | None, state: tuple) -> tuple[tuple, tuple]:
        """The row of a session given up, and its state: only the number of its lifetimes stays."""
        self.objects.clear()
        at = pd.Timestamp(state[2], unit="us") + pd.Timedelta(milliseconds=self.ttl)
        return (key, None, at, "expired", True, state[0], 0, 0), (state[0], False, 0, 0)

    def _answer(self, key: int | None, row: tuple, state: tuple) -> tuple[tuple, tuple]:
        seq, at, action, obj = row
        life, is_open, last, prompts = state
        now = at.value // 1000
        if action == "start":
            life, is_open, prompts = life + 1, True, 0
            self.objects.clear()
        ok = action in ("start", "close") or (is_open and action in ACTIONS)
        of = life if is_open else None
        if is_open:
            if action == "add_prompt":
                prompts += 1
                if obj is not None:
                    self.objects.updateValue((obj,), (True,))
            elif action == "remove_object" and obj is not None:
                self.objects.removeKey((obj,))
            elif action in ("reset", "close"):
                prompts = 0
                self.objects.clear()
            is_open, last = action != "close", now
        n = sum(1 for _ in self.objects.keys()) if is_open else 0
        return (key, seq, at, action, ok, of, prompts if is_open else 0, n), (life, is_open, last, prompts)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        requests = pd.concat(list(rows)).sort_values(["at", "seq"])
        state, out = self._state(), []
        none = lambda x: None if pd.isna(x) else int(x)
        for seq, at, action, obj in zip(requests["seq"], requests["at"], requests["action"], requests["obj"], strict=True):
            if state[1] and at.value // 1000 - state[2] > self.ttl * 1000:
                row, state = self._expire(key[0], state)
                out.append(row)
            row, state = self._answer(key[0], (none(seq), at, action, none(obj)), state)
            out.append(row)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if state[1]:
            self.handle.registerTimer(state[2] // 1000 + self.ttl)
        self.session.update(state)
        yield _answers(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        state, out = self._state(), []
        if state[1]:
            row, state = self._expire(key[0], state)
            out.append(row)
            self.session.update(state)
        yield _answers(out)

    def close(self) -> None:
        pass


def _answers(rows: list[tuple]) -> pd.DataFrame:
    df = pd.DataFrame(rows, columns=[c.split()[0] for c in ANSWER.split(", ")])
    return df.astype({"session": "Int64", "seq": "Int64", "at": "datetime64[us]", "ok": bool, "lifetime": "Int64", "prompts": "int64", "objects": "int64"})


def session_stream(requests: DataFrame, ttl: timedelta, late: str = "0 seconds") -> DataFrame:
    """The answers of a request stream, sessions given up as the watermark passes their time; a restart from its checkpoint goes on with the open ones."""
    keyed = requests.withWatermark("at", late).groupBy("session")
    return keyed.transformWithStateInPandas(SessionProcessor(ttl), ANSWER, "Append", "EventTime")
