"""Chat formatting in budgeted windows, with built-in functions only.

Prefix sums of turn tokens choose turn-aligned spans: a window takes new turns
while they and what it repeats fit the budget (one turn always fits). It
opens with the conversation's system turn, then repeats the last turns before
it that fit the history budget; only new assistant texts are training targets,
so each is one exactly once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.operators.rank import global_rank

from .storage import materialize

#: Turns among which windows are chosen together; more than a history holds.
BLOCK = 4096

# Fixed values of the template: control strings begin with < or [, which an escaped text never holds.
OPEN, CLOSE, ROLE_END = "[INST]", "</s>", "[/INST]"
ESCAPES = (("\\", "\\\\"), ("<", "\\l"), ("[", "\\b"))


def escape(text: Column) -> Column:
    for plain, coded in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column) -> Column:
    r"""Undoes ``escape``: the coded backslash is set aside first, as a raw < can't occur in an escaped text."""
    text = F.replace(text, F.lit("\\\\"), F.lit("<"))
    text = F.replace(F.replace(text, F.lit("\\l"), F.lit("[l")), F.lit("\\b"), F.lit("[b"))
    text = F.replace(text, F.lit("<"), F.lit("\\"))
    return F.replace(F.replace(text, F.lit("[l"), F.lit("<")), F.lit("[b"), F.lit("["))


def turn_tokens(text: Column) -> Column:
    """A native token estimate: four code points a token, and one for the turn's marks."""
    return (F.ceil(F.char_length(text) / 4) + 1).cast("long")


def render(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), escape(turn["role"]), F.lit(ROLE_END), escape(turn["text"]), F.lit(CLOSE))


def _ordered(df: DataFrame) -> DataFrame:
    """``conv_id, place, role, text, tokens``: each conversation's turns from 1, also where one holds any share of the rows."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = df.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    turns = turns.withColumn("head", F.substring("text", 1, 64)).withColumn("digest", F.md5(F.col("text").cast("binary")))
    ranked = global_rank(turns, F.asc("turn"), F.asc("role"), F.asc("head"), F.asc("digest"), name="place", keys=["conv_id"])
    return ranked.select("conv_id", "place", "role", "text", turn_tokens(F.col("text")).alias("tokens"))


def _windows(turns: DataFrame, budget: int, history: int) -> DataFrame:
    """``conv_id, first, last, back, head`` of each window: its new turns, how many before them it repeats, and whether it opens with the system turn.

    Windows are chosen in blocks of turns, each of which also sees as many
    turns before it as the history can hold; only their tokens are gathered.
    """
    block = max(BLOCK, history)
    of = F.floor((F.col("place") - 1) / block)
    own = turns.select("conv_id", "place", "tokens", of.alias("block"))
    tail = own.where(F.col("place") > (F.col("block") + 1) * block - history).withColumn("block", F.col("block") + 1)
    seen = own.withColumn("own", F.lit(True)).unionByName(tail.withColumn("own", F.lit(False)))
    upto = F.sum("tokens").over(W.partitionBy("conv_id", "block").orderBy("place").rowsBetween(W.unboundedPreceding, 0))
    each = F.struct("place", "tokens", upto.alias("upto"), "own")
    blocks = seen.select("conv_id", "block", each.alias("t")).groupBy("conv_id", "block").agg(F.sort_array(F.collect_list("t")).alias("ts"), F.max(F.when(F.col("t.own"), F.col("t.place"))).alias("end")).where("end is not null")
    system = turns.where("place = 1 and role = 'system'").select(F.col("conv_id").alias("of"), F.col("tokens").alias("head"))
    blocks = blocks.join(system, F.col("conv_id").eqNullSafe(F.col("of")), "left").drop("of")
    spare = F.greatest(F.lit(1).cast("long"), F.lit(budget).cast("long") - F.coalesce("head", F.lit(0)) - history)
    blocks = blocks.withColumn("spare", spare).withColumn("first_seen", F.element_at("ts", 1)["place"])
    none = F.struct(F.lit(0).cast("long").alias("sum"), F.array().cast("array<bigint>").alias("starts"))

    def step(acc: Column, t: Column) -> Column:
        new = (F.size(acc["starts"]) == 0) | (acc["sum"] + t["tokens"] > F.col("spare"))
        return F.when(~t["own"], acc).when(new, F.struct(t["tokens"].alias("sum"), F.concat(acc["starts"], F.array(t["place"])).alias("starts"))).otherwise(F.struct((acc["sum"] + t["tokens"]).alias("sum"), acc["starts"].alias("starts")))

    chosen = blocks.withColumn("starts", F.aggregate("ts", none, step)["starts"])
    chosen = chosen.select("conv_id", "ts", "head", "end", "first_seen", "starts", F.posexplode("starts").alias("i", "first"))
    last = F.coalesce(F.get("starts", F.col("i") + 1) - 1, F.col("end"))
    at = (F.col("first") - F.col("first_seen")).cast("int")  # turns of the block before the window
    before = F.slice("ts", F.greatest(at - history, F.lit(0)) + 1, F.least(at, F.lit(history)))
    full = F.get("ts", at - 1)["upto"]
    back = F.size(F.filter(before, lambda t: ((t["place"] > 1) | F.col("head").isNull()) & (full - t["upto"] + t["tokens"] <= history)))
    return chosen.select("conv_id", "first", last.alias("last"), back.alias("back"), (F.col("head").isNotNull() & (F.col("first") > 1)).cast("int").alias("head"))


def format_chat(df: DataFrame, budget: int = 2048, history: int = 512) -> DataFrame:
    """``conv_id, window_id, formatted, n_repeated, loss`` from ``conv_id, turn, role, text``.

    ``loss`` lists (start, length) in code points of ``formatted``, the new
    assistant texts as they stand there, escaped. ``n_repeated`` turns at the
    window's head are repeats; ``window_id`` is the place of its first new
    turn, from 0. Turns sort by ``turn``, then role, the text's first 64
    characters and its digest; null role and text are empty, a null ``conv_id``
    is a conversation; repeated rows are turns of their own. No conversation is
    gathered: turns are numbered by range, windows chosen in blocks of BLOCK
    turns, at whose ends a window ends too, and only a window's turns, within
    its budget, meet in one row. An empty table has no windows.
    """
    turns = materialize(_ordered(df), "turns")
    windows = materialize(_windows(turns, budget, history), "windows")
    places = F.concat(F.when(F.col("head") > 0, F.array(F.lit(1).cast("long"))).otherwise(F.array().cast("array<bigint>")), F.sequence(F.col("first") - F.col("back"), F.col("last")))
    shown = windows.select(F.col("conv_id").alias("of"), "first", (F.col("head") + F.col("back")).alias("n_repeated"), F.explode(places).alias("at"))
    rows = turns.join(shown, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("place") == F.col("at")))
    part = render({"role": F.col("role"), "text": F.col("text")})
    rows = rows.select("conv_id", "first", "n_repeated", "place", part.alias("part"), F.char_length(escape(F.col("role"))).alias("role_chars"), F.char_length(escape(F.col("text"))).alias("length"), ((F.col("place") > F.col("first") - 1) & (F.col("role") == "assistant")).alias("target"))
    chars = F.sum(F.char_length("part")).over(W.partitionBy("conv_id", "first").orderBy("place").rowsBetween(W.unboundedPreceding, 0)).cast("int")
    begin = chars - F.char_length("part") + len(OPEN + ROLE_END) + F.col("role_chars")
    rows = rows.withColumn("start", begin)
    loss = F.sort_array(F.collect_list(F.when(F.col("target"), F.struct("start", "length"))))
    parts = F.sort_array(F.collect_list(F.struct("place", "part")))
    out = rows.groupBy("conv_id", "first").agg(F.array_join(F.transform(parts, lambda p: p["part"]), "").alias("formatted"), F.max("n_repeated").alias("n_repeated"), loss.alias("loss"))
    return out.select("conv_id", (F.col("first") - 1).alias("window_id"), "formatted", "n_repeated", "loss")


def read_chat(windows: DataFrame) -> DataFrame:
    """One row a conversation, parsed from the formatted windows alone: ``conv_id, turns (role, text), targets, formatted_chars``.

    ``turns`` are the new turns in order; ``targets`` the unescaped texts under
    the loss mask, in order.
    """
    parts = F.filter(F.split("formatted", CLOSE), lambda p: p != "")
    parsed = F.transform(parts, lambda p: F.struct(
        unescape(F.substring_index(F.substr(p, F.lit(len(OPEN) + 1)), ROLE_END, 1)).alias("role"),
        unescape(F.substr(p, F.instr(p, F.lit(ROLE_END)) + len(ROLE_END))).alias("text")))
    fresh = F.slice(parsed, F.col("n_repeated") + 1, F.greatest(F.size(parsed) - F.col("n_repeated"), F.lit(0)))
    targets = F.transform("loss", lambda s: unescape(F.substr(F.col("formatted"), s["start"] + 1, s["length"])))
    window = F.struct("window_id", fresh.alias("turns"), targets.alias("targets"), F.char_length("formatted").alias("chars"))
    conv = windows.select("conv_id", window.alias("w")).groupBy("conv_id").agg(F.sort_array(F.collect_list("w")).alias("ws"))
    return conv.select("conv_id", F.flatten(F.col("ws.turns")).alias("turns"), F.flatten(F.col("ws.targets")).alias("targets"), F.aggregate("ws", F.lit(0).cast("long"), lambda a, w: a + w["chars"]).alias("formatted_chars"))
