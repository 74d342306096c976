"""Prefix trie of conversations, measured along its Euler tour.

Each node has an arc in and an arc out. The tour's list of arcs is ranked
(``list_ranking``), and what a subtree holds is the difference of the running
sums at its two arcs, however deep or wide it is. A prefix's key is the XOR of
its turns' keyed hashes, so a long conversation is cut into blocks; a second
hash finds colliding keys, after which other keys are drawn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.operators.rank import global_rank

from .counting import n_words
from .list_ranking import list_positions, running_sums
from .storage import materialize

#: Turns of a conversation, children of a node and member ids that are handled together.
BLOCK = 256
EMPTY = hashlib.sha256().hexdigest()


def numbered_turns(df: DataFrame) -> DataFrame:
    """``conv_id, place, key, words``: each conversation's turns from 1 by turn (null first), then role and text.

    Rows without ``conv_id`` belong to no conversation. Null role or text is
    empty, repeated rows are turns of their own. A turn goes on as a digest; of
    its text only the first 64 characters are sorted, then the digest.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    key = F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    turns = df.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), F.substring(text, 1, 64).alias("head"), key.alias("key"), n_words(text).alias("words"))
    ranked = global_rank(turns, F.asc_nulls_first("turn"), F.asc("role"), F.asc("head"), F.asc("key"), name="place", keys=["conv_id"])
    return ranked.select("conv_id", "place", "key", "words")


def lengths(turns: DataFrame) -> DataFrame:
    return turns.groupBy("conv_id").agg(F.count("*").alias("length"))


def shared_heads(turns: DataFrame, group: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Turns and lengths of conversations that begin as the first of their group of ids does.

    The first h turns, h an unsigned CRC-32 of the id modulo ``most``, come from
    the conversation of id c - c % ``group`` (all, if it has fewer; none, if
    there is none), the rest are the conversation's own after its first h. A
    conversation of which nothing is left has length 0.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    base = F.col("conv_id") - F.col("conv_id") % group
    first = turns.where((F.col("place") < most) & (F.col("conv_id") % group == 0))
    first = first.groupBy(F.col("conv_id").alias("base")).agg(F.sort_array(F.collect_list(F.struct("place", "key", "words"))).alias("first"))
    convs = lengths(turns).withColumn("h", h).withColumn("base", base).join(first, "base", "left")
    head = F.when(F.col("first").isNotNull(), F.slice("first", F.lit(1), F.col("h").cast("int")))
    convs = convs.withColumn("head", head).withColumn("n_head", F.coalesce(F.size("head"), F.lit(0)).cast("long"))
    convs = materialize(convs.select("conv_id", "h", "head", F.when(F.col("head").isNull(), 0).otherwise(F.col("n_head")).cast("long").alias("n_head"), "length"), "heads")
    heads = convs.select("conv_id", F.explode("head").alias("t")).select("conv_id", "t.place", "t.key", "t.words")
    rest = turns.join(convs.select("conv_id", "h", "n_head"), "conv_id").where("place > h").select("conv_id", (F.col("place") - F.col("h") + F.col("n_head")).alias("place"), "key", "words")
    whole = F.col("n_head") + F.greatest(F.col("length") - F.col("h"), F.lit(0))
    return heads.unionAll(rest), convs.select("conv_id", whole.alias("length"))


def prefix_paths(turns: DataFrame, seed: int) -> DataFrame:
    """``conv_id, depth, node, parent, check, words``: the keys of each prefix and of the one before it. A node's key is even."""
    one = turns.select("conv_id", "place", "words", F.floor(F.col("place") / BLOCK).alias("block"), *(F.xxhash64(F.lit(seed + k), "place", "key").alias(f"h{k}") for k in (0, 1)))
    inner = W.partitionBy("conv_id", "block").orderBy("place").rowsBetween(W.unboundedPreceding, 0)
    before = W.partitionBy("conv_id").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    blocks = one.groupBy("conv_id", "block").agg(*(F.bit_xor(f"h{k}").alias(f"h{k}") for k in (0, 1)))
    blocks = blocks.select("conv_id", "block", *(F.bit_xor(f"h{k}").over(before).alias(f"b{k}") for k in (0, 1))).where("b0 is not null")
    whole = one.withColumns({f"x{k}": F.bit_xor(f"h{k}").over(inner) for k in (0, 1)}).join(blocks, ["conv_id", "block"], "left")
    x = [F.col(f"x{k}").bitwiseXOR(F.coalesce(f"b{k}", F.lit(0).cast("long"))) for k in (0, 1)]
    even = lambda c: c.bitwiseAND(F.lit(-2))
    return whole.select("conv_id", F.col("place").alias("depth"), even(x[0]).alias("node"), even(x[0].bitwiseXOR(F.col("h0"))).alias("parent"), x[1].alias("check"), "words")


def trie_nodes(turns: DataFrame, members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Paths, and a row for each distinct prefix: ``node, parent, depth, conv_id, n_convs, words``; the root's key is 0."""
    seed = 11
    while True:
        paths = materialize(prefix_paths(turns, seed), "paths")
        null = F.lit(None).cast("long")
        root = members.select("conv_id", *(F.lit(0).cast("long").alias(c) for c in ("depth", "node")), null.alias("parent"), *(F.lit(0).cast("long").alias(c) for c in ("check", "words")))
        both = paths.unionByName(root)
        nodes = both.groupBy("node").agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), *(f(c).alias(f"{c}{i}") for c in ("depth", "check", "parent") for i, f in enumerate((F.min, F.max))), F.max("words").alias("words"))
        nodes = materialize(nodes, "nodes")
        if nodes.where("depth0 <> depth1 or check0 <> check1 or parent0 <> parent1 or (parent0 is null) <> (node = 0)").isEmpty():
            return paths, nodes.select("node", F.col("parent0").alias("parent"), F.col("depth0").alias("depth"), "conv_id", "n_convs", "words")
        seed += 2


def next_siblings(kids: DataFrame, levels: int = 3) -> DataFrame:
    """``parent, at, node, next``: the child after each of ``parent, at, node`` by ``at``, found in blocks of ``at``, as a parent may have any number."""
    if levels == 1:
        return kids.withColumn("next", F.lead("node").over(W.partitionBy("parent").orderBy("at")))
    kids = kids.withColumn("block", F.floor(F.col("at") / BLOCK))
    firsts = kids.groupBy("parent", F.col("block").alias("at")).agg(F.min_by("node", "at").alias("node"))
    later = next_siblings(firsts, levels - 1).select("parent", F.col("at").alias("block"), F.col("next").alias("later"))
    own = kids.withColumn("next", F.lead("node").over(W.partitionBy("parent", "block").orderBy("at")))
    return own.join(later, ["parent", "block"]).select("parent", "at", "node", F.coalesce("next", "later").alias("next"))


def hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's ids, comma-joined; a node's chunks come one after another and are not held."""
    node, digest = None, None
    for batch in batches:
        nodes, out = [], []
        for key, chunk in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if digest is not None and key == node:
                digest.update(b",")
            else:
                if digest is not None:
                    nodes.append(node)
                    out.append(digest.hexdigest())
                node, digest = key, hashlib.sha256()
            digest.update(chunk.encode())
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(out, pa.string())], names=["node", "ends_sha256"])
    if digest is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.int64()), pa.array([digest.hexdigest()])], names=["node", "ends_sha256"])


def ends_digests(paths: DataFrame, members: DataFrame) -> DataFrame:
    """``node, ends_sha256`` of the nodes at which a conversation ends. Ids are joined in blocks, which one task a node hashes one by one."""
    last = members.where("length > 0").join(paths.select("conv_id", F.col("depth").alias("length"), "node"), ["conv_id", "length"]).select("node", "conv_id")
    ends = last.unionAll(members.where("length = 0").select(F.lit(0).cast("long"), "conv_id"))
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    chunks = ends.groupBy("node", F.floor(F.col("conv_id") / BLOCK).alias("block")).agg(ids.alias("ids"))
    return chunks.repartition("node").sortWithinPartitions("node", "block").select("node", "ids").mapInArrow(hash_ids, "node long, ends_sha256 string")


def measured_trie(turns: DataFrame, members: DataFrame) -> DataFrame:
    """The nodes of ``turns(conv_id, place, key, words)`` and ``members(conv_id, length)``; see ``prefix_trie``."""
    paths, nodes = trie_nodes(turns, members)
    kids = nodes.where("parent is not null").groupBy("parent").agg(F.count("*").alias("n_children"), F.min_by("node", "conv_id").alias("child")).withColumnRenamed("parent", "node")
    siblings = next_siblings(nodes.where("parent is not null").select("parent", F.col("conv_id").alias("at"), "node")).select("node", "next")
    linked = materialize(nodes.join(kids, "node", "left").join(siblings, "node", "left"), "linked")
    out = F.col("node").bitwiseOR(F.lit(1).cast("long"))
    enter = F.struct(F.col("node").alias("id"), F.coalesce("child", out).alias("next"))
    leave = F.struct(out.alias("id"), F.coalesce("next", F.col("parent").bitwiseOR(F.lit(1).cast("long"))).alias("next"))
    arcs = linked.select(F.explode(F.array(enter, leave)).alias("arc"), F.col("conv_id").alias("near"), "depth").select("arc.id", "arc.next", "near", "depth")
    tour = list_positions(arcs).select("pos", F.col("id").bitwiseAND(F.lit(-2)).alias("node"), (F.col("id") % 2 != 0).alias("leaving"))
    zero = F.lit(0).cast("long")
    leaf = F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long")
    worth = linked.select("node", leaf.alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"))
    values = ["n_leaves", "saved_tokens"]
    steps = materialize(tour.join(worth, "node").select("pos", "node", "leaving", *(F.when(F.col("leaving"), zero).otherwise(F.col(v)).alias(v) for v in values), *(F.when(F.col("leaving"), zero).otherwise(F.col(v)).alias(f"own_{v}") for v in values)), "steps")
    sums = running_sums(steps, "pos", values)
    within = sums.groupBy("node").agg(*(F.sum(F.when(F.col("leaving"), F.col(v)).otherwise(F.col(f"own_{v}") - F.col(v))).alias(v) for v in values))
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    rows = linked.join(within, "node").join(ends_digests(paths, members), "node", "left").join(above, "parent", "left")
    return rows.select("conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"), "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"))


def prefix_trie(df: DataFrame) -> DataFrame:
    """The trie of ``conv_id, turn, role, text``: a node for each distinct sequence of first turns (role and text), from the textless root on.

    ``conv_id`` is a node's smallest member, a conversation that begins with
    it, ``parent_conv_id`` that of the node above (null for the root),
    ``n_convs`` its members, ``n_children`` its children; ``n_leaves`` are the
    childless nodes of its subtree and ``saved_tokens`` the words that need not
    be read again there, (n_convs - 1) times the words of each node's last
    text; ``ends_sha256`` is the SHA-256 of the ids of the conversations that
    end there, ascending and comma-joined. Turns sort by ``turn`` (null first),
    role and text; null role or text is empty; rows without ``conv_id`` take no
    part; repeated rows are turns. An empty table has no nodes. Other columns
    don't matter. Any share of the turns may be one conversation's, and any
    share of the nodes one node's children.
    """
    turns = numbered_turns(df)
    return measured_trie(turns, lengths(turns))
