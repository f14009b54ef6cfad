"""Prefix trie of conversations, with subtree totals by time-forward processing.

A node is a distinct sequence of first turns (role, text); its members are the conversations that start
with it, and its id is its smallest member and its depth.

1. A prefix is known by its depth and two 64-bit hashes, each the exclusive or of the hashes of its turns
   with their positions, so prefixes are running totals and long conversations can be split. Prefixes with
   equal depth and 128 bits count as equal.
2. Nodes are aggregates by prefix; the members of a hot prefix are combined before the shuffle.
3. The trie is cut into shards. A node's weight is the number of turns of its members behind it, which
   bounds its subtree; its tier is the logarithm of that to the base 2 ** TIER_BITS. Neighbouring nodes of
   one tier are a shard, so on one level a shard has at most 2 ** TIER_BITS nodes.
4. Tier by tier, each shard's nodes are sorted externally, deepest level first. A node takes the totals of its
   children from a priority queue, which keeps what exceeds its memory in sorted runs on disk, and sends its
   own on to its parent. What shard roots send across is added up by parent and enters the parents' tier.

Defined cases: as in `turns`, but rows without a conversation id are ignored; a conversation without turns
is a member of the root only; equal conversations end in one node; other columns are ignored; without
conversations there are no nodes, not even the root. The shard of a conversation of very many turns
that no other shares is a chain of as many nodes: one task works it off in bounded memory.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import os
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dnsight.llm.turns import BLOCK, in_order, running
from dnsight.sources.storage import stage

#: Logarithm of the weights that make a tier.
TIER_BITS = 12
#: Messages of a priority queue that are held in memory.
HELD = 1 << 16
#: Conversation ids that are joined to one text before the digest of a node's ends.
IDS = 4096
#: Turns that a conversation takes from another one, at most, and conversations that share their first turns.
SHARED_TURNS, FAMILY = 8, 5


def hashed_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place, p, q, size: two hashes of each turn's role and text, and the UTF-8 bytes of the text."""
    turns = in_order(conversations.filter("conv_id is not null"))
    return turns.select(
        "conv_id", "place", F.xxhash64("role", "text").alias("p"),
        F.xxhash64(F.lit(1), "text", "role").alias("q"), F.octet_length("text").cast("long").alias("size"),
    )


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, depth from 1, p, q, size) and lengths (conv_id, length) of the rebuilt conversations.

    Conversation c starts with the first h turns of conversation c - c % FAMILY and goes on with its own
    turns after its first h; h is crc32 of c as text modulo SHARED_TURNS + 1.
    """
    own = turns.groupBy("conv_id").agg(F.count("*").alias("own"))
    lengths = own.select(
        "conv_id", "own", F.expr(f"conv_id - conv_id % {FAMILY}").alias("base"),
        F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(SHARED_TURNS + 1)).alias("h"),
    )
    lengths = stage(
        lengths.join(own.toDF("base", "__theirs"), "base", "left")
        .withColumn("taken", F.least("h", F.coalesce("__theirs", F.lit(0).cast("long")))).drop("__theirs")
    )
    firsts = turns.filter(F.col("place") < SHARED_TURNS).withColumnRenamed("conv_id", "base")
    taken = firsts.join(lengths.filter("taken > 0"), "base").filter("place < taken").select(
        "conv_id", (F.col("place") + 1).alias("depth"), "p", "q", "size"
    )
    kept = turns.join(lengths.select("conv_id", "h", "taken"), "conv_id").filter("place >= h").select(
        "conv_id", (F.col("taken") + F.col("place") - F.col("h") + 1).alias("depth"), "p", "q", "size"
    )
    length = F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))
    return taken.unionByName(kept), lengths.select("conv_id", length.cast("long").alias("length"))


def prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, depth, x, y, size of every prefix; (depth, x, y) is the same for equal ones."""
    salted = turns.select(
        "conv_id", "depth", F.xxhash64("depth", "p", "q").alias("a"), F.xxhash64("q", "depth", "p").alias("b"), "size"
    )
    before = running(
        salted, F.expr(f"depth div {BLOCK}"), [F.col("depth")],
        {"x": (F.bit_xor, F.col("a")), "y": (F.bit_xor, F.col("b"))}, lambda m, n: m.bitwiseXOR(n),
    )
    return before.select(
        "conv_id", "depth", F.col("x").bitwiseXOR(F.col("a")).alias("x"), F.col("y").bitwiseXOR(F.col("b")).alias("y"), "size"
    )


def trie(turns: DataFrame, lengths: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes (conv_id, depth, parent_conv_id, n_convs, saved, tier, shard) and members (member, conv_id, depth, length).

    `saved` is what the node saves itself, `shard` the topmost node of its shard.
    """
    rows = stage(prefixes(turns).join(lengths, "conv_id"))
    nodes = stage(
        rows.groupBy("depth", "x", "y").agg(
            F.min("conv_id").alias("node"), F.count("*").alias("n_convs"), F.max("size").alias("size"),
            F.sum(F.col("length") - F.col("depth")).alias("weight"),
        )
    )
    named = rows.join(nodes.select("depth", "x", "y", "node", "weight"), ["depth", "x", "y"])
    # All conversations are members of the root, so these rows need no join.
    whole = lengths.agg(
        F.min("conv_id").alias("node"), F.count("*").alias("n_convs"), F.lit(0).cast("long").alias("size"),
        F.sum("length").alias("weight"),
    ).filter("n_convs > 0")
    whole = stage(whole)
    found = whole.collect()
    root = found[0] if found else {"node": None, "weight": 0}
    zero = F.lit(0).cast("long")
    top = lengths.select(
        "conv_id", zero.alias("depth"), "length", F.lit(root["node"]).cast("long").alias("node"),
        F.lit(root["weight"]).cast("long").alias("weight"),
    )
    tier = F.expr(f"cast((length(bin(weight)) - 1) div {TIER_BITS} as int)")
    members = stage(
        named.select("conv_id", "depth", "length", "node", "weight").unionByName(top).withColumn("tier", tier).drop("weight")
    )
    above = members.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("node").alias("parent_conv_id"))
    tops = members.groupBy("conv_id", "tier").agg(F.min(F.struct("depth", "node")).alias("shard"))
    all_nodes = nodes.unionByName(whole.withColumns({"depth": zero, "x": zero, "y": zero}))
    own = all_nodes.select(
        F.col("node").alias("conv_id"), "depth", "n_convs", (F.col("size") * (F.col("n_convs") - 1)).alias("saved"),
        tier.alias("tier"),
    )
    placed = own.join(above, ["conv_id", "depth"], "left").join(tops, ["conv_id", "tier"])
    members = members.select(F.col("conv_id").alias("member"), F.col("node").alias("conv_id"), "depth", "length")
    return stage(placed), members


class SpillingQueue:
    """A priority queue of equally long rows of integers; what exceeds `held` rows is kept on disk in sorted runs."""

    def __init__(self, held: int = HELD):
        self.held, self.heap, self.runs = held, [], []

    def _run(self, file, count: int, width: int):
        """The rows of a run, a piece at a time."""
        with file:
            file.seek(0)
            piece = max(1, self.held // 16)
            for left in range(count, 0, -piece):
                data = file.read(8 * width * min(left, piece))
                yield from map(tuple, np.frombuffer(data, np.int64).reshape(-1, width).tolist())

    def push(self, row: tuple) -> None:
        heapq.heappush(self.heap, row)
        if len(self.heap) > self.held:
            # Spark names its own local folders to its workers; the file has no name and ends with the task.
            file = tempfile.TemporaryFile(dir=os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None)
            rows = np.array(sorted(self.heap), np.int64)
            file.write(rows.tobytes())
            self.heap = []
            run = self._run(file, *rows.shape)
            self.runs.append([next(run), run])

    def _least(self):
        best = min((run[0] for run in self.runs), default=None)
        if self.heap and (best is None or self.heap[0] <= best):
            return self.heap[0], None
        return best, next((run for run in self.runs if run[0] == best), None)

    def pop_equal(self, width: int, key: tuple):
        """All rows, least first, whose first `width` numbers are the key."""
        while self.heap or self.runs:
            row, run = self._least()
            if row[:width] != key:
                return
            if run is None:
                heapq.heappop(self.heap)
            else:
                run[0] = next(run[1], None)
                if run[0] is None:
                    self.runs.remove(run)
            yield row

    def __len__(self):
        return len(self.heap) + len(self.runs)


def time_forward(rows, held: int = HELD):
    """Totals of shards whose nodes come deepest level first: the nodes with children, leaves and saved bytes.

    Rows: shard, depth, conv_id, parent, whether the node is its shard's root, and children, leaves and saved
    bytes known so far (those of the node itself and of other shards below it).
    """
    queue = SpillingQueue(held)
    for _, shard in itertools.groupby(rows, key=lambda row: row[0]):
        for _, depth, node, parent, root, children, leaves, saved in shard:
            for _, _, more_leaves, more_saved in queue.pop_equal(2, (-depth, node)):
                children, leaves, saved = children + 1, leaves + more_leaves, saved + more_saved
            if not children:
                leaves = 1
            if not root:
                queue.push((1 - depth, parent, leaves, saved))
            yield depth, node, parent, root, children, leaves, saved
        if len(queue):
            raise ValueError("a message found no receiver")


def _processed(batches):
    names = ["depth", "conv_id", "parent_conv_id", "root", "n_children", "n_leaves", "saved_tokens"]

    def rows():
        for batch in batches:
            columns = {c: batch.column(c).to_pylist() for c in ("depth", "conv_id", "parent_conv_id", "children", "leaves", "saved")}
            shards = [(s["depth"], s["node"]) for s in batch.column("shard").to_pylist()]
            for shard, *row in zip(shards, *columns.values()):
                depth, node, parent, children, leaves, saved = row
                yield shard, depth, node, parent, shard == (depth, node), children, leaves, saved

    done = time_forward(rows())
    while part := list(itertools.islice(done, 1 << 15)):
        kinds = [pa.bool_() if n == "root" else pa.int64() for n in names]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*part), kinds)], names)


def subtree_totals(nodes: DataFrame) -> DataFrame:
    """conv_id, depth, n_children, n_leaves, saved_tokens of every node, shard by shard, lower tiers first."""
    highest = nodes.agg(F.max("tier")).first()[0]
    done, sent = [], []
    kinds = "depth long, conv_id long, parent_conv_id long, root boolean, n_children long, n_leaves long, saved_tokens long"
    for tier in range(-1 if highest is None else highest + 1):
        rows = nodes.filter(F.col("tier") == tier)
        known = [F.lit(0).cast("long").alias(c) for c in ("children", "leaves")]
        if sent:
            received = sent[0]
            for more in sent[1:]:
                received = received.unionByName(more)
            received = received.groupBy("conv_id", "depth").agg(*[F.sum(c).alias(c) for c in ("children", "leaves", "below")])
            rows = rows.join(received, ["conv_id", "depth"], "left")
            known = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("children", "leaves")]
            rows = rows.withColumn("saved", F.col("saved") + F.coalesce("below", F.lit(0).cast("long")))
        ready = rows.select("shard", "depth", "conv_id", "parent_conv_id", *known, "saved")
        finished = stage(
            ready.repartition("shard").sortWithinPartitions("shard", F.desc("depth"), "conv_id").mapInArrow(_processed, kinds)
        )
        done.append(finished)
        sent.append(
            finished.filter("root and parent_conv_id is not null")
            .groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth"))
            .agg(F.count("*").alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("below"))
        )
    if not done:
        return nodes.sparkSession.createDataFrame([], kinds).drop("root", "parent_conv_id")
    whole = done[0]
    for more in done[1:]:
        whole = whole.unionByName(more)
    return whole.drop("root", "parent_conv_id")


def _digested(batches):
    names = ["conv_id", "depth", "ends_sha256"]
    current, state, done = None, None, []
    for batch in batches:
        for row in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "depth", "ids")]):
            if row[:2] != current:
                if state is not None:
                    done.append((*current, state.hexdigest()))
                current, state = row[:2], hashlib.sha256(row[2].encode())
            else:
                state.update(f",{row[2]}".encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names)
            done = []
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([c]) for c in (*current, state.hexdigest())], names)


def ends(members: DataFrame) -> DataFrame:
    """conv_id, depth, ends_sha256 of each node where conversations end; a task holds IDS of their ids at most."""
    chunk = F.expr(f"member div {IDS}").alias("chunk")
    joined = F.array_join(F.array_sort(F.collect_list("member")).cast("array<string>"), ",").alias("ids")
    chunks = members.filter("depth = length").groupBy("conv_id", "depth", chunk).agg(joined)
    return (
        chunks.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "chunk")
        .mapInArrow(_digested, "conv_id long, depth long, ends_sha256 string")
    )


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """Every node of the trie of rebuilt conversations with its members, children, subtree totals and ends."""
    turns, lengths = rebuilt(stage(hashed_turns(conversations.withColumn("conv_id", F.col("conv_id").cast("long")))))
    nodes, members = trie(turns, lengths)
    totals = subtree_totals(nodes)
    key = ["conv_id", "depth"]
    return (
        nodes.select(*key, "parent_conv_id", "n_convs").join(totals, key).join(ends(members), key, "left")
        .withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)))
        .select(*key, "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    )
