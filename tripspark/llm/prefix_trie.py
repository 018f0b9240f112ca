"""Conversation prefix trie: every distinct opening of the conversations, with subtree totals.

A conversation is a sequence of turns (role, text). Each distinct sequence of its first d turns is
a node of depth d, from the root at 0; the conversations that start with it are its members.

Conversations. Turns are range-partitioned by (conversation, turn), so one that holds a third of
all rows is spread over several tasks; what its parts need of each other (how many turns came
before, the hash so far) is a table of two rows per partition at most. A prefix is known by its
depth and 128 bits: the exclusive or of a hash per (position, role, text), which can be summed up
part by part.

Totals (time-forward processing). A node is named by its smallest member and its depth. Nodes go
to shards, ranges of a trie order by the prefixes at a few depths, and are sorted externally by
reverse level order. A shard takes its nodes from the deepest on; a node collects the messages
sent to it from a priority queue that spills to disk, and when all its children have reported it
is done and sends its totals to its parent's time slot. Messages to nodes of other shards leave
the shard, one for each target. Nodes that miss children there, the shard roots' ancestors, and
those messages are the next round's input, with an eighth of the shards; the last round has one.
Every round is a written table.

`assembled` rebuilds conversations from the openings of others, as the contract of the query says.

Defined cases: rows without conv_id belong to no conversation. A NULL role or text is empty. Turns
are ordered by turn, NULL first, then by role and the text's first 64 characters, then by the
MD5 of the text; repeated rows are turns of their own. An empty table has no nodes. Extra columns
are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import col

from tripspark.llm.common import partitions, rows, stored

FAMILY = 20  # conversations that share the opening of the first of them
SHRINK = 8  # how many shards become one in the next round
QUEUE = 100_000  # messages held in memory before they are spilled
ENDS_BYTES = 1 << 20  # of conv_ids written as text at once
SKETCH = (1, 2, 4, 8, 16)  # depths whose prefixes order the nodes

_ORDER = ["turn", "role_key", "text_key", "tie"]


def turns(conversations: DataFrame) -> DataFrame:
    """One slim row per turn, in written order: conv_id, part, the order keys, a, b, words."""
    role = F.coalesce(col("role"), F.lit(""))
    text = F.coalesce(col("text"), F.lit(""))
    slim = conversations.where(col("conv_id").isNotNull()).select(
        col("conv_id").cast("long").alias("conv_id"),
        col("turn").cast("long").alias("turn"),
        F.substring(role, 1, 64).alias("role_key"),
        F.substring(text, 1, 64).alias("text_key"),
        F.concat(F.md5(role), F.md5(text)).alias("tie"),
        F.xxhash64(role, text).alias("a"),
        F.xxhash64(F.lit(1), role, text).alias("b"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
    )
    by = ["conv_id", *_ORDER]
    return stored(
        slim.repartitionByRange(partitions(conversations.sparkSession), *by).withColumn(
            "part", F.spark_partition_id()
        ),
        "turns",
    )


def _before(parts: DataFrame, value: str, total: str) -> DataFrame:
    """What the earlier parts of a conversation add up to, for those in several parts.

    `parts` has a row per part and conversation. A conversation in several parts is the first or
    last of each, so the result has two rows per partition at most.
    """
    several = parts.groupBy("conv_id").agg(F.count("*").alias("n")).where("n > 1")
    earlier = (
        "OVER (PARTITION BY conv_id ORDER BY part"
        " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    )
    return parts.join(several, "conv_id", "left_semi").select(
        "conv_id", "part", F.expr(f"coalesce({total}({value}) {earlier}, 0L)").alias("before")
    )


def _plus(df: DataFrame, before: DataFrame) -> tuple[DataFrame, Column]:
    joined = df.join(F.broadcast(before), ["conv_id", "part"], "left")
    return joined, F.coalesce(col("before"), F.lit(0).cast("long"))


def positioned(conversations: DataFrame) -> DataFrame:
    """The turns with `pos`, their place in the conversation from 1."""
    slim = turns(conversations)
    in_order = col("turn").asc_nulls_first(), *_ORDER[1:]
    local = Window.partitionBy("conv_id", "part").orderBy(*in_order)
    counts = slim.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    numbered = slim.withColumn("local", F.row_number().over(local))
    numbered, before = _plus(numbered, _before(counts, "n", "sum"))
    return stored(
        numbered.select("conv_id", "part", "a", "b", "words", (col("local") + before).alias("pos")),
        "positions",
    )


def assembled(placed: DataFrame, family: int = FAMILY) -> DataFrame:
    """Conversations rebuilt on the openings of their family's first one.

    The first h turns of conversation c - c % family, h = crc32(c) % 4, then c's own turns after
    its first h. Returns conv_id, part, depth from 1, a, b, words.
    """
    base = col("conv_id") - col("conv_id") % family
    h = F.crc32(col("conv_id").cast("string").cast("binary")) % 4
    # At most three rows of a conversation.
    heads = placed.where((col("pos") <= 3) & (col("conv_id") % family == 0)).select(
        col("conv_id").alias("base"), "pos", "a", "b", "words"
    )
    lengths = heads.groupBy("base").agg(F.max("pos").alias("n"))
    convs = placed.groupBy("conv_id").agg(F.min("part").alias("part")).withColumn("base", base)
    opening = convs.join(heads, "base").where(col("pos") <= h)
    shift = F.least(h, F.coalesce(col("n"), F.lit(0))) - h
    own = placed.where(col("pos") > h).withColumn("base", base).join(lengths, "base", "left")
    return opening.select(
        "conv_id", "part", col("pos").cast("long").alias("depth"), "a", "b", "words"
    ).unionByName(
        own.select(
            "conv_id", "part", (col("pos") + shift).cast("long").alias("depth"), "a", "b", "words"
        )
    )


def prefixes(sequences: DataFrame, convs: DataFrame) -> DataFrame:
    """A row per conversation and depth, 0 included, with the hashes of prefix and parent prefix.

    `sequences` has conv_id, part, depth, a, b, words; `convs` has every conv_id, also turnless.
    """
    mixed = sequences.select(
        "conv_id",
        "part",
        "depth",
        "words",
        F.xxhash64("depth", "a", "b").alias("x"),
        F.xxhash64("b", "depth", "a").alias("y"),
    )
    mixed = stored(mixed, "sequences")
    running = "OVER (PARTITION BY conv_id, part ORDER BY depth)"
    out = mixed.selectExpr(
        "*", f"bit_xor(x) {running} AS run_x", f"bit_xor(y) {running} AS run_y"
    )
    parts = mixed.groupBy("conv_id", "part").agg(
        F.expr("bit_xor(x)").alias("all_x"), F.expr("bit_xor(y)").alias("all_y")
    )
    for run, total in (("run_x", "all_x"), ("run_y", "all_y")):
        out, before = _plus(out, _before(parts, total, "bit_xor"))
        out = out.withColumn(run, col(run).bitwiseXOR(before)).drop("before")
    sketch = [f"max(CASE WHEN depth = {d} THEN run_x END) {running} AS s{d}" for d in SKETCH]
    deep = out.selectExpr(
        "conv_id",
        "depth",
        "words",
        "run_x AS x",
        "run_y AS y",
        "run_x ^ x AS up_x",
        "run_y ^ y AS up_y",
        *sketch,
    )
    root = convs.select(
        "conv_id",
        *[F.lit(0).cast("long").alias(c) for c in ("depth", "words", "x", "y")],
        *[
            F.lit(None).cast("long").alias(c)
            for c in ("up_x", "up_y", *(f"s{d}" for d in SKETCH))
        ],
    )
    return stored(root.unionByName(deep), "prefixes")


def _nodes(members: DataFrame) -> DataFrame:
    """The nodes, each with its smallest member, its parent's and its counts."""
    key = ["depth", "x", "y"]
    nodes = stored(
        members.groupBy(*key).agg(
            F.min("conv_id").alias("conv_id"),
            F.count("*").alias("n_convs"),
            *[F.max(c).alias(c) for c in ("words", "up_x", "up_y", *(f"s{d}" for d in SKETCH))],
        ),
        "nodes",
    )
    up = [(col("depth") - 1).alias("depth"), col("up_x").alias("x"), col("up_y").alias("y")]
    children = nodes.where("depth > 0").groupBy(*up).agg(F.count("*").alias("n_children"))
    parents = nodes.select(
        (col("depth") + 1).alias("depth"),
        col("x").alias("up_x"),
        col("y").alias("up_y"),
        col("conv_id").alias("parent_conv_id"),
    )
    linked = nodes.join(parents, ["depth", "up_x", "up_y"], "left")
    return stored(
        linked.join(children, key, "left").fillna(0, ["n_children"]).drop("up_x", "up_y"),
        "linked",
    )


class MessageQueue:
    """A priority queue that spills: sorted runs on disk, the rest a heap in memory."""

    def __init__(self, limit: int = QUEUE):
        self.limit = limit
        self.heap: list[tuple] = []
        self.runs: list[tuple] = []  # (next message, number of the run, its messages)
        self.n_runs = 0

    def push(self, message: tuple) -> None:
        heapq.heappush(self.heap, message)
        if len(self.heap) > self.limit:
            self._spill()

    def _spill(self) -> None:
        file = tempfile.TemporaryFile()  # gone with the task
        for message in sorted(self.heap):
            pickle.dump(message, file)
        file.seek(0)
        self.heap = []
        self.n_runs += 1
        heapq.heappush(self.runs, (pickle.load(file), self.n_runs, file))

    def peek(self) -> tuple | None:
        ahead = self.runs[0][0] if self.runs else None
        if self.heap and (ahead is None or self.heap[0] <= ahead):
            return self.heap[0]
        return ahead

    def pop(self) -> tuple:
        if self.heap and (not self.runs or self.heap[0] <= self.runs[0][0]):
            return heapq.heappop(self.heap)
        message, number, file = self.runs[0]
        try:
            heapq.heapreplace(self.runs, (pickle.load(file), number, file))
        except EOFError:
            heapq.heappop(self.runs)
            file.close()
        return message

    def take(self, slot: tuple) -> list[int]:
        """The sums of all messages sent to a slot."""
        total = [0, 0, 0]
        while (ahead := self.peek()) is not None and ahead[:2] == slot:
            for i, value in enumerate(self.pop()[2:]):
                total[i] += value
        return total


# What a row of a round says: a node with its final totals, a node that misses children of other
# shards, or what a shard has for a node of another one.
DONE, OPEN, MESSAGE = 0, 1, 2
_STATE = pa.schema(
    [
        (c, pa.int64())
        for c in ("kind", "depth", "conv_id", "parent_conv_id", "missing", "leaves", "saved")
    ]
)
_STATE_DDL = ", ".join(f"{f.name} long" for f in _STATE)


def _time_forward(limit: int):
    """One shard, its nodes from the deepest on: depth, conv_id, parent_conv_id, missing (children
    that have not reported), leaves, saved (so far, its own share included)."""

    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue, out = MessageQueue(limit), []

        def foreign(until: tuple | None) -> None:
            """Messages to slots before `until` have their targets in other shards."""
            while (ahead := queue.peek()) is not None and (until is None or ahead[:2] < until):
                count, leaves, saved = queue.take(ahead[:2])
                out.append((MESSAGE, -ahead[0], ahead[1], None, count, leaves, saved))

        for batch in batches:
            for depth, conv, parent, missing, leaves, saved in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                foreign((-depth, conv))
                count, more_leaves, more_saved = queue.take((-depth, conv))
                missing, leaves, saved = missing - count, leaves + more_leaves, saved + more_saved
                out.append((OPEN if missing else DONE, depth, conv, parent, missing, leaves, saved))
                if not missing and depth:
                    queue.push((1 - depth, parent, 1, leaves, saved))
            if len(out) >= 20_000:
                yield rows(_STATE, list(zip(*out, strict=True)))
                out.clear()
        foreign(None)
        if out:
            yield rows(_STATE, list(zip(*out, strict=True)))

    return forward


def subtree_totals(nodes: DataFrame, limit: int = QUEUE, shards: int | None = None) -> DataFrame:
    """(conv_id, depth, n_leaves, saved_tokens) of every node."""
    order = [*(f"s{d}" for d in SKETCH), "stretch", "conv_id", "depth"]
    shards = shards or partitions(nodes.sparkSession)
    state = nodes.select(
        "depth",
        "conv_id",
        "parent_conv_id",
        col("n_children").alias("missing"),
        (col("n_children") == 0).cast("long").alias("leaves"),
        ((col("n_convs") - 1) * col("words")).alias("saved"),
        *(f"s{d}" for d in SKETCH),
        F.expr("depth div 1024").alias("stretch"),
    )
    done = None
    while True:
        sharded = state.repartitionByRange(shards, *order) if shards > 1 else state.coalesce(1)
        moved = stored(
            sharded.sortWithinPartitions(col("depth").desc(), "conv_id")
            .select("depth", "conv_id", "parent_conv_id", "missing", "leaves", "saved")
            .mapInArrow(_time_forward(limit), _STATE_DDL),
            "forward",
        )
        ready = moved.where(col("kind") == DONE).select(
            "conv_id",
            "depth",
            col("leaves").alias("n_leaves"),
            col("saved").alias("saved_tokens"),
        )
        done = ready if done is None else done.unionByName(ready)
        if shards == 1 or moved.where(col("kind") == OPEN).isEmpty():
            return done
        sent = (
            moved.where(col("kind") == MESSAGE)
            .groupBy("depth", "conv_id")
            .agg(*[F.sum(c).alias(f"more_{c}") for c in ("missing", "leaves", "saved")])
        )
        still = moved.where(col("kind") == OPEN).join(sent, ["depth", "conv_id"], "left")
        known = nodes.select("depth", "conv_id", *(f"s{d}" for d in SKETCH))
        more = {c: F.coalesce(col(f"more_{c}"), F.lit(0)) for c in ("missing", "leaves", "saved")}
        state = still.join(known, ["depth", "conv_id"]).select(
            "depth",
            "conv_id",
            "parent_conv_id",
            (col("missing") - more["missing"]).alias("missing"),
            (col("leaves") + more["leaves"]).alias("leaves"),
            (col("saved") + more["saved"]).alias("saved"),
            *(f"s{d}" for d in SKETCH),
            F.expr("depth div 1024").alias("stretch"),
        )
        shards = max(1, shards // SHRINK)


_CHUNK = pa.schema(
    [
        ("depth", pa.int64()),
        ("x", pa.int64()),
        ("y", pa.int64()),
        ("first", pa.int64()),
        ("ids", pa.binary()),
    ]
)


def _id_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (depth, x, y, conv_id) rows as runs of comma-joined ids, one per node and stretch."""
    key, first, ids, size = None, None, [], 0
    out = []
    for batch in batches:
        for depth, x, y, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (depth, x, y) != key or size >= ENDS_BYTES:
                if ids:
                    out.append((*key, first, b",".join(ids)))
                key, first, ids, size = (depth, x, y), conv, [], 0
                if len(out) >= 2000 or out and len(out[-1][4]) >= ENDS_BYTES:
                    yield rows(_CHUNK, list(zip(*out, strict=True)))
                    out.clear()
            ids.append(b"%d" % conv)
            size += len(ids[-1]) + 1
    if ids:
        out.append((*key, first, b",".join(ids)))
    if out:
        yield rows(_CHUNK, list(zip(*out, strict=True)))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The SHA-256 of each node's chunks, which arrive in order."""
    schema = pa.schema([*_CHUNK][:3] + [pa.field("ends_sha256", pa.string())])
    key, running = None, None
    for batch in batches:
        out = []
        for *node, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if node != key:
                if key is not None:
                    out.append((*key, running.hexdigest()))
                key, running = node, hashlib.sha256(ids)
            else:
                running.update(b",")
                running.update(ids)
        if out:
            yield rows(schema, list(zip(*out, strict=True)))
    if key is not None:
        yield rows(schema, [[k] for k in (*key, running.hexdigest())])


def end_digests(members: DataFrame) -> DataFrame:
    """(depth, x, y, ends_sha256) of the nodes at which conversations end.

    The ids of a node are first joined in the tasks that hold them in order, so the one task that
    carries a digest on reads a row per task and megabyte, not one per conversation.
    """
    key = ["depth", "x", "y"]
    ends = members.groupBy("conv_id").agg(F.max(F.struct(*key)).alias("end"))
    ends = ends.select("end.*", "conv_id")
    chunks = (
        ends.repartitionByRange(partitions(members.sparkSession), *key, "conv_id")
        .sortWithinPartitions(*key, "conv_id")
        .mapInArrow(_id_chunks, "depth long, x long, y long, first long, ids binary")
    )
    return (
        chunks.repartition(*key)
        .sortWithinPartitions(*key, "first")
        .drop("first")
        .mapInArrow(_digests, "depth long, x long, y long, ends_sha256 string")
    )


def trie(members: DataFrame, limit: int = QUEUE, shards: int | None = None) -> DataFrame:
    """The nodes of the trie over `prefixes`, with their subtree totals."""
    nodes = _nodes(members)
    totals = subtree_totals(nodes, limit, shards)
    nothing = hashlib.sha256(b"").hexdigest()
    return (
        nodes.join(totals, ["conv_id", "depth"])
        .join(end_digests(members), ["depth", "x", "y"], "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
        )
    )


def report(
    conversations: DataFrame,
    family: int = FAMILY,
    limit: int = QUEUE,
    shards: int | None = None,
) -> DataFrame:
    """Every node of the trie over the rebuilt conversations."""
    placed = positioned(conversations)
    convs = placed.select("conv_id").distinct()
    return trie(prefixes(assembled(placed, family), convs), limit, shards)


# CRC-32 of the decimal conv_id, a bit at a time: 256 and more brings in a byte, 0 shifts.
ORACLE = r"""
WITH plain AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (
           PARTITION BY conv_id
           ORDER BY turn ASC NULLS FIRST, left(coalesce(role, ''), 64), left(coalesce(text, ''), 64),
                    md5(coalesce(role, '')), md5(coalesce(text, ''))) AS pos
  FROM conversations
  WHERE conv_id IS NOT NULL
), conv AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base,
         xor(4294967295, list_reduce(
           list_concat([4294967295::BIGINT], flatten(list_transform(
             string_split(conv_id::VARCHAR, ''),
             lambda c: [256 + ascii(c), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]))),
           lambda crc, x: CASE WHEN x >= 256 THEN xor(crc, x - 256)
                               WHEN crc % 2 = 1 THEN xor(crc >> 1, 3988292384)
                               ELSE crc >> 1 END)) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM plain)
), turn AS (
  SELECT conv.conv_id, 0 AS own, pos, role, text
  FROM conv JOIN plain ON plain.conv_id = base AND pos <= h
  UNION ALL
  SELECT conv_id, 1, pos, role, text FROM plain JOIN conv USING (conv_id) WHERE pos > h
), rebuilt AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY own, pos) AS turns
  FROM turn GROUP BY conv_id
  UNION ALL
  SELECT conv_id, [] FROM conv WHERE conv_id NOT IN (SELECT conv_id FROM turn)
), member AS (
  SELECT conv_id, d AS depth, turns[1:d] AS prefix, len(turns) AS n_turns
  FROM rebuilt, unnest(range(len(turns) + 1)) AS r(d)
), node AS (
  SELECT depth, prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce(len(regexp_extract_all(any_value(prefix[depth].text), '[^\x20\x09-\x0D]+')), 0)
           * (count(*) - 1) AS saved,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)
                           FILTER (WHERE n_turns = depth), '')) AS ends_sha256
  FROM member GROUP BY depth, prefix
), child AS (
  SELECT node.*, up.conv_id AS parent_conv_id
  FROM node LEFT JOIN node AS up
    ON up.depth = node.depth - 1 AND up.prefix = node.prefix[1:node.depth - 1]
), counted AS (
  SELECT child.*, coalesce(n, 0) AS n_children
  FROM child LEFT JOIN (
    SELECT depth - 1 AS depth, parent_conv_id AS conv_id, count(*) AS n
    FROM child WHERE depth > 0 GROUP BY ALL
  ) USING (depth, conv_id)
), below AS (
  SELECT node.conv_id, node.depth, sum(low.saved)::BIGINT AS saved_tokens,
         count(*) FILTER (WHERE low.n_children = 0) AS n_leaves
  FROM node
  JOIN member ON member.depth = node.depth AND member.prefix = node.prefix
  JOIN counted AS low ON low.conv_id = member.conv_id AND low.depth >= node.depth
  GROUP BY node.conv_id, node.depth
)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
FROM counted JOIN below USING (conv_id, depth)
"""
