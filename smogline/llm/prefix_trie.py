r"""Conversation prefix trie by splitter skeletons.

A conversation is a path: one 16-byte key (SHA-256, cut) of role and text per
turn.  Rows are ordered by (path, conv_id) and cut into shards at splitters,
which are rows chosen from a sample; copies of one path are cut by conv_id, so
no path is too frequent.  In that order the members of a node stand together.

* The sorted splitter paths with the depth each shares with the one before it
  are the skeleton trie.  They are broadcast; at most ``SPLITTER_BYTES`` of
  them, else every second one is left out, which makes larger shards.
* Only a node on a splitter's path can have members in two shards.  Every other
  node is finished in its sorted shard, by one walk with a stack.
* For a skeleton node each of its shards gives a partial row: members, smallest
  member, and sums over the part of the subtree that lies in the shard.  What
  must count once is given by one shard that needs no message to know it: the
  first splitter on which a node lies owns it (its share of saved tokens, its
  place among its parent's children); the last shard that has members, the one
  whose right splitter does not lie below the node, knows if it has children.
  So one sum per skeleton node finishes it: partial aggregates are reduced,
  nothing is passed up level by level.

A task holds one shard's records at most; shards are cut by turns.  The ids
that end at a skeleton node travel as text pieces of ``PIECE`` bytes and are
hashed in order as a stream.  A path is one row, 16 bytes (and 4 for the length
of the text) a turn; texts themselves are not shuffled.

Defined results: rows without conv_id are left out; null role or text is empty;
turns come in order of ``turn`` (null first), ties by key, so repeated rows are
repeated turns; an empty table has no node, not even a root; a remainder takes
the sign of the id, as in SQL.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table, tune

KEY = 16
SAMPLE_PER_SHARD = 20
SPLITTER_BYTES = 64 << 20
PIECE = 1 << 20
NO_ENDS = hashlib.sha256(b"").hexdigest()
# fixed values of the data contract
FAMILY, HEADS = 100, 6

_NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
_PARTS = f"kind int, shard int, owner int, parent_owner int, {_NODE}, seq int, piece binary"
_DONE, _UNDER, _PARTIAL, _ENDS = range(4)  # finished; finished but for the parent's id; skeleton share; ids that end in a skeleton node


def turn_key(role: Column, text: Column) -> Column:
    """16 bytes that stand for (role, text); nulls are empty."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return F.substring(F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)), 1, KEY)


def rebuilt(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """``_q_conv``, ``_q_path`` (keys), ``_q_chars`` (code points) of every rebuilt conversation:
    the first h turns of the family's first one, then its own turns after its first h."""
    rows = turns.select(
        F.col(f"`{conv_id}`").cast("long").alias("_q_conv"),
        F.col(f"`{turn}`").alias("_q_turn"),
        turn_key(F.col(f"`{role}`"), F.col(f"`{text}`")).alias("_q_key"),
        F.length(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("_q_len"),
    ).where(F.col("_q_conv").isNotNull())
    rows = rows.withColumn("_q_family", F.col("_q_conv") - F.col("_q_conv") % FAMILY)
    # dealt by family: grouping and joining need no other shuffle
    own = rows.repartition("_q_family").groupBy("_q_family", "_q_conv").agg(F.sort_array(F.collect_list(F.struct("_q_turn", "_q_key", "_q_len"))).alias("_q_own"))
    first = own.where(F.col("_q_conv") == F.col("_q_family")).select("_q_family", F.slice("_q_own", 1, HEADS - 1).alias("_q_first"))
    h = (F.crc32(F.col("_q_conv").cast("string").cast("binary")) % HEADS).cast("int")
    head = F.coalesce(F.slice("_q_first", F.lit(1), h), F.slice("_q_own", 1, 0))
    path = F.concat(head, F.slice("_q_own", h + 1, F.size("_q_own")))
    out = own.join(first, "_q_family", "left").select("_q_conv", path.alias("_q_turns"))
    return out.select("_q_conv", F.col("_q_turns._q_key").alias("_q_path"), F.col("_q_turns._q_len").alias("_q_chars"))


def _paths(column: pa.Array) -> list[bytes]:
    """Each row's keys, joined."""
    data = b"".join(column.flatten().to_pylist())
    ends = KEY * np.cumsum([0, *column.value_lengths().to_pylist()])
    return [data[a:b] for a, b in zip(ends[:-1], ends[1:])]


def _shared(a: bytes, b: bytes) -> int:
    """Depth that two paths share."""
    if a == b:
        return len(a) // KEY
    n = min(len(a), len(b)) // KEY
    for d in range(n):
        if a[d * KEY : d * KEY + KEY] != b[d * KEY : d * KEY + KEY]:
            return d
    return n


def splitters(paths: DataFrame, shards: int) -> list[tuple[bytes, int]]:
    """Rows of a sample that cut the paths into shards of about equal turns, in order."""
    total = paths.count()
    share = min(1.0, SAMPLE_PER_SHARD * shards / max(total, 1))
    sample = paths.where(F.pmod(F.xxhash64("_q_conv"), F.lit(1 << 30)) < int(share * (1 << 30))).select("_q_path", "_q_conv")
    rows = sorted((b"".join(r[0]), r[1]) for r in sample.collect())
    if not rows:
        return []
    weight = np.cumsum([1 + len(p) // KEY for p, _ in rows])
    cut = sorted({int(i) for i in np.searchsorted(weight, weight[-1] * np.arange(1, shards) / shards)})
    chosen = [rows[i] for i in cut]
    while sum(len(p) for p, _ in chosen) > SPLITTER_BYTES and len(chosen) > 1:
        chosen = chosen[1::2]
    return chosen


class _Open:
    """A node on the stack: its members and its subtree as far as the shard has gone."""

    __slots__ = ("chars", "children", "convs", "ends", "least", "leaves", "owner", "saved", "seen", "waiting")

    def __init__(self, chars: int, owner: int):
        self.chars, self.owner = chars, owner  # owner: of a skeleton node, else -1
        self.convs = self.children = self.leaves = self.saved = 0
        self.least = self.ends = None
        self.seen = False
        self.waiting: list[tuple] = []


class Walk:
    """One walk over a sorted shard; ``out`` takes its records."""

    def __init__(self, shard: int, skeleton: list[tuple[bytes, int]], shared: list[int]):
        self.shard, self.out, self.path, self.seq = shard, [], b"", 0
        # splitter number s starts shard s; shard 0 starts at the root
        self.left = skeleton[shard - 1][0] if shard else b""
        self.last = shard == len(skeleton)
        self.right = b"" if self.last else skeleton[shard][0]
        self.left_owner = self._owners(shard, shared)
        self.right_owner = [] if self.last else self._owners(shard + 1, shared)
        self.stack = [_Open(0, 0)]
        self.below_right = -1 if self.last else 0  # depth to which the path lies on the right splitter's

    def _owners(self, splitter: int, shared: list[int]) -> list[int]:
        """The first splitter on which each prefix of this one's path lies."""
        depth = len(self.left if splitter == self.shard else self.right) // KEY
        owner = [0] * (depth + 1)
        top, s = depth, splitter
        while s > 0 and top > 0:
            for d in range(shared[s - 1] + 1, top + 1):
                owner[d] = s
            top, s = min(top, shared[s - 1]), s - 1
        return owner

    def row(self, path: bytes, conv: int, chars: list[int]) -> None:
        keep = _shared(self.path, path)
        self.close(keep)
        depth = len(path) // KEY
        if keep < depth:
            left = _shared(path, self.left)
            right = -1 if self.last else _shared(path, self.right)
            for d in range(keep + 1, depth + 1):
                self.stack.append(_Open(chars[d - 1], self.left_owner[d] if d <= left else self.right_owner[d] if d <= right else -1))
            self.below_right = right
        self.path = path
        top = self.stack[-1]
        top.convs += 1
        top.least = conv if top.least is None else min(top.least, conv)
        if top.owner < 0:
            if top.ends is None:
                top.ends = hashlib.sha256(b"%d" % conv)
            else:
                top.ends.update(b",%d" % conv)
        else:
            top.ends = top.ends or bytearray()
            top.ends += b"%d," % conv
            if len(top.ends) >= PIECE:
                self.flush(top, depth)

    def flush(self, node: _Open, depth: int) -> None:
        if node.ends:
            self.out.append((_ENDS, self.shard, node.owner, None, None, depth, *[None] * 6, self.seq, bytes(node.ends)))
            self.seq += 1
            node.ends = None

    def close(self, keep: int) -> None:
        """Close all nodes deeper than ``keep``."""
        while len(self.stack) > keep + 1:
            depth = len(self.stack) - 1
            node, parent = self.stack.pop(), self.stack[-1]
            own = node.owner < 0
            node.leaves += not node.seen and (own or depth > self.below_right)
            node.saved += (node.convs - (own or node.owner == self.shard)) * node.chars
            self.finish(node, depth, parent)
            parent.convs += node.convs
            parent.leaves += node.leaves
            parent.saved += node.saved
            parent.children += own or node.owner == self.shard
            parent.seen = True
            if node.least is not None:
                parent.least = node.least if parent.least is None else min(parent.least, node.least)

    def finish(self, node: _Open, depth: int, parent: _Open | None) -> None:
        for record in node.waiting:  # its children, now that its smallest member is known
            self.out.append((*record[:6], node.least, *record[7:]))
        counts = (node.convs, node.children, node.leaves, node.saved)
        if node.owner >= 0:
            self.flush(node, depth)
            self.out.append((_PARTIAL, self.shard, node.owner, parent.owner if parent else None, node.least, depth, None, *counts, None, None, None))
            return
        sha = node.ends.hexdigest() if node.ends else NO_ENDS
        record = (_DONE if parent.owner < 0 else _UNDER, self.shard, None, parent.owner, node.least, depth, None, *counts, sha, None, None)
        (self.out if parent.owner >= 0 else parent.waiting).append(record)

    def end(self) -> list[tuple]:
        self.close(0)
        root = self.stack.pop()
        root.leaves += not root.seen and self.last
        self.finish(root, 0, None)
        return self.out


def _batches(records: list[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(records), 20_000):
        columns = zip(*records[at : at + 20_000])
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


_ARROW = pa.schema(
    [("kind", pa.int32()), ("shard", pa.int32()), ("owner", pa.int32()), ("parent_owner", pa.int32())]
    + [(x, pa.int64()) for x in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")]
    + [("ends_sha256", pa.string()), ("seq", pa.int32()), ("piece", pa.binary())]
)


def parts(paths: DataFrame, shards: int) -> DataFrame:
    """The records of all shards: finished nodes and the shares of skeleton nodes."""
    skeleton = splitters(paths, shards)
    # shared[s]: depth that splitter s + 1 shares with the one before it (the first: the root alone)
    shared = [_shared(a, b) for (a, _), (b, _) in zip([(b"", 0), *skeleton], skeleton)]
    sent = paths.sparkSession.sparkContext.broadcast((skeleton, shared))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = sent.value[0]
        for batch in batches:
            path, conv = _paths(batch.column(1)), batch.column(0).to_pylist()
            shard = [bisect_right(cuts, x) for x in zip(path, conv)]
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), pa.array(path, pa.binary()), batch.column(0), batch.column(2)], names=["shard", "path", "conv", "chars"])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: Walk | None = None
        for batch in batches:
            for shard, path, conv, chars in zip(*[c.to_pylist() for c in batch.columns]):
                if at is None or at.shard != shard:
                    if at is not None:
                        yield from _batches(at.end(), _ARROW)
                    at = Walk(shard, *sent.value)
                at.row(path, conv, chars)
            if at is not None and at.out:
                yield from _batches(at.out, _ARROW)
                at.out = []
        if at is not None:
            yield from _batches(at.end(), _ARROW)

    dealt = paths.select("_q_conv", "_q_path", "_q_chars").mapInArrow(deal, "shard int, path binary, conv long, chars array<int>")
    dealt = dealt.repartitionById(len(skeleton) + 1, F.col("shard")).sortWithinPartitions("shard", "path", "conv")
    return dealt.mapInArrow(walk, _PARTS)


def _hash_pieces(pieces: DataFrame) -> DataFrame:
    """SHA-256 of each skeleton node's ids, its pieces read in order as a stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = held = None

        def result(key, held):
            return pa.RecordBatch.from_pydict({"owner": pa.array([key[0]], pa.int32()), "depth": pa.array([key[1]], pa.int64()), "ends": [held.hexdigest()]})

        for batch in batches:
            for owner, depth, piece in zip(*[batch.column(i).to_pylist() for i in (0, 1, 4)]):
                if key != (owner, depth):
                    if key is not None:
                        yield result(key, held)
                    key, held = (owner, depth), hashlib.sha256(piece[:-1])
                else:
                    held.update(b"," + piece[:-1])
        if key is not None:
            yield result(key, held)

    rows = pieces.select("owner", "depth", "shard", "seq", "piece").repartition("owner", "depth").sortWithinPartitions("owner", "depth", "shard", "seq")
    return rows.mapInArrow(run, "owner int, depth long, ends string")


def trie(paths: DataFrame, shards: int | None = None) -> DataFrame:
    """All nodes of the trie of ``rebuilt`` paths.  ``shards`` defaults to the session's shuffle partitions."""
    spark = paths.sparkSession
    tune(spark)
    records = stored(parts(paths, shards or int(spark.conf.get("spark.sql.shuffle.partitions"))), "trie")
    kind = lambda k: records.where(F.col("kind") == k)
    shares = kind(_PARTIAL)
    sums = [F.sum(x).alias(x) for x in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    skeleton = shares.groupBy("owner", "depth").agg(F.min("conv_id").alias("conv_id"), F.max("parent_owner").alias("parent_owner"), *sums)
    skeleton = skeleton.join(_hash_pieces(kind(_ENDS)), ["owner", "depth"], "left").withColumn("ends_sha256", F.coalesce("ends", F.lit(NO_ENDS)))
    skeleton = stored(skeleton, "skeleton")
    least = skeleton.select(F.col("owner").alias("parent_owner"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("_q_parent"))
    # a skeleton node's id goes to each of its shards, so that no parent is a hot key
    here = shares.select("shard", F.col("owner").alias("parent_owner"), (F.col("depth") + 1).alias("depth")).join(least, ["parent_owner", "depth"])
    names = [c.split()[0] for c in _NODE.split(", ")]

    def with_parent(rows: DataFrame) -> DataFrame:
        return rows.drop("parent_conv_id").withColumnRenamed("_q_parent", "parent_conv_id").select(*names)

    return (
        kind(_DONE).select(*names)
        .unionByName(with_parent(kind(_UNDER).join(here, ["shard", "parent_owner", "depth"])))
        .unionByName(with_parent(skeleton.join(least, ["parent_owner", "depth"], "left")))
    )


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all rebuilt ``conversations``."""
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return trie(stored(rebuilt(turns, "conv_id", "turn", "role", "text"), "paths"))


OP13_SQL = """
WITH turns AS (
  SELECT conv_id AS c, list(struct_pack(r := coalesce(role, ''), x := coalesce(text, ''))
           ORDER BY turn NULLS FIRST, substring(sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32)) AS own
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), crc AS (
  SELECT c, own, c - c % 100 AS family,
    xor(list_reduce(list_transform(string_split(c::VARCHAR, ''), lambda s: ascii(s)::BIGINT),
      lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: xor(v >> 1, 3988292384 * (v & 1))), 4294967295::BIGINT),
      4294967295) % 6 AS h
  FROM turns
), paths AS (
  SELECT a.c, list_concat(coalesce(b.own[1 : a.h], []), a.own[a.h + 1 : ]) AS p FROM crc a LEFT JOIN turns b ON b.c = a.family
), prefixes AS (
  SELECT c, len(p) AS n, d, p[1 : d] AS node FROM paths, unnest(range(0, len(p) + 1)) AS t(d)
), nodes AS (
  SELECT node, d, min(c) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (n = d), '')) AS ends
  FROM prefixes GROUP BY node, d
), children AS (
  SELECT node[1 : d - 1] AS node, d - 1 AS d, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL
), alone AS (
  SELECT a.*, coalesce(n_children, 0) AS n_children, CASE WHEN a.d = 0 THEN 0 ELSE (n_convs - 1) * length(a.node[-1].x) END AS saved
  FROM nodes a LEFT JOIN children b ON a.d = b.d AND a.node = b.node
), below AS (
  SELECT a.node[1 : t.d] AS node, t.d, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
  FROM alone a, unnest(range(0, a.d + 1)) AS t(d) GROUP BY ALL
)
SELECT a.conv_id::BIGINT AS conv_id, a.d::BIGINT AS depth, p.conv_id::BIGINT AS parent_conv_id, a.n_convs::BIGINT AS n_convs,
  a.n_children::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, a.ends AS ends_sha256
FROM alone a JOIN below b ON a.d = b.d AND a.node = b.node
LEFT JOIN nodes p ON p.d = a.d - 1 AND p.node = a.node[1 : a.d - 1]
"""
