"""SimHash near-duplicates by vantage-point trees.

Fingerprint: ASCII lower case, words are runs of non-space characters,
shingles of ``size`` words joined by one space, repeats included (a text of
fewer words: its whole sequence).  h is the XXH64 of a shingle (UTF-8, seed
42); a bit is 1 if set in over half the h.  Fingerprints link at ``distance``
or fewer differing bits; components are the transitive closure.

Search, exact at every size:

1. Equal fingerprints are one class (pre-aggregated before any shuffle), so a
   group of exact copies, however large, is one point.
2. A vantage-point tree fitted on a bounded sample of the classes cuts the
   Hamming space into shards: inside a node's radius goes left, outside right.
   Every class has one home shard.  A class inside the radius by less than
   ``distance`` is also sent right as a query, and a query follows every branch
   that the triangle inequality leaves open.  So of two linked classes with
   different homes one always meets the other in the other's home shard.
3. Each shard grows a vantage-point tree of its own over its classes and runs
   all of them and the queries through it, with the same pruning, down to
   small leaves that are compared bit by bit.  A shard returns a spanning
   forest of its links (at most one row per class), never all pairs.
4. Components come from the forests by minimum labels with pointer jumping, as
   Spark joins; every round is written to the shared scratch folder.

Broadcast bound: the routing tree, at most ``2 * SAMPLE`` nodes of 9 bytes.

Defined results: null or empty text has fingerprint 0 and links like any
other.  A null doc_id never becomes a component id unless the component has no
other.  Repeated rows are rows of one class.  Empty table: empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, stored, table, tune

SHINGLE = 3
DISTANCE = 3
SEED = 42
#: classes per shard aimed at, and the bound on the sample that fits the routing tree
SHARD_CLASSES = 8192
SAMPLE = 65_536
LEAF = 256


def shingle_hashes(text: bytes, size: int = SHINGLE) -> np.ndarray:
    words = text.lower().split()  # of bytes: ASCII case and ASCII white space only
    if not words:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    if len(words) < size:
        return np.array([digest(b" ".join(words), SEED)], np.uint64)
    runs = zip(*[words[i:] for i in range(size)])
    return np.fromiter([digest(b" ".join(x), SEED) for x in runs], np.uint64, len(words) - size + 1)


def fingerprint(hashes: np.ndarray) -> int:
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.ascontiguousarray(hashes[at : at + (1 << 16)])
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str, out: str = "_q_fp", size: int = SHINGLE) -> DataFrame:
    """Replace the text column by the fingerprint (64 bits as a signed long)."""
    tune(docs.sparkSession)
    keep = [c for c in docs.columns if c != text]
    source = docs.select(*[F.col(f"`{c}`").alias(f"_q_{i}") for i, c in enumerate(keep)], F.col(f"`{text}`").alias("_q_text"))
    names = [f"_q_{i}" for i in range(len(keep))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in chunks(batches, "_q_text"):
            fps = np.array([fingerprint(shingle_hashes(x, size)) for x in texts], np.uint64).view(np.int64)
            yield from pa.table([*rows.columns[: len(keep)], pa.array(fps)], names=[*names, "_q_out"]).combine_chunks().to_batches()

    done = source.mapInArrow(run, source.select(*names, F.lit(0).cast("long").alias("_q_out")).schema)
    return done.select(*[F.col(n).alias(c) for n, c in zip(names, keep)], F.col("_q_out").alias(out))


# ---------------------------------------------------------------- the trees


def _apart(points: np.ndarray, vantage: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ vantage)


def _vantage(points: np.ndarray) -> tuple[np.uint64, int]:
    """Of a few points the one whose distances spread most, and the radius that
    halves the rest best; radius 64 when no radius separates them."""
    best = (-1.0, points[0], 64)
    for v in points[:: max(1, len(points) // 5)][:5]:
        d = _apart(points, v)
        radius = int(np.median(d))
        if (d <= radius).all():
            radius -= 1
        inside = int((d <= radius).sum())
        spread = float(d.std()) if 0 < inside < len(points) else -0.5
        if spread > best[0]:
            best = (spread, v, radius if 0 < inside < len(points) else 64)
    return best[1], best[2]


def routing_tree(sample: np.ndarray, shards: int) -> list[tuple]:
    """Nodes as (vantage, radius, left, right); a negative child ~k is shard k."""
    leaf = max(1, len(sample) // max(1, shards))
    nodes: list = []
    count = 0

    def grow(points: np.ndarray, depth: int) -> int:
        nonlocal count
        if len(points) > leaf and depth < 24:
            v, radius = _vantage(points)
            if radius < 64:
                at = len(nodes)
                nodes.append(None)
                inside = _apart(points, v) <= radius
                nodes[at] = (v, radius, grow(points[inside], depth + 1), grow(points[~inside], depth + 1))
                return at
        count += 1
        return ~(count - 1)

    grow(sample, 0)
    return nodes


def route(nodes: list[tuple], points: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shard, index of point, is home) rows of all points."""
    out = []

    def go(at: int, homes: np.ndarray, queries: np.ndarray) -> None:
        if not len(homes) and not len(queries):
            return
        if at < 0 or not nodes:
            for idx, home in ((homes, True), (queries, False)):
                out.append((np.full(len(idx), ~at if at < 0 else 0), idx, np.full(len(idx), home)))
            return
        v, radius, left, right = nodes[at]
        dh, dq = _apart(points[homes], v), _apart(points[queries], v).astype(int)
        near = homes[(dh <= radius) & (dh.astype(int) > radius - distance)]
        go(left, homes[dh <= radius], queries[dq <= radius + distance])
        go(right, homes[dh > radius], np.concatenate([queries[dq > radius - distance], near]))

    go(0 if nodes else -1, np.arange(len(points)), np.zeros(0, np.int64))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, int), np.zeros(0, int), np.zeros(0, bool))


def _leaf_links(homes: np.ndarray, others: np.ndarray, points: np.ndarray, distance: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """A spanning forest of the links among a leaf's homes, and one to every
    linked home component of each query."""
    near = np.bitwise_count(points[homes][:, None] ^ points[homes][None, :]) <= distance
    label = np.arange(len(homes))
    while True:
        new = np.where(near, label[None, :], len(homes)).min(axis=1)
        new = new[new]
        if (new == label).all():
            break
        label = new
    out = [(homes[label != np.arange(len(homes))], homes[label[label != np.arange(len(homes))]])]
    step = max(1, (1 << 21) // max(1, len(homes)))
    for at in range(0, len(others), step):
        some = others[at : at + step]
        q, h = np.nonzero(np.bitwise_count(points[some][:, None] ^ points[homes][None, :]) <= distance)
        if len(q):
            pair = np.unique(q.astype(np.int64) * len(homes) + label[h])
            out.append((some[pair // len(homes)], homes[pair % len(homes)]))
    return out


def shard_links(homes: np.ndarray, queries: np.ndarray, distance: int = DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest (point, smallest point of its part) of all links between
    a shard's home points, and between them and the queries."""
    points = np.concatenate([homes, queries])
    found: list[tuple[np.ndarray, np.ndarray]] = []
    todo = [(np.arange(len(homes)), np.arange(len(homes), len(points)))]
    while todo:
        h, q = todo.pop()
        if not len(h):
            continue
        v, radius = _vantage(points[h]) if len(h) > LEAF else (None, 64)
        if radius == 64:
            for at in range(0, len(h), LEAF):  # more than LEAF only if no radius separates them
                found += _leaf_links(h[at : at + LEAF], np.concatenate([q, h[at + LEAF :]]), points, distance)
            continue
        dh, dq = _apart(points[h], v).astype(int), _apart(points[q], v).astype(int)
        inside = dh <= radius
        todo.append((h[inside], q[dq <= radius + distance]))
        todo.append((h[~inside], np.concatenate([q[dq > radius - distance], h[inside & (dh > radius - distance)]])))
    a = np.concatenate([x for x, _ in found]) if found else np.zeros(0, int)
    b = np.concatenate([x for _, x in found]) if found else np.zeros(0, int)
    # the order of labels is the order of the points' values
    rank = np.unique(points, return_inverse=True)
    a, b, label = rank[1][a], rank[1][b], np.arange(len(rank[0]))
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    while (label[label] != label).any():
        label = label[label]
    moved = np.flatnonzero(label != np.arange(len(label)))
    return rank[0][moved], rank[0][label[moved]]


# ---------------------------------------------------------------- Spark jobs


def links(classes: DataFrame, fp: str, distance: int = DISTANCE, shard_classes: int = SHARD_CLASSES) -> DataFrame:
    """Rows (a, b): a spanning forest, per shard, of all links between the
    distinct fingerprints of ``classes``."""
    spark = classes.sparkSession
    points = classes.select(F.col(fp).alias("fp"))
    n = points.count()
    # the sample: the smallest hashes; its bound is SAMPLE rows
    share = min(1.0, SAMPLE / 2 / max(1, n))
    some = points.where(F.pmod(F.xxhash64("fp"), F.lit(1_000_003)) < share * 1_000_003).limit(SAMPLE)
    sample = np.array([r["fp"] for r in some.collect()], np.int64).view(np.uint64)
    tree = spark.sparkContext.broadcast(routing_tree(np.sort(sample), -(-n // shard_classes)))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            shard, idx, home = route(tree.value, fps, distance)
            yield pa.RecordBatch.from_arrays([pa.array(shard.astype(np.int64)), pa.array(fps[idx].view(np.int64)), pa.array(home)], names=["shard", "fp", "home"])

    def search(rows: pa.Table) -> pa.Table:
        fps, home = rows.column("fp").to_numpy().view(np.uint64), rows.column("home").to_numpy()
        a, b = shard_links(fps[home], fps[~home], distance)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return points.mapInArrow(deal, "shard long, fp long, home boolean").groupBy("shard").applyInArrow(search, "a long, b long")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows (node, label): each node that has an edge and the smallest node of
    its component.  Minimum labels over the edges, then pointer jumping, until
    nothing changes; rounds grow with the logarithm of the longest chain."""
    two = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x <> y")
    two = stored(two.union(two.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(), "edges")
    label = stored(two.groupBy(F.col("x").alias("node")).agg(F.least(F.min("y"), F.first("x")).alias("label")), "labels")
    while True:
        low = (two.join(label, F.col("y") == F.col("node")).groupBy(F.col("x").alias("node")).agg(F.min("label").alias("low")))
        new = label.join(low, "node").select("node", F.col("label").alias("old"), F.least("label", "low").alias("label"))
        jump = new.select(F.col("node").alias("via"), F.col("label").alias("far"))
        new = stored(new.join(jump, F.col("label") == F.col("via")).select("node", "old", F.least("label", "far").alias("label")), "labels")
        if new.where("old <> label").isEmpty():
            return new.select("node", "label")
        label = new.select("node", "label")


def near_duplicates(docs: DataFrame, doc_id: str, text: str, distance: int = DISTANCE, size: int = SHINGLE,
                    extra: list[str] | None = None) -> DataFrame:
    """Per row of ``docs``: ``_q_id``, ``_q_fp``, ``_q_component`` (smallest id
    reachable), and the ``extra`` columns as ``_q_x0, _q_x1, ...``."""
    extra = extra or []
    rows = docs.select(F.col(doc_id).alias("_q_id"), *[F.col(f"`{c}`").alias(f"_q_x{i}") for i, c in enumerate(extra)], F.col(text).alias("_q_text"))
    rows = stored(fingerprints(rows, "_q_text", size=size), "fingerprints")
    classes = rows.groupBy("_q_fp").agg(F.min("_q_id").alias("_q_low"))
    classes = stored(classes, "classes")
    member = components(links(classes, "_q_fp", distance))
    linked = classes.join(member, F.col("_q_fp") == F.col("node")).select("_q_fp", "label", "_q_low")
    lowest = linked.groupBy("label").agg(F.min("_q_low").alias("_q_component"))
    # every class with its component: linked ones through the label, the others are their own
    named = linked.join(lowest, "label").select("_q_fp", "_q_component")
    own = classes.join(member, F.col("_q_fp") == F.col("node"), "left_anti").select("_q_fp", F.col("_q_low").alias("_q_component"))
    return rows.join(named.union(own), "_q_fp")


def op10_simhash(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = near_duplicates(docs, "doc_id", "text")
    return found.select(F.col("_q_id").alias("doc_id"), F.lower(F.lpad(F.hex("_q_fp"), 16, "0")).alias("fingerprint"), F.col("_q_component").alias("component_id"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each component the row with the smallest doc_id stays
    (of rows that share it, the one whose text hashes lowest)."""
    cols = docs.columns
    keyed = docs.select(F.struct(*[F.col(f"`{c}`").alias(c) for c in cols]).alias("_q_row"), F.col("doc_id").alias("_q_id"), F.col("text").alias("_q_text"), F.xxhash64("text").alias("_q_key"))
    found = near_duplicates(keyed.select("_q_id", "_q_key", "_q_text"), "_q_id", "_q_text", extra=["_q_key"])
    best = found.groupBy("_q_component").agg(F.min(F.struct(F.isnull("_q_id").alias("no_id"), "_q_id", F.col("_q_x0").alias("_q_key"))).alias("best"))
    best = best.select(F.col("best._q_id").alias("_q_best"), F.col("best._q_key").alias("_q_best_key"))
    kept = keyed.join(best, F.col("_q_id").eqNullSafe(F.col("_q_best")) & (F.col("_q_key") == F.col("_q_best_key")), "left_semi")
    return kept.dropDuplicates(["_q_id", "_q_key"]).select("_q_row.*")
