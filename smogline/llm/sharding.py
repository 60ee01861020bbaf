"""Sharding by extendible hashing.

A row's hash is 60 bits of an md5 over id and text.  The directory is indexed
by hash prefixes: it starts as one bucket, and only a bucket above the byte
limit splits on the next bit, until every bucket fits.  A bucket of depth d
with prefix p is named by the number 2^d + p, so its parent is the number
shifted right by one.

Splitting is planned on sums: bytes per prefix of some bits (pre-aggregated,
about ``FINE`` times as many cells as shards), rolled up to every shorter
prefix.  A bucket is the shortest prefix that fits and whose ancestors all do
not.  Cells that still do not fit at that depth are looked at with more bits
in the next round; the others are done.  Texts are hashed where they are read,
only numbers are shuffled.

Defined results: a null text has 0 bytes.  Rows with equal id and text have
equal hashes and stay together; a bucket that 60 bits cannot divide (one row,
or copies of one row, above the limit) is closed as it is and marked
``oversized``.  Empty table: empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free, stored, table

BITS = 60
LIMIT = 8 << 20
FINE = 32


def row_hash(doc_id: str, text: str):
    joined = F.concat(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.col(f"`{text}`"), F.lit("")))
    return F.conv(F.substring(F.md5(joined.cast("binary")), 1, BITS // 4), 16, 10).cast("long")


def directory(rows: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Buckets (shard, depth, shard_bytes, shard_rows, oversized) of ``rows``
    (_q_hash, _q_bytes); shards are 2^depth + prefix."""
    total = rows.agg(F.sum("_q_bytes")).first()[0] or 0
    depth = 0
    while depth < BITS and (total >> depth) * FINE > limit:
        depth += 1
    done, base, todo = None, 0, rows
    while True:
        # cells of this depth, and all their ancestors down to the depth looked at before
        cell = F.lit(1 << depth).cast("long") + F.shiftright("_q_hash", BITS - depth)
        cells = todo.groupBy(cell.alias("cell")).agg(F.sum("_q_bytes").alias("bytes"), F.count("*").alias("n"))
        up = cells.select(F.explode(F.sequence(F.lit(0), F.lit(depth - base))).alias("up"), "cell", "bytes", "n")
        up = up.select((F.lit(depth) - F.col("up")).alias("depth"), F.expr("shiftright(cell, up)").alias("node"), "bytes", "n")
        sums = stored(up.groupBy("depth", "node").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n")), "shards")
        fits = sums.where(F.col("bytes") <= limit)
        above = fits.select((F.col("node") * 2).alias("child")).union(fits.select((F.col("node") * 2 + 1).alias("child")))
        # the parent is a bucket or below one: not a bucket itself
        shut = fits.join(above, F.col("node") == F.col("child"), "left_anti").select(F.col("node").alias("shard"), "depth", F.col("bytes").alias("shard_bytes"), F.col("n").alias("shard_rows"), F.lit(False).alias("oversized"))
        open_ = sums.where((F.col("depth") == depth) & (F.col("bytes") > limit))
        if depth == BITS:
            shut = shut.union(open_.select(F.col("node").alias("shard"), "depth", F.col("bytes").alias("shard_bytes"), F.col("n").alias("shard_rows"), F.lit(True).alias("oversized")))
        done = shut if done is None else done.union(shut)
        if depth == BITS or open_.isEmpty():
            return stored(done, "shards")
        todo = stored(todo.join(open_.select("node"), cell == F.col("node"), "left_semi"), "shards")
        base, depth = depth + 1, min(BITS, depth + 8)


def shard(docs: DataFrame, doc_id: str, text: str, limit: int = LIMIT) -> DataFrame:
    """All columns of ``docs`` as ``_q_0, _q_1, ...`` with ``_q_bytes``, ``_q_hash`` and the row's bucket."""
    cols = [F.col(f"`{c}`").alias(f"_q_{i}") for i, c in enumerate(docs.columns)]
    rows = docs.select(*cols, F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)).cast("long").alias("_q_bytes"), row_hash(doc_id, text).alias("_q_hash"))
    buckets = directory(stored(rows.select("_q_hash", "_q_bytes"), "shards"), limit)
    # a row asks for its prefix at each depth that occurs (60 at most): one of them is its bucket
    depths = sorted(r["depth"] for r in buckets.select("depth").distinct().collect())
    if not depths:
        rows = rows.withColumn("_q_at", F.lit(1).cast("long"))
    else:
        rows = rows.withColumn("_q_at", F.explode(F.array(*[F.lit(1 << d).cast("long") + F.shiftright("_q_hash", BITS - d) for d in depths])))
    return rows.join(buckets, F.col("_q_at") == F.col("shard")).drop("_q_at")


def write_shards(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", limit: int = LIMIT) -> None:
    """Write one folder of Parquet per shard: rows of a shard meet in one task, which holds ``limit`` bytes of text."""
    out = shard(docs, doc_id, text, limit)
    named = out.select(*[F.col(f"_q_{i}").alias(c) for i, c in enumerate(docs.columns)], F.col("shard").alias("_shard"))
    named.repartition("_shard").write.partitionBy("_shard").parquet(path)


def op6_sharding(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    out = shard(docs, "doc_id", "text")
    return out.select(F.col("_q_0").alias("doc_id"), F.col("_q_bytes").alias("n_bytes"), "shard", F.col("depth").cast("int").alias("depth"), "shard_bytes", "oversized")


def sql(limit: int = LIMIT) -> str:
    """DuckDB SQL of the same buckets, for inputs that 24 bits divide."""
    return rf"""
WITH RECURSIVE d AS (SELECT doc_id, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n_bytes,
       CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15) AS BIGINT) AS h FROM documents),
sums AS (SELECT depth, (CAST(1 AS BIGINT) << depth) + (h >> CAST({BITS} - depth AS BIGINT)) AS node, CAST(sum(n_bytes) AS BIGINT) AS bytes
         FROM d, (SELECT CAST(unnest(generate_series(0, 24)) AS BIGINT) AS depth) GROUP BY 1, 2),
tree AS (SELECT * FROM sums WHERE depth = 0
         UNION ALL SELECT s.* FROM sums s JOIN tree t ON s.depth = t.depth + 1 AND (s.node >> 1) = t.node WHERE t.bytes > {limit})
SELECT d.doc_id, d.n_bytes, t.node AS shard, CAST(t.depth AS INTEGER) AS depth, t.bytes AS shard_bytes, false AS oversized
FROM d JOIN tree t ON t.bytes <= {limit} AND (CAST(1 AS BIGINT) << t.depth) + (d.h >> CAST({BITS} - t.depth AS BIGINT)) = t.node
"""


OP6_SQL = sql()


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the columns of the documents and their shard (``shard_id``, ``shard_depth``,
    ``shard_bytes``; a name that the documents have already gets ``_2``, ``_3``, ...)."""
    out = shard(docs, "doc_id", "text")
    name = lambda n: free(n, docs.columns)
    return out.select(*[F.col(f"_q_{i}").alias(c) for i, c in enumerate(docs.columns)], F.col("shard").alias(name("shard_id")),
                      F.col("depth").cast("int").alias(name("shard_depth")), F.col("shard_bytes").alias(name("shard_bytes")))
