"""Benchmark decontamination by a prefix-filtered set join.

Patterns are the windows of ``window`` consecutive words of the benchmark
items (an item of fewer words, but not none, is one window).  A window's set
are its shingles of ``shingle`` words (a shorter window: all its words).
Shingles are ordered by rarity, that is by how often they occur in all
documents.  A window can only be contained whole where each of its shingles
is, so with containment 1 the necessary prefix is its one rarest shingle:
documents are probed with prefix shingles only.  A probe at a document
position gives the place the window would have; the positional and length
bounds (start >= 0, end <= number of words) drop what cannot fit, and the
item-sized window of words that is left is compared exactly.

Both passes read every whole document; neither shuffles texts.  The benchmark
side is broadcast in blocks of at most ``BLOCK_WINDOWS`` windows (the proven
bound); a larger benchmark takes several passes, the results of a document
are merged over the blocks.  Rarity counts are combined per task before they
are summed.

Defined results: a null or empty text has no words and is never contaminated;
null or wordless items have no windows; items with equal texts are all
reported; repeated documents are judged alike; an empty benchmark hits
nothing.  A null item_id is reported as the empty string.
"""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, stored, table, tune

WINDOW = 10
SHINGLE = 3
#: windows of one broadcast block: about 100 MB in a worker at most
BLOCK_WINDOWS = 200_000
#: blocks chained in one job before the documents are written
CHAIN = 4

# letters, digits and all non-ASCII bytes of UTF-8: the contract's words
_WORDS = regex.compile(rb"[a-z0-9\x80-\xff]+")


def words(text: bytes) -> list[bytes]:
    return _WORDS.findall(text.lower())


def windows(item: list[bytes], window: int) -> list[tuple[bytes, ...]]:
    if not item:
        return []
    return [tuple(item[i : i + window]) for i in range(max(1, len(item) - window + 1))]


def _shingles(run: tuple[bytes, ...], size: int) -> list[tuple[bytes, ...]]:
    size = min(size, len(run))
    return [run[i : i + size] for i in range(len(run) - size + 1)]


class Block:
    """Windows of some items: shingle -> windows it is the prefix of."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int, shingle: int):
        self.items: dict[tuple, set[str]] = defaultdict(set)
        for name, item in items:
            for run in windows(item, window):
                self.items[run].add(name)
        self.size = shingle
        self.sizes = sorted({min(shingle, len(run)) for run in self.items})
        self.shingles = {s for run in self.items for s in _shingles(run, shingle)}
        self.prefix: dict[tuple, list[tuple[int, tuple]]] = {}

    def order(self, seen: dict[tuple, int]) -> None:
        """Index every window under its rarest shingle; ties by the shingle itself."""
        index = defaultdict(list)
        for run in self.items:
            parts = _shingles(run, self.size)
            offset = min(range(len(parts)), key=lambda i: (seen.get(parts[i], 0), parts[i]))
            index[parts[offset]].append((offset, run))
        self.prefix = dict(index)

    def count(self, text: list[bytes], into: Counter) -> None:
        for n in self.sizes:
            into.update(s for s in zip(*[text[i:] for i in range(n)]) if s in self.shingles)

    def spans(self, text: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged (start, end) of all occurring windows, and their items."""
        found, names = [], set()
        prefix = self.prefix
        for n in self.sizes:
            for at, s in enumerate(zip(*[text[i:] for i in range(n)])):
                if s in prefix:
                    for offset, run in prefix[s]:
                        start = at - offset
                        end = start + len(run)
                        if start >= 0 and end <= len(text) and tuple(text[start:end]) == run:
                            found.append((start, end))
                            names |= self.items[run]
        return merged(found), names


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [tuple(x) for x in out]


def _blocks(bench: DataFrame, window: int, shingle: int, limit: int) -> Iterator[Block]:
    items: list[tuple[str, list[bytes]]] = []
    size = 0
    for r in bench.toLocalIterator():  # item by item: the driver holds one block
        item = words(bytes(r["_q_text"] or b""))
        items.append((r["_q_item"] or "", item))
        size += max(1, len(item) - window + 1)
        if size >= limit:
            yield Block(items, window, shingle)
            items, size = [], 0
    if items:
        yield Block(items, window, shingle)


def _rarity(rows: DataFrame, block: Block) -> dict[tuple, int]:
    """How often each shingle of the block occurs in all documents."""
    shared = rows.sparkSession.sparkContext.broadcast(block)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for _, texts in chunks(batches, "_q_text"):
            for x in texts:
                shared.value.count(words(x), seen)
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([b" ".join(s) for s in seen], pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["s", "n"])

    sums = rows.select("_q_text").mapInArrow(count, "s binary, n long").groupBy("s").agg(F.sum("n").alias("n"))
    out = {tuple(bytes(r["s"]).split(b" ")): r["n"] for r in sums.collect()}  # at most the block's shingles
    shared.unpersist()
    return out


def find(docs: DataFrame, text: str, bench: DataFrame, item_id: str, item_text: str, window: int = WINDOW,
         shingle: int = SHINGLE, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """All columns of ``docs`` as ``_q_0, _q_1, ...``, then ``_q_words`` (number
    of words), ``_q_spans`` (merged word spans that windows hit, end exclusive)
    and ``_q_items`` (items with occurring windows, as strings)."""
    tune(docs.sparkSession)
    n = len(docs.columns)
    names = [f"_q_{i}" for i in range(n)]
    rows = docs.select(*[F.col(f"`{c}`").alias(x) for c, x in zip(docs.columns, names)], F.col(f"`{text}`").cast("binary").alias("_q_text"),
                       F.lit(0).cast("long").alias("_q_words"), F.expr("cast(array() as array<struct<s: long, e: long>>)").alias("_q_spans"), F.expr("cast(array() as array<string>)").alias("_q_items"))
    schema = rows.schema
    kinds = [pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())])), pa.list_(pa.string())]
    bench = bench.select(F.col(item_id).cast("string").alias("_q_item"), F.col(item_text).cast("binary").alias("_q_text"))

    def hits(block):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, texts in chunks(batches, "_q_text"):
                lengths, spans, items = [], [], []
                before = zip(part.column("_q_spans").to_pylist(), part.column("_q_items").to_pylist())
                for x, (old, named) in zip(texts, before):
                    w = words(x)
                    new, found = block.value.spans(w) if block else ([], set())
                    lengths.append(len(w))
                    spans.append([{"s": a, "e": b} for a, b in merged(new + [(y["s"], y["e"]) for y in old])])
                    items.append(sorted(found.union(named)))
                out = pa.table([*part.columns[: n + 1], pa.array(lengths, pa.int64()), pa.array(spans, kinds[0]), pa.array(items, kinds[1])], names=[*names, "_q_text", "_q_words", "_q_spans", "_q_items"])
                yield from out.combine_chunks().to_batches()

        return run

    done = 0
    source = rows
    for block in _blocks(bench, window, shingle, block_windows):
        block.order(_rarity(source, block))
        block.shingles = set()
        rows = rows.mapInArrow(hits(docs.sparkSession.sparkContext.broadcast(block)), schema)
        done += 1
        if done % CHAIN == 0:
            rows = stored(rows, "decontaminate")
    if not done:
        rows = rows.mapInArrow(hits(None), schema)
    return rows.drop("_q_text")


def op2_decontaminate(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = find(docs, "text", table(spark, sf_dir, "benchmark", "item_id", "text"), "item_id", "text").drop("_q_1")
    n_hit = F.aggregate("_q_spans", F.lit(0).cast("long"), lambda n, x: n + x["e"] - x["s"])
    out = found.select(F.col("_q_0").alias("doc_id"), F.col("_q_words").alias("n_words"), n_hit.alias("n_hit"), F.size("_q_items").cast("long").alias("n_items"),
                       F.sha2(F.array_join("_q_items", ",").cast("binary"), 256).alias("items_sha256"))
    return out.withColumn("contaminated", F.col("n_hit") > 0)


# every window of every item against every document, by a plain scan for " w1 ... wn "
OP2_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w, row_number() OVER () AS rid FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
win AS (SELECT DISTINCT item, CASE WHEN len(w) <= 10 THEN w ELSE w[i:i + 9] END AS run FROM (SELECT item, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS i FROM b WHERE len(w) > 0)),
size AS (SELECT DISTINCT len(run) AS n FROM win),
place AS (SELECT rid, i, n, w[i:i + n - 1] AS run FROM (SELECT rid, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, size WHERE len(w) >= n)),
hit AS (SELECT p.rid, p.i, p.n, win.item FROM place p JOIN win ON p.run = win.run),
covered AS (SELECT rid, count(DISTINCT pos) AS n_hit FROM (SELECT rid, unnest(generate_series(i, i + n - 1)) AS pos FROM hit) GROUP BY rid),
named AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM hit) GROUP BY rid)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (rid) LEFT JOIN named USING (rid)
"""


def items_digest(items: list[str]) -> str:
    """The digest column of a list of item ids."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that hold a benchmark window go."""
    bench = table(spark, sf_dir, "benchmark", "item_id", "text")
    found = find(docs, "text", bench, "item_id", "text").where(F.size("_q_spans") == 0)
    return found.select(*[F.col(f"_q_{i}").alias(c) for i, c in enumerate(docs.columns)])
