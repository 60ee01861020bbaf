r"""Language-model scores from a log-frequency Bloom filter.

Training: uni- and bigrams of the training texts are counted (combined per
task, then per hash bucket).  A count c has level 1 + floor(log_b c); an
n-gram is put into its bucket's Bloom filter once per level 1, 2, ... up to
its own.  A look-up probes level after level until one is missing; the last
level met stands for the mean count of its range.  So the filter holds no
n-gram and no number, only bits, ``BITS`` per entry.

Score: log10 of the interpolated bigram probability of every token,
``MIX * c(h,w) / c(h) + (1 - MIX) * (c(w) + 0.5) / (N + 0.5 (V + 1))``, all
c() from the filter; the first token's context is the start of a text, and the
end of a text is a token.

Base: the exact add-half unigram score.  Tokens that are frequent (``HEAVY``
of them at most, the top of every bucket) are looked up in a broadcast table
of that bound; all others meet their exact counts in a shuffle by hash bucket,
which no frequent token can fill.

The filter grows with the corpus.  It is broadcast in groups of buckets of at
most ``MAX_FILTER_BYTES`` each (the bound); each further group is a further
pass over the texts.  The unigram filter is needed in every pass.  Above the
bound it goes in groups as well: a pass for each notes the levels of its tokens
beside the texts, one byte a token, and the later passes read them there.

Tokens are compared by 64-bit hashes.  Defined results: a null or empty text
is its end token alone; a null id counts as the empty text when ids are
dealt; repeated rows train as often as they occur and score alike; without
training texts N = V = 0 and every probability is 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks, held_out, stored, table, tune

BITS = 10
PROBES = 4
MIX = 0.6
HEAVY = 65_536
MAX_FILTER_BYTES = 256 << 20
#: quantisation bases: finer for unigrams
BASE = {1: 2**0.5, 2: 2.0}
#: tokens of the corpus per bucket of n-grams
BUCKET_TOKENS = {1: 8_000_000, 2: 4_000_000}
#: bytes of text handled at once
PIECE_BYTES = 4 << 20

_END = b" "  # no word holds white space
_START = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.uint64(0xFFFFFFFF)
_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and shift)."""
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


@dataclass
class Tokens:
    """Tokens of some texts: hash of each distinct one, which one stands at each
    place, and the place where each text starts (and the end)."""

    kinds: np.ndarray
    code: np.ndarray
    at: np.ndarray

    def pairs(self) -> np.ndarray:
        """Hash of each token with the one before it in its text."""
        before = np.empty(len(self.code), np.uint64)
        before[1:] = (self.kinds * np.uint64(3))[self.code[:-1]]
        before[self.at[:-1]] = np.uint64(int(_START) * 3 & 0xFFFFFFFFFFFFFFFF)
        before += _mix(self.kinds)[self.code]
        return _mix(before)

    def before(self, of_kind: np.ndarray, of_start: float) -> np.ndarray:
        """A value of the token before each token."""
        out = np.empty(len(self.code))
        out[1:] = of_kind[self.code[:-1]]
        out[self.at[:-1]] = of_start
        return out


def hashed(texts: list[bytes]) -> Tokens:
    flat: list[bytes] = []
    starts = [0]
    for x in texts:
        flat += x.lower().split()
        flat.append(_END)
        starts.append(len(flat))
    coded = pa.array(flat, pa.large_binary()).dictionary_encode()
    digest = xxhash.xxh64_intdigest
    kinds = np.fromiter((digest(x) for x in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    return Tokens(kinds, coded.indices.to_numpy(), np.array(starts, np.int64))


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets are ranges of hashes, so sorted hashes need no dealing out."""
    return ((h >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of all parts and their summed counts; empties the list."""
    h, n = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
    parts.clear()
    order = np.argsort(h, kind="stable")  # quick on runs that are sorted already
    h, n = h[order], n[order]
    del order
    new = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
    return h[new], np.add.reduceat(n, new, dtype=np.int64) if len(new) else np.zeros(0, np.int64)


def levels(n: np.ndarray, base: float) -> np.ndarray:
    return 1 + np.floor(np.log(n) / np.log(base) + 1e-9).astype(np.int64)


def meant(level: np.ndarray, base: float) -> np.ndarray:
    """The mean count of a level's range; 0 of level 0."""
    low = np.power(base, np.maximum(level, 1) - 1.0)
    return np.where(level > 0, (low + np.maximum(low, low * base - 1)) / 2, 0.0)


def _drawn(h: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """The two numbers from which a level's probes are made."""
    g = _mix(h + np.uint64(level * int(_START) & 0xFFFFFFFFFFFFFFFF))
    return g & _LOW, (g >> np.uint64(32)) | np.uint64(1)


def _cell(low: np.ndarray, high: np.ndarray, probe: int, size: np.ndarray) -> np.ndarray:
    return ((((low + np.uint64(probe) * high) & _LOW) * size) >> np.uint64(32)).astype(np.int64)


def build(h: np.ndarray, n: np.ndarray, base: float) -> bytes:
    """One bucket's filter."""
    level = levels(n, base)
    size = np.uint64(max(64, -(-int(level.sum()) * BITS // 64) * 64))
    bits = np.zeros(int(size), bool)
    for j in range(1, int(level.max(initial=0)) + 1):
        low, high = _drawn(h[level >= j], j)
        for p in range(PROBES):
            bits[_cell(low, high, p, size)] = True
    return np.packbits(bits, bitorder="little").tobytes()


@dataclass
class Filter:
    """Filters of buckets ``first`` .. of ``buckets``, laid end to end."""

    base: float
    buckets: int
    first: int
    parts: list[bytes]
    _bits: np.ndarray | None = field(default=None, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "_bits": None}

    def count(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Estimated counts, and which n-grams belong to these buckets at all."""
        level, mine = self.level(h)
        return meant(level, self.base), mine

    def level(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if self._bits is None:
            self._bits = np.frombuffer(b"".join(self.parts), np.uint8)
            sizes = np.array([len(x) for x in self.parts], np.int64)
            self._size, self._at = (sizes * 8).astype(np.uint64), np.concatenate([[0], np.cumsum(sizes)[:-1]])
            self.parts = [b""] * len(self.parts)
        own = bucket_of(h, self.buckets).astype(np.int64) - self.first
        mine = (own >= 0) & (own < len(self.parts))
        level = np.zeros(len(h), np.int64)
        left = np.flatnonzero(mine)
        g, size, at = h[left], self._size[own[left]], self._at[own[left]]
        j = 1
        while len(left):
            low, high = _drawn(g, j)
            met = np.arange(len(left))  # those that all probes so far found
            z, a = size, at
            for p in range(PROBES):
                cell = _cell(low, high, p, z)
                hit = np.flatnonzero((self._bits[a + (cell >> 3)] >> (cell & 7).astype(np.uint8)) & 1)
                met, low, high, z, a = met[hit], low[hit], high[hit], z[hit], a[hit]
            left, g, size, at = left[met], g[met], z, a
            level[left] = j
            j += 1
        return level, mine


@dataclass
class Model:
    """What a pass needs: exact totals, exact counts of heavy tokens, filters."""

    tokens: int
    kinds: int
    texts: int
    heavy: np.ndarray  # sorted hashes
    heavy_n: np.ndarray
    one: Filter | None  # none: the levels stand beside the texts
    two: Filter


def train(rows: DataFrame, text: str, bits: int = BITS) -> tuple[DataFrame, dict[int, int]]:
    """One row per kind (1, 2) and bucket: totals, the filter, the heaviest
    tokens and, for unigrams, all exact counts; and the numbers of buckets."""
    tune(rows.sparkSession)
    size = rows.agg(F.sum(F.octet_length(text))).first()[0] or 0
    buckets = {k: 1 + size // 6 // t for k, t in BUCKET_TOKENS.items()}
    top = HEAVY // buckets[1] + 1

    def dealt(kind: int, h: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        cut = np.searchsorted(bucket_of(h, buckets[kind]), np.arange(buckets[kind] + 1, dtype=np.uint64))
        n = n.astype(np.uint32)
        for b in range(buckets[kind]):
            part = slice(cut[b], cut[b + 1])
            if cut[b] < cut[b + 1]:
                small = n[part].astype(np.uint8) if n[part].max() < 256 else n[part]
                yield pa.RecordBatch.from_arrays([pa.array([kind], pa.int32()), pa.array([b], pa.int32()), pa.array([h[part].tobytes()], pa.binary()), pa.array([small.tobytes()], pa.binary())], names=["kind", "bucket", "h", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {1: [], 2: []}
        for _, texts in chunks(batches, "_q_text"):
            tokens = hashed(texts)
            held[1].append((tokens.kinds, np.bincount(tokens.code, minlength=len(tokens.kinds)).astype(np.uint32)))
            kinds, often = np.unique(tokens.pairs(), return_counts=True)
            held[2].append((kinds, often.astype(np.uint32)))
            for kind in held:
                if sum(len(h) for h, _ in held[kind]) > 3_000_000:  # combine and send before memory fills
                    yield from dealt(kind, *summed(held[kind]))
        for kind, some in held.items():
            if some:
                yield from dealt(kind, *summed(some))

    def merge(part: pa.Table) -> pa.Table:
        kind, bucket = part.column("kind")[0].as_py(), part.column("bucket")[0].as_py()
        parts = []
        for h, n in zip(part.column("h").to_pylist(), part.column("n").to_pylist()):
            h = np.frombuffer(h, np.uint64)
            parts.append((h, np.frombuffer(n, np.uint8 if len(n) == len(h) else np.uint32).astype(np.uint32)))
        h, n = summed(parts)
        heavy = np.sort(np.argsort(-n, kind="stable")[:top]) if kind == 1 else np.zeros(0, np.int64)
        row = {"kind": kind, "bucket": bucket, "total": int(n.sum()), "distinct": len(h), "filter": build(h, n, BASE[kind]),
               "heavy_h": h[heavy].tobytes(), "heavy_n": n[heavy].tobytes(), "h": h.tobytes() if kind == 1 else b"", "n": n.tobytes() if kind == 1 else b""}
        return pa.table({k: pa.array([v], t) for (k, v), t in zip(row.items(), [pa.int32(), pa.int32(), pa.int64(), pa.int64()] + [pa.binary()] * 5)})

    sent = rows.select(F.col(text).alias("_q_text")).mapInArrow(count, "kind int, bucket int, h binary, n binary")
    return stored(sent.groupBy("kind", "bucket").applyInArrow(merge, "kind int, bucket int, total long, distinct long, filter binary, heavy_h binary, heavy_n binary, h binary, n binary"), "lm"), buckets


def _filters(trained: DataFrame, kind: int, buckets: int, limit: int) -> Iterator[Filter]:
    """Groups of neighbouring buckets of at most ``limit`` bytes; one is fetched at a time."""
    size = {r["bucket"]: r["s"] for r in trained.where(F.col("kind") == kind).select("bucket", F.length("filter").alias("s")).collect()}
    groups, first, held = [], 0, 0
    for b in range(buckets):
        own = size.get(b, 8)
        if b > first and held + own > limit:
            groups.append((first, b))
            first, held = b, 0
        held += own
    groups.append((first, buckets))
    for first, end in groups:
        found = {r["bucket"]: bytes(r["filter"]) for r in trained.where((F.col("kind") == kind) & F.col("bucket").between(first, end - 1)).select("bucket", "filter").toLocalIterator()}
        yield Filter(BASE[kind], buckets, first, [found.get(b, bytes(8)) for b in range(first, end)])


def probabilities(model: Model, tokens: Tokens, level: np.ndarray | None = None) -> np.ndarray:
    """log10 probabilities; 0 for a token whose pair is of another group of buckets."""
    both, mine = model.two.count(tokens.pairs())
    share = lambda single: (1 - MIX) * (single + 0.5) / (model.tokens + 0.5 * (model.kinds + 1))
    if level is None:
        single = model.one.count(tokens.kinds)[0]
        flat, ctx = share(single)[tokens.code], tokens.before(single, float(model.texts))
    else:
        single = meant(level.astype(np.int64), BASE[1])
        flat, ctx = share(single), np.concatenate([[0.0], single[:-1]])
        ctx[tokens.at[:-1]] = float(model.texts)
    seen = ctx > 0
    given = np.minimum(1.0, np.divide(both, ctx, out=np.zeros(len(both)), where=seen))
    p = np.where(seen, MIX * given + flat, flat / (1 - MIX))
    return np.where(mine, np.log10(np.minimum(1.0, p)), 0.0)


def score(docs: DataFrame, text: str, training: Column, max_filter_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """All columns of ``docs`` as ``_q_0, _q_1, ...`` with ``_q_tokens``,
    ``_q_known``, ``_q_train_tokens``, ``_q_base`` and ``_q_score``."""
    spark = docs.sparkSession
    tune(spark)
    n = len(docs.columns)
    names = [f"_q_{i}" for i in range(n)]
    rows = docs.select(*[F.col(f"`{c}`").alias(x) for c, x in zip(docs.columns, names)], F.col(f"`{text}`").cast("binary").alias("_q_text"), training.alias("_q_train"))
    learn = rows.where("_q_train")
    trained, buckets = train(learn.select("_q_text"), "_q_text")
    total = trained.where("kind = 1").agg(F.sum("total").alias("n"), F.sum("distinct").alias("v")).first()
    heavy = trained.where("kind = 1").select("heavy_h", "heavy_n").collect()
    hh = np.concatenate([np.zeros(0, np.uint64)] + [np.frombuffer(bytes(r["heavy_h"]), np.uint64) for r in heavy])
    hn = np.concatenate([np.zeros(0, np.int64)] + [np.frombuffer(bytes(r["heavy_n"]), np.int64) for r in heavy])
    order = np.argsort(hh)
    ones = _filters(trained, 1, buckets[1], max_filter_bytes)
    one, later = next(ones), next(ones, None)
    model = lambda two: spark.sparkContext.broadcast(Model(total["n"] or 0, total["v"] or 0, learn_count, hh[order], hn[order], one, two))
    learn_count = learn.count()

    rows = rows.drop("_q_train").withColumns({"_q_row": F.monotonically_increasing_id(), "_q_score": F.lit(0.0)})
    if later is not None:
        rows = rows.withColumn("_q_level", F.lit(b""))
        for group in chain((one, later), ones):
            rows = stored(rows.mapInArrow(_levels(spark.sparkContext.broadcast(group)), rows.schema), "lm-pass")
        one = later = group = None
    groups = _filters(trained, 2, buckets[2], max_filter_bytes)
    held = next(groups)
    for later in groups:  # every group but the last: a pass of its own
        rows = stored(rows.mapInArrow(_partial(model(held)), rows.schema), "lm-pass")
        held = later
    shared = model(held)
    own = rows.select(*names, "_q_row", F.lit(0).cast("long").alias("_q_tokens"), F.lit(0).cast("long").alias("_q_known"), F.lit(0.0).alias("_q_base"), "_q_score",
                      F.lit(0).alias("_q_bucket"), F.lit(0).cast("long").alias("_q_piece"), F.lit(b"").alias("_q_h"), F.lit(b"").alias("_q_r"), F.lit(b"").alias("_q_n")).schema
    made = stored(rows.mapInArrow(_final(shared, names, pa_kinds(rows, names), buckets[1]), as_nullable(own)), "lm-docs")

    rare = made.where("_q_bucket is not null").select("_q_bucket", "_q_piece", "_q_h", "_q_r", "_q_n")
    counts = trained.where("kind = 1").select("bucket", "h", "n")
    # from each bucket one packed row of sums per piece of texts, then the pieces' rows are added up
    packed = rare.groupBy("_q_bucket").cogroup(counts.groupBy("bucket")).applyInArrow(_rare, "_q_piece long, _q_r binary, _q_part binary, _q_met binary")
    sums = packed.groupBy("_q_piece").applyInArrow(_add_up, "_q_at long, _q_part double, _q_met long")
    out = made.where("_q_bucket is null").join(sums, F.col("_q_row") == F.col("_q_at"), "left")
    norm = float(np.log10((total["n"] or 0) + 0.5 * ((total["v"] or 0) + 1)))
    return out.select(*names, "_q_tokens", (F.col("_q_known") + F.coalesce("_q_met", F.lit(0))).alias("_q_known"), F.lit(total["n"] or 0).cast("long").alias("_q_train_tokens"),
                      (F.col("_q_base") + F.coalesce("_q_part", F.lit(0.0)) - F.col("_q_tokens") * F.lit(norm)).alias("_q_base"), "_q_score")


def as_nullable(schema):
    from pyspark.sql import types as T

    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def pa_kinds(rows: DataFrame, names: list[str]) -> list[pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_schema

    return list(to_arrow_schema(rows.select(*names).schema).types)


def _per_text(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, at[:-1]) if len(at) > 1 else np.zeros(0)


def _noted(part: pa.Table) -> np.ndarray | None:
    """The levels noted beside the texts, if they are: one byte a token."""
    return np.frombuffer(b"".join(part.column("_q_level").to_pylist()), np.uint8) if "_q_level" in part.column_names else None


def _levels(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks(batches, "_q_text", PIECE_BYTES):
            tokens, noted = hashed(texts), _noted(part)
            level = shared.value.level(tokens.kinds)[0].astype(np.uint8)[tokens.code]
            if len(noted):  # a token is of one group only
                level += noted
            column = pa.array([level[a:b].tobytes() for a, b in zip(tokens.at[:-1], tokens.at[1:])], pa.binary())
            yield from part.set_column(part.schema.get_field_index("_q_level"), "_q_level", column).combine_chunks().to_batches()

    return run


def _partial(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks(batches, "_q_text", PIECE_BYTES):
            tokens = hashed(texts)
            value = part.column("_q_score").to_numpy() + _per_text(probabilities(shared.value, tokens, _noted(part)), tokens.at)
            yield from part.set_column(part.schema.get_field_index("_q_score"), "_q_score", pa.array(value)).combine_chunks().to_batches()

    return run


def _final(shared, names: list[str], kinds: list[pa.DataType], buckets: int):
    """Rows of documents (bucket null) and, packed per piece of texts and bucket, of their tokens that are not heavy."""
    last = ["_q_row", "_q_tokens", "_q_known", "_q_base", "_q_score", "_q_bucket", "_q_piece", "_q_h", "_q_r", "_q_n"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for part, texts in chunks(batches, "_q_text", PIECE_BYTES):
            tokens = hashed(texts)
            row = part.column("_q_row").to_numpy()
            value = part.column("_q_score").to_numpy() + _per_text(probabilities(model, tokens, _noted(part)), tokens.at)
            easy, gain = np.zeros(len(tokens.kinds), bool), np.zeros(len(tokens.kinds))
            if len(model.heavy):
                spot = np.minimum(np.searchsorted(model.heavy, tokens.kinds), len(model.heavy) - 1)
                easy = model.heavy[spot] == tokens.kinds
                gain = np.where(easy, np.log10(model.heavy_n[spot] + 0.5), 0.0)
            plain = easy[tokens.code]
            size = np.diff(tokens.at)
            cols = [*part.columns[: len(names)], part.column("_q_row"), pa.array(size), pa.array(_per_text(plain.astype(np.int64), tokens.at)), pa.array(_per_text(gain[tokens.code], tokens.at)), pa.array(value)]
            void = [pa.nulls(len(texts), t) for t in types[5:]]
            yield from pa.table([*cols, *void], names=[*names, *last]).cast(pa.schema(list(zip([*names, *last], [*kinds, *types])))).combine_chunks().to_batches()
            # (token, text) pairs of the others, with how often
            other = np.flatnonzero(~plain)
            who = np.repeat(np.arange(len(texts)), size)[other]
            both, often = np.unique(tokens.code[other].astype(np.int64) * len(texts) + who, return_counts=True)
            h, who = tokens.kinds[both // len(texts)], both % len(texts)
            order = np.argsort(to := bucket_of(h, buckets), kind="stable")
            cut = np.searchsorted(to[order], np.arange(buckets + 1, dtype=np.uint64))
            for b in range(buckets):
                some = order[cut[b] : cut[b + 1]]
                if len(some):
                    yield pa.RecordBatch.from_arrays([pa.nulls(1, k) for k in kinds] + [pa.nulls(1, t) for t in types[:5]] + [
                        pa.array([b], pa.int32()), pa.array([int(row[0])], pa.int64()), pa.array([h[some].tobytes()], pa.binary()),
                        pa.array([row[who[some]].tobytes()], pa.binary()), pa.array([often[some].astype(np.uint32).tobytes()], pa.binary())], names=[*names, *last])

    return run


def _rare(key, tokens: pa.Table, counts: pa.Table) -> pa.Table:
    """Of one bucket, per piece of texts, the sums of each text."""
    kinds, total = np.zeros(1, np.uint64), np.zeros(1, np.int64)
    if counts.num_rows:
        kinds, total = np.frombuffer(counts.column("h")[0].as_py(), np.uint64), np.frombuffer(counts.column("n")[0].as_py(), np.int64)
    out: list[tuple] = []
    for piece, h, who, often in zip(*(tokens.column(c) for c in ("_q_piece", "_q_h", "_q_r", "_q_n"))):
        h, who, often = np.frombuffer(h.as_py(), np.uint64), np.frombuffer(who.as_py(), np.int64), np.frombuffer(often.as_py(), np.uint32).astype(np.int64)
        spot = np.minimum(np.searchsorted(kinds, h), len(kinds) - 1)
        n = np.where(kinds[spot] == h, total[spot], 0)
        rows, at = np.unique(who, return_inverse=True)
        met = np.bincount(at, often * (n > 0), len(rows)).astype(np.int64)
        out.append((piece.as_py(), rows.tobytes(), np.bincount(at, often * np.log10(n + 0.5), len(rows)).tobytes(), met.tobytes()))
    return pa.table([pa.array(list(x), t) for x, t in zip(zip(*out) if out else [[]] * 4, [pa.int64(), pa.binary(), pa.binary(), pa.binary()])], names=["_q_piece", "_q_r", "_q_part", "_q_met"])


def _add_up(part: pa.Table) -> pa.Table:
    glue = lambda name, kind: np.concatenate([np.frombuffer(x, kind) for x in part.column(name).to_pylist()])
    rows, at = np.unique(glue("_q_r", np.int64), return_inverse=True)
    return pa.table({"_q_at": rows, "_q_part": np.bincount(at, glue("_q_part", np.float64), len(rows)), "_q_met": np.bincount(at, glue("_q_met", np.int64), len(rows)).astype(np.int64)})


def op3_lm_score(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    docs = docs.select("doc_id", held_out(F.col("doc_id"), 1).alias("held_out"), "text")
    out = score(docs, "text", ~held_out(F.col("doc_id"), 1)).drop("_q_2")
    return out.select(F.col("_q_0").alias("doc_id"), F.col("_q_1").alias("held_out"), F.col("_q_tokens").alias("n_tokens"), F.col("_q_known").alias("n_known"),
                      F.col("_q_train_tokens").alias("train_tokens"), F.col("_q_base").alias("base_score"), F.col("_q_score").alias("score"))
