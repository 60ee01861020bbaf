r"""Embedding whitening: exact covariance by bit-sliced scatter, then ``eigh``.

1. Entries become integers x = floor(256 c); the fit list is each distinct
   vector once.  Distinct vectors are found on packed bytes, combined before
   the shuffle, so a vector that a third of the rows share costs one row a task.
2. Bit-sliced scatter: a chunk's entries are shifted by the least of their
   dimension; each dimension's bit planes are packed across rows into 64-bit
   words; the popcount of the AND of two planes, weighted by 2^(p + q), is
   their part of the cross-product.  The shift is taken back exactly.  Chunks
   give integers, in parts of 40 bits, which Spark adds up per pair of dimensions.
3. The driver holds d (d + 1) / 2 sums, however many rows there are: it centres
   them as integers, n C - S S', and only then divides and calls ``eigh``.
4. One pass over the fit list measures the covariance of the whitened values;
   one over the input gives each row its components.

Defined results: rows whose vector is null, empty or holds null or non-finite
entries are left out; of several vector lengths the most frequent one counts
(ties: the longest) and rows of others are left out, too.  Repeated rows each
get their result; a null id stays.  Entries beyond 64 bits are clipped to them.
``deviation`` is null where it does not fit a long.  A component whose variance
is zero, or not distinguishable from zero beside the largest (a ratio of d
times the double's precision), has null ``whitened`` and is not part of
``identity_error``; ``explained`` and ``identity_error`` are null if no
component has variance.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table

SCALE = 256
COMPONENTS = 4
#: entries of a chunk (rows x dimensions): 32 MB of longs
CHUNK_ENTRIES = 1 << 22
_LONG = 1 << 63
#: a sum travels as 40-bit parts: products of any longs, added up over millions of chunks
_LIMBS, _LIMB = ("v0", "v1", "v2", "v3"), (1 << 40) - 1


def _usable(df: DataFrame, id_: str, vec: str) -> DataFrame:
    """``_q_id``, ``_q_vec`` of the rows whose vector has only finite entries."""
    v = F.col("_q_vec")
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = df.select(F.col(f"`{id_}`").alias("_q_id"), F.col(f"`{vec}`").cast("array<double>").alias("_q_vec"))
    return rows.where(v.isNotNull() & (F.size(v) > 0) & ~odd)


def _integers(column: pa.Array, d: int) -> np.ndarray:
    x = np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False))
    inside = np.where(np.abs(x) < _LONG, x, 0.0).astype(np.int64)
    return np.where(x >= _LONG, _LONG - 1, np.where(x < -_LONG, -_LONG, np.where(x == -_LONG, -_LONG, inside))).astype(np.int64).reshape(-1, d)


def _pack(x: np.ndarray) -> list[bytes]:
    """Each vector as bytes, 16 bits an entry where they hold it: equal vectors, equal bytes."""
    small = ((x >= -32768) & (x < 32768)).all(axis=1)
    short, wide = x.astype("<i2"), x.astype("<i8")
    return [short[i].tobytes() if s else wide[i].tobytes() for i, s in enumerate(small)]


def _unpack(column: pa.Array, d: int) -> np.ndarray:
    out = np.empty((len(column), d), np.int64)
    for i, key in enumerate(column.to_pylist()):
        out[i] = np.frombuffer(key, "<i2" if len(key) == 2 * d else "<i8")
    return out


def cross_products(x: np.ndarray) -> tuple[int, list[int], list[list[int]]]:
    """Rows, sums and the upper triangle of sums of products of integer vectors, exact, by bit planes."""
    n, d = x.shape
    low = x.min(axis=0)
    u = x.astype(np.uint64) - low.astype(np.uint64)  # modulo 2^64: exact up to the whole range of longs
    bits = [int(b).bit_length() for b in u.max(axis=0)]
    words = -(-n // 64)
    planes = np.zeros((sum(bits), words * 8), np.uint8)
    dims, shift = np.repeat(np.arange(d), bits), np.concatenate([np.arange(b) for b in bits]).astype(np.uint64)
    for k, (j, p) in enumerate(zip(dims, shift)):
        packed = np.packbits(((u[:, j] >> p) & np.uint64(1)).astype(bool))
        planes[k, : len(packed)] = packed
    planes = planes.view(np.uint64)
    narrow = 2 * max(bits, default=0) + n.bit_length() < 62
    kind = np.int64 if narrow else object
    weight = np.array([1 << int(p) for p in shift], kind)
    sums = np.zeros(d, kind)
    np.add.at(sums, dims, np.bitwise_count(planes).sum(axis=1, dtype=np.int64).astype(kind) * weight)
    products = np.zeros((d, d), kind)
    first = np.searchsorted(dims, np.arange(d + 1))
    some = np.flatnonzero(np.array(bits) > 0)  # a constant dimension has no plane
    for i in some:
        rest = some[some >= i]
        part = np.zeros(first[d] - first[i], kind)
        for k in range(first[i], first[i + 1]):
            counts = np.bitwise_count(planes[k] & planes[first[i] :]).sum(axis=1, dtype=np.int64)
            part += counts.astype(kind) * (weight[k] * weight[first[i] :])
        products[i, rest] = np.add.reduceat(part, first[rest] - first[i])
    m, su = [int(v) for v in low], [int(v) for v in sums]
    s = [su[i] + n * m[i] for i in range(d)]
    c = [[int(products[i, j]) + m[i] * su[j] + m[j] * su[i] + n * m[i] * m[j] for j in range(i, d)] for i in range(d)]
    return n, s, c


def _chunked(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[np.ndarray]:
    kept, rows = [], 0
    for batch in batches:
        if batch.num_rows:
            kept.append(_unpack(batch.column(0), d))
            rows += batch.num_rows
        if rows * d >= CHUNK_ENTRIES:
            yield np.concatenate(kept)
            kept, rows = [], 0
    if kept:
        yield np.concatenate(kept)


class Fit:
    """Exact sums of a fit list and what follows from them."""

    def __init__(self, n: int, s: list[int], c: dict[tuple[int, int], int], components: int):
        self.n, self.s, self.d = n, s, len(s)
        centred = [[n * c[min(i, j), max(i, j)] - s[i] * s[j] for j in range(self.d)] for i in range(self.d)]
        v = np.array([[x / (n * n) for x in row] for row in centred])  # integer division of Python: rounded once
        e, w = np.linalg.eigh(v)
        k = min(components, self.d)
        self.values, self.vectors = e[::-1][:k], w[:, ::-1][:, :k]
        trace = sum(centred[i][i] for i in range(self.d)) / (n * n)
        self.usable = self.values > max(self.d * np.finfo(float).eps * e[-1], 0)
        self.explained = [float(max(x, 0.0) / trace) if trace > 0 else None for x in self.values]

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exact: longs where all of it fits, else Python's integers."""
        most = max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0
        if (self.n * most + max(map(abs, self.s))) ** 2 * self.d < _LONG:
            return self.n * x - np.array(self.s, np.int64)
        return self.n * x.astype(object) - np.array(self.s, object)

    def whitened(self, deviations: np.ndarray) -> np.ndarray:
        scale = np.where(self.usable, np.sqrt(np.where(self.usable, self.values, 1.0)), np.nan)
        return (deviations / self.n).astype(float) @ self.vectors / scale


def fit(rows: DataFrame, d: int, components: int) -> tuple[Fit, DataFrame]:
    """The fit of the distinct vectors of ``_usable`` rows, and those vectors as stored bytes ``_q_key``."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_pack(_integers(batch.column(0), d)), pa.binary())], names=["_q_key"])

    distinct = stored(rows.select("_q_vec").mapInArrow(pack, "_q_key binary").groupBy("_q_key").agg(F.count(F.lit(1)).alias("_q_copies")), "vectors").select("_q_key")

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in _chunked(batches, d):
            n, s, c = cross_products(x)
            cells = [(-1, -1, n)] + [(i, -1, v) for i, v in enumerate(s)] + [(i, i + k, v) for i, row in enumerate(c) for k, v in enumerate(row)]
            i, j, v = zip(*cells)
            top = len(_LIMBS) - 1
            limbs = [pa.array([a >> 40 * k if k == top else a >> 40 * k & _LIMB for a in v], pa.int64()) for k in range(top + 1)]
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), *limbs], names=["i", "j", *_LIMBS])

    parts = distinct.mapInArrow(scatter, "i int, j int, " + ", ".join(f"{x} long" for x in _LIMBS))
    total = {(r.i, r.j): sum(r[x] << 40 * k for k, x in enumerate(_LIMBS)) for r in parts.groupBy("i", "j").agg(*[F.sum(x).alias(x) for x in _LIMBS]).collect()}
    return Fit(total[-1, -1], [total[i, -1] for i in range(d)], total, components), distinct


def identity_error(made: Fit, distinct: DataFrame) -> float | None:
    """The largest absolute entry of the whitened fit list's covariance less the identity."""
    use = np.flatnonzero(made.usable)
    if not len(use):
        return None

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = made.whitened(made.deviations(_unpack(batch.column(0), made.d)))
            yield pa.RecordBatch.from_arrays([pa.array(y[:, k]) for k in use], names=[f"y{k}" for k in use])

    y = distinct.mapInArrow(project, ", ".join(f"y{k} double" for k in use))
    pairs = [(a, b) for a in use for b in use if a <= b]
    cov = y.agg(*[F.covar_pop(f"y{a}", f"y{b}").alias(f"c{a}_{b}") for a, b in pairs]).first()
    return max(abs(cov[f"c{a}_{b}"] - (a == b)) for a, b in pairs)


def whiten(df: DataFrame, id_: str, vec: str, components: int = COMPONENTS) -> DataFrame:
    """Per usable row and component: ``_q_id, component, n, deviation, whitened, explained, identity_error``."""
    schema = "component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = _usable(df, id_, vec)
    out = rows.select("_q_id").schema.fields[0]
    empty = df.sparkSession.createDataFrame([], f"_q_id {out.dataType.simpleString()}, {schema}")
    sizes = rows.groupBy(F.size("_q_vec").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    if not sizes:
        return empty
    d = sizes[0].d
    rows = rows.where(F.size("_q_vec") == d)
    made, distinct = fit(rows, d, components)
    error = identity_error(made, distinct)
    k, names = len(made.values), empty.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.num_rows
            dev = made.deviations(_integers(batch.column(1), d))
            square = [int(x) if x < _LONG else None for x in (dev * dev).sum(axis=1)]
            y = made.whitened(dev).ravel()
            each = np.repeat(np.arange(m), k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, made.n)),
                    pa.array(square, pa.int64()).take(pa.array(each)),
                    pa.array(y, mask=np.isnan(y)),
                    pa.array(made.explained * m, pa.float64()),
                    pa.array([error] * (m * k), pa.float64()),
                ],
                names=names,
            )

    return rows.select("_q_id", "_q_vec").mapInArrow(run, empty.schema)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened coordinates of every usable row of ``embeddings``."""
    rows = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return whiten(rows, "vec_id", "embedding").withColumnRenamed("_q_id", "vec_id")
