"""Language identification by prediction by partial matching (PPM).

Each language has a variable-order byte context tree (order 3 by default).
The probability of a byte in a context is count / (total + distinct), the
escape to the next shorter context has distinct / (total + distinct); below
order 0 every byte has 1/256.  The statistics are frozen after training.  A
text's code length under a language is the exact sum over all its bytes
(ASCII lower-cased); the shortest code wins.

Training sample (documented bound): per label at most ``docs_per_label``
distinct texts of at most ``max_doc_bytes`` bytes each, chosen by a hash.
Copies of one text count once and are dropped before anything reaches the
driver, so no group of copies fills the sample.  A label with fewer such texts
also takes whole longer ones, by hash, while all its texts stay within
``label_bytes``; a label whose every text is above that learns from that much
of its shortest one.  Only text and label are learned from.  Scoring reads
every whole text.

For speed the trees of all labels share one automaton: a state is the longest
context in any tree, so code lengths become two table look-ups per byte, done
for many 256-byte segments at once.  A segment starts in the state reached
after the ``order`` bytes before it, which is the state of the whole text
there, so cutting changes nothing.

Broadcast bound: contexts <= (docs_per_label * max_doc_bytes + label_bytes) * labels * order;
a table holds (contexts x byte classes x labels) floats of a sample of that
bound, independent of the number of documents.

Defined results: null text or a text without any letter: ``und``, score 0.
No labelled row to learn from: every text is ``und``.  Ties go to the label
first in code-point order.  Repeated rows are predicted alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free, chunks, held_out, table, tune

ORDER = 3
DOCS_PER_LABEL = 400
MAX_DOC_BYTES = 32_768
LABEL_BYTES = 4 << 20
UNKNOWN = "und"
SEGMENT = 256


@dataclass(frozen=True)
class ContextTrees:
    """Frozen statistics of all labels: byte classes, transitions, code lengths in bits."""

    labels: list[str]
    order: int
    classes: np.ndarray  # 256 -> class of a byte; bytes never seen share one class
    step: np.ndarray  # (states * width,) next state
    bits: np.ndarray  # (states * width, labels) code length
    width: int  # classes, then one more for padding


def fit(samples: dict[str, list[bytes]], order: int = ORDER) -> ContextTrees:
    """Build the context trees from whole sample texts per label."""
    labels = sorted(samples)
    seen = np.zeros(256, bool)
    for texts in samples.values():
        for x in texts:
            seen[np.frombuffer(x.lower(), np.uint8)] = True
    classes = np.full(256, seen.sum(), np.uint8 if seen.sum() < 255 else np.int16)
    classes[seen] = np.arange(seen.sum())
    size = int(seen.sum()) + 1  # the last class: any unseen byte
    classes[65:91] = classes[97:123]

    def grams(texts: list[bytes], n: int) -> np.ndarray:
        out = []
        for x in texts:
            c = classes[np.frombuffer(x, np.uint8)].astype(np.int64)
            if len(c) >= n:
                g = np.zeros(len(c) - n + 1, np.int64)
                for i in range(n):
                    g = g * size + c[i : len(c) - n + 1 + i]
                out.append(g)
        return np.concatenate(out) if out else np.zeros(0, np.int64)

    contexts = [np.zeros(1, np.int64)]
    contexts += [np.unique(np.concatenate([grams(t, k) for t in samples.values()] or [np.zeros(0, np.int64)])) for k in range(1, order + 1)]
    first = np.concatenate([[0], np.cumsum([len(c) for c in contexts])])
    step = np.zeros((first[-1], size + 1), np.int32)
    bits = np.zeros((first[-1], size + 1, len(labels)), np.float32)
    for k, ctx in enumerate(contexts):
        rows = slice(first[k], first[k + 1])
        if k:
            shorter = first[k - 1] + np.searchsorted(contexts[k - 1], ctx % size ** (k - 1))
            step[rows, :size] = step[shorter, :size]
            below = bits[shorter, :size].astype(np.float64)
        else:
            below = np.full((1, size, len(labels)), 8.0)
        if k < order and len(contexts[k + 1]):
            longer = contexts[k + 1]
            step[first[k] + np.searchsorted(ctx, longer // size), longer % size] = first[k + 1] + np.arange(len(longer))
        for j, label in enumerate(labels):
            gram, count = np.unique(grams(samples[label], k + 1), return_counts=True)
            at, sym = np.searchsorted(ctx, gram // size), gram % size
            total = np.bincount(at, count, len(ctx))
            kinds = np.bincount(at, minlength=len(ctx))
            met = total > 0
            code = below[:, :, j] + np.where(met, np.log2((total + kinds) / np.maximum(kinds, 1), where=met, out=np.zeros(len(ctx))), 0.0)[:, None]
            code[at, sym] = np.log2((total[at] + kinds[at]) / count)
            bits[rows, :size, j] = code
    width = size + 1
    return ContextTrees(labels, order, classes, step.reshape(-1), bits.reshape(first[-1] * (size + 1), len(labels)), width)


def code_lengths(trees: ContextTrees, texts: list[bytes]) -> np.ndarray:
    """Bits of every whole text under every label."""
    out = np.zeros((len(texts), len(trees.labels)))
    lengths = np.array([len(x) for x in texts], np.int64)
    if not lengths.sum() or not trees.labels:
        return out
    pieces = -(-lengths // SEGMENT)
    first = np.concatenate([[0], np.cumsum(pieces)])
    cells = np.full(int(first[-1]) * SEGMENT, trees.width - 1, trees.classes.dtype)
    for x, at in zip(texts, first):
        cells[at * SEGMENT : at * SEGMENT + len(x)] = trees.classes[np.frombuffer(x, np.uint8)]
    columns = np.ascontiguousarray(cells.reshape(-1, SEGMENT).T)
    state = np.zeros(columns.shape[1], np.int32)
    inner = np.ones(columns.shape[1], bool)
    inner[first[:-1][pieces > 0]] = False
    inner = np.flatnonzero(inner)  # segments that go on with a text
    for i in range(SEGMENT - trees.order, SEGMENT):
        state[inner] = trees.step[state[inner] * trees.width + columns[i, inner - 1]]
    total = np.zeros((columns.shape[1], len(trees.labels)))
    for i in range(SEGMENT):
        cell = state * trees.width + columns[i]
        total += trees.bits.take(cell, axis=0)
        state = trees.step.take(cell)
    some = np.flatnonzero(pieces)
    out[some] = np.add.reduceat(total, first[some], axis=0)
    return out


def learn(docs: DataFrame, text: str, label: str, training: Column, order: int = ORDER,
          docs_per_label: int = DOCS_PER_LABEL, max_doc_bytes: int = MAX_DOC_BYTES, label_bytes: int = LABEL_BYTES) -> ContextTrees:
    """Fit the trees on the bounded sample of ``docs`` where ``training`` holds.

    The label column must be a code of few values (languages): one count per
    label comes to the driver.
    """
    rows = docs.select(F.col(text).alias("_q_text"), F.col(label).cast("string").alias("_q_label"), training.alias("_q_train"))
    rows = rows.where(F.col("_q_train") & F.col("_q_label").isNotNull() & (F.octet_length("_q_text") > 0))
    rows = rows.withColumns({"_q_key": F.xxhash64("_q_text"), "_q_size": F.octet_length("_q_text")})
    short = F.col("_q_size") <= max_doc_bytes
    found = rows.groupBy("_q_label").agg(*[F.approx_count_distinct(F.when(x, F.col("_q_key"))).alias(n) for n, x in (("short", short), ("long", ~short))]).collect()

    def some(which: Column, counts: dict[str, int]) -> DataFrame:
        """A share of each label's distinct texts by hash, twice what is kept; the exact cut follows on the driver."""
        share = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, 2.0 * docs_per_label / max(1, n))))])
        return rows.where(which & ((F.pmod(F.col("_q_key"), F.lit(1_000_003)) / 1_000_003.0) < F.element_at(share, F.col("_q_label"))))

    kept: dict[str, list] = {r["_q_label"]: [] for r in found}
    counts = {r["_q_label"]: r["short"] for r in found if r["short"]}
    if counts:
        texts = some(short, counts).groupBy("_q_label", "_q_key").agg(F.min("_q_text").alias("_q_text"))
        for r in texts.select("_q_label", "_q_key", F.col("_q_text").cast("binary").alias("_q_text")).toLocalIterator():
            kept[r["_q_label"]].append((r["_q_key"], bytes(r["_q_text"])))
    kept = {k: sorted(v)[:docs_per_label] for k, v in kept.items()}
    counts = {r["_q_label"]: r["long"] for r in found if r["long"] and len(kept[r["_q_label"]]) < docs_per_label}
    if counts:
        sizes = some(~short, counts).groupBy("_q_label", "_q_key").agg(F.min("_q_size").alias("n")).collect()
        chosen: list[tuple[str, int]] = []
        for k in counts:
            own = sorted((r["_q_key"], r["n"]) for r in sizes if r["_q_label"] == k)
            room, places = label_bytes - sum(len(x) for _, x in kept[k]), docs_per_label - len(kept[k])
            fit_in = []
            for key, n in own:
                if n <= room and len(fit_in) < places:
                    fit_in.append(key)
                    room -= n
            if own and not kept[k] and not fit_in:
                fit_in = [min(own, key=lambda x: (x[1], x[0]))[0]]
            chosen += [(k, key) for key in fit_in]
        if chosen:
            wanted = docs.sparkSession.createDataFrame(chosen, "_q_label string, _q_key long")
            whole = rows.where(~short).join(F.broadcast(wanted), ["_q_label", "_q_key"]).groupBy("_q_label", "_q_key").agg(F.min("_q_text").alias("_q_text"))
            for r in whole.select("_q_label", "_q_key", F.substring(F.col("_q_text").cast("binary"), 1, label_bytes).alias("_q_text")).toLocalIterator():
                kept[r["_q_label"]].append((r["_q_key"], bytes(r["_q_text"])))
    return fit({k: [x for _, x in sorted(v)] for k, v in kept.items() if v}, order)


def _letter(text: str) -> Column:
    return F.coalesce(F.col(f"`{text}`").rlike(r"\p{L}"), F.lit(False))


def predict(docs: DataFrame, text: str, trees: ContextTrees, pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """Add the predicted label and its posterior (0 to 1) to every row of ``docs``; a name that
    ``docs`` has already gets ``_2``, ``_3``, ... added."""
    pred, score = free(pred, docs.columns), free(score, docs.columns)
    tune(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(trees)
    source = docs.select(*[F.col(f"`{c}`").alias(f"_q_{i}") for i, c in enumerate(docs.columns)],
                         F.col(f"`{text}`").alias("_q_text"),
                         _letter(text).alias("_q_letter"))
    keep = len(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for rows, texts in chunks(batches, "_q_text", 4 << 20):
            letter = np.array(rows.column("_q_letter").to_pylist(), bool)
            if model.labels:
                bits = code_lengths(model, [x if ok else b"" for x, ok in zip(texts, letter)])
                best = bits.argmin(axis=1)
                weight = np.exp2(bits.min(axis=1, keepdims=True) - bits).sum(axis=1)
            else:
                best, weight, letter = np.zeros(len(texts), int), np.ones(len(texts)), np.zeros(len(texts), bool)
            names = [model.labels[b] if ok else UNKNOWN for b, ok in zip(best, letter)]
            values = np.where(letter, 1.0 / weight, 0.0)
            out = pa.table(list(rows.columns[:keep]) + [pa.array(names, pa.string()), pa.array(values)],
                           names=[f"_q_{i}" for i in range(keep)] + ["_q_pred", "_q_score"])
            yield from out.combine_chunks().to_batches()

    schema = source.select(*[f"_q_{i}" for i in range(keep)], F.lit("").alias("_q_pred"), F.lit(0.0).alias("_q_score")).schema
    done = source.mapInArrow(run, schema)
    return done.select(*[F.col(f"_q_{i}").alias(c) for i, c in enumerate(docs.columns)],
                       F.col("_q_pred").alias(pred), F.col("_q_score").alias(score))


def op7_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    trees = learn(docs, "text", "lang", ~held_out(F.col("doc_id"), 0))
    rows = docs.select("doc_id", held_out(F.col("doc_id"), 0).alias("held_out"), "text")
    return predict(rows, "text", trees).drop("text")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents whose language cannot be told (no letter at all) go.
    Where nothing was learned, that no label fits says nothing about a document."""
    trees = learn(docs, "text", "lang", ~held_out(F.col("doc_id"), 0))
    if not trees.labels:
        return docs.where(_letter("text"))
    return predict(docs, "text", trees, "_q_lang_pred", "_q_lang_score").where(F.col("_q_lang_pred") != UNKNOWN).drop("_q_lang_pred", "_q_lang_score")
