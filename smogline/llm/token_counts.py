r"""Token counts of whole texts, with overlap resynchronisation for huge ones.

A text of more than ``CHUNK`` characters is encoded in chunks that overlap,
with offsets.  Two neighbours are spliced at a boundary in their overlap that
both have: a token of the same id starts there in both, and the character
before it is ASCII white space.  Such a boundary is stable: the tokenizer
drops white space before it splits into words, no rule, merge, special token
or composition of characters reaches across it, so the tokens on either side
are those of the whole text.  If an overlap has no such boundary, it is
widened, twofold each time; when it would take in the whole left chunk, that
chunk itself grows, to the whole text at last.

Shorter texts go through the same library word by word (runs between ASCII
white space, for the same reason exact), and a worker remembers the counts of
words it has met, at most ``WORDS_KEPT`` of them.

The tokenizer file is read by the driver and broadcast (1.7 MB); nothing is
shuffled.  Defined results: a null or empty text has 0 bytes and 0 tokens;
repeated rows are counted alike.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, table, tune

CHUNK = 65_536
OVERLAP = 1_024
LIMIT = 2_048
WORDS_KEPT = 500_000
_SPACE = frozenset(" \t\n\x0b\x0c\r")

_ready: dict[int, tuple] = {}  # per worker: hash of the file -> (tokenizer, counts of words)


def load(text: str):
    """The tokenizer of a file's text as the contract uses it, and its word counts so far."""
    key = hash(text)
    if key not in _ready:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # the tasks are the parallelism
        from tokenizers import Tokenizer

        t = Tokenizer.from_str(text)
        t.no_truncation()
        t.no_padding()
        _ready[key] = (t, {})
    return _ready[key]


def _encode(tokenizer, text: str, at: int) -> tuple[np.ndarray, np.ndarray]:
    e = tokenizer.encode(text, add_special_tokens=False)
    starts = np.fromiter((s for s, _ in e.offsets), np.int64, len(e))
    return np.array(e.ids, np.int64), starts + at


def _common(text: str, left: tuple, right: tuple, low: int, high: int) -> int | None:
    """A stable boundary of both encodings in (low, high), the middle one of them."""
    at = {int(p): int(i) for i, p in zip(left[0][::-1], left[1][::-1]) if low < p < high}
    both = []
    before = -1
    for i, p in zip(right[0], right[1]):
        if p >= high:
            break
        if p > low and p != before and at.get(int(p)) == i and text[p - 1] in _SPACE:
            both.append(int(p))
        before = p
    return both[len(both) // 2] if both else None


def spliced(tokenizer, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[int]:
    """Token ids of the whole text from overlapping chunks."""
    if len(text) <= chunk:
        return tokenizer.encode(text, add_special_tokens=False).ids
    out: list[np.ndarray] = []
    start, done, end = 0, 0, chunk  # the left chunk is text[start:end]; tokens before done are out
    left = _encode(tokenizer, text[:end], 0)
    while end < len(text):
        wide = min(overlap, end - start)
        while True:
            begin = end - wide
            stop = min(len(text), begin + max(chunk, 2 * wide))
            right = _encode(tokenizer, text[begin:stop], begin)
            # a boundary after the right chunk's first, perhaps cut, word and before the left one's last
            p = _common(text, left, right, max(begin, done), end)
            if p is not None or begin <= max(start, done):
                break
            wide = min(2 * wide, end - max(start, done))
        if p is None:  # nothing to hold on to in all of the left chunk: grow it
            end = min(len(text), end + chunk)
            left = _encode(tokenizer, text[start:end], start)
            continue
        out.append(left[0][(left[1] >= done) & (left[1] < p)])
        left, start, done, end = right, begin, p, stop
    out.append(left[0][left[1] >= done])
    return np.concatenate(out).tolist()


def count_words(tokenizer, known: dict[bytes, int], texts: list[bytes]) -> list[int]:
    """Token counts of texts by their words, remembered in ``known``."""
    split = [x.split() for x in texts]
    new = list({w for words in split for w in words if w not in known})
    if len(known) + len(new) > WORDS_KEPT:
        known.clear()
        new = list({w for words in split for w in words})
    for at in range(0, len(new), 20_000):
        part = new[at : at + 20_000]
        known.update(zip(part, map(len, tokenizer.encode_batch_fast([w.decode() for w in part], add_special_tokens=False))))
    get = known.__getitem__
    return [sum(map(get, words)) for words in split]


def add_counts(docs: DataFrame, text: str, path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """All columns of ``docs`` as ``_q_0, _q_1, ...`` with ``_q_bytes`` and ``_q_tokens``."""
    tune(docs.sparkSession)
    with open(path, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    n = len(docs.columns)
    names = [f"_q_{i}" for i in range(n)]
    rows = docs.select(*[F.col(f"`{c}`").alias(x) for c, x in zip(docs.columns, names)], F.col(f"`{text}`").alias("_q_text"))
    rows = rows.select(*names, "_q_text")
    schema = rows.select(*names, F.lit(0).cast("long").alias("_q_bytes"), F.lit(0).cast("long").alias("_q_tokens")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, known = load(shared.value)
        for part, texts in chunks(batches, "_q_text", 4 << 20):
            # in UTF-8 a text has at most as many characters as bytes
            huge = {i: s for i, x in enumerate(texts) if len(x) > chunk and len(s := x.decode()) > chunk}
            counts = count_words(tokenizer, known, [b"" if i in huge else x for i, x in enumerate(texts)])
            for i, s in huge.items():
                counts[i] = len(spliced(tokenizer, s, chunk, overlap))
            out = pa.table([*part.columns[:n], pa.array([len(x) for x in texts], pa.int64()), pa.array(counts, pa.int64())], names=[*names, "_q_bytes", "_q_tokens"])
            yield from out.combine_chunks().to_batches()

    return rows.mapInArrow(run, schema)


def op5_token_counts(spark, sf_dir: str, tokenizer: str = "word_bpe_49k.json") -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    out = add_counts(docs.select("doc_id", "text"), "text", str(public_tokenizers.path(tokenizer))).drop("_q_1")
    return out.select(F.col("_q_0").alias("doc_id"), F.col("_q_bytes").alias("n_bytes"), F.col("_q_tokens").alias("n_tokens"), (F.col("_q_tokens") > LIMIT).alias("over_limit"))
