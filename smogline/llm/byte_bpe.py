r"""Byte-level BPE: texts to token ids and back, by recursive DuckDB queries.

Each partition has its own in-process DuckDB (one thread, a memory limit, no
file) with two tables made from a ranks file: ``vocab`` (id, bytes) and
``merges`` (left id, right id, merged id), every way to cut a token into two.

Encoding: a text is cut by the pattern; a piece that is a token is that token,
any other starts as one row per byte, keyed by its place.  The recursive query
joins neighbouring rows with ``merges``, contracts each
word's leftmost pair of least rank and goes on with the words that changed,
until no word does.  State is keyed by place, so it never grows beyond the
bytes it began with.  Words of over ``LONG`` bytes contract, at once, all
places of their least pair where no younger pair can arise from it (``bulk``:
no merge with that token has a smaller rank), and else the leftmost only; so
a text without a break takes few rounds.  Each distinct word of a piece of
texts is encoded once; a worker remembers about ``WORDS_KEPT`` words, and when
they are more, it goes on with those that it met in several pieces.

Decoding: token rows join ``vocab``; the bytes in the order of the tokens' places
are cut by document.

Nothing is shuffled; the ranks file is read by the driver and broadcast (under
1 MB).  Texts go through in pieces of about ``PIECE_BYTES``; a longer text is
cut into slices of ``SLICE_WORDS`` words, its hashes carried on.

Defined results: a null or empty text has no tokens; repeated rows are encoded
alike, each on its own; special strings in a text are ordinary text; null ids
decode to no bytes, an id that is not in the ranks is an error.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, table, tune

LONG = 256
WORDS_KEPT = 1_000_000
PIECE_BYTES = 4 << 20
SLICE_WORDS = 500_000
#: words of one recursive query; more fit no longer in the processor's cache
ROUND_WORDS = 16_000

_ENCODE = """
WITH RECURSIVE state(place, word, token) USING KEY (place) AS (
  SELECT place, word, token FROM bytes
  UNION
  (WITH live AS (
     SELECT place, word, token, lead(place) OVER o AS gone, lead(token) OVER o AS next, lead(word) OVER o AS same
     FROM recurring.state WHERE token >= 0 AND word IN (SELECT word FROM state) WINDOW o AS (ORDER BY place)),
   pairs AS (
     SELECT word, merged::BIGINT << 32 | place AS least, gone
     FROM live JOIN merges ON pair = (token::BIGINT << 32 | next) WHERE word = same),
   cut AS (SELECT word, min(least) AS least, arg_min(gone, least) AS gone FROM pairs GROUP BY word)
   SELECT (least & 4294967295)::INTEGER, word, (least >> 32)::INTEGER FROM cut UNION ALL SELECT gone, word, -1 FROM cut)
)
SELECT word, token FROM state WHERE token >= 0 ORDER BY place
"""

_ENCODE_LONG = """
WITH RECURSIVE state(place, word, token) USING KEY (place) AS (
  SELECT place, word, token FROM bytes
  UNION
  (WITH live AS (
     SELECT place, word, token, lead(token) OVER (PARTITION BY word ORDER BY place) AS next
     FROM recurring.state WHERE token >= 0 AND word IN (SELECT word FROM state)),
   pairs AS (
     SELECT place, word, merged, bulk, min(merged) OVER (PARTITION BY word) AS least, row_number() OVER (PARTITION BY word ORDER BY place) AS i
     FROM live LEFT JOIN merges ON pair = (token::BIGINT << 32 | next)),
   runs AS (
     SELECT *, CASE WHEN merged = least THEN i - row_number() OVER (PARTITION BY word, merged ORDER BY place) END AS run
     FROM pairs WHERE least IS NOT NULL),
   cut AS (  -- in a run of overlapping pairs every second one, from the left
     SELECT place, word, least, coalesce(merged = least, false) AND CASE
       WHEN bulk THEN row_number() OVER (PARTITION BY word, run ORDER BY place) % 2 = 1
       ELSE place = min(place) FILTER (merged = least) OVER (PARTITION BY word) END AS head
     FROM runs),
   moved AS (
     SELECT place, word, least, head, lag(head, 1, false) OVER (PARTITION BY word ORDER BY place) AS gone FROM cut)
   SELECT place, word, CASE WHEN head THEN least ELSE -1 END FROM moved WHERE head OR gone)
)
SELECT word, token FROM state WHERE token >= 0 ORDER BY place
"""

_DECODE = "SELECT place, bytes FROM tokens LEFT JOIN vocab ON id = token"


def _ragged(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The slices of ``flat`` one after another."""
    ends = np.cumsum(lengths)
    return flat[np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)]


def _ranges(chars: list[int]) -> str:
    """Code points as the inside of a character class."""
    x = np.array(chars, np.int64)
    cut = np.flatnonzero(np.diff(x) > 1)
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(x[np.concatenate([[0], cut + 1])], x[np.concatenate([cut, [len(x) - 1]])]))


class Pattern:
    """The pattern with tiktoken's character classes: the two regex libraries know different versions
    of Unicode.  A text with a code point on which they differ is split with the classes written out."""

    def __init__(self, pattern: str):
        import regex
        import tiktoken

        self.plain = regex.compile(pattern)
        every = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
        text = "".join(map(chr, every))
        spelt, odd = {}, set()
        for name in set(re.findall(r"\\[pP]\{\w+\}", pattern)):
            bytewise = tiktoken.Encoding("class", pat_str=name, mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={})
            theirs = [ord(c) for c in bytes(bytewise.encode_ordinary(text)).decode()]
            odd.update(set(theirs) ^ {ord(c) for c in regex.findall(name, text)})
            spelt[name] = _ranges(theirs) if theirs else name
        self.odd = None
        if odd:
            self.high = re.compile(f"[{chr(min(odd))}-\U0010ffff]")
            self.odd = re.compile(f"[{_ranges(sorted(odd))}]")
            out, inside = [], False
            for part in re.findall(r"\\[pP]\{\w+\}|\\.|.", pattern, re.S):
                inside = part == "[" or inside and part != "]"
                out.append(part if part not in spelt else spelt[part] if inside else f"[{spelt[part]}]")
            self.spelt = regex.compile("".join(out))

    def of(self, text: str):
        if self.odd is not None and self.high.search(text) and self.odd.search(text):
            return self.spelt
        return self.plain

    def split(self, text: str) -> list[str]:
        return self.of(text).findall(text)


class _Numbers(dict):
    """Words numbered as they are first asked for."""

    def __missing__(self, word: str) -> int:
        at = self[word] = len(self)
        return at


class Codec:
    """A worker's DuckDB for one ranks file and pattern."""

    def __init__(self, ranks: bytes, pattern: str):
        import duckdb

        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines()) if a}
        missing = [i for i in range(256) if bytes([i]) not in self.ranks]
        if missing:
            raise ValueError(f"the ranks file has no token for the bytes {missing[:5]}")
        self.byte = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        self.pattern = Pattern(pattern)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "512MB", "temp_directory": ""})
        vocab = pa.table({"id": pa.array(self.ranks.values(), pa.int32()), "bytes": pa.array(self.ranks.keys(), pa.binary())})
        self.db.register("given", vocab)
        self.db.execute("CREATE TABLE vocab AS FROM given")
        cuts = [(self.ranks[t[:k]], self.ranks[t[k:]], m) for t, m in self.ranks.items() for k in range(1, len(t)) if t[:k] in self.ranks and t[k:] in self.ranks]
        left, right, merged = (pa.array(x, pa.int32()) for x in (zip(*cuts) if cuts else ((), (), ())))
        self.db.register("given", pa.table({"l": left, "r": right, "merged": merged}))
        self.db.execute(
            """CREATE TABLE merges AS
            SELECT l::BIGINT << 32 | r AS pair, merged, coalesce(youngest > merged, true) AS bulk FROM given LEFT JOIN (
              SELECT part, min(merged) AS youngest FROM (SELECT l AS part, merged FROM given UNION ALL SELECT r, merged FROM given) GROUP BY part
            ) ON part = merged"""
        )
        self.db.unregister("given")
        self.known = _Numbers()
        self.flat, self.bounds, self.met = np.zeros(0, np.int32), np.zeros(1, np.int64), np.zeros(0, np.int64)

    def forget(self, keep: int = 0) -> None:
        """Forget all words, or all but those met in several pieces, if these are at most ``keep``."""
        often = np.flatnonzero(self.met > 1) if keep else np.zeros(0, np.int64)
        often = often if len(often) <= keep else often[:0]
        names, count = list(self.known), np.diff(self.bounds)[often]
        self.flat = _ragged(self.flat, self.bounds[often], count)
        self.known = _Numbers((names[i], k) for k, i in enumerate(often))
        self.bounds, self.met = np.concatenate([[0], np.cumsum(count)]), np.zeros(len(often), np.int64)

    def _contract(self, words: list[bytes], query: str) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of the words one after another, and how many each has."""
        size = np.array([len(w) for w in words])
        token = self.byte[np.frombuffer(b"".join(words), np.uint8)]
        rows = pa.table({"place": np.arange(len(token), dtype=np.int32), "word": np.repeat(np.arange(len(words), dtype=np.int32), size), "token": token})
        self.db.register("bytes", rows)
        out = self.db.sql(query).to_arrow_table()
        self.db.unregister("bytes")
        return out.column("token").to_numpy(), np.bincount(out.column("word").to_numpy(), minlength=len(words))

    def learn(self, words: list[str]) -> None:
        """Encode words that have just got their numbers."""
        raw = [w.encode() for w in words]
        count, kinds = np.ones(len(raw), np.int64), np.zeros(len(raw), np.int8)
        for i, w in enumerate(raw):
            kinds[i] = 0 if w in self.ranks else 1 if len(w) <= LONG else 2
        # words of one length together: a query's rounds follow its longest word, and each scans all its rows
        order = np.lexsort((np.array([len(w) for w in raw]), kinds))
        ends = np.searchsorted(kinds[order], (0, 1, 2), "right")
        parts = [np.array([self.ranks[raw[i]] for i in order[: ends[0]]], np.int32)]
        for every, query in ((order[ends[0] : ends[1]], _ENCODE), (order[ends[1] : ends[2]], _ENCODE_LONG)):
            for a in range(0, len(every), ROUND_WORDS):
                which = every[a : a + ROUND_WORDS]
                tokens, count[which] = self._contract([raw[i] for i in which], query)
                parts.append(tokens)
        # from that order to the order of words
        starts = np.empty(len(raw), np.int64)
        starts[order] = np.cumsum(count[order]) - count[order]
        self.flat = np.concatenate([self.flat, _ragged(np.concatenate(parts), starts, count)])
        self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(count)])
        self.met = np.concatenate([self.met, np.zeros(len(words), np.int64)])

    def ids(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of texts given as words, one after another, and how many each has."""
        if len(self.known) > WORDS_KEPT:
            self.forget(WORDS_KEPT // 2)
        old = len(self.known)
        words = np.fromiter(map(self.known.__getitem__, itertools.chain.from_iterable(texts)), np.int64, sum(map(len, texts)))
        if len(self.known) > old:
            try:
                self.learn(list(itertools.islice(self.known, old, None)))
            except BaseException:
                self.known = _Numbers(itertools.islice(self.known.items(), old))
                raise
        self.met += np.bincount(words, minlength=len(self.met)) > 0
        count = np.diff(self.bounds)[words]
        ends = np.concatenate([[0], np.cumsum(count)])[np.cumsum([0, *map(len, texts)])]
        return _ragged(self.flat, self.bounds[words], count), np.diff(ends)

    def bytes(self, ids: np.ndarray, counts: np.ndarray) -> list[memoryview]:
        """The bytes of texts given by their ids, one after another."""
        self.db.register("tokens", pa.table({"place": np.arange(len(ids), dtype=np.int32), "token": ids.astype(np.int32)}))
        found = self.db.sql(_DECODE).to_arrow_table()
        self.db.unregister("tokens")
        if found.column("bytes").null_count:
            raise ValueError("a token id is not in the ranks file")
        place = found.column("place").to_numpy()
        if (np.diff(place) < 0).any():  # the join keeps the order of the tokens; nothing relies on it
            found = found.take(np.argsort(place))
        data, size = _joined(found.column("bytes"))
        ends = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(counts)])]
        return [data[a:b] for a, b in zip(ends[:-1], ends[1:])]

    def slices(self, text: bytes) -> Iterator[list[str]]:
        """The words of one text, in slices."""
        s = text.decode()
        if len(text) <= PIECE_BYTES:
            yield self.pattern.of(s).findall(s)
            return
        words: list[str] = []
        for m in self.pattern.of(s).finditer(s):
            words.append(m.group())
            if len(words) == SLICE_WORDS:
                yield words
                words = []
        yield words


def _joined(column: pa.ChunkedArray) -> tuple[memoryview, np.ndarray]:
    """Byte strings as one run of bytes, and the length of each."""
    runs, sizes = [], [np.zeros(0, np.int64)]
    for values in column.chunks:
        wide = pa.types.is_large_binary(values.type)
        offsets = np.frombuffer(values.buffers()[1], np.int64 if wide else np.int32)[values.offset : values.offset + len(values) + 1]
        if len(values):
            runs.append(memoryview(values.buffers()[2] or b"")[offsets[0] : offsets[-1]])
            sizes.append(np.diff(offsets))
    return memoryview(b"".join(runs)), np.concatenate(sizes)


_ready: dict[tuple[int, str], Codec] = {}  # per worker


def codec(shared: Broadcast, pattern: str) -> Codec:
    key = (hash(shared.value), pattern)
    if key not in _ready:
        _ready[key] = Codec(shared.value, pattern)
    return _ready[key]


def share(spark: SparkSession, path: str) -> Broadcast:
    """The ranks file, read by the driver, for all workers."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def _renamed(df: DataFrame, column: str) -> tuple[DataFrame, list[str]]:
    names = [f"_q_{i}" for i in range(len(df.columns))]
    rows = df.select(*[F.col(f"`{c}`").alias(x) for c, x in zip(df.columns, names)], F.col(f"`{column}`").alias("_q_in"))
    return rows, names


def encode(df: DataFrame, text: str, path: str, pattern: str) -> DataFrame:
    """All columns of ``df`` as ``_q_0, _q_1, ...`` with ``_q_ids`` (array of int; null or empty text: empty)."""
    tune(df.sparkSession)
    shared = share(df.sparkSession, path)
    rows, names = _renamed(df, text)
    schema = rows.select(*names, F.array().cast("array<int>").alias("_q_ids")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(shared, pattern)
        for part, texts in chunks(batches, "_q_in", PIECE_BYTES):
            ids = [np.concatenate([c.ids([words])[0] for words in c.slices(x)]) for x in texts]
            column = pa.ListArray.from_arrays(np.cumsum([0, *map(len, ids)]).astype(np.int32), pa.array(np.concatenate(ids)))
            yield from pa.table([*part.columns[: len(names)], column], names=[*names, "_q_ids"]).combine_chunks().to_batches()

    return rows.mapInArrow(run, schema)


def decode(df: DataFrame, ids: str, path: str, pattern: str) -> DataFrame:
    """All columns of ``df`` as ``_q_0, _q_1, ...`` with ``_q_bytes`` (binary; null ids: empty)."""
    tune(df.sparkSession)
    shared = share(df.sparkSession, path)
    rows, names = _renamed(df, ids)
    schema = rows.select(*names, F.lit(b"").alias("_q_bytes")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(shared, pattern)
        for batch in batches:
            lists = batch.column(len(names))
            found = c.bytes(lists.flatten().to_numpy(zero_copy_only=False), lists.value_lengths().fill_null(0).to_numpy())
            column = pa.array([x.tobytes() for x in found], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], column], names=[*names, "_q_bytes"])

    return rows.mapInArrow(run, schema)


def digests(df: DataFrame, text: str, path: str, pattern: str) -> DataFrame:
    """All columns of ``df`` as ``_q_0, _q_1, ...`` with ``_q_tokens``, and the SHA-256 of the ids
    (``_q_ids``, little-endian unsigned 32-bit) and of the bytes decoded from them (``_q_decoded``):
    encoding and decoding in one pass, the ids never leaving the worker."""
    tune(df.sparkSession)
    shared = share(df.sparkSession, path)
    rows, names = _renamed(df, text)
    made = [F.lit(0).cast("long").alias("_q_tokens"), F.lit("").alias("_q_ids"), F.lit("").alias("_q_decoded")]
    schema = rows.select(*names, *made).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(shared, pattern)
        for part, texts in chunks(batches, "_q_in", PIECE_BYTES):
            tokens = np.zeros(len(texts), np.int64)
            hashes = [(hashlib.sha256(), hashlib.sha256()) for _ in texts]

            def add(which: list[int], words: list[list[str]]) -> None:
                ids, counts = c.ids(words)
                tokens[which] += counts
                raw, ends = memoryview(ids.astype("<u4").tobytes()), np.cumsum(counts)
                for i, a, b, decoded in zip(which, ends - counts, ends, c.bytes(ids, counts)):
                    hashes[i][0].update(raw[4 * a : 4 * b])
                    hashes[i][1].update(decoded)

            short = [i for i, x in enumerate(texts) if len(x) <= PIECE_BYTES]
            add(short, [c.pattern.split(texts[i].decode()) for i in short])
            for i, x in enumerate(texts):
                if len(x) > PIECE_BYTES:
                    for words in c.slices(x):
                        add([i], [words])
            columns = [pa.array(tokens), pa.array([a.hexdigest() for a, _ in hashes]), pa.array([b.hexdigest() for _, b in hashes])]
            yield from pa.table([*part.columns[: len(names)], *columns], names=schema.names).combine_chunks().to_batches()

    return rows.mapInArrow(run, schema)


def op12_byte_bpe(spark: SparkSession, sf_dir: str, ranks: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """Every whole text of ``documents`` encoded and decoded again."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", "text")
    out = digests(docs, "text", str(public_tokenizers.path(ranks)), public_tokenizers.PATTERN)
    return out.select(F.col("_q_0").alias("doc_id"), F.col("_q_tokens").alias("n_tokens"), F.col("_q_ids").alias("ids_sha256"), F.col("_q_decoded").alias("decoded_sha256"))
