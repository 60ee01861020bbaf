"""Byte-level BPE, whitening and the conversation trie against plain versions."""

import base64
import hashlib
import random
import struct
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from smogline.llm import byte_bpe, prefix_trie, whitening

SF = "/root/testdata/sf0.001"
RANKS = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def codec():
    with open(RANKS, "rb") as f:
        return byte_bpe.Codec(f.read(), P.PATTERN)


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoded(codec, texts):
    ids, n = codec.ids([codec.pattern.split(x) for x in texts])
    ends = np.cumsum(n)
    assert [bytes(x).decode() for x in codec.bytes(ids, n)] == texts
    return [ids[e - k : e].tolist() for e, k in zip(ends, n)]


def test_bpe_equals_the_library_on_odd_texts(codec, library):
    rnd = random.Random(5)
    odd = [0x558, 0x58B, 0xC5C, 0x208F, 0x11DE0, 0x11DE9, 0x3FC3D, *range(0x323B0, 0x323F0)]  # Unicode versions differ here
    texts = ["", " ", "a" * 3000, "é" * 500, "<|endoftext|>", " \n\t  x", "\x1c\x1d y", "中文" * 700, "ab" * 900 + "b" * 77]
    texts += ["".join(chr(rnd.choice([32, 10, 39, 0x61, 0x74, 0x31, 0xE9, 0x301, 0x1F600, rnd.randrange(0x4E00, 0x5000), rnd.choice(odd)])) for _ in range(400)) for _ in range(30)]
    assert encoded(codec, texts) == [library.encode_ordinary(x) for x in texts]


def test_bpe_both_queries_agree_on_any_ranks(library):
    """Random ranks, in which a longer token is often older than its parts: no place may contract too early."""
    rnd = random.Random(7)
    for _ in range(6):
        parts = {bytes(rnd.choices(b"abc", k=rnd.randrange(2, 6))) for _ in range(60)}
        order = rnd.sample(sorted(parts), len(parts))
        ranks = {bytes([i]): i for i in range(256)} | {t: 256 + k for k, t in enumerate(order)}
        lines = b"\n".join(base64.b64encode(t) + b" %d" % r for t, r in ranks.items())
        c = byte_bpe.Codec(lines, r"[abc]+")
        lib = tiktoken.Encoding("t", pat_str=r"[abc]+", mergeable_ranks=ranks, special_tokens={})
        words = ["".join(rnd.choices("abc", weights=(6, 2, 1), k=k)) for k in (5, 17, 90, 255, 257, 700) for _ in range(4)]
        assert encoded(c, words) == [lib.encode_ordinary(w) for w in words]


def test_bpe_of_slices_and_a_full_memory(codec, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "WORDS_KEPT", 3)
    monkeypatch.setattr(byte_bpe, "SLICE_WORDS", 10)
    monkeypatch.setattr(byte_bpe, "PIECE_BYTES", 50)
    text = "a long text of words, cut into slices " * 20
    ids = [i for words in codec.slices(text.encode()) for i in codec.ids([words])[0].tolist()]
    assert ids == library.encode_ordinary(text)


def test_bpe_queries_take_words_of_one_length_together(library, monkeypatch):
    """A query's rounds follow its longest word; and decoding does not rely on the order of its join."""
    with open(RANKS, "rb") as f:
        c = byte_bpe.Codec(f.read(), P.PATTERN)
    spans, contract = [], c._contract
    monkeypatch.setattr(byte_bpe, "ROUND_WORDS", 40)
    monkeypatch.setattr(c, "_contract", lambda words, query: spans.append({len(w) for w in words}) or contract(words, query))
    texts = [" ".join("qzx" * k + chr(97 + i // 20) + chr(97 + i % 20) for k in (1, 4, 9, 30)) for i in range(40)]
    assert encoded(c, texts) == [library.encode_ordinary(x) for x in texts]
    assert len(spans) > 3 and max(map(len, spans)) <= 2
    monkeypatch.setattr(byte_bpe, "_DECODE", byte_bpe._DECODE + " ORDER BY hash(place)")
    assert encoded(c, texts) == [library.encode_ordinary(x) for x in texts]


def test_op12_matches_the_library(spark, odd_documents, empty_tables, library):
    def digest(x):
        ids = library.encode_ordinary(x)
        return len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(x.encode()).hexdigest()

    for d in (odd_documents, SF):
        docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()
        want = sorted((-1 if r.doc_id is None else r.doc_id, *digest(r.text or "")) for r in docs)
        got = [(-1 if r.doc_id is None else r.doc_id, *r[1:]) for r in byte_bpe.op12_byte_bpe(spark, d).collect()]
        assert sorted(got) == want
    assert byte_bpe.op12_byte_bpe(spark, empty_tables).count() == 0


def test_bpe_interfaces_with_clashing_names(spark, library):
    docs = spark.createDataFrame([(1, "über  Öl", 5), (2, None, 6), (3, "", 7)], "_q_ids long, _q_in string, place long")
    out = byte_bpe.encode(docs, "_q_in", RANKS, P.PATTERN)
    assert [r._q_ids for r in out.orderBy("_q_0").collect()] == [library.encode_ordinary("über  Öl"), [], []]
    back = byte_bpe.decode(out.withColumnRenamed("_q_ids", "ids"), "ids", RANKS, P.PATTERN).orderBy("_q_0").collect()
    assert [bytes(r._q_bytes).decode() for r in back] == ["über  Öl", "", ""]
    with pytest.raises(Exception, match="not in the ranks"):
        byte_bpe.decode(spark.createDataFrame([([50_300],)], "ids array<int>"), "ids", RANKS, P.PATTERN).collect()


@pytest.mark.parametrize("low, high, shape", [(-80, 80, (200, 5)), (-(2**62), 2**62, (130, 3)), (3, 4, (70, 2)), (0, 2, (1, 4))])
def test_bit_planes_give_exact_products(low, high, shape):
    x = np.random.default_rng(3).integers(low, high, shape)
    x[0, 0] = low
    n, s, c = whitening.cross_products(x)
    o = x.astype(object)
    full = o.T @ o
    assert n == shape[0] and s == list(o.sum(axis=0))
    assert all(c[i][j - i] == full[i, j] for i in range(shape[1]) for j in range(i, shape[1]))


def plain_whitening(rows):
    """vec_id -> (deviation, whitened up to sign, explained), by numpy over all rows."""
    x = np.floor(256.0 * np.array([v for _, v in rows], float))
    u = np.unique(x, axis=0)
    n, s = len(u), u.sum(axis=0)
    e, w = np.linalg.eigh(np.cov(u.T, bias=True).reshape(u.shape[1], -1))
    k = min(4, u.shape[1])
    e4, w4 = e[::-1][:k], w[:, ::-1][:, :k]
    return n, [(i, int(((n * a - s) ** 2).sum()), (a - s / n) @ w4 / np.sqrt(e4), e4 / e.sum()) for (i, _), a in zip(rows, x)]


def test_op11_matches_numpy(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    n, want = plain_whitening(rows)
    got = defaultdict(dict)
    for r in whitening.op11_whitening(spark, SF).collect():
        got[r.vec_id][r.component] = r
        assert r.n == n and r.identity_error < 1e-9
    assert len(got) == len(want)
    flip = {}
    for i, dev, y, explained in want:
        for k in range(4):
            r = got[i][k + 1]
            sign = flip.setdefault(k, 1 if r.whitened * y[k] > 0 else -1)
            assert r.deviation == dev and abs(sign * r.whitened - y[k]) < 1e-8 and abs(r.explained / explained[k] - 1) < 1e-9


def test_whitening_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0, 0.5]), (1, [1.0, 2.0, 0.5]), (2, None), (3, [nan, 0.0, 0.0]), (4, [inf, 0.0, 0.0]), (5, []), (6, [None, 1.0, 1.0]), (7, [1.0, 2.0]), (None, [0.0, -1.0, 0.25]), (8, [0.5, 0.0, 0.5])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, n long")
    out = whitening.whiten(df, "vec_id", "embedding").collect()
    assert sorted((-1 if r._q_id is None else r._q_id, r.component) for r in out) == sorted((i, k) for i in (1, 1, -1, 8) for k in (1, 2, 3))
    assert {r.n for r in out} == {3}  # distinct vectors
    # three points span a plane: the third component has no variance
    assert {r.component for r in out if r.whitened is None} == {3}
    assert all(r.identity_error < 1e-9 for r in out)
    one = whitening.whiten(df.where("vec_id = 1"), "vec_id", "embedding").collect()
    assert {(r.deviation, r.whitened, r.explained, r.identity_error) for r in one} == {(0, None, None, None)}
    assert whitening.whiten(df.where("vec_id = 2"), "vec_id", "embedding").count() == 0
    huge = spark.createDataFrame([(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [1.0, 2.0])], "vec_id long, embedding array<double>")
    assert {r.deviation for r in whitening.whiten(huge, "vec_id", "embedding").collect()} == {None, 513**2 + 768**2}  # clipped entries add up to -1


def brute_trie(rows):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            own[c].append((t is not None, t or 0, hashlib.sha256(f"{len(r)}:{r}{x}".encode()).digest()[:16], (r, x)))
    own = {c: [x[3] for x in sorted(v)] for c, v in own.items()}
    paths = {}
    for c, turns in own.items():
        h, m = zlib.crc32(str(c).encode()) % 6, abs(c) % 100 * (1 if c >= 0 else -1)
        paths[c] = own.get(c - m, [])[:h] + turns[h:]
    members, children, leaves, saved = defaultdict(list), defaultdict(int), defaultdict(int), defaultdict(int)
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members[tuple(p[:d])].append(c)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, m in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += children[node] == 0
            saved[node[:d]] += (len(m) - 1) * len(node[-1][1]) if node else 0
    out = []
    for node, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(paths[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(m), len(node), parent, len(m), children[node], leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def nodes(df):
    return sorted((tuple(r) for r in df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()), key=str)


@pytest.fixture(scope="module")
def odd_turns(spark):
    rnd = random.Random(3)
    rows = []
    for c in range(-120, 260):
        for t in range(rnd.choice([0, 1, 2, 3, 5, 8])):
            rows.append((c, rnd.choice([t, t, t, None]), rnd.choice(["a", "a", "b", None]), rnd.choice(["x", "x", "yy", None, "zzz"])))
            if rnd.random() < 0.05:
                rows.append(rows[-1])
    rows += [(1000 + i, t, "u", "copy") for i in range(300) for t in range(3)]  # a large group of copies
    rows += [(None, 1, "a", "b")] + [(7000, t, "u", f"turn {t}") for t in range(700)]  # a long conversation
    return rows, spark.createDataFrame([(*r, 0, 0) for r in rows], "conv_id long, turn long, role string, text string, depth long, _q_conv long").repartition(5)


@pytest.mark.parametrize("shards, piece", [(1, 1 << 20), (2, 1 << 20), (9, 7), (60, 40)])
def test_trie_is_the_same_for_any_shards(spark, odd_turns, monkeypatch, shards, piece):
    monkeypatch.setattr(prefix_trie, "PIECE", piece)
    rows, df = odd_turns
    paths = prefix_trie.stored(prefix_trie.rebuilt(df, "conv_id", "turn", "role", "text"), "paths")
    assert nodes(prefix_trie.trie(paths, shards)) == brute_trie(rows)


def test_trie_with_few_splitters(spark, odd_turns, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SPLITTER_BYTES", 200)
    rows, df = odd_turns
    paths = prefix_trie.stored(prefix_trie.rebuilt(df, "conv_id", "turn", "role", "text"), "paths")
    assert sum(len(p) for p, _ in prefix_trie.splitters(paths, 40)) <= 200
    assert nodes(prefix_trie.trie(paths, 40)) == brute_trie(rows)


def test_op13_tables_and_sql(spark, odd_turns, tmp_path):
    _, df = odd_turns
    df.select("conv_id", "turn", "role", "text").write.parquet(f"{tmp_path}/conversations.parquet")
    for d, files in ((SF, f"{SF}/conversations.parquet"), (str(tmp_path), f"{tmp_path}/conversations.parquet/*.parquet")):
        with duckdb.connect() as db:
            db.execute(f"CREATE VIEW conversations AS FROM '{files}'")
            want = sorted(db.sql(prefix_trie.OP13_SQL).fetchall(), key=str)
        assert nodes(prefix_trie.op13_prefix_trie(spark, d)) == want
    assert prefix_trie.trie(prefix_trie.rebuilt(df.where("false"), "conv_id", "turn", "role", "text")).count() == 0
