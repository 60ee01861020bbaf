"""The pipeline against its stages by brute force, and on odd and empty tables."""

import collections
import re

import corpus_pipeline
from tests.llm.test_operators import brute_simhash, brute_windows, closure

SF = "/root/testdata/sf0.001"


def test_stages_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas()
    items = [(str(r["item_id"]), r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    left = docs[docs.text.map(lambda x: bool(re.search(r"[^\W\d_]", x or "")))].sort_values("doc_id").reset_index(drop=True)
    label = closure([brute_simhash(x) for x in left.text])
    left = left[[i == k for i, k in enumerate(label)]]
    left = left[left.text.map(lambda x: brute_windows(x, items)[1] == 0)]
    got = corpus_pipeline.run(spark, SF).toPandas()
    copies = collections.Counter(got.doc_id)
    assert set(copies) <= set(left.doc_id) and max(copies.values()) <= 3
    size = dict(zip(left.doc_id, left.text.map(lambda x: len(re.findall(r"[^\x20\x09-\x0D]+", x)))))
    # targets: the water-filling by hand
    sources = sorted(set(left.source))
    total = {s: sum(size[i] for i, x in zip(left.doc_id, left.source) if x == s) for s in sources}
    weight = {s: k % 3 + 1 for k, s in enumerate(sources)}
    fixed = set()
    while True:
        level = (sum(total.values()) - sum(3 * total[s] for s in fixed)) / sum(w for s, w in weight.items() if s not in fixed)
        above = {s for s in sources if s not in fixed and level * weight[s] > 3 * total[s]}
        if not above:
            break
        fixed |= above
    taken = collections.Counter()
    for i, s in zip(got.doc_id, got.source):
        taken[s] += size[i]
    for s in sources:
        target = 3 * total[s] if s in fixed else level * weight[s]
        assert abs(taken[s] - target) <= max(max(size[i] for i, x in zip(left.doc_id, left.source) if x == s) / 2, 1)
    assert list(got.columns)[: len(docs.columns)] == list(docs.columns) and (got.shard_bytes <= 8 << 20).all()


def test_odd_rows_keep_their_columns(spark, odd_documents, empty_tables):
    docs = spark.read.parquet(f"{odd_documents}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, odd_documents)
        added = ["shard_id", "shard_depth", "shard_bytes"] if name == "shard" else []
        assert out.columns == docs.columns + added, name
        out.count()
    # columns named like those that operators add
    clash = docs.selectExpr("*", "1 AS shard_id", "2 AS SHARD_bytes", "'x' AS lang_pred", "3 AS taken", "4 AS _q_0", "5 AS target", "6 AS hash", "7 AS component_id")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, clash, odd_documents)
        assert out.columns[: len(clash.columns)] == clash.columns, name
        assert out.where("shard_id <> 1").count() == 0 if name != "shard" else {"shard_id_2", "shard_depth", "shard_bytes_2"} <= set(out.columns)
    # of the repeated rows and their near copy one stays; documents without letters go; a benchmark passage goes
    one, ten, two = (dict(corpus_pipeline.STAGES)[x](spark, docs, odd_documents).toPandas() for x in ("language_id", "simhash_dedup", "decontaminate"))
    assert sorted(one.doc_id.dropna()) == [1, 1, 2, 7, 9, 10, 11]
    assert list(ten.doc_id).count(1) == 1
    assert 11 not in set(two.doc_id) and 9 not in set(two.doc_id) and 7 in set(two.doc_id)
    assert corpus_pipeline.run(spark, empty_tables).count() == 0
