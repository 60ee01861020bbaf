r"""License scan: exact set-similarity join of text blocks with license notices.

A block is any run of ``BLOCK`` words of a document (of twice a longer template's
words), wherever it starts.  It matches a template if at least ``THRESHOLD`` of
the template's distinct words are in it (containment of the template).

The join is exact and filtered in the usual way.  Tokens are ordered by their
document frequency over the whole corpus, rarest first.  To share
alpha = ceil(threshold * size) tokens with a template, a block must hold one of
its first size - alpha + 1 tokens: the prefix filter.  So the search starts at
the places of such tokens only, joined with the templates they lead to; each is
taken for the rarest token that the two share, the other places see to the rest.
Then only the template's tokens from it on can be shared: the positional filter.
If the words within a block's reach of the place hold fewer than alpha of them,
none of its blocks can match: the length filter.  Of the blocks that hold the
place, those that start at a word of the template are counted exactly; a block
that starts elsewhere has no more of its words than the next one that does.
The template side is a list of this module, so its broadcast has a fixed size;
documents are never shuffled, only one narrow row per document is.  A place
carries the words around it, not the document.

The base counts places where a label's phrase stands word for word.

Defined results: null or empty text: no words, no labels, nulls for the
places; a phrase that overlaps itself counts at every place; repeated rows are
separate; score is the highest containment of a block that matches, 0 without one,
and 1 where a base phrase stands.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lower_az, table

# fixed values of the contract: phrase -> label
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: usual notices: label, words
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "redistribute it and or modify it under the terms of the gnu general public license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
]
THRESHOLD = 0.9
BLOCK = 48


def _alpha(size: int, threshold: float) -> int:
    return max(1, math.ceil(round(threshold * size, 9)))


# the contract's words, before their letters are lower-cased
_BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def split_words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), _BREAK), lambda w: w != "")


def known(words: Column, order: list[str]) -> Column:
    """Per word its place in ``order``, null if it has none.  ``lower`` finds
    the candidates; a word with a letter that only full lower case maps into
    ASCII is not among them after ``lower_az``."""
    ranked = F.array(*map(F.lit, order))
    rank = lambda w: F.nullif(F.array_position(ranked, lower_az(w)), F.lit(0)) - 1
    return F.transform(words, lambda w: F.when(F.lower(w).isin(order), rank(w)).cast("int"))


def token_order(docs: DataFrame, text: str, vocabulary: list[str]) -> list[str]:
    """The templates' tokens by document frequency over all documents, rarest
    first (ties by the token).  At most one row per token reaches the driver."""
    met = docs.select(F.explode(F.array_distinct(F.filter(known(split_words(F.col(text)), vocabulary), lambda r: r.isNotNull()))).alias("w"))
    n = {vocabulary[r["w"]]: r["n"] for r in met.groupBy("w").agg(F.count("*").alias("n")).collect()}
    return sorted(vocabulary, key=lambda w: (n.get(w, 0), w))


def places(ranks: str, seen: str, phrase: list[int]) -> Column:
    """Start of every occurrence of a phrase, given as ranks; a text that lacks one of its words is not walked."""
    has = F.size(F.array_intersect(F.col(seen), F.array(*map(F.lit, phrase)))) == len(set(phrase))
    at = F.transform(F.col(ranks), lambda x, i: F.when(_all([F.get(F.col(ranks), i + k) == r for k, r in enumerate(phrase)]), i))
    return F.when(has, F.filter(at, lambda i: i.isNotNull())).otherwise(F.expr("cast(array() as array<int>)"))


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def matched_blocks(rows: DataFrame, ranks: str, seen: str, order: list[str], templates: list[tuple[str, str]], threshold: float, block: int) -> DataFrame:
    """``rows`` (without ``ranks`` and ``seen``, the rank of each word and the distinct ones), each
    with ``_q_template`` (null: no match), ``_q_block`` (the block's first word) and ``_q_score``."""
    spark = rows.sparkSession
    rank = {w: i for i, w in enumerate(order)}
    sets = [(k, sorted({rank[w] for w in text.split()}), max(block, 2 * len(text.split()))) for k, (_, text) in enumerate(templates)]
    alphas = {k: _alpha(len(s), threshold) for k, s, _ in sets}
    prefixes = [(s[i], k, len(s), alphas[k], s[i:], n) for k, s, n in sets for i in range(len(s) - alphas[k] + 1)]
    index = F.broadcast(spark.createDataFrame(prefixes, "t_rank int, t_id int, t_size int, t_alpha int, t_left array<int>, t_block int"))
    reach = max(n for _, _, n in sets)

    r, d = F.col(ranks), F.col(seen)
    # a block has no token that its text lacks: texts that cannot hold alpha tokens of any template are not searched
    able = F.lit(False)
    for k, s, _ in sets:
        able = able | (F.size(F.array_intersect(d, F.array(*map(F.lit, s)))) >= alphas[k])
    start = lambda i: F.greatest(i - F.lit(reach - 1), F.lit(0))
    around = lambda i: F.struct(i.alias("at"), F.get(r, i).alias("rank"), start(i).alias("from"), F.slice(r, start(i) + 1, i - start(i) + reach).alias("words"))
    first = sorted({p[0] for p in prefixes})
    found = F.filter(F.transform(r, lambda x, i: F.when(x.isin(first), i)), lambda i: i.isNotNull())
    probes = rows.withColumn("_q_at", F.when(able, F.transform(found, around))).drop(ranks, seen).withColumn("_q_at", F.explode_outer("_q_at"))
    met = probes.join(index, F.col("_q_at.rank") == F.col("t_rank"), "left")
    words, at, begin, left, n = F.col("_q_at.words"), F.col("_q_at.at"), F.col("_q_at.from"), F.col("t_left"), F.col("t_block")
    starts = F.filter(F.sequence(F.greatest(at - n + 1, begin), at), lambda s: F.array_contains(left, F.coalesce(F.get(words, s - begin), F.lit(-1))))
    counted = F.transform(starts, lambda s: F.struct(F.size(F.array_intersect(F.slice(words, s - begin + 1, n), left)).alias("n"), (-s).alias("s")))
    best = F.when(F.size(F.array_intersect(words, left)) >= F.col("t_alpha"), F.array_max(counted))
    met = met.withColumn("_q_best", best)
    hit = F.col("_q_best.n") >= F.col("t_alpha")
    return met.withColumns({"_q_template": F.when(hit, F.col("t_id")), "_q_block": F.when(hit, -F.col("_q_best.s")), "_q_score": F.when(hit, F.col("_q_best.n") / F.col("t_size"))}).drop(
        "_q_at", "_q_best", "t_rank", "t_id", "t_size", "t_alpha", "t_left", "t_block")


def scan(docs: DataFrame, doc_id: str, text: str, templates: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """One row per document, place of a prefix token and template it leads to (a document
    without one has one row with nulls): ``_q_row``, ``_q_id``, ``_q_words``, ``_q_places`` (per
    phrase), ``_q_block``, ``_q_template`` and ``_q_score``."""
    templates = templates or TEMPLATES
    vocabulary = sorted({w for t in [*PHRASES, *(t for _, t in templates)] for w in t.split()})
    only = docs.select(F.col(doc_id).alias("_q_id"), F.col(text).alias("_q_text"))
    order = token_order(only, "_q_text", vocabulary)
    rank = {w: i for i, w in enumerate(order)}
    rows = only.select("_q_id", F.monotonically_increasing_id().alias("_q_row"), known(split_words(F.col("_q_text")), order).alias("_q_ranks"))
    rows = rows.withColumn("_q_seen", F.array_distinct(F.filter("_q_ranks", lambda r: r.isNotNull())))
    found = F.array(*[places("_q_ranks", "_q_seen", [rank[w] for w in p.split()]) for p in PHRASES])
    rows = rows.withColumns({"_q_words": F.size("_q_ranks").cast("long"), "_q_places": found})
    return matched_blocks(rows, "_q_ranks", "_q_seen", order, templates, threshold, block)


def labels_of(spark: SparkSession, found: DataFrame, templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """The digest of ``scan``: one row per document."""
    templates = templates or TEMPLATES
    label = F.element_at(F.array(*[F.lit(k) for k, _ in templates]), F.col("_q_template") + 1)
    docs = found.groupBy("_q_row").agg(F.first("_q_id").alias("doc_id"), F.first("_q_words").alias("n_words"), F.first("_q_places").alias("p"),
                                       F.collect_set(label).alias("own"), F.max("_q_score").alias("best"))
    flat = F.flatten("p")
    base = F.filter(F.array(*[F.when(F.size(F.get("p", F.lit(i))) > 0, F.lit(k)) for i, k in enumerate(PHRASES.values())]), lambda x: x.isNotNull())
    return docs.select("doc_id", "n_words", F.size(flat).cast("long").alias("n_base"), F.array_min(flat).cast("long").alias("first_word"), F.array_max(flat).cast("long").alias("last_word"),
                       F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"), F.array_join(F.array_sort(F.array_union(base, "own")), ",").alias("labels"),
                       F.when(F.size(flat) > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"))


def op1_license_scan(spark, sf_dir: str) -> DataFrame:
    return labels_of(spark, scan(table(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", "text"))


def _sql() -> str:
    """The same by brute force: every block that starts at a word of a template, with every template."""
    q = lambda x: "'" + x + "'"
    phrase = ", ".join(f"({q(p)}, {q(k)})" for p, k in PHRASES.items())
    template = ", ".join(f"({q(k)}, {q(t)}, {_alpha(len(set(t.split())), THRESHOLD)})" for k, t in TEMPLATES)
    assert all(2 * len(t.split()) <= BLOCK for _, t in TEMPLATES)
    return rf"""
WITH phrase(p, label) AS (VALUES {phrase}), ph AS (SELECT string_split(p, ' ') AS p, label FROM phrase),
tpl(label, t, alpha) AS (VALUES {template}), tp AS (SELECT label, list_distinct(string_split(t, ' ')) AS t, alpha FROM tpl),
d AS (SELECT row_number() OVER () AS rid, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
place AS (SELECT rid, i - 1 AS i, label FROM (SELECT rid, w, unnest(generate_series(1, len(w))) AS i FROM d) x JOIN ph ON x.w[x.i] = ph.p[1] AND x.w[x.i:x.i + len(ph.p) - 1] = ph.p),
base AS (SELECT rid, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM place GROUP BY rid),
vocabulary AS (SELECT list_distinct(flatten(list(t))) AS v FROM tp),
block AS (SELECT rid, list_distinct(w[i:i + {BLOCK} - 1]) AS s FROM (SELECT rid, w, unnest(generate_series(1, len(w))) AS i FROM d) x, vocabulary WHERE list_contains(v, w[i])),
near AS (SELECT rid, label, len(list_intersect(s, t)) AS shared, len(t) AS size FROM block, tp WHERE len(list_intersect(s, t)) >= alpha),
own AS (SELECT rid, max(shared / size) AS best FROM near GROUP BY rid),
named AS (SELECT rid, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT rid, label FROM near UNION ALL SELECT rid, label FROM place) GROUP BY rid)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(best, 0.0) END::DOUBLE AS score
FROM d LEFT JOIN base USING (rid) LEFT JOIN own USING (rid) LEFT JOIN named USING (rid)
"""


OP1_SQL = _sql()
