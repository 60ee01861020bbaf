r"""Quality rules as a short-circuit cascade, in DataFrame expressions only.

A rule rejects a text by a condition over its measures.  The order of the
rules is chosen from a sample: each rule's cost (time over the sample, less
that of an empty rule) and its selectivity (share rejected) are estimated, and
rules run by rejections per cost, the best first.  The verdict is one CASE:
a rule after the first that rejects is not evaluated.  The order changes the
work, never the verdict, so reruns agree whatever was timed.

Sample bound: ``SAMPLE_ROWS`` rows, those first read whose text hashes to a
32nd; every document is judged, whole.

Measures of a text (words are runs of characters outside ``[\x20\x09-\x0D]``):
n_words, word_chars (code points in words), n_symbols (of ``#*$%&|<>``),
n_lines and n_dup_lines (\n-split lines with a word; those equal to an earlier
one), n_repeat_words (words inside 3-word windows that occur twice or more in
the text).  Windows are compared by 64-bit hashes inside one text.

Defined results: a null or empty text has no words and fails the base rule;
repeated rows are judged alike; empty table: empty result.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, TOKEN, let, stored, table

SAMPLE_ROWS = 500
SYMBOLS = "[#*$%&|<>]"
RUN = 3


def split_words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), lambda w: w != "")


def split_lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: F.ltrim(F.translate(x, "\t\x0b\x0c\r", "    ")) != "")


def with_repeats(docs: DataFrame, words: str, out: str, run: int = RUN) -> DataFrame:
    """Add how many words of the array ``words`` lie in runs of ``run`` words that occur more than once.

    Runs are hashed; the hashes, their lowest bits replaced by the place, are
    sorted as plain numbers, so that repeated runs stand beside each other.
    Neighbours that agree in the remaining bits are candidates; only those are
    compared, and ordered, by the whole hash."""
    w, h, bits, s, c = F.col(words), F.col("_q_h"), F.col("_q_bits"), F.col("_q_s"), F.col("_q_c")
    last = F.size(w) - run
    none = F.expr("cast(array() as array<bigint>)")
    right = lambda x: F.call_function("shiftright", x, bits)
    near = lambda x, y: F.coalesce(right(x.bitwiseXOR(y)) == 0, F.lit(False))
    out_h = docs.withColumn("_q_h", F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(run)]))).otherwise(none))
    out_h = out_h.withColumn("_q_bits", F.length(F.bin(F.size(h))).cast("int"))
    packed = F.transform(h, lambda x, i: F.call_function("shiftleft", right(x), bits).bitwiseOR(i.cast("long")))
    out_s = out_h.withColumn("_q_s", F.sort_array(F.coalesce(packed, none)))
    place = lambda x: x.bitwiseXOR(F.call_function("shiftleft", right(x), bits)).cast("int")
    pick = F.filter(s, lambda x, k: near(x, F.get(s, k - 1)) | near(x, F.get(s, k + 1)))
    out_c = out_s.withColumn("_q_c", F.sort_array(F.transform(pick, lambda x: F.struct(F.get(h, place(x)).alias("h"), place(x).alias("i")))))
    same = lambda x, k: F.coalesce(x["h"] == F.get(c, k - 1)["h"], F.lit(False)) | F.coalesce(x["h"] == F.get(c, k + 1)["h"], F.lit(False))
    twice = F.sort_array(F.transform(F.filter(c, same), lambda x: x["i"]))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    covered = F.aggregate(twice, start, lambda acc, i: F.struct((acc["n"] + i + run - F.greatest(i, acc["end"])).alias("n"), (i + run).alias("end")), lambda acc: acc["n"])
    # a filter on the result would be pushed down and spelled out through all these steps; it stops at explode
    return out_c.withColumn(out, F.explode(F.array(F.when(F.size(c) > 0, covered).otherwise(F.lit(0).cast("long"))))).drop("_q_h", "_q_bits", "_q_s", "_q_c")


def measures(docs: DataFrame, text: str, prefix: str = "") -> DataFrame:
    """Add the measures of every whole text (n_words, word_chars, n_symbols,
    n_lines, n_dup_lines, n_repeat_words), named with ``prefix``."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    out = docs.withColumns({"_q_w": split_words(t), "_q_l": split_lines(t), f"{prefix}n_symbols": F.regexp_count(t, F.lit(SYMBOLS)).cast("long")})
    out = out.withColumns({f"{prefix}n_words": F.size("_q_w").cast("long"), f"{prefix}word_chars": F.char_length(F.array_join("_q_w", "")).cast("long"), f"{prefix}n_lines": F.size("_q_l").cast("long"),
                           f"{prefix}n_dup_lines": (F.size("_q_l") - F.size(F.array_distinct("_q_l"))).cast("long")})
    return with_repeats(out, "_q_w", f"{prefix}n_repeat_words").drop("_q_w", "_q_l")


@dataclass(frozen=True)
class Rule:
    """``reject`` is a condition over the input's columns; ``base`` rules are fixed by the contract."""

    name: str
    reject: Column
    base: bool = False


def rules(prefix: str = "") -> list[Rule]:
    """The rule set, over the measures.  Thresholds of the method's own rules:
    a symbol per ten words, three in ten lines repeated, words of odd length."""
    c = lambda x: F.col(prefix + x)
    return [
        Rule("few_words", c("n_words") < 50, True),
        Rule("repetition", 100 * c("n_repeat_words") > 50 * c("n_words"), True),
        Rule("symbols", 10 * c("n_symbols") > c("n_words")),
        Rule("dup_lines", 100 * c("n_dup_lines") > 30 * c("n_lines")),
        Rule("word_length", (c("word_chars") < 2 * c("n_words")) | (c("word_chars") > 20 * c("n_words"))),
    ]


def text_rules(text: str) -> list[Rule]:
    """The same rules straight over a text column, each with only the work it
    needs: what a filter that wants no measures should run.  The repetition
    rule reads ``_q_repeat``, which ``keep`` computes for what is left by then."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    n = F.regexp_count(t, F.lit(TOKEN))
    chars = F.char_length(t) - F.regexp_count(t, F.lit(SPACE))
    return [
        Rule("few_words", n < 50, True),
        Rule("repetition", 100 * F.col("_q_repeat") > 50 * n, True),
        Rule("symbols", 10 * F.regexp_count(t, F.lit(SYMBOLS)) > n),
        Rule("dup_lines", let(split_lines(t), lambda x: 100 * (F.size(x) - F.size(F.array_distinct(x))) > 30 * F.size(x))),
        Rule("word_length", let(F.struct(n.alias("n"), chars.alias("c")), lambda x: (x["c"] < 2 * x["n"]) | (x["c"] > 20 * x["n"]))),
    ]


def _counted(docs: DataFrame, text: str) -> DataFrame:
    return with_repeats(docs.withColumn("_q_w", split_words(F.col(f"`{text}`"))), "_q_w", "_q_repeat").drop("_q_w")


def cascade_order(docs: DataFrame, text: str, some: list[Rule], sample_rows: int = SAMPLE_ROWS) -> list[str]:
    """Rule names by rejections per cost on a bounded sample of whole documents."""
    sample = docs.where(F.pmod(F.xxhash64(F.col(f"`{text}`")), F.lit(32)) == 0).limit(sample_rows)
    sample = stored(sample, "quality-sample")

    def timed(reject: Column) -> tuple[float, float]:
        began = time.perf_counter()
        share = (_counted(sample, text) if "_q_repeat" in str(reject) else sample).agg(F.avg(reject.cast("double")).alias("share")).first()["share"]
        return time.perf_counter() - began, share or 0.0

    timed(F.lit(False))  # opens the files
    idle = timed(F.lit(False))[0]
    rank = []
    for r in some:
        cost, share = timed(r.reject)
        rank.append((-share / max(cost - idle, 1e-3), r.name))
    return [name for _, name in sorted(rank)]


def cascade(some: list[Rule], order: list[str]) -> Column:
    """True where no rule rejects; stops at the first that does."""
    by_name = {r.name: r for r in some}
    verdict = F.when(by_name[order[0]].reject, False)
    for name in order[1:]:
        verdict = verdict.when(by_name[name].reject, False)
    return verdict.otherwise(True)


def keep(docs: DataFrame, text: str) -> DataFrame:
    """The rows of ``docs`` that pass all rules, in the order the sample gives:
    each rule is a filter over what the ones before it left, so work that an
    earlier rejection makes needless is never done."""
    own = {r.name: r for r in text_rules(text)}
    for name in cascade_order(docs, text, list(own.values())):
        docs = (_counted(docs, text).where(~own[name].reject).drop("_q_repeat") if name == "repetition" else docs.where(~own[name].reject))
    return docs


def op8_quality(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    order = cascade_order(docs, "text", text_rules("text"))
    own = rules()
    measured = measures(docs, "text").drop("text")
    base = [r.reject for r in own if r.base]
    out = measured.withColumns({"base_failed": base[0] | base[1], "kept": cascade(own, order)})
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines")


OP8_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
win AS (SELECT rid, i, w[i:i + 2] AS run FROM (SELECT rid, w, unnest(generate_series(1, len(w) - 2)) AS i FROM w WHERE len(w) >= 3)),
twice AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, run) AS n FROM win),
rep AS (SELECT rid, count(DISTINCT pos) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS pos FROM twice WHERE n > 1) GROUP BY rid),
m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
       CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
       CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, CAST(len(l) AS BIGINT) AS n_lines FROM w LEFT JOIN rep USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > n_words OR 100 * n_dup_lines > 30 * n_lines OR word_chars < 2 * n_words OR word_chars > 20 * n_words) AS kept, n_lines
FROM m
"""
