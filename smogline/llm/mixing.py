"""Mixing sources to target weights by capped water-filling.

Every source has a weight; its share of the total size is its target.  A
target is clamped at ``max_epochs`` times the source's size; the excess goes
to the sources not clamped in proportion to their weights, again and again
until none is above its clamp.

A source's target is met by repetitions: every document ``whole`` times, and
some documents once more.  Which ones is a seeded draw: documents are ordered
by a hash of (seed, id, size, text), and taken in that order while they fit the
rest; of the equal rows under the hash in which the rest runs out, as many as
fit.  Two corrections are then weighed, and the one that comes nearest to the
target is made, if it comes nearer at all: one document more, of the size
nearest to what is missing; or the smallest one more that covers it, and one
of those taken given back, of the size nearest to what that is too much.

The order is cut without sorting a source: the hash's digits are fixed one
after another by 16 sums a source, until a prefix holds about ``BUCKET_ROWS``
rows; only these are ordered.

Defined results: a null text has size 0, a null source is a source of its own
(last in order), a source of size 0 has target 0, an empty table gives an empty
result.  Rows equal in id, text and source are drawn one by one; which of them
is taken follows their order in the input, all else is the same in reruns and
other partitionings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import TOKEN, stored, table

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
SEED = "mix-1"
BUCKET_ROWS = 4096


def n_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(TOKEN)), F.lit(0)).cast("long")


def water_fill(sources: DataFrame, size: str, weight: str, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Add ``target`` to a table of sources (one row each).  Only three sums of
    each round come to the driver; a round clamps at least one source."""
    total = sources.agg(F.sum(size)).first()[0] or 0
    cap = F.col(size) * max_epochs
    state = sources.withColumn("_q_clamped", F.lit(False))
    while True:
        r = state.agg(
            F.sum(F.when(F.col("_q_clamped"), cap).otherwise(0)).alias("fixed"),
            F.sum(F.when(~F.col("_q_clamped"), F.col(weight)).otherwise(0)).alias("weight"),
            F.sum(F.when(F.col("_q_clamped"), 1).otherwise(0)).alias("clamped"),
        ).first()
        if not r["weight"]:
            return state.withColumn("target", cap.cast("double")).drop("_q_clamped")
        level = float(total - r["fixed"]) / float(r["weight"])
        above = F.col(weight) * F.lit(level) > cap
        new = stored(state.withColumn("_q_clamped", F.col("_q_clamped") | above), "mix")
        if new.where("_q_clamped").count() == r["clamped"]:
            return state.withColumn("target", F.when(F.col("_q_clamped"), cap.cast("double")).otherwise(F.col(weight) * F.lit(level))).drop("_q_clamped")
        state = new


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def _cut_buckets(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Per source the key prefix in which its rest runs out, and the size ahead of it, digit by
    digit: 16 sums a source and level.  A prefix holds about ``BUCKET_ROWS`` rows in the end."""
    digits, n = 1, rows.count()
    while n > BUCKET_ROWS * 16**digits and digits < 8:
        digits += 1
    at = sources.select(F.col("_q_source").alias("s"), "rest", F.lit("").alias("prefix"), F.lit(0).cast("long").alias("ahead"))
    before = Window.partitionBy("s").orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)
    for level in range(digits):
        inside = rows.join(at, _same("_q_source", "s") & (F.substring("_q_key", 1, level) == F.col("prefix")))
        sums = inside.groupBy("s", "rest", "prefix", "ahead", F.substring("_q_key", level + 1, 1).alias("digit")).agg(F.sum("_q_size").alias("size"))
        sums = sums.withColumn("ahead", F.col("ahead") + F.coalesce(F.sum("size").over(before), F.lit(0))).where("ahead <= rest")
        last = sums.groupBy("s", "rest", "prefix").agg(F.max(F.struct("digit", "ahead")).alias("last"))
        at = stored(last.select("s", "rest", F.concat("prefix", "last.digit").alias("prefix"), F.col("last.ahead").alias("ahead")), "mix")
    return at


def plan(rows: DataFrame, max_epochs: int = MAX_EPOCHS, weights: tuple[int, ...] = WEIGHTS) -> tuple[DataFrame, DataFrame]:
    """From ``rows`` (_q_source, _q_size, _q_key): per source its size, target, whole repetitions and
    the key before which documents get one more; and for the few keys that differ from this rule
    (the cut key and those of the corrections) how many of their ``n`` rows get it."""
    order = F.row_number().over(Window.orderBy(F.col("_q_source").asc_nulls_last()))  # one row per source
    weight = F.element_at(F.array(*map(F.lit, weights)), ((order - 1) % len(weights) + 1).cast("int"))
    sources = stored(rows.groupBy("_q_source").agg(F.sum("_q_size").alias("size")).withColumn("weight", weight), "mix")
    sources = water_fill(sources, "size", "weight", max_epochs)
    sources = sources.withColumn("whole", F.when(F.col("size") > 0, F.floor(F.col("target") / F.col("size"))).otherwise(0).cast("long"))
    sources = stored(sources.withColumn("rest", F.col("target") - F.col("whole") * F.col("size")), "mix")

    # the key in which the rest runs out: ``k`` of its ``n`` rows, all of one size, still fit
    inside = rows.join(_cut_buckets(rows, sources), _same("_q_source", "s") & F.col("_q_key").startswith(F.col("prefix")))
    inside = inside.groupBy("s", "_q_key", "ahead", "rest").agg(F.count(F.lit(1)).alias("n"), F.max("_q_size").alias("size"))
    sofar = Window.partitionBy("s").orderBy("_q_key").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("ahead") + F.coalesce(F.sum(F.col("n") * F.col("size")).over(sofar), F.lit(0))
    fit = F.when(F.col("size") > 0, F.least("n", F.floor((F.col("rest") - F.col("start")) / F.col("size")))).otherwise(F.col("n")).cast("long")
    cut = inside.withColumn("start", start).where("start <= rest").withColumn("k", fit)
    cut = cut.groupBy("s").agg(F.max(F.struct("_q_key", "n", "k", (F.col("rest") - F.col("start") - F.col("k") * F.col("size")).alias("missing"))).alias("c"))
    cut = stored(cut.select("s", F.col("c._q_key").alias("cut_key"), F.col("c.n").alias("cut_n"), F.col("c.k").alias("k"), F.col("c.missing").alias("missing")), "mix")

    # documents not taken: the nearest in size to what is missing, and the smallest that covers it
    missing, size, key = F.col("missing"), F.col("_q_size"), F.col("_q_key")
    placed = rows.join(cut, _same("_q_source", "s"))
    beyond = placed.where((key > F.col("cut_key")) | (key == F.col("cut_key")) & (F.col("k") < F.col("cut_n"))).groupBy(F.col("s").alias("m")).agg(
        F.first("missing").alias("missing"), F.min(F.struct(F.abs(size - missing).alias("off"), "_q_key")).alias("near"),
        F.min(F.when(size >= missing, F.struct("_q_size", "_q_key"))).alias("above"))
    beyond = stored(beyond.select("m", "missing", "near", F.col("above._q_key").alias("above_key"), (F.col("above._q_size") - F.col("missing")).alias("over")), "mix")
    # documents taken: the nearest in size to what the covering one is too much
    taken = placed.drop("missing").where((key < F.col("cut_key")) | (key == F.col("cut_key")) & (F.col("k") > 0)).join(beyond.where("over is not null").select("m", "over"), _same("s", "m"))
    less = taken.groupBy(F.col("s").alias("b")).agg(F.min(F.struct(F.abs(size - F.col("over")).alias("off"), "_q_key")).alias("less"))
    swap = (F.col("less.off") < F.col("near.off")) & (F.col("less.off") < F.col("missing"))
    fix = beyond.join(less, _same("m", "b"), "left").select(
        "m", F.when(swap, F.col("above_key")).when(F.col("near.off") < F.col("missing"), F.col("near._q_key")).alias("more_key"), F.when(swap, F.col("less._q_key")).alias("less_key"))
    out = sources.join(cut, _same("_q_source", "s"), "left").join(fix, _same("_q_source", "m"), "left")
    out = stored(out.select(F.col("_q_source").alias("_q_name"), F.col("size").alias("source_size"), "target", "whole", "cut_key", "k", "more_key", "less_key"), "mix")

    # three keys a source at most; their rows are counted
    named = out.select("_q_name", "cut_key", "k", "more_key", "less_key", F.explode(F.array_distinct(F.array("cut_key", "more_key", "less_key"))).alias("special")).where("special is not null")
    count = F.when(F.col("special") < F.col("cut_key"), F.col("n")).when(F.col("special") == F.col("cut_key"), F.col("k")).otherwise(0)
    count = count + F.coalesce((F.col("special") == F.col("more_key")).cast("int"), F.lit(0)) - F.coalesce((F.col("special") == F.col("less_key")).cast("int"), F.lit(0))
    n = rows.join(named.select("_q_name", "special"), _same("_q_source", "_q_name") & (F.col("_q_key") == F.col("special"))).groupBy("_q_name", "special").agg(F.count(F.lit(1)).alias("n"))
    draws = named.join(n.select(F.col("_q_name").alias("w"), F.col("special").alias("x"), "n"), _same("_q_name", "w") & (F.col("special") == F.col("x")))
    return out, stored(draws.select(F.col("_q_name").alias("_q_drawn"), "special", "n", count.cast("long").alias("count")), "mix")


def _numbered(rows: DataFrame) -> DataFrame:
    """Stored ``rows`` with ``_q_no``, their number from 1 among those of equal (_q_source, _q_key):
    counts per partition are added up, so no window holds more than a partition's rows."""
    rows = stored(rows.withColumn("_q_part", F.spark_partition_id()).withColumn("_q_at", F.monotonically_increasing_id()), "mix")
    sizes = rows.groupBy("_q_source", "_q_key", "_q_part").agg(F.count(F.lit(1)).alias("_q_n"))
    before = Window.partitionBy("_q_source", "_q_key").orderBy("_q_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col("_q_source").alias("o"), F.col("_q_key").alias("p"), F.col("_q_part").alias("q"), F.coalesce(F.sum("_q_n").over(before), F.lit(0)).alias("_q_off"))
    at = F.row_number().over(Window.partitionBy("_q_source", "_q_key", "_q_part").orderBy("_q_at"))
    joined = rows.withColumn("_q_row", at).join(offsets, _same("_q_source", "o") & (F.col("_q_key") == F.col("p")) & (F.col("_q_part") == F.col("q")))
    return joined.withColumn("_q_no", F.col("_q_row") + F.col("_q_off")).drop("o", "p", "q", "_q_row", "_q_off", "_q_part", "_q_at")


def mix(docs: DataFrame, doc_id: str, text: str, source: str, max_epochs: int = MAX_EPOCHS, weights: tuple[int, ...] = WEIGHTS, seed: str = SEED) -> DataFrame:
    """All columns of ``docs`` as ``_q_0, _q_1, ...`` with ``_q_size``,
    ``source_size``, ``target`` and ``_q_copies`` (0 to max_epochs)."""
    cols = [F.col(f"`{c}`").alias(f"_q_{i}") for i, c in enumerate(docs.columns)]
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    size = n_tokens(F.col(f"`{text}`"))
    key = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")), size.cast("string"), F.md5(whole.cast("binary"))).cast("binary"))
    rows = docs.select(*cols, F.col(f"`{source}`").cast("string").alias("_q_source"), size.alias("_q_size"), key.alias("_q_key"))
    # the plan needs the narrow columns only; they are written once instead of counting words in every job
    by_source, draws = plan(stored(rows.select("_q_source", "_q_size", "_q_key"), "mix"), max_epochs, weights)
    joined = rows.join(by_source, _same("_q_source", "_q_name")).join(draws, _same("_q_source", "_q_drawn") & (F.col("_q_key") == F.col("special")), "left")
    some = F.coalesce((F.col("count") > 0) & (F.col("count") < F.col("n")), F.lit(False))
    extra = F.coalesce(F.col("count") > 0, F.col("_q_key") < F.col("cut_key"))
    out = joined.withColumn("_q_extra", extra).where(~some)
    if not draws.where(some).isEmpty():  # equal rows of which some are drawn
        out = out.unionByName(_numbered(joined.where(some)).withColumn("_q_extra", F.col("_q_no") <= F.col("count")).drop("_q_no"))
    # a clamped source is taken whole; a document never passes max_epochs
    copies = F.least(F.col("whole") + F.coalesce((F.col("_q_size") > 0) & F.col("_q_extra"), F.lit(False)).cast("long"), F.lit(max_epochs))
    return out.select(*[f"_q_{i}" for i in range(len(cols))], "_q_size", "source_size", "target", copies.alias("_q_copies"))


def op4_mixing(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source")
    out = mix(docs, "doc_id", "text", "source")
    return out.select(F.col("_q_0").alias("doc_id"), F.col("_q_size").alias("size"), "source_size", F.round("target", 6).alias("target"), (F.col("_q_size") * F.col("_q_copies")).alias("taken"))


OP4_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size, md5(coalesce(text, '')) AS hash FROM documents),
k AS (SELECT *, md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || CAST(size AS VARCHAR) || ':' || hash) AS key FROM d),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM k GROUP BY source),
-- clamped are the sources with the smallest size per weight; the level is the first that the next one bears
o AS (SELECT *, sum(3 * size) OVER w - 3 * size AS fixed, sum(weight) OVER (ORDER BY size / weight DESC, source DESC NULLS FIRST ROWS UNBOUNDED PRECEDING) AS free,
      (SELECT sum(size) FROM s) AS total FROM s WINDOW w AS (ORDER BY size / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
level AS (SELECT min_by((total - fixed) / free, size / weight) AS level FROM o WHERE weight * ((total - fixed) / free) <= 3 * size),
t AS (SELECT source, size, least(3.0 * size, weight * CAST(level AS DOUBLE)) AS target FROM s, level),
r AS (SELECT *, CASE WHEN size > 0 THEN CAST(floor(target / size) AS BIGINT) ELSE 0 END AS whole FROM t),
u AS (SELECT source, key, count(*) AS n, any_value(size) AS size FROM k GROUP BY source, key),
c AS (SELECT u.*, sum(n * u.size) OVER (PARTITION BY u.source ORDER BY key ROWS UNBOUNDED PRECEDING) - n * u.size AS start, r.target - r.whole * r.size AS rest FROM u JOIN r ON u.source IS NOT DISTINCT FROM r.source),
-- of the rows under the key in which the rest runs out, as many as fit
f AS (SELECT *, CASE WHEN size > 0 THEN least(n, CAST(floor((rest - start) / size) AS BIGINT)) ELSE n END AS fit FROM c WHERE start <= rest),
got AS (SELECT source, max(key) AS cut, max_by(n, key) AS cut_n, max_by(fit, key) AS fit, max_by(rest - start - fit * size, key) AS missing FROM f GROUP BY source),
beyond AS (SELECT u.source, missing, min((abs(u.size - missing), u.key)) AS near, min((u.size, u.key)) FILTER (WHERE u.size >= missing) AS above
           FROM u JOIN got ON u.source IS NOT DISTINCT FROM got.source WHERE u.key > cut OR u.key = cut AND fit < cut_n GROUP BY u.source, missing),
before AS (SELECT u.source, min((abs(u.size - (b.above[1] - b.missing)), u.key)) AS less FROM u JOIN got ON u.source IS NOT DISTINCT FROM got.source
           JOIN beyond b ON u.source IS NOT DISTINCT FROM b.source WHERE (u.key < cut OR u.key = cut AND fit > 0) AND b.above IS NOT NULL GROUP BY u.source),
fix AS (SELECT b.source, CASE WHEN less[1] < near[1] AND less[1] < missing THEN above[2] WHEN near[1] < missing THEN near[2] END AS more,
        CASE WHEN less[1] < near[1] AND less[1] < missing THEN less[2] END AS less FROM beyond b LEFT JOIN before l ON b.source IS NOT DISTINCT FROM l.source)
SELECT k.doc_id, k.size, r.size AS source_size, round(r.target, 6) AS target,
       CAST(k.size * least(3, r.whole + CASE WHEN row_number() OVER (PARTITION BY k.source, k.key) <=
         CASE WHEN k.key < got.cut THEN u.n WHEN k.key = got.cut THEN got.fit ELSE 0 END + CASE WHEN k.key = fix.more THEN 1 ELSE 0 END - CASE WHEN k.key = fix.less THEN 1 ELSE 0 END THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM k JOIN u ON k.source IS NOT DISTINCT FROM u.source AND k.key = u.key JOIN r ON k.source IS NOT DISTINCT FROM r.source
JOIN got ON k.source IS NOT DISTINCT FROM got.source LEFT JOIN fix ON k.source IS NOT DISTINCT FROM fix.source
"""


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every document as many times as the mix takes it."""
    out = mix(docs, "doc_id", "text", "source")
    copies = out.withColumn("_q_copy", F.explode(F.sequence(F.lit(1), F.greatest("_q_copies", F.lit(1)).cast("int")))).where("_q_copies > 0")
    return copies.select(*[F.col(f"_q_{i}").alias(c) for i, c in enumerate(docs.columns)])
