"""Exact, linearly interpolated quantiles per group.

``grouped_quantiles`` is for many groups:

1. Equal values of a group become one row with a count (combined before the
   shuffle), so ties, however many, are one row.
2. A value's slice is a fixed expression of the value and its group's range.
   Slices are ordered like the values.
3. Slice totals, accumulated per group (at most ``SLICES`` + 2 rows each), tell
   in which slices the wanted ranks lie.
4. Only those slices are ordered, each in a window of its own.

Every step is a function of the data, so it does not matter whether Spark
computes a shared input once or again.

``sketched_quantiles`` is for a few groups of any size and shape.  Its slices
are cut at quantiles of the group's distinct values, taken from a mergeable
sketch, so a long tail or a crowd of close values gets its share of slices: a
slice holds about one ``SLICES``-th of the distinct values.  A sketch depends on
the order in which Spark merges it, so the counts and the cuts are stored once
and every later step reads them.  The sketch only says where to cut; ranks are
counted, so the results are exact whatever it returns.

No row is dropped or sampled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICES = 256


def _on(left: list[str], right: list[str]) -> Column:
    """Join condition in which null keys meet."""
    cond = F.lit(True)
    for a, b in zip(left, right):
        cond = cond & F.col(a).eqNullSafe(F.col(b))
    return cond


def value_counts(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    return df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))


def grouped_quantiles(df: DataFrame, keys: list[str], value: str, probs: dict[str, float], count: str | None = None) -> DataFrame:
    """Exact linear quantiles ``{name: p}`` of ``value`` per ``keys``.

    With ``count``, ``df`` already has one row per (keys, value) and that column
    says how often.  Null values are ignored.
    """
    counts = df.select(*keys, value, F.col(count).alias("_n")) if count else value_counts(df, keys, value)
    counts = counts.filter(F.col(value).isNotNull())
    v = F.col(value).cast("double")
    top, low = F.lit(float("inf")), F.lit(float("-inf"))
    finite = ~F.isnan(v) & (v != top) & (v != low)
    k = [f"_k{i}" for i in range(len(keys))]
    span = counts.groupBy(*[F.col(c).alias(n) for c, n in zip(keys, k)]).agg(
        F.min(F.when(finite, v)).alias("_lo"), F.max(F.when(finite, v)).alias("_hi"))
    place = F.when(F.col("_hi") > F.col("_lo"), F.least(F.floor((v - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * SLICES), F.lit(SLICES - 1))).otherwise(0)
    slice_ = F.when(v == low, -1).when(finite, place).otherwise(SLICES).cast("int")
    return _select(counts.join(span, _on(keys, k)).select(*keys, value, "_n", slice_.alias("_s")), keys, value, probs)


def sketched_slices(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, value, ``_n``, ``_s``): each distinct value, how often, and its slice."""
    counts = value_counts(df, keys, value).filter(F.col(value).isNotNull()).checkpoint()
    v = F.col(value).cast("double")
    finite = ~F.isnan(v) & (F.abs(v) != float("inf"))
    k = [f"_k{i}" for i in range(len(keys))]
    at = [i / SLICES for i in range(1, SLICES)]
    cuts = counts.groupBy(*[F.col(c).alias(n) for c, n in zip(keys, k)]).agg(F.approx_percentile(F.when(finite, v), at, F.lit(8 * SLICES)).alias("_cuts")).checkpoint()
    out = counts.join(cuts, _on(keys, k)).withColumn("_s", F.lit(0))
    step = SLICES // 2
    while step:  # the number of cuts below the value, by halving
        out = out.withColumn("_s", F.col("_s") + F.when(v > F.get("_cuts", F.col("_s") + (step - 1)), step).otherwise(0))
        step //= 2
    return out.select(*keys, value, "_n", "_s")


def sketched_quantiles(df: DataFrame, keys: list[str], value: str, probs: dict[str, float]) -> DataFrame:
    """Exact linear quantiles ``{name: p}`` of ``value`` per ``keys``; null values are ignored."""
    return _select(sketched_slices(df, keys, value), keys, value, probs)


def _select(sliced: DataFrame, keys: list[str], value: str, probs: dict[str, float]) -> DataFrame:
    """Count into the slices, order those that hold a wanted rank, read the values off."""
    k = [f"_k{i}" for i in range(len(keys))]
    sizes = sliced.groupBy(*[F.col(c).alias(n) for c, n in zip(keys, k)], F.col("_s").alias("_ks")).agg(F.sum("_n").alias("_size"))
    group = Window.partitionBy(*k)
    offsets = sizes.withColumn("_from", F.sum("_size").over(group.orderBy("_ks")) - F.col("_size")).withColumn("_all", F.sum("_size").over(group))
    ranks = {n: (F.col("_all") - 1) * p for n, p in probs.items()}
    wanted = F.array(*[f(h).cast("long") for h in ranks.values() for f in (F.floor, F.ceil)])
    needed = offsets.filter(F.exists(wanted, lambda r: (r >= F.col("_from")) & (r < F.col("_from") + F.col("_size"))))
    inside = Window.partitionBy(*keys, "_s").orderBy(value)
    ordered = (sliced.join(needed, _on([*keys, "_s"], [*k, "_ks"]))
               .withColumn("_end", F.col("_from") + F.sum("_n").over(inside)).withColumn("_begin", F.col("_end") - F.col("_n")))
    aggs = []
    for n, h in ranks.items():
        for side, f in (("lo", F.floor), ("hi", F.ceil)):
            r = f(h).cast("long")
            aggs.append(F.max(F.when((r >= F.col("_begin")) & (r < F.col("_end")), F.col(value))).alias(f"_{n}_{side}"))
        aggs.append(F.max(h - F.floor(h)).alias(f"_{n}_part"))
    g = ordered.groupBy(*keys).agg(*aggs)
    found = g.select(*[F.col(c).alias(n) for c, n in zip(keys, k)], *[
        F.when(F.col(f"_{n}_part") == 0, F.col(f"_{n}_lo")).otherwise(F.col(f"_{n}_lo") + F.col(f"_{n}_part") * (F.col(f"_{n}_hi") - F.col(f"_{n}_lo"))).alias(n) for n in probs])
    return found.select(*[F.col(n).alias(c) for c, n in zip(keys, k)], *probs)
