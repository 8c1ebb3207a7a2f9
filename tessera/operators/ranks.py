"""Exact quantiles and running totals of few large groups, without a task that holds a group.

Rows are first counted by value, where they lie. Values are cut into slices at approximate quantiles; slices have
totals (a row per group and slice), whose running sums say in which slice a rank falls and what stands before it. Only the
rows of the slices that hold a wanted rank are sorted, slice by slice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.session import written

SLICES = 64


def _sliced(counts: DataFrame, value: str) -> DataFrame:
    """counts with _slice: how many of the edges are under the value. The edges are SLICES - 1 numbers at most."""
    edges = counts.agg(F.percentile_approx(value, F.array(*[F.lit(k / SLICES) for k in range(1, SLICES)]), F.lit(1000)).alias("e")).head()["e"]
    known = F.array(*map(F.lit, sorted(set(edges or [])))).cast("array<double>")
    return counts.withColumn("_slice", F.size(F.filter(known, lambda e: e < F.col(value))))


def _before(sliced: DataFrame, keys: list[str], n: str) -> DataFrame:
    """keys, _slice, _m (total of the slice), _before (total of the slices before it), _total."""
    totals = sliced.groupBy(*keys, "_slice").agg(F.sum(n).alias("_m"))
    w = W.partitionBy(*keys)
    return totals.withColumn("_before", F.sum("_m").over(w.orderBy("_slice")) - F.col("_m")).withColumn("_total", F.sum("_m").over(w))


def exact_quantiles(df: DataFrame, keys: list[str], value: str, quantiles: tuple[float, ...]) -> DataFrame:
    """keys, n, q (array, interpolated between neighbours as percentile does); null values don't count."""
    counts = written(df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_n")), "value-counts")
    sliced = written(_sliced(counts, "_v"), "sliced")
    before = _before(sliced, keys, "_n")
    place = lambda q: F.lit(q) * (F.col("_total") - 1)
    wanted = F.array(*[F.struct(F.lit(k).alias("k"), up.cast("long").alias("rank"), (place(q) - F.floor(place(q))).alias("share"), F.lit(side).alias("side")) for k, q in enumerate(quantiles) for side, up in ((0, F.floor(place(q))), (1, F.ceil(place(q))))])
    targets = before.select(*keys, "_slice", "_before", "_m", "_total", F.explode(wanted).alias("_t")).where("_t.rank >= _before and _t.rank < _before + _m")
    run = F.sum("_n").over(W.partitionBy(*keys, "_slice").orderBy("_v"))
    # of every slice that holds a wanted rank; others have no partner
    hit = sliced.join(targets.select(*keys, "_slice").distinct(), [*keys, "_slice"], "left_semi").withColumn("_until", run)
    found = hit.join(targets, [*keys, "_slice"]).where("_t.rank - _before < _until and _t.rank - _before >= _until - _n")
    side = lambda k: F.max(F.when(F.col("_t.side") == k, F.col("_v")))
    ends = found.groupBy(*keys, "_total", F.col("_t.k").alias("_k")).agg(side(0).alias("_low"), side(1).alias("_high"), F.max("_t.share").alias("_share"))
    each = ends.select(*keys, "_total", F.struct("_k", (F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_share")).alias("v")).alias("_x"))
    return each.groupBy(*keys, F.col("_total").alias("n")).agg(F.transform(F.array_sort(F.collect_list("_x")), lambda x: x["v"]).alias("q"))  # len(quantiles) values


def running_totals(df: DataFrame, value: str, n: str) -> DataFrame:
    """df (a row per value) with until, the sum of n up to its value: sums of slices, then running sums inside them."""
    sliced = written(_sliced(df, value), "sliced")
    inside = F.sum(n).over(W.partitionBy("_slice").orderBy(value))
    before = _before(sliced.withColumn("_one", F.lit(0)), ["_one"], n).select("_slice", "_before")  # SLICES rows
    return sliced.withColumn("_inside", inside).join(F.broadcast(before), "_slice").withColumn("until", F.col("_inside") + F.col("_before")).drop("_inside", "_before", "_slice")
