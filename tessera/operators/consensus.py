"""Consensus over measurements: log-space statistics per material, outliers, grades, spreads, noise.

Roles over the driver's tables: a lineitem row is a measurement of the material l_partkey in the paper
l_suppkey; l_extendedprice is its value, l_discount + 0.01 its activation energy, l_quantity its temperature.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.functions.columns import log10_positive
from tessera.operators.ranks import exact_quantiles
from tessera.session import table

OUTLIER_LOG10 = 1.5


def agreement_grade(n: Column, deviation: Column) -> Column:
    """Sizes and largest log10 deviations of the grades."""
    return (
        F.when(n == 0, "")
        .when((n >= 3) & (deviation <= 0.2), "A+")
        .when((n >= 3) & (deviation <= 0.5), "A")
        .when((n >= 2) & (deviation <= 0.7), "B")
        .when((n == 1) | ((n >= 2) & (deviation <= 1.0)), "C")
        .otherwise("D")
    )


GRADE_SQL = "case when n = 0 then '' when n >= 3 and dev <= 0.2 then 'A+' when n >= 3 and dev <= 0.5 then 'A' when n >= 2 and dev <= 0.7 then 'B' when n = 1 or (n >= 2 and dev <= 1.0) then 'C' else 'D' end"


def measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("material"), F.col("l_suppkey").alias("paper"), F.col("l_extendedprice").alias("value"), (F.col("l_discount") + 0.01).alias("ea"),
        F.col("l_quantity").alias("temperature"), F.col("l_orderkey").alias("ordinal"), F.col("l_linenumber").alias("line"),
    )


def with_medians(ms: DataFrame, key: str = "material", value: str = "value") -> DataFrame:
    """Positive values with l (log10) and med (its group's median): one aggregate and an equi-join, no sort of a group in a window."""
    logs = ms.where(F.col(value) > 0).withColumn("l", F.log10(value))
    medians = logs.groupBy(key).agg(F.median("l").alias("med"))
    return logs.join(medians, key)


def consensus(ms: DataFrame, key: str = "material") -> DataFrame:
    """A row per group: size, papers, 10^ of log median, ends, confidence interval (n >= 3), MAD, deviation, grade, outliers."""
    # papers are counted apart: a distinct count next to percentiles would keep a buffer of values per group and paper
    papers = ms.where("value > 0").select(key, "paper").distinct().groupBy(key).agg(F.count("paper").alias("papers"))
    agg = with_medians(ms, key).groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), F.first("med").alias("med"), F.min("l").alias("lo"), F.max("l").alias("hi"),
        F.percentile("l", F.array(F.lit(0.025), F.lit(0.975))).alias("ci"), F.median(F.abs(F.col("l") - F.col("med"))).alias("mad"),
        F.stddev_pop("l").alias("sd"), F.max(F.abs(F.col("l") - F.col("med"))).alias("dev"), F.count_if(F.abs(F.col("l") - F.col("med")) > OUTLIER_LOG10).alias("over"),
    ).join(papers, key)
    several = F.col("n") >= 2
    r = lambda c: F.round(c, 6)
    return agg.select(
        key, "n", "papers", r(F.pow(F.lit(10.0), "med")).alias("median_value"), r(F.pow(F.lit(10.0), "lo")).alias("min_value"), r(F.pow(F.lit(10.0), "hi")).alias("max_value"),
        F.when(F.col("n") >= 3, r(F.col("ci")[0])).alias("ci_low"), F.when(F.col("n") >= 3, r(F.col("ci")[1])).alias("ci_high"),
        F.when(several, r("mad")).alias("mad"), F.when(several, r("sd")).alias("log_std"), agreement_grade(F.col("n"), F.col("dev")).alias("grade"),
        F.when(F.col("n") >= 3, F.col("over")).otherwise(0).cast("long").alias("outliers"),
    )


_L = "with l as (select l_partkey material, l_suppkey paper, l_orderkey ordinal, l_linenumber line, l_extendedprice v, log10(l_extendedprice) l from lineitem where l_extendedprice > 0), m as (select *, median(l) over (partition by material) med from l)"


def consensus_by_material(spark: SparkSession, sf_dir: str) -> DataFrame:
    return consensus(measurements(spark, sf_dir))


def consensus_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements over 0.8 decades off: the published 1.5 never occur in these prices."""
    ms = with_medians(measurements(spark, sf_dir))
    n = ms.groupBy("material").agg(F.count(F.lit(1)).alias("n"))
    off = F.abs(F.col("l") - F.col("med"))
    return ms.where(off > 0.8).join(n.where("n >= 3"), "material").select("material", "ordinal", "line", F.round(off, 6).alias("deviation"))


def consensus_grade_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return consensus_by_material(spark, sf_dir).groupBy("grade").agg(F.count(F.lit(1)).alias("materials"), F.sum("n").alias("measurements"))


def consensus_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = consensus_by_material(spark, sf_dir)
    return c.agg(F.count(F.lit(1)).alias("groups"), F.count_if(F.col("papers") >= 3).alias("three_papers"), F.count_if(F.col("ci_low").isNotNull()).alias("with_ci"), F.sum("n").alias("values"))


def value_by_temp_bin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bins of 25 degrees, halves to even."""
    ms = measurements(spark, sf_dir).where("value > 0").withColumn("bin", (F.bround(F.col("temperature") / 25, 0) * 25).cast("int"))
    ends = ms.groupBy("bin").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    g = exact_quantiles(ms.withColumn("l", F.log10("value")), ["bin"], "l", (0.5,)).join(F.broadcast(ends), "bin")  # a row per bin
    return g.select("bin", "n", F.round(F.pow(F.lit(10.0), F.col("q")[0]), 6).alias("median_value"), F.round("lo", 6).alias("min_value"), F.round("hi", 6).alias("max_value"))


def temperature_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measurements(spark, sf_dir).where("temperature is not null").groupBy((F.floor(F.col("temperature") / 50) * 50).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def value_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("value")).agg(F.count(F.lit(1)).alias("n"))


def cross_source_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Materials of two papers or more whose largest value is over ten times the smallest."""
    g = measurements(spark, sf_dir).where("value > 0").groupBy("material").agg(F.countDistinct("paper").alias("papers"), F.count(F.lit(1)).alias("n"), (F.max("value") / F.min("value")).alias("ratio"))
    return g.where("papers >= 2 and n >= 2 and ratio > 10").select("material", "papers", "n", F.round("ratio", 6).alias("ratio"))


def noise_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of repeats: root mean square about the mean, mean absolute difference to the median, range, in decades."""
    ms = with_medians(measurements(spark, sf_dir))
    means = ms.groupBy("material").agg(F.avg("l").alias("mean"), F.count(F.lit(1)).alias("n")).where("n >= 2")
    g = ms.join(means, "material").groupBy("material").agg(
        F.first("n").alias("n"), F.sqrt(F.avg(F.pow(F.col("l") - F.col("mean"), 2))).alias("rms"), F.avg(F.abs(F.col("l") - F.col("med"))).alias("mad"), (F.max("l") - F.min("l")).alias("ptp"))
    return g.agg(F.count(F.lit(1)).alias("groups"), F.sum("n").alias("entries"), F.round(F.avg("rms"), 6).alias("rms"), F.round(F.avg("mad"), 6).alias("mad"), F.round(F.max("ptp"), 6).alias("widest"))


def ea_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median activation energy and the MEAN absolute difference to it, of materials with two papers or more."""
    ms = measurements(spark, sf_dir)
    papers = ms.select("material", "paper").distinct().groupBy("material").agg(F.count("paper").alias("papers")).where("papers >= 2")
    med = ms.groupBy("material").agg(F.median("ea").alias("med")).join(papers, "material")
    g = ms.join(med, "material").groupBy("material").agg(F.first("papers").alias("papers"), F.first("med").alias("m"), F.avg(F.abs(F.col("ea") - F.col("med"))).alias("d"))
    return g.select("material", "papers", F.round("m", 9).alias("median_ea"), F.round("d", 9).alias("mean_abs_dev"), (F.round("d", 9) > 0.02).alias("inconsistent"))


def family_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per family: moments, values outside the family's range, and flags (over 20 % outside; under five values)."""
    part = table(spark, sf_dir, "part")
    outside = ~F.col("p_retailprice").between(950.0, 1900.0)
    g = part.groupBy(F.col("p_brand").alias("family")).agg(F.count(F.lit(1)).alias("n"), F.avg("p_retailprice").alias("mean"), F.median("p_retailprice").alias("med"), F.stddev_samp("p_retailprice").alias("sd"), F.min("p_retailprice").alias("min_value"), F.max("p_retailprice").alias("max_value"), F.count_if(outside).alias("outside"))
    return g.select("family", "n", F.round("mean", 6).alias("mean"), F.round("med", 6).alias("median"), F.round("sd", 6).alias("std"), "min_value", "max_value", "outside", (F.col("outside") > 0.2 * F.col("n")).alias("often_outside"), (F.col("n") < 5).alias("few"))


def records_per_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per flag, per status and per ship year, in one pass."""
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", F.year("l_shipdate").alias("y"))
    g = rows.groupingSets([["l_returnflag"], ["l_linestatus"], ["y"]], "l_returnflag", "l_linestatus", "y").agg(F.count(F.lit(1)).alias("n"))
    dim = F.when(F.col("l_returnflag").isNotNull(), "flag").when(F.col("l_linestatus").isNotNull(), "status").otherwise("year")
    return g.select(dim.alias("dimension"), F.coalesce("l_returnflag", "l_linestatus", F.col("y").cast("string")).alias("value"), "n")


def benchmark_tolerance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Does a material's median stand within a factor of ten of its reference value."""
    med = measurements(spark, sf_dir).where("value > 0").groupBy("material").agg(F.median("value").alias("m"))
    ref = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("material"), (F.col("p_retailprice") * 10).alias("reference"))
    j = med.join(ref.where("reference > 0"), "material").withColumn("ratio", F.col("m") / F.col("reference"))
    return j.select("material", F.round("ratio", 6).alias("ratio"), F.col("ratio").between(0.1, 10.0).alias("passes"))


def ensemble_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs vote on a value: at least two distinct runs, the upper median, agreement within 10 %, confidence by votes."""
    rows = measurements(spark, sf_dir).select("material", F.pmod("ordinal", F.lit(5)).alias("run"), F.round(F.col("value") / 1000, 0).alias("v")).distinct()
    g = rows.groupBy("material").agg(F.countDistinct("run").alias("votes"), F.sort_array(F.collect_list("v")).alias("vs")).where("votes >= 2")
    m = F.element_at("vs", (F.floor(F.size("vs") / 2) + 1).cast("int"))
    agree = F.forall("vs", lambda v: F.abs(v - m) < 0.1 * F.abs(m))
    return g.select("material", "votes", m.alias("value"), agree.alias("agree"), F.round(F.least(F.lit(0.85), 0.5 + 0.1 * F.col("votes")), 6).alias("confidence"))


def consensus_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Materials that lack papers up to a target of 40: benchmarks first, then the fewest additions."""
    c = measurements(spark, sf_dir).groupBy("material").agg(F.countDistinct("paper").alias("papers"))
    b = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("material"), (F.col("p_size") > 40).alias("benchmark"))
    need = c.join(b, "material").withColumn("need", 40 - F.col("papers")).where("need > 0")
    return need.orderBy(F.desc("benchmark"), "need", "material").select("material", "papers", "need", "benchmark")


def deficit_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Families by how far their share is under an equal share."""
    g = table(spark, sf_dir, "part").groupBy(F.col("p_type").alias("family")).agg(F.count(F.lit(1)).alias("n"))
    t = g.agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("families"))
    return g.crossJoin(F.broadcast(t)).select("family", "n", F.round(1 / F.col("families") - F.col("n") / F.col("total"), 6).alias("deficit"))  # t is one row


QUERIES = {f.__name__: f for f in (consensus_by_material, consensus_outliers, consensus_grade_distribution, consensus_summary, value_by_temp_bin, temperature_histogram, value_distribution, cross_source_spread, noise_floor, ea_consistency, family_distribution, records_per_dimension, benchmark_tolerance, ensemble_vote, consensus_priority, deficit_ranking)}

_C = f"""{_L}, g as (select material, count(*) n, count(distinct paper) papers, any_value(med) med, min(l) lo, max(l) hi, quantile_cont(l, 0.025) c0, quantile_cont(l, 0.975) c1, median(abs(l - med)) mad, stddev_pop(l) sd, max(abs(l - med)) dev, count(*) filter (abs(l - med) > 1.5) over_ from m group by material),
c as (select material, n, papers, round(pow(10, med), 6) median_value, round(pow(10, lo), 6) min_value, round(pow(10, hi), 6) max_value, case when n >= 3 then round(c0, 6) end ci_low, case when n >= 3 then round(c1, 6) end ci_high, case when n >= 2 then round(mad, 6) end mad, case when n >= 2 then round(sd, 6) end log_std, {GRADE_SQL} grade, cast(case when n >= 3 then over_ else 0 end as bigint) outliers from g)"""
SQL = {
    "consensus_by_material": f"{_C} select * from c",
    "consensus_outliers": f"{_L} select material, ordinal, line, round(abs(l - med), 6) deviation from (select *, count(*) over (partition by material) n from m) where abs(l - med) > 0.8 and n >= 3",
    "consensus_grade_distribution": f"{_C} select grade, count(*) materials, cast(sum(n) as bigint) measurements from c group by grade",
    "consensus_summary": f"{_C} select count(*) groups, count(*) filter (papers >= 3) three_papers, count(*) filter (ci_low is not null) with_ci, cast(sum(n) as bigint) \"values\" from c",
    "value_by_temp_bin": "select cast(round_even(l_quantity / 25, 0) * 25 as int) bin, count(*) n, round(pow(10, median(log10(l_extendedprice))), 6) median_value, round(min(l_extendedprice), 6) min_value, round(max(l_extendedprice), 6) max_value from lineitem where l_extendedprice > 0 group by 1",
    "temperature_histogram": "select cast(floor(l_quantity / 50) * 50 as int) bin, count(*) n from lineitem where l_quantity is not null group by 1",
    "value_distribution": "select l_returnflag as value, count(*) n from lineitem group by 1",
    "cross_source_spread": "select l_partkey material, count(distinct l_suppkey) papers, count(*) n, round(max(l_extendedprice) / min(l_extendedprice), 6) ratio from lineitem where l_extendedprice > 0 group by 1 having count(distinct l_suppkey) >= 2 and max(l_extendedprice) / min(l_extendedprice) > 10",
    "noise_floor": f"{_L}, a as (select *, avg(l) over (partition by material) mean, count(*) over (partition by material) n from m), g as (select material, any_value(n) n, sqrt(avg(pow(l - mean, 2))) rms, avg(abs(l - med)) mad, max(l) - min(l) ptp from a where n >= 2 group by material) select count(*) groups, cast(sum(n) as bigint) entries, round(avg(rms), 6) rms, round(avg(mad), 6) mad, round(max(ptp), 6) widest from g",
    "ea_consistency": "with m as (select l_partkey material, l_suppkey paper, l_discount + 0.01 ea from lineitem), a as (select material, median(ea) med, count(distinct paper) papers from m group by 1), g as (select material, any_value(papers) papers, any_value(med) m, avg(abs(ea - med)) d from m join a using (material) where papers >= 2 group by 1) select material, papers, round(m, 9) median_ea, round(d, 9) mean_abs_dev, round(d, 9) > 0.02 inconsistent from g",
    "family_distribution": "with g as (select p_brand family, count(*) n, avg(p_retailprice) mean, median(p_retailprice) med, stddev_samp(p_retailprice) sd, min(p_retailprice) min_value, max(p_retailprice) max_value, count(*) filter (not p_retailprice between 950 and 1900) outside from part group by 1) select family, n, round(mean, 6) mean, round(med, 6) median, round(sd, 6) std, min_value, max_value, outside, outside > 0.2 * n often_outside, n < 5 few from g",
    "records_per_dimension": "select 'flag' dimension, l_returnflag as value, count(*) n from lineitem group by 2 union all select 'status', l_linestatus, count(*) from lineitem group by 2 union all select 'year', cast(year(l_shipdate) as varchar), count(*) from lineitem group by 2",
    "benchmark_tolerance": "with m as (select l_partkey material, median(l_extendedprice) m from lineitem where l_extendedprice > 0 group by 1) select material, round(m / (p_retailprice * 10), 6) ratio, m / (p_retailprice * 10) between 0.1 and 10 passes from m join part on material = p_partkey where p_retailprice > 0",
    "ensemble_vote": "with r as (select distinct l_partkey material, l_orderkey % 5 run, round(l_extendedprice / 1000, 0) v from lineitem), g as (select material, count(distinct run) votes, list_sort(list(v)) vs from r group by 1), h as (select *, vs[len(vs) // 2 + 1] m from g where votes >= 2) select material, votes, m as value, len(list_filter(vs, lambda v: not abs(v - m) < 0.1 * abs(m))) = 0 agree, round(least(0.85, 0.5 + 0.1 * votes), 6)::double confidence from h",
    "consensus_priority": "select material, papers, 40 - papers need, p_size > 40 benchmark from (select l_partkey material, count(distinct l_suppkey) papers from lineitem group by 1) join part on p_partkey = material where papers < 40",
    "deficit_ranking": "with g as (select p_type family, count(*) n from part group by 1) select family, n, round(1.0::double / (select count(*) from g) - n::double / (select sum(n) from g), 6) deficit from g",
}
