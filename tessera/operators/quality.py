"""Quality: negative signals in three-valued logic, record scores and tiers, red flags, anomalies, audits, drift, gates.

Roles over the driver's tables: a part is a material (p_size, p_retailprice its properties), a lineitem
row a measured record, orders the review queue.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.units import KB_EV, RT_K
from tessera.session import table

#: Grades by score, and thresholds of the negative signals.
GRADES = ((90, "A+"), (80, "A"), (65, "B"), (45, "C"))
E_HULL, LI_HOP = 0.025, 4.5
SIGNALS = ("thermodynamically_unstable", "electronic_conductor", "poor_li_transport_proxy")


def grade(score: Column) -> Column:
    out = F.lit("D")
    for low, name in reversed(GRADES):
        out = F.when(score >= low, name).otherwise(out)
    return out


def negative_signals(e_hull: Column, is_metal: Column, band_gap: Column, li_hop: Column) -> Column:
    """struct(is_negative, reasons, confidence): null without any data, never false."""
    fired = F.array_compact(F.array(
        F.when(e_hull > E_HULL, SIGNALS[0]), F.when(F.coalesce(is_metal, F.lit(False)) | F.coalesce(band_gap == 0, F.lit(False)), SIGNALS[1]), F.when(li_hop > LI_HOP, SIGNALS[2])))
    known = e_hull.isNotNull() | is_metal.isNotNull() | band_gap.isNotNull() | li_hop.isNotNull()
    only_proxy = (F.size(fired) == 1) & F.array_contains(fired, SIGNALS[2])
    return F.struct(F.when(known, F.size(fired) > 0).alias("is_negative"), fired.alias("reasons"), F.when(known, F.when(only_proxy, "medium").otherwise("high")).alias("confidence"))


def _materials(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        "p_partkey", "p_brand", F.when(F.col("p_partkey") % 5 != 0, (F.col("p_size") - 25) / 100).alias("e_hull"), F.when(F.col("p_partkey") % 4 != 0, F.col("p_size") % 7 == 0).alias("is_metal"),
        F.when(F.col("p_partkey") % 3 != 0, (F.col("p_size") % 6).cast("double")).alias("band_gap"), F.when(F.col("p_partkey") % 2 != 0, F.col("p_retailprice") / 300).alias("li_hop"))


def negative_signals_3vl(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = negative_signals(F.col("e_hull"), F.col("is_metal"), F.col("band_gap"), F.col("li_hop"))
    return _materials(spark, sf_dir).select("p_partkey", "p_brand", n.alias("n")).select("p_partkey", "p_brand", "n.is_negative", F.array_join("n.reasons", ",").alias("reasons"), "n.confidence")


def negative_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unknown counts as not negative in the share, and is told on its own."""
    rows = negative_signals_3vl(spark, sf_dir)
    unknown = F.count_if(F.col("is_negative").isNull())
    share = F.round(100.0 * F.count_if(F.coalesce("is_negative", F.lit(False))) / F.count(F.lit(1)), 4)
    return rows.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"), unknown.alias("unknown"), share.alias("share"), *[F.count_if(F.col("reasons").contains(s)).alias(s) for s in SIGNALS])


def completeness_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted share of blocks with data, five points off for a contradiction, clamped, halves to even."""
    m = _materials(spark, sf_dir)
    has = lambda c: F.when(F.col(c).isNotNull(), 1.0).otherwise(0.0)
    score = 40 * has("e_hull") + 25 * has("band_gap") + 20 * has("li_hop") + 15 * has("is_metal")
    penalty = F.when(F.col("is_metal") & (F.col("band_gap") > 0), 5).otherwise(0)
    return m.select("p_partkey", F.bround(F.greatest(F.lit(0.0), F.least(F.lit(100.0), score - penalty)), 0).cast("int").alias("score"))


def record_components() -> dict[str, Column]:
    """Weights of evidence, metadata, agreement and depth."""
    flag = lambda c: c.cast("int")
    evidence = F.bround((flag(F.col("l_discount") > 0) + flag(F.col("l_tax") > 0) + flag(F.col("l_returnflag") != "N")) / 3 * 20, 0)
    metadata = 6 * flag(F.col("l_quantity") > 10) + 6 * flag(F.col("l_linestatus") == "F") + 2 * flag(F.col("l_linenumber") > 1) + 2 * flag(F.col("l_linenumber") > 2) + 2 * flag(F.col("l_tax") > 0.02) + 2 * flag(F.col("l_discount") > 0.02)
    rank = F.when(F.col("l_linenumber") <= 5, F.col("l_linenumber")).otherwise(0)
    agreement = F.when(rank == 0, 5).otherwise(F.bround(rank / 5 * 15, 0))
    depth = F.least(F.lit(10), F.least(F.col("l_linenumber"), F.lit(3)) * 2 + 4 * flag(F.col("l_discount") > 0))
    human = F.when(F.col("l_returnflag") == "A", 25).otherwise(0)
    penalty = F.when(F.col("l_extendedprice") > 90_000, -10).otherwise(0)
    return {"human": human, "evidence": evidence, "metadata": metadata, "agreement": agreement, "depth": depth, "penalty": penalty}


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = record_components()
    li = table(spark, sf_dir, "lineitem").withColumns({k: c.cast("int") for k, c in parts.items()})
    total = F.greatest(F.lit(0), F.least(F.lit(100), sum(F.col(k) for k in parts)))
    seen = (F.col("l_discount") > 0) | (F.col("l_tax") > 0)
    return li.withColumn("seen", seen).withColumn("score", F.when(~F.col("seen") & (F.col("human") == 0), F.least(total, F.lit(30))).otherwise(total))


def record_quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "human", "evidence", "metadata", "agreement", "depth", "penalty", "score", grade(F.col("score")).alias("grade"))


def tier_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered decisions: rejected sources, machine-only rows, gold, silver, the rest."""
    human = F.col("human") > 0
    pair = (F.col("score") >= 75) & (F.col("l_quantity") > 10) & (F.col("l_linestatus") == "F")
    agrees = F.col("l_linenumber").isin(4, 5)
    tier = F.when(F.col("l_quantity") > 49, "rejected").when(~human, F.when(F.col("score") >= 60, "bronze").otherwise("rejected")).when(F.col("seen") & agrees & pair, "gold").when(F.col("seen"), "silver").otherwise("rejected")
    return _scored(spark, sf_dir).groupBy(tier.alias("tier"), grade(F.col("score")).alias("grade")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("score"), 6).alias("avg_score"))


#: Flag, severity, condition: rows of a table in the order of the checks.
def red_flags() -> tuple[tuple[str, str, Column], ...]:
    sigma, ea = F.col("l_extendedprice") * 1e-7, F.col("l_discount") * 10
    prefactor = sigma / F.exp(-ea / (KB_EV * RT_K))
    return (
        ("sigma_out_of_range", "high", ~sigma.between(1e-4, 8e-3)),
        ("ea_out_of_range", "medium", ~ea.between(0.05, 0.95)),
        ("arrhenius", "high", (sigma > 0) & (ea > 0) & ~prefactor.between(1e1, 1e5)),
        ("type_missing", "low", (F.col("l_returnflag") == "N") & (F.col("l_linenumber") > 4)),
    )


def redflags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per flag that a record raises: one projection, exploded."""
    flags = F.array_compact(F.array(*[F.when(c, F.struct(F.lit(n).alias("flag"), F.lit(s).alias("severity"))) for n, s, c in red_flags()]))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.explode(flags).alias("f")).select("l_orderkey", "l_linenumber", "l_partkey", "f.flag", "f.severity")


def redflag_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return redflags(spark, sf_dir).groupBy("flag", "severity").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("l_partkey").alias("materials"))


def anomaly_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight checks: name, severity, number of offenders. Row checks share one scan; a duplicated key counts all its rows, a paper of several materials once."""
    li = table(spark, sf_dir, "lineitem")
    checks = (
        ("negative_activation_energy", "high", F.col("l_discount") < 0), ("negative_conductivity", "high", F.col("l_extendedprice") - 1000 < 0),
        ("density_exceeds_theoretical", "medium", F.col("l_tax") * 100 > 5 * 1.05), ("temperature_below_zero_k", "high", F.col("l_quantity") - 2 < 0),
        ("missing_composition", "high", F.col("l_partkey").isNull() | (F.trim(F.col("l_partkey").cast("string")) == "")), ("charge_imbalance", "medium", (F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "O")),
    )
    row = li.agg(*[F.count_if(c).alias(n) for n, _, c in checks])
    single = row.select(F.explode(F.array(*[F.struct(F.lit(n).alias("check"), F.lit(s).alias("severity"), F.col(n).alias("n")) for n, s, _ in checks])).alias("p")).select("p.*")
    ends = li.where("l_suppkey is not null").groupBy("l_suppkey").agg(F.min("l_partkey").alias("a"), F.max("l_partkey").alias("z"))
    papers = ends.agg(F.lit("duplicate_doi").alias("check"), F.lit("low").alias("severity"), F.count_if(F.col("a") < F.col("z")).alias("n"))
    copies = li.groupBy("l_suppkey", "l_partkey", "l_extendedprice").agg(F.count(F.lit(1)).alias("c"))
    rows = copies.agg(F.lit("duplicate_experiment").alias("check"), F.lit("medium").alias("severity"), F.coalesce(F.sum(F.when(F.col("c") > 1, F.col("c"))), F.lit(0)).alias("n"))
    return single.unionByName(papers).unionByName(rows)


def unit_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values outside the physical ranges of their unit."""
    li = table(spark, sf_dir, "lineitem")
    outside = lambda c, lo, hi: F.count_if(F.col(c).isNotNull() & ~F.col(c).between(lo, hi))
    return li.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), outside("l_extendedprice", 1000.0, 90000.0).alias("value_outside"), outside("l_discount", 0.01, 0.09).alias("ea_outside"), F.count_if(F.col("l_quantity") < 0).alias("temperature_outside"))


def field_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").where("l_returnflag <> 'N'")
    share = lambda c: F.round(F.avg(c.cast("int")) * 100, 6)
    return li.groupBy("l_linestatus").agg(share(F.col("l_discount") > 0).alias("discount"), share(F.col("l_tax") > 0).alias("tax"), share(F.col("l_quantity") > 25).alias("quantity"))


def drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage of two snapshots (years) per family: joined in full, kept where it moved over two points."""
    li = table(spark, sf_dir, "lineitem").withColumn("y", F.year("l_shipdate"))
    cover = lambda y: li.where(F.col("y") == y).groupBy(F.col("l_linenumber").alias("family")).agg((F.avg((F.col("l_discount") > 0.05).cast("int")) * 100).alias(f"c{y}"))
    j = cover(1996).join(cover(1997), "family", "full")
    delta = F.round(F.coalesce("c1997", F.lit(0.0)) - F.coalesce("c1996", F.lit(0.0)), 6)
    return j.select("family", delta.alias("delta")).where(F.abs("delta") > 0.2)


def rejection_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notes fall under the first pattern that fits; the ten most frequent."""
    patterns = (("url", "^https?://"), ("numbers", "[0-9]{3}"), ("quoted", '"'), ("table", r"\|"), ("question", r"\?"))
    c = table(spark, sf_dir, "conversations")
    reason = F.lit("other")
    for name, p in reversed(patterns):
        reason = F.when(F.col("text").rlike(p), name).otherwise(reason)
    g = c.groupBy("role", reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))
    return g.orderBy(F.desc("n"), "role", "reason").limit(10)


def rejection_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The queue's funnel by status, and the rate of decided items."""
    o = table(spark, sf_dir, "orders")
    g = o.groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).agg(F.count(F.lit(1))).fillna(0)
    decided = F.col("F") + F.col("P")
    return g.select("o_orderpriority", F.col("F").alias("approved"), F.col("O").alias("pending"), F.col("P").alias("rejected"), F.round(F.try_divide(100.0 * F.col("P"), decided), 6).alias("rate"))


#: Gate -> the metrics that it asks for, each at least ("min") or at most ("max") a threshold; all must hold.
GATES = {
    "total_records": (("rows", "min", 1000.0),),
    "verified_labels": (("labels", "min", 500.0),),
    "materials": (("materials", "min", 100.0),),
    "relational_model": (("materials", "min", 100.0), ("experiments", "min", 500.0), ("rows", "min", 1000.0)),
    "pending_queue": (("pending", "max", 0.0),),
    "evidence_quality": (("page_pct", "min", 80.0), ("sentence_pct", "min", 80.0)),
    "duplicate_rate": (("duplicate_pct", "max", 1.0),),
    "metadata_completeness": (("temperature_pct", "min", 95.0), ("method_pct", "min", 80.0)),
    "doi_coverage": (("doi_pct", "min", 99.0),),
    "health_report": (("rows", "min", 1.0),),
    "gold_tier": (("gold_pct", "min", 30.0),),
    "canonical_quality": (("scored", "min", 1000.0), ("score", "min", 50.0)),
    "anomalies": (("high_anomalies", "max", 0.0),),
    "unit_audit": (("invalid_units", "max", 0.0),),
    "provenance": (("doi_pct", "min", 99.0), ("sentence_pct", "min", 80.0), ("confidence_pct", "min", 90.0)),
    "families": (("families", "min", 5.0), ("largest_family_pct", "max", 60.0)),
    "negative_results": (("negative_pct", "min", 5.0),),
    "consensus_groups": (("several_papers", "min", 100.0),),
}


def gates_of(metrics: DataFrame, spec: dict = GATES) -> DataFrame:
    """gate, measured (its first metric), ok, of a row of metrics; a metric without a value fails."""
    holds = lambda m, kind, t: F.coalesce(F.col(m) >= t if kind == "min" else F.col(m) <= t, F.lit(False))
    rows = [F.struct(F.lit(g).alias("gate"), F.round(F.col(parts[0][0]).cast("double"), 6).alias("measured"), reduce(Column.__and__, [holds(*x) for x in parts]).alias("ok")) for g, parts in spec.items()]
    return metrics.select(F.explode(F.array(*rows)).alias("g")).select("g.*")


def release_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the gates ask for, as one row: one scan of the records and narrow aggregates beside it."""
    li, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    pct = lambda c, name: (F.avg(c.cast("int")) * 100).alias(name)
    own = li.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("l_returnflag") == "A").alias("labels"), pct(F.col("l_linenumber") > 1, "page_pct"), pct(F.col("l_discount") > 0, "sentence_pct"), pct(F.col("l_quantity").isNotNull(), "temperature_pct"),
        pct(F.col("l_tax") > 0, "method_pct"), pct(F.col("l_suppkey").isNotNull(), "doi_pct"), pct((F.col("l_quantity") > 25) & (F.col("l_tax") > 0.02), "gold_pct"), F.count("l_quantity").alias("scored"), (F.avg("l_quantity") * 2).alias("score"),
        F.count_if(F.col("l_extendedprice") <= 0).alias("invalid_units"), pct(F.col("l_discount") < 0.1, "confidence_pct"), pct(F.col("l_returnflag") == "R", "negative_pct"),
    )
    materials = li.groupBy("l_partkey").agg(F.min("l_suppkey").alias("a"), F.max("l_suppkey").alias("z")).agg(F.count("l_partkey").alias("materials"), F.count_if(F.col("a") < F.col("z")).alias("several_papers"))
    experiments = li.groupBy("l_partkey", "l_suppkey", "l_quantity").agg(F.count(F.lit(1)).alias("c")).agg(F.count(F.lit(1)).alias("experiments"), (100 * F.sum(F.when(F.col("c") > 1, F.col("c")).otherwise(0)) / F.sum("c")).alias("duplicate_pct"))
    families = table(spark, sf_dir, "part").groupBy("p_brand").agg(F.count(F.lit(1)).alias("n")).agg(F.count(F.lit(1)).alias("families"), (100 * F.max("n") / F.sum("n")).alias("largest_family_pct"))
    pending = o.agg(F.count_if(F.col("o_orderstatus") == "O").alias("pending"))
    high = anomaly_scan(spark, sf_dir).agg(F.count_if((F.col("severity") == "high") & (F.col("n") > 0)).alias("high_anomalies"))
    return reduce(lambda a, b: a.crossJoin(F.broadcast(b)), (own, materials, experiments, families, pending, high))  # one row each


def release_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The computed gates of a release: what is measured, and whether it is enough."""
    return gates_of(release_metrics(spark, sf_dir))


def queue_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by status and by band of confidence, in grouping sets."""
    o = table(spark, sf_dir, "orders").select("o_orderstatus", F.when(F.col("o_totalprice") >= 200_000, "high").when(F.col("o_totalprice") >= 100_000, "middle").otherwise("low").alias("band"))
    return o.groupingSets([["o_orderstatus"], ["band"], []], "o_orderstatus", "band").agg(F.count(F.lit(1)).alias("n"))


def missing_recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per field how many approved records lack it, with the first and the last of them."""
    li = table(spark, sf_dir, "lineitem").where("l_returnflag = 'A'")
    fields = F.array(*[F.when(F.col(c) == 0, F.lit(c)) for c in ("l_discount", "l_tax")])
    g = li.select("l_orderkey", F.explode(F.array_compact(fields)).alias("field")).groupBy("field")
    n = g.agg(F.count(F.lit(1)).alias("missing"), F.min("l_orderkey").alias("first_id"), F.max("l_orderkey").alias("last_id"))
    total = li.agg(F.count(F.lit(1)).alias("t"))
    return n.crossJoin(F.broadcast(total)).select("field", "missing", "first_id", "last_id", F.round(100.0 * F.col("missing") / F.col("t"), 1).alias("pct"))  # total is one row


QUERIES = {f.__name__: f for f in (negative_signals_3vl, negative_summary, completeness_score, record_quality_score, tier_assignment, redflags, redflag_summary, anomaly_scan, unit_audit, field_coverage, drift, rejection_reasons, rejection_statistics, release_gates, queue_summary, missing_recommendations)}

_MAT = "select p_partkey, p_brand, case when p_partkey % 5 <> 0 then (p_size - 25) / 100 end e_hull, case when p_partkey % 4 <> 0 then p_size % 7 = 0 end is_metal, case when p_partkey % 3 <> 0 then (p_size % 6)::double end band_gap, case when p_partkey % 2 <> 0 then p_retailprice / 300 end li_hop from part"
_NEG = f"with m as ({_MAT}), f as (select *, coalesce(e_hull > 0.025, false) a, coalesce(is_metal, false) or coalesce(band_gap = 0, false) b, coalesce(li_hop > 4.5, false) c, e_hull is not null or is_metal is not null or band_gap is not null or li_hop is not null known from m), n as (select p_partkey, p_brand, case when known then a or b or c end is_negative, concat_ws(',', case when a then 'thermodynamically_unstable' end, case when b then 'electronic_conductor' end, case when c then 'poor_li_transport_proxy' end) reasons, case when known then case when c and not a and not b then 'medium' else 'high' end end confidence from f)"
_G = "case when score >= 90 then 'A+' when score >= 80 then 'A' when score >= 65 then 'B' when score >= 45 then 'C' else 'D' end"
_REC = """with p as (select *, case when l_returnflag = 'A' then 25 else 0 end human, cast(round_even(((l_discount > 0)::int + (l_tax > 0)::int + (l_returnflag <> 'N')::int)::double / 3 * 20, 0) as int) evidence,
6 * (l_quantity > 10)::int + 6 * (l_linestatus = 'F')::int + 2 * (l_linenumber > 1)::int + 2 * (l_linenumber > 2)::int + 2 * (l_tax > 0.02)::int + 2 * (l_discount > 0.02)::int metadata,
cast(case when l_linenumber > 5 then 5 else round_even(l_linenumber::double / 5 * 15, 0) end as int) agreement, least(10, least(l_linenumber, 3) * 2 + 4 * (l_discount > 0)::int) depth, case when l_extendedprice > 90000 then -10 else 0 end penalty, l_discount > 0 or l_tax > 0 seen from lineitem),
t as (select *, greatest(0, least(100, human + evidence + metadata + agreement + depth + penalty)) total from p), s as (select *, case when not seen and human = 0 then least(total, 30) else total end score from t)"""
_FLAGS = "select l_orderkey, l_linenumber, l_partkey, 'sigma_out_of_range' flag, 'high' severity from lineitem where not l_extendedprice * 1e-7 between 1e-4 and 8e-3 union all select l_orderkey, l_linenumber, l_partkey, 'ea_out_of_range', 'medium' from lineitem where not l_discount * 10 between 0.05 and 0.95 union all select l_orderkey, l_linenumber, l_partkey, 'arrhenius', 'high' from lineitem where l_extendedprice > 0 and l_discount > 0 and not l_extendedprice * 1e-7 / exp(-l_discount * 10 / (8.617333262e-5 * 298)) between 10 and 1e5 union all select l_orderkey, l_linenumber, l_partkey, 'type_missing', 'low' from lineitem where l_returnflag = 'N' and l_linenumber > 4"
_holds = lambda parts: " and ".join(f"{m} {'>=' if kind == 'min' else '<='} {t}" for m, kind, t in parts)
SQL = {
    "negative_signals_3vl": f"{_NEG} select * from n",
    "negative_summary": f"{_NEG} select p_brand, count(*) n, count(*) filter (is_negative is null) unknown, round(100.0::double * count(*) filter (coalesce(is_negative, false)) / count(*), 4) share, " + ", ".join(f"count(*) filter (contains(reasons, '{s}')) {s}" for s in SIGNALS) + " from n group by 1",
    "completeness_score": f"with m as ({_MAT}) select p_partkey, cast(round_even(greatest(0, least(100, 40 * (e_hull is not null)::int + 25 * (band_gap is not null)::int + 20 * (li_hop is not null)::int + 15 * (is_metal is not null)::int - case when is_metal and band_gap > 0 then 5 else 0 end)), 0) as int) score from m",
    "record_quality_score": f"{_REC} select l_orderkey, l_linenumber, l_partkey, l_suppkey, human, evidence, metadata, agreement, depth, penalty, score, {_G} grade from s",
    "tier_assignment": f"{_REC} select case when l_quantity > 49 then 'rejected' when human = 0 then case when score >= 60 then 'bronze' else 'rejected' end when seen and l_linenumber in (4, 5) and score >= 75 and l_quantity > 10 and l_linestatus = 'F' then 'gold' when seen then 'silver' else 'rejected' end tier, {_G} grade, count(*) n, round(avg(score), 6) avg_score from s group by 1, 2",
    "redflags": _FLAGS,
    "redflag_summary": f"select flag, severity, count(*) n, count(distinct l_partkey) materials from ({_FLAGS}) group by 1, 2",
    "anomaly_scan": """
    select 'negative_activation_energy' as "check", 'high' as severity, count(*) filter (l_discount < 0) as n from lineitem
    union all select 'negative_conductivity', 'high', count(*) filter (l_extendedprice < 1000) from lineitem
    union all select 'density_exceeds_theoretical', 'medium', count(*) filter (l_tax * 100 > 5.25) from lineitem
    union all select 'temperature_below_zero_k', 'high', count(*) filter (l_quantity < 2) from lineitem
    union all select 'missing_composition', 'high', count(*) filter (l_partkey is null) from lineitem
    union all select 'charge_imbalance', 'medium', count(*) filter (l_returnflag = 'A' and l_linestatus = 'O') from lineitem
    union all select 'duplicate_doi', 'low', count(*) from (select l_suppkey from lineitem group by 1 having count(distinct l_partkey) > 1)
    union all select 'duplicate_experiment', 'medium', coalesce(sum(c), 0)::bigint from (select count(*) as c from lineitem group by l_suppkey, l_partkey, l_extendedprice having count(*) > 1)""",
    "unit_audit": "select l_returnflag, count(*) n, count(*) filter (not l_extendedprice between 1000 and 90000) value_outside, count(*) filter (not l_discount between 0.01 and 0.09) ea_outside, count(*) filter (l_quantity < 0) temperature_outside from lineitem group by 1",
    "field_coverage": "select l_linestatus, round(avg((l_discount > 0)::int) * 100, 6) discount, round(avg((l_tax > 0)::int) * 100, 6) tax, round(avg((l_quantity > 25)::int) * 100, 6) quantity from lineitem where l_returnflag <> 'N' group by 1",
    "drift": "with c as (select l_linenumber as family, avg((l_discount > 0.05)::int) filter (year(l_shipdate) = 1996) * 100 a, avg((l_discount > 0.05)::int) filter (year(l_shipdate) = 1997) * 100 b from lineitem where year(l_shipdate) in (1996, 1997) group by 1) select family, round(coalesce(b, 0) - coalesce(a, 0), 6) delta from c where abs(round(coalesce(b, 0) - coalesce(a, 0), 6)) > 0.2",
    "rejection_reasons": "select role, case when regexp_matches(text, '^https?://') then 'url' when regexp_matches(text, '[0-9]{3}') then 'numbers' when contains(text, '\"') then 'quoted' when contains(text, '|') then 'table' when contains(text, '?') then 'question' else 'other' end reason, count(*) n from conversations group by 1, 2 order by n desc, role, reason limit 10",
    "rejection_statistics": "with g as (select o_orderpriority, count(*) filter (o_orderstatus = 'F') approved, count(*) filter (o_orderstatus = 'O') pending, count(*) filter (o_orderstatus = 'P') rejected from orders group by 1) select *, round(100.0::double * rejected / nullif(approved + rejected, 0), 6) rate from g",
    "release_gates": f"""
    with own as (select count(*) as rows, count(*) filter (l_returnflag = 'A') as labels, avg((l_linenumber > 1)::int) * 100 as page_pct, avg((l_discount > 0)::int) * 100 as sentence_pct, avg((l_quantity is not null)::int) * 100 as temperature_pct,
      avg((l_tax > 0)::int) * 100 as method_pct, avg((l_suppkey is not null)::int) * 100 as doi_pct, avg((l_quantity > 25 and l_tax > 0.02)::int) * 100 as gold_pct, count(l_quantity) as scored, avg(l_quantity) * 2 as score,
      count(*) filter (l_extendedprice <= 0) as invalid_units, avg((l_discount < 0.1)::int) * 100 as confidence_pct, avg((l_returnflag = 'R')::int) * 100 as negative_pct,
      (count(*) filter (l_discount < 0) > 0)::int + (count(*) filter (l_extendedprice < 1000) > 0)::int + (count(*) filter (l_quantity < 2) > 0)::int + (count(*) filter (l_partkey is null) > 0)::int as high_anomalies from lineitem),
    m as (select count(*) as materials, count(*) filter (p > 1) as several_papers from (select count(distinct l_suppkey) as p from lineitem group by l_partkey)),
    e as (select count(*) as experiments, 100 * sum(case when c > 1 then c else 0 end) / sum(c) as duplicate_pct from (select count(*) as c from lineitem group by l_partkey, l_suppkey, l_quantity)),
    f as (select count(*) as families, 100 * max(n) / sum(n) as largest_family_pct from (select count(*) as n from part group by p_brand)),
    o as (select count(*) filter (o_orderstatus = 'O') as pending from orders),
    x as (select * from own, m, e, f, o)
    {' union all '.join(f"select '{g}' as gate, round({parts[0][0]}::double, 6) as measured, {_holds(parts)} as ok from x" for g, parts in GATES.items())}""",
    "queue_summary": "select o_orderstatus, band, count(*) n from (select o_orderstatus, case when o_totalprice >= 200000 then 'high' when o_totalprice >= 100000 then 'middle' else 'low' end band from orders) group by grouping sets ((o_orderstatus), (band), ())",
    "missing_recommendations": "with a as (select * from lineitem where l_returnflag = 'A'), g as (select 'l_discount' field, count(*) missing, min(l_orderkey) first_id, max(l_orderkey) last_id from a where l_discount = 0 union all select 'l_tax', count(*), min(l_orderkey), max(l_orderkey) from a where l_tax = 0) select field, missing, first_id, last_id, round(100.0::double * missing / (select count(*) from a), 1) pct from g where missing > 0",
}
