"""Agreement between sources: formula joins, ranks, percentiles, conflicts, near values, cards, as-of and range joins."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.functions.units import agreement
from tessera.operators.ranks import running_totals
from tessera.session import table, written

#: Parts of a doubling in logarithms, those by which two of them may be wrong together, and the most pairs of distinct values made at once.
OCTAVE, SLACK, PAIRS = 1 << 40, 16, 4_000_000


def near_pairs(df: DataFrame, keys: list[str], value: str, row: str, width: float) -> DataFrame:
    """Pairs of rows with equal keys and values (logarithms) nearer than width.

    Values fall into bins of that width; a row meets its own bin and the next, so that only neighbours are compared.
    """
    base = df.withColumn("_bin", F.floor(F.col(value) / width).cast("long"))
    left = base.select(*keys, F.col(row).alias("row_a"), F.col(value).alias("a"), F.explode(F.array(F.col("_bin"), F.col("_bin") + 1, F.col("_bin") - 1)).alias("_bin"))
    right = base.select(*keys, F.col(row).alias("row_b"), F.col(value).alias("b"), "_bin")
    return left.join(right, [*keys, "_bin"]).where((F.col("row_a") < F.col("row_b")) & (F.abs(F.col("a") - F.col("b")) < width)).drop("_bin")


def as_of(left: DataFrame, right: DataFrame, key: str, at: str, payload: list[str]) -> DataFrame:
    """For each left row the last right row of its key that isn't later: a union in time order and a running last value."""
    both = left.select(key, at, F.lit(None).cast(right.select(F.struct(*payload).alias("p")).schema["p"].dataType).alias("p"), F.lit(1).alias("side"), F.struct(*left.columns).alias("row"))
    theirs = right.select(key, at, F.struct(*payload).alias("p"), F.lit(0).alias("side"), F.lit(None).cast(both.schema["row"].dataType).alias("row"))
    w = W.partitionBy(key).orderBy(at, "side").rowsBetween(W.unboundedPreceding, 0)
    found = both.unionByName(theirs).withColumn("seen", F.last("p", ignorenulls=True).over(w)).where("side = 1")
    return found.select("row.*", *[F.col(f"seen.{p}").alias(p) for p in payload])


def _mean_over_partners(rows: DataFrame) -> DataFrame:
    """partners, score of every row (formula, side, key, size, price > 0): the mean agreement with all rows of the other side, without a pair.

    The agreement falls in straight lines from 1 at equality to 0 at the tolerance, so that its sum over the partners below a
    row and over those above it hangs on their number, sum and sum of reciprocals alone, which are differences of sums up to a bound.
    """
    def upto(order: str, bound: float, value: Column) -> Column:
        w = W.partitionBy("formula").orderBy(order).rangeBetween(W.unboundedPreceding, bound)
        sums = F.array(*[F.coalesce(F.sum(F.when(F.col("side") == s, value)).over(w), F.lit(0)).cast("double") for s in (2, 1)])
        return F.element_at(sums, F.col("side"))

    a, p, one = F.col("size"), F.col("price"), F.lit(1)
    rows = rows.withColumn("x", F.log2("price"))
    sized = {f"{n}{k}": upto("size", b, v) for n, v in (("c", one), ("s", a)) for k, b in (("0", -20), ("1", 0), ("2", 20))}
    priced = {f"p{n}{k}": upto("x", b, v) for n, v in (("c", one), ("s", p), ("r", 1 / p)) for k, b in (("0", -1), ("1", 0), ("2", 1))}
    d = rows.withColumns(sized).withColumns(priced).withColumn("partners", F.element_at(F.array(*[F.count_if(F.col("side") == s).over(W.partitionBy("formula")) for s in (2, 1)]), F.col("side")))
    c = lambda name: F.col(name)
    below, above = lambda n: c(f"{n}1") - c(f"{n}0"), lambda n: c(f"{n}2") - c(f"{n}1")
    by_size = below("c") * (1 - a / 20) + below("s") / 20 + above("c") * (1 + a / 20) - above("s") / 20
    by_price = 2 * below("ps") / p - below("pc") + 2 * p * above("pr") - above("pc")
    return d.where("partners > 0").select("formula", "key", "partners", ((by_size + by_price) / 2 / c("partners")).alias("score"))


def cross_source_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Materials of both sources with partners of equal formula in the other; a record's score is its mean agreement with them."""
    p = table(spark, sf_dir, "part")
    rows = p.select(F.concat_ws("/", "p_brand", "p_type").alias("formula"), F.col("p_partkey").alias("key"), F.when(F.col("p_partkey") % 2 == 1, 1).otherwise(2).alias("side"), F.col("p_size").cast("double").alias("size"), F.col("p_retailprice").alias("price"))
    return _mean_over_partners(rows.where("price > 0")).select("formula", "key", "partners", F.round("score", 4).alias("score"))


def agreement_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = W.partitionBy("formula").orderBy(F.desc("score"), "key")
    return cross_source_agreement(spark, sf_dir).withColumn("rank", F.row_number().over(w))


def _ranked(known: dict, ranks: list[int]) -> dict:
    """For each rank the last edge that no more pairs are nearer than, and the first that more are nearer than (None: no such edge)."""
    return {j: (max(e for e in known if known[e][0] <= j), min((e for e in known if known[e][0] > j), default=None)) for j in ranks}


def relative_agreement_at(counts: DataFrame, ranks: list[int], tolerance: float = 0.5, most: int = PAIRS) -> dict[int, float]:
    """For each rank (from 0, the nearest first) the relative agreement of the pair of a side 1 and a side 2 row there; 0 beyond the tolerance.

    counts: formula, side, v (finite), n (rows of that value). The agreement falls with the difference of logarithms, so that the pairs
    nearer than an edge are differences of running sums. Edges close in on each rank until at most `most` pairs of
    distinct values lie between two of them; only those are made. Logarithms are whole parts of a doubling;
    pairs of SLACK parts beyond the edges are made too, so that their order is that of the agreements themselves.
    Values nearer to 0 than 1e-12 count as 0.
    """
    end = math.ceil(-math.log2(1 - tolerance) * OCTAVE) + SLACK
    size = F.abs("v")
    x = F.when(size < 1e-12, 0).otherwise(F.round(F.log2(size) * OCTAVE)).cast("long")
    rows = written(counts.select("formula", F.when(size < 1e-12, 0).otherwise(F.signum("v")).cast("int").alias("sign"), "side", "v", x.alias("x"), "n"), "logarithms")
    w = W.partitionBy("formula", "sign").orderBy("x")

    def nearer(edges: list[int]) -> dict:
        """edge: pairs nearer than it, and pairs of distinct values."""
        weights = {"many": F.col("n"), "one": F.lit(1).cast("long")}
        upto = lambda c, bound: F.coalesce(F.sum(c).over(w.rangeBetween(W.unboundedPreceding, bound)), F.lit(0))
        sides = rows.withColumns({c: F.when(F.col("side") == 2, v).otherwise(0) for c, v in weights.items()})
        within = sides.withColumns({f"{c}{k}": upto(c, e - 1) - upto(c, -e) for c in weights for k, e in enumerate(edges)}).where("side = 1")
        sums = within.agg(*[F.coalesce(F.sum(v * F.col(f"{c}{k}")), F.lit(0)) for k in range(len(edges)) for c, v in weights.items()]).head()
        return {e: (sums[2 * k], sums[2 * k + 1]) for k, e in enumerate(edges)}

    known = {0: (0, 0)} | nearer([end])
    while True:
        wide = {(lo, hi) for lo, hi in _ranked(known, ranks).values() if hi and hi - lo > SLACK and known[hi][1] - known[lo][1] > most}
        if not wide:
            break
        cuts = max(8, 32 // len(wide))
        known |= nearer(sorted({lo + (hi - lo) * k // cuts for lo, hi in wide for k in range(1, cuts)} - known.keys()))

    found, places = {}, _ranked(known, ranks)
    for lo, hi in set(places.values()):
        inside = [j for j in ranks if places[j] == (lo, hi)]
        if hi is None:
            found |= dict.fromkeys(inside, 0.0)
        elif known[hi][1] - known[lo][1] > most:  # these agree to SLACK parts
            found |= dict.fromkeys(inside, max(0.0, 1 - (1 - 2 ** (-lo / OCTAVE)) / tolerance))
        else:
            first, last = max(lo - SLACK, 0), hi + SLACK  # distances from first, up to but not last
            bin_of = lambda c: c - F.pmod(c, F.lit(last - first))
            bins = [F.sequence(bin_of(F.col("x") + a), bin_of(F.col("x") + b), F.lit(last - first)) for a, b in ((first, last - 1), (1 - last, -first))]
            left = rows.where("side = 1").select("formula", "sign", F.col("v").alias("a"), F.col("x").alias("ax"), F.col("n").alias("an"), F.explode(F.array_distinct(F.concat(*bins))).alias("bin"))
            right = rows.where("side = 2").select("formula", "sign", F.col("v").alias("b"), F.col("x").alias("bx"), F.col("n").alias("bn"), bin_of(F.col("x")).alias("bin"))
            gap = F.abs(F.col("ax") - F.col("bx"))
            pairs = left.join(right, ["formula", "sign", "bin"]).where((gap >= first) & (gap < last)).select(F.when(F.col("sign") == 0, 0.0).otherwise(F.col("a")).alias("a"), F.when(F.col("sign") == 0, 0.0).otherwise(F.col("b")).alias("b"), gap.alias("gap"), (F.col("an") * F.col("bn")).alias("n"))
            values = written(pairs.groupBy((-agreement(F.col("a"), F.col("b"), tolerance, relative=True)).alias("v")).agg(F.sum("n").alias("n"), F.sum(F.when(F.col("gap") < lo, F.col("n")).otherwise(0)).alias("before")), "agreements")
            start = known[lo][0] - values.agg(F.sum("before")).head()[0]  # pairs nearer than first
            at = F.filter(F.array(*[F.lit(j - start).cast("long") for j in inside]), lambda r: (r < F.col("until")) & (r >= F.col("until") - F.col("n")))
            totals = running_totals(values.select("v", "n"), "v", "n")
            found |= {r["rank"] + start: abs(r["v"]) for r in totals.select("v", F.explode(at).alias("rank")).collect()}  # a row per rank
    return found


def agreement_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles of the agreement of all pairs of materials of two sources (odd and even keys) with equal brand and type, from counted values."""
    p = table(spark, sf_dir, "part").select(F.concat_ws("/", "p_brand", "p_type").alias("formula"), F.when(F.col("p_partkey") % 2 == 1, 1).when(F.col("p_partkey") % 2 == 0, 2).alias("side"), F.col("p_size").cast("long").alias("size"), F.col("p_retailprice").cast("double").alias("price")).where("side is not null")
    prices = written(p.groupBy("formula", "side", F.col("price").alias("v")).agg(F.count(F.lit(1)).alias("n")), "prices")
    sizes = written(p.where("size is not null").groupBy("formula", "side", "size").agg(F.count(F.lit(1)).alias("n")), "sizes")
    finite = F.abs("v") < math.inf  # not NaN either, which is above all
    kinds = {"all": F.lit(True), "some": F.col("v").isNotNull(), "finite": finite}
    by_side = prices.groupBy("formula").agg(*[F.sum(F.when((F.col("side") == s) & test, F.col("n")).otherwise(0)).alias(f"{k}{s}") for k, test in kinds.items() for s in (1, 2)])
    n, some, fine = (x or 0 for x in by_side.agg(*[F.sum(F.col(f"{k}1") * F.col(f"{k}2")) for k in kinds]).head())
    if not n:
        return spark.createDataFrame([], "property string, n long, p25 double, p50 double, p75 double, p95 double")
    places = [(math.floor(q * (n - 1)), math.ceil(q * (n - 1)), q * (n - 1)) for q in (0.25, 0.5, 0.75, 0.95)]
    ranks = sorted({n - 1 - k for low, high, _ in places for k in (low, high)})  # from the top

    # null agrees with nothing; what isn't finite gives NaN, the highest
    strange = some - fine
    priced = relative_agreement_at(prices.where(finite), [j - strange for j in ranks if j >= strange])
    price = {j: math.nan if j < strange else priced[j - strange] for j in ranks}

    a = sizes.where("side = 1").select("formula", F.col("n").alias("an"), F.explode(F.sequence(F.lit(-19), F.lit(19))).alias("gap"), "size").withColumn("size", F.col("size") + F.col("gap"))
    b = sizes.where("side = 2").select("formula", "size", "n")
    gaps = a.join(b, ["formula", "size"]).groupBy(F.abs("gap").alias("gap")).agg(F.sum(F.col("an") * F.col("n")).alias("n"))
    until, size = 0, dict.fromkeys(ranks, 0.0)
    for gap, m in sorted(map(tuple, gaps.collect())):  # 20 rows at most
        size |= {j: max(0.0, 1 - gap / 20.0) for j in ranks if until <= j < until + m}
        until += m

    def row(name: str, at: dict) -> Column:
        low_high = [(at[n - 1 - low], at[n - 1 - high], place - low) for low, high, place in places]
        quantiles = [F.round(F.lit(low + (high - low) * share), 6).alias(f"p{q}") for (low, high, share), q in zip(low_high, (25, 50, 75, 95))]
        return F.struct(F.lit(name).alias("property"), F.lit(n).cast("long").alias("n"), *quantiles)

    return spark.range(1).select(F.inline(F.array(row("size", size), row("price", price))))


def conflict_self_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of one material and paper under different flags that differ more than fivefold."""
    li = table(spark, sf_dir, "lineitem").where("l_extendedprice > 0").select("l_partkey", "l_suppkey", "l_returnflag", "l_extendedprice")
    a, b = li.toDF("l_partkey", "l_suppkey", "flag_a", "a"), li.toDF("l_partkey", "l_suppkey", "flag_b", "b")
    ratio = F.greatest("a", "b") / F.least("a", "b")
    return a.join(b, ["l_partkey", "l_suppkey"]).where("flag_a < flag_b").withColumn("ratio", ratio).where("ratio > 5").select("l_partkey", "l_suppkey", "flag_a", "flag_b", F.round("ratio", 6).alias("ratio"))


def same_paper_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").where("l_extendedprice > 0")
    rows = li.select("l_partkey", "l_suppkey", (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("row"), F.log10("l_extendedprice").alias("v"))
    return near_pairs(rows, ["l_partkey", "l_suppkey"], "v", "row", 0.1).select("l_partkey", "l_suppkey", "row_a", "row_b", F.round(F.abs(F.col("a") - F.col("b")), 6).alias("distance"))


def material_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per material: papers, families of flags, log spread, consensus and quality points, verdict."""
    li = table(spark, sf_dir, "lineitem").where("l_extendedprice > 0")
    g = li.groupBy("l_partkey").agg(F.countDistinct("l_suppkey").alias("papers"), F.count(F.lit(1)).alias("n"), F.array_join(F.sort_array(F.collect_set("l_returnflag")), ",").alias("flags"), F.round(F.stddev_pop(F.log10("l_extendedprice")), 6).alias("spread"), F.round(F.avg((F.col("l_discount") > 0).cast("int")), 6).alias("evidence"))
    points = F.least(F.col("papers") * 10, F.lit(60)) + F.when(F.col("spread") < 0.2, 40).when(F.col("spread") < 0.4, 25).otherwise(10)
    return g.select("l_partkey", "papers", "n", "flags", "spread", "evidence", points.alias("consensus"), F.when((points >= 85) & (F.col("evidence") > 0.9), "strong").when(points >= 60, "fair").otherwise("weak").alias("verdict"))


def events_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each purchase-like event with the last other event of its user; totals by pair of types."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"), "value")
    left = e.where("event_id % 2 = 0").select("user_id", "event_id", "ts")
    right = e.where("event_id % 2 = 1").groupBy("user_id", "ts").agg(F.max("event_id").alias("last_id"))
    j = as_of(left, right, "user_id", "ts", ["last_id"])
    return j.select("event_id", "user_id", "last_id")


def band_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Range join of prices against fixed bands: one pass with a case, since the bands are few and known."""
    p = table(spark, sf_dir, "part")
    band = F.when(F.col("p_retailprice") < 1000, "low").when(F.col("p_retailprice") < 1500, "middle").otherwise("high")
    return p.groupBy(band.alias("band"), "p_brand").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("p_retailprice"), 6).alias("mean"))


QUERIES = {f.__name__: f for f in (cross_source_agreement, agreement_rank, agreement_percentiles, conflict_self_join, same_paper_near_duplicates, material_cards, events_as_of, band_counts)}
_J = "with p as (select p_partkey k, concat_ws('/', p_brand, p_type) formula, p_size s, p_retailprice v from part), j as (select a.formula, a.k a_key, b.k b_key, greatest(0, 1 - abs(a.s - b.s) / 20) s1, greatest(0, 1 - abs(a.v - b.v) / greatest(abs(a.v), abs(b.v), 1e-12) / 0.5) s2 from p a join p b using (formula) where a.k % 2 = 1 and b.k % 2 = 0)"
_AG = f"{_J}, g as (select formula, key, count(*) partners, round(avg((s1 + s2) / 2), 4) score from (select formula, a_key as key, s1, s2 from j union all select formula, b_key, s1, s2 from j) group by 1, 2)"
SQL = {
    "cross_source_agreement": f"{_AG} select * from g",
    "agreement_rank": f"{_AG} select *, row_number() over (partition by formula order by score desc, key)::int as rank from g",
    "agreement_percentiles": f"{_J}, x as (select 'size' property, s1 s from j union all select 'price', s2 from j) select property, count(*) n, round(quantile_cont(s, 0.25), 6) p25, round(quantile_cont(s, 0.5), 6) p50, round(quantile_cont(s, 0.75), 6) p75, round(quantile_cont(s, 0.95), 6) p95 from x group by 1",
    "conflict_self_join": "select a.l_partkey, a.l_suppkey, a.l_returnflag flag_a, b.l_returnflag flag_b, round(greatest(a.l_extendedprice, b.l_extendedprice) / least(a.l_extendedprice, b.l_extendedprice), 6) ratio from lineitem a join lineitem b on a.l_partkey = b.l_partkey and a.l_suppkey = b.l_suppkey and a.l_returnflag < b.l_returnflag where a.l_extendedprice > 0 and b.l_extendedprice > 0 and greatest(a.l_extendedprice, b.l_extendedprice) / least(a.l_extendedprice, b.l_extendedprice) > 5",
    "same_paper_near_duplicates": "with r as (select l_partkey, l_suppkey, l_orderkey * 8 + l_linenumber r, log10(l_extendedprice) v from lineitem where l_extendedprice > 0) select a.l_partkey, a.l_suppkey, a.r row_a, b.r row_b, round(abs(a.v - b.v), 6) distance from r a join r b on a.l_partkey = b.l_partkey and a.l_suppkey = b.l_suppkey and a.r < b.r where abs(a.v - b.v) < 0.1",
    "material_cards": "with g as (select l_partkey, count(distinct l_suppkey) papers, count(*) n, string_agg(distinct l_returnflag, ',' order by l_returnflag) flags, round(stddev_pop(log10(l_extendedprice)), 6) spread, round(avg((l_discount > 0)::int), 6) evidence from lineitem where l_extendedprice > 0 group by 1), c as (select *, least(papers * 10, 60) + case when spread < 0.2 then 40 when spread < 0.4 then 25 else 10 end consensus from g) select *, case when consensus >= 85 and evidence > 0.9 then 'strong' when consensus >= 60 then 'fair' else 'weak' end verdict from c",
    "events_as_of": "with l as (select user_id, event_id, ts from events where event_id % 2 = 0), r as (select user_id, ts, max(event_id) last_id from events where event_id % 2 = 1 group by 1, 2) select l.event_id, l.user_id, r.last_id from l asof left join r on l.user_id = r.user_id and l.ts >= r.ts",
    "band_counts": "select case when p_retailprice < 1000 then 'low' when p_retailprice < 1500 then 'middle' else 'high' end band, p_brand, count(*) n, round(avg(p_retailprice), 6) mean from part group by 1, 2",
}
