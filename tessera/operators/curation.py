"""Curation joins and reports: evidence attached, records filed, literature and seeds compared, sources merged, audits.

Roles over the driver's tables: orders are queue items, lineitem rows the records of an item, parts the
literature values, documents the evidence texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.session import table


def attach_longest(items: DataFrame, evidence: DataFrame, keys: list[str], snippet: str) -> DataFrame:
    """The longest snippet of each key; equals by text."""
    best = evidence.groupBy(*keys).agg(F.max(F.struct(F.length(snippet).alias("n"), F.col(snippet).alias("s"))).alias("b"))
    return items.join(best.select(*keys, F.col("b.s").alias(snippet)), keys, "left")


def within(a: Column, b: Column, share: float, floor: float) -> Column:
    """|a - b| within a share of b, or within a floor."""
    return F.abs(a - b) <= F.greatest(share * F.abs(b), F.lit(floor))


def literature_status(value: Column, exact: Column, prefix: Column) -> Column:
    """Null value: pending; the exact reference decides within 50 %; else the prefix reference may agree within 100 %."""
    return F.when(value.isNull(), "pending").when(exact.isNotNull(), F.when(within(value, exact, 0.5, 5e-5), "agree").otherwise("conflict")).when(prefix.isNotNull() & within(value, prefix, 1.0, 5e-5), "agree").otherwise("no_ref")


def evidence_attach(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").where("o_orderstatus = 'O'").select("o_orderkey", (F.col("o_custkey") % 50).alias("k"))
    c = table(spark, sf_dir, "conversations").select((F.col("conv_id") % 50).alias("k"), F.col("text").alias("snippet"))
    return attach_longest(o, c, ["k"], "snippet").select("o_orderkey", "snippet")


def filed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose seven-field key isn't in the queue yet; two properties a row are filed apart."""
    li = table(spark, sf_dir, "lineitem")
    pairs = F.expr("stack(2, 'sigma', l_extendedprice, 'ea', l_discount) as (property, value)")
    rows = li.select("l_suppkey", "l_partkey", "l_returnflag", "l_linestatus", pairs)
    key = F.md5(F.concat_ws("|", "l_suppkey", "l_partkey", "l_returnflag", "l_linestatus", "property"))
    new = rows.where("l_linestatus = 'O'").withColumn("l_linestatus", F.lit("F")).select(key.alias("key"), "property").distinct()
    old = rows.where("l_linestatus = 'F'").select(key.alias("key")).distinct()
    return new.join(old, "key", "left_anti").groupBy("property").agg(F.count(F.lit(1)).alias("filed"))


def literature_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values against references of the same key, else of the family."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.when(F.col("l_linenumber") != 6, F.col("l_extendedprice") / F.col("l_quantity")).alias("v"))
    p = table(spark, sf_dir, "part")
    exact = p.where("p_size <= 15").select(F.col("p_partkey").alias("l_partkey"), F.col("p_retailprice").alias("exact"))
    family = p.groupBy("p_brand").agg(F.round(F.avg("p_retailprice"), 2).alias("prefix"))
    prefix = p.join(family, "p_brand").where("p_size > 30").select(F.col("p_partkey").alias("l_partkey"), "prefix")
    j = li.join(exact, "l_partkey", "left").join(prefix, "l_partkey", "left")
    return j.groupBy(literature_status(F.col("v"), F.col("exact"), F.col("prefix")).alias("status")).agg(F.count(F.lit(1)).alias("n"))


def seed_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By paper: hits are values within a factor of two of the paper's first."""
    li = table(spark, sf_dir, "lineitem").where("l_extendedprice > 0")
    seed = li.groupBy("l_suppkey").agg(F.min(F.struct("l_orderkey", "l_linenumber", "l_extendedprice")).alias("s")).select("l_suppkey", F.col("s.l_extendedprice").alias("seed"))
    ratio = F.col("l_extendedprice") / F.col("seed")
    j = li.join(seed, "l_suppkey")
    return j.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("matched"), F.count_if(ratio.between(0.5, 2.0)).alias("hits"), F.round(F.avg(ratio.between(0.5, 2.0).cast("int")), 6).alias("accuracy"))


def cleaning_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units, plausibility, duplicates in a chain: rows after each step."""
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice", "l_discount")
    kept = li.where("l_extendedprice > 2000")
    plausible = kept.where("l_discount > 0.01")
    single = plausible.select("l_partkey", "l_suppkey").distinct()
    n = lambda df, step: df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(step).alias("step"), "rows")
    return n(li, "input").unionByName(n(kept, "units")).unionByName(n(plausible, "plausible")).unionByName(n(single, "deduplicated"))


def sentinel_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentinels 0 and -1, labels without value, short texts."""
    li = table(spark, sf_dir, "lineitem")
    a = li.agg(F.count_if(F.col("l_discount") == 0).alias("zero_discount"), F.count_if(F.col("l_tax") == 0).alias("zero_tax"), F.count_if((F.col("l_returnflag") == "R") & (F.col("l_discount") == 0)).alias("label_without_value"), F.count_if(F.col("l_quantity") == -1).alias("minus_one"))
    return a.selectExpr("stack(4, 'zero_discount', zero_discount, 'zero_tax', zero_tax, 'label_without_value', label_without_value, 'minus_one', minus_one) as (finding, n)")


def type_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spellings of an enumeration to its values; what is labelled but empty is unknown."""
    t = F.lower(F.regexp_replace("p_type", "^.*[. ]", ""))
    value = F.when(t.isin("tin", "steel", "nickel", "brass", "copper"), t).otherwise("unknown")
    return table(spark, sf_dir, "part").groupBy(value.alias("type")).agg(F.count(F.lit(1)).alias("n"))


def discovery_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upsert by key: known entries gain a source tag, new ones are appended."""
    o = table(spark, sf_dir, "orders")
    old = o.where("o_orderkey % 2 = 0").groupBy("o_custkey").agg(F.array_sort(F.collect_set("o_orderstatus")).alias("a"))
    new = o.where("o_orderkey % 2 = 1").groupBy("o_custkey").agg(F.array_sort(F.collect_set(F.lower("o_orderstatus"))).alias("b"))
    none = F.array().cast("array<string>")
    both = F.array_sort(F.array_union(F.coalesce("a", none), F.coalesce("b", none)))
    return old.join(new, "o_custkey", "full").select("o_custkey", F.array_join(both, ",").alias("sources"), F.col("a").isNull().alias("appended"))


def incremental_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users of the later half of the events that the first half didn't stamp."""
    e = table(spark, sf_dir, "events")
    seen, fresh = e.where("event_id % 10 < 2").select("user_id").distinct(), e.where("event_id % 10 >= 2").select("user_id").distinct()
    return fresh.join(seen, "user_id", "left_anti")


def provenance_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record's best source by points for equal value, material and prefix; the first among equals. Candidates are all other records of the part.

    Points hang on part, supplier and quantity alone: groups of these are paired, not records. The first two sources
    of a group say what its best is to others and, without the record itself, to its own.
    """
    a = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    key = ["l_partkey", "l_suppkey", "l_quantity"]
    first = a.withColumn("n", F.row_number().over(W.partitionBy(*key).orderBy("l_orderkey"))).where("n <= 2")
    g = first.groupBy(*key).agg(F.min("l_orderkey").alias("s1"), F.max(F.when(F.col("n") == 2, F.col("l_orderkey"))).alias("s2"))
    h = g.select("l_partkey", F.col("l_suppkey").alias("s"), F.col("l_quantity").alias("q"), F.col("s1").alias("source"))
    points = lambda s, q: F.when(F.abs(F.col("l_quantity") - q) <= 5, 3.0).otherwise(0.0) + F.when(F.col("l_suppkey") == s, 1.5).otherwise(0.0) + F.when(F.col("l_suppkey") % 10 == s % 10, 2.0).otherwise(0.0)
    same = F.col("l_suppkey").eqNullSafe(F.col("s")) & F.col("l_quantity").eqNullSafe(F.col("q"))
    pairs = g.join(h, "l_partkey").select(*key, "s1", "s2", "source", F.when(~same, points(F.col("s"), F.col("q"))).alias("p"))
    # a least source for every sum of points, since numbers are hashed where structs would be sorted
    sums = (6.5, 5.0, 3.5, 3.0, 2.0, 0.0)
    best = pairs.groupBy(*key, "s1", "s2").agg(*[F.min(F.when(F.col("p") == p, F.col("source"))).alias(f"m{k}") for k, p in enumerate(sums)])
    choice = lambda p, source: F.when(source.isNotNull(), F.struct(p.alias("p"), (-source).alias("m")))
    other = F.coalesce(*[choice(F.lit(p), F.col(f"m{k}")) for k, p in enumerate(sums)])
    best = best.select(*[F.col(c).alias(f"_{c}") for c in key], "s1", "s2", other.alias("other"))
    j = a.join(best, (F.col("l_partkey") == F.col("_l_partkey")) & F.col("l_suppkey").eqNullSafe(F.col("_l_suppkey")) & F.col("l_quantity").eqNullSafe(F.col("_l_quantity")))
    own = choice(points(F.col("l_suppkey"), F.col("l_quantity")), F.when(F.col("s1") == F.col("l_orderkey"), F.col("s2")).otherwise(F.col("s1")))
    x = j.select("l_orderkey", "l_linenumber", "l_partkey", F.greatest("other", own).alias("x")).where("x is not null")
    return x.select("l_orderkey", "l_linenumber", "l_partkey", (-F.col("x.m")).alias("source"), F.col("x.p").alias("points"))


def split_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A gold list overrides the stored split."""
    p = table(spark, sf_dir, "part")
    stored = F.when(F.col("p_size") < 5, "val").when(F.col("p_size") < 15, "test").otherwise("train")
    gold = p.where("p_retailprice > 1950").select("p_partkey", F.lit("gold").alias("g"))
    return p.join(gold, "p_partkey", "left").groupBy(F.coalesce("g", stored).alias("split")).agg(F.count(F.lit(1)).alias("n"))


QUERIES = {f.__name__: f for f in (evidence_attach, filed_records, literature_check, seed_comparison, cleaning_report, sentinel_audit, type_normalize, discovery_merge, incremental_feed, provenance_best, split_backfill)}
SQL = {
    "evidence_attach": "with b as (select conv_id % 50 k, text snippet from conversations), r as (select *, row_number() over (partition by k order by length(snippet) desc, snippet desc) n from b) select o_orderkey, snippet from orders left join (select * from r where n = 1) r on o_custkey % 50 = k where o_orderstatus = 'O'",
    "filed_records": "with r as (select l_suppkey, l_partkey, l_returnflag, l_linestatus, p.property from lineitem, (values ('sigma'), ('ea')) p(property)), n as (select distinct l_suppkey, l_partkey, l_returnflag, property from r where l_linestatus = 'O'), o as (select distinct l_suppkey, l_partkey, l_returnflag, property from r where l_linestatus = 'F') select property, count(*) filed from (select * from n except select * from o) group by 1",
    "literature_check": "with f as (select p_brand, round(avg(p_retailprice), 2) a from part group by 1), l as (select l_partkey, case when l_linenumber <> 6 then l_extendedprice / l_quantity end v from lineitem), j as (select v, case when p_size <= 15 then p_retailprice end e, case when p_size > 30 then a end x from l left join part on p_partkey = l_partkey left join f using (p_brand)) select case when v is null then 'pending' when e is not null then case when abs(v - e) <= greatest(0.5 * abs(e), 5e-5) then 'agree' else 'conflict' end when x is not null and abs(v - x) <= greatest(abs(x), 5e-5) then 'agree' else 'no_ref' end status, count(*) n from j group by 1",
    "seed_comparison": "with s as (select l_suppkey, arg_min(l_extendedprice, (l_orderkey, l_linenumber, l_extendedprice)) seed from lineitem where l_extendedprice > 0 group by 1) select l_suppkey, count(*) matched, count(*) filter (l_extendedprice / seed between 0.5 and 2) hits, round(avg((l_extendedprice / seed between 0.5 and 2)::int), 6) accuracy from lineitem join s using (l_suppkey) where l_extendedprice > 0 group by 1",
    "cleaning_report": "select 'input' step, count(*) as rows from lineitem union all select 'units', count(*) from lineitem where l_extendedprice > 2000 union all select 'plausible', count(*) from lineitem where l_extendedprice > 2000 and l_discount > 0.01 union all select 'deduplicated', count(*) from (select distinct l_partkey, l_suppkey from lineitem where l_extendedprice > 2000 and l_discount > 0.01)",
    "sentinel_audit": "select 'zero_discount' finding, count(*) filter (l_discount = 0) n from lineitem union all select 'zero_tax', count(*) filter (l_tax = 0) from lineitem union all select 'label_without_value', count(*) filter (l_returnflag = 'R' and l_discount = 0) from lineitem union all select 'minus_one', count(*) filter (l_quantity = -1) from lineitem",
    "type_normalize": "with t as (select lower(regexp_replace(p_type, '^.*[. ]', '')) t from part) select case when t in ('tin', 'steel', 'nickel', 'brass', 'copper') then t else 'unknown' end as type, count(*) n from t group by 1",
    "discovery_merge": "with a as (select o_custkey, list(distinct o_orderstatus) a from orders where o_orderkey % 2 = 0 group by 1), b as (select o_custkey, list(distinct lower(o_orderstatus)) b from orders where o_orderkey % 2 = 1 group by 1) select o_custkey, array_to_string(list_sort(list_distinct(list_concat(coalesce(a, []), coalesce(b, [])))), ',') sources, a is null appended from a full join b using (o_custkey)",
    "incremental_feed": "select distinct user_id from events where event_id % 10 >= 2 and user_id not in (select user_id from events where event_id % 10 < 2 and user_id is not null)",
    "provenance_best": "with li as (select *, row_number() over () r from lineitem), j as (select a.r, a.l_orderkey, a.l_linenumber, a.l_partkey, b.l_orderkey source, case when abs(a.l_quantity - b.l_quantity) <= 5 then 3 else 0 end + case when a.l_suppkey = b.l_suppkey then 1.5 else 0 end + case when a.l_suppkey % 10 = b.l_suppkey % 10 then 2 else 0 end p from li a join li b using (l_partkey) where a.r <> b.r) select l_orderkey, l_linenumber, l_partkey, source, p::double points from (select *, row_number() over (partition by r order by p desc, source) n from j) where n = 1",
    "split_backfill": "select case when p_retailprice > 1950 then 'gold' when p_size < 5 then 'val' when p_size < 15 then 'test' else 'train' end split, count(*) n from part group by 1",
}
