"""Relational builders: one row per key, first values, unpivots, ids, counts, joins, upserts, unions, reports.

First-wins folds are order-dependent in a table's rows; here an ordinal of the business key decides, so that
results don't hang on partitioning. Windows are partitioned by keys of a few rows each (an id, an order).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.functions.columns import condition_fingerprint, populated, stable_id
from tessera.session import table


def best_row(df: DataFrame, key: str, *order) -> DataFrame:
    """The first row of each key in the order given."""
    return df.withColumn("_n", F.row_number().over(W.partitionBy(key).orderBy(*order))).where("_n = 1").drop("_n")


def count_onto(left: DataFrame, counts: DataFrame, key: str, *names: str) -> DataFrame:
    """Left join of grouped counts, nothing as 0."""
    return left.join(counts, key, "left").fillna(0, subset=list(names))


def upsert_missing(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Existing values stay, nulls are filled from new, unknown keys are appended."""
    rest = [c for c in old.columns if c not in keys]
    n = new.select(*keys, *[F.col(c).alias(f"_{c}") for c in rest])
    return old.join(n, keys, "full").select(*keys, *[F.coalesce(c, f"_{c}").alias(c) for c in rest])


def union_fill(*tables: DataFrame) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def missing_report(df: DataFrame) -> DataFrame:
    """column, missing, pct (one decimal) of columns with nulls; one pass."""
    row = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("missing")) for c in df.columns]))
    out = row.select("_n", pairs.alias("p")).where("p.missing > 0")
    return out.select("p.column", "p.missing", F.round(100.0 * F.col("p.missing") / F.col("_n"), 1).alias("pct"))


def materials_best_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: open lines first, then the most populated, then the first; and the sorted set of its sources."""
    li = table(spark, sf_dir, "lineitem")
    filled = sum((F.col(c) > 0).cast("int") for c in ("l_discount", "l_tax"))
    best = best_row(li.select("l_orderkey", "l_linenumber", "l_partkey", "l_linestatus", filled.alias("filled")), "l_orderkey", F.desc("l_linestatus"), F.desc("filled"), "l_linenumber", "l_partkey")
    sources = li.groupBy("l_orderkey").agg(F.array_join(F.sort_array(F.collect_set("l_returnflag")), ",").alias("sources"))
    return best.join(sources, "l_orderkey").select("l_orderkey", "l_linenumber", "l_partkey", "l_linestatus", "filled", "sources")


def papers_first_non_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per customer the first value, in row order, that says something."""
    o = table(spark, sf_dir, "orders")
    urgent = F.when(F.col("o_orderpriority").startswith("1"), F.col("o_orderpriority"))
    return o.groupBy("o_custkey").agg(F.min_by("o_orderstatus", "o_orderkey").alias("first_status"), F.min_by("o_orderkey", F.when(urgent.isNotNull(), F.col("o_orderkey"))).alias("first_urgent"), F.count(F.lit(1)).alias("n"))


def measurement_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per populated property of a record."""
    li = table(spark, sf_dir, "lineitem")
    pairs = F.expr("stack(3, 'discount', l_discount, 'tax', l_tax, 'quantity', l_quantity) as (property, value)")
    return li.select("l_orderkey", "l_linenumber", pairs).where("value <> 0")


def first_occurrence_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber")
    w = W.partitionBy("l_partkey", "l_suppkey").orderBy("l_orderkey", "l_linenumber")
    return li.withColumn("n", F.row_number().over(w)).where("n = 1").drop("n")


def canonical_and_alternates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nothing is dropped: the first of a group is canonical, the rest are alternates."""
    w = W.partitionBy("l_partkey", "l_suppkey").orderBy("l_orderkey", "l_linenumber")
    li = table(spark, sf_dir, "lineitem").withColumn("n", F.row_number().over(w))
    return li.select("l_orderkey", "l_linenumber", F.when(F.col("n") == 1, "canonical").otherwise("alternate").alias("role"))


def duplicate_measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of a key that occurs more than once inside a paper: the key's count, joined back."""
    key = ["l_suppkey", "l_partkey", "l_returnflag"]
    li = table(spark, sf_dir, "lineitem").select(*key, "l_orderkey", "l_linenumber")
    g = li.groupBy(*[F.col(c).alias(f"_{c}") for c in key]).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    one, two, three = (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key)
    return li.join(g, one & two & three).select(*key, "l_orderkey", "l_linenumber", "n")


def duplicate_experiment_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of a repeated key is marked: the key's count, joined back."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.concat_ws("|", "l_partkey", "l_suppkey").alias("key"))
    n = li.groupBy("key").agg((F.count(F.lit(1)) > 1).alias("duplicated"))
    return li.join(n, "key").select("l_orderkey", "l_linenumber", "duplicated")


def doi_multiplicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").where("l_suppkey is not null")
    return li.groupBy("l_suppkey").agg(F.countDistinct("l_partkey").alias("materials")).where("materials > 1")


def relational_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Materials with their numbers of experiments, papers and measurements."""
    li, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    # two narrow aggregates: two distinct counts in one would send every row three times
    orders = li.groupBy("l_partkey", "l_orderkey").agg(F.count(F.lit(1)).alias("n")).groupBy("l_partkey").agg(F.count("l_orderkey").alias("n_experiments"), F.sum("n").alias("n_measurements"))
    papers = li.select("l_partkey", "l_suppkey").distinct().groupBy("l_partkey").agg(F.count("l_suppkey").alias("n_papers"))
    out = count_onto(count_onto(part, orders, "l_partkey", "n_experiments", "n_measurements"), papers, "l_partkey", "n_papers")
    return out.select("l_partkey", "p_name", "n_experiments", "n_papers", "n_measurements")


def stable_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", stable_id("meas", F.col("l_orderkey"), F.col("l_linenumber"), F.lit(None), F.col("l_returnflag")).alias("measurement_id"))


def condition_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderstatus") != "O", F.col("o_orderstatus"))
    return o.select("o_orderkey", condition_fingerprint(status=status, priority=F.col("o_orderpriority"), customer=F.col("o_custkey")).alias("fingerprint"))


def field_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base by tier; blended with the stated confidence 0.6 to 0.4 and clamped; weights .5 .15 .15 .2."""
    li = table(spark, sf_dir, "lineitem")
    base = F.when(F.col("l_returnflag") == "A", 1.0).when(F.col("l_returnflag") == "N", 0.75).otherwise(0.5)
    value = F.least(F.lit(1.0), F.greatest(F.lit(0.0), 0.6 * base + 0.4 * (1 - F.col("l_tax") * 5)))
    temp, method, evidence = F.when(F.col("l_quantity") > 0, base).otherwise(0.0), F.when(F.col("l_linestatus") == "F", base).otherwise(0.0), F.when(F.col("l_discount") > 0, base).otherwise(0.0)
    return li.select("l_orderkey", "l_linenumber", F.round(value, 9).alias("confidence_value"), F.round(0.5 * value + 0.15 * temp + 0.15 * method + 0.2 * evidence, 6).alias("confidence"))


def verified_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged customers without an order: what is verified wins."""
    c, o = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    return c.join(o, c["c_custkey"] == o["o_custkey"], "left_anti").select("c_custkey", "c_name")


def upsert_fill_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    old = c.where("c_custkey % 3 <> 0").select("c_custkey", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("balance"), "c_mktsegment")
    new = c.where("c_custkey % 2 = 0").select("c_custkey", (-F.col("c_acctbal")).alias("balance"), F.lit("new").alias("c_mktsegment"))
    return upsert_missing(old, new, ["c_custkey"])


def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    b = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return union_fill(a, b)


def attribution_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled rows against structures by key: how many, how many distinct, ambiguous or not."""
    part = table(spark, sf_dir, "part").where("p_size <= 25").select("p_type", "p_brand")
    g = table(spark, sf_dir, "part").groupBy("p_type").agg(F.count(F.lit(1)).alias("structures"), F.countDistinct("p_brand").alias("polymorphs"))
    j = part.join(g, "p_type", "left")
    return j.groupBy("p_type", "p_brand").agg(F.count(F.lit(1)).alias("rows"), F.max("structures").alias("structures"), (F.max("polymorphs") > 1).alias("ambiguous"))


def missing_value_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return missing_report(li.select("l_orderkey", *[F.when(F.col(c) != 0, F.col(c)).alias(c) for c in ("l_discount", "l_tax")], F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("l_returnflag")))


def provenance_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    share = lambda c: F.round(100.0 * F.count_if(c) / F.count(F.lit(1)), 4)
    return li.agg(share(populated(F.col("l_returnflag"))).alias("method"), share(F.col("l_discount") > 0).alias("page"), share(F.col("l_tax") > 0).alias("sentence"), share(F.col("l_shipdate").isNotNull()).alias("date"))


def prefix_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exclusive running sums of sizes, per order."""
    w = W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity").rowsBetween(W.unboundedPreceding, -1)
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", F.coalesce(F.sum("l_quantity").over(w), F.lit(0.0)).alias("offset"))


def json_props_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    props = F.from_json("props", "map<string,string>")
    keys = e.select("event_type", F.explode(F.map_keys(props)).alias("key"))
    return keys.groupBy("event_type", "key").agg(F.count(F.lit(1)).alias("n"))


def relational_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Foreign keys without their row, and repeated primary keys."""
    li, o, c = (table(spark, sf_dir, t) for t in ("lineitem", "orders", "customer"))
    n = lambda df, name: df.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check"), "violations")
    return n(li.join(o, li["l_orderkey"] == o["o_orderkey"], "left_anti"), "lineitem.order").unionByName(n(o.join(c, o["o_custkey"] == c["c_custkey"], "left_anti"), "orders.customer")).unionByName(n(o.groupBy("o_orderkey").count().where("count > 1"), "orders.pk"))


QUERIES = {f.__name__: f for f in (materials_best_row, papers_first_non_null, measurement_unpivot, first_occurrence_dedup, canonical_and_alternates, duplicate_measurements, duplicate_experiment_flag, doi_multiplicity, relational_counts, stable_ids, condition_fingerprints, field_confidence, verified_anti_join, upsert_fill_missing, union_by_name, attribution_join, missing_value_report, provenance_coverage, prefix_offsets, json_props_extract, relational_integrity)}
_F = "case when l_returnflag = 'A' then 1.0 when l_returnflag = 'N' then 0.75 else 0.5 end"
SQL = {
    "materials_best_row": "with b as (select *, cast(l_discount > 0 as int) + cast(l_tax > 0 as int) filled from lineitem), r as (select *, row_number() over (partition by l_orderkey order by l_linestatus desc, filled desc, l_linenumber, l_partkey) n from b), s as (select l_orderkey, string_agg(distinct l_returnflag, ',' order by l_returnflag) sources from lineitem group by 1) select l_orderkey, l_linenumber, l_partkey, l_linestatus, filled, sources from r join s using (l_orderkey) where n = 1",
    "papers_first_non_null": "select o_custkey, arg_min(o_orderstatus, o_orderkey) first_status, min(o_orderkey) filter (o_orderpriority like '1%') first_urgent, count(*) n from orders group by 1",
    "measurement_unpivot": "select * from (select l_orderkey, l_linenumber, 'discount' property, l_discount as value from lineitem union all select l_orderkey, l_linenumber, 'tax', l_tax from lineitem union all select l_orderkey, l_linenumber, 'quantity', l_quantity from lineitem) where value <> 0",
    "first_occurrence_dedup": "select l_partkey, l_suppkey, l_orderkey, l_linenumber from (select *, row_number() over (partition by l_partkey, l_suppkey order by l_orderkey, l_linenumber) n from lineitem) where n = 1",
    "canonical_and_alternates": "select l_orderkey, l_linenumber, case when row_number() over (partition by l_partkey, l_suppkey order by l_orderkey, l_linenumber) = 1 then 'canonical' else 'alternate' end as role from lineitem",
    "duplicate_measurements": "select * from (select l_suppkey, l_partkey, l_returnflag, l_orderkey, l_linenumber, count(*) over (partition by l_suppkey, l_partkey, l_returnflag) n from lineitem) where n > 1",
    "duplicate_experiment_flag": "select l_orderkey, l_linenumber, count(*) over (partition by l_partkey, l_suppkey) > 1 duplicated from lineitem",
    "doi_multiplicity": "select l_suppkey, count(distinct l_partkey) materials from lineitem where l_suppkey is not null group by 1 having count(distinct l_partkey) > 1",
    "relational_counts": "select p_partkey l_partkey, p_name, coalesce(e, 0) n_experiments, coalesce(p, 0) n_papers, coalesce(m, 0) n_measurements from part left join (select l_partkey, count(distinct l_orderkey) e, count(distinct l_suppkey) p, count(*) m from lineitem group by 1) on l_partkey = p_partkey",
    "stable_ids": "select l_orderkey, l_linenumber, 'meas-' || substr(sha256(l_orderkey || '|' || l_linenumber || '||' || l_returnflag), 1, 16) measurement_id from lineitem",
    "condition_fingerprints": "select o_orderkey, concat_ws('|', case when o_orderstatus <> 'O' then 'status=' || o_orderstatus end, 'priority=' || o_orderpriority, 'customer=' || o_custkey) fingerprint from orders",
    "field_confidence": f"with v as (select *, {_F}::double b, least(1.0, greatest(0.0, 0.6 * {_F}::double + 0.4 * (1 - l_tax * 5)))::double v from lineitem) select l_orderkey, l_linenumber, round(v, 9) confidence_value, round(0.5::double * v + 0.15::double * case when l_quantity > 0 then b else 0 end + 0.15::double * case when l_linestatus = 'F' then b else 0 end + 0.2::double * case when l_discount > 0 then b else 0 end, 6) confidence from v",
    "verified_anti_join": "select c_custkey, c_name from customer where c_custkey not in (select o_custkey from orders where o_custkey is not null)",
    "upsert_fill_missing": "with o as (select c_custkey, case when c_acctbal > 0 then c_acctbal end balance, c_mktsegment from customer where c_custkey % 3 <> 0), n as (select c_custkey, -c_acctbal balance, 'new' c_mktsegment from customer where c_custkey % 2 = 0) select coalesce(o.c_custkey, n.c_custkey) c_custkey, coalesce(o.balance, n.balance) balance, coalesce(o.c_mktsegment, n.c_mktsegment) c_mktsegment from o full join n on o.c_custkey = n.c_custkey",
    "union_by_name": "select c_custkey id, c_name as name, c_mktsegment segment, null::double balance from customer union all select s_suppkey, s_name, null, s_acctbal from supplier",
    "attribution_join": "with g as (select p_type, count(*) structures, count(distinct p_brand) polymorphs from part group by 1) select p_type, p_brand, count(*) as rows, max(structures) structures, max(polymorphs) > 1 ambiguous from part left join g using (p_type) where p_size <= 25 group by 1, 2",
    "missing_value_report": "with t as (select count(*) n, count(*) filter (l_discount = 0) d, count(*) filter (l_tax = 0) t, count(*) filter (l_returnflag = 'N') f from lineitem) select * from (select 'l_discount' as column, d missing, round(100.0::double * d / n, 1) pct from t union all select 'l_tax', t, round(100.0::double * t / n, 1) from t union all select 'l_returnflag', f, round(100.0::double * f / n, 1) from t) where missing > 0",
    "provenance_coverage": "select round(100.0::double * count(*) filter (lower(trim(l_returnflag)) not in ('', 'nan', 'none', 'null', 'unknown')) / count(*), 4) as method, round(100.0::double * count(*) filter (l_discount > 0) / count(*), 4) page, round(100.0::double * count(*) filter (l_tax > 0) / count(*), 4) sentence, round(100.0::double * count(l_shipdate) / count(*), 4) date from lineitem",
    "prefix_offsets": "select l_orderkey, l_linenumber, coalesce(sum(l_quantity) over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity rows between unbounded preceding and 1 preceding), 0)::double as offset from lineitem",
    "json_props_extract": "select event_type, k as key, count(*) n from (select event_type, unnest(json_keys(props)) k from events) group by 1, 2",
    "relational_integrity": "select 'lineitem.order' as check, count(*) violations from lineitem where l_orderkey not in (select o_orderkey from orders) union all select 'orders.customer', count(*) from orders where o_custkey not in (select c_custkey from customer) union all select 'orders.pk', count(*) from (select 1 from orders group by o_orderkey having count(*) > 1)",
}
