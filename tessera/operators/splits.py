"""Leakage-free splits and evaluation metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.functions.columns import SQL_BUCKET, md5_bucket, split_of
from tessera.operators.ranks import running_totals
from tessera.session import table, written


def hash_split(key: Column) -> Column:
    return split_of(md5_bucket(F.coalesce(key.cast("string"), F.lit("unknown"))))


def connected(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) of undirected edges a-b: labels fall to the neighbours' least, then to their label's label.

    A label that can fall does, and labels are nodes, so the rounds end; paths halve with each.
    """
    both = written(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "edges")
    labels = written(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("component")), "components")
    while True:
        low = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("component").alias("m"))
        fallen = labels.join(low, F.col("node") == F.col("a")).select("node", F.col("component").alias("old"), F.least("component", "m").alias("low"))
        own = labels.select(F.col("node").alias("n"), F.col("component").alias("c"))
        moved = written(fallen.join(own, F.col("low") == F.col("n"), "left").select("node", F.least("low", F.coalesce("c", "low")).alias("component"), "old"), "components")
        labels = moved.select("node", "component")
        if not moved.where("component <> old").limit(1).count():
            return labels


def hash_bucket_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", md5_bucket(F.concat(F.lit("::"), F.col("o_custkey").cast("string"))).alias("bucket"), hash_split(F.concat(F.lit("::"), F.col("o_custkey").cast("string"))).alias("split"))


def family_holdout_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held-out families are the test split; the others go by the bucket of their key."""
    p = table(spark, sf_dir, "part")
    split = F.when(F.col("p_brand").isin("Brand#1", "Brand#11", "Brand#23"), "test").otherwise(hash_split(F.concat_ws("::", "p_brand", "p_type")))
    return p.select("p_partkey", "p_brand", split.alias("split"))


def split_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return family_holdout_split(spark, sf_dir).groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("p_brand").alias("families"))


def leakage_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups in more than one split; a split by row leaks, one by group doesn't."""
    p = table(spark, sf_dir, "part")
    rows = p.select("p_brand", hash_split(F.col("p_partkey")).alias("split"))
    return rows.groupBy("p_brand").agg(F.countDistinct("split").alias("splits")).where("splits > 1")


def component_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers that share an order stay together: bucket of the component's smallest key. Suppliers that all hang together are one component, in one split."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey").distinct()
    first = li.groupBy("l_orderkey").agg(F.min("l_suppkey").alias("a"))
    edges = li.join(first, "l_orderkey").select("a", F.col("l_suppkey").alias("b"))
    nodes = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("node"))
    out = nodes.join(connected(edges), "node", "left").withColumn("component", F.coalesce("component", "node"))
    return out.select("node", "component", hash_split(F.col("component")).alias("split"))


def gold_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five of each family in the order of a hash: a sampling operator."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", F.md5(F.col("p_partkey").cast("string")).alias("h"))
    w = W.partitionBy("p_brand").orderBy("h", "p_partkey")
    return p.withColumn("n", F.row_number().over(w)).where("n <= 5").select("p_partkey", "p_brand", "n")


def _predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", "p_brand", F.col("p_retailprice").alias("y"), (F.col("p_retailprice") + (F.col("p_partkey") * 7919 % 101) - 50).alias("p"), F.pmod("p_size", F.lit(5)).alias("label"), F.pmod(F.col("p_size") + F.when(F.col("p_partkey") % 6 == 0, 1).otherwise(0), F.lit(5)).alias("guess"))


def regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _predictions(spark, sf_dir)
    e = F.col("y") - F.col("p")
    g = r.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"), F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), (1 - F.sum(e * e) / (F.var_pop("y") * F.count(F.lit(1)))).alias("r2"))
    return g.select("p_brand", "n", *[F.round(c, 6).alias(c) for c in ("mae", "rmse", "r2")])


def macro_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per class from its own counts, averaged over the classes that occur."""
    r = _predictions(spark, sf_dir)
    t = r.groupBy(F.col("label").alias("c")).agg(F.count(F.lit(1)).alias("t"), F.count_if(F.col("label") == F.col("guess")).alias("tp"))
    g = r.groupBy(F.col("guess").alias("c")).agg(F.count(F.lit(1)).alias("g"))
    f = F.coalesce(F.try_divide(2.0 * F.col("tp"), F.coalesce("t", F.lit(0)) + F.coalesce("g", F.lit(0))), F.lit(0.0))
    acc = r.agg(F.avg((F.col("label") == F.col("guess")).cast("int")).alias("accuracy"))
    return t.join(g, "c", "full").select(f.alias("f")).agg(F.round(F.avg("f"), 6).alias("macro_f1"), F.count(F.lit(1)).alias("classes")).crossJoin(F.broadcast(acc)).select("macro_f1", "classes", F.round("accuracy", 6).alias("accuracy"))  # one row each


def _ranked(df: DataFrame, key: str, column: str) -> DataFrame:
    """Average ranks: equals share the mean of their places. Counts of distinct values are summed, not rows sorted."""
    g = df.groupBy(key, column).agg(F.count(F.lit(1)).alias("n"))
    w = W.partitionBy(key).orderBy(column)
    return g.withColumn("r", F.sum("n").over(w) - (F.col("n") - 1) / 2).select(key, column, "r")


def spearman(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _predictions(spark, sf_dir).withColumn("p", F.col("p").cast("double"))
    a, b = _ranked(r, "p_brand", "y").withColumnRenamed("r", "ry"), _ranked(r, "p_brand", "p").withColumnRenamed("r", "rp")
    return r.join(a, ["p_brand", "y"]).join(b, ["p_brand", "p"]).groupBy("p_brand").agg(F.round(F.corr("ry", "rp"), 6).alias("spearman"))


def ndcg_at_10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gain 2^g - 1 over the ten best by prediction against the ten best by truth."""
    r = _predictions(spark, sf_dir).withColumn("g", F.pow(F.lit(2.0), F.floor((F.col("y") - 900) / 250)) - 1)
    dcg = lambda order, name: r.withColumn("k", F.row_number().over(W.partitionBy("p_brand").orderBy(F.desc(order), "p_partkey"))).where("k <= 10").groupBy("p_brand").agg(F.sum(F.col("g") / F.log2(F.col("k") + 1)).alias(name))
    return dcg("p", "d").join(dcg("g", "i"), "p_brand").select("p_brand", F.round(F.coalesce(F.try_divide("d", "i"), F.lit(0.0)), 6).alias("ndcg"))


def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By rank sums over distinct scores."""
    r = _predictions(spark, sf_dir).select((F.col("label") >= 3).alias("pos"), F.floor(F.col("p") / 20).cast("double").alias("s"))
    g = r.groupBy("s").agg(F.count(F.lit(1)).alias("n"), F.count_if("pos").alias("np"))
    ranked = running_totals(g, "s", "n").withColumn("rank", F.col("until") - (F.col("n") - 1) / 2)
    a = ranked.agg(F.sum(F.col("rank") * F.col("np")).alias("rs"), F.sum("np").alias("p"), F.sum(F.col("n") - F.col("np")).alias("q"))
    return a.select(F.round((F.col("rs") - F.col("p") * (F.col("p") + 1) / 2) / (F.col("p") * F.col("q")), 6).alias("auc"))


def best_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The smallest error per family over simple models; the first name among equals."""
    r = _predictions(spark, sf_dir)
    means = r.groupBy("p_brand").agg(F.avg("y").alias("mean"), F.median("y").alias("med"))
    j = r.join(means, "p_brand")
    models = F.explode(F.array(F.struct(F.lit("dummy").alias("m"), F.abs(F.col("y") - F.col("mean")).alias("e")), F.struct(F.lit("median").alias("m"), F.abs(F.col("y") - F.col("med")).alias("e")), F.struct(F.lit("ridge").alias("m"), F.abs(F.col("y") - F.col("p")).alias("e"))))
    g = j.select("p_brand", models.alias("x")).groupBy("p_brand", F.col("x.m").alias("model")).agg(F.round(F.avg("x.e"), 6).alias("mae"))
    return g.groupBy("p_brand").agg(F.min(F.struct("mae", "model")).alias("b")).select("p_brand", "b.model", "b.mae")


def grouped_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five folds of whole families, largest families dealt first, in a snake: fold sizes differ little."""
    g = table(spark, sf_dir, "part").groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))
    k = F.row_number().over(W.partitionBy(F.lit(1)).orderBy(F.desc("n"), "p_brand")) - 1  # a row per family
    turn = F.floor(k / 5) % 2 == 0
    return g.select("p_brand", "n", F.when(turn, k % 5).otherwise(4 - k % 5).cast("int").alias("fold"))


QUERIES = {f.__name__: f for f in (hash_bucket_split, family_holdout_split, split_sizes, leakage_check, component_split, gold_sample, regression_metrics, macro_f1, spearman, ndcg_at_10, roc_auc, best_model, grouped_folds)}

_B = lambda k: SQL_BUCKET.format(k=k)
_S = lambda k: f"case when {_B(k)} < 100 then 'val' when {_B(k)} < 300 then 'test' else 'train' end"
_HOLD = f"select p_partkey, p_brand, case when p_brand in ('Brand#1', 'Brand#11', 'Brand#23') then 'test' else {_S('concat(p_brand, $$::$$, p_type)')} end split from part"
_P = "with r as (select p_partkey, p_brand, p_retailprice y, p_retailprice + (p_partkey * 7919 % 101) - 50 p, p_size % 5 as label, (p_size + case when p_partkey % 6 = 0 then 1 else 0 end) % 5 guess from part)"
SQL = {
    "hash_bucket_split": f"select o_orderkey, cast({_B('concat($$::$$, o_custkey)')} as int) bucket, {_S('concat($$::$$, o_custkey)')} split from orders",
    "family_holdout_split": _HOLD,
    "split_sizes": f"select split, count(*) n, count(distinct p_brand) families from ({_HOLD}) group by 1",
    "leakage_check": f"select p_brand, count(distinct {_S('p_partkey::varchar')}) splits from part group by 1 having count(distinct {_S('p_partkey::varchar')}) > 1",
    "component_split": f"with recursive e as (select distinct a.l_suppkey a, b.l_suppkey b from lineitem a join lineitem b using (l_orderkey)), r(node, c) as (select s_suppkey, s_suppkey from supplier union select e.b, r.c from r join e on e.a = r.node), m as (select node, min(c) component from r group by 1) select node, component, {_S('component::varchar')} split from m",
    "gold_sample": "select p_partkey, p_brand, n::int n from (select p_partkey, p_brand, row_number() over (partition by p_brand order by md5(p_partkey::varchar), p_partkey) n from part) where n <= 5",
    "regression_metrics": f"{_P} select p_brand, count(*) n, round(avg(abs(y - p)), 6) mae, round(sqrt(avg((y - p) * (y - p))), 6) rmse, round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) r2 from r group by 1",
    "macro_f1": f"{_P}, t as (select label c, count(*) t, count(*) filter (label = guess) tp from r group by 1), g as (select guess c, count(*) g from r group by 1), f as (select coalesce(2.0::double * tp / nullif(coalesce(t, 0) + coalesce(g, 0), 0), 0) f from t full join g using (c)) select round(avg(f), 6) macro_f1, count(*) classes, (select round(avg((label = guess)::int), 6) from r) accuracy from f",
    "spearman": f"{_P}, a as (select *, rank() over (partition by p_brand order by y) + (count(*) over (partition by p_brand, y) - 1) / 2 ry, rank() over (partition by p_brand order by p) + (count(*) over (partition by p_brand, p) - 1) / 2 rp from r) select p_brand, round(corr(ry, rp), 6) spearman from a group by 1",
    "ndcg_at_10": f"{_P}, x as (select *, pow(2, floor((y - 900) / 250)) - 1 g from r), a as (select *, row_number() over (partition by p_brand order by p desc, p_partkey) kp, row_number() over (partition by p_brand order by g desc, p_partkey) kg from x) select p_brand, round(coalesce(sum(g / log2(kp + 1)) filter (kp <= 10) / nullif(sum(g / log2(kg + 1)) filter (kg <= 10), 0), 0), 6) ndcg from a group by 1",
    "roc_auc": f"{_P}, s as (select label >= 3 pos, floor(p / 20) s from r), k as (select *, rank() over (order by s) + (count(*) over (partition by s) - 1) / 2 rk from s) select round((sum(rk) filter (pos) - count(*) filter (pos) * (count(*) filter (pos) + 1) / 2) / (count(*) filter (pos) * count(*) filter (not pos)), 6) auc from k",
    "best_model": f"{_P}, m as (select *, avg(y) over (partition by p_brand) mean, median(y) over (partition by p_brand) med from r), g as (select p_brand, 'dummy' model, round(avg(abs(y - mean)), 6) mae from m group by 1 union all select p_brand, 'median', round(avg(abs(y - med)), 6) from m group by 1 union all select p_brand, 'ridge', round(avg(abs(y - p)), 6) from m group by 1) select p_brand, model, mae from (select *, row_number() over (partition by p_brand order by mae, model) n from g) where n = 1",
    "grouped_folds": "with g as (select p_brand, count(*) n from part group by 1), k as (select *, row_number() over (order by n desc, p_brand) - 1 k from g) select p_brand, n, cast(case when (k // 5) % 2 = 0 then k % 5 else 4 - k % 5 end as int) fold from k",
}
