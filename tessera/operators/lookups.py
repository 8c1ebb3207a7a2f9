"""Joins in front of consensus and validation: record unions, verified look-ups, fallbacks, stamps, confirmations.

Roles over the driver's tables: lineitem rows of status F are approved queue items, those that weren't returned are
catalogue rows; parts are materials, their formulas compositions, suppliers papers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import formula as fm
from tessera.operators.roles import SQL_PARTS, SQL_REDUCED, formula_of, parts, sql_formula
from tessera.session import table


def first_of(sources: list[DataFrame], keys: list[str]) -> DataFrame:
    """The union of the sources; of rows with equal keys the one of the first source stays, with the number of its source. Keys collapse where the rows lie."""
    out = None
    for k, df in enumerate(sources):
        part = df.withColumn("source", F.lit(k))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out.groupBy(*keys).agg(F.min("source").alias("source"), F.count(F.lit(1)).alias("copies"))


def two_tier(items: DataFrame, verified: DataFrame, exact: list[str], value: str, comp: str) -> DataFrame:
    """items with hit, the verified row of the same exact keys, else the first of the same composition and value to six digits.

    verified has the keys, the value, `ordinal` and `row`; equal exact keys: the last wins; equal values: the first.
    """
    digits = lambda c: F.format_string("%.6g", c.cast("double"))
    by_key = verified.groupBy(*exact).agg(F.max_by("row", "ordinal").alias("_exact"))
    by_value = verified.where(F.col(value).isNotNull()).groupBy(F.col(comp).alias("_comp"), digits(F.col(value)).alias("_digits")).agg(F.min_by("row", "ordinal").alias("_near"))
    j = items.join(by_key, exact, "left").join(by_value, (F.col(comp) == F.col("_comp")) & (digits(F.col(value)) == F.col("_digits")), "left")
    return j.withColumn("hit", F.coalesce("_exact", "_near")).drop("_exact", "_near", "_comp", "_digits")


def by_reduced_formula(rows: DataFrame, formula: str) -> DataFrame:
    """rows with reduced; distinct formulas alone go through the parser."""
    known = rows.select(F.col(formula).alias("_f")).distinct().withColumn("reduced", fm.reduced_formula("_f"))
    return rows.join(known, F.col(formula) == F.col("_f")).drop("_f")


def close(a: Column, b: Column, share: float, floor: float) -> Column:
    return F.abs(a - b) <= F.greatest(share * F.abs(b), F.lit(floor))


def near_runs(points: DataFrame, keys: list[str], x: str, y: str, run: str, dx: float, dy: float) -> DataFrame:
    """Distinct points that a point of another run confirms within dx and dy: points meet in cells of dx by dy, each also sent to the cells around its own."""
    cell = points.withColumn("_cx", F.floor(F.col(x) / dx)).withColumn("_cy", F.floor(F.col(y) / dy))
    around = lambda c: F.explode(F.array(F.col(c) - 1, F.col(c), F.col(c) + 1))
    sent = cell.select(*keys, F.col(x).alias("_x"), F.col(y).alias("_y"), F.col(run).alias("_run"), F.col("_cx"), F.col("_cy")).distinct()
    sent = sent.withColumn("_cx", around("_cx")).withColumn("_cy", around("_cy"))
    near = (F.abs(F.col(x) - F.col("_x")) <= dx) & (F.abs(F.col(y) - F.col("_y")) <= dy) & (F.col(run) != F.col("_run"))
    own = cell.select(*keys, x, y, run, "_cx", "_cy").distinct()
    right = sent.select(*[F.col(k).alias(f"_{k}") for k in keys], "_x", "_y", "_run", F.col("_cx").alias("_a"), F.col("_cy").alias("_b"))
    on = [F.col(k) == F.col(f"_{k}") for k in keys] + [F.col("_cx") == F.col("_a"), F.col("_cy") == F.col("_b"), near]
    return own.join(right, on, "left_semi").select(*keys, x, y, run)


def _queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").where("l_linestatus = 'F'")
    return li.select(F.col("l_partkey").alias("composition"), F.col("l_suppkey").alias("doi"), F.lit("conductivity").alias("property"), F.col("l_quantity").alias("value"))


def record_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queue items, then catalogue rows of two properties: one record for each composition, paper, property and value, of the first source."""
    li = table(spark, sf_dir, "lineitem").where("l_returnflag <> 'R'")
    pairs = F.expr("stack(2, 'conductivity', l_quantity, 'activation_energy', l_discount) as (property, value)")
    catalogue = li.select(F.col("l_partkey").alias("composition"), F.col("l_suppkey").alias("doi"), pairs).where("value is not null")
    return first_of([_queue(spark, sf_dir), catalogue], ["composition", "doi", "property", "value"])


def benchmark_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conductivity and activation energy of the inventory as records; only the first has a temperature."""
    p = parts(spark, sf_dir).where("p_size <= 10")
    rows = F.expr("stack(2, 'conductivity', p_retailprice, 25, 'activation_energy', if(p_size > 5, p_size / 10.0D, null), null) as (property, value, temperature)")
    return p.select("p_partkey", "formula", rows).where("value is not null").select("p_partkey", "formula", "property", "value", "temperature")


def consensus_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every material with its consensus: size of the group and papers, or defaults."""
    c = table(spark, sf_dir, "lineitem").where("l_returnflag = 'A'").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"), F.max("l_suppkey").alias("paper"), (F.max("l_quantity") > 45).alias("outlier"))
    j = table(spark, sf_dir, "part").select("p_partkey").join(c, F.col("p_partkey") == F.col("l_partkey"), "left")
    return j.select("p_partkey", F.coalesce("n", F.lit(0)).alias("n_papers"), F.coalesce(F.col("paper").cast("string"), F.lit("")).alias("grade"), F.coalesce("outlier", F.lit(False)).alias("is_outlier"))


def verified_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queue items with their verified row: by composition and paper, else by composition and value."""
    li = table(spark, sf_dir, "lineitem")
    names = [F.col("l_partkey").alias("comp"), F.col("l_suppkey").alias("doi"), F.col("l_quantity").alias("value")]
    verified = li.where("l_returnflag = 'A'").select(*names, F.struct("l_orderkey", "l_linenumber").alias("ordinal"), F.col("l_orderkey").alias("row"))
    items = li.where("l_returnflag = 'N'").select("l_orderkey", "l_linenumber", *names)
    return two_tier(items, verified, ["comp", "doi"], "value", "comp").select("l_orderkey", "l_linenumber", "comp", "hit")


def material_sigma(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every part the first consensus group of the same reduced formula that has values, and the sum of its values."""
    groups = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.count_if(F.col("l_discount") > 0.05).alias("n_sigma"), F.sum(F.round(F.col("l_extendedprice") * 100).cast("long")).alias("sigma"))  # summed in whole cents, so that the sum has no order
    keyed = by_reduced_formula(groups.withColumn("formula", formula_of(F.col("l_partkey"))), "formula").where("n_sigma > 0")
    first = keyed.groupBy("reduced").agg(F.min(F.struct("l_partkey", "sigma")).alias("m"))
    own = by_reduced_formula(parts(spark, sf_dir).select("p_partkey", "formula"), "formula")
    return own.join(first, "reduced", "left").select("p_partkey", F.col("m.l_partkey").alias("source"), F.col("m.sigma").alias("sigma"))


def unmatched_compositions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compositions of records that no material of the index has the elements of, with their records counted."""
    key = lambda f: F.array_join(F.array_sort(fm.elements(f)), "")
    p = parts(spark, sf_dir).withColumn("k", key(F.col("formula")))
    index = p.where("p_size > 25").select("k").distinct()
    return p.where("p_size <= 25").join(index, "k", "left_anti").groupBy("formula").agg(F.count(F.lit(1)).alias("n"), F.min("p_partkey").alias("first"))


def compound_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wanted compounds: by name without case, else by reduced formula; rows with a family are preferred, then the first."""
    wanted = spark.createDataFrame([("LI2P2O2",), ("Li2La4O24",), ("Na2Zr2S",), ("K2Ge2F4",), ("none",)], "wanted string")  # five rows
    p = by_reduced_formula(parts(spark, sf_dir).select("p_partkey", "formula", F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).alias("family")), "formula")
    w = by_reduced_formula(wanted, "wanted").withColumnRenamed("reduced", "_reduced")
    named = p.join(F.broadcast(w), F.lower("formula") == F.lower("wanted")).withColumn("tier", F.lit(0))
    reduced = p.join(F.broadcast(w), F.col("reduced") == F.col("_reduced")).withColumn("tier", F.lit(1))
    best = named.unionByName(reduced).groupBy("wanted").agg(F.min(F.struct("tier", F.col("family").isNull().alias("none"), "p_partkey")).alias("b"))
    return w.join(best, "wanted", "left").select("wanted", F.col("b.p_partkey").alias("p_partkey"), F.col("b.tier").alias("tier"))


def signal_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims beside the values located in their paper: FOUND if one is within 35 %, PARTIAL if there are others, else null."""
    li = table(spark, sf_dir, "lineitem")
    located = li.where("l_returnflag = 'A'").select(F.col("l_partkey").alias("k"), F.col("l_quantity").alias("v"))
    spans = located.groupBy("k").agg(F.array_sort(F.collect_set("v")).alias("values"))  # distinct quantities, fifty at most
    claims = li.where("l_returnflag = 'N'").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").alias("claim"))
    j = claims.join(spans, F.col("l_partkey") == F.col("k"), "left")
    found = F.exists("values", lambda v: close(v, F.col("claim"), 0.35, 5e-5))
    return j.groupBy(F.when(F.col("values").isNull(), "none").when(found, "FOUND").otherwise("PARTIAL").alias("verdict")).agg(F.count(F.lit(1)).alias("n"))


def run_confirmation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of a material's curve that another run of the reading confirms."""
    points = table(spark, sf_dir, "lineitem").select("l_partkey", F.col("l_quantity").alias("x"), F.round(F.log10("l_extendedprice"), 6).alias("y"), F.col("l_linenumber").alias("run")).where("y is not null")
    return near_runs(points, ["l_partkey"], "x", "y", "run", 5.0, 0.1).groupBy("l_partkey").agg(F.count(F.lit(1)).alias("confirmed"))


def validation_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Materials with their validation: absent is a count of 0 and no score."""
    v = table(spark, sf_dir, "lineitem").where("l_discount > 0.09").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("l_tax"), 6).alias("score"))
    j = table(spark, sf_dir, "part").join(v, F.col("p_partkey") == F.col("l_partkey"), "left")
    return j.select("p_partkey", F.coalesce("n", F.lit(0)).alias("n"), "score")


def add_columns(left: DataFrame, right: DataFrame, key: str, *order: str) -> DataFrame:
    """left with the columns that right alone has, from its first row of each key by order and then by the others."""
    new = [c for c in right.columns if c not in left.columns]
    first = right.groupBy(key).agg(F.min(F.struct(*order, *[c for c in new if c not in order])).alias("_r"))
    return left.join(first, key, "left").select(*left.columns, *[F.col(f"_r.{c}").alias(c) for c in new])


def descriptor_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    right = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("p_partkey"), F.lit(0).alias("p_size"), "l_orderkey", "l_quantity", "l_tax")
    return add_columns(left, right, "p_partkey", "l_orderkey")


QUERIES = {f.__name__: f for f in (record_union, benchmark_records, consensus_context, verified_lookup, material_sigma, unmatched_compositions, compound_lookup, signal_stamp, run_confirmation, validation_block, descriptor_join)}
_F = f"(select distinct {sql_formula('p_partkey')} as formula from part)"
SQL = {
    "record_union": "with u as (select l_partkey as composition, l_suppkey as doi, 'conductivity' as property, l_quantity as value, 0 as source from lineitem where l_linestatus = 'F' union all select l_partkey, l_suppkey, 'conductivity', l_quantity, 1 from lineitem where l_returnflag <> 'R' union all select l_partkey, l_suppkey, 'activation_energy', l_discount, 1 from lineitem where l_returnflag <> 'R') select composition, doi, property, value, min(source) as source, count(*) as copies from u group by 1, 2, 3, 4",
    "benchmark_records": f"with p as (select * from {SQL_PARTS} where p_size <= 10) select p_partkey, formula, 'conductivity' as property, p_retailprice as value, 25 as temperature from p union all select p_partkey, formula, 'activation_energy', p_size / 10.0::double, null from p where p_size > 5",
    "consensus_context": "with c as (select l_partkey, count(*) as n, max(l_suppkey) as paper, max(l_quantity) > 45 as outlier from lineitem where l_returnflag = 'A' group by 1) select p_partkey, coalesce(n, 0) as n_papers, coalesce(paper::varchar, '') as grade, coalesce(outlier, false) as is_outlier from part left join c on l_partkey = p_partkey",
    "verified_lookup": """
    with v as (select * from lineitem where l_returnflag = 'A'),
    e as (select l_partkey, l_suppkey, arg_max(l_orderkey, (l_orderkey, l_linenumber)) as r from v group by 1, 2),
    q as (select l_partkey, printf('%.6g', l_quantity) as d, arg_min(l_orderkey, (l_orderkey, l_linenumber)) as r from v group by 1, 2)
    select l_orderkey, l_linenumber, i.l_partkey as comp, coalesce(e.r, q.r) as hit from lineitem i left join e using (l_partkey, l_suppkey) left join q on q.l_partkey = i.l_partkey and q.d = printf('%.6g', i.l_quantity) where i.l_returnflag = 'N'""",
    "material_sigma": f"""
    with r as ({SQL_REDUCED.format(source=_F)}), k as (select p_partkey, reduced from {SQL_PARTS} join r using (formula)),
    g as (select l_partkey, count(*) filter (l_discount > 0.05) as n, sum(round(l_extendedprice * 100)::bigint)::bigint as sigma from lineitem group by 1),
    -- records name parts that may not stand in the table of parts
    gk as (select l_partkey, sigma, reduced from (select *, {sql_formula('l_partkey')} as formula from g where n > 0) join ({SQL_REDUCED.format(source=f"(select distinct {sql_formula('l_partkey')} as formula from lineitem)")}) using (formula)),
    m as (select reduced, min(l_partkey) as source, arg_min(sigma, l_partkey) as sigma from gk group by 1)
    select p_partkey, source, sigma from k left join m using (reduced)""",
    "unmatched_compositions": f"with p as (select *, array_to_string(list_sort(list_distinct(regexp_extract_all(formula, '[A-Z][a-z]?'))), '') as k from {SQL_PARTS}) select formula, count(*) as n, min(p_partkey) as first from p where p_size <= 25 and k not in (select k from p where p_size > 25) group by 1",
    "signal_stamp": "with s as (select l_partkey, list(distinct l_quantity) as vs from lineitem where l_returnflag = 'A' group by 1) select case when vs is null then 'none' when len(list_filter(vs, lambda v: abs(v - l_quantity) <= greatest(0.35 * abs(l_quantity), 5e-5))) > 0 then 'FOUND' else 'PARTIAL' end as verdict, count(*) as n from lineitem left join s using (l_partkey) where l_returnflag = 'N' group by 1",
    "run_confirmation": "with p as (select distinct l_partkey, l_quantity as x, round(log10(l_extendedprice), 6) as y, l_linenumber as run from lineitem where l_extendedprice > 0) select l_partkey, count(*) as confirmed from p a where exists (select 1 from p b where b.l_partkey = a.l_partkey and b.run <> a.run and abs(a.x - b.x) <= 5 and abs(a.y - b.y) <= 0.1) group by 1",
    "validation_block": "with v as (select l_partkey, count(*) as n, round(avg(l_tax), 6) as score from lineitem where l_discount > 0.09 group by 1) select p_partkey, coalesce(n, 0) as n, score from part left join v on l_partkey = p_partkey",
    "descriptor_join": "with d as (select *, row_number() over (partition by l_partkey order by l_orderkey, l_quantity, l_tax) as n from lineitem) select p_partkey, p_size, l_orderkey, l_quantity, l_tax from part left join (select * from d where n = 1) d on l_partkey = p_partkey",
}
