"""Relational builders: experiments, measurements, synthesis, dopants, authors, papers, evidence records, schema report.

Roles over the driver's tables: a lineitem row is a record of the material l_partkey in the paper l_suppkey; orders carry
its synthesis, suppliers are papers and hold their authors' names, parts the materials.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.columns import condition_fingerprint, populated, stable_id
from tessera.operators.extraction import colon_dopant, doped_element
from tessera.operators.roles import METALS, SQL_PARTS, parts, pick, sql_pick
from tessera.session import table


def celsius(low: Column, *names: str) -> Column:
    """The first of a range's fields that is set; one named in kelvin is converted."""
    return F.coalesce(*[low[n] - 273.15 if n.endswith("_K") else low[n] for n in names])


def min_celsius(span: Column) -> Column:
    return celsius(span, "min_C", "min", "low", "min_K")


def max_celsius(span: Column) -> Column:
    return celsius(span, "max_C", "max", "high", "max_K")


def one_celsius(number: Column, span: Column) -> Column:
    """A number as it is, else the middle of a range, in kelvin if an end of it is named so."""
    low, high = F.coalesce(span["min_K"], span["min_C"], span["min"]), F.coalesce(span["max_K"], span["max_C"], span["max"])
    kelvin = span["min_K"].isNotNull() | span["max_K"].isNotNull()
    return F.coalesce(number, (low + high) / 2 - F.when(kelvin, 273.15).otherwise(0.0))


def paper_id(doi: Column, *fallback: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(doi), F.lit("")), stable_id("paper", *fallback))


def first_rows(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """One row for each key, the first by order and then by the other columns; partial aggregation collapses repeats where they lie."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    return df.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("r")).select(*keys, *[F.col(f"r.{c}").alias(c) for c in (*order, *rest)])


def merged_fields(first: Column, second: Column, names: list[str]) -> list[Column]:
    """Fields of two structs gap by gap."""
    return [F.coalesce(first[n], second[n]).alias(n) for n in names]


def rebuilt_text(index: Column) -> Column:
    """The text of an inverted index, a map of words to their positions."""
    placed = F.flatten(F.transform(F.map_entries(index), lambda e: F.transform(e["value"], lambda p: F.struct(p.alias("at"), e["key"].alias("word")))))
    return F.array_join(F.transform(F.array_sort(placed), lambda x: x["word"]), " ")


def inverted_index(words: Column) -> Column:
    """Words to their positions, from 0."""
    places = lambda w: F.filter(F.transform(words, lambda x, i: F.when(x == w, i)), lambda i: i.isNotNull())
    own = F.array_distinct(words)
    return F.map_from_arrays(own, F.transform(own, places))


def voigt_matrix(components: Column) -> Column:
    """A 6 x 6 array of a map with the keys C11 to C66; missing ones are null."""
    return F.array(*[F.array(*[F.try_element_at(components, F.lit(f"C{i}{j}")) for j in range(1, 7)]) for i in range(1, 7)])


def flat_ids(by_database: Column) -> Column:
    return F.flatten(F.map_values(by_database))


def dopants_of(name: Column) -> Column:
    return F.array_distinct(F.array_compact(F.array(colon_dopant(name), doped_element(name))))


def schema_report_of(name: str, df: DataFrame, keys: dict[str, str]) -> DataFrame:
    """table, column, rows, nulls, refers_to: a row per column, from one aggregate."""
    counted = df.agg(F.count(F.lit(1)).alias("rows"), F.array(*[F.struct(F.lit(c).alias("column"), F.count_if(F.col(f"`{c}`").isNull()).alias("nulls"), F.lit(keys.get(c, "")).alias("refers_to")) for c in df.columns]).alias("c"))
    return counted.select(F.lit(name).alias("table"), "rows", F.inline("c"))


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with their temperature range, named in four ways, and their experiment."""
    li, kind = table(spark, sf_dir, "lineitem"), F.col("l_orderkey") % 4
    q = F.col("l_quantity")
    span = F.struct(
        F.when(kind == 0, q).alias("min_C"), F.when(kind == 0, q + 5).alias("max_C"), F.when(kind == 1, q + 273.15).alias("min_K"), F.when(kind == 1, q + 283.15).alias("max_K"),
        F.when(kind == 2, q).alias("min"), F.when(kind == 2, q).alias("max"), F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"),
    )
    conditions = condition_fingerprint(flag=F.col("l_returnflag"), status=F.col("l_linestatus"))
    experiment = stable_id("exp", F.col("l_partkey"), F.col("l_suppkey"), conditions)
    return li.withColumn("span", span).withColumn("experiment_id", experiment)


def experiments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each material, paper and conditions: the first record's temperatures."""
    rows = _records(spark, sf_dir).select("experiment_id", "l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", F.round(min_celsius(F.col("span")), 6).alias("t_min"), F.round(max_celsius(F.col("span")), 6).alias("t_max"))
    return first_rows(rows, ["experiment_id", "l_partkey", "l_suppkey"], "l_orderkey", "l_linenumber")


def experiment_measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct values of each experiment and property; other values are never collapsed."""
    pairs = F.expr("stack(2, 'conductivity', l_extendedprice, 'activation_energy', l_discount) as (property, value)")
    rows = _records(spark, sf_dir).select("experiment_id", pairs).where("value is not null").distinct()
    return rows.groupBy("experiment_id").agg(F.count_if(F.col("property") == "conductivity").alias("conductivities"), F.count_if(F.col("property") == "activation_energy").alias("energies"))


def consensus_temperatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.when(F.col("l_linenumber") == 1, F.col("l_tax") * 100)
    return _records(spark, sf_dir).groupBy("l_linenumber").agg(F.round(F.avg(one_celsius(number, F.col("span"))), 6).alias("celsius"), F.count(one_celsius(number, F.col("span"))).alias("n"))


def synthesis_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Synthesis of a record, its gaps filled from the experiment; one row for each material, paper and fingerprint with any field."""
    o = table(spark, sf_dir, "orders")
    synthesis = F.struct(F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderpriority")).alias("route"), F.when(F.col("o_orderkey") % 5 == 0, F.lit("unknown")).alias("atmosphere"))
    experiment = F.struct(F.when(F.col("o_orderkey") % 7 == 0, F.col("o_orderstatus")).alias("route"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderstatus")).alias("atmosphere"))
    rows = o.select("o_custkey", *merged_fields(synthesis, experiment, ["route", "atmosphere"])).where(populated(F.col("route")) | populated(F.col("atmosphere")))
    fp = condition_fingerprint(route=F.col("route"), atmosphere=F.col("atmosphere"))
    return rows.select(stable_id("syn", F.col("o_custkey"), fp).alias("synthesis_id"), "o_custkey", "route", "atmosphere").groupBy("synthesis_id", "o_custkey").agg(F.min("route").alias("route"), F.min("atmosphere").alias("atmosphere"))


def dopant_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotated dopants of material ids and of an inventory: a row for each pair."""
    p = parts(spark, sf_dir)
    own = p.select(F.concat("formula", F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit(":"), pick(METALS, F.col("p_partkey")))).otherwise("")).alias("material"))
    inventory = spark.createDataFrame([("Li7La3Zr2O12:Ta",), ("Li6PS5Cl",), ("Li6.25Al0.25La3Zr2O12 Al-doped",)], "material string")
    pairs = own.unionByName(inventory).select("material", F.explode(dopants_of(F.col("material"))).alias("dopant")).distinct()
    return pairs.select(stable_id("dop", F.col("material"), F.col("dopant")).alias("dopant_id"), "material", "dopant")


def author_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Authors by position; a name that stands twice in a paper at one position is one."""
    s = table(spark, sf_dir, "supplier")
    names = F.split(F.concat(F.col("s_name"), F.lit("; N."), F.col("s_nationkey").cast("string"), F.lit("; "), F.col("s_name")), "; ")
    rows = s.select(F.concat(F.lit("10.1/"), F.col("s_suppkey").cast("string")).alias("doi"), F.posexplode(names).alias("pos", "author"))
    rows = rows.withColumn("author_position", F.col("pos") + 1)
    return rows.select(stable_id("author", F.col("doi"), F.col("author"), F.col("author_position")).alias("author_id"), F.col("doi").alias("paper_id"), "author", "author_position").distinct()


def papers_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Empty fields of papers from a cache, then from first pages; the sources that gave something are named."""
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), F.when(F.col("s_suppkey") % 4 == 0, F.col("s_name")).alias("title"), F.lit(None).cast("int").alias("year"))
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("c_title"), (F.col("n_regionkey") + 2000).alias("c_year"))
    pdf = table(spark, sf_dir, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("p_title"), (F.col("c_nationkey") + 1990).alias("p_year"))
    j = s.join(n, "k", "left").join(pdf, "k", "left")
    cached = (F.col("title").isNull() & F.col("c_title").isNotNull()) | (F.col("year").isNull() & F.col("c_year").isNotNull())
    sources = F.array_compact(F.array(F.when(cached, "cache"), F.when(F.col("p_title").isNotNull(), "pdf_first_page")))
    return j.select("k", paper_id(F.when(F.col("k") % 3 != 0, F.concat(F.lit(" 10.1/"), F.col("k").cast("string"))), F.col("k")).alias("paper_id"), F.coalesce("title", "c_title", "p_title").alias("title"), F.coalesce("year", "c_year", "p_year").alias("year"), F.array_join(F.array_sort(sources), ",").alias("metadata_source"))


def schema_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = {"lineitem": {"l_orderkey": "orders", "l_partkey": "part", "l_suppkey": "supplier"}, "orders": {"o_custkey": "customer"}, "customer": {"c_nationkey": "nation"}, "supplier": {"s_nationkey": "nation"}}
    out = None
    for name in ("customer", "lineitem", "orders", "supplier"):
        report = schema_report_of(name, table(spark, sf_dir, name), keys[name])
        out = report if out is None else out.unionByName(report)
    return out


def evidence_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence of a paper's high and flagged extractions; invalid ones under 0.3 are left out."""
    li = table(spark, sf_dir, "lineitem")
    entry = lambda name, value, confidence: F.struct(F.lit(name).alias("property"), value.alias("value"), confidence.alias("confidence"), (F.col("l_returnflag") != "R").alias("valid"))
    high = F.filter(F.array(entry("conductivity", F.col("l_extendedprice").cast("long"), F.col("l_discount") * 10)), lambda x: x["confidence"] >= 0.6)
    flagged = F.filter(F.array(entry("conductivity", F.col("l_extendedprice").cast("long"), F.col("l_discount") * 10), entry("activation_energy", F.col("l_quantity").cast("long"), F.col("l_tax") * 10)), lambda x: x["confidence"] < 0.6)
    rows = li.select("l_partkey", "l_suppkey", F.explode(F.concat(high, flagged)).alias("e")).where("e.valid or e.confidence >= 0.3")
    key = F.concat_ws("|", F.col("l_suppkey").cast("string"), F.col("l_partkey").cast("string"), "e.property", F.col("e.value").cast("string"))
    return rows.select(F.substring(F.sha2(key, 256), 1, 16).alias("evidence_id"), "e.property", "e.confidence")


def dataset_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence counts of every paper as a JSON document."""
    li = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("l_discount") >= 0.06).alias("high"))
    doc = F.to_json(F.struct(F.struct(F.col("l_suppkey").alias("paper_id")).alias("paper"), F.col("n").alias("n_evidence"), F.col("high").alias("n_high_confidence"), (F.col("n") - F.col("high")).alias("n_flagged")))
    return li.select("l_suppkey", doc.alias("document"))


def rebuilt_abstracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts from their inverted indexes."""
    c = table(spark, sf_dir, "conversations").where("text is not null")
    words = F.split("text", " ")
    return c.select("conv_id", "turn", F.sha2(rebuilt_text(inverted_index(words)), 256).alias("sha256"))


def elastic_tensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """6 x 6 matrices of the parts' components, and the mean of their upper left block's diagonal and sides (Voigt's bulk modulus)."""
    names = [f"C{i}{j}" for i in range(1, 7) for j in range(i, 7)]
    p = table(spark, sf_dir, "part").select("p_partkey", F.create_map(*[x for k, n in enumerate(names, 1) for x in (F.lit(n), (F.col("p_partkey") * k % 97).cast("double"))]).alias("c"))
    m = p.select("p_partkey", voigt_matrix(F.col("c")).alias("m"))
    side = lambda i, j: F.col("m")[i][j]
    bulk = (side(0, 0) + side(1, 1) + side(2, 2) + 2 * (side(0, 1) + side(0, 2) + side(1, 2))) / 9
    return m.select("p_partkey", F.round(bulk, 6).alias("bulk"), side(5, 0).isNull().alias("lower_missing"), F.size("m").alias("rows"))


def database_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = F.create_map(F.lit("mp"), F.array(F.concat(F.lit("mp-"), F.col("p_partkey").cast("string"))), F.lit("icsd"), F.when(F.col("p_size") > 25, F.array(F.col("p_size").cast("string"), F.col("p_brand"))).otherwise(F.array()))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(flat_ids(ids), ",").alias("ids"))


QUERIES = {f.__name__: f for f in (experiments, experiment_measurements, consensus_temperatures, synthesis_rows, dopant_rows, author_rows, papers_enriched, schema_report, evidence_records, dataset_records, rebuilt_abstracts, elastic_tensors, database_ids)}
_ID = lambda kind, *cols: f"'{kind}-' || substr(sha256(concat_ws('|', {', '.join(f'coalesce({c}::varchar, {chr(39) * 2})' for c in cols)})), 1, 16)"
_R = f"""r as (select *, {_ID('exp', 'l_partkey', 'l_suppkey', "'flag=' || l_returnflag || '|status=' || l_linestatus")} as experiment_id, l_orderkey % 4 as kind from lineitem)"""
_REPORT = {"customer": ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"), "lineitem": ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"), "orders": ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"), "supplier": ("s_suppkey", "s_name", "s_nationkey", "s_acctbal")}
_REFERS = {"l_orderkey": "orders", "l_partkey": "part", "l_suppkey": "supplier", "o_custkey": "customer", "c_nationkey": "nation", "s_nationkey": "nation"}
SQL = {
    "experiments": f"with {_R}, s as (select *, row_number() over (partition by experiment_id order by l_orderkey, l_linenumber, t_min, t_max) as n from (select *, round(case kind when 0 then l_quantity when 1 then l_quantity + 273.15 - 273.15 when 2 then l_quantity end, 6) as t_min, round(case kind when 0 then l_quantity + 5 when 1 then l_quantity + 283.15 - 273.15 when 2 then l_quantity end, 6) as t_max from r)) select experiment_id, l_partkey, l_suppkey, l_orderkey, l_linenumber, t_min, t_max from s where n = 1",
    "experiment_measurements": f"with {_R} select experiment_id, count(distinct l_extendedprice) as conductivities, count(distinct l_discount) as energies from r group by 1",
    "consensus_temperatures": f"with {_R}, t as (select l_linenumber, case when l_linenumber = 1 then l_tax * 100 when kind = 0 then l_quantity + 2.5 when kind = 1 then l_quantity + 5 when kind = 2 then l_quantity end as c from r) select l_linenumber, round(avg(c), 6) as celsius, count(c) as n from t group by 1",
    "synthesis_rows": f"""
    with m as (select o_custkey, case when o_orderkey % 3 = 0 then o_orderpriority when o_orderkey % 7 = 0 then o_orderstatus end as route, case when o_orderkey % 5 = 0 then 'unknown' when o_orderkey % 2 = 0 then o_orderstatus end as atmosphere from orders),
    p as (select *, nullif(atmosphere, 'unknown') as known from m where route is not null or nullif(atmosphere, 'unknown') is not null)
    select {_ID('syn', 'o_custkey', "concat_ws('|', 'route=' || route, 'atmosphere=' || known)")} as synthesis_id, o_custkey, min(route) as route, min(atmosphere) as atmosphere from p group by 1, 2""",
    "dopant_rows": f"""
    with m as (select distinct formula || ':' || {sql_pick(METALS, 'p_partkey')} as material, {sql_pick(METALS, 'p_partkey')} as dopant from {SQL_PARTS} where p_partkey % 3 = 0 union select 'Li7La3Zr2O12:Ta', 'Ta' union select 'Li6.25Al0.25La3Zr2O12 Al-doped', 'Al')
    select {_ID('dop', 'material', 'dopant')} as dopant_id, material, dopant from m""",
    "author_rows": f"""
    with a as (select '10.1/' || s_suppkey as paper_id, unnest([s_name, 'N.' || s_nationkey, s_name]) as author, unnest([1, 2, 3]) as author_position from supplier)
    select {_ID('author', 'paper_id', 'author', 'author_position')} as author_id, paper_id, author, author_position from a""",
    "papers_enriched": f"""
    with j as (select s_suppkey as k, case when s_suppkey % 4 = 0 then s_name end as title, n_name, n_regionkey, c_name, c_nationkey from supplier left join nation on n_nationkey = s_suppkey left join (select * from customer where c_custkey % 2 = 0) on c_custkey = s_suppkey)
    select k, case when k % 3 <> 0 then '10.1/' || k else {_ID('paper', 'k')} end as paper_id, coalesce(title, n_name, c_name) as title, coalesce(n_regionkey + 2000, c_nationkey + 1990)::int as year,
      concat_ws(',', case when n_name is not null then 'cache' end, case when c_name is not null then 'pdf_first_page' end) as metadata_source from j""",
    "schema_report": " union all ".join(f"select '{t}' as \"table\", count(*) as rows, '{c}' as \"column\", count(*) - count({c}) as nulls, '{_REFERS.get(c, '')}' as refers_to from {t}" for t, cs in _REPORT.items() for c in cs),
    "evidence_records": """
    with e as (select l_partkey, l_suppkey, l_returnflag, 'conductivity' as property, trunc(l_extendedprice)::bigint as value, l_discount * 10 as confidence from lineitem
      union all select l_partkey, l_suppkey, l_returnflag, 'activation_energy', trunc(l_quantity)::bigint, l_tax * 10 from lineitem where l_tax * 10 < 0.6)
    select substr(sha256(l_suppkey || '|' || l_partkey || '|' || property || '|' || value), 1, 16) as evidence_id, property, confidence from e where l_returnflag <> 'R' or confidence >= 0.3""",
    "dataset_records": """select l_suppkey, printf('{"paper":{"paper_id":%d},"n_evidence":%d,"n_high_confidence":%d,"n_flagged":%d}', l_suppkey, count(*), count(*) filter (l_discount >= 0.06), count(*) filter (not l_discount >= 0.06)) as document from lineitem group by 1""",
    "rebuilt_abstracts": "select conv_id, turn, sha256(text) as sha256 from conversations where text is not null",
    "elastic_tensors": "select p_partkey, round(((p_partkey % 97) + (p_partkey * 7 % 97) + (p_partkey * 12 % 97) + 2 * ((p_partkey * 2 % 97) + (p_partkey * 3 % 97) + (p_partkey * 8 % 97))) / 9.0::double, 6) as bulk, true as lower_missing, 6 as rows from part",
    "database_ids": "select p_partkey, 'mp-' || p_partkey || case when p_size > 25 then ',' || p_size || ',' || p_brand else '' end as ids from part",
}
