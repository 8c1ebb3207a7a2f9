"""Facts out of names and texts: dopants, roles, labels, symmetry, descriptors; value evidence in texts; tables of lines.

Names and formulas are made of the parts, texts are the driver's documents and pages.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.functions import formula as fm
from tessera.operators.roles import METALS, SQL_ELEMENTS, SQL_FORMULAS, SQL_PARTS, formulas, parts, pick, sql_pick
from tessera.session import table

#: Prefixes of ids of other databases, elements that are looked for as dopants, mobile ions in order.
SOURCE_PREFIXES = ("aflow-", "mp-", "jvasp-", "oqmd-", "cod-", "nomad-", "icsd-")
MOBILE = ("Li", "Na", "K", "Mg", "Ca", "Zn", "Al")
CRYSTAL_SYSTEMS = ((1, 2, "Triclinic"), (3, 15, "Monoclinic"), (16, 74, "Orthorhombic"), (75, 142, "Tetragonal"), (143, 167, "Trigonal"), (168, 194, "Hexagonal"), (195, 230, "Cubic"))
#: Atomic number, mass, electronegativity of the elements in FORMULAS; a dimension table of the descriptors.
ELEMENTS = {"H": (1, 1.008, 2.20), "Li": (3, 6.94, 0.98), "B": (5, 10.81, 2.04), "C": (6, 12.011, 2.55), "N": (7, 14.007, 3.04), "O": (8, 15.999, 3.44), "F": (9, 18.998, 3.98), "Na": (11, 22.990, 0.93), "Al": (13, 26.982, 1.61), "Si": (14, 28.085, 1.90), "P": (15, 30.974, 2.19), "S": (16, 32.06, 2.58), "Cl": (17, 35.45, 3.16), "K": (19, 39.098, 0.82), "Ti": (22, 47.867, 1.54), "Fe": (26, 55.845, 1.83), "Ge": (32, 72.630, 2.01), "Y": (39, 88.906, 1.22), "Zr": (40, 91.224, 1.33), "I": (53, 126.904, 2.66), "La": (57, 138.905, 1.10)}


def colon_dopant(name: Column) -> Column:
    """What follows the first colon outside brackets, if it isn't a number and the name isn't a database id."""
    bare = F.regexp_replace(name, r"\([^()]*\)", "")
    after = F.trim(F.regexp_extract(bare, r"^[^:]*:(.*)$", 1))
    foreign = F.lower(F.trim(name)).rlike("^(" + "|".join(SOURCE_PREFIXES) + ")")
    return F.when(~foreign & (after != "") & ~after.rlike(r"^[0-9.]+$"), after)


def doped_element(name: Column) -> Column:
    """X-doped, X doped."""
    return F.nullif(F.regexp_extract(name, r"\b([A-Z][a-z]?)[- ]doped", 1), F.lit(""))


def crystal_system(number: Column) -> Column:
    out = F.lit("Unknown")
    for low, high, name in CRYSTAL_SYSTEMS:
        out = F.when(number.between(low, high), name).otherwise(out)
    return out


def mobile_ion(elements: Column) -> Column:
    return F.try_element_at(F.filter(F.array(*map(F.lit, MOBILE)), lambda x: F.array_contains(elements, x)), F.lit(1))


def dopants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dopants in names of the parts: annotated, spelled out, in brackets, in ids of other databases, or none."""
    k, metal = F.col("p_partkey"), pick(METALS, F.col("p_partkey"))
    name = F.when(k % 5 == 0, F.concat("formula", F.lit(":"), metal)).when(k % 5 == 1, F.concat("formula", F.lit(" "), metal, F.lit("-doped"))).when(k % 5 == 2, F.concat("formula", F.lit("(70:30)glass"))).when(k % 5 == 3, F.concat(F.lit("mp-"), k.cast("string"), F.lit(":x"))).otherwise(F.concat("formula", F.lit(":0.5")))
    found = F.array_distinct(F.array_compact(F.array(colon_dopant(name), doped_element(name))))
    return parts(spark, sf_dir).select("p_partkey", F.array_join(F.array_sort(found), ",").alias("dopants"))


def mobile_ions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return formulas(spark, sf_dir).select("formula", mobile_ion(fm.elements(F.col("formula"))).alias("ion"))


def element_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unknown elements, all gas, non-oxides: differences and quantifiers over sets."""
    e = fm.elements(F.col("formula"))
    unknown = F.array_except(e, F.array(*map(F.lit, ELEMENTS)))
    gas = F.forall(e, lambda x: x.isin("H", "N", "O", "F", "Cl"))
    return formulas(spark, sf_dir).select("formula", F.array_join(F.array_sort(unknown), ",").alias("unknown"), gas.alias("all_gas"), (F.array_contains(e, "Li") & ~F.arrays_overlap(e, F.array(*map(F.lit, ("Co", "Mn", "Ni"))))).alias("candidate"))


def crystal_systems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Space groups from sizes: a range dimension as one case."""
    n = F.pmod(F.col("p_partkey") * 7, F.lit(240)).cast("int")
    return table(spark, sf_dir, "part").groupBy(crystal_system(n).alias("system")).agg(F.count(F.lit(1)).alias("n"), F.min(n).alias("lowest"))


def composition_descriptors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted means and deviations, plain ranges, of mass and electronegativity; elements without data weigh nothing."""
    dim = spark.createDataFrame([(e, *v) for e, v in ELEMENTS.items()], "element string, z int, mass double, en double")
    pieces = formulas(spark, sf_dir).select("formula", F.explode(fm.element_counts(F.col("formula"))).alias("x")).groupBy("formula", F.col("x.element").alias("element")).agg(F.sum("x.n").alias("n"))
    j = pieces.join(F.broadcast(dim), "element")  # the dimension is the table above
    mean = lambda c: F.sum(F.col("n") * F.col(c)) / F.sum("n")
    g = j.groupBy("formula").agg(F.count(F.lit(1)).alias("n_elements"), F.sum("n").alias("atoms"), mean("mass").alias("mass"), mean("en").alias("en"), (F.sum(F.col("n") * F.col("en") * F.col("en")) / F.sum("n")).alias("en2"), (F.max("en") - F.min("en")).alias("range"))
    return g.select("formula", "n_elements", F.round("atoms", 6).alias("atoms"), F.round("mass", 6).alias("mean_mass"), F.round("en", 6).alias("mean_en"), F.round(F.sqrt(F.greatest(F.lit(0.0), F.col("en2") - F.col("en") * F.col("en"))), 4).alias("std_en"), F.round("range", 6).alias("range_en"))


def discovery_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-valued: without a value high conductivity is unknown, but not fast and perhaps promising."""
    p = table(spark, sf_dir, "part")
    sigma = F.when(F.col("p_size") % 3 != 0, F.col("p_retailprice") * 1e-7)
    ea = F.when(F.col("p_size") % 2 == 0, F.col("p_size") / 50)
    stable, metal = F.col("p_partkey") % 4 == 0, F.col("p_partkey") % 9 == 0
    fast = F.coalesce(sigma >= 1.4e-4, F.lit(False)) & F.coalesce(ea < 0.6, F.lit(True))
    promising = (stable & ~metal) | F.coalesce(sigma >= 1.4e-4, F.lit(False))
    return p.select("p_partkey", fast.alias("fast"), (sigma >= 1.4e-4).alias("high"), promising.alias("promising"))


def query_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of a brand list and a type list (both fixed), and the three best parts of each."""
    p = table(spark, sf_dir, "part")
    cells = spark.createDataFrame([(b, t) for b in ("Brand#11", "Brand#23", "Brand#3", "Brand#7") for t in sorted({"ECONOMY", "PROMO", "STANDARD"})], "p_brand string, word string")
    j = p.join(F.broadcast(cells), "p_brand").where(F.col("p_type").contains(F.col("word")))  # twelve cells
    w = W.partitionBy("p_brand", "word").orderBy(F.desc("p_retailprice"), "p_partkey")
    return j.withColumn("n", F.row_number().over(w)).where("n <= 3").select("p_brand", "word", "p_partkey", "n")


def matrix_yield(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = table(spark, sf_dir, "part").groupBy("p_brand", "p_type")
    return g.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("p_size") > 25).alias("large"), F.max("p_retailprice").alias("best"))


def document_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title, language and first heading of a page; numbers of links and paragraphs."""
    h = F.col("html")
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_extract(h, "<title>([^<]*)</title>", 1).alias("title"), F.regexp_extract(h, 'lang="([a-z]+)"', 1).alias("lang"), F.regexp_count(h, F.lit("<a href")).cast("long").alias("links"), F.regexp_count(h, F.lit("<p>")).cast("long").alias("paragraphs"))


def majority_role(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations nested to one row: turns in order, characters by role."""
    c = table(spark, sf_dir, "conversations")
    turns = F.array_sort(F.collect_list(F.struct("turn", "role")))
    g = c.groupBy("conv_id").agg(turns.alias("t"), F.sum(F.when(F.col("role") == "user", F.char_length("text")).otherwise(0)).cast("long").alias("user_chars"), F.count(F.lit(1)).alias("turns"))
    return g.select("conv_id", "turns", "user_chars", F.array_join(F.transform("t", lambda x: x["role"]), ">").alias("roles"))


NUMBER = re.compile(r"(?<![A-Za-z0-9.])([0-9]+(?:\.[0-9]+)?)(?:\s*[x×*]\s*10\s*\^?\s*([-−]?[0-9]+)|[eE]([-+]?[0-9]+))?(?![A-Za-z0-9])")


def locate_values(df: DataFrame, key: str, text: str, value: str, tolerance: float = 0.35, window: int = 240) -> DataFrame:
    """Where a text states a number within the tolerance of the row's value: the nearest one, its offset and a snippet.

    Overlapping notations and offsets need a scanner, so batches go through Python by Arrow.
    """

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for k, t, v in zip(f[key], f[text], f[value]):
                best = None
                for m in NUMBER.finditer(t or "") if v else ():
                    x = float(m[1]) * 10.0 ** int((m[2] or m[3] or "0").replace("−", "-"))
                    off = abs(x - v) / abs(v)
                    if off <= tolerance and (best is None or (off, m.start()) < best[:2]):
                        best = off, m.start(), x
                if best:
                    a = max(0, best[1] - window // 2)
                    out.append((k, best[2], best[1], t[a : a + window]))
            yield pd.DataFrame(out, columns=["key", "found", "at", "snippet"])

    return df.select(key, text, F.col(value).cast("double").alias(value)).mapInPandas(scan, "key long, found double, at int, snippet string")


def evidence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that state a number near 2.0 (licence versions among them)."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", F.lit(2.0).alias("value"))
    return locate_values(d, "doc_id", "text", "value", 0.01).select(F.col("key").alias("doc_id"), "found", "at")


def tables_from_lines(df: DataFrame, key: str, text: str) -> DataFrame:
    """Runs of two lines or more with bars: table number, row number, cells; the first row of a run is its header."""
    lines = df.select(key, F.posexplode(F.split(text, "\n")).alias("k", "line")).withColumn("bar", F.col("line").contains("|"))
    w = W.partitionBy(key).orderBy("k")
    start = F.col("bar") & ~F.coalesce(F.lag("bar").over(w), F.lit(False))
    runs = lines.withColumn("table", F.sum(start.cast("int")).over(w)).where("bar")
    sized = runs.groupBy(key, "table").agg(F.count(F.lit(1)).alias("n"), F.min("k").alias("first")).where("n >= 2")
    return runs.join(sized, [key, "table"]).select(key, "table", (F.col("k") - F.col("first")).alias("row"), F.size(F.split("line", r"\|")).alias("cells"))


def text_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables_from_lines(table(spark, sf_dir, "documents"), "doc_id", "text")
    return t.groupBy("doc_id", "table").agg(F.count(F.lit(1)).alias("rows"), F.max("cells").alias("columns"))


QUERIES = {f.__name__: f for f in (dopants, mobile_ions, element_filters, crystal_systems, composition_descriptors, discovery_labels, query_matrix, matrix_yield, document_titles, majority_role, evidence_scan, text_tables)}
_E = f"select formula, list_distinct(regexp_extract_all(formula, '[A-Z][a-z]?')) as e from {SQL_FORMULAS}"
_L = lambda xs: "[" + ", ".join(f"'{x}'" for x in xs) + "]"
_SYS = "case " + " ".join(f"when n between {a} and {b} then '{s}'" for a, b, s in CRYSTAL_SYSTEMS) + " else 'Unknown' end"
_DIM = "(values " + ", ".join(f"('{e}', {m}::double, {x}::double)" for e, (_, m, x) in ELEMENTS.items()) + ") d(element, mass, en)"
SQL = {
    "dopants": f"select p_partkey, case when p_partkey % 5 < 2 then {sql_pick(METALS, 'p_partkey')} else '' end as dopants from {SQL_PARTS}",
    "mobile_ions": f"select formula, list_filter({_L(MOBILE)}, lambda x: list_contains(e, x))[1] ion from ({_E})",
    "element_filters": f"select formula, array_to_string(list_sort(list_filter(e, lambda x: not list_contains({_L(ELEMENTS)}, x))), ',') unknown, len(list_filter(e, lambda x: x not in ('H', 'N', 'O', 'F', 'Cl'))) = 0 all_gas, list_contains(e, 'Li') and not list_has_any(e, ['Co', 'Mn', 'Ni']) candidate from ({_E})",
    "crystal_systems": f"select {_SYS} system, count(*) n, min(n)::int lowest from (select p_partkey * 7 % 240 n from part) group by 1",
    "composition_descriptors": f"with p as (select formula, element, sum(n) as n from ({SQL_ELEMENTS.format(source=SQL_FORMULAS)}) group by 1, 2) select formula, count(*) n_elements, round(sum(n), 6) atoms, round(sum(n * mass) / sum(n), 6) mean_mass, round(sum(n * en) / sum(n), 6) mean_en, round(sqrt(greatest(0, sum(n * en * en) / sum(n) - (sum(n * en) / sum(n)) * (sum(n * en) / sum(n)))), 4) std_en, round(max(en) - min(en), 6) range_en from p join {_DIM} using (element) group by 1",
    "discovery_labels": "with p as (select p_partkey, case when p_size % 3 <> 0 then p_retailprice * 1e-7 end s, case when p_size % 2 = 0 then p_size::double / 50 end ea, p_partkey % 4 = 0 stable, p_partkey % 9 = 0 metal from part) select p_partkey, coalesce(s >= 1.4e-4, false) and coalesce(ea < 0.6, true) fast, s >= 1.4e-4 high, (stable and not metal) or coalesce(s >= 1.4e-4, false) promising from p",
    "query_matrix": "with c as (select * from (values ('Brand#11'), ('Brand#23'), ('Brand#3'), ('Brand#7')) b(p_brand), (values ('ECONOMY'), ('PROMO'), ('STANDARD')) t(word)) select p_brand, word, p_partkey, n::int n from (select p_brand, word, p_partkey, row_number() over (partition by p_brand, word order by p_retailprice desc, p_partkey) n from part join c using (p_brand) where contains(p_type, word)) where n <= 3",
    "matrix_yield": "select p_brand, p_type, count(*) n, count(*) filter (p_size > 25) large, max(p_retailprice) best from part group by 1, 2",
    "document_titles": "select page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) title, regexp_extract(html, 'lang=\"([a-z]+)\"', 1) lang, len(regexp_extract_all(html, '<a href'))::bigint links, len(regexp_extract_all(html, '<p>'))::bigint paragraphs from pages",
    "majority_role": "select conv_id, count(*) turns, cast(sum(case when role = 'user' then length(text) else 0 end) as bigint) user_chars, string_agg(role, '>' order by turn, role) roles from conversations group by 1",
    "text_tables": "with l as (select doc_id, unnest(string_split(text, chr(10))) line, generate_subscripts(string_split(text, chr(10)), 1) k from documents), b as (select *, contains(line, '|') bar from l), s as (select *, bar and not coalesce(lag(bar) over (partition by doc_id order by k), false) st from b), r as (select *, sum(st::int) over (partition by doc_id order by k) t from s) select doc_id, t::bigint as \"table\", count(*) as rows, max(len(string_split(line, '|')))::int as columns from r where bar group by 1, 2 having count(*) >= 2",
}
