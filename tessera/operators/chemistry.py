"""Queries over unit and formula functions. Formulas are those of the parts; values with units are texts made of lineitem rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import formula as fm
from tessera.functions import units as un
from tessera.functions.columns import doi_canonical
from tessera.operators.consensus import measurements
from tessera.operators.roles import SQL_ELEMENTS, SQL_FORMULAS, SQL_REDUCED, formulas, pick, sql_pick
from tessera.session import table

FORMULAS = ("Li7La3Zr2O12", "Li6PS5Cl", "Li10GeP2S12", "Li3YCl6", "LiBH4", "Li1.3Al0.3Ti1.7P3O12", "Na3Zr2Si2PO12", "PEO-LiTFSI", "Li2O", "Li3PS4", "Li0.5La0.5TiO3", "NaCl", "Li2OHCl", "KFe2O4")
#: Spellings of units that the texts use: every prefix with every way to write "per length", and others.
UNITS = (*[f"{p}S{per}" for p in ("", "m", "u", "n") for per in ("/cm", " cm-1", "/m")], "log S/cm", "ohm^-1cm^-1", "counts")
ENERGY_UNITS, TEMPERATURE_UNITS = ("kJ/mol", "kcal/mol", "meV", "eV", "J"), ("K", "C", "Kelvin", "F")


def _rows(spark: SparkSession, rows, *names: str) -> DataFrame:
    return spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], ", ".join(f"{n} string" for n in names))


def _values(rows) -> str:
    q = lambda x: "null::varchar" if x is None else "'" + x.replace("'", "''") + "'"
    return ", ".join("(" + ", ".join(map(q, r if isinstance(r, tuple) else (r,))) + ")" for r in rows)


def _quantities(spark: SparkSession, sf_dir: str, units: tuple[str, ...]) -> DataFrame:
    """value and unit of every lineitem row as text: with a point, a comma, an exponent, a power of ten, or no number; one unit of many is missing."""
    li, n = table(spark, sf_dir, "lineitem"), F.col("l_linenumber")
    whole, form = F.col("l_quantity").cast("int").cast("string"), F.col("l_orderkey") % 4
    digits = n.cast("string")
    value = F.when(n == 7, "n/a").when(form == 0, F.concat(whole, F.lit("."), digits)).when(form == 1, F.concat(whole, F.lit(","), digits)).when(form == 2, F.concat(whole, F.lit("e-"), digits)).otherwise(F.concat(whole, F.lit(" x 10-"), digits))
    return li.select(value.alias("value"), F.when(F.col("l_partkey") % 17 != 0, pick(units, F.col("l_partkey"))).alias("unit"))


def unit_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts in S/cm, by unit: how they were read, and the mean of their logarithms."""
    q = _quantities(spark, sf_dir, UNITS).select("unit", un.normalize_sigma(F.col("value"), F.col("unit")).alias("n"))
    return q.groupBy("unit", "n.is_log", "n.note").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(F.log10("n.value")), 6).alias("mean_log"))


def ea_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = _quantities(spark, sf_dir, ENERGY_UNITS).select("unit", un.normalize_ea(F.col("value"), F.col("unit")).alias("ev"))
    return q.groupBy("unit").agg(F.count(F.lit(1)).alias("n"), F.count("ev").alias("known"), F.round(F.avg("ev"), 6).alias("ev"))


def temperature_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = _quantities(spark, sf_dir, TEMPERATURE_UNITS).select("unit", un.normalize_temperature(F.col("value"), F.col("unit")).alias("c"))
    return q.groupBy("unit").agg(F.count(F.lit(1)).alias("n"), F.count("c").alias("known"), F.round(F.avg("c"), 6).alias("celsius"))


def formula_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return formulas(spark, sf_dir).select("formula", F.array_join(F.array_sort(fm.elements(F.col("formula"))), ",").alias("elements"))


def formula_parse_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return formulas(spark, sf_dir).select("formula", F.explode(fm.element_counts(F.col("formula"))).alias("x")).groupBy("formula", F.col("x.element").alias("element")).agg(F.round(F.sum("x.n"), 6).alias("n"))


def canonical_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return formulas(spark, sf_dir).select("formula", fm.canonical_key(F.col("formula")).alias("key"))


def family_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return formulas(spark, sf_dir).select("formula", fm.classify_family(F.col("formula")).alias("family"))


def charge_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = fm.net_charge(F.col("formula"))
    return formulas(spark, sf_dir).select("formula", F.round(q, 6).alias("charge"), (F.abs(F.round(q, 6)) > 1).alias("imbalanced"))


def doi_canonicals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identifiers of suppliers with the first slash written as an underscore, as a slash, or that are none."""
    k = F.col("s_suppkey").cast("string")
    doi = F.when(F.col("s_suppkey") % 3 == 0, F.concat(F.lit(" 10."), k, F.lit("_a_b"))).when(F.col("s_suppkey") % 3 == 1, F.concat(F.lit("10."), k, F.lit("/a_b "))).otherwise(F.concat(F.lit("x_"), k))
    return table(spark, sf_dir, "supplier").select("s_suppkey", doi_canonical(doi).alias("canonical"))


def reduced_formula(spark: SparkSession, sf_dir: str) -> DataFrame:
    return formulas(spark, sf_dir).select("formula", fm.reduced_formula("formula").alias("reduced"))


def same_material(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formulas of equal element sets are one material: its first formula, and how many there are."""
    rows = formulas(spark, sf_dir).select("formula", F.array_join(F.array_sort(fm.elements(F.col("formula"))), ",").alias("k"))
    first = rows.groupBy("k").agg(F.min("formula").alias("material"), F.count(F.lit(1)).alias("spellings"))
    return rows.join(first, "k").select("formula", "material", "spellings")


def arrhenius_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failures of the ratio form; prices are scaled to conductivities, temperature is 273.15 + quantity."""
    ms = measurements(spark, sf_dir).withColumn("sigma", F.col("value") * 1e-7).withColumn("kelvin", F.col("temperature") + 273.15)
    ratio = un.arrhenius_prefactor(F.col("sigma"), F.col("ea") * 10, F.col("kelvin"))
    ok = un.arrhenius_plausible(F.col("sigma"), F.col("ea") * 10, F.col("kelvin"))
    return ms.where(~ok).select("ordinal", "line", "material", F.round(F.log10(ratio), 6).alias("log_ratio"))


def arrhenius_slope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordinary least squares of log10 value on 1000 / T per material; activation energy from the slope."""
    ms = measurements(spark, sf_dir).where("value > 0").withColumn("y", F.log10("value")).withColumn("x", 1000 / (F.col("temperature") + 273.15))
    g = ms.groupBy("material").agg(F.count(F.lit(1)).alias("n"), F.regr_slope("y", "x").alias("m"), F.countDistinct("x").alias("d")).where("d >= 2")
    return g.select("material", "n", F.round(F.col("m") * -1000 * un.LN10 * un.KB_EV, 6).alias("ea"))


def msd_conductivity(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").where("value is not null").select("event_type", "value", (F.col("event_id") / 1000).alias("t"))
    g = e.groupBy("event_type").agg(F.regr_slope("value", "t").alias("slope"))
    return g.select("event_type", F.round(un.conductivity_from_slope(F.abs("slope"), F.lit(8.0), F.lit(500.0), F.lit(600.0)), 6).alias("sigma"))


def cosine_best_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference compound most similar to each formula, at 0.5 or more; first by name among equals. Both meet by element; the references are a fixed list."""
    counts = lambda df: df.select("formula", F.explode(fm.element_counts(F.col("formula"))).alias("x")).groupBy("formula", F.col("x.element").alias("element")).agg(F.sum("x.n").alias("n"))
    norm = lambda df, name: df.groupBy("formula").agg(F.sqrt(F.sum(F.col("n") * F.col("n"))).alias(name))
    a, b = counts(formulas(spark, sf_dir)), counts(_rows(spark, FORMULAS, "formula"))
    known = F.broadcast(b.join(norm(b, "m_norm"), "formula").select(F.col("formula").alias("other"), "element", F.col("n").alias("m"), "m_norm"))  # len(FORMULAS) compounds
    dot = a.join(known, "element").groupBy("formula", "other", "m_norm").agg(F.sum(F.col("n") * F.col("m")).alias("dot"))
    s = dot.join(norm(a, "norm"), "formula").withColumn("score", F.round(F.col("dot") / (F.col("norm") * F.col("m_norm")), 6)).where("score >= 0.5")
    best = s.groupBy("formula").agg(F.max("score").alias("score"))
    return s.join(best, ["formula", "score"]).groupBy("formula", "score").agg(F.min("other").alias("other"))


QUERIES = {f.__name__: f for f in (unit_normalize, ea_normalize, temperature_normalize, formula_elements, formula_parse_map, canonical_key, family_classify, charge_balance, doi_canonicals, reduced_formula, same_material, arrhenius_filter, arrhenius_slope, msd_conductivity, cosine_best_match)}
_FV = f"{SQL_FORMULAS} t"
_PARTS = SQL_ELEMENTS.format(source=SQL_FORMULAS)
_NUM = "coalesce(try_cast(regexp_extract(value, '^([+-]?[0-9]+\\.?[0-9]*)\\s*[eEx]\\s*10\\s*([+-]?[0-9]+)$', 1) as double) * pow(10, try_cast(regexp_extract(value, '^([+-]?[0-9]+\\.?[0-9]*)\\s*[eEx]\\s*10\\s*([+-]?[0-9]+)$', 2) as double)), try_cast(replace(value, ',', '.') as double))"
_MATCH = "case " + " ".join(f"when regexp_matches(formula, '(?i){p}') then '{n}'" for n, p in fm.FAMILY_PATTERNS) + " else 'unknown' end"
_OX = "case element " + " ".join(f"when '{e}' then {q}" for e, q in fm.OXIDATION.items()) + " else 0 end"
_M = "with m as (select l_partkey material, l_orderkey ordinal, l_linenumber line, l_extendedprice as value, l_discount + 0.01 ea, l_quantity temperature from lineitem)"


def _texts(units: tuple[str, ...]) -> str:
    value = "case when l_linenumber = 7 then 'n/a' else l_quantity::int || case l_orderkey % 4 when 0 then '.' when 1 then ',' when 2 then 'e-' else ' x 10-' end || l_linenumber end"
    return f"select {value} as value, case when l_partkey % 17 <> 0 then {sql_pick(units, 'l_partkey')} end as unit from lineitem"


SQL = {
    "reduced_formula": SQL_REDUCED.format(source=SQL_FORMULAS),
    "unit_normalize": f"""
    with q as ({_texts(UNITS)}), t as (select *, {_NUM} as v, coalesce(contains(lower(unit), 'log'), false) as is_log, regexp_replace(lower(unit), '[ /^]|-?1', '', 'g') as bare from q),
    p as (select *, regexp_extract(bare, '(m|u|n)?(s|ohm)(c?m)$', 1) as prefix, regexp_extract(bare, '(m|u|n)?(s|ohm)(c?m)$', 3) as length from t),
    f as (select *, case when length <> '' then case prefix when 'm' then 1e-3 when 'u' then 1e-6 when 'n' then 1e-9 else 1.0 end::double / case length when 'm' then 100 else 1 end end as f from p)
    select unit, is_log, case when v is null then 'unparseable' when unit is null then 'no unit' when is_log then 'log-form' when f is null then 'unit not recognised' else '' end as note,
      count(*) as n, round(avg(case when is_log then v else log10(v * coalesce(f, 1)) end), 6) as mean_log from f group by 1, 2, 3""",
    "ea_normalize": f"with q as ({_texts(ENERGY_UNITS)}), e as (select unit, case when unit is null or unit = 'eV' then {_NUM} when unit = 'kJ/mol' then {_NUM} / 96.485 when unit = 'kcal/mol' then {_NUM} / 23.061 when unit = 'meV' then {_NUM} * 1e-3 end as ev from q) select unit, count(*) as n, count(ev) as known, round(avg(ev), 6) as ev from e group by 1",
    "temperature_normalize": f"with q as ({_texts(TEMPERATURE_UNITS)}), c as (select unit, case when unit is null or unit = 'C' then {_NUM} when unit in ('K', 'Kelvin') then {_NUM} - 273.15 end as c from q) select unit, count(*) as n, count(c) as known, round(avg(c), 6) as celsius from c group by 1",
    "formula_elements": f"select formula, array_to_string(list_sort(list_distinct(regexp_extract_all(formula, '[A-Z][a-z]?'))), ',') elements from {_FV}",
    "formula_parse_map": f"select formula, element, round(sum(n), 6) n from ({_PARTS}) group by 1, 2",
    "canonical_key": f"select formula, string_agg(element || printf('%.4f', n), '' order by element || printf('%.4f', n)) as key from ({_PARTS}) group by 1",
    "family_classify": f"select formula, {_MATCH} as family from {_FV}",
    "charge_balance": f"select formula, round(sum({_OX} * n), 6) charge, abs(round(sum({_OX} * n), 6)) > 1 imbalanced from ({_PARTS}) group by 1",
    "doi_canonicals": "select s_suppkey, case s_suppkey % 3 when 2 then 'x_' || s_suppkey else '10.' || s_suppkey || '/a_b' end as canonical from supplier",
    "same_material": f"with k as (select formula, list_sort(list_distinct(regexp_extract_all(formula, '[A-Z][a-z]?'))) as k from {_FV}) select formula, min(formula) over (partition by k) as material, count(*) over (partition by k) as spellings from k",
    "arrhenius_filter": f"{_M}, r as (select *, value * 1e-7 / exp(-ea * 10 / (8.617333262e-5 * (temperature + 273.15))) r from m where value > 0 and ea > 0) select ordinal, line, material, round(log10(r), 6) log_ratio from r where not (r > 1e-4 and r < 1e4)",
    "arrhenius_slope": f"{_M}, g as (select material, count(*) n, regr_slope(log10(value), 1000 / (temperature + 273.15)) m, count(distinct temperature) d from m where value > 0 group by 1) select material, n, round(m * -1000 * ln(10) * 8.617333262e-5, 6) ea from g where d >= 2",
    "msd_conductivity": "select event_type, round(8.0::double / 500 * (abs(regr_slope(value, event_id / 1000)) / 6) / (8.617333262e-5 * 600), 6) sigma from events where value is not null group by 1",
    "cosine_best_match": f"with a as (select formula, element, sum(n) as n from ({_PARTS}) group by 1, 2), b as (select formula, element, sum(n) as n from ({SQL_ELEMENTS.format(source=f'(values {_values(FORMULAS)}) t(formula)')}) group by 1, 2), x as (select formula, sqrt(sum(n * n)) as norm from a group by 1), y as (select formula, sqrt(sum(n * n)) as norm from b group by 1), s as (select a.formula, b.formula as other, round(sum(a.n * b.n) / (any_value(x.norm) * any_value(y.norm)), 6) as score from a join b using (element) join x on x.formula = a.formula join y on y.formula = b.formula group by 1, 2) select formula, other, score from (select *, row_number() over (partition by formula order by score desc, other) as n from s where score >= 0.5) where n = 1",
}
