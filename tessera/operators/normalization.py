"""Normalisation of records and texts: units routed by property, legacy conversions, ranges in texts, chunks, targets.

Roles over the driver's tables: a lineitem row is a record whose status tells its property, its quantity the value;
documents are paper texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.functions import units as un
from tessera.operators.roles import SQL_PARTS, parts, pick, sql_pick
from tessera.session import table

#: What the older cleaning step multiplies by, in the order of its look-up.
LEGACY_CONDUCTIVITY = (("S/cm", 1.0), ("S/m", 0.01), ("mS/cm", 0.001), ("mS/m", 1e-5), ("µS/cm", 1e-6), ("uS/cm", 1e-6), ("Ω⁻¹cm⁻¹", 1.0), ("S*cm⁻¹", 1.0), ("Scm⁻¹", 1.0))
LEGACY_ENERGY = (("eV", 1.0), ("kJ/mol", 0.010364), ("kcal/mol", 0.043364), ("meV", 0.001), ("J", 6.242e18))
#: The extraction step's own factor for kJ/mol.
EXTRACTION_KJ = 0.01036
HERTZ = {"hz": 1.0, "khz": 1e3, "mhz": 1e6, "ghz": 1e9}
NOT_IMPEDANCE = r"MHz\s*\(|\bMAS\b|\bspinning\s*speed|\bNMR\b"


def record_units(prop: Column, value: Column, unit: Column) -> Column:
    """struct(sigma, multiplier, ea, issues): a value is a conductivity by its property, or by its unit where the property doesn't say; an energy never is."""
    name = F.lower(F.coalesce(prop, F.lit("")))
    energy = name.contains("activation") | name.isin("ea", "energy")
    sigma = name.contains("conduct") | name.contains("sigma") | (~energy & F.coalesce(un.sigma_factor(unit).isNotNull(), F.lit(False)))
    n = un.normalize_sigma(value, unit)
    read = F.when(sigma, n["value"])
    factor = F.when(sigma & ~n["is_log"], F.coalesce(un.sigma_factor(unit), F.lit(1.0)))
    ea = F.when(energy, un.normalize_ea(value, unit))
    issues = F.array_compact(F.array(F.when(value.isNotNull() & sigma & read.isNull(), "no number"), F.when(factor != 1.0, "converted"), F.when(value.isNotNull() & energy & ea.isNull(), "energy not read")))
    return F.struct(read.alias("sigma"), factor.alias("multiplier"), ea.alias("ea"), issues.alias("issues"))


def legacy_conductivity(value: Column, unit: Column) -> Column:
    """By the unit as it stands, else by the first known one that holds it or is held; else as it is."""
    u = F.replace(F.trim(unit), F.lit(" "), F.lit(""))
    factor = F.lit(None).cast("double")
    for name, f in reversed(LEGACY_CONDUCTIVITY):
        factor = F.when(F.contains(u, F.lit(name)) | F.contains(F.lit(name), u), f).otherwise(factor)
    exact = F.try_element_at(F.create_map(*[F.lit(x) for pair in LEGACY_CONDUCTIVITY for x in pair]), u)
    return value * F.coalesce(exact, factor, F.lit(1.0))


def legacy_energy(value: Column, unit: Column) -> Column:
    u = F.lower(F.trim(unit))
    factor = F.lit(1.0)
    for name, f in reversed(LEGACY_ENERGY):
        factor = F.when(F.contains(u, F.lit(name.lower())) | F.contains(F.lit(name.lower()), u), f).otherwise(factor)
    return value * factor


def legacy_kelvin(value: Column, unit: Column) -> Column:
    u = F.upper(F.trim(unit))
    return F.when(u.contains("C") & ~u.contains("K"), value + 273.15).when(u.contains("F"), (value - 32) * 5 / 9 + 273.15).otherwise(value)


def standard_sigma(sigma: Column) -> Column:
    """A struct of value and unit in S/cm; one without a unit is taken as that; others stay null."""
    return F.when(sigma.isNotNull(), legacy_conductivity(sigma["value"], F.coalesce(sigma["unit"], F.lit("S/cm"))))


def extraction_sigma(value: Column, unit: Column) -> Column:
    u = F.translate(F.lower(F.replace(unit, F.lit(" "), F.lit(""))), "−–", "--")
    return F.when(u.rlike("ms[/·]cm"), value * 0.001).when(u.contains("s/m"), value * 0.01).otherwise(value)


def extraction_ea(value: Column, unit: Column) -> Column:
    u = F.lower(F.replace(unit, F.lit(" "), F.lit("")))
    return F.when(u.contains("mev"), value * 0.001).when(u.contains("kj/mol"), value * EXTRACTION_KJ).otherwise(value)


def axis_value(pixel: Column, first: tuple[Column, Column], second: tuple[Column, Column]) -> Column:
    """The value at a pixel of an axis known by two ticks (pixel, value); null if they share a pixel."""
    slope = F.try_divide(second[1] - first[1], second[0] - first[0])
    return first[1] + slope * (pixel - first[0])


def frequency_range(text: Column) -> Column:
    """struct(low, high) in hertz of an impedance sweep: powers of ten, a number and a power, two numbers, or one; null beside NMR words."""
    return F.element_at(F.transform(F.array(text), _frequency_range), 1)


def _frequency_range(text: Column) -> Column:
    t = F.translate(F.replace(text, F.lit("­"), F.lit("")), " −–⁰¹²³⁴⁵⁶⁷⁸⁹⁻", " --0123456789-")
    unit = r"(Hz|kHz|MHz|GHz)"
    to = r"\s*(?:to|-|and|up to)\s*"
    get = lambda p, k: F.nullif(F.regexp_extract(t, f"(?i){p}", k), F.lit(""))
    scale = lambda u: F.try_element_at(F.create_map(*[F.lit(x) for pair in HERTZ.items() for x in pair]), F.lower(u))
    powers = rf"10\s*-\s*([0-9])\s*(?:Hz|kHz|MHz|GHz)?\s*(?:to|-)\s*10\s*-?\s*([0-9])\s*{unit}"
    mixed = rf"([0-9]+(?:\.[0-9]+)?){to}10\s*([0-9])\s*{unit}"
    plain = rf"([0-9]+(?:\.[0-9]+)?)\s*{unit}{to}([0-9]+(?:\.[0-9]+)?)\s*{unit}"
    single = rf"([0-9]+(?:\.[0-9]+)?)\s*{unit}"
    number = lambda c: c.try_cast("double")
    ends = lambda a, b: F.struct(F.least(a, b).alias("low"), F.greatest(a, b).alias("high"))
    ten = F.lit(10.0)
    found = (
        F.when(get(powers, 3).isNotNull(), F.struct((F.pow(ten, -number(get(powers, 1))) * scale(get(powers, 3))).alias("low"), (F.pow(ten, number(get(powers, 2))) * scale(get(powers, 3))).alias("high")))
        .when(get(mixed, 3).isNotNull(), ends(number(get(mixed, 1)) * scale(get(mixed, 3)), F.pow(ten, number(get(mixed, 2))) * scale(get(mixed, 3))))
        .when(get(plain, 4).isNotNull(), ends(number(get(plain, 1)) * scale(get(plain, 2)), number(get(plain, 3)) * scale(get(plain, 4))))
        .when(get(single, 2).isNotNull(), F.struct((number(get(single, 1)) * scale(get(single, 2))).alias("low"), F.lit(None).cast("double").alias("high")))
    )
    return F.when(~t.rlike(NOT_IMPEDANCE), found)


def without_flagged(conditions: Column, suspicious: Column) -> Column:
    """A map without the fields that messages of the form field=... name."""
    flagged = F.filter(F.transform(F.coalesce(suspicious, F.array().cast("array<string>")), lambda s: F.trim(F.substring_index(s, "=", 1))), lambda f: f != "")
    return F.map_filter(conditions, lambda k, v: ~F.array_contains(flagged, k))


def says_something(c: Column) -> Column:
    """Present to the quality score: neither null nor a word for nothing; false, 0 and empty arrays are values."""
    return c.isNotNull() & ~F.lower(F.trim(c.cast("string"))).isin("", "nan", "none", "null", "unknown")


def scoring_kind(tier: Column) -> Column:
    """Computed rows are scored by completeness, others by trust."""
    return F.when(F.coalesce(tier, F.lit("")).isin("", "dft_native", "dft_computed_inhouse"), "completeness").otherwise("experimental")


def paragraph_chunks(text: Column, most: int = 2000, least: int = 100) -> Column:
    """Paragraphs put together up to `most` characters, tables (a bar among the first 80 of over 60) kept alone; chunks under `least` go.

    A fold that keeps the open chunk apart from the closed ones, which are joined by a sign and split at the end, so that no array is copied.
    """
    end = "\u001e"
    pieces = F.filter(F.transform(F.split(F.translate(text, end, " "), "\n\n"), lambda p: F.regexp_replace(p, r"^\s+|\s+$", "")), lambda p: p != "")

    def step(acc: Column, p: Column) -> Column:
        is_table = F.contains(F.substring(p, 1, 80), F.lit("|")) & (F.char_length(p) > 60)
        full = F.char_length(acc["open"]) + F.char_length(p) > most
        closed = lambda x: F.concat(acc["done"], F.when(acc["open"] != "", F.concat(acc["open"], F.lit(end))).otherwise(""), x)
        done = F.when(is_table, closed(F.concat(p, F.lit(end)))).when(full, closed(F.lit(""))).otherwise(acc["done"])
        opened = F.when(is_table, "").when(full | (acc["open"] == ""), p).otherwise(F.concat(acc["open"], F.lit("\n\n"), p))
        return F.struct(done.alias("done"), opened.alias("open"))

    whole = F.aggregate(pieces, F.struct(F.lit("").alias("done"), F.lit("").alias("open")), step, lambda acc: F.concat(acc["done"], acc["open"]))
    return F.filter(F.split(whole, end), lambda c: F.char_length(c) >= least)


def regex_prepass(text: Column) -> Column:
    """Candidates (composition, sigma) that read plainly as "3.2 x 10-4 S/cm" or "3.2e-4 S/cm"; the composition is the first formula among the 80 characters before, else unknown.

    One expression finds them; the texts between the matches give what stands before each.
    """
    form = r"[0-9]+(?:\.[0-9]+)?\s*(?:(?:[×x*]\s*10|[eE])\s*[-−⁻–^]*\s*)[0-9]+\s*[Ss]\s*[/.]?\s*[Cc]m"
    gaps = F.split(text, form, -1)

    def of(m: Column, k: Column) -> Column:
        before = F.right(F.get(gaps, k), F.lit(80))
        formula = F.nullif(F.regexp_extract(before, r"([A-Z][a-z]?[0-9]*(?:\.[0-9]+)?(?:[A-Z][a-z]?[0-9]*(?:\.[0-9]+)?)+)", 1), F.lit(""))
        mantissa = F.regexp_extract(m, r"^([0-9]+(?:\.[0-9]+)?)", 1).try_cast("double")
        exponent = F.regexp_extract(m, r"([0-9]+)\s*[Ss]\s*[/.]?\s*[Cc]m$", 1).try_cast("double")
        return F.struct(F.coalesce(formula, F.lit("unknown")).alias("composition"), (mantissa * F.pow(F.lit(10.0), -exponent)).alias("sigma"))

    return F.transform(F.regexp_extract_all(text, F.lit(f"({form})"), F.lit(1)), of)


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem")


def normalized_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records by property and unit: conductivities, energies and what had to be assumed."""
    li = _texts(spark, sf_dir)
    prop = pick(("conductivity", "activation_energy", "porosity"), F.col("l_partkey"))
    unit = pick(("mS/cm", "eV", "S/cm", "kJ/mol", "%"), F.col("l_suppkey"))
    value = F.when(F.col("l_linenumber") != 7, F.col("l_quantity").cast("int").cast("string")).otherwise("?")
    r = li.select(prop.alias("property"), unit.alias("unit"), record_units(prop, value, unit).alias("r"))
    return r.groupBy("property", "unit").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("r.sigma"), 6).alias("sigma"), F.round(F.sum("r.ea"), 6).alias("ea"), F.count_if(F.size("r.issues") > 0).alias("with_issues"))


def legacy_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The older conversions and the extraction step's, beside each other by unit."""
    li = _texts(spark, sf_dir)
    unit, q = pick(("mS / cm", "S/m", "kJ/mol", "meV", "degC", "F", "K"), F.col("l_partkey")), F.col("l_quantity")
    sums = {"sigma": legacy_conductivity(q, unit), "energy": legacy_energy(q, unit), "kelvin": legacy_kelvin(q, unit), "struct_sigma": standard_sigma(F.struct(q.alias("value"), F.when(F.col("l_linenumber") > 1, unit).alias("unit"))), "x_sigma": extraction_sigma(q, unit), "x_ea": extraction_ea(q, unit)}
    return li.select(unit.alias("unit"), *[c.alias(k) for k, c in sums.items()]).groupBy("unit").agg(*[F.round(F.avg(k), 6).alias(k) for k in sums])


def calibrated_axes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixels in data units, by the two ticks of their axis."""
    p = table(spark, sf_dir, "part")
    v = axis_value(F.col("p_retailprice"), (F.lit(100.0), F.lit(-6.0)), (100.0 + F.col("p_size") % 5, F.lit(-3.0)))
    return p.select("p_partkey", F.round(v, 6).alias("value"))


def frequency_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sweeps in sentences made of the parts, in four typographic forms and beside NMR words."""
    size = F.col("p_size").cast("string")
    form = F.col("p_partkey") % 6
    text = (
        F.when(form == 0, F.concat(F.lit("from 10⁻² to 10⁶ Hz, cell "), size)).when(form == 1, F.concat(F.lit("from "), size, F.lit(" to 10⁶ Hz")))
        .when(form == 2, F.concat(size, F.lit(" MHz – 1 Hz"))).when(form == 3, F.concat(F.lit("at "), size, F.lit(" kHz only"))).when(form == 4, F.concat(F.lit("MAS NMR at "), size, F.lit(" kHz"))).otherwise("no sweep")
    )
    return table(spark, sf_dir, "part").select("p_partkey", frequency_range(text).alias("f")).select("p_partkey", F.round("f.low", 6).alias("low"), F.round("f.high", 6).alias("high"))


def retracted_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conditions of parts without their suspicious fields."""
    conditions = F.create_map(F.lit("size"), F.col("p_size").cast("string"), F.lit("brand"), F.col("p_brand"), F.lit("type"), F.col("p_type"))
    suspicious = F.when(F.col("p_size") % 3 == 0, F.array(F.concat(F.lit("size = "), F.col("p_size").cast("string")), F.lit("=x"))).when(F.col("p_size") % 3 == 1, F.array(F.lit("brand=?"), F.lit("type")))
    m = without_flagged(conditions, suspicious)
    return table(spark, sf_dir, "part").groupBy(F.array_join(F.array_sort(F.map_keys(m)), ",").alias("kept")).agg(F.count(F.lit(1)).alias("n"))


def scoring_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    tier = F.when(F.col("p_size") > 2, pick(("dft_native", "verified_human", "literature_mined", "dft_computed_inhouse", ""), F.col("p_partkey")))
    return table(spark, sf_dir, "part").groupBy(scoring_kind(tier).alias("kind"), says_something(tier).alias("tiered")).agg(F.count(F.lit(1)).alias("n"))


def recent_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers of 2016 and later, and those whose year isn't known."""
    year = F.when(F.col("s_suppkey") % 7 != 0, 2005 + F.col("s_nationkey"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", year.alias("year")).where("year is null or year >= 2016")


def text_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraph chunks of every document (a line is a paragraph here)."""
    d = table(spark, sf_dir, "documents").where("text is not null")
    text = F.replace(F.replace("text", F.lit("\r"), F.lit("")), F.lit("\n"), F.lit("\n\n"))
    c = paragraph_chunks(text, 400, 20)
    return d.select("doc_id", F.size(c).alias("chunks"), F.aggregate(c, F.lit(0), lambda acc, x: acc + F.char_length(x)).alias("chars"))


def prepass_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conductivities that sentences made of the parts state plainly."""
    size = F.col("p_size").cast("string")
    text = F.concat(F.lit("The sample "), "formula", F.when(F.col("p_partkey") % 3 == 0, " reached ").otherwise(" and, after a long treatment at many temperatures that we describe at length below and in the other parts, it had "), size, F.when(F.col("p_partkey") % 2 == 0, " x 10-4 S/cm").otherwise(".5e-3 S cm"), F.lit(" at 25 C."))
    c = parts(spark, sf_dir).select("p_partkey", F.explode(regex_prepass(text)).alias("c"))
    return c.select("p_partkey", "c.composition", F.round("c.sigma", 9).alias("sigma"))


def ml_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets of materials: class numbers in alphabetic order, and values with a mask; missing labels are 0 and masked."""
    p = table(spark, sf_dir, "part")
    classes = p.select("p_brand").distinct().withColumn("label", F.row_number().over(W.orderBy("p_brand")) - 1)  # a row per class
    y = F.when(F.col("p_size") % 4 != 0, F.log10("p_retailprice"))
    return p.join(F.broadcast(classes), "p_brand").select("p_partkey", "label", F.round(F.coalesce(y, F.lit(0.0)), 6).alias("y"), y.isNotNull().alias("mask"))


QUERIES = {f.__name__: f for f in (normalized_records, legacy_units, calibrated_axes, frequency_ranges, retracted_fields, scoring_kinds, recent_papers, text_chunks, prepass_candidates, ml_targets)}
_UNIT = sql_pick(("mS / cm", "S/m", "kJ/mol", "meV", "degC", "F", "K"), "l_partkey")
SQL = {
    "normalized_records": f"""
    with r as (select {sql_pick(('conductivity', 'activation_energy', 'porosity'), 'l_partkey')} as property, {sql_pick(('mS/cm', 'eV', 'S/cm', 'kJ/mol', '%'), 'l_suppkey')} as unit, case when l_linenumber <> 7 then l_quantity::int::double end as v from lineitem),
    s as (select *, property = 'conductivity' or (property = 'porosity' and unit in ('mS/cm', 'S/cm')) as sigma, property = 'activation_energy' as energy from r),
    c as (select *, case when sigma then v * case unit when 'mS/cm' then 1e-3 else 1 end end as s, case when energy then case unit when 'eV' then v when 'kJ/mol' then v / 96.485 end end as e from s)
    select property, unit, count(*) as n, round(sum(s), 6) as sigma, round(sum(e), 6) as ea, count(*) filter ((sigma and (v is null or unit = 'mS/cm')) or (energy and e is null)) as with_issues from c group by 1, 2""",
    "legacy_units": f"""
    with u as (select {_UNIT} as unit, l_quantity as q, l_linenumber as l from lineitem),
    s as (select *, q * case unit when 'mS / cm' then 0.001 when 'S/m' then 0.01 else 1 end as sigma from u)
    select unit, round(avg(sigma), 6) as sigma,
      round(avg(q * case when unit in ('kJ/mol', 'K') then 0.010364 else 1 end), 6) as energy,
      round(avg(case when unit in ('mS / cm', 'degC') then q + 273.15 when unit = 'F' then (q - 32) * 5 / 9 + 273.15 else q end), 6) as kelvin,
      round(avg(case when l > 1 then sigma else q end), 6) as struct_sigma,
      round(avg(q * case unit when 'mS / cm' then 0.001 when 'S/m' then 0.01 else 1 end), 6) as x_sigma, round(avg(q * case unit when 'meV' then 0.001 when 'kJ/mol' then 0.01036 else 1 end), 6) as x_ea
    from s group by 1""",
    "calibrated_axes": "select p_partkey, round(case when p_size % 5 <> 0 then -6 + 3.0::double / (p_size % 5) * (p_retailprice - 100) end, 6) as value from part",
    "frequency_ranges": "select p_partkey, round(case p_partkey % 6 when 0 then 0.01 when 1 then least(p_size, 1e6) when 2 then 1.0 when 3 then p_size * 1e3 end::double, 6) as low, round(case p_partkey % 6 when 0 then 1e6 when 1 then 1e6 when 2 then p_size * 1e6 end::double, 6) as high from part",
    "retracted_fields": "select case p_size % 3 when 0 then 'brand,type' when 1 then 'size' else 'brand,size,type' end as kept, count(*) as n from part group by 1",
    "scoring_kinds": f"with t as (select case when p_size > 2 then {sql_pick(('dft_native', 'verified_human', 'literature_mined', 'dft_computed_inhouse', ''), 'p_partkey')} end as t from part) select case when coalesce(t, '') in ('', 'dft_native', 'dft_computed_inhouse') then 'completeness' else 'experimental' end as kind, coalesce(t, '') <> '' as tiered, count(*) as n from t group by 1, 2",
    "recent_papers": "select s_suppkey, case when s_suppkey % 7 <> 0 then 2005 + s_nationkey end as year from supplier where s_suppkey % 7 = 0 or 2005 + s_nationkey >= 2016",
    "prepass_candidates": f"select p_partkey, case when p_partkey % 3 = 0 then formula else 'unknown' end as composition, round(case when p_partkey % 2 = 0 then p_size::double * pow(10::double, -4) else (p_size || '.5')::double * pow(10::double, -3) end, 9) as sigma from {SQL_PARTS}",
    "ml_targets": "with c as (select p_brand, (row_number() over (order by p_brand) - 1)::int as label from (select distinct p_brand from part)) select p_partkey, label, round(case when p_size % 4 <> 0 then log10(p_retailprice) else 0 end, 6) as y, p_size % 4 <> 0 as mask from part join c using (p_brand)",
}
