"""Queries over formulas: resolution, families, keys, roles, descriptors. Formulas are those of the parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import formula as fm
from tessera.functions import materials as mt
from tessera.operators.roles import SQL_ELEMENTS, SQL_FORMULAS, SQL_PARTS, formulas, parts


def sorted_formulas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return formulas(spark, sf_dir).select("formula", mt.sorted_formula(F.concat(F.lit("O2"), "formula")).alias("canonical"))


def resolved_materials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical formula, key and family of every part; an unknown family may stand in the name."""
    p = parts(spark, sf_dir)
    own, name = fm.classify_family(F.col("formula")), F.lower("p_type")
    named = F.coalesce(*[F.when(name.contains(f) | name.rlike(f"(?i){pattern}"), f) for f, pattern in fm.FAMILY_PATTERNS], F.lit("unknown"))
    return p.select("p_partkey", mt.sorted_formula(F.col("formula")).alias("canonical"), fm.canonical_key(F.col("formula")).alias("key"), F.when(own == "unknown", named).otherwise(own).alias("family"))


def extraction_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = mt.extraction_family(F.col("formula"))
    return parts(spark, sf_dir).groupBy(f.alias("family")).agg(F.count(F.lit(1)).alias("n"))


def rule_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    return formulas(spark, sf_dir).select("formula", mt.rule_family(F.col("formula")).alias("family"))


def composition_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Split keys of the parts: family and reduced formula."""
    reduced = formulas(spark, sf_dir).withColumn("reduced", fm.reduced_formula("formula"))
    j = parts(spark, sf_dir).select("p_partkey", "formula").join(reduced, "formula")
    group = mt.composition_group(F.col("reduced"), F.col("formula"))
    return j.groupBy(mt.split_key(mt.rule_family(F.col("formula")), group).alias("split_key")).agg(F.count(F.lit(1)).alias("n"), F.min("p_partkey").alias("first"))


def material_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each formula beside the primary material of its size class."""
    p = parts(spark, sf_dir)
    primary = p.groupBy("p_size").agg(F.min("formula").alias("primary"))
    role, sub = mt.material_role(F.col("formula"), F.col("primary")), mt.is_substitution(F.col("formula"), F.col("primary"))
    return p.join(primary, "p_size").select("p_partkey", role.alias("role"), sub.alias("substitution"), mt.loosely_same(F.col("formula"), F.col("primary")).alias("loosely_same"))


def normal_compositions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spellings with blanks, dots and typographic minus signs come down to one."""
    spelled = F.concat(F.lit(" "), "formula", F.lit(" · "), "p_brand", F.lit(" –x−"), F.col("p_size").cast("string"))
    return parts(spark, sf_dir).select("p_partkey", mt.normal_composition(spelled).alias("normal"))


def formula_unit_volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    nsites = F.when(F.col("p_size") > 3, F.col("p_size"))
    v = mt.volume_per_formula_unit(F.col("p_retailprice"), nsites, F.col("formula"))
    return parts(spark, sf_dir).select("p_partkey", F.round(v, 6).alias("volume"))


def chemistry_descriptors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return formulas(spark, sf_dir).select("formula", mt.descriptors(F.col("formula")).alias("d")).select("formula", "d.*")


def redox_descriptors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Species are made of the formula's first element and its anion."""
    first, last = F.regexp_extract("formula", "^([A-Z][a-z]?)", 1), F.regexp_extract("formula", "([A-Z][a-z]?)[0-9]*$", 1)
    charged = F.array(F.concat(first, F.lit("+")), F.when(F.length("formula") % 2 == 0, F.concat(first, F.lit("2+"))), F.concat(last, F.lit("2-")), F.lit("odd"))
    return formulas(spark, sf_dir).select("formula", mt.redox(F.col("formula"), F.array_compact(charged)).alias("r")).select("formula", "r.*")


def polymer_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes and prices of polymer hosts alone; other families have none."""
    hosts = F.concat(F.element_at(F.array(*map(F.lit, ("PEO", "PVDF", "Li", "pan"))), (F.col("p_partkey") % 4 + 1).cast("int")), F.lit("-LiTFSI"))
    p = parts(spark, sf_dir).withColumn("polymer", mt.rule_family(hosts) == "polymer_composite")
    return p.groupBy("polymer").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("polymer"), F.col("p_size"))).alias("chain_lengths"), F.round(F.avg(F.when(F.col("polymer"), F.col("p_retailprice"))), 6).alias("mean_weight"))


def composition_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Additive confidence of an extracted composition, at most 1."""
    f = F.when(F.col("p_size") % 10 != 0, F.col("formula")).otherwise("")
    source = F.element_at(F.array(*map(F.lit, ("primary", "literature", "unknown"))), (F.col("p_partkey") % 3 + 1).cast("int"))
    score = 0.5 + F.when(F.length(f) >= 3, 0.3).otherwise(0) + F.when(mt.extraction_family(f) != "unknown", 0.2).otherwise(0) + F.when(F.col("p_size") > 25, 0.2).otherwise(0) + F.when(source == "primary", 0.2).when(source == "literature", -0.2).otherwise(0)
    return parts(spark, sf_dir).select("p_partkey", F.round(F.when(f != "", F.least(score, F.lit(1.0))).otherwise(0.5), 3).alias("confidence"), (f != "").alias("valid"))


QUERIES = {f.__name__: f for f in (sorted_formulas, resolved_materials, extraction_families, rule_families, composition_groups, material_roles, normal_compositions, formula_unit_volumes, chemistry_descriptors, redox_descriptors, polymer_features, composition_scores)}

_PLACE = "case element " + " ".join(f"when '{e}' then {k}" for k, e in enumerate(mt.ELEMENT_ORDER, 1)) + " else 1000 end"
_SPELLED = "element || case when place < 1000 and n = 1 then '' else n::bigint::varchar end"
_EXTRACTION = "case " + " ".join(f"when regexp_matches({{f}}, '(?i){p}') then '{n}'" for n, p in mt.EXTRACTION_FAMILIES) + " else 'unknown' end"
_FAMILY = "case " + " ".join(f"when regexp_matches(formula, '(?i){p}') then '{n}'" for n, p in fm.FAMILY_PATTERNS) + " else 'unknown' end"
_NAMED = "case " + " ".join(f"when contains(lower(p_type), '{n}') or regexp_matches(lower(p_type), '(?i){p}') then '{n}'" for n, p in fm.FAMILY_PATTERNS) + " else 'unknown' end"
_LIST = lambda names: "[" + ", ".join(f"'{n}'" for n in names) + "]"
_E = "list_distinct(regexp_extract_all({f}, '[A-Z][a-z]?'))"
_RULES = f"""case
  when regexp_matches({{f}}, '(?i){mt.POLYMER_HOSTS}') then 'polymer_composite'
  when not list_has_any({_E}, {_LIST(mt.ALKALI)}) then 'unknown'
  when list_has_all({_E}, ['C', 'H']) then 'polymer_composite'
  when list_has_all({_E}, ['P', 'S']) and list_has_any({_E}, {_LIST(mt.HALOGENS)}) then 'argyrodite'
  when list_contains({_E}, 'O') and list_has_any({_E}, {_LIST(mt.HALOGENS)}) and list_has_all({_LIST(mt.ANTIPEROVSKITE)}, {_E}) then 'antiperovskite'
  when list_has_any({_E}, {_LIST(mt.HALOGENS)}) and not list_has_any({_E}, ['O', 'S']) then 'halide'
  when list_has_all({_E}, ['B', 'H']) then 'borohydride'
  when list_has_all({_E}, ['La', 'O']) and list_has_any({_E}, {_LIST(mt.GARNET_METALS)}) then 'garnet'
  when list_has_all({_E}, ['La', 'Ti', 'O']) then 'perovskite'
  when list_has_all({_E}, ['O', 'P']) and list_has_any({_E}, {_LIST(mt.NASICON_METALS)}) then 'nasicon'
  when list_contains({_E}, 'H') and not list_contains({_E}, 'O') then 'hydride'
  when list_contains({_E}, 'S') and (not list_contains({_E}, 'O') or list_has_any({_E}, {_LIST(mt.THIO_METALS)})) then 'sulfide'
  when list_contains({_E}, 'O') and (list_has_all(['Li', 'O'], {_E}) or not list_has_all({_LIST((*mt.NON_METALS, 'Li'))}, {_E})) then 'oxide'
  else 'unknown' end"""
_rules = lambda f: _RULES.replace("{f}", f)
_PROPS = "(values " + ", ".join(f"('{e}', {a}::double, {b}::double, {c}::double, {d}::double)" for e, (a, b, c, d) in mt.PROPERTIES.items()) + ") q(element, eneg, mass, grp, period)"
_LETTERS = "list_distinct(regexp_extract_all(lower({f}), '[a-z]+'))"
SQL = {
    "sorted_formulas": f"with p as ({SQL_ELEMENTS.format(source='(select formula as own, $$O2$$ || formula as formula from ' + SQL_FORMULAS + ')')}), s as (select formula, element, sum(n) as n, {_PLACE} as place from p group by 1, 2) select substr(formula, 3) as formula, string_agg({_SPELLED}, '' order by place, element) as canonical from s group by 1",
    "resolved_materials": f"with p as ({SQL_ELEMENTS.format(source=SQL_FORMULAS)}), s as (select formula, string_agg({_SPELLED}, '' order by place, element) as canonical, string_agg(element || printf('%.4f', n), '' order by element || printf('%.4f', n)) as key from (select *, {_PLACE} as place from p) group by 1) select p_partkey, canonical, key, case when {_FAMILY} = 'unknown' then {_NAMED} else {_FAMILY} end as family from {SQL_PARTS} join s using (formula)",
    "extraction_families": f"select {_EXTRACTION.replace('{f}', 'formula')} as family, count(*) as n from {SQL_PARTS} group by 1",
    "rule_families": f"select formula, {_rules('formula')} as family from {SQL_FORMULAS}",
    "composition_groups": f"with p as ({SQL_ELEMENTS.format(source=SQL_FORMULAS)}), g as (select formula, list(n::bigint) as c from p group by 1), r as (select p.formula, string_agg(element || case when n::bigint // d = 1 then '' else (n::bigint // d)::varchar end, '' order by element) as reduced from p join (select formula, gcd(gcd(c[1], c[2]), c[3]) as d from g) using (formula) group by 1) select {_rules('formula')} || '::' || reduced as split_key, count(*) as n, min(p_partkey) as first from {SQL_PARTS} join r using (formula) group by 1",
    "material_roles": f"""
    with p as (select * from {SQL_PARTS}), m as (select p_size, min(formula) as prime from p group by 1),
    x as (select p_partkey, formula, prime, {_LETTERS.replace('{f}', 'formula')} as a, {_LETTERS.replace('{f}', 'prime')} as b, {_E.replace('{f}', 'formula')} as c, {_E.replace('{f}', 'prime')} as d from p join m using (p_size))
    select p_partkey,
      case when lower(formula) = lower(prime) then 'primary' when len(list_intersect(a, b)) > 0 and len(list_intersect(a, b)) >= greatest(1, least(len(a), len(b)) - 1) then 'primary_variant' else 'other' end as role,
      not (list_has_all(c, d) and list_has_all(d, c)) and len(list_intersect(c, d)) >= greatest(len(c), len(d)) - 2 as substitution,
      contains(lower(formula), lower(prime)) or contains(lower(prime), lower(formula)) as loosely_same
    from x""",
    "normal_compositions": f"select p_partkey, formula || replace(p_brand, ' ', '') || '-x-' || p_size as normal from {SQL_PARTS}",
    "formula_unit_volumes": f"with a as (select formula, sum(n) as atoms from ({SQL_ELEMENTS.format(source=SQL_FORMULAS)}) group by 1) select p_partkey, round(case when p_size > 3 and p_retailprice > 0 then p_retailprice * atoms / p_size end, 6) as volume from {SQL_PARTS} join a using (formula)",
    "chemistry_descriptors": f"select formula, round(avg(eneg), 6) as eneg_mean, max(eneg) as eneg_max, min(eneg) as eneg_min, round(stddev_pop(eneg), 6) as eneg_std, round(sum(n * mass) / sum(n), 6) as mass_mean, round(sum(n * grp) / sum(n), 6) as group_mean, round(sum(n * period) / sum(n), 6) as period_mean from ({SQL_ELEMENTS.format(source=SQL_FORMULAS)}) join {_PROPS} using (element) group by 1",
    "redox_descriptors": f"""
    with p as ({SQL_ELEMENTS.format(source=SQL_FORMULAS)}),
    x as (select formula, length(formula) % 2 = 0 as twice, regexp_extract(formula, '^([A-Z][a-z]?)', 1) as f, regexp_extract(formula, '([A-Z][a-z]?)[0-9]*$', 1) as l from {SQL_FORMULAS}),
    t as (select formula, sum(n) as atoms, sum(n) filter (element = f) - 2 * sum(n) filter (element = l) as net from p join x using (formula) group by 1)
    select formula, round(case when twice then 1.0 / 3 else -0.5 end, 6)::double as average_oxidation, case when twice then 4.0 else 3.0 end::double as oxidation_range, twice as mixed_valence, abs(net / atoms) < 0.01 as electroneutral from x join t using (formula)""",
    "polymer_features": "select p_partkey % 4 <> 2 as polymer, count(*) as n, count(case when p_partkey % 4 <> 2 then p_size end) as chain_lengths, round(avg(case when p_partkey % 4 <> 2 then p_retailprice end), 6) as mean_weight from part group by 1",
    "composition_scores": f"with x as (select p_partkey, p_size, case when p_size % 10 <> 0 then formula else '' end as f from {SQL_PARTS}) select p_partkey, round(case when f <> '' then least(1.0::double, 0.5::double + case when length(f) >= 3 then 0.3 else 0 end + case when {_EXTRACTION.replace('{f}', 'f')} <> 'unknown' then 0.2 else 0 end + case when p_size > 25 then 0.2 else 0 end + case p_partkey % 3 when 0 then 0.2 when 1 then -0.2 else 0 end) else 0.5 end::double, 3) as confidence, f <> '' as valid from x",
}
