"""Evidence: graph filters and summaries, physics checks, verifier scores, extraction scores, values near unit words in texts.

Roles over the driver's tables: a lineitem row is an extracted value or a verdict, its quantity a conductivity in
mS/cm or a temperature, its discount an activation energy in tenths of eV; documents and conversations are paper texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import materials as mt
from tessera.functions.units import KB_EV
from tessera.operators.roles import SQL_PARTS, formula_of, parts, sql_formula
from tessera.session import table

#: Weights and bands of the verifier's score, caps for a different value and for no model.
WEIGHTS = {"evidence": 25, "llm_agreement": 25, "physics": 20, "literature": 15, "units": 10, "temp": 5}
BANDS = ((98, "auto_approve"), (95, "spot_check"), (80, "needs_review"))
DIFFERENT_CAP, NO_MODEL_CAP = 82.0, 74.0
#: Plausible ranges of the extraction side, by property; a prefactor's bounds.
CONDUCTIVITY_RANGE, PREFACTOR = (1e-15, 1e2), (1e-10, 1e10)
#: Words that mark reviews.
REVIEW_WORDS = r"(?i)(this review|review article|we review|literature review|mini.?review|critical review|overview of)"
TITLE_WORDS = "review|perspective|tutorial"
ABSTRACT_WORDS = "this review|we review|review of|overview of|survey of|review article"
#: Words of units and quantities that must stand near a value.
SIGMA_CONTEXT = r"(?i)(s/cm|s[∙· ]*cm|cm\s*-\s*1|cm⁻|mS|µ\s*s|u\s*s/cm|n\s*s/cm|Ω|ohm|s/m|conductiv|σ)"
EA_CONTEXT = r"(?i)((?<![a-z])ev\b|kj/mol|kcal|activation|barrier|\bea\b)"
NEAR = 20


def keeps_node(primary: Column, source_type: Column, confidence: Column, material: Column, wanted: Column) -> Column:
    """Primary, not from literature, at least 0.3, and of the wanted material where both are named."""
    other = (material != "") & (wanted != "") & (F.lower(material) != F.lower(wanted))
    return F.coalesce(primary & (source_type != "literature") & (confidence >= 0.3) & ~F.coalesce(other, F.lit(False)), F.lit(False))


def prefactor_issue(sigma: Column, ea: Column, celsius: Column) -> Column:
    """Why the Arrhenius prefactor can't be, or null; without a temperature over absolute zero nothing is said."""
    kelvin = celsius + 273.15
    s0 = sigma / F.exp(-ea / (KB_EV * kelvin))
    return F.when(kelvin > 0, F.when(s0 < 0, "negative").when(s0 > PREFACTOR[1], "unphysical").when(s0 < PREFACTOR[0], "suspiciously low"))


def physics_ok(sigma: Column, ea: Column, celsius: Column, sigma_range: tuple[Column, Column], ea_range: tuple[Column, Column], typical: tuple[float, float]) -> Column:
    """Ranges of the family and the prefactor at celsius + 298, as the verifier reckons (0 counts as no temperature: 25)."""
    inside = lambda v, r: F.coalesce(v.between(*r), F.lit(True))
    kelvin = F.coalesce(F.nullif(celsius, F.lit(0.0)), F.lit(25.0)) + 298
    s0 = sigma * F.pow(F.lit(2.7182818), ea / (KB_EV * kelvin))
    return inside(sigma, sigma_range) & inside(ea, ea_range) & F.coalesce(s0.between(*typical), F.lit(True))


def composite_score(present: Column, quoted: Column, agreeing: Column, models: Column, different: Column, physics: Column, literature: Column, units: Column, temperature: Column) -> Column:
    """Weighted score of 0 to 100; a different value and a review without models are capped."""
    s = (
        WEIGHTS["evidence"] * F.when(present & quoted, 1.0).when(present, 0.9).otherwise(0.15)
        + WEIGHTS["llm_agreement"] * (agreeing / F.greatest(models, F.lit(1)))
        + WEIGHTS["physics"] * F.when(physics, 1.0).otherwise(0.25)
        + WEIGHTS["literature"] * F.when(literature == "agree", 0.75).when(literature == "conflict", 0.15).otherwise(0.5)
        + WEIGHTS["units"] * F.when(units, 1.0).otherwise(0.2)
        + WEIGHTS["temp"] * F.when(temperature, 1.0).otherwise(0.4)
    )
    s = F.when(different, F.least(s, F.lit(DIFFERENT_CAP))).otherwise(s)
    return F.bround(F.when(models == 0, F.least(s, F.lit(NO_MODEL_CAP))).otherwise(s), 1)


def decision(score: Column) -> Column:
    out = F.lit("reject")
    for least, name in reversed(BANDS):
        out = F.when(score >= least, name).otherwise(out)
    return out


def queue_clear(verdict: Column, snippet: Column, prop: Column) -> Column:
    """What becomes of a pending item: one value for several compositions goes, a found value with a snippet (an energy without, too) stays."""
    found = (verdict == "FOUND") & (snippet.isNotNull() | F.lower(prop).isin("activation_energy", "ea"))
    return F.when(verdict == "DUP_VALUE", "rejected: duplicate").when(F.coalesce(found, F.lit(False)), "approved").otherwise("rejected: no evidence")


def conductivity_confidence(value: Column, celsius: Column, kind: Column, primary: Column, source_type: Column, mismatch: Column) -> Column:
    """Additive confidence of an extracted conductivity as (confidence, valid); without a value 0.5 and not valid."""
    sound = value.between(1e-15, 100.0) & (value > 0)
    inside = value.between(*CONDUCTIVITY_RANGE)
    add = lambda holds, points: F.when(F.coalesce(holds, F.lit(False)), points).otherwise(0.0)
    score = 0.5 + add(sound, 0.2) + add(~inside, -0.1) + add(celsius.isNotNull(), 0.15) + add(kind.isin("total", "bulk", "grain_boundary"), 0.1) + add(primary, 0.15)
    score = score + add(source_type == "primary", 0.2) + add(source_type == "literature", -0.3) + add(mismatch, -0.2)
    valid = sound & inside & ~F.coalesce(mismatch, F.lit(False))
    return F.struct(F.round(F.when(value.isNotNull(), F.least(score, F.lit(1.0))).otherwise(0.5), 3).alias("confidence"), F.coalesce(valid, F.lit(False)).alias("valid"))


def is_review(text: Column) -> Column:
    """Judged by the first 5,000 characters."""
    return F.coalesce(F.substring(text, 1, 5000).rlike(REVIEW_WORDS), F.lit(False))


def is_review_paper(title: Column, text: Column, paragraphs: Column) -> Column:
    """By title, by the first 2,000 characters, or by more than 80 paragraphs."""
    return F.coalesce(F.lower(title).rlike(TITLE_WORDS), F.lit(False)) | F.coalesce(F.lower(F.substring(text, 1, 2000)).rlike(ABSTRACT_WORDS), F.lit(False)) | F.coalesce(paragraphs > 80, F.lit(False))


def table_rows_of(markdown: Column, formulas: Column) -> Column:
    """A pipe table's head and the lines that name a formula (or its first element); the whole table if none does."""
    plain = lambda f: F.lower(F.replace(f, F.lit(" "), F.lit("")))
    aliases = F.array_distinct(F.filter(F.flatten(F.transform(formulas, lambda f: F.array(plain(f), F.regexp_replace(plain(f), "[()]", ""), F.lower(F.regexp_extract(f, "^([A-Z][a-z]*)", 1))))), lambda a: a != ""))
    lines = F.split(markdown, "\n")
    kept = F.filter(lines, lambda line, k: (k == 0) | F.exists(aliases, lambda a: F.contains(F.lower(line), a)))
    return F.when((F.size(kept) <= 1) | (F.size(aliases) == 0), markdown).otherwise(F.array_join(kept, "\n"))


def fixed_units(sigma: Column, confidence: Column, text: Column) -> Column:
    """(sigma, confidence): where the text speaks of mS/cm, values over 0.001 and up to 10 are taken as such, with at most 0.7."""
    hit = F.coalesce(text.rlike(r"mS\s*/?\s*cm") & (sigma > 0.001) & (sigma / 0.001 <= 10_000), F.lit(False))
    return F.struct(F.when(hit, sigma * 0.001).otherwise(sigma).alias("sigma"), F.when(hit, F.least(confidence, F.lit(0.7))).otherwise(confidence).alias("confidence"))


def value_near_unit(text: Column, target: Column, context: str) -> Column:
    """The first number of the text within 35 % of the target that has a unit word within NEAR characters; zero never counts.

    Numbers and the gaps between them come from one expression, so that a text is read once.
    """
    number = r"[0-9]+\.?[0-9]*(?:[eE][-−]?[0-9]+|\s*[x×]\s*10\s*[-−]?\s*[0-9]+)?"
    value = lambda m: F.coalesce(
        F.regexp_replace(F.translate(m, "−", "-"), r"\s*[x×]\s*10\s*(-?)\s*([0-9]+)$", "e$1$2").try_cast("double"), F.lit(0.0)
    )

    def first(found: Column, gaps: Column) -> Column:
        hits = F.transform(found, lambda m, k: F.when((value(m) != 0) & (F.abs(value(m) - target) <= F.greatest(F.abs(target) * 0.35, F.lit(1e-7))) & F.concat(F.right(F.get(gaps, k), F.lit(NEAR)), m, F.left(F.get(gaps, k + 1), F.lit(NEAR))).rlike(context), value(m)))
        return F.get(F.filter(hits, lambda h: h.isNotNull()), F.lit(0))

    return first(F.regexp_extract_all(text, F.lit(f"({number})"), F.lit(1)), F.split(text, number, -1))


def rerank_fallback(rank: Column) -> Column:
    """The score of a result by its rank (from 0) where no model ranks."""
    return 1.0 - 0.01 * rank


def _verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem")


def evidence_primary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes that stand for their paper's own material, by property and source."""
    li = _verdicts(spark, sf_dir)
    keep = keeps_node(F.col("l_linenumber") <= 4, F.col("source_type"), F.col("l_discount") * 10, formula_of(F.col("l_partkey")), F.when(F.col("l_suppkey") % 2 == 0, formula_of(F.col("l_suppkey"))))
    kinds = li.withColumn("source_type", F.when(F.col("l_returnflag") == "R", "literature").otherwise("primary"))
    return kinds.where(keep).groupBy("source_type", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))


def evidence_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes by property and by source, and all."""
    li = _verdicts(spark, sf_dir).select(F.col("l_linestatus").alias("property"), F.col("l_returnflag").alias("source_type"))
    g = li.groupingSets([["property"], ["source_type"], []], "property", "source_type").agg(F.count(F.lit(1)).alias("n"))
    return g.select(F.coalesce("property", F.lit("")).alias("property"), F.coalesce("source_type", F.lit("")).alias("source_type"), "n")


def prefactor_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _verdicts(spark, sf_dir)
    issue = prefactor_issue(F.col("l_extendedprice") * 1e-7, F.col("l_discount") * 10, F.when(F.col("l_linenumber") != 7, F.col("l_quantity")))
    return li.groupBy(F.coalesce(issue, F.lit("")).alias("issue")).agg(F.count(F.lit(1)).alias("n"))


def verifier_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Physics, score and decision of every verdict, counted by decision and score."""
    li, n = _verdicts(spark, sf_dir), F.col("l_linenumber")
    sigma, ea = F.col("l_extendedprice") * 1e-7, F.col("l_discount") * 10
    physics = physics_ok(sigma, ea, F.col("l_quantity"), (F.lit(1e-5), F.lit(8e-3)), (F.lit(0.1), F.lit(0.8)), (1e-2, 1e8))
    literature = F.when(F.col("l_returnflag") == "A", "agree").when(F.col("l_returnflag") == "R", "conflict").otherwise("none")
    score = composite_score(F.col("l_quantity") > 10, n <= 5, F.least(n % 4, n - 1), n - 1, F.col("l_tax") > 0.07, physics, literature, F.col("l_tax") > 0.01, F.col("l_discount") > 0.02)
    return li.select(score.alias("score")).groupBy("score", decision(F.col("score")).alias("decision")).agg(F.count(F.lit(1)).alias("n"))


def queue_clearance(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _verdicts(spark, sf_dir)
    verdict = F.when(F.col("l_tax") > 0.06, "DUP_VALUE").when(F.col("l_tax") > 0.02, "FOUND")
    out = queue_clear(verdict, F.when(F.col("l_linestatus") == "F", F.lit("snippet")), F.when(F.col("l_linenumber") % 2 == 0, "Ea").otherwise("sigma"))
    return li.groupBy(out.alias("decision")).agg(F.count(F.lit(1)).alias("n"))


def conductivity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confidence of every extracted conductivity, by confidence and validity."""
    li = _verdicts(spark, sf_dir)
    value = F.when(F.col("l_linenumber") != 7, (F.col("l_quantity") - 1) * 1e-3)
    kind, source = F.when(F.col("l_returnflag") == "A", "bulk").otherwise("other"), F.when(F.col("l_returnflag") == "N", "primary").when(F.col("l_returnflag") == "R", "literature").otherwise("unknown")
    c = conductivity_confidence(value, F.when(F.col("l_tax") > 0.04, F.col("l_quantity")), kind, F.col("l_linestatus") == "F", source, F.col("l_partkey") % 5 == 0)
    return li.select(c.alias("c")).groupBy("c.confidence", "c.valid").agg(F.count(F.lit(1)).alias("n"))


def extraction_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extracted records that hit a label of the same material within 35 %, or 0.05 eV, by paper."""
    li = _verdicts(spark, sf_dir)
    truth = li.where("l_linestatus = 'F'").groupBy(F.col("l_suppkey").alias("paper"), F.col("l_partkey").alias("m")).agg(F.collect_set("l_quantity").alias("sigmas"), F.collect_set("l_discount").alias("energies"))  # fifty quantities, eleven discounts at most
    records = li.where("l_linestatus = 'O'").join(truth, (F.col("l_suppkey") == F.col("paper")) & (F.col("l_partkey") == F.col("m")), "left")
    sigma = F.exists("sigmas", lambda s: F.abs(F.col("l_quantity") - s) <= F.abs(s) * 0.35)
    energy = F.exists("energies", lambda e: F.abs(F.col("l_discount") - e) <= 0.05)
    return records.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("records"), F.count_if(sigma).alias("sigma_hits"), F.count_if(energy).alias("ea_hits"), F.countDistinct("l_partkey").alias("compositions"))


def review_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that read as reviews, by either rule."""
    d = table(spark, sf_dir, "documents")
    title, paragraphs = F.substring_index("text", "\n", 1), F.size(F.filter(F.split("text", "\n"), lambda x: F.trim(x) != ""))
    return d.select("doc_id", is_review(F.col("text")).alias("review"), is_review_paper(title, F.col("text"), paragraphs).alias("review_paper"))


def material_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of a size class's parts cut down to the lines of one material."""
    p = parts(spark, sf_dir).where("p_partkey % 10 = 0").select("p_partkey", "formula", "p_brand")
    markdown = F.concat(F.lit("| material | brand |\n| --- | --- |\n| "), "formula", F.lit(" | "), "p_brand", F.lit(" |\n| Xx9 | "), "p_brand", F.lit(" |"))
    wanted = F.array(F.when(F.col("p_partkey") % 20 == 0, F.col("formula")).otherwise("Qq(2)"))
    return p.select("p_partkey", table_rows_of(markdown, wanted).alias("rows"))


def unit_fixups(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _verdicts(spark, sf_dir)
    text = F.when(F.col("l_linestatus") == "F", "reported in mS cm").otherwise("reported in S/cm")
    fixed = fixed_units(F.col("l_quantity") / 4, F.col("l_discount") * 10, text)
    return li.select("l_linestatus", fixed.alias("f")).groupBy("l_linestatus").agg(F.round(F.sum("f.sigma"), 6).alias("sigma"), F.round(F.max("f.confidence"), 6).alias("confidence"))


def located_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims looked up in a sentence made of their record: values stand beside a unit or not."""
    li = _verdicts(spark, sf_dir)
    q = F.col("l_quantity").cast("int").cast("string")
    unit = F.when(F.col("l_linenumber") % 3 == 0, " mS/cm").when(F.col("l_linenumber") % 3 == 1, " cycles").otherwise("e-3 S cm")
    text = F.concat(F.lit("At 0 degrees and after many further hours of work: "), q, unit, F.lit("; the other sample, measured much later, had 777 counts."))
    target = F.when(F.col("l_linenumber") % 3 == 2, F.col("l_quantity") / 1000).otherwise(F.col("l_quantity") * F.when(F.col("l_returnflag") == "R", 2.0).otherwise(1.2))
    found = value_near_unit(text, target, SIGMA_CONTEXT)
    return li.select((F.col("l_linenumber") % 3).alias("unit"), "l_returnflag", found.alias("v")).groupBy("unit", "l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.count("v").alias("located"), F.round(F.sum("v"), 6).alias("total"))


def same_material_loose(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels that an extraction of the same part names loosely: with a suffix, in lower case, or not at all."""
    p = parts(spark, sf_dir)
    named = F.when(F.col("p_size") % 3 == 0, F.concat(F.lower("formula"), F.lit(" glass"))).when(F.col("p_size") % 3 == 1, F.lit("")).otherwise("zz")
    return p.groupBy(mt.loosely_same(F.col("formula"), named).alias("same")).agg(F.count(F.lit(1)).alias("n"))


QUERIES = {f.__name__: f for f in (evidence_primary, evidence_summary, prefactor_issues, verifier_decisions, queue_clearance, conductivity_scores, extraction_scores, review_documents, material_tables, unit_fixups, located_values, same_material_loose)}
SQL = {
    "evidence_primary": f"with n as (select *, case when l_returnflag = 'R' then 'literature' else 'primary' end as source_type, {sql_formula('l_partkey')} as f, case when l_suppkey % 2 = 0 then {sql_formula('l_suppkey')} end as w from lineitem) select source_type, l_linestatus, count(*) as n from n where l_linenumber <= 4 and source_type <> 'literature' and l_discount * 10 >= 0.3 and (w is null or lower(f) = lower(w)) group by 1, 2",
    "evidence_summary": "select l_linestatus as property, '' as source_type, count(*) as n from lineitem group by 1 union all select '', l_returnflag, count(*) from lineitem group by 2 union all select '', '', count(*) from lineitem",
    "prefactor_issues": "with s as (select l_extendedprice * 1e-7 / exp(-l_discount * 10 / (8.617333262e-5 * (case when l_linenumber <> 7 then l_quantity end + 273.15))) as s from lineitem) select case when s < 0 then 'negative' when s > 1e10 then 'unphysical' when s < 1e-10 then 'suspiciously low' else '' end as issue, count(*) as n from s group by 1",
    "verifier_decisions": f"""
    with p as (select *, l_extendedprice * 1e-7 as sigma, l_discount * 10 as ea, l_linenumber - 1 as models, least(l_linenumber % 4, l_linenumber - 1) as agreeing from lineitem),
    k as (select *, sigma between 1e-5 and 8e-3 and ea between 0.1 and 0.8 and sigma * pow(2.7182818, ea / (8.617333262e-5 * (l_quantity + 298))) between 1e-2 and 1e8 as physics from p),
    s as (select *, {WEIGHTS['evidence']} * case when l_quantity > 10 and l_linenumber <= 5 then 1.0::double when l_quantity > 10 then 0.9 else 0.15 end
      + {WEIGHTS['llm_agreement']} * (agreeing::double / greatest(models, 1)) + {WEIGHTS['physics']} * case when physics then 1.0::double else 0.25 end
      + {WEIGHTS['literature']} * case l_returnflag when 'A' then 0.75::double when 'R' then 0.15 else 0.5 end
      + {WEIGHTS['units']} * case when l_tax > 0.01 then 1.0::double else 0.2 end + {WEIGHTS['temp']} * case when l_discount > 0.02 then 1.0::double else 0.4 end as raw from k),
    c as (select round_even(case when models = 0 then least(case when l_tax > 0.07 then least(raw, 82) else raw end, 74) when l_tax > 0.07 then least(raw, 82) else raw end, 1) as score from s)
    select score, case when score >= 98 then 'auto_approve' when score >= 95 then 'spot_check' when score >= 80 then 'needs_review' else 'reject' end as decision, count(*) as n from c group by 1, 2""",
    "queue_clearance": "select case when l_tax > 0.06 then 'rejected: duplicate' when l_tax > 0.02 and (l_linestatus = 'F' or l_linenumber % 2 = 0) then 'approved' else 'rejected: no evidence' end as decision, count(*) as n from lineitem group by 1",
    "conductivity_scores": """
    with v as (select *, case when l_linenumber <> 7 then (l_quantity - 1) * 1e-3 end as v from lineitem),
    s as (select v, l_partkey, 0.5::double + case when v > 0 and v between 1e-15 and 100 then 0.2 else 0 end + case when not v between 1e-15 and 1e2 then -0.1 else 0 end + case when l_tax > 0.04 then 0.15 else 0 end
      + case when l_returnflag = 'A' then 0.1 else 0 end + case when l_linestatus = 'F' then 0.15 else 0 end + case l_returnflag when 'N' then 0.2 when 'R' then -0.3 else 0 end + case when l_partkey % 5 = 0 then -0.2 else 0 end as s from v)
    select round(case when v is not null then least(s, 1.0::double) else 0.5 end, 3) as confidence, coalesce(v > 0 and v between 1e-15 and 100 and l_partkey % 5 <> 0, false) as valid, count(*) as n from s group by 1, 2""",
    "extraction_scores": """
    with t as (select l_suppkey, l_partkey, list(distinct l_quantity) as q, list(distinct l_discount) as d from lineitem where l_linestatus = 'F' group by 1, 2)
    select l_suppkey, count(*) as records, count(*) filter (len(list_filter(q, lambda s: abs(l_quantity - s) <= abs(s) * 0.35)) > 0) as sigma_hits, count(*) filter (len(list_filter(d, lambda e: abs(l_discount - e) <= 0.05)) > 0) as ea_hits, count(distinct l_partkey) as compositions
    from lineitem left join t using (l_suppkey, l_partkey) where l_linestatus = 'O' group by 1""",
    "review_documents": f"select doc_id, coalesce(regexp_matches(substr(text, 1, 5000), '{REVIEW_WORDS}'), false) as review, coalesce(regexp_matches(lower(split_part(text, chr(10), 1)), '{TITLE_WORDS}'), false) or coalesce(regexp_matches(lower(substr(text, 1, 2000)), '{ABSTRACT_WORDS}'), false) or coalesce(len(list_filter(string_split(text, chr(10)), lambda x: trim(x, ' ') <> '')) > 80, false) as review_paper from documents",
    "material_tables": f"select p_partkey, '| material | brand |' || chr(10) || case when p_partkey % 20 = 0 then '' else '| --- | --- |' || chr(10) end || '| ' || formula || ' | ' || p_brand || ' |' || case when p_partkey % 20 = 0 then '' else chr(10) || '| Xx9 | ' || p_brand || ' |' end as rows from {SQL_PARTS} where p_partkey % 10 = 0",
    "unit_fixups": "with f as (select l_linestatus, l_linestatus = 'F' and l_quantity / 4 > 0.001 and l_quantity / 4 / 0.001 <= 10000 as hit, l_quantity / 4 as s, l_discount * 10 as c from lineitem) select l_linestatus, round(sum(case when hit then s * 0.001 else s end), 6) as sigma, round(max(case when hit then least(c, 0.7) else c end), 6) as confidence from f group by 1",
    "located_values": """
    with c as (select l_linenumber % 3 as unit, l_returnflag, case when l_linenumber % 3 = 0 then l_quantity::int::double when l_linenumber % 3 = 2 then (l_quantity::int || 'e-3')::double end as v, case when l_linenumber % 3 = 2 then l_quantity / 1000 else l_quantity * case when l_returnflag = 'R' then 2.0 else 1.2 end end as target from lineitem),
    h as (select unit, l_returnflag, case when abs(v - target) <= greatest(abs(target) * 0.35, 1e-7) then v end as v from c)
    select unit, l_returnflag, count(*) as n, count(v) as located, round(sum(v), 6) as total from h group by 1, 2""",
    "same_material_loose": "select p_size % 3 = 0 as same, count(*) as n from part group by 1",
}
