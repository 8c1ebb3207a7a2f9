"""Review: seventeen rules, a weighted score, an ordered decision; and the queue's updates.

Rules are column builders over one wide record, whose context (consensus, duplicates) is joined before, so that a
whole review is one projection. A rule's status is PASS, WARNING or FAIL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.units import KB_EV, RT_K
from tessera.session import table

PASS, WARNING, FAIL = "PASS", "WARNING", "FAIL"


def _status(fail: Column | None = None, warning: Column | None = None) -> Column:
    out = F.when(F.coalesce(fail, F.lit(False)), FAIL) if fail is not None else None
    if warning is not None:
        w = F.coalesce(warning, F.lit(False))
        out = F.when(w, WARNING) if out is None else out.when(w, WARNING)
    return out.otherwise(PASS)


c = F.col
RULES: dict[str, Callable[[], Column]] = {
    "value_present": lambda: _status(fail=c("value").isNull()),
    "value_nonneg": lambda: _status(fail=c("value") < 0),
    "evidence": lambda: F.when((c("verdict") == "FOUND") & c("snippet"), F.when(c("located") != 0, PASS).otherwise(WARNING)).when((c("verdict") == "NOT_FOUND") | ~c("snippet"), FAIL).otherwise(WARNING),
    "page": lambda: _status(warning=c("page").isNull()),
    "units_normalized": lambda: _status(warning=c("issues") > 0),
    "family_range": lambda: _status(warning=~c("sigma").between(5e-4, 8e-3) | ~c("ea").between(0.02, 0.9)),
    "arrhenius": lambda: _status(fail=(c("sigma") > 0) & (c("ea") > 0) & ~(c("sigma") / F.exp(-c("ea") / (KB_EV * RT_K))).between(1e-3, 1e14)),
    "consensus": lambda: _status(fail=(c("n") >= 3) & (c("deviation") > 1.0), warning=c("deviation") > 0.7),
    "consensus_db": lambda: _status(warning=c("deviation") > 0.5),
    "duplicate": lambda: _status(warning=c("copies") > 1),
    "llm_confidence": lambda: _status(warning=c("confidence") < 0.5),
    "autoflag": lambda: _status(warning=c("flagged")),
    "formula_specificity": lambda: _status(fail=c("formula").rlike("M[0-9]?x")),
    "scope": lambda: _status(fail=F.lower("formula").rlike("liquid|electrode only")),
    "digit_match": lambda: _status(warning=~c("digit_match")),
    "dup_value": lambda: _status(warning=c("dup_value")),
    "verified_value_match": lambda: _status(warning=F.abs(c("located") - c("value")) > F.greatest(0.35 * F.abs("value"), F.lit(5e-5))),
}
#: Factor -> weight and its rules; value of each status.
FACTORS = {"evidence": (25.0, ("evidence",)), "physics": (18.0, ("arrhenius",)), "units": (9.0, ("units_normalized",)), "family": (9.0, ("family_range",)), "consensus": (10.0, ("consensus", "consensus_db")), "duplicate": (9.0, ("duplicate",)), "extraction": (8.0, ("llm_confidence",)), "page": (6.0, ("page",)), "digit_match": (5.0, ("digit_match",)), "dup_value": (5.0, ("dup_value",))}
SCALE = {PASS: 1.0, WARNING: 0.55, FAIL: 0.15}
APPROVE, REJECT, MISMATCH_CAP = 85.0, 55.0, 82.0
DISQUALIFIERS = ("evidence", "value_present", "value_nonneg", "arrhenius", "consensus", "formula_specificity", "scope")
CLEAR = ("family_range", "verified_value_match", "autoflag", "duplicate")


def evaluate(records: DataFrame) -> DataFrame:
    return records.withColumns({f"r_{n}": build() for n, build in RULES.items()})


def _scale(rule: str) -> Column:
    return F.when(c(f"r_{rule}") == PASS, SCALE[PASS]).when(c(f"r_{rule}") == WARNING, SCALE[WARNING]).otherwise(SCALE[FAIL])


def score() -> Column:
    """Worst rule of a factor times its weight; digit_match and dup_value weigh only where they were stamped."""
    total = F.lit(0.0)
    for name, (weight, rules) in FACTORS.items():
        worst = F.least(*map(_scale, rules)) if len(rules) > 1 else _scale(rules[0])
        part = weight * worst
        if name == "digit_match":
            part = F.when(c("digit_match").isNull(), 0.0).otherwise(part)
        if name == "dup_value":
            part = F.when(F.coalesce("dup_value", F.lit(False)), part).otherwise(0.0)
        total = total + part
    capped = F.when(c("r_verified_value_match") == WARNING, F.least(total, F.lit(MISMATCH_CAP))).otherwise(total)
    return F.round(F.least(capped, F.lit(100.0)) + 1e-9, 1)  # weights of halves: ties must not hang on the last bit


def decision() -> Column:
    """Disqualifiers first, then approval, then weak rejection, else a human."""
    any_of = lambda names, s: _any([c(f"r_{n}") == s for n in names])
    approve = ~any_of(RULES, FAIL) & (c("r_evidence") == PASS) & ~any_of(CLEAR, WARNING) & (c("score") >= APPROVE)
    weak = (c("score") < REJECT) & ((c("r_evidence") != PASS) | (c("r_llm_confidence") == WARNING) | (c("r_page") == WARNING))
    return F.when(any_of(DISQUALIFIERS, FAIL), "auto_reject").when(approve, "auto_approve").when(weak, "auto_reject").otherwise("human")


def _any(conditions: list[Column]) -> Column:
    out = conditions[0]
    for x in conditions[1:]:
        out = out | x
    return out


def review(records: DataFrame) -> DataFrame:
    return evaluate(records).withColumn("score", score()).withColumn("decision", decision())


def queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The review queue over lineitem: one record a row, its context joined."""
    li = table(spark, sf_dir, "lineitem")
    med = li.where("l_extendedprice > 0").groupBy(c("l_partkey").alias("material")).agg(F.median(F.log10("l_extendedprice")).alias("med"), F.count(F.lit(1)).alias("n"))
    copies = li.groupBy("l_partkey", "l_suppkey").agg(F.count(F.lit(1)).alias("copies"))
    j = li.join(med, li["l_partkey"] == med["material"]).join(copies, ["l_partkey", "l_suppkey"])
    kind = c("l_linenumber")
    return j.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "copies", "n",
        F.when(kind != 7, c("l_extendedprice")).alias("value"), (c("l_extendedprice") * 1e-7).alias("sigma"), (c("l_discount") * 10).alias("ea"),
        F.when(c("l_returnflag") == "A", "FOUND").when(c("l_tax") == 0, "NOT_FOUND").alias("verdict"), (c("l_discount") > 0).alias("snippet"),
        F.when(c("l_tax") > 0.06, 0.0).otherwise(c("l_extendedprice") * F.when(c("l_tax") > 0.05, 2).otherwise(1)).alias("located"), F.when(kind > 1, kind).alias("page"), F.when(c("l_linestatus") == "O", 1).otherwise(0).alias("issues"),
        F.abs(F.log10("l_extendedprice") - c("med")).alias("deviation"), (1 - c("l_tax") * 8).alias("confidence"), (c("l_quantity") > 48).alias("flagged"),
        F.concat(F.lit("Li"), F.when(c("l_quantity") == 13, F.lit("M1x")).otherwise(F.lit("2S"))).alias("formula"), F.when(c("l_linestatus") == "F", c("l_tax") < 0.04).alias("digit_match"), (c("copies") > 1).alias("dup_value"),
    )


def review_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each rule ends in each status."""
    rows = evaluate(queue(spark, sf_dir))
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), c(f"r_{n}").alias("status")) for n in RULES]))
    return rows.select(pairs.alias("p")).groupBy("p.rule", "p.status").agg(F.count(F.lit(1)).alias("n"))


def review_score_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review(queue(spark, sf_dir)).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "score", "decision")


def review_calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions against a human status: counts, and the share that the human would approve."""
    r = review(queue(spark, sf_dir)).withColumn("human", c("l_quantity") < 40)
    return r.groupBy("decision").agg(F.count(F.lit(1)).alias("n"), F.count_if("human").alias("approved"), F.round(F.avg(c("human").cast("int")), 6).alias("precision"), F.round(F.avg("score"), 6).alias("avg_score"))


def autoflag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pending rows with any finding: notes in order, joined."""
    rows = queue(spark, sf_dir).where("issues = 1")
    notes = F.array_compact(F.array(F.when(~c("sigma").between(5e-4, 8e-3), "range"), F.when(c("ea") > 0.9, "energy"), F.when((c("n") >= 3) & (c("deviation") > 0.8), "outlier")))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", F.array_join(notes, "; ").alias("notes")).where("notes <> ''")


def decisions_applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Update by key: decided items take their new status, all others keep theirs; counted by status."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    new = review(queue(spark, sf_dir)).groupBy(c("l_orderkey").alias("o_orderkey")).agg(F.max(F.when(c("decision") == "auto_approve", "A")).alias("approved"))
    return o.join(new, "o_orderkey", "left").groupBy(F.coalesce("approved", "o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("n"))


QUERIES = {f.__name__: f for f in (review_rules, review_score_decision, review_calibration, autoflag, decisions_applied)}

_Q = """with m as (select l_partkey, median(log10(l_extendedprice)) med, count(*) n from lineitem where l_extendedprice > 0 group by 1), k as (select l_partkey, l_suppkey, count(*) copies from lineitem group by 1, 2),
q as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, copies, n, case when l_linenumber <> 7 then l_extendedprice end as value, l_extendedprice * 1e-7 sigma, l_discount * 10 ea, case when l_returnflag = 'A' then 'FOUND' when l_tax = 0 then 'NOT_FOUND' end verdict, l_discount > 0 snippet,
case when l_tax > 0.06 then 0 else l_extendedprice * case when l_tax > 0.05 then 2 else 1 end end located, case when l_linenumber > 1 then l_linenumber end page, case when l_linestatus = 'O' then 1 else 0 end issues, abs(log10(l_extendedprice) - med) deviation, 1 - l_tax * 8 confidence, l_quantity > 48 flagged, 'Li' || case when l_quantity = 13 then 'M1x' else '2S' end formula, case when l_linestatus = 'F' then l_tax < 0.04 end digit_match, copies > 1 dup_value
from lineitem join m using (l_partkey) join k using (l_partkey, l_suppkey))"""
_w = lambda cond: f"case when coalesce({cond}, false) then 'WARNING' else 'PASS' end"
_f = lambda cond: f"case when coalesce({cond}, false) then 'FAIL' else 'PASS' end"
_RULES = {
    "value_present": _f("value is null"), "value_nonneg": _f("value < 0"),
    "evidence": "case when coalesce(verdict = 'FOUND', false) and snippet then case when located <> 0 then 'PASS' else 'WARNING' end when coalesce(verdict = 'NOT_FOUND', false) or not snippet then 'FAIL' else 'WARNING' end",
    "page": _w("page is null"), "units_normalized": _w("issues > 0"), "family_range": _w("not sigma between 5e-4 and 8e-3 or not ea between 0.02 and 0.9"),
    "arrhenius": _f("sigma > 0 and ea > 0 and not sigma / exp(-ea / (8.617333262e-5 * 298)) between 1e-3 and 1e14"),
    "consensus": "case when coalesce(n >= 3 and deviation > 1, false) then 'FAIL' when coalesce(deviation > 0.7, false) then 'WARNING' else 'PASS' end", "consensus_db": _w("deviation > 0.5"), "duplicate": _w("copies > 1"),
    "llm_confidence": _w("confidence < 0.5"), "autoflag": _w("flagged"), "formula_specificity": _f("regexp_matches(formula, 'M[0-9]?x')"), "scope": _f("regexp_matches(lower(formula), 'liquid|electrode only')"),
    "digit_match": _w("not digit_match"), "dup_value": _w("dup_value"), "verified_value_match": _w("abs(located - value) > greatest(0.35 * abs(value), 5e-5)"),
}
_R = f"{_Q}, r as (select *, {', '.join(f'{s} r_{n}' for n, s in _RULES.items())} from q)"
_v = lambda n: f"case r_{n} when 'PASS' then 1.0::double when 'WARNING' then 0.55::double else 0.15::double end"
_T = f"25 * {_v('evidence')} + 18 * {_v('arrhenius')} + 9 * {_v('units_normalized')} + 9 * {_v('family_range')} + 10 * least({_v('consensus')}, {_v('consensus_db')}) + 9 * {_v('duplicate')} + 8 * {_v('llm_confidence')} + 6 * {_v('page')} + case when digit_match is null then 0 else 5 * {_v('digit_match')} end + case when dup_value then 5 * {_v('dup_value')} else 0 end"
_D = f"{_R}, t as (select *, {_T} total from r), s as (select *, round(least(case when r_verified_value_match = 'WARNING' then least(total, 82) else total end, 100) + 1e-9, 1) score from t), d as (select *, case when {' or '.join(f'r_{n} = $$FAIL$$' for n in DISQUALIFIERS)} then 'auto_reject' when not ({' or '.join(f'r_{n} = $$FAIL$$' for n in RULES)}) and r_evidence = 'PASS' and not ({' or '.join(f'r_{n} = $$WARNING$$' for n in CLEAR)}) and score >= 85 then 'auto_approve' when score < 55 and (r_evidence <> 'PASS' or r_llm_confidence = 'WARNING' or r_page = 'WARNING') then 'auto_reject' else 'human' end decision from s)"
SQL = {
    "review_rules": f"{_R} " + " union all ".join(f"select '{n}' as rule, r_{n} status, count(*) n from r group by 2" for n in RULES),
    "review_score_decision": f"{_D} select l_orderkey, l_linenumber, l_partkey, l_suppkey, score, decision from d",
    "review_calibration": f"{_D} select decision, count(*) n, count(*) filter (l_quantity < 40) approved, round(avg((l_quantity < 40)::int), 6) as precision, round(avg(score), 6) avg_score from d group by 1",
    "autoflag": f"{_Q} select * from (select l_orderkey, l_linenumber, l_partkey, concat_ws('; ', case when not sigma between 5e-4 and 8e-3 then 'range' end, case when ea > 0.9 then 'energy' end, case when n >= 3 and deviation > 0.8 then 'outlier' end) notes from q where issues = 1) where notes <> ''",
    "decisions_applied": f"{_D}, n as (select l_orderkey, max(case when decision = 'auto_approve' then 'A' end) a from d group by 1) select coalesce(a, o_orderstatus) status, count(*) n from orders left join n on l_orderkey = o_orderkey group by 1",
}
