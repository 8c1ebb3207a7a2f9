"""Quality rules with risk-controlled cutoffs, in DataFrame functions only.

Words are runs of non-blank characters. Base rules reject texts of under 20 words and texts of which
over 30 % of the words stand in 8-word windows that occur twice or more. The method judges four more
ratios (RULES), by stratum (the document's language, whatever values it has). Level i of the ladder holds the i-th cutoff of
every rule; levels are fixed beforehand and tighten from the first to the last, so that what a level rejects the next
rejects too. Labelled documents of quality 1 that pass the base rules are the holdout: of n of them in a stratum a level
rejects k by any rule. A level is certified if the exact binomial test rejects "the false rejection
rate is RISK or more", that is if P(Bin(n, RISK) <= k) <= DELTA / strata, and every level before it is certified:
tests in a fixed sequence need no correction among them (the first true hypothesis in the sequence is rejected with at
most that probability, and nothing after it is reached otherwise). Strata are corrected by Bonferroni; strata with too
few holdout documents for any certificate aren't counted, since their number doesn't depend on what the rules do.
The last certified level holds; a stratum without one rejects nothing beyond the base rules. So with probability
1 - DELTA no stratum loses RISK of its good documents or more to the four rules. Base rules are given; what they reject isn't certified.

Defined results: null and empty texts have no words and fail the base rules; a null language
is stratum ""; labels of unknown documents, null labels and repeated labels of a document are
ignored or count once for each; rows that repeat a doc_id are judged one by one, and of a labelled one every row is in the holdout;
without labels only the base rules hold; other columns are ignored.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import columns_of, let, small, table, written

BLANK = r"\x20\x09-\x0D"
#: Rule -> its cutoff at every level of the ladder; a document over the cutoff is rejected.
RULES = {
    "symbol_ratio": (2.0, 1.0, 0.7, 0.5, 0.4, 0.3, 0.2, 0.1, 0.1, 0.1, 0.05, 0.05),
    "long_words": (25.0, 25.0, 20.0, 20.0, 15.0, 15.0, 12.0, 12.0, 10.0, 10.0, 9.0, 9.0),
    "repeat_ratio": (0.3, 0.3, 0.3, 0.3, 0.3, 0.3, 0.3, 0.3, 0.25, 0.2, 0.2, 0.15),
    "dup_line_ratio": (0.7, 0.7, 0.7, 0.7, 0.6, 0.6, 0.6, 0.5, 0.5, 0.4, 0.4, 0.35),
}
RISK = 0.02
DELTA = 0.05
WINDOW = 8


def _covered(words: Column) -> Column:
    """Words in windows that occur twice or more; windows are compared as texts, in sorted order."""
    at = F.sequence(F.lit(1), F.size(words) - (WINDOW - 1))
    windows = F.array_sort(F.transform(at, lambda i: F.struct(F.concat_ws(" ", F.slice(words, i, WINDOW)).alias("k"), i.alias("i"))))

    def starts(s: Column) -> Column:
        same = lambda j, k: s[j]["k"] == s[k]["k"]
        last = F.size(s) - 1
        twice = F.filter(F.sequence(F.lit(0), last), lambda j: ((j > 0) & same(F.greatest(j - 1, F.lit(0)), j)) | ((j < last) & same(F.least(j + 1, last), j)))
        return F.array_sort(F.transform(twice, lambda j: s[j]["i"]))

    first = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("at"))
    step = lambda acc, i: F.struct((acc["n"] + F.least(F.lit(WINDOW), i - acc["at"])).alias("n"), i.alias("at"))
    return let(windows, lambda s: F.aggregate(starts(s), first, step, lambda acc: acc["n"]))


def _repeat_words(words: Column) -> Column:
    """Hashes of the windows tell whether any occurs twice; only then are texts compared."""
    hashes = F.transform(F.sequence(F.lit(1), F.size(words) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(words, i, WINDOW)))
    twice = let(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))
    return F.when(F.size(words) <= WINDOW, F.lit(0).cast("long")).when(twice, _covered(words)).otherwise(F.lit(0).cast("long"))


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def _stratum(docs: DataFrame) -> Column:
    return F.coalesce(F.col("lang").cast("string"), F.lit("")) if "lang" in docs.columns else F.lit("")


def counts(text: Column) -> Column:
    """A struct of the counts of a whole text."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{BLANK}]"))
    line_counts = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup")))

    def of(words: Column, on_lines: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
            F.char_length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
            on_lines["dup"].alias("n_dup_lines"),
            _repeat_words(words).alias("n_repeat_words"),
            on_lines["n"].alias("n_lines"),
        )

    return let(F.regexp_extract_all(text, F.lit(f"([^{BLANK}]+)")), lambda words: let(line_counts, lambda x: of(words, x)))


def ratios(m: Column) -> dict[str, Column]:
    """What the rules judge, of a struct of counts."""
    return {
        "symbol_ratio": _ratio(m["n_symbols"], m["n_words"]),
        "dup_line_ratio": _ratio(m["n_dup_lines"], m["n_lines"]),
        "repeat_ratio": _ratio(m["n_repeat_words"], m["n_words"]),
        "long_words": _ratio(m["word_chars"], m["n_words"]),
    }


def fails_base(m: Column) -> Column:
    return (m["n_words"] < 20) | (100 * m["n_repeat_words"] > 30 * m["n_words"])


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, stratum, counts and ratios of every whole text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _stratum(docs).alias("stratum"), counts(F.col("text")).alias("m"))
    m = F.col("m")
    return rows.select("doc_id", "stratum", "m.*", *[c.alias(k) for k, c in ratios(m).items()], fails_base(m).alias("base_failed"))


def binomial_at_most(n: Column, k: Column, p: float) -> Column:
    """P(Bin(n, p) <= k), summed in logarithms; 1 where k >= n p, which no test here needs more exactly."""
    nn = n.cast("double")
    odds = math.log(p / (1 - p))
    first = let(nn * math.log1p(-p), lambda t: F.struct(t.alias("term"), t.alias("total")))

    def step(acc: Column, j: Column) -> Column:
        term = acc["term"] + F.log((nn - j + 1) / j) + odds
        return let(term, lambda t: F.struct(t.alias("term"), (F.greatest(t, acc["total"]) + F.log1p(F.exp(-F.abs(t - acc["total"])))).alias("total")))

    summed = F.aggregate(F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<long>")), first, step, lambda acc: F.exp(acc["total"]))
    return F.when(k >= nn * p, F.lit(1.0)).otherwise(summed)


def holdout_counts(measures: DataFrame, labels: DataFrame, rules: dict[str, tuple] = RULES) -> DataFrame:
    """stratum, n (holdout documents) and over, the number that each level rejects. Counts are summed where the rows lie."""
    good = labels.where("quality = 1").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    rows = measures.where(~F.col("base_failed")).join(small(good), "doc_id", "left_semi")
    levels = range(len(next(iter(rules.values()))))
    over = [F.count_if(reduce(Column.__or__, [F.col(r) > grid[k] for r, grid in rules.items()])) for k in levels]
    return rows.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), F.array(*over).alias("over"))


def certified_levels(counts: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """counts with level, the last certified one (from 0), null where there is none."""
    least = math.log(delta) / math.log1p(-risk)
    strata = counts.agg(F.greatest(F.count_if(F.col("n") >= least), F.lit(1)).alias("strata"))  # a row
    tested = counts.crossJoin(F.broadcast(strata))
    passed = F.transform("over", lambda k: binomial_at_most(F.col("n"), k, risk) <= F.lit(delta) / F.col("strata"))
    run = F.array_position(F.concat(passed, F.array(F.lit(False))), False)
    return tested.withColumn("level", F.when(run > 1, (run - 2).cast("int"))).drop("strata")


def certified_cutoffs(measures: DataFrame, labels: DataFrame, rules: dict[str, tuple] = RULES, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """A row per stratum with good labels: n_good, level, and the cutoff of each rule at that level, null where no level is certified."""
    found = certified_levels(holdout_counts(measures, labels, rules), risk, delta)
    cutoffs = [F.get(F.array(*map(F.lit, grid)), F.col("level")).alias(f"{r}_cutoff") for r, grid in rules.items()]
    return found.select("stratum", F.col("n").alias("n_good"), "level", *cutoffs)


def judged(measures: DataFrame, labels: DataFrame, rules: dict[str, tuple] = RULES, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """measures with base_failed, failed_rules and kept."""
    cutoffs = written(certified_cutoffs(measures, labels, rules, risk, delta), "cutoffs")
    rows = measures.join(small(cutoffs), "stratum", "left")
    failed = F.array_compact(F.array(*[F.when(F.col(r) > F.col(f"{r}_cutoff"), F.lit(r)) for r in rules]))
    return rows.withColumn("failed_rules", F.array_join(failed, ",")).withColumn("kept", ~F.col("base_failed") & (F.size(failed) == 0))


def apply_quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without the rejected, row by row: a filter in the scan, so no text is shuffled while the strata are few enough to broadcast. Only labelled documents are measured for the cutoffs."""
    good = labels.where("quality = 1").select(F.col("doc_id").cast("long").alias("good_id")).distinct()
    own = docs.select("doc_id", "text", _stratum(docs).alias("lang"))
    fitted = own.join(small(good), F.col("doc_id") == F.col("good_id"), "left_semi")
    # written, else the filter on base_failed would be pushed below and count every text several times
    cutoffs = written(certified_cutoffs(written(measured(fitted), "measures"), labels).where("level is not null"), "cutoffs")
    limits = cutoffs.select(F.col("stratum"), F.struct(*[F.col(f"{r}_cutoff").alias(r) for r in RULES]).alias("limits"))
    rows = docs.select(F.struct(*columns_of(docs)).alias("row"), _stratum(docs).alias("stratum"), F.col("text").alias("text")).join(small(limits), "stratum", "left")

    def keeps(m: Column) -> Column:
        over = [F.coalesce(c > F.col("limits")[rule], F.lit(False)) for rule, c in ratios(m).items()]
        return ~fails_base(m) & ~F.array_contains(F.array(*over), True)

    return rows.where(let(counts(F.col("text")), keeps)).select("row.*")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    measures = written(measured(table(spark, sf_dir, "documents")), "measures")
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "stratum", "failed_rules")
    return judged(measures, table(spark, sf_dir, "labels")).select(*columns)


def _sql() -> str:
    levels = range(len(next(iter(RULES.values()))))
    over = ",\n        ".join(f"count(*) filter (where {' or '.join(f'{r} > {grid[k]}' for r, grid in RULES.items())}) as k{k}" for k in levels)
    tests = ",\n        ".join(f"case when k{k} >= n * {RISK} then false else list_sum(list_transform(range(k{k} + 1), lambda j: exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln({RISK}) + (n - j) * ln(1 - {RISK})))) <= {DELTA} / strata end as p{k}" for k in levels)
    passed = " + ".join(" * ".join(f"p{j}::INT" for j in range(k + 1)) for k in levels)
    failed = ", ".join(f"case when {r} > {list(grid)}[level] then '{r}' end" for r, grid in RULES.items())
    return f"""
    with split as (
      select row_number() over () as r, doc_id, coalesce(lang, '') as stratum, coalesce(text, '') as text,
        regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as words,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as lines
      from documents),
    places as (select r, unnest(range(1, greatest(len(words) - 6, 1))) as i, words from split where len(words) >= 8),
    windows as (select r, i, array_to_string(words[i:i + 7], ' ') as w from places),
    twice as (select r, i from (select r, i, count(*) over (partition by r, w) as c from windows) where c > 1),
    covered as (select r, count(distinct i + o) as n from twice, (select unnest(range(8)) as o) group by r),
    counted as (
      select split.r, doc_id, stratum, len(words)::BIGINT as n_words, length(array_to_string(words, ''))::BIGINT as word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT as n_symbols,
        (len(lines) - len(list_distinct(lines)))::BIGINT as n_dup_lines, len(lines) as n_lines, coalesce(covered.n, 0)::BIGINT as n_repeat_words
      from split left join covered using (r)),
    measured as (
      select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
        coalesce(n_symbols / nullif(n_words, 0), 0) as symbol_ratio, coalesce(n_dup_lines / nullif(n_lines, 0), 0) as dup_line_ratio,
        coalesce(n_repeat_words / nullif(n_words, 0), 0) as repeat_ratio, coalesce(word_chars / nullif(n_words, 0), 0) as long_words
      from counted),
    holdout as (
      select stratum, count(*) as n,
        {over}
      from measured where not base_failed and doc_id in (select doc_id from labels where quality = 1) group by stratum),
    tested as (
      select stratum,
        {tests}
      from holdout, (select greatest(count(*) filter (where n >= ln({DELTA}) / ln(1 - {RISK})), 1) as strata from holdout)),
    certified as (select stratum, {passed} as level from tested),
    judged as (
      select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, measured.stratum,
        coalesce(array_to_string(list_filter([{failed}], lambda x: x is not null), ','), '') as failed_rules
      from measured left join (select * from certified where level > 0) using (stratum))
    select *, not base_failed and failed_rules = '' as kept from judged"""


QUERIES = {"op9_quality_rules": op9_quality_rules}
SQL: dict[str, str] = {"op9_quality_rules": _sql()}
