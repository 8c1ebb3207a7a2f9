"""URL filters: rules first, then gradient-boosted trees on lexical features, in DataFrame functions only.

A rule (host, path prefix, verdict) fits its host and all subdomains if the url's path starts with the rule's; the longest
rule decides. Where none fits, boosted trees (pyspark.ml's DataFrame API) judge lexical features: lengths, depth,
digit and sign ratios, entropy, parameters, and statistics of suffixes and first path segments, which are smoothed block rates in the
labelled urls. Labelled urls are a parameter (url, label: 1 is block); by default they are the table's own urls
that a rule decides.

The model learns from distinct urls, each with the label of most of its rows (block, if as many) and with its number of rows as weight: at most FIT_URLS of them, the first in
hash order. A fifth of them, by another hash, is held out from the trees and from the rates, and measures both (held_out). For the other four fifths a
row's rates come from the folds that it isn't in, so that no row's own label is among its features. The rule labels of this corpus
say how well the trees follow the rules on urls that they have not seen, not whether the rules are right.

Defined results: null urls and urls without :// have empty host and path; without labelled urls of both verdicts the
model gives the only verdict seen, else allow; rows that repeat a page_id are judged one by one, and labelled urls that repeat count
as one; other columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import let, small, table, written

RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))
FIT_URLS = 20_000
FOLDS = 5
#: Trees, depth, and the weight of the overall rate in a suffix's rate.
TREES, DEPTH, PRIOR = 10, 4, 5.0
FEATURES = ("url_length", "host_length", "path_length", "depth", "labels_in_host", "digit_ratio", "hyphens", "sign_ratio", "entropy", "parameters", "longest_label", "suffix_rate", "segment_rate")


def cut(rows: DataFrame) -> DataFrame:
    """rows with url (null as empty), host and path."""
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    after = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(after, "^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(after, "^[^/?#]*([^?#]*)", 1)
    return rows.withColumns({"url": url, "host": host, "path": path})


def rule_for(host: Column, path: Column, rules: tuple = RULES) -> Column:
    """The longest rule that fits as a struct of rule and verdict, or null."""
    ordered = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r))
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for h, p, verdict in reversed(ordered):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        found = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _suffix() -> Column:
    return F.substring_index("host", ".", -1)


def _segment() -> Column:
    return F.regexp_extract("path", "^/([^/]*)", 1)


def entropy(text: Column) -> Column:
    """Bits per character."""
    chars = lambda t: F.array_distinct(F.split(t, ""))
    share = lambda c: (F.length(text) - F.length(F.replace(text, c, F.lit("")))) / F.length(text)
    bits = lambda c: let(share(c), lambda p: F.when(p > 0, -p * F.log2(p)).otherwise(0.0))
    return F.when(F.length(text) == 0, 0.0).otherwise(F.aggregate(F.filter(chars(text), lambda c: c != ""), F.lit(0.0), lambda acc, c: acc + bits(c)))


def lexical(rows: DataFrame) -> DataFrame:
    url, host, path = F.col("url"), F.col("host"), F.col("path")
    long = F.greatest(F.length(url), F.lit(1))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    columns = {
        "url_length": F.length(url),
        "host_length": F.length(host),
        "path_length": F.length(path),
        "depth": F.size(F.filter(F.split(path, "/"), lambda x: x != "")),
        "labels_in_host": F.size(F.split(host, "[.]")),
        "digit_ratio": F.length(F.regexp_replace(url, "[^0-9]", "")) / long,
        "hyphens": F.length(host) - F.length(F.replace(host, F.lit("-"), F.lit(""))),
        "sign_ratio": F.length(F.regexp_replace(url, "[A-Za-z0-9]", "")) / long,
        "entropy": let(url, entropy),
        "parameters": F.when(query == "", 0).otherwise(F.size(F.split(query, "&"))),
        "longest_label": F.array_max(F.transform(F.split(host, "[.]"), F.length)),
    }
    return rows.withColumns({k: c.cast("double") for k, c in columns.items()} | {"suffix": _suffix(), "segment": _segment()})


def known_urls(labelled: DataFrame, fit_urls: int = FIT_URLS) -> DataFrame:
    """url, label, weight, fold of the distinct urls that the model knows."""
    known = labelled.where(F.col("label").isin(0, 1)).select(F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), F.col("label").cast("long").alias("label"))
    turn = F.xxhash64(F.lit("fit"), F.col("url"))
    # a sample by hash somewhat too large, so that few distinct urls are shuffled; then the first of it
    share = 1.5 * fit_urls / max(1, known.agg(F.approx_count_distinct("url")).head()[0])
    if share < 1:
        known = known.where(F.pmod(turn, F.lit(1 << 30)) < int(share * (1 << 30)))
    urls = known.groupBy("url").agg(F.count(F.lit(1)).alias("weight"), F.sum("label").alias("blocked"))
    first = urls.orderBy(F.pmod(turn, F.lit(1 << 30)), "url").limit(fit_urls)
    return first.select("url", (2 * F.col("blocked") >= F.col("weight")).cast("double").alias("label"), F.col("weight").cast("double").alias("weight"), F.pmod(F.xxhash64(F.lit("fold"), "url"), F.lit(FOLDS)).cast("int").alias("fold"))


class UrlModel:
    """Rates of suffixes and first segments, and the trees; one constant verdict if the labels hold less than two."""

    def __init__(self, labelled: DataFrame, fit_urls: int = FIT_URLS):
        """labelled: url and label, 1 for block."""
        self.known = written(lexical(cut(known_urls(labelled, fit_urls))), "urls")
        rows = self.known.where("fold > 0")
        n, blocked = rows.agg(F.coalesce(F.sum("weight"), F.lit(0.0)), F.coalesce(F.sum(F.col("label") * F.col("weight")), F.lit(0.0))).head()
        self.constant = None if 0 < blocked < n else float(blocked > 0)
        if self.constant is not None:
            return
        self.rate = blocked / n
        self.rates = {key: written(self._sums(rows, key), f"{key}-rates") for key in ("suffix", "segment")}
        train = rows
        for key in ("suffix", "segment"):
            own = self._sums(rows, key, "fold").select(key, "fold", F.col("n").alias("own_n"), F.col("blocked").alias("own_blocked"))
            train = train.join(small(self.rates[key]), key).join(small(own), [key, "fold"])
            train = train.withColumn(f"{key}_rate", self._rate(F.col("n") - F.col("own_n"), F.col("blocked") - F.col("own_blocked"))).drop("n", "blocked", "own_n", "own_blocked")
        train = self._assembled(train).select("features", "label", "weight").coalesce(4)
        self.trees = GBTClassifier(labelCol="label", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, maxBins=32, seed=1).fit(train)

    @staticmethod
    def _sums(rows: DataFrame, *keys: str) -> DataFrame:
        return rows.groupBy(*keys).agg(F.sum("weight").alias("n"), F.sum(F.col("label") * F.col("weight")).alias("blocked"))

    def _rate(self, n: Column, blocked: Column) -> Column:
        return (F.coalesce(blocked, F.lit(0.0)) + F.lit(PRIOR * self.rate)) / (F.coalesce(n, F.lit(0.0)) + F.lit(PRIOR))

    @staticmethod
    def _assembled(rows: DataFrame) -> DataFrame:
        return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)

    def _vectors(self, rows: DataFrame) -> DataFrame:
        """The rate tables come from at most fit_urls urls."""
        for key in ("suffix", "segment"):
            rows = rows.join(small(self.rates[key]), key, "left").withColumn(f"{key}_rate", self._rate(F.col("n"), F.col("blocked"))).drop("n", "blocked")
        return self._assembled(rows)

    def held_out(self) -> DataFrame:
        """n, accuracy and log_loss over the held-out labelled urls, and base_loss, the log loss of the training rate; one row."""
        rows = self.scored(self.known.where("fold = 0").select("url", "host", "path", "label"))
        p = F.least(F.greatest(F.col("block_score"), F.lit(1e-6)), F.lit(1 - 1e-6))
        loss = lambda q: -F.avg(F.col("label") * F.log(q) + (1 - F.col("label")) * F.log(1 - q))
        rate = F.lit(self.constant if self.constant is not None else self.rate)
        right = F.avg(((F.col("block_score") >= 0.5).cast("int") == F.col("label")).cast("double"))
        return rows.agg(F.count(F.lit(1)).alias("n"), right.alias("accuracy"), loss(p).alias("log_loss"), loss(F.least(F.greatest(rate, F.lit(1e-6)), F.lit(1 - 1e-6))).alias("base_loss"))

    def scored(self, rows: DataFrame) -> DataFrame:
        """rows (with url, host, path) with block_score, the probability of block."""
        if self.constant is not None:
            return rows.withColumn("block_score", F.lit(self.constant))
        judged = self.trees.transform(self._vectors(lexical(rows)))
        return judged.select(*rows.columns, vector_to_array("probability")[1].alias("block_score"))


def filter_urls(pages: DataFrame, rules: tuple = RULES, labelled: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, block_score."""
    rows = cut(pages.select(F.col("page_id").cast("long").alias("page_id"), "url")).withColumn("fit", rule_for(F.col("host"), F.col("path"), rules))
    if labelled is None:
        labelled = rows.where("fit is not null").select("url", (F.col("fit.verdict") == "block").cast("int").alias("label"))
    scored = UrlModel(labelled).scored(rows)
    verdict = F.coalesce(F.col("fit.verdict"), F.when(F.col("block_score") >= 0.5, "block").otherwise("allow"))
    return scored.select("page_id", "host", "path", F.col("fit.rule").alias("rule"), verdict.alias("verdict"), "block_score")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"))


QUERIES = {"op2_url_filter": op2_url_filter}
SQL: dict[str, str] = {}
