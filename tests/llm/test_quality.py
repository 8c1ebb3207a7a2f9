from __future__ import annotations

import collections
import math
import random
import re
import zlib

import numpy as np
import oracle
import pytest
from pyspark.sql import functions as F

from tessera.llm import quality_model as qm
from tessera.llm import quality_rules as qr


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    count, covered = collections.Counter(windows), set()
    for k, w in enumerate(windows):
        if count[w] > 1:
            covered.update(range(k, k + 8))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), len(words) < 20 or 100 * len(covered) > 30 * len(words)


def test_counts(spark, sf_dir):
    odd = [(-1, None), (-2, ""), (-3, "a b c d e f g h"), (-4, "a b c d e f g h i " * 2), (-5, "w " * 30), (-6, " \n\n x\n x\n é\xa0y\n"), (-7, "ab cd ef gh ij kl mn op qr st " * 3000), (-8, "  a\x0bb")]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in qr.measured(docs).collect()}
    assert all(got[r.doc_id] == brute(r.text) for r in docs.collect())


@pytest.mark.parametrize("n, k, p", [(100, 0, 0.05), (100, 2, 0.05), (2000, 10, 0.01), (50_000, 200, 0.005), (10, 9, 0.5), (0, 0, 0.1)])
def test_binomial(spark, n, k, p):
    got = spark.range(1).select(qr.binomial_at_most(F.lit(n).cast("long"), F.lit(k).cast("long"), p).alias("x")).head()["x"]
    exact = 1.0 if k >= n * p else sum(math.exp(math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) + j * math.log(p) + (n - j) * math.log1p(-p)) for j in range(k + 1))
    assert got == pytest.approx(exact, rel=1e-9)


def labelled(spark, n):
    clean = [(k, " ".join(f"word{k}x{j}" for j in range(40)), "en") for k in range(n)]
    junk = [(n + k, " ".join(f"w{k}x{j}***" for j in range(40)), "en") for k in range(50)]
    docs = spark.createDataFrame(clean + junk, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, int(k < n)) for k in range(n + 50)], "doc_id long, quality int")
    return docs, labels


def test_cutoffs_need_evidence(spark):
    docs, labels = labelled(spark, 3000)
    kept = {r.doc_id for r in qr.apply_quality_rules(docs, labels).collect()}
    assert kept == set(range(3000))
    docs, labels = labelled(spark, 100)  # too few good documents for any certificate
    assert qr.apply_quality_rules(docs, labels).count() == 150
    assert qr.apply_quality_rules(docs, labels.limit(0)).count() == 150
    assert qr.apply_quality_rules(docs.limit(0), labels).count() == 0


def test_stage_agrees_with_verdicts_and_judges_rows_without_ids(spark):
    docs, labels = labelled(spark, 3000)
    good, bad = " ".join(f"v{j}" for j in range(40)), " ".join(f"u{j}***" for j in range(40))
    odd = spark.createDataFrame([(None, good, "en"), (None, bad, "en"), (5, bad, "en"), (-1, bad, None), (-2, bad, "xx"), (-3, None, "en"), (-4, "short", "en")], docs.schema)
    docs = docs.unionByName(odd)
    rows = docs.withColumn("m", F.lit(1)).withColumn("a.b", F.lit(2))
    verdicts = qr.judged(qr.measured(docs), labels).groupBy("doc_id").agg(F.count_if("kept").alias("n")).where("n > 0").collect()
    got = qr.apply_quality_rules(rows, labels)
    assert got.columns == rows.columns
    assert collections.Counter(r.doc_id for r in got.collect()) == {r.doc_id: r.n for r in verdicts}


def test_model_learns_and_never_reads_the_held_out_third(spark):
    docs, labels = labelled(spark, 300)
    weights = qm.fit(docs, labels)
    flipped = labels.withColumn("quality", F.when(qm.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert qm.fit(docs, flipped) == weights
    scored = qm.score(docs.unionByName(spark.createDataFrame([(-1, None, None), (-2, "", None)], docs.schema)), weights).collect()
    assert all(0 <= r.score <= 1 for r in scored)
    held = [r for r in scored if r.doc_id >= 0 and zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert sum((r.score >= 0.5) == (r.doc_id < 300) for r in held) / len(held) >= 0.95


def test_model_without_labels(spark):
    docs, labels = labelled(spark, 5)
    assert {r.score for r in qm.score(docs, qm.fit(docs, labels.limit(0))).collect()} == {0.5}


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    rows = qm.score(docs, qm.fit(docs, labels)).join(labels, "doc_id").where(qm.held_out(F.col("doc_id"))).collect()
    assert sum((r.score >= 0.5) == (r.quality == 1) for r in rows) / len(rows) >= 0.95


def test_sql(spark, sf_dir):
    assert oracle.differences(qr.op9_quality_rules(spark, sf_dir), oracle.connect(sf_dir), qr.SQL["op9_quality_rules"]) == []


def test_levels_against_brute_force(spark):
    """Levels of random counts, and how often one with too high a rate is certified."""
    r = random.Random(5)
    rates = [0.0, 0.002, 0.01, qr.RISK, 0.03, 0.06]
    rows = []
    for t in range(600):
        n, over = r.randint(0, 900), []
        draws = [r.random() for _ in range(n)]
        for rate in rates:
            over.append(sum(d < rate for d in draws))
        rows.append((f"s{t}", n, over))
    counts = spark.createDataFrame(rows, "stratum string, n long, over array<long>")
    strata = max(1, sum(n >= math.log(qr.DELTA) / math.log(1 - qr.RISK) for _, n, _ in rows))

    def level(n, over, delta):
        for i, k in enumerate(over):
            if k >= n * qr.RISK or sum(math.comb(n, j) * qr.RISK**j * (1 - qr.RISK) ** (n - j) for j in range(k + 1)) > delta:
                return i - 1 if i else None
        return len(over) - 1

    got = {x.stratum: x.level for x in qr.certified_levels(counts).collect()}
    assert got == {s: level(n, over, qr.DELTA / strata) for s, n, over in rows}
    wrong = sum((v := level(n, over, qr.DELTA)) is not None and rates[v] >= qr.RISK for _, n, over in rows)
    assert wrong / len(rows) <= qr.DELTA


def test_three_hundred_labels_suffice(spark):
    docs, labels = labelled(spark, 300)
    assert {r.doc_id for r in qr.apply_quality_rules(docs, labels).collect()} == set(range(300))
    other = docs.withColumn("lang", F.lit("xx"))  # strata come from the data
    assert {r.stratum: r.n_good for r in qr.certified_cutoffs(qr.measured(docs.unionByName(other)), labels).collect()} == {"en": 300, "xx": 300}


def test_leader_against_brute_force(spark):
    """The same weights as per-coordinate FTRL-proximal over dictionaries, document by document."""
    docs, labels = labelled(spark, 40)
    rows = sorted(((r.turn, r.doc_id, r.label, r["at"], r["value"]) for r in qm.fitted_rows(docs, labels).collect()))
    assert 50 <= len(rows) <= 70 and all(zlib.crc32(str(d).encode()) % 3 != 1 for _, d, *_ in rows)
    z, n = collections.defaultdict(float), collections.defaultdict(float)

    def weight(k):
        return 0.0 if abs(z[k]) <= qm.L1 else -(z[k] - math.copysign(qm.L1, z[k])) / ((qm.BETA + math.sqrt(n[k])) / qm.ALPHA + qm.L2)

    for _ in range(30):
        for _, _, label, at, value in rows:
            x = dict(zip(np.frombuffer(at, np.uint32).tolist(), np.frombuffer(value, np.float32).tolist()))
            w = {k: weight(k) for k in x}
            p = 1 / (1 + math.exp(-sum(w[k] * v for k, v in x.items())))
            for k, v in x.items():
                g = (p - label) * v
                z[k] += g - (math.sqrt(n[k] + g * g) - math.sqrt(n[k])) / qm.ALPHA * w[k]
                n[k] += g * g
    got = np.frombuffer(qm.fit(docs, labels), np.float32)
    want = np.zeros(len(got))
    for k in z:
        want[k] = weight(k)
    assert np.abs(got - want).max() < 1e-5 and np.abs(want).max() > 0.1


def test_bounds_hold_on_repeated_keys(spark):
    docs, labels = labelled(spark, 60)
    hot = spark.createDataFrame([(0, f"copy {k} of one id", "en") for k in range(3000)], docs.schema)
    many = docs.unionByName(hot).withColumn("label", F.lit("x")).withColumn("turn", F.lit(1))
    twice = labels.unionByName(labels).unionByName(spark.createDataFrame([(3, 0), (None, 1), (10**9, 1)], labels.schema))
    rows = qm.fitted_rows(many, twice)
    ids = [r.doc_id for r in rows.collect()]
    assert len(ids) == len(set(ids)) and 3 not in ids and 0 in ids
    assert qm.fitted_rows(many, twice, fit_docs=20).count() == 20
    assert 1 <= qm.fitted_rows(many, twice, fit_bytes=3000).count() < 20
    scored = qm.score(many.limit(0), qm.fit(many, twice))
    assert scored.count() == 0 and qm.score(many, bytes(4 << qm.BITS)).count() == many.count()
    long = spark.createDataFrame([(1, "word " * 400_000)], "doc_id long, text string")
    assert qm.score(long, bytes(4 << qm.BITS)).head().score == 0.5
