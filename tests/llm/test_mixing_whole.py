"""Sources without any token stay in the mixture."""

from __future__ import annotations

from collections import Counter

from tessera.llm import mixing as mx


def test_source_without_tokens(spark):
    rows = [(k, "word " * (k % 5 + 1), "text") for k in range(300)] + [(300 + k, (None, "", " \n")[k % 3], "blank") for k in range(600)] + [(900, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = mx.Plan(docs)
    placed = Counter((r["doc_id"], r["epoch"]) for r in mx.schedule(docs, plan).collect())
    assert {k: n for k, n in placed.items() if k[0] >= 300} == {(k, 0): 1 for k in range(300, 901)}
    assert {k[0] for k in placed} == set(range(901))
    alone = Counter((r["doc_id"], r["epoch"]) for r in mx.schedule(docs.where("source = 'text'")).collect())
    assert {k: n for k, n in placed.items() if k[0] < 300} == alone
    got = Counter(r["doc_id"] for r in mx.mix(docs).where("doc_id >= 300").collect())
    assert got == {k: 1 for k in range(300, 901)}
