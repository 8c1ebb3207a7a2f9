"""Whole results over small tables, against brute force: no row, term or text is left out."""

from __future__ import annotations

import random

import duckdb
import numpy as np
import pytest
from oracle import differences

from tessera.operators import agreement
from tessera.plans import registry

QUERIES = registry.queries()
LINE = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_discount double, l_tax double, l_returnflag string"


def line(order, number, part=1, supplier=1, quantity=10.0, discount=0.01, tax=0.02, flag="N"):
    return order, number, part, supplier, quantity, discount, tax, flag


def tables(spark, folder, **rows) -> str:
    """Writes name=(schema, rows) as the tables of a folder."""
    for name, (schema, data) in rows.items():
        spark.createDataFrame(data, schema).coalesce(1).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)


def found(df) -> list[tuple]:
    return sorted(map(tuple, df.collect()))


def test_sources_without_supplier_or_quantity(spark, tmp_path):
    rows = [line(1, 1, supplier=None), line(2, 1, supplier=None), line(3, 1, supplier=None, quantity=None), line(4, 1, quantity=None), line(4, 2, quantity=None)]
    got = QUERIES["provenance_best"](spark, tables(spark, tmp_path, lineitem=(LINE, rows)))
    assert found(got) == [(1, 1, 1, 2, 3.0), (2, 1, 1, 1, 3.0), (3, 1, 1, 1, 0.0), (4, 1, 1, 4, 3.5), (4, 2, 1, 4, 3.5)]


def test_unpivot_of_every_line(spark, tmp_path):
    sf = tables(spark, tmp_path, lineitem=(LINE, [line(1, 1), line(1, 2, discount=0.0), line(1, 7, tax=0.0, quantity=5.0)]))
    want = [(1, 1, "discount", 0.01), (1, 1, "quantity", 10.0), (1, 1, "tax", 0.02), (1, 2, "quantity", 10.0), (1, 2, "tax", 0.02), (1, 7, "discount", 0.01), (1, 7, "quantity", 5.0)]
    assert found(QUERIES["measurement_unpivot"](spark, sf)) == want


def test_sources_of_any_line(spark, tmp_path):
    # repeated order and line numbers, and whole repeated rows, occur in the tables
    rows = [line(k * 7 % 40, k % 7 + 1, part=k % 4, supplier=k * k % 23, quantity=float(k * 13 % 50)) for k in range(150)]
    rows += rows[:10] + [line(50, 3, part=9), line(51, 4, part=8), line(52, 5, part=8)]
    want = []
    for i, (o, n, p, s, q, *_) in enumerate(rows):
        other = [(3.0 * (abs(q - r[4]) <= 5) + 1.5 * (s == r[3]) + 2.0 * (s % 10 == r[3] % 10), -r[0]) for k, r in enumerate(rows) if k != i and r[2] == p]
        if other:
            points, m = max(other)
            want.append((o, n, p, -m, points))
    sf = tables(spark, tmp_path, lineitem=(LINE, rows))
    assert found(QUERIES["provenance_best"](spark, sf)) == sorted(want)


def test_components_of_every_shared_order(spark, tmp_path):
    rows = [line(1, 1, supplier=1), line(1, 2, supplier=2, quantity=50.0, discount=0.1), line(2, 1, supplier=2), line(2, 3, supplier=5), line(3, 1, supplier=3), line(3, 2, supplier=4), line(4, 1, supplier=6)]
    sf = tables(spark, tmp_path, lineitem=(LINE, rows), supplier=("s_suppkey long", [(k,) for k in range(1, 8)]))
    label = {k: k for k in range(1, 8)}
    for _ in label:
        for a in rows:
            for b in rows:
                if a[0] == b[0]:
                    label[a[3]] = label[b[3]] = min(label[a[3]], label[b[3]])
    got = QUERIES["component_split"](spark, sf).collect()
    assert {r["node"]: r["component"] for r in got} == label == {1: 1, 2: 1, 5: 1, 3: 3, 4: 3, 6: 6, 7: 7}
    splits = {(r["component"], r["split"]) for r in got}
    assert len(splits) == len(set(label.values()))


def test_priority_of_every_material(spark, tmp_path):
    rows = [line(1, 1, part=k) for k in range(1, 71)] + [line(2, 1, part=71, supplier=s) for s in range(40)]
    part = ("p_partkey long, p_size int", [(k, 50 if k % 2 else 10) for k in range(1, 72)])
    lines = (LINE + ", l_extendedprice double", [(*r, 100.0) for r in rows])
    got = [tuple(r) for r in QUERIES["consensus_priority"](spark, tables(spark, tmp_path, lineitem=lines, part=part)).collect()]
    assert got == [(k, 1, 39, True) for k in range(1, 71, 2)] + [(k, 1, 39, False) for k in range(2, 71, 2)]


def test_duplicates_of_every_record(spark, tmp_path):
    rows = [line(k, k % 7 + 1) for k in range(25)] + [line(30, 1, part=2), line(31, 1, part=3, flag=None), line(32, 2, part=3, flag=None)]
    got = QUERIES["duplicate_measurements"](spark, tables(spark, tmp_path, lineitem=(LINE, rows))).select("l_orderkey", "l_linenumber", "n")
    assert found(got) == [(k, k % 7 + 1, 25) for k in range(25)] + [(31, 1, 2), (32, 2, 2)]


def test_statistics_of_every_term(spark, tmp_path):
    sf = tables(spark, tmp_path, documents=("doc_id long, text string", [(k, "Common common") for k in range(120)] + [(200, "rare\tcommon"), (201, None), (202, " ")]))
    assert found(QUERIES["term_statistics"](spark, sf).select("term", "df", "tf")) == [("common", 121, 241), ("rare", 1, 1)]


def test_evidence_of_whole_texts(spark, tmp_path):
    short, long = "z" * 41, "a" * 40 + " and the rest of the longest text"
    orders = ("o_orderkey long, o_custkey long, o_orderstatus string", [(1, 1, "O"), (2, 2, "O"), (3, 3, "O"), (4, 1, "F")])
    talks = ("conv_id long, text string", [(1, short), (51, long), (2, "b" * 60), (52, "c" * 60), (2, None)])
    got = QUERIES["evidence_attach"](spark, tables(spark, tmp_path, orders=orders, conversations=talks)).collect()
    assert {r["o_orderkey"]: r["snippet"] for r in got} == {1: long, 2: "c" * 60, 3: None}


def test_agreement_percentiles_without_pairs(spark, tmp_path):
    """Odd prices and sizes against SQL, and two million pairs of one formula, of which few are made, against all of them."""
    r = random.Random(3)
    odd = [None, 0.0, 0.0, -5.0, -7.5, 1e-9, 3e15, float("nan"), float("inf")]
    rows = [(k, f"B{k % 3}", "T", r.choice([None, *range(-5, 60)]), r.choice(odd) if k % 9 == 0 else round(r.uniform(0.5, 90), r.choice([0, 2, 9]))) for k in range(400)] + [(None, "B1", "T", 1, 1.0)]
    path = str(tmp_path / "part.parquet")
    spark.createDataFrame(rows, "p_partkey long, p_brand string, p_type string, p_size int, p_retailprice double").coalesce(1).write.parquet(path)
    con = duckdb.connect()
    con.sql(f"create view part as select * from '{path}/*.parquet'")
    assert not differences(agreement.agreement_percentiles(spark, str(tmp_path)), con, agreement.SQL["agreement_percentiles"])

    values = np.random.default_rng(5).uniform(900, 2900, (2, 1500)).round(3)
    counts = spark.createDataFrame([("f", s + 1, float(v), 1) for s in (0, 1) for v in values[s]], "formula string, side int, v double, n long")
    a, b = values[0][:, None], values[1][None, :]
    want = np.sort(np.maximum(0, 1 - np.abs(a - b) / np.maximum(a, b) / 0.5).ravel())[::-1]
    ranks = [0, 1, 5000, 562_499, 1_124_999, 1_700_000, len(want) - 1]
    got = agreement.relative_agreement_at(counts, ranks, most=3000)
    assert [got[j] for j in ranks] == pytest.approx([want[j] for j in ranks], abs=1e-13)
