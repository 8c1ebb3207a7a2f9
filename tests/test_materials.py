"""Formula side, evidence and look-ups on rows that the tables don't hold."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tessera.functions import materials as mt
from tessera.operators import agreement as ag
from tessera.operators import builders as bd
from tessera.operators import evidence as ev
from tessera.operators import lookups as lk
from tessera.operators import normalization as nm
from tessera.operators import ranks as rk
from tessera.operators import retrieval as rt


def many(spark, rows, schema, column):
    return [r["x"] for r in spark.createDataFrame(rows, schema).select(column.alias("x")).collect()]


def test_sorted_formula(spark):
    rows = [("O2Na",), ("Cl0.5LiO",), ("ZzLi2",), ("LiOLi",), ("",), (None,)]
    assert many(spark, rows, "f string", mt.sorted_formula(F.col("f"))) == ["NaO2", "LiOCl0.5", "Li2Zz1", "Li2O", "", None]


def test_rule_families(spark):
    rows = {"PVDF-x": "polymer_composite", "Fe2O3": "unknown", "LiC2H4": "polymer_composite", "Na3PS4Br": "argyrodite", "K3OCl": "antiperovskite", "LiAlCl4": "halide", "NaBH4": "borohydride", "Li5La3Ta2O12": "garnet", "LiLaTiO": "perovskite", "LiSn2P3O12": "nasicon", "LiH": "hydride", "Li4SnS4": "sulfide", "Li2MnO3": "oxide", "Li2CO3": "unknown", "Li2O": "oxide"}
    assert many(spark, [(f,) for f in rows], "f string", mt.rule_family(F.col("f"))) == list(rows.values())


def test_roles_and_substitutions(spark):
    rows = [("Li3PS4", "li3ps4", "primary", False), ("Na3SbS4", "", "unknown", None), (None, "x", "unknown", None), ("Fe", "Li3PS4", "other", None)]
    got = many(spark, [r[:2] for r in rows], "a string, b string", mt.material_role(F.col("a"), F.col("b")))
    assert got == [r[2] for r in rows]
    subs = many(spark, [("Li6PS5Cl", "Li6PS5Br"), ("Li6PS5Cl", "Li6PS5Cl"), ("LiAlCl4", "Na3SbS4")], "a string, b string", mt.is_substitution(F.col("a"), F.col("b")))
    assert subs == [True, False, False]


def test_normal_composition(spark):
    assert many(spark, [("Li\u00b7 Cl \u2212x",), (None,)], "f string", mt.normal_composition(F.col("f"))) == ["LiCl-x", None]


def test_redox(spark):
    rows = [("LiFeO2", ["Li+", "Fe3+", "O2-"]), ("FeO", ["Fe2+", "Fe3+", "O2-"]), ("LiO", []), ("LiO", ["bad"])]
    got = many(spark, rows, "f string, s array<string>", mt.redox(F.col("f"), F.col("s")))
    assert [(r["mixed_valence"], r["electroneutral"]) for r in got] == [(False, True), (True, True), (False, None), (False, None)]
    assert got[0]["oxidation_range"] == 5.0 and got[2]["average_oxidation"] is None


def test_volumes(spark):
    rows = [(120.0, 6.0, "Li2O"), (None, 6.0, "Li2O"), (float("nan"), 6.0, "Li2O"), (120.0, 0.0, "Li2O"), (120.0, 6.0, "")]
    assert many(spark, rows, "v double, n double, f string", mt.volume_per_formula_unit(F.col("v"), F.col("n"), F.col("f"))) == [60.0, None, None, None, None]


def test_values_near_units(spark):
    rows = [("cycled 50 times, then 1.1 mS/cm at last", 1.0), ("1.1 cycles and nothing else at all that matters here", 1.0), ("conductivity 2.0 x 10-3 S cm", 2.1e-3), ("0.000 S/cm", 2.5e-6), ("9.9e-4 S/cm or 1.4e-3 S/cm", 1.4e-3), (None, 1.0), ("", 1.0)]
    got = many(spark, rows, "t string, v double", ev.value_near_unit(F.col("t"), F.col("v"), ev.SIGMA_CONTEXT))
    assert got[1] is None and got[3] is None and got[5] is None and got[6] is None
    assert [got[0], got[2], got[4]] == pytest.approx([1.1, 2e-3, 9.9e-4])


def test_table_rows(spark):
    md = "| m | v |\n| Li3PS4 | 1 |\n| NaCl | 2 |"
    rows = [(md, ["Li 3PS4"]), (md, ["Zr"]), (md, []), (None, ["Li"]), ("one", ["Li"])]
    assert many(spark, rows, "t string, f array<string>", ev.table_rows_of(F.col("t"), F.col("f"))) == ["| m | v |\n| Li3PS4 | 1 |", md, md, None, "one"]


def test_score_caps(spark):
    def scored(agreeing, models, different, literature):
        t = F.lit(True)
        score = ev.composite_score(t, t, F.lit(agreeing), F.lit(models), F.lit(different), t, F.lit(literature), t, t)
        return tuple(spark.range(1).select(score.alias("s"), ev.decision(score).alias("d")).head())

    assert scored(3, 3, False, "agree") == (96.2, "spot_check")
    assert scored(3, 3, True, "agree") == (82.0, "needs_review")
    assert scored(0, 0, False, "none") == (67.5, "reject")


def test_inverted_index_round_trip(spark):
    texts = ["a b a", "", "one", "x  y x"]
    assert many(spark, [(t,) for t in texts], "t string", bd.rebuilt_text(bd.inverted_index(F.split("t", " ")))) == texts


def test_near_runs_against_brute_force(spark):
    import random

    r = random.Random(2)
    points = [(r.randint(0, 3), r.uniform(-20, 20), r.uniform(-1, 1), r.randint(1, 3)) for _ in range(400)] + [(9, 1.0, 1.0, 1), (9, 1.0, 1.0, 1)]
    got = {tuple(x) for x in lk.near_runs(spark.createDataFrame(points, "k int, x double, y double, run int"), ["k"], "x", "y", "run", 1.5, 0.2).collect()}
    want = {p for p in points if any(q[0] == p[0] and q[3] != p[3] and abs(q[1] - p[1]) <= 1.5 and abs(q[2] - p[2]) <= 0.2 for q in points)}
    assert got == want


def test_two_tiers(spark):
    verified = spark.createDataFrame([("a", "d1", 0.001, 1, "r1"), ("a", "d1", 0.002, 2, "r2"), ("a", "d2", 0.001, 3, "r3"), ("b", "d9", None, 4, "r4")], "comp string, doi string, v double, ordinal int, row string")
    items = spark.createDataFrame([(1, "a", "d1", 9.0), (2, "a", "", 1e-3), (3, "a", "x", 5.0), (4, "b", "d9", None), (5, None, None, None)], "i int, comp string, doi string, v double")
    got = {r.i: r.hit for r in lk.two_tier(items, verified, ["comp", "doi"], "v", "comp").collect()}
    assert got == {1: "r2", 2: "r1", 3: None, 4: "r4", 5: None}


def test_schema_report_and_temperatures(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, `b.c` string")
    got = {(r.column, r.rows, r.nulls, r.refers_to) for r in bd.schema_report_of("t", df, {"a": "u"}).collect()}
    assert got == {("a", 2, 1, "u"), ("b.c", 2, 2, "")}
    rows = [(None, (20.0, 30.0, None, None, None, None)), (None, (None, None, 293.15, 303.15, None, None)), (7.0, None), (None, None)]
    c = bd.one_celsius(F.col("n"), F.col("s"))
    assert many(spark, rows, "n double, s struct<min_C:double,max_C:double,min_K:double,max_K:double,min:double,max:double>", c) == [25.0, pytest.approx(25.0), 7.0, None]


def test_frequencies(spark):
    rows = [("1 Hz - 7 MHz", (1.0, 7e6)), ("10–2 to 106 Hz", (1e-2, 1e6)), ("0.01 to 10⁶ Hz", (0.01, 1e6)), ("5 kHz", (5e3, None)), ("7 MHz (NMR)", None), ("no", None), (None, None)]
    got = many(spark, [(t,) for t, _ in rows], "t string", nm.frequency_range(F.col("t")))
    assert [tuple(r) if r else None for r in got] == [w for _, w in rows]


def brute_chunks(text, most, least):
    out, open_ = [], ""
    for p in (x.strip() for x in text.split("\n\n")):
        if not p:
            continue
        if "|" in p[:80] and len(p) > 60:
            out += [open_] * bool(open_) + [p]
            open_ = ""
        elif len(open_) + len(p) > most:
            out += [open_] * bool(open_)
            open_ = p
        else:
            open_ = f"{open_}\n\n{p}" if open_ else p
    return [c for c in out + [open_] * bool(open_) if len(c) >= least]


def test_chunks_against_brute_force(spark):
    import random

    r = random.Random(6)
    texts = ["\n\n".join(r.choice(["", " a b", "x" * r.randint(1, 60), "| c | " + "d" * 70, "é " * r.randint(1, 40)]) for _ in range(r.randint(0, 30))) for _ in range(40)] + ["", "y" * 5000]
    got = many(spark, [(t,) for t in texts], "t string", nm.paragraph_chunks(F.col("t"), 120, 15))
    assert got == [brute_chunks(t, 120, 15) for t in texts]


def test_prepass(spark):
    text = "Li3PS4 gave 3.2 x 10-4 S/cm; Na3SbS4 1.1e-3 S cm, and 5 S/cm"
    got, none, empty = many(spark, [(text,), (None,), ("",)], "t string", nm.regex_prepass(F.col("t")))
    assert [(c["composition"], c["sigma"]) for c in got] == [("Li3PS4", pytest.approx(3.2e-4)), ("Na3SbS4", pytest.approx(1.1e-3))] and none is None and empty == []


def test_flagged_fields_go(spark):
    rows = [({"a": "1", "b": "2"}, ["a=1", "=", "zz"]), ({"a": "1"}, None), (None, ["a=1"])]
    assert many(spark, rows, "m map<string,string>, s array<string>", nm.without_flagged(F.col("m"), F.col("s"))) == [{"b": "2"}, {"a": "1"}, None]


def test_quantiles_and_totals_against_brute_force(spark):
    import random

    import numpy as np

    r = random.Random(8)
    rows = [(k % 3, r.choice([r.uniform(-9, 9), 4.0, 4.0])) for k in range(2000)] + [(7, 1.0), (8, None), (9, 2.0), (9, 3.0)]
    got = {x.k: (x.n, x.q) for x in rk.exact_quantiles(spark.createDataFrame(rows, "k int, v double"), ["k"], "v", (0.0, 0.3, 0.5, 0.97, 1.0)).collect()}
    for k in {k for k, v in rows if v is not None}:
        own = [v for j, v in rows if j == k]
        assert got[k][0] == len(own) and got[k][1] == pytest.approx(list(np.quantile(own, (0.0, 0.3, 0.5, 0.97, 1.0))))
    assert 8 not in got
    totals = {x.v: x.until for x in rk.running_totals(spark.createDataFrame([(float(v), v % 5) for v in range(300)], "v double, n int"), "v", "n").collect()}
    assert totals == {float(v): sum(j % 5 for j in range(v + 1)) for v in range(300)}


def test_agreement_without_pairs(spark):
    import random

    r = random.Random(9)
    rows = [(r.choice("ab"), k, r.choice((1, 2)), float(r.randint(0, 40)), r.choice([10.0, 20.0, r.uniform(1, 60)])) for k in range(150)] + [("alone", 999, 1, 1.0, 1.0)]
    got = {x.key: (x.partners, x.score) for x in ag._mean_over_partners(spark.createDataFrame(rows, "formula string, key int, side int, size double, price double")).collect()}
    want = {}
    for f, k, s, z, p in rows:
        scores = [(max(0, 1 - abs(z - z2) / 20) + max(0, 1 - abs(p - p2) / max(p, p2) / 0.5)) / 2 for f2, _, s2, z2, p2 in rows if f2 == f and s2 != s]
        if scores:
            want[k] = (len(scores), pytest.approx(sum(scores) / len(scores), abs=1e-9))
    assert got == want


def test_places_near_mentions(spark):
    rows = [("v m v", "v", "m", 1), ("v  m v", "v", "m", 6), ("m xx vv", "vv", "m", 6), ("a v", "v", "m", 3), ("a", "v", "m", None), ("", "v", "m", None), (None, "v", "m", None), ("vmv é v", "v", "é", 3)]
    got = many(spark, [r[:3] for r in rows], "t string, v string, m string", rt.nearest_place(F.col("t"), F.col("v"), F.col("m")))
    assert got == [r[3] for r in rows]
    w = many(spark, [("One. Two 5 three. Four 5.", "5", "three"), ("none", "5", "x")], "t string, v string, m string", rt.evidence_window(F.col("t"), F.col("v"), F.col("m"), 6))
    assert (w[0]["start"], w[0]["window"], w[1]) == (10, ". Two 5 three", None)
