from __future__ import annotations

import math

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions import formula as fm
from tessera.functions import units as un
from tessera.functions.columns import condition_fingerprint, md5_bucket, populated, split_of, stable_id
from tessera.operators.consensus import agreement_grade
from tessera.operators.quality import negative_signals


def one(spark, column):
    return spark.range(1).select(column.alias("x")).head()["x"]


SPELLINGS = {"S/cm": 0, "S cm-1": 0, "S\u00b7cm\u207b\u00b9": 0, "S cm^-1": 0, "S/m": -2, "S m-1": -2, "ohm-1 cm-1": 0, "\u03a9\u207b\u00b9cm\u207b\u00b9": 0}
DECADES = {"": 0, "m": -3, "milli": -3, "u": -6, "\u00b5": -6, "micro": -6, "n": -9, "nano": -9}


def test_sigma_units_are_prefix_times_base(spark):
    """Every prefix before every spelling multiplies by its power of ten, whatever the value."""
    rows = [(f"{v}", f"{p}{u}", v * 10.0 ** (d + e)) for v in (1.75, 62.0) for p, d in DECADES.items() for u, e in SPELLINGS.items()]
    df = spark.createDataFrame(rows, "value string, unit string, want double")
    got = df.select("unit", "want", un.normalize_sigma(F.col("value"), F.col("unit")).alias("n")).collect()
    assert all(r.n["value"] == pytest.approx(r.want, rel=1e-9) and r.n["note"] == "" and not r.n["is_log"] for r in got)


def test_sigma_without_a_known_unit(spark):
    rows = [("17", None, 17.0, "no unit"), ("17", "counts", 17.0, "unit not recognised"), ("-2.5", "log10(S/cm)", 10**-2.5, "log-form"), ("n/a", "S/cm", None, "unparseable"), ("6,25", "S/cm", 6.25, ""), ("3 x 10-2", "S/m", 3e-4, ""), ("2\u00d710\u22125", "S/cm", 2e-5, "")]
    df = spark.createDataFrame(rows, "value string, unit string, want double, note string")
    for r in df.select("want", "note", un.normalize_sigma(F.col("value"), F.col("unit")).alias("n")).collect():
        assert r.n["note"] == r.note and (r.n["value"] == pytest.approx(r.want) if r.want is not None else r.n["value"] is None)


@pytest.mark.parametrize("unit, per_ev", [("kJ/mol", un.KJ_PER_EV), ("kcal/mol", un.KCAL_PER_EV), ("meV", 1000.0), ("eV", 1.0)])
def test_energies_round_trip(spark, unit, per_ev):
    assert one(spark, un.normalize_ea(F.lit(str(0.47 * per_ev)), F.lit(unit))) == pytest.approx(0.47)


def test_energy_and_temperature(spark):
    assert one(spark, un.normalize_ea(F.lit("1"), F.lit("furlong"))) is None
    assert one(spark, un.normalize_temperature(F.lit("310.15"), F.lit("K"))) == pytest.approx(37.0)


def test_arrhenius_bounds(spark):
    """A pair is plausible while its prefactor is within the tolerance of 1, both ways."""
    for kelvin in (250.0, 420.0):
        for prefactor, ok in ((1e-7, False), (1e-5, True), (1.0, True), (1e5, True), (1e7, False)):
            sigma = prefactor * math.exp(-0.41 / (un.KB_EV * kelvin))
            assert one(spark, un.arrhenius_plausible(F.lit(sigma), F.lit(0.41), F.lit(kelvin), tolerance=1e6)) is ok
    assert one(spark, un.arrhenius_plausible(F.lit(0.0), F.lit(0.41), F.lit(300.0))) is False
    assert one(spark, un.arrhenius_plausible(F.lit(None).cast("double"), F.lit(0.41), F.lit(300.0))) is True


def test_negative_signals_are_three_valued(spark):
    """One signal is enough for true; without any value nothing is known; false needs a value."""
    cases = [((0.0, False, 5.1, 2.0), False), ((0.5, False, 5.1, 2.0), True), ((None, None, None, 9.0), True), ((None, None, None, None), None), ((None, True, None, None), True)]
    for (e, m, g, h), want in cases:
        row = one(spark, negative_signals(F.lit(e).cast("double"), F.lit(m).cast("boolean"), F.lit(g).cast("double"), F.lit(h).cast("double")))
        assert row["is_negative"] is want and bool(row["reasons"]) is bool(want)


def test_ids(spark):
    a = stable_id("exp", F.lit("x"), F.lit(None))
    assert one(spark, a) == one(spark, stable_id("exp", F.lit("x"), F.lit("")))
    assert one(spark, a).startswith("exp-") and len(one(spark, a)) == 20
    assert one(spark, condition_fingerprint(a=F.lit("1"), b=F.lit("unknown"), c=F.lit("z"))) == "a=1|c=z"
    assert one(spark, populated(F.lit(" NaN "))) is False


@pytest.mark.parametrize("key, bucket", [("Li7La3Zr2O12", 298), ("unknown", 106), ("::Li2O", 512)])
def test_buckets(spark, key, bucket):
    assert one(spark, md5_bucket(F.lit(key))) == bucket
    assert one(spark, split_of(md5_bucket(F.lit(key)))) == ("test" if bucket < 300 else "train")


@pytest.mark.parametrize("n, deviation, want", [(0, 0.0, ""), (5, 0.19, "A+"), (5, 0.21, "A"), (5, 0.6, "B"), (2, 0.1, "B"), (2, 0.9, "C"), (1, 3.0, "C"), (4, 1.1, "D")])
def test_grades(spark, n, deviation, want):
    assert one(spark, agreement_grade(F.lit(n), F.lit(deviation))) == want


@pytest.mark.parametrize("text, want", [("Li14La6Zr4O24", "La3Li7O12Zr2"), ("Li2(OH)2", "HLiO"), ("Ca(OH)2", "CaH2O2"), ("x y", "xy"), (")", ")"), (None, None)])
def test_reduce(text, want):
    assert fm.reduce_formula(text) == want


@given(st.dictionaries(st.sampled_from(["Li", "O", "P", "S", "Cl"]), st.integers(1, 9), min_size=1), st.integers(1, 5))
def test_reduction_ignores_multiples(counts, k):
    spell = lambda m: "".join(f"{e}{n * m}" for e, n in counts.items())
    assert fm.reduce_formula(spell(1)) == fm.reduce_formula(spell(k))
