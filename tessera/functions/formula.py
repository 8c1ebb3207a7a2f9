"""Chemical formulas: element counts, canonical keys, ordered family patterns, charge balance, reduction."""

from __future__ import annotations

import math
import re
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Family patterns in order of precedence.
FAMILY_PATTERNS = (
    ("argyrodite", r"Li6PS5"),
    ("lgps", r"Li[0-9]+GeP"),
    ("garnet", r"Li[^A-Z]*La[^A-Z]*Zr"),
    ("llzo", r"Li7La3Zr2O12"),
    ("llto", r"Li[^A-Z]*La[^A-Z]*TiO"),
    ("perovskite", r"Li[^A-Z]*La[^A-Z]*TiO"),
    ("nasicon", r"(?:Li|Na)[^A-Z]*(?:Zr|Ti|Ge)[^Z]*P[^Z]*O"),
    ("lagp", r"Li[^A-Z]*Al[^A-Z]*Ge[^Z]*P"),
    ("latp", r"Li[^A-Z]*Al[^A-Z]*Ti[^Z]*P"),
    ("halide", r"Li[^A-Z]*(?:Y|Sc|In|Er)[A-Za-z]*Cl"),
    ("sulfide", r"Li[^A-Z]*[PS]"),
    ("polymer", r"PEO|polyethylene|polypropylene|PVDF|PVDF-HFP|PMMA|PAN"),
    ("oxide", r"Li[^A-Z]*O"),
)
#: Usual oxidation states.
OXIDATION = {"Li": 1, "Na": 1, "K": 1, "Mg": 2, "Ca": 2, "Sr": 2, "Ba": 2, "La": 3, "Zr": 4, "Ti": 4, "Ta": 5, "Nb": 5, "Al": 3, "Ga": 3, "In": 3, "Ge": 4, "Sn": 4, "P": 5, "As": 5, "Sb": 5, "S": -2, "Se": -2, "Te": -2, "O": -2, "F": -1, "Cl": -1, "Br": -1, "I": -1, "N": -3}
PART = r"([A-Z][a-z]?)([0-9.]*)"


def elements(formula: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(formula, F.lit("([A-Z][a-z]?)"), F.lit(1)))


def element_counts(formula: Column) -> Column:
    """array of (element, count) in order of appearance; brackets are dropped without their factor, counts are 1 by default."""
    clean = F.regexp_replace(formula, r"[(){}]", "")
    names = F.regexp_extract_all(clean, F.lit(PART), F.lit(1))
    counts = F.regexp_extract_all(clean, F.lit(PART), F.lit(2))
    return F.zip_with(names, counts, lambda e, n: F.struct(e.alias("element"), F.coalesce(F.when(n != "", n.try_cast("double")), F.lit(1.0)).alias("n")))


def canonical_key(formula: Column) -> Column:
    parts = element_counts(F.regexp_replace(formula, r"[^A-Za-z0-9.]", ""))
    return F.array_join(F.array_sort(F.transform(parts, lambda x: F.concat(x["element"], F.format_string("%.4f", x["n"])))), "")


def classify_family(formula: Column) -> Column:
    out = F.lit("unknown")
    for name, pattern in reversed(FAMILY_PATTERNS):
        out = F.when(formula.rlike(f"(?i){pattern}"), name).otherwise(out)
    return out


def net_charge(formula: Column) -> Column:
    states = F.create_map(*[F.lit(x) for pair in OXIDATION.items() for x in (pair[0], float(pair[1]))])
    return F.aggregate(element_counts(formula), F.lit(0.0), lambda acc, x: acc + F.coalesce(F.try_element_at(states, x["element"]), F.lit(0.0)) * x["n"])


def cosine(a: Column, b: Column) -> Column:
    """Of two maps of element counts; 0 where one is empty."""
    dot = F.aggregate(F.map_keys(a), F.lit(0.0), lambda acc, k: acc + F.try_element_at(a, k) * F.coalesce(F.try_element_at(b, k), F.lit(0.0)))
    norm = lambda m: F.sqrt(F.aggregate(F.map_values(m), F.lit(0.0), lambda acc, v: acc + v * v))
    return F.coalesce(F.try_divide(dot, norm(a) * norm(b)), F.lit(0.0))


def parse_nested(formula: str) -> dict[str, float]:
    """Counts with brackets and their factors; empty for what isn't a formula."""
    stack: list[dict[str, float]] = [{}]
    pos = 0
    token = re.compile(r"([A-Z][a-z]?)([0-9]*\.?[0-9]*)|([(\[{])|[)\]}]([0-9]*\.?[0-9]*)")
    while pos < len(formula):
        m = token.match(formula, pos)
        if not m or m.end() == pos:
            return {}
        if m[1]:
            stack[-1][m[1]] = stack[-1].get(m[1], 0.0) + float(m[2] or 1)
        elif m[3]:
            stack.append({})
        else:
            if len(stack) == 1:
                return {}
            inner, factor = stack.pop(), float(m[4] or 1)
            for e, n in inner.items():
                stack[-1][e] = stack[-1].get(e, 0.0) + n * factor
        pos = m.end()
    return stack[0] if len(stack) == 1 else {}


def reduce_formula(formula: str | None) -> str | None:
    """Counts over their greatest common divisor, elements in alphabetic order; other text without blanks."""
    if formula is None:
        return None
    text = re.sub(r"\s+", "", formula)
    inner = re.search(r"(?:-type|-based|-like)\s*\(([^)]*)\)$", text)
    counts = parse_nested(inner[1] if inner else text)
    if not counts or any(n <= 0 for n in counts.values()):
        return text
    scaled = [round(n * 10_000) for n in counts.values()]
    divisor = reduce(math.gcd, scaled) or 1
    if any(abs(n * 10_000 - s) > 1e-6 for n, s in zip(counts.values(), scaled)):
        return text
    parts = sorted((e, s // divisor) for e, s in zip(counts, scaled))
    return "".join(f"{e}{n if n != 1 else ''}" for e, n in parts)


@F.pandas_udf(StringType())
def reduced_formula(formulas: pd.Series) -> pd.Series:
    """Nested brackets are beyond the built-in functions; batches come by Arrow and repeats are parsed once."""
    known = {f: reduce_formula(f) for f in formulas.dropna().unique()}
    return formulas.map(known)
