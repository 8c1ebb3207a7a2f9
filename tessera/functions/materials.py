"""What a formula says of its material: canonical order, family by rules, role beside a primary material, descriptors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.formula import element_counts, elements

#: The order of elements in canonical formulas; others follow by name.
ELEMENT_ORDER = (
    "Li", "Na", "K", "Rb", "Cs", "Mg", "Ca", "Sr", "Ba", "Sc", "Y", "La", "Ce", "Pr", "Nd", "Sm", "Eu", "Gd", "Tb", "Dy", "Ho", "Er", "Tm", "Yb", "Lu",
    "Ti", "Zr", "Hf", "Nb", "Ta", "Cr", "Mo", "W", "Mn", "Fe", "Co", "Ni", "Cu", "Zn", "Al", "Ga", "In", "Ge", "Sn", "Pb", "P", "As", "Sb", "Bi",
    "O", "S", "Se", "Te", "F", "Cl", "Br", "I", "C", "N", "B", "Si", "H",
)
#: Family patterns of the extraction side, in order of precedence.
EXTRACTION_FAMILIES = (
    ("argyrodite", "Li6PS5"), ("LGPS", r"Li\d+GeP"), ("LLZO", "Li7La3Zr2O12"), ("LLTO", r"Li\d*La\d*TiO"), ("LAGP", r"Li\d*Al\d*Ge\d*P\d*O"), ("LATP", r"Li\d*Al\d*Ti\d*P\d*O"),
    ("NASICON", "Na"), ("perovskite", r"Li\d*La\d*TiO"), ("garnet", r"Li\d*La\d*Zr\d*O"), ("sulfide", r"Li\d*[PS]"), ("halide", r"Li\d*[YScIn]Cl"), ("polymer", "PEO|polyethylene"),
)
#: Element sets of the family rules.
POLYMER_HOSTS = r"(PEO|PAN|PVDF|PMMA|PCL|PEG|PPO|PTMC|PVDF-HFP)\d*"
ALKALI = ("Li", "Na", "K", "Rb", "Cs", "Mg")
HALOGENS = ("Cl", "Br", "I", "F")
ANTIPEROVSKITE = ("Li", "Na", "K", "Rb", "Cs", "H", "O", "F", "Cl", "Br", "I")
GARNET_METALS, NASICON_METALS, THIO_METALS = ("Zr", "Hf", "Ta", "Nb"), ("Ti", "Zr", "Ge", "Hf", "Al", "Sn"), ("P", "Si", "Ge", "Sn")
NON_METALS = ("H", "He", "B", "C", "N", "O", "F", "Ne", "P", "S", "Cl", "Ar", "Br", "Kr", "I", "Xe", "Se", "As", "Te", "At", "Rn")
#: Electronegativity (Pauling), atomic mass, group and period of the elements that descriptors are asked for.
PROPERTIES = {
    "H": (2.20, 1.00794, 1, 1), "Li": (0.98, 6.941, 1, 2), "B": (2.04, 10.811, 13, 2), "C": (2.55, 12.0107, 14, 2), "N": (3.04, 14.0067, 15, 2), "O": (3.44, 15.9994, 16, 2),
    "F": (3.98, 18.9984032, 17, 2), "Na": (0.93, 22.98976928, 1, 3), "Mg": (1.31, 24.305, 2, 3), "Al": (1.61, 26.9815386, 13, 3), "P": (2.19, 30.973762, 15, 3), "S": (2.58, 32.065, 16, 3),
    "Cl": (3.16, 35.453, 17, 3), "K": (0.82, 39.0983, 1, 4), "Ti": (1.54, 47.867, 4, 4), "Ge": (2.01, 72.64, 14, 4), "Br": (2.96, 79.904, 17, 4), "Zr": (1.33, 91.224, 4, 5), "La": (1.10, 138.90547, 3, 6),
}


def _array(values) -> Column:
    return F.array(*map(F.lit, values))


def summed_counts(formula: Column) -> Column:
    """element_counts with the counts of an element that stands more than once added up, in order of first appearance."""
    whole = lambda parts, e: F.aggregate(F.filter(parts, lambda x: x["element"] == e), F.lit(0.0), lambda acc, x: acc + x["n"])
    parts = element_counts(formula)
    return F.transform(F.array_distinct(F.transform(parts, lambda x: x["element"])), lambda e: F.struct(e.alias("element"), whole(parts, e).alias("n")))


def sorted_formula(formula: Column) -> Column:
    """Elements in canonical order; whole counts without decimals, 1 left out; elements beyond the order follow by name, with their 1."""
    place = lambda x: F.array_position(_array(ELEMENT_ORDER), x["element"])
    count = lambda n: F.when(n == F.floor(n), n.cast("long").cast("string")).otherwise(n.cast("string"))
    ranked = F.transform(summed_counts(formula), lambda x: F.struct(F.when(place(x) > 0, place(x)).otherwise(1000).alias("at"), x["element"].alias("element"), x["n"].alias("n")))
    spelled = lambda x: F.concat(x["element"], F.when((x["at"] < 1000) & (x["n"] == 1), "").otherwise(count(x["n"])))
    return F.array_join(F.transform(F.array_sort(ranked), spelled), "")


def extraction_family(formula: Column) -> Column:
    out = F.lit("unknown")
    for name, pattern in reversed(EXTRACTION_FAMILIES):
        out = F.when(formula.rlike(f"(?i){pattern}"), name).otherwise(out)
    return out


def rule_family(formula: Column) -> Column:
    """The family by the formula's set of elements; a polymer host in its text comes first."""
    return F.when(formula.rlike(f"(?i){POLYMER_HOSTS}"), "polymer_composite").otherwise(family_of_elements(elements(formula)))


def family_of_elements(e: Column) -> Column:
    """The first rule that holds decides."""
    has = lambda *names: F.forall(_array(names), lambda x: F.array_contains(e, x))
    some = lambda names: F.arrays_overlap(e, _array(names))
    only = lambda names: F.size(F.array_except(e, _array(names))) == 0
    rules = (
        (~some(ALKALI), "unknown"),
        (has("C", "H"), "polymer_composite"),
        (has("P", "S") & some(HALOGENS), "argyrodite"),
        (has("O") & some(HALOGENS) & only(ANTIPEROVSKITE), "antiperovskite"),
        (some(HALOGENS) & ~has("O") & ~has("S"), "halide"),
        (has("B", "H"), "borohydride"),
        (has("La", "O") & some(GARNET_METALS), "garnet"),
        (has("La", "Ti", "O"), "perovskite"),
        (has("O", "P") & some(NASICON_METALS), "nasicon"),
        (has("H") & ~has("O"), "hydride"),
        (has("S") & (~has("O") | some(THIO_METALS)), "sulfide"),
        (has("O") & (only(("Li", "O")) | ~only((*NON_METALS, "Li"))), "oxide"),
    )
    out = F.lit("unknown")
    for holds, family in reversed(rules):
        out = F.when(holds, family).otherwise(out)
    return out


def composition_group(reduced: Column, formula: Column) -> Column:
    """The reduced formula, else the formula without digits, else unknown."""
    return F.coalesce(F.nullif(reduced, F.lit("")), F.nullif(F.regexp_replace(formula, "[0-9.]", ""), F.lit("")), F.lit("unknown"))


def split_key(family: Column, group: Column) -> Column:
    return F.concat(F.coalesce(family, F.lit("unknown")), F.lit("::"), group)


def is_substitution(a: Column, b: Column) -> Column:
    """Different element sets that share all but two of the larger one's."""
    x, y = elements(a), elements(b)
    same = (F.size(F.array_except(x, y)) == 0) & (F.size(F.array_except(y, x)) == 0)
    return ~same & (F.size(F.array_intersect(x, y)) >= F.greatest(F.size(x), F.size(y)) - 2)


def _letters(formula: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.regexp_replace(F.lower(formula), "[_₀-₉]", ""), F.lit("([a-z]+)"), F.lit(1)))


def material_role(formula: Column, primary: Column) -> Column:
    """primary, primary_variant (letter runs but one shared), other; unknown without one of both."""
    a, b = _letters(formula), _letters(primary)
    shared = F.size(F.array_intersect(a, b))
    plain = lambda c: F.regexp_replace(F.lower(c), "[_₀-₉]", "")
    variant = (shared > 0) & (shared >= F.greatest(F.lit(1), F.least(F.size(a), F.size(b)) - 1))
    known = F.coalesce((formula != "") & (primary != ""), F.lit(False))
    return F.when(~known, "unknown").when(plain(formula) == plain(primary), "primary").when(variant, "primary_variant").otherwise("other")


def normal_composition(text: Column) -> Column:
    """Without white space and middle dots, every minus sign a hyphen."""
    return F.translate(F.regexp_replace(text, r"[\s·∙⋅•]", ""), "−–—", "---")


def loosely_same(a: Column, b: Column) -> Column:
    """Equal, or one inside the other, without case and blanks; false where one is empty."""
    x, y = (F.lower(F.replace(c, F.lit(" "), F.lit(""))) for c in (a, b))
    return F.coalesce((x != "") & (y != "") & (F.contains(x, y) | F.contains(y, x)), F.lit(False))


def volume_per_formula_unit(volume: Column, nsites: Column, formula: Column) -> Column:
    """volume * atoms / nsites; null where a part is missing, not a number or not over zero, or the formula has no atoms."""
    atoms = F.aggregate(element_counts(formula), F.lit(0.0), lambda acc, x: acc + x["n"])
    good = (volume > 0) & ~F.isnan(volume) & (nsites > 0) & (atoms > 0)
    return F.when(good, volume * atoms / nsites)


def descriptors(formula: Column) -> Column:
    """Electronegativity over elements, mass, group, period and weight over fractions; over the elements that PROPERTIES has."""
    table = F.create_map(*[x for e, v in PROPERTIES.items() for x in (F.lit(e), F.struct(*[F.lit(float(p)).alias(n) for p, n in zip(v, ("eneg", "mass", "group", "period"))]))])
    parts = F.filter(F.transform(summed_counts(formula), lambda x: F.struct(x["n"].alias("n"), F.try_element_at(table, x["element"]).alias("p"))), lambda x: x["p"].isNotNull())
    total = lambda p, f: F.aggregate(p, F.lit(0.0), lambda acc, x: acc + f(x))

    def of(p: Column) -> Column:
        n, atoms = F.size(p), total(p, lambda x: x["n"])
        mean = total(p, lambda x: x["p"]["eneg"]) / n
        weighted = lambda field: F.round(total(p, lambda x: x["n"] * x["p"][field]) / atoms, 6)
        enegs = F.transform(p, lambda x: x["p"]["eneg"])
        spread = F.sqrt(total(p, lambda x: (x["p"]["eneg"] - mean) * (x["p"]["eneg"] - mean)) / n)
        return F.struct(
            F.round(mean, 6).alias("eneg_mean"), F.array_max(enegs).alias("eneg_max"), F.array_min(enegs).alias("eneg_min"), F.round(spread, 6).alias("eneg_std"),
            weighted("mass").alias("mass_mean"), weighted("group").alias("group_mean"), weighted("period").alias("period_mean"),
        )

    return F.when(F.size(parts) > 0, F.element_at(F.transform(F.array(parts), of), 1))


def species(text: Column) -> Column:
    """Element and signed charge of a species as Fe3+ or O2-; null if it is none."""
    sign = F.regexp_extract(text, r"^[A-Z][a-z]?\d*([+-])", 1)
    size = F.regexp_extract(text, r"^[A-Z][a-z]?(\d*)[+-]", 1)
    charge = F.when(size == "", 1).otherwise(size.cast("int")) * F.when(sign == "+", 1).otherwise(-1)
    return F.when(sign != "", F.struct(F.regexp_extract(text, "^([A-Z][a-z]?)", 1).alias("element"), charge.alias("charge")))


def redox(formula: Column, all_species: Column) -> Column:
    """Mean and range of the charges, mixed valence, and whether first charges by fraction cancel; null without charges."""
    found = F.filter(F.transform(all_species, species), lambda x: x.isNotNull())
    charges = F.transform(found, lambda x: x["charge"])
    first = lambda e: F.get(F.filter(found, lambda x: x["element"] == e), F.lit(0))["charge"]
    parts = summed_counts(formula)
    atoms = F.aggregate(parts, F.lit(0.0), lambda acc, x: acc + x["n"])
    net = F.aggregate(parts, F.lit(0.0), lambda acc, x: acc + F.coalesce(first(x["element"]).cast("double"), F.lit(0.0)) * x["n"]) / atoms
    average = F.aggregate(charges, F.lit(0.0), lambda acc, c: acc + c) / F.size(charges)
    return F.struct(
        F.when(F.size(charges) > 0, F.round(average, 6)).alias("average_oxidation"),
        F.when(F.size(charges) > 1, (F.array_max(charges) - F.array_min(charges)).cast("double")).alias("oxidation_range"),
        (F.size(F.array_distinct(found)) > F.size(F.array_distinct(F.transform(found, lambda x: x["element"])))).alias("mixed_valence"),
        F.when((F.size(charges) > 0) & (atoms > 0), F.abs(net) < 0.01).alias("electroneutral"),
    )
