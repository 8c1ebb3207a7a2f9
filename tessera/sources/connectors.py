"""Connectors of materials databases: landed JSON lines to records of one schema.

Fetching is network work and stays outside: each database is landed as JSON lines (read_landed), and its mapping
turns payloads into records with columns only, so that a dump of any size is one scan. A payload that isn't JSON
gives a record without an id, which `rejected` keeps apart.

A record: material_id (with the database's prefix), source_db, source_id, elements, family, is_electrolyte_candidate,
space_group, lattice (a, b, c, alpha, beta, gamma), structure (text), formation_energy_per_atom, energy_above_hull, band_gap.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.formula import elements as formula_elements
from tessera.functions.formula import reduced_formula
from tessera.functions.materials import family_of_elements

LATTICE = ("a", "b", "c", "alpha", "beta", "gamma")
_LATTICE = "struct<a:double,b:double,c:double,alpha:double,beta:double,gamma:double>"
#: Families that are candidates whatever metals they hold, and the metals of intercalation cathodes.
ALWAYS_CANDIDATES = ("garnet", "perovskite", "nasicon", "sulfide", "argyrodite", "halide", "hydride", "borohydride", "antiperovskite", "polymer_composite")
CATHODE_METALS = ("Co", "Mn", "Ni", "Fe")


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """payload: a row per line of landed files, on any file system that Spark reads."""
    return spark.read.text(path).where("trim(value) <> ''").withColumnRenamed("value", "payload")


def lattice_of(vectors: Column) -> Column:
    """Lengths and angles of three lattice vectors; null unless they are 3 x 3."""
    dot = lambda x, y: x[0] * y[0] + x[1] * y[1] + x[2] * y[2]
    va, vb, vc = (F.get(vectors, F.lit(k)) for k in range(3))
    na, nb, nc = (F.sqrt(dot(v, v)) for v in (va, vb, vc))
    angle = lambda x, y, n: F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.try_divide(dot(x, y), n)))))
    good = (F.size(vectors) == 3) & F.forall(vectors, lambda v: F.size(v) == 3)
    return F.when(good, F.struct(na.alias("a"), nb.alias("b"), nc.alias("c"), angle(vb, vc, nb * nc).alias("alpha"), angle(va, vc, na * nc).alias("beta"), angle(va, vb, na * nb).alias("gamma")))


def volume_of(vectors: Column) -> Column:
    """|det| of three lattice vectors."""
    x, y, z = (F.get(vectors, F.lit(k)) for k in range(3))
    det = x[0] * (y[1] * z[2] - y[2] * z[1]) - x[1] * (y[0] * z[2] - y[2] * z[0]) + x[2] * (y[0] * z[1] - y[1] * z[0])
    return F.when((F.size(vectors) == 3) & F.forall(vectors, lambda v: F.size(v) == 3), F.abs(det))


def with_defaults(lattice: Column) -> Column:
    """Missing and zero lengths are 0, missing and zero angles 90; a missing lattice stays null."""
    fields = [F.coalesce(F.nullif(lattice[n], F.lit(0.0)), F.lit(0.0 if len(n) == 1 else 90.0)).alias(n) for n in LATTICE]
    return F.when(lattice.isNotNull(), F.struct(*fields))


def is_candidate(e: Column, family: Column) -> Column:
    """With lithium, and either of a family that always is one or without a cathode's metals."""
    metals = F.arrays_overlap(e, F.array(*map(F.lit, CATHODE_METALS)))
    return F.coalesce(F.array_contains(e, "Li") & (family.isin(*ALWAYS_CANDIDATES) | ~metals), F.lit(False))


def _none(kind: str) -> Column:
    return F.lit(None).cast(kind)


@dataclass(frozen=True)
class Connector:
    """What a database's payload holds (schema) and where a record's parts are in it."""

    prefix: str
    schema: str
    source_id: Callable[[Column], Column]
    elements: Callable[[Column], Column]
    space_group: Callable[[Column], Column]
    lattice: Callable[[Column], Column]
    structure: Callable[[Column], Column] = lambda d: _none("string")
    energies: Callable[[Column], tuple[Column, Column, Column]] = lambda d: (_none("double"),) * 3

    def records(self, landed: DataFrame) -> DataFrame:
        """A record per payload."""
        d = F.col("d")
        parsed = landed.select(F.from_json("payload", self.schema).alias("d"), "payload")
        own = F.array_distinct(F.filter(F.coalesce(self.elements(d), F.array().cast("array<string>")), lambda x: (x != "") & x.isNotNull()))
        formation, hull, gap = self.energies(d)
        rows = parsed.select(
            self.source_id(d).cast("string").alias("source_id"), own.alias("elements"), F.nullif(self.space_group(d), F.lit("")).alias("space_group"), self.lattice(d).alias("lattice"),
            F.nullif(self.structure(d), F.lit("")).alias("structure"), formation.alias("formation_energy_per_atom"), hull.alias("energy_above_hull"), gap.alias("band_gap"), "payload",
        )
        rows = rows.withColumn("family", family_of_elements(F.col("elements")))
        return rows.select(
            F.concat(F.lit(f"{self.prefix}-"), "source_id").alias("material_id"), F.lit(self.prefix).alias("source_db"), "source_id", "elements", "family", is_candidate(F.col("elements"), F.col("family")).alias("is_electrolyte_candidate"),
            "space_group", "lattice", "structure", "formation_energy_per_atom", "energy_above_hull", "band_gap", "payload",
        )


def rejected(records: DataFrame) -> DataFrame:
    """Payloads without a usable id."""
    return records.where("source_id is null or source_id = ''").select("source_db", "payload")


_SITES = "sites:array<struct<species:array<struct<element:string,occu:double>>>>"
CONNECTORS = {
    "materials_project": Connector(
        "mp", f"material_id string, structure struct<lattice:{_LATTICE},{_SITES},cif:string>, symmetry struct<symbol:string>, formation_energy_per_atom double, energy_above_hull double, band_gap double",
        lambda d: d["material_id"], lambda d: F.flatten(F.transform(d["structure"]["sites"], lambda s: F.transform(s["species"], lambda x: x["element"]))), lambda d: d["symmetry"]["symbol"],
        lambda d: with_defaults(F.coalesce(d["structure"]["lattice"], F.from_json(F.lit("{}"), _LATTICE.removeprefix("struct<").removesuffix(">").replace(":", " ")))), lambda d: d["structure"]["cif"],
        lambda d: (d["formation_energy_per_atom"], d["energy_above_hull"], d["band_gap"]),
    ),
    "jarvis": Connector(
        "jarvis", f"jid string, space_group string, struct struct<lattice:{_LATTICE},elements:array<string>>",
        lambda d: d["jid"], lambda d: d["struct"]["elements"], lambda d: d["space_group"], lambda d: with_defaults(d["struct"]["lattice"]),
    ),
    "oqmd": Connector(
        "oqmd", f"id string, composition map<string,double>, formula string, name string, space_group struct<symbol:string>, unit_cell array<array<double>>, lattice {_LATTICE}, cif string",
        lambda d: d["id"], lambda d: F.when(F.size(F.coalesce(F.map_keys(d["composition"]), F.array().cast("array<string>"))) > 0, F.map_keys(d["composition"])).otherwise(formula_elements(F.coalesce(d["formula"], d["name"], F.lit("")))),
        lambda d: d["space_group"]["symbol"], lambda d: with_defaults(F.coalesce(d["lattice"], lattice_of(d["unit_cell"]))), lambda d: d["cif"],
    ),
    "aflow": Connector(
        "aflow", f"auid string, species array<string>, compound string, spacegroup struct<symbol:string>, spacegroup_relax struct<symbol:string>, lattice {_LATTICE}, cif string",
        lambda d: d["auid"], lambda d: F.coalesce(F.when(F.size(F.filter(F.coalesce(d["species"], F.array().cast("array<string>")), lambda s: ~F.trim(s).rlike("^([0-9]|$)"))) > 0, F.filter(F.transform(d["species"], F.trim), lambda s: ~s.rlike("^([0-9]|$)"))), formula_elements(F.coalesce(d["compound"], F.lit("")))),
        lambda d: F.coalesce(d["spacegroup"]["symbol"], d["spacegroup_relax"]["symbol"]), lambda d: with_defaults(d["lattice"]), lambda d: d["cif"],
    ),
    "nomad": Connector(
        "nomad", "entry_id string, results struct<material:struct<elements:array<string>,symmetry:struct<space_group_symbol:string>>>, cif string",
        lambda d: d["entry_id"], lambda d: d["results"]["material"]["elements"], lambda d: d["results"]["material"]["symmetry"]["space_group_symbol"], lambda d: _none(_LATTICE), lambda d: d["cif"],
    ),
    "cod": Connector(
        "cod", "cod_id string, id string, file string, elements array<string>, space_group string, sg string, cell_length_a double, cell_length_b double, cell_length_c double, cell_angle_alpha double, cell_angle_beta double, cell_angle_gamma double, a double, b double, c double, alpha double, beta double, gamma double, cif string",
        lambda d: F.coalesce(d["cod_id"], d["id"], d["file"]), lambda d: F.coalesce(d["elements"], F.array(F.lit("Li"))), lambda d: F.coalesce(F.nullif(d["space_group"], F.lit("")), d["sg"]),
        lambda d: with_defaults(F.struct(*[F.coalesce(F.nullif(d[f"cell_length_{n}" if len(n) == 1 else f"cell_angle_{n}"], F.lit(0.0)), d[n]).alias(n) for n in LATTICE])), lambda d: d["cif"],
    ),
    "materials_cloud": Connector(
        "materials_cloud", "id string, attributes struct<formula_reduced:string,species_at_sites:array<string>,lattice_vectors:array<array<double>>,space_group:struct<space_group_symbol:string,symbol:string>,is_stable:boolean>",
        lambda d: d["id"], lambda d: F.when(F.size(F.filter(F.coalesce(d["attributes"]["species_at_sites"], F.array().cast("array<string>")), lambda s: s != "X")) > 0, F.filter(d["attributes"]["species_at_sites"], lambda s: s != "X")).otherwise(formula_elements(F.coalesce(d["attributes"]["formula_reduced"], F.lit("")))),
        lambda d: F.coalesce(F.nullif(d["attributes"]["space_group"]["space_group_symbol"], F.lit("")), d["attributes"]["space_group"]["symbol"]), lambda d: lattice_of(d["attributes"]["lattice_vectors"]),
    ),
}


def ingest(landed: dict[str, DataFrame]) -> DataFrame:
    """Records of several databases; of records with equal material_id the first by payload stays."""
    out = None
    for name, df in landed.items():
        part = CONNECTORS[name].records(df)
        out = part if out is None else out.unionByName(part)
    usable = out.where("source_id is not null and source_id <> ''")
    rest = [c for c in usable.columns if c != "material_id"]
    first = usable.groupBy("material_id").agg(F.min_by(F.struct(*rest), "payload").alias("r"))
    return first.select("material_id", "r.*").drop("payload")


def jarvis_properties(landed: DataFrame) -> DataFrame:
    """jid, composition, reduced_formula, density (0 is none), volume, nsites: what fills rows of that database."""
    schema = "jid string, formula string, density double, atoms struct<elements:array<string>,lattice_mat:array<array<double>>>"
    d = landed.select(F.from_json("payload", schema).alias("d")).select("d.*").where("jid is not null and jid <> ''")
    n = F.when(F.col("atoms.elements").isNotNull(), F.size("atoms.elements"))
    return d.select("jid", F.nullif("formula", F.lit("")).alias("composition"), reduced_formula(F.nullif("formula", F.lit(""))).alias("reduced_formula"), F.nullif("density", F.lit(0.0)).alias("density"), volume_of(F.col("atoms.lattice_mat")).alias("volume"), n.alias("nsites"))


def id_chunks(ids: DataFrame, key: str, size: int = 500) -> DataFrame:
    """chunk, ids: what a fetcher asks for at once; chunks are made where the ids lie and hold `size` on average."""
    chunks = F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / size))
    n = ids.agg(chunks.alias("n")).head()["n"]
    return ids.select(key).distinct().groupBy(F.pmod(F.xxhash64(key), F.lit(n)).alias("chunk")).agg(F.sort_array(F.collect_list(key)).alias("ids"))


def merge_blocks(base: DataFrame, blocks: DataFrame, key: str, overwrite: list[str], fill: dict[str, str]) -> DataFrame:
    """base with a sidecar's columns: those of `overwrite` replace what the sidecar has a value for, those of `fill` (new name -> field) are added; rows without sidecar stay."""
    side = blocks.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_{c}") for c in overwrite], *[F.col(c).alias(f"_new_{n}") for n, c in fill.items()])
    j = base.join(side, F.col(key) == F.col("_key"), "left")
    kept = [F.coalesce(f"_{c}", c).alias(c) if c in overwrite else F.col(c) for c in base.columns]
    return j.select(*kept, *[F.col(f"_{c}").alias(c) for c in overwrite if c not in base.columns], *[F.col(f"_new_{n}").alias(n) for n in fill])


def find_column(df: DataFrame, names: list[str]) -> str | None:
    """The first of the names that df has."""
    return next((n for n in names if n in df.columns), None)


def flat_or_nested(df: DataFrame, name: str) -> Column:
    """A column called by its dotted name, else the field of that path; not-a-number is null; missing names are null."""
    if name in df.columns:
        c, kind = F.col(f"`{name}`"), dict(df.dtypes)[name]
    else:
        try:
            c = F.col(".".join(f"`{x}`" for x in name.split(".")))
            kind = df.select(c.alias("x")).dtypes[0][1]
        except Exception as e:  # the analyser's error for a missing path
            if "UNRESOLVED_COLUMN" not in str(e) and "FIELD_NOT_FOUND" not in str(e) and "INVALID_EXTRACT" not in str(e):
                raise
            return F.lit(None)
    return F.when(~F.isnan(c), c) if kind in ("double", "float") else c
