"""Benchmark tasks: a registry, label masks, split regimes, metric dispatch, routing to splits or grouped folds, baselines.

A frame holds a column for each target of the registry. Tasks are judged together: every row gives an array of
(task, label), which is exploded and aggregated by task before anything is shuffled, so that the frame is scanned
once, however many tasks and regimes there are. Baselines predict the mean or the most frequent class of the training rows.

Over the driver's tables, parts are materials; target columns are arithmetic on their keys, sizes and prices (TARGETS).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tessera.functions.columns import SQL_BUCKET, md5_bucket, split_of
from tessera.operators.roles import SQL_PARTS, parts

REGRESSION, CLASSES, RANKING = "regression", "classification", "ranking"


@dataclass(frozen=True)
class Task:
    name: str
    kind: str
    target: str
    metric: str
    threshold: float | None = None
    log10: bool = False
    bounds: tuple[float, float] | None = None
    leaky: tuple[str, ...] = ()

    @property
    def text_classes(self) -> bool:
        return self.kind == CLASSES and self.threshold is None

    def mask(self) -> Column:
        """Rows with a usable label: thresholds leave out zeros, logarithms what isn't over zero; bounds are closed."""
        y = F.col(f"`{self.target}`")
        held = y.isNotNull()
        if self.kind == CLASSES and self.threshold is not None:
            held = held & (y != 0)
        elif self.log10:
            held = held & (y > 0)
        if self.bounds:
            held = held & y.cast("double").between(*self.bounds)
        return F.coalesce(held, F.lit(False))

    def label(self) -> Column:
        """The label as a number; classes without threshold as text are another column (label_class)."""
        y = F.col(f"`{self.target}`")
        if self.kind == CLASSES:
            return (y >= self.threshold).cast("double") if self.threshold is not None else F.lit(None).cast("double")
        return F.log10(y) if self.log10 else y.cast("double")

    def label_class(self) -> Column:
        return F.col(f"`{self.target}`").cast("string") if self.text_classes else F.lit(None).cast("string")


_MODULI = ("mechanical.bulk_modulus", "mechanical.shear_modulus", "mechanical.debye_temperature")
_ELASTIC = ("mechanical.homogeneous_poisson", "mechanical.universal_anisotropy")
_GAP = ("thermodynamics.cbm", "thermodynamics.vbm", "thermodynamics.efermi", "thermodynamics.is_gap_direct")
_REACTION = "thermodynamics.equilibrium_reaction_energy_per_atom"
_MEASURED = ("ion_transport.conductivity_type", "ion_transport.conductivity_source_type", "ion_transport.measurement_method", "ion_transport.temperature_range_measured")
_SIGMA, _EA, _HULL = "ion_transport.sigma_RT", "ion_transport.activation_energy_Ea", "thermodynamics.energy_above_hull"
_METAL = "thermodynamics.is_metal"

#: The tasks with their targets, metrics, thresholds, bounds and leaky columns.
TASKS = (
    Task("formation_energy_regression", REGRESSION, "thermodynamics.formation_energy_per_atom", "mae", leaky=("thermodynamics.total_energy", "thermodynamics.energy_per_atom", _REACTION)),
    Task("band_gap_regression", REGRESSION, "thermodynamics.band_gap", "mae", leaky=(*_GAP, _METAL)),
    Task("energy_above_hull_regression", REGRESSION, _HULL, "mae", leaky=("thermodynamics.is_stable", _REACTION)),
    Task("bulk_modulus_regression", REGRESSION, "mechanical.bulk_modulus", "mae", bounds=(1.0, 1000.0), leaky=(*_MODULI[1:], *_ELASTIC)),
    Task("shear_modulus_regression", REGRESSION, "mechanical.shear_modulus", "mae", bounds=(1.0, 1000.0), leaky=(_MODULI[0], _MODULI[2], *_ELASTIC)),
    Task("debye_temperature_regression", REGRESSION, "mechanical.debye_temperature", "mae", bounds=(50.0, 3000.0), leaky=(*_MODULI[:2], *_ELASTIC)),
    Task("density_regression", REGRESSION, "structure.density", "mae", leaky=("structure.volume", "structure.density_atomic")),
    Task("volume_regression", REGRESSION, "structure.volume", "mae", leaky=("structure.density", "structure.density_atomic")),
    Task("ionic_radius_regression", REGRESSION, "chemistry.ionic_radius_mean", "mae"),
    Task("stability_classification", CLASSES, "thermodynamics.is_stable", "macro_f1", leaky=(_HULL, _REACTION)),
    Task("wide_gap_classification", CLASSES, "thermodynamics.band_gap", "macro_f1", threshold=4.0, leaky=(*_GAP, _METAL)),
    Task("family_classification", CLASSES, "identity.family", "macro_f1"),
    Task("crystal_system_classification", CLASSES, "structure.crystal_system", "macro_f1", leaky=("structure.space_group_number", "structure.symmetry_operations_count")),
    Task("space_group_classification", CLASSES, "structure.space_group_number", "top5_accuracy", leaky=("structure.crystal_system", "structure.symmetry_operations_count")),
    Task("conductive_candidate_ranking", RANKING, _SIGMA, "ndcg10", log10=True, leaky=(_EA, *_MEASURED)),
    Task("negative_result_classification", CLASSES, "negative.is_negative_result", "macro_f1", leaky=(_HULL, _METAL, "thermodynamics.band_gap", *_GAP, "structure.li_hopping_distance")),
    Task("metallic_classification", CLASSES, _METAL, "macro_f1", leaky=("thermodynamics.band_gap", *_GAP)),
    Task("high_conductivity_classification", CLASSES, _SIGMA, "macro_f1", threshold=1e-3, leaky=(_EA, *_MEASURED)),
    Task("activation_energy_regression", REGRESSION, _EA, "mae", leaky=(_SIGMA, *_MEASURED)),
    Task("sigma_RT_regression", REGRESSION, _SIGMA, "mae", log10=True, leaky=(_EA, *_MEASURED)),
    Task("is_magnetic_classification", CLASSES, "magnetic.is_magnetic", "macro_f1"),
    Task("packing_fraction_regression", REGRESSION, "structure.packing_fraction", "mae"),
    Task("electroneutral_classification", CLASSES, "redox.electroneutral", "macro_f1"),
    Task("li_hopping_distance_regression", REGRESSION, "structure.li_hopping_distance", "mae"),
    Task("electrolyte_candidate_classification", CLASSES, "identity.is_electrolyte_candidate", "macro_f1"),
)
#: Training and test rows from which a split is used; below, grouped folds.
SCARCE = 30
FOLDS = 5
NO_FEATURE = ("identity.", "text_provenance.", "ml_features.", "validation.", "negative.", "_")

#: Regime -> key whose bucket decides the split; a paper's components are splits.component_split.
REGIMES: dict[str, Callable[[], Column]] = {
    "random": lambda: F.col("`identity.material_id`"),
    "family_ood": lambda: F.col("`identity.family`"),
    "composition_ood": lambda: F.col("`identity.formula`"),
    "crystal_system_ood": lambda: F.col("`structure.crystal_system`"),
}


def split_map(regime: str) -> Column:
    """The split of a row under a regime."""
    if regime not in REGIMES:
        raise ValueError(f"unknown regime: {regime}")
    return split_of(md5_bucket(F.coalesce(REGIMES[regime]().cast("string"), F.lit("unknown"))))


def labelled(frame: DataFrame, *extra: Column, tasks: tuple[Task, ...] = TASKS) -> DataFrame:
    """task, y, y_class and the extra columns: a row for each label of each row."""
    labels = [F.when(t.mask(), F.struct(F.lit(t.name).alias("task"), t.label().alias("y"), t.label_class().alias("y_class"))) for t in tasks]
    return frame.select(F.explode(F.array_compact(F.array(*labels))).alias("t"), *extra).select("t.*", *[c for c in frame.select(*extra).columns])


def usable_features(frame: DataFrame, tasks: tuple[Task, ...] = TASKS) -> DataFrame:
    """task, features: numeric columns with at least max(10, 0.3 n) values, without identity, provenance, the target and what leaks it. One scan for all tasks."""
    names = [f.name for f in frame.schema if isinstance(f.dataType, NumericType) and not f.name.startswith(NO_FEATURE)]
    counts = frame.agg(F.count(F.lit(1)).alias("_n"), *[F.count(F.col(f"`{c}`")).alias(c) for c in names])
    enough = F.array_compact(F.array(*[F.when(F.col(f"`{c}`") >= F.greatest(F.lit(10.0), 0.3 * F.col("_n")), F.lit(c)) for c in names]))
    banned = F.create_map(*[x for t in tasks for x in (F.lit(t.name), F.array(*map(F.lit, (t.target, *t.leaky))))])
    return counts.select(enough.alias("all"), F.explode(banned).alias("task", "banned")).select("task", F.array_except("all", "banned").alias("features"))


def baseline_errors(rows: DataFrame, keys: list[str]) -> DataFrame:
    """keys (task first), n_train, n_test, mae, rmse, r2 of the training mean on rows of split test."""
    train = rows.where("split = 'train'").groupBy(*keys).agg(F.count("y").alias("n_train"), F.avg("y").alias("mean"))
    test = rows.where("split = 'test'").join(F.broadcast(train), keys)  # a row for each task and regime
    error = F.col("y") - F.col("mean")
    found = test.groupBy(*keys, "n_train").agg(F.count("y").alias("n_test"), F.avg(F.abs(error)).alias("mae"), F.sqrt(F.avg(error * error)).alias("rmse"), F.sum(error * error).alias("res"), (F.var_pop("y") * F.count("y")).alias("tot"))
    return found.select(*keys, "n_train", "n_test", F.round("mae", 6).alias("mae"), F.round("rmse", 6).alias("rmse"), F.round(1 - F.col("res") / F.greatest("tot", F.lit(1e-12)), 6).alias("r2"))


def class_hits(rows: DataFrame, keys: list[str], best: int) -> DataFrame:
    """keys, n_test, and accuracy of the `best` most frequent training classes (by name among equals) for rows of split test."""
    train = rows.where("split = 'train'").groupBy(*keys, "label").agg(F.count(F.lit(1)).alias("c"))
    ranked = train.withColumn("r", F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("c"), "label"))).where(F.col("r") <= best)
    test = rows.where("split = 'test'").groupBy(*keys, "label").agg(F.count(F.lit(1)).alias("n"))
    hits = test.join(ranked.select(*keys, "label", "r"), [*keys, "label"], "left")
    return hits.groupBy(*keys).agg(F.sum("n").alias("n_test"), F.round(F.sum(F.when(F.col("r").isNotNull(), F.col("n")).otherwise(0)) / F.sum("n"), 6).alias("accuracy"))


#: Target -> (a, b, modulus, scale): ((key a + size b) modulo modulus) scale, null where (key + a) is a multiple of 11. Booleans are parities.
TARGETS = {
    "thermodynamics.formation_energy_per_atom": (7, 3, 401, 0.01), "thermodynamics.band_gap": (5, 11, 97, 0.1), _HULL: (3, 17, 211, 0.001), "mechanical.bulk_modulus": (13, 5, 1201, 1.0),
    "mechanical.shear_modulus": (17, 7, 1103, 1.0), "mechanical.debye_temperature": (19, 2, 3307, 1.0), "structure.density": (23, 3, 83, 0.1), "structure.volume": (29, 31, 997, 1.0),
    "chemistry.ionic_radius_mean": (31, 1, 151, 0.01), "structure.space_group_number": (37, 5, 29, 1.0), _SIGMA: (41, 13, 53, 0.0001), _EA: (43, 3, 61, 0.01),
    "structure.packing_fraction": (47, 7, 71, 0.01), "structure.li_hopping_distance": (53, 2, 43, 0.1),
}
FLAGS = {"thermodynamics.is_stable": 3, _METAL: 5, "negative.is_negative_result": 7, "magnetic.is_magnetic": 13, "redox.electroneutral": 17, "identity.is_electrolyte_candidate": 19}


def frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    numbers = [F.when((key + a) % 11 != 0, F.round(((key * a + size * b) % m) * scale, 6)).alias(t) for t, (a, b, m, scale) in TARGETS.items()]
    flags = [F.when((key + m) % 11 != 0, ((key + size) % m) % 2 == 0).alias(t) for t, m in FLAGS.items()]
    names = [key.alias("identity.material_id"), F.col("p_brand").alias("identity.family"), F.col("formula").alias("identity.formula"), (size % 7).cast("string").alias("structure.crystal_system")]
    return parts(spark, sf_dir).select(*names, *numbers, *flags)


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """task, label and split of every row under every regime."""
    splits = F.create_map(*[x for r in REGIMES for x in (F.lit(r), split_map(r))])
    rows = labelled(frame(spark, sf_dir), splits.alias("splits"))
    return rows.select("task", "y", F.coalesce("y_class", F.col("y").cast("string")).alias("label"), F.explode("splits").alias("regime", "split"))


def benchmark_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usable labels of every task, their mean or their number of classes."""
    rows = labelled(frame(spark, sf_dir))
    return rows.groupBy("task").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("y"), 6).alias("mean"), F.countDistinct("y_class").alias("classes"))


def benchmark_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usable_features(frame(spark, sf_dir)).select("task", F.size("features").alias("n"), F.array_join(F.array_sort("features"), ",").alias("features"))


def benchmark_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every task and regime by split, and whether the split or grouped folds judge it."""
    g = _judged(spark, sf_dir).groupBy("regime", "task").agg(F.count_if(F.col("split") == "train").alias("n_train"), F.count_if(F.col("split") == "test").alias("n_test"))
    return g.withColumn("route", F.when((F.col("n_train") >= SCARCE) & (F.col("n_test") >= SCARCE), "split").otherwise("grouped_cv"))


def benchmark_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors of the training mean for regression and ranking tasks under every regime."""
    kinds = [t.name for t in TASKS if t.kind != CLASSES]
    return baseline_errors(_judged(spark, sf_dir).where(F.col("task").isin(*kinds)), ["task", "regime"])


def benchmark_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy of the most frequent training class for every classification task and regime."""
    kinds = [t.name for t in TASKS if t.kind == CLASSES]
    return class_hits(_judged(spark, sf_dir).where(F.col("task").isin(*kinds)), ["task", "regime"], 1)


def top5_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of test rows whose space group is among the five most frequent of their crystal system in training."""
    f = frame(spark, sf_dir).where("`structure.space_group_number` is not null")
    rows = f.select(F.col("`structure.crystal_system`").alias("system"), F.col("`structure.space_group_number`").cast("int").alias("label"), split_map("random").alias("split"))
    return class_hits(rows, ["system"], 5)


def grouped_cv_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors of the mean of the other folds, averaged over folds that have rows; families stay together."""
    fold = md5_bucket(F.coalesce(F.col("`identity.family`"), F.lit("unknown"))) % FOLDS
    rows = labelled(frame(spark, sf_dir), fold.alias("fold")).where("y is not null")
    sums = rows.groupBy("task", "fold").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("s"))
    totals = sums.groupBy("task").agg(F.sum("n").alias("all_n"), F.sum("s").alias("all_s"))
    means = sums.join(F.broadcast(totals), "task").select("task", "fold", F.try_divide(F.col("all_s") - F.col("s"), F.col("all_n") - F.col("n")).alias("mean"))
    maes = rows.join(F.broadcast(means), ["task", "fold"]).groupBy("task", "fold").agg(F.avg(F.abs(F.col("y") - F.col("mean"))).alias("mae"))
    return maes.groupBy("task").agg(F.count("mae").alias("folds"), F.round(F.avg("mae"), 6).alias("mae"))


QUERIES = {f.__name__: f for f in (benchmark_labels, benchmark_features, benchmark_routes, benchmark_regression, benchmark_classes, top5_accuracy, grouped_cv_means)}


def _sql_frame() -> str:
    numbers = ", ".join(f'case when (p_partkey + {a}) % 11 <> 0 then round(((p_partkey * {a} + p_size * {b}) % {m}) * {scale!r}::double, 6) end as "{t}"' for t, (a, b, m, scale) in TARGETS.items())
    flags = ", ".join(f'case when (p_partkey + {m}) % 11 <> 0 then ((p_partkey + p_size) % {m}) % 2 = 0 end as "{t}"' for t, m in FLAGS.items())
    return f'(select p_partkey as "identity.material_id", p_brand as "identity.family", formula as "identity.formula", (p_size % 7)::varchar as "structure.crystal_system", {numbers}, {flags} from {SQL_PARTS})'


def _sql_task(t: Task) -> str:
    y = f'"{t.target}"'
    held = f"{y} is not null" + (f" and {y} <> 0" if t.kind == CLASSES and t.threshold is not None else f" and {y} > 0" if t.log10 else "") + (f" and {y} between {t.bounds[0]} and {t.bounds[1]}" if t.bounds else "")
    number = f"({y} >= {t.threshold})::int::double" if t.kind == CLASSES and t.threshold is not None else "null::double" if t.kind == CLASSES else f"log10({y})" if t.log10 else f"{y}::double"
    return f"select '{t.name}' as task, {number} as y, {f'{y}::varchar' if t.text_classes else 'null::varchar'} as y_class, f.* from f where {held}"


_bucket = lambda k: SQL_BUCKET.replace("{k}", k)
_split = lambda k: f"case when {_bucket(k)} < 100 then 'val' when {_bucket(k)} < 300 then 'test' else 'train' end"
_KEYS = {"random": '"identity.material_id"::varchar', "family_ood": '"identity.family"', "composition_ood": '"identity.formula"', "crystal_system_ood": '"structure.crystal_system"'}
_WITH = f"with f as {_sql_frame()}, l as ({' union all '.join(map(_sql_task, TASKS))})"
_JUDGED = f"{_WITH}, j as ({' union all '.join(f'''select task, y, coalesce(y_class, case when y = 1 then '1.0' when y = 0 then '0.0' end) as label, '{r}' as regime, {_split(k)} as split from l''' for r, k in _KEYS.items())})"
_NUMBERS = ", ".join(f"'{t.name}'" for t in TASKS if t.kind != CLASSES)
_NUMERIC = [t for t in TARGETS if not t.startswith(NO_FEATURE)]
SQL = {
    "benchmark_labels": f"{_WITH} select task, count(*) as n, round(avg(y), 6) as mean, count(distinct y_class) as classes from l group by 1",
    "benchmark_features": f"with f as {_sql_frame()}, c as ({' union all '.join(f'''select '{c}' as name, count("{c}") as n, count(*) as rows from f''' for c in _NUMERIC)}), t(task, banned) as (values {', '.join(f'''('{t.name}', [{', '.join(repr(x) for x in (t.target, *t.leaky))}])''' for t in TASKS)}) select task, count(*)::int as n, string_agg(name, ',' order by name) as features from t, c where c.n >= greatest(10, 0.3 * rows) and not list_contains(banned, name) group by 1",
    "benchmark_routes": f"{_JUDGED} select regime, task, count(*) filter (split = 'train') as n_train, count(*) filter (split = 'test') as n_test, case when count(*) filter (split = 'train') >= {SCARCE} and count(*) filter (split = 'test') >= {SCARCE} then 'split' else 'grouped_cv' end as route from j group by 1, 2",
    "benchmark_regression": f"{_JUDGED}, t as (select task, regime, count(*) as n_train, avg(y) as m from j where split = 'train' group by 1, 2) select task, regime, n_train, count(*) as n_test, round(avg(abs(y - m)), 6) as mae, round(sqrt(avg((y - m) ** 2)), 6) as rmse, round(1 - sum((y - m) ** 2) / greatest(var_pop(y) * count(*), 1e-12), 6) as r2 from j join t using (task, regime) where split = 'test' and task in ({_NUMBERS}) group by 1, 2, 3",
    "benchmark_classes": f"{_JUDGED}, c as (select task, regime, label, count(*) as c from j where split = 'train' group by 1, 2, 3), b as (select task, regime, label from (select *, row_number() over (partition by task, regime order by c desc, label) as r from c) where r = 1) select j.task, j.regime, count(*) as n_test, round(avg((j.label = b.label)::int) filter (b.label is not null), 6) as accuracy from j left join b on b.task = j.task and b.regime = j.regime where split = 'test' and j.task not in ({_NUMBERS}) group by 1, 2",
    "top5_accuracy": f"""with f as {_sql_frame()}, j as (select "structure.crystal_system" as system, "structure.space_group_number"::int as label, {_split(_KEYS['random'])} as split from f where "structure.space_group_number" is not null),
    c as (select system, label, row_number() over (partition by system order by count(*) desc, label) as r from j where split = 'train' group by 1, 2)
    select j.system, count(*) as n_test, round(avg((r is not null)::int), 6) as accuracy from j left join c on c.system = j.system and c.label = j.label and r <= 5 where split = 'test' group by 1""",
    "grouped_cv_means": f"""{_WITH}, r as (select task, y, {_bucket('"identity.family"')} % {FOLDS} as fold from l where y is not null),
    m as (select task, fold, (sum(sum(y)) over (partition by task) - sum(y)) / nullif(sum(count(*)) over (partition by task) - count(*), 0) as m from r group by 1, 2),
    e as (select task, fold, avg(abs(y - m)) as mae from r join m using (task, fold) group by 1, 2) select task, count(mae) as folds, round(avg(mae), 6) as mae from e group by 1""",
}
