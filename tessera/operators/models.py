"""Baselines with pyspark.ml, composition coverage by PCA, and cutoff graphs of structures."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier, RandomForestClassifier
from pyspark.ml.feature import PCA, Imputer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.splits import hash_split
from tessera.session import table, written

FEATURES = ["p_size", "n_papers", "mean_quantity", "mean_discount"]


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.countDistinct("l_suppkey").cast("double").alias("n_papers"), F.avg("l_quantity").alias("mean_quantity"), F.avg("l_discount").alias("mean_discount"))
    p = table(spark, sf_dir, "part").join(li, F.col("p_partkey") == F.col("l_partkey"), "left")
    return p.select("p_partkey", "p_brand", F.col("p_size").cast("double").alias("p_size"), "n_papers", "mean_quantity", "mean_discount", F.col("p_retailprice").alias("y"), (F.col("p_retailprice") > 1400).cast("double").alias("label"), hash_split(F.col("p_brand")).alias("split"))


def _prepared() -> list:
    filled = [f"{c}_f" for c in FEATURES]
    return [Imputer(strategy="mean", inputCols=FEATURES, outputCols=filled), VectorAssembler(inputCols=filled, outputCol="x")]


def regressors() -> dict:
    return {"ridge": LinearRegression(featuresCol="x", labelCol="y", regParam=1.0), "rf": RandomForestRegressor(featuresCol="x", labelCol="y", numTrees=20, maxDepth=6, seed=42)}


def classifiers() -> dict:
    return {"logistic": LogisticRegression(featuresCol="x", labelCol="label", maxIter=50), "rf": RandomForestClassifier(featuresCol="x", labelCol="label", numTrees=20, maxDepth=6, seed=42), "mlp": MultilayerPerceptronClassifier(featuresCol="x", labelCol="label", layers=[len(FEATURES), 8, 2], maxIter=30, seed=42)}


def ml_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean absolute error on the test families: dummy (mean), ridge, forest."""
    f = written(features(spark, sf_dir), "features")
    train, test = f.where("split = 'train'"), f.where("split = 'test'")
    mean = train.agg(F.avg("y")).head()[0]
    out = test.agg(F.lit("dummy").alias("model"), F.round(F.avg(F.abs(F.col("y") - F.lit(mean))), 4).alias("mae"))
    for name, model in regressors().items():
        fitted = Pipeline(stages=[*_prepared(), model]).fit(train)
        out = out.unionByName(fitted.transform(test).agg(F.lit(name).alias("model"), F.round(F.avg(F.abs(F.col("y") - F.col("prediction"))), 4).alias("mae")))
    return out


def class_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels as numbers in alphabetic order."""
    p = table(spark, sf_dir, "part")
    m = StringIndexer(inputCol="p_type", outputCol="i", stringOrderType="alphabetAsc").fit(p)
    return m.transform(p).groupBy("p_type", F.col("i").cast("int").alias("index")).agg(F.count(F.lit(1)).alias("n"))


def composition_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two principal components of imputed descriptors."""
    fitted = Pipeline(stages=[*_prepared(), PCA(k=2, inputCol="x", outputCol="z")]).fit(features(spark, sf_dir))
    z = vector_to_array("z")
    return fitted.transform(features(spark, sf_dir)).select("p_partkey", F.round(F.abs(z[0]), 4).alias("z1"), F.round(F.abs(z[1]), 4).alias("z2"))


def cutoff_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges between sites of a structure nearer than the cutoff, both ways; sites share a structure, so the join stays inside it.

    Vectors stand for sites: structures are their labels and buckets of 32 ids; the first three numbers are coordinates.
    """
    v = table(spark, sf_dir, "embeddings").select(F.concat_ws(":", "label", F.floor(F.col("vec_id") / 32)).alias("s"), "vec_id", *[F.col("embedding")[k].cast("double").alias(f"x{k}") for k in range(3)])
    a, b = v.toDF("s", "a", "ax", "ay", "az"), v.toDF("s", "b", "bx", "by", "bz")
    d = F.sqrt(sum((F.col(f"a{k}") - F.col(f"b{k}")) * (F.col(f"a{k}") - F.col(f"b{k}")) for k in "xyz"))
    return a.join(b, "s").where("a <> b").withColumn("d", d).where("d < 0.15").select("a", "b", F.round("d", 5).alias("distance"))


QUERIES = {f.__name__: f for f in (ml_baseline, class_index, composition_coverage, cutoff_graph)}
SQL = {
    "class_index": "select p_type, (dense_rank() over (order by p_type) - 1)::int as index, count(*) n from part group by 1",
    "cutoff_graph": "with v as (select concat_ws(':', label, vec_id // 32) s, vec_id, embedding e from embeddings), d as (select a.vec_id a, b.vec_id b, sqrt(pow(a.e[1]::double - b.e[1]::double, 2) + pow(a.e[2]::double - b.e[2]::double, 2) + pow(a.e[3]::double - b.e[3]::double, 2)) d from v a join v b on a.s = b.s and a.vec_id <> b.vec_id) select a, b, round(d, 5) distance from d where d < 0.15",
}
