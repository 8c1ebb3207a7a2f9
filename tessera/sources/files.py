"""File sources and sinks: schema-merging Parquet, staged partitions, nested JSON queues, JSON lines, CSV, XML, checksums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_merged(spark: SparkSession, *paths: str) -> DataFrame:
    """Union of files of differing schemas."""
    return spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true").parquet(*paths)


def write_staged(df: DataFrame, path: str, *by: str, mode: str = "append") -> None:
    """Partitioned by every row's own keys; rows of a key are gathered before, so that files stay few."""
    df.repartition(*by).write.mode(mode).partitionBy(*by).parquet(path)


def read_queue(spark: SparkSession, path: str, item_schema: str | None = None) -> DataFrame:
    """A document {version, updated_at, items[]} as one row per item, with its ordinal."""
    reader = spark.read.option("multiLine", "true")
    doc = (reader.schema(f"version string, updated_at string, items array<struct<{item_schema}>>") if item_schema else reader).json(path)
    return doc.select("version", F.posexplode("items").alias("ordinal", "item")).select("version", "ordinal", "item.*")


def append_events(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def export_approved(queue: DataFrame, path: str) -> None:
    """Approved items with the edited value, where there is one."""
    value = F.coalesce("edited_value", "value") if "edited_value" in queue.columns else F.col("value")
    queue.where("status = 'approved'").withColumn("value", value).write.mode("overwrite").parquet(path)


def flat(df: DataFrame, separator: str = ".") -> DataFrame:
    """Structs as columns named by their path; arrays and maps stay."""

    def walk(schema: StructType, prefix: tuple[str, ...]) -> list[Column]:
        out = []
        for f in schema.fields:
            at = (*prefix, f.name)
            if isinstance(f.dataType, StructType):
                out += walk(f.dataType, at)
            else:
                out.append(F.col(".".join(f"`{x}`" for x in at)).alias(separator.join(at)))
        return out

    return df.select(*walk(df.schema, ()))


def placeholder_to_null(c: Column) -> Column:
    """'na' and blanks as null, numbers as doubles."""
    t = F.lower(F.trim(c.cast("string")))
    return F.when(~t.isin("na", "n/a", "", "nan", "none"), c.cast("string")).try_cast("double")


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """SHA-256 of every file below a path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "length", F.sha2("content", 256).alias("sha256"))


def missing_only(candidates: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Resume: keys that aren't landed yet."""
    return candidates.join(done.select(key), key, "left_anti")


def json_response(text: Column, schema: str) -> Column:
    """A model's answer: JSON, else the outermost [...] slice, else the {...} slice, else null."""
    array = F.regexp_extract(text, r"(?s)(\[.*\])", 1)
    single = F.regexp_extract(text, r"(?s)(\{.*\})", 1)
    return F.coalesce(F.from_json(F.nullif(array, F.lit("")), f"array<struct<{schema}>>"), F.array(F.from_json(F.nullif(single, F.lit("")), f"struct<{schema}>")))


def tables_of_tei(xml: Column) -> Column:
    """Cells of the tables in a TEI document."""
    return F.xpath(xml, F.lit("//table/row/cell/text()"))


def write_csv(df: DataFrame, path: str) -> None:
    """Comma-separated files with a header; text is quoted where it must be."""
    df.write.mode("overwrite").option("header", "true").option("escape", '"').csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.option("header", "true").option("escape", '"').option("multiLine", "true").schema(schema).csv(path)


def write_consensus(groups: DataFrame, path: str) -> None:
    """Groups as Parquet without their members, and as JSON lines with them."""
    groups.drop("measurements", "outliers").write.mode("overwrite").parquet(f"{path}/parquet")
    groups.write.mode("overwrite").json(f"{path}/json")


def markdown_table(caption: Column, headers: Column, rows: Column) -> Column:
    """A pipe table: caption in bold, head, rule, rows; what is missing is left out. rows: arrays of cells."""
    line = lambda cells: F.concat(F.lit("| "), F.array_join(cells, " | ", ""), F.lit(" |"))
    head = F.when(F.size(F.coalesce(headers, F.array().cast("array<string>"))) > 0, F.array(line(headers), line(F.transform(headers, lambda h: F.lit("---")))))
    title = F.when(caption != "", F.array(F.concat(F.lit("**"), caption, F.lit("**"))))
    none = F.array().cast("array<string>")
    return F.array_join(F.concat(F.coalesce(title, none), F.coalesce(head, none), F.coalesce(F.transform(rows, line), none)), "\n")


#: Fields of an extraction result's evidence that a queue item takes as they are.
ITEM_FIELDS = ("composition", "family", "property", "value", "temperature_celsius", "conductivity_type", "measurement_method", "evidence_sentence", "page", "section", "table_number", "source", "confidence", "issues")
_EVIDENCE = "evidence_id string, doi string, composition string, family string, property string, value double, unit string, normalized_unit string, temperature_celsius double, conductivity_type string, measurement_method string, evidence_sentence string, page int, section string, table_number string, source string, is_primary boolean, confidence double, issues array<string>, valid boolean"


def queue_items(spark: SparkSession, path: str) -> DataFrame:
    """Pending review items of every per-paper result below a path (one JSON document a file, in a folder named by its paper); evidence that is marked invalid is left out."""
    docs = spark.read.option("multiLine", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").schema(f"doi string, evidence array<struct<{_EVIDENCE}>>").json(path)
    rows = docs.select(F.element_at(F.split("_metadata.file_path", "/"), -2).alias("paper_id"), F.col("doi").alias("paper_doi"), F.explode("evidence").alias("e")).where("coalesce(e.valid, true)")
    return rows.select(
        F.concat(F.lit("review_"), F.coalesce("e.evidence_id", F.lit(""))).alias("review_id"), "e.evidence_id", "paper_id", F.coalesce("e.doi", "paper_doi").alias("doi"), *[f"e.{c}" for c in ITEM_FIELDS],
        F.coalesce("e.normalized_unit", "e.unit").alias("unit"), F.coalesce("e.is_primary", F.lit(True)).alias("is_primary"), F.lit("pending").alias("status"),
        *[F.lit(None).cast("string").alias(c) for c in ("reviewed_at", "reviewer", "review_note", "edited_unit")], F.lit(None).cast("double").alias("edited_value"),
    )


def with_cached_metadata(papers: DataFrame, cache: DataFrame) -> DataFrame:
    """papers with title, authors, journal and year of a cache of look-ups by doi, where they have none; unknown ones stay null."""
    names = [c for c in ("title", "authors", "journal", "year") if c in cache.columns]
    first = cache.groupBy(F.lower(F.trim("doi")).alias("_doi")).agg(F.min(F.struct(*names)).alias("_m"))
    j = papers.join(first, F.lower(F.trim(papers["doi"])) == F.col("_doi"), "left")
    kept = [F.coalesce(F.col(c), F.col(f"_m.{c}")).alias(c) if c in names else F.col(f"`{c}`") for c in papers.columns]
    return j.select(*kept, *[F.col(f"_m.{c}").alias(c) for c in names if c not in papers.columns])
