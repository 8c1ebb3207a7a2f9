"""Document fingerprints: a canonical exact digest.

A text is canonical after NFKC, case folding, NFKC again and folding of white space; its fingerprint is the 128-bit
xxhash of those bytes, in hex. Rows that share a digest form a bucket. Buckets of more than one row are compared byte by byte
(smallest against largest canonical text, pre-aggregated where the rows lie, so that no bucket meets
in one task); if two texts of a bucket differ, its digest names them no longer: every text of that digest takes "<digest>-<sha256>" instead,
edited texts too.

A document's successor is the next row by descending doc_id. Rows are cut into ranges of that order; a range judges all its rows but the last, and hands
out its first and its last text, two rows a range, which are paired afterwards. The order is (doc_id descending, first characters, hash of
the text, the row's number in the scan), so that a doc_id or a text of many rows fills several ranges.

Defined results: null text is the empty text; rows that repeat a doc_id are all kept, the order among
them is by their first characters, then by hash; a null doc_id sorts after all others; other columns are ignored; in an empty table
nothing comes back; the only document is its own successor.
"""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.common import arrow_map, partitions, small, table, texts, written

#: Characters of a text that order rows of one doc_id before its hash does.
ORDER_CHARS = 64


def canonical(text: str) -> bytes:
    if text.isascii():
        return " ".join(text.lower().split()).encode()
    folded = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold())
    return " ".join(folded.split()).encode("utf-8", "surrogatepass")


def digest(data: bytes) -> str:
    return xxhash.xxh3_128_hexdigest(data)


def canonical_digests(docs: DataFrame, with_bytes: bool = False) -> DataFrame:
    """doc_id, fingerprint before byte comparison, and the canonical bytes if asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms = [canonical(t) for t in batch.column("text").to_pylist()]
            cols = {"doc_id": batch.column("doc_id"), "fingerprint": pa.array([digest(x) for x in forms], pa.string())}
            if with_bytes:
                cols["canonical"] = pa.array(forms, pa.binary())
            yield pa.RecordBatch.from_pydict(cols)

    return arrow_map(texts(docs), run, "doc_id long, fingerprint string" + ", canonical binary" * with_bytes)


def colliding(docs: DataFrame, digests: DataFrame) -> DataFrame:
    """Digests whose bucket holds different canonical texts: byte comparison of every row that shares its digest."""
    shared = digests.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("fingerprint")
    rows = canonical_digests(docs, with_bytes=True).join(small(shared), "fingerprint", "left_semi")
    ends = rows.groupBy("fingerprint").agg(F.min("canonical").alias("least"), F.max("canonical").alias("most"))
    return ends.where("least <> most").select("fingerprint")


def group_exact(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint, first_id (the bucket's smallest doc_id) and copies of every row."""
    digests = written(canonical_digests(docs), "digests")
    split = colliding(docs, digests)
    if split.limit(1).count():
        named = canonical_digests(docs, with_bytes=True).join(split.withColumn("hit", F.lit(True)), "fingerprint", "left")
        digests = named.select("doc_id", F.when(F.col("hit"), F.concat_ws("-", "fingerprint", F.sha2("canonical", 256))).otherwise(F.col("fingerprint")).alias("fingerprint"))
    groups = digests.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
    return digests.join(groups, "fingerprint").select("doc_id", "fingerprint", "first_id", "copies")


def ordered(docs: DataFrame) -> DataFrame:
    """doc_id and text in ranges of descending doc_id, sorted in each."""
    keys = [F.desc_nulls_last("doc_id"), "start", "hash", "number"]
    rows = texts(docs).withColumns({"start": F.substring("text", 1, ORDER_CHARS), "hash": F.xxhash64("text"), "number": F.monotonically_increasing_id()})
    return rows.repartitionByRange(partitions(docs.sparkSession), *keys).sortWithinPartitions(*keys).select("doc_id", "text")


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, own_sha binary, edited_sha binary, range int, end string, text string"
KINDS = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64(), "binary": pa.binary()}
RESULT = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def _judged(doc_id: int | None, own: str, own_form: bytes, text: str, form: bytes) -> tuple:
    """The row of a document whose successor has this text and canonical form."""
    n = len(own)
    edited = own[: n - n // 3] + text[: n // 3]
    edited_form = canonical(edited)
    sha = lambda data: hashlib.sha256(data).digest()
    return doc_id, n, hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), digest(own_form), digest(edited_form), float(own_form == edited_form), float(own_form == form), sha(own_form), sha(edited_form)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names, kinds = zip(*(c.split() for c in SCHEMA.split(", ")))
    return pa.RecordBatch.from_arrays([pa.array(list(c), KINDS[k]) for c, k in zip(zip(*rows), kinds)], names=list(names))


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Walks a range in order; a row is judged when its successor has come. The first text and the last row come out as ends."""
    from pyspark import TaskContext

    number = TaskContext.get().partitionId()
    held = None  # the row before: doc_id, text, canonical bytes
    ends = lambda kind, doc_id, text: (doc_id, *[None] * 8, number, kind, text)
    for batch in batches:
        out = []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            form = canonical(text)
            out.append((*_judged(*held, text, form), number, None, None) if held else ends("first", doc_id, text))
            held = doc_id, text, form
        if out:
            yield _batch(out)
    if held:
        yield _batch([ends("last", *held[:2])])


def _paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(*_judged(d, own, canonical(own), text, canonical(text)), None, None, None) for d, own, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "own", "text")))]
        if rows:
            yield _batch(rows)


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and whether they and the successor's are the same."""
    walked = written(arrow_map(ordered(docs), _compare, SCHEMA), "walked")
    inner = walked.where("end is null")
    lasts, firsts = (walked.where(F.col("end") == e) for e in ("last", "first"))
    # two rows a range: the ranges are few, whatever the documents
    numbers = lasts.select("range").withColumn("next", F.coalesce(F.lead("range").over(W.orderBy("range")), F.first("range").over(W.orderBy("range"))))
    texts_of = firsts.select(F.col("range").alias("next"), F.col("text").alias("following"))
    pairs = lasts.join(numbers, "range").join(texts_of, "next").select("doc_id", F.col("text").alias("own"), F.col("following").alias("text"))
    paired = written(arrow_map(pairs, _paired, SCHEMA), "paired")
    rows = inner.unionByName(paired).drop("range", "end", "text")
    split = split_digests(docs, rows)  # the ranges' last rows too
    if not split.limit(1).count():
        return rows.select(*RESULT)
    for name, sha in (("fingerprint", "own_sha"), ("edited_fingerprint", "edited_sha")):
        hits = split.select(F.col("fingerprint").alias("hit"))
        rows = rows.join(small(hits), F.col(name) == F.col("hit"), "left")
        rows = rows.withColumn(name, F.when(F.col("hit").isNotNull(), F.concat_ws("-", name, F.lower(F.hex(sha)))).otherwise(F.col(name))).drop("hit")
    return rows.select(*RESULT)


def split_digests(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """Digests that name different texts: own ones by byte comparison, edited ones, whose texts aren't kept, by SHA-256."""
    named = rows.select(F.explode(F.array(F.struct("fingerprint", F.col("own_sha").alias("sha")), F.struct(F.col("edited_fingerprint").alias("fingerprint"), F.col("edited_sha").alias("sha")))).alias("x")).select("x.*")
    ends = named.groupBy("fingerprint").agg(F.min("sha").alias("least"), F.max("sha").alias("most")).where("least <> most").select("fingerprint")
    return written(colliding(docs, rows.select("fingerprint")).unionByName(ends).distinct(), "split")


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_next(table(spark, sf_dir, "documents"))


QUERIES = {"op3_fingerprints": op3_fingerprints}
SQL: dict[str, str] = {}
