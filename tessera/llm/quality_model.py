"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader, sparse dot products.

Tokens are runs of word characters (lower case) and runs of other signs. Unigrams and bigrams are hashed into 2^BITS
buckets with the value 1 + ln(count), scaled to length 1. Training takes labelled documents outside the held-out third, one row
for each doc_id: the first FIT_DOCS in hash order, and of these as many as FIT_BYTES of features hold, so that growth of the
corpus changes the sample's rate, not its kind. They are hashed in parallel
and learned one by one in a single task, whose input both bounds hold. The result is one vector of 2^BITS
weights, which is broadcast.

Defined results: null and empty texts have only the intercept; labels that are null or of unknown documents
are ignored, repeated ones count once, a document with contrary labels is left out; without labels every score is 0.5; a null doc_id isn't held out; rows that
repeat a doc_id are scored one by one, and one of them (the smallest by its text's hash) is learned; other columns are ignored. Texts are read whole.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import arrow_map, small, table, texts, written

BITS = 18
FIT_DOCS = 8_000
FIT_BYTES = 128 << 20
UPDATES = 24_000
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.3, 1.0
KEPT_TOKENS = 500_000

TOKEN = re.compile(r"\w+|[^\w\s]+")
MASK = np.uint32((1 << BITS) - 1)
INTERCEPT = 0
_HASHES: dict[str, int] = {}


def _hash(token: str) -> int:
    value = xxhash.xxh32_intdigest(token.encode("utf-8", "surrogatepass"))
    if len(_HASHES) >= KEPT_TOKENS:
        _HASHES.clear()
    _HASHES[token] = value
    return value


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values; bucket 0 is the intercept."""
    tokens = TOKEN.findall(text.lower())
    if not tokens:
        return np.array([INTERCEPT], dtype=np.uint32), np.array([1.0], dtype=np.float32)
    get = _HASHES.get
    h = np.array([v if (v := get(t)) is not None else _hash(t) for t in tokens], dtype=np.uint32)
    pairs = (h[:-1] * np.uint32(0x9E3779B1)) ^ (h[1:] * np.uint32(0x85EBCA77))
    at, count = np.unique(np.concatenate([h, pairs ^ (pairs >> np.uint32(15))]) & MASK, return_counts=True)
    value = 1 + np.log(count, dtype=np.float32)
    value /= np.sqrt((value * value).sum())
    keep = at != INTERCEPT
    return np.concatenate([np.array([INTERCEPT], dtype=np.uint32), at[keep]]), np.concatenate([np.array([1.0], dtype=np.float32), value[keep]])


def sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-max(-35.0, min(35.0, x))))


class Leader:
    """FTRL-proximal: per-bucket sums z and n; a weight is zero while |z| is under L1."""

    def __init__(self):
        self.z, self.n = np.zeros(1 << BITS), np.zeros(1 << BITS)

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z = self.z[at]
        rest = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
        return -rest / ((BETA + np.sqrt(self.n[at])) / ALPHA + L2)

    def learn(self, at: np.ndarray, value: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = (sigmoid(float(w @ value)) - label) * value
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fitted_rows(docs: DataFrame, labels: DataFrame, fit_docs: int = FIT_DOCS, fit_bytes: int = FIT_BYTES) -> DataFrame:
    """turn, label, at, value of the documents that are learned: at most fit_docs rows and fit_bytes (or one row)."""
    known = labels.where(F.col("quality").isin(0, 1)).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    known = known.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("most"))
    present = known.where("label = most").join(docs.select(F.col("doc_id").cast("long").alias("doc_id")), "doc_id", "left_semi")
    first = present.select("doc_id", "label", F.xxhash64(F.lit("fit"), "doc_id").alias("turn")).orderBy("turn", "doc_id").limit(fit_docs)
    rows = texts(docs).join(small(written(first, "known")), "doc_id").select("doc_id", "turn", "label", "text")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("text").to_pylist()
            pairs = [features(t) for t in own]
            hashes = pa.array([xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass")) - (1 << 63) for t in own], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "turn", "label")), hashes, pa.array([a.tobytes() for a, _ in pairs], pa.binary()), pa.array([v.tobytes() for _, v in pairs], pa.binary())], names=["doc_id", "turn", "label", "hash", "at", "value"])

    found = arrow_map(rows, hashed, "doc_id long, turn long, label int, hash long, at binary, value binary")
    one = found.groupBy("doc_id", "turn", "label").agg(F.min(F.struct("hash", "at", "value")).alias("f"))
    sized = written(one.select("doc_id", "turn", "label", "f.at", "f.value", F.octet_length("f.at").alias("size")), "features")
    total, last = 0, None
    for r in sized.select("turn", "doc_id", "size").orderBy("turn", "doc_id").collect():  # at most fit_docs rows
        total += 2 * r["size"]
        if last is not None and total > fit_bytes:
            break
        last = r["turn"], r["doc_id"]
    return sized.where(F.struct("turn", "doc_id") <= F.struct(*[F.lit(x).cast("long") for x in last])) if last else sized


def fit(docs: DataFrame, labels: DataFrame, fit_docs: int = FIT_DOCS, fit_bytes: int = FIT_BYTES) -> bytes:
    """The weight vector (float32) learned from labels.quality of documents outside the held-out third."""
    rows = fitted_rows(docs, labels, fit_docs, fit_bytes).select("turn", "doc_id", "label", "at", "value")

    def learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(label, np.frombuffer(a, dtype=np.uint32), np.frombuffer(v, dtype=np.float32)) for b in batches for label, a, v in zip(*(b.column(c).to_pylist() for c in ("label", "at", "value")))]
        leader = Leader()
        for _ in range(min(30, max(2, -(-UPDATES // max(1, len(rows)))))):
            for label, at, value in rows:
                leader.learn(at, value, label)
        yield pa.RecordBatch.from_pydict({"w": pa.array([leader.weights(slice(None)).astype(np.float32).tobytes()], pa.binary())})

    found = arrow_map(rows.repartition(1).sortWithinPartitions("turn", "doc_id"), learned, "w binary").head()
    return bytes(found["w"]) if found else np.zeros(1 << BITS, dtype=np.float32).tobytes()


def score(docs: DataFrame, weights: bytes) -> DataFrame:
    """doc_id and score of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = np.frombuffer(shared.value, dtype=np.float32)
        for batch in batches:
            scores = [sigmoid(float(w[at] @ value)) for at, value in map(features, batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return arrow_map(texts(docs), run, "doc_id long, score double")


def op10_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


QUERIES = {"op10_quality_model": op10_quality_model}
SQL: dict[str, str] = {}
