"""N-gram Jaccard join: MinHash banding, then verification on full n-gram sets.

A text's set holds its runs of N words (64-bit hashes); a text of fewer words has one run of all of them.
Rows with equal sets are one representative from there on (pre-aggregated, so that a third of all rows being
copies costs nothing). Representatives are hashed into bands; bands x rows are chosen so that a pair at the threshold
shares a band with probability TARGET_RECALL. A band that two or more representatives share is led by the smallest; the leader of a
representative is the smallest one that leads any of its bands.

Only representatives that share a band have their n-gram sets moved. Leaders follow their own leaders HOPS times, so that the fragments of a large
group come together; the representatives of such a head are dealt into tiles of about BLOCK
representatives and BLOCK_BYTES of sets, at most TILES tiles, which grow with a larger group. Two tiles are compared if some band holds representatives of both: tiles meet in
bands, never representatives, and tiles that only a chain of bands joins are not compared. Each such pair of tiles is a group of rows, and in it all set sizes and
overlaps are computed as matrix products, a block of each tile at a time (sets beyond BLOCK_BYTES wait in a temporary file of the task): a row comes out per representative and
group, with the number of its links and the smallest representative that links lead to, never a row per pair. No bucket is capped: a set of a group of m representatives is
moved at most TILES times for its head, whatever m; comparing them all stays work in the square of m, inside the tasks.
Groups are numbered and dealt to tasks by number. The verified links give the classes.

Result: a row per document with class_id, the smallest doc_id of its class, and n_links, the number of other
documents at the threshold or over, copies included.

Defined results: null and empty texts have no words, link to nothing and are their own class; rows that repeat
a doc_id with the same text come back each and link to one another; rows that repeat it with other texts are one
document in one class; a row without a doc_id takes no part, its class_id is null and n_links 0; other columns are ignored.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import arrow_map, columns_of, partitions, small, table, texts, written
from tessera.llm.graph import components

N = 5
THRESHOLD = 0.8
TARGET_RECALL = 0.999999
ROWS = 6
BLOCK = 128
BLOCK_BYTES = 32 << 20
#: Tiles of a head at most, and how often leaders follow their leaders.
TILES, HOPS = 16, 2
SEED = 7
COLUMNS = 8192


def bands_for(threshold: float, recall: float, rows: int = ROWS) -> int:
    """The fewest bands of `rows` rows at which a pair at the threshold shares one with probability `recall`."""
    return int(np.ceil(np.log(1 - recall) / np.log(1 - threshold**rows)))


def gram_set(text: str, n: int = N) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word n-grams."""
    words = text.encode("utf-8", "surrogatepass").split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    grams = [b" ".join(words[k : k + n]) for k in range(max(1, len(words) - n + 1))]
    return np.unique(np.fromiter(map(xxhash.xxh3_64_intdigest, grams), dtype=np.uint64, count=len(grams)))


def permutations(count: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(SEED)
    return random.integers(1, 1 << 32, count, dtype=np.uint64).astype(np.uint32) | np.uint32(1), random.integers(0, 1 << 32, count, dtype=np.uint64).astype(np.uint32)


def min_hashes(grams: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each permutation the smallest value over the grams, of a 32-bit multiply, xor-shift, multiply hash."""
    x = (grams ^ (grams >> np.uint64(29))).astype(np.uint32)
    out = np.empty(len(a), dtype=np.uint32)
    for k in range(0, len(a), 32):
        h = x[None, :] * a[k : k + 32, None]
        h ^= h >> np.uint32(15)
        h *= b[k : k + 32, None] | np.uint32(1)
        out[k : k + 32] = h.min(axis=1)
    return out


def _signatures(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """doc_id, the set's digest (hi, lo), its size, and a key per band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = permutations(bands * rows)
        salt = [k.to_bytes(2, "little") for k in range(bands)]
        for batch in batches:
            digests, sizes, keys = [], [], []
            for text in batch.column("text").to_pylist():
                grams = gram_set(text, n)
                digests.append(xxhash.xxh3_128_digest(grams.tobytes()))
                sizes.append(len(grams))
                if len(grams):
                    m = min_hashes(grams, a, b).reshape(bands, rows)
                    keys.append([xxhash.xxh3_64_intdigest(s + r.tobytes()) - (1 << 63) for s, r in zip(salt, m)])
                else:
                    keys.append([])
            halves = np.frombuffer(b"".join(digests), dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "hi": pa.array(halves[:, 0]), "lo": pa.array(halves[:, 1]), "size": pa.array(sizes, pa.int32()), "bands": pa.array(keys, pa.list_(pa.int64()))})

    return arrow_map(texts(docs), run, "doc_id long, hi long, lo long, size int, bands array<long>")


def _sets(docs: DataFrame, n: int) -> DataFrame:
    """v, leader, part, copies, text -> the same with the n-gram set as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = [gram_set(t, n).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("v", "leader", "part", "copies")), pa.array(grams, pa.binary())], names=["v", "leader", "part", "copies", "grams"])

    return arrow_map(docs, run, "v long, leader long, part int, copies long, grams binary")


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """|x & y| for each x of left and y of right. Grams that occur once can't be shared; the others are columns, a slice at a time."""
    values = np.concatenate(left + right)
    rows = np.repeat(np.arange(len(left) + len(right)), [len(g) for g in left + right])
    distinct, column, count = np.unique(values, return_inverse=True, return_counts=True)
    numbered = np.cumsum(count > 1) - 1
    keep = count[column] > 1
    rows, column = rows[keep], numbered[column[keep]]
    order = np.argsort(column, kind="stable")
    rows, column = rows[order], column[order]
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    for start in range(0, int(numbered[-1]) + 1 if len(numbered) else 0, COLUMNS):
        lo, hi = np.searchsorted(column, [start, start + COLUMNS])
        block = np.zeros((len(left) + len(right), min(COLUMNS, int(numbered[-1]) + 1 - start)), dtype=np.float32)
        block[rows[lo:hi], column[lo:hi] - start] = 1
        out += block[: len(left)] @ block[len(left) :].T
    return out.astype(np.int64)


def linked(left: list[np.ndarray], right: list[np.ndarray], threshold: float) -> np.ndarray:
    """Jaccard >= threshold, in integers: the threshold is taken to six decimals."""
    common = overlaps(left, right)
    union = np.array([len(g) for g in left])[:, None] + np.array([len(g) for g in right])[None, :] - common
    return common * 1_000_000 >= union * round(threshold * 1_000_000)


class _Group:
    """The rows of a pair of tiles; sides: 1 in the first tile, 2 in the second, 3 where both are one."""

    def __init__(self) -> None:
        self.seen, self.v, self.copies, self.side, self.size = set(), [], [], [], []
        self.sets = tempfile.SpooledTemporaryFile(max_size=BLOCK_BYTES)

    def add(self, v: int, side: int, copies: int, grams: bytes) -> None:
        key = v, xxhash.xxh3_128_digest(grams)
        if key in self.seen:
            return
        self.seen.add(key)
        self.sets.write(grams)
        for column, x in ((self.v, v), (self.copies, copies), (self.side, side), (self.size, len(grams))):
            column.append(x)

    def blocks(self, side: int) -> list[np.ndarray]:
        """The numbers of the rows of a side, in blocks by rows and bytes."""
        out, taken = [], 0
        for k in (k for k, s in enumerate(self.side) if s & side):
            if not out or len(out[-1]) >= BLOCK or taken + self.size[k] > BLOCK_BYTES:
                out.append([])
                taken = 0
            out[-1].append(k)
            taken += self.size[k]
        return [np.array(x) for x in out]

    def loaded(self, block: np.ndarray) -> list[np.ndarray]:
        out = []
        for k in block.tolist():
            self.sets.seek(int(self.start[k]))
            out.append(np.frombuffer(self.sets.read(self.size[k]), dtype=np.uint64))
        return out

    def judged(self, threshold: float) -> pa.RecordBatch:
        self.start = np.concatenate([[0], np.cumsum(self.size, dtype=np.int64)])
        v, copies = np.array(self.v, dtype=np.int64), np.array(self.copies, dtype=np.int64)
        links = np.zeros(len(v), dtype=np.int64)
        parent = {x: x for x in self.v}

        def find(x: int) -> int:
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        one = all(s == 3 for s in self.side)
        rights = self.blocks(2)
        for i, left in enumerate(self.blocks(1)):
            own = self.loaded(left)
            for right in rights[i:] if one else rights:  # within one tile the blocks of both sides are the same
                same = one and right is rights[i]
                hits = linked(own, own if same else self.loaded(right), threshold) & (v[left][:, None] != v[right][None, :])
                links[left] += hits @ copies[right]
                if not same:
                    links[right] += hits.T @ copies[left]
                for x, low in zip(np.concatenate([v[left], v[right]]).tolist(), np.concatenate(_lowest(hits, v[left], v[right])).tolist()):
                    x, low = sorted((find(x), find(low)))
                    parent[low] = x
        out = [(x, n, find(x)) for x, n in zip(self.v, links.tolist()) if n]
        columns = list(zip(*out)) if out else [[], [], []]
        return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], names=["v", "links", "low"])


def _lowest(hits: np.ndarray, vl: np.ndarray, vr: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the rows of both sides the smallest id that hits lead to: until none falls."""
    al, ar = vl.copy(), vr.copy()
    far = np.iinfo(np.int64).max
    ids = np.unique(np.concatenate([vl, vr]))
    while True:
        low = np.full(len(ids), far)
        np.minimum.at(low, np.searchsorted(ids, vl), np.minimum(al, np.where(hits, ar[None, :], far).min(axis=1, initial=far)))
        np.minimum.at(low, np.searchsorted(ids, vr), np.minimum(ar, np.where(hits, al[:, None], far).min(axis=0, initial=far)))
        bl, br = low[np.searchsorted(ids, vl)], low[np.searchsorted(ids, vr)]
        if (bl == al).all() and (br == ar).all():
            return al, ar
        al, ar = bl, br


def _verify(threshold: float):
    """Rows of a group (a pair of tiles) lie together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows = None, _Group()
        for batch in batches:
            for pair, v, side, copies, grams in zip(*(batch.column(k).to_pylist() for k in ("pair", "v", "side", "copies", "grams"))):
                if pair != group:
                    if len(rows.v) > 1:
                        yield rows.judged(threshold)
                    rows.sets.close()
                    group, rows = pair, _Group()
                rows.add(v, side, copies, grams)
        if len(rows.v) > 1:
            yield rows.judged(threshold)
        rows.sets.close()

    return run


def block_pairs(members: DataFrame, blocks: DataFrame) -> DataFrame:
    """pair (a number), leader, part, side: the pairs of blocks that share a band, a row for each of a pair's blocks (one row where both are one).

    members: band, v of every representative in a shared band; blocks: v, leader, part.
    """
    found = members.join(small(blocks.select("v", F.struct("leader", "part").alias("block"))), "v").select("band", "block").distinct()
    mixed = found.groupBy("band").agg(F.min("block").alias("least"), F.max("block").alias("most")).where("least < most").select("band")
    meeting = written(found.join(small(mixed), "band"), "meeting")
    across = meeting.join(meeting.withColumnRenamed("block", "other"), "band").where("block < other").select("block", "other").distinct()
    inside = blocks.groupBy("leader", "part").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.struct("leader", "part").alias("block"), F.struct("leader", "part").alias("other"))
    pairs = written(across.unionByName(inside), "pairs").withColumn("pair", F.monotonically_increasing_id())
    ends = F.when(F.col("block") == F.col("other"), F.array(F.struct(F.col("block"), F.lit(3).alias("side")))).otherwise(F.array(F.struct(F.col("block"), F.lit(1).alias("side")), F.struct(F.col("other").alias("block"), F.lit(2).alias("side"))))
    return pairs.select("pair", F.explode(ends).alias("x")).select("pair", "x.block.leader", "x.block.part", "x.side")


def jaccard_classes(docs: DataFrame, threshold: float = THRESHOLD, n: int = N, recall: float = TARGET_RECALL, rows: int = ROWS) -> DataFrame:
    """doc_id, class_id, n_links of every row of docs."""
    spark = docs.sparkSession
    bands = bands_for(threshold, recall, rows)
    signed = written(_signatures(docs.where("doc_id is not null"), n, bands, rows), "signatures")
    # a set's name is its smallest doc_id; copies meet where the rows lie
    named = signed.where("size > 0").groupBy("hi", "lo").agg(F.min("doc_id").alias("v"), F.count(F.lit(1)).alias("copies"), F.any_value("bands").alias("bands"), F.any_value("size").alias("size"))
    named = written(named, "sets")
    reps = named.select("v", F.explode("bands").alias("band")).distinct()
    shared = reps.groupBy("band").agg(F.min("v").alias("a"), F.max("v").alias("z")).where("a < z").select("band", "a")
    members = written(reps.join(shared, "band"), "members")
    own = members.groupBy("v").agg(F.min("a").alias("leader")).join(named.groupBy("v").agg(F.max("copies").alias("copies"), F.sum("size").alias("size")), "v")
    own = written(own, "leaders")
    heads = own.select("leader").distinct().withColumn("head", F.col("leader"))
    up = own.select(F.col("v").alias("head"), F.col("leader").alias("up"))
    for _ in range(HOPS):
        heads = written(up.join(small(heads), "head").select("leader", F.col("up").alias("head")), "heads")
    own = written(own.join(small(heads), "leader").select("v", "leader", "head", "copies", "size"), "headed")
    # representatives of one leader stay together where they fit into a tile
    count = F.least(F.lit(TILES), F.greatest(F.ceil(F.sum("n") / BLOCK), F.ceil(F.sum("size") * 8 / BLOCK_BYTES))).cast("int")
    led = own.groupBy("head", "leader").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"))
    parts = led.groupBy("head").agg(count.alias("parts"))
    led = led.join(parts, "head").select("leader", "parts", ((F.col("n") <= BLOCK) & (F.col("size") * 8 <= BLOCK_BYTES)).alias("together"))
    part = F.pmod(F.xxhash64(F.lit(SEED), F.when(F.col("together"), F.col("leader")).otherwise(F.col("v"))), F.col("parts")).cast("int")
    active = written(own.join(small(led), "leader").select("v", F.col("head").alias("leader"), part.alias("part"), "copies"), "active")
    pairs = written(block_pairs(members, active.select("v", "leader", "part")), "block-pairs")
    sets = _sets(texts(docs).join(small(active), F.col("doc_id") == F.col("v")).select("v", "leader", "part", "copies", "text"), n)
    tasks = partitions(spark)
    dealt = sets.join(small(pairs), ["leader", "part"]).select("pair", "v", "side", "copies", "grams")
    dealt = dealt.repartitionById(tasks, F.pmod("pair", F.lit(tasks)).cast("int")).sortWithinPartitions("pair")
    found = written(arrow_map(dealt, _verify(threshold), "v long, links long, low long"), "links")
    classes = components(found.where("v <> low").select(F.col("v").alias("a"), F.col("low").alias("b")))
    counts = found.groupBy("v").agg(F.sum("links").alias("links"))
    own = named.join(classes, "v", "left").join(counts, "v", "left")
    own = own.select("hi", "lo", F.coalesce("label", "v").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"))
    result = signed.where("size > 0").select("doc_id", "hi", "lo").join(written(own, "classes"), ["hi", "lo"]).select("doc_id", "class_id", "n_links")
    alone = signed.where("size = 0").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    nameless = docs.where("doc_id is null").select(*[F.lit(v).cast("long").alias(c) for c, v in (("doc_id", None), ("class_id", None), ("n_links", 0))])
    return result.unionByName(alone).unionByName(nameless)


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """docs without the near copies: of each class the row of the smallest doc_id stays; rows without a doc_id stay."""
    classes = jaccard_classes(docs, **options)
    gone = written(classes.where("doc_id <> class_id").select("doc_id").distinct(), "copies")
    return docs.join(small(gone), "doc_id", "left_anti").select(*columns_of(docs))


def op1_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(table(spark, sf_dir, "documents"))


QUERIES = {"op1_jaccard": op1_jaccard}
SQL: dict[str, str] = {}
