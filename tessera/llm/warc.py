"""WARC archives and their index: write, read back, and merge capture histories.

Writing. A record is a text: header lines, a blank line, the payload. The text writer ends records with
CRLF CRLF, as WARC does, so a part file is a WARC file, committed by Spark's own protocol to any
file system that Spark writes to. Pages are written by size class (CLASSES), each with its number of records a file,
so that a file holds about 128 MB at most, or one record. Of records with equal payloads
those of the largest page_id are responses; the others are revisits that name it and carry no payload. Files aren't
compressed by default, so that an index line's offset and length address the bytes of its file; with
compression="gzip" they address the unpacked bytes.

Reading. Archives are read as binary files and cut by Content-Length; the payload's digest is computed anew.
A scan partition packs spark.sql.files.maxPartitionBytes of files at most, or one file.

Index. Every archive file gives a run of index lines (url key, timestamp, page_id, place in the file), sorted where the
file is read and written out. Runs are cut into ranges of the global order, enough of them that a range holds about RANGE_ROWS
lines and RANGE_BYTES of keys; file and offset break ties, so that no key is too hot to be cut. In each range a
loser tree merges the slices of the runs, which stay in Arrow form and become rows a few at a time; the ranges in order are one sorted
history of captures.

Defined results: null html is the empty payload, equal to other empty ones; a null url has url key "", line ends in a url are
percent-encoded; page_id may be any long: captures are a second apart by page_id, modulo CAPTURE_SECONDS; rows without a
page_id are archived under the id null, sort before others and are responses only if no row with equal payload has an id; rows that
repeat a page_id are each archived, and with equal payloads have the same role; other
columns are ignored; an empty table gives an empty archive.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.common import arrow_map, fresh_path, partitions, small, table, written

#: Payload bytes up to which a page belongs to a class (the last has no bound), and records in a file of that class.
CLASSES = ((1 << 18, 512), (1 << 22, 32), (None, 1))
END = "\r\n"
SALTS = 16
RANGE_ROWS, RANGE_BYTES = 250_000, 128 << 20
#: Captures of a table without timestamps: a second apart by page_id, from here on.
FIRST_CAPTURE = "2024-01-01T00:00:00Z"
CAPTURE_SECONDS = 1_000_000_000


def base32_sha1(text: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: each ten hex digits are eight base-32 digits."""
    hexed = F.sha1(F.encode(text, "UTF-8"))
    parts = [F.lpad(F.conv(F.substring(hexed, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.upper(F.concat(*parts)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def url_key(url: str) -> str:
    """Host labels reversed, then the rest: org,example)/en/1."""
    rest = re.sub("^[a-z][a-z0-9+.-]*://(www[.])?", "", url.lower())
    host = re.match("[^/?#]*", rest)[0]
    return f"{','.join(reversed(host.split('.')))}){rest[len(host):] or '/'}" if rest else ""


def shared_payloads(digests: DataFrame, least_bytes: int = 0) -> DataFrame:
    """payload_digest, winner (the largest page_id) and salt of every payload that several pages have; a row per salt, so that a join can deal out a hot payload."""
    found = digests.where(F.col("payload_bytes") >= least_bytes).groupBy("payload_digest").agg(F.max("page_id").alias("winner"), F.count(F.lit(1)).alias("n"))
    return found.where("n > 1 and winner is not null").select("payload_digest", "winner", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))


def _class(size: Column) -> Column:
    found = F.lit(len(CLASSES) - 1)
    for k in range(len(CLASSES) - 2, -1, -1):
        found = F.when(size <= CLASSES[k][0], k).otherwise(found)
    return found


def _header(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), F.coalesce(value.cast("string"), F.lit("")), F.lit(END))


def write_archives(pages: DataFrame, least_bytes: int = 0, compression: str = "none") -> str:
    """Writes a record for each of page_id, url, html and returns the folder."""
    spark = pages.sparkSession
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    own = own.withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    digests = written(own.select("page_id", base32_sha1(F.col("payload")).alias("payload_digest"), "payload_bytes"), "digests")
    shared = written(shared_payloads(digests, least_bytes), "shared")
    classes = [r["class"] for r in digests.groupBy(_class(F.col("payload_bytes")).alias("class")).count().collect()] or [0]  # at most len(CLASSES) rows
    salted = own.withColumn("payload_digest", base32_sha1(F.col("payload"))).withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int"))
    rows = salted.join(small(shared), ["payload_digest", "salt"], "left")
    revisit = F.col("winner").isNotNull() & ~F.col("winner").eqNullSafe(F.col("page_id"))
    after = F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(CAPTURE_SECONDS))
    stamp = F.date_format(F.timestamp_seconds(F.unix_timestamp(F.lit(FIRST_CAPTURE), "yyyy-MM-dd'T'HH:mm:ssX") + after), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    uri = F.replace(F.replace(F.coalesce("url", F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    named = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    record = F.concat(
        F.lit(f"WARC/1.1{END}"),
        _header("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _header("WARC-Record-ID", named(F.col("page_id"))),
        _header("WARC-Date", stamp),
        _header("WARC-Target-URI", uri),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(revisit, F.concat(_header("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")), _header("WARC-Refers-To", named(F.col("winner"))), _header("X-Payload-Length", F.col("payload_bytes")))).otherwise(""),
        _header("Content-Type", F.lit("text/html; charset=utf-8")),
        _header("Content-Length", F.when(revisit, 0).otherwise(F.col("payload_bytes"))),
        F.lit(END),
        F.when(revisit, "").otherwise(F.col("payload")),
    )
    path = fresh_path(spark, "warc")
    for k in classes:
        part = rows.where(_class(F.col("payload_bytes")) == k).select(record.alias("value"))
        part.write.option("lineSep", END + END).option("compression", compression).option("maxRecordsPerFile", CLASSES[k][1]).text(f"{path}/{k}")
    return path


def records_of(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """Offset, length, headers and payload of each record of an archive file."""
    if data[:2] == b"\x1f\x8b":
        data = zlib.decompress(data, wbits=31)
    at = 0
    while data.startswith(b"WARC/", at):
        head_end = data.index(b"\r\n\r\n", at)
        lines = data[at:head_end].decode("utf-8").split("\r\n")[1:]
        headers = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}
        start = head_end + 4
        end = start + int(headers["content-length"])
        yield at, end + 4 - at, headers, data[start:end]
        at = end + 4


def _page(name: str | None) -> int | None:
    value = (name or "<urn:page:null>")[10:-1]
    return None if value == "null" else int(value)


RECORD = "url_key string, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, captured string, file string, offset long, length long, intact boolean, place int"
KINDS = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}


def batch_of(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(c.split() for c in schema.split(", ")))
    return pa.RecordBatch.from_arrays([pa.array(list(c), KINDS[k]) for c, k in zip(zip(*rows), kinds)], names=list(names))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """A row per record of the archive files in a folder, as sorted runs: place is a record's place in its file's run. intact: the payload has the digest that its header names."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", "true").load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                name, rows = "/".join(batch.column("path")[k].as_py().split("/")[-2:]), []
                for offset, length, h, payload in records_of(batch.column("content")[k].as_py()):
                    stated = h["warc-payload-digest"].removeprefix("sha1:")
                    revisit = h["warc-type"] == "revisit"
                    digest = stated if revisit else base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    rows.append((url_key(h["warc-target-uri"]), _page(h["warc-record-id"]), int(h["x-payload-length"]) if revisit else len(payload), digest, h["warc-type"], _page(h.get("warc-refers-to")) if revisit else None, h["warc-target-uri"], h["warc-date"], name, offset, length, digest == stated))
                rows.sort(key=lambda r: (r[0], r[7], r[1] is not None, r[1] or 0, r[9]))
                if rows:
                    yield batch_of([(*r, i) for i, r in enumerate(rows)], RECORD)

    return files.mapInArrow(run, RECORD)


class LoserTree:
    """Merges k sorted iterators: each inner node keeps the loser of its match, so the next item costs log2 k comparisons."""

    def __init__(self, runs: Iterable[Iterator[tuple]]):
        self.runs = [iter(r) for r in runs]
        self.k = len(self.runs)
        self.heads = [next(r, None) for r in self.runs]
        self.loser = [-1] * max(self.k, 1)
        for leaf in range(self.k):
            self._replay(leaf, building=True)

    def _before(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and x is not None
        return (x, a) < (y, b)

    def _replay(self, leaf: int, building: bool = False) -> None:
        winner, node = leaf, (leaf + self.k) // 2
        while node > 0:
            other = self.loser[node]
            if other < 0:
                if building:
                    self.loser[node] = winner
                    return
            elif self._before(other, winner):
                self.loser[node], winner = winner, other
            node //= 2
        self.loser[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while self.k and (top := self.heads[winner := self.loser[0]]) is not None:
            yield top
            self.heads[winner] = next(self.runs[winner], None)
            self._replay(winner)


INDEX = "url_key string, captured string, page_id long, file string, offset long, length long, range int, at long"
LINE = ("url_key", "captured", "page_id", "file", "offset", "length")


def merge_index(records: DataFrame) -> DataFrame:
    """Index lines in global order: partition by partition, and in each by url_key, captured, page_id, file, offset; range numbers the partitions, at counts a url key's lines in its range."""
    lines = records.select("url_key", "captured", "page_id", "file", "offset", "length", "place")
    n, size = lines.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("url_key")), F.lit(0))).head()
    ranges = max(partitions(records.sparkSession), -(-n // RANGE_ROWS), -(-size // RANGE_BYTES))
    ranged = lines.repartitionByRange(ranges, "url_key", "captured", "page_id", "file", "offset").sortWithinPartitions("file", "place")

    def slices(pieces: list[pa.RecordBatch]) -> Iterator[tuple]:
        for piece in pieces:
            for start in range(0, piece.num_rows, 64):
                part = piece.slice(start, 64)
                for u, c, p, f, o, n in zip(*(part.column(x).to_pylist() for x in LINE)):
                    yield u, c, p is not None, p or 0, f, o, n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId()
        runs: dict[str, list[pa.RecordBatch]] = {}
        for batch in batches:
            names = batch.column("file").to_pylist()
            starts = [k for k, name in enumerate(names) if not k or name != names[k - 1]]
            for start, end in zip(starts, [*starts[1:], len(names)]):
                runs.setdefault(names[start], []).append(batch.slice(start, end - start))
        out: list[tuple] = []
        last, at = None, 0
        for u, c, known, p, f, o, n in LoserTree(slices(x) for x in runs.values()):
            last, at = u, at + 1 if u == last else 1
            out.append((u, c, p if known else None, f, o, n, number, at))
            if len(out) == 4096:
                yield batch_of(out, INDEX)
                out = []
        if out:
            yield batch_of(out, INDEX)

    return arrow_map(ranged, run, INDEX)


def capture_histories(records: DataFrame) -> DataFrame:
    """The merged index with capture_no: the place in the url key's history, counted over ranges by their totals."""
    index = written(merge_index(records), "index")
    totals = index.groupBy("url_key", "range").agg(F.max("at").alias("n"))
    before = totals.select("url_key", "range", (F.sum("n").over(W.partitionBy("url_key").orderBy("range")) - F.col("n")).alias("before")).where("before > 0")
    return index.join(small(before), ["url_key", "range"], "left").select(*LINE, (F.col("at") + F.coalesce("before", F.lit(0))).cast("long").alias("capture_no"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_archives(table(spark, sf_dir, "pages"))
    records = written(read_archives(spark, path), "records")
    history = capture_histories(records).select("file", "offset", "url_key", "capture_no")
    return records.drop("url_key").join(history, ["file", "offset"]).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact", "url_key", "captured", "capture_no")


QUERIES = {"op5_warc": op5_warc}
SQL: dict[str, str] = {
    "op5_warc": """
    with own as (select page_id, coalesce(url, '') as url, coalesce(html, '') as payload, sha1(coalesce(html, '')) as h from pages),
    groups as (select h, max(page_id) as winner from own group by h),
    -- five hex digits are four of base 32
    named as (
      select own.*, winner,
        list_aggregate(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
          (((('0x' || substr(own.h, 1 + 5 * (k // 4), 5))::BIGINT >> (15 - 5 * (k % 4))) & 31) + 1)::BIGINT, 1)), 'string_agg', '') as digest,
        regexp_replace(lower(replace(replace(url, chr(13), '%0D'), chr(10), '%0A')), '^[a-z][a-z0-9+.-]*://(www[.])?', '') as rest,
        strftime(timestamp '2024-01-01' + to_seconds(((page_id % 1000000000) + 1000000000) % 1000000000), '%Y-%m-%dT%H:%M:%SZ') as captured
      from own join groups using (h)),
    cut as (select *, regexp_extract(rest, '^([^/?#]*)', 1) as host from named),
    keyed as (
      select *, case when rest = '' then '' else array_to_string(list_reverse(string_split(host, '.')), ',') || ')'
        || case when length(rest) = length(host) then '/' else substr(rest, length(host) + 1) end end as url_key from cut)
    select page_id, strlen(payload)::BIGINT as payload_bytes, digest as payload_digest,
      case when page_id = winner then 'response' else 'revisit' end as record_type,
      case when page_id <> winner then winner end as refers_to, true as intact, url_key, captured,
      row_number() over (partition by url_key order by captured, page_id) as capture_no
    from keyed""",
}
