from __future__ import annotations

import hashlib
import re

import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.llm import fingerprints as fp
from tessera.llm import licenses as li


def brute_next(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    for k, (doc_id, text) in enumerate(order):
        own, nxt = text or "", order[(k + 1) % len(order)][1] or ""
        n = len(own)
        yield doc_id, n, hashlib.sha256((own[: n - n // 3] + nxt[: n // 3]).encode()).hexdigest(), fp.digest(fp.canonical(own)), float(fp.canonical(own) == fp.canonical(nxt))


def test_successors_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(fp, "partitions", lambda spark: 23)
    rows = [(k * 3 - 50, f"text {k % 5} é" * (k % 9)) for k in range(100)] + [(5, "A  b"), (4, "a b"), (None, "null id"), (1000, None), (1001, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = fp.compare_with_next(df).collect()
    assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256, r.fingerprint, r.near_next) for r in got) == sorted((str(a), *rest) for a, *rest in brute_next(rows))


def test_hot_ids_long_texts_and_clashing_columns(spark, monkeypatch):
    monkeypatch.setattr(fp, "partitions", lambda spark: 9)
    rows = [(None, f"no id {k}") for k in range(300)] + [(7, "same")] * 300 + [(8, f"{k:03d} own") for k in range(300)] + [(9, "x" * 3_000_000), (10, "Y " * 500_000)]
    df = spark.createDataFrame([(d, t, "z", 1) for d, t in rows], "doc_id long, text string, fingerprint string, start int")
    placed = fp.ordered(df).groupBy(F.spark_partition_id()).count().collect()
    assert len(placed) == 9 and max(r["count"] for r in placed) < 300
    got = fp.compare_with_next(df).collect()
    assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256, r.fingerprint, r.near_next) for r in got) == sorted((str(a), *rest) for a, *rest in brute_next(rows))


def test_a_collision_renames_every_text_of_the_digest(spark, monkeypatch):
    """With a digest of one hex digit equal texts keep equal fingerprints and different ones get different, edited texts included."""
    rows = [(k, f"text number {k % 40}") for k in range(60)] + [(1000, "text number 5"), (1001, "text number 6")]
    monkeypatch.setattr(fp, "digest", lambda data: hashlib.sha256(data).hexdigest()[:1])
    one = {r.doc_id: r for r in _in_process(spark, rows)}
    own = {d: fp.canonical(t) for d, t in rows}
    order = sorted(rows, reverse=True)
    edited = {d: fp.canonical(t[: len(t) - len(t) // 3] + order[(k + 1) % len(order)][1][: len(t) // 3]) for k, (d, t) in enumerate(order)}
    names = {}
    for d, r in one.items():
        for form, name in ((own[d], r.fingerprint), (edited[d], r.edited_fingerprint)):
            assert names.setdefault(form, name) == name
    assert len(set(names.values())) == len(names)


@pytest.mark.parametrize("rows", [[(2, "ab"), (1, "ac")], [(1, "abcdef")]])
def test_the_last_row_of_a_range_collides(spark, monkeypatch, rows):
    """Its own text with another row's, and its edited text with its own: it is judged apart from the rows of its range."""
    monkeypatch.setattr(fp, "digest", lambda data: data[:1].hex())
    got = _in_process(spark, rows)
    names = {r.fingerprint for r in got} | {r.edited_fingerprint for r in got}
    assert names == {f"61-{hashlib.sha256(t).hexdigest()}" for t in ([b"ab", b"ac"] if len(rows) == 2 else [b"abcdef", b"abcdab"])}


def _in_process(spark, rows):
    """compare_with_next with the steps of Python run here, so that a patched digest holds."""
    def here(df, fn, schema):
        table = df.coalesce(1).toArrow()
        return spark.createDataFrame(pa.Table.from_batches(list(fn(iter(table.to_batches()))) or [], schema=_arrow(schema)).to_pylist(), schema)

    import pyspark

    class Context:
        @staticmethod
        def get():
            return type("Task", (), {"partitionId": lambda self: 0})()

    keep, task = fp.arrow_map, pyspark.TaskContext
    fp.arrow_map, pyspark.TaskContext = here, Context
    try:
        return fp.compare_with_next(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    finally:
        fp.arrow_map, pyspark.TaskContext = keep, task


def _arrow(schema):
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in schema.split(", "))])


def test_small_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert fp.compare_with_next(empty).count() == 0 and fp.group_exact(empty).count() == 0
    one = fp.compare_with_next(spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")).head()
    assert one.near_next == 1.0 and one.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest()


def test_groups(spark):
    rows = [(1, "Ｈello  World"), (2, "hello world\n"), (3, "other"), (4, None), (5, ""), (6, "STRASSE"), (7, "straße")]
    got = {r.doc_id: (r.first_id, r.copies) for r in fp.group_exact(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (1, 2), 2: (1, 2), 3: (3, 1), 4: (4, 2), 5: (4, 2), 6: (6, 2), 7: (6, 2)}


def test_bytes_split_a_bucket(spark, monkeypatch):
    """With a digest of few values buckets mix texts; the byte comparison parts them."""
    rows = [(1, "a"), (2, "b"), (3, "a")]
    digests = fp.canonical_digests(spark.createDataFrame(rows, "doc_id long, text string"), with_bytes=True)
    assert digests.select("fingerprint").distinct().count() == 2
    same = digests.selectExpr("doc_id", "'x' as fingerprint", "canonical")
    monkeypatch.setattr(fp, "canonical_digests", lambda docs, with_bytes=False: same if with_bytes else same.drop("canonical"))
    got = {r.doc_id: r for r in fp.group_exact(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].fingerprint == got[3].fingerprint != got[2].fingerprint and got[1].copies == 2


def brute_base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    starts, labels = [], set()
    for phrase, label in li.BASE.items():
        p = phrase.split()
        for k in range(len(words) - len(p) + 1):
            if words[k : k + len(p)] == p:
                starts.append(k)
                labels.add(label)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


FINDER = li.automaton(li.BASE, li.NOTICES)


@given(st.lists(st.sampled_from(["CC", "by", "cc-by", "General", "public", "license", "all", "rights", "reserved", "x", "é", "\n", "cc BY cc by", "İ", " ", "K"])).map(" ".join))
def test_base_places(text):
    assert li.scan(text, FINDER)[:5] == brute_base(text)


@pytest.mark.parametrize("expression, postfix, value", [("MIT", ["mit"], 0.9), ("MIT OR GPL-3.0-only", ["mit", "gpl-3.0-only", "or"], 0.9), ("MIT AND (GPL-2.0+ OR CC0-1.0)", ["mit", "gpl-2.0+", "cc0-1.0", "or", "and"], 0.9), ("GPL-2.0 WITH Classpath-exception-2.0 AND MIT", ["gpl-2.0", "classpath-exception-2.0", "with", "mit", "and"], 0.3), ("A OR B AND C", ["a", "b", "c", "and", "or"], 0.5)])
def test_expressions(expression, postfix, value):
    assert li.to_postfix(expression) == postfix and li.evaluate(postfix) == value


@pytest.mark.parametrize("broken", ["", "AND MIT", "(MIT", "MIT OR"])
def test_broken(broken):
    assert li.to_postfix(broken) is None


def test_scan_table(spark):
    rows = [(1, "SPDX-License-Identifier: MIT OR Apache-2.0\nAll Rights Reserved."), (2, None), (3, ""), (3, "CC BY 4.0 " * 2000)]
    got = {(r.doc_id, r.n_base): r for r in li.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1, 1].labels == "apache-2.0,mit,reserved" and got[1, 1].base_labels == "reserved"
    assert got[2, 0].first_word is None and got[2, 0].score == 0.0 and got[3, 2000].last_word == 4 * 1999
