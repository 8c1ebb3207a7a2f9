"""Empty tables, nulls, repeated rows, extra columns and very long texts through every operator and the pipeline."""

from __future__ import annotations

import collections

import corpus_pipeline as cp
import pytest

from tessera.llm import bpe, fingerprints, licenses, mixing, near_duplicates, pii, quality_model, quality_rules, registry

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `a.b` string, row int, fingerprint string"
LONG = "One very long line of words that never ends " * 40_000


def odd(spark):
    good = [(k, " ".join(f"w{k}x{j}" for j in range(30)), "en", "s", 1) for k in range(40)]
    rows = [*good, *good[:5], (100, None, None, None, None), (100, "", "", "", 0), (None, good[0][1] + " more", "en", "s", 1), (None, good[0][1] + " more", "en", "s", 1), (200, LONG, "en", "t", 1), (201, "line of a few words here\n" * 60_000, "xx", None, 1)]
    return spark.createDataFrame([(*r, "kept", 7, "own") for r in rows], SCHEMA)


OPERATORS = {
    "jaccard": lambda d: near_duplicates.jaccard_classes(d),
    "fingerprints": lambda d: fingerprints.compare_with_next(d),
    "groups": lambda d: fingerprints.group_exact(d),
    "licenses": lambda d: licenses.scan_licenses(d),
    "pii": lambda d: pii.find_pii(d),
    "bpe": lambda d: bpe.encode_documents(d),
    "rules": lambda d: quality_rules.measured(d),
    "score": lambda d: quality_model.score(d, bytes(4 << quality_model.BITS)),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_a_row_for_a_row(spark, name):
    docs = odd(spark)
    want = collections.Counter(r.doc_id for r in docs.select("doc_id").collect())
    assert collections.Counter(r.doc_id for r in OPERATORS[name](docs).select("doc_id").collect()) == want
    assert OPERATORS[name](docs.limit(0)).count() == 0


def test_long_texts_are_read_whole(spark):
    rows = {r.doc_id: r for r in quality_rules.measured(odd(spark)).where("doc_id in (200, 201)").collect()}
    assert rows[200].n_words == 9 * 40_000 and rows[200].n_repeat_words == 9 * 40_000 and rows[201].n_dup_lines == 59_999
    found = {r.doc_id: r.n_words for r in licenses.scan_licenses(odd(spark)).where("doc_id = 200").collect()}
    assert found == {200: 9 * 40_000}


def tables(spark, path, docs):
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(k, 1, 0) for k in range(40)] + [(None, None, None), (3, 1, 0), (999, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")


def test_pipeline_keeps_clean_documents_and_all_columns(spark, tmp_path):
    tables(spark, tmp_path, odd(spark))
    docs, names = spark.read.parquet(f"{tmp_path}/documents.parquet"), odd(spark).columns
    for k, (name, stage) in enumerate(cp.STAGES[:-1]):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.columns == names and docs.where("`a.b` <> 'kept' or row <> 7 or fingerprint <> 'own'").count() == 0
        ids = collections.Counter(r.doc_id for r in docs.select("doc_id").collect())
        assert set(range(40)) <= set(ids) and ids[None] >= 2 and not {100, 200, 201} & set(ids)
    out = cp.STAGES[-1][1](spark, docs, str(tmp_path))
    assert out.count() == docs.count()


def test_pipeline_of_nothing(spark, tmp_path):
    tables(spark, tmp_path, odd(spark).limit(0))
    assert cp.run(spark, str(tmp_path)).count() == 0


def test_mix_of_long_and_repeated_rows(spark):
    docs = odd(spark)
    out = collections.Counter(r.doc_id for r in mixing.mix(docs).select("doc_id").collect())
    assert set(out) >= {r.doc_id for r in docs.collect()} and mixing.mix(docs.limit(0)).count() == 0


def test_every_operator_is_registered():
    assert len(registry.queries()) == 10 and set(registry.oracle_sql()) == {"op5_warc", "op9_quality_rules"}
