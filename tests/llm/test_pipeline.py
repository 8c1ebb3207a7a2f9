from __future__ import annotations

import corpus_pipeline as cp

from tessera.llm import bpe, common, near_duplicates, pii


def test_stages(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents")
    columns, n = docs.columns, docs.count()
    for name, stage in cp.STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), name)
        assert docs.columns == columns
        if name == "near_duplicates":
            assert {r.n_links for r in near_duplicates.jaccard_classes(docs).collect()} == {0}
        if name == "pii":
            assert {len([s for s in r.spans if s.kind in pii.BASE]) for r in pii.find_pii(docs).collect()} == {0}
        if name == "mixing":
            assert docs.select("doc_id").distinct().count() == kept
        kept = docs.select("doc_id").distinct().count()
        assert 0 < kept <= n
    out = cp.STAGES[-1][1](spark, docs, sf_dir).collect()
    codec = bpe.codec(bpe.vocabulary())
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(out) == docs.count() and all(codec.decode(r.ids) == (texts[r.doc_id] or "") for r in out)


def test_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names and {int(k[2:].split("_")[0]) for k in names if k.startswith("op")} == set(range(1, 11))
