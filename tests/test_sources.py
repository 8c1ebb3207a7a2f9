from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tessera.sources import connectors as cn
from tessera.sources import files
from tessera.sources.records import PagedRecords


def test_merged_and_staged(spark, tmp_path):
    spark.createDataFrame([(1, "a", "x")], "id int, source string, family string").write.parquet(f"{tmp_path}/one/a")
    spark.createDataFrame([(2, "b", "y", 3.0)], "id int, source string, family string, v double").write.parquet(f"{tmp_path}/one/b")
    df = files.read_merged(spark, f"{tmp_path}/one")
    assert {(r.id, r.v) for r in df.collect()} == {(1, None), (2, 3.0)}
    files.write_staged(df, f"{tmp_path}/staged", "source", "family")
    assert spark.read.parquet(f"{tmp_path}/staged").where("source = 'b'").count() == 1


def test_queue(spark, tmp_path):
    (tmp_path / "q.json").write_text(json.dumps({"version": "1", "updated_at": "x", "items": [{"review_id": "r1", "value": 1.0, "status": "approved"}, {"review_id": "r2", "value": None, "status": "pending"}]}))
    q = files.read_queue(spark, f"{tmp_path}/q.json")
    assert [(r.ordinal, r.review_id) for r in q.orderBy("ordinal").collect()] == [(0, "r1"), (1, "r2")]
    files.export_approved(q, f"{tmp_path}/approved")
    assert spark.read.parquet(f"{tmp_path}/approved").count() == 1
    files.append_events(q, f"{tmp_path}/log")
    files.append_events(q, f"{tmp_path}/log")
    assert spark.read.json(f"{tmp_path}/log").count() == 4


def test_flat_and_scalars(spark):
    df = spark.sql("select struct(1 as a, struct(2 as c) as b) as s, 3 as d")
    assert files.flat(df).columns == ["s.a", "s.b.c", "d"]
    rows = spark.createDataFrame([("na",), ("1.5",), ("",), (None,)], "x string").select(files.placeholder_to_null(F.col("x")).alias("x")).collect()
    assert [r.x for r in rows] == [None, 1.5, None, None]
    answers = spark.createDataFrame([('text [{"a": 1}, {"a": 2}] more',), ('{"a": 3}',), ("none",)], "t string").select(files.json_response(F.col("t"), "a int").alias("j")).collect()
    assert [x.a for x in answers[0].j] == [1, 2] and answers[1].j[0].a == 3 and answers[2].j == [None]


def test_checksums_and_resume(spark, tmp_path):
    (tmp_path / "f").mkdir()
    (tmp_path / "f/x.bin").write_bytes(b"abc")
    row = files.checksums(spark, f"{tmp_path}/f").head()
    assert (row.file, row.length, row.sha256[:8]) == ("x.bin", 3, "ba7816bf")
    assert files.missing_only(spark.range(5), spark.range(3), "id").count() == 2


def test_pages_cover_the_whole_file(spark, tmp_path):
    """More lines than a page by default; every line once, in pages that seek."""
    (tmp_path / "dump.jsonl").write_text("".join(json.dumps({"id": k, "t": "\u00e9" * (k % 7)}) + "\n" for k in range(1234)))
    spark.dataSource.register(PagedRecords)
    df = spark.read.format("paged_records").options(path=f"{tmp_path}/dump.jsonl", source="s").load()
    assert sorted(int(r.id) for r in df.collect()) == list(range(1234)) and df.rdd.getNumPartitions() == 3
    assert spark.read.format("paged_records").options(path=f"{tmp_path}/dump.jsonl", page_size="7").load().count() == 1234


def test_bad_lines_and_missing_files(spark, tmp_path):
    (tmp_path / "bad.jsonl").write_text('{"id": 1}\nnot json\n\n[1]\n{"source": "own"}')
    spark.dataSource.register(PagedRecords)
    read = lambda **o: spark.read.format("paged_records").options(**o).load()
    with pytest.raises(Exception):
        read(path=f"{tmp_path}/bad.jsonl").collect()
    with pytest.raises(Exception):
        read(path=f"{tmp_path}/none.jsonl", lenient="true").collect()
    rows = read(path=f"{tmp_path}/bad.jsonl", lenient="true").collect()
    assert [(r.id, r.payload) for r in rows if r.error] == [(None, "not json"), (None, "[1]")] and [(r.id, r.source) for r in rows if not r.error] == [("1", ""), (None, "own")]
    (tmp_path / "empty.jsonl").write_text("")
    assert read(path=f"{tmp_path}/empty.jsonl").count() == 0


CUBE = [[4.0, 0.0, 0.0], [0.0, 4.0, 0.0], [0.0, 0.0, 4.0]]
PAYLOADS = {
    "materials_project": {"material_id": "7", "structure": {"lattice": {"a": 3.0, "b": 3.0, "c": 3.0, "alpha": 90.0, "beta": 90.0, "gamma": 60.0}, "sites": [{"species": [{"element": "Li", "occu": 1.0}]}, {"species": [{"element": "Co", "occu": 0.5}, {"element": "O", "occu": 0.5}]}]}, "symmetry": {"symbol": "R-3m"}, "band_gap": 2.5},
    "jarvis": {"jid": "JVASP-1", "space_group": "Fm-3m", "struct": {"lattice": {"a": 4.0}, "elements": ["Na", "Cl"]}},
    "oqmd": {"id": 5, "composition": {"Li": 3, "N": 1}, "unit_cell": CUBE},
    "aflow": {"auid": "x:1", "species": ["La", "3", "Li", "Zr", "O"], "lattice": {"a": 1.0}},
    "nomad": {"entry_id": "n1", "results": {"material": {"elements": ["Li", "B", "H"], "symmetry": {"space_group_symbol": "P1"}}}},
    "cod": {"file": "99", "cell_length_a": 5.0, "gamma": 120.0},
    "materials_cloud": {"id": "m1", "attributes": {"formula_reduced": "LiLaTiO3", "species_at_sites": ["X"], "lattice_vectors": CUBE}},
}


def test_connectors(spark):
    got = {}
    for name, doc in PAYLOADS.items():
        landed = spark.createDataFrame([(json.dumps(doc),), ("not json",), ("{}",)], "payload string")
        rows = cn.CONNECTORS[name].records(landed)
        got[name] = [r for r in rows.collect() if r.source_id][0]
        assert rows.count() == 3 and cn.rejected(rows).count() == 2
    assert {n: (r.material_id, r.family, r.is_electrolyte_candidate) for n, r in got.items()} == {
        "materials_project": ("mp-7", "oxide", False), "jarvis": ("jarvis-JVASP-1", "halide", False), "oqmd": ("oqmd-5", "unknown", True), "aflow": ("aflow-x:1", "garnet", True),
        "nomad": ("nomad-n1", "borohydride", True), "cod": ("cod-99", "unknown", True), "materials_cloud": ("materials_cloud-m1", "perovskite", True),
    }
    assert got["oqmd"].lattice.a == 4.0 and got["oqmd"].lattice.alpha == pytest.approx(90.0) and got["nomad"].lattice is None
    assert (got["cod"].lattice.a, got["cod"].lattice.b, got["cod"].lattice.gamma) == (5.0, 0.0, 120.0) and got["jarvis"].lattice.alpha == 90.0
    assert got["materials_project"].band_gap == 2.5 and got["materials_project"].space_group == "R-3m"


def test_candidates(spark):
    rows = [(["Li", "Fe", "P", "O"], "oxide", False), (["Li", "Fe", "O"], "garnet", True), (["Li", "Zr", "O"], "oxide", True), (["Na", "Cl"], "halide", False), (["Li", "Mn"], "unknown", False), ([], "unknown", False), (None, "x", False)]
    df = spark.createDataFrame(rows, "e array<string>, f string, want boolean")
    assert all(r.got == r.want for r in df.select("want", cn.is_candidate(F.col("e"), F.col("f")).alias("got")).collect())


def test_ingest_keeps_one_record_an_id(spark):
    twice = spark.createDataFrame([(json.dumps(PAYLOADS["oqmd"] | {"name": n}),) for n in "ba"] + [("bad",)], "payload string")
    out = cn.ingest({"oqmd": twice, "nomad": spark.createDataFrame([(json.dumps(PAYLOADS["nomad"]),)], "payload string")})
    assert sorted(r.material_id for r in out.collect()) == ["nomad-n1", "oqmd-5"]


def test_enrichment(spark):
    doc = {"jid": "J", "formula": "Li2O2", "density": 0.0, "atoms": {"elements": ["Li", "O"], "lattice_mat": [[2.0, 0, 0], [1.0, 3.0, 0], [0, 0, 5.0]]}}
    row = cn.jarvis_properties(spark.createDataFrame([(json.dumps(doc),), ("x",)], "payload string")).collect()
    assert [(r.reduced_formula, r.density, r.volume, r.nsites) for r in row] == [("LiO", None, 30.0, 2)]
    base = spark.createDataFrame([("a", 1.0, "x"), ("b", 2.0, None)], "id string, gap double, note string")
    side = spark.createDataFrame([("a", 9.0, "text"), ("c", 8.0, "t")], "id string, gap double, description string")
    got = {r.id: (r.gap, r.note, r.robocrys) for r in cn.merge_blocks(base, side, "id", ["gap"], {"robocrys": "description"}).collect()}
    assert got == {"a": (9.0, "x", "text"), "b": (2.0, None, None)}
    chunks = cn.id_chunks(spark.range(2600).selectExpr("string(id) as id"), "id").collect()
    assert len(chunks) == 6 and sum(len(c.ids) for c in chunks) == 2600 and len({i for c in chunks for i in c.ids}) == 2600


def test_names(spark):
    df = spark.sql("select double('nan') as `a.b`, struct(struct(3 as c) as b) as a, 5 as z")
    assert cn.find_column(df, ["q", "z"]) == "z" and cn.find_column(df, ["q"]) is None
    assert tuple(df.select(cn.flat_or_nested(df, "a.b").alias("x"), cn.flat_or_nested(df, "a.b.c").alias("y"), cn.flat_or_nested(df, "a.q").alias("w")).head()) == (None, 3, None)


def test_csv_consensus_and_tables(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "quoted", text\nand line'), (2, None)], "id int, t string")
    files.write_csv(df, f"{tmp_path}/csv")
    assert sorted(files.read_csv(spark, f"{tmp_path}/csv", "id int, t string").collect()) == sorted(df.collect())
    groups = spark.sql("select 'm' as material, array(1, 2) as measurements, array() as outliers")
    files.write_consensus(groups, f"{tmp_path}/c")
    assert spark.read.parquet(f"{tmp_path}/c/parquet").columns == ["material"] and spark.read.json(f"{tmp_path}/c/json").head().measurements == [1, 2]
    rows = [("cap", ["a", "b"], [["1", "2"], ["3", None]]), (None, None, [["x"]]), ("", [], None)]
    got = spark.createDataFrame(rows, "c string, h array<string>, r array<array<string>>").select(files.markdown_table(F.col("c"), F.col("h"), F.col("r")).alias("x")).collect()
    assert [r.x for r in got] == ["**cap**\n| a | b |\n| --- | --- |\n| 1 | 2 |\n| 3 |  |", "| x |", ""]


def test_queue_build_and_metadata(spark, tmp_path):
    for paper, valid in (("p1", None), ("p2", False)):
        (tmp_path / "r" / paper).mkdir(parents=True)
        (tmp_path / "r" / paper / "extraction_result.json").write_text(json.dumps({"doi": f"10.1/{paper}", "evidence": [{"evidence_id": f"e{paper}", "value": 1.5, "unit": "mS/cm", "normalized_unit": "S/cm", "valid": valid}]}, indent=1))
    items = files.queue_items(spark, f"{tmp_path}/r").collect()
    assert [(r.review_id, r.paper_id, r.doi, r.unit, r.status, r.is_primary, r.edited_value) for r in items] == [("review_ep1", "p1", "10.1/p1", "S/cm", "pending", True, None)]
    papers = spark.createDataFrame([("10.1/A ", None, 2001), ("10.1/b", "own", None), (None, None, None)], "doi string, title string, year int")
    cache = spark.createDataFrame([("10.1/a", "found", 1999, "J"), ("10.1/b", "other", 1998, None)], "doi string, title string, year int, journal string")
    got = {r.doi: (r.title, r.year, r.journal) for r in files.with_cached_metadata(papers, cache).collect()}
    assert got == {"10.1/A ": ("found", 2001, "J"), "10.1/b": ("own", 1998, None), None: (None, None, None)}


def test_cells_of_tei(spark):
    xml = "<TEI><table><row><cell>a</cell><cell>1</cell></row><row><cell>b</cell></row></table></TEI>"
    rows = spark.createDataFrame([(xml,), ("<TEI/>",), (None,)], "x string").select(files.tables_of_tei(F.col("x")).alias("c")).collect()
    assert [r.c for r in rows] == [["a", "1", "b"], [], None]
