from __future__ import annotations

import random

import numpy as np
import pytest

from tessera.llm import graph
from tessera.llm import near_duplicates as nd


def brute(rows):
    own = [(d, set(nd.gram_set(t or "").tolist())) for d, t in rows if d is not None]
    parent, links = list(range(len(own))), [0] * len(own)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (_, a) in enumerate(own):
        for j in range(i):
            b = own[j][1]
            if a and b and 5 * len(a & b) >= 4 * len(a | b):
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(own):
        low[find(i)] = min(d, low.get(find(i), d))
    return sorted((d, low[find(i)], links[i]) for i, (d, _) in enumerate(own))


@pytest.mark.parametrize("block", [256, 16])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(nd, "BLOCK", block)
    r = random.Random(block)
    vocabulary = [f"w{k}" for k in range(300)]
    rows = []
    for group in range(8):
        base = [r.choice(vocabulary) for _ in range(r.choice([10, 60, 150]))]
        for _ in range(r.choice([1, 2, 5, 120 if group == 0 else 6])):
            words = list(base)
            for _ in range(r.randint(0, 5)):
                words[r.randrange(len(words))] = r.choice(vocabulary)
            rows.append((len(rows), " ".join(words)))
    n = len(rows)
    rows += [(n, None), (n + 1, ""), (n + 2, "a b"), (n + 3, "a  b"), (n + 4, rows[0][1]), (n + 4, rows[0][1]), (None, "a b")]
    got = nd.jaccard_classes(spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, band string")).collect()
    assert sorted((x.doc_id, x.class_id, x.n_links) for x in got if x.doc_id is not None) == brute(rows)
    assert [(x.class_id, x.n_links) for x in got if x.doc_id is None] == [(None, 0)]


def test_large_group_of_copies(spark):
    rows = [(k, "one two three four five six") for k in range(500)] + [(k, f"text {k} is about {k * 7} things and nothing else {k * k}") for k in range(500, 700)]
    got = nd.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all((x.class_id, x.n_links) == ((0, 499) if x.doc_id < 500 else (x.doc_id, 0)) for x in got) and len(got) == 700
    assert nd.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).count() == 201


def test_empty(spark):
    assert nd.jaccard_classes(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_bands():
    b = nd.bands_for(0.8, 0.999999)
    assert 1 - (1 - 0.8**nd.ROWS) ** b >= 0.999999 > 1 - (1 - 0.8**nd.ROWS) ** (b - 1)


def test_minhash_estimates_jaccard():
    r = np.random.default_rng(1)
    a, b = nd.permutations(2048)
    x = r.integers(0, 1 << 63, 1000, dtype=np.uint64)
    y = np.concatenate([x[:800], r.integers(0, 1 << 63, 200, dtype=np.uint64)])
    same = (nd.min_hashes(np.sort(x), a, b) == nd.min_hashes(np.sort(y), a, b)).mean()
    assert abs(same - 800 / 1200) < 0.05


def test_components(spark):
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, 101), (101, 102), (100, 102)] + [(200, k) for k in range(201, 260)]
    got = {r.v: r.label for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(41)}, 100: 100, 101: 100, 102: 100, **{k: 200 for k in range(200, 260)}}


def test_a_chain_compares_neighbours_only(spark, monkeypatch):
    """Texts that a chain of bands joins: classes and links are exact, and blocks that share no band never meet."""
    monkeypatch.setattr(nd, "BLOCK", 4)
    words = [f"w{k}" for k in range(4000)]
    rows = [(k, " ".join(words[k * 15 : k * 15 + 200])) for k in range(200)]  # neighbours overlap by about 0.85
    met = []
    keep = nd.block_pairs
    monkeypatch.setattr(nd, "block_pairs", lambda m, b: met.append((keep(m, b).select("pair").distinct().count(), b.select("leader", "part").distinct().count())) or keep(m, b))
    got = nd.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((x.doc_id, x.class_id, x.n_links) for x in got) == brute(rows)
    (pairs, blocks), = met
    assert pairs < blocks * blocks / 8


def test_very_long_texts_and_blocks_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK_BYTES", 1 << 20)
    r = random.Random(4)
    base = [f"w{r.randrange(10**6)}" for _ in range(100_000)]
    rows = [(k, " ".join(base[: 100_000 - 40 * k])) for k in range(5)] + [(k, " ".join(base[k : k + 90_000])) for k in (10, 20)]
    got = nd.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((x.doc_id, x.class_id, x.n_links) for x in got) == [(d, 0, 6) for d, _ in rows]


def _copies(count, edits=6):
    """Texts of 60 words of one base with a few words replaced each, so that about half of the pairs are links."""
    r = random.Random(count)
    base = [f"w{k}" for k in range(60)]
    return [(k, " ".join(f"x{r.randrange(10**6)}" if j in where else w for j, w in enumerate(base))) for k in range(count) for where in [set(r.sample(range(57, 60), r.randint(0, 3))) | set(r.sample(range(60), r.choice([0, 0, 1, edits])))]]


def test_moved_sets_grow_with_a_group_not_with_its_square(spark, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK", 4)
    monkeypatch.setattr(nd, "TILES", 4, raising=False)
    moved, keep = [], nd.arrow_map

    def counted(df, fn, schema):
        if schema == "v long, links long, low long":
            moved.append(df.count())
        return keep(df, fn, schema)

    monkeypatch.setattr(nd, "arrow_map", counted)
    for count in (60, 240):
        rows = _copies(count)
        got = nd.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        assert sorted((x.doc_id, x.class_id, x.n_links) for x in got) == brute(rows)
    assert moved[1] <= 6 * moved[0]


@pytest.mark.parametrize("one", [True, False])
def test_blocks_of_a_pair_of_tiles(monkeypatch, one):
    """Many blocks a tile, sets in the temporary file: links and components as from all pairs at once; a row that comes twice counts once."""
    monkeypatch.setattr(nd, "BLOCK", 7)
    monkeypatch.setattr(nd, "BLOCK_BYTES", 2000)
    rows = [(k + 1, 3 if one else 1 + k % 2, 1 + k % 3, nd.gram_set(t)) for k, (_, t) in enumerate(_copies(80))]
    group = nd._Group()
    for v, side, copies, grams in rows + rows[:5]:
        group.add(v, side, copies, grams.tobytes())
    got = {r["v"]: r for r in group.judged(0.8).to_pylist()}
    sides = {v: side for v, side, *_ in rows}
    met = lambda a, b: a != b and (one or sides[a] != sides[b])
    near = {a: [(b, c) for b, _, c, y in rows if met(a, b) and 5 * len(np.intersect1d(x, y)) >= 4 * len(np.union1d(x, y))] for a, _, _, x in rows}
    low = {a: a for a in near}
    for _ in near:
        low = {a: min([low[a], *(low[b] for b, _ in near[a])]) for a in near}
    assert {a: (sum(c for _, c in x), low[a]) for a, x in near.items() if x} == {v: (r["links"], r["low"]) for v, r in got.items()}
