"""Near-duplicate embeddings against brute force, and the recall of the graph index."""

import math

import numpy as np
import pytest

from shelfmark.llm import embeddings, neighbours
from shelfmark.llm.embeddings import close_pairs, forest, near_duplicates
from shelfmark.llm.neighbours import nearest_neighbours

BAD = [None, [], [0.0] * 8, [1.0] * 7 + [None], [float("nan")] + [1.0] * 7, [float("inf")] + [0.0] * 7]


def clustered(seed, n, size=8, spread=0.25):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, size))
    vectors = centres[rng.integers(0, 6, n)] + spread * rng.normal(size=(n, size))
    vectors[n // 2 : n // 2 + n // 6] = vectors[0]  # a hot copy
    vectors[-1] = -vectors[0]
    return (vectors * rng.uniform(0.2, 5, (n, 1))).astype(np.float32).astype(float)


def table_of(spark, vectors, extra=()):
    rows = [(3 * k + 2, [float(x) for x in v], k) for k, v in enumerate(vectors)]
    rows += [(1000 + k, v, None) for k, v in enumerate(extra)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, n_links int").repartition(3)


@pytest.mark.parametrize("seed,stripe", [(1, 8192), (2, 30)])
def test_links_equal_brute_force(spark, monkeypatch, seed, stripe):
    monkeypatch.setattr(embeddings, "STRIPE", stripe)
    vectors = clustered(seed, 150)
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_duplicates(table_of(spark, vectors, [*BAD, [1.0, 2.0], [2.0, 4.0]])).collect()}
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.9 - 1e-12
    ids, want = 3 * np.arange(150) + 2, {}
    seen = linked.copy()
    while True:
        more = (seen.astype(int) @ linked.astype(int)) > 0
        if (more == seen).all():
            break
        seen = more
    for k in range(150):
        low = int(ids[seen[k]].min())
        want[int(ids[k])] = (int(linked[k].sum()) - 1, low, low == ids[k])
    want |= {1000 + k: (0, 1000 + k, True) for k in range(len(BAD))} | {1006: (1, 1006, True), 1007: (1, 1006, False)}
    assert found == want


def test_bounds_lose_no_pair():
    rng = np.random.default_rng(3)
    left, right = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in (rng.normal(size=(60, 24)), rng.normal(size=(70, 24))))
    right[:20] = left[:20] + 0.05 * rng.normal(size=(20, 24))
    for threshold in (-1.0, 0.2, 0.6, 0.95, 2.0):
        a, b = close_pairs(left, right, threshold)
        assert set(zip(*np.nonzero(left @ right.T >= threshold))) <= set(zip(a.tolist(), b.tolist()))


def test_forests_connect_what_edges_connect():
    x, y = forest(np.array([5, 7, 9, 20, 20]), np.array([7, 9, 11, 21, 22]))
    assert sorted(zip(x.tolist(), y.tolist())) == [(7, 5), (9, 5), (11, 5), (21, 20), (22, 20)]


def test_empty_tables(spark):
    empty = table_of(spark, clustered(1, 20)).limit(0)
    assert near_duplicates(empty).count() == 0 and nearest_neighbours(empty, empty, 5).count() == 0


@pytest.mark.parametrize("shard", [8192, 150])
def test_recall_and_exact_scores(spark, monkeypatch, shard):
    monkeypatch.setattr(neighbours, "SHARD", shard)
    vectors = clustered(4, 600, size=16, spread=0.6)
    rows = table_of(spark, vectors, [*BAD, [3.0] * 16, [1.0, 2.0]])
    asked = rows.filter("vec_id % 4 = 0")
    found = {}
    for r in nearest_neighbours(rows, asked, 10).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    ids = np.array([3 * k + 2 for k in range(600)] + [1006])
    every = np.vstack([vectors, np.full((1, 16), 3.0)])
    hits = 0
    wanted = [k for k in range(len(ids)) if ids[k] % 4 == 0]
    assert sorted(found) == sorted(int(ids[k]) for k in wanted)
    for k in wanted:
        own = sorted(found[int(ids[k])])
        assert [x[0] for x in own] == list(range(1, 11)) and int(ids[k]) not in [x[1] for x in own]
        scores = every @ every[k]
        for _, vec, score in own:
            assert math.isclose(score, scores[np.flatnonzero(ids == vec)[0]], rel_tol=1e-12)
        assert [(-s, v) for _, v, s in own] == sorted((-s, v) for _, v, s in own)
        best = [x for x in np.lexsort((ids, -np.round(scores, 9))) if x != k][:10]
        floor = scores[best[-1]] - 1e-9
        hits += sum(s >= floor for _, _, s in own)
    assert hits >= 0.9 * 10 * len(wanted)


def test_few_candidates_ties_and_clashing_names(spark):
    rows = spark.createDataFrame([(k, [1.0, 0.0], "x") for k in (9, 4, 7, 2)] + [(5, [0.0, 1.0], "y")], "vec_id long, embedding array<float>, rank string")
    found = nearest_neighbours(rows, rows.filter("vec_id IN (4, 5)"), 3).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found) == [
        (4, 1, 2, 1.0), (4, 2, 7, 1.0), (4, 3, 9, 1.0), (5, 1, 2, 0.0), (5, 2, 4, 0.0), (5, 3, 7, 0.0)
    ]
    alone = rows.filter("vec_id = 5")
    assert nearest_neighbours(alone, alone, 3).count() == 0
