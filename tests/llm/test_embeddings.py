import math
import random

import numpy as np
import pytest

from linkgraph.llm import embeddings

SCHEMA = "vec_id long, embedding array<float>, label int, row long, slab int"


def brute(rows, least=0.9):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    n, root = {i: 0 for i, _ in rows}, {i: i for i, _ in rows}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (a, x) in enumerate(good):
        for b, y in good[:k]:
            if x @ y / math.sqrt((x @ x) * (y @ y)) >= least:
                n[a] += 1
                n[b] += 1
                p, q = top(a), top(b)
                root[max(p, q)] = min(p, q)
    return {i: (n[i], top(i), i == top(i)) for i, _ in rows}


@pytest.mark.parametrize("tile", [2048, 40])
def test_against_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(embeddings, "TILE", tile)
    rng = random.Random(3)
    rows = []
    for _ in range(12):
        centre = [rng.gauss(0, 1) for _ in range(16)]
        rows += [[c + rng.gauss(0, s) for c in centre] for s in [0.0, 0.0, *(rng.choice([0.1, 0.25, 0.4]) for _ in range(20))]]
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    rows += [(1000, None), (1001, []), (1002, [0.0] * 16), (1003, [float("nan")] * 16), (1004, [None] * 16), (1005, [float("inf")] + [1.0] * 15), (1006, [1e-30] * 16), (1007, [1e30] * 16)]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(spark.createDataFrame([(i, v, 1, 2, 3) for i, v in rows], SCHEMA)).collect()}
    assert got == brute([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows])


def test_small_tables(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], 1, 2, 3)], SCHEMA)
    assert [tuple(r) for r in embeddings.near_duplicates(df).collect()] == [(1, 0, 1, True)]
    assert embeddings.near_duplicates(df.limit(0)).count() == 0


def test_forest_joins_what_links_join():
    a, b = np.array([5, 7, 9, 2, 9]), np.array([7, 9, 5, 3, 7])
    assert sorted(map(tuple, embeddings.forest(a, b).T.tolist())) == [(3, 2), (7, 5), (9, 5)]


def test_vectors_of_several_lengths(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0, 0.0]), (3, [2.0, 0.1]), (4, [1.0, 0.0, 0.1]), (5, [1.0]), (6, []), (7, None), (8, [0.0, 0.0])]
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {1: (1, 1), 2: (1, 2), 3: (1, 1), 4: (1, 2), 5: (0, 5), 6: (0, 6), 7: (0, 7), 8: (0, 8)}
