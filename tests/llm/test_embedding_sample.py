import numpy as np

from linkgraph.llm import embeddings


def test_equal_invalid_vectors_leave_the_links(spark, monkeypatch):
    """Rows that can't be linked don't take the sample's places."""
    monkeypatch.setattr(embeddings, "SAMPLE", 4)
    choices = [[float(k), 1.0, 2.0, -1.0, 0.5, 3.0, 1.0, 1.0] for k in range(30)]
    df = spark.createDataFrame([([0.0] * 8,), *((c,) for c in choices)], "v array<float>").selectExpr("v", "xxhash64(v) AS h").collect()
    later = [list(r.v) for r in df[1:] if r.h > df[0].h]
    assert later
    rows = [(k, [0.0] * 8) for k in range(9)] + [(9, [float("nan")] * 8), (10, later[0]), (11, later[0])]
    got = {r[0]: r for r in embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    assert got[10].n_links == got[11].n_links == 1 and got[11].component_id == 10 and got[0].n_links == got[9].n_links == 0


def test_slabs_are_as_wide_as_what_is_admitted():
    x = np.random.default_rng(0).standard_normal((4000, 8))
    plan = embeddings.make_plan(x / np.linalg.norm(x, axis=1, keepdims=True), 1e-4, 4, 3000)
    for r, b in zip(plan.radius2, plan.bounds, strict=True):
        assert (np.diff(b) >= np.sqrt(r + 2 * embeddings.ROOM) - 1e-12).all()
