import collections
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from linkgraph.llm import eliasfano, ngrams

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_elias_fano():
    rng = np.random.default_rng(1)
    for _ in range(150):
        v = np.unique(rng.integers(0, rng.choice([5, 400, 10**6, 2**50]), rng.integers(1, 400))).astype(np.uint64)
        s = eliasfano.Sequence(eliasfano.encode(v))
        assert (s.get(np.arange(len(v))) == v).all()
        q = np.concatenate([v, rng.integers(0, int(v[-1]) + 5, 50).astype(np.uint64)])
        lo, hi = rng.integers(0, len(v) + 1, len(q)), rng.integers(0, len(v) + 1, len(q))
        at = {int(x): k for k, x in enumerate(v)}
        assert s.find(q, lo, hi).tolist() == [at[int(x)] if int(x) in at and a <= at[int(x)] < b else -1 for x, a, b in zip(q, lo, hi, strict=True)]
    assert (eliasfano.Sequence(eliasfano.encode(np.array([0, 0, 3, 3, 3, 9], np.uint64))).get(np.arange(6)) == [0, 0, 3, 3, 3, 9]).all()


@pytest.mark.parametrize("keys", [3_000_000, 300])
def test_scores(spark, monkeypatch, keys):
    monkeypatch.setattr(ngrams, "RANGE_KEYS", keys)
    rng = random.Random(2)
    vocabulary = [f"W{k}" for k in range(80)] + ["é", "x y"]
    rows = [(i, " ".join(rng.choice(vocabulary[: 5 + i]) for _ in range(rng.choice([0, 1, 40])))) for i in range(90)] + [(200, None), (201, ""), (202, "never seen"), (None, "w1 w2"), (5, "w1")]
    df = spark.createDataFrame([(i, t, "en", 7) for i, t in rows], "doc_id long, text string, lang string, n_tokens long")
    model = ngrams.train(df)
    tokens = [((i, t), (t or "").translate(LOWER).encode().split() + [None], i is not None and zlib.crc32(str(i).encode()) % 5 == 1) for i, t in rows]
    c = collections.Counter(w for _, ws, h in tokens if not h for w in ws)
    pairs = collections.Counter(p for _, ws, h in tokens if not h for p in zip([0, *ws[:-1]], ws, strict=True))
    triples = collections.Counter(p for _, ws, h in tokens if not h for p in zip([0, *ws[:-2]], ws[:-1], ws[1:]))
    n, v, texts = sum(c.values()), len(c), sum(not h for *_, h in tokens)
    assert (model.n_tokens, model.n_words) == (n, v)
    want = []
    for (i, _), ws, h in tokens:
        p1 = [(c[w] + 0.5) / (n + 0.5 * (v + 1)) for w in ws]
        p2 = [(pairs[(a, w)] + ngrams.M * p) / ((texts if a == 0 else c[a]) + ngrams.M) for a, w, p in zip([0, *ws[:-1]], ws, p1, strict=True)]
        p3 = [p2[0], *((triples[(a, b, w)] + ngrams.M * p) / (pairs[(a, b)] + ngrams.M) for a, b, w, p in zip([0, *ws[:-2]], ws[:-1], ws[1:], p2[1:]))]
        want.append((i, h, len(ws), sum(c[w] > 0 for w in ws), sum(map(math.log10, p1)), sum(map(math.log10, p3))))
    got = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.base_score, r.score) for r in ngrams.score(df, model).collect()]
    for x, y in zip(sorted(got, key=repr), sorted(want, key=repr), strict=True):
        assert x[:4] == y[:4] and math.isclose(x[4], y[4], abs_tol=1e-9) and abs(x[5] - y[5]) <= 0.02 * x[2]  # codes and counts are steps


def test_no_training_documents(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    r = ngrams.score(df, ngrams.train(df.limit(0))).collect()[0]
    assert (r.n_tokens, r.n_known, r.train_tokens) == (3, 0, 0)


def test_shards_are_visited_once_for_many_batches(spark, monkeypatch):
    """A visit of a shard costs much whatever the number of keys, so the work would grow with batches times shards."""
    monkeypatch.setattr(ngrams, "RANGE_KEYS", 100)
    rng = random.Random(4)
    texts = [" ".join(f"w{rng.randrange(60)}" for _ in range(rng.choice([0, 30]))) for _ in range(60)]
    model = ngrams.train(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert len(model.triples) > 3
    rows = [pa.RecordBatch.from_arrays([pa.array([i]), pa.array([False]), pa.array([t])], names=["doc_id", "held_out", "text"]) for i, t in enumerate(texts)]
    visits, level = collections.Counter(), ngrams.level
    monkeypatch.setattr(ngrams, "level", lambda path, kind: visits.update([path]) or level(path, kind))
    got = pa.Table.from_batches(ngrams.scored(model, iter(rows)))
    assert max(visits.values()) == 1
    monkeypatch.setattr(ngrams, "TOGETHER_BYTES", (1, 1))  # each text alone
    assert pa.Table.from_batches(ngrams.scored(model, iter(rows))).equals(got)
    assert max(visits.values()) > 1
