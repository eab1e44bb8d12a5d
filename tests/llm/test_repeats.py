import collections
import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from linkgraph.llm import repeats, substring_dedup, suffix_dedup
from linkgraph.llm.common import slices, text_bytes, words_of
from linkgraph.llm.repeats import Unit

SCHEMA = "doc_id long, text string, first int, anchor string, _key long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", 2) for i, t in rows], SCHEMA)


def brute_words(rows, window):
    first = {}
    for i, t in rows:
        w = (t or "").encode().split()
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            first[key] = min(first.get(key, i), i) if i is not None else first.get(key)
    out = []
    for i, t in rows:
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            m = first.get(tuple(w[k : k + window]))
            if i is not None and m is not None and m < i:
                gone[k : k + window] = [True] * window
        left = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(left).hexdigest()))
    return sorted(out, key=repr)


def brute_bytes(rows, window):
    count = collections.Counter()
    for _, t in rows:
        b = (t or "").encode()
        count.update(b[k : k + window] for k in range(len(b) - window + 1))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for k in range(len(b) - window + 1):
            if count[b[k : k + window]] > 1:
                gone[k : k + window] = [True] * window
        runs = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        left = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((i, len(b), sum(gone), runs, hashlib.sha256(left).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed, n=60):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(60)] + ["é", "日本", "\x00"]
    passages = [[rng.choice(vocabulary) for _ in range(rng.choice([20, 70, 130]))] for _ in range(6)]
    rows = []
    for i in range(n):
        w = []
        for _ in range(rng.choice([0, 1, 3])):
            w += [rng.choice(vocabulary) for _ in range(rng.choice([0, 5, 60]))] + (rng.choice(passages) if rng.random() < 0.7 else ["same"] * rng.choice([3, 120]))
        rows.append((i, "\t \n"[i % 3].join(w)))
    rows += [(n, None), (n + 1, ""), (n + 2, rows[5][1]), (n + 3, "a" * 900), (n + 4, "b" + "a" * 700), (5, rows[5][1]), (7, "another text of one id " * 30)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_substring_dedup(spark, seed):
    rows = corpus(seed) + [(None, "no id " * 60), (None, "no id " * 60)]
    got = substring_dedup.dedup(frame(spark, rows), digests=True).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=repr) == brute_words(rows, 50)


def test_substring_batches_agree(spark):
    rows = frame(spark, corpus(3))
    one, many = (sorted(map(tuple, substring_dedup.dedup(rows, digests=True, batches=b).collect())) for b in (1, 6))
    assert one == many


@pytest.mark.parametrize("seed", [4, 5])
def test_suffix_dedup(spark, seed):
    rows = corpus(seed) + [(None, "no id " * 60)]
    got = suffix_dedup.dedup(frame(spark, rows), digests=True).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=repr) == brute_bytes(rows, 200)


def test_empty_tables(spark):
    none = frame(spark, [(1, "a")]).limit(0)
    assert substring_dedup.dedup(none).count() == 0
    assert suffix_dedup.dedup(none).count() == 0


def test_kept_text(spark):
    text = " ".join(f"t{k}" for k in range(60))
    got = {r.doc_id: r.kept for r in substring_dedup.dedup(frame(spark, [(1, text), (2, "head " + text + " tail")])).collect()}
    assert bytes(got[1]).decode() == text and bytes(got[2]).decode() == "head tail"


def test_suffix_array_against_sorting():
    rng = random.Random(7)
    for _ in range(200):
        pieces = [bytes(rng.choice(b"ab\x00\xff") for _ in range(rng.choice([0, 1, 7, 40]))) for _ in range(rng.choice([1, 4]))]
        t = np.concatenate([np.append(np.frombuffer(p, np.uint8).astype(np.int16) + 1, 0) for p in pieces]).astype(np.int16)
        got = suffix_dedup.suffix_array(t, 20).tolist()
        want = sorted(range(len(t)), key=lambda k: t[k:].tolist())
        assert [t[k : k + 20].tolist() for k in got] == [t[k : k + 20].tolist() for k in want]
        window = rng.choice([1, 3, 8])
        count, places, at = collections.Counter(p[k : k + window] for p in pieces for k in range(len(p) - window + 1)), [], 0
        for p in pieces:
            places += [at + k for k in range(len(p) - window + 1) if count[p[k : k + window]] > 1]
            at += len(p) + 1
        assert suffix_dedup.repeated_windows(pieces, window).tolist() == places


def test_equal_windows_have_equal_anchors():
    rng = random.Random(9)
    unit = Unit("byte", 24, 8)
    col = pa.array(["".join(rng.choice("abc") for _ in range(300)) for _ in range(20)] + ["abcabc" * 40, None, ""])
    s = repeats.symbols(col, unit)
    b = repeats.bundles(s, unit)
    seen = {}
    windows = 0
    for anchor, place, first, last in zip(b.anchor, b.place, b.first, b.last, strict=True):
        for w in range(first, last + 1):
            windows += 1
            assert seen.setdefault(s.data[w : w + 24], (anchor, place - w)) == (anchor, place - w)
    assert windows == sum(max(0, len(t or "") - 23) for t in col.to_pylist())


def test_words_and_slices():
    col = pa.array([" a\tbb\x0bc ", None, "", "é x y", "\x1cz"])
    raw, off = text_bytes(col)
    start, end, doc = words_of(raw, off)
    assert [bytes(raw[a:b]) for a, b in zip(start, end, strict=True)] == [w for t in col.to_pylist() if t for w in t.encode().split()]
    assert doc.tolist() == [0, 0, 0, 3, 3, 4]
    batch = pa.record_batch([pa.array(["x" * n for n in (5, 50, 5, 5, 500)])], names=["t"])
    parts = list(slices(batch, 60))
    assert sum(p.num_rows for p in parts) == 5 and pa.Table.from_batches(parts).equals(pa.Table.from_batches([batch]))


def test_index_is_opened_again_for_each_batch(spark, tmp_path):
    rng = random.Random(8)
    passages = [" ".join(rng.choice("abcdefgh") + str(rng.randint(0, 30)) for _ in range(70)) for _ in range(5)]
    rows = []
    for i in range(60):
        p = rng.choice(passages).split()
        a = rng.randint(0, 15)
        rows.append((i, " ".join([f"own{i}x{k}" for k in range(rng.randint(0, 40))] + p[a : a + rng.randint(45, 70)] + [f"end{i}"])))
    docs = substring_dedup.doc_key(frame(spark, rows), "doc_id", "text")
    path = str(tmp_path / "index")
    spans = None
    for k in range(10):
        index = substring_dedup.FingerprintIndex(spark, path, parts=3)  # as another session would
        assert index.written == k + len([x for x in range(1, k + 1) if x % 4 == 0])
        hits = index.append(docs.filter(f"_id >= {6 * k} and _id < {6 * k + 6}"), docs.filter(f"_id < {6 * k + 6}"))
        spans = hits if spans is None else spans.unionByName(hits)
    assert [len(level) for level in index.levels] == [2, 2]
    got = {r.doc_id: r.kept for r in repeats.cover(docs, spans, substring_dedup.UNIT, "doc_id", False).collect()}
    want = {r.doc_id: r.kept for r in substring_dedup.dedup(frame(spark, rows)).collect()}
    assert got == want and len({len(x.split()) for x in got.values()}) > 5
    with pytest.raises(ValueError, match="comes after"):
        index.append(docs.filter("_id = 3"), docs)
    with pytest.raises(ValueError, match="integers"):
        substring_dedup.dedup(spark.createDataFrame([("a", "b")], "doc_id string, text string"))
    small = spark.createDataFrame([(1, "w " * 60), (2, "w " * 60)], "doc_id smallint, text string")
    assert [(r.doc_id, r.n_removed) for r in sorted(substring_dedup.dedup(small).collect())] == [(1, 0), (2, 60)]
