import random

from linkgraph.llm import minhash

ROWS = "doc_id long, text string, lang string, n long, sig string"


def brute(rows, words, percent):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for i, t in rows:
        w = (t or "").translate(lower).encode().split()
        sets[i] = {tuple(w[k : k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), top(i)) for i in ids}


def corpus(seed, families, size):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    out = []
    for _ in range(families):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([30, 80, 150]))]
        for _ in range(size):
            w = list(base)
            for _ in range(rng.choice([0, 1, 2, 4, 8])):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            out.append(" ".join(w))
    rng.shuffle(out)
    return [(k, t) for k, t in enumerate(out)]


def found(spark, rows, like):
    df = spark.createDataFrame([(i, t, "en", 1, "x") for i, t in rows], ROWS)
    got = minhash.near_duplicates(df, like=like).collect()
    assert len(got) == len(rows)
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in got)
    return {r.doc_id: (r.n_shingles, r.component_id) for r in got}


def test_families_of_near_copies(spark, monkeypatch):
    rows = corpus(1, 6, 60)
    like = minhash.Likeness(3, 85)
    assert found(spark, rows, like) == brute(rows, 3, 85)
    monkeypatch.setattr(minhash, "BLOCK", 16)  # every list in many blocks
    rows = corpus(2, 3, 90)
    assert found(spark, rows, like) == brute(rows, 3, 85)


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t"), (4, "A b"), (5, "a B"), (6, "a"), (7, "a b c d e f g h"), (8, "A B C D E F G H"), (9, "x " * 5000), (10, "x " * 4000)]
    assert found(spark, rows, minhash.Likeness(3, 85)) == brute(rows, 3, 85)
    repeated = spark.createDataFrame([(7, "a b c d e"), (7, "a b c d e"), (9, "a b c d e"), (None, "a b c d e")], "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.component_id or -1) for r in minhash.near_duplicates(repeated).collect())
    assert got == [(-1, -1), (7, 7), (7, 7), (9, 7)]
    assert minhash.near_duplicates(repeated.limit(0)).count() == 0


def test_keep_one_keeps_columns(spark):
    df = spark.createDataFrame([(2, "a b c d e f g", 5), (1, "a b c d e f g", 6), (3, "other words are here now", 7), (4, None, 8)], "doc_id long, text string, n long")
    out = minhash.keep_one(df)
    assert out.columns == df.columns and sorted(r.doc_id for r in out.collect()) == [1, 3, 4]


def test_keep_one_row_of_each_group(spark):
    one, two, other = " ".join(f"w{k}" for k in range(60)), " ".join(f"w{k}" for k in range(58)), " ".join(f"v{k}" for k in range(60))
    rows = [(1, one, "a"), (7, two, "a"), (7, other, "b"), (7, other, "c"), (8, other, "d"), (None, one, "e"), (None, "its own words " * 9, "f"), (None, "its own words " * 9, "g"), (9, "", "h"), (9, "", "i"), (10, None, "j"), (None, None, "k")]
    docs = spark.createDataFrame([(i, t, c, c) for i, t, c in rows], "doc_id long, text string, _row string, component string")
    got = sorted((r.doc_id or 0, r.text or "", r._row) for r in minhash.keep_one(docs).collect())
    assert minhash.keep_one(docs).columns == docs.columns
    assert [(i, t) for i, t, _ in got] == sorted([(0, ""), (0, "its own words " * 9), (1, one), (7, other), (9, ""), (9, ""), (10, "")])
    assert minhash.keep_one(docs.limit(0)).count() == 0
