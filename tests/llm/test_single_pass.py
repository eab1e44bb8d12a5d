import gzip
import hashlib
import random
import re

import numpy as np
import pytest

from linkgraph.llm import decontaminate, pii, sentencepiece, toxicity, warc

public_tokenizers = pytest.importorskip("public_tokenizers")
MODEL = public_tokenizers.path("piece_bpe_32k.model")


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", 1, "a", 2) for i, t in rows], "doc_id long, text string, lang string, n_words long, score string, first long")


def test_sentencepiece_equals_the_library(spark):
    rng = random.Random(1)
    letters = "ab c  ▁▁é日本\U0001f600\n\t\0<s></s>' ing the"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(3000)] + [" ", "   x   ", "▁", "a" * 5000, " " * 300, "", None]
    enc = sentencepiece.Encoder(MODEL)
    assert enc.encode(texts) == enc.library.encode([t or "" for t in texts], add_eos=True)
    got = {r.doc_id: r for r in sentencepiece.encode(frame(spark, list(enumerate(texts[-300:]))), MODEL).collect()}
    for k, t in enumerate(texts[-300:]):
        ids = enc.library.encode(t or "", add_eos=True)
        assert list(got[k].ids) == ids and got[k].n_tokens == len(ids) and got[k].decoded == enc.library.decode(ids)
    assert sentencepiece.encode(frame(spark, [(1, "a")]).limit(0), MODEL).count() == 0


def test_sentencepiece_memory_is_bounded(monkeypatch):
    rng = random.Random(2)
    texts = [" ".join("".join(rng.choice("abcdeéß.,;1\n") for _ in range(rng.randint(1, 90))) for _ in range(60)) + " the end" for _ in range(60)]
    monkeypatch.setattr(sentencepiece, "MEMORY_BYTES", 100_000)
    enc = sentencepiece.Encoder(MODEL)
    for k in range(0, 60, 5):
        assert enc.encode(texts[k : k + 5]) == enc.library.encode(texts[k : k + 5], add_eos=True)
        batch = sum(sentencepiece._ENTRY_BYTES + 12 * len(p) for t in texts[k : k + 5] for p in {*enc.split("▁" + t.replace(" ", "▁"))})
        assert enc.held <= 50_000 + batch
    assert "▁the" in enc.known and 0 < len(enc.older) < 3000


def test_sentencepiece_refuses_other_models(tmp_path):
    with pytest.raises(Exception):
        sentencepiece.Encoder(str(tmp_path / "none.model"))


def brute_windows(docs, items, window):
    def words(t):
        return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").encode().lower() if (t or "").isascii() else bytes(b + 32 if 65 <= b <= 90 else b for b in (t or "").encode()))

    out = {}
    for i, t in docs:
        d = words(t)
        hit, ids = set(), set()
        for k, u in items:
            w = words(u)
            if k is None or u is None or not w:
                continue
            n = min(window, len(w))
            for a in range(len(w) - n + 1):
                for b in range(len(d) - n + 1):
                    if d[b : b + n] == w[a : a + n]:
                        hit.update(range(b, b + n))
                        ids.add(str(k))
        out[i] = (len(d), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit))
    return out


@pytest.mark.parametrize("block", [decontaminate.BLOCK_BYTES, 60])
def test_decontamination(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", 40 * block)
    rng = random.Random(4)
    vocabulary = [f"w{k}" for k in range(6)] + ["É", "x-y"]
    docs = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([0, 3, 60])))) for k in range(30)] + [(90, None), (91, "W1 W2, w3"), (92, "the short one.")]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([2, 11, 15])))) for k in range(9)] + [(20, "Short one"), (20, "again short"), (None, "w1"), (21, None), (22, "!!"), (23, docs[2][1] or "w")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in decontaminate.measure(frame(spark, docs), bench).collect()}
    want = brute_windows(docs, items, 10)
    assert got == want
    clean = decontaminate.decontaminate(frame(spark, docs), bench)
    assert clean.columns == frame(spark, docs).columns
    assert sorted(r.doc_id for r in clean.collect()) == sorted(i for i, w in want.items() if not w[4])
    assert decontaminate.decontaminate(frame(spark, docs), bench.limit(0)).count() == len(docs)


def test_decontamination_keeps_columns_of_any_name(spark):
    docs = spark.createDataFrame([(1, "a b c", "x", 5), (2, "b c d", None, None)], "doc_id long, text string, _shard_text string, _n_hit int")
    bench = spark.createDataFrame([(1, "A, b")], "item_id long, text string")
    assert [tuple(r) for r in decontaminate.decontaminate(docs, bench).collect()] == [(2, "b c d", None, None)]


def test_longest_match(spark):
    bench = spark.createDataFrame([(1, "a b c d e f g h i j k l")], "item_id long, text string")
    got = decontaminate.measure(frame(spark, [(1, "x x b c d e y")]), bench).collect()[0]
    assert (got.longest_match, got.longest_item, got.longest_at, got.contaminated) == (4, "1", 2, False)


def test_base_spans_equal_plain_regexes():
    patterns = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]

    def plain(t):
        out = []
        for kind, p in zip(pii.KINDS, patterns, strict=True):
            for m in re.finditer(p, t):
                d = "".join(re.findall("[0-9]", m[0]))
                if {"email": True, "ip": kind != "ip" or all(int(q) <= 255 for q in m[0].split(".")), "card": 12 <= len(d) <= 19 and pii.luhn(d), "phone": 9 <= len(d) <= 15}[kind]:
                    out.append((kind, m.start(), m.end()))
        return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))

    rng = random.Random(2)
    texts = ["".join(rng.choice("ab1.2@ -+()%345_é678") for _ in range(rng.randint(0, 60))) for _ in range(20000)] + ["4111 1111-1111 1111 +1 (234) 555-2999", "@foo.bar@baz.com", "a@b@c.d", "1" * 40]
    for t in texts:
        assert pii.base_spans(t) == plain(t), t


def pii_corpus():
    rng = random.Random(3)
    words = "the and of in to was river stone green walks under".split()
    rows = []
    for k in range(400):
        w = [rng.choice(words) for _ in range(30)]
        w.insert(9, rng.choice([f"user{k}.name@mail{k % 9}.example.com", f"+1 ({200 + k}) 555-{1000 + k}", "4111 1111 1111 1111", f"10.0.{k % 200}.7", "look at noon. Then"]))
        rows.append((k, " ".join(w)))
    return rows


def test_trees_add_spans_and_keep_base_ones(spark):
    rows = pii_corpus()
    model = pii.train(frame(spark, rows))
    assert model.trees is not None
    assert [s[0] for s in model.spans("write to jane.doe at mail3 dot example dot com today")[1]] == ["email"]
    assert model.spans("the river was green and walks under stone at noon. Then of 2001")[1] == []
    extra = [(900, None), (901, ""), (902, "ab@cd.ef and ab@cd.ef")]
    got = {r.doc_id: r for r in pii.find(frame(spark, rows + extra), model).collect()}
    for i, t in rows + extra:
        base, every = model.spans(t)
        assert set(base) <= set(every) and got[i].spans == pii.joined(every)
        assert got[i].base_sha256 == hashlib.sha256(pii.joined(base).encode()).hexdigest() and got[i].n_email == sum(s[0] == "email" for s in base)
    out = {r.doc_id: r.text for r in pii.redact(frame(spark, extra), model).collect()}
    assert out == {900: None, 901: "", 902: "[EMAIL] and [EMAIL]"}


def test_all_documents_are_learnt_from(spark):
    """Personal data in 60 of 40,060 documents: of the 4,000 that were learnt from before, too few had any."""
    assert pii.train(frame(spark, [(1000 + k, "plain words") for k in range(40_000)] + pii_corpus()[:60])).trees is not None


def test_sums_of_tasks_give_the_model_of_the_driver(spark, monkeypatch):
    rows = pii.cut(pii.described(frame(spark, pii_corpus() + [(None, "mail ab@cd.ef")]).repartition(3)))
    assert rows.agg({"n": "sum"}).first()[0] > rows.count() >= 50
    monkeypatch.setattr(pii, "DRIVER_ROWS", 10**6)
    own = pii.fit(pii.summed(rows), rounds=3)
    monkeypatch.setattr(pii, "DRIVER_ROWS", rows.count() // 3)
    other = pii.fit(pii.summed(rows), rounds=3)
    assert own.thresholds == other.thresholds and (own.trees.slope, own.trees.shift) == (other.trees.slope, other.trees.shift)
    for a, b in ((own.trees.feature, other.trees.feature), (own.trees.bound, other.trees.bound), (own.trees.leaf, other.trees.leaf)):
        assert np.array_equal(a, b)


def test_bounds_are_quantiles():
    rng = np.random.default_rng(1)
    for top in (2, 9, 400):
        x = rng.integers(0, top, 1000)
        assert np.allclose(pii.quantiles(np.bincount(x, minlength=pii.VALUES)), np.unique(np.quantile(x, np.linspace(0, 1, 33)[1:-1])))


def test_calibration_of_rows_that_are_told_apart():
    """Newton's steps alone went astray where the trees are sure and right."""
    z = np.array([-7.0, -5.0, 4.0, 7.0])
    trees = pii.Trees(1)
    pii.calibrate(trees, z, np.array([[50, 9, 0, 0], [0, 0, 2, 57]]))
    assert 0 < trees.slope < 2 and abs(trees.shift) < 1


def test_nothing_to_learn_from(spark):
    model = pii.train(frame(spark, [(1, "plain words"), (2, None)]))
    assert model.trees is None and model.spans("ab@cd.ef")[1] == [("email", 0, 8)]


def toxic_corpus():
    rng = random.Random(5)
    words = [f"word{k}" for k in range(300)]
    rows, labels = [], []
    for k in range(900):
        w = [rng.choice(words) for _ in range(rng.choice([10, 80]))]
        y = k % 5 == 0
        if y:
            w[rng.randrange(len(w))] = rng.choice(["awful", "horrid"])
            w[rng.randrange(len(w))] = rng.choice(["awful", "horrid"])
        if rng.random() < (0.5 if y else 0.1):
            w.append("muslim")
        rows.append((k, " ".join(w)))
        labels.append((k, 1, int(y)))
    return rows, labels


def test_toxicity(spark):
    rows, labels = toxic_corpus()
    lab = spark.createDataFrame([*labels, (None, 1, 1), (5, 1, None)], "doc_id long, quality int, toxic int")
    docs = frame(spark, [*rows, (2000, None), (2001, ""), (None, "awful horrid")])
    model = toxicity.train(docs, lab)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    held = [k for k, _ in rows if got[k].held_out]
    truth = {k: y for k, _, y in labels}
    right = np.mean([got[k].predicted == truth[k] for k in held])
    assert right > 0.95 and 0 <= got[2000].score <= 1 and got[2000].score == got[2001].score
    assert got[2001].held_out in (True, False) and len(got) == len(rows) + 3
    loose = toxicity.train(docs, lab, counterfactual=0.0)
    odds = [[np.log(p / (1 - p)) for p in m.scores(toxicity.pa.array(["word1 muslim", "word1 christian"]))] for m in (model, loose)]
    bias = [abs(a - b) for a, b in odds]
    assert bias[0] < 0.5 * bias[1]
    kept = toxicity.reject(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {k for k, r in got.items() if r.predicted == 0}
    assert toxicity.train(docs, lab.limit(0)).scores(toxicity.pa.array(["x"]))[0] == 0.5


def test_warc_round_trip(spark, tmp_path):
    rng = random.Random(6)
    same = "<p>" + "x" * 200
    pages = [(k, f"http://e.org/{k}\r\n%", "".join(rng.choice("abé\n") for _ in range(rng.choice([0, 50, 3000])))) for k in range(60)] + [(k, None, same) for k in range(100, 130)] + [(200, "u", None), (201, "u", "short"), (202, "u", "short"), (None, "u", same), (110, None, same)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    want = []
    for i, _, html in pages:
        b = (html or "").encode()
        revisit = html == same and i != 100
        want.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if revisit else "response", 100 if revisit else None))
    got = warc.round_trip(df).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    manifest = warc.write(df, f"file://{tmp_path}/w")
    for split in (1, 700, 1 << 20):
        rows = warc.read(manifest, split_bytes=split).collect()
        assert len(rows) == len(pages) and {(r.page_id, r.url) for r in rows} == {(i, u) for i, u, _ in pages}
    assert {r.url for r in rows} >= {"http://e.org/3\r\n%", None}
    stored = b"".join(gzip.open(r.file).read() for r in manifest.collect())
    assert stored.count(b"WARC/1.1\r\n") == len(pages)
    assert warc.round_trip(df.limit(0)).count() == 0


def test_damaged_archives(spark, tmp_path):
    rng = np.random.default_rng(3)
    bodies = [rng.integers(0, 256, 3000, np.uint8).tobytes() for _ in range(9)]
    members = [warc.record(k, f"u{k}", b, hashlib.sha256(b).hexdigest(), None) for k, b in enumerate(bodies)]
    at = np.cumsum([0, *map(len, members)]).tolist()
    whole = b"".join(members)

    def ids(data, split, strict=True):
        path = tmp_path / "d.warc.gz"
        path.write_bytes(data)
        with warc.file_system(str(path))[0].open_input_file(str(path)) as f:
            return [int(warc.parse(r)[0]["x-page-id"]) for a in range(0, len(data), split) for r in warc.records_in(f, a, min(a + split, len(data)), len(data), strict)]

    for split in (100, 2500, at[4], 1 << 20):
        assert ids(whole, split) == list(range(9))
        for place in (0, 1, at[4], at[4] + 2, at[4] + 1500, at[5] - 3, at[8] + 1, len(whole) - 1):
            data = bytearray(whole)
            data[place] ^= 0x55
            with pytest.raises(ValueError, match="byte"):
                ids(bytes(data), split)
            assert len(ids(bytes(data), split, strict=False)) == 8
        with pytest.raises(ValueError, match="byte"):
            ids(whole[:-700], split)
        with pytest.raises(ValueError, match="byte"):
            ids(whole[: at[3]] + b"junk" + whole[at[3] :], split)
    file = tmp_path / "e.warc.gz"
    data = bytearray(whole)
    data[at[2]] ^= 0xFF
    file.write_bytes(bytes(data))
    manifest = spark.createDataFrame([(str(file), len(data), 9)], "file string, bytes long, records long")
    with pytest.raises(Exception, match="no record begins at byte"):
        warc.read(manifest, digests=True, split_bytes=2000).collect()
    assert warc.read(spark.createDataFrame([(str(file), len(data), 9)] * 6, manifest.schema), split_bytes=2000).rdd.getNumPartitions() >= 16


def test_false_magic_inside_a_member(tmp_path):
    data = b"".join(warc.record(k, "u", warc.MAGIC * 40 + bytes(np.random.default_rng(k).integers(0, 256, 5000, np.uint8)), "0", None) for k in range(5))
    path = tmp_path / "a.warc.gz"
    path.write_bytes(b"junk" + data)
    with warc.file_system(str(path))[0].open_input_file(str(path)) as f:
        size = path.stat().st_size
        for step in (100, 3000, size):
            ids = [warc.parse(r)[0]["x-page-id"] for a in range(0, size, step) for r in warc.records_in(f, a, min(a + step, size), size)]
            assert ids == ["0", "1", "2", "3", "4"]


@pytest.mark.parametrize("text, n", [("A muslim, a Muslim. MUSLIM!", 3), ("la femme (femmes)", 2), ("ein Moslem; die Juden", 2), ("un judío y una mujer", 2), ("womanly semantics", 0), ("a muſlim man", 1)])
def test_every_mention_is_swapped(text, n):
    for row in range(12):
        with_mention, other = toxicity.swapped(text, row)
        a, b = (re.findall(r"\w+", x) for x in (with_mention, other))
        assert len(a) == len(b) and sum(x != y for x, y in zip(a, b)) == max(n, 1)
        if n:
            assert with_mention == text and all((x.isupper(), x.istitle()) == (y.isupper(), y.istitle()) for x, y in zip(a, b) if len(x) > 1)


def test_reject_keeps_columns_of_any_name(spark):
    docs = spark.createDataFrame([(1, "vile words", "x"), (2, None, "y")], "doc_id long, text string, _score_text string")
    model = toxicity.Model(np.zeros(1 << toxicity.BITS, np.float32), -1.0)
    assert sorted(map(tuple, toxicity.reject(docs, model).collect())) == [(1, "vile words", "x"), (2, None, "y")]
