"""Toxicity by a counterfactual-regularised classifier.

A logistic model over hashed words and their beginnings, of those that go with a label. For each labelled text a
counterfactual is made by swapping its identity terms for others of the same group (a text that names
none gets one term of a group appended, and its counterfactual another), and the squared change of the
score's log odds is a penalty, so that naming a group doesn't move a score.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkgraph.llm.common import BYTE, LOWER, arrow_map, cut, fresh, mix, prefix_sums, range_hash, text_bytes, words_of

BITS = 18
#: The model is fitted on at most so many labelled rows, those of smallest xxhash64(doc_id).
MAX_TRAIN = 20_000
THRESHOLD = 0.7
#: About what chance alone gives to one of 2**18 features.
EVIDENCE = 20.0
# Terms that name groups of people, by language and group.
IDENTITY_TERMS = {
    "en": {
        "faith": ["christian", "muslim", "jewish", "hindu", "buddhist", "atheist", "catholic", "sikh"],
        "faiths": ["christians", "muslims", "jews", "hindus", "buddhists", "atheists", "catholics", "sikhs"],
        "gender": ["woman", "man", "girl", "boy"],
        "genders": ["women", "men", "girls", "boys"],
        "identity": ["transgender", "cisgender", "nonbinary", "trans"],
        "orientation": ["gay", "lesbian", "bisexual", "straight", "queer", "homosexual", "heterosexual"],
        "origin": ["african", "asian", "european", "latino", "arab", "american", "mexican", "chinese", "indian"],
        "origins": ["africans", "asians", "europeans", "latinos", "arabs", "americans", "mexicans", "indians"],
        "colour": ["black", "white", "brown"],
        "ability": ["blind", "deaf", "disabled", "autistic"],
    },
    "fr": {
        "faith": ["chrétien", "musulman", "juif", "hindou", "bouddhiste", "athée", "catholique"],
        "faiths": ["chrétiens", "musulmans", "juifs", "hindous", "bouddhistes", "athées", "catholiques"],
        "gender": ["femme", "homme", "fille", "garçon"],
        "genders": ["femmes", "hommes", "filles", "garçons"],
        "orientation": ["gai", "lesbienne", "bisexuel", "hétérosexuel", "homosexuel"],
        "origin": ["africain", "asiatique", "européen", "arabe", "américain", "mexicain", "chinois", "indien"],
        "colour": ["noir", "blanc"],
        "ability": ["aveugle", "sourd", "handicapé", "autiste"],
    },
    "de": {
        "faith": ["christ", "moslem", "jude", "hindu", "buddhist", "atheist", "katholik"],
        "faiths": ["christen", "muslime", "juden", "hindus", "buddhisten", "atheisten", "katholiken"],
        "gender": ["frau", "mann", "mädchen", "junge"],
        "genders": ["frauen", "männer", "mädchen", "jungen"],
        "orientation": ["schwul", "lesbisch", "bisexuell", "heterosexuell", "homosexuell"],
        "origin": ["afrikaner", "asiate", "europäer", "araber", "amerikaner", "mexikaner", "chinese", "inder"],
        "colour": ["schwarz", "weiß"],
        "ability": ["taub", "behindert", "autistisch"],
    },
    "es": {
        "faith": ["cristiano", "musulmán", "judío", "hindú", "budista", "ateo", "católico"],
        "faiths": ["cristianos", "musulmanes", "judíos", "hindúes", "budistas", "ateos", "católicos"],
        "gender": ["mujer", "hombre", "niña", "niño"],
        "genders": ["mujeres", "hombres", "niñas", "niños"],
        "orientation": ["lesbiana", "bisexual", "heterosexual", "homosexual"],
        "origin": ["africano", "asiático", "europeo", "árabe", "americano", "mexicano", "chino", "indio"],
        "colour": ["negro", "blanco"],
        "ability": ["ciego", "sordo", "discapacitado", "autista"],
    },
}


def _groups() -> dict[str, tuple[list[str], int]]:
    """Each term's group and its place there; a term of several languages is of the first."""
    out: dict[str, tuple[list[str], int]] = {}
    for terms in IDENTITY_TERMS.values():
        for group in terms.values():
            for k, t in enumerate(group):
                out.setdefault(t, (group, k))
    return out


_GROUP_OF = _groups()
# A mention is a whole word: what stands before and behind it is neither a letter nor a digit.
_MENTION = re.compile(rf"(?<![^\W_])(?:{'|'.join(sorted(_GROUP_OF, key=len, reverse=True))})(?![^\W_])", re.IGNORECASE)


def features(col: pa.Array, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Row and feature of each feature that a text has, once each, by row; only wanted ones if that is given."""
    raw, off = text_bytes(col)
    starts, ends, doc = words_of(raw, off, "alnum")
    c = prefix_sums(BYTE[LOWER[raw]])
    whole = range_hash(c, starts, ends)
    long = ends - starts > 4
    begin = [mix(range_hash(c, starts[k], starts[k] + n) + np.uint64(n)) for n, k in ((4, long), (5, ends - starts > 5))]
    rows = np.concatenate([doc, doc[long], doc[ends - starts > 5]]).astype(np.int64)
    feats = (np.concatenate([whole, *begin]) >> np.uint64(64 - BITS)).astype(np.int64)
    if wanted is not None:
        keep = wanted[feats]
        rows, feats = rows[keep], feats[keep]
    found = np.unique((rows << BITS) | feats)
    return found >> BITS, found & ((1 << BITS) - 1)


def swapped(text: str, row: int) -> tuple[str, str]:
    """The text with a mention, and its counterfactual: each mention, whatever its case and what stands around it, is another of its group."""
    new = _MENTION.sub(lambda m: _other(m[0], row), text)
    if new != text:
        return text, new
    groups = [g for terms in IDENTITY_TERMS.values() for g in terms.values()]
    group = groups[row % len(groups)]
    a = row // len(groups) % len(group)
    return f"{text} {group[a]}", f"{text} {group[(a + 1) % len(group)]}"


def _other(word: str, row: int) -> str:
    """Another term of the word's group and language, cased as the word is."""
    if word.lower() not in _GROUP_OF:  # matched by a letter that only folds to one of the term's
        return word
    group, k = _GROUP_OF[word.lower()]
    new = group[(k + 1 + row % (len(group) - 1)) % len(group)]
    return new.upper() if word.isupper() and len(word) > 1 else new.capitalize() if word[:1].isupper() else new


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def scores(self, col: pa.Array) -> np.ndarray:
        rows, feats = features(col, self.weights != 0)
        z = np.bincount(rows, self.weights[feats], minlength=len(col)) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def telling(count: np.ndarray, with_label: np.ndarray, n: int, n_label: int) -> np.ndarray:
    """Features whose presence goes with a label: log-likelihood ratio against independence of at least EVIDENCE.

    count and with_label: of n texts, how many have each feature; and how many of the n_label labelled 1.
    """
    total = np.zeros(len(count))
    for seen, of in ((with_label, n_label), (count - with_label, n - n_label)):
        for k, all_k in ((seen, count), (of - seen, n - count)):
            total += np.where(k > 0, k * np.log(np.maximum(k, 1) * max(n, 1) / np.maximum(all_k * of, 1)), 0)
    return 2 * total >= EVIDENCE


def fit(texts: list[tuple[np.ndarray, np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = 40, rate: float = 0.3, l2: float = 1e-5, counterfactual: float = 1.0, batch: int = 64, seed: int = 7) -> Model:
    """texts: features of each text, those that only its version with a mention has, and those that only its counterfactual has.

    AdaGrad on log loss, plus `counterfactual` times the squared difference of the two versions' log odds,
    plus l2. Classes are weighted to count alike. Without both labels the model says 0.5.
    """
    w, b = np.zeros(1 << BITS), 0.0
    if len({*labels.tolist()}) < 2:
        return Model(w.astype(np.float32), b)
    seen, seen_b, rng = np.full(1 << BITS, 1e-6), 1e-6, np.random.default_rng(seed)
    share = labels.mean()
    weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)) ** 0.5
    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for k in range(0, len(order), batch):
            idx = order[k : k + batch]
            z = np.array([w[texts[i][0]].sum() for i in idx]) + b
            g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[idx]) * weight[idx]
            gb = g.sum()
            za, zb = (np.array([w[texts[i][v]].sum() for i in idx]) for v in (1, 2))
            change = 2 * counterfactual * np.clip(za - zb, -5, 5)
            cols = [texts[i][v] for v in (0, 1, 2) for i in idx]
            grads = np.repeat(np.concatenate([g, change, -change]), [len(c) for c in cols])
            at, inv = np.unique(np.concatenate(cols), return_inverse=True)
            step = np.bincount(inv, grads, minlength=len(at)) / len(idx) + l2 * w[at]
            seen[at] += step**2
            w[at] -= rate * step / np.sqrt(seen[at])
            gb /= len(idx)
            seen_b += gb**2
            b -= rate * gb / np.sqrt(seen_b)
    return Model(w.astype(np.float32), float(b))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_train: int = MAX_TRAIN, **options: float) -> Model:
    """The model of the labelled rows whose crc32(id as text) mod 3 isn't 1, of at most max_train of them.

    A row of labels without id or label is left out; an id labelled more than once is toxic if any of
    its rows is. Of the documents of one id each is learnt from. Features are counted by Spark; the driver
    gets the counts, at most 2**BITS, and of each text only the features that go with a label.
    """
    chosen = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y")).na.drop().filter(F.expr("crc32(cast(_id as string)) % 3 <> 1")).groupBy("_id").agg(F.max("_y").alias("_y")).orderBy(F.xxhash64("_id"), "_id").limit(max_train)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text")).join(F.broadcast(chosen), "_id").select("_y", F.crc32(F.col("_id").cast("string")).alias("_r"), "_text")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        plain = [x or "" for x in batch.column(2).to_pylist()]
        both = [swapped(x, r) for x, r in zip(plain, batch.column(1).to_pylist(), strict=True)]
        parts = []
        for part in (plain, [x for x, _ in both], [x for _, x in both]):
            rows, feats = features(pa.array(part, pa.string()))
            parts.append((rows, feats))
        # Of the two versions only what one has and the other hasn't moves their difference.
        keys = [(rows << BITS) | feats for rows, feats in parts]
        only = [np.setdiff1d(keys[k], keys[j], assume_unique=True) for k, j in ((1, 2), (2, 1))]
        cols = [as_lists(k, len(plain)) for k in (keys[0], *only)]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *cols], names=["y", "r", "a", "b", "c"])

    schema = "y int, r long, a array<int>, b array<int>, c array<int>"
    rows = cut(arrow_map(texts, run, schema))
    n, n_label = rows.agg(F.count("*"), F.coalesce(F.sum((F.col("y") == 1).cast("long")), F.lit(0))).first()
    seen = rows.select("y", F.explode("a").alias("f")).groupBy("f").agg(F.count("*").alias("n"), F.sum((F.col("y") == 1).cast("long")).alias("y")).toArrow()
    count, with_label = np.zeros(1 << BITS), np.zeros(1 << BITS)
    at = seen["f"].to_numpy()
    count[at], with_label[at] = seen["n"].to_numpy(), seen["y"].to_numpy()
    keep = telling(count, with_label, n, n_label)
    keep[features(pa.array([form for t in _GROUP_OF for form in (t, t.capitalize(), t.upper())]))[1]] = True

    def choose(batch: pa.RecordBatch) -> pa.RecordBatch:
        cols = []
        for col in batch.columns[2:]:
            feats = col.flatten().to_numpy()
            of = np.repeat(np.arange(len(col)), np.diff(col.offsets.to_numpy()))
            some = keep[feats]
            cols.append(as_lists((of[some] << BITS) | feats[some], len(col)))
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *cols], names=batch.schema.names)

    got = arrow_map(rows, choose, schema).toArrow().combine_chunks()
    y, r = got["y"].to_numpy(), got["r"].to_numpy()
    lists = [[x.values.to_numpy() for x in got[c]] for c in "abc"]
    # The order in which rows arrive must not matter.
    order = sorted(range(len(y)), key=lambda i: (r[i], y[i], *(x[i].tobytes() for x in lists)))
    return fit([tuple(x[i] for x in lists) for i in order], y[order].astype(np.float64), **options)


def as_lists(keys: np.ndarray, n: int) -> pa.Array:
    """The features in keys (row << BITS | feature, sorted), as a list for each of n rows."""
    off = np.searchsorted(keys, np.arange(n + 1) << BITS).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(off), pa.array((keys & ((1 << BITS) - 1)).astype(np.int32)))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The id, held_out, score and predicted of each row of docs; null and empty texts get the score of no words. Rows without id are not held out."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        s = np.round(sent.value.scores(batch.column(2)), 9)
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=[id_col, "held_out", "score", "predicted"])

    rows = docs.select(F.col(id_col), F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False)).alias("held_out"), F.col(text_col).cast("string").alias("_text"))
    return arrow_map(rows, run, f"{id_col} {dict(docs.dtypes)[id_col]}, held_out boolean, score double, predicted int")


def reject(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """docs without those that score at least threshold; all columns stay."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(np.round(sent.value.scores(batch.column(batch.num_columns - 1)), 9) < threshold)).select(batch.schema.names[:-1])

    return arrow_map(docs.withColumn(fresh(docs, "_score_text"), F.col(text_col).cast("string")), run, ", ".join(f"`{c}` {k}" for c, k in docs.dtypes))
