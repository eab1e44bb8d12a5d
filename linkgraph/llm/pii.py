"""Personal data by candidate gradient boosting.

High-recall generators propose overlapping spans; the base patterns certify some of them outright, and
boosted trees judge the rest by their format and context. A span is taken if its probability,
calibrated on rows kept out of the fit, reaches the threshold of its kind.

There are no labelled spans, so labels are made: spans that the base patterns certify are positive,
written anew in the ways people write such data (an address spelt with "at" and "dot", a number without
its plus or with other separators), in their own contexts; candidates that the patterns don't certify,
and look-alikes put in their place (wrong check digits, too many digits, plain words), are negative.

All documents are learnt from. Tasks describe their candidates and count equal descriptions; bounds, trees,
calibration and thresholds need only sums over these counts. Few descriptions are summed by the driver,
more by tasks, one pass for each level of a tree; sums are of whole numbers, so both give the same model.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkgraph.llm.common import arrow_map, cut, give_back, slices, small_batches

KINDS = ("email", "ip", "card", "phone")
#: The driver sums so many different descriptions itself; more are summed by tasks, so many each.
DRIVER_ROWS = 200_000
#: A task hands on its counts when it holds so many descriptions.
HELD_ROWS = 100_000
#: Features of a description, and a bound of their values, which the generators' lengths set.
FEATURES, VALUES = 27, 512
BINS = 32
#: Gradients are summed in these units, log odds of the calibration counted in those.
UNIT, LOG_ODDS, MOST = 2.0**-24, 2.0**-8, 16
# The base patterns.
EMAIL_DOMAIN = r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
EMAIL_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+"
CARD = r"[0-9](?:[\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_DOMAIN, _IP, _CARD, _PHONE = map(re.compile, (EMAIL_DOMAIN, IP, CARD, PHONE))
_DIGIT_RUN = re.compile(r"[0-9][0-9\x20-]{10,}[0-9]")
#: Generators beyond the base patterns; a candidate overlapping a base span is dropped.
_GENERATORS = [
    ("email", re.compile(r"[A-Za-z0-9._%+-]{2,64} ?(?:\[at\]|\(at\)|@| at ) ?[A-Za-z0-9-]{2,63}(?: ?(?:\[dot\]|\(dot\)|\.| dot ) ?[A-Za-z0-9-]{2,24}){1,4}", re.I)),
    ("phone", re.compile(r"(?<![0-9A-Za-z.])(?:\(?[0-9]{2,4}\)?[\x20./-]){1,4}[0-9]{3,8}(?![0-9A-Za-z])")),
    ("card", re.compile(r"(?<![0-9A-Za-z])[0-9]{4}(?:[./_ -]{1,2}[0-9]{3,6}){2,4}(?![0-9A-Za-z])")),
    ("ip", re.compile(r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:(?:\[\.\]|\(\.\)| \. )[0-9]{1,3}){3}(?![0-9A-Za-z])")),
]
_MAYBE_EMAIL = re.compile(r"@|\[at\]|\(at\)| at \S+ ?(?:dot|\.|\[dot\]|\(dot\))", re.I)

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        if k % 2:
            v = v * 2 - 9 if v > 4 else v * 2
        total += v
    return total % 10 == 0


def only_digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """What the base patterns certify, by start, then kind: leftmost and non-overlapping in each kind; a match that fails its test is dropped."""
    out: list[Span] = []
    if "@" in text:
        done = 0
        for m in _DOMAIN.finditer(text):
            k = m.start()
            while k > done and text[k - 1] in EMAIL_LOCAL:
                k -= 1
            if k < m.start():
                out.append(("email", k, m.end()))
                done = m.end()
    for m in _IP.finditer(text):
        if all(int(p) <= 255 if len(p) < 40 else not p.strip("0") for p in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    # Only a stretch with 12 digits can hold a card, and its first match begins where any match would.
    if _DIGIT_RUN.search(text):
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12 and 12 <= len(d := only_digits(m[0])) <= 19 and luhn(d):
                out.append(("card", m.start(), m.end()))
    if "+" in text:
        out.extend(("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(only_digits(m[0])) <= 15)
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def candidates(text: str, taken: list[Span]) -> list[Span]:
    """What the generators propose, but for what overlaps spans taken."""
    out: list[Span] = []
    for kind, pattern in _GENERATORS:
        if kind == "email" and not _MAYBE_EMAIL.search(text):
            continue
        for m in pattern.finditer(text):
            if all(m.end() <= a or b <= m.start() for _, a, b in taken):
                out.append((kind, m.start(), m.end()))
    return out


# Words before or after which people write such data.
CUES = {
    "email": ("mail", "email", "e-mail", "contact", "write", "correo", "courriel"),
    "ip": ("ip", "host", "server", "address", "ping", "adresse"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "karte", "carte", "tarjeta"),
    "phone": ("phone", "call", "tel", "mobile", "cell", "fax", "telefon", "teléfono", "whatsapp"),
}
_YEAR = re.compile(r"(?:19|20)[0-9]{2}")


def describe(text: str, span: Span) -> list[float]:
    """Format and context of a candidate."""
    kind, a, b = span
    s, left, right = text[a:b], text[max(0, a - 24) : a].lower(), text[b : b + 24].lower()
    d = only_digits(s)
    groups = re.findall("[0-9]+", s)
    labels = re.split(r"[^a-z]+", s.lower())
    around = {*re.findall(r"[\w-]+", left)[-3:], *re.findall(r"[\w-]+", right)[:1]}
    return [
        KINDS.index(kind), len(s), len(d), len(groups), max(map(len, groups), default=0), min(map(len, groups), default=0), len(groups[0]) if groups else 0, len(groups[-1]) if groups else 0,
        float(len(d) >= 12 and luhn(d)), float("@" in s), float(" at " in s.lower()), float(bool(re.search(r"[\[(](?:at|@)[\])]", s.lower()))), float(bool(re.search(r" dot |[\[(](?:dot|\.)[\])]", s.lower()))), float("(" in s), float("-" in s), float("." in s), float(" " in s), float("/" in s),
        len(labels[-1]) if labels else 0, float(any(c.isdigit() for c in s.split(" ")[0])), float(bool(groups) and all(len(g) <= 3 and int(g) <= 255 for g in groups)), float(bool(_YEAR.match(s))),
        float(any(c in around for c in CUES[kind])), float(left[-1:].isalnum()), float(right[:1].isalnum()), float(left[-1:] in "\"'=<"), len({*s}),
    ]


@dataclass
class Trees:
    """Trees of fixed depth over numbers; each node has a feature and a bound, each leaf a value."""

    depth: int
    feature: list[np.ndarray] = field(default_factory=list)
    bound: list[np.ndarray] = field(default_factory=list)
    leaf: list[np.ndarray] = field(default_factory=list)
    start: float = 0.0
    slope: float = 1.0
    shift: float = 0.0

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        for f, b, v in zip(self.feature, self.bound, self.leaf, strict=True):
            out += v[self.node(x, f, b, self.depth) - (2**self.depth - 1)]
        return out

    @staticmethod
    def node(x: np.ndarray, feature: np.ndarray, bound: np.ndarray, depth: int) -> np.ndarray:
        """Where each row gets to in so many steps from a tree's root."""
        node, row = np.zeros(len(x), np.int64), np.arange(len(x))
        for _ in range(depth):
            node = 2 * node + 1 + (x[row, feature[node]] > bound[node])
        return node

    def proba(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.raw(x) + self.shift, -30, 30)))


class Part:
    """Descriptions, each with its label, whether it is held out of the fit, and how often it occurs."""

    def __init__(self, keys: pa.Array, counts: pa.Array) -> None:
        raw = np.frombuffer(b"".join(keys.to_pylist()), np.uint8).reshape(-1, 2 * FEATURES + 2)
        self.x = np.ascontiguousarray(raw[:, :-2]).view(np.uint16).astype(np.int64)
        self.y, self.held = raw[:, -2].astype(np.int64), raw[:, -1] > 0
        self.n = counts.to_numpy(zero_copy_only=False).astype(np.int64)
        self.bins: list[np.ndarray] = []  # these and the log odds are of the rows of the fit
        self.z, self.done = np.zeros(0), 0

    @staticmethod
    def key(x: list[float], y: int, held: bool) -> bytes:
        return np.array(x, np.uint16).tobytes() + bytes([y, held])

    def values(self) -> np.ndarray:
        """How often each feature has each value among the rows of the fit; then counts of all rows with label 0 and 1, and of those of the fit."""
        fit = ~self.held
        of = [np.bincount(self.x[fit, c], self.n[fit], VALUES) for c in range(FEATURES)]
        return np.concatenate([*of, np.bincount(self.y, self.n, 2), np.bincount(self.y[fit], self.n[fit], 2)]).astype(np.int64)

    def gradients(self, trees: Trees, bounds: list[np.ndarray], feature: np.ndarray, bound: np.ndarray, level: int) -> np.ndarray:
        """First and second derivatives of the loss, summed by node of a tree's level, feature and bin, in units."""
        fit = np.flatnonzero(~self.held)
        x, y, n = self.x[fit], self.y[fit], self.n[fit]
        if not self.bins:
            self.bins = [np.searchsorted(b, c) for b, c in zip(bounds, x.T, strict=True)]
            self.z = np.full(len(x), trees.start)
        for k in range(self.done, len(trees.leaf)):  # the sums of trees seen before are kept
            self.z += trees.leaf[k][trees.node(x, trees.feature[k], trees.bound[k], trees.depth) - (2**trees.depth - 1)]
        self.done = len(trees.leaf)
        p = 1 / (1 + np.exp(-self.z))
        node = (trees.node(x, feature, bound, level) - (2**level - 1)) * BINS
        sums = [np.rint(v / UNIT) * n for v in (p - y, p * (1 - p))]
        return np.array([[np.bincount(node + b, v, 2**level * BINS) for b in self.bins] for v in sums]).astype(np.int64).ravel()

    def outcomes(self, trees: Trees) -> np.ndarray:
        """Counts of the rows held out by kind, label and log odds."""
        z = np.clip(np.rint(trees.raw(self.x[self.held]) / LOG_ODDS), -MOST / LOG_ODDS, MOST / LOG_ODDS).astype(np.int64)
        n = int(2 * MOST / LOG_ODDS) + 1
        at = (self.x[self.held, 0] * 2 + self.y[self.held]) * n + z + n // 2
        return np.bincount(at, self.n[self.held], len(KINDS) * 2 * n).astype(np.int64)


#: Adds up what a function makes of every part.
Sums = Callable[[Callable[[Part], np.ndarray]], np.ndarray]


def quantiles(counts: np.ndarray) -> np.ndarray:
    """Different bounds that cut values with these counts into BINS bins."""
    total = np.cumsum(counts)
    at = np.linspace(0, 1, BINS + 1)[1:-1] * (total[-1] - 1)
    below, above = (np.searchsorted(total, f(at), side="right") for f in (np.floor, np.ceil))
    return np.unique(below + (above - below) * (at - np.floor(at)))


def boost(sums: Sums, bounds: list[np.ndarray], positive: float, rounds: int = 60, depth: int = 3, rate: float = 0.2, ridge: float = 1.0) -> Trees:
    """Newton boosting of log loss; each split is the best of at most 31 bounds of each feature. positive is the share of label 1."""
    share = np.clip(positive, 1e-3, 1 - 1e-3)
    out = Trees(depth, start=float(np.log(share / (1 - share))))
    for _ in range(rounds):
        f, b, v = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, np.inf), np.zeros(2**depth)
        for level in range(depth):
            g, h = sums(lambda part, level=level, f=f, b=b: part.gradients(out, bounds, f, b, level)).reshape(2, FEATURES, 2**level, BINS) * UNIT
            gs, hs = np.cumsum(g, 2), np.cumsum(h, 2)
            for k in range(2**level):
                best, at, cell = 1e-6, 2**level - 1 + k, BINS - 1
                for c in range(FEATURES):
                    n = len(bounds[c])
                    left, weight, every, whole = gs[c, k, :n], hs[c, k, :n], gs[c, k, -1], hs[c, k, -1]
                    gain = left**2 / (weight + ridge) + (every - left) ** 2 / (whole - weight + ridge) - every**2 / (whole + ridge)
                    if n and gain.max() > best:
                        best, f[at], cell = gain.max(), c, int(gain.argmax())
                        b[at] = bounds[c][cell]
                if level == depth - 1:
                    left, weight, every, whole = gs[f[at], k, cell], hs[f[at], k, cell], gs[f[at], k, -1], hs[f[at], k, -1]
                    v[2 * k : 2 * k + 2] = -rate * left / (weight + ridge), -rate * (every - left) / (whole - weight + ridge)
        out.feature.append(f)
        out.bound.append(b)
        out.leaf.append(v)
    return out


def calibrate(trees: Trees, z: np.ndarray, n: np.ndarray) -> None:
    """Platt's scaling on rows that the trees haven't seen: n has their counts by label and log odds z."""
    no, yes = n.sum(1).tolist()
    if not no or not yes:
        return
    target = np.array([1 / (no + 2), (yes + 1) / (yes + 2)])[:, None]

    def loss(a: float, b: float) -> float:
        return float((n * (np.logaddexp(0, a * z + b) - target * (a * z + b))).sum())

    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        off = (n * (p - target)).sum(0)
        w = n.sum(0) * (p * (1 - p) + 1e-6)
        grad = np.array([(off * z).sum(), off.sum()])
        hess = np.array([[(w * z * z).sum() + 1e-3, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-3]])
        step, now = np.linalg.solve(hess, grad), loss(a, b)
        while abs(step).max() > 1e-9 and loss(a - step[0], b - step[1]) > now:  # where p is near 0 or 1, Newton's step is too long
            step /= 2
        if abs(step).max() <= 1e-9:
            break
        a, b = a - step[0], b - step[1]
    trees.slope, trees.shift = float(a), float(b)


def rewritten(kind: str, s: str, rng: random.Random) -> tuple[str, str]:
    """A span as people might write it so that the base patterns miss it, and a look-alike that is no personal data."""
    d = only_digits(s)
    if kind == "email":
        local, _, domain = s.partition("@")
        at, dot = rng.choice([(" at ", " dot "), (" [at] ", " [dot] "), ("(at)", "(dot)"), ("[at]", "."), (" @ ", ".")])
        words = ["look", "the end", "noon", "best", "least", "all", "the door"]
        return f"{local}{at}{domain.replace('.', dot)}", f"{rng.choice(words)} at {rng.choice(words).split()[-1]}. {rng.choice(words).capitalize()}"
    if kind == "ip":
        form = rng.choice(["[.]", "(.)", " . "])
        return s.replace(".", form), form.join(str(rng.randint(256, 999)) for _ in range(4))
    if kind == "card":
        sep = rng.choice([".", "/", "_", " - "])
        bad = d[:-1] + str((int(d[-1]) + rng.randint(1, 9)) % 10)
        return sep.join(re.findall(".{1,4}", d)), sep.join(re.findall(".{1,4}", bad))
    ten = d[-10:]
    good = rng.choice([f"({ten[:3]}) {ten[3:6]}-{ten[6:]}", f"{ten[:3]}-{ten[3:6]}-{ten[6:]}", f"{ten[:3]}.{ten[3:6]}.{ten[6:]}", f"0{ten[:3]} {ten[3:6]}{ten[6:]}"])
    bad = rng.choice([f"{rng.randint(1900, 2030)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d} {rng.randint(1900, 2030)}", f"{rng.randint(10, 99)}.{rng.randint(100, 999)}", f"{rng.randint(1900, 2030)}/{rng.randint(100, 999)}", f"{rng.randint(100, 999)} {rng.randint(100, 999)}", f"{rng.randint(1990, 2030)} 000"])
    return good, bad


def examples(text: str, rng: random.Random) -> list[tuple[list[float], int, str]]:
    """Described candidates of a text and of its rewritings, each with its made label and kind."""
    base = base_spans(text)
    out = [(describe(text, c), 0, c[0]) for c in candidates(text, base)]
    for kind, a, b in base:
        for label, new in zip((1, 0), rewritten(kind, text[a:b], rng), strict=True):
            left, right = text[max(0, a - 60) : a], text[b : b + 60]
            cue = f"{rng.choice(CUES[kind])}: " if label and rng.random() < 0.3 else ""
            context = f"{left}{cue}{new}{right}"
            at, end = len(left) + len(cue), len(left) + len(cue) + len(new)
            out.extend((describe(context, c), label, c[0]) for c in candidates(context, base_spans(context)) if c[1] < end and at < c[2] and (not label or c[0] == kind))
    return out


@dataclass
class Model:
    """trees is None where nothing could be learnt; then only base spans are found."""

    trees: Trees | None
    thresholds: dict[str, float]

    def spans(self, text: str | None) -> tuple[list[Span], list[Span]]:
        """Base spans, and all spans by start, then kind, then end."""
        if not text:
            return [], []
        base = base_spans(text)
        more = candidates(text, base) if self.trees is not None else []
        if not more:
            return base, base
        p = self.trees.proba(np.array([describe(text, c) for c in more]))
        chosen: list[Span] = []
        for q, c in sorted(zip(p.tolist(), more, strict=True), key=lambda x: (-x[0], x[1][1], x[1])):
            if q >= self.thresholds[c[0]] and all(c[2] <= a or b <= c[1] for _, a, b in chosen):
                chosen.append(c)
        return base, sorted([*base, *chosen], key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def fit(sums: Sums, precision: float = 0.98, rounds: int = 60) -> Model:
    """Trees of four fifths of the rows; calibration, and thresholds of at least that precision by kind, from the rest."""
    got = sums(Part.values)
    no, yes, fit_no, fit_yes = got[-4:].tolist()
    if no + yes < 50 or not no or not yes or not fit_no + fit_yes:
        return Model(None, {})
    bounds = [quantiles(c) for c in got[:-4].reshape(FEATURES, VALUES)]
    trees = boost(sums, bounds, fit_yes / (fit_no + fit_yes), rounds)
    n = sums(lambda part: part.outcomes(trees)).reshape(len(KINDS), 2, -1)
    z = (np.arange(n.shape[2]) - n.shape[2] // 2) * LOG_ODDS
    calibrate(trees, z, n.sum(0))
    p = 1 / (1 + np.exp(-np.clip(trees.slope * z + trees.shift, -30, 30)))
    thresholds = {}
    for kind, (wrong, right) in zip(KINDS, n, strict=True):
        good = [t for t in np.arange(0.5, 1.0, 0.01) if right[p >= t].sum() >= max(1, precision * (right + wrong)[p >= t].sum())]
        thresholds[kind] = float(max(good[0], 0.8)) if good else 2.0  # no span of a kind that never gets precise
    return Model(trees, thresholds)


def described(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The different descriptions of all documents' candidates and how often each occurs: (key, n). Documents whose hash is divisible by five are held out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()
        for batch in batches:
            for part in slices(batch):
                for h, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    if t:
                        seen.update(Part.key(x, y, h % 5 == 0) for x, y, _ in examples(t, random.Random(h)))
                if len(seen) > HELD_ROWS:
                    yield block(seen)
                    seen.clear()
            give_back()
        if seen:
            yield block(seen)

    def block(seen: Counter[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["key", "n"])

    small_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text")).select(F.xxhash64("_id", "_text").alias("_h"), "_text")
    return texts.mapInArrow(run, "key binary, n long").groupBy("key").agg(F.sum("n").alias("n"))


def summed(rows: DataFrame) -> Sums:
    """Adds up over all descriptions: in the driver if they are few, else in tasks."""
    n = rows.count()
    if n <= DRIVER_ROWS:
        got = rows.toArrow()
        part = Part(got["key"].combine_chunks(), got["n"].combine_chunks())
        return lambda f: f(part)
    parts = rows.coalesce(math.ceil(n / max(1, DRIVER_ROWS)))

    def spread(f: Callable[[Part], np.ndarray]) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = list(batches)
            if sum(b.num_rows for b in held):
                got = pa.Table.from_batches(held)
                yield pa.RecordBatch.from_arrays([pa.array([f(Part(got["key"].combine_chunks(), got["n"].combine_chunks()))], pa.list_(pa.int64()))], names=["sums"])

        total = None
        for row in parts.mapInArrow(run, "sums array<long>").toArrow()["sums"]:
            own = row.values.to_numpy()
            total = own if total is None else total + own
        return total

    return spread


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """The model of all documents; the driver gets counted descriptions or sums over them, not texts."""
    return fit(summed(cut(described(docs, id_col, text_col))))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of docs: its id, counts of base spans by kind, base_sha256, and spans (base and added, kind:start:end in code points, end exclusive).

    Null and empty texts have no spans. Added spans never overlap base ones, nor one another.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [sent.value.spans(t) for t in batch.column(1).to_pylist()]
        counts = [pa.array([sum(s[0] == k for s in b) for b, _ in found], pa.int64()) for k in KINDS]
        sha = pa.array([hashlib.sha256(joined(b).encode()).hexdigest() for b, _ in found], pa.string())
        return pa.RecordBatch.from_arrays([batch.column(0), *counts, sha, pa.array([joined(a) for _, a in found], pa.string())], names=[id_col, *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    kind = dict(docs.dtypes)[id_col]
    return arrow_map(docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text")), run, f"{id_col} {kind}, {', '.join(f'n_{k} long' for k in KINDS)}, base_sha256 string, spans string")


def redact_text(text: str, spans: list[Span]) -> str:
    """The text with a mark of its kind in place of each span; of overlapping spans the first marks, the rest only lengthen it."""
    out, done = [], 0
    for kind, a, b in spans:
        if a >= done:
            out.extend((text[done:a], f"[{kind.upper()}]"))
        done = max(done, b)
    return "".join(out) + text[done:]


def redact(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """docs with personal data replaced by marks; null texts stay null, other columns as they are."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        new = pa.array([t and redact_text(t, sent.value.spans(t)[1]) for t in batch.column(at).to_pylist()], pa.string())
        return pa.RecordBatch.from_arrays([new if k == at else c for k, c in enumerate(batch.columns)], names=batch.schema.names)

    return arrow_map(docs, run, ", ".join(f"`{c}` {k}" for c, k in docs.dtypes))
