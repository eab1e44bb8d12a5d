"""Language-model scoring with an Elias-Fano n-gram trie of three levels.

Level 1 is the words: their hashes are a monotone Elias-Fano sequence, found by successor search, and
their counts lie beside it in as few bits as the largest needs (the base score asks for exact ones).
Level 2 is the followers of each word and level 3 those of each pair, both of one form: pointers and
followers are monotone Elias-Fano sequences, followers made so by adding to each context's ids the last
value of the context before. A context is the rank of a word or pair in the level above, so an n-gram is
found by a successor search inside its context's range. Its smoothed probability is a code of eight bits,
spread evenly over the logarithms that a corpus of this size can have, so that none is clipped; a pair's
count, which weighs its followers against the shorter context, is one of 256 counts in geometric steps up to
the number of tokens, taken upwards. The levels lie in files by key range, which workers map into memory
where the file system is local, and else hold in a memory of bounded bytes; so what a worker holds doesn't
grow with the corpus.

p(w | uv) = (c(uvw) + M p(w | v)) / (c(uv) + M), p(w | v) = (c(vw) + M p(w)) / (c(v) + M),
p(w) = (c(w) + 0.5) / (N + 0.5 (V + 1)): followers of a context are drawn towards those of the shorter one, and
unknown words have one share of the words' own frequencies. A text's first token has the context of a
text's beginning, and its second the pair of that and the first.

Counts come from all training documents. A task counts its whole part before anything moves; counts move
as sorted blocks of bytes, one for each key range, and are merged there.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkgraph.llm import eliasfano
from linkgraph.llm.common import U64, cut, gathered, scratch, slices, small_batches, text_bytes, word_hashes, words_of
from linkgraph.llm.warc import file_system

#: The hash that stands for a text's end.
END = U64(0x1)
#: Weight of the shorter context among a context's followers.
M = 20.0
#: Stands for an n-gram that can't be in the model.
NONE = U64(2**64 - 1)
#: Keys of one range, about.
RANGE_KEYS = 3_000_000
#: A task merges its keys when it holds so many.
HELD_KEYS = 3_000_000
#: Bytes of files that a worker holds where they can't be mapped.
HELD_BYTES = 256 << 20
SAMPLE_KEYS = 512
#: Bytes of text whose keys are looked up together, between these bounds so many for each shard of a level: each lookup visits every shard, which costs the same for few keys as for many.
TOGETHER_BYTES = (8 << 20, 16 << 20)
SHARD_BYTES = 16 << 10


@dataclass(frozen=True)
class Shard:
    path: str
    first: int
    n: int


@dataclass(frozen=True)
class Model:
    """words: shards by hash; pairs and triples: shards by (context << shift | follower), words and pairs by rank; bounds: first key of each shard."""

    words: tuple[Shard, ...]
    pairs: tuple[Shard, ...]
    triples: tuple[Shard, ...]
    word_bounds: np.ndarray
    pair_bounds: np.ndarray
    triple_bounds: np.ndarray
    n_words: int
    n_tokens: int
    n_texts: int

    @property
    def step(self) -> float:
        """Of the 256 codes of log10 probabilities, from 0 down to that of one in all tokens."""
        return math.log10(self.n_tokens + self.n_texts + M + 10) / 255

    @property
    def shift(self) -> int:
        """Bits of a word's rank."""
        return max(1, self.n_words.bit_length())

    @property
    def counts(self) -> np.ndarray:
        """The counts that a pair's code stands for; every count up to the first gap, then geometric steps."""
        return np.unique(np.ceil(np.geomspace(1, max(2, self.n_tokens), 256)))

    @property
    def together(self) -> int:
        """Bytes of text whose keys are looked up together."""
        return int(np.clip(SHARD_BYTES * max(len(self.words), len(self.pairs), len(self.triples)), *TOGETHER_BYTES))

    def code(self, p: np.ndarray) -> np.ndarray:
        return np.clip(np.round(-np.log10(p) / self.step), 0, 255).astype(np.uint8)


_held: dict[str, tuple[Words | Followers, int]] = {}


def level(path: str, kind: type[Words] | type[Followers]) -> Words | Followers:
    """The level in a file: mapped where the file system is local, else read; held while HELD_BYTES allow it."""
    if (got := _held.pop(path, None)) is None:
        fs, name = file_system(path)
        if fs.type_name == "local":
            words = np.asarray(np.memmap(name, U64, "r"))
            got = kind(words), words.nbytes // 8  # of a mapped level only what is derived from it takes memory
        else:
            with fs.open_input_file(name) as f:
                words = np.frombuffer(f.read(), U64)
            got = kind(words), words.nbytes + words.nbytes // 8
    _held[path] = got  # the latest is last
    while len(_held) > 1 and sum(n for _, n in _held.values()) > HELD_BYTES:
        del _held[next(iter(_held))]
    return got[0]


def save(folder: str, name: str, words: np.ndarray) -> str:
    """Writes a file under a name of this attempt."""
    fs, at = file_system(folder)
    fs.create_dir(at, recursive=True)
    path = f"{at}/{name}-{TaskContext.get().taskAttemptId()}.bin"
    with fs.open_output_stream(path, compression=None) as f:
        f.write(np.ascontiguousarray(words, U64).data)
    return f"{folder.partition('://')[0]}://{path}" if "://" in folder and fs.type_name != "local" else path


def tokens_of(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (of 63 bits) of all tokens of the texts, each text's end included, and where each text begins (one more place at the end)."""
    hashes, sizes = [np.zeros(0, U64)], [np.zeros(0, np.int64)]
    for part in slices(pa.RecordBatch.from_arrays([col], names=["text"])):
        raw, off = text_bytes(part.column(0))
        starts, ends, doc = words_of(raw, off)
        n = np.bincount(doc, minlength=part.num_rows) + 1
        out = np.full(n.sum(), END)
        out[np.arange(len(doc)) + doc] = word_hashes(raw, starts, ends, lower=True) >> U64(1)
        hashes.append(out)
        sizes.append(n)
    return np.concatenate(hashes), np.concatenate([[0], np.cumsum(np.concatenate(sizes))])


def merge(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    k, c = np.concatenate(keys), np.concatenate(counts)
    if not len(k):
        return k, c
    order = np.argsort(k, kind="stable")
    k = k[order]
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    return k[first], np.add.reduceat(c[order], first)


def to_bytes(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted keys and their counts; differences by byte planes, so that compression finds the zeros."""
    step = np.diff(keys, prepend=U64(0))
    planes = [np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8).T).tobytes() for x in (step, counts.astype(U64))]
    return zlib.compress(b"".join(planes), 1)


def from_bytes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(zlib.decompress(data), np.uint8)
    half = len(raw) // 2
    step, counts = (np.ascontiguousarray(x.reshape(8, -1).T).view(U64).ravel() for x in (raw[:half], raw[half:]))
    return np.cumsum(step, dtype=U64), counts.astype(np.int64)


def counted(texts: DataFrame, keys_of: Callable[[pa.Array], np.ndarray], bounds: np.ndarray, finish: Callable[[int, np.ndarray, np.ndarray], tuple[str, int, int]], together: int = TOGETHER_BYTES[0]) -> DataFrame:
    """Counts keys_of all texts (one column), by range, and gives each range's merged keys and counts to finish: (range, path, first, n, total)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, held = [], [], 0
        for part in gathered(batches, together):
            k, c = np.unique(keys_of(part.column(0)), return_counts=True)
            keys.append(k)
            counts.append(c)
            held += len(k)
            if held > HELD_KEYS:
                k, c = merge(keys, counts)
                keys, counts, held = [k], [c], len(k)
                if held > HELD_KEYS // 2:  # a large part goes out in several blocks
                    yield from blocks(k, c)
                    keys, counts, held = [], [], 0
        if keys:
            yield from blocks(*merge(keys, counts))

    def blocks(k: np.ndarray, c: np.ndarray) -> Iterator[pa.RecordBatch]:
        edges = [0, *np.searchsorted(k, bounds[1:]).tolist(), len(k)]
        for r, (lo, hi) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            if hi > lo:
                yield pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), pa.array([to_bytes(k[lo:hi], c[lo:hi])], pa.binary())], names=["range", "block"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, keys, counts, held = None, [], [], 0

        def close() -> pa.RecordBatch:
            k, c = merge(keys, counts)
            path, first, n = finish(now, k, c)
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([path]), pa.array([first], pa.int64()), pa.array([n], pa.int64()), pa.array([int(c.sum())], pa.int64())], names=["range", "path", "first", "n", "total"])

        for batch in batches:
            for r, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if r != now and keys:
                    yield close()
                    keys, counts, held = [], [], 0
                now = r
                k, c = from_bytes(data.as_py())
                keys.append(k)
                counts.append(c)
                held += len(k)
                if held > 2 * HELD_KEYS:
                    k, c = merge(keys, counts)
                    keys, counts, held = [k], [c], len(k)
        if keys:
            yield close()

    small_batches(texts.sparkSession)
    moved = texts.mapInArrow(count, "range int, block binary").repartitionById(max(1, len(bounds)), "range").sortWithinPartitions("range")
    return cut(moved.mapInArrow(gather, "range int, path string, first long, n long, total long"))


class Words:
    """A shard of words: their hashes in order, and their counts."""

    def __init__(self, words: np.ndarray) -> None:
        self.bits, n_hash = (int(x) for x in words[:2])
        self.hashes = eliasfano.Sequence(words[2 : 2 + n_hash])
        self.packed = words[2 + n_hash :]

    @staticmethod
    def encode(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        bits = int(counts.max(initial=1)).bit_length()
        h = eliasfano.encode(hashes)
        return np.concatenate([np.array([bits, len(h)], U64), h, eliasfano.pack(counts.astype(U64), bits)])

    def counts(self, at: np.ndarray) -> np.ndarray:
        return eliasfano.unpack(self.packed, self.bits, at).astype(np.int64)


def word_ids(model: Model, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank and count of each word (of sorted, different hashes); -1 and 0 for unknown ones."""
    ids, counts = np.full(len(hashes), -1), np.zeros(len(hashes), np.int64)
    edges = [0, *np.searchsorted(hashes, model.word_bounds[1:]).tolist(), len(hashes)]
    for shard, lo, hi in zip(model.words, edges[:-1], edges[1:], strict=True):
        if hi > lo and shard.n:
            words = level(shard.path, Words)
            n = hi - lo
            at = words.hashes.find(hashes[lo:hi], np.zeros(n, np.int64), np.full(n, shard.n))
            ok = at >= 0
            ids[lo:hi][ok] = shard.first + at[ok]
            counts[lo:hi][ok] = words.counts(at[ok])
    return ids, counts


def tokens_known(model: Model, col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranks and counts of the texts' tokens, and where each text begins."""
    tokens, begin = tokens_of(col)
    words, inv = np.unique(tokens, return_inverse=True)
    ids, counts = word_ids(model, words)
    return ids[inv], counts[inv], begin


def pair_keys(model: Model, ids: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Key of each token and the one before it, which for a text's first is its beginning, of rank n_words."""
    before = np.concatenate([[model.n_words], ids[:-1]])
    before[begin[:-1]] = model.n_words
    return key_of(model, before, ids)


def triple_keys(model: Model, ids: np.ndarray, pair_ranks: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Key of each token and the pair before it; a text's first has none."""
    before = np.concatenate([[-1], pair_ranks[:-1]])
    before[begin[:-1]] = -1
    return key_of(model, before, ids)


def key_of(model: Model, context: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """context << shift | id; NONE where either is unknown."""
    out = (context.astype(U64) << U64(model.shift)) | ids.astype(U64)
    out[(context < 0) | (ids < 0)] = NONE
    return out


class Followers:
    """A shard of pairs or triples: pointers of each context in its range, followers, codes of probabilities, and codes of counts if given."""

    def __init__(self, words: np.ndarray) -> None:
        self.shift, self.low, n_ptr, n_fol, self.n, n_codes = (int(x) for x in words[:6])
        self.pointers = eliasfano.Sequence(words[6 : 6 + n_ptr])
        self.followers = eliasfano.Sequence(words[6 + n_ptr : 6 + n_ptr + n_fol])
        at = 6 + n_ptr + n_fol
        self.codes, self.counts = words[at : at + n_codes].view(np.uint8), words[at + n_codes :].view(np.uint8)

    @staticmethod
    def split(keys: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
        return (keys >> U64(shift)).astype(np.int64), keys & U64((1 << shift) - 1)

    @staticmethod
    def encode(keys: np.ndarray, shift: int, codes: np.ndarray, counts: np.ndarray | None = None) -> np.ndarray:
        context, follower = Followers.split(keys, shift)
        low = int(context[0])
        pointers = np.searchsorted(context, np.arange(low, int(context[-1]) + 2))
        heads = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
        lasts = np.append(heads[1:], len(context)) - 1
        base = np.concatenate([[0], np.cumsum(follower[lasts] + U64(1))[:-1]]).astype(U64)  # the last value of the context before
        values = follower + U64(1) + np.repeat(base, lasts - heads + 1)
        p, f = eliasfano.encode(pointers), eliasfano.encode(values)
        tail = [np.pad(x, (0, -len(x) % 8)).view(U64) for x in (codes, counts) if x is not None]
        return np.concatenate([np.array([shift, low, len(p), len(f), len(keys), len(tail[0])], U64), p, f, *tail])

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Places of sorted keys in the shard; -1 where there is none."""
        context, follower = Followers.split(keys, self.shift)
        context -= self.low
        out = np.full(len(keys), -1)
        first, last = np.searchsorted(context, [0, self.pointers.n - 1])
        context, follower = context[first:last], follower[first:last]
        if not len(context):
            return out
        new = np.concatenate([[True], context[1:] != context[:-1]])
        heads = context[new]  # each context's range is looked up once
        lo, hi = self.pointers.get(heads).astype(np.int64), self.pointers.get(heads + 1).astype(np.int64)
        base = np.zeros(len(heads), U64)
        later = np.flatnonzero((lo > 0) & (lo < hi))
        base[later] = self.followers.get(lo[later] - 1)
        of = np.cumsum(new) - 1
        some = np.flatnonzero((lo < hi)[of])
        of = of[some]
        out[first + some] = self.followers.find(base[of] + follower[some] + U64(1), lo[of], hi[of])
        return out


def found(shards: tuple[Shard, ...], bounds: np.ndarray, keys: np.ndarray, counted_too: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rank, code of probability and, if asked, code of count of each key; -1 where it isn't in the model."""
    some, inv = np.unique(keys, return_inverse=True)
    n = len(some) - int(len(some) > 0 and some[-1] == NONE)
    ranks, codes, counts = (np.full(len(some), -1, kind) for kind in (np.int64, np.int16, np.int16))
    edges = [0, *np.searchsorted(some[:n], bounds[1:]).tolist(), n]
    for shard, lo, hi in zip(shards, edges[:-1], edges[1:], strict=True):
        if hi > lo and shard.n:
            own = level(shard.path, Followers)
            at = own.find(some[lo:hi])
            hit = np.flatnonzero(at >= 0)
            at, hit = at[hit], hit + lo
            ranks[hit], codes[hit] = shard.first + at, own.codes[at]
            if counted_too:
                counts[hit] = own.counts[at]
    return ranks[inv], codes[inv], counts[inv]


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 1, F.lit(False))


def bounds_of(texts: DataFrame, keys_of: Callable[[pa.Array], np.ndarray], n_keys: int, together: int = TOGETHER_BYTES[0]) -> np.ndarray:
    """First keys of ranges of about RANGE_KEYS keys each, from SAMPLE_KEYS keys of each of the parts; results don't depend on them."""

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng, kept = np.random.default_rng(TaskContext.get().partitionId()), []
        for part in gathered(batches, together):
            k = np.unique(keys_of(part.column(0)))
            kept.append(rng.choice(k, min(len(k), SAMPLE_KEYS), replace=False) if len(k) else k)
        k = np.concatenate(kept) if kept else np.zeros(0, U64)
        k = rng.choice(k, min(len(k), SAMPLE_KEYS), replace=False)
        yield pa.RecordBatch.from_arrays([pa.array(k.view(np.int64))], names=["k"])

    ranges = max(1, n_keys // RANGE_KEYS)
    if ranges == 1:
        return np.zeros(1, U64)
    got = np.sort(texts.sample(0.05, seed=3).mapInArrow(sample, "k long").toArrow()["k"].to_numpy().astype(np.int64).view(U64))
    inner = got[np.linspace(0, len(got), ranges + 1).astype(np.int64)[1:-1]] if len(got) else np.zeros(0, U64)
    return np.unique(np.concatenate([np.zeros(1, U64), inner]))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """The model of the documents whose crc32(id as text) mod 5 isn't 1; those without id are learnt from."""
    spark = docs.sparkSession
    folder = scratch(spark, "ngrams")
    texts = docs.filter(~held_out(id_col)).select(F.col(text_col).cast("string").alias("_text"))
    n_texts, n_bytes = texts.agg(F.count("*"), F.sum(F.octet_length("_text"))).first()
    n_guess = (n_bytes or 0) // 6
    # Hashes are spread evenly, so their ranges are cut evenly.
    n_ranges = max(1, n_guess // (4 * RANGE_KEYS))
    word_bounds = np.array([(r << 63) // n_ranges for r in range(n_ranges)], U64)

    def word_file(r: int, k: np.ndarray, c: np.ndarray) -> tuple[str, int, int]:
        return save(folder, f"words-{r}", Words.encode(k, c)), 0, len(k)

    got = counted(texts, lambda col: tokens_of(col)[0], word_bounds, word_file).orderBy("range").collect()
    by_range = {r["range"]: r for r in got}
    words, rank = [], 0
    for r in range(n_ranges):
        row = by_range.get(r)
        words.append(Shard(row["path"] if row else "", rank, row["n"] if row else 0))
        rank += words[-1].n
    n_tokens = sum(r["total"] for r in got)
    if 2 * rank.bit_length() > 64:
        raise ValueError(f"{rank} different words: a pair's key has 64 bits for two of them")
    none = np.zeros(1, U64)
    base = Model(tuple(words), (), (), word_bounds, none, none, rank, n_tokens, n_texts)
    pairs, pair_bounds = _followers(texts, base, n_guess, folder)
    n_pairs = sum(s.n for s in pairs)
    if base.shift + n_pairs.bit_length() > 64:
        raise ValueError(f"{rank} different words and {n_pairs} different pairs: a triple's key has 64 bits for one of each")
    model = replace(base, pairs=pairs, pair_bounds=pair_bounds)
    triples, triple_bounds = _followers(texts, model, n_guess, folder)
    return replace(model, triples=triples, triple_bounds=triple_bounds)


def _followers(texts: DataFrame, model: Model, n_guess: int, folder: str) -> tuple[tuple[Shard, ...], np.ndarray]:
    """The next level of a model: its shards and their bounds; that of pairs, or of triples if the model has pairs."""
    sent = texts.sparkSession.sparkContext.broadcast(model)
    third = bool(model.pairs)

    def keys(col: pa.Array) -> np.ndarray:
        m = sent.value
        ids, _, begin = tokens_known(m, col)
        out = pair_keys(m, ids, begin)
        if third:
            out = triple_keys(m, ids, found(m.pairs, m.pair_bounds, out)[0], begin)
        return out[out != NONE]

    def file(r: int, k: np.ndarray, c: np.ndarray) -> tuple[str, int, int]:
        m = sent.value
        heads, inv = np.unique(Followers.split(k, m.shift)[0], return_inverse=True)
        totals = np.empty(len(heads))
        for s in m.pairs if third else m.words:
            own = np.flatnonzero((heads >= s.first) & (heads < s.first + s.n))
            if len(own):
                at = heads[own] - s.first
                totals[own] = m.counts[level(s.path, Followers).counts[at]] if third else level(s.path, Words).counts(at)
        if not third:
            totals[heads == m.n_words] = m.n_texts
        codes = m.code(c / (totals[inv] + M))
        counts = None if third else np.searchsorted(m.counts, c).astype(np.uint8)
        return save(folder, f"{'triples' if third else 'pairs'}-{r}", Followers.encode(k, m.shift, codes, counts)), 0, len(k)

    bounds = bounds_of(texts, keys, n_guess, model.together)
    rows = {r["range"]: r for r in counted(texts, keys, bounds, file, model.together).collect()}
    shards, first = [], 0
    for r in range(len(bounds)):
        shards.append(Shard(rows[r]["path"], first, rows[r]["n"]) if r in rows else Shard("", first, 0))
        first += shards[-1].n
    return tuple(shards), bounds


def scored(m: Model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The columns of score for batches of id, held_out and text."""
    sizes = m.counts
    for part in gathered(batches, m.together):
        ids, counts, begin = tokens_known(m, part.column(2))
        p1 = (counts + 0.5) / (m.n_tokens + 0.5 * (m.n_words + 1))
        ranks, codes, pair_counts = found(m.pairs, m.pair_bounds, pair_keys(m, ids, begin), counted_too=True)
        context = np.concatenate([[m.n_texts], counts[:-1]]).astype(np.float64)
        context[begin[:-1]] = m.n_texts
        p2 = np.where(codes >= 0, 10.0 ** (codes * -m.step), 0.0) + M / (context + M) * p1
        codes = found(m.triples, m.triple_bounds, triple_keys(m, ids, ranks, begin))[1]
        context = np.concatenate([[0.0], np.where(pair_counts >= 0, sizes[pair_counts], 0.0)[:-1]])
        context[begin[:-1]] = 0.0  # nothing stands before the beginning
        p = np.where(codes >= 0, 10.0 ** (codes * -m.step), 0.0) + M / (context + M) * p2
        first = begin[:-1]
        sums = [np.add.reduceat(x, first) for x in (np.log10(p1), np.log10(p))]
        known = np.add.reduceat((counts > 0).astype(np.int64), first)
        yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(np.diff(begin)), pa.array(known), pa.array(np.full(len(first), m.n_tokens)), *(pa.array(s) for s in sums)], names=[part.schema.names[0], "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of docs: its id, held_out, n_tokens, n_known, train_tokens, base_score and score.

    Words are `[^\\x20\\x09-\\x0D]+`, A-Z lowered, and each text has one end token; null and empty texts
    have that alone. Without training documents every token is unknown.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return scored(sent.value, batches)

    rows = docs.select(F.col(id_col), held_out(id_col).alias("held_out"), F.col(text_col).cast("string").alias("_text"))
    return rows.mapInArrow(run, f"{id_col} {dict(docs.dtypes)[id_col]}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
