"""SentencePiece encoding and decoding for merge-type vocabularies.

The agenda holds adjacent symbol pairs by score; the best is merged, ties from the left, until none
is in the vocabulary. Where no piece holds two characters side by side, no merge can reach across them,
so a text falls apart there: before runs of space marks, between letters and other characters, and
around characters that no piece joins with others. A worker remembers the parts that it met lately, in
a memory that is bounded by bytes.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterable, Sequence
from itertools import chain, pairwise

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkgraph.llm.common import arrow_map

SPACE = "▁"
#: Bytes of parts that a worker remembers, about. It has two halves: when the newer is full it becomes the older, and what
#: the older held and hasn't been met since is forgotten. So frequent parts stay; results don't depend on it.
MEMORY_BYTES = 48 << 20
#: What a remembered part takes beside its characters and ids: its place in a dictionary, and the heads of a string and a tuple.
_ENTRY_BYTES = 200
#: Characters of parts whose agenda is a list.
SHORT = 40
_NEVER = float("inf")
_LOADED: dict[str, Encoder] = {}


def splitter(pieces: list[str]) -> re.Pattern[str]:
    """Of a text with space marks, the parts that no merge reaches across, for a vocabulary with these pieces of two characters or more."""
    beside = {p[i : i + 2] for p in pieces for i in range(len(p) - 1)}
    joined = {c for p in pieces for c in p} - {SPACE}
    letters = {c for c in joined if c.isalnum()}
    while glued := {c for b in beside if SPACE not in b and (b[0] in letters) != (b[1] in letters) for c in b if c in letters}:
        letters -= glued
    classes = ["[" + "".join(map(re.escape, sorted(s))) + "]+" for s in (letters, joined - letters) if s]
    return re.compile(f"{SPACE}*(?:{'|'.join([*classes, f'[^{SPACE}]'])})|{SPACE}+$", re.DOTALL)


class Encoder:
    """Encoder of a model of merge type with identity normalisation and byte fallback.

    Other kinds of model are refused. check=True holds each part, when it is first met, against the
    sentencepiece library and raises ValueError at any difference.
    """

    def __init__(self, model_file: str, check: bool = True) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        self.library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        spec = pb.ModelProto()
        with open(model_file, "rb") as f:
            spec.ParseFromString(f.read())
        norm, train = spec.normalizer_spec, spec.trainer_spec
        if train.model_type != 2 or norm.name != "identity" or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not (norm.escape_whitespaces and train.byte_fallback):
            raise ValueError("the model isn't of merge type with identity normalisation and byte fallback")
        self.dummy = SPACE if norm.add_dummy_prefix else ""
        self.pieces = {p.piece: i for i, p in enumerate(spec.pieces) if p.type == 1}
        self.costs = {p.piece: -p.score for p in spec.pieces if p.type == 1 and len(p.piece) > 1}
        if any(p.type not in (1, 2, 3, 6) for p in spec.pieces) or any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.pieces):
            raise ValueError("the vocabulary has pieces of other kinds, or with a space mark inside")
        whole = pb.ModelProto()
        whole.CopyFrom(spec)
        whole.normalizer_spec.add_dummy_prefix = False
        self.by_part = sentencepiece.SentencePieceProcessor(model_proto=whole.SerializeToString())  # which takes a part as it is
        self.bytes = [self.library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.end = self.library.eos_id()
        self.check = check
        self.known: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.held = 0
        self.split = splitter([*self.costs]).findall

    def merge(self, part: str) -> tuple[int, ...]:
        """Ids of a part by the score-ordered agenda: a list for a short part, a heap for a long one."""
        symbols = list(part)
        if len(symbols) > SHORT:
            self.merge_long(symbols)
        else:
            cost = self.costs.get
            agenda = [cost(a + b, _NEVER) for a, b in pairwise(symbols)]
            while agenda and (best := min(agenda)) != _NEVER:
                i = agenda.index(best)
                del agenda[i]
                symbols[i] = both = symbols[i] + symbols.pop(i + 1)
                if i < len(agenda):
                    agenda[i] = cost(both + symbols[i + 1], _NEVER)
                if i:
                    agenda[i - 1] = cost(symbols[i - 1] + both, _NEVER)
        out: list[int] = []
        for s in symbols:
            if s:
                if (hit := self.pieces.get(s)) is not None:
                    out.append(hit)
                else:
                    out.extend(self.bytes[b] for b in s.encode())
        return tuple(out)

    def merge_long(self, symbols: list[str]) -> None:
        """Merges symbols in place; those that went into another are empty."""
        costs, n = self.costs, len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda: list[tuple[float, int, int, str]] = []
        for i in range(n - 1):
            both = symbols[i] + symbols[i + 1]
            if (cost := costs.get(both)) is not None:
                agenda.append((cost, i, i + 1, both))
        heapq.heapify(agenda)
        while agenda:
            _, i, j, both = heapq.heappop(agenda)
            if not symbols[i] or not symbols[j] or len(symbols[i]) + len(symbols[j]) != len(both):
                continue  # one of the two has since been merged
            symbols[i], symbols[j] = both, ""
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (cost := costs.get(more := both + symbols[k])) is not None:
                    heapq.heappush(agenda, (cost, i, k, more))
            if (h := before[i]) >= 0 and (cost := costs.get(more := symbols[h] + both)) is not None:
                heapq.heappush(agenda, (cost, h, i, more))

    def parts(self, texts: Iterable[str]) -> list[list[str]]:
        """The texts' parts; those not met before are encoded, and checked as one batch."""
        if self.held > MEMORY_BYTES // 2:
            self.known, self.older, self.held = {}, self.known, 0
        split, known, older, held = self.split, self.known, self.older, 0
        out = [split(self.dummy + t.replace(" ", SPACE)) if t else [] for t in texts]
        new = []
        for p in {p for parts in out for p in parts if p not in known}:
            if (ids := older.get(p)) is None:
                ids = self.merge(p)
                new.append(p)
            known[p] = ids
            held += _ENTRY_BYTES + 4 * len(p) + 8 * len(ids)
        self.held += held
        if self.check and new:
            for p, ids in zip(new, self.by_part.encode(new, num_threads=1), strict=True):
                if tuple(ids) != known[p]:
                    raise ValueError(f"the agenda and the library differ on {p!r}")
        return out

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        """Ids of each text, with the end id; null is an empty text."""
        split = self.parts([t or "" for t in texts])
        ids = self.known.__getitem__
        return [[*chain.from_iterable(map(ids, parts)), self.end] for parts in split]

    def decode(self, ids: list[list[int]]) -> list[str]:
        return [self.library.decode(x) for x in ids]


def encoder(model_file: str, check: bool = True) -> Encoder:
    """The worker's encoder of this file."""
    if model_file not in _LOADED:
        _LOADED[model_file] = Encoder(model_file, check)
    return _LOADED[model_file]


def encode(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text", digests: bool = False, check: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """One row per row of docs: its id, n_tokens, then ids and decoded, or their SHA-256 if digests is set, then the columns to keep.

    ids ends with the end id; decoded is the library's decode(ids). A null or empty text has the end
    id only. Repeated rows and ids give repeated rows; columns other than those named are not read. A
    column to keep whose name is one of those made here, in any case, is an error.
    model_file must be readable on every executor, as an installed package is.
    """
    kind = dict(docs.dtypes)[id_col]
    schema = f"{id_col} {kind}, n_tokens long, " + ("ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string")
    names = [id_col, "n_tokens", *(("ids_sha256", "decoded_sha256") if digests else ("ids", "decoded"))]
    if clash := {c.lower() for c in keep} & {c.lower() for c in names}:
        raise ValueError(f"can't keep {sorted(clash)}: results have these names")
    schema = ", ".join([schema, *(f"`{c}` {dict(docs.dtypes)[c]}" for c in keep)])
    names = [*names, *keep]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        enc = encoder(model_file, check)
        ids = enc.encode(batch.column(1).to_pylist())
        texts = enc.decode(ids)
        counts = pa.array([len(x) for x in ids], pa.int64())
        if digests:
            names_of = enc.__dict__.setdefault("names", [str(i) for i in range(enc.library.get_piece_size())])
            last = [pa.array([hashlib.sha256(" ".join(map(names_of.__getitem__, x)).encode()).hexdigest() for x in ids], pa.string()), pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts], pa.string())]
        else:
            last = [pa.array(ids, pa.list_(pa.int32())), pa.array(texts, pa.string())]
        return pa.RecordBatch.from_arrays([batch.column(0), counts, *last, *batch.columns[2:]], names=names)

    return arrow_map(docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"), *keep), run, schema)
